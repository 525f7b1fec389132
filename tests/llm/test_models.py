import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tabflow.llm import gru_langid, quality_mil
from tabflow.llm.common import fair_share, utf8
from tabflow.llm.queries import QUERIES


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def numeric(weights, loss, name, at, step=1e-3):
    weights[name].flat[at] += step
    up = loss()
    weights[name].flat[at] -= 2 * step
    down = loss()
    weights[name].flat[at] += step
    return (up - down) / (2 * step)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, quality_mil.FEATURES)).astype(np.float32)
    text = np.sort(rng.integers(0, 5, 30))
    text[:5] = np.arange(5)
    text = np.sort(text)
    y = np.array([0, 1, 1, 0, 1.0])
    model = quality_mil.train(x, text, y, epochs=1)
    first = np.searchsorted(text, np.arange(5))
    w = {k: np.array(v, np.float64) for k, v in model.weights.items()}

    def loss():
        p = quality_mil._forward(w, x.astype(np.float64), first)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    exact = quality_mil._gradients(w, x.astype(np.float64), first, y)
    for name in w:
        for at in rng.integers(0, w[name].size, 4):
            assert numeric(w, loss, name, at) == pytest.approx(np.asarray(exact[name]).flat[at], abs=2e-5)


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    chars, counts, y = rng.integers(97, 105, (6, 12)).astype(np.uint8), np.ones((6, 12), bool), np.array([0, 1, 2, 0, 1, 2])
    counts[0, 5:] = False
    model = gru_langid.train(chars, counts, y, ["a", "b", "c"], steps=2, batch=4)
    w = model.weights

    def loss():
        p = model.label(chars)
        return float(-(np.log(p[y, :, np.arange(6)].astype(np.float64)) * counts).sum() / counts.sum())

    exact = gru_langid._gradients(w, chars, counts, y)
    for name in w:
        top = np.argsort(-np.abs(exact[name]).ravel())[:3]
        for at in top:
            assert numeric(w, loss, name, at, 1e-2) == pytest.approx(exact[name].flat[at], abs=3e-3)


def plain_quality(model, text):
    """The score of one text, passage by passage and word by word."""
    data = text.encode()
    words = [(m.start(), m.group()) for m in re.finditer(rb"[^\t-\r ]+", data)]
    groups = [words[i:i + 64] for i in range(0, len(words), 64)] or [[]]
    w, encoded, gate = {k: np.array(v, float) for k, v in model.weights.items()}, [], []
    for n, group in enumerate(groups):
        x = np.zeros(quality_mil.FEATURES)
        if group:
            lo = group[0][0] if n else 0
            hi = groups[n + 1][0][0] if n + 1 < len(groups) else len(data)
            for b in data[lo:hi]:
                x[b if b < 128 else 128 + (b - 128) // 4] += 1
            x = np.sqrt(x / (hi - lo))
            sizes, k = [len(g) for _, g in group], len(group)
            x[160:] = [sum(a[1] == b[1] for a, b in zip(group, group[1:])) / k, len({g for _, g in group}) / k, np.mean(sizes) / 8, np.std(sizes) / 4, k / 64, np.log1p(k)]
        z = np.tanh((x - model.centre) / model.scale @ w["encode"] + w["encode0"])
        encoded.append(z)
        gate.append((np.tanh(z @ w["v"]) / (1 + np.exp(-(z @ w["u"])))) @ w["a"])
    share = np.exp(np.array(gate) - max(gate))
    bag = (share[:, None] / share.sum() * np.array(encoded)).sum(axis=0)
    return 1 / (1 + np.exp(-(bag @ w["out"] + w["out0"])))


def test_quality_scores_are_those_of_a_plain_pass(spark, odd_texts, sf_dir):
    """Each text by itself, whatever stands beside it in a batch."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality_mil.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = [t for t in odd_texts if t is not None] + [r.text for r in docs.limit(40).collect()] + ["   leading", "  \n  ", "trailing   ", " w" * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.score for r in quality_mil.score_quality(df, model).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain_quality(model, text), abs=2e-4)


def test_a_sample_of_long_texts_is_bounded(spark):
    """Passages of a long text are spread over it; the driver gets no more than its share of each."""
    texts = [(i, " ".join(f"w{i}{k}" for k in range(30_000)), 0) for i in range(3)] + [(9, "short", 0)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, n int")
    labels = spark.createDataFrame([(i, i % 2) for i in (0, 1, 2, 9)], "doc_id long, quality int")
    seen = []
    train, quality_mil.train = quality_mil.train, lambda x, text, y, **k: seen.append(np.bincount(text)) or train(x, text, y, epochs=1)
    try:
        quality_mil.learn(docs, labels, folds=1, held=5)
    finally:
        quality_mil.train = train
    assert sorted(seen[0]) == [1, 32, 32, 32]
    assert quality_mil.spread_over(1000, 3).tolist() in ([0, 500, 999], [0, 499, 999]) and quality_mil.spread_over(2, 3).tolist() == [0, 1]


def test_columns_that_differ_in_case(spark):
    df = spark.createDataFrame([(1, "a text", 3, 4)], "doc_id long, text string, Score int, PREDICTED int")
    out = quality_mil.score_quality(df, None, keep=True)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == 1


def plain_pool(model, text):
    """Mean probabilities of one text, window by window and byte by byte."""
    data, n = text.encode(), len(text.encode())
    total = np.zeros(len(model.languages))
    for nominal in range(0, n, gru_langid.WINDOW):
        begin = max(0, min(nominal, n - gru_langid.WINDOW))
        chunk = data[begin:begin + gru_langid.WINDOW].ljust(gru_langid.WINDOW, b"\0")
        p = model.label(np.frombuffer(chunk, np.uint8)[None, :])
        total += p[:, nominal - begin:min(n - begin, gru_langid.WINDOW), 0].sum(axis=1)
    return total / max(1, n)


def test_pooling_counts_every_byte_once():
    rng = np.random.default_rng(1)
    chars = rng.integers(97, 110, (40, gru_langid.WINDOW)).astype(np.uint8)
    model = gru_langid.train(chars, np.ones(chars.shape, bool), rng.integers(0, 2, 40), ["x", "y"], steps=3, batch=8)
    samples = ["", "a", "ab" * 48, "ab" * 48 + "c", "lorem ipsum é " * 40, "z" * 500]
    data, starts = utf8(pa.array(samples))
    p, _ = model.pool(data, starts)
    for got, text in zip(p, samples):
        assert got == pytest.approx(plain_pool(model, text), abs=1e-5)


def plain_language(model, text):
    """Mean probabilities of one text: every window byte by byte through both recurrences, with plain gates."""
    w = {k: np.array(v, float) for k, v in model.weights.items()}
    sigmoid = lambda a: 1 / (1 + np.exp(-a))
    data, n = text.encode(), len(text.encode())
    total = np.zeros(len(model.languages))
    for nominal in range(0, n, gru_langid.WINDOW):
        begin = max(0, min(nominal, n - gru_langid.WINDOW))
        chunk = data[begin:begin + gru_langid.WINDOW].ljust(gru_langid.WINDOW, b"\0")
        scores = np.tile(w["o"], (gru_langid.WINDOW, 1))
        for side in "fb":
            h = np.zeros(gru_langid.STATES)
            for t in range(gru_langid.WINDOW) if side == "f" else range(gru_langid.WINDOW - 1, -1, -1):
                z, r = (sigmoid(w[f"{side}x{g}"][chunk[t]] + h @ w[f"{side}h{g}"]) for g in "zr")
                new = np.tanh(w[f"{side}xn"][chunk[t]] + r * (h @ w[f"{side}hn"]))
                h = z * h + (1 - z) * new
                scores[t] += h @ w[f"{side}o"]
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        total += p[nominal - begin:min(n - begin, gru_langid.WINDOW)].sum(axis=0)
    return total / max(1, n)


def test_languages_are_those_of_a_plain_pass(spark, odd_texts, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = gru_langid.learn(docs)
    texts = [t[:700] for t in odd_texts if t] + [r.text[:900] for r in docs.limit(25).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for r in gru_langid.identify(df, model).collect():
        want = plain_language(model, texts[r.doc_id])
        if any(c.isalpha() for c in texts[r.doc_id]):
            assert r.score == pytest.approx(want.max(), abs=2e-4) and want[model.languages.index(r.lang_pred)] > want.max() - 4e-4


def test_odd_texts(spark, odd_texts):
    rows = [(i, t, "en" if i % 2 else "de", 1) for i, t in enumerate(odd_texts)] + [(None, "null id", None, 1), (3, "  ", "fr", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(i % 30, i % 2, None) for i in range(60)] + [(None, 1, 1), (2, None, 1), (4, 7, 1)], "doc_id long, quality int, toxic int")
    scored = quality_mil.score_quality(df, quality_mil.learn(df, labels)).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    kept = quality_mil.score_quality(df, None, keep=True)
    assert kept.columns == ["doc_id", "text", "lang", "score", "predicted"] and kept.where("score = 1").count() == len(rows)
    found = gru_langid.identify(df, gru_langid.learn(df, sample=50))
    for r in found.join(df.select("doc_id", "text"), "doc_id").collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("de", "en", "fr")) if lettered else (r.lang_pred, r.score) == ("und", 0.0)
    assert found.count() == len(rows)
    empty = df.limit(0)
    assert quality_mil.learn(empty, labels) is None and gru_langid.learn(empty) is None
    assert quality_mil.score_quality(empty, None).count() == 0 and gru_langid.identify(empty, None).count() == 0
    assert {r.lang_pred for r in gru_langid.identify(df, None).collect()} == {"und"}


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    held = [r for r in rows if r.doc_id in labels and r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    right = np.mean([r.predicted == labels[r.doc_id] for r in held])
    clean = np.mean([r.predicted for r in held if labels[r.doc_id] == 1])
    assert right > 0.97 and clean > 0.98


def test_held_out_language(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_language_id"](spark, sf_dir).collect()
    assert sorted(langs) == sorted(r.doc_id for r in rows)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.95


def test_labels_are_never_inputs(spark, sf_dir):
    """Documents without their labels, languages and sources get the same results from the same model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bare = docs.select("doc_id", "text")
    model = gru_langid.learn(docs)
    assert sorted(gru_langid.identify(docs, model).collect()) == sorted(gru_langid.identify(bare, model).collect())
    assert model.languages == ["de", "en", "es", "fr"]


def test_fair_share():
    assert [fair_share(c, 10) for c in ({}, {"a": 3}, {"a": 30}, {"a": 30, "b": 2}, {"a": 4, "b": 50, "c": 1, "d": 9})] == [0, 3, 10, 8, 3]


def test_a_rare_language_is_learnt(spark):
    """However few its rows, and beside any number of others, it is in the sample and can be predicted."""
    rows = [(i, "the cat sat on the mat", "en") for i in range(4000)] + [(-i, "ζω και βλέπω", "el") for i in range(1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = gru_langid.learn(docs, sample=40)
    assert model.languages == ["el", "en"]
    found = {r.lang_pred for r in gru_langid.identify(docs.where("doc_id < 0"), model).collect()}
    assert found == {"el"}


def test_a_rare_label_is_learnt(spark):
    rows = [(i, f"plain words of number {i}") for i in range(3000)] + [(-i, f"!!!! $$$$ #### {i} ;;;; ~~~~") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id >= 0) quality")
    scored = quality_mil.score_quality(docs, quality_mil.learn(docs, labels, sample=40)).collect()
    assert max(r.score for r in scored if r.doc_id < 0) < min(r.score for r in scored if r.doc_id >= 0)
