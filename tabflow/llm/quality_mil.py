"""A quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. Each passage becomes a vector of byte shares and word
statistics and is encoded by one tanh layer. Gated attention, tanh times sigmoid of two
projections, weighs the passages of a text; the weighted encoding gives the
score. All weights are learnt from document labels alone, by backpropagation in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.llm.common import by_bytes, fair_share, in_bucket, least_hashed, spare_name, span_hashes, utf8, value_counts, word_spans

PASSAGE_WORDS = 64
BYTE_KINDS = 160  # ASCII one by one, then the other bytes four at a time
FEATURES = BYTE_KINDS + 6
ENCODED, ATTENTION = 24, 12
SAMPLE_DOCS = 4000  # labelled documents to learn from
SAMPLE_PASSAGES = 32  # of a labelled document, spread over it: with SAMPLE_DOCS 85 MB on the driver at most
BATCH_BYTES = 1 << 20


def passage_features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, its text); a text without words has one passage of zeros."""
    begin, end, text = word_spans(data, starts)
    n_texts = len(starts) - 1
    words = np.bincount(text, minlength=n_texts)
    first_word = np.r_[0, np.cumsum(words)]
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    first_passage = np.r_[0, np.cumsum(passages)]
    of = first_passage[text] + (np.arange(len(begin)) - first_word[text]) // PASSAGE_WORDS
    total = int(first_passage[-1])
    size = np.bincount(of, minlength=total)
    x = np.zeros((total, FEATURES), np.float32)
    # A byte belongs to the passage of the last word of its text that begins at or before it, before the first word to the first.
    head = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    if len(head):
        own = text[head]
        opens, closes = np.r_[True, own[1:] != own[:-1]], np.r_[own[1:] != own[:-1], True]
        lo = np.where(opens, starts[own], begin[head])
        hi = np.where(closes, starts[own + 1], np.r_[lo[1:], len(data)])
        at = np.arange((hi - lo).sum()) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)
        where = np.repeat(of[head], hi - lo)
        kind = np.where(data < 128, data, 128 + (data.astype(np.int64) - 128) // 4).astype(np.int64)
        counts = np.bincount(where * BYTE_KINDS + kind[at], minlength=total * BYTE_KINDS).reshape(total, BYTE_KINDS)
        x[:, :BYTE_KINDS] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    h = span_hashes(data, begin, end)
    n = np.maximum(1, size)
    same = np.r_[False, (h[1:] == h[:-1]) & (of[1:] == of[:-1])] if len(h) else np.empty(0, bool)
    tagged = np.sort(of.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
    new = np.r_[True, tagged[1:] != tagged[:-1]] if len(h) else np.empty(0, bool)
    distinct = np.bincount((tagged[new] >> np.uint64(40)).astype(np.int64), minlength=total)
    length = (end - begin).astype(np.float64)
    mean = np.bincount(of, length, total) / n
    square = np.bincount(of, length * length, total) / n
    x[:, BYTE_KINDS:] = np.stack([
        np.bincount(of, same, total) / n, distinct / n, mean / 8, np.sqrt(np.maximum(0, square - mean * mean)) / 4,
        size / PASSAGE_WORDS, np.log1p(size)], axis=1)
    return x, np.repeat(np.arange(n_texts), passages)


def spread_over(n: int, most: int) -> np.ndarray:
    """All of n places, or ``most`` of them, evenly from the first to the last."""
    return np.arange(n) if n <= most else np.linspace(0, n - 1, most).round().astype(np.int64)


@dataclass
class AttentionModel:
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, x: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        return _forward(self.weights, (x - self.centre) / self.scale, np.searchsorted(text, np.arange(n_texts)))["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Every text has a passage; ``first`` is where its passages begin."""
    sizes = np.diff(np.r_[first, len(x)])
    z = np.tanh(x @ w["encode"] + w["encode0"])
    v, u = np.tanh(z @ w["v"]), _sigmoid(z @ w["u"])
    a = (v * u) @ w["a"]
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, first), sizes))
    a /= np.repeat(np.add.reduceat(a, first), sizes)
    bag = np.add.reduceat(a[:, None] * z, first, axis=0)
    p = _sigmoid((bag @ w["out"] + w["out0"]).astype(np.float64))
    return {"z": z, "v": v, "u": u, "a": a, "bag": bag, "p": p, "sizes": sizes}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, first)
    d = ((f["p"] - y) / len(y)).astype(np.float32)
    d_bag = np.repeat(d[:, None] * w["out"], f["sizes"], axis=0)
    d_a = (d_bag * f["z"]).sum(axis=1)
    d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, first), f["sizes"]))
    gate = d_e[:, None] * w["a"]
    d_v = gate * f["u"] * (1 - f["v"] ** 2)
    d_u = gate * f["v"] * f["u"] * (1 - f["u"])
    d_z = (f["a"][:, None] * d_bag + d_v @ w["v"].T + d_u @ w["u"].T) * (1 - f["z"] ** 2)
    return {"out": f["bag"].T @ d, "out0": d.sum(), "a": (f["v"] * f["u"]).T @ d_e, "v": f["z"].T @ d_v, "u": f["z"].T @ d_u,
            "encode": x.T @ d_z, "encode0": d_z.sum(axis=0)}


def train(x: np.ndarray, text: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.004,
          decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Adam on the cross entropy; ``text`` numbers the passages' texts in order, ``y`` has a label for each."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    x = ((x - centre) / scale).astype(np.float32)
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    base = np.clip(y.mean(), 0.01, 0.99)
    w = {"encode": draw(FEATURES, ENCODED), "encode0": np.zeros(ENCODED, np.float32), "v": draw(ENCODED, ATTENTION),
         "u": draw(ENCODED, ATTENTION), "a": draw(ATTENTION), "out": draw(ENCODED), "out0": np.float32(np.log(base / (1 - base)))}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    begin, step = np.searchsorted(text, np.arange(len(y) + 1)), 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            docs = order[lo:lo + batch]
            sizes = begin[docs + 1] - begin[docs]
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            rows = np.arange(sizes.sum()) - np.repeat(first, sizes) + np.repeat(begin[docs], sizes)
            step += 1
            pace = rate * (1 - epoch / epochs)
            for k, g in _gradients(w, x[rows], first, y[docs]).items():
                g = g + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                w[k] = (w[k] - pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return AttentionModel(centre.astype(np.float32), scale.astype(np.float32), w)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = SAMPLE_DOCS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AttentionModel | None:
    """A model from at most ``sample`` labelled documents outside the held-out fold, of each label all, or its share,
    those of the least hash of their id. The scores are those of the labels' own frequencies. Labels other than 0 and 1 and null ids are
    passed over; of several labels of an id the greatest counts, of several texts the last by bytes. None if nothing is left.
    What reaches the driver is the features of at most ``SAMPLE_PASSAGES`` passages of each document of the sample, evenly
    spread from its first to its last, so texts of any length are learnt from.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & (in_bucket("id", folds) != held))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    counts = value_counts(known, "y", 2)
    if not counts:
        return None
    few = least_hashed(known, "id", sample, "y", counts)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    # ``few`` has at most ``sample`` rows of two numbers, whatever the size of the tables.
    chosen = source.join(F.broadcast(few), "id").groupBy("id", "y").agg(F.max("text").alias("text")).select("y", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(1))
            for lo, hi in by_bytes(starts, BATCH_BYTES):
                x, text = passage_features(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                first = np.searchsorted(text, np.arange(hi - lo + 1))
                blobs = [x[a + spread_over(b - a, SAMPLE_PASSAGES)].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(blobs, pa.binary())], names=["y", "x"])

    kind = chosen.schema[0].dataType.simpleString()
    rows = sorted((bytes(r.x), int(r.y)) for r in chosen.mapInArrow(features, f"y {kind}, x binary").collect())
    if not rows:
        return None
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x, _ in rows]
    text = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    model = train(np.concatenate(parts), text, np.array([y for _, y in rows], np.float64))
    # A label that was thinned out counts as often as it occurs.
    thinned = {int(y): np.log(max(1, n / fair_share(counts, sample))) for y, n in counts.items()}
    model.weights["out0"] = np.float32(model.weights["out0"] + thinned.get(1, 0) - thinned.get(0, 0))
    return model


def score_quality(docs: DataFrame, model: AttentionModel | None, threshold: float = 0.3, id_col: str = "doc_id",
                  text_col: str = "text", keep: bool = False) -> DataFrame:
    """``id_col``, score (0 to 1) and predicted (1 if score >= ``threshold``) of every row.

    A null text counts as empty; it has one passage of zeros and is scored like any other. Without a
    model every row scores 1.0, so nothing is rejected. Rows are scored one by one, repeated
    ones alike. With ``keep`` all columns of ``docs`` come first instead, and columns
    named score or predicted, in any case, are replaced.
    """
    columns = [c for c in docs.columns if c.lower() not in ("score", "predicted")] if keep else [id_col]
    source = docs.select(*[F.col(c) for c in columns], F.col(text_col).cast("string").alias(spare_name(docs, "_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(len(columns)))
            scores = np.ones(batch.num_rows)
            if model is not None:
                for lo, hi in by_bytes(starts, BATCH_BYTES):
                    x, text = passage_features(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                    scores[lo:hi] = model.score(x, text, hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(scores)], names=[*columns, "score"])

    scored = source.mapInArrow(run, StructType(source.schema.fields[:len(columns)]).add("score", "double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
