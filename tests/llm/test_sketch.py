import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from tabflow.llm import scaled_sketch
from tabflow.llm.common import utf8
from tabflow.llm.queries import QUERIES
from tabflow.llm.scaled_sketch import containment, decoded, edited_likeness, likeness, merge, sketch_documents, sketches


def sketch(text, **how):
    return sketches(*utf8(pa.array([text])), **how)[0]


def plain_rows(rows):
    """(id, n_chars, edited sha, fingerprint of text and edit) with the next row by id, nulls first, then text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        q = len(t) // 4
        edit = t[:len(t) - q] + u[:q]
        a, b, c = sketch(t), sketch(edit), sketch(u)
        hexes = ["".join(f"{int(h):016x}" for h in s) for s in (a, b)]
        yield (str(i), len(t), hashlib.sha256(edit.encode()).hexdigest(), *hexes, likeness(a, b), likeness(a, c))


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_neighbours(spark, odd_texts, monkeypatch):
    rows = [(i * 3, t) for i, t in enumerate(odd_texts)] + [(4, "twin"), (4, "twin"), (None, "b"), (None, None), (None, "a"), (-7, "é" * 9)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, place int").repartition(5)
    for size in (4 << 20, 2000):
        monkeypatch.setattr(scaled_sketch, "RANGE_BYTES", size)
        assert found(edited_likeness(df)) == sorted(plain_rows(rows))
    one = spark.createDataFrame([(1, "abcdefgh ij")], "doc_id long, text string")
    assert found(edited_likeness(one)) == sorted(plain_rows([(1, "abcdefgh ij")]))
    assert edited_likeness(df.limit(0)).count() == 0 and sketch_documents(df.limit(0)).count() == 0
    assert {r.doc_id for r in sketch_documents(df).collect()} == {i for i, _ in rows}


@pytest.mark.parametrize("base", [2**60, -(2**62), 2**63 - 600, -(2**63), 0])
def test_no_row_is_lost_for_any_id(spark, monkeypatch, base):
    """Ids that doubles can't tell apart, in many ranges."""
    monkeypatch.setattr(scaled_sketch, "RANGE_BYTES", 300)
    rows = [(base + i, f"text {i % 7} of row {i} " * (1 + i % 3)) for i in range(500)] + [(base + 250, "same id")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(edited_likeness(df)) == sorted(plain_rows(rows))


def test_a_missing_successor_fails(spark, monkeypatch):
    monkeypatch.setattr(scaled_sketch, "RANGE_BYTES", 300)
    monkeypatch.setattr(scaled_sketch, "_bounds", lambda rows, n, count: np.array([50, 1001], np.int64))  # 1001 is no id of the table
    df = spark.createDataFrame([(i, f"text {i}") for i in range(0, 2000, 2)], "doc_id long, text string")
    with pytest.raises(PySparkException, match="is missing"):
        edited_likeness(df).collect()


def test_one_very_long_text(spark):
    rows = [(1, "a few words only"), (2, "long words again " * 600_000), (3, None)]
    assert found(edited_likeness(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(plain_rows(rows))


def test_estimates():
    random.seed(1)
    words = [f"w{random.randint(0, 10**6)}" for _ in range(40_000)]
    whole, part = sketch(" ".join(words)), sketch(" ".join(words[:4000]))
    assert abs(containment(whole, part) - 0.1) < 0.03 and containment(part, whole) == 1 == likeness(part, whole)
    other = sketch(" ".join(words[20_000:] + words[:20_000]))
    assert likeness(whole, other) > 0.99
    halves = [sketch(" ".join(words[a:a + 20_000])) for a in (0, 20_000)]
    assert len(np.setxor1d(merge(halves), whole)) <= 4
    assert np.array_equal(decoded("".join(f"{int(h):016x}" for h in whole)), whole)
    assert likeness(sketch(""), sketch(" ")) == 1 and likeness(sketch(""), sketch("a")) == 0
    assert len(sketch("a")) == 1 and np.array_equal(sketch("a b"), sketch(" a\nb\t"))
    every = sketch("a b c d e f g", fraction=1)
    assert len(every) == 3


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = found(QUERIES["op8_document_fingerprints"](spark, sf_dir))
    assert got == sorted(plain_rows(rows))
    assert np.mean([r[5] for r in got]) > 0.6 > 0.2 > np.mean([r[6] for r in got])
