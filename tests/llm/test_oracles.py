"""The registered queries of the subpackage: those with an oracle against it, all for their whole table."""

import __spark_entry__
import pytest
from check import compare, connect

from tabflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, sf_dir, key):
    assert compare(QUERIES[key](spark, sf_dir), connect(sf_dir), ORACLES[key]) is None


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_every_row_has_a_result(spark, sf_dir):
    for key, query in QUERIES.items():
        if key.split("_")[0] in ("op3", "op12", "op13"):
            continue  # one row per sequence, phrase or negative; what they are made of is checked by itself
        name, column = ("embeddings", "vec_id") if key.startswith("op5_") else ("documents", "doc_id")
        ids = [r[0] for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(column).collect()]
        assert sorted(r[0] for r in query(spark, sf_dir).select(column).collect()) == sorted(ids), key
