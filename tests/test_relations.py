"""The files that Spark makes of the given tables for the queries."""

import pytest

from tabflow.checks import relations as rel
from tabflow.checks.queries import QUERIES

ROWS = 1000


@pytest.fixture
def tables(spark, tmp_path):
    """Three tables of ``ROWS`` rows and one of nations; made anew for each test, since what is made of them is remembered by their folder."""
    n = spark.range(ROWS)
    made = {
        "lineitem": n.selectExpr("id l_orderkey", "cast(id % 7 as double) l_quantity"),
        "events": n.selectExpr("id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) ts", "id % 9 user_id",
                               "concat('type', id % 3) event_type", "cast(id as double) value", "concat('{\"k\":', id, '}') props"),
        "customer": n.selectExpr("id c_custkey", "concat('c', id) c_name", "cast(id % 2 as int) c_nationkey", "1.5D c_acctbal", "'m' c_mktsegment"),
        "nation": spark.range(2).selectExpr("cast(id as int) n_nationkey", "concat('n', id) n_name"),
    }
    for name, rows in made.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def rows_by_file(spark, path, form):
    return [r["count"] for r in getattr(spark.read, form)(path).groupBy("_metadata.file_path").count().collect()]


MADE = {
    "lineitem": (lambda *at: rel.in_files(*at, "lineitem"), "parquet"),
    "events": (lambda *at: rel.in_files(*at, "events"), "parquet"),
    "event messages": (rel.event_messages, "text"),
    "account messages": (rel.account_messages, "text"),
    "damaged messages": (rel.damaged_messages, "text"),
}


@pytest.mark.parametrize("name", MADE)
@pytest.mark.parametrize(("limit", "files"), [(100, 10), (ROWS, rel.FILES)])
def test_a_large_table_gets_more_files(spark, tables, monkeypatch, name, limit, files):
    """No file, and so no task that writes one, has a share of the table that grows with it."""
    monkeypatch.setattr(rel, "FILE_ROWS", limit, raising=False)
    make, form = MADE[name]
    rows = rows_by_file(spark, make(spark, tables), form)
    assert len(rows) == files and sum(rows) == ROWS
    assert max(rows) <= ROWS // files + 16  # a task deals its rows in turn, from any file on


def test_halves_of_many_events(spark, tables, monkeypatch):
    monkeypatch.setattr(rel, "FILE_ROWS", 100, raising=False)
    *halves, last = rel.halves_of_events(spark, tables)
    counts = [half.count() for half in halves]
    assert [half.rdd.getNumPartitions() for half in halves] == [-(-n // 100) for n in counts]
    assert (sum(counts), last.count()) == (ROWS, 1)


def test_streams_take_all_of_many_files(spark, tables, monkeypatch):
    monkeypatch.setattr(rel, "FILE_ROWS", 100, raising=False)
    found = QUERIES["stream_append"](spark, tables)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rel.table(spark, tables, "lineitem").collect()))
    counts = QUERIES["window_count_stream"](spark, tables).collect()
    assert sum(r["num_cc_card"] for r in counts) == ROWS
