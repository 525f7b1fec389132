import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions.coerce import conform
from tabflow.functions.schema import (
    ACCOUNT_SCHEMA,
    schema_from_fields,
    schema_from_text,
    schema_to_text,
)
from tabflow.session import remove_path
from tabflow.sinks import loads
from tabflow.sinks.loads import append_load, days_table, fold_days, read_loads
from tabflow.sinks.tables import append_table, create_if_needed
from tabflow.sources.registry import (
    read_load_config,
    read_registry,
    read_schema_file,
    read_small_file,
    registry_schemas,
)


def test_schema_text():
    schema = schema_from_text("a:STRING, b:INT64,c : FLOAT64, d:DATETIME, e:TIMESTAMP, f:DATE")
    assert [f.dataType for f in schema] == [
        T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(), T.TimestampType(), T.DateType()
    ]
    assert schema_from_text(schema_to_text(schema)) == schema
    assert all(f.nullable for f in schema)


@pytest.mark.parametrize("text", ["a", "a:WHAT", ":STRING", ""])
def test_bad_schema_text(text):
    with pytest.raises(ValueError):
        schema_from_text(text)


def test_account_schema():
    assert len(ACCOUNT_SCHEMA) == 14
    assert ACCOUNT_SCHEMA["credit_card"].dataType == T.LongType()


def test_required_mode_is_refused():
    with pytest.raises(ValueError):
        schema_from_fields([{"name": "a", "type": "STRING", "mode": "REQUIRED"}])


def _write(path, text):
    path.write_text(text)
    return str(path)


def _line(name, *fields):
    listed = [{"name": n, "type": t, "mode": "NULLABLE"} for n, t in fields]
    return json.dumps({"tablename": name, "schema": {"fields": listed}})


def test_registry(spark, tmp_path):
    lines = [_line("p:d.one", ("tablename", "STRING"), ("n", "INT64")), _line("p:d.two", ("x", "FLOAT64"))]
    registry = read_registry(spark, _write(tmp_path / "registry.json", "\n".join(lines)))
    assert registry_schemas(registry) == {
        "p:d.one": schema_from_text("tablename:STRING, n:INT64"),
        "p:d.two": schema_from_text("x:FLOAT64"),
    }
    one = spark.createDataFrame([("p:d.two",), ("p:d.two",), ("other",), (None,)], "tablename string")
    assert list(registry_schemas(registry, one)) == ["p:d.two"]
    with pytest.raises(ValueError):
        registry_schemas(registry.unionAll(registry))


def test_config_and_schema_files(spark, tmp_path):
    config = {"tablelist": [
        {"sourcefile": "a.json", "targettable": "t1", "schemauri": "a.txt"},
        {"sourcefile": "b.json", "targettable": "t2", "schemauri": "b.txt"},
    ]}
    entries = read_load_config(spark, _write(tmp_path / "config.json", json.dumps(config, indent=2)))
    assert [(e.source, e.target, e.schema_uri) for e in entries] == [
        ("a.json", "t1", "a.txt"), ("b.json", "t2", "b.txt")
    ]
    schema = _write(tmp_path / "a.txt", "a:STRING, b:INT64\n")
    assert read_schema_file(spark, schema) == schema_from_text("a:STRING, b:INT64")
    with pytest.raises(ValueError):
        read_small_file(spark, str(tmp_path / "*.*"))


def test_append_matches_by_name(spark, tmp_path):
    schema = schema_from_text("a:INT64, b:STRING, c:FLOAT64")
    path = str(tmp_path / "t")
    append_table(spark.createDataFrame([("x", "1")], "b string, a string"), "by_name", schema, path)
    append_table(spark.createDataFrame([(2.5, 2)], "c double, a long"), "by_name", schema, path)
    assert sorted(map(tuple, spark.table("by_name").collect())) == [(1, "x", None), (2, None, 2.5)]
    assert spark.table("by_name").schema == schema


def test_append_refuses_bad_values_and_columns(spark, tmp_path):
    schema = schema_from_text("a:INT64")
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([(1,)], "z long"), schema)
    for text in ("", "x", "1.5"):
        with pytest.raises(PySparkException):
            conform(spark.createDataFrame([(text,)], "a string"), schema).collect()


def test_casts_lose_nothing(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4)
    good = spark.createDataFrame([(2.0, 3, at.replace(hour=0, minute=0), at.date(), 5)], "a double, b long, c timestamp_ntz, d date, E int")
    kept = conform(good, schema_from_text("a:INT64, b:FLOAT64, c:DATE, d:DATETIME, e:INT64")).collect()[0]
    assert tuple(kept) == (2, 3.0, at.date(), datetime.datetime(2024, 1, 2), 5)
    for value, kind, wanted in ((1.7, "double", "INT64"), (float("nan"), "double", "INT64"), (2**53 + 1, "long", "FLOAT64"),
                                (at, "timestamp_ntz", "DATE"), (1e30, "double", "INT64"), ("2024-01-02 10:00", "string", "DATE")):
        with pytest.raises(PySparkException):
            conform(spark.createDataFrame([(value,)], f"a {kind}"), schema_from_text(f"a:{wanted}")).collect()
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([(1,)], "b long"), schema_from_text("a:INT64"))


def test_create_if_needed_keeps_an_existing_table(spark, tmp_path):
    schema = schema_from_text("a:INT64")
    path = str(tmp_path / "kept")
    append_table(spark.createDataFrame([(1,)], "a long"), "kept", schema, path)
    create_if_needed(spark, "kept", schema_from_text("b:STRING"), path)
    assert spark.table("kept").columns == ["a"] and spark.table("kept").count() == 1


def test_repeated_load_changes_nothing(spark, tmp_path):
    schema = schema_from_text("a:INT64, b:STRING")
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "b string, a long")
    path = str(tmp_path / "loads")
    append_load(rows, "loads", "q-0", schema, path)
    append_load(rows.limit(1), "loads", "q-1", schema, path)
    append_load(rows, "loads", "q-0", schema, path)
    assert sorted(map(tuple, read_loads(spark, "loads").collect())) == [(1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        append_load(rows, "loads", "x' OR '1", schema, path)


LATER = datetime.date(9999, 1, 1)


def values(spark, table):
    return sorted(r["a"] for r in read_loads(spark, table).collect())


def test_folded_days(spark, tmp_path, monkeypatch):
    """Finished days become one partition each of a second table; a repeat of a folded load does nothing, an interrupted fold goes on."""
    schema, path, table = schema_from_text("a:INT64"), str(tmp_path / "t"), "folded"
    rows = lambda n: spark.createDataFrame([(n,)], "a long")
    for n in range(6):
        append_load(rows(n), table, f"q-{n}", schema, path)
    append_load(rows(100), table, "batch_load", schema, path)
    assert fold_days(spark, table, datetime.date(2000, 1, 1), path) == []
    dropped = []

    def fail(session, folder):
        if dropped:
            raise OSError("lost")
        dropped.append(folder)
        remove_path(session, folder)

    monkeypatch.setattr(loads, "remove_path", fail)
    with pytest.raises(OSError):  # after the files of the first load
        fold_days(spark, table, LATER, path)
    want = [0, 1, 2, 3, 4, 5, 100]
    assert values(spark, table) == want
    monkeypatch.undo()
    assert not append_load(rows(3), table, "q-3", schema, path)
    assert len(fold_days(spark, table, LATER, path)) == 1
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 0
    assert spark.sql(f"SHOW PARTITIONS {days_table(table)}").count() == 1
    assert not append_load(rows(3), table, "q-3", schema, path) and not append_load(rows(100), table, "batch_load", schema, path)
    assert values(spark, table) == want
    assert append_load(rows(6), table, "q-6", schema, path)
    assert values(spark, table) == [0, 1, 2, 3, 4, 5, 6, 100]
    # A day that was folded may be folded again; each fold adds up its own loads.
    assert len(fold_days(spark, table, LATER, path, lambda df: df.groupBy().agg((F.sum("a") * 10).alias("a")))) == 1
    assert values(spark, table) == [0, 1, 2, 3, 4, 5, 60, 100]
    assert fold_days(spark, table, LATER, path) == []
    properties = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert not [k for k in properties if "fold" in k or "stream" in k]


def test_a_late_load_is_written_after_a_fold(spark, tmp_path):
    """A first load counts, however its id compares with folded ones; only the folded ids themselves are skipped."""
    schema, path, table = schema_from_text("a:INT64"), str(tmp_path / "t"), "late"
    rows = lambda n: spark.createDataFrame([(n,)], "a long")
    assert append_load(rows(1), table, "2024-01-15", schema, path) and append_load(rows(2), table, "run-7", schema, path)
    assert len(fold_days(spark, table, LATER, path)) == 1
    assert append_load(rows(3), table, "2024-01-10", schema, path) and append_load(rows(4), table, "run-3", schema, path)
    assert append_load(rows(5), table, "run-07", schema, path)
    assert not append_load(rows(6), table, "2024-01-15", schema, path) and not append_load(rows(7), table, "run-7", schema, path)
    for _ in range(2):
        assert values(spark, table) == [1, 2, 3, 4, 5]
        fold_days(spark, table, LATER, path)
    assert not append_load(rows(8), table, "run-3", schema, path)


def test_rows_without_values_survive_a_fold(spark, tmp_path):
    schema, path, table = schema_from_text("a:INT64, b:STRING"), str(tmp_path / "t"), "blank_rows"
    rows = spark.createDataFrame([(None, None), (None, None), (1, None)], "a long, b string")
    append_load(rows, table, "q-1", schema, path)
    fold_days(spark, table, LATER, path)
    assert sorted(map(tuple, read_loads(spark, table).collect()), key=repr) == [(1, None), (None, None), (None, None)]


def test_a_fold_keeps_a_further_partition(spark, tmp_path):
    schema, path, table = schema_from_text("a:INT64"), str(tmp_path / "t"), "within"
    for n in range(3):
        rows = spark.createDataFrame([(n, "x"), (n + 10, "y=/ 1")], "a long, side string")
        append_load(rows, table, f"q-{n}", schema, path, within="side")
        append_load(rows, table, f"q-{n}", schema, path, within="side")
    want = sorted((n + add, side) for n in range(3) for add, side in ((0, "x"), (10, "y=/ 1")))
    for _ in range(2):
        assert sorted((r["a"], r["side"]) for r in read_loads(spark, table).collect()) == want
        assert len(fold_days(spark, table, LATER, path)) in (0, 1)
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 0
    plan = read_loads(spark, table).where("side = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "side" in plan.split("PartitionFilters: [")[1].split("]")[0]
