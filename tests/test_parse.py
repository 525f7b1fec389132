import datetime
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabflow.functions.schema import ACCOUNT_SCHEMA, SCENARIO_SCHEMA, schema_from_text
from tabflow.functions.text import decode_utf8, to_json_line, unchecked_payload
from tabflow.operators.parse import REASON, accept_all, bad_rows, good_rows, parse_object, tag_csv, tag_json, tag_object
from tabflow.operators.registry_join import table_name
from tabflow.sources.lines import read_csv_positional, read_lines, read_ndjson

ACCOUNT = {name: f"{name} text" for name in ACCOUNT_SCHEMA.names} | {
    "credit_card": "4111111111111111", "date_record_created": "2020-01-02 03:04:05"
}


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def tag_accounts(df):
    return tag_json(df, ACCOUNT_SCHEMA, require_keys=True, allow_extra_keys=True)


def reasons(tagged):
    return [r[REASON] for r in tagged.collect()]


def test_account_row(spark):
    row = accept_all(tag_accounts(lines(spark, json.dumps(ACCOUNT)))).collect()[0]
    assert row["credit_card"] == 4111111111111111
    assert row["date_record_created"] == datetime.datetime(2020, 1, 2, 3, 4, 5)
    assert row["city"] == "city text"


def test_account_rejects(spark):
    without = {k: v for k, v in ACCOUNT.items() if k not in ("name", "city")}
    tagged = tag_accounts(lines(
        spark,
        json.dumps(ACCOUNT | {"name": None, "credit_card": None}),  # a null is present
        json.dumps(ACCOUNT | {"another": 1}),                       # further keys are dropped
        json.dumps(ACCOUNT | {"credit_card": 4111}),                # a number is fine too
        json.dumps(without),
        json.dumps(ACCOUNT | {"credit_card": "41x"}),
        json.dumps(ACCOUNT | {"credit_card": ""}),
        json.dumps(ACCOUNT | {"date_record_created": "soon"}),
        json.dumps(ACCOUNT)[:-1],
        json.dumps(ACCOUNT) + "x",
        json.dumps(ACCOUNT) * 2,
        json.dumps([ACCOUNT]),
        json.dumps(ACCOUNT) + "," + json.dumps(ACCOUNT),
        "", "null", "{}", "{'name': 'single quotes'}", None,
    ))
    found = reasons(tagged)
    assert found[:3] == [None] * 3
    assert set(found[3].removeprefix("missing ").split(",")) == {"name", "city"}
    assert found[4:7] == ["bad value in credit_card"] * 2 + ["bad value in date_record_created"]
    assert found[7:14] == ["malformed"] * 7
    assert found[14].startswith("missing ")
    assert found[15:] == ["malformed"] * 2
    assert good_rows(tagged).count() == 3
    assert bad_rows(tagged).count() == 14


def test_strict_fails_even_if_the_bad_column_is_not_used(spark):
    tagged = tag_accounts(lines(spark, json.dumps(ACCOUNT), json.dumps({"country_code": "BE"})))
    with pytest.raises(PySparkException, match="missing"):
        accept_all(tagged).groupBy("country_code").count().collect()


def test_registry_row(spark):
    schema = schema_from_text("tablename:STRING, n:INT64, x:FLOAT64")
    tagged = tag_json(lines(
        spark,
        '{"tablename": "t", "n": "7", "x": 1}',
        '{"tablename": "t"}',
        '{"tablename": "t", "n": null, "x": null}',
        '{"tablename": "t", "n": 1, "n": 2}',
        '{"tablename": "t", "more": 1}',
        '{"tablename": "t", "n": null, "more": null}',
        '{"n": 1.5}',
        '{"n": 1',
    ), schema)
    rows = [tuple(r) for r in good_rows(tagged).collect()]
    assert rows == [("t", 7, 1.0), ("t", None, None), ("t", None, None), ("t", 2, None)]
    assert reasons(tagged)[4:] == ["unknown more", "unknown more", "bad value in n", "malformed"]


def test_the_json_is_parsed_once(spark):
    tagged = tag_accounts(lines(spark, json.dumps(ACCOUNT)))
    for df in (good_rows(tagged), bad_rows(tagged), accept_all(tagged)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_any_column_name(spark):
    schema = schema_from_text("value:INT64, reject_reason:STRING, it's:STRING, a b:FLOAT64, x.y:STRING, t`k:INT64")
    row = {"value": 1, "reject_reason": "none", "it's": "a", "a b": 2.5, "x.y": "z", "t`k": 3}
    df = spark.createDataFrame([(5, json.dumps(row))], "id long, line string")
    tagged = tag_json(df, schema, keep=["id"], value="line")
    assert [tuple(r) for r in accept_all(tagged).collect()] == [(5, *row.values())]
    bad = tag_json(lines(spark, '{"value": "x"}'), schema)
    assert [tuple(r) for r in bad_rows(bad).collect()] == [('{"value": "x"}', "bad value in value")]


def test_csv_positions(spark):
    tagged = tag_csv(lines(
        spark, "J1,2,0.5,0.25", "J1,2,0.5", "J1", "J1,2,0.5,0.25,more,fields", 'J1,2,"0,5",1', "J1,,1,2", ""
    ), SCENARIO_SCHEMA)
    rows = [tuple(r) for r in tagged.select(*SCENARIO_SCHEMA.names, REASON).collect()]
    assert rows[0] == ("J1", 2, 0.5, 0.25, None)
    assert rows[1] == ("J1", 2, 0.5, None, None)
    assert rows[2] == ("J1", None, None, None, None)
    assert rows[3] == ("J1", 2, 0.5, 0.25, None)
    assert rows[4][-1] == "bad value in migration_pl"
    assert rows[5][-1] == "bad value in scenarioid"
    assert rows[6][0] == "" and rows[6][-1] is None


def test_lines(spark, tmp_path):
    text = b"a\r\nb\rc\n\n d \r\r\nlast"
    (tmp_path / "plain.txt").write_bytes(text)
    (tmp_path / "packed.txt.gz").write_bytes(gzip.compress(text))
    expected = ["a", "b\rc", "", " d \r", "last"]
    for name in ("plain.txt", "packed.txt.gz"):
        assert [r["value"] for r in read_lines(spark, str(tmp_path / name)).collect()] == expected
    assert read_lines(spark, str(tmp_path / "*.txt*")).count() == 10


def test_file_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("J1,1,0.5,1\nJ2,2,0.5,1\n")
    assert accept_all(read_csv_positional(spark, str(tmp_path / "a.csv"), SCENARIO_SCHEMA)).count() == 2
    (tmp_path / "a.json").write_text('{"n": "1"}\n{"n": 2}\n')
    rows = accept_all(read_ndjson(spark, str(tmp_path / "a.json"), schema_from_text("n:INT64")))
    assert sorted(r["n"] for r in rows.collect()) == [1, 2]


BROKEN = b'{"n": "1", "s": "a\xff\xfeb"}'


def test_malformed_utf8_fails(spark, tmp_path):
    good = spark.createDataFrame([(bytearray("é".encode()),)], "value binary")
    assert unchecked_payload(good).collect()[0]["value"] == "é"
    payload = spark.createDataFrame([(bytearray(BROKEN),), (bytearray(b'{"n": 2, "s": "ok"}'),)], "value binary")
    with pytest.raises(PySparkException):
        payload.select(decode_utf8(F.col("value"))).collect()
    schema = schema_from_text("n:INT64, s:STRING")
    (tmp_path / "a.json").write_bytes(BROKEN + b'\n{"n": 2, "s": "ok"}\n')
    (tmp_path / "a.csv").write_bytes(b"J1,1,0.5,1\nJ\xff,2,0.5,1\n")
    for tagged in (tag_json(unchecked_payload(payload), schema), read_ndjson(spark, str(tmp_path / "a.json"), schema)):
        assert [tuple(r) for r in good_rows(tagged).collect()] == [(2, "ok")]
        rejects = bad_rows(tagged).select(F.col("value").cast("binary"), "reject_reason").collect()
        assert [(bytes(r[0]), r[1]) for r in rejects] == [(BROKEN, "not UTF-8")]
        with pytest.raises(PySparkException, match="not UTF-8"):
            accept_all(tagged).collect()
    assert good_rows(read_csv_positional(spark, str(tmp_path / "a.csv"), SCENARIO_SCHEMA)).count() == 1
    with pytest.raises(PySparkException):
        read_lines(spark, str(tmp_path / "a.csv")).collect()
    assert good_rows(tag_object(parse_object(unchecked_payload(payload)), schema)).count() == 1


def test_dates_keep_no_time(spark):
    schema = schema_from_text("d:DATE")
    texts = ['{"d": "2024-01-02"}', '{"d": "2024-01-02 00:00:00"}', '{"d": "2024-01-02 10:00:00"}', '{"d": "2024-13-02"}']
    assert reasons(tag_json(lines(spark, *texts), schema)) == [None, None, "bad value in d", "bad value in d"]


def test_a_repeated_key_is_routed_and_stored_alike(spark):
    row = '{"tablename": "p:d.one", "n": 1, "tablename": "p:d.two", "n": 2}'
    schema = schema_from_text("tablename:STRING, n:INT64")
    parsed = parse_object(lines(spark, row))
    assert parsed.select(table_name()).collect()[0][0] == "p:d.two"
    assert [tuple(r) for r in accept_all(tag_object(parsed, schema)).collect()] == [("p:d.two", 2)]
    assert [tuple(r) for r in accept_all(tag_json(lines(spark, row), schema)).collect()] == [("p:d.two", 2)]


def test_json_line_keeps_null_keys(spark):
    df = spark.range(1).select(F.lit(None).cast("string").alias("a"), F.col("id").alias("b"))
    assert df.select(to_json_line("*")).collect()[0][0] == '{"a":null,"b":0}'


# Literals by type: those that a value is made of, and those that a cast would change, fill in or make depend on the day.
GOOD_LITERALS = {
    "INT64": {"7": 7, "-7": -7, "+7": 7, "007": 7, "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63)},
    "FLOAT64": {"1": 1.0, "-0.5": -0.5, "+.5": 0.5, "1.": 1.0, "1e3": 1000.0, "1E-3": 0.001, "0.1": 0.1, "9007199254740992": 2.0**53,
                "0.30000000000000004": 0.30000000000000004, "0.10000000000000001": 0.1, "1.7976931348623157E308": 1.7976931348623157e308,
                "1152921504606846976": 2.0**60, "-9223372036854775808": -(2.0**63), "0.000": 0.0, "0e5": 0.0, "100000000000000000000": 1e20,
                "12345678901234.567": 12345678901234.567, "2e23": 2e23, "1.5000000000000000000000": 1.5, "-Infinity": float("-inf")},
    "DATE": {"2024-01-02": datetime.date(2024, 1, 2), "2024-1-2": datetime.date(2024, 1, 2), "2024-01-02 00:00:00": datetime.date(2024, 1, 2)},
    "DATETIME": {"2024-01-02 03:04:05": datetime.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05.123456": datetime.datetime(2024, 1, 2, 3, 4, 5, 123456),
                 "2024-01-02 03:04:05.120000000": datetime.datetime(2024, 1, 2, 3, 4, 5, 120000), "2024-01-02": datetime.datetime(2024, 1, 2)},
    "TIMESTAMP": {"2024-01-02 03:04:05": datetime.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05Z": datetime.datetime(2024, 1, 2, 3, 4, 5),
                  "2024-01-02 03:04:05+02:00": datetime.datetime(2024, 1, 2, 1, 4, 5), "2024-01-02 03:04:05.5 UTC": datetime.datetime(2024, 1, 2, 3, 4, 5, 500000)},
}
BAD_LITERALS = {
    "INT64": ["", " 7", "7 ", "7\n", "1.0", "1e3", "1_000", "0x10", "9223372036854775808", "1L", "x", "--1"],
    "FLOAT64": ["", "9007199254740993", "9007199254740993.0", "9.007199254740993E15", "1e400", "-1e400", "1e-400", "1d", "1f", "0x1p3", "1.5\n", "1,5", "e5", ".",
                "3.14159265358979323846", "4.94e-324", "1 000", " 1", "1.23456789012345678901", "36893488147419103233"],
    "DATE": ["2024", "2024-02", "2024-02-30", "2024-01-02 10:00:00", "12:30", "02.01.2024", "2024-01-02Z", "0000-01-01", "today", "2024-01-02 00:00:00.001"],
    "DATETIME": ["2024", "2024-02", "2024-01-01 00:00:00+05:00", "2024-01-01 00:00:00Z", "2024-01-01 00:00:00.1234567", "12:30", "2024-01-01 10", "2024-01-01 10:20",
                 "2024-01-01 25:00:00", "now", "2024-01-01 00:00:00 Europe/Rome", "2024-13-01 00:00:00"],
    "TIMESTAMP": ["12:30", "12:30:00", "T12:30:00", "2024", "2024-02", "2024-01-01 00:00:00.1234567Z", "2024-03-31 02:30:00 Europe/Rome", "2024-01-01 10:20", "epoch"],
}


@pytest.mark.parametrize("kind", sorted(GOOD_LITERALS))
def test_a_literal_says_what_the_value_says(spark, kind):
    """In CSV, JSON and routed messages alike: good literals give their value, others a reason."""
    schema = schema_from_text(f"i:INT64, v:{kind}")
    cases = [*GOOD_LITERALS[kind].items(), *((text, None) for text in BAD_LITERALS[kind])]
    good = len(GOOD_LITERALS[kind])

    def held(tagged, left_out=()):
        rows = {r["i"]: r for r in tagged.select("i", REASON, F.when(F.col(REASON).isNull(), F.col("v")).alias("v")).collect()}
        wrong = []
        for i, (text, value) in enumerate(cases):
            if text in left_out:
                continue
            row = rows[i]
            if (row[REASON], row["v"]) != (None, value) if i < good else row[REASON] != "bad value in v":
                wrong.append((text, row["v"], row[REASON]))
        assert not wrong

    commas = [text for text, _ in cases if "," in text]
    held(tag_csv(lines(spark, *[f"{i},{text}" for i, (text, _) in enumerate(cases)]), schema), commas)
    objects = lines(spark, *[json.dumps({"i": i, "v": text}) for i, (text, _) in enumerate(cases)])
    held(tag_json(objects, schema))
    held(tag_object(parse_object(objects), schema))


def test_json_numbers_keep_their_digits(spark):
    """A number that a double doesn't hold is a reject, also for a column of texts and inside a nested value."""
    schema = schema_from_text("s:STRING")
    good = ['{"s": 9007199254740993}', '{"s": "9007199254740993.0"}', '{"s": "1e400"}', '{"s": [1.5, 2e3]}', '{"s": "\\"Infinity\\""}', '{"s": 12345678.123456789}',
            '{"s": "[3.14159265358979323846]"}']
    bad = ['{"s": 9007199254740993.0}', '{"s": 1e400}', '{"s": {"k": [1, 3.14159265358979323846]}}', '{"s": -1e-400}']
    for parse in (lambda df: tag_json(df, schema), lambda df: tag_object(parse_object(df), schema)):
        assert reasons(parse(lines(spark, *good))) == [None] * 6 + ["bad value in s"]  # no telling a quoted list from a nested one
        assert reasons(parse(lines(spark, *bad))) == ["bad value in s"] * 4
        assert [r["s"] for r in accept_all(parse(lines(spark, *good[:3]))).collect()] == ["9007199254740993", "9007199254740993.0", "1e400"]
    schema = schema_from_text("x:FLOAT64")
    good = lines(spark, '{"x": 0.1}', '{"x": 1e3}', '{"x": 9007199254740992}', '{"x": -2.50}')
    bad = lines(spark, '{"x": 9007199254740993}', '{"x": 1e400}', '{"x": 9007199254740993.0}', '{"x": 3.14159265358979323846}')
    for parse in (lambda df: tag_json(df, schema), lambda df: tag_object(parse_object(df), schema)):
        assert [r["x"] for r in accept_all(parse(good)).collect()] == [0.1, 1000.0, 2.0**53, -2.5]
        assert reasons(parse(bad)) == ["bad value in x"] * 4
        with pytest.raises(PySparkException, match="bad value in x"):
            accept_all(parse(bad)).collect()
