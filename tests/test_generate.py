import datetime
import json
import re

import pytest
from pyspark.sql import functions as F

from tabflow.functions import credit
from tabflow.functions.hashing import bucket_of, fraction_of, portable_hash, stable_hash
from tabflow.functions.schema import ACCOUNT_SCHEMA
from tabflow.operators.accounts import generate_accounts
from tabflow.operators.parse import accept_all, tag_json
from tabflow.operators.replicate import shift_replicate
from tabflow.operators.sample import first_values, pick_values, sample_rows
from tabflow.plans.layouts import Layout, write_date_clustered
from tabflow.plans.synthetic import generate_accounts_job, replicate_day_job
from tabflow.sinks.files import publish_messages
from tabflow.sources.lines import read_lines



def ident():
    return F.col("id")


ROWS = 20_000


def draws(spark, *columns):
    return spark.range(ROWS).select(*columns).collect()


@pytest.mark.parametrize("hasher", [stable_hash, portable_hash])
def test_scores(spark, hasher):
    columns = [credit.credit_score(ident(), hasher=hasher)]
    columns += [credit.credit_score(ident(), name, hasher) for name in credit.SCORE_TYPES]
    rows = draws(spark, *columns)
    assert all(300 <= r[0] <= 850 for r in rows)
    for i, kind in enumerate(credit.SCORE_TYPES.values(), start=1):
        assert {r[i] for r in rows} == set(range(kind.low, kind.high + 1))


def test_names_and_providers(spark):
    rows = draws(spark, credit.credit_score_name(ident()), credit.credit_score_provider(ident()),
                 credit.credit_score_name(ident(), "fico5"), credit.credit_score_provider(ident(), "fico5"),
                 credit.credit_score_provider(ident(), credit.FICO2))
    names = [r[0] for r in rows]
    assert set(names) == {kind.name for kind in credit.SCORE_TYPES.values()}
    # Two of the five type names mean the same type.
    assert abs(names.count("FICO Score 8") / ROWS - 0.4) < 0.02
    for name in ("Equifax Beacon 5.0", "TransUnion FICO Risk Score, Classic 04"):
        assert abs(names.count(name) / ROWS - 0.2) < 0.02
    assert {r[1] for r in rows} == {"Equifax", "Experian", "TransUnion"}
    assert {r[2] for r in rows} == {"Equifax Beacon 5.0"}
    assert {r[3] for r in rows} == {"Equifax"} and {r[4] for r in rows} == {"Experian"}


def test_full_text_is_of_one_type(spark):
    kinds = {kind.name: kind for kind in credit.SCORE_TYPES.values()}
    for text, fixed in draws(spark, credit.credit_score_full(ident()), credit.credit_score_full(ident(), "fico5")):
        name, provider, score, rest = text.split("\n")
        assert provider in kinds[name].providers and kinds[name].low <= int(score) <= kinds[name].high
        assert rest == "" and re.fullmatch(r"Equifax Beacon 5\.0\nEquifax\n\d{3}\n", fixed)


def test_unknown_score_type():
    with pytest.raises(ValueError):
        credit.credit_score(F.lit(1), "fico9")


def test_accounts(spark):
    rows = generate_accounts(spark, 2000, partitions=4)
    assert rows.columns == ACCOUNT_SCHEMA.names
    assert rows.where("NOT luhn_check(credit_card)").count() == 0
    first, last = datetime.datetime(1970, 1, 1), datetime.datetime(2025, 1, 1)
    for r in rows.collect():
        rearranged = r["bank_iban"][4:] + r["bank_iban"][:4]
        assert int("".join(str(int(c, 36)) for c in rearranged)) % 97 == 1
        assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}", r["emp_id"])
        assert re.fullmatch(r"(0[1-9]|1[0-2])/\d\d", r["credit_card_expires"])
        assert re.fullmatch(r"[A-Z]{2}", r["country_code"]) and "\n" in r["address"]
        assert first <= datetime.datetime.fromisoformat(r["date_record_created"]) < last
        assert re.fullmatch(r"4\d{15}", r["credit_card"])
    assert rows.select("emp_id").distinct().count() == 2000


def test_accounts_do_not_depend_on_partitioning(spark):
    one, many = generate_accounts(spark, 300, partitions=1), generate_accounts(spark, 300, partitions=7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.intersect(generate_accounts(spark, 300, seed=1)).count() == 0


def test_generated_messages_parse(spark, tmp_path):
    path = str(tmp_path / "messages")
    publish_messages(generate_accounts(spark, 500), path, fmt="text")
    tagged = tag_json(read_lines(spark, path), ACCOUNT_SCHEMA, require_keys=True, allow_extra_keys=True)
    assert accept_all(tagged).count() == 500
    first = read_lines(spark, path).first()["value"]
    assert list(json.loads(first)) == ACCOUNT_SCHEMA.names


@pytest.fixture(scope="module")
def days(spark):
    """100 rows on each of three days, copies of ten customers."""
    start = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    return spark.range(300).select(
        (ident() % 10).cast("string").alias("cust_identifier"),
        F.timestamp_add("DAY", (ident() % 3).cast("int"), start).alias("tstamp"),
        ident().alias("attr1"),
    )


@pytest.mark.parametrize("iterations, shifts", [(None, 0), (-1, 0), (0, 0), (1, 0), (2, 1), (4, 3)])
def test_replicate_counts(days, iterations, shifts):
    copies = shift_replicate(days, "2024-01-02", iterations, 1.0)
    assert copies.columns == days.columns
    per_day = {str(r["day"]): r["count"] for r in copies.groupBy(F.to_date("tstamp").alias("day")).count().collect()}
    assert per_day == {f"2024-01-{3 + i:02d}": 100 for i in range(shifts)}


def test_replicate_rates(days):
    key = [F.col("attr1")]
    assert shift_replicate(days, "2024-01-02", 5, 0.0).count() == 0
    part = shift_replicate(days, "2024-01-02", 41, 0.3, key=key)
    assert 0.25 < part.count() / 4000 < 0.35
    again = shift_replicate(days.repartition(7), "2024-01-02", 41, 0.3, key=key)
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, again.collect()))
    assert 0 <= shift_replicate(days, "2024-01-02", 3, seed=3).count() <= 200


def test_replicate_job_grows_a_clustered_table(spark, days, tmp_path):
    write_date_clustered(days, "grown_days", str(tmp_path / "days"))
    layout = Layout("grown_days", by_date=True)
    replicate_day_job(spark, layout, datetime.date(2024, 1, 3), 3, 1.0)
    replicate_day_job(spark, layout, datetime.date(2024, 1, 3), 1)
    counts = spark.table("grown_days").groupBy("tstamp_date").count().orderBy("tstamp_date").collect()
    assert [(r[0].day, r[1]) for r in counts] == [(d, 100) for d in range(1, 6)]
    assert spark.table("grown_days").where("tstamp_date != to_date(tstamp)").count() == 0
    with pytest.raises(ValueError):
        replicate_day_job(spark, Layout("x", buckets=4), datetime.date(2024, 1, 3), 3)


def test_account_job_destinations(spark, tmp_path):
    generate_accounts_job(spark, 50, "file", str(tmp_path / "accounts"))
    assert read_lines(spark, str(tmp_path / "accounts")).count() == 50
    for destination, location in (("queue", "x"), ("file", ""), ("topic", "")):
        with pytest.raises(ValueError):
            generate_accounts_job(spark, 5, destination, location)


def test_replicate_appends_to_its_own_table(spark, days, tmp_path):
    days.write.option("path", str(tmp_path / "grown")).saveAsTable("grown")
    shift_replicate(spark.table("grown"), "2024-01-03", 3, 1.0).write.mode("append").saveAsTable("grown")
    assert spark.table("grown").count() == 500


def test_samples(spark):
    rows = spark.range(ROWS)
    for kept in (sample_rows(rows, 0.3, seed=1), sample_rows(rows, 0.3, [ident()], seed=1)):
        assert abs(kept.count() / ROWS - 0.3) < 0.02
    by_key = sample_rows(rows, 0.3, [ident()], seed=1)
    assert by_key.exceptAll(sample_rows(rows.repartition(5), 0.3, [ident()], seed=1)).count() == 0
    assert by_key.exceptAll(sample_rows(rows, 0.3, [ident()], seed=2)).count() > 0
    assert sample_rows(rows, 0.0, [ident()]).count() == 0 and sample_rows(rows, 1.0, [ident()]).count() == ROWS


def test_parameter_lists(days):
    keys = first_values(days, F.col("cust_identifier"), "k", 4)
    assert [r["k"] for r in keys.collect()] == ["0", "1", "2", "3"]
    picks = [r["k"] for r in pick_values(keys, "k", 3, "a").collect()]
    assert len(set(picks)) == 3 and picks == [r["k"] for r in pick_values(keys, "k", 3, "a").collect()]


def test_hashes(spark):
    rows = spark.range(ROWS).select(
        bucket_of(ident().cast("string"), 16).alias("fast"),
        bucket_of(ident().cast("string"), 16, portable_hash).alias("portable"),
        fraction_of(ident()).alias("fraction"),
    )
    for name in ("fast", "portable"):
        counts = rows.groupBy(name).count().collect()
        assert {r[name] for r in counts} == set(range(16))
        assert max(r["count"] for r in counts) < 1.2 * ROWS / 16
    low, high, mean = rows.agg(F.min("fraction"), F.max("fraction"), F.avg("fraction")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02
