"""SQL oracles: each query's result in plain SQL over the given tables."""

from __future__ import annotations

from . import queries as q
from .relations import BUCKETS, ROUTED, UNLISTED


# Fixed values, written out here so that the oracle doesn't share them with the code it checks.
FIRST_NAMES = ["Ada", "Ben", "Carla", "Dmitri", "Elena", "Farid", "Grace", "Hugo", "Ines", "Jonas",
               "Kira", "Liam", "Mona", "Nils", "Olga", "Pablo"]
LAST_NAMES = ["Abbott", "Brandt", "Costa", "Dubois", "Eriksen", "Fischer", "Garcia", "Hughes",
              "Ivanov", "Jansen", "Keller", "Lopez", "Moreau", "Novak", "Olsen", "Peeters"]
STREETS = ["Station Road", "High Street", "Mill Lane", "Park Avenue", "Church Road", "River Walk",
           "Garden Close", "Market Square"]
CITIES = ["Antwerp", "Bergen", "Cork", "Dresden", "Essen", "Florence", "Ghent", "Hull", "Izmir",
          "Jena", "Krakow", "Lyon", "Malmo", "Nantes", "Oporto", "Poznan"]
COUNTRY_CODES = ["AT", "AU", "BE", "BR", "CA", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IN",
                 "IT", "JP", "NL", "NO", "PL", "PT", "SE", "TR", "US", "ZA"]
COMPANY_FORMS = ["Ltd", "Inc", "Group", "PLC", "and Sons", "LLC"]
CARD_PROVIDERS = ["VISA 16 digit", "Mastercard", "American Express", "Discover", "Maestro",
                  "JCB 16 digit", "Diners Club"]
JOBS = ["Accountant", "Biologist", "Civil engineer", "Dentist", "Editor", "Florist", "Geologist",
        "Herbalist", "Illustrator", "Journalist", "Librarian", "Midwife", "Nurse", "Optician"]
PREFIXES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Mx."]
IBAN_COUNTRY, IBAN_COUNTRY_DIGITS = "GB", "1611"
IBAN_BANK, IBAN_BANK_DIGITS = "NWBK", "23321120"
CREATED_SPAN = 1_735_689_600
SCORE_TYPES = """(0, 'FICO Score 8', ['Equifax', 'Experian', 'TransUnion'], 300, 850),
    (1, 'Equifax Beacon 5.0', ['Equifax'], 334, 818),
    (2, 'Experian/Fair Isaac Risk Model V2SM', ['Experian'], 320, 844),
    (3, 'TransUnion FICO Risk Score, Classic 04', ['TransUnion'], 309, 839),
    (4, 'FICO Score 8', ['Equifax', 'Experian', 'TransUnion'], 300, 850)"""
N_SCORE_TYPES, FICO5 = 5, 1


def _hash(*terms: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(terms)})), 1, 15))::BIGINT)"


def _draw(key: str, purpose: str, size: int) -> str:
    return f"({_hash(key, repr(purpose))} % {size})"


ACCOUNTS = """
SELECT c_name AS name,
       concat(c_custkey, ' Mill Lane', chr(10), n_name) AS address,
       n_name AS country_code,
       concat('City ', c_nationkey) AS city,
       concat('GB', lpad(c_custkey::VARCHAR, 20, '0')) AS bank_iban,
       c_mktsegment AS company,
       4000000000000000 + c_custkey AS credit_card,
       CASE WHEN c_custkey % 7 <> 0 THEN 'VISA 16 digit' END AS credit_card_provider,
       '01/30' AS credit_card_expires,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS date_record_created,
       'Nurse' AS employement,
       md5(c_custkey::VARCHAR) AS emp_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'Dr.' ELSE 'Mx.' END AS name_prefix,
       concat('555-', c_custkey) AS phone_number
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

DEMO_LINEITEM = """
SELECT l_partkey::VARCHAR AS cust_identifier, l_shipdate + to_hours(l_linenumber) AS tstamp,
       l_returnflag AS country_code, l_quantity::BIGINT AS attr1, l_linenumber::BIGINT AS attr2,
       round(l_discount * 100)::BIGINT AS attr3, l_orderkey AS attr4, l_suppkey AS attr5,
       l_partkey AS attr6, floor(l_extendedprice)::BIGINT AS attr7, round(l_tax * 100)::BIGINT AS attr8,
       l_orderkey % 10 AS attr9, l_partkey % 10 AS attr10
FROM lineitem
"""

DEMO_EVENTS = """
SELECT user_id::VARCHAR AS cust_identifier, ts AS tstamp, event_type AS country_code,
       event_id AS attr1, floor(value)::BIGINT AS attr2,
       json_extract_string(props, '$.k')::BIGINT AS attr3,
       user_id AS attr4, event_id % 5 AS attr5, event_id % 6 AS attr6, event_id % 7 AS attr7,
       event_id % 8 AS attr8, event_id % 9 AS attr9, event_id % 10 AS attr10
FROM events
"""

JOB_LOG = """
SELECT concat('report_', event_type, '_', event_id) AS job_id, ts AS creation_time, ts AS start_time,
       CASE WHEN event_id % 13 <> 0
            THEN ts + to_microseconds(floor(value * 1000)::BIGINT) END AS end_time,
       event_id * 1000 AS total_bytes_processed,
       CASE WHEN event_id % 7 <> 0 THEN event_id * 1024 END AS total_bytes_billed,
       CASE WHEN event_id % 10 = 0 THEN 'LOAD' ELSE 'QUERY' END AS job_type,
       CASE WHEN event_id % 11 = 0 THEN 'other' ELSE 'shop' END AS project_id
FROM events
"""


def _lookup(where: str) -> str:
    return (f"WITH demo AS ({DEMO_EVENTS}) SELECT cust_identifier, tstamp, "
            f"attr1 + attr2 - attr3 AS some_random_calc FROM demo WHERE {where}")


_BY_CASE = {
    "c1": f"cust_identifier = '{q.CUSTOMER}'",
    "c2": f"tstamp::DATE = DATE '{q.DAY}'",
    "c3": f"cust_identifier = '{q.CUSTOMER}' AND tstamp::DATE = DATE '{q.DAY}'",
}


def _one_of(pool: list[str], key: str, purpose: str) -> str:
    items = ", ".join("'" + item.replace("'", "''") + "'" for item in pool)
    return f"([{items}])[1 + {_draw(key, purpose, len(pool))}]"


def _digits(key: str, purpose: str, width: int) -> str:
    return f"lpad({_draw(key, purpose, 10**width)}::VARCHAR, {width}, '0')"


def _accounts_sql() -> str:
    key = "c_custkey"

    def one(pool: list[str], purpose: str) -> str:
        return _one_of(pool, key, purpose)

    luhn = " + ".join(
        f"(CASE WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END)" if place % 2 else d
        for place in range(1, 16)
        for d in [f"substr(body, {place}, 1)::INTEGER"]
    )
    rest = f"('{IBAN_BANK_DIGITS}' || account || '{IBAN_COUNTRY_DIGITS}00')::HUGEINT % 97"
    return f"""
    WITH base AS (
      SELECT c_custkey, '4' || {_digits(key, 'card', 14)} AS body,
             {_digits(key, 'iban', 14)} AS account,
             md5(concat_ws('|', c_custkey, 'uuid')) AS h
      FROM customer
    )
    SELECT c_custkey,
      concat_ws(' ', {one(FIRST_NAMES, 'first')}, {one(LAST_NAMES, 'last')}) AS name,
      (1 + {_draw(key, 'house', 999)}) || ' ' || {one(STREETS, 'street')} || chr(10)
        || {one(CITIES, 'address city')} || ' ' || {_digits(key, 'zip', 5)} AS address,
      {one(COUNTRY_CODES, 'country')} AS country_code,
      {one(CITIES, 'city')} AS city,
      '{IBAN_COUNTRY}' || lpad((98 - {rest})::VARCHAR, 2, '0') || '{IBAN_BANK}' || account AS bank_iban,
      concat_ws(' ', {one(LAST_NAMES, 'company')}, {one(COMPANY_FORMS, 'form')}) AS company,
      body || ((10 - ({luhn}) % 10) % 10)::VARCHAR AS credit_card,
      {one(CARD_PROVIDERS, 'card provider')} AS credit_card_provider,
      strftime(DATE '{q.TODAY}' + to_months({_draw(key, 'expires', 121)}::INTEGER), '%m/%y') AS credit_card_expires,
      strftime(make_timestamp({_draw(key, 'created', CREATED_SPAN)} * 1000000), '%Y-%m-%d %H:%M:%S')
        AS date_record_created,
      {one(JOBS, 'job')} AS employement,
      concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '4' || substr(h, 14, 3), 'a' || substr(h, 18, 3),
                substr(h, 21, 12)) AS emp_id,
      {one(PREFIXES, 'prefix')} AS name_prefix,
      concat_ws('-', {_digits(key, 'area', 3)}, {_digits(key, 'exchange', 3)}, {_digits(key, 'line', 4)})
        AS phone_number
    FROM base
    """


def _credit_sql(purpose: str, value: str) -> str:
    """``value`` over the drawn type ``t`` and over the fixed type fico5."""
    return f"""
    WITH types(pos, type_name, providers, low, high) AS (VALUES {SCORE_TYPES})
    SELECT c_custkey, {value.replace('@', 't')} AS any_type, {value.replace('@', 'f')} AS fico5
    FROM customer
    JOIN types t ON t.pos = {_draw('c_custkey', purpose, N_SCORE_TYPES)}
    JOIN types f ON f.pos = {FICO5}
    """


_NAME = "@.type_name"
_PROVIDER = f"@.providers[1 + {_hash('c_custkey', repr('provider'))} % len(@.providers)]"
_SCORE = f"@.low + {_hash('c_custkey', repr('score'))} % (@.high - @.low + 1)"

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _columns(name: str) -> str:
    """The declared columns of a routed table, integers as BIGINT."""
    items = [item.strip().split(":") for item in ROUTED[f"shop:sales.{name}"].split(",")[1:]]
    return ", ".join(f"{column}::BIGINT AS {column}" if kind == "INT64" else column for column, kind in items)


# Partition i holds values from bound i up to the next; what lies outside is in partition 0.
_RANGE = "CASE " + " ".join(
    f"WHEN attr1 >= {low} AND attr1 < {high} THEN {i}" for i, (low, high) in enumerate(zip(q.BOUNDARIES, q.BOUNDARIES[1:]), 1)) + " ELSE 0 END"

_PARAMETERS = f"""
    WITH demo AS ({DEMO_EVENTS}),
    keys AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM (SELECT DISTINCT cust_identifier AS k FROM demo) ORDER BY k LIMIT 10),
    days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM (SELECT DISTINCT tstamp::DATE AS d FROM demo) ORDER BY d LIMIT 10),
    parameters(case_code, customer, day) AS (
      SELECT 'c1', k, NULL::DATE FROM keys UNION ALL SELECT 'c2', NULL, d FROM days UNION ALL
      SELECT 'c3', k, d FROM range(10) runs(r)
      JOIN keys ON keys.i = {_draw('r', 'customer', '(SELECT count(*) FROM keys)')}
      JOIN days ON days.i = {_draw('r', 'day', '(SELECT count(*) FROM days)')})"""

_ON = {"c1": "cust_identifier = customer", "c2": "tstamp::DATE = day", "c3": "cust_identifier = customer AND tstamp::DATE = day"}

# The rows of the partitions a lookup names; where it names none, all.
_BUCKET_OF = f"{_hash('{}')} % {BUCKETS}"
_ROWS_AT_MOST = f"""{_PARAMETERS}
    SELECT case_code || part AS job_group, CAST(sum(n) AS BIGINT) AS rows_at_most FROM (
      SELECT case_code, part, (SELECT count(*) FROM demo WHERE
             CASE WHEN part = 'q2' AND customer IS NOT NULL THEN {_BUCKET_OF.format('cust_identifier')} = {_BUCKET_OF.format('customer')}
                  WHEN part <> 'q2' AND day IS NOT NULL THEN tstamp::DATE = day ELSE true END) AS n
      FROM parameters, (VALUES ('q1'), ('q2'), ('q3')) parts(part)) GROUP BY 1"""

_MATCHES = f"""
    WITH demo AS ({DEMO_EVENTS}),
    keys AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM (SELECT DISTINCT cust_identifier AS k FROM demo) ORDER BY k LIMIT 10),
    days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM (SELECT DISTINCT tstamp::DATE AS d FROM demo) ORDER BY d LIMIT 10),
    pairs AS (SELECT k, d FROM range(10) runs(r)
              JOIN keys ON keys.i = {_draw('r', 'customer', '(SELECT count(*) FROM keys)')}
              JOIN days ON days.i = {_draw('r', 'day', '(SELECT count(*) FROM days)')}),
    found(case_code, num_exec, rows_matched) AS (
      SELECT 'c1', (SELECT count(*) FROM keys), count(*) FROM demo JOIN keys ON cust_identifier = k
      UNION ALL
      SELECT 'c2', (SELECT count(*) FROM days), count(*) FROM demo JOIN days ON tstamp::DATE = d
      UNION ALL
      SELECT 'c3', (SELECT count(*) FROM pairs), count(*) FROM demo JOIN pairs ON cust_identifier = k AND tstamp::DATE = d)
    SELECT case_code || part AS job_group, num_exec, rows_matched
    FROM found, (VALUES ('q1'), ('q2'), ('q3')) parts(part)"""

_SAMPLE_KEY = ("cust_identifier", "attr4", "attr2")


def _fraction(*terms: str) -> str:
    return f"({_hash(*terms)} % 1000000000)::DOUBLE / 1000000000.0::DOUBLE"


_LAYOUT_COLUMNS = ("cust_identifier, tstamp, country_code, attr1, attr2, attr3, attr4, attr5, attr6, "
                   "attr7, attr8, attr9, attr10")

ORACLES: dict[str, str] = {
    "scan_table": "SELECT * FROM orders",
    "scan_text": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents WHERE text IS NOT NULL",
    "scan_csv_positional":
        "SELECT 'J' || l_orderkey AS jobid, l_linenumber::BIGINT AS scenarioid, l_tax AS migration_pl, "
        "l_discount AS default_pl FROM lineitem",
    "scan_ndjson": _ORDERS,
    "stream_source": "SELECT * FROM events",
    "registry_lookup": " UNION ALL ".join(
        f"SELECT '{name}' AS tablename, count(*) AS n_messages, {len(text.split(','))} AS n_fields "
        f"FROM {name.rpartition('.')[2]}" for name, text in ROUTED.items()
    ) + f" UNION ALL SELECT '{UNLISTED}', count(*), 0 FROM part",
    "unknown_table_rejects": f"SELECT '{UNLISTED}' AS tablename, * FROM part",
    "append_table":
        "SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS note FROM customer "
        "UNION ALL SELECT c_custkey, c_name, NULL, 'again' FROM customer",
    "multi_table_load": " UNION ALL BY NAME ".join(f"SELECT '{n}' AS target, {_columns(n)} FROM {n}" for n in ("customer", "supplier", "orders")),
    "route_by_table": " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS tablename, {_columns(name.rpartition('.')[2])} FROM {name.rpartition('.')[2]}" for name in ROUTED
    ) + f" UNION ALL BY NAME SELECT 'unknown table {UNLISTED}' AS reject_reason, * FROM part",
    "route_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS route, count(*) AS n_messages FROM {name.rpartition('.')[2]}" for name in ROUTED
    ) + " UNION ALL SELECT '_rejects', count(*) FROM part",
    "sink_text":
        "SELECT printf('%s: %d', n_name, count(*)) AS value FROM customer "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "sink_ndjson": "SELECT * FROM customer",
    "sink_messages": ACCOUNTS,
    "parse_account_json": ACCOUNTS,
    "parse_json_registry": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "utf8_roundtrip": "SELECT doc_id, text, octet_length(encode(text)) AS n_bytes FROM documents",
    "json_roundtrip": "SELECT * FROM events",
    "computed_column":
        f"WITH demo AS ({DEMO_LINEITEM}) SELECT cust_identifier, tstamp, "
        "attr1 + attr2 - attr3 AS some_random_calc FROM demo",
    "bucket_column": f"WITH demo AS ({DEMO_LINEITEM}) SELECT abs({_hash('cust_identifier')} % 4000) AS cust_identifier_bucket, * FROM demo",
    "extract_date": f"WITH demo AS ({DEMO_LINEITEM}) SELECT attr4, attr2, tstamp::DATE AS day FROM demo",
    "elapsed_ms":
        f"WITH jobs AS ({JOB_LOG}) SELECT job_id, "
        "date_sub('millisecond', start_time, end_time) AS elapsed_millisecond FROM jobs",
    "job_group": f"WITH jobs AS ({JOB_LOG}) SELECT job_id, substr(job_id, 8, 4) AS job_group FROM jobs",
    "count_per_country":
        "SELECT n_name AS country_name, count(*) AS num_cc_card FROM customer "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "count_per_country_table":
        "SELECT n_name AS country_name, count(*) AS num_cc_card FROM customer "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "format_count":
        "SELECT printf('%s: %d', event_type, count(*)) AS value FROM events GROUP BY event_type",
    "window_count_batch":
        "SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, event_type AS country_name, "
        "count(*) AS num_cc_card FROM events GROUP BY 1, 2",
    "window_count_stream":
        "SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, event_type AS country_name, "
        "count(*) AS num_cc_card FROM events GROUP BY 1, 2",
    "window_count_accounts":
        f"SELECT time_bucket(INTERVAL 60 SECOND, date_record_created) AS window_start, "
        f"country_code AS country_name, count(*) AS num_cc_card FROM ({ACCOUNTS}) GROUP BY 1, 2",
    "latest_date": f"WITH demo AS ({DEMO_LINEITEM}) SELECT max(tstamp::DATE) AS latest_date FROM demo",
    "job_history_summary": f"""
        WITH jobs AS ({JOB_LOG}), runs AS (
          SELECT *, substr(job_id, 8, 4) AS job_group,
                 date_sub('millisecond', start_time, end_time) AS ms
          FROM jobs
          WHERE creation_time BETWEEN TIMESTAMP '{q.HISTORY_START}' AND TIMESTAMP '{q.HISTORY_END}'
            AND end_time BETWEEN TIMESTAMP '{q.HISTORY_START}' AND TIMESTAMP '{q.HISTORY_END}'
            AND job_type = 'QUERY' AND job_id LIKE 'report%' AND project_id = 'shop')
        SELECT job_group, count(*) AS num_exec,
               ceil(avg(total_bytes_processed) / 1024 / 1024) AS avg_mb_processed_per_run,
               ceil(avg(total_bytes_billed) / 1024 / 1024) AS avg_mb_billed_per_run,
               ceil(avg(ms)) AS avg_millisecond_per_run
        FROM runs GROUP BY job_group ORDER BY job_group""",
    "layout_date_cust": f"SELECT *, tstamp::DATE AS tstamp_date FROM ({DEMO_EVENTS})",
    "layout_bucket_ts": f"SELECT *, abs({_hash('cust_identifier')} % {BUCKETS}) AS cust_identifier_bucket FROM ({DEMO_EVENTS})",
    "layout_bucket_by": DEMO_EVENTS,
    "lookup_bucket_by": _lookup(_BY_CASE["c3"]),
    "layout_date_plain": f"SELECT *, tstamp::DATE AS tstamp_date FROM ({DEMO_EVENTS})",
    **{f"lookup_{case}{part}": _lookup(where) for case, where in _BY_CASE.items() for part in ("q1", "q2", "q3")},
    "layout_matches": _MATCHES,
    "layout_report": f"SELECT *, true AS within FROM ({_MATCHES}) JOIN ({_ROWS_AT_MOST}) USING (job_group)",
    **{f"lookup_many_{case}": f"{_PARAMETERS} SELECT case_code || part AS job_group, customer, day, cust_identifier, tstamp, "
       f"attr1 + attr2 - attr3 AS some_random_calc FROM demo JOIN parameters ON {on}, (VALUES ('q1'), ('q2'), ('q3')) parts(part) "
       f"WHERE case_code = '{case}'" for case, on in _ON.items()},
    "layout_ranges": f"SELECT *, {_RANGE} AS attr1_range FROM ({DEMO_LINEITEM})",
    "lookup_ranges": f"""
        SELECT CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high, attr4, attr2, attr1, CAST({_RANGE} AS INTEGER) AS attr1_range
        FROM ({DEMO_LINEITEM}) JOIN (VALUES {', '.join(map(str, q.RANGES))}) asked(low, high) ON attr1 BETWEEN low AND high""",
    "latest_partition": f"SELECT max(tstamp::DATE) AS latest_date FROM ({DEMO_EVENTS})",
    "typed_literals": """
        WITH o AS (SELECT *, o_orderkey % 20 AS k FROM orders)
        SELECT o_orderkey AS key, CASE k WHEN 10 THEN 9007199254740992 WHEN 14 THEN 1000 ELSE o_totalprice END AS amount,
               CASE WHEN k = 12 THEN o_orderdate + INTERVAL 123456 MICROSECONDS ELSE o_orderdate END AS ordered,
               CASE WHEN k = 13 THEN o_orderdate - INTERVAL 2 HOURS ELSE o_orderdate END AS seen, o_orderdate::DATE AS day
        FROM o WHERE k NOT BETWEEN 1 AND 9 AND k NOT IN (16, 17)
        UNION ALL BY NAME
        SELECT o_orderkey AS key, 'bad value in ' || CASE WHEN k <= 4 OR k = 16 THEN 'amount' WHEN k <= 7 THEN 'ordered' WHEN k = 8 THEN 'seen' ELSE 'day' END
               AS reject_reason FROM o WHERE k BETWEEN 1 AND 9 OR k IN (16, 17)""",
    "window_count_final":
        "SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, event_type AS country_name, "
        "count(*) AS num_cc_card, true AS at_most_once FROM events GROUP BY 1, 2",
    "count_by_customer": "SELECT user_id::VARCHAR AS cust_identifier, count(*) AS n_rows FROM events GROUP BY 1",
    "sample_rows_rand": "SELECT true AS share_as_asked, true AS all_from_table, count(*) AS n_rows FROM lineitem",
    "damaged_messages": f"""
        SELECT * FROM ({ACCOUNTS}) WHERE substr(phone_number, 5)::BIGINT % 5 <> 0
        UNION ALL BY NAME
        SELECT emp_id, 'not UTF-8' AS reject_reason FROM ({ACCOUNTS}) WHERE substr(phone_number, 5)::BIGINT % 5 = 0""",
    "stream_two_outputs": f"""
        SELECT * FROM ({ACCOUNTS}) UNION ALL BY NAME
        SELECT time_bucket(INTERVAL 60 SECOND, date_record_created) AS window_start, country_code AS country_name,
               count(*) AS num_cc_card FROM ({ACCOUNTS}) GROUP BY 1, 2""",
    "param_keys":
        f"WITH demo AS ({DEMO_LINEITEM}) SELECT DISTINCT cust_identifier FROM demo "
        "ORDER BY cust_identifier LIMIT 10",
    "param_dates":
        f"WITH demo AS ({DEMO_LINEITEM}) SELECT DISTINCT tstamp::DATE AS dates FROM demo ORDER BY dates LIMIT 10",
    "param_pick":
        f"WITH demo AS (SELECT DISTINCT cust_identifier FROM ({DEMO_LINEITEM})) SELECT cust_identifier "
        f"FROM demo ORDER BY {_hash('cust_identifier', repr('pick'))}, cust_identifier LIMIT 10",
    "sample_rows": f"WITH demo AS ({DEMO_LINEITEM}) SELECT * FROM demo "
        f"WHERE {_fraction(*_SAMPLE_KEY, repr('1'))} < {q.SAMPLE_RATE}::DOUBLE",
    "shift_replicate":
        f"WITH demo AS ({DEMO_LINEITEM}) SELECT cust_identifier, tstamp + x * INTERVAL 1 DAY AS tstamp, "
        f"{_LAYOUT_COLUMNS.split(', ', 2)[2]} FROM demo, range(1, {q.ITERATIONS}) shifts(x) "
        f"WHERE tstamp::DATE = DATE '{q.REPLICATE_DAY}' "
        f"AND {_fraction(*_SAMPLE_KEY, 'x')} < {q.RATE}::DOUBLE",
    "replicate_into_table":
        f"WITH demo AS ({DEMO_EVENTS}) SELECT *, tstamp::DATE AS tstamp_date FROM demo "
        f"UNION ALL SELECT * EXCLUDE (x) REPLACE (tstamp + x * INTERVAL 1 DAY AS tstamp), "
        f"(tstamp + x * INTERVAL 1 DAY)::DATE FROM demo, range(1, {q.ITERATIONS}) shifts(x) "
        f"WHERE tstamp::DATE = DATE '{q.DAY}' AND {_fraction('attr1', 'x')} < {q.RATE}::DOUBLE",
    "generate_accounts": _accounts_sql(),
    "credit_score": _credit_sql("score type", _SCORE),
    "credit_score_name": _credit_sql("name type", _NAME),
    "credit_score_provider": _credit_sql("provider type", _PROVIDER),
    "credit_score_full": _credit_sql(
        "full type", f"{_NAME} || chr(10) || {_PROVIDER} || chr(10) || ({_SCORE}) || chr(10)"
    ),
    "stream_append": "SELECT * FROM lineitem",
    "stream_parse_append": ACCOUNTS,
    "console_tap": f"SELECT country_code, 1::BIGINT AS ones, count(*) AS n FROM ({ACCOUNTS}) GROUP BY 1",
}
