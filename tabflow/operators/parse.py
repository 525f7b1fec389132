"""Text to typed rows.

A *tagged* frame has the target columns, the source text and a reject reason, NULL
for a good row. ``accept_all`` fails the job on the first bad row;
``good_rows`` and ``bad_rows`` separate them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import fails_cast, literal, quoted, real_keeps, to_type
from ..functions.schema import schema_from_text

# Added columns of a tagged frame; a target table may well have a column "value".
SOURCE, REASON, OBJECT = "_source", "_reject_reason", "_object"
REJECT_SCHEMA = schema_from_text("value:STRING, reject_reason:STRING")

# Options also keep the optimizer from splitting one parse into a parse per field.
_JSON_OPTIONS = (
    "map('mode', 'PERMISSIVE', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
)
# The JSON parser hands on a number with a point or an exponent by way of a double. Up to 15 digits that says the same; a row
# with a longer one, or an exponent, has its numbers looked at as they were written.
_LONG_NUMBER = r"[:,\[]\s*-?(?=[\d.]*[.eE])([\d.]{17,}|[\d.]+[eE][+-]?\d+)"
_NUMBER = r"-?\d+(\.\d+)?([eE][+-]?\d+)?"
_NESTED = r"^[\[{]"
_NUMBERS = "_numbers"
# Text of the array element that shows where the source text ends.
_END = "end of row"


def _numbers(value: str) -> str:
    """The numbers of a JSON text, as they were written, that a double doesn't hold; NULL where every number has come through."""
    written = f"regexp_extract_all({quoted(value)}, {literal(_NUMBER)}, 0)"
    return f"CASE WHEN {quoted(value)} RLIKE {literal(_LONG_NUMBER)} THEN filter({written}, t -> NOT {real_keeps('t')}) END AS {_NUMBERS}"


def _changed(raw: str) -> str:
    """True where a text has come from one of ``_numbers``."""
    alike = f"try_cast(t AS DOUBLE) = try_cast({raw} AS DOUBLE) OR {raw} IN ('\"Infinity\"', '\"-Infinity\"') OR {raw} RLIKE {literal(_NESTED)}"
    return f"({_NUMBERS} IS NOT NULL AND exists({_NUMBERS}, t -> t <> {raw} AND ({alike})))"


def _tag(df: DataFrame, raw: dict[str, str], schema: T.StructType, reason: str,
         keep: Sequence[str], value: str, numbers: bool = False) -> DataFrame:
    """Cast the raw columns and attach the reject reason; ``numbers`` says that ``df`` has the numbers of its JSON text.

    The row is built as a one-element array and unnested: a filter on its columns
    then stays above the parse. Without that step the optimizer copies the parse
    into the filter and every row is parsed twice.
    """
    def fails(field: T.StructField) -> list[str]:
        text = isinstance(field.dataType, T.StringType)
        found = [] if text else [fails_cast(raw[field.name], field.dataType)]
        return found + ([_changed(raw[field.name])] if numbers and (text or isinstance(field.dataType, T.DoubleType)) else [])

    wrong = " ".join(f"WHEN {' OR '.join(terms)} THEN {literal('bad value in ' + f.name)}" for f in schema.fields if (terms := fails(f)))
    reasons = f"coalesce({reason}, CASE {wrong} END)" if wrong else reason
    reasons = f"CASE WHEN NOT is_valid_utf8({quoted(value)}) THEN 'not UTF-8' ELSE {reasons} END"
    items = [(name, quoted(name)) for name in keep]
    items += [(f.name, to_type(raw[f.name], f.dataType)) for f in schema.fields]
    items += [(SOURCE, quoted(value)), (REASON, reasons)]
    row = ", ".join(f"{literal(name)}, {expression}" for name, expression in items)
    return df.selectExpr(f"inline(array(named_struct({row})))")


def tag_json(
    df: DataFrame,
    schema: T.StructType,
    *,
    require_keys: bool = False,
    allow_extra_keys: bool = False,
    keep: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Parse one JSON object per row into the columns of ``schema``.

    All fields are read as text and then cast, since a JSON string such as
    ``"4111"`` is a valid BIGINT here. ``require_keys`` rejects rows that lack a
    key (a key holding null is present); rows with keys outside the schema are
    rejected unless ``allow_extra_keys``. The last of repeated keys counts.
    """
    raw = {name: f"_row.{quoted(name)}" for name in schema.names}
    as_text = ", ".join(f"{quoted(name)}: string" for name in schema.names)
    expected = "array(" + ", ".join(map(literal, schema.names)) + ")"
    source = quoted(value)
    carried = [quoted(name) for name in dict.fromkeys([*keep, value])]
    # Parsed as the first of two array elements: if anything follows the object in
    # the source text, the second element is not the end mark.
    first = schema.names[0]
    mark = json.dumps({first: _END})
    objects = (f"from_json(concat('[', {source}, {literal(f',{mark}]')}), "
               f"{literal(f'array<struct<{as_text}>>')}, {_JSON_OPTIONS}) AS _objects")
    keys = [] if allow_extra_keys else [f"json_object_keys({source}) AS _keys"]
    parsed = df.selectExpr(*carried, objects, *keys, _numbers(value)).selectExpr(
        "*",
        f"CASE WHEN size(_objects) = 2 AND get(_objects, 1).{quoted(first)} = {literal(_END)} "
        "THEN get(_objects, 0) END AS _row",
    )

    # Rows without NULLs are well formed and have every key. Only the others list their
    # keys; there are none to list if a value is malformed.
    complete = " AND ".join(f"{column} IS NOT NULL" for column in raw.values())
    found = f"json_object_keys({source})" if allow_extra_keys else "_keys"
    cases = ["WHEN _row IS NULL THEN 'malformed'",
             f"WHEN NOT ({complete}) AND {found} IS NULL THEN 'malformed'"]
    if require_keys:
        missing = f"array_except({expected}, {found})"
        cases.append(f"WHEN NOT ({complete}) AND size({missing}) > 0 "
                     f"THEN concat('missing ', array_join({missing}, ','))")
    if not allow_extra_keys:
        # As many values as keys means that the schema knows every key; else compare them.
        values = " + ".join(f"int({column} IS NOT NULL)" for column in raw.values())
        extra = f"array_except({found}, {expected})"
        cases.append(f"WHEN size({found}) != {values} AND size({extra}) > 0 "
                     f"THEN concat('unknown ', array_join({extra}, ','))")
    return _tag(parsed, raw, schema, f"CASE {' '.join(cases)} END", keep, value, numbers=True)


def parse_object(df: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """The JSON object of every row as a map of texts in ``_object``, NULL if it is malformed.

    The one parse of a message whose schema depends on what it holds; see ``tag_object``. The
    last of repeated keys counts.
    """
    carried = [quoted(name) for name in dict.fromkeys([*keep, value])]
    source, end = quoted(value), literal(_END)
    mark = literal("," + json.dumps({_END: _END}) + "]")
    objects = (f"CASE WHEN is_valid_utf8({source}) THEN from_json(concat('[', {source}, {mark}), "
               f"'array<map<string, string>>', {_JSON_OPTIONS}) END AS _objects")
    last = ("map_from_entries(transform(array_distinct(map_keys(_first)), k -> struct(k, "
            "element_at(filter(map_entries(_first), e -> e.key = k), -1).value)))")
    parsed = df.selectExpr(*carried, objects).selectExpr(
        *carried, f"CASE WHEN size(_objects) = 2 AND try_element_at(get(_objects, 1), {end}) = {end} "
        "THEN get(_objects, 0) END AS _first")
    row = ", ".join(f"{literal(name.strip('`'))}, {name}" for name in carried)
    # One-row unnesting keeps later filters above the parse.
    return parsed.selectExpr(
        f"inline(array(named_struct({row}, {literal(OBJECT)}, CASE WHEN size(array_distinct(map_keys(_first))) "
        f"< size(_first) THEN {last} ELSE _first END)))")


def tag_object(df: DataFrame, schema: T.StructType, *, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Rows of ``parse_object`` as the columns of ``schema``; keys outside the schema reject a row."""
    raw = {name: f"try_element_at({OBJECT}, {literal(name)})" for name in schema.names}
    expected = "array(" + ", ".join(map(literal, schema.names)) + ")"
    extra = f"array_except(map_keys({OBJECT}), {expected})"
    reason = (f"CASE WHEN {OBJECT} IS NULL THEN 'malformed' WHEN size({extra}) > 0 "
              f"THEN concat('unknown ', array_join({extra}, ',')) END")
    return _tag(df.selectExpr("*", _numbers(value)), raw, schema, reason, keep, value, numbers=True)


def tag_csv(
    df: DataFrame, schema: T.StructType, *, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Cut at every comma and take fields by position: no quotes, no trimming.

    Surplus fields are dropped; a short line leaves its last columns NULL.
    """
    carried = [quoted(name) for name in dict.fromkeys([*keep, value])]
    fields = df.selectExpr(*carried, f"split({quoted(value)}, ',', -1) AS _fields")
    raw = {name: f"get(_fields, {i})" for i, name in enumerate(schema.names)}
    return _tag(fields, raw, schema, "CAST(NULL AS STRING)", keep, value)


def accept_all(tagged: DataFrame) -> DataFrame:
    """The typed rows; fails on a bad one, naming the reason."""
    checked = tagged.where(
        f"CASE WHEN {REASON} IS NULL THEN true ELSE raise_error(concat('rejected row: ', {REASON})) END"
    )
    return checked.drop(SOURCE, REASON)


def good_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(SOURCE, REASON)


def bad_rows(tagged: DataFrame) -> DataFrame:
    """Source text and reason of the rejected rows."""
    return tagged.where(F.col(REASON).isNotNull()).select(
        F.col(SOURCE).alias("value"), F.col(REASON).alias("reject_reason")
    )
