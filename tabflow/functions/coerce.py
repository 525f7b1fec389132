"""Checked casts from raw columns to declared types.

A text is a value of a type if it looks like one of its literals and the cast value says the same: no digit, zone or time is
lost, nothing is filled in, nothing depends on the day of the load. Spark's own casts are more generous (``1d`` is a
number, ``12:30`` today's time, ``2024`` a date).

Expressions are SQL text: a frame over a wide schema is then built by one call
into the JVM instead of several per column, which counts when a stream does so
for every table of every micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# How the literals of a type look (whole text). A time of midnight behind a date tells nothing else, nor do
# zeros behind the sixth digit of a second; only an instant has a zone, and without one it is UTC.
_DAY = r"(?!0000)\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"[ T]\d{1,2}:\d{2}:\d{2}(\.\d{1,6}0*)?"
_INTEGER = r"[+-]?\d+"
_REAL = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
_NO_NUMBER = r"(?i)nan|[+-]?inf(inity)?"
_LITERALS: dict[type[T.DataType], str] = {
    T.ByteType: _INTEGER,
    T.ShortType: _INTEGER,
    T.IntegerType: _INTEGER,
    T.LongType: _INTEGER,
    T.DoubleType: f"{_REAL}|{_NO_NUMBER}",
    T.DateType: rf"{_DAY}([ T]00:00:00(\.0+)?)?",
    T.TimestampNTZType: f"{_DAY}({_TIME})?",
    T.TimestampType: rf"{_DAY}({_TIME}( ?(Z|UTC|GMT|[+-]\d{{1,2}}:\d{{2}}))?)?",
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_type(raw: str, kind: T.DataType) -> str:
    """``raw`` as ``kind``, NULL where the text is no such value (in any ANSI mode)."""
    return raw if isinstance(kind, T.StringType) else f"try_cast({raw} AS {kind.simpleString()})"


def _looks_like(raw: str, pattern: str) -> str:
    return f"{raw} RLIKE {literal(f'^(?:{pattern})' + chr(92) + 'z')}"


def _digits(text: str) -> str:
    """The significant digits of a number's text."""
    return f"trim(BOTH '0' FROM regexp_replace(regexp_replace({text}, '[eE].*', ''), '[^0-9]', ''))"


def real_keeps(raw: str) -> str:
    """True where a number's text and its nearest double say the same.

    Up to 15 digits always do, 17 below 2^53, where doubles lie closer than that; beyond, the double must
    print the same digits or be the same whole number. Overflow is a loss, and so is a number too small.
    """
    cast = f"try_cast({raw} AS DOUBLE)"
    own = _digits(raw)
    normal = f"abs({cast}) BETWEEN 2.3e-308D AND 1.7976931348623157e308D"
    return (f"CASE WHEN length({raw}) <= 15 AND NOT {raw} RLIKE '[a-zA-Z]' THEN true "
            f"WHEN {_looks_like(raw, _NO_NUMBER)} THEN true "
            f"WHEN {own} = {_digits(f'CAST({cast} AS STRING)')} THEN abs({cast}) <= 1.7976931348623157e308D "
            f"WHEN NOT {normal} THEN false "
            f"ELSE length({own}) <= 15 OR (length({own}) <= 17 AND abs({cast}) < 9007199254740992D) "
            f"OR coalesce(try_cast({raw} AS BIGINT) = try_cast({cast} AS BIGINT), false) END")


def _keeps(raw: str, kind: T.DataType, source: T.DataType) -> str | None:
    """True where the cast value says the same as ``raw``; None if every successful cast does."""
    cast = to_type(raw, kind)
    if isinstance(source, T.StringType):
        pattern = _LITERALS.get(type(kind))
        if pattern is None:
            return None
        alike = _looks_like(raw, pattern)
        return f"({alike} AND {real_keeps(raw)})" if isinstance(kind, T.DoubleType) else alike
    # Whatever comes back by the opposite cast has not lost anything.
    return f"coalesce(try_cast({cast} AS {source.simpleString()}) = {raw}, false)"


def fails_cast(raw: str, kind: T.DataType, source: T.DataType = T.StringType()) -> str:
    """True where a value is present but is not a ``kind``, or only with a loss."""
    if isinstance(kind, T.StringType) or kind == source:
        return "false"
    failure = f"{to_type(raw, kind)} IS NULL"
    if kept := _keeps(raw, kind, source):
        failure = f"({failure} OR NOT {kept})"
    return f"({raw} IS NOT NULL AND {failure})"


def checked_cast(raw: str, kind: T.DataType, name: str, source: T.DataType = T.StringType()) -> str:
    """The cast value; a value that is none of the type, or would lose something, fails the job."""
    message = f"concat({literal(f'column {name}: not a {kind.simpleString()}: ')}, CAST({raw} AS STRING))"
    return f"CASE WHEN {fails_cast(raw, kind, source)} THEN raise_error({message}) ELSE {to_type(raw, kind)} END"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns to ``schema`` by name: cast without loss, fill absent ones with NULL, refuse extra ones.

    Names match as the session compares them, by default in any case.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda name: name) if exact else str.lower
    present = {fold(f.name): f for f in df.schema.fields}
    if len(present) < len(df.columns):
        raise ValueError(f"columns of one name: {df.columns}")
    wanted = {fold(name) for name in schema.names}
    if extra := [f.name for name, f in present.items() if name not in wanted]:
        raise ValueError(f"columns not in the target schema: {extra}")

    def column(field: T.StructField) -> str:
        kind = field.dataType.simpleString()
        found = present.get(fold(field.name))
        if found is None:
            return f"CAST(NULL AS {kind})"
        if found.dataType == field.dataType:
            return quoted(found.name)
        if isinstance(field.dataType, T.StringType):
            return f"CAST({quoted(found.name)} AS STRING)"
        return checked_cast(quoted(found.name), field.dataType, field.name, found.dataType)

    return df.selectExpr(*[f"{column(f)} AS {quoted(f.name)}" for f in schema.fields])
