"""What the operators of this package share: reading, Arrow text buffers, checkpoints."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` and read from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts (one entry more); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, starts, data = column.buffers()
    if starts is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def texts(column: pa.Array) -> Iterator[str]:
    """The texts of a column one by one; null is empty."""
    return (x.as_py() or "" for x in column)


def in_bucket(column: str, modulus: int):
    """crc32 of the column as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(id_col: str, text_col: str):
    """16 bytes that stand for an id and its text; rows that agree in both share it."""
    whole = F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit("")))
    return F.unhex(F.md5(whole))


def value_counts(rows: DataFrame, column: str, most: int) -> dict:
    """The numbers of rows of the values of a column; of more than ``most`` values those of the most frequent."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(most)
    return {r[0]: r[1] for r in counts.collect()}


def fair_share(counts: dict, size: int) -> int:
    """The number of rows a value may have at most, so that all values together have ``size``, or all their rows."""
    left, share = size, 0
    for i, n in enumerate(sorted(counts.values())):
        share = -(-left // (len(counts) - i))
        if n >= share:
            return share
        left, share = left - n, n
    return share


def least_hashed(rows: DataFrame, key: str, size: int, by: str, counts: dict, *columns: Column) -> DataFrame:
    """``key``, ``by`` and ``columns`` of at most ``size`` rows: of every value of ``by`` in ``counts`` its ``fair_share``
    of rows, those of the least hash of ``key``, then by ``columns``; of rows that share ``key`` and ``by`` the first.

    A bound on the hash for each value comes first, six deviations above its share, so that few rows are ranked. ``counts``
    has at most ``size`` values and is broadcast.
    """
    share = fair_share(counts, size)
    bound = share + 6 * math.ceil(share ** 0.5) + 20
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    limits = [(value, (1 << 40) * min(n, bound) // n) for value, n in counts.items()]
    kind = T.StructType([T.StructField("_by", rows.schema[by].dataType), T.StructField("_limit", T.LongType())])
    near = rows.join(F.broadcast(rows.sparkSession.createDataFrame(limits, kind)), F.col(by) == F.col("_by")).where(hashed < F.col("_limit"))
    # One row of a key collapses before the shuffle, so that a hot key isn't ranked copy by copy.
    named = near.select(key, by, *columns)
    first = F.min(F.struct(*named.columns[2:] or [key])).alias("_first")
    drawn = named.groupBy(key, by).agg(first).select(key, by, *[F.col("_first")[c].alias(c) for c in named.columns[2:]])
    order = [hashed, F.col(key), *[F.col(c) for c in drawn.columns[2:]]]
    ranked = drawn.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.orderBy("_rank", *order, by).limit(size).drop("_rank")


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, text) of every word between ASCII white space."""
    letter = ~SPACES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begin = np.flatnonzero(letter & (cut[:-1] | np.r_[True, ~letter[:-1]]))
    end = np.flatnonzero(letter & (cut[1:] | np.r_[~letter[1:], True])) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; up to some millions of them are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if n <= 1 << 22:
            _POWERS[base] = known
    return known[:n]


HASHED_AT_ONCE = 1 << 23  # bytes; sums over more would be many times the size of a long text


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever they stand."""
    if len(data) > HASHED_AT_ONCE and len(begin):
        out = np.empty(len(begin), np.uint64)
        part = begin // HASHED_AT_ONCE
        for p in np.unique(part):
            some = np.flatnonzero(part == p)
            lo, hi = int(p) * HASHED_AT_ONCE, int(end[some].max())
            out[some] = _span_hashes(data[lo:hi], begin[some] - lo, end[some] - lo)
        return out
    return _span_hashes(data, begin, end)


def _span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.add(data, np.uint64(1), out=total[1:], dtype=np.uint64)
    total[1:] *= _powers(_BASE, len(data))
    np.cumsum(total, out=total)
    sums = total[end]
    sums -= total[begin]
    sums *= _powers(_BASE_INVERSE, len(data) + 1)[begin]
    sums += (end - begin).astype(np.uint64)
    return mixed(sums)


def by_bytes(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes, or of one longer text."""
    lo = 0
    while lo < len(starts) - 1:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi
