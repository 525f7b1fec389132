"""Threshold-scaled sketches: all shingle hashes below a fixed fraction of the range.

A sketch keeps every distinct hash of five-word shingles under the threshold, so its size
follows the text's, the sketch of a union is the union of the sketches, and the shares of two very
unequal texts in one another can be estimated from their sketches alone. A text of few
shingles may have none below the threshold; its sketch is then its least hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.llm.common import by_bytes, mixed, span_hashes, utf8, word_spans

SHINGLE = 5
FRACTION = 16  # one hash in so many is kept
BATCH_BYTES = 1 << 20
RANGE_BYTES = 4 << 20
MOST_RANGES = 100_000
PER_RANGE = 16  # ids in the sample for each range


def _threshold(fraction: int) -> np.uint64:
    return np.uint64((1 << 64) // fraction - 1)


def sketches(data: np.ndarray, starts: np.ndarray, shingle: int = SHINGLE, fraction: int = FRACTION) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's sketch; texts without words have none.

    A text of fewer words than a shingle has one shingle of all of them.
    """
    begin, end, text = word_spans(data, starts)
    words = np.bincount(text, minlength=len(starts) - 1)
    first = np.r_[0, np.cumsum(words)]
    h = np.zeros(len(begin), np.uint64)
    word = span_hashes(data, begin, end)
    rank = np.arange(len(begin)) - first[text]
    for k in range(shingle):
        inside = rank + k < words[text]
        part = np.zeros(len(begin), np.uint64)
        part[inside] = word[np.flatnonzero(inside) + k]
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k))
    begins = (rank == 0) | (rank + shingle <= words[text])
    keep = begins & (h <= _threshold(fraction))
    found = np.split(h[keep], np.searchsorted(text[keep], np.arange(1, len(starts) - 1)))
    out = []
    for i, hashes in enumerate(found):
        if not len(hashes) and words[i]:
            own = slice(first[i], first[i + 1])
            hashes = h[own][begins[own]].min(keepdims=True)
        out.append(np.unique(hashes))
    return out


def merge(parts: list[np.ndarray], fraction: int = FRACTION) -> np.ndarray:
    """The sketch of texts together (their shingles, not those across their borders)."""
    union = reduce(np.union1d, parts, np.empty(0, np.uint64))
    below = union[union <= _threshold(fraction)]
    return below if len(below) else union[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of a's shingles that b has."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else float(not len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated shared shingles over those of the smaller text; two texts without words are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def encoded(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and fingerprint (16 hex digits per hash, ascending) of every row; a null text counts as empty."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(1))
            out: list[str] = []
            for lo, hi in by_bytes(starts, BATCH_BYTES):
                out += map(encoded, sketches(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "fingerprint"])

    return source.mapInArrow(run, StructType([source.schema[0]]).add("fingerprint", "string"))


def _bounds(rows: DataFrame, n: int, count: int) -> np.ndarray:
    """Ids that cut the table into about n ranges; each is an id of the table and begins a range.

    They come from a sample by the ids' hash, of some ``PER_RANGE`` ids to a range, and stay whole numbers throughout: a
    quantile in double precision would round ids beyond 2^53 to ones that the table hasn't got.
    """
    if n < 2:
        return np.empty(0, np.int64)
    share = min(1 << 40, (1 << 40) * n * PER_RANGE // max(1, count))
    sample = rows.where(F.col("id").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < share)).select("id").distinct()
    ids = np.sort(sample.toArrow()["id"].to_numpy())
    return np.unique(ids[np.linspace(0, len(ids), n + 1).astype(np.int64)[1:-1]]) if len(ids) else np.empty(0, np.int64)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketches of every text and of its edit, and how alike they are.

    The edit replaces the last quarter of a text's characters (rounded down) by the first as many, or all,
    of the next text; after the last row comes the first. Rows follow one another by
    id, null ids first, then by text, so repeated rows are one another's next. A null text counts
    as empty. Returns ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next; other columns are not read.

    Rows go to ranges of ids, each range's first row also to the range before it, and every range is read
    in order: one shuffle, and two texts at a time in memory. At most ``MOST_RANGES`` bounds are kept, from some
    ``PER_RANGE`` times as many ids on the driver. A range whose last row has no successor fails the job, so no row is lost unseen.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    seen = rows.agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"), F.min("id").alias("least"),
                    F.min(F.when(F.col("id").isNull(), F.col("text"))).alias("unnamed")).first()
    bounds = _bounds(rows, min(MOST_RANGES, -(-(seen.size or 0) // RANGE_BYTES)), seen.n)
    first = docs.sparkSession.sparkContext.broadcast((bounds, seen.least, seen.unnamed))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, least, unnamed = first.value
        for batch in batches:
            data, starts = utf8(batch.column(1))
            blobs: list[bytes] = []
            for lo, hi in by_bytes(starts, BATCH_BYTES):
                blobs += (s.tobytes() for s in sketches(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo]))
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            place = np.where(none, 0, np.searchsorted(cuts, ids, "right"))
            # What begins a range also ends the one before it; the very first row ends the last range.
            begins = np.flatnonzero(~none & np.isin(ids, cuts))
            wraps = np.flatnonzero(none if unnamed is not None else ~none & (ids == least))
            if unnamed is not None:
                wraps = np.array([i for i in wraps if batch.column(1)[i].as_py() == unnamed][:1], np.int64)
            rows_ = np.concatenate([np.arange(batch.num_rows), begins, wraps]).astype(np.int64)
            where = np.concatenate([place, place[begins] - 1, np.full(len(wraps), len(cuts))]).astype(np.int32)
            last = np.arange(len(rows_)) >= batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(where), pa.array(last), batch.column(0).take(pa.array(rows_)), batch.column(1).take(pa.array(rows_)),
                 pa.array([blobs[i] for i in rows_], pa.binary())], names=["place", "last", "id", "text", "sketch"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            now = list(zip(*(batch.column(i).to_pylist() for i in range(5))))
            pairs = []
            for row in now:
                if before is not None and not before[1]:
                    ended(before, row[0])
                    pairs.append((before, row))
                before = row
            yield compare(pairs)
        if before is not None and not before[1]:
            ended(before, None)

    def ended(row: tuple, place: int | None) -> None:
        if row[0] != place:
            raise ValueError(f"the row after id {row[2]} is missing")

    def compare(pairs: list[tuple]) -> pa.RecordBatch:
        edits = [(a[3][:len(a[3]) - len(a[3]) // 4] + b[3][:len(a[3]) // 4]).encode() for a, b in pairs]
        starts = np.r_[0, np.cumsum([len(e) for e in edits])].astype(np.int64)
        data = np.frombuffer(b"".join(edits), np.uint8)
        changed: list[np.ndarray] = []
        for lo, hi in by_bytes(starts, BATCH_BYTES):
            changed += sketches(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
        own = [np.frombuffer(a[4], np.uint64) for a, _ in pairs]
        following = [np.frombuffer(b[4], np.uint64) for _, b in pairs]
        strings = lambda values: pa.array(values, pa.string())
        return pa.RecordBatch.from_arrays([
            pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
            strings([hashlib.sha256(e).hexdigest() for e in edits]), strings([*map(encoded, own)]), strings([*map(encoded, changed)]),
            pa.array([*map(likeness, own, changed)], pa.float64()), pa.array([*map(likeness, own, following)], pa.float64()),
        ], names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    dealt = rows.mapInArrow(deal, "place int, last boolean, id bigint, text string, sketch binary")
    ordered = dealt.repartition("place").sortWithinPartitions("place", "last", "id", "text")
    return ordered.mapInArrow(follow, f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double")
