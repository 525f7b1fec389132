"""Near copies by SimHash, found with keys from the binary Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Of at most three
differing bits, some two segments hold at most one each. The (23, 12) Golay code puts
every 23-bit word within three bits of exactly one codeword, and within four bits of
one or six. So two words that differ in at most one bit share a codeword: the nearest
of the one is among the near ones of the other. Every pair of segments (a, b) gives a
fingerprint keys of two sides: (near codewords of a, nearest of b) and (nearest of a,
near codewords of b). Fingerprints that link meet under one key from different
sides; candidates are then verified by their bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed, row_key, spare_name
from tabflow.llm.components import components, forest, roots

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # fixed value: x^11+x^10+x^6+x^5+x^4+x^2+1, of the Golay code
PAIRS_AT_ONCE = 1 << 20
LIST_ROWS = 1 << 15  # longer sides of a key are searched in blocks of about so many


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of all word shingles, repeats included; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    joined, ends = b" ".join(words), ends.tolist()
    ends = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        cut = [joined[a:b] for a, b in zip(starts[lo:min(n, lo + (1 << 16))], ends[lo:lo + (1 << 16)])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, len(cut))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """(syndromes of the upper 12 bits, error patterns by syndrome): the nearest first, then up to five more."""
    def remainder(x: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            x = np.where(x >> bit & 1, x ^ (GENERATOR << (bit - 11)), x)
        return x

    patterns = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            at = int(remainder(np.array(error)))
            if weight < 4 or filled[at] < 6:
                patterns[at, filled[at]] = error
                filled[at] += 1
    return remainder(np.arange(4096) << 11), patterns


def near_codewords(x: np.ndarray) -> np.ndarray:
    """Indices of the codewords within four bits of each 23-bit word, the nearest first, -1 where there are fewer."""
    upper, patterns = golay()
    errors = patterns[upper[x >> 11] ^ (x & 0x7FF)]
    return np.where(errors < 0, -1, (x[:, None] ^ errors) >> 11)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, side, position) of every key of the fingerprints (uint64)."""
    near = [near_codewords((prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)) for at, width in SEGMENTS]
    keys, sides, rows = [], [], []
    for pair, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        for side, (x, y) in enumerate(((near[a], near[b][:, :1]), (near[a][:, :1], near[b]))):
            both = (pair << 24) | (x << 12) | y
            row, column = np.nonzero((x >= 0) & (y >= 0))
            keys.append(both[row, column])
            sides.append(np.full(len(row), side, np.int8))
            rows.append(row)
    return np.concatenate(keys), np.concatenate(sides), np.concatenate(rows)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _hot_links(left: np.ndarray, right: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the links between two long lists join; what is joined already isn't compared again."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    l, r = at[:len(left)], at[len(left):]
    label, step = np.arange(len(nodes)), max(1, PAIRS_AT_ONCE // len(right))
    for lo in range(0, len(l), step):
        rows = l[lo:lo + step]
        top = np.bincount(label[r]).argmax()
        for mine, theirs in ((rows[label[rows] != top], r), (rows[label[rows] == top], r[label[r] != top])):
            if len(mine) and len(theirs):
                i, j = np.nonzero(_apart(nodes[mine][:, None], nodes[theirs][None, :]) <= most)
                label = roots(len(nodes), mine[i], theirs[j], label)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def bucket_links(key: np.ndarray, side: np.ndarray, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of different sides under one key (or group), as a forest; sorted by key and side."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    lefts = np.add.reduceat((side == 0).astype(np.int64), start)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = lefts * (size - lefts)
    for g in np.flatnonzero(pairs > PAIRS_AT_ONCE):
        mid, end = start[g] + lefts[g], start[g] + size[g]
        found.append(_hot_links(prints[start[g]:mid], prints[mid:end], most))
    plain = (pairs > 0) & (pairs <= PAIRS_AT_ONCE)
    group = np.repeat(np.arange(len(start)), size)
    left = np.flatnonzero((side == 0) & plain[group])
    times = (size - lefts)[group[left]]
    first = (start + lefts)[group[left]]
    upto = np.cumsum(times)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
        n = times[lo:hi]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x, y = prints[np.repeat(left[lo:hi], n)], prints[np.repeat(first[lo:hi], n) + within]
        hit = (x != y) & (_apart(x, y) <= most)
        if hit.any():
            found.append(forest(x[hit], y[hit]))
        lo = hi
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return forest(np.concatenate([u for u, _ in found]), np.concatenate([v for _, v in found]))


def _marked(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """id, row key and fingerprint of every row, checkpointed."""
    source = docs.select(F.col(id_col).cast("bigint"), row_key(id_col, text_col), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py() or "", shingle) for x in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["id", "k", "fp"])

    return checkpointed(source.mapInArrow(run, "id bigint, k binary, fp bigint"))


def deal_keys(keyed: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(group, side, fp) of keyed fingerprints: a group is a key, or two blocks of a key's sides.

    Every two fingerprints of different sides of a key meet in one group. A side longer than
    ``list_rows`` is cut into blocks by hash, and each block meets each of the other side by itself, so that no task gathers a key.
    """
    blocks = lambda side: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side") == side) / list_rows)).cast("int")
    # At most one row per ``list_rows`` keyed ones; stored, so that Spark knows how few.
    long = checkpointed(keyed.groupBy("key").agg(blocks(0).alias("lefts"), blocks(1).alias("rights")).where("lefts > 1 OR rights > 1"))
    both = keyed.join(long, "key", "left").withColumns({"lefts": F.coalesce("lefts", F.lit(1)), "rights": F.coalesce("rights", F.lit(1))})
    left = F.col("side") == 0
    both = both.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.when(left, F.col("lefts")).otherwise(F.col("rights"))))
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(left, F.col("rights")).otherwise(F.col("lefts")) - F.lit(1).cast("bigint"))))
    # A key has 26 bits, a block 18.
    part = F.when(left, F.shiftleft("own", 18) + F.col("other")).otherwise(F.shiftleft("other", 18) + F.col("own"))
    return both.select((F.shiftleft("key", 36) + part).alias("group"), "side", "fp")


def _groups(marked: DataFrame, most: int) -> DataFrame:
    """(fp, root, component): the least fingerprint and the least id reachable from each fingerprint."""
    prints = marked.groupBy("fp").agg(F.min("id").alias("least"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo in range(0, len(whole), 4096):
                part = whole[lo:lo + 4096]
                key, side, row = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side), pa.array(part[row])], names=["key", "side", "fp"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            u, v = bucket_links(columns[0], columns[1], columns[2].view(np.uint64), most)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        rest: list[np.ndarray] = []
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rest = [np.concatenate(c) for c in zip(rest, now)] if rest else now
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last group may go on
            if cut:
                yield found([c[:cut] for c in rest])
                rest = [c[cut:] for c in rest]
        if rest and len(rest[0]):
            yield found(rest)

    keyed = prints.select("fp").mapInArrow(keys, "key bigint, side tinyint, fp bigint")
    dealt = deal_keys(keyed).repartition("group").sortWithinPartitions("group", "side")
    roots_of = components(dealt.mapInArrow(links, "u bigint, v bigint"))
    joined = prints.join(roots_of.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = joined.select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(least, "root").select("fp", "root", "component")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id of every row.

    component_id is the least id reachable over links of at most ``max_bits`` (3 at most)
    differing bits; null if no row of the group has an id. Texts without words, null
    or empty, have the fingerprint zero and link like any other. Rows with one
    fingerprint are one node, so copies cost nothing, and of the links only a
    forest per task is passed on. Repeated rows stay; other columns are not read.
    """
    if max_bits > 3:
        raise ValueError("three Golay segments find at most three differing bits")
    marked = _marked(docs, shingle, id_col, text_col)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    joined = marked.join(_groups(marked, max_bits), "fp")
    return joined.select(F.col("id").alias(id_col), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with its columns: that of the least id (null ids
    last), then of the least fingerprint and row key. Of rows that agree in id and text the one stays whose other columns
    come first as JSON text."""
    if max_bits > 3:
        raise ValueError("three Golay segments find at most three differing bits")
    marked = _marked(docs, shingle, id_col, text_col)
    ranked = marked.join(_groups(marked, max_bits), "fp").select(
        "root", F.struct(F.col("id").isNull().alias("none"), "id", "fp", "k").alias("r"))
    kept = ranked.groupBy("root").agg(F.min("r").alias("r")).select(F.col("r.k").alias("_key"))
    key = spare_name(docs, "_key")
    kept = kept.withColumnRenamed("_key", key)
    stay = docs.withColumn(key, row_key(id_col, text_col)).join(kept, key, "left_semi")
    others = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    if not others:
        return stay.dropDuplicates([key]).drop(key)
    first = F.min_by(F.struct(*[F.col(c) for c in docs.columns]), F.to_json(F.struct(*others)))
    return stay.groupBy(key).agg(first.alias("row")).select("row.*")
