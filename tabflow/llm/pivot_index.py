"""Near copies among vectors by a pivot-permutation index.

Reference points (pivots) are vectors of the data, drawn by their hash, seen from the middle of the sample, so that vectors which
all point one way spread over them as well. A vector is described by its permutation: its nearest pivots in order, and, for pairs of other pivots,
which of the two comes first. It is posted on the inverted lists of its first pivots. Two vectors on
one list are compared by what they share: first the pairs of pivots they order differently, then the number of pivots in both
prefixes; a pair that passes is verified by its cosine, on the list of its lowest shared pivot only.

How many pivots a vector is posted under, and what two must share, is measured before: partners at exactly the asked cosine are made for sampled
vectors, out of the data's own directions, and the bounds are set so that nearly all of them are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed
from tabflow.llm.components import components, forest

FEWEST_PIVOTS = 1024
PIVOT_BYTES = 64 << 20  # of all pivots, which are broadcast
TRIED = 512  # sampled vectors besides the pivots, for which partners are made
PARTNERS = 6  # of each
RECALL = 0.996  # of the partners that share a list
APART = 0.8  # pivots of a greater cosine would say the same; looked at for up to COMPARED pivots
COMPARED = 8192
MOST_SENT = 1_000_000  # long lists whose numbers of blocks are broadcast (some 30 MB); more are joined by a shuffle
FEWEST_LISTS, MOST_LISTS = 4, 48
MORE_PREFIX = 6  # pivots in the prefix besides those a vector is posted under
ORDERED = 256  # pairs of pivots whose order is kept
LIST_ROWS = 2048  # longer lists are searched in blocks of about so many
PAIRS_AT_ONCE = 1 << 16
SEED = 20_240_229


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows of length one, in double precision, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=1))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _directions(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass
class Pivots:
    """Reference points of vectors of one length, and what near vectors share."""

    centre: np.ndarray
    points: np.ndarray  # directions from the centre
    lists: int = 1  # a vector is posted under so many pivots
    shared: int = 1  # near vectors have at least so many pivots in both prefixes
    flips: int = ORDERED  # and order at most so many pairs differently

    @property
    def prefix(self) -> int:
        return min(len(self.points), self.lists + MORE_PREFIX)

    @property
    def kind(self) -> type:
        """The type of a pivot's number in a prefix."""
        return np.uint16 if len(self.points) <= 1 << 16 else np.int32

    def describe(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the nearest pivots of every vector, the nearest first; words of bits that tell the order of pairs)."""
        near = (vectors - self.centre) @ self.points.T
        first = np.argpartition(-near, self.prefix - 1, axis=1)[:, :self.prefix]
        order = np.take_along_axis(first, np.argsort(-np.take_along_axis(near, first, axis=1), axis=1, kind="stable"), axis=1)
        pairs = min(ORDERED, len(self.points) // 2)
        bits = np.zeros((len(vectors), ORDERED), np.uint8)
        bits[:, :pairs] = near[:, :2 * pairs:2] < near[:, 1:2 * pairs:2]
        return order.astype(self.kind), np.packbits(bits, axis=1).view(np.uint64)

    @staticmethod
    def drawn(sample: np.ndarray, count: int, least: float) -> Pivots:
        """Of a sample of vectors the first ``count`` that lie apart as pivots, with bounds for partners at the cosine ``least``."""
        centre = sample.mean(axis=0)
        tried = sample[-TRIED:]
        points = _directions((sample[:-TRIED] if len(sample) > 2 * TRIED else sample) - centre)
        if len(points) <= COMPARED:
            points = points[~(np.tril(points @ points.T, -1) > APART).any(axis=1)]
        found = Pivots(centre, points[:count])
        x, y = _partners(tried, centre, least)
        if not len(x):
            return found
        found.lists = min(MOST_LISTS, len(found.points))
        a, b = found.describe(x), found.describe(y)
        same = a[0][:, :, None] == b[0][:, None, :]
        for lists in range(min(FEWEST_LISTS, found.lists), found.lists + 1):
            if same[:, :lists, :lists].any(axis=(1, 2)).mean() >= RECALL:
                break
        found.lists = lists
        common = same[:, :found.prefix, :found.prefix].sum(axis=(1, 2))
        found.shared = max(1, int(np.quantile(common, 1 - RECALL)) - 1)
        found.flips = int(np.ceil(np.quantile(np.bitwise_count(a[1] ^ b[1]).sum(axis=1), RECALL))) + 4
        return found


def _partners(vectors: np.ndarray, centre: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample, and partners at exactly the cosine ``least``, as far from the middle and in directions that the data has."""
    x = np.repeat(vectors, PARTNERS, axis=0)
    rng = np.random.default_rng(SEED)
    middle = centre / max(np.linalg.norm(centre), 1e-12)
    along = (x @ middle)[:, None]
    rest = x - along * middle
    size = np.linalg.norm(rest, axis=1, keepdims=True)
    own = rest / np.maximum(size, 1e-12)
    turn = (least - along ** 2) / np.maximum(size ** 2, 1e-12)
    other = own[rng.permutation(len(x))]
    other = other - (other * own).sum(axis=1, keepdims=True) * own
    length = np.linalg.norm(other, axis=1, keepdims=True)
    good = ((np.abs(turn) < 1) & (length > 1e-6)).ravel()
    y = along * middle + size * (turn * own + np.sqrt(np.maximum(0, 1 - turn ** 2)) * other / np.maximum(length, 1e-12))
    return x[good], y[good]


def pivot_count(vectors: int, dimension: int) -> int:
    """Four times the root of the number of vectors, as far as ``PIVOT_BYTES`` go."""
    return max(2, min(PIVOT_BYTES // (12 * max(1, dimension)), max(FEWEST_PIVOTS, round(4 * vectors ** 0.5))))


def _draw(classes: DataFrame, least: float) -> dict[int, Pivots]:
    """Pivots by the length of the vectors, from a sample of those of the least hash."""
    seen = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    if not seen.n:
        return {}
    count = pivot_count(seen.n, seen.d)
    rows = classes.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(count + count // 2 + TRIED).toArrow()
    column = rows["vector"].combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    return {int(d): Pivots.drawn(matrix(column.take(pa.array(np.flatnonzero(sizes == d)))), count, least) for d in np.unique(sizes)}


def list_links(table: dict[str, np.ndarray], pivots: Pivots, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(u, v) joining what links, (row, weight) counts of links, and the number of cosines; the table is sorted by list, block and part."""
    group = np.stack([table[c] for c in ("label", "list", "low", "high")])
    n = group.shape[1]
    start = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
    size = np.diff(np.r_[start, n])
    of = np.repeat(np.arange(len(start)), size)
    end = (start + size)[of]
    # Within one block every later row is a partner, between two blocks all rows of the other.
    one = table["low"] == table["high"]
    lows = np.add.reduceat((table["part"] == table["low"]).astype(np.int64), start)
    first = np.where(one, np.arange(n) + 1, (start + lows)[of])
    times = np.where(one | (table["part"] == table["low"]), end - first, 0)
    weight, links, cosines = np.zeros(n, np.int64), [], 0
    upto, lo = np.cumsum(times), 0
    near, bits = table["near"], table["bits"]
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
        t = times[lo:hi]
        x = np.repeat(np.arange(lo, hi), t)
        y = np.arange(len(x)) - np.repeat(np.cumsum(t) - t, t) + np.repeat(first[lo:hi], t)
        lo = hi
        keep = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1) <= pivots.flips
        x, y = x[keep], y[keep]
        same = near[x][:, :, None] == near[y][:, None, :]
        posted = same[:, :pivots.lists, :pivots.lists].any(axis=2)
        lowest = np.where(posted, near[x][:, :pivots.lists].astype(np.int64), 1 << 32).min(axis=1)
        keep = (same.sum(axis=(1, 2)) >= pivots.shared) & (lowest == table["list"][x])
        x, y = x[keep], y[keep]
        cosines += len(x)
        hit = np.einsum("ij,ij->i", table["vector"][x], table["vector"][y]) >= least
        x, y = x[hit], y[hit]
        np.add.at(weight, x, table["copies"][y])
        np.add.at(weight, y, table["copies"][x])
        if len(x):
            links.append(forest(table["id"][x], table["id"][y]))
    u, v = (np.concatenate(c) for c in zip(*links)) if links else (np.empty(0, np.int64), np.empty(0, np.int64))
    u, v = forest(u, v) if len(u) else (u, v)
    return u, v, np.flatnonzero(weight), weight[weight > 0], cosines


def near_vectors(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 list_rows: int = LIST_ROWS) -> DataFrame:
    """``id_col``, n_links, component_id and kept of every row.

    Rows link if their labels are equal and not null, their vectors as long, and their cosine is ``least`` or more, in
    double precision; vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor
    do rows without an id. Ids are taken as BIGINT, labels of any type as they are. n_links counts the other rows linked directly, copies among them; component_id is the least
    id reachable, null without an id, and kept says that it is the row's own. Repeated rows are copies of one
    another. Other columns are not read.

    Equal vectors of a label are one node with a number of copies. Lists longer than ``list_rows`` are cut into
    blocks, and each two blocks are searched by themselves, so that no task gathers a list. Of the
    links only a forest and sums per row leave a task. The pivots grow with the root of the number of
    vectors up to ``PIVOT_BYTES``, which is what the driver and a broadcast hold of them; beyond (some 10^9 vectors of 64 dimensions) lists grow with the table.
    """
    source = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    classes = checkpointed(source.where(sound).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    drawn = _draw(classes, least)
    shared = vectors.sparkSession.sparkContext.broadcast(drawn)

    def pivots_for(size: int) -> Pivots:
        """Lengths so rare that the sample has none share one list."""
        return shared.value.get(size) or Pivots(np.zeros(size), np.zeros((1, size)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = np.diff(column.offsets.to_numpy())
            near, bits, lists = ([None] * len(sizes) for _ in range(3))
            for d in np.unique(sizes):
                rows, pivots = np.flatnonzero(sizes == d), pivots_for(int(d))
                order, pairs = pivots.describe(matrix(column.take(pa.array(rows))))
                for i, own, words in zip(rows.tolist(), order, pairs):
                    near[i], bits[i], lists[i] = own.tobytes(), words.tobytes(), own[:pivots.lists].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(near, pa.binary()), pa.array(bits, pa.binary()),
                                              pa.array(lists, pa.list_(pa.int32()))], names=["id", "label", "vector", "copies", "size", "near", "bits", "lists"])

    # A label is a number from here on; equal ones stay equal.
    coded = classes.select("id", F.xxhash64("label").alias("label"), "vector", "copies")
    kind = classes.schema["vector"].dataType.simpleString()
    described = checkpointed(coded.mapInArrow(
        index, f"id bigint, label bigint, vector {kind}, copies bigint, size int, near binary, bits binary, lists array<int>"))
    keys = ["size", "label", "list"]
    long = described.select("label", "size", F.explode("lists").alias("list")).groupBy(keys).count().where(F.col("count") > list_rows)
    long = long.select(*keys, F.ceil(F.col("count") / list_rows).cast("int").alias("blocks"))
    long = checkpointed(long)
    n_long = long.count()
    posted = described.select("*", F.explode("lists").alias("list")).drop("lists")
    if n_long:
        posted = posted.join(F.broadcast(long) if n_long <= MOST_SENT else long, keys, "left")
    blocks = F.coalesce("blocks", F.lit(1)) if n_long else F.lit(1)
    posted = posted.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), blocks).cast("int"))
    posted = posted.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    posted = posted.select(*keys, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "copies", "near", "bits", "vector")
    dealt = posted.repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, now]) if rest is not None else now
            if not rest.num_rows:
                continue
            group = np.stack([rest[c].to_numpy() for c in (*keys, "low", "high")])
            cut = int(np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])[-1])
            if cut:
                yield from found(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from found(rest)

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = rows["size"].to_numpy()
        for d in np.unique(sizes).tolist():
            part = rows.filter(pa.array(sizes == d)).combine_chunks()
            blob = lambda name, kind: np.frombuffer(b"".join(part[name].to_pylist()), kind).reshape(len(part), -1)
            table = {c: part[c].to_numpy() for c in ("label", "list", "low", "high", "part", "id", "copies")}
            table |= {"near": blob("near", pivots_for(d).kind), "bits": blob("bits", np.uint64), "vector": matrix(part["vector"].combine_chunks())}
            u, v, row, weight, _ = list_links(table, pivots_for(d), least)
            none = np.zeros(len(u), bool), np.ones(len(row), bool)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([u, table["id"][row]])), pa.array(np.concatenate([v, np.zeros(len(row), np.int64)]), mask=np.concatenate(none)),
                pa.array(np.concatenate([np.zeros(len(u), np.int64), weight])), pa.array(np.concatenate([np.zeros(len(u), np.int64), table["label"][row]])),
            ], names=["u", "v", "n", "label"])

    result = checkpointed(dealt.mapInArrow(search, "u bigint, v bigint, n bigint, label bigint"))
    degree = result.where("v IS NULL").groupBy(F.col("u").alias("id"), F.col("label").alias("code")).agg(F.sum("n").alias("links"))
    root = components(result.where("v IS NOT NULL").select("u", "v")).withColumnRenamed("node", "id")
    known = classes.withColumn("code", F.xxhash64("label")).join(degree, ["id", "code"], "left").join(root, "id", "left").select(
        "label", "vector", F.coalesce("root", "id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    linked = source.where(sound).join(known, ["label", "vector"]).select("id", "links", "component")
    alone = source.where(~sound).select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                                            (F.col("id") == F.col("component")).alias("kept"))
