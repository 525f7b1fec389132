"""Hard negatives of anchors, by bounds along spanning trees of the anchors.

Anchors of one label that lie near one another form trees of some hundred, each a minimum spanning tree. A row is
scored against the root; from then on a child's score is its parent's plus or minus the length of the edge times
the norm of the row. Where such an interval meets nothing that is asked for, the row isn't scored with the child, and its
interval, a little wider, goes on to the child's children. The others are scored anew, which
makes their intervals points again. So no row that counts is missed, whatever the vectors.

Two walks: the first finds every anchor's nearest rows of its own label, its positives, the second the rows of
other labels in the window below each positive. Anchors meet rows in bundles of trees and stripes of rows; a task holds
one bundle and reads its rows in order.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed

TREE_ANCHORS = 512
BUNDLE_TREES = 64  # trees that a task holds at once
STRIPE_ROWS = 1 << 18
CHUNK_ROWS = 2048  # rows that walk a tree together
MOST_BITS = 12
EXACT = 2.0 ** 52  # products below it are exact in double precision
SEED = 20_250_113
_KEYS = ["size", "side", "bundle", "stripe"]
Pair = tuple[int, int]  # (minus the score, id), so that the best come first


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): points in an order in which parents come first, the place of each one's parent in this
    order (-1: the root, the point nearest to the mean) and the distance to it."""
    n = len(points)
    order, parent, edge = np.empty(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    away, nearest, outside = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    j = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for k in range(n):
        if k:
            j = int(np.where(outside, away, np.inf).argmin())
            parent[k], edge[k] = nearest[j], away[j]
        order[k], outside[j] = j, False
        distance = np.sqrt(((points - points[j]) ** 2).sum(axis=1))
        closer = outside & (distance < away)
        away[closer], nearest[closer] = distance[closer], k
        away[outside & np.isinf(away)] = np.finfo(float).max  # beyond double precision: any parent will do, and all is scored
    return order, parent, edge


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


class Rows:
    """Integer vectors with their ids, labels and norms."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, exact: np.ndarray) -> None:
        self.ids, self.labels, self.exact = ids, labels, exact
        self.values = exact.astype(np.float64)
        self.norms = np.sqrt((self.values ** 2).sum(axis=1))

    def where(self, keep: np.ndarray) -> "Rows":
        return Rows(self.ids[keep], self.labels[keep], self.exact[keep])


class Tree:
    """Anchors in the order of their tree, and what each has found."""

    def __init__(self, label: str, blob: bytes, wishes: list | None = None) -> None:
        self.label = label
        self.name, self.ids, self.exact, self.parent, self.edge = pickle.loads(blob)
        self.points = self.exact.astype(np.float64)
        self.norms = np.sqrt((self.points ** 2).sum(axis=1))
        self.found: dict[tuple[int, int], list[Pair]] = {}
        self.wishes: dict[int, list] = {}
        for wish in wishes or ():
            self.wishes.setdefault(wish["at"], []).append(wish)

    def scores(self, rows: Rows, j: int, pick: np.ndarray) -> np.ndarray:
        """The integer products of some rows with an anchor; a product that is no 64-bit number fails."""
        if rows.norms.max(initial=0) * self.norms[j] < EXACT:
            return np.rint(rows.values[pick] @ self.points[j]).astype(np.int64)
        whole = rows.exact[pick].astype(object) @ self.exact[j].astype(object)
        return np.array([int(s) for s in whole], np.int64)

    def keep(self, key: tuple[int, int], scores: np.ndarray, ids: np.ndarray, most: int) -> None:
        best = np.lexsort((ids, -scores))[:most]
        self.found[key] = sorted(self.found.get(key, []) + [(-int(scores[i]), int(ids[i])) for i in best])[:most]

    def floor(self, key: tuple[int, int], most: int) -> float:
        """The least score that can still be among the best."""
        held = self.found.get(key, ())
        return -held[-1][0] if len(held) == most else -math.inf


Range = tuple[float, float]


def walk(tree: Tree, rows: Rows, wanted: Callable[[int, np.ndarray, np.ndarray], Range], take: Callable[[int, np.ndarray, np.ndarray], None]) -> int:
    """Call ``take`` with all rows whose score with an anchor may be in its ``wanted`` range, which may depend on the
    bounds of all rows; the number of products."""
    n = len(rows.ids)
    low, high = np.full((len(tree.ids), n), -np.inf), np.full((len(tree.ids), n), np.inf)
    reach, scored = 1e-12 * float(tree.norms.max(initial=0)), 0
    with np.errstate(over="ignore", invalid="ignore"):
        for j, parent in enumerate(tree.parent):
            if parent >= 0:
                slack = rows.norms * (tree.edge[j] * (1 + 1e-9) + reach)
                np.subtract(low[parent], slack, out=low[j])
                np.add(high[parent], slack, out=high[j])
            least, most = wanted(j, low[j], high[j])
            if parent >= 0 and least > most:
                continue
            pick = np.flatnonzero(~((high[j] < least) | (low[j] > most))) if parent >= 0 else np.arange(n)
            if len(pick):
                scores = tree.scores(rows, j, pick)
                low[j, pick] = high[j, pick] = scores
                scored += len(pick)
                if least <= most:
                    take(j, pick, scores)
    return scored


def _surely(low: np.ndarray, most: int) -> float:
    """So many rows have at least this score: the ``most``-th greatest lower bound."""
    return float(np.partition(low, len(low) - most)[len(low) - most]) if len(low) >= most else -math.inf


def find_positives(tree: Tree, rows: Rows, most: int) -> int:
    """The ``most`` best other rows of every anchor; ``rows`` have the tree's label."""
    def wanted(j: int, low: np.ndarray, _: np.ndarray) -> Range:
        return max(tree.floor((j, 0), most), _surely(low[rows.ids != tree.ids[j]], most)), math.inf

    def take(j: int, pick: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= tree.floor((j, 0), most)) & (rows.ids[pick] != tree.ids[j])
        if good.any():
            tree.keep((j, 0), scores[good], rows.ids[pick][good], most)

    return walk(tree, rows, wanted, take)


def find_negatives(tree: Tree, rows: Rows, most: int) -> int:
    """The ``most`` best rows in the window of every positive; ``rows`` have other labels than the tree."""
    def ranges(j: int) -> list[tuple[int, float, int]]:
        every = ((w["rank"], max(w["least"], tree.floor((j, w["rank"]), most)), w["most"]) for w in tree.wishes.get(j, ()))
        return [r for r in every if r[1] <= r[2]]

    def wanted(j: int, low: np.ndarray, high: np.ndarray) -> Range:
        asked = ranges(j)
        if not asked:
            return math.inf, -math.inf
        # Rows whose whole interval lies in a window are in it; of these only the best can be wanted.
        return min(max(least, _surely(low[(low >= least) & (high <= upto)], most)) for _, least, upto in asked), max(r[2] for r in asked)

    def take(j: int, pick: np.ndarray, scores: np.ndarray) -> None:
        for rank, least, upto in ranges(j):
            good = (scores >= least) & (scores <= upto)
            if good.any():
                tree.keep((j, rank), scores[good], rows.ids[pick][good], most)

    return walk(tree, rows, wanted, take)


def _search(trees: DataFrame, rows: DataFrame, find: Callable[[Tree, Rows, int], int], most: int, own_label: bool) -> DataFrame:
    """name, at, rank, id and score of what every tree finds among the rows of its bundle and stripe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            keys = list(zip(*(column[c].to_pylist() for c in _KEYS), column["kind"].to_pylist()))
            lo = 0
            while lo < len(keys):
                hi = next((i for i in range(lo + 1, len(keys)) if keys[i] != keys[lo]), len(keys))
                if keys[lo][:-1] != current:
                    yield from told(held)
                    current, held = keys[lo][:-1], []
                part = {c: v.slice(lo, hi - lo) for c, v in column.items()}
                if keys[lo][-1] == 0:
                    held += [Tree(*x) for x in zip(*(part[c].to_pylist() for c in ("label", "tree", "wishes")))]
                elif held:
                    meet(held, part, keys[lo][0])
                lo = hi
        yield from told(held)

    def meet(held: list[Tree], part: dict[str, pa.Array], size: int) -> None:
        exact = _matrix(part["vector"], size) if size else np.zeros((len(part["id"]), 0), np.int64)
        ids, labels = part["id"].to_numpy(), np.array(part["label"].to_pylist(), object)
        for lo in range(0, len(ids), CHUNK_ROWS):
            chunk = Rows(*(v[lo:lo + CHUNK_ROWS] for v in (ids, labels, exact)))
            others: dict[str, Rows] = {}
            for tree in held:
                if not own_label and tree.label not in others:
                    others[tree.label] = chunk.where(chunk.labels != tree.label)
                met = chunk if own_label else others[tree.label]
                if len(met.ids):
                    find(tree, met, most)

    def told(held: list[Tree]) -> Iterator[pa.RecordBatch]:
        rows_ = [(t.name, j, rank, i, -s) for t in held for (j, rank), best in t.found.items() for s, i in best]
        if rows_:
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_), kinds)], names=["name", "at", "rank", "id", "score"])

    dealt = trees.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    dealt = dealt.select(*_KEYS, "kind", "label", "id", "vector", "tree", "wishes")
    return dealt.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "kind").mapInArrow(run, "name string, at int, rank int, id bigint, score bigint")


def _best(found: DataFrame, most: int) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("name", "at", "rank").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", order).where(F.col("place") <= most)


def _trees(anchors: DataFrame, count: int, tree_anchors: int) -> DataFrame:
    """name, size, label and tree of the anchors, in groups of one label and about ``tree_anchors``."""
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, count) / tree_anchors))))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).to_numpy()
            code = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes[sizes > 0]):
                planes = np.random.default_rng((SEED, int(size))).normal(size=(size, bits))
                at = np.flatnonzero(sizes == size)
                side = _matrix(batch.column(2).take(pa.array(at)), size).astype(np.float64) @ planes > 0
                code[at] = side @ (1 << np.arange(bits))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=["id", "label", "vector", "size", "code"])

    coded = anchors.select("id", "label", "vector", "size").mapInArrow(near, "id bigint, label string, vector array<bigint>, size int, code bigint")
    keys = ["size", "label", "code"]
    parts = coded.groupBy(*keys).agg(F.ceil(F.count("*") / tree_anchors).alias("parts"))
    part = F.pmod(F.xxhash64("id", "vector"), F.col("parts"))
    named = coded.join(parts, keys).withColumn("name", F.concat_ws("/", "size", "code", part, "label"))

    def grow(group: pa.Table) -> pa.Table:
        size = group["size"][0].as_py()
        column = group["vector"].combine_chunks()
        exact = _matrix(column, size) if size else np.zeros((len(group), 0), np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            order, parent, edge = spanning_tree(exact.astype(np.float64))
        name = group["name"][0].as_py()
        blob = pickle.dumps((name, group["id"].to_numpy()[order], exact[order], parent, edge))
        return pa.table({"name": [name], "size": pa.array([size], pa.int32()), "label": [group["label"][0].as_py()], "tree": [blob]})

    grown = named.select("name", "size", "label", "id", "vector").groupBy("name").applyInArrow(grow, "name string, size int, label string, tree binary")
    return checkpointed(grown)


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label", tree_anchors: int = TREE_ANCHORS,
                   bundle_trees: int = BUNDLE_TREES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vector_col`` holds integers. Anchors are the rows whose id is divisible by ``every``. The score of a row with an anchor is the
    product of their vectors; higher scores come first, of equal ones the smaller id. An anchor's positives are its first
    ``positives`` rows of the same label with another id. Of each positive, of score p, the first ``negatives`` rows of
    another label with a score s such that ``low`` p <= 100 s <= ``high`` p are returned, ranked from 1.

    Rows without id, label or vector, or with a null component, take no part. Rows that agree in id, label and vector count
    once; rows of one id that differ are rows of their own. Only vectors of one length are compared. An empty table gives no
    rows; other columns are not read. A score outside 64 bits fails.

    Nothing is broadcast or collected. Every row goes to each bundle of ``bundle_trees`` trees, so the work grows with
    anchors times rows, as all anchors are asked against all rows; what the bounds save are products.
    """
    source = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
                            F.col(vector_col).cast("array<bigint>").alias("vector"))
    whole = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    base = checkpointed(source.where(whole).distinct().withColumn("size", F.size("vector")))
    anchors = base.where(F.col("id") % every == 0)
    count, chosen = base.count(), anchors.count()
    trees = _trees(anchors, chosen, tree_anchors)
    parallel = vectors.sparkSession.sparkContext.defaultParallelism
    stripes = max(1, -(-count // STRIPE_ROWS), min(parallel, -(-count // CHUNK_ROWS)))
    striped = base.withColumn("stripe", F.pmod(F.xxhash64("id", "vector"), F.lit(stripes)).cast("int"))

    def meeting(trees: DataFrame, keys: list[str], side) -> tuple[DataFrame, DataFrame]:
        bundles = trees.groupBy(*keys).agg(F.ceil(F.count("*") / bundle_trees).cast("int").alias("bundles"))
        bundled = trees.join(bundles, keys).withColumn("bundle", F.pmod(F.xxhash64("name"), F.col("bundles")).cast("int"))
        bundled = bundled.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
        rows = striped.join(bundles, keys).withColumn("bundle", F.explode(F.sequence(F.lit(0), F.col("bundles") - 1)))
        return (bundled.withColumn("side", side).drop("bundles", "name"), rows.withColumn("side", side).drop("bundles"))

    nothing = F.lit(None).cast("array<struct<at:int,rank:int,least:bigint,most:bigint>>").alias("wishes")
    found = _search(*meeting(trees.select("*", nothing), ["size", "label"], F.col("label")), find_positives, positives, True)
    nearest = checkpointed(_best(found, positives).select("name", "at", F.col("place").alias("rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # The window of a positive in whole numbers; decimals, as the products may pass 64 bits.
    p = F.col("positive_score").cast("decimal(20,0)")
    asked = nearest.select("name", F.struct("at", "rank", F.ceil(p * low / 100).cast("bigint").alias("least"), F.floor(p * high / 100).cast("bigint").alias("most")).alias("wish"))
    wishing = trees.join(asked.groupBy("name").agg(F.collect_list("wish").alias("wishes")), "name")
    below = _best(_search(*meeting(wishing, ["size"], F.lit(None).cast("string")), find_negatives, negatives, False), negatives)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [pickle.loads(blob)[1] for blob in batch.column(1).to_pylist()]
            sizes = [len(i) for i in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(len(ids)), sizes))), pa.array(np.concatenate([np.arange(s) for s in sizes]).astype(np.int32)),
                pa.array(np.concatenate(ids))], names=["name", "at", "anchor_id"])

    anchor_ids = trees.select("name", "tree").mapInArrow(named, "name string, at int, anchor_id bigint")
    result = below.join(nearest, ["name", "at", "rank"]).join(anchor_ids, ["name", "at"])
    return result.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
                         "positive_score", F.col("score").alias("negative_score"))


NEGATIVE_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
