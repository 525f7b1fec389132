import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from check import compare, connect  # noqa: E402
from tabflow.llm.anchor_tree import NEGATIVE_SQL, Rows, Tree, find_negatives, find_positives, hard_negatives, spanning_tree  # noqa: E402
from tabflow.llm.queries import QUERIES  # noqa: E402

SCHEMA = "vec_id long, vector array<bigint>, label string, Rank int, size string"


def plain(rows, every=50, positives=5, negatives=3, low=50, high=95):
    good = {(i, lab, tuple(v)) for i, v, lab, *_ in rows if None not in (i, v, lab) and None not in v}
    out = []
    for i, lab, v in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == lab][:positives]:
            fit = [s for s in scored if s[2] != lab and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(i, j, rank, s[1], -p, -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out)


def made_up(seed, n=900, d=8, spread=0.3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = np.floor(60 * (base[rng.integers(0, 12)] + rng.normal(size=d) * rng.choice([0, spread])))
        rows.append((int(i - 20), [int(x) for x in v], str(rng.integers(0, 4)), 0, "x"))
    return rows


def mined(df, **parameters):
    return sorted(tuple(r) for r in hard_negatives(df, **parameters).collect())


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"tree_anchors": 4, "bundle_trees": 2}), (3, {"tree_anchors": 1, "bundle_trees": 1})])
def test_against_all_scores(spark, seed, sizes):
    rows = made_up(seed)
    rows += [(2000 + i, rows[70][1], rows[70][2], 0, "") for i in range(30)] + [rows[70]] * 40 + [(50, rows[3][1], "3", 0, "")]
    rows += [(None, rows[0][1], "1", 0, ""), (3000, None, "1", 0, ""), (3050, [1, None], "1", 0, ""), (3100, rows[0][1], None, 0, ""),
             (3150, [], "1", 0, ""), (3151, [], "2", 0, ""), (3200, [5, 7], "1", 0, ""), (3201, [5, 6], "1", 0, ""), (3202, [3, 5], "2", 0, ""),
             (3250, [0] * 8, "2", 0, "")]
    got, want = mined(spark.createDataFrame(rows, SCHEMA).repartition(3), every=10, **sizes), plain(rows, every=10)
    assert len(want) > 500
    assert got == want


def test_large_components(spark):
    rows = [(i, [10 ** 9 + i * 7919 % 1000, -3 * 10 ** 8 + i, i], str(i % 3), 0, "") for i in range(200)]
    assert mined(spark.createDataFrame(rows, SCHEMA), high=100) == plain(rows, high=100)


def test_empty(spark):
    out = hard_negatives(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_one_label_has_no_negatives(spark):
    assert mined(spark.createDataFrame([(i, [i, 1], "1", 0, "") for i in range(100)], SCHEMA)) == []


def test_spanning_tree():
    points = np.random.default_rng(4).normal(size=(60, 5))
    order, parent, edge = spanning_tree(points)
    assert sorted(order) == list(range(60)) and parent[0] == -1 and all(parent[k] < k for k in range(1, 60))
    assert np.allclose(edge[1:], np.linalg.norm(points[order[1:]] - points[order[parent[1:]]], axis=1))
    # No spanning tree is shorter: cut by cut, the edge is the least across (Kruskal).
    import itertools
    root = list(range(60))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    least = 0.0
    for length, a, b in sorted((np.linalg.norm(points[a] - points[b]), a, b) for a, b in itertools.combinations(range(60), 2)):
        if find(a) != find(b):
            root[find(a)] = find(b)
            least += length
    assert np.isclose(edge.sum(), least)


def test_bounds_save_products():
    """Anchors and rows in tight groups: most products are never formed."""
    import pickle
    rng = np.random.default_rng(6)
    base = rng.normal(size=(8, 32)) * 40
    anchors = np.floor(base[np.arange(200) % 8] + rng.normal(size=(200, 32)))
    order, parent, edge = spanning_tree(anchors)
    blob = pickle.dumps(("t", np.arange(200)[order] + 10_000, anchors[order].astype(np.int64), parent, edge))
    rows = Rows(np.arange(2000), np.array(["a"] * 2000, object), np.floor(base[np.arange(2000) % 8] + rng.normal(size=(2000, 32))).astype(np.int64))
    tree = Tree("a", blob)
    first = find_positives(tree, rows, 5)
    assert first < 0.2 * 200 * 2000
    wishes = [{"at": j, "rank": 1, "least": 40_000, "most": 45_000} for j in range(200)]
    assert find_negatives(Tree("b", blob, wishes), rows, 3) < 0.2 * 200 * 2000


def test_registered_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(QUERIES["op13_hard_negatives"](spark, folder), connect(folder), NEGATIVE_SQL) is None
