import numpy as np
import pytest

from tabflow.llm.pivot_index import Pivots, near_vectors
from tabflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, near int"


def plain(rows, least=0.93):
    """{row: (links, component)} and all links by comparing all vectors."""
    def sound(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, r in enumerate(rows) if sound(r)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) / np.linalg.norm(np.array(rows[i][1], np.float32).astype(float)) for i in good}
    links = {(i, j) for i in good for j in good if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
             and unit[i] @ unit[j] >= least}
    label = {r[0]: r[0] for r in rows}
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[rows[i][0]], label[rows[j][0]])
            for k in (i, j):
                if label[rows[k][0]] > low:
                    label[rows[k][0]], changed = low, True
    degree = [0] * len(rows)
    for i, _ in links:
        degree[i] += 1
    return [(r[0], degree[i], label[r[0]] if i in unit else r[0]) for i, r in enumerate(rows)], len(links)


def made_up(seed, n=250, d=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, d))
    rows = []
    for i in range(n):
        v = base[rng.integers(0, 40)] + rng.normal(size=d) * rng.choice([0, 0.05, 0.2, 0.35])
        rows.append((i + 3, v.astype(np.float32).tolist(), int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("list_rows", [2048, 4])
def test_all_links_are_found(spark, list_rows):
    rows = made_up(list_rows)
    rows += [(900 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(900, rows[0][1], rows[0][2])]
    rows += [(None, rows[0][1], rows[0][2]), (950, rows[0][1], None), (951, None, 1), (952, [], 1), (953, [0.0] * 16, 1), (954, [float("nan")] * 16, 1),
             (955, [1.0, None], 1), (956, [1.0, float("inf")], 1), (957, [2.0, 4.0], 1), (958, [1.0, 2.0], 1), (959, [-1.0, -2.0], 1), (960, [1e-30] * 16, 2),
             (961, [3.0], 1), (962, [0.5], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    want, links = plain(rows)
    assert links > 300
    got = sorted(((r.vec_id or -1), r.n_links, r.component_id or -1) for r in near_vectors(df, list_rows=list_rows).collect())
    # The cosines of the sample are far enough from the bound for a recall of all.
    assert got == sorted(((i or -1), n, c or -1) for i, n, c in want)


def test_empty(spark):
    out = near_vectors(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["vec_id", "n_links", "component_id", "kept"]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_recall(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = {r.vec_id: r for r in QUERIES["op5_embedding_near_dedup"](spark, folder).collect()}
    assert len(found) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    by_label, wanted, seen = {}, 0, 0
    for i, v, label in rows:
        by_label.setdefault(label, []).append((i, np.array(v, float) / np.linalg.norm(np.array(v, float))))
    for members in by_label.values():
        m = np.stack([v for _, v in members])
        degree = (m @ m.T >= 0.93).sum(axis=1) - 1
        for (i, _), n in zip(members, degree):
            assert found[i].n_links <= n
            wanted, seen = wanted + n, seen + found[i].n_links
    assert seen >= 0.99 * wanted


def sampled(rng, n, d, together):
    """Unit vectors with the mean cosine ``together``."""
    rest = rng.normal(size=(n, d))
    rest[:, 0] = 0
    rest /= np.linalg.norm(rest, axis=1, keepdims=True)
    return np.sqrt(together) * np.eye(1, d) + np.sqrt(1 - together) * rest


def turned(rng, x, together, cosine):
    """For every vector another of the same kind at the given cosine."""
    middle = np.sqrt(together) * np.eye(1, x.shape[1])
    own = (x - middle) / np.sqrt(1 - together)
    other = sampled(rng, len(x), x.shape[1], 0)
    other -= (other * own).sum(axis=1, keepdims=True) * own
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = (cosine - together) / (1 - together)
    return middle + np.sqrt(1 - together) * (c * own + np.sqrt(1 - c * c) * other)


def met(pivots, x, y):
    """Which pairs are verified."""
    (a, p), (b, q) = pivots.describe(x), pivots.describe(y)
    same = a[:, :, None] == b[:, None, :]
    listed = same[:, :pivots.lists, :pivots.lists].any(axis=(1, 2))
    return listed & (same.sum(axis=(1, 2)) >= pivots.shared) & (np.bitwise_count(p ^ q).sum(axis=1) <= pivots.flips)


@pytest.mark.parametrize("dimension", [64, 384])
@pytest.mark.parametrize("together", [0.0, 0.5, 0.8])
@pytest.mark.parametrize("count", [1024, 2048, 4096])
def test_recall_and_cost_for_any_pivots(count, together, dimension):
    """Pairs at the very bound are found, whether the vectors point everywhere or one way, and few others are compared."""
    rng = np.random.default_rng(count + dimension)
    pivots = Pivots.drawn(sampled(rng, count + 512, dimension, together), count, 0.93)
    x = sampled(rng, 3000, dimension, together)
    assert met(pivots, x, turned(rng, x, together, 0.93)).mean() > 0.99
    assert met(pivots, x, sampled(rng, 3000, dimension, together)).mean() < 0.05


def test_vectors_that_point_one_way(spark):
    rng = np.random.default_rng(9)
    base = sampled(rng, 300, 32, 0.8)
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(base)]
    rows += [(1000 + i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(turned(rng, base[:100], 0.8, 0.95))]
    want, links = plain(rows)
    got = near_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert links >= 200 and sum(r.n_links for r in got) >= 0.99 * links


@pytest.mark.parametrize("kind", ["string", "double", "boolean"])
def test_labels_of_any_type(spark, kind):
    label = {"string": lambda i: f"label {i % 3}", "double": lambda i: i % 3 / 2, "boolean": lambda i: i % 2 == 0}[kind]
    rows = [(i, v, label(lab)) for i, v, lab in made_up(3, 120)] + [(999, [1.0] * 16, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], f"vec_id long, embedding array<float>, label {kind}, near int")
    want, _ = plain(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()) == sorted(want)


def test_posted_rows_are_few(spark):
    """What is shuffled grows with the number of lists of a vector, which is small."""
    rng = np.random.default_rng(2)
    pivots = Pivots.drawn(sampled(rng, 1536, 64, 0.0), 1024, 0.93)
    assert pivots.lists <= 8 and pivots.prefix * 4 + 32 + 64 * 4 < 400


def test_long_and_odd_vectors(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i % 5).normal(size=20_000)], 1) for i in range(12)] + [(100, [1.0] * 3, 1), (101, [2.0] * 3, 1)]
    want, links = plain(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect())
    assert links > 10 and got == sorted(want)
