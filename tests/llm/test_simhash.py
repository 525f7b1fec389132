import numpy as np
import xxhash

from tabflow.llm.golay_simhash import bucket_links, deal_keys, drop_near_copies, fingerprint, golay_keys, near_codewords, simhash_groups
from tabflow.llm.components import components
from tabflow.llm.queries import QUERIES


def plain_fingerprint(text, shingle=3):
    words = text.encode().lower().split()
    if not words:
        return 0
    cut = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(c, 42) for c in cut]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows, most=3):
    """{row number: least id} by comparing all rows."""
    prints = [plain_fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                label[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    least = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least |= dict.fromkeys(members, min(ids) if ids else None)
    return prints, least, groups


def test_words_one_bit_apart_share_a_codeword():
    x = np.random.default_rng(1).integers(0, 1 << 23, 20_000)
    near = near_codewords(x)
    for bit in range(23):
        nearest = near_codewords(x ^ (1 << bit))[:, 0]
        assert (near == nearest[:, None]).any(axis=1).all()
    assert set((near >= 0).sum(axis=1)) <= {1, 6}


def test_keys_find_every_pair_within_three_bits():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            y[i] ^= np.uint64(1 << int(bit))
    both = np.concatenate([x, y])
    key, side, row = golay_keys(both)
    keys = {}
    for k, s, r in zip(key.tolist(), side.tolist(), row.tolist()):
        keys.setdefault(r, (set(), set()))[s].add(k)
    assert all(keys[i][0] & keys[i + len(x)][1] for i in range(len(x)))


def test_long_lists_join_the_same(monkeypatch):
    monkeypatch.setattr("tabflow.llm.golay_simhash.PAIRS_AT_ONCE", 50)
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 8, 120, dtype=np.uint64) << np.uint64(3) | rng.integers(0, 8, 120, dtype=np.uint64))
    both = np.concatenate([prints, prints])
    side = np.repeat([0, 1], len(prints))
    u, v = bucket_links(np.zeros(len(both), np.int64), side, both, 1)
    want = {}
    for x in prints.tolist():
        seen, todo = {x}, [x]
        while todo:
            now = todo.pop()
            for other in prints.tolist():
                if other not in seen and bin(now ^ other).count("1") <= 1:
                    seen.add(other)
                    todo.append(other)
        want[x] = min(seen)
    got = {x: x for x in want} | dict(zip(u.tolist(), v.tolist()))
    assert got == want


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (7, 9)] + [(500, 400 + i) for i in range(50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 100} | {400 + i: 400 for i in range(50)} | {500: 400}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_of_odd_texts(spark, odd_texts):
    rows = [(i + 5, t) for i, t in enumerate(odd_texts)] + [(1, "same text"), (None, "SAME text"), (None, "lonely words here"), (30, "x"), (30, "x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    prints, least, groups = plain_groups(rows)
    found = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in simhash_groups(df).collect())
    assert found == sorted((d or -1, f"{prints[i]:016x}", least[i] or -1) for i, (d, _) in enumerate(rows))
    kept = drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == len(groups)
    empty = df.limit(0)
    assert simhash_groups(empty).count() == 0 and drop_near_copies(empty).count() == 0


def test_fingerprints(odd_texts):
    assert [fingerprint(t or "") for t in odd_texts] == [plain_fingerprint(t or "") for t in odd_texts]


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    prints, least, _ = plain_groups(rows)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash_near_dedup"](spark, sf_dir).collect()}
    assert found == {d: (f"{prints[i]:016x}", least[i]) for i, (d, _) in enumerate(rows)}


def test_hot_keys_are_dealt(spark):
    """No group has more than about two blocks, and every two fingerprints of a key's sides meet exactly once."""
    rows = [(5, s, f) for s in (0, 1) for f in range(400)] + [(6, 0, f) for f in range(300)] + [(6, 1, 7), (7, 0, 1), (7, 1, 2), (3 << 24, 1, -4)]
    dealt = deal_keys(spark.createDataFrame(rows, "key long, side byte, fp long"), 50).collect()
    groups = {}
    for r in dealt:
        groups.setdefault(r.group, ([], []))[r.side].append(r.fp)
    assert max(len(l) + len(r) for l, r in groups.values()) < 200
    met = sorted((g >> 36, a, b) for g, (l, r) in groups.items() for a in l for b in r)
    assert met == sorted([(5, a, b) for a in range(400) for b in range(400)] + [(6, a, 7) for a in range(300)] + [(7, 1, 2)])


def test_dealt_keys_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr("tabflow.llm.golay_simhash.deal_keys", lambda keyed: deal_keys(keyed, 3))
    rows = [(i, " ".join(f"w{j}" if j != i % 40 else f"x{i}" for j in range(120))) for i in range(60)]
    prints, least, _ = plain_groups(rows)
    found = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(set(least.values())) < len(set(prints)) and {r.doc_id: r.component_id for r in found} == least


def test_of_equal_rows_the_same_one_stays(spark):
    """Rows of one id and text that differ elsewhere: always the same one is kept, however they are dealt."""
    rows = [(1, "one and the same text", f"source {i}", i) for i in range(50)] + [(2, "quite another text here", None, None)] * 3
    kept = set()
    for parts in (1, 4, 7):
        df = spark.createDataFrame(rows[::-1] if parts == 4 else rows, "doc_id long, text string, source string, n int").repartition(parts)
        kept.add(tuple(sorted(map(tuple, drop_near_copies(df).collect()))))
    assert kept == {((1, "one and the same text", "source 0", 0), (2, "quite another text here", None, None))}
    bare = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c d")], "doc_id long, text string")
    assert drop_near_copies(bare).count() == 2
