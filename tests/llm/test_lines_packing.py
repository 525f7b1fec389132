import hashlib
from collections import Counter

import pytest

from tabflow.llm.bestfit_pack import CAPACITIES, pack, pack_documents, sequence_cost
from tabflow.llm.line_windows import drop_repeated_lines
from tabflow.llm.queries import QUERIES


def plain_dedup(rows, size=3):
    """Texts left of (id, text) rows; rows of one id and text are one document."""
    seen, left = set(), {}
    key = lambda i, t: hashlib.md5(f"{'null' if i is None else i}\x00{t or ''}".encode()).digest()
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, key(*r))):
        lines, gone = (t or "").split("\n"), set()
        for at in range(len(lines) - size + 1) if t is not None else ():
            window = tuple(lines[at:at + size])
            if "".join(window).strip(" \t\r\n") == "":
                continue
            if window in seen:
                gone |= set(range(at, at + size))
            seen.add(window)
        left[i, t] = (t if not gone else "\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone))
    return left


def test_lines(spark, odd_texts):
    block = "alpha\nbeta\ngamma\ndelta"
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [
        (40, block), (41, f"head\n{block}\ntail"), (42, "beta\ngamma\ndelta\nbeta\ngamma\ndelta"), (43, "x\ny"), (44, "x\ny"),
        (45, "\n\n\n\n\n"), (46, "\n\n\n\n\n"), (47, block), (47, block), (None, block), (None, "alpha\nbeta"), (48, "a\n" * 5000)]
    df = spark.createDataFrame([(1, i, t, "k") for i, t in rows], "_gone int, doc_id long, text string, _key string")
    out = drop_repeated_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    left = plain_dedup(rows)
    found = Counter((r.doc_id, r.text, r.n_removed) for r in out.collect())
    assert found == Counter((i, *left[i, t]) for i, t in rows)
    assert drop_repeated_lines(df.limit(0)).count() == 0


def simulated_pack(lengths, sizes=CAPACITIES):
    """Best fit over lists: what a new sequence will hold is found by filling it with the items behind."""
    bins, place, turn = [], [], 0
    for at, n in enumerate(lengths):
        fits = [b for b in range(len(bins)) if bins[b][0] - bins[b][1] >= n]
        turn += 1
        if fits:
            b = min(fits, key=lambda b: (bins[b][0] - bins[b][1], -bins[b][2]))
        else:
            prices = []
            for c in sizes:
                if c >= n:
                    held = n
                    for other in lengths[at + 1:]:  # longest first
                        if held + other <= c:
                            held += other
                    prices.append(((64 + c + c * c / 16_384) / max(1, held), c))
            bins.append([min(prices)[1], 0, 0])
            b = len(bins) - 1
        bins[b][1] += n
        bins[b][2] = turn
        place.append(b)
    return place, [b[0] for b in bins], [min(c for c in sizes if c >= b[1]) for b in bins]


def cost_of(lengths):
    return sum(sequence_cost(c) for c in lengths)


def test_pack_is_best_fit():
    import random
    random.seed(5)
    for n in (0, 1, 7, 300):
        items = sorted((random.choice((0, 3, 511, 512, 513, random.randint(1, 4096))) for _ in range(n)), reverse=True)
        assert pack(items) == simulated_pack(items)
    assert pack([1500], (1024, 2048))[2] == [2048]
    assert pack([100], (512, 4096))[2] == [512]
    with pytest.raises(ValueError):
        pack([5000])


def cheapest(items, sizes):
    """The least cost of all ways to group a few items."""
    best = [float("inf")]

    def go(rest, bins):
        if not rest:
            best[0] = min(best[0], cost_of(min(c for c in sizes if c >= b) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= max(sizes):
                go(rest[1:], bins[:i] + [bins[i] + rest[0]] + bins[i + 1:])
        go(rest[1:], [*bins, rest[0]])

    go(items, [])
    return best[0]


def test_pack_is_near_the_cheapest():
    """Against all ways to group the items, a rule that has nothing in common with the code's."""
    import random
    random.seed(8)
    ratios = []
    for _ in range(60):
        items = sorted((random.randint(1, random.choice((300, 900, 4096))) for _ in range(7)), reverse=True)
        ratios.append(cost_of(pack(items)[2]) / cheapest(items, CAPACITIES))
    assert min(ratios) >= 1 and max(ratios) < 1.35 and sum(ratios) / len(ratios) < 1.06


def test_several_lengths_are_opened_and_pay(spark):
    """On real lengths: more than one length is chosen, and together they cost less than any one."""
    lengths = [r.n_tokens for r in QUERIES["op2_token_counts"](spark, "/root/testdata/sf0.01").collect()]
    items = sorted((n % 4096 for n in lengths if n % 4096), reverse=True)
    _, opened, final = pack(items)
    shares = {c: n / len(opened) for c, n in Counter(opened).items()}
    assert sum(share > 0.05 for share in shares.values()) >= 2
    assert cost_of(final) < cost_of(pack(items, (4096,))[2])
    shrunk = [min(c for c in CAPACITIES if c >= used) for used in held(items, pack(items, (4096,))[0])]
    assert cost_of(final) < cost_of(shrunk)


def held(items, place):
    used = [0] * (max(place, default=-1) + 1)
    for n, b in zip(items, place):
        used[b] += n
    return used


def test_a_hot_row_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("tabflow.llm.bestfit_pack.COPIES", 10)
    rows = [(1, 700)] * 1234 + [(2, 5000)] * 25 + [(3, 0)] * 31
    out = pack_documents(spark.createDataFrame(rows, "doc_id long, n_tokens long"), shard_tokens=50_000).collect()
    check_packing(out, rows)
    assert len({r.shard for r in out if 1 in r.doc_ids}) > 3


def check_packing(rows, lengths):
    parts = Counter()
    for r in rows:
        assert sum(r.lengths) == r.used <= r.capacity and r.capacity in CAPACITIES
        assert r.capacity == min(c for c in CAPACITIES if c >= r.used) <= r.opened in CAPACITIES
        parts.update(zip(r.doc_ids, r.starts, r.lengths))
    want = Counter()
    for i, n in lengths:
        n = n or 0
        top = max(CAPACITIES)
        for start in range(0, n - n % top, top):
            want[i, start, top] += 1
        if n % top or not n:
            want[i, n - n % top, n % top] += 1
    assert parts == want


def test_pack_documents(spark):
    lengths = [(i, (i * 37) % 5000) for i in range(400)] + [(None, 20)] * 50 + [(3, 10_000), (3, 8192), (9, 0), (9, None), (7, 700), (7, 700)]
    df = spark.createDataFrame([(i, n, 1) for i, n in lengths], "doc_id long, n_tokens long, copy int")
    rows = pack_documents(df, shard_tokens=100_000).collect()
    check_packing(rows, lengths)
    again = pack_documents(df.repartition(3), shard_tokens=100_000).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    filled = sum(r.used for r in rows) / sum(r.capacity for r in rows)
    assert filled > 0.9
    assert pack_documents(df.limit(0)).count() == 0


def test_pack_query(spark, sf_dir):
    lengths = [(r.doc_id, r.n_tokens) for r in QUERIES["op2_token_counts"](spark, sf_dir).collect()]
    check_packing(QUERIES["op3_best_fit_packing"](spark, sf_dir).collect(), lengths)
