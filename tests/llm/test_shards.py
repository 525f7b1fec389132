import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabflow.llm.lpt_shards import deal_equal, shard_documents
from tabflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, Size int, shard string"


def plain_loads(texts, shards=8):
    """Bytes per shard by the rule itself: every group by itself, the largest first, to the least loaded shard."""
    groups = Counter(t or "" for t in texts)
    heap = [(0, j) for j in range(shards)]
    for total in sorted((n * (len(t.encode()) + 1) for t, n in groups.items()), reverse=True):
        load, j = heap[0]
        heapq.heapreplace(heap, (load + total, j))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


def hold(rows, got, shards=8):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text_crc32, r.size) for r in got) == sorted(
        (i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t, *_ in rows)
    of, slots, loads = {}, defaultdict(list), [0] * shards
    for r in got:
        assert of.setdefault((r.text_crc32, r.size), r.shard) == r.shard
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert loads == plain_loads([t for _, t, *_ in rows], shards)


@pytest.mark.parametrize("seed", range(40))
def test_a_class_is_dealt_as_its_groups_one_by_one(seed):
    draw = random.Random(seed)
    loads = [draw.choice([0, 5, draw.randrange(10_000)]) for _ in range(draw.randrange(1, 9))]
    size, count = draw.randrange(1, 500), draw.choice([1, 63, 64, 65, 1000, 4321])
    heap = [(load, j) for j, load in enumerate(loads)]
    heapq.heapify(heap)
    want = [0] * len(loads)
    for _ in range(count):
        load, j = heap[0]
        want[j] += 1
        heapq.heapreplace(heap, (load + size, j))
    after = [load + size * n for load, n in zip(loads, want)]
    assert deal_equal(loads, size, count) == want and loads == after


@pytest.mark.parametrize("block", [1 << 17, 7])
def test_against_the_rule(spark, odd_texts, block):
    draw = random.Random(3)
    texts = [*odd_texts, *("w" * draw.randrange(1, 60) + str(draw.randrange(40)) for _ in range(900)), *["hot copy"] * 400, *["é" * 3000] * 2]
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)] + [(7, "same row", 0, "y")] * 300 + [(None, "no id", 0, "")] * 2
    got = shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(5), block_groups=block).collect()
    hold(rows, got)


def test_many_equal_sizes(spark):
    rows = [(i, f"{i:05d}", 0, "") for i in range(5000)]
    hold(rows, shard_documents(spark.createDataFrame(rows, SCHEMA), shards=3, block_groups=100).collect(), 3)


def test_empty(spark):
    out = shard_documents(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_one_very_long_text(spark):
    rows = [(1, "long " * 4_000_000, 0, ""), (2, "short", 0, ""), (3, None, 0, "")]
    hold(rows, shard_documents(spark.createDataFrame(rows, SCHEMA)).collect())


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_sharding"](spark, sf_dir).collect()
    hold([tuple(d) for d in docs], got)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
