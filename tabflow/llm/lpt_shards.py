"""Shards of near equal bytes by longest-processing-time scheduling.

Documents of equal texts are a group that stays together. Groups go, the largest first, to the shard
with the least bytes so far, which a heap gives. Groups of one size are interchangeable, so the heap isn't asked for
each of them: the schedule deals classes of equal size, and of a large class it works out at once how many
groups the heap would give each shard. A class is a row (size, number of groups). Different
sizes that add up to B bytes are at most sqrt(2 B), 14 million for 100 TB; these rows alone are
scheduled in order, in one task that holds nothing but the loads of the shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed

BLOCK_GROUPS = 1 << 17  # groups of one size that are numbered in one task
SINGLY = 64  # so many groups of one size go through the heap one by one


def deal_equal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of ``size`` each shard gets if every group goes to the least loaded one (of
    equals the first); ``loads`` grow by them."""
    given = [0] * len(loads)
    if count > SINGLY:
        # Shard j would take its next groups at the loads l, l + size, l + 2 size, ...; the heap takes the least of all
        # shards' values, so all values below some level. Search the highest level that asks for no more than there are.
        wanted = lambda level: [max(0, -((load - level) // size)) for load in loads]
        low, high = min(loads), min(loads) + size * count
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if sum(wanted(middle)) <= count else (low, middle - 1)
        given = wanted(low)
        count -= sum(given)
    heap = [(load + size * n, j) for j, (load, n) in enumerate(zip(loads, given))]
    heapq.heapify(heap)
    for _ in range(count):
        load, j = heap[0]
        given[j] += 1
        heapq.heapreplace(heap, (load + size, j))
    for j, n in enumerate(given):
        loads[j] += size * n
    return given


def _schedule(units: DataFrame, shards: int) -> DataFrame:
    """``ends`` of every (total, block): its groups ranked below ends[0] go to shard 0, those below ends[1] to shard 1, ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [0] * shards
        for batch in batches:
            ends = []
            for total, groups in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                given, upto = deal_equal(loads, total, groups), 0
                ends.append([upto := upto + n for n in given])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ends, pa.list_(pa.int64()))], names=["total", "block", "ends"])

    ordered = units.repartition(1).sortWithinPartitions(F.desc("total"), "block")
    return ordered.mapInArrow(run, "total bigint, block bigint, ends array<bigint>")


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """``id_col``, size, text_crc32, shard and slot of every row.

    The size of a row is the UTF-8 bytes of its text plus one; a null text counts as empty. Rows of equal texts are in
    one shard; texts whose 64-bit hash and length agree count as equal, so that two others may stay together, never
    the other way round. Slots count the rows of a shard from 0, without gaps. Repeated rows, and rows
    without an id, are rows like any other and have slots of their own. An empty table gives no rows; other columns are not read.

    Texts are read once and never shuffled. Copies are counted before the shuffle; their rows meet the group's
    shard in a join that AQE splits. The groups of a size are numbered in blocks of about ``block_groups``, and the rows of
    a shard by the partitions of a written table, so no task numbers more than a part of a shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = checkpointed(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                                    F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("text")))
    groups = checkpointed(rows.groupBy("text", "size").agg(F.count("*").alias("n")).select("text", "size", (F.col("n") * F.col("size")).alias("total")))
    large = groups.groupBy("total").agg(F.count("*").alias("n")).where(F.col("n") > block_groups)
    blocks = large.select("total", F.ceil(F.col("n") / block_groups).alias("blocks"))
    blocked = groups.join(blocks, "total", "left").withColumn(
        "block", F.pmod(F.xxhash64("text", "size"), F.coalesce("blocks", F.lit(1)))).drop("blocks")
    ends = _schedule(blocked.groupBy("total", "block").agg(F.count("*").alias("groups")), shards)
    rank = F.row_number().over(Window.partitionBy("total", "block").orderBy("text", "size")) - 1
    ranked = blocked.withColumn("rank", rank).join(ends, ["total", "block"])
    dealt = ranked.select("text", "size", F.size(F.filter("ends", lambda end: end <= F.col("rank"))).alias("shard"))
    placed = checkpointed(rows.join(dealt, ["text", "size"]).select("id", "size", "crc", "shard"))
    # The table is written, so its partitions stay as they are.
    parts = placed.withColumn("part", F.spark_partition_id())
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = parts.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "size", "crc")) - 1
    numbered = parts.withColumn("within", within).join(offsets, ["shard", "part"])
    return numbered.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                           (F.col("before") + F.col("within")).cast("bigint").alias("slot"))
