"""Packing of documents into sequences of several permitted lengths.

Longer documents fill sequences of the greatest length; what is left of them and all
others are dealt evenly to shards and packed there, the longest first, each into the open
sequence with the least room that holds it. If none does, a new one is opened: of all lengths
that hold the item the one that costs least for each token that it will hold. What it will hold is not a guess: the
items still to come, a histogram of lengths, are put into it on trial, the longest that fits first. A sequence
costs its tokens, a share for itself, and attention, which grows with the square of its length; so neither the greatest nor the least
length is always the cheapest. In the end every sequence shrinks to the least length that holds its contents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import checkpointed

CAPACITIES = (512, 1024, 2048, 4096)
SEQUENCE_COST = 64  # what a sequence costs besides its tokens, in tokens
ATTENTION_TOKENS = 16_384  # in a sequence of this length attention costs as much as all else
SHARD_TOKENS = 2_000_000
COPIES = 10_000
ITEM_WEIGHT = 64  # what an item counts besides its tokens when shards are made


def sequence_cost(length: int) -> float:
    """What a sequence of a length costs, in tokens."""
    return SEQUENCE_COST + length + length * length / ATTENTION_TOKENS


class Ahead:
    """The lengths still to come, and how far they fill a room."""

    def __init__(self, lengths: list[int]) -> None:
        self.count = Counter(lengths)
        self.present = sum(1 << n for n in self.count if n)  # a bit for each length

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n] and n:
            self.present &= ~(1 << n)

    def left_over(self, room: int) -> int:
        """The room that is left if the longest item that fits goes in, again and again."""
        fitting = self.present & ((1 << (room + 1)) - 1)
        while fitting:
            n = fitting.bit_length() - 1
            room -= n * min(self.count[n], room // n)
            fitting &= (1 << min(n, room + 1)) - 1
        return room


def pack(lengths: Iterable[int], capacities: tuple[int, ...] = CAPACITIES,
         cost: Callable[[int], float] = sequence_cost) -> tuple[list[int], list[int], list[int]]:
    """(the sequence of each item, the length each sequence was opened with, and the length it shrinks to); items come longest first."""
    lengths, sizes = [*lengths], sorted(capacities)
    if any(n > sizes[-1] for n in lengths):
        raise ValueError("an item is longer than the greatest sequence")
    ahead, room, place = Ahead(lengths), 0, []
    open_bins: dict[int, list[int]] = {}  # by free room; ``room`` has a bit for each
    used: list[int] = []
    opened: list[int] = []
    for n in lengths:
        ahead.take(n)
        fitting = room >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            bin_ = open_bins[free].pop()
            if not open_bins[free]:
                room &= ~(1 << free)
        else:
            free = min((c for c in sizes if c >= n), key=lambda c: (cost(c) / max(1, c - ahead.left_over(c - n)), c))
            bin_ = len(used)
            used.append(0)
            opened.append(free)
        place.append(bin_)
        used[bin_] += n
        open_bins.setdefault(free - n, []).append(bin_)
        room |= 1 << (free - n)
    return place, opened, [next(c for c in sizes if c >= u) for u in used]


def pack_documents(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost,
                   shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", length_col: str = "n_tokens") -> DataFrame:
    """One row per sequence: shard, bin, the length it was opened with, its capacity, used, doc_ids, starts and lengths of its parts.

    ``starts`` has where a part begins in its document. Every row of ``lengths`` is packed: a
    null length counts as 0, a document of length 0 is a part of length 0, negative ones
    fail. Repeated rows are packed as often as they occur, null ids too; other
    columns are not read. Rows of one id and length are counted before the shuffle and
    dealt out again by their number, in blocks of ``COPIES`` that are spread over the tasks first, so a hot id is spread over all shards. The shards
    grow in number, not in size, with the tokens and rows; each loses at most the room of its last
    few sequences. Ties are settled by id, start and copy, so the result is the same in
    every run.
    """
    largest = max(capacities)
    n = F.coalesce(F.col(length_col).cast("bigint"), F.lit(0)).alias("n")
    # Lengths may be dear to compute, and three plans read them.
    counted = checkpointed(lengths.select(F.col(id_col).cast("bigint").alias("id"), n).groupBy("id", "n").count())
    # An item has a weight of its own, so that a shard is bounded even if all lengths are 0.
    total = counted.agg(F.sum((F.col("n") + ITEM_WEIGHT) * F.col("count"))).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    # A hot row is dealt out in two steps, so that no task makes all its copies.
    numbers = lambda first, last: F.explode(F.sequence(first, last))
    many = F.col("count") > COPIES
    blocks = counted.where(many).select("id", "n", "count", numbers(F.lit(0).cast("bigint"), F.floor((F.col("count") - 1) / COPIES)).alias("block"))
    spread = blocks.repartition("id", "n", "block").select(
        "id", "n", numbers(F.col("block") * COPIES + 1, F.least("count", (F.col("block") + 1) * COPIES)).alias("copy"))
    copies = counted.where(~many).select("id", "n", numbers(F.lit(1).cast("bigint"), F.col("count")).alias("copy")).unionByName(spread)
    whole = F.floor(F.col("n") / largest) * largest
    full = copies.where(F.col("n") >= largest).select(
        "id", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - largest, F.lit(largest).cast("bigint"))).alias("start"), "copy")
    shard = lambda *c: F.pmod(F.xxhash64("id", *c, "copy"), F.lit(shards)).alias("shard")
    single = full.select(shard("start"), F.lit(None).cast("bigint").alias("bin"), F.lit(largest).alias("opened"), F.lit(largest).alias("capacity"),
                         F.lit(largest).cast("bigint").alias("used"), F.array("id").alias("doc_ids"),
                         F.array("start").alias("starts"), F.array(F.lit(largest).cast("bigint")).alias("lengths"))
    rest = copies.where((F.col("n") == 0) | (F.col("n") % largest != 0)).select(
        "id", whole.alias("start"), (F.col("n") - whole).alias("n"), "copy").withColumn("shard", shard("start"))

    def pack_shard(items: pa.Table) -> pa.Table:
        items = items.sort_by([("n", "descending"), ("id", "ascending"), ("start", "ascending"), ("copy", "ascending")])
        sizes = items["n"].to_pylist()
        place, opened, capacity = pack(sizes, capacities, cost)
        members: list[list[int]] = [[] for _ in capacity]
        for row, bin_ in enumerate(place):
            members[bin_].append(row)
        ids, starts = items["id"].to_pylist(), items["start"].to_pylist()
        of = lambda values: pa.array([[values[i] for i in m] for m in members], pa.list_(pa.int64()))
        return pa.table({
            "shard": pa.array([items["shard"][0].as_py()] * len(members), pa.int64()),
            "bin": pa.array(range(len(members)), pa.int64()), "opened": pa.array(opened, pa.int32()), "capacity": pa.array(capacity, pa.int32()),
            "used": pa.array([sum(sizes[i] for i in m) for m in members], pa.int64()),
            "doc_ids": of(ids), "starts": of(starts), "lengths": of(sizes)})

    kind = "shard bigint, bin bigint, opened int, capacity int, used bigint, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>"
    return rest.groupBy("shard").applyInArrow(pack_shard, kind).unionByName(single)
