"""Contiguous shards of near equal size: the smallest capacity that is feasible, found by binary search.

Texts that are equal form one atomic group and never part. Groups are ordered by the MD5 of their text, which
is also what a shard is told by: a document's shard follows from its text and the cuts alone, without a join.

A shard may hold several groups up to the capacity, or one group alone that is larger. Greedy filling uses the
fewest shards for a capacity, so the smallest capacity that needs no more than the wanted shards minimizes the
largest shard, and a group of copies beyond it costs one shard and does not swell the others.

The driver never sees the groups. It gets, for at most ``BINS`` equal ranges of the running size, the first and
last group end in each. Cutting only at known ends shows a capacity to be feasible; letting a cut fall anywhere
between a range's ends shows one to be infeasible. Ranges that could hold a cut of any capacity between the two
answers are split again until both agree, a factor of about BINS / shards ** 2 a round.

Rows: a NULL text is sized and grouped like an empty one (its CRC is NULL). Repeated rows get slots of their
own; equal doc_ids are put in order by text. NULL doc_ids come first. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import blocks_for, written

OVERHEAD_BYTES = 16
# Ranges of the running size summed up for the driver at a time.
BINS = 4096
# Rows numbered by one task.
ROWS_PER_BLOCK = 200_000


@dataclass
class Ends:
    """What the driver knows of the group ends: per range the first and last one, and whether those are all."""

    first: list[int]
    last: list[int]
    whole: list[bool]

    def walk(self, capacity: int, anywhere: bool) -> Iterator[tuple[int, bool]]:
        """Greedy cuts, and whether each is known to be possible.

        ``anywhere`` takes every place inside a range that is not known whole for a group end; otherwise only the
        known ends count. If no end is within reach the next group goes alone.
        """
        base = 0
        while base < self.last[-1]:
            reach, end, sure = base + capacity, base, True
            at = bisect_right(self.first, reach) - 1  # the last range that begins within reach
            if at >= 0:
                inside = reach if anywhere and not self.whole[at] else self.first[at]
                end = self.last[at] if self.last[at] <= reach else inside
            if end <= base:
                at = bisect_right(self.last, base)
                if self.first[at] > base:
                    end = self.first[at]
                elif self.whole[at]:
                    end = self.last[at]
                else:
                    end, sure = base + 1, anywhere
            base = end
            yield base, sure

    def feasible(self, capacity: int, anywhere: bool, shards: int) -> bool:
        walked = list(islice(self.walk(capacity, anywhere), shards))
        return walked[-1][0] == self.last[-1] and all(sure for _, sure in walked)

    def smallest(self, low: int, anywhere: bool, shards: int) -> int:
        high = self.last[-1]
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, anywhere, shards):
                high = middle
            else:
                low = middle + 1
        return high

    def cuts(self, capacity: int, anywhere: bool, shards: int) -> list[int]:
        return [end for end, _ in islice(self.walk(capacity, anywhere), shards)]

    def open_ranges(self, low: list[int], high: list[int]) -> list[tuple[int, int]]:
        """Index ranges of the spans between paired cuts, where any of them is not known whole; disjoint."""
        ranges: list[tuple[int, int]] = []
        for a, b in zip(low, high):
            start, stop = bisect_left(self.last, a), bisect_right(self.first, b)
            if ranges and start <= ranges[-1][1]:
                start, stop = ranges[-1][0], max(stop, ranges.pop()[1])
            ranges.append((start, stop))
        return [(a, b) for a, b in ranges if not all(self.whole[a:b])]


def _spans(prefix: DataFrame, width: int) -> list[tuple[int, int, bool]]:
    """First and last group end of every bin of a width, and whether the bin has no other."""
    bins = prefix.groupBy(F.expr(f"running DIV {width}").alias("bin"))
    found = bins.agg(F.min("running").alias("first"), F.max("running").alias("last"), F.count("*").alias("n"))
    return [(r["first"], r["last"], r["n"] <= 2) for r in found.collect()]


def minimax_cuts(prefix: DataFrame, total: int, shards: int) -> list[int]:
    """Running sizes at which the shards end. ``prefix`` has one row per group with its ``running`` size."""
    width = max(1, -(-total // BINS))
    known = sorted(_spans(prefix, width))
    while True:
        ends = Ends(*map(list, zip(*known)))
        least = ends.smallest(0, True, shards)
        most = ends.smallest(least, False, shards)
        # A true cut lies between that of the least capacity at known ends and that of the most anywhere.
        low, high = ends.cuts(least, False, shards), ends.cuts(most, True, shards)
        ranges = ends.open_ranges(low, high + [total] * (len(low) - len(high)))
        if not ranges:
            return ends.cuts(most, False, shards)
        bounds = [(known[a][0], known[b - 1][1]) for a, b in ranges]
        width = max(1, min(width // 2, -(-sum(b - a + 1 for a, b in bounds) // BINS)))
        wanted = reduce(Column.__or__, [F.col("running").between(a, b) for a, b in bounds])
        for a, b in reversed(ranges):
            del known[a:b]
        known = sorted(known + _spans(prefix.where(wanted), width))


def running_sizes(groups: DataFrame, order: str, size: str, block: Column) -> DataFrame:
    """Groups with the total size up to and including each, summed within blocks and then over block totals.

    ``block`` is a number that never decreases along the order.
    """
    rows = groups.withColumn("block", block)
    totals = rows.groupBy("block").agg(F.sum(size).alias("block_size"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("inside", F.sum(size).over(inside)).join(starts, "block").select(
        order, size, (F.col("start") + F.col("inside")).alias("running")
    )


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row; ``slot`` counts from 0 within its shard."""
    text = F.col(text_col)
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_size"))
    # The order is that of a digest, so its leading digits cut the groups into even blocks.
    prefix = written(running_sizes(groups, "digest", "group_size", F.substring("digest", 1, 3)), "groups")
    cuts = minimax_cuts(prefix, total, shards)[:-1]
    last = sorted(r["digest"] for r in prefix.where(F.col("running").isin(cuts)).select("digest").collect())
    shard = reduce(Column.__add__, [(F.col("digest") > d).cast("int") for d in last], F.lit(0))
    return numbered(rows.withColumn("shard", shard), count).select("doc_id", "size", "text_crc32", "shard", "slot")


def numbered(rows: DataFrame, count: int) -> DataFrame:
    """``slot`` from 0 in every shard. Rows, equal ones too, are dealt to blocks, blocks are counted, and each numbers
    its own."""
    blocks = blocks_for(count, ROWS_PER_BLOCK, 64)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "digest", "row"), F.lit(blocks)))
    sizes = dealt.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "digest", "row")
    ranked = dealt.withColumn("rank", F.row_number().over(inside))
    # The rows lie by shard and block already; one row per shard and block comes to them.
    return ranked.join(starts, ["shard", "block"]).withColumn("slot", F.col("start") + F.col("rank") - 1)
