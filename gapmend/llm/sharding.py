"""Shards of nearly equal bytes that keep equal texts together.

Groups of equal texts stand in the order of a hash of the text. A shard is a
contiguous run of groups, and the largest shard is as small as any such cut
allows: a binary search finds the smallest capacity for which greedy filling
needs no more than the wished shards. Within that capacity the cuts follow the
even share of what is left, so one large group does not leave others empty.

Groups are never sorted or collected. Their sizes are summed by the leading
digits of the hash. A range of hashes that the search looks into, to find where
a shard ends, is summed again by more digits, until every such range is one
group; then the cuts are those of the groups themselves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapmend.shared import write_shared

# The hash has 15 hexadecimal digits: 3 are summed first, then 2 more at a time.
KEY_DIGITS = 15
FIRST_DIGITS = 3
MORE_DIGITS = 2


def group_order(text: Column) -> Column:
    """Order of the groups: 60 bits of MD5; null texts form a group of their own."""
    digits = F.substring(F.md5(F.coalesce(text.cast("binary"), F.lit(b"\x00null"))), 1, KEY_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


class Cutter:
    """Cuts a row of sizes into shards and notes where it has looked."""

    def __init__(self, sizes: list[int], shards: int):
        self.ends = [0, *accumulate(sizes)]
        self.shards = shards
        self.looked: set[int] = set()

    def last_end(self, limit: int) -> int:
        """Index of the last end up to ``limit``; the next size is looked at."""
        at = bisect_right(self.ends, limit) - 1
        if at < len(self.ends) - 1 and self.ends[at] != limit:
            self.looked.add(at)
        return at

    def fits(self, capacity: int) -> bool:
        """Greedy check."""
        at = 0
        for _ in range(self.shards):
            at = self.last_end(self.ends[at] + capacity)
        return at == len(self.ends) - 1

    def capacity(self) -> int:
        """The smallest one that fits; only looks that decide it are kept."""
        low, high = -(-self.ends[-1] // self.shards), self.ends[-1]
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle) else (middle + 1, high)
        self.looked.clear()
        self.fits(low)
        self.fits(low - 1)
        return low

    def cuts(self) -> list[int]:
        """Index of the first group of each shard but the first."""
        capacity, total = self.capacity(), self.ends[-1]
        # Where shard k must begin at the latest, so that the rest still fits,
        # found by filling from the end.
        needed = [total]
        for _ in range(self.shards - 1):
            at = bisect_left(self.ends, needed[-1] - capacity)
            if at > 0 and self.ends[at] != needed[-1] - capacity:
                self.looked.add(at - 1)
            needed.append(self.ends[at])
        found, start = [], 0
        for left in range(self.shards, 1, -1):
            share = start + -(-(total - start) // left)
            even = self.last_end(share)
            if even < len(self.ends) - 1 and self.ends[even + 1] - share < share - self.ends[even]:
                even += 1
            at = min(even, self.last_end(start + capacity))
            start = max(self.ends[at], needed[left - 1])
            found.append(bisect_left(self.ends, start))
        return found


def shard_bounds(sized: DataFrame, shards: int) -> list[int]:
    """First key of each shard but the first, for rows of (key, size)."""
    # Ranges in order: lowest key, digits seen, size; with all digits, a group.
    ranges = _summed(sized, [], 0, FIRST_DIGITS)
    while ranges:
        cutter = Cutter([size for _, _, size in ranges], shards)
        cuts = cutter.cuts()
        split = {i for i in cutter.looked if ranges[i][1] < KEY_DIGITS}
        if not split:
            lows = [low for low, _, _ in ranges]
            return [lows[at] if at < len(lows) else 16**KEY_DIGITS for at in cuts]
        finer = []
        for digits in {ranges[i][1] for i in split}:
            lows = [ranges[i][0] for i in split if ranges[i][1] == digits]
            finer += _summed(sized, lows, digits, digits + MORE_DIGITS)
        ranges = sorted([r for i, r in enumerate(ranges) if i not in split] + finer)
    return []


def _summed(sized: DataFrame, lows: list[int], digits: int, to: int) -> list[tuple[int, int, int]]:
    """Sizes by the first ``to`` digits within the ranges ``lows`` of ``digits``."""
    wide, narrow = 16 ** (KEY_DIGITS - digits), 16 ** (KEY_DIGITS - to)
    key = F.col("key")
    own = sized.filter((key - key % wide).isin(lows)) if digits else sized
    sums = own.groupBy((key - key % narrow).alias("low")).agg(F.sum("size").alias("size"))
    return sorted((r["low"], to, r["size"]) for r in sums.collect())


def minimax_shards(docs: DataFrame, shards: int = 24, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Deal documents to shards 0 to ``shards - 1``.

    Returns doc_id, size, text_crc32, key (order of the text), shard and slot,
    the place in the shard, gapless from 0 in the order of a hash of doc_id.
    Size is the UTF-8 bytes of the text and 8 more. Null texts have size 8 and
    CRC 0 and stay together; empty texts likewise. Repeated rows are rows of
    their own with neighbouring slots. An empty table gives no rows; shards
    stay empty where there are fewer groups. Other columns are not looked at.
    """
    body = F.col(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0).cast("bigint")).alias("text_crc32"),
        group_order(body).alias("key"),
    )
    # The texts are read once; all that follows reads these narrow rows.
    rows = write_shared(rows, "shard-sizes").frame
    shard = F.lit(0)
    for bound in shard_bounds(rows.select("key", "size"), shards):
        shard = shard + (F.col("key") >= F.lit(bound)).cast("int")
    return with_slots(rows.withColumn("shard", shard))


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: rows of a shard counted from 0, without sorting a shard.

    Rows are numbered in 1,024 ranges of a hash of doc_id, and the sizes of the
    ranges before are added. A hot text has many doc_ids, so it is spread too.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = rows.withColumn("place", F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint"))
    rows = rows.withColumn("part", F.shiftright("place", 50))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy("place", "doc_id", "key", "size")
    numbered = rows.withColumn("row", F.row_number().over(inside) - 1)
    # At most 1,024 rows for each shard.
    placed = numbered.join(F.broadcast(starts), ["shard", "part"])
    return placed.select(
        "doc_id", "size", "text_crc32", "key", "shard", (F.col("row") + F.col("before")).alias("slot")
    )
