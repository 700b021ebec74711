"""Best-fit-decreasing bin packing of indivisible groups into shards.

A group is all rows with one text; its weight is the sum of their sizes. The
packing itself only needs how many groups have which weight: groups of one
weight class are interchangeable. So Spark counts the classes (their number is
bounded by the precision of a class, not by the data), the driver packs the
class counts, and Spark deals the groups of a class out by their rank in it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored, utf8

#: Significant bits of a weight class: a weight is taken as up to 1/1024 larger.
CLASS_BITS = 11
#: Ranks within a class and within a shard are counted in so many parts, to spread hot ones.
SPREAD = 256


class FreeSpace:
    """Bins ordered by free space: an AVL tree of (free, bin)."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _balanced(self, key, left, right):
        tilt = self._height(left) - self._height(right)
        if tilt > 1:
            lk, ll, lr, _ = left
            if self._height(ll) >= self._height(lr):
                return self._node(lk, ll, self._node(key, lr, right))
            return self._node(lr[0], self._node(lk, ll, lr[1]), self._node(key, lr[2], right))
        if tilt < -1:
            rk, rl, rr, _ = right
            if self._height(rr) >= self._height(rl):
                return self._node(rk, self._node(key, left, rl), rr)
            return self._node(rl[0], self._node(key, left, rl[1]), self._node(rk, rl[2], rr))
        return self._node(key, left, right)

    def _node(self, key, left, right):
        return key, left, right, 1 + max(self._height(left), self._height(right))

    def add(self, free: int, bin_: int) -> None:
        def put(node):
            if node is None:
                return self._node((free, bin_), None, None)
            key, left, right, _ = node
            if (free, bin_) < key:
                return self._balanced(key, put(left), right)
            return self._balanced(key, left, put(right))

        self.root = put(self.root)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least free space that is at least ``need``."""
        node, found = self.root, None
        while node:
            key, left, right, _ = node
            if key[0] >= need:
                found, node = key, left
            else:
                node = right
        if found is not None:
            self.root = self._without(self.root, found)
        return found

    def _without(self, node, gone):
        key, left, right, _ = node
        if gone < key:
            return self._balanced(key, self._without(left, gone), right)
        if gone > key:
            return self._balanced(key, left, self._without(right, gone))
        if left is None or right is None:
            return left or right
        least = right
        while least[1]:
            least = least[1]
        return self._balanced(least[0], left, self._without(right, least[0]))


@dataclass
class Plan:
    """Which ranks of a class go to which bin: ``runs[weight] = [(bin, count), ...]``."""

    bins: int = 0
    runs: dict[int, list[tuple[int, int]]] = field(default_factory=dict)


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> Plan | None:
    """Pack ``(weight, count)`` classes, heaviest first, each item into the tightest bin.

    Items of one weight are placed together: the tightest bin stays the
    tightest until it is too full for the next of them. ``bins`` limits the
    number of bins; None is returned if it is not enough or an item is too large.
    """
    tree, plan = FreeSpace(), Plan()
    for weight, count in sorted(classes, reverse=True):
        if weight > capacity:
            return None
        runs = plan.runs.setdefault(weight, [])
        while count:
            found = tree.take_tightest(weight)
            if found is None:
                if plan.bins == bins:
                    return None
                found = (capacity, plan.bins)
                plan.bins += 1
            free, bin_ = found
            fit = min(count, free // weight) if weight else count
            runs.append((bin_, fit))
            count -= fit
            tree.add(free - fit * weight, bin_)
    return plan


def even_plan(classes: list[tuple[int, int]], bins: int) -> Plan:
    """The smallest capacity found by bisection for which ``bins`` bins are enough.

    A group heavier than the mean of what is left has a bin to itself, and the
    capacity is searched for the others: one hot group does not leave bins empty.
    """
    left = {w: n for w, n in classes if n}
    alone: list[int] = []
    while left and len(alone) < bins - 1:
        weight = max(left)
        if weight * (bins - len(alone)) <= sum(w * n for w, n in left.items()):
            break
        alone.append(weight)
        left[weight] -= 1
        if not left[weight]:
            del left[weight]
    rest, some = bins - len(alone), sorted(left.items())
    total = sum(w * n for w, n in some)
    low = max(math.ceil(total / rest), max(left, default=0))
    best = best_fit_decreasing(some, low, rest)
    if best is None:
        high = low
        while best is None:
            high += max(1, high // 64)
            best = best_fit_decreasing(some, high, rest)
        while low + 1 < high:
            middle = (low + high) // 2
            tried = best_fit_decreasing(some, middle, rest)
            if tried is None:
                low = middle
            else:
                best, high = tried, middle
    for i, weight in enumerate(alone):
        best.runs.setdefault(weight, []).insert(0, (rest + i, 1))
    best.bins = bins
    return best


def weight_class(weight: str, bits: int = CLASS_BITS) -> Column:
    """Round a column of positive longs up to ``bits`` significant bits."""
    step = f"shiftleft(1L, greatest(0, length(bin({weight})) - {bits}))"
    return F.expr(f"(({weight} - 1) div {step} + 1) * {step}")


def shard_rows(docs: DataFrame, shards: int | None = 16, capacity: int | None = None) -> DataFrame:
    """Shard and slot of every row; rows with equal text share a shard.

    Takes ``doc_id`` and ``text``, other columns are ignored. With ``capacity``
    the least number of shards of that size is aimed at (ValueError if a group
    is larger); otherwise ``shards`` shards of nearly equal size are filled.
    Returns ``doc_id, size, text_crc32, shard, slot``; a size is the bytes of
    the text plus one. A null text has no bytes and is one group with the empty
    texts. Null or repeated ids are rows like all others. Slots of a shard run
    from 0 without gaps. An empty table gives no rows.
    """
    text = utf8("text")
    rows = stored(
        docs.select(
            "doc_id",
            (F.length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("__key"),
        ),
        "shard-rows",
    )
    groups = (
        rows.groupBy("__key")
        .agg(F.sum("size").alias("__weight"))
        .withColumn("__class", weight_class("__weight"))
        .withColumn("__part", F.pmod(F.xxhash64("__key"), F.lit(SPREAD)).cast("int"))
        .select("__key", "__class", "__part")
    )
    counts = stored(groups.groupBy("__class", "__part").agg(F.count("*").alias("__n")), "shard-counts")
    # A row per class: their number is bounded by CLASS_BITS.
    classes = [(r[0], r[1]) for r in counts.groupBy("__class").agg(F.sum("__n")).collect()]
    if capacity is None:
        plan = even_plan(classes, shards)
    else:
        plan = best_fit_decreasing(classes, capacity)
        if plan is None:
            raise ValueError(f"a group is larger than the capacity of {capacity}")
    table = []
    for weight, runs in plan.runs.items():
        ends, at = [], 0
        for _, n in runs:
            at += n
            ends.append(at)
        table.append((weight, ends, [b for b, _ in runs]))
    spark = docs.sparkSession
    runs = spark.createDataFrame(table, "__class long, __ends array<long>, __bins array<int>")

    before = Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).join(runs, "__class")
    own = Window.partitionBy("__class", "__part").orderBy("__key")
    placed = (
        groups.withColumn("__rank", F.row_number().over(own) - 1)
        .join(offsets.drop("__n"), ["__class", "__part"])
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .select("__key", F.expr("element_at(__bins, size(filter(__ends, e -> e <= __rank)) + 1)").alias("shard"))
    )
    sharded = stored(
        rows.join(placed, "__key")
        .drop("__key")
        .withColumn("__part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SPREAD)).cast("int")),
        "sharded-rows",
    )
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sharded.groupBy("shard", "__part")
        .agg(F.count("*").alias("__n"))
        .select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    own = Window.partitionBy("shard", "__part").orderBy("doc_id", "text_crc32")
    return (
        sharded.withColumn("__row", F.row_number().over(own) - 1)
        .join(starts, ["shard", "__part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("__row") + F.col("__start")).cast("long").alias("slot"))
    )
