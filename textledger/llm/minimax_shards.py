"""Sharding by a minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, whole_text

SHARDS = 8
#: Groups stand in the order of their key, 32 hexadecimal digits. Ends of groups are known to the driver by prefixes of
#: keys: all prefixes of the first length at first, then longer ones of those that matter.
DIGITS = 3
FINER = 2
#: Rows of a shard are numbered in parts of about so many at once.
ROWS_PER_PART = 100_000


class Ends:
    """Where groups may end, in bytes from the start: some ends exactly, and between them stretches not looked into yet.

    Holds a number per prefix, 16**DIGITS at first and 16**FINER more for each prefix that a search touches.
    """

    def __init__(self, finer):
        self.finer, self.nodes = finer, finer([""], DIGITS)  # (end, begin, groups, prefix), by end

    @property
    def total(self) -> int:
        return self.nodes[-1][0] if self.nodes else 0

    def around(self, position: int) -> tuple[int, int, str | None]:
        """Greatest known end up to ``position``, the least known one after it, and the prefix between if it is not known in full."""
        at = bisect_right(self.nodes, position, key=lambda node: node[0])
        below = self.nodes[at - 1][0] if at else 0
        if at == len(self.nodes):
            return below, below, None
        end, _, groups, prefix = self.nodes[at]
        return below, end, prefix if groups > 1 else None

    def open(self, prefixes: set[str]) -> None:
        """Look into prefixes: their children take their places."""
        children = self.finer(sorted(prefixes), FINER)
        self.nodes = sorted([n for n in self.nodes if n[3] not in prefixes] + children)

    def floor(self, position: int) -> int:
        """Greatest end up to ``position``, exactly."""
        while (found := self.around(position))[2] is not None:
            self.open({found[2]})
        return found[0]

    def ceiling(self, position: int) -> int:
        """Least end at or after ``position``, exactly."""
        return position if self.floor(position) == position else self.around(position)[1]


def _reach(ends: Ends, shards: int, capacity: int, hopeful: bool, touched: set[str] | None = None) -> bool:
    """Greedy check: do so many shards of a capacity reach the end? Unknown stretches count as solid, or, hopefully, as divisible."""
    position = 0
    for _ in range(shards):
        aim = position + capacity
        below, above, prefix = ends.around(aim)
        if prefix is not None and touched is not None:
            touched.add(prefix)
        position = min(aim, above) if hopeful and prefix is not None else below
        if position >= ends.total:
            return True
    return False


def smallest_capacity(ends: Ends, shards: int) -> int:
    """Smallest capacity at which the greedy check succeeds, by binary search; stretches are looked into only where it is in doubt."""
    def search(hopeful: bool) -> int:
        low, high = 0, ends.total
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if _reach(ends, shards, middle, hopeful) else (middle + 1, high)
        return low

    while (surely := search(False)) > (perhaps := search(True)):
        touched: set[str] = set()
        for capacity in (perhaps, (perhaps + surely) // 2, surely):
            _reach(ends, shards, capacity, True, touched)
            _reach(ends, shards, capacity, False, touched)
        if not touched:
            break
        ends.open(touched)
    return surely


def balanced_cuts(ends: Ends, shards: int) -> list[int]:
    """Ends of the shards. None exceeds the smallest feasible capacity; within it, shards stay near an even share of what is left."""
    capacity, total = smallest_capacity(ends, shards), ends.total
    latest = [total]  # from the right: before this, the shards that follow would not do
    for _ in range(shards - 1):
        latest.append(ends.ceiling(max(0, latest[-1] - capacity)))
    cuts, position = [], 0
    for k in range(1, shards):
        least, aim = latest[shards - k], position + (total - position) // (shards - k + 1)
        below, above = ends.floor(aim), ends.ceiling(aim)
        cut = above if above - position <= capacity and above - aim < aim - below else below
        position = min(max(cut, least, position), ends.floor(position + capacity))
        cuts.append(position)
    return [*cuts, total]


def group_key(text: Column) -> Column:
    """Equal texts have equal keys. Should different texts ever share one, they only stay together."""
    return F.md5(text)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    Law ``bytes``: equal texts are one group, groups stand in the order of their key, and the shards are the contiguous cut with the
    smallest possible largest shard. ``slot`` numbers a shard's rows from 0 without gaps, in an order that doc_id and text fix;
    equal rows are interchangeable. A null text is the same group as an empty one and takes 1 byte. A shard may stay empty where
    one group takes more than its share. No rows give no rows.

    The driver searches over sums per key prefix. Rows need no join to find their shard: they compare their key with
    the shards' last keys.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = whole_text()
    rows = scratch.keep(id_and_text(docs).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), group_key(text).alias("key")))
    bins = Window.partitionBy(F.substring("key", 1, DIGITS))
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    sums = scratch.keep(groups.withColumn("upto", F.sum("bytes").over(bins.orderBy("key"))))
    starts = {r[0]: r[1] for r in sums.groupBy(F.substring("key", 1, DIGITS)).agg(F.max("upto")).collect()}
    offset, before = {}, 0
    for prefix in sorted(starts):
        offset[prefix], before = before, before + starts[prefix]

    def finer(prefixes: list[str], digits: int) -> list[tuple[int, int, int, str]]:
        at = len(prefixes[0]) if len({*map(len, prefixes)}) == 1 else None
        if at is None:  # prefixes of several lengths: one length at a time
            return [n for size in sorted({*map(len, prefixes)}) for n in finer([p for p in prefixes if len(p) == size], digits)]
        # Ranges of keys, which reach the scan; the sums lie in the order of keys.
        within = (F.col("key").between(p, p + "g") for p in prefixes)
        chosen = sums if prefixes == [""] else sums.where(reduce(or_, within))
        found = chosen.groupBy(F.substring("key", 1, at + digits).alias("p")).agg(F.max("upto").alias("end"), F.min(F.col("upto") - F.col("bytes")).alias("begin"), F.count("*").alias("n")).collect()
        return sorted((offset[r.p[:DIGITS]] + r.end, offset[r.p[:DIGITS]] + r.begin, r.n, r.p) for r in found)

    ends = Ends(finer)
    last_keys = []
    for cut in balanced_cuts(ends, shards)[:-1] if ends.nodes else []:
        prefix = next((n[3] for n in ends.nodes if n[0] == cut), None)  # the prefix whose greatest key ends here
        last_keys.append(sums.where(F.col("key").startswith(prefix)).agg(F.max("key")).first()[0] if prefix else "")
    number = sum(((F.col("key") > key).cast("int") for key in last_keys), F.lit(0)).cast("int")

    parts = max(8, rows.count() // (shards * ROWS_PER_PART))
    placed = rows.select("doc_id", "size", "text_crc32", "key", number.alias("shard"), F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)).cast("int").alias("part"))
    counts = placed.groupBy("shard", "part").count()
    before_part = F.sum("count").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts_at = counts.select(F.col("shard").alias("s"), F.col("part").alias("p"), F.coalesce(before_part, F.lit(0)).alias("first_slot"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "key")) - 1
    return (placed.withColumn("nth", nth).join(starts_at, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p")))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first_slot") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
