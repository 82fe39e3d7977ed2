"""Sharding by the smallest feasible capacity (minimax contiguous partition).

Rows with equal texts form one atomic group; groups are ordered by a 64-bit
hash of the text. The smallest capacity C for which the ordered groups fit
into the given number of contiguous shards is found by binary search with the
greedy check, and the sequence is cut under that capacity.

The group sizes are never brought together in one place. The driver holds
sums over blocks of the hash range, at most ``2**first_bits`` to begin with.
The greedy check on block sums bounds each cut from below (cut at block
boundaries only) and from above (cut anywhere); the few blocks between the
bounds are split by the next ``step_bits`` hash bits, until every block that
decides a cut holds a single group. The result is exactly that of the check on
all groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm.tables import fresh, stored


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


class _Blocks:
    """Consecutive blocks of the hash range: first key, bits, bytes, groups."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows.sort()
        self.key, self.bits, self.bytes, self.groups = (np.array([r[i] for r in rows], object if i == 0 else np.int64)
                                                        for i in range(4))
        self.edge = np.concatenate([[0], np.cumsum(self.bytes)]).astype(np.int64)
        self.total = int(self.edge[-1])

    def holds(self, at: int) -> int:
        """The block that starts at or before the byte position ``at``."""
        return int(np.searchsorted(self.edge, at, "right")) - 1

    def down(self, at: int) -> int:
        return int(self.edge[min(self.holds(at), len(self.bytes))])

    def up(self, at: int) -> int:
        return int(self.edge[int(np.searchsorted(self.edge, at, "left"))])

    def mixed(self, at: int) -> int | None:
        """The block with several groups that has ``at`` strictly inside."""
        i = self.holds(at)
        return i if i < len(self.bytes) and self.edge[i] < at and self.groups[i] > 1 else None

    def floor(self, at: int, hopeful: bool) -> int:
        """The last group boundary up to ``at``: of those known, or the best
        that could exist."""
        if at >= self.total:
            return self.total
        return at if hopeful and self.mixed(at) is not None else self.down(at)

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = self.floor(at + capacity, hopeful)
            out.append(at)
        return out

    def least(self, shards: int, hopeful: bool) -> int:
        """The smallest capacity that passes the greedy check."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, hopeful)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def between(self, low: int, high: int) -> set[int]:
        """Blocks of several groups that meet the byte range."""
        return {i for i in range(self.holds(low), min(self.holds(high), len(self.bytes) - 1) + 1) if self.groups[i] > 1}

    def split(self, todo: set[int], parts: dict[int, list[tuple[int, int, int, int]]]) -> _Blocks:
        rows = [(self.key[i], int(self.bits[i]), int(self.bytes[i]), int(self.groups[i]))
                for i in range(len(self.bytes)) if i not in todo]
        for i in todo:
            rows += parts[i]
        return _Blocks(rows)


def _block_rows(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
    rows = groups.groupBy(F.shiftright("key", 64 - bits).alias("b")).agg(F.sum("bytes").alias("s"), F.count("*").alias("n")).collect()
    return [(r["b"] << (64 - bits), bits, r["s"], r["n"]) for r in rows]


def _refined(blocks: _Blocks, todo: set[int], groups: DataFrame, step_bits: int) -> _Blocks:
    parts: dict[int, list] = {}
    for bits in {int(blocks.bits[i]) for i in todo}:
        mine = {int(blocks.key[i]) >> (64 - bits): i for i in todo if blocks.bits[i] == bits}
        more = min(bits + step_bits, 64)
        ids = groups.sparkSession.createDataFrame([(k,) for k in mine], T.StructType([T.StructField("w", T.LongType())]))
        # ids: at most the blocks between the bounds, a fixed number for given shards and bits.
        inside = groups.join(F.broadcast(ids), F.shiftright("key", 64 - bits) == F.col("w"), "left_semi")
        for row in _block_rows(inside, more):
            parts.setdefault(mine[row[0] >> (64 - bits)], []).append(row)
    return blocks.split(todo, parts)


def capacity_cuts(groups: DataFrame, shards: int, first_bits: int = 14, step_bits: int = 8) -> tuple[int, list[int]]:
    """(smallest capacity, first key of each shard after the first).

    ``groups`` has one row per group: ``key`` long (unique, the order) and
    ``bytes`` long. Under the smallest capacity many cuts can be feasible; each
    is put as near to an equal share of what is left as the capacity allows.
    """
    blocks = _Blocks(_block_rows(groups, first_bits))
    if not blocks.total:
        return 0, []
    while True:
        low, high = blocks.least(shards, True), blocks.least(shards, False)
        first, last = blocks.cuts(low, shards, False), blocks.cuts(high, shards, True)
        todo = set().union(*(blocks.between(a, b) for a, b in zip(first, last, strict=True) if a < b))
        if not todo:
            break
        blocks = _refined(blocks, todo, groups, step_bits)
    capacity = low
    while True:
        todo = set()
        # From the end: the first position from which the shards that are left still suffice.
        need = [blocks.total]
        for _ in range(shards - 1):
            at = max(0, need[-1] - capacity)
            if (i := blocks.mixed(at)) is not None:
                todo.add(i)
            need.append(blocks.up(at))
        need = need[::-1][1:]
        at, cuts = 0, []
        for j in range(shards - 1):
            ideal = at + (blocks.total - at) / (shards - j)
            if (i := blocks.mixed(int(ideal))) is not None:
                todo.add(i)
            most = at + capacity
            if (i := blocks.mixed(most)) is not None and most < blocks.total:
                todo.add(i)
            near = min((blocks.down(int(ideal)), blocks.up(min(blocks.total, int(ideal) + 1))), key=lambda x: (abs(x - ideal), x))
            at = max(at, min(max(near, need[j]), blocks.floor(most, False)))
            cuts.append(at)
        if not todo:
            keys = []
            for c in cuts:
                i = int(np.searchsorted(blocks.edge, c))
                keys.append(int(blocks.key[i]) if i < len(blocks.bytes) else None)
            return capacity, keys
        blocks = _refined(blocks, todo, groups, step_bits)


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8,
          keep: list[str] | None = None) -> DataFrame:
    """Every row with ``size`` (UTF-8 bytes plus ``overhead``), ``text_crc32``,
    ``shard``, ``slot`` (gapless from 0 in each shard) and ``capacity``.

    ``keep`` names the columns to carry (all by default; the text itself is
    needed only to be measured). A null text counts as the empty text. Equal
    texts share a shard; two texts with one 64-bit hash would do so as well.
    Repeated rows and ids keep a slot each. An empty table gives an empty
    result. Input columns named like an output are replaced.
    """
    keep = docs.columns if keep is None else keep
    outs = ("size", "text_crc32", "shard", "slot", "capacity")
    keep = [c for c in keep if c.lower() not in outs]
    n = fresh(docs.select(*keep), "key", "pid", "idx", "first", "before", "order")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, (text_bytes(text) + F.lit(overhead)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias(n["key"]))
    groups = stored(rows.groupBy(F.col(n["key"]).alias("key")).agg(F.sum("size").alias("bytes")), "shard-groups")
    capacity, cuts = capacity_cuts(groups, shards)
    place = F.lit(0)
    for c in cuts:
        if c is not None:
            place = place + (F.col(n["key"]) >= F.lit(c)).cast("int")
    # Range partitions in (hash, id) order split a hot group; the position in
    # the stored partition and the rows of earlier partitions give the slot.
    ordered = (rows.withColumn("shard", place.cast("int"))
               .repartitionByRange(F.col(n["key"]), F.col(id_col)).sortWithinPartitions(n["key"], id_col)
               .withColumn(n["order"], F.monotonically_increasing_id())
               .withColumn(n["pid"], F.shiftright(n["order"], 33)).withColumn(n["idx"], F.col(n["order"]).bitwiseAND(F.lit((1 << 33) - 1)))
               .drop(n["order"], n["key"]))
    ordered = stored(ordered, "shard-order")
    counts = ordered.groupBy("shard", n["pid"]).agg(F.min(n["idx"]).alias(n["first"]), F.count("*").alias("n"))
    w = Window.partitionBy("shard").orderBy(n["pid"]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", n["pid"], n["first"], F.coalesce(F.sum("n").over(w), F.lit(0)).alias(n["before"]))
    # counts: at most one row per partition and one more per cut.
    return (ordered.join(F.broadcast(counts), ["shard", n["pid"]])
            .select(*keep, "size", "text_crc32", "shard", (F.col(n["idx"]) - F.col(n["first"]) + F.col(n["before"])).alias("slot"),
                    F.lit(capacity).cast("long").alias("capacity")))
