"""Join helpers: attaching measures to a query set.

Every scoring operator ends by right-joining its measures onto the query
set (``queryset LEFT JOIN measures``). These helpers cover the two shapes:

* keyed measures (at most one row per key, e.g. after ``groupBy(key)``):
  a plain left join. The aggregate already hash-partitions the measures by
  key, so the join reuses that partitioning and only the query set moves.
* fan-out measures (several rows per key, e.g. duplicate records):
  - :func:`attach_counted` for categorical measures (few distinct values
    per key): query rows and measures are both counted with map-side
    combine, the counts are joined, split into bounded chunks, dealt out
    and only then copied. No shuffle ever sees a hot key's raw rows, of
    either side, and no task makes all copies of a hot key.
  - ``attach(..., fanout=True)`` for open-ended values: the left join is
    split into an inner join plus an anti join against the *distinct* keys.
    Spark's adaptive skew handling can split a hot key on either side of an
    inner join but never on the null-supplying side of an outer join, so
    this form stays balanced when one key holds a large share of the rows.
  - :func:`attach_salted` for the same without adaptive handling: heavy keys
    are found by counting and dealt out over salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "__key"


def attach(queryset: DataFrame, measures: DataFrame, on: str, qkey: str = "targetid",
           fanout: bool = False) -> DataFrame:
    """``queryset LEFT JOIN measures ON queryset[qkey] = measures[on]``.

    Keeps every query-set row; rows without a match get nulls. The measures'
    key column is dropped. With ``fanout=True`` the skew-safe inner + anti
    form is used (same rows, see module docstring).
    """
    m = measures.withColumnRenamed(on, KEY)
    cond = F.col(qkey) == F.col(KEY)
    if not fanout:
        return queryset.join(m, cond, "left").drop(KEY)
    matched = queryset.join(m, cond, "inner").drop(KEY)
    keys = m.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    unmatched = queryset.join(keys, cond, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


CHUNK = 1 << 12


def dealt(rows: DataFrame, copies: str, by: list[str], chunk: int = CHUNK) -> DataFrame:
    """Every row as often as its column ``copies`` says, which is dropped.

    A row is first cut into chunks of at most ``chunk`` copies, the chunks are
    dealt out by the columns ``by`` and their number, and only then copied: a
    row of very many copies is made by as many tasks as it has chunks."""
    size = F.lit(chunk).cast("long")
    last = F.floor((F.col(copies) - 1) / size).cast("long")
    parts = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn(
        "_left", F.least(size, F.col(copies) - F.col("_chunk") * size))
    parts = parts.repartition(*by, "_chunk")
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left")))).drop(copies, "_chunk", "_left", "_copy")


def attach_counted(queryset: DataFrame, *measures: tuple[DataFrame, str], qkey: str = "targetid", chunk: int = CHUNK) -> DataFrame:
    """``queryset LEFT JOIN measures`` for each ``(measures, key column)`` whose
    values are few per key (category scores, flags): the rows of the plain joins.

    Both sides are counted first, map-side combined: equal rows of the query set
    become one with a count, and so do equal values of a key. The joins then
    meet a row per distinct query row and value tuple, whose count is the
    product; :func:`dealt` makes the copies. So neither an id that a third of
    the query rows ask for nor one that a third of the measures bear comes to
    one task. The columns of the query set have to be groupable (no maps)."""
    asked, vals = queryset.columns, []
    out = queryset.groupBy(*asked).agg(F.count(F.lit(1)).alias("_copies"))
    for i, (frame, on) in enumerate(measures):
        key, own = f"{KEY}_{i}", [c for c in frame.columns if c != on]
        n = frame.groupBy(F.col(on).alias(key), *own).agg(F.count(F.lit(1)).alias("_n"))
        out = out.join(n, F.col(qkey) == F.col(key), "left").withColumn("_copies", F.col("_copies") * F.coalesce("_n", F.lit(1))).drop(key, "_n")
        vals += own
    return dealt(out, "_copies", [*asked, *vals], chunk).select(*asked, *vals)


HEAVY_PARTS = 1_000


def attach_salted(queryset: DataFrame, measures: DataFrame, on: str, qkey: str = "targetid", parts: int = HEAVY_PARTS) -> DataFrame:
    """``attach(queryset, measures, on, qkey)`` for open-ended values of which
    one key may hold a large share: the rows of the plain left join.

    A key is heavy if it has more than one in ``parts`` of all rows of the
    measures, so there are fewer than ``parts`` heavy keys, which is why they may
    be broadcast. The rows of a heavy key are dealt out by a hash of their values
    over as many salts as it has such shares; query rows of that key are copied
    once for each salt. Query rows without a match are found by an anti join
    against the distinct keys. Equal rows of the measures are counted first, cut
    into chunks of copies that are dealt out with the others, and copied where
    they were joined: the joined rows are not shuffled. The plan reads
    ``measures`` four times: pass a stored table."""
    m = measures.withColumnRenamed(on, KEY).where(F.col(KEY).isNotNull())
    vals = [c for c in m.columns if c != KEY]
    total = m.agg(F.count(F.lit(1)).alias("n")).scalar()
    heavy = m.groupBy(F.col(KEY).alias("_heavy")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = heavy.select("_heavy", "_n", total.alias("_all")).where(F.col("_n") * parts > F.col("_all"))
    heavy = F.broadcast(heavy.select("_heavy", F.ceil(F.col("_n") * parts / F.col("_all")).cast("int").alias("_salts")))
    one = F.lit(1)
    asked = queryset.join(heavy, F.col(qkey) == F.col("_heavy"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", one) - 1))).drop("_heavy", "_salts")
    size = F.lit(CHUNK).cast("long")
    rows = m.groupBy(KEY, *vals).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / size).cast("long"))))
    rows = rows.withColumn("_copies", F.least(size, F.col("_copies") - F.col("_chunk") * size)).join(heavy, F.col(KEY) == F.col("_heavy"), "left")
    rows = rows.withColumn("_of", F.pmod(F.xxhash64(*vals, "_chunk"), F.coalesce("_salts", one)).cast("int")).drop("_heavy", "_salts", "_chunk")
    matched = asked.join(rows, (F.col(qkey) == F.col(KEY)) & (F.col("_salt") == F.col("_of"))).drop(KEY, "_of", "_salt")
    matched = matched.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copies", "_copy")
    alone = queryset.join(m.select(KEY).distinct(), F.col(qkey) == F.col(KEY), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
