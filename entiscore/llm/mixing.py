"""Mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule over training progress 0..1: a base weight
times a piecewise-linear multiplier. The integral of the schedule is the
source's weight in the mix; weights share the words of the whole corpus, with
a cap on how often a source may be repeated. A source's documents form one
stream in hash order; the inverse of the cumulative schedule turns a document's
place in its stream into a training position, and range-sorting by position
gives the training order.

Everything is DataFrame work on built-in functions. Running sums are taken in
two levels, (source, bucket) and rows of one bucket, so that a source with a
third of all rows is spread over as many buckets as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.tables import fresh, stored

WORD = r"[^\x20\x09-\x0D]+"

# Multiplier knots (progress, multiplier) by place of the source in code-point
# order: early, even, late. Each integrates to 1, so base weights are the shares.
CURRICULUM = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
WEIGHTS = (1.0, 2.0, 3.0)


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def schedule_area(knots) -> float:
    """Integral of a piecewise-linear schedule over 0..1."""
    return sum((t1 - t0) * (m0 + m1) / 2 for (t0, m0), (t1, m1) in zip(knots, knots[1:], strict=False))


def progress_at(share: Column, knots) -> Column:
    """Inverse of the cumulative schedule: the training progress at which the
    given share (0..1) of the schedule's area is reached."""
    area, done, out = schedule_area(knots), 0.0, F.lit(1.0)
    pieces = []
    for (t0, m0), (t1, m1) in zip(knots, knots[1:], strict=False):
        piece = (t1 - t0) * (m0 + m1) / 2
        # Solve m0 x + (m1 - m0) x^2 / (2 d) = rest, in the form that is stable for m0 = m1.
        rest, slope = share * area - done, (m1 - m0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(m0 * m0) + 2 * slope * rest, F.lit(0.0)))
        pieces.append((done + piece, F.lit(t0) + F.coalesce(F.try_divide(2 * rest, m0 + root), F.lit(0.0))))
        done += piece
    for upto, value in reversed(pieces):
        out = F.when(share * area < upto, value).otherwise(out)
    return out


def targets(totals: DataFrame, weights=WEIGHTS, curriculum=CURRICULUM, most: int = 3) -> DataFrame:
    """``source, source_size, rows`` (one row per source) plus ``place`` (from 0
    in code-point order, null last) and ``target``.

    Shares follow the integrated weights; no target passes ``most`` times its
    source, and what is cut off goes to the others by weight: target = least(cap,
    weight * level). With sources in the order in which they fill up (cap /
    weight), taking the first i as full gives a level that is too low unless i
    is right, so the common level is the largest of these.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n, m = len(weights), len(curriculum)
    placed = totals.withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.lit(None).cast("double")
    for i in range(n * m):
        weight = F.when(F.col("place") % (n * m) == i, F.lit(float(weights[i % n] * schedule_area(curriculum[i % m])))).otherwise(weight)
    cap = F.col("source_size") * F.lit(float(most))
    placed = placed.withColumn("w", weight).withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("w"))
    up = Window.orderBy("full_at", "place")
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    leveled = placed.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy()))
    return leveled.select("source", "source_size", "rows", "place", F.least("cap", F.col("w") * F.col("level")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, curriculum=CURRICULUM, most: int = 3, id_col: str = "doc_id", source_col: str = "source",
        size: Column | None = None, seed: int = 17, bucket_rows: int = 20_000, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """One row per input row with ``size``, ``source_size``, ``target``,
    ``taken``, ``passes`` (whole uses), ``cut`` (words of one more, partial use)
    and ``positions`` (one training position per use, at most ``most``).

    A source is passed through whole as often as its target allows; the rest of
    the target takes the first words of the stream once more, and the document
    in which the target falls is used in part. A source's ``taken`` therefore
    sums to its rounded target. Null sources form a source of their own; rows
    of size 0 take nothing and get no position; repeated rows count each; an
    empty table gives an empty result. Input columns named like an output are
    replaced; ``keep`` names the columns to carry (all by default). The stream
    order, and with it the bucket, follows a hash of id and text, so rows that
    share an id (or have none) are spread; only rows equal in both share a bucket.
    """
    outs = ("size", "source_size", "target", "taken", "passes", "cut", "positions")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outs]
    h = fresh(docs.select(*keep), "src", "key", "bucket", "start", "whole", "rest", "place", "sum", "rows_in")
    size = word_count(F.col(text_col)) if size is None else size
    rows = docs.select(*keep, size.alias("size"), F.col(source_col).alias(h["src"]),
                       F.xxhash64(F.lit(seed), F.col(id_col), *([F.col(text_col)] if text_col in docs.columns else [])).alias(h["key"]))
    # Sums over fine hash buckets first; their number follows the rows.
    n_rows = docs.count()
    bits = max(6, (n_rows // bucket_rows).bit_length())
    rows = rows.withColumn(h["bucket"], F.shiftright(F.col(h["key"]), 64 - bits))
    sums = stored(rows.groupBy(F.col(h["src"]).alias("source"), F.col(h["bucket"]).alias("bucket"))
                  .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "mix-sums")
    totals = sums.groupBy("source").agg(F.sum("bytes").alias("source_size"), F.sum("rows").alias("rows"))
    plan = targets(totals, weights, curriculum, most)
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (sums.withColumn("before", F.coalesce(F.sum("bytes").over(by_bucket), F.lit(0)))
               .join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "rows"))
    buckets = buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "before",
                             F.col("source_size").alias("b_size"), F.col("target").alias("b_target"), F.col("place").alias("b_place"))
    inside = Window.partitionBy(h["src"], h["bucket"]).orderBy(h["key"], id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn(h["sum"], F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(buckets, F.col(h["src"]).eqNullSafe(F.col("b_source")) & (F.col(h["bucket"]) == F.col("b_bucket"))))
    goal = F.round("b_target").cast("long")
    start = F.col(h["sum"]) + F.col("before")
    # A source can be empty of words: then there is nothing to pass through.
    whole = F.when(F.col("b_size") > 0, F.floor(goal / F.col("b_size"))).otherwise(0).cast("long")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), goal - whole * F.col("b_size") - start)).cast("long")
    rows = (rows.withColumn(h["start"], start).withColumn("passes", F.when(F.col("size") > 0, whole).otherwise(0))
            .withColumn("cut", cut).withColumn("taken", F.col("size") * F.col("passes") + F.col("cut")))
    uses = F.col("passes") + (F.col("cut") > 0).cast("long")
    share = lambda j: F.try_divide(j * F.col("b_size") + F.col(h["start"]), goal)
    place = F.col("b_place") % len(curriculum)
    spots = []
    for j in range(most):
        spot = F.lit(None).cast("double")
        for i, knots in enumerate(curriculum):
            spot = F.when(place == i, progress_at(share(j), knots)).otherwise(spot)
        spots.append(F.when(uses > j, spot))
    return rows.select(*keep, "size", F.col("b_size").alias("source_size"), F.col("b_target").alias("target"), "taken", "passes", "cut",
                       F.filter(F.array(*spots), lambda x: x.isNotNull()).alias("positions"))


def training_order(plan: DataFrame, text_col: str = "text", id_col: str = "doc_id", chars_col: str | None = "n_chars",
                   whole: bool = False) -> DataFrame:
    """The plan's uses as rows in training order: a row per use with
    ``position`` (range-sorted). A partial use holds the first ``cut`` words of
    the text, joined by single spaces; with ``whole`` it is a use of the whole
    text as it stands, so that a source's words pass its target by less than
    one document."""
    mine = ("size", "source_size", "target", "taken", "passes", "cut", "positions", "position")
    columns = [c for c in plan.columns if c.lower() not in mine]
    h = fresh(plan.select(*columns), "use", "short")
    uses = plan.select(*columns, "passes", "cut", F.posexplode("positions").alias(h["use"], "position"))
    if whole:
        return uses.orderBy("position", id_col, h["use"]).select(*columns, "position")
    uses = uses.withColumn(h["short"], (F.col(h["use"]) >= F.col("passes")) & (F.col("cut") < word_count(F.col(text_col))))
    words = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col("cut").cast("int")), " ")
    uses = uses.withColumn(text_col, F.when(F.col(h["short"]), words).otherwise(F.col(text_col)))
    if chars_col in columns:
        uses = uses.withColumn(chars_col, F.when(F.col(h["short"]), F.char_length(text_col).cast("long")).otherwise(F.col(chars_col)))
    return uses.orderBy("position", id_col, h["use"]).select(*columns, "position")
