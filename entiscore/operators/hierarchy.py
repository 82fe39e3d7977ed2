"""One-level term hierarchy (H1–H6) from a term list in TSV shape.

Columns of the term list: ``Name``, ``Subcellular location ID``, ``Is a`` and
``Is part of``; the last two are multi-valued (``,`` between items, ``;``
inside an item, only the text before ``;`` is the term id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME, TERM_ID, IS_A, PART_OF = "Name", "Subcellular location ID", "Is a", "Is part of"


def _item(col):
    return F.trim(F.split(col, ";")[0])


def explode_multivalue(terms: DataFrame, name_col: str = NAME, id_col: str = TERM_ID,
                       is_a_col: str = IS_A, part_of_col: str = PART_OF) -> DataFrame:
    """H1: one row per (is-a item × part-of item) of every term (outer: a
    missing list gives one null item). Items are trimmed (a blank after the
    comma would otherwise stay part of the id)."""
    return (
        terms.select(F.col(f"`{name_col}`").alias("Name"), F.col(f"`{id_col}`").alias("SubcellID"),
                     F.explode_outer(F.split(F.col(f"`{is_a_col}`"), ",")).alias("_a"),
                     F.col(f"`{part_of_col}`").alias("_p"))
        .select("Name", "SubcellID", "_a", F.explode_outer(F.split("_p", ",")).alias("_b"))
        .select("Name", "SubcellID", _item(F.col("_a")).alias("Is_a"), _item(F.col("_b")).alias("Is_part"))
    )


def parents(exploded: DataFrame) -> DataFrame:
    """H2: distinct (Name, SubcellID, Is_a)."""
    return exploded.select("Name", "SubcellID", "Is_a").distinct()


def children(exploded: DataFrame) -> DataFrame:
    """H3: per parent id (``Is_a``, null included) its distinct child ids,
    sorted. ``collect_set`` deduplicates map-side: one shuffle."""
    return exploded.groupBy("Is_a").agg(F.sort_array(F.collect_set("SubcellID")).alias("children"))


def part_members(exploded: DataFrame) -> DataFrame:
    """H4: per whole (``Is_part``, null included) its member ids, sorted, with
    repeats kept (one per exploded row)."""
    return exploded.groupBy("Is_part").agg(F.sort_array(F.collect_list("SubcellID")).alias("members"))


def term_search_set(exploded: DataFrame) -> DataFrame:
    """H5: per (Name, SubcellID, Is_a) the search set ``toSearch`` = the term
    itself, its children and its members (one level only, no closure). Items
    without a parent or whole belong to no term: they are left out before
    grouping."""
    ch = children(exploded.where(F.col("Is_a").isNotNull())).withColumnRenamed("Is_a", "_parent")
    mb = part_members(exploded.where(F.col("Is_part").isNotNull())).withColumnRenamed("Is_part", "_whole")
    return (
        parents(exploded)
        .join(ch, F.col("SubcellID") == F.col("_parent"), "left")
        .join(mb, F.col("SubcellID") == F.col("_whole"), "left")
        .select(
            "Name", "SubcellID", "Is_a", "children", "members",
            F.concat(F.array("SubcellID"), F.coalesce("children", F.array().cast("array<string>")),
                     F.coalesce("members", F.array().cast("array<string>"))).alias("toSearch"),
        )
    )


def terms_for_name(exploded: DataFrame, name: str) -> DataFrame:
    """H6: the distinct terms to search for one named term, one per row: the
    term, its children and its members (:func:`term_search_set`'s ``toSearch``,
    read from the long form, so no list is built). The result is a small
    DataFrame for the location operators, never a driver-side list."""
    named = exploded.where(F.col("Name") == F.lit(name)).select(F.col("SubcellID").alias("_t")).distinct()
    below = exploded.select("SubcellID", F.explode(F.array("Is_a", "Is_part")).alias("_up")).where(F.col("_up").isNotNull())
    found = below.join(named, F.col("_up") == F.col("_t"), "left_semi").select(F.col("SubcellID").alias("term"))
    return named.select(F.col("_t").alias("term")).unionByName(found).distinct()


SHORT = 256


def term_struct(entries: str) -> str:
    """SQL of a term table from its sorted ``array<struct<term, bits>>``:
    ``struct<entries, first, second>``, where ``first`` and ``second`` are the two
    sets as plain arrays if there are at most ``SHORT`` entries (in so few a scan
    beats a search), else null."""
    def plain(bit: int) -> str:
        return f"CASE WHEN size({entries}) <= {SHORT} THEN transform(filter({entries}, e -> e.bits & {bit} > 0), e -> e.term) END"
    return f"named_struct('entries', {entries}, 'first', {plain(1)}, 'second', {plain(2)})"


def term_bits(exploded: DataFrame, names: Sequence[str]) -> Column:
    """The search sets (H6) of several named terms as one value, a scalar
    subquery: a term table (:func:`term_struct`) whose entries are sorted by term;
    bit i says that the term is in the set of ``names[i]``. A term may stand there
    more than once, with other bits; its bits are those of all its entries.

    One pass finds the ids of the names, another the terms that are one of them
    or directly below: two global aggregates for all names together, and no join."""
    bit = F.lit(0)
    for i, name in enumerate(names):
        bit = bit.bitwiseOR(F.when(F.col("Name") == F.lit(name), F.lit(1 << i)).otherwise(F.lit(0)))
    named = exploded.select(F.col("SubcellID").alias("id"), bit.alias("bit")).where((F.col("bit") > 0) & F.col("id").isNotNull())
    named = named.agg(F.collect_set(F.struct("id", "bit")).alias("named")).scalar()
    bits = F.expr("""aggregate(filter(_named, e -> coalesce(e.id = SubcellID, false) OR coalesce(e.id = Is_a, false) OR coalesce(e.id = Is_part, false)), 0, (a, e) -> a | e.bit)""")
    found = exploded.select("SubcellID", "Is_a", "Is_part", named.alias("_named")).select(F.col("SubcellID").alias("term"), bits.alias("bits"))
    found = found.where((F.col("bits") > 0) & F.col("term").isNotNull())
    return found.agg(F.sort_array(F.collect_set(F.struct("term", "bits"))).alias("terms")).selectExpr(f"{term_struct('terms')} AS terms").scalar()
