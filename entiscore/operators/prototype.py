"""Prototype variants of six operators (V1–V6) whose results differ from the
current ones. Same contract as :mod:`entiscore.operators.properties`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiscore.functions.measures import bands
from entiscore.operators.joins import attach
from entiscore.operators.properties import (
    LOF,
    MEMBRANE_BIT,
    PROTEIN_CODING,
    _finish,
    _lof,
    _require,
    classed_locations,
    mouse_model_counts,
    term_table,
)

# Fixed values of the prototype constraint bands.
BAND_CENTER, BAND_SCALE = 9456, 19196
BAND_LOWER, BAND_UPPER = -0.1, 0.1
BAND_INNER_LO, BAND_INNER_HI = -0.0999999, 0.0999999


def biotype_binary(target: DataFrame, queryset: DataFrame, id_col: str = "id",
                   biotype_col: str = "biotype") -> DataFrame:
    """V1: distinct (id, biotype), then ``Nr_biotype`` 1 for protein coding and
    0 otherwise, also for ids missing from the entity table (never null)."""
    q = _require(queryset, "biotype_binary")
    m = target.select(F.col(id_col).alias("id"), F.col(biotype_col).alias("biotype")).dropDuplicates()
    out = attach(q, m, on="id")
    return out.withColumn("Nr_biotype", F.when(F.col("biotype") == PROTEIN_CODING, F.lit(1)).otherwise(F.lit(0)))


def in_membrane(classed: str) -> Column:
    """Whether some classed location's term is in the membrane set."""
    return F.coalesce(F.exists(classed, lambda x: F.coalesce(x["bits"].bitwiseAND(F.lit(MEMBRANE_BIT)) > 0, F.lit(False))), F.lit(False))


def membrane_simple(target: DataFrame, membrane_terms, queryset: DataFrame | None = None,
                    id_col: str = "id", loc_col: str = "subcellularLocations") -> DataFrame:
    """V2: any location term in the membrane list → ``IsinMembrane`` Yes and
    ``Nr_mb`` 1; otherwise null."""
    base = target.select(F.col(id_col).alias("id"), F.col(loc_col).alias("_locs"), term_table(membrane_terms).alias("_terms"))
    base = base.select("id", classed_locations("_locs", "_terms").alias("_classed"))
    m = base.select("id", in_membrane("_classed").alias("_hit")).select(
        "id", F.when(F.col("_hit"), F.lit("Yes")).alias("IsinMembrane"), F.when(F.col("_hit"), F.lit(1)).alias("Nr_mb"))
    return _finish(m, queryset)


def approved_drugs(molecule: DataFrame, mechanism: DataFrame, queryset: DataFrame,
                   targets_col: str = "linkedTargets.rows") -> DataFrame:
    """V3: per entity the approved drugs (that have a mechanism record) and
    their action types, and ``Nr_drug`` = 1 for any approved drug.

    Drugs are matched to mechanisms through ``chemblIds``; each (entity, drug)
    pair keeps the smallest action type (the prototype kept an arbitrary one).
    Both lists are ordered by drug id; drugs without an action type have no
    entry in the second, so the two need not be equally long."""
    q = _require(queryset, "approved_drugs")
    return attach(q, approved_drug_lists(molecule, mechanism, targets_col), on="id")


def approved_drug_lists(molecule: DataFrame, mechanism: DataFrame,
                        targets_col: str = "linkedTargets.rows") -> DataFrame:
    """Keyed V3 measures ``(id, App_drug_ChEMBL, App_drug_actionType, Nr_drug)``.

    The action type depends only on the drug, so mechanisms are reduced to
    one ``min(actionType)`` per drug (map-side combined) before the join:
    the join meets one mechanism row per drug, whatever the number of
    mechanism records. Repeated (entity, drug) links collapse in the
    per-entity ``collect_set`` (combined map-side), so no separate dedupe
    shuffle is needed."""
    actions = (mechanism.select("actionType", F.explode("chemblIds").alias("chembl"))
               .groupBy("chembl").agg(F.min("actionType").alias("actionType")))
    approved = (molecule.where(F.col("isApproved"))
                .select(F.col("id").alias("drug_id"), F.explode(F.col(targets_col)).alias("target"))
                .where(F.col("target").isNotNull()))
    pairs = approved.join(actions, F.col("chembl") == F.col("drug_id"), "left").select("target", "chembl", "actionType")
    per_target = pairs.groupBy("target").agg(
        F.sort_array(F.collect_set(F.when(F.col("chembl").isNotNull(), F.struct("chembl", "actionType")))).alias("_p"))
    return per_target.select(
        F.col("target").alias("id"),
        F.transform("_p", lambda p: p["chembl"]).alias("App_drug_ChEMBL"),
        F.filter(F.transform("_p", lambda p: p["actionType"]), lambda a: a.isNotNull()).alias("App_drug_actionType"),
        F.lit(1).alias("Nr_drug"),
    )


def probe_moa_counts(target: DataFrame, queryset: DataFrame | None = None, id_col: str = "id",
                     arr_col: str = "chemicalProbes") -> DataFrame:
    """V4: for high-quality probes, the number of (probe, url) entries per
    mechanism as ``"mechanism:count"`` strings (sorted); probes without a
    mechanism are dropped. ``Nr_chprob`` = 1 when the list is not empty,
    else both null."""
    hq = F.filter(F.col(arr_col), lambda p: F.coalesce(p["isHighQuality"], F.lit(False)))
    base = target.select(F.col(id_col).alias("id"), hq.alias("_hq"))
    moas = F.array_distinct(F.filter(F.transform("_hq", lambda p: p["mechanismOfAction"]), lambda m: m.isNotNull()))

    def url_count(m: Column) -> Column:
        return F.aggregate(F.filter("_hq", lambda p: p["mechanismOfAction"] == m), F.lit(0).cast("long"),
                           lambda acc, p: acc + F.when(p["urls"].isNotNull(), F.size(p["urls"])).otherwise(F.lit(0)).cast("long"))

    counted = F.transform(moas, lambda m: F.struct(m.alias("m"), url_count(m).alias("n")))
    labels = F.sort_array(F.transform(F.filter(counted, lambda c: c["n"] > 0),
                                      lambda c: F.concat_ws(":", c["m"], c["n"].cast("string"))))
    m = base.select("id", labels.alias("_l")).select(
        "id",
        F.when(F.size("_l") > 0, F.col("_l")).alias("ChemicalProbes_HC"),
        F.when(F.size("_l") > 0, F.lit(1)).alias("Nr_chprob"),
    )
    return _finish(m, queryset)


def constraint_bands(target: DataFrame, queryset: DataFrame | None = None, id_col: str = "id",
                     arr_col: str = "constraint", center: float = BAND_CENTER, scale: float = BAND_SCALE,
                     constraint_type: str = LOF) -> DataFrame:
    """V5: ``constraintType`` and ``cal_score = (rank - 9456) / 19196`` per lof element and a band
    '-1' (< -0.1), '0' (within ±0.0999999), '1' (> 0.1); the gaps, exactly
    ±0.1 included, give null."""
    lof = _lof(F.col(arr_col), constraint_type)
    m = target.select(F.col(id_col).alias("id"),
                      F.transform(lof, lambda c: F.struct(c["constraintType"].alias("constraintType"),
                                                          ((c["upperRank"] - F.lit(center)) / F.lit(scale)).alias("cal_score"))).alias("scores"))
    out = _finish(m, queryset).withColumn("_s", F.explode_outer("scores")).drop("scores")
    out = out.select("*", "_s.constraintType", "_s.cal_score").drop("_s")
    return out.withColumn("selection", bands(F.col("cal_score"), BAND_LOWER, BAND_UPPER, BAND_INNER_LO, BAND_INNER_HI))


def mouse_models_flag(mouse: DataFrame, queryset: DataFrame, id_col: str = "targetFromSourceId",
                      arr_col: str = "modelPhenotypeClasses") -> DataFrame:
    """V6: as O12 without ``hasMouseKO``; ``Nr_Mousemodels`` 1 if any label,
    else null (the prototype's empty string)."""
    q = _require(queryset, "mouse_models_flag")
    n = F.col("Nr_mouse_models")
    m = mouse_model_counts(mouse, id_col, arr_col).select(
        "id", n, "Different_PhenoClasses", F.when(n != 0, F.lit(1)).alias("Nr_Mousemodels"))
    return attach(q, m, on="id")
