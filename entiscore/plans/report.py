"""Report shaping (R1–R5): wide, nested and long reports over the operators.

The wide reports are planned in one pass instead of a chain of joins:

1. every same-row measure of the entity table (location, tractability,
   safety, constraint, homologues, driver, TEP, probes) is computed in a few
   projections over a single scan, with the term table arriving as a scalar
   subquery (one value, computed once);
2. the query set and all cross-table measures, fan-outs included, are one
   union of partial rows that is aggregated once by entity id (map-side
   combined, :func:`side_measures`), and joined once with the entity rows;
3. the fan-out measures (location info rows, several lof rows, several
   essentiality entries, duplicate atlas records, repeated query ids) are
   unfolded last: the in-row arrays are exploded in place, and what was
   counted per id is dealt out in chunks of copies and copied
   (:func:`~entiscore.operators.joins.dealt`), so no task makes all rows of
   a hot id.

The result has the same rows as chaining the operators by right joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.functions.measures import inverse_square_sum, minmax_scaled, no_neg_zero, rank_weighted_sum
from entiscore.operators import prototype as V
from entiscore.operators.joins import attach, dealt
from entiscore.operators.properties import (
    DISTRIBUTION_SCORES,
    LOF,
    PROTEIN_CODING,
    SPECIFICITY_SCORES,
    _lof,
    classed_locations,
    driver_measures,
    essentiality_values,
    location_class,
    location_evidence,
    location_results,
    membrane_flag,
    mouse_model_counts,
    ortholog_measures,
    paralog_measures,
    probe_measures,
    safety_measures,
    scored_classes,
    scored_counts,
    secreted_flag,
    tep_measures,
    term_table,
    tissue_values,
    tractability_measures,
)

# Public names of the current report, in order (source column -> name).
REPORT_COLUMNS = [
    ("Nr_mb", "isInMembrane"),
    ("Nr_secreted", "isSecreted"),
    ("Nr_Pocket", "hasPocket"),
    ("Nr_Ligand", "hasLigand"),
    ("Nr_sMBinder", "hasSmallMoleculeBinder"),
    ("Nr_Event", "hasSafetyEvent"),
    ("cal_score", "geneticConstraint"),
    ("Nr_paralogs", "paralogMaxIdentityPercentage"),
    ("Nr_ortholog", "mouseOrthologMaxIdentityPercentage"),
    ("Nr_CDG", "isCancerDriverGene"),
    ("Nr_essential", "isEssential"),
    ("Nr_TEP", "hasTEP"),
    ("Nr_Mousemodels", "hasMouseKO"),
    ("Nr_chprob", "hasHighQualityChemicalProbes"),
    ("inClinicalTrials", "maxClinicalTrialPhase"),
    ("Nr_specificity", "tissueSpecificity"),
    ("Nr_distribution", "tissueDistribution"),
    ("scaledHarmonicSum", "phenotypeScores"),
]

# Public names of the older report, in order. It has no
# small-molecule binder, essentiality or phenotype score, and reports the
# raw highest phase instead of phase / 4.
REPORT_COLUMNS_V1 = [
    ("Nr_mb", "isInMembrane"),
    ("Nr_secreted", "isSecreted"),
    ("Nr_Pocket", "hasPocket"),
    ("Nr_Ligand", "hasLigand"),
    ("Nr_Event", "hasSafetyEvent"),
    ("cal_score", "geneticConstraint"),
    ("Nr_paralogs", "paralogMaxIdentityPercentage"),
    ("Nr_ortholog", "mouseOrthologMaxIdentityPercentage"),
    ("Nr_CDG", "isCancerDriverGene"),
    ("Nr_TEP", "hasTEP"),
    ("Nr_Mousemodels", "hasMouseKO"),
    ("Nr_chprob", "hasHighQualityChemicalProbes"),
    ("maxClinTrialPhase", "maxClinicalTrialPhase"),
    ("Nr_specificity", "tissueSpecificity"),
    ("Nr_distribution", "tissueDistribution"),
]


def entity_measures(target: DataFrame, membrane_terms, secreted_terms=None, id_col: str = "id") -> DataFrame:
    """All same-row measures of the entity table in one scan; the entity rows
    are not shuffled. (DataFrame term lists are a scalar subquery over one small
    aggregate.)

    Output: ``id``, ``loc``, ``results`` (O3 array), ``ranks`` (the lof ranks,
    not scaled yet) and the O4, O5, O7, O8, O9, O11, O13 measures."""
    groups = [
        tractability_measures(F.col("tractability")),
        safety_measures(F.col("safetyLiabilities")),
        paralog_measures(F.col("homologues")),
        ortholog_measures(F.col("homologues")),
        driver_measures(F.col("hallmarks.attributes")),
        tep_measures(F.col("tep.description")),
        probe_measures(F.col("chemicalProbes")),
    ]
    bases = [c for b, _ in groups for c in b]
    derives = [c for _, d in groups for c in d]

    ranks = F.transform(_lof(F.col("constraint"), LOF), lambda c: c["upperRank"])
    b = target.select(F.col(id_col).alias("id"), F.col("subcellularLocations").alias("_locs"), ranks.alias("ranks"), *bases)
    base_names = [c for c in b.columns if c not in ("id", "_locs", "ranks")]
    b = b.select("*", term_table(membrane_terms, secreted_terms).alias("_terms"))
    step1 = b.select("id", "ranks", classed_locations("_locs", "_terms").alias("_classed"), location_results(F.col("_locs")).alias("results"), *base_names)
    step2 = step1.select("id", "ranks", *location_evidence(F.col("_classed")), "results", *base_names)
    return step2.select("id", location_class().alias("loc"), "results", "ranks", *derives)


def _scores_of(mapping) -> list[float]:
    """The distinct scores of a category table."""
    return sorted({float(v) for _, v in mapping if v is not None})


# A tissue record's pair of scores as one number, and an essentiality value as one:
# what the report counts per id instead of joining records.
_SPECIFICITIES: list[float | None] = [*_scores_of(SPECIFICITY_SCORES), None]
_DISTRIBUTIONS: list[float | None] = [*_scores_of(DISTRIBUTION_SCORES), None]
_PAIRS = [(s, d) for s in _SPECIFICITIES for d in _DISTRIBUTIONS]
_ESSENTIALS: list[int | None] = [-1, 0, None]


def _place(value, choices: list) -> F.Column:
    """Position of a value among the choices, of which null is the last."""
    out = F.when(value.isNull(), F.lit(len(choices) - 1))
    for i, c in enumerate(choices[:-1]):
        out = out.when(value == F.lit(c), F.lit(i))
    return out


def _counts(column: str, choices: int) -> str:
    return f"array({', '.join(f'count_if({column} = {i})' for i in range(choices))})"


def _choices(values: list[tuple], schema: str) -> str:
    """SQL of an array of structs."""
    text = lambda v: "NULL" if v is None else repr(v)
    return f"CAST(array({', '.join(f'struct({', '.join(map(text, v))})' for v in values)}) AS array<struct<{schema}>>)"


def _held(name: str, values: str, kind: str) -> str:
    """The values with a count, each with it; one row of nulls where nothing was counted."""
    kept = f"filter(transform({name}, (n, i) -> struct({values}[i] AS v, n AS n)), x -> x.n > 0)"
    return f"CASE WHEN any_{name} THEN {kept} ELSE array(struct(CAST(NULL AS {kind}) AS v, 1L AS n)) END"


def side_measures(queryset, gene_essentiality, mouse, molecule, atlas, mouse_phenotypes, phenotype_scores) -> DataFrame:
    """Everything that the report takes from other tables than the entity table,
    a row per id: one union of partial rows that bear an id and the columns of
    one measure, aggregated once. Counts, sums and maxima are combined map-side,
    so a hot id is few rows in the shuffle; the lists are as long as there are
    distinct scores.

    ``asked`` counts the query rows, ``classes``/``labels`` the phenotype classes
    and their labels (null without any), ``phase`` is the highest phase,
    ``tissues``/``essentials`` count the values by position (``any_...``: is there one), ``scored`` lists
    ``struct(score, n)``, ``observed`` tells ids of the phenotype table."""
    one = F.lit(1).cast("long")
    partial = [
        mouse.select(F.col("targetFromSourceId").alias("id"), F.explode("modelPhenotypeClasses").alias("c")).select(
            "id", one.alias("classes"), F.col("c.label").isNotNull().cast("long").alias("labels")),
        molecule.select(F.explode("linkedTargets.rows").alias("id"), F.col("maximumClinicalTrialPhase").alias("phase")),
        tissue_values(atlas).select("id", (_place(F.col("Nr_specificity"), _SPECIFICITIES) * len(_DISTRIBUTIONS)
                                           + _place(F.col("Nr_distribution"), _DISTRIBUTIONS)).alias("tissue")),
    ]
    if gene_essentiality is not None:
        partial.append(essentiality_values(gene_essentiality).select("id", _place(F.col("Nr_essential"), _ESSENTIALS).alias("essential")))
    if mouse_phenotypes is not None:
        partial.append(scored_classes(mouse_phenotypes, phenotype_scores).select("id", "score", F.col("n").alias("scored_n"), F.lit(True).alias("observed")))
    partial = [p.where(F.col("id").isNotNull()) for p in partial]
    if queryset is not None:
        partial.append(queryset.select(F.col("targetid").alias("id"), one.alias("asked")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), partial)
    aggregates = ["sum(classes) AS classes", "sum(labels) AS labels", "max(phase) AS phase", f"{_counts('tissue', len(_PAIRS))} AS tissues", "count(tissue) > 0 AS any_tissues"]
    if gene_essentiality is not None:
        aggregates += [f"{_counts('essential', len(_ESSENTIALS))} AS essentials", "count(essential) > 0 AS any_essentials"]
    if mouse_phenotypes is not None:
        aggregates += ["max(observed) AS observed", "collect_list(CASE WHEN score IS NOT NULL THEN struct(score, scored_n AS n) END) AS scored"]
    if queryset is not None:
        aggregates.append("sum(asked) AS asked")
    return rows.groupBy("id").agg(*[F.expr(a) for a in aggregates])


def _wide_report(target, gene_essentiality, mouse, molecule, atlas, mouse_phenotypes, phenotype_scores,
                 membrane_terms, secreted_terms, queryset, columns) -> DataFrame:
    names = {src for src, _ in columns}
    rows = entity_measures(target, membrane_terms, secreted_terms)
    sides = side_measures(queryset, gene_essentiality, mouse, molecule, atlas, mouse_phenotypes, phenotype_scores).withColumnRenamed("id", "_id")
    if queryset is None:
        wide = rows.join(sides, F.col("id") == F.col("_id"), "left").withColumn("asked", F.lit(1).cast("long")).withColumnRenamed("id", "targetid")
    else:
        wide = sides.where("asked > 0").join(rows, F.col("_id") == F.col("id"), "left").withColumnRenamed("_id", "targetid")

    # constants of the whole data, one small aggregate
    wide = wide.withColumn("_range", data_range(target, mouse_phenotypes, phenotype_scores))
    wide = wide.withColumns({
        "Nr_Mousemodels": F.expr("CASE WHEN classes IS NOT NULL THEN CASE WHEN labels > 0 THEN 1 ELSE 0 END END"),
        "maxClinTrialPhase": F.col("phase"),
        "inClinicalTrials": F.when(F.col("phase") >= 0, F.col("phase") / F.lit(4)),
        "scores": F.transform("ranks", lambda r: minmax_scaled(r, F.col("_range.lo"), F.col("_range.hi"))),
    })
    if "scaledHarmonicSum" in names:
        wide = wide.withColumn("_scored", F.sort_array("scored", asc=False)).withColumns({
            "_sum": rank_weighted_sum("_scored"), "_top_n": F.col("_range.top")}).withColumn("_most", inverse_square_sum("_top_n"))
        wide = wide.withColumn("scaledHarmonicSum", F.when(F.col("observed"), no_neg_zero(-F.try_divide(F.col("_sum.hs"), F.col("_most")))))

    # fan-out measures: values with their counts, copied last
    fans = {"tissues": (_choices(_PAIRS, "Nr_specificity:double,Nr_distribution:double"), "struct<Nr_specificity:double,Nr_distribution:double>")}
    if "Nr_essential" in names:
        fans["essentials"] = (_choices([(v,) for v in _ESSENTIALS], "Nr_essential:int"), "struct<Nr_essential:int>")
    copies = F.col("asked")
    for name, (values, kind) in fans.items():
        wide = wide.withColumn(f"_{name}", F.explode(F.expr(_held(name, values, kind))))
        copies = copies * F.col(f"_{name}.n")
    fanned = [F.col(f"_{n}.v.{c}").alias(c) for n, c in (("tissues", "Nr_specificity"), ("tissues", "Nr_distribution"), ("essentials", "Nr_essential")) if n in fans]
    keep = [src for src, _ in columns if src in wide.columns]
    wide = dealt(wide.select("targetid", "loc", "results", "scores", *keep, *fanned, copies.alias("_copies")), "_copies",
                 ["targetid", *[c for c in ("Nr_specificity", "Nr_distribution", "Nr_essential") if c in names]])
    keep = [c for c in wide.columns if c not in ("results", "scores")]
    wide = (wide.select(*keep, F.explode_outer("results").alias("result"), "scores")
                .select(*keep, "result", F.explode_outer("scores").alias("cal_score")))
    derived = {"Nr_mb": membrane_flag(F.col("loc"), F.col("result")),
               "Nr_secreted": secreted_flag(F.col("loc"), F.col("result"))}
    return wide.select("targetid", *[derived.get(src, F.col(src)).alias(dst) for src, dst in columns])


def data_range(target: DataFrame, mouse_phenotypes: DataFrame | None, phenotype_scores: DataFrame | None) -> F.Column:
    """``struct(lo, hi, top)`` as one scalar subquery: least and greatest lof rank,
    and the most scored phenotypes of an id."""
    rows = target.select(F.explode(_lof(F.col("constraint"), LOF)).alias("c")).select(F.col("c.upperRank").alias("rank"), F.lit(None).cast("long").alias("n"))
    if mouse_phenotypes is not None:
        rows = rows.unionByName(scored_counts(mouse_phenotypes, phenotype_scores).select(F.lit(None).cast(rows.schema["rank"].dataType).alias("rank"), "n"))
    return rows.agg(F.struct(F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.coalesce(F.max("n"), F.lit(0)).alias("top")).alias("range")).scalar()


def priority_report(target: DataFrame, gene_essentiality: DataFrame, mouse: DataFrame, molecule: DataFrame,
                    atlas: DataFrame, mouse_phenotypes: DataFrame, phenotype_scores: DataFrame,
                    membrane_terms, secreted_terms=None, queryset: DataFrame | None = None) -> DataFrame:
    """The current wide report, ``targetid`` plus 18 public measures.

    ``queryset=None`` reports every entity of ``target`` (the entity scan
    itself is the backbone, no self-join). Ids may repeat where a measure
    fans out (location info, several lof rows, essentiality entries,
    duplicate atlas records), exactly as the chained right joins do."""
    return _wide_report(target, gene_essentiality, mouse, molecule, atlas, mouse_phenotypes, phenotype_scores,
                        membrane_terms, secreted_terms, queryset, REPORT_COLUMNS)


def priority_report_v1(target: DataFrame, mouse: DataFrame, molecule: DataFrame, atlas: DataFrame,
                       membrane_terms, secreted_terms=None, queryset: DataFrame | None = None) -> DataFrame:
    """R2: the older report, 13 operators and 15 public measures."""
    return _wide_report(target, None, mouse, molecule, atlas, None, None,
                        membrane_terms, secreted_terms, queryset, REPORT_COLUMNS_V1)


def nest_report(df: DataFrame, key: str = "targetid", out_col: str = "prioritisations") -> DataFrame:
    """Key plus an array of ``struct(id, value)`` for the non-null columns,
    in column order (values as double); all null → empty array. A pure
    projection: one stage, no shuffle."""
    cols = [c for c in df.columns if c != key]
    arr = F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("id"), F.col(c).cast("double").alias("value")))
        for c in cols
    ])
    return df.select(key, F.filter(arr, lambda x: x.isNotNull()).alias(out_col))


def unpivot_report(df: DataFrame, key: str = "targetid") -> DataFrame:
    """Wide to long ``(key, id, value)`` over every column but the key;
    null values are kept, values are widened to double."""
    cols = [c for c in df.columns if c != key]
    typed = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot([key], cols, "id", "value")


def prototype_report(target: DataFrame, molecule: DataFrame, mechanism: DataFrame, mouse: DataFrame,
                     membrane_terms, queryset: DataFrame) -> DataFrame:
    """The prototype chain V1, V2, V3, V4, V6, V5: ``targetid``,
    ``Nr_biotype``, ``Nr_mb``, ``Nr_drug``, ``Nr_chprob``, ``Nr_Mousemodels``,
    ``cal_score`` (one row per lof element).

    One scan of the entity table gives V1's biotype, V2's membrane hit, V4's
    probe list and V5's scores (the entity table is keyed by id, so V1's
    distinct (id, biotype) is the row itself); V3 and V6 are keyed
    aggregates joined on the id partitioning."""
    base = target.select(F.col("id").alias("id"), "biotype", F.col("subcellularLocations").alias("_locs"),
                         F.col("chemicalProbes").alias("_probes"), _lof(F.col("constraint")).alias("_lof"),
                         term_table(membrane_terms).alias("_terms"))
    base = base.withColumn("_classed", classed_locations("_locs", "_terms"))
    hq = F.exists("_probes", lambda p: F.coalesce(p["isHighQuality"], F.lit(False)) & p["mechanismOfAction"].isNotNull()
                  & F.coalesce(F.size(p["urls"]) > 0, F.lit(False)))
    rows = base.select(
        "id",
        F.when(F.col("biotype") == PROTEIN_CODING, F.lit(1)).otherwise(F.lit(0)).alias("Nr_biotype"),
        F.when(V.in_membrane("_classed"), F.lit(1)).alias("Nr_mb"),
        F.when(hq, F.lit(1)).alias("Nr_chprob"),
        F.transform("_lof", lambda c: (c["upperRank"] - F.lit(V.BAND_CENTER)) / F.lit(V.BAND_SCALE)).alias("_s"),
    )
    out = attach(queryset, rows, on="id")
    out = out.withColumn("Nr_biotype", F.coalesce("Nr_biotype", F.lit(0)))
    out = attach(out, V.approved_drug_lists(molecule, mechanism).select("id", "Nr_drug"), on="id")
    mm = mouse_model_counts(mouse).select("id", F.when(F.col("Nr_mouse_models") != 0, F.lit(1)).alias("Nr_Mousemodels"))
    out = attach(out, mm, on="id").withColumn("cal_score", F.explode_outer("_s"))
    return out.select("targetid", "Nr_biotype", "Nr_mb", "Nr_drug", "Nr_chprob", "Nr_Mousemodels", "cal_score")


def priority_report_from_files(spark, target: str, gene_essentiality: str, mouse: str, molecule: str,
                               tissue_atlas_json: str, mouse_phenotypes: str, phenotype_scores_csv: str,
                               term_list_tsv: str, membrane_name: str = "Cell membrane",
                               secreted_name: str = "Secreted", queryset: DataFrame | None = None) -> DataFrame:
    """R1 end to end from files, the way the current report is produced:
    entity parquet (read with its declared nested schema), side tables as
    parquet, the tissue atlas as JSON records, the phenotype score list as
    CSV and the location term list as TSV. The membrane and secreted term
    sets come from the term list through H1–H6, as one scalar
    subquery (never a driver-side list)."""
    from entiscore.operators import hierarchy as H
    from entiscore.sources import io

    terms = io.scan_delimited(spark, term_list_tsv, sep="\t", schema=io.TERM_SCHEMA)
    exploded = H.explode_multivalue(terms)
    return priority_report(
        io.scan_entities(spark, target),
        io.scan_parquet(spark, gene_essentiality),
        io.scan_parquet(spark, mouse),
        io.scan_parquet(spark, molecule),
        io.scan_json_records(spark, tissue_atlas_json),
        io.scan_parquet(spark, mouse_phenotypes),
        io.scan_delimited(spark, phenotype_scores_csv, sep=",", schema=io.PHENOTYPE_SCORE_SCHEMA),
        H.term_bits(exploded, (membrane_name, secreted_name)),
        queryset=queryset,
    )
