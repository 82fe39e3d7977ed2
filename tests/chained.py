"""The reports built the straightforward way, one operator joined after
another: an independent check of the one-pass plans, and the bench's baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.operators import properties as P
from entiscore.operators import prototype as V
from entiscore.plans.report import REPORT_COLUMNS


def priority_report_chained(target: DataFrame, gene_essentiality: DataFrame, mouse: DataFrame,
                            molecule: DataFrame, atlas: DataFrame, mouse_phenotypes: DataFrame,
                            phenotype_scores: DataFrame, membrane_terms, secreted_terms,
                            queryset: DataFrame | None = None, columns=None) -> DataFrame:
    """R1 (or, with ``columns=REPORT_COLUMNS_V1``, R2) built the
    straightforward way: every operator on its own, joined one after another
    on the query set. Same rows as :func:`priority_report`; kept as the
    comparison baseline for the one-pass plan (bench) and as an independent
    check of it (tests)."""
    columns = REPORT_COLUMNS if columns is None else columns
    names = {src for src, _ in columns}
    q = P.query_set(target) if queryset is None else queryset
    chain = P.location_profile(target, membrane_terms, secreted_terms, q).select(*q.columns, "Nr_mb", "Nr_secreted")
    q = q.select("targetid").distinct()  # each part once per id: repeated query ids are not multiplied
    parts = [
        (lambda: P.tractability_pivot(target, q), ["Nr_Pocket", "Nr_Ligand", "Nr_sMBinder"]),
        (lambda: P.safety_events(target, q), ["Nr_Event"]),
        (lambda: P.constraint_minmax(target, q), ["cal_score"]),
        (lambda: P.paralog_ramp(target, q), ["Nr_paralogs"]),
        (lambda: P.ortholog_ramp(target, q), ["Nr_ortholog"]),
        (lambda: P.driver_flag(target, q), ["Nr_CDG"]),
        (lambda: P.essentiality(gene_essentiality, q), ["Nr_essential"]),
        (lambda: P.tep_flag(target, q), ["Nr_TEP"]),
        (lambda: P.mouse_models(mouse, q), ["Nr_Mousemodels"]),
        (lambda: P.chemical_probes(target, q), ["Nr_chprob"]),
        (lambda: P.clinical_phase(molecule, q), ["maxClinTrialPhase", "inClinicalTrials"]),
        (lambda: P.tissue_scores(atlas, q), ["Nr_specificity", "Nr_distribution"]),
        (lambda: P.phenotype_harmonic(mouse_phenotypes, phenotype_scores, q), ["scaledHarmonicSum"]),
    ]
    for build, cols in parts:
        if not names.intersection(cols):
            continue
        chain = chain.join(build().select(F.col("targetid").alias("_k"), *cols),
                           F.col("targetid") == F.col("_k"), "left").drop("_k")
    return chain.select("targetid", *[F.col(src).alias(dst) for src, dst in columns])


def prototype_report_chained(target: DataFrame, molecule: DataFrame, mechanism: DataFrame, mouse: DataFrame,
                             membrane_terms, queryset: DataFrame) -> DataFrame:
    """R5 built by chaining V1, V2, V3, V4, V6, V5 one join at a time (the
    independent check of :func:`prototype_report`)."""
    chain = V.biotype_binary(target, queryset).select("targetid", "Nr_biotype")
    queryset = queryset.select("targetid").distinct()  # each part once per id
    for df, col in [
        (V.membrane_simple(target, membrane_terms, queryset), "Nr_mb"),
        (V.approved_drugs(molecule, mechanism, queryset), "Nr_drug"),
        (V.probe_moa_counts(target, queryset), "Nr_chprob"),
        (V.mouse_models_flag(mouse, queryset), "Nr_Mousemodels"),
        (V.constraint_bands(target, queryset), "cal_score"),
    ]:
        chain = chain.join(df.select(F.col("targetid").alias("_k"), col), F.col("targetid") == F.col("_k"), "left").drop("_k")
    return chain.select("targetid", "Nr_biotype", "Nr_mb", "Nr_drug", "Nr_chprob", "Nr_Mousemodels", "cal_score")
