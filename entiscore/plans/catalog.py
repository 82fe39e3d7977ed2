"""Every operator wired to the stand-in datasets of a driver scale-factor
directory: ``CATALOG[key](spark, sf_dir) -> DataFrame``.

driver tables (:mod:`entiscore.sources.fixtures`) and runs the library's
operator on the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.operators import hierarchy as H
from entiscore.operators import network as N
from entiscore.operators import properties as P
from entiscore.operators import prototype as V
from entiscore.plans import report as R
from entiscore.session import scratch_path
from entiscore.sources import fixtures as fx
from entiscore.sources import io

# Names of the membrane and the secreted term in the stand-in term list (FIXTURES.md).
MEMBRANE_NAME = "Supplier#000000001"
SECRETED_NAME = "Supplier#000000002"
# S5's documented limit: the older report's number of ids.
REPORT_IDS = 61_524


def _t(spark, d):
    return fx.target(spark, d)


def _q(spark, d):
    return fx.query_ids(spark, d)


def terms(spark, d):
    """The two term arguments of the location operators: the membrane and the
    secreted term set, through H1–H6, as one value, and no second set."""
    return H.term_bits(_exploded_terms(spark, d), (MEMBRANE_NAME, SECRETED_NAME)), None


def _exploded_terms(spark, d):
    return H.explode_multivalue(fx.term_table(spark, d))


def rounded(df: DataFrame, column: str) -> DataFrame:
    """To 6 places, for comparison with a sum taken in another order."""
    return df.withColumn(column, F.round(column, 6) + F.lit(0.0))


def _report(spark, d):
    return rounded(R.priority_report(
        _t(spark, d), fx.gene_essentiality(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d),
        fx.tissue_atlas(spark, d), fx.mouse_phenotypes(spark, d), fx.phenotype_scores(spark, d),
        *terms(spark, d), _q(spark, d)), "phenotypeScores")


def _report_v1(spark, d):
    return R.priority_report_v1(
        _t(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d), fx.tissue_atlas(spark, d),
        *terms(spark, d), _q(spark, d))


def _prototype(spark, d):
    t = _t(spark, d)
    return R.prototype_report(t, fx.molecule(spark, d), fx.mechanism_of_action(spark, d),
                              fx.mouse_phenotypes(spark, d), terms(spark, d)[0], _q(spark, d))


def _scan_delimited(spark, d):
    path = io.write_delimited(fx.term_table(spark, d), scratch_path(spark, "terms-tsv"))
    return io.scan_delimited(spark, path, sep="\t", schema=io.TERM_SCHEMA)


def _scan_json(spark, d):
    path = io.write_json_report(fx.tissue_atlas(spark, d), scratch_path(spark, "atlas-json"))
    return io.scan_json_records(spark, path)


def _write_json(spark, d):
    rep = _report(spark, d)
    path = io.write_json_report(rep, scratch_path(spark, "report-json"))
    return spark.read.schema(rep.schema).json(path)


def _partners(spark, d):
    return N.partner_drugs(fx.molecule(spark, d), fx.interaction(spark, d), _q(spark, d))


def _n5(spark, d):
    return N.drug_disease_area(fx.molecule(spark, d), fx.interaction(spark, d), fx.diseases(spark, d), _q(spark, d))


def _n6(spark, d):
    path = io.write_delimited(fx.symbol_pairs(spark, d), scratch_path(spark, "pairs-csv"), sep=",")
    pairs = io.scan_delimited(spark, path, sep=",", schema=io.SYMBOL_PAIR_SCHEMA)
    return N.pairs_from_csv(pairs, fx.symbol_map(spark, d))


def _n8(spark, d):
    return N.target_drug_pairs(_n6(spark, d), fx.molecule(spark, d), fx.interaction(spark, d), _q(spark, d))


def _n9(spark, d):
    return N.matched_triples(_n6(spark, d), fx.molecule(spark, d), fx.interaction(spark, d), fx.diseases(spark, d), _q(spark, d))


CATALOG: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources, sinks, query set
    "scan_parquet": lambda s, d: io.scan_parquet(s, f"{d}/part.parquet", ["p_partkey", "p_name", "p_size"]),
    "scan_delimited": _scan_delimited,
    "scan_json_records": _scan_json,
    "query_set": lambda s, d: P.query_set(_t(s, d)),
    "query_set_limit": lambda s, d: P.query_set_limit(_t(s, d), REPORT_IDS),
    "write_json_report": _write_json,
    # current property operators
    "biotype": lambda s, d: P.biotype(_t(s, d), _q(s, d)),
    "location_profile": lambda s, d: P.location_profile(_t(s, d), *terms(s, d), _q(s, d)),
    "location_info": lambda s, d: P.location_info(_t(s, d), _q(s, d)),
    "tractability_pivot": lambda s, d: P.tractability_pivot(_t(s, d), _q(s, d)),
    "safety_events": lambda s, d: P.safety_events(_t(s, d), _q(s, d)),
    "constraint_minmax": lambda s, d: P.constraint_minmax(_t(s, d), _q(s, d)),
    "paralog_ramp": lambda s, d: P.paralog_ramp(_t(s, d), _q(s, d)),
    "ortholog_ramp": lambda s, d: P.ortholog_ramp(_t(s, d), _q(s, d)),
    "driver_flag": lambda s, d: P.driver_flag(_t(s, d), _q(s, d)),
    "essentiality": lambda s, d: P.essentiality(fx.gene_essentiality(s, d), _q(s, d)),
    "tep_flag": lambda s, d: P.tep_flag(_t(s, d), _q(s, d)),
    "mouse_models": lambda s, d: P.mouse_models(fx.mouse_phenotypes(s, d), _q(s, d)),
    "chemical_probes": lambda s, d: P.chemical_probes(_t(s, d), _q(s, d)),
    "clinical_phase": lambda s, d: P.clinical_phase(fx.molecule(s, d), _q(s, d)),
    "tissue_scores": lambda s, d: P.tissue_scores(fx.tissue_atlas(s, d), _q(s, d)),
    "phenotype_harmonic": lambda s, d: rounded(P.phenotype_harmonic(
        fx.mouse_phenotypes(s, d), fx.phenotype_scores(s, d), _q(s, d)), "scaledHarmonicSum"),
    # the same on an entity table whose ids repeat
    **{f"{name}_merged": (lambda s, d, op=op: op(fx.target_rows(s, d), _q(s, d), merge_ids=True)) for name, op in {
        "tractability_pivot": P.tractability_pivot, "safety_events": P.safety_events, "paralog_ramp": P.paralog_ramp,
        "ortholog_ramp": P.ortholog_ramp, "driver_flag": P.driver_flag, "chemical_probes": P.chemical_probes}.items()},
    # prototype variants
    "biotype_binary": lambda s, d: V.biotype_binary(_t(s, d), _q(s, d)).select("targetid", "biotype", "Nr_biotype"),
    "membrane_simple": lambda s, d: V.membrane_simple(_t(s, d), terms(s, d)[0], _q(s, d)),
    "approved_drugs": lambda s, d: V.approved_drugs(fx.molecule(s, d), fx.mechanism_of_action(s, d), _q(s, d)),
    "probe_moa_counts": lambda s, d: V.probe_moa_counts(_t(s, d), _q(s, d)),
    "constraint_bands": lambda s, d: V.constraint_bands(_t(s, d), _q(s, d)),
    "mouse_models_flag": lambda s, d: V.mouse_models_flag(fx.mouse_phenotypes(s, d), _q(s, d)),
    # term hierarchy
    "explode_multivalue": _exploded_terms,
    "parents": lambda s, d: H.parents(_exploded_terms(s, d)),
    "children": lambda s, d: H.children(_exploded_terms(s, d)),
    "part_members": lambda s, d: H.part_members(_exploded_terms(s, d)),
    "term_search_set": lambda s, d: H.term_search_set(_exploded_terms(s, d)),
    "terms_for_name": lambda s, d: H.terms_for_name(_exploded_terms(s, d), MEMBRANE_NAME),
    # partners, drugs, diseases
    "tractability_true": lambda s, d: N.tractability_true(_t(s, d), _q(s, d)),
    "drugs_per_target": lambda s, d: N.drugs_per_target(fx.molecule(s, d)),
    "partner_drugs": _partners,
    "disease_areas": lambda s, d: N.disease_areas(fx.diseases(s, d)),
    "drug_disease_area": _n5,
    "pairs_from_csv": _n6,
    "partner_names": lambda s, d: N.partner_names(fx.molecule(s, d), fx.interaction(s, d), _q(s, d), _t(s, d)),
    "target_drug_pairs": _n8,
    "matched_triples": _n9,
    "matched_drugs": lambda s, d: N.matched_drugs(_n9(s, d)),
    # reports
    "priority_report": _report,
    "priority_report_v1": _report_v1,
    "nest_report": lambda s, d: R.nest_report(_report(s, d)),
    "unpivot_report": lambda s, d: R.unpivot_report(_prototype(s, d)),
    "prototype_report": _prototype,
}

# Flagship query for the smoke check.
FLAGSHIP = "priority_report"

