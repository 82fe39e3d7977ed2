"""Plan properties of every registered query: no nested-loop / Cartesian
joins, no Python evaluation, and no shuffle for the same-row operators."""

import contextlib
import io
import os
import re

import pytest

from entiscore.operators import network as N
from entiscore.operators import properties as P
from entiscore.operators import prototype as V
from entiscore.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"
TERMS = ["SL-1", "SL-2"]
SAME_ROW = {
    "biotype": P.biotype, "location_profile": lambda t: P.location_profile(t, TERMS, TERMS), "location_info": P.location_info,
    "tractability_pivot": P.tractability_pivot, "safety_events": P.safety_events, "paralog_ramp": P.paralog_ramp,
    "ortholog_ramp": P.ortholog_ramp, "driver_flag": P.driver_flag, "tep_flag": P.tep_flag, "chemical_probes": P.chemical_probes,
    "membrane_simple": lambda t: V.membrane_simple(t, TERMS), "probe_moa_counts": V.probe_moa_counts,
    "constraint_bands": V.constraint_bands, "tractability_true": N.tractability_true,
}


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_no_pairwise_joins_and_no_python(spark):
    for name, build in CATALOG.items():
        plan = formatted(build(spark, SF))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), name


@pytest.fixture(scope="module")
def materialized(spark, tmp_path_factory):
    from entiscore.sources import fixtures as fx

    fx.materialize(spark, SF, str(tmp_path_factory.mktemp("standins")))
    yield SF
    fx.forget_materialized(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", SAME_ROW)
def test_same_row_operators_do_not_shuffle_entity_rows(spark, materialized, name):
    from entiscore.sources import fixtures as fx

    plan = formatted(SAME_ROW[name](fx.target(spark, materialized)))
    main = plan.split("===== Subqueries =====")[0]
    assert not re.search(r"^\(\d+\) Exchange", main, flags=re.M), name


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_matched_triples_shuffles(spark, materialized):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(CATALOG["matched_triples"](spark, materialized))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"^\(\d+\) Exchange\b", plan, flags=re.M)) <= 12


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name,most", [("priority_report", 12), ("nest_report", 12), ("priority_report_v1", 6), ("location_profile", 4), ("membrane_simple", 4)])
def test_shuffles_of_reports_and_term_lookups(spark, materialized, name, most):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(CATALOG[name](spark, materialized))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"^\(\d+\) Exchange\b", plan, flags=re.M)) <= most


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_stored_links_need_no_exchange(spark, materialized, tmp_path):
    from entiscore.sources import fixtures as fx

    mol, edges, q, t = (f(spark, materialized) for f in (fx.molecule, fx.interaction, fx.query_ids, fx.target))
    links = N.stored_links(mol, "links_by_target", 8, path=str(tmp_path / "links"))
    forms = {"n2": lambda m: N.drugs_per_target(m), "n3": lambda m: N.partner_drugs(m, edges, q), "n7": lambda m: N.partner_names(m, edges, q, t)}
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, form in forms.items():
            plain, bucketed = formatted(form(mol)), formatted(form(links))
            shuffles = [len(re.findall(r"^\(\d+\) Exchange\b", p, flags=re.M)) for p in (plain, bucketed)]
            assert shuffles[1] == shuffles[0] - 1, (name, shuffles)
            assert rows(form(links)) == rows(form(mol)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE links_by_target")


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", ["target", "mouse_phenotypes", "molecule"])
def test_stand_ins_shuffle_plain_rows_not_arrays(spark, name):
    from entiscore.sources import fixtures as fx

    inputs = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", formatted(getattr(fx, name).uncached(spark, SF)), flags=re.M)
    assert inputs and not [i for i in inputs if "buf#" in i], name


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_matched_triples_join_no_row_per_area(spark, materialized):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(CATALOG["matched_triples"](spark, materialized))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not re.search(r"hashpartitioning\(entity#\d+, drug#\d+, \d+\)|hashpartitioning\(drug#\d+, ind_disease_therapy#\d+, \d+\)", plan)
