"""Prototype variants, term hierarchy, partner network and report shaping
on hand-written frames."""

import chained as C
from frames import by_id, loc, queryset, target_df, target_row

from entiscore.operators import hierarchy as H
from entiscore.operators import network as N
from entiscore.operators import properties as P
from entiscore.operators import prototype as V
from entiscore.plans import report as R

MOL_SCHEMA = ("id string, isApproved boolean, maximumClinicalTrialPhase int, linkedTargets struct<rows:array<string>>, "
              "linkedDiseases struct<rows:array<string>>")


def one(rows):
    assert len(rows) == 1, rows
    return rows[0]


# --- prototype ------------------------------------------------------------
def test_biotype_binary_never_null(spark):
    t = target_df(spark, target_row("A", biotype="protein_coding"), target_row("B", biotype=None))
    out = by_id(V.biotype_binary(t, queryset(spark, "A", "B", "Z")))
    assert [one(out[k])["Nr_biotype"] for k in "ABZ"] == [1, 0, 0]


def test_membrane_simple(spark):
    t = target_df(spark, target_row("A", subcellularLocations=[loc("x", "uniprot", "SL-M")]),
                  target_row("B", subcellularLocations=[loc("x", "HPA_main", None)]), target_row("C"))
    out = by_id(V.membrane_simple(t, ["SL-M"]))
    assert [(one(out[k])["IsinMembrane"], one(out[k])["Nr_mb"]) for k in "ABC"] == [("Yes", 1), (None, None), (None, None)]


def test_approved_drugs_lists_aligned(spark):
    mol = spark.createDataFrame(
        [("D2", True, 4, (["A"],), None), ("D1", True, 4, (["A", "A"],), None), ("D3", False, 4, (["A"],), None),
         ("D4", True, 4, (["B"],), None)], MOL_SCHEMA)
    mech = spark.createDataFrame([("INHIBITOR", ["D1"]), ("AGONIST", ["D2", "D1"])], "actionType string, chemblIds array<string>")
    out = by_id(V.approved_drugs(mol, mech, queryset(spark, "A", "B", "Z")))
    a = one(out["A"])
    assert (a["App_drug_ChEMBL"], a["App_drug_actionType"], a["Nr_drug"]) == (["D1", "D2"], ["AGONIST", "AGONIST"], 1)
    b = one(out["B"])  # approved drug without mechanism: flagged, not listed
    assert (b["App_drug_ChEMBL"], b["Nr_drug"]) == ([], 1)
    assert one(out["Z"])["Nr_drug"] is None


def test_probe_moa_counts(spark):
    t = target_df(
        spark,
        target_row("A", chemicalProbes=[(True, "m1", [("u",), ("v",)]), (True, "m1", [("w",)]), (True, None, [("u",)]),
                                        (False, "m2", [("u",)]), (True, "m3", [])]),
        target_row("B", chemicalProbes=[(True, None, [("u",)])]),
    )
    out = by_id(V.probe_moa_counts(t))
    assert (one(out["A"])["ChemicalProbes_HC"], one(out["A"])["Nr_chprob"]) == (["m1:3"], 1)
    assert (one(out["B"])["ChemicalProbes_HC"], one(out["B"])["Nr_chprob"]) == (None, None)


def test_constraint_bands(spark):
    t = target_df(spark, target_row("A", constraint=[("lof", 9456), ("lof", 9456 + 19196), ("lof", 0)]))
    got = sorted((r["cal_score"], r["selection"]) for r in V.constraint_bands(t).collect())
    assert got == [((0 - 9456) / 19196, "-1"), (0.0, "0"), (1.0, "1")]


def test_mouse_models_flag(spark):
    m = spark.createDataFrame([("A", [("MP:1", "a")]), ("B", [("MP:1", None)])],
                              "targetFromSourceId string, modelPhenotypeClasses array<struct<id:string,label:string>>")
    out = by_id(V.mouse_models_flag(m, queryset(spark, "A", "B", "Z")))
    assert [one(out[k])["Nr_Mousemodels"] for k in "ABZ"] == [1, None, None]


# --- hierarchy ------------------------------------------------------------
TERMS = [
    ("Cell membrane", "SL-0039", "SL-0162; membrane", None),
    ("Apical cell membrane", "SL-0015", "SL-0039; cell membrane", "SL-0039; x"),
    ("Basal cell membrane", "SL-0024", "SL-0039; cell membrane, SL-0162; y", None),
    ("Cell tip membrane", "SL-0500", None, "SL-0039; whole, SL-0024; whole"),
    ("Secreted", "SL-0243", None, None),
]


def _terms(spark):
    return spark.createDataFrame(TERMS, "`Name` string, `Subcellular location ID` string, `Is a` string, `Is part of` string")


def test_hierarchy_levels(spark):
    ex = H.explode_multivalue(_terms(spark))
    rows = {(r["SubcellID"], r["Is_a"], r["Is_part"]) for r in ex.collect()}
    assert ("SL-0024", "SL-0162", None) in rows  # trimmed item after the comma
    assert ("SL-0500", None, "SL-0024") in rows and ("SL-0243", None, None) in rows
    ch = {r["Is_a"]: r["children"] for r in H.children(ex).collect()}
    assert ch["SL-0039"] == ["SL-0015", "SL-0024"] and ch["SL-0162"] == ["SL-0024", "SL-0039"]
    mb = {r["Is_part"]: r["members"] for r in H.part_members(ex).collect()}
    assert mb["SL-0039"] == ["SL-0015", "SL-0500"]
    terms = sorted(r["term"] for r in H.terms_for_name(ex, "Cell membrane").collect())
    assert terms == ["SL-0015", "SL-0024", "SL-0039", "SL-0500"]  # one level: children and members


def test_hierarchy_feeds_location_profile(spark):
    ex = H.explode_multivalue(_terms(spark))
    mem, sec = H.terms_for_name(ex, "Cell membrane"), H.terms_for_name(ex, "Secreted")
    t = target_df(spark, target_row("A", subcellularLocations=[loc("x", "HPA_main", "SL-0500")]),
                  target_row("B", subcellularLocations=[loc("x", "uniprot", "SL-0243")]),
                  target_row("C", subcellularLocations=[loc("x", "HPA_main", "SL-9999")]))
    out = by_id(P.location_profile(t, mem, sec))
    assert [one(out[k])["loc"] for k in "ABC"] == ["inMembrane", "onlySecreted", "noMembraneHPA"]


# --- network ----------------------------------------------------------------
def _network(spark):
    mol = spark.createDataFrame(
        [("D1", True, 2, (["B", "B"],), (["DIS1"],)), ("D2", True, 3, (["C"],), (["DIS2", "DIS9"],)),
         ("D3", True, 1, None, None)], MOL_SCHEMA)
    inter = spark.createDataFrame(
        [("intact", "A", "B", 0.9), ("intact", "A", "B", 0.5), ("intact", "A", "C", 0.42), ("string", "A", "C", 0.9),
         ("intact", "A", "C", 0.43), ("intact", "E", "Q", 0.99)],
        "sourceDatabase string, targetA string, targetB string, scoring double")
    dis = spark.createDataFrame([("DIS1", ["TA1", "TA2"]), ("DIS2", [])], "id string, therapeuticAreas array<string>")
    return mol, inter, dis


def test_tractability_true(spark):
    t = target_df(spark, target_row("A", tractability=[("b", True), ("a", True), ("c", False)]),
                  target_row("B", tractability=[("a", False)]))
    out = by_id(N.tractability_true(t))
    assert [tuple(x) for x in one(out["A"])["drug"]] == [("a", True), ("b", True)]
    assert one(out["B"])["drug"] is None


def test_partner_drugs_and_names(spark):
    mol, inter, _ = _network(spark)
    out = by_id(N.partner_drugs(mol, inter, queryset(spark, "A", "Z")))
    assert sorted((r["targetB"], tuple(r["CHEMBL"] or ())) for r in out["A"]) == [("B", ("D1", "D1")), ("C", ("D2",))]
    assert [(r["targetB"], r["CHEMBL"]) for r in out["Z"]] == [(None, None)]
    t = target_df(spark, target_row("B", approvedSymbol="SYMB"))
    names = by_id(N.partner_names(mol, inter, queryset(spark, "A"), t))
    assert sorted((r["targetB"], r["Symbol_targetB"]) for r in names["A"]) == [("B", "SYMB"), ("C", None)]


def test_drug_disease_area_keeps_repeats(spark):
    mol, inter, dis = _network(spark)
    rows = sorted(tuple(r) for r in N.drug_disease_area(mol, inter, dis, queryset(spark, "A", "Z")).collect())
    d1 = [r for r in rows if r[0] == "D1"]
    assert sorted(d1) == sorted([("D1", "DIS1", "TA1", "A"), ("D1", "DIS1", "TA2", "A")] * 2)
    assert sorted(r for r in rows if r[0] == "D2") == [("D2", "DIS2", None, "A"), ("D2", "DIS9", None, "A")]


def test_pairs_targets_and_matches(spark):
    mol, inter, dis = _network(spark)
    pairs = spark.createDataFrame([("symA", "DIS1, DIS2", "TA1,TA3"), ("symZ", "DIS1", None)],
                                  "hgnc_protein string, EFO_disease string, Therapy_area string")
    smap = spark.createDataFrame([("symA", "A")], "symbol string, id string")
    n6 = N.pairs_from_csv(pairs, smap)
    assert sorted(tuple(r) for r in n6.collect()) == [("A", "TA1", "DIS1"), ("A", "TA1", "DIS2"), ("A", "TA3", "DIS1"), ("A", "TA3", "DIS2")]
    n8 = N.target_drug_pairs(n6, mol, inter, queryset(spark, "A"))
    assert n8.count() == 4 * 3  # two D1 links through B, one D2 link through C
    n9 = N.matched_triples(n6, mol, inter, dis, queryset(spark, "A"))
    assert sorted(tuple(r) for r in n9.collect()) == [("A", "D1", "TA1", "TA1")]
    assert [tuple(r) for r in N.matched_drugs(n9).collect()] == [("A", ["D1"])]


def test_disease_areas_outer(spark):
    _, _, dis = _network(spark)
    assert sorted(tuple(r) for r in N.disease_areas(dis).collect()) == [("DIS1", "TA1"), ("DIS1", "TA2"), ("DIS2", None)]


# --- reports ---------------------------------------------------------------
def test_nest_and_unpivot(spark):
    wide = spark.createDataFrame([("A", 1, None, 0.5), ("B", None, None, None)], "targetid string, x int, y double, z double")
    nested = {r["targetid"]: [tuple(p) for p in r["prioritisations"]] for r in R.nest_report(wide).collect()}
    assert nested == {"A": [("x", 1.0), ("z", 0.5)], "B": []}
    long = sorted(tuple(r) for r in R.unpivot_report(wide).collect())
    assert len(long) == 6 and ("A", "y", None) in long and ("A", "x", 1.0) in long
    plan = R.nest_report(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_one_pass_report_equals_operator_chain(spark):
    """Metamorphic: the one-pass report has the same rows as chaining the
    individual operators by joins on the query set."""
    import os

    from entiscore.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        return
    args = (fx.target(spark, d), fx.gene_essentiality(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d),
            fx.tissue_atlas(spark, d), fx.mouse_phenotypes(spark, d), fx.phenotype_scores(spark, d), ["SL-0039"], ["SL-0243"])
    a = sorted(map(repr, map(tuple, R.priority_report(*args).collect())))
    b = sorted(map(repr, map(tuple, C.priority_report_chained(*args).collect())))
    assert a == b and len(a) > 0


def test_entity_reader_prunes_nested_fields(spark, tmp_path):
    import contextlib
    import io as _io

    from frames import hom
    from entiscore.sources import io as sio

    t = target_df(spark, target_row("A", homologues=[hom("other_paralog", "Human", 70.0)]))
    t.write.mode("overwrite").parquet(str(tmp_path / "t"))
    pruned = sio.scan_entities(spark, str(tmp_path / "t"))
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        P.paralog_ramp(pruned).explain("formatted")
    schema_lines = [line for line in buf.getvalue().splitlines() if "ReadSchema" in line]
    assert schema_lines and all("targetGeneid" not in line for line in schema_lines)
    assert [r["Nr_paralogs"] for r in P.paralog_ramp(pruned).collect()] == [-0.25]


def test_one_pass_v1_and_prototype_reports_equal_chains(spark):
    import os

    from entiscore.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        return
    t, mouse, mol, atlas = fx.target(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d), fx.tissue_atlas(spark, d)
    v1 = R.priority_report_v1(t, mouse, mol, atlas, ["SL-0039"], ["SL-0243"])
    v1_chain = C.priority_report_chained(t, None, mouse, mol, atlas, None, None, ["SL-0039"], ["SL-0243"],
                                         columns=R.REPORT_COLUMNS_V1)
    assert sorted(map(repr, map(tuple, v1.collect()))) == sorted(map(repr, map(tuple, v1_chain.collect())))
    mech, q = fx.mechanism_of_action(spark, d), P.query_set(t)
    proto = R.prototype_report(t, mol, mech, mouse, ["SL-0039"], q)
    proto_chain = C.prototype_report_chained(t, mol, mech, mouse, ["SL-0039"], q)
    assert sorted(map(repr, map(tuple, proto.collect()))) == sorted(map(repr, map(tuple, proto_chain.collect())))


def test_threaded_chain_like_the_reference_equals_one_pass(spark):
    """Each operator takes the previous operator's whole output as its query
    set (the reference's usage pattern); the selected columns equal R1."""
    import os

    from entiscore.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        return
    t, ge, mouse, mol = fx.target(spark, d), fx.gene_essentiality(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d)
    atlas, scores = fx.tissue_atlas(spark, d), fx.phenotype_scores(spark, d)
    out = P.biotype(t, P.query_set(t))
    out = P.location_profile(t, ["SL-0039"], ["SL-0243"], out)
    for step in (P.tractability_pivot, P.safety_events, P.constraint_minmax, P.paralog_ramp, P.ortholog_ramp,
                 P.driver_flag):
        out = step(t, out)
    out = P.essentiality(ge, out)
    out = P.tep_flag(t, out)
    out = P.mouse_models(mouse, out)
    out = P.chemical_probes(t, out)
    out = P.clinical_phase(mol, out)
    out = P.tissue_scores(atlas, out)
    out = P.phenotype_harmonic(mouse, scores, out)
    from pyspark.sql import functions as F
    threaded = out.select("targetid", *[F.col(s).alias(n) for s, n in R.REPORT_COLUMNS])
    one_pass = R.priority_report(t, ge, mouse, mol, atlas, mouse, scores, ["SL-0039"], ["SL-0243"])
    assert sorted(map(repr, map(tuple, threaded.collect()))) == sorted(map(repr, map(tuple, one_pass.collect())))


def test_one_pass_report_with_explicit_queryset_duplicates_and_absent_ids(spark):
    import os

    from entiscore.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        return
    q = queryset(spark, "P1", "P1", "P5", "P7", "NOT_AN_ENTITY", "NOT_AN_ENTITY")
    args = (fx.target(spark, d), fx.gene_essentiality(spark, d), fx.mouse_phenotypes(spark, d), fx.molecule(spark, d),
            fx.tissue_atlas(spark, d), fx.mouse_phenotypes(spark, d), fx.phenotype_scores(spark, d), ["SL-0039"], ["SL-0243"])
    one = sorted(map(repr, map(tuple, R.priority_report(*args, queryset=q).collect())))
    chain = sorted(map(repr, map(tuple, C.priority_report_chained(*args, queryset=q).collect())))
    assert one == chain
    absent = [r for r in R.priority_report(*args, queryset=q).collect() if r["targetid"] == "NOT_AN_ENTITY"]
    assert len(absent) == 2 and all(r["isSecreted"] == 0 and r["hasPocket"] is None for r in absent)


def test_probe_counts_with_null_urls_do_not_depend_on_ansi_mode(spark):
    t = target_df(spark, target_row("A", chemicalProbes=[(True, "m", [("u1",), ("u2",)]), (True, "m", None), (True, "n", None)]))
    old = spark.conf.get("spark.sql.ansi.enabled")
    got = []
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            got.append([tuple(r) for r in V.probe_moa_counts(t).collect()])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert all(g == [("A", ["m:2"], 1)] for g in got)
