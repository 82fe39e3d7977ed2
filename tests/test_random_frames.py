"""Randomised entity rows (nulls at every level, boundary values) checked
against a plain-Python statement of each operator's semantics."""

import random

import pytest
from frames import target_df, target_row

from entiscore.operators import properties as P
from entiscore.operators import prototype as V

SEEDS = [11, 23, 47]
MEM, SEC = ["SL-M", "SL-B"], ["SL-S", "SL-B"]


def maybe(rnd, v, p=0.15):
    return None if rnd.random() < p else v


def rand_list(rnd, make, k=5):
    r = rnd.random()
    if r < 0.15:
        return None
    if r < 0.3:
        return []
    return [None if rnd.random() < 0.05 else make() for _ in range(rnd.randint(1, k))]


def random_rows(seed, n=250):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(target_row(
            f"T{i}",
            biotype=maybe(rnd, rnd.choice(["protein_coding", "", "lncRNA"])),
            subcellularLocations=rand_list(rnd, lambda: (
                maybe(rnd, "loc"), maybe(rnd, rnd.choice(["HPA_main", "HPA_additional", "HPA_extracellular_location", "uniprot", "other"])),
                maybe(rnd, rnd.choice(["SL-M", "SL-S", "SL-B", "SL-X"])))),
            tractability=rand_list(rnd, lambda: (
                maybe(rnd, rnd.choice(["High-Quality Ligand", "High-Quality Pocket", "Small Molecule Binder", "Approved Drug"])),
                maybe(rnd, rnd.random() < 0.5))),
            safetyLiabilities=rand_list(rnd, lambda: (maybe(rnd, rnd.choice(["E1", "E2", "E3"])),)),
            homologues=rand_list(rnd, lambda: (
                maybe(rnd, rnd.choice(["ortholog_one2one", "ortholog_one2many", "within_species_paralog", "other_paralog",
                                       "x_paralog", "paralog", "another_thing"])),
                maybe(rnd, rnd.choice(["Mouse", "Rat"])), None, None,
                maybe(rnd, float(rnd.choice([40, 59, 60, 61, 79, 80, 81, 99, 100]))))),
            hallmarks=maybe(rnd, (rand_list(rnd, lambda: (maybe(rnd, rnd.choice(["TSG", "oncogene", "Oncogene", "fusion", "oncogene,TSG", "tsg"])),)),)),
            tep=maybe(rnd, (maybe(rnd, rnd.choice(["null", "text"])),)),
            chemicalProbes=rand_list(rnd, lambda: (
                maybe(rnd, rnd.random() < 0.5), maybe(rnd, rnd.choice(["m1", "m2"])),
                rand_list(rnd, lambda: ("u",), 3))),
        ))
    return rows


def _field(row, name):
    from frames import FIELDS
    return row[FIELDS.index(name)]


# --- plain-Python statements of the semantics -----------------------------
def py_paralog(h):
    def kept(x):
        if x is None or x[0] is None:
            return False
        tok = x[0].split("_")[0].replace("other", "paralog_other").replace("within", "paralog_intrasp")
        return "paralog" in tok
    vals = [x[4] for x in (h or []) if kept(x) and x[4] is not None]
    if not vals:
        return None
    mx = max(vals)
    return 0.0 if mx < 60 else -((mx - 60) / 40) + 0.0


def py_ortholog(h):
    vals = [x[4] for x in (h or []) if x is not None and x[0] is not None and "ortholog" in x[0].split("_")[0]
            and x[1] == "Mouse" and x[4] is not None]
    if not vals:
        return None
    mx = max(vals)
    return 0.0 if mx < 80 else (mx - 80) / 20 + 0.0


def py_tract(t):
    cats = ["High-Quality Ligand", "High-Quality Pocket", "Small Molecule Binder"]
    els = [x for x in (t or []) if x is not None and x[0] in cats]
    if not els:
        return (None, None, None)
    return tuple(1 if sum(1 for x in els if x[0] == c and x[1]) == 1 else 0 for c in cats)


def py_safety(s):
    info = "conInfo" if s else "noReported"
    ev = [x[0] for x in (s or []) if x is not None and x[0] is not None]
    has = "Yes" if ev and info == "conInfo" else None
    return (info, len(ev), sorted(set(ev)), has, -1 if has else None)


def py_driver(h):
    lst = {"TSG", "oncogene", "Oncogene", "oncogene,TSG", "TSG,oncogene", "fusion,oncogene", "oncogene,fusion"}
    attrs = (h[0] if h is not None else None) or []
    return -1 if any(a is not None and a[0] in lst for a in attrs) else None


def py_probe(p):
    vals = [1 if x[0] else 0 for x in (p or []) if x is not None and x[0] is not None]
    return max(vals) if vals else None


def py_tep(t):
    d = t[0] if t is not None else None
    return ("Yes", 1) if d is not None and d != "null" else ("No", None)


def py_moa(p):
    counts = {}
    for x in p or []:
        if x is not None and x[0] and x[1] is not None:
            counts[x[1]] = counts.get(x[1], 0) + len(x[2] or [])
    lst = sorted(f"{m}:{c}" for m, c in counts.items() if c > 0)
    return lst or None


def py_location(locs):
    labels = set()
    for x in locs or []:
        if x is None:
            continue
        loc, src, term = x
        in_m = None if term is None else term in MEM
        if src == "HPA_main" and in_m:
            labels.add("HPA_1")
        elif src == "HPA_main" and in_m is False:
            labels.add("HPA_dif")
        elif src == "HPA_extracellular_location":
            labels.add("HPA_secreted")
        elif src == "HPA_additional" and in_m:
            labels.add("HPA_add_1")
        elif src == "HPA_additional" and in_m is False:
            labels.add("HPA_dif")
        elif src == "uniprot" and in_m:
            labels.add("uniprot_1")
        elif src == "uniprot" and term is not None and term in SEC:
            labels.add("uniprot_secreted")
    cls = None
    if labels:
        hm = "yes" if {"HPA_1", "HPA_add_1"} & labels else ("dif" if "HPA_dif" in labels else "no")
        hs = "yes" if "HPA_secreted" in labels else "no"
        um = "yes" if "uniprot_1" in labels else "no"
        us = "yes" if "uniprot_secreted" in labels else "no"
        if hm == "yes" and hs == "no":
            cls = "inMembrane"
        elif hm in ("no", "dif") and hs == "yes":
            cls = "onlySecreted"
        elif hm == "yes" and hs == "yes":
            cls = "secreted&inMembrane"
        elif hm == "no" and hs == "no":
            cls = {("yes", "no"): "inMembrane", ("no", "yes"): "onlySecreted", ("yes", "yes"): "secreted&inMembrane"}.get((um, us))
        elif hm == "dif":
            cls = "noMembraneHPA"
    results = set()
    for x in (locs or [None]):
        results.add("noInfo" if x is None or x[0] is None else "hasInfo")
    out = []
    for r in sorted(results):
        nr_mb = 1 if cls in ("secreted&inMembrane", "inMembrane") else (0 if cls is not None else (0 if r == "hasInfo" else None))
        if cls in ("secreted&inMembrane", "onlySecreted"):
            nr_sec = 1
        elif cls is not None and r == "hasInfo":
            nr_sec = 0
        elif r == "noInfo":
            nr_sec = None
        else:
            nr_sec = 0
        out.append((cls, r, nr_mb, nr_sec))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_same_row_operators_against_python(spark, seed):
    rows = random_rows(seed)
    t = target_df(spark, *rows)
    by = {r[0]: r for r in rows}

    def got(df, *cols):
        return {r["targetid"]: tuple(r[c] for c in cols) for r in df.collect()}

    par = got(P.paralog_ramp(t), "Nr_paralogs")
    ort = got(P.ortholog_ramp(t), "Nr_ortholog")
    tra = got(P.tractability_pivot(t), "Nr_Ligand", "Nr_Pocket", "Nr_sMBinder")
    saf = got(P.safety_events(t), "info", "nEvents", "events", "hasSafetyEvent", "Nr_Event")
    drv = got(P.driver_flag(t), "Nr_CDG")
    prb = got(P.chemical_probes(t), "Nr_chprob")
    tep = got(P.tep_flag(t), "hasTEP", "Nr_TEP")
    moa = got(V.probe_moa_counts(t), "ChemicalProbes_HC")
    loc = {}
    for r in P.location_profile(t, MEM, SEC).collect():
        loc.setdefault(r["targetid"], []).append((r["loc"], r["result"], r["Nr_mb"], r["Nr_secreted"]))
    for k, row in by.items():
        h = _field(row, "homologues")
        assert par[k] == (py_paralog(h),), k
        assert ort[k] == (py_ortholog(h),), k
        assert tra[k] == py_tract(_field(row, "tractability")), k
        s = saf[k]
        assert (s[0], s[1], list(s[2]), s[3], s[4]) == py_safety(_field(row, "safetyLiabilities")), k
        assert drv[k] == (py_driver(_field(row, "hallmarks")),), k
        assert prb[k] == (py_probe(_field(row, "chemicalProbes")),), k
        assert tep[k] == py_tep(_field(row, "tep")), k
        assert moa[k] == (py_moa(_field(row, "chemicalProbes")),), k
        assert sorted(loc[k], key=repr) == py_location(_field(row, "subcellularLocations")), k


MOL_SCHEMA = ("id string, isApproved boolean, maximumClinicalTrialPhase int, linkedTargets struct<rows:array<string>>, "
              "linkedDiseases struct<rows:array<string>>")


@pytest.mark.parametrize("seed", SEEDS)
def test_cross_table_operators_against_python(spark, seed):
    from frames import queryset

    from entiscore.operators import network as N

    rnd = random.Random(seed)
    ids = [f"T{i}" for i in range(40)]
    mouse_rows = [(maybe(rnd, rnd.choice(ids), 0.05),
                   rand_list(rnd, lambda: (f"MP:{rnd.randint(0, 9)}", maybe(rnd, f"lbl{rnd.randint(0, 5)}")), 6))
                  for _ in range(120)]
    mouse = spark.createDataFrame(mouse_rows, "targetFromSourceId string, modelPhenotypeClasses array<struct<id:string,label:string>>")
    mols = [(f"D{i}", maybe(rnd, rnd.random() < 0.6, 0.1), maybe(rnd, rnd.randint(-1, 4)),
             maybe(rnd, (rand_list(rnd, lambda: rnd.choice(ids), 4),)), None) for i in range(150)]
    mol = spark.createDataFrame(mols, MOL_SCHEMA)
    mech = spark.createDataFrame([(rnd.choice(["A", "B", "C", None]), [f"D{rnd.randint(0, 160)}" for _ in range(2)])
                                  for _ in range(60)], "actionType string, chemblIds array<string>")
    q = queryset(spark, *ids, "ABSENT")

    # Non-null label count and distinct labels over exploded classes
    counts, labels = {}, {}
    for tid, classes in mouse_rows:
        if tid is None or not classes:
            continue
        for c in classes:
            counts.setdefault(tid, 0)
            labels.setdefault(tid, set())
            if c is not None and c[1] is not None:
                counts[tid] += 1
                labels[tid].add(c[1])
    got = {r["targetid"]: (r["Nr_mouse_models"], r["Different_PhenoClasses"], r["hasMouseKO"], r["Nr_Mousemodels"])
           for r in P.mouse_models(mouse, q).collect()}
    for t in ids + ["ABSENT"]:
        if t in counts:
            n = counts[t]
            assert got[t] == (n, sorted(labels[t]), "Yes" if n else "0", 1 if n else 0), t
        else:
            assert got[t] == (None, None, None, None), t
    v6 = {r["targetid"]: r["Nr_Mousemodels"] for r in V.mouse_models_flag(mouse, q).collect()}
    assert all(v6[t] == (1 if counts.get(t) else None) for t in ids)

    # Highest phase over linked drugs; N2: drug lists with repeats
    phase, lists = {}, {}
    for d, _, ph, lt, _ in mols:
        for t in ((lt or (None,))[0] or []):
            if t is None:
                continue
            lists.setdefault(t, []).append(d)
            cur = phase.get(t)
            phase[t] = ph if cur is None else (cur if ph is None else max(cur, ph))
    got14 = {r["targetid"]: (r["maxClinTrialPhase"], r["inClinicalTrials"]) for r in P.clinical_phase(mol, q).collect()}
    for t in ids:
        ph = phase.get(t)
        assert got14[t] == (ph, ph / 4 if ph is not None and ph >= 0 else None), t
    got2 = {r["target"]: r["CHEMBL"] for r in N.drugs_per_target(mol).collect()}
    assert got2 == {t: sorted(v) for t, v in lists.items()}

    # V3: approved drugs with a mechanism record, min action type per drug
    actions = {}
    for act, chembls in mech.collect():
        for c in chembls:
            cur = actions.get(c)
            actions[c] = act if cur is None else (cur if act is None else min(cur, act))
    approved = {}
    for d, ok, _, lt, _ in mols:
        if ok:
            for t in ((lt or (None,))[0] or []):
                if t is not None:
                    approved.setdefault(t, set()).add(d)
    got3 = {r["targetid"]: (r["App_drug_ChEMBL"], r["App_drug_actionType"], r["Nr_drug"])
            for r in V.approved_drugs(mol, mech, q).collect()}
    for t in ids:
        if t not in approved:
            assert got3[t] == (None, None, None), t
            continue
        drugs = sorted(d for d in approved[t] if d in actions)
        acts = [actions[d] for d in drugs if actions[d] is not None]
        assert got3[t] == (drugs, acts, 1), t


@pytest.mark.parametrize("seed", SEEDS)
def test_hierarchy_against_python(spark, seed):
    from entiscore.operators import hierarchy as H

    rnd = random.Random(seed)
    ids = [f"SL-{i}" for i in range(30)]

    def items(k):
        r = rnd.random()
        if r < 0.2:
            return None
        parts = [f"{' ' if rnd.random() < 0.3 else ''}{rnd.choice(ids)}; note{';x' if rnd.random() < 0.2 else ''}"
                 for _ in range(rnd.randint(1, k))]
        return ",".join(parts)

    rows = [(f"name{i % 25}", ids[i], items(2), items(3)) for i in range(30)]
    terms = spark.createDataFrame(rows, "`Name` string, `Subcellular location ID` string, `Is a` string, `Is part of` string")

    def split(v):
        return [None] if v is None else [x.split(";")[0].strip() for x in v.split(",")]

    ex = [(n, i, a, b) for n, i, ia, ip in rows for a in split(ia) for b in split(ip)]
    got_ex = sorted(map(tuple, H.explode_multivalue(terms).collect()), key=repr)
    assert got_ex == sorted(ex, key=repr)

    parents = {(n, i, a) for n, i, a, _ in ex}
    kids = {}
    for i, a in {(i, a) for _, i, a, _ in ex}:
        kids.setdefault(a, set()).add(i)
    members = {}
    for _, i, _, b in ex:
        members.setdefault(b, []).append(i)
    want = {}
    for n, i, a in parents:
        ch = sorted(kids[i]) if i in kids else None
        mb = sorted(members[i]) if i in members else None
        want[(n, i, a)] = (ch, mb, [i] + (ch or []) + (mb or []))
    got = {(r["Name"], r["SubcellID"], r["Is_a"]): (r["children"], r["members"], r["toSearch"])
           for r in H.term_search_set(H.explode_multivalue(terms)).collect()}
    assert got == want
    name = rows[0][0]
    want_terms = sorted({t for (n, _, _), (_, _, ts) in want.items() if n == name for t in ts})
    assert sorted(r["term"] for r in H.terms_for_name(H.explode_multivalue(terms), name).collect()) == want_terms
