"""DuckDB oracle SQL for every catalog query.

Each oracle reads the *flat* stand-in rows (the FIXTURES.md views over the
driver tables) and computes the operator's result with plain SQL joins and
aggregates, independent of the nested Spark logic. Column names match the
Spark output exactly.
"""

from __future__ import annotations

from entiscore.sources.fixtures import FLAT_VIEWS, view_sql

MEMBRANE = "(SELECT term FROM mterms)"
SECRETED = "(SELECT term FROM sterms)"
DRIVER = "('TSG', 'oncogene', 'Oncogene', 'oncogene,TSG', 'TSG,oncogene', 'fusion,oncogene', 'oncogene,fusion')"


def _with(body: str, *ctes: str) -> str:
    """Prefix ``body`` with every flat view it names plus extra CTEs."""
    views = [v for v in FLAT_VIEWS if v == "f_query" or v in body or any(v in c for c in ctes)]
    parts = [f"{v} AS ({view_sql(v)})" for v in views]
    parts.append("q AS (SELECT targetid FROM f_query)")
    parts.extend(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


D = "CAST({} AS DOUBLE)"

# --- reusable CTEs ---------------------------------------------------------
H1_CTES = (
    "ta AS (SELECT Name, term_id, unnest(coalesce(string_split(is_a, ','), CAST([NULL] AS VARCHAR[]))) AS ia, part_of FROM f_term)",
    "tb AS (SELECT Name, term_id, ia, unnest(coalesce(string_split(part_of, ','), CAST([NULL] AS VARCHAR[]))) AS ip FROM ta)",
    "h1 AS (SELECT Name, term_id AS SubcellID, trim(split_part(ia, ';', 1)) AS Is_a, trim(split_part(ip, ';', 1)) AS Is_part FROM tb)",
    "h2 AS (SELECT DISTINCT Name, SubcellID, Is_a FROM h1)",
    "h3 AS (SELECT Is_a, list_sort(list(SubcellID)) AS children FROM (SELECT DISTINCT SubcellID, Is_a FROM h1) GROUP BY Is_a)",
    "h4 AS (SELECT Is_part, list_sort(list(SubcellID)) AS members FROM h1 GROUP BY Is_part)",
    """h5 AS (SELECT h2.Name, h2.SubcellID, h2.Is_a, h3.children, h4.members,
        list_concat([h2.SubcellID], coalesce(h3.children, CAST([] AS VARCHAR[])), coalesce(h4.members, CAST([] AS VARCHAR[]))) AS toSearch
        FROM h2 LEFT JOIN h3 ON h3.Is_a = h2.SubcellID LEFT JOIN h4 ON h4.Is_part = h2.SubcellID)""",
)

def _term_set(cte: str, name: str) -> str:
    one = f"(SELECT term_id FROM f_term WHERE Name = '{name}')"
    return f"{cte} AS (SELECT term_id AS term FROM f_term WHERE Name = '{name}' UNION SELECT SubcellID FROM h1 WHERE Is_a IN {one} OR Is_part IN {one})"


TERM_CTES = (*H1_CTES[:3], _term_set("mterms", "Supplier#000000001"), _term_set("sterms", "Supplier#000000002"))
LOC_CTES = (
    *TERM_CTES,
    f"""lr AS (SELECT id, source, source LIKE 'HPA%' AND source <> 'HPA_extracellular_location' AS by_hpa,
        termSL IN {MEMBRANE} AS m, termSL IN {SECRETED} AS s FROM f_location)""",
    """ev AS (SELECT t.id,
        count(*) FILTER (WHERE by_hpa AND m) > 0 AS hpa_membrane, count(*) FILTER (WHERE by_hpa AND NOT m) > 0 AS hpa_other,
        count(*) FILTER (WHERE source = 'HPA_extracellular_location') > 0 AS hpa_secreted,
        count(*) FILTER (WHERE source = 'uniprot' AND m) > 0 AS uniprot_membrane,
        count(*) FILTER (WHERE source = 'uniprot' AND s AND NOT m) > 0 AS uniprot_secreted
        FROM f_target t LEFT JOIN lr ON lr.id = t.id GROUP BY t.id)""",
    "kinds (code, loc) AS (VALUES (1, 'onlySecreted'), (2, 'inMembrane'), (3, 'secreted&inMembrane'), (9, 'noMembraneHPA'))",
    """coded AS (SELECT *, 2 * CAST(hpa_membrane AS INTEGER) + CAST(hpa_secreted AS INTEGER) AS by_h,
        2 * CAST(uniprot_membrane AS INTEGER) + CAST(uniprot_secreted AS INTEGER) AS by_u FROM ev)""",
    """cls AS (SELECT coded.*, kinds.loc FROM coded LEFT JOIN kinds
        ON kinds.code = CASE WHEN by_h > 0 THEN by_h WHEN hpa_other THEN 9 ELSE by_u END)""",
    """info AS (SELECT DISTINCT t.id, CASE WHEN l.location IS NOT NULL THEN 'hasInfo' ELSE 'noInfo' END AS result
        FROM f_target t LEFT JOIN f_location l ON l.id = t.id)""",
)

NR_MB = "CASE WHEN contains(loc, 'inMembrane') THEN 1 WHEN loc IS NULL AND result IS DISTINCT FROM 'hasInfo' THEN NULL ELSE 0 END"
NR_SECRETED = "CASE WHEN lower(loc) LIKE '%secreted%' THEN 1 WHEN result IS DISTINCT FROM 'noInfo' THEN 0 END"

TRACT_CTE = """tr AS (SELECT id,
    sum(CASE WHEN category = 'High-Quality Ligand' THEN CAST(value AS INTEGER) END) AS s_l,
    sum(CASE WHEN category = 'High-Quality Pocket' THEN CAST(value AS INTEGER) END) AS s_p,
    sum(CASE WHEN category = 'Small Molecule Binder' THEN CAST(value AS INTEGER) END) AS s_b
    FROM f_tractability WHERE category IN ('High-Quality Ligand', 'High-Quality Pocket', 'Small Molecule Binder') GROUP BY id)"""
TRACT_NR = """tn AS (SELECT id, CAST(coalesce(s_l, 0) AS BIGINT) AS sum_Ligand, CAST(coalesce(s_p, 0) AS BIGINT) AS sum_Pocket,
    CAST(coalesce(s_b, 0) AS BIGINT) AS sum_sMBinder, CASE WHEN s_l = 1 THEN 1 ELSE 0 END AS Nr_Ligand, CASE WHEN s_p = 1 THEN 1 ELSE 0 END AS Nr_Pocket,
    CASE WHEN s_b = 1 THEN 1 ELSE 0 END AS Nr_sMBinder FROM tr)"""

SAFETY_CTE = """sf AS (SELECT id, count(event) AS nEvents, list_sort(list_distinct(list(event))) AS events FROM f_safety GROUP BY id)"""
SAFETY_MEASURES = """sm AS (SELECT t.id,
    CASE WHEN sf.id IS NOT NULL THEN 'conInfo' ELSE 'noReported' END AS info,
    coalesce(sf.nEvents, 0) AS nEvents,
    coalesce(sf.events, CAST([] AS VARCHAR[])) AS events,
    CASE WHEN sf.nEvents > 0 THEN 'Yes' END AS hasSafetyEvent,
    CASE WHEN sf.nEvents > 0 THEN -1 END AS Nr_Event
    FROM f_target t LEFT JOIN sf ON sf.id = t.id)"""

CONSTRAINT_CTES = (
    "lof AS (SELECT id, constraintType, upperRank FROM f_constraint WHERE constraintType = 'lof')",
    "st AS (SELECT min(upperRank) AS mn, max(upperRank) AS mx FROM lof)",
    "cs AS (SELECT lof.id, 2 * ((lof.upperRank - st.mn) / (st.mx - st.mn)) - 1 AS cal_score FROM lof CROSS JOIN st)",
)

PARALOG_CTE = """par AS (SELECT id, max(queryPercentageIdentity) AS mx FROM f_homologue
    WHERE replace(replace(split_part(homologyType, '_', 1), 'other', 'paralog_other'), 'within', 'paralog_intrasp') LIKE '%paralog%'
    GROUP BY id)"""
ORTHOLOG_CTE = """ort AS (SELECT id, max(queryPercentageIdentity) AS mx FROM f_homologue
    WHERE split_part(homologyType, '_', 1) LIKE '%ortholog%' AND speciesName = 'Mouse' GROUP BY id)"""
PARALOG_NR = "CASE WHEN par.mx < 60 THEN CAST(0 AS DOUBLE) WHEN par.mx >= 60 THEN -((par.mx - 60) / 40) + 0.0 END"
ORTHOLOG_NR = "CASE WHEN ort.mx < 80 THEN CAST(0 AS DOUBLE) WHEN ort.mx >= 80 THEN (ort.mx - 80) / 20 + 0.0 END"

DRIVER_CTE = f"drv AS (SELECT DISTINCT id FROM f_hallmark WHERE description IN {DRIVER})"
PROBE_CTE = """prb AS (SELECT id, max(CASE WHEN isHighQuality THEN 1 WHEN NOT isHighQuality THEN 0 END) AS Nr_chprob
    FROM f_probe GROUP BY id)"""
MOUSE_CTE = """mm AS (SELECT id, count(label) AS Nr_mouse_models, list_sort(list_distinct(list(label))) AS Different_PhenoClasses
    FROM f_phenotype GROUP BY id)"""
PHASE_CTE = """ph AS (SELECT lt.target_id AS id, max(m.phase) AS mx FROM f_linked_target lt
    JOIN f_molecule m ON m.drug_id = lt.drug_id GROUP BY lt.target_id)"""
TISSUE_CTE = f"""ts AS (SELECT Ensembl AS id, specificity, distribution,
    CASE specificity WHEN 'Tissue enriched' THEN {D.format(1)} WHEN 'Group enriched' THEN {D.format(0.75)}
        WHEN 'Tissue enhanced' THEN {D.format(0.5)} WHEN 'Low tissue specificity' THEN {D.format(-1)} END AS Nr_specificity,
    CASE distribution WHEN 'Detected in single' THEN {D.format(1)} WHEN 'Detected in some' THEN {D.format(0.5)}
        WHEN 'Detected in many' THEN {D.format(0)} WHEN 'Detected in all' THEN {D.format(-1)} END AS Nr_distribution
    FROM f_atlas)"""
PHENO_CTES = (
    "psc AS (SELECT p.id, s.score FROM f_phenotype p LEFT JOIN f_score s ON s.class_id = p.class_id)",
    "prk AS (SELECT id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC) AS rn FROM psc WHERE score IS NOT NULL)",
    "phs AS (SELECT id, sum(score / (rn * rn)) AS hs, count(*) AS n FROM prk GROUP BY id)",
    "pall AS (SELECT DISTINCT p.id, coalesce(h.hs, 0) AS hs, coalesce(h.n, 0) AS n FROM f_phenotype p LEFT JOIN phs h ON h.id = p.id)",
    "gmx AS (SELECT sum(CAST(1 AS DOUBLE) / (k * k)) AS g FROM (SELECT unnest(range(1, max(n) + 1)) AS k FROM pall))",
    "phen AS (SELECT pall.id, round(-(pall.hs / gmx.g), 6) + 0.0 AS scaledHarmonicSum FROM pall CROSS JOIN gmx)",
)
EDGE_CTE = """e AS (SELECT DISTINCT q.targetid, i.targetA, i.targetB, i.sourceDatabase, i.scoring FROM q LEFT JOIN
    (SELECT targetA, targetB, sourceDatabase, max(scoring) AS scoring FROM f_interaction
     WHERE sourceDatabase = 'intact' AND scoring > 0.42 GROUP BY ALL) i ON i.targetA = q.targetid)"""
PAIR_CTE = """pr AS (SELECT lt.target_id AS target, lt.drug_id AS drug FROM f_linked_target lt
    JOIN f_molecule m ON m.drug_id = lt.drug_id WHERE lt.target_id IS NOT NULL)"""
N2_CTE = "n2 AS (SELECT target, list_sort(list(drug)) AS CHEMBL FROM pr GROUP BY target)"
AREA_CTE = "ar AS (SELECT id, area1 AS IndTherArea FROM f_disease UNION ALL SELECT id, area2 FROM f_disease)"
N5_CTE = """n5 AS (SELECT pr.drug, m.disease AS inddisease_name, ar.IndTherArea AS IndTherAreaDrug, e.targetid AS target
    FROM e JOIN pr ON pr.target = e.targetB LEFT JOIN f_molecule m ON m.drug_id = pr.drug LEFT JOIN ar ON ar.id = m.disease)"""
N6_CTES = (
    "pm AS (SELECT t.id, p.EFO_disease, p.Therapy_area FROM f_pair p LEFT JOIN f_symbol t ON t.symbol = p.symbol)",
    "pa AS (SELECT id, unnest(string_split(Therapy_area, ',')) AS th, EFO_disease FROM pm)",
    "pb AS (SELECT id, th, unnest(string_split(EFO_disease, ',')) AS dn FROM pa)",
    "n6 AS (SELECT id, trim(th) AS ind_disease_therapy, trim(dn) AS ind_disease_name FROM pb)",
)
N8_CTES = (
    "td AS (SELECT e.targetid AS target, pr.drug FROM e JOIN pr ON pr.target = e.targetB)",
    "n8 AS (SELECT n6.id, td.drug AS ChEMBL, n6.ind_disease_therapy, n6.ind_disease_name FROM n6 LEFT JOIN td ON td.target = n6.id)",
)
N9_CTE = """n9 AS (SELECT DISTINCT n8.id, n8.ChEMBL, n8.ind_disease_therapy, n5.IndTherAreaDrug FROM n8 JOIN n5
    ON n8.ind_disease_therapy = n5.IndTherAreaDrug AND n8.id = n5.target AND n8.ChEMBL = n5.drug)"""
V3_CTES = (
    """ad AS (SELECT lt.target_id AS target, mech.chembl, mech.actionType FROM f_molecule m
        JOIN f_linked_target lt ON lt.drug_id = m.drug_id LEFT JOIN f_mechanism mech ON mech.chembl = m.drug_id
        WHERE m.isApproved AND lt.target_id IS NOT NULL)""",
    "adp AS (SELECT target, chembl, min(actionType) AS actionType FROM ad GROUP BY target, chembl)",
    """adg AS (SELECT target,
        coalesce(list(chembl ORDER BY chembl) FILTER (WHERE chembl IS NOT NULL), CAST([] AS VARCHAR[])) AS App_drug_ChEMBL,
        coalesce(list(actionType ORDER BY chembl) FILTER (WHERE chembl IS NOT NULL AND actionType IS NOT NULL), CAST([] AS VARCHAR[])) AS App_drug_actionType
        FROM adp GROUP BY target)""",
)
V4_CTES = (
    """mc AS (SELECT id, mechanismOfAction AS moa, sum(n_urls) AS cnt FROM f_probe
        WHERE isHighQuality AND mechanismOfAction IS NOT NULL GROUP BY id, mechanismOfAction HAVING sum(n_urls) > 0)""",
    "mg AS (SELECT id, list_sort(list(moa || ':' || CAST(cnt AS VARCHAR))) AS ChemicalProbes_HC FROM mc GROUP BY id)",
)
V5_SCORE = "(lof.upperRank - 9456) / 19196"

REPORT_CTES = (
    *LOC_CTES, TRACT_CTE, TRACT_NR, SAFETY_CTE, *CONSTRAINT_CTES, PARALOG_CTE, ORTHOLOG_CTE, DRIVER_CTE,
    PROBE_CTE, MOUSE_CTE, PHASE_CTE, TISSUE_CTE, *PHENO_CTES,
)

REPORT_SELECT = f"""SELECT q.targetid,
    {NR_MB.replace('loc', 'cls.loc').replace('result', 'info.result')} AS isInMembrane,
    {NR_SECRETED.replace('loc', 'cls.loc').replace('result', 'info.result')} AS isSecreted,
    tn.Nr_Pocket AS hasPocket, tn.Nr_Ligand AS hasLigand, {{smb}}
    CASE WHEN sf.nEvents > 0 THEN -1 END AS hasSafetyEvent,
    cs.cal_score AS geneticConstraint,
    {PARALOG_NR} AS paralogMaxIdentityPercentage,
    {ORTHOLOG_NR} AS mouseOrthologMaxIdentityPercentage,
    CASE WHEN drv.id IS NOT NULL THEN -1 END AS isCancerDriverGene, {{ess}}
    CASE WHEN t.tep_description <> 'null' THEN 1 END AS hasTEP,
    CASE WHEN mm.id IS NULL THEN NULL WHEN mm.Nr_mouse_models <> 0 THEN 1 ELSE 0 END AS hasMouseKO,
    prb.Nr_chprob AS hasHighQualityChemicalProbes,
    {{phase}} AS maxClinicalTrialPhase,
    ts.Nr_specificity AS tissueSpecificity, ts.Nr_distribution AS tissueDistribution{{pheno}}
FROM q LEFT JOIN f_target t ON t.id = q.targetid
    LEFT JOIN cls ON cls.id = q.targetid LEFT JOIN info ON info.id = q.targetid
    LEFT JOIN tn ON tn.id = q.targetid LEFT JOIN sf ON sf.id = q.targetid
    LEFT JOIN cs ON cs.id = q.targetid LEFT JOIN par ON par.id = q.targetid LEFT JOIN ort ON ort.id = q.targetid
    LEFT JOIN drv ON drv.id = q.targetid {{ess_join}}
    LEFT JOIN mm ON mm.id = q.targetid LEFT JOIN prb ON prb.id = q.targetid
    LEFT JOIN ph ON ph.id = q.targetid LEFT JOIN ts ON ts.id = q.targetid {{pheno_join}}"""

REPORT_SQL = _with(REPORT_SELECT.format(
    smb="tn.Nr_sMBinder AS hasSmallMoleculeBinder,",
    ess="-CAST(ess.isEssential AS INTEGER) AS isEssential,",
    phase="CASE WHEN ph.mx >= 0 THEN ph.mx / 4 END",
    pheno=",\n    phen.scaledHarmonicSum AS phenotypeScores",
    ess_join="LEFT JOIN f_essential ess ON ess.id = q.targetid",
    pheno_join="LEFT JOIN phen ON phen.id = q.targetid",
), *REPORT_CTES)

REPORT_V1_SQL = _with(REPORT_SELECT.format(
    smb="", ess="", phase="ph.mx", pheno="", ess_join="", pheno_join="",
), *REPORT_CTES)

PROTOTYPE_SQL = _with(f"""SELECT q.targetid, CASE WHEN t.biotype = 'protein_coding' THEN 1 ELSE 0 END AS Nr_biotype,
    CASE WHEN vm.id IS NOT NULL THEN 1 END AS Nr_mb,
    CASE WHEN adg.target IS NOT NULL THEN 1 END AS Nr_drug,
    CASE WHEN mg.id IS NOT NULL THEN 1 END AS Nr_chprob,
    CASE WHEN mm.Nr_mouse_models <> 0 THEN 1 END AS Nr_Mousemodels,
    {V5_SCORE} AS cal_score
FROM q LEFT JOIN (SELECT DISTINCT id, biotype FROM f_target) t ON t.id = q.targetid
    LEFT JOIN vm ON vm.id = q.targetid LEFT JOIN adg ON adg.target = q.targetid
    LEFT JOIN mg ON mg.id = q.targetid LEFT JOIN mm ON mm.id = q.targetid
    LEFT JOIN lof ON lof.id = q.targetid""",
    *TERM_CTES, f"vm AS (SELECT DISTINCT id FROM f_location WHERE termSL IN {MEMBRANE})", *V3_CTES, *V4_CTES, MOUSE_CTE,
    CONSTRAINT_CTES[0])

R_COLS = ["isInMembrane", "isSecreted", "hasPocket", "hasLigand", "hasSmallMoleculeBinder", "hasSafetyEvent",
          "geneticConstraint", "paralogMaxIdentityPercentage", "mouseOrthologMaxIdentityPercentage",
          "isCancerDriverGene", "isEssential", "hasTEP", "hasMouseKO", "hasHighQualityChemicalProbes",
          "maxClinicalTrialPhase", "tissueSpecificity", "tissueDistribution", "phenotypeScores"]
P_COLS = ["Nr_biotype", "Nr_mb", "Nr_drug", "Nr_chprob", "Nr_Mousemodels", "cal_score"]

NEST_SQL = (
    "WITH r AS (" + REPORT_SQL + ")\nSELECT targetid, list_filter([" + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {{'id': '{c}', 'value': CAST({c} AS DOUBLE)}} END" for c in R_COLS
    ) + "], lambda x: x IS NOT NULL) AS prioritisations FROM r"
)

UNPIVOT_SQL = (
    "WITH r AS (" + PROTOTYPE_SQL + ")\n" + "\nUNION ALL\n".join(
        f"SELECT targetid, '{c}' AS id, CAST({c} AS DOUBLE) AS value FROM r" for c in P_COLS)
)

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT p_partkey, p_name, p_size FROM part",
    "scan_delimited": _with('SELECT Name, term_id AS "Subcellular location ID", is_a AS "Is a", part_of AS "Is part of" FROM f_term'),
    "scan_json_records": _with('SELECT Ensembl, specificity AS "RNA tissue specificity", distribution AS "RNA tissue distribution", [antibody] AS Antibody FROM f_atlas'),
    "query_set": "SELECT concat('P', p_partkey) AS targetid FROM part",
    "query_set_limit": "SELECT concat('P', p_partkey) AS targetid FROM part ORDER BY targetid LIMIT 61524",
    "write_json_report": REPORT_SQL,
    "biotype": _with("""SELECT q.targetid,
        CASE WHEN t.id IS NULL THEN NULL WHEN t.biotype = 'protein_coding' THEN 'Yes' WHEN t.biotype = '' THEN 'No_info' ELSE 'No' END AS isProteinCoding,
        CASE WHEN t.id IS NULL THEN NULL WHEN t.biotype = 'protein_coding' THEN 1 WHEN t.biotype = '' THEN NULL ELSE 0 END AS Nr_biotype
        FROM q LEFT JOIN f_target t ON t.id = q.targetid"""),
    "location_profile": _with(f"""SELECT q.targetid, cls.hpa_membrane, cls.hpa_other, cls.hpa_secreted, cls.uniprot_membrane,
        cls.uniprot_secreted, cls.loc, info.result,
        {NR_MB.replace('loc', 'cls.loc').replace('result', 'info.result')} AS Nr_mb,
        {NR_SECRETED.replace('loc', 'cls.loc').replace('result', 'info.result')} AS Nr_secreted
        FROM q LEFT JOIN cls ON cls.id = q.targetid LEFT JOIN info ON info.id = q.targetid""", *LOC_CTES),
    "location_info": _with("SELECT q.targetid, info.result FROM q LEFT JOIN info ON info.id = q.targetid", LOC_CTES[-1]),
    "tractability_pivot": _with("""SELECT q.targetid, tn.* EXCLUDE (id),
        CASE tn.Nr_sMBinder WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS hassMBinder,
        CASE tn.Nr_Ligand WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS hasLigand,
        CASE tn.Nr_Pocket WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS hasPocket
        FROM q LEFT JOIN tn ON tn.id = q.targetid""", TRACT_CTE, TRACT_NR),
    "safety_events": _with("""SELECT q.targetid, sm.info, sm.nEvents, sm.events, sm.hasSafetyEvent, sm.Nr_Event
        FROM q LEFT JOIN sm ON sm.id = q.targetid""", SAFETY_CTE, SAFETY_MEASURES),
    "constraint_minmax": _with("SELECT q.targetid, cs.cal_score FROM q LEFT JOIN cs ON cs.id = q.targetid", *CONSTRAINT_CTES),
    "paralog_ramp": _with(f"""SELECT q.targetid, par.mx AS maxParalogIdentity, {PARALOG_NR} AS Nr_paralogs
        FROM q LEFT JOIN par ON par.id = q.targetid""", PARALOG_CTE),
    "ortholog_ramp": _with(f"""SELECT q.targetid, ort.mx AS maxOrthologIdentity, {ORTHOLOG_NR} AS Nr_ortholog
        FROM q LEFT JOIN ort ON ort.id = q.targetid""", ORTHOLOG_CTE),
    "driver_flag": _with("""SELECT q.targetid, CASE WHEN drv.id IS NOT NULL THEN -1 END AS Nr_CDG,
        CASE WHEN drv.id IS NOT NULL THEN 'Yes' END AS isCancerDriverGene FROM q LEFT JOIN drv ON drv.id = q.targetid""", DRIVER_CTE),
    "essentiality": _with("""SELECT q.targetid, -CAST(e.isEssential AS INTEGER) AS Nr_essential
        FROM q LEFT JOIN f_essential e ON e.id = q.targetid"""),
    "tep_flag": _with("""SELECT q.targetid, t.tep_description AS description,
        CASE WHEN t.id IS NULL THEN NULL WHEN t.tep_description <> 'null' THEN 'Yes' ELSE 'No' END AS hasTEP,
        CASE WHEN t.tep_description <> 'null' THEN 1 END AS Nr_TEP FROM q LEFT JOIN f_target t ON t.id = q.targetid"""),
    "mouse_models": _with("""SELECT q.targetid, mm.Nr_mouse_models, mm.Different_PhenoClasses,
        CASE WHEN mm.id IS NULL THEN NULL WHEN mm.Nr_mouse_models <> 0 THEN 'Yes' ELSE '0' END AS hasMouseKO,
        CASE WHEN mm.id IS NULL THEN NULL WHEN mm.Nr_mouse_models <> 0 THEN 1 ELSE 0 END AS Nr_Mousemodels
        FROM q LEFT JOIN mm ON mm.id = q.targetid""", MOUSE_CTE),
    "chemical_probes": _with("""SELECT q.targetid, prb.Nr_chprob,
        CASE prb.Nr_chprob WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS hasHQCP FROM q LEFT JOIN prb ON prb.id = q.targetid""", PROBE_CTE),
    "clinical_phase": _with("""SELECT q.targetid, ph.mx AS maxClinTrialPhase, CASE WHEN ph.mx >= 0 THEN ph.mx / 4 END AS inClinicalTrials
        FROM q LEFT JOIN ph ON ph.id = q.targetid""", PHASE_CTE),
    "tissue_scores": _with("SELECT q.targetid, ts.* EXCLUDE (id) FROM q LEFT JOIN ts ON ts.id = q.targetid", TISSUE_CTE),
    "phenotype_harmonic": _with("SELECT q.targetid, phen.scaledHarmonicSum FROM q LEFT JOIN phen ON phen.id = q.targetid", *PHENO_CTES),
    "biotype_binary": _with("""SELECT q.targetid, t.biotype, CASE WHEN t.biotype = 'protein_coding' THEN 1 ELSE 0 END AS Nr_biotype
        FROM q LEFT JOIN (SELECT DISTINCT id, biotype FROM f_target) t ON t.id = q.targetid"""),
    "membrane_simple": _with(f"""SELECT q.targetid, CASE WHEN vm.id IS NOT NULL THEN 'Yes' END AS IsinMembrane,
        CASE WHEN vm.id IS NOT NULL THEN 1 END AS Nr_mb FROM q LEFT JOIN vm ON vm.id = q.targetid""",
        *TERM_CTES, f"vm AS (SELECT DISTINCT id FROM f_location WHERE termSL IN {MEMBRANE})"),
    "approved_drugs": _with("""SELECT q.targetid, adg.App_drug_ChEMBL, adg.App_drug_actionType,
        CASE WHEN adg.target IS NOT NULL THEN 1 END AS Nr_drug FROM q LEFT JOIN adg ON adg.target = q.targetid""", *V3_CTES),
    "probe_moa_counts": _with("""SELECT q.targetid, mg.ChemicalProbes_HC, CASE WHEN mg.id IS NOT NULL THEN 1 END AS Nr_chprob
        FROM q LEFT JOIN mg ON mg.id = q.targetid""", *V4_CTES),
    "constraint_bands": _with(f"""SELECT targetid, constraintType, cal_score, CASE WHEN cal_score < -0.1 THEN '-1'
        WHEN cal_score BETWEEN -0.0999999 AND 0.0999999 THEN '0' WHEN cal_score > 0.1 THEN '1' END AS selection
        FROM (SELECT q.targetid, lof.constraintType, {V5_SCORE} AS cal_score FROM q LEFT JOIN lof ON lof.id = q.targetid)""", CONSTRAINT_CTES[0]),
    "mouse_models_flag": _with("""SELECT q.targetid, mm.Nr_mouse_models, mm.Different_PhenoClasses,
        CASE WHEN mm.Nr_mouse_models <> 0 THEN 1 END AS Nr_Mousemodels FROM q LEFT JOIN mm ON mm.id = q.targetid""", MOUSE_CTE),
    "explode_multivalue": _with("SELECT * FROM h1", *H1_CTES),
    "parents": _with("SELECT * FROM h2", *H1_CTES),
    "children": _with("SELECT * FROM h3", *H1_CTES),
    "part_members": _with("SELECT * FROM h4", *H1_CTES),
    "term_search_set": _with("SELECT * FROM h5", *H1_CTES),
    "terms_for_name": _with("SELECT DISTINCT unnest(toSearch) AS term FROM h5 WHERE Name = 'Supplier#000000001'", *H1_CTES),
    "tractability_true": _with("""SELECT q.targetid, g.drug FROM q LEFT JOIN
        (SELECT id, list({'id': category, 'value': value} ORDER BY category) AS drug FROM f_tractability WHERE value GROUP BY id) g
        ON g.id = q.targetid"""),
    "drugs_per_target": _with("SELECT * FROM n2", PAIR_CTE, N2_CTE),
    "partner_drugs": _with("SELECT e.*, n2.CHEMBL FROM e LEFT JOIN n2 ON n2.target = e.targetB",
                           EDGE_CTE, PAIR_CTE, N2_CTE),
    "disease_areas": _with("SELECT * FROM ar", AREA_CTE),
    "drug_disease_area": _with("SELECT * FROM n5", EDGE_CTE, PAIR_CTE, AREA_CTE, N5_CTE),
    "pairs_from_csv": _with("SELECT * FROM n6", *N6_CTES),
    "partner_names": _with("""SELECT e.*, n2.CHEMBL, t.approvedSymbol AS Symbol_targetB
        FROM e LEFT JOIN n2 ON n2.target = e.targetB LEFT JOIN f_target t ON t.id = e.targetB""", EDGE_CTE, PAIR_CTE, N2_CTE),
    "target_drug_pairs": _with("SELECT * FROM n8", EDGE_CTE, PAIR_CTE, *N6_CTES, *N8_CTES),
    "matched_triples": _with("SELECT * FROM n9", EDGE_CTE, PAIR_CTE, AREA_CTE, N5_CTE, *N6_CTES, *N8_CTES, N9_CTE),
    "matched_drugs": _with("SELECT id, list_sort(list(ChEMBL)) AS CHEMBL FROM n9 GROUP BY id",
                           EDGE_CTE, PAIR_CTE, AREA_CTE, N5_CTE, *N6_CTES, *N8_CTES, N9_CTE),
    "priority_report": REPORT_SQL,
    "priority_report_v1": REPORT_V1_SQL,
    "nest_report": NEST_SQL,
    "unpivot_report": UNPIVOT_SQL,
    "prototype_report": PROTOTYPE_SQL,
}
ORACLES |= {f"{k}_merged": ORACLES[k] for k in ("tractability_pivot", "safety_events", "paralog_ramp", "ortholog_ramp", "driver_flag", "chemical_probes")}
