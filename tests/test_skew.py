"""Hot keys (one key holding a third of the rows) give the same results as
the plain formulation / a brute-force computation."""

import random
from collections import Counter, defaultdict

from frames import queryset

from pyspark.sql import functions as F

from entiscore.operators import network as N
from entiscore.operators import properties as P
from entiscore.operators.joins import attach, attach_counted, attach_salted

MOL_SCHEMA = ("id string, isApproved boolean, maximumClinicalTrialPhase int, linkedTargets struct<rows:array<string>>, "
              "linkedDiseases struct<rows:array<string>>")


def _multiset(df):
    return Counter(map(tuple, df.collect()))


def test_attach_counted_equals_left_join_with_hot_key(spark):
    rnd = random.Random(1)
    rows = [("HOT", rnd.choice([1.0, 0.5, None]), rnd.choice(["a", "b"])) for _ in range(3000)]
    rows += [(f"K{rnd.randint(0, 300)}", rnd.choice([1.0, 0.5, None]), rnd.choice(["a", "b", None])) for _ in range(6000)]
    m = spark.createDataFrame(rows, "id string, v double, w string")
    q = queryset(spark, "HOT", "NONE", *[f"K{i}" for i in range(0, 320, 3)])
    plain = attach(q, m, on="id")
    counted = attach_counted(q, (m, "id"))
    assert _multiset(counted) == _multiset(plain)
    assert _multiset(attach_counted(q, (m, "id"), chunk=7)) == _multiset(plain)  # many chunks per value
    assert counted.where("targetid = 'HOT'").count() == 3000
    # the packed row of the hot key holds one entry per distinct value tuple
    packed = m.groupBy("id", "v", "w").count().groupBy("id").count().where("id = 'HOT'").first()[1]
    assert packed <= 6


def test_fanout_attach_equals_left_join_with_hot_key(spark):
    rows = [("HOT", i) for i in range(2000)] + [(f"K{i % 97}", i) for i in range(4000)]
    m = spark.createDataFrame(rows, "id string, v long")
    q = queryset(spark, "HOT", "NONE", "K1", "K2")
    assert _multiset(attach(q, m, on="id", fanout=True)) == _multiset(attach(q, m, on="id"))


def test_clinical_phase_hot_target(spark):
    rnd = random.Random(2)
    mols = [(f"D{i}", True, rnd.randint(-1, 4), (["HOT"] + [f"T{rnd.randint(0, 50)}"],), None) for i in range(3000)]
    mol = spark.createDataFrame(mols, MOL_SCHEMA)
    want = defaultdict(lambda: None)
    for _, _, ph, (tg,), _ in mols:
        for t in tg:
            want[t] = ph if want[t] is None else max(want[t], ph)
    got = {r["targetid"]: r["maxClinTrialPhase"] for r in P.clinical_phase(mol, queryset(spark, "HOT", "T3", "ZZ")).collect()}
    assert got == {"HOT": want["HOT"], "T3": want["T3"], "ZZ": None}


def _brute_n5(q_ids, edges, mols, diseases):
    kept = {(a, b) for src, a, b, s in edges if src == "intact" and s > 0.42 and a in q_ids}
    pairs = [(t, d) for d, _, _, lt, _ in mols for t in ((lt or (None,))[0] or []) if t is not None]
    dis_of = {d: ((ld or (None,))[0] or [None]) for d, _, _, _, ld in mols}
    areas = {k: (v or [None]) for k, v in diseases}
    out = Counter()
    for a, b in kept:
        for t, drug in pairs:
            if t != b:
                continue
            for dis in dis_of.get(drug, [None]) or [None]:
                for ar in (areas.get(dis, [None]) if dis is not None else [None]):
                    out[(drug, dis, ar, a)] += 1
    return out


def test_drug_disease_area_and_matches_hot_partner(spark):
    rnd = random.Random(3)
    ents = [f"E{i}" for i in range(40)]
    edges = [("intact", rnd.choice(ents), "HOTB", rnd.choice([0.3, 0.42, 0.9])) for _ in range(600)]
    edges += [(rnd.choice(["intact", "string"]), rnd.choice(ents), f"B{rnd.randint(0, 30)}", rnd.choice([0.3, 0.9]))
              for _ in range(1200)]
    mols = [(f"D{i}", True, 1, ([rnd.choice(["HOTB", f"B{rnd.randint(0, 30)}"]) for _ in range(2)],),
             ([f"DIS{rnd.randint(0, 6)}"],)) for i in range(200)]
    diseases = [(f"DIS{i}", [f"TA{i % 3}", f"TA{(i + 1) % 3}"] if i < 5 else []) for i in range(7)]
    inter = spark.createDataFrame(edges, "sourceDatabase string, targetA string, targetB string, scoring double")
    mol = spark.createDataFrame(mols, MOL_SCHEMA)
    dis = spark.createDataFrame(diseases, "id string, therapeuticAreas array<string>")
    q = queryset(spark, *ents)
    n5 = N.drug_disease_area(mol, inter, dis, q)
    want = _brute_n5(set(ents), edges, mols, diseases)
    assert _multiset(n5) == want

    # N8/N9 against brute force: every (entity, area) of the pair table
    pair_rows = [(e, f"DIS{rnd.randint(0, 6)}", f"TA{rnd.randint(0, 2)},TA{rnd.randint(0, 2)}") for e in ents]
    pairs = spark.createDataFrame(pair_rows, "hgnc_protein string, EFO_disease string, Therapy_area string")
    smap = spark.createDataFrame([(e, e) for e in ents], "symbol string, id string")
    n8 = N.target_drug_pairs(N.pairs_from_csv(pairs, smap), mol, inter, q)
    n6 = N.pairs_from_csv(pairs, smap)
    n9 = {tuple(r) for r in N.matched_triples(n6, mol, inter, dis, q).collect()}
    drug_side = {(t, d, ar) for (d, _, ar, t) in want if ar is not None}
    reach = defaultdict(list)
    for a, b in {(a, b) for s, a, b, sc in edges if s == "intact" and sc > 0.42}:
        for d, _, _, (tg,), _ in mols:
            reach[a].extend([d] * sum(1 for t in tg if t == b))
    ent_side = {(e, d, ta.strip()) for e, _, tas in pair_rows for ta in tas.split(",") for d in reach[e]}
    assert n9 == {(e, d, ta, ta) for (e, d, ta) in ent_side & drug_side}


def test_copies_of_a_hot_key_are_spread_over_tasks(spark):
    """One id has a third of the rows; no task makes more than twice the median."""
    from pyspark.sql import functions as F

    rows = spark.range(600_000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("K"), (F.col("id") % 20_000).cast("string"))).alias("id"), F.lit(1).alias("v"))
    q = rows.select(F.col("id").alias("targetid")).distinct()
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = attach_counted(q, (rows, "id"), chunk=1 << 10)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(sizes) == 600_000
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_a_hot_query_id_is_spread_over_tasks(spark):
    """One id has a third of the query rows; no task makes more than twice the median."""
    from pyspark.sql import functions as F

    q = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("K"), (F.col("id") % 20_000).cast("string"))).alias("targetid"))
    rows = spark.createDataFrame([("HOT", 1), ("HOT", 2), ("K1", 1), ("K4", 1), ("K4", 1)], "id string, v int")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = attach_counted(q, (rows, "id"), chunk=1 << 10)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert _multiset(out.groupBy("targetid", "v").count()) == _multiset(attach(q, rows, on="id").groupBy("targetid", "v").count())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_counted_join_of_wide_and_repeated_query_rows(spark):
    q = spark.createDataFrame([("A", 1, [1]), ("A", 1, [1]), ("A", 2, None), (None, 1, []), ("Z", 1, [2])], "targetid string, x int, y array<int>")
    m = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("A", None), (None, 5.0), ("B", 2.0)], "id string, v double")
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert rows(attach_counted(q, (m, "id"), chunk=1)) == rows(attach(q, m, on="id"))
    assert attach_counted(q.limit(0), (m, "id")).count() == 0
    assert rows(attach_counted(q, (m.limit(0), "id"))) == rows(attach(q, m.limit(0), on="id"))


def test_report_of_a_hot_query_id(spark):
    """The report equals the operator chain where a third of the query rows, and of the side tables, bear one id."""
    import chained as C
    from frames import target_df, target_row

    from entiscore.plans import report as R

    rnd = random.Random(4)
    some = lambda: "HOT" if rnd.random() < 0.33 else rnd.choice(["A", "B", "C", None, "X"])
    t = target_df(spark, *[target_row(i, subcellularLocations=[("in", "HPA_main", "SL-1"), (None, "uniprot", "SL-2")], constraint=[("lof", 3), ("lof", r)])
                           for r, i in enumerate(["HOT", "A", "B", "C"])])
    q = queryset(spark, *[some() for _ in range(60)])
    ess = spark.createDataFrame([(some(), [(rnd.choice([True, False, None]),)] * rnd.randint(0, 2)) for _ in range(12)], "id string, geneEssentiality array<struct<isEssential:boolean>>")
    mouse = spark.createDataFrame([(some(), [(rnd.choice(["m1", "m2", "m3", None]), rnd.choice(["l", None]))] * rnd.randint(0, 3)) for _ in range(30)],
                                  "targetFromSourceId string, modelPhenotypeClasses array<struct<id:string,label:string>>")
    mol = spark.createDataFrame([(f"D{i}", True, rnd.choice([-1, 0, 3, None]), ([some()],), None) for i in range(20)], MOL_SCHEMA)
    atlas = spark.createDataFrame([(some(), rnd.choice(["Tissue enriched", "Not detected", None, "new"]), rnd.choice(["Detected in all", "Detected in some", None]), []) for _ in range(15)],
                                  "Ensembl string, `RNA tissue specificity` string, `RNA tissue distribution` string, Antibody array<string>")
    scores = spark.createDataFrame([("m1", 0.5), ("m2", 1.0)], "id string, score double")
    args = (t, ess, mouse, mol, atlas, mouse, scores, ["SL-1"], ["SL-2"])
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert rows(R.priority_report(*args, queryset=q)) == rows(C.priority_report_chained(*args, queryset=q))


def test_salted_join_deals_out_a_heavy_key(spark):
    """The rows of the plain left join; one key with a third of the measures, no task with more than twice the median."""
    from pyspark.sql import functions as F

    rnd = random.Random(6)
    small = [("HOT", rnd.randint(0, 400)) for _ in range(900)] + [(rnd.choice([None, *"ABCDEFG"]), rnd.randint(0, 5)) for _ in range(600)]
    m = spark.createDataFrame(small, "k string, v int")
    q = spark.createDataFrame([(i, x) for i in ["HOT", "A", "Z", None] for x in (1, 1, 2)], "id string, x int")
    for parts in (1, 3, 1000):
        assert _multiset(attach_salted(q, m, on="k", qkey="id", parts=parts)) == _multiset(attach(q, m, on="k", qkey="id"))
    assert _multiset(attach_salted(q, m.limit(0), on="k", qkey="id")) == _multiset(attach(q, m.limit(0), on="k", qkey="id"))
    big = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 20_000).cast("string"))).alias("k"), F.col("id").alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = attach_salted(big.select(F.col("k").alias("id")).distinct(), big, on="k", qkey="id")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().where("count > 10").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(sizes) == 300_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_first_ids_equal_an_ordered_limit(spark, monkeypatch):
    monkeypatch.setattr(P, "SAMPLED_IDS", 50)
    rnd = random.Random(7)
    ids = [rnd.choice(["HOT", f"K{rnd.randint(0, 900):04d}", f"K{rnd.randint(0, 900):04d}"]) for _ in range(3000)] + [None] * 7
    t = spark.createDataFrame([(i,) for i in ids], "id string").repartition(4)
    want = sorted(ids, key=lambda i: (i is not None, i or ""))
    for n in (0, 1, 5, 40, 300, 1200, 2900, 5000):
        got = [r[0] for r in P.query_set_limit(t, n).collect()]
        assert sorted(got, key=lambda i: (i is not None, i or "")) == want[:n]
    cut = P._cut_off(P.query_set(t), 40)
    assert 40 <= sum(i is None or i <= cut for i in ids) <= 3000
    unique = spark.range(20_000).selectExpr("concat('U', lpad(id, 6, '0')) AS id")
    below = P._cut_off(P.query_set(unique), 500)
    assert 500 <= unique.where(unique["id"] <= below).count() <= 1000


def test_attach_salted_copies_where_it_joined(spark):
    """A row that stands there more often than a chunk holds is copied in full,
    and the joined rows are not shuffled again."""
    from entiscore.operators.joins import CHUNK

    n = 2 * CHUNK + 10
    m = spark.range(n).select(F.lit("hot").alias("k"), F.lit(1).alias("v")).unionByName(spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), (None, 3)], "k string, v int"))
    q = spark.createDataFrame([("hot",), ("a",), ("a",), ("none",), (None,)], "id string")
    out = attach_salted(q, m, on="k", qkey="id", parts=10)
    assert {tuple(r) for r in out.groupBy("id", "v").count().collect()} == {("hot", 1, n), ("a", 1, 2), ("a", 2, 4), ("none", None, 1), (None, None, 1)}
    assert "REPARTITION_BY_COL" not in out._jdf.queryExecution().executedPlan().toString()


def test_scored_classes_are_counted_by_score(spark):
    """An entity of many classes has a row per score, in parts that are not merged by their bytes."""
    mouse = spark.createDataFrame([("HOT", [(f"MP:{i}", None) for i in range(500)]), ("NONE", None)],
                                  "targetFromSourceId string, modelPhenotypeClasses array<struct<id:string,label:string>>")
    scores = spark.createDataFrame([(f"MP:{i}", float(i % 2)) for i in range(400)], "id string, score double")
    out = P.scored_classes(mouse, scores)
    assert {tuple(r) for r in out.collect()} == {("HOT", 0.0, 200), ("HOT", 1.0, 200), ("HOT", None, 100), ("NONE", None, 1)}
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
