"""Readers and writers: delimited files (named and unnamed columns), JSON
records (lines and pretty-printed arrays), JSON report round trip."""

import json
import os

import pytest

from entiscore.operators import properties as P
from entiscore.sources import io


def test_csv_with_unnamed_trailing_column(spark, tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text("id,label,score,\nMP:1,a phenotype,1,\nMP:2,b phenotype,0.75,*\nMP:3,c,0,\n")
    raw = io.scan_delimited(spark, str(path), sep=",")
    assert raw.columns == ["id", "label", "score", "_c3"]
    typed = io.scan_delimited(spark, str(path), sep=",", schema=io.PHENOTYPE_SCORE_SCHEMA)
    assert sorted(map(tuple, typed.collect())) == [("MP:1", "a phenotype", 1.0), ("MP:2", "b phenotype", 0.75), ("MP:3", "c", 0.0)]
    flagged = io.scan_delimited(spark, str(path), sep=",", schema=io.PHENOTYPE_SCORE_SCHEMA + ", _c3 string")
    assert {r["id"]: r["_c3"] for r in flagged.collect()} == {"MP:1": None, "MP:2": "*", "MP:3": None}


def test_delimited_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "wide.tsv"
    path.write_text("Subcellular location ID\tDescription\tIs part of\tIs a\tName\nSL-1\tsome text\t\tSL-2; x\tCell membrane\n")
    row = io.scan_delimited(spark, str(path), schema=io.TERM_SCHEMA).first()
    assert tuple(row) == ("Cell membrane", "SL-1", "SL-2; x", None)
    with pytest.raises(ValueError, match="symbol"):
        io.scan_delimited(spark, str(path), schema="Name string, symbol string")


def test_malformed_input_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,label,score\na,b,not a number\n")
    with pytest.raises(Exception):
        io.scan_delimited(spark, str(tmp_path / "bad.csv"), sep=",", schema=io.PHENOTYPE_SCORE_SCHEMA).collect()
    (tmp_path / "bad.json").write_text('{"Ensembl": "A"}\n{"Ensembl": \n')
    with pytest.raises(Exception):
        io.scan_json_records(spark, str(tmp_path / "bad.json")).collect()
    with pytest.raises(ValueError, match="Gene"):
        io.scan_json_records(spark, str(tmp_path / "bad.json"), columns=("Ensembl", "Gene"))


def test_bad_json_records_are_counted_and_kept_aside(spark, tmp_path):
    lines = ['{"Ensembl": "A", "Antibody": ["HPA1"]}', '{"Ensembl": ', '{"Ensembl": "B", "Antibody": 3}', '{"Ensembl": "C"}']
    (tmp_path / "some.jsonl").write_text("\n".join(lines))
    rows, n = io.scan_json_tolerant(spark, str(tmp_path / "some.jsonl"), str(tmp_path / "aside"), columns=("Ensembl",))
    assert n == 2 and sorted(r["Ensembl"] for r in rows.collect()) == ["A", "C"]
    assert sorted(r["record"] for r in spark.read.json(str(tmp_path / "aside")).collect()) == sorted(lines[1:3])
    (tmp_path / "good.jsonl").write_text("\n".join([lines[0], lines[3]]))
    rows, n = io.scan_json_tolerant(spark, str(tmp_path / "good.jsonl"), str(tmp_path / "none"), columns=("Ensembl",))
    assert n == 0 and rows.count() == 2 and not (tmp_path / "none").exists()
    with pytest.raises(ValueError, match="Gene"):
        io.scan_json_tolerant(spark, str(tmp_path / "good.jsonl"), str(tmp_path / "none"), columns=("Gene",))


def test_bad_lines_are_counted_and_kept_aside(spark, tmp_path):
    lines = ["MP:1,a phenotype,1,", "MP:2,b,not a number,*", "MP:3", "MP:4,d,0.5,,more", "MP:5,e,,x"]
    (tmp_path / "some.csv").write_text("\n".join(["id,label,score,", *lines]))
    rows, n = io.scan_delimited_tolerant(spark, str(tmp_path / "some.csv"), str(tmp_path / "aside"), ",", "score double, id string")
    assert n == 3 and sorted(map(tuple, rows.collect()), key=str) == [(1.0, "MP:1"), (None, "MP:5")]
    assert sorted(r["record"] for r in spark.read.json(str(tmp_path / "aside")).collect()) == sorted(lines[1:4])
    (tmp_path / "good.csv").write_text("\n".join(["id,label,score,", lines[0], lines[4]]))
    rows, n = io.scan_delimited_tolerant(spark, str(tmp_path / "good.csv"), str(tmp_path / "none"), ",")
    assert n == 0 and rows.columns == ["id", "label", "score", "_c3"] and rows.count() == 2 and not (tmp_path / "none").exists()
    (tmp_path / "empty.csv").write_text("id,label\n")
    rows, n = io.scan_delimited_tolerant(spark, str(tmp_path / "empty.csv"), str(tmp_path / "none"), ",")
    assert n == 0 and rows.count() == 0
    with pytest.raises(ValueError, match="symbol"):
        io.scan_delimited_tolerant(spark, str(tmp_path / "good.csv"), str(tmp_path / "none"), ",", "symbol string")


def test_releases_with_other_types_and_fields_are_read_together(spark, tmp_path):
    old, new, odd, big = (str(tmp_path / n) for n in ("old", "new", "odd", "big"))
    ddl = "id string, constraint array<struct<constraintType:string,upperRank:{}>>{}"
    spark.createDataFrame([("A", [("lof", 7)]), ("B", None), ("C", [])], ddl.format("int", "")).write.parquet(old)
    spark.createDataFrame([("D", [("lof", 9), (None, None)], (None, "text"), 1)],
                          ddl.format("bigint", ", tep struct<uri:string,description:string>, other int")).write.parquet(new)
    want = ddl.format("int", ", tep struct<description:string>")
    got = {r["id"]: r for r in io.scan_entities(spark, [old, new], want).collect()}
    assert set(got) == {"A", "B", "C", "D"} and got["A"]["tep"] is None and got["D"]["tep"]["description"] == "text"
    assert got["A"]["constraint"] == [("lof", 7)] and got["B"]["constraint"] is None and got["C"]["constraint"] == []
    assert got["D"]["constraint"] == [("lof", 9), (None, None)]
    both = io.scan_entities(spark, [old, new])  # the full entity schema: all other columns null
    assert {r["targetid"]: r["cal_score"] for r in P.constraint_minmax(both).collect()} == {"A": -1.0, "B": None, "C": None, "D": 1.0}
    spark.createDataFrame([("E", "text")], "id string, tep string").write.parquet(odd)
    with pytest.raises(ValueError, match="tep"):
        io.scan_entities(spark, [old, odd], want)
    spark.createDataFrame([("F", [("lof", 2**40)])], ddl.format("bigint", "")).write.parquet(big)
    with pytest.raises(Exception, match="(?i)overflow"):
        io.scan_entities(spark, [old, big], want).collect()
    with pytest.raises(ValueError, match="no path"):
        io.scan_entities(spark, [], want)


def test_tsv_term_list(spark, tmp_path):
    path = tmp_path / "terms.tsv"
    path.write_text("Name\tSubcellular location ID\tIs a\tIs part of\n"
                    "Cell membrane\tSL-0039\tSL-0162; Membrane\t\n"
                    "Secreted\tSL-0243\t\t\n")
    df = io.scan_delimited(spark, str(path), sep="\t", schema=io.TERM_SCHEMA)
    rows = {r["Name"]: r for r in df.collect()}
    assert rows["Cell membrane"]["Is a"] == "SL-0162; Membrane" and rows["Secreted"]["Is a"] is None


def test_json_records_lines_and_array(spark, tmp_path):
    recs = [{"Ensembl": "A", "RNA tissue specificity": "Tissue enriched", "RNA tissue distribution": "Detected in all",
             "Antibody": ["HPA1"], "Gene": "x"},
            {"Ensembl": "B", "RNA tissue specificity": "Not detected", "RNA tissue distribution": "Detected in some"}]
    lines = tmp_path / "atlas.jsonl"
    lines.write_text("\n".join(json.dumps(r) for r in recs))
    pretty = tmp_path / "atlas.json"
    pretty.write_text(json.dumps(recs, indent=2))
    a = io.scan_json_records(spark, str(lines))
    b = io.scan_json_records(spark, str(pretty), multi_line=True)
    assert a.columns == ["Ensembl", "RNA tissue distribution", "RNA tissue specificity", "Antibody"]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    scored = {r["targetid"]: (r["Nr_specificity"], r["Nr_distribution"]) for r in
              P.tissue_scores(a, spark.createDataFrame([("A",), ("B",)], "targetid string")).collect()}
    assert scored == {"A": (1.0, -1.0), "B": (None, 0.5)}


def test_json_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, None, 0.5), ("B", None, None, None)], "targetid string, x int, y double, z double")
    path = io.write_json_report(df, str(tmp_path / "report"))
    back = spark.read.schema(df.schema).json(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    io.write_json_report(df.limit(1), path)  # overwrite
    assert spark.read.schema(df.schema).json(path).count() == 1


def test_parquet_column_pruning(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, d double")
    df.write.parquet(str(tmp_path / "p"))
    assert io.scan_parquet(spark, str(tmp_path / "p"), ["k", "d"]).columns == ["k", "d"]


def test_report_from_files_equals_in_memory_report(spark, tmp_path):
    import os

    from entiscore.operators import hierarchy as H
    from entiscore.plans import report as R
    from entiscore.sources import fixtures as fx

    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        return
    p = {k: str(tmp_path / k) for k in ("t", "ge", "mm", "mol", "atlas", "ph", "scores", "terms")}
    fx.target(spark, d).write.parquet(p["t"])
    fx.gene_essentiality(spark, d).write.parquet(p["ge"])
    fx.mouse_phenotypes(spark, d).write.parquet(p["mm"])
    fx.mouse_phenotypes(spark, d).write.parquet(p["ph"])
    fx.molecule(spark, d).write.parquet(p["mol"])
    io.write_json_report(fx.tissue_atlas(spark, d), p["atlas"])
    fx.phenotype_scores(spark, d).write.option("header", True).csv(p["scores"])
    io.write_delimited(fx.term_table(spark, d), p["terms"])
    name = "Supplier#000000001"
    got = R.priority_report_from_files(spark, p["t"], p["ge"], p["mm"], p["mol"], p["atlas"], p["ph"], p["scores"],
                                       p["terms"], membrane_name=name, secreted_name="Supplier#000000002")
    sets = H.explode_multivalue(fx.term_table(spark, d))
    want = R.priority_report(fx.target(spark, d), fx.gene_essentiality(spark, d), fx.mouse_phenotypes(spark, d),
                             fx.molecule(spark, d), fx.tissue_atlas(spark, d), fx.mouse_phenotypes(spark, d),
                             fx.phenotype_scores(spark, d), H.terms_for_name(sets, name),
                             H.terms_for_name(sets, "Supplier#000000002"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_json_report_is_compressed_unless_asked(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('P', id) AS targetid", "id AS aLongColumnName")
    files = lambda p: [f for f in os.listdir(p) if f.startswith("part-")]
    packed, plain = io.write_json_report(df, str(tmp_path / "a")), io.write_json_report(df, str(tmp_path / "b"), compression="none")
    assert all(f.endswith(".json.gz") for f in files(packed)) and all(f.endswith(".json") for f in files(plain))
    assert sorted(map(tuple, spark.read.schema(df.schema).json(packed).collect())) == sorted(map(tuple, df.collect()))
