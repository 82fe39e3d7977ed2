"""Classifiers on held-out rows, quality rules against brute force, WARC round trips and the queries."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_frames import EDGE_ROWS, docs, wide, words
from pyspark.sql import functions as F

from entiscore.llm import langid, licenses, quality, queries, toxicity, warc
from entiscore.session import scratch_path

SF = "/root/testdata/sf0.01"
BIG = "/root/testdata/sf0.1"
needs_big = pytest.mark.skipif(not os.path.exists(BIG), reason="driver tables missing")
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


@needs_data
def test_toxicity_held_out(spark):
    out = {r["doc_id"]: r for r in queries.op1_toxicity(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(table)
    marked = re.compile(r"\b(idiot|clown|pathetic|worthless|scum|moron|trash|disgusting|stupid|loser)\b", re.I)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in table if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(out[r["doc_id"]]["held_out"] for r in held)
    toxic = [r for r in held if labels.get(r["doc_id"]) == 1 and marked.search(r["text"] or "")]
    plain = [r for r in held if labels.get(r["doc_id"]) == 0]
    assert toxic and sum(out[r["doc_id"]]["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(out[r["doc_id"]]["predicted"] for r in plain) <= 0.02 * len(plain)


@needs_big
def test_toxicity_held_out_all_labels(spark):
    """All held-out labels, those that no abuse in the text bears out included: these cap
    the recall (about a third of the label-1 rows), so ranking and clean rows are held to."""
    out = queries.op1_toxicity(spark, BIG).filter("held_out")
    labels = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", "toxic").filter("toxic IS NOT NULL")
    rows = sorted((r["score"], r["toxic"], r["predicted"]) for r in out.join(labels, "doc_id").collect())
    bad, good = [i for i, r in enumerate(rows) if r[1] == 1], [i for i, r in enumerate(rows) if r[1] == 0]
    auc = (sum(bad) - len(bad) * (len(bad) - 1) / 2) / (len(bad) * len(good))
    recall, wrong = (sum(rows[i][2] for i in x) / len(x) for x in (bad, good))
    print(f"held out: AUC {auc:.3f}, label 1 caught {recall:.3f} of {len(bad)}, label 0 rejected {wrong:.4f} of {len(good)}")
    assert auc >= 0.95 and recall >= 0.4 and wrong <= 0.005


def test_toxicity_repeated_ids_are_bounded(spark):
    rows = [(1, f"vile words {i}") for i in range(500)] + [(2, "kind words"), (3, None), (3, "more kind words")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    a, b = (toxicity.train(docs(spark, rows).repartition(n), labels) for n in (1, 5))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_toxicity_edge_rows(spark):
    frame, _ = wide(spark, EDGE_ROWS + [(9, "a vile insult here"), (10, "a kind word here")])
    labels = spark.createDataFrame([(9, 1), (10, 0), (9, 0), (None, 1), (4, None), (77, 1)], "doc_id long, toxic int")
    out = toxicity.score(frame, toxicity.train(frame, labels))
    assert out.count() == len(EDGE_ROWS) + 2 and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    by = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert by[(9, "a vile insult here")] > by[(10, "a kind word here")] and by[(1, None)] == by[(2, "")]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs(spark, []), toxicity.train(docs(spark, []), none)).count() == 0


@needs_data
def test_language_held_out(spark):
    out = {r["doc_id"]: r for r in queries.op2_language(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    held = [r for r in table if out[r["doc_id"]]["held_out"]]
    assert len(out) == len(table) and held
    assert sum(out[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_language_edge_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5)]
    frame = docs(spark, rows + [(90, None, "en"), (91, "abc", None)], "doc_id long, text string, lang string")
    model = langid.train(frame)
    assert model.languages == ["de", "en"]
    probe, _ = wide(spark, EDGE_ROWS + [(20, "THE DOG"), (21, "die Katze"), (22, "1234 ..."), (23, "ωω")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(probe, model).collect()}
    assert got[20][0] == "en" and got[21][0] == "de" and got[1] == got[2] == got[22] == ("und", 0.0) and got[23] == ("de", 0.0)
    empty = langid.train(docs(spark, [], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.predict(probe, empty).collect()} == {"und"}


def test_filter_counts_are_corrected():
    """Bit-sliced lookups agree with sets up to the filters' false positives."""
    s = langid.Settings(bits=12)
    rnd = np.random.default_rng(1)
    grams = rnd.integers(0, 2**63, 600).astype(np.uint64)
    table = np.zeros(1 << s.bits, np.uint64)
    for p in langid._positions(grams, s):
        np.bitwise_or.at(table, p, np.uint64(1))
    hit = lambda g: np.bitwise_and.reduce([table[p] for p in langid._positions(g, s)]) & np.uint64(1)
    assert hit(grams).all()
    rate = float((table & np.uint64(1)).mean()) ** s.hashes
    assert abs(hit(rnd.integers(0, 2**63, 20_000).astype(np.uint64)).mean() - rate) < 0.01


def brute_measures(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if words(x)]
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_measures_and_verdict(spark):
    rnd = random.Random(4)
    vocab = ["a", "bb", "é", "###", "x|y", "WORD", "　odd"] + [f"w{i}" for i in range(40)]
    rows = EDGE_ROWS + [(100 + i, "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", "\t\t", "\r\n"]) for _ in range(rnd.randint(0, 120)))) for i in range(150)]
    frame, _ = wide(spark, rows)
    out = quality.cascade(frame).collect()
    assert len(out) == len(rows)
    for r in out:
        got = brute_measures(r["text"])
        assert tuple(r[c] for c in quality.MEASURES) == got
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0]) and not (r["base_failed"] and r["kept"])
    # The order of the rules changes the work, never the verdict.
    other = quality.cascade(frame, order=list(quality.RULES)[::-1]).collect()
    assert sorted(map(repr, other)) == sorted(map(repr, out))
    assert quality.cascade(docs(spark, [])).count() == 0


def test_rule_order():
    assert quality.best_order({0b01: 10, 0b10: 9, 0b11: 1}, [10.0, 1.0]) == [1, 0]
    assert quality.best_order({}, [3.0, 1.0, 2.0]) == [1, 2, 0]


@needs_data
def test_licence_families(spark):
    out = queries.op3_licenses(spark, SF).filter("confirmed").collect()
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    marks = {"MIT": "MIT License", "Apache": "Apache License", "GPL": "GNU General Public License", "CC-BY-NC": "CC BY-NC"}
    want = {(r["doc_id"], i, f) for r in table for i, line in enumerate((r["text"] or "").split("\n")) for f, m in marks.items()
            if m in line and re.search("licensed|released", line, re.I)}
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in out}
    assert want and want <= got


def test_licence_edge_rows(spark):
    frame, _ = wide(spark, EDGE_ROWS + [
        (20, "x\nLicensed under the Apache License, Version 2.0."), (21, "He lost his driving license and all copies."),
        (22, "You should have received a copy of the GNU Affero General Public License along with this program.")])
    model = licenses.train(spark, frame)
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.scan(frame, model).filter("confirmed").collect()}
    assert got == {(20, 1, "Apache"), (22, 0, "AGPL")}
    assert licenses.scan(docs(spark, []), licenses.train(spark, docs(spark, []))).count() == 0


def test_licence_lines_without_cues_and_wrapped_notices(spark):
    wrapped = "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this\nsoftware and associated documentation files"
    rows = [(1, "GPL-3.0-or-later"), (2, "In no event shall the authors be liable"), (3, "The cat sat.\n \n" + wrapped + "\n\nThe dog sat."), (4, "CC BY-SA 4.0"),
            (5, None), (6, " \n\n")]
    frame = docs(spark, rows)
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.scan(frame, licenses.train(spark, frame)).filter("confirmed").collect()}
    assert got == {(1, 0, "GPL"), (2, 0, "MIT"), (3, 2, "MIT"), (3, 3, "MIT"), (3, 4, "MIT"), (4, 0, "CC-BY-SA")}
    parts = licenses.paragraphs(frame, "doc_id", "text").filter("doc_id = 3").collect()
    assert sorted([x["n"] for x in r["lines"]] for r in parts) == [[0], [2, 3, 4], [6]]


def test_licence_model_learns_from_every_line(spark):
    lines = [f"{a}{b} and {b}{c} went to the {c}{a}" for a in "abcdefghijklmnopq" for b in "abcdefghijklmnopq" for c in "abcdefghijklmnopq"]
    frame = docs(spark, [(i, "\n\n".join([*lines[i::50], "SPDX-License-Identifier: MIT"])) for i in range(50)])
    parts = [licenses.other_units(frame, "text", kept_out, 3) for kept_out in (False, True)]
    found = [[" ".join(r["words"]) for r in p.collect()] for p in parts]
    assert sorted(found[0] + found[1]) == sorted(lines)  # all but the licence lines
    model = licenses.train(spark, frame)
    n = {True: 0, False: 0}  # grams learned from, of templates and of others
    for f, text in [*licenses.TEMPLATES, *((None, t) for t in licenses.NOT_LICENCES), *((None, t) for t in found[0])]:
        w = len([x for x in re.split("[^a-z]+", text.lower()) if x])
        for k in [w, *(s for s in (6, 10, 16) for _ in range(0, w - s + 1, 2) if f)]:
            n[f is not None] += sum(max(0, k - j) for j in range(3))
    share = (n[False] + licenses.SMOOTHING) / (n[True] + n[False] + licenses.SMOOTHING * len(model.families))
    assert len(found[0]) > 3_000 and math.isclose(math.exp(model.classifier.pi[len(model.families) - 1]), share, rel_tol=1e-9)
    # The short cut loses no row, and few of the kept-out ones pass.
    every = licenses.features(frame.select(F.explode(F.split("text", "\n\n")).alias("text")).select(licenses.words_of(F.col("text")).alias("words")))
    every = model.judged(every).filter(F.col("family") != licenses.UNKNOWN)
    short = model.accepted(frame.select(F.explode(F.split("text", "\n\n")).alias("text")).select(licenses.words_of(F.col("text")).alias("words")))
    assert sorted(map(tuple, short.select("words", "family", "margin").collect())) == sorted(map(tuple, every.select("words", "family", "margin").collect()))
    assert model.judged(parts[1]).filter(F.col("family") != licenses.UNKNOWN).count() <= 0.01 * len(found[1])


def test_licence_texts_are_parted_into_words_once(spark):
    """A paragraph's n-grams and bound come from its lines and the runs across their ends."""
    wrapped = "Permission is hereby granted,\n---\nfree\nof charge, to\nany person obtaining a copy of this software and associated\n42"
    plain = [f"The {a} went\nto the\n{b}\n\n{b} {a} of the\n \r\n1\n2" for a in ("cat", "dog", "fox", "ox") for b in ("hill", "lake", "sea")]
    rows = [wrapped, "Licensed under the ISC license.", "x\nGPL-3.0-or-later\ny", "the the the the of the\nthe", "", None, "\n\n", *plain, *plain]
    frame = docs(spark, list(enumerate(rows)))
    for kept_out in (False, True):
        parts = licenses.other_parts(frame, "text", kept_out, 3)
        got = Counter({r["gram"]: r["n"] for r in licenses.other_grams(parts).groupBy("gram").agg(F.sum("n").alias("n")).collect()})
        assert got and got == Counter(g for r in licenses.other_units(frame, "text", kept_out, 3).collect() for g in r["grams"])
    model = licenses.train(spark, frame)
    text = lambda x: licenses.features(x.select("text", licenses.words_of(F.col("text")).alias("words")))
    parts = model.bounded_parts(licenses.hashed(licenses.paragraphs(frame, "doc_id", "text"))).collect()
    units = [(x["line"], b) for r in parts for x, b in zip(r["lines"], r["bounds"], strict=True)] + [(" ".join(x["line"] for x in r["lines"]), r["bound"]) for r in parts]
    bounds = {r["text"]: r["bound"] for r in model.bounded(text(docs(spark, [(0, t) for t, _ in units]))).collect()}
    assert len(units) > 100 and all(math.isclose(b, bounds[t], abs_tol=1e-6) for t, b in units)
    path = scratch_path(spark, "licence-docs")
    frame.write.parquet(path)
    out = licenses.scan(spark.read.parquet(path), model)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1  # lines and paragraphs in one pass
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in out.filter("confirmed").collect()} >= {(0, 0, "MIT"), (0, 4, "MIT"), (1, 0, "ISC"), (2, 1, "GPL")}


PAGES = [(3, "http://a", "x" * 200), (1, "http://b", "x" * 200), (2, "http://c", "short"), (4, "http://d é", "short"), (5, None, None),
         (6, "http://e", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (7, "http://f\r\n", "é" * 60), (8, "http://g", "é" * 60),
         (None, "http://h", "x" * 200), (9, "http://i", "z" * 3_000_000)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = warc.archive(pages)
    back = {r["record_id"]: r for r in warc.read(spark, path).collect()}
    assert len(back) == len(PAGES)
    for i, url, html in PAGES:
        r, data = back[f"urn:page:{'' if i is None else i}"], (html or "").encode()
        assert r["target_uri"] == url and r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest()
        again = i in (3, 8) or i is None
        assert (r["record_type"], r["refers_to"]) == (("revisit", f"urn:page:{1 if i != 8 else 7}") if again else ("response", None))
        assert r["payload"] == (None if again else data) and r["actual_digest"] == (None if again else r["payload_digest"])
    assert warc.read(spark, warc.archive(pages.limit(0))).count() == 0


def test_warc_filters_and_headers_only(spark):
    path = warc.archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    heads = warc.read(spark, path, payload=False)
    assert "payload" not in heads.columns
    assert sorted(r["record_id"] for r in heads.filter("record_type = 'revisit'").collect()) == ["urn:page:", "urn:page:3", "urn:page:8"]
    assert heads.filter("target_uri LIKE 'http://a%'").count() == 1 and heads.filter("refers_to IS NULL AND payload_bytes > 100").count() == 4
    reader = warc.WarcReader({"path": path}, warc.READ_SCHEMA)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 5)]))
    assert [type(f) for f in rest] == [GreaterThan]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 3 and all(r["payload"] is None for r in rows)


def test_warc_uncommitted_files_are_not_read(spark):
    path = warc.archive(spark.createDataFrame(PAGES[:2], "page_id long, url string, html string"), scratch_path(spark, "warc-test"))
    local = path.removeprefix("file:").replace("//", "/")
    with open(f"{local}/.part-00000-0000-lost.warc.tmp", "wb") as f:
        f.write(b"WARC/1.1\r\nhalf a rec")
    assert warc.read(spark, path).count() == 2


@needs_data
def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    rows = out.select("doc_id", "shard", "slot", "size").collect()
    assert rows and {r["shard"] for r in rows} == set(range(24))
    table = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    marked = re.compile(r"\b(idiot|clown|pathetic|worthless|scum|moron|trash|disgusting|stupid|loser)\b", re.I)
    toxic = [i for i in {r["doc_id"] for r in rows} if marked.search(table[i]["text"] or "")]
    assert len(toxic) <= 5
    items = [re.sub(r"\W+", " ", r["text"]).lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(q in re.sub(r"\W+", " ", table[r["doc_id"]]["text"] or "").lower() for r in rows for q in items)
