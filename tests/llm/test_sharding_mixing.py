"""Sharding and mixing against brute force."""

import random

import pytest
from llm_frames import EDGE_ROWS, docs, wide, words
from pyspark.sql import functions as F

from entiscore.llm import mixing, sharding


def greedy(sizes, shards):
    """Smallest capacity by trying the greedy check on all groups."""
    def fits(c):
        used, at = 1, 0
        for s in sizes:
            if s > c:
                return False
            if at + s > c:
                used, at = used + 1, 0
            at += s
        return used <= shards
    low, high = -(-sum(sizes) // shards), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed,hot", [(0, 0), (1, 0), (2, 1500)])
def test_capacity_is_the_smallest_and_groups_stay_whole(spark, seed, hot):
    rnd = random.Random(seed)
    rows = [(i, None if rnd.random() < 0.02 else "x" * rnd.randint(0, 40) + str(rnd.randint(0, 2000))) for i in range(3000)]
    rows += [(10_000 + i, "hot") for i in range(hot)]
    frame = docs(spark, rows)
    out = sharding.shard(frame, 24).collect()
    keys = {r[0]: r[1] for r in frame.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).distinct().collect()}
    groups = {}
    for _, t in rows:
        groups[keys[t or ""]] = groups.get(keys[t or ""], 0) + len((t or "").encode()) + 8
    want = greedy([groups[k] for k in sorted(groups)], 24)
    held, slots, places = {}, {}, {}
    for r in out:
        held[r["shard"]] = held.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        places.setdefault(r["text"] or "", set()).add(r["shard"])
    assert len(out) == len(rows) and max(held.values()) <= want == out[0]["capacity"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in places.values())
    if not hot:
        assert len(held) == 24


def test_sharding_edge_rows(spark):
    frame, names = wide(spark, EDGE_ROWS)
    out = sharding.shard(frame, 3)
    assert out.count() == len(EDGE_ROWS) and {"node", "score"} <= set(out.columns)
    assert out.filter("text IS NULL").first()["size"] == 8
    assert sharding.shard(docs(spark, []), 3).count() == 0


def fill(sizes, weights, most=3):
    """Targets by resharing what passes the cap until nothing does."""
    free, out, left = set(sizes), {}, sum(sizes.values())
    while free:
        total = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / total > most * sizes[k]]
        for k in over or free:
            out[k] = most * sizes[k] if over else left * weights[k] / total
        free -= set(over or free)
        left = sum(sizes.values()) - sum(out.values())
    return out


@pytest.mark.parametrize("seed", range(3))
def test_mix_targets_and_taken(spark, seed):
    rnd = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(rnd.randint(1, 6)))]
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 3, 50])) or None, rnd.choices(names, [1, *[7 ** (j % 3) for j in range(len(names) - 1)]])[0]) for i in range(400)]
    frame = docs(spark, rows, "doc_id long, text string, source string")
    out = mixing.mix(frame).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    taken = {}
    for r in out:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6) and 0 <= r["taken"] <= 3 * r["size"]
        assert len(r["positions"]) == r["passes"] + (r["cut"] > 0) and all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert len(out) == len(rows) and all(abs(taken[s] - want[s]) <= 1 for s in taken)
    again = mixing.mix(frame.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_curriculum_inverse(spark):
    for knots in (*mixing.CURRICULUM, ((0.0, 0.0), (0.25, 2.0), (1.0, 1.0))):
        shares = [i / 20 for i in range(21)]
        rows = spark.createDataFrame([(s,) for s in shares], "s double")
        got = [r[0] for r in rows.select(mixing.progress_at(F.col("s"), knots)).collect()]

        def area(t):
            done = 0.0
            for (a, x), (b, y) in zip(knots, knots[1:], strict=False):
                e = min(max(t, a), b)
                done += (e - a) * (x + x + (y - x) * (e - a) / (b - a)) / 2
            return done / mixing.schedule_area(knots)
        assert got == sorted(got) and all(area(t) == pytest.approx(s, abs=1e-9) for s, t in zip(shares, got, strict=True))


def test_training_order(spark):
    rows = [(1, "a b c d e f", "s0", 11), (2, "g  h", "s0", 4), (3, "x " * 40, "s1", 80), (4, "", "s2", 0)]
    frame = docs(spark, rows, "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(frame)
    used = {r["doc_id"]: r["taken"] for r in plan.collect()}
    stream = mixing.training_order(plan).collect()
    assert [r["position"] for r in stream] == sorted(r["position"] for r in stream)
    got = {}
    for r in stream:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert got == {k: v for k, v in used.items() if v}


def test_training_order_keeps_whole_texts(spark):
    rows = [(i, f"a{i}\n b\tc " * (1 + i % 7), f"s{i % 3}", 0) for i in range(60)] + [(None, "x\n\ny " * 90, "s1", 0), (3, "one more\n", None, 0)]
    frame = docs(spark, rows, "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(frame)
    used = {(r["doc_id"], r["text"]): (r["passes"] + (r["cut"] > 0), r["source"], r["target"]) for r in plan.collect()}
    stream = mixing.training_order(plan, whole=True).collect()
    seen, taken = {}, {}
    for r in stream:
        key = (r["doc_id"], r["text"])
        seen[key] = seen.get(key, 0) + 1
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    assert {tuple(r)[:2] for r in rows} >= set(seen)  # every text as it came, byte for byte
    assert seen == {k: u for k, (u, _, _) in used.items() if u}
    longest = max(len(words(t)) for _, t, _, _ in rows)
    for source, target in {(s, t) for _, s, t in used.values()}:
        assert round(target) <= taken[source] < round(target) + longest


def test_rows_without_id_are_spread(spark):
    rows = [(None if i % 3 else i, f"text {i}", "s") for i in range(3000)]
    out = mixing.mix(docs(spark, rows, "doc_id long, text string, source string"), bucket_rows=30)
    sums = mixing.mix(docs(spark, rows, "doc_id long, text string, source string"), bucket_rows=30).selectExpr("sum(taken)").first()[0]
    assert out.count() == 3000 and sums == 6000
    key = F.shiftright(F.xxhash64(F.lit(17), "doc_id", "text"), 64 - 7)
    sizes = [r["count"] for r in docs(spark, rows, "doc_id long, text string, source string").groupBy(key).count().collect()]
    assert max(sizes) <= 4 * 3000 / 128


def test_mixing_edge_rows(spark):
    frame, _ = wide(spark, EDGE_ROWS)
    out = mixing.mix(frame)
    assert out.count() == len(EDGE_ROWS) and out.filter("size = 0 AND (taken > 0 OR size(positions) > 0)").count() == 0
    assert mixing.training_order(out).count() >= 1
    assert mixing.mix(docs(spark, [], "doc_id long, text string, source string")).count() == 0
    blank = docs(spark, [(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(blank).select("taken", "target").collect()] == [(0, 0.0), (0, 0.0)]
