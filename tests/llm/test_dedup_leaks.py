"""Substring dedup, the Jaccard join and decontamination against brute force."""

import hashlib
import random
import re

import pytest
from llm_frames import EDGE_ROWS, LONG, docs, lower, wide, words

from entiscore.llm import decontamination, jaccard, substrings
from entiscore.llm.components import connected


def brute_repeats(rows, window=50):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,vocabulary", [(0, 3), (1, 400), (2, 400)])
def test_substrings_against_brute_force(spark, seed, vocabulary):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    passages = [" ".join(rnd.choices(vocab, k=rnd.randint(30, 140))) for _ in range(10)]
    rows = []
    for i in range(110):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(rnd.choices(vocab, k=rnd.randint(1, 90))) for _ in range(rnd.randint(0, 6))]
        text = rnd.choice(rows)[1] if rows and rnd.random() < 0.15 else rnd.choice([" ", "\n", " \t "]).join(parts)
        rows.append((rnd.choice([i, i // 2, None]) if rnd.random() < 0.2 else i, None if rnd.random() < 0.03 else text))
    out = [tuple(r)[:4] for r in substrings.remove_repeats(docs(spark, rows)).collect()]
    assert sorted(out, key=repr) == brute_repeats(rows)


def test_substring_edge_rows(spark):
    frame, _ = wide(spark, EDGE_ROWS + [(8, LONG)])
    out = substrings.remove_repeats(frame).collect()
    assert sorted((tuple(r)[:4] for r in out), key=repr) == brute_repeats(EDGE_ROWS + [(8, LONG)])
    assert substrings.remove_repeats(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(frame, window=20)


def sets(rows, k):
    out = []
    for _, t in rows:
        w = words(lower(t))
        out.append({tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def brute_components(rows, k=4, num=85, den=100):
    found, parent = sets(rows, k), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            shared = len(found[x] & found[y])
            if shared and den * shared >= num * (len(found[x]) + len(found[y]) - shared):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[root(x)] = min(least.get(root(x), i), i)
    return sorted((i, len(found[x]), least[root(x)]) for x, (i, _) in enumerate(rows))


def near_copies(seed, groups=18):
    rnd = random.Random(seed)
    vocab, rows = [f"w{i}" for i in range(300)], []
    for _ in range(groups):
        base = rnd.choices(vocab, k=rnd.choice([1, 2, 5, 8, 20, 60, 150, 300]))
        for _ in range(rnd.choice([1, 2, 4, 12])):
            w = list(base)
            for _ in range(int(len(w) * rnd.choice([0, 0, 0.01, 0.02, 0.04, 0.08])) + (rnd.random() < 0.3)):
                p = rnd.randrange(len(w))
                op = rnd.random()
                if op < 0.4:
                    w[p] = rnd.choice(vocab)
                elif op < 0.7:
                    w.insert(p, rnd.choice(vocab))
                elif len(w) > 1:
                    del w[p]
            rows.append((len(rows), " ".join(w) if rnd.random() < 0.9 else "\n".join(w).upper()))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n")]


@pytest.mark.parametrize("seed,k,num", [(0, 4, 85), (1, 4, 85), (2, 5, 80)])
def test_components_against_brute_force(spark, seed, k, num):
    rows = near_copies(seed)
    out = jaccard.components(docs(spark, rows), k, num, keep=["doc_id"])
    want = brute_components(rows, k, num)
    assert sorted(map(tuple, out.collect())) == want
    kept = [r["doc_id"] for r in jaccard.keep_one(docs(spark, rows), k, num).collect()]
    assert sorted(kept) == sorted({c for _, _, c in want})


def test_linked_sets_share_a_sketch_word():
    """Whatever the differences, two sets within the budget have an equal word in some sketch."""
    import numpy as np

    rnd = np.random.default_rng(3)
    for n in (8, 20, 60, 147, 500):
        for _ in range(25):
            a = rnd.integers(0, 2**63, n).astype(np.uint64)
            most = jaccard.most_different(n, n, 85, 100)
            cut, new = rnd.integers(0, most // 2 + 1, 2)
            b = np.concatenate([a[cut:], rnd.integers(0, 2**63, new).astype(np.uint64)])
            if np.array_equal(a, b) or 100 * (n - cut) < 85 * (n + new):
                continue
            words = [np.concatenate([k for k, _, _ in jaccard._class_keys(len(x), 0, x, 85, 100)]) for x in (a, b)]
            assert len(np.intersect1d(*words))


def test_jaccard_edge_rows(spark):
    frame, names = wide(spark, EDGE_ROWS)
    out = {(r["doc_id"], r["text"]): (r["n_shingles"], r["component_id"]) for r in jaccard.components(frame).collect()}
    assert out[(1, None)] == (0, 1) and out[(2, "")] == (0, 2) and out[(4, "one")] == (1, 4)
    assert out[(None, "a text without an id")] == out[(7, "a text without an id")] == (2, 7)
    assert jaccard.components(frame).count() == len(EDGE_ROWS) and {"node", "score"} <= set(jaccard.components(frame).columns)
    one = jaccard.keep_one(frame)
    assert one.columns == frame.columns and sorted(r["doc_id"] for r in one.collect()) == [1, 2, 3, 4, 5, 7]
    assert jaccard.components(docs(spark, [])).count() == 0 and jaccard.keep_one(docs(spark, [])).count() == 0


def test_near_copies_without_an_id(spark):
    base = [f"w{i}" for i in range(120)]
    near, far = " ".join([*base[:119], "other"]), " ".join(f"x{i}" for i in range(60))
    rows = [(None, " ".join(base)), (None, near), (None, near), (None, far), (3, far + " end"), (3, "else"), (3, "else")]
    out = sorted(((r["doc_id"], r["text"], r["component_id"]) for r in jaccard.components(docs(spark, rows)).collect()), key=repr)
    assert out == sorted([(i, t, 3 if t[0] != "w" else None) for i, t in rows], key=repr)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(docs(spark, rows)).collect()]
    assert len(kept) == 3 and sorted(kept[0:3], key=repr)[:2] == [(3, "else"), (3, far + " end")]
    assert [i for i, _ in kept].count(None) == 1


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    out = {r["node"]: r["root"] for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


ALNUM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def sellers(pattern, text):
    row, out = list(range(len(pattern) + 1)), [len(pattern)]
    for w in text:
        now = [0]
        for i, x in enumerate(pattern):
            now.append(min(row[i] + (x != w), row[i + 1] + 1, now[i] + 1))
        row = now
        out.append(row[-1])
    return out


def test_bit_parallel_distance():
    rnd = random.Random(0)
    for _ in range(400):
        p = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 12))]
        t = [rnd.randint(0, 3) for _ in range(rnd.randint(0, 30))]
        assert decontamination.distance(p, t) == sellers(p, t)


def test_leaks_against_brute_force(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([3, 8, 10, 15, 25, 40])))) for i in range(25)] + [(90, None), (91, "")]
    rows = []
    for i in range(100):
        parts = [" ".join(rnd.choices(vocab, k=rnd.randint(0, 80)))]
        for _ in range(rnd.randint(0, 2)):
            w = (rnd.choice(items)[1] or "").split()
            for _ in range(rnd.randint(0, 5) if w else 0):
                k = rnd.randrange(len(w))
                w[k:k + 1] = rnd.choice([["zz"], ["yy", w[k]], [] if len(w) > 1 else w[k:k + 1]])
            parts += [rnd.choice([" , ", ". "]).join(w).upper(), " ".join(rnd.choices(vocab, k=rnd.randint(0, 20)))]
        rows.append((None if i == 5 else i // 2 if i % 7 == 0 else i, " ".join(parts) if i else None))
    tokens = lambda t: ALNUM.findall(lower(t))
    want = set()
    for i, t in rows:
        for j, q in items:
            p = tokens(q)
            if len(p) >= decontamination.LEAST_WORDS and (d := min(sellers(p, tokens(t)))) <= int(0.1 * len(p) + 1e-9):
                want.add((i, j, d))
    frame, listed = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.leaks(frame, listed).collect()
    assert {(r["doc_id"], r["item_id"], r["errors"]) for r in got} == want
    clean = decontamination.clean(frame, listed)
    held = [t for i, t in rows if not any(min(sellers(tokens(q), tokens(t))) <= int(0.1 * len(tokens(q)) + 1e-9)
                                           for _, q in items if len(tokens(q)) >= decontamination.LEAST_WORDS)]
    assert sorted(map(repr, (r["text"] for r in clean.collect()))) == sorted(map(repr, held))


def test_short_and_unspaced_items_are_found(spark, tmp_path):
    import corpus_pipeline
    from entiscore.llm import queries

    zh = "今天的天气非常好，我们一起去公园散步吧。"
    items = [(1, "Paris"), (2, "what is love"), (3, zh), (4, "สวัสดีครับ"), (5, "one “two” three four five six seven eight—nine"), (6, None), (7, " . ")]
    rows = [(10, "He went to Paris, then home."), (11, "Parisian life"), (12, "So: what is   LOVE?"), (13, "开头" + zh.replace("，", " ").replace("非", "很") + "结尾"),
            (14, "ก่อนสวัสดีครับ"), (15, 'x one\u00a0"two" three four five six seven eight - nine y'), (16, "今天的天气"), (17, None), (18, "what love is")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["item_id"], r["errors"]) for r in queries.op6_decontamination(spark, str(tmp_path)).collect()}
    assert got == {(10, 1, 0), (12, 2, 0), (13, 3, 1), (14, 4, 0), (15, 5, 0)}
    left = corpus_pipeline.drop_leaks(spark, docs(spark, rows), str(tmp_path))
    assert {r["doc_id"] for r in left.collect()} == {11, 16, 17, 18}


def test_leak_edge_rows(spark):
    frame, _ = wide(spark, EDGE_ROWS)
    item = [(1, " ".join(LONG.split()[500:520])), (2, "one"), (3, None)]
    items = spark.createDataFrame(item, "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"], r["errors"]) for r in decontamination.leaks(frame, items).collect()) == [(5, 1, 0)]
    left = decontamination.clean(frame, items)
    assert left.columns == frame.columns and left.count() == len(EDGE_ROWS) - 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(frame, none).count() == len(EDGE_ROWS) and decontamination.leaks(docs(spark, []), items).count() == 0
