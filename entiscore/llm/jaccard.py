"""N-gram Jaccard join with parity sketches.

A document's set holds its distinct word shingles; two documents link if the
Jaccard similarity of their sets reaches a threshold. The join is exact:

1. Equal sets form one class, found by a hash of the set; classes are joined.
2. A shingle that one class alone has can be in no intersection. A class with
   too many of them to reach the threshold links with none and is left out;
   from the others they are taken off, and count against the budget of
   differences. (First on a hash sample of shingles over all texts, then on
   all shingles of the classes that are left.)
3. Parity sketches. In a size band a sketch has ``p`` words; each shingle
   XORs its hash into one of them. A shingle in one of two sets but not in
   both changes at most one word, so the number of differing words is at most
   the symmetric difference, which the threshold bounds by d. Neighbouring
   words XOR into coarser sketches of p/2, p/4, ... words. For each pair the
   budget d that its sizes and lone shingles leave fixes the coarsest sketch
   with more words than d has room for, and by the pigeonhole principle two
   linked sets agree in a word of it.
4. Candidates. Classes with an equal sketch word form a bucket. First each is
   compared with one of the bucket (that with fewest lone shingles), and
   verified pairs make components; then only buckets that still hold several
   components give pairs, across components, and only those whose budget
   belongs to that sketch. Groups of copies are so joined in linear time.
5. Verification. Set sizes and the exact intersection decide each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.components import connected
from entiscore.llm.tables import discard, fresh, stored

SAMPLE = 4          # one of so many shingles is counted over all texts
SLACK = (5, 4)      # words of a sketch for each allowed difference, as a fraction


class Sets:
    """Distinct shingle hashes of the texts of a slice."""

    def __init__(self, column: pa.Array, k: int):
        words = tx.Words(tx.Texts(column, lower=True))
        self.n, self.k, self.first, self.counts = words.texts.n, k, words.first, words.counts
        self.hashes = words.hashes()
        self.all = tx.shingles(self.hashes, k)

    def of(self, i: int) -> np.ndarray:
        a, b = int(self.first[i]), int(self.first[i + 1])
        if b - a >= self.k:
            return np.unique(self.all[a:b - self.k + 1])
        if b == a:
            return np.zeros(0, np.uint64)
        return tx.word_span_hash(self.hashes[a:b], np.array([0]), np.array([b - a]))


def set_id(values: np.ndarray) -> int:
    """64-bit hash of a set, as a Spark long."""
    total = tx.mix64(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(np.array([total], np.uint64).view(np.int64)[0])


def most_different(n: int, m: int, num: int, den: int) -> int:
    """The largest symmetric difference of linked sets of n and m elements:
    from den * I >= num * (n + m - I)."""
    return (den - num) * (n + m) // (den + num)


def _bands(num: int, den: int, most: int) -> list[int]:
    """First sizes of the bands; a band reaches up to 1.5 times its first size.
    A linked partner of a larger size is in the same band or the next."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 3 // 2 + 1)
    return out


def sketch_words(high: int, num: int, den: int) -> int:
    """Words of the finest sketch for pairs whose smaller set has at most ``high`` elements."""
    d = most_different(high, high * den // num, num, den)
    return SLACK[0] * d // SLACK[1] + 2 if d else 0


def has_room(words, budget):
    """A sketch of so many words serves the budget (ints or columns)."""
    return words * SLACK[1] >= budget * SLACK[0] + SLACK[1]


def _class_keys(n: int, lone: int, rest: np.ndarray, num: int, den: int) -> Iterator[tuple]:
    """(keys, words, level) of a class: one key for each sketch word that some
    partner's budget can ask for."""
    bands = _bands(num, den, n)
    band_of = lambda size: max(i for i, low in enumerate(bands) if low <= size)
    for band in sorted({band_of(n), band_of(-(-n * num // den))}):
        high = bands[band] * 3 // 2
        words = sketch_words(high, num, den)
        largest = most_different(high, high * den // num, num, den) - lone
        if not words or largest < 0:
            continue
        place = (tx.mix64(rest + np.uint64(0x1234567)) % np.uint64(words)).astype(np.int64)
        sketch = np.zeros(words, np.uint64)
        np.bitwise_xor.at(sketch, place, tx.mix64(rest))
        level = 0
        while True:
            size = len(sketch)
            # Budgets for which the next coarser sketch has no room belong to this one.
            if size == 1 or not has_room(-(-size // 2), largest):
                at = np.flatnonzero(sketch)
                served = min(largest, (size - 1) * SLACK[1] // SLACK[0])
                if size - len(at) >= size - served:
                    at = np.arange(size)  # so many zero words that an equal one may be zero
                tag = tx.mix64(np.uint64((band * 64 + level) << 32) + at.astype(np.uint64))
                yield tx.signed(tx.mix64(sketch[at] ^ tag)), words, level
            if size == 1:
                break
            if size % 2:
                sketch = np.concatenate([sketch, np.zeros(1, np.uint64)])
            sketch, level = sketch[0::2] ^ sketch[1::2], level + 1


def _keys(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = tx.column_of(batch, "rest")
            for i, (node, n, lone) in enumerate(zip(*(tx.column_of(batch, c).to_pylist() for c in ("node", "n", "lone")), strict=True)):
                rest = np.asarray(rests[i].values).view(np.uint64)
                for keys, words, level in _class_keys(n, lone, rest, num, den):
                    m = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(np.full(m, node)), *(pa.array(np.full(m, v, np.int32)) for v in (n, lone, words, level))],
                        ["key", "node", "n", "lone", "words", "level"])
    return run


PARITY = 4  # 64-bit words of the bit sketch


def _parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit sketches: each shingle flips one bit, so the number of bits in which
    two sketches differ is at most the symmetric difference."""
    for batch in batches:
        words = np.zeros((PARITY, batch.num_rows), np.uint64)
        for i, values in enumerate(tx.column_of(batch, "rest")):
            h = tx.mix64(np.asarray(values.values).view(np.uint64) ^ np.uint64(0x6A09E667F3BCC909))
            np.bitwise_xor.at(words[:, i], (h >> np.uint64(32)) % np.uint64(PARITY), np.uint64(1) << (h & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([tx.column_of(batch, "node"), *(pa.array(tx.signed(w)) for w in words)],
                                         ["node", *(f"p{j}" for j in range(PARITY))])


def _sampled(k: int, sample: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            sets = Sets(tx.column_of(part, "text"), k)
            for i in range(sets.n):
                values = sets.of(i)
                some = values[tx.mix64(values) % np.uint64(sample) == 0]
                yield pa.RecordBatch.from_arrays([pa.array(tx.signed(some)), pa.array(np.full(len(some), set_id(values)))], ["s", "node"])
    return run


def _whole(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            sets, nodes, ns, values = Sets(tx.column_of(part, "text"), k), [], [], []
            for i, want in enumerate(tx.column_of(part, "node").to_pylist()):
                own = sets.of(i)
                if set_id(own) == want:  # another row with the same id may have another text
                    nodes.append(want)
                    ns.append(len(own))
                    values.append(tx.signed(own))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(ns, pa.int32()), pa.array(values, pa.list_(pa.int64()))],
                                             ["node", "n", "shingles"])
    return run


def _row(id_col: str, text_col: str) -> Column:
    """Key of a row's id and text, null ids included: two 64-bit hashes."""
    return F.struct(F.xxhash64(id_col, text_col).alias("x"), F.xxhash64(text_col, id_col, F.lit(1)).alias("y"))


def signatures(docs: DataFrame, k: int, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns, ``n_shingles`` and ``node`` (hash of the shingle set; null if it is empty)."""
    h = fresh(docs.select(*keep), "text", "node", "n_shingles")
    carried = docs.select(*keep, F.col(text_col).alias(h["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, h["text"]):
            sets = Sets(tx.column_of(part, h["text"]), k)
            values = [sets.of(i) for i in range(sets.n)]
            yield pa.RecordBatch.from_arrays([*(tx.column_of(part, c) for c in keep), pa.array([len(v) for v in values], pa.int64()),
                                              pa.array([set_id(v) if len(v) else None for v in values], pa.int64())],
                                             [*keep, h["n_shingles"], h["node"]])

    out = T.StructType([carried.schema[c] for c in keep]).add(h["n_shingles"], T.LongType()).add(h["node"], T.LongType())
    return carried.mapInArrow(run, out)


def _lone(rows: DataFrame) -> DataFrame:
    """``s, node`` of the shingles that one class alone has."""
    return rows.groupBy("s").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other").select("s", "node")


def _fits(x: str, y: str, num: int, den: int) -> tuple[Column, Column]:
    """(sizes and lone shingles allow a link, budget of differences that is left)."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    budget = F.floor((den - num) * (n + m) / F.lit(den + num)) - F.col(f"{x}lone") - F.col(f"{y}lone")
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & (budget >= 0), budget


def _verified(pairs: DataFrame, rest: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link: the exact intersection decides."""
    side = lambda c: rest.select(F.col("node").alias(c), F.col("n").alias(f"{c}n"), F.col("rest").alias(f"{c}r"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("ar", "br"))
    return both.filter(den * shared >= num * (F.col("an") + F.col("bn") - shared)).select("a", "b")


def links(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
          sig: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(classes ``node, n, doc, row``; ``node, root`` of the classes that link
    to another). ``doc`` is the smallest id of a class and ``row`` the key of a
    row that has it. ``sig`` has ``doc, row, n_shingles, node`` of the rows, if
    at hand."""
    if 3 * num < 2 * den:
        raise ValueError("size bands reach 1.5 times their first size: the threshold has to be two thirds or more")
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), _row(id_col, text_col).alias("row"))
    if sig is None:
        sig = signatures(docs, k, "text", ["doc", "row"])
    # One row stands for a class, found by its key, so rows without an id take part.
    classes = (sig.filter("node IS NOT NULL").groupBy("node")
               .agg(F.first("n_shingles").cast("int").alias("n"), F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("w"))
               .select("node", "n", F.col("w.doc").alias("doc"), F.col("w.row").alias("row")))
    lone = _lone(docs.select("text").mapInArrow(_sampled(k, SAMPLE), "s long, node long")).groupBy("node").agg(
        F.count("*").alias("lone"))
    enough = den * (F.col("n") - F.coalesce(F.col("lone"), F.lit(0))) >= num * F.col("n")
    left = classes.join(lone, "node", "left").filter(enough).select("node", "row")
    texts = docs.select("row", "text").join(left, "row").select("text", "node")
    whole = stored(texts.mapInArrow(_whole(k), "node long, n int, shingles array<long>"), "jaccard-left")
    alone = _lone(whole.select("node", F.explode("shingles").alias("s"))).groupBy("node").agg(F.collect_list("s").alias("alone"))
    # Repeated rows have brought their text once each.
    rest = whole.dropDuplicates(["node"]).join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.array().cast("array<long>")))
    rest = rest.withColumn("lone", F.size("alone")).filter(enough)
    rest = stored(rest.select("node", "n", "lone", F.array_except("shingles", "alone").alias("rest")), "jaccard-rest")
    discard(whole)
    keys = stored(rest.mapInArrow(_keys(num, den), "key long, node long, n int, lone int, words int, level int"), "jaccard-keys")

    # Each class with one of its bucket.
    chief = (keys.groupBy("key").agg(F.min(F.struct("lone", "node", "n")).alias("c"), F.min("node").alias("x"), F.max("node").alias("y"))
             .filter("x < y").select("key", F.col("c.node").alias("c_node"), F.col("c.n").alias("c_n"), F.col("c.lone").alias("c_lone")))
    star = keys.withColumnsRenamed({"n": "o_n", "lone": "o_lone"}).join(chief, "key").filter(F.col("node") != F.col("c_node"))
    ok, _ = _fits("o_", "c_", num, den)
    first = stored(star.filter(ok).select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct(), "jaccard-pairs")
    found = stored(_verified(first, rest, num, den), "jaccard-links")
    roots = connected(found)

    # What the buckets still hold across components.
    named = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("key")
    bits = [f"p{j}" for j in range(PARITY)]
    several = stored(named.join(mixed, "key"), "jaccard-mixed")
    discard(keys)
    named = several.join(
        rest.mapInArrow(_parity, ", ".join(["node long", *(f"{b} long" for b in bits)])), "node")
    x = named.select("key", *(F.col(c).alias(f"x_{c}") for c in ("node", "n", "lone", "root", *bits)), "words", "level")
    y = named.select(F.col("key").alias("y_key"), *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "lone", "root", *bits)))
    ok, budget = _fits("x_", "y_", num, den)
    differing = sum((F.bit_count(F.col(f"x_{b}").bitwiseXOR(F.col(f"y_{b}"))) for b in bits), F.lit(0))
    ok = ok & (differing <= budget)
    size = lambda level: F.ceil(F.col("words") / F.pow(F.lit(2.0), level))
    here = has_room(size(F.col("level")), budget) & ((size(F.col("level")) == 1) | ~has_room(size(F.col("level") + 1), budget))
    cross = x.join(y, (F.col("key") == F.col("y_key")) & (F.col("x_node") < F.col("y_node")) & (F.col("x_root") != F.col("y_root")) & ok & here)
    second = cross.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = stored(_verified(second, rest, num, den), "jaccard-links")
    discard(rest, several, first)
    return classes, connected(found.unionByName(more))


def components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """Every row with ``n_shingles`` and ``component_id``: the smallest id that
    links reach from it, its own included.

    Two texts link if ``den * shared >= num * union`` over their distinct
    ``k``-word shingles (words lower-cased for A-Z; a text of fewer words has
    its whole sequence as one). Null, empty and blank texts have no shingles
    and link with nothing. Rows with equal sets are one class: repeated rows
    fall together, rows that share an id with different texts stay apart, and
    rows with a null id get the smallest id of their component, if any. An
    empty table gives an empty result. Input columns named like an output are
    replaced. ``keep`` names the columns to carry.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_shingles", "component_id")]
    carry = keep if id_col in keep else [id_col, *keep]
    h = fresh(docs, "node", "row")
    rows = signatures(docs.withColumn(h["row"], _row(id_col, text_col)), k, text_col, [*carry, h["row"]])
    if set(carry) <= {id_col}:  # narrow enough to be kept instead of made again
        rows = stored(rows, "jaccard-sets")
    sig = rows.select(F.col(id_col).alias("doc"), F.col(h["row"]).alias("row"), "n_shingles", F.col(h["node"]).alias("node"))
    classes, roots = links(docs, k, num, den, id_col, text_col, sig)
    grown = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grown.groupBy("root").agg(F.min("doc").alias("least"))
    named = grown.join(least, "root").select(F.col("node").alias("c_node"), F.col("least").alias("component_id"))
    rows = rows.join(named, F.col(h["node"]) == F.col("c_node"), "left")
    own = F.when(F.col("n_shingles") == 0, F.col(id_col)).otherwise(F.col("component_id"))
    return rows.select(*keep, "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of linked texts (a row with its smallest id; a
    null id only if there is no other), columns as they are. Rows without
    shingles link with nothing and stay."""
    h = fresh(docs, "row", "c_row")
    plain = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    sig = stored(signatures(plain.select("*", _row("doc", "text").alias("row")), k, "text", ["doc", "row"]), "jaccard-sets")
    classes, roots = links(plain, k, num, den, "doc", "text", sig)
    best = (classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
            .agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("w"))
            .select(F.col("w.row").alias(h["c_row"])))
    # Repeated rows become one before the shuffle; then each winner meets one row.
    rows = docs.withColumn(h["row"], _row(id_col, text_col)).dropDuplicates([h["row"]])
    chosen = rows.join(best, F.col(h["row"]) == F.col(h["c_row"])).select(*docs.columns)
    return chosen.unionByName(docs.filter(~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))))
