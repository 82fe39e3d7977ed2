"""Ranked lexical search by an Aho-Corasick scan of the documents.

No index of the documents is made. The items, a stated set of queries, are
taken in blocks of bounded size. A block's distinct terms make one automaton in
which every term stands between two guards; the documents are read with
everything but terms turned into guards, so that the automaton finds whole
terms only. Each output of the automaton is a term number, and a posting list
maps it to the block's items. Two scans per block are made: one counts in how
many documents each term stands, the other scores documents as their counts
come and keeps the best of each item.

Scores follow an integer form of BM25, see :func:`search`.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.tables import stored

BLOCK_BYTES = 1 << 20   # of item text in a block; a longer item makes a block of its own
PIECE_BYTES = 1 << 22   # of document text that the automaton takes at once
CELLS = 1 << 22         # of the score table of some documents by a block's items
PARTS = 256             # groups of items in which block numbers are summed up
SALTS = 64              # groups of documents in which an item's best are found first

_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _TERM[_a:_b] = True
_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_GUARD = 0x20


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, only A-Z lower-cased."""
    return [t.encode().lower() for t in _TERMS.findall(text or "")]


class Block:
    """Items of one block: automaton of their terms, and for each term the items that hold it."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        counts = [Counter(terms_of(t)) for _, t in items]
        self.terms = sorted(set().union(*counts))
        number = {t: n for n, t in enumerate(self.terms)}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for term, n in number.items():
            self.automaton.add_word(f" {term.decode('latin-1')} ", n)
        if self.terms:
            self.automaton.make_automaton()
        postings = np.array([(number[t], i, c) for i, held in enumerate(counts) for t, c in held.items()], np.int64).reshape(-1, 3)
        postings = postings[np.argsort(postings[:, 0], kind="stable")]
        self.first = np.searchsorted(postings[:, 0], np.arange(len(self.terms) + 1))
        self.items, self.times = postings[:, 1].copy(), postings[:, 2].copy()

    @functools.cached_property
    def longest(self) -> int:
        return max(map(len, self.terms), default=0) + 2


def _pieces(buffer: np.ndarray, longest: int, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of the buffer from guard to guard, of at most about ``limit`` bytes.
    A run without a guard that is longer than every term is left out: no term can stand in it."""
    limit = max(limit, longest)
    guards = np.flatnonzero(buffer == _GUARD)
    at, end = 0, len(buffer) - 1
    while at < end:
        to = int(guards[np.searchsorted(guards, at + limit, "right") - 1])
        if to > at:
            yield at, to + 1
        else:
            to = int(guards[np.searchsorted(guards, at, "right")])
        at = to


class Counted:
    """Terms of a block in a slice of texts: (document, term, times) by document, and every document's number of terms."""

    def __init__(self, column: pa.Array, block: Block):
        texts = tx.Texts(column, lower=True)
        self.lengths = tx.Words(texts, _TERM).counts.astype(np.int64)
        guards = texts.offsets + np.arange(texts.n + 1)  # one before each text, one behind the last
        buffer = np.insert(np.where(_TERM[texts.data], texts.data, np.uint8(_GUARD)), texts.offsets, _GUARD)
        found = []
        for a, b in _pieces(buffer, block.longest) if block.terms else ():
            hits = np.fromiter(itertools.chain.from_iterable(block.automaton.iter(buffer[a:b].tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
            found.append(np.stack([np.searchsorted(guards, hits[:, 0] + a) - 1, hits[:, 1]]))
        doc, term = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        key, self.times = np.unique(doc * max(1, len(block.terms)) + term, return_counts=True)
        self.doc, self.term = np.divmod(key, max(1, len(block.terms)))


def _statistics(shared: Broadcast, text_col: str):
    """Rows (term number, documents with it); -1: documents with a term, -2: all terms with repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        df, n, total = np.zeros(len(block.terms), np.int64), 0, 0
        for part in tx.slices(batches, text_col):
            c = Counted(tx.column_of(part, text_col), block)
            df += np.bincount(c.term, minlength=len(df))
            n += int((c.lengths > 0).sum())
            total += int(c.lengths.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], held]), pa.int64()), pa.array(np.concatenate([[n, total], df[held]]), pa.int64())], ["term", "n"])
    return run


def _scores(c: Counted, block: Block, weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first document, scores of some documents by all items), for groups of documents that keep within ``CELLS``."""
    middle = np.array([75 + 25 * n * n_docs // n_terms for n in c.lengths.tolist()], np.int64)
    times = c.times.astype(np.int64)
    gain = weights[c.term] * ((1_000_000_000 * times) // (1000 * times + 12 * middle[c.doc]))
    lists = block.first[c.term + 1] - block.first[c.term]
    work = np.concatenate([[0], np.cumsum(np.bincount(c.doc, lists, minlength=len(c.lengths)) + len(block.ids))])
    bounds = np.searchsorted(c.doc, np.arange(len(c.lengths) + 1))
    at = 0
    while at < len(c.lengths):
        to = max(at + 1, int(np.searchsorted(work, work[at] + CELLS, "right")) - 1)
        own = slice(int(bounds[at]), int(bounds[to]))
        n = lists[own]
        spread = np.repeat(np.arange(len(n)), n)
        post = np.arange(len(spread)) + (block.first[c.term[own]] - np.concatenate([[0], np.cumsum(n)])[:-1])[spread]
        table = np.zeros((to - at, len(block.ids)), np.int64)
        np.add.at(table.reshape(-1), (c.doc[own] - at)[spread] * len(block.ids) + block.items[post], gain[own][spread] * block.times[post])
        yield at, table
        at = to


def _best(pairs: pa.Table, k: int, floor: np.ndarray) -> pa.Table:
    """The k best rows of each item; ``floor`` gets the k-th score of items that have so many."""
    pairs = pairs.sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    item = pairs["item"].to_numpy()
    rank = np.arange(len(item)) - np.searchsorted(item, item)
    last = np.flatnonzero(rank == k - 1)
    floor[item[last]] = pairs["score"].to_numpy()[last]
    return pairs.filter(pa.array(rank < k))


def _search(shared: Broadcast, weighing: Broadcast, k: int, id_type: pa.DataType, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        weights, n_docs, n_terms = weighing.value
        floor = np.ones(len(block.ids), np.int64)
        empty = pa.table({"item": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "id": pa.array([], id_type)})
        best, fresh, waiting = empty, [], 0
        for part in tx.slices(batches, "text"):
            ids = tx.column_of(part, "id")
            for at, table in _scores(Counted(tx.column_of(part, "text"), block), block, weights, n_docs, n_terms):
                doc, item = np.nonzero(table >= floor)
                fresh.append(pa.table({"item": pa.array(item, pa.int64()), "score": pa.array(table[doc, item]), "id": ids.take(pa.array(doc + at))}))
                waiting += len(doc)
                if waiting > 4 * k * len(floor) + CELLS // 16:
                    best, fresh, waiting = _best(pa.concat_tables([best, *fresh]), k, floor), [], 0
        best = _best(pa.concat_tables([best, *fresh]), k, floor)
        for b in best.combine_chunks().to_batches():
            ordinal = b.column(0)
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, item_type).take(ordinal), ordinal, b.column(2), b.column(1)], ["item_id", "item", "id", "score"])
    return run


def _in_blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The distinct items with a number of their block, stored; and the number of blocks. A block
    begins at a multiple of ``block_bytes`` of the item texts in hash order; the only
    rows that the driver gets are the sums of ``PARTS`` hash groups."""
    h, size = F.xxhash64("item_id", "text"), F.octet_length("text") + F.lit(16)
    listed = (items.where(F.col("text").isNotNull()).dropDuplicates().withColumns({"h": h, "size": size.cast("long")})
              .withColumn("part", F.pmod("h", F.lit(PARTS)).cast("int")))
    sums = {r["part"]: r["n"] for r in listed.groupBy("part").agg(F.sum("size").alias("n")).collect()}
    before = list(itertools.accumulate((sums.get(p, 0) for p in range(PARTS)), initial=0))
    earlier = Window.partitionBy("part").orderBy("h", "item_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("part") + 1)
    at = start + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    return stored(listed.select("item_id", "text", "h", F.floor(at / F.lit(block_bytes)).cast("long").alias("block")), "search-items"), -(-before[-1] // block_bytes)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    Terms are maximal runs of ASCII letters and digits and of all characters
    beyond ASCII; only A-Z are lower-cased. N counts the documents with a term,
    L all their terms, n those of one document, df the documents with a term,
    tf its occurrences in the document. A term weighs
    ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document has
    ``m = 75 + (25 n N) div L``, and scores the sum over the item's terms,
    repeats included, of ``w * ((10^9 tf) div (1000 tf + 12 m))``. Documents
    with a score above 0 are ranked by it, equal ones by ascending id, a null
    id last.

    Null and empty texts hold no term: such documents are not counted in N and
    never found, such items have no result. Every row is a document of its own,
    repeated ids and repeated rows too. Equal rows of ``items`` are one item;
    other texts under one id are ranked by themselves. Empty tables give an
    empty result. Columns that are not named are not read. The output has
    ``item_col`` and ``id_col`` under these names, whatever the types.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    listed, n_blocks = _in_blocks(asked, block_bytes)
    out = T.StructType([listed.schema["item_id"], T.StructField("item", T.LongType()), rows.schema["id"], T.StructField("score", T.LongType())])
    arrow = rows.limit(0).toArrow().schema.field("id").type, asked.limit(0).toArrow().schema.field("item_id").type
    found = spark.createDataFrame([], T.StructType([*out, T.StructField("block", T.IntegerType())]))
    n_docs = n_terms = None
    for b in range(n_blocks):
        held = listed.where(F.col("block") == b).orderBy("h", "item_id", "text").collect()  # about block_bytes of text, or one item
        block = Block([(r["item_id"], r["text"]) for r in held])
        if not block.terms:
            continue
        shared = spark.sparkContext.broadcast(block)
        counted = rows.select("text").mapInArrow(_statistics(shared, "text"), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        got = {r["term"]: r["n"] for r in counted.collect()}  # a row per term of the block
        n_docs, n_terms = got.get(-1, 0), got.get(-2, 0)
        if not n_docs:
            break
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * got.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
        weighing = spark.sparkContext.broadcast((weights, n_docs, n_terms))
        found = found.unionByName(rows.mapInArrow(_search(shared, weighing, k, *arrow), out).withColumn("block", F.lit(b)))
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    salted = Window.partitionBy("block", "item", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
