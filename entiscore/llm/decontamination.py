"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words: maximal runs of letters and digits, lower-cased
for A-Z. Spaces and punctuation of all of Unicode part words; each character of
a script without spaces (Chinese, Japanese, Thai) and each symbol beyond ASCII
is a word. A test item of m words
may occur with up to e = floor(error_rate * m) word edits. Cut into e + 1
pieces, at least one piece of a true occurrence is untouched; so every
occurrence is found from an exact piece hit, and Myers' bit-parallel distance
decides the words around it.

A piece is looked up by its first words. A bit set of these keys, of a fixed
size whatever the benchmark's, goes to the scan of the documents and drops
nearly all other places; those that are left are joined with the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm import textops as tx
from entiscore.llm.tables import fresh, stored

_WORD = np.zeros(256, bool)
_WORD[0x80:] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _WORD[_a:_b] = True

ERROR_RATE = 0.1
LEAST_WORDS = 8     # default of the operator; the query and the pipeline look for every item that has a word
KEY_WORDS = 5       # first words of a piece that make its key (all, if it has fewer)
FILTER_BITS = 24    # the bit set has 2**FILTER_BITS bits


def _hashes(column: pa.Array) -> tuple[tx.Words, np.ndarray]:
    words = tx.Words(tx.Texts(column, lower=True), _WORD, tx.kinds_of())
    return words, words.hashes()


def piece_starts(m: int, error_rate: float) -> list[int]:
    """First words of the floor(error_rate * m) + 1 pieces of m words, and m."""
    n = int(error_rate * m + 1e-9) + 1
    return [m * i // n for i in range(n + 1)]


def distance(pattern: list[int], text: list[int]) -> list[int]:
    """For each end in ``text`` (0 to its length), the least number of word
    edits between ``pattern`` and a stretch of ``text`` that ends there (Myers'
    bit vectors, in one Python integer of as many bits as the pattern has words)."""
    m = len(pattern)
    at: dict[int, int] = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score, out = full, 0, m, [m]
    for w in text:
        eq = at.get(w, 0)
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        rise = minus | (full & ~(diagonal | plus))
        fall = plus & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full
        plus, minus = fall | (full & ~(diagonal | rise)), rise & diagonal
        out.append(score)
    return out


def occurrence(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """(distance, start, end) of the best occurrence: least distance, then first end, then longest."""
    ends = distance(pattern, text)
    best = min(ends)
    end = ends.index(best)
    back = distance(pattern[::-1], text[:end][::-1])
    return best, end - max(i for i, d in enumerate(back) if d == best), end


def _pieces(error_rate: float, least_words: int, key_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            words, h = _hashes(tx.column_of(part, "text"))
            items, out = tx.column_of(part, "item").to_pylist(), []
            for i, item in enumerate(items):
                a, m = int(words.first[i]), int(words.counts[i])
                if m < max(1, least_words):
                    continue
                own = h[a:a + m]
                starts = piece_starts(m, error_rate)
                for s, e in zip(starts, starts[1:], strict=False):
                    size = min(key_words, e - s)
                    key = int(tx.signed(tx.word_span_hash(own, np.array([s]), np.array([s + size])))[0])
                    out.append((key, size, item, s, e - s, tx.signed(own).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, _PIECES, strict=True)],
                                             ["key", "size", "item", "piece", "length", "words"])
    return run


_PIECES = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))


def _scan(shared, sizes: list[int], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, np.uint8)
        mask = np.uint64((1 << bits) - 1)
        for part in tx.slices(batches, "text"):
            words, h = _hashes(tx.column_of(part, "text"))
            owner = np.repeat(np.arange(words.texts.n), words.counts)
            rows = tx.column_of(part, "row")
            for size in sizes:
                keys = tx.shingles(h, size)
                if not len(keys):
                    continue
                spot = (keys & mask).astype(np.int64)
                at = np.flatnonzero(marks[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)
                at = at[owner[at] == owner[at + size - 1]]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(tx.signed(keys[at])), rows.take(pa.array(owner[at])),
                                                      pa.array((at - words.first[owner[at]]).astype(np.int32))], ["key", "row", "pos"])
    return run


def _verify(error_rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            words, h = _hashes(tx.column_of(part, "text"))
            rows, ids, found = (tx.column_of(part, c) for c in ("row", "id", "found"))
            out: list[tuple] = []
            for i in range(part.num_rows):
                a, n = int(words.first[i]), int(words.counts[i])
                text = tx.signed(h[a:a + n]).tolist()
                best: dict[int, tuple] = {}
                for c in found[i].as_py():
                    pattern, spots = c["words"], sorted({(s["pos"], s["piece"], s["length"]) for s in c["spots"]})
                    allowed = int(error_rate * len(pattern) + 1e-9)
                    done: set[int] = set()
                    for pos, piece, length in spots:
                        # The whole piece, not only its first words, has to stand there.
                        if pos - piece in done or text[pos:pos + length] != pattern[piece:piece + length]:
                            continue
                        done.add(pos - piece)
                        low = max(0, pos - piece - allowed)
                        d, s, e = occurrence(pattern, text[low:pos - piece + len(pattern) + allowed])
                        if d <= allowed:
                            hit = (d, low + s, low + e, allowed)
                            best[c["item"]] = min(best.get(c["item"], hit), hit)
                for item, (d, s, e, allowed) in best.items():
                    out.append((rows[i].as_py(), ids[i].as_py(), item, d, allowed, s, e))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, _FOUND, strict=True)],
                                             ["row", "id", "item_id", "errors", "allowed", "start_word", "end_word"])
    return run


_FOUND = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())


def _row(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", error_rate: float = ERROR_RATE, least_words: int = LEAST_WORDS, key_words: int = KEY_WORDS,
          filter_bits: int = FILTER_BITS) -> DataFrame:
    """``row, id_col, item_id, errors, allowed, start_word, end_word``: the best
    occurrence of each item in each document that holds it.

    ``row`` is a hash of id and text that tells rows apart. Null, empty and
    short items (fewer than ``least_words`` words) are not looked for; null and
    empty texts hold nothing; rows with a null id are searched like others;
    identical rows give one result; repeated items give one each. Empty tables
    give an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    listed = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    pieces = stored(listed.mapInArrow(_pieces(error_rate, least_words, key_words),
                                      "key long, size int, item long, piece int, length int, words array<long>"), "pieces")
    sizes = [r["size"] for r in pieces.select("size").distinct().orderBy("size").collect()]  # at most key_words of them
    spot = F.col("key").bitwiseAND(F.lit((1 << filter_bits) - 1))
    blocks = (pieces.select(spot.alias("s")).groupBy(F.shiftright("s", 6).alias("block"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("marks")))
    marks = np.zeros(1 << filter_bits - 6, np.int64)
    for r in blocks.collect():  # at most 2**filter_bits / 64 rows
        marks[r["block"]] = r["marks"]
    shared = spark.sparkContext.broadcast(marks.tobytes())
    rows = docs.select(_row(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hits = rows.select("row", "text").mapInArrow(_scan(shared, sizes, filter_bits), "key long, row long, pos int")
    spots = hits.join(pieces.drop("size"), "key")
    found = (spots.groupBy("row", "item").agg(F.first("words").alias("words"), F.collect_set(F.struct("pos", "piece", "length")).alias("spots"))
             .groupBy("row").agg(F.collect_list(F.struct("item", "words", "spots")).alias("found")))  # by text: at most its own hits
    found = stored(found, "leak-candidates")
    # Candidates grow with the corpus: one and the same join for every size.
    return (rows.join(found.hint("merge"), "row").mapInArrow(_verify(error_rate), "row long, id long, item_id long, errors int, allowed int, start_word int, end_word int")
            .dropDuplicates().withColumnRenamed("id", id_col))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows in which no item occurs, with their columns as they are."""
    bad = stored(leaks(docs, items, id_col, text_col, **settings).select(F.col("row").alias("bad")).distinct(), "leaks")
    row = fresh(docs, "row")["row"]
    return (docs.withColumn(row, _row(id_col, text_col)).join(bad, F.col(row) == F.col("bad"), "left_anti").drop(row))
