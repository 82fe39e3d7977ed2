"""Substring dedup by De Bruijn compaction: every word covered by a long window
whose word sequence also starts in a document with a smaller id is removed.

1. Nodes and edges. Sampled token k-mers (the least hash of every ``spread``
   consecutive k-mers) are the graph's nodes; an edge is the word sequence from
   one sampled k-mer of a text to the next. Sampling depends on content alone,
   and ``k + 2 * spread <= window``, so two equal windows hold the same edges,
   one at least.
2. Repeats. Edges are grouped by hash; an edge with several documents is
   repeated, and its source is its first place (document, word) by document.
3. Compaction. Joined back, the repeated edges of a text that follow each other
   with one source document and matching source coordinates compact into one
   path. A path of a window's length or more is a verified copy: all its words
   go, and none of its windows has to be looked at.
4. Windows that no path settles (at path ends, at branches, and in the sources
   themselves) but whose edges all repeat are compared word by word: as
   96-bit hashes of the window, grouped, with the least document id.

Only edges (about one for each ``spread / 2`` words) and the windows of step 4 are
shuffled beside the texts; hot edges and windows are pre-aggregated, and the
joins back are plain equi-joins that Spark can split where they are skewed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm import textops as tx
from entiscore.llm.tables import stored

WINDOW, K, SPREAD = 50, 12, 19


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _sampled(word_hashes: np.ndarray, k: int, spread: int) -> np.ndarray:
    """For every ``spread`` consecutive k-mers, the place of the first of those with the least hash."""
    kmers = tx.shingles(word_hashes, k)
    if len(kmers) < spread:
        return np.zeros(0, np.int64)
    ranked = (kmers >> np.uint64(32) << np.uint64(32)) | np.arange(len(kmers), dtype=np.uint64)
    return (_least(ranked, spread) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _edges(word_hashes: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the word sequences from each sampled k-mer to the end of the next."""
    return tx.word_span_hash(word_hashes, places[:-1], places[1:] + k)


def _edge_rows(id_col: str, text_col: str, window: int, k: int, spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, text_col):
            words = tx.Words(tx.Texts(tx.column_of(part, text_col)))
            hashes, first = words.hashes(), words.first
            picked = _sampled(hashes, k, spread)
            owner = np.repeat(np.arange(words.texts.n), words.counts)
            at = np.arange(len(picked))
            long = np.repeat(words.counts >= window, words.counts)[at]
            picked = np.unique(picked[(owner[at] == owner[at + spread + k - 2]) & long])
            if len(picked) < 2:
                continue
            h = _edges(hashes, picked, k)
            same = owner[picked[:-1]] == owner[picked[1:]]
            start, h = picked[:-1][same], h[same]
            ids = tx.column_of(part, id_col).take(pa.array(owner[start]))
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(h)), ids, pa.array((start - first[owner[start]]).astype(np.int32))],
                                             ["h", "doc", "start"])
    return run


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _paths(doc: int, found: list[dict], places: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(which edges repeat, word ranges of the paths copied from a smaller document)."""
    repeated = np.zeros(max(0, len(places) - 1), bool)
    source: list[tuple[int, int] | None] = [None] * len(repeated)
    for e in found:
        i = int(np.searchsorted(places, e["start"]))
        # An entry of another row with the same id does not fit this text.
        if i < len(repeated) and places[i] == e["start"] and hashes[i] == e["h"]:
            repeated[i] = True
            source[i] = (e["src_doc"], e["src_start"])
    paths, i = [], 0
    while i < len(repeated):
        if source[i] is None or source[i][0] >= doc:
            i += 1
            continue
        j = i
        while j + 1 < len(repeated) and source[j + 1] == (source[j][0], source[j][1] + int(places[j + 1] - places[j])):
            j += 1
        paths.append((int(places[i]), int(places[j + 1]) + k))
        i = j + 1
    return repeated, paths


def _settle(id_col: str, text_col: str, window: int, k: int, spread: int):
    """Per text: paths, and the windows that are still open; the result where none is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, text_col):
            docs, lists, texts = tx.column_of(part, id_col), tx.column_of(part, "found"), tx.column_of(part, text_col)
            out = []
            for i in range(part.num_rows):
                doc, found = docs[i].as_py(), lists[i].as_py()
                if not found:
                    words = (texts[i].as_py() or "").encode().split()
                    out.append((doc, len(words), 0, _digest(words), None, None, None))
                    continue
                words = tx.Words(tx.Texts(texts.slice(i, 1)))
                h1, n = words.hashes(), int(words.counts[0])
                picked = _sampled(h1, k, spread)
                places = np.unique(picked)
                repeated, paths = _paths(doc, found, places, tx.signed(_edges(h1, places, k)), k)
                at = np.arange(n - window + 1)
                # The edges that both texts of an equal pair of windows must have.
                low, high = np.searchsorted(places, picked[at]), np.searchsorted(places, picked[at + window - k + 1 - spread])
                lacking = np.concatenate([[0], np.cumsum(~repeated)])
                open_ = lacking[high] == lacking[low]
                long = [(a, b) for a, b in paths if b - a >= window]
                for a, b in long:
                    open_[a:b - window + 1] = False
                at = at[open_]
                if not len(at):
                    keep = np.ones(n, bool)
                    for a, b in long:
                        keep[a:b] = False
                    left = [w for w, ok in zip(words.text(0), keep.tolist(), strict=True) if ok]
                    out.append((doc, n, n - len(left), _digest(left), None, None, None))
                    continue
                key = tx.signed(tx.word_span_hash(h1, at, at + window))
                second = (tx.word_span_hash(words.hashes(2), at, at + window) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                wins = [{"h1": a, "h2": b, "pos": c} for a, b, c in zip(key.tolist(), second.tolist(), at.tolist(), strict=True)]
                out.append((doc, n, None, None, texts[i].as_py(), [{"a": a, "b": b} for a, b in long], wins))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SETTLED.types, strict=True)], schema=_SETTLED)
    return run


_SETTLED = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string()),
                      ("paths", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                      ("wins", pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int32()), ("pos", pa.int32())])))])
_SETTLED_DDL = ("doc long, n_words long, n_removed long, kept_sha256 string, text string, paths array<struct<a:int,b:int>>, "
                "wins array<struct<h1:long,h2:int,pos:int>>")


def _finish(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            out = []
            for row in part.to_pylist():
                words = tx.Words(tx.Texts(pa.array([row["text"]])))
                n = int(words.counts[0])
                change = np.zeros(n + 1, np.int64)
                for p in row["paths"]:
                    change[p["a"]] += 1
                    change[p["b"]] -= 1
                hits = row["hits"] or []
                own = {(w["pos"], w["h1"]) for w in row["wins"]}
                at = np.array([h["pos"] for h in hits if (h["pos"], h["h1"]) in own], np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                keep = np.cumsum(change[:-1]) <= 0
                left = [w for w, ok in zip(words.text(0), keep.tolist(), strict=True) if ok]
                out.append((row["doc"], n, n - len(left), _digest(left), b" ".join(left).decode() if with_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _DONE.types, strict=True)], schema=_DONE)
    return run


_DONE = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def repeated_edges(docs: DataFrame, window: int = WINDOW, k: int = K, spread: int = SPREAD) -> DataFrame:
    """``doc, start, h, src_doc, src_start`` of every edge that several documents
    have, from ``doc, text``; the source is the first place by document id."""
    edges = docs.filter("doc IS NOT NULL").mapInArrow(_edge_rows("doc", "text", window, k, spread), "h long, doc long, start int")
    stats = (edges.groupBy("h").agg(F.min(F.struct("doc", "start")).alias("src"), F.max("doc").alias("last"))
             .filter(F.col("last") > F.col("src.doc"))
             .select("h", F.col("src.doc").alias("src_doc"), F.col("src.start").alias("src_start")))
    # Stored, so that the join deals out both sides itself and can split a hot edge.
    return edges.join(stored(stats, "repeated-edges"), "h").select("doc", "start", "h", "src_doc", "src_start")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K,
                   spread: int = SPREAD) -> DataFrame:
    """Per row ``id_col, n_words, n_removed, kept_sha256, kept_text``.

    ``kept_text`` (kept words joined by single spaces) is given only where
    something could be removed; elsewhere it is null and the text stands.
    Null and empty texts have no words. Rows with a null id are no source and
    keep all words. Rows with one id are judged one by one and are no source
    for each other. An empty table gives an empty result; columns beside id and
    text are not read.
    """
    if k + 2 * spread > window:
        raise ValueError("k + 2 * spread must not pass the window")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    found = repeated_edges(rows, window, k, spread).groupBy("doc").agg(
        F.collect_list(F.struct("start", "h", "src_doc", "src_start")).alias("found"))  # at most the edges of one text
    settled = stored(rows.join(found, "doc", "left").mapInArrow(_settle("doc", "text", window, k, spread), _SETTLED_DDL), "substrings")
    wins = settled.filter("text IS NOT NULL").select("doc", F.explode("wins").alias("w")).select("doc", "w.h1", "w.h2", "w.pos")
    first = stored(wins.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("last")).filter("last > least").drop("last"),
                   "repeated-windows")
    hits = (wins.join(first, ["h1", "h2"]).filter("doc > least").groupBy("doc")
            .agg(F.collect_set(F.struct("pos", "h1")).alias("hits")))  # at most the windows of one text
    done = (settled.filter("text IS NOT NULL").select("doc", "text", "paths", "wins").join(hits, "doc", "left")
            .mapInArrow(_finish(window, True), "doc long, n_words long, n_removed long, kept_sha256 string, kept_text string"))
    rest = settled.filter("text IS NULL").select("doc", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    return done.unionByName(rest).withColumnRenamed("doc", id_col)
