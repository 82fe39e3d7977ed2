"""Language identification with language-bitmask n-gram filters.

Every learned language has a Bloom filter of its character n-grams. The
filters are stored bit-sliced: one word per filter position, whose bit l says
whether language l's filter has that position set. The AND of the words at an
n-gram's positions gives at once all languages that hold it. A text's n-grams
are counted per language (popcounts of each bit), the counts are corrected for
the filters' false positives, and the language with the largest corrected
count is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.tables import fresh

UNKNOWN = "und"
_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
_FOLD = np.arange(0x110000, dtype=np.uint32)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[0xC0:0xDF] += 32


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (3, 4)
    bits: int = 20                  # positions of the filters: 2**bits
    hashes: int = 3
    sample_per_language: int = 500  # bound of the training sample, in texts
    min_count: int = 3              # occurrences in the language's sample
    min_share: float = 0.2          # of the n-gram's largest relative frequency in any language
    seed: int = 11


@dataclass(frozen=True)
class Model:
    languages: list[str]            # in code-point order; at most 64
    words: np.ndarray               # bit-sliced filters, one 64-bit word a position
    false_rate: np.ndarray          # of each language's filter


def _grams(column: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of a slice (words padded by a blank on either
    side), the text of each, and whether each text has a letter."""
    texts = tx.Texts(column)
    lead = np.concatenate([[0], np.cumsum((texts.raw & 0xC0) != 0x80)])
    points = np.frombuffer(texts.raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    letter = _LETTER[points]
    offsets = lead[texts.offsets]
    owner = np.repeat(np.arange(texts.n), np.diff(offsets))
    count = np.concatenate([[0], np.cumsum(letter)])
    # Two blanks between texts, one for a run of other characters.
    codes = np.where(letter, _FOLD[points], 0).astype(np.uint64)
    keep = letter | np.concatenate([letter[1:], [False]]) if len(letter) else letter
    codes, owner, letter = codes[keep], owner[keep], letter[keep]
    codes = tx.mix64(codes + np.uint64(1))
    out, owners = [], []
    for n in s.orders:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = np.zeros(size, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + size]
        ok = owner[:size] == owner[n - 1:]
        for j in range(1, n - 1):  # a blank stands only at an end
            ok &= letter[j:j + size]
        out.append(tx.mix64(h[ok]))
        owners.append(owner[:size][ok])
    has = count[offsets[1:]] > count[offsets[:-1]]
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (np.concatenate(out) if out else empty[0]), (np.concatenate(owners) if out else empty[1]), has


def _positions(h: np.ndarray, s: Settings) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << s.bits) - 1)
    return [((h + np.uint64(j) * step) & mask).astype(np.int64) for j in range(s.hashes)]


def train(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from at most ``sample_per_language`` texts of each language (those
    with the least id hashes; a documented bound). Rows with a null language or
    text are left out. An n-gram goes into a language's filter if it occurs
    there ``min_count`` times and is not ``1 / min_share`` times more frequent
    in another: stray passages in another language leave no trace."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    # Ids with small hashes, as many as the bound needs at the least; then exactly the bound.
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * s.sample_per_language) / F.col("n"))
    key = F.xxhash64(F.lit(s.seed), "id")
    few = (known.select("id", "lang", key.alias("k")).join(F.broadcast(sizes), "lang")
           .filter((F.col("k") / F.lit(float(2**64)) + 0.5) < share))
    ranked = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k", "id"))).filter(F.col("r") <= s.sample_per_language)
    ids = ranked.select("id").distinct()  # at most the bound times the languages

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            h, owner, _ = _grams(tx.column_of(part, "text"), s)
            langs, which = np.unique(np.array(tx.column_of(part, "lang").to_pylist(), object), return_inverse=True)
            for i, lang in enumerate(langs.tolist()):
                values, n = np.unique(h[which[owner] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(tx.signed(values)), pa.array(n)],
                                                 ["lang", "gram", "n"])

    counts = (known.join(F.broadcast(ids), "id", "left_semi").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    freq = counts.join(F.broadcast(totals), "lang").withColumn("f", F.col("n") / F.col("total"))
    best = F.max("f").over(Window.partitionBy("gram"))
    held = freq.withColumn("best", best).filter((F.col("n") >= s.min_count) & (F.col("f") >= s.min_share * F.col("best"))).select("lang", "gram")
    # n-grams of a bounded sample: the model's size is set by the settings.
    rows = held.toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    if len(languages) > 64:
        raise ValueError(f"{len(languages)} languages; a 64-bit word holds 64")
    words = np.zeros(1 << s.bits, np.uint64)
    code = {lang: i for i, lang in enumerate(languages)}
    which = np.array([code[x] for x in rows.column("lang").to_pylist()], np.uint64)
    grams = np.asarray(rows.column("gram")).view(np.uint64)
    for p in _positions(grams, s):
        np.bitwise_or.at(words, p, np.uint64(1) << which)
    fill = np.array([float(((words >> np.uint64(i)) & np.uint64(1)).mean()) for i in range(len(languages))])
    return Model(languages, words, fill**s.hashes)


def predict(docs: DataFrame, model: Model, s: Settings = Settings(), text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (the part of the corrected
    counts' lead: 0 if two languages tie, 1 if no other language is hit).

    A null text, or one without a letter, gets ``und`` and 0. A text with
    letters gets a learned language even if no n-gram is known (then the first
    one, score 0); ties go to the first in code-point order. Rows are judged
    one by one; an empty table gives an empty result; without any learned
    language all rows get ``und``. Input columns named like an output are
    replaced. ``keep`` names the columns to carry.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    text = fresh(docs.select(*keep), "judged")["judged"]
    carried = docs.select(*keep, F.col(text_col).alias(text))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 8 * 2**bits bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        k = len(m.languages)
        names = np.array([*m.languages, UNKNOWN], object)
        for part in tx.slices(batches, text, 1 << 19):
            n = part.num_rows
            h, owner, has = _grams(tx.column_of(part, text), s)
            hit = np.full(len(h), ~np.uint64(0))
            for p in _positions(h, s):
                hit &= m.words[p]
            total = np.bincount(owner, minlength=n)
            counts = np.zeros((n, max(k, 1)))
            for i in range(k):
                found = np.bincount(owner[((hit >> np.uint64(i)) & np.uint64(1)).astype(bool)], minlength=n)
                counts[:, i] = np.maximum(0, (found - total * m.false_rate[i]) / (1 - min(m.false_rate[i], 0.99)))
            best = counts.argmax(axis=1)
            top = np.sort(counts, axis=1)[:, ::-1]
            second = top[:, 1] if k > 1 else np.zeros(n)
            score = np.divide(top[:, 0] - second, top[:, 0], out=np.zeros(n), where=top[:, 0] > 0)
            known = has & (k > 0)
            columns = [tx.column_of(part, c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names[np.where(known, best, k)], pa.string()),
                                              pa.array(np.where(known, score, 0.0))], [*keep, "lang_pred", "score"])

    out = T.StructType([carried.schema[c] for c in keep]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return carried.mapInArrow(run, out)
