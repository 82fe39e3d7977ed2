"""Quality rules as a short-circuit cascade.

Base measures are taken of every text. A text that passes the base limits goes
through further rules, in an order found on a sample: the sample gives each
rule's time and the sets of rules that reject each text, and the order takes,
again and again, the rule with most rejections of texts that are still left
per second. A text leaves the cascade at the first rule that rejects it, so
the order changes the work and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.tables import fresh

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER |= _UPPER
_NON_ASCII = np.zeros(256, bool)
_NON_ASCII[0x80:] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _owner(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only for equal content in the same text."""
    return tx.mix64(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Measured:
    """A slice of texts with its words and base measures."""

    def __init__(self, column: pa.Array):
        self.texts = texts = tx.Texts(column)
        self.words = words = tx.Words(texts)
        data, offsets = texts.data, texts.offsets
        inside = tx.SPACE_TABLE[data]
        self.n_words = words.counts.astype(np.int64)
        self.word_chars = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
        self.n_symbols = _per_text(_SYMBOL[data], offsets)
        self.hashes = words.hashes()
        self.lines, self.n_dup_lines = self._lines(inside)
        self.n_repeat_words = self._repeats(5)

    def _lines(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word and those of them that equal an earlier one, per text."""
        texts = self.texts
        starts, ends, _ = texts.runs(texts.data != 0x0A)
        in_words = np.concatenate([[0], np.cumsum(inside)])
        used = in_words[ends] > in_words[starts]
        starts, ends = starts[used], ends[used]
        owner = np.searchsorted(texts.offsets, starts, "right") - 1
        key = _keyed(texts.span_hashes(starts, ends), owner)
        order = np.argsort(key)
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order][1:] == key[order][:-1]
        return np.bincount(owner, minlength=texts.n), np.bincount(owner[again], minlength=texts.n)

    def _repeats(self, k: int) -> np.ndarray:
        """Words in k-word windows that the text has twice or more."""
        words, n = self.words, len(self.hashes)
        if n < k:
            return np.zeros(self.texts.n, np.int64)
        owner = _owner(words.first)
        at = np.flatnonzero(owner[: n - k + 1] == owner[k - 1:])
        key = _keyed(tx.shingles(self.hashes, k)[at], owner[at])
        order = np.argsort(key)
        same = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
        twice = at[order[same[:-1] | same[1:]]]
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + k, -1)
        return _per_text(np.cumsum(cover[:-1]) > 0, words.first)

    def base_failed(self, least_words: int, most_repeat_pct: int) -> np.ndarray:
        return (self.n_words < least_words) | (100 * self.n_repeat_words > most_repeat_pct * self.n_words)

    def bytes_of(self, i: int) -> np.ndarray:
        return self.texts.data[self.texts.offsets[i]:self.texts.offsets[i + 1]]

    def word_part(self, i: int, table: np.ndarray) -> float:
        """Part of the text's words that have a byte of the table."""
        a, b = self.words.first[i], self.words.first[i + 1]
        lo = int(self.texts.offsets[i])
        has = np.concatenate([[0], np.cumsum(table[self.bytes_of(i)])])
        return float((has[self.words.ends[a:b] - lo] > has[self.words.starts[a:b] - lo]).mean()) if b > a else 0.0


# A rule: does it reject text i of a measured slice? All limits are parameters of the rule.
Rule = Callable[[Measured, int], bool]


def symbols(most: float = 0.1) -> Rule:
    """More symbol characters than ``most`` times the words."""
    return lambda m, i: m.n_symbols[i] > most * m.n_words[i]


def word_length(least: float = 2.0, most: float = 12.0) -> Rule:
    """Mean word length out of bounds."""
    return lambda m, i: not least * m.n_words[i] <= m.word_chars[i] <= most * m.n_words[i]


def repeated_lines(most: float = 0.5) -> Rule:
    """Too many of the lines with a word equal an earlier one."""
    return lambda m, i: m.n_dup_lines[i] > most * m.lines[i]


def wordless(least: float = 0.8) -> Rule:
    """Too few words have a letter (ASCII, or any character beyond ASCII)."""
    return lambda m, i: m.word_part(i, _LETTER | _NON_ASCII) < least


def capitals(most: float = 0.5) -> Rule:
    """Too many of the ASCII letters are capitals."""
    def reject(m: Measured, i: int) -> bool:
        data = m.bytes_of(i)
        return int(_UPPER[data].sum()) > most * int(_LETTER[data].sum())
    return reject


def one_word(most: float = 0.25) -> Rule:
    """One word makes up too much of the text."""
    def reject(m: Measured, i: int) -> bool:
        words = np.sort(m.hashes[m.words.first[i]:m.words.first[i + 1]])
        edges = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1], [True]]))
        return int(np.diff(edges).max(initial=0)) > most * len(words)
    return reject


RULES: dict[str, Rule] = {
    "symbols": symbols(), "word_length": word_length(), "repeated_lines": repeated_lines(),
    "wordless": wordless(), "capitals": capitals(), "one_word": one_word(),
}


def best_order(patterns: dict[int, int], seconds: list[float]) -> list[int]:
    """Order of rules by rejection per cost. ``patterns``: bit set of the
    rejecting rules -> texts; ``seconds``: cost of each rule on the sample."""
    left, order, todo = dict(patterns), [], list(range(len(seconds)))
    while todo:
        gain = {r: sum(n for p, n in left.items() if p >> r & 1) / max(seconds[r], 1e-9) for r in todo}
        pick = max(todo, key=lambda r: (gain[r], -seconds[r], -r))
        order.append(pick)
        todo.remove(pick)
        left = {p: n for p, n in left.items() if not p >> pick & 1}
    return order


def plan_cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, sample_rows: int = 2_000, id_col: str = "doc_id",
                 text_col: str = "text", least_words: int = 10, most_repeat_pct: int = 20) -> list[str]:
    """Rule names in the order of rejection per cost, measured on about
    ``sample_rows`` rows picked by hash of the id (the only use of a sample)."""
    parts = max(1, docs.count() // sample_rows)
    sample = docs.select(text_col).filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(parts)) == 0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, patterns = [0.0] * len(rules), {}
        for part in tx.slices(batches, text_col):
            m = Measured(tx.column_of(part, text_col))
            bits = np.zeros(m.texts.n, np.int64)
            todo = np.flatnonzero(~m.base_failed(least_words, most_repeat_pct))
            for r, rule in enumerate(rules.values()):
                t = time.perf_counter()
                for i in todo.tolist():
                    bits[i] |= int(bool(rule(m, i))) << r
                seconds[r] += time.perf_counter() - t
            for b in bits[todo].tolist():
                patterns[b] = patterns.get(b, 0) + 1
        rows = [(-1 - r, s) for r, s in enumerate(seconds)] + [(b, float(n)) for b, n in patterns.items()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.float64())], ["k", "v"])

    # One row for each rule and each set of rules: bounded by the rules alone.
    got = {r["k"]: r["v"] for r in sample.mapInArrow(measure, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}
    seconds = [got.get(-1 - r, 0.0) for r in range(len(rules))]
    order = best_order({k: v for k, v in got.items() if k >= 0}, seconds)
    return [list(rules)[r] for r in order]


def cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, order: list[str] | None = None, id_col: str = "doc_id",
            text_col: str = "text", least_words: int = 10, most_repeat_pct: int = 20, keep: list[str] | None = None) -> DataFrame:
    """Every row with the base measures, ``base_failed`` and ``kept``.

    ``keep`` names the columns to carry (all by default). A null text has no
    words and fails the base limits, as does an empty one; rows are judged one
    by one, so repeated rows get equal verdicts; an empty table gives an empty
    result. Input columns named like an output are replaced.
    """
    order = plan_cascade(docs, rules, id_col=id_col, text_col=text_col, least_words=least_words, most_repeat_pct=most_repeat_pct) if order is None else order
    chain = [rules[name] for name in order]
    outs = (*MEASURES, "base_failed", "kept")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outs]
    text = fresh(docs.select(*keep), "judged")["judged"]
    carried = docs.select(*keep, F.col(text_col).alias(text))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, text):
            m = Measured(tx.column_of(part, text))
            failed = m.base_failed(least_words, most_repeat_pct)
            kept = ~failed
            for i in np.flatnonzero(kept).tolist():
                kept[i] = not any(rule(m, i) for rule in chain)
            columns = [tx.column_of(part, c) for c in keep] + [pa.array(getattr(m, c), pa.int64()) for c in MEASURES]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(failed), pa.array(kept)], [*keep, *outs])

    out = T.StructType([carried.schema[c] for c in keep])
    for c in MEASURES:
        out = out.add(c, T.LongType())
    return carried.mapInArrow(judge, out.add("base_failed", T.BooleanType()).add("kept", T.BooleanType()))
