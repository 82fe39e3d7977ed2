"""Which of several filters removes what: an audit over a sparse document-term matrix.

The matrix (:func:`term_matrix`) is built in three steps. One scan turns the
texts into CSR shards, each with a dictionary of its own words. The shards'
dictionaries are cut into ranges of word hashes and every range is numbered in
one task, which gives each word of the corpus its number. The numbers go back
to the shards, whose columns are then those of the whole corpus. Shards and
ranges have a bounded number of words, and what is shuffled is a row of packed
numbers per shard and range, not one per word.

Row sums and numbers of nonzero columns then decide the two word filters of
:func:`audit`; the other filters' flags are taken in the first scan.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.tables import fresh, stored

SHARD_WORDS = 1 << 20    # word occurrences of a shard; a longer text makes a shard of its own
RANGE_WORDS = 1 << 20    # words of all shards' dictionaries in one range of hashes, about

# Measures of the texts of a slice, by name; all are longs.
Measures = Callable[[tx.Texts], dict[str, np.ndarray]]


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans of ``data``, one behind the other."""
    sizes = sizes.astype(np.int64)
    return data[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class _Slice:
    """The rows of a slice as counts of its own distinct words."""

    def __init__(self, part: pa.RecordBatch, text_col: str, measures: Measures):
        texts = tx.Texts(tx.column_of(part, text_col))
        words = tx.Words(texts)
        self.carried = part.drop_columns([text_col])
        self.measured = measures(texts)
        self.n_words = len(words.starts)
        self.hashes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.sizes = (words.ends - words.starts)[first].astype(np.uint32)
        self.words = _gather(texts.data, words.starts[first], self.sizes)
        width = max(1, len(self.hashes))
        key, times = np.unique(np.repeat(np.arange(texts.n), words.counts) * width + number, return_counts=True)
        self.times = times.astype(np.uint32)
        self.column = (key % width).astype(np.int32)
        self.filled = np.bincount(key // width, minlength=texts.n)


def _shard(number: int, slices: list[_Slice], fields: list[str], schema: pa.Schema) -> pa.RecordBatch:
    """One shard as a row; its dictionary is in the order of the hashes, which are not kept: the words give them again."""
    hashes, first, at = np.unique(np.concatenate([s.hashes for s in slices]), return_index=True, return_inverse=True)
    sizes = np.concatenate([s.sizes for s in slices])
    words = np.concatenate([s.words for s in slices])
    before = _starts([len(s.hashes) for s in slices])
    columns = np.concatenate([at[b + s.column] for b, s in zip(before, slices, strict=False)]).astype(np.int32)
    rows = pa.Table.from_batches([s.carried for s in slices]).combine_chunks()
    held = [rows.column(f).combine_chunks() for f in fields]
    held += [pa.array(np.concatenate([s.measured[m] for s in slices]).astype(np.int64)) for m in slices[0].measured]
    rows = pa.StructArray.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in held],
                                      fields=list(schema.field("rows").type.value_type))
    packed = (_starts(np.concatenate([s.filled for s in slices])), columns, np.concatenate([s.times for s in slices]),
              sizes[first], _gather(words, _starts(sizes)[first], sizes[first]))
    values = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([len(hashes)]), *[pa.array([x.tobytes()]) for x in packed]]
    return pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _build(text_col: str, fields: list[str], measures: Measures, shard_words: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, slices = TaskContext.get().partitionId() << 32, []
        for part in tx.slices(batches, text_col):
            slices.append(_Slice(part, text_col, measures))
            if sum(s.n_words for s in slices) >= shard_words:
                yield _shard(number, slices, fields, schema)
                number, slices = number + 1, []
        if slices:
            yield _shard(number, slices, fields, schema)
    return run


def _cut(ranges: int):
    """A shard's dictionary as a row per range of hashes."""
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes, words = np.frombuffer(row["sizes"], np.uint32), np.frombuffer(row["words"], np.uint8)
                hashes = tx.packed_hashes(words, sizes)
                at = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
                byte = _starts(sizes)[at]
                used = np.flatnonzero(np.diff(at)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([row["shard"]] * len(used), pa.int64()),
                     *[pa.array([x[p[r]:p[r + 1]].tobytes() for r in used], pa.binary())
                       for x, p in ((sizes, at), (words, byte))]],
                    ["range", "shard", "sizes", "words"])
    return run


def _number(part: pa.Table) -> pa.Table:
    """The numbers of a range's words for every shard that has some, and the range's dictionary (shard null)."""
    packed = {c: [x.as_py() for x in part[c]] for c in ("sizes", "words")}
    sizes, words = (np.frombuffer(b"".join(packed[c]), t) for c, t in (("sizes", np.uint32), ("words", np.uint8)))
    _, first, at = np.unique(tx.packed_hashes(words, sizes), return_index=True, return_inverse=True)
    numbers = at.astype(np.int32)
    bounds = _starts([len(x) // 4 for x in packed["sizes"]])
    own = part["range"][0].as_py()
    rows = [(own, s, numbers[a:b].tobytes(), None, None) for s, a, b in zip(part["shard"].to_pylist(), bounds, bounds[1:], strict=False)]
    rows.append((own, None, None, sizes[first].tobytes(), _gather(words, _starts(sizes)[first], sizes[first]).tobytes()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                ["range", "shard", "numbers", "sizes", "words"])


def _encode(schema: pa.Schema):
    """A shard whose columns are the words' numbers in the whole corpus: range * 2**32 + number in the range."""
    def run(shard: pa.Table, numbers: pa.Table) -> pa.Table:
        numbers = numbers.sort_by("range")  # as the shard's dictionary is ordered
        word = [np.frombuffer(n, np.int32).astype(np.int64) + (r << 32) for r, n in zip(numbers["range"].to_pylist(), numbers["numbers"].to_pylist(), strict=True)]
        columns = np.concatenate([*word, np.zeros(0, np.int64)])[np.frombuffer(shard["columns"][0].as_py(), np.int32)]
        return pa.Table.from_arrays([shard["shard"], shard["rows"], shard["starts"], pa.array([columns.tobytes()], pa.binary()), shard["times"]], schema=schema)
    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sizes = np.frombuffer(row["sizes"], np.uint32)
            offsets = pa.array(_starts(sizes), pa.int64())
            text = pa.LargeStringArray.from_buffers(len(sizes), offsets.buffers()[1], pa.py_buffer(row["words"]))
            yield pa.RecordBatch.from_arrays([pa.array((row["range"] << 32) + np.arange(len(sizes))), text.cast(pa.string())], ["word_id", "word"])


def _row_measures(fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = tx.column_of(batch, "rows").slice(i, 1).flatten()
                starts, times = (np.frombuffer(tx.column_of(batch, c)[i].as_py(), t) for c, t in (("starts", np.int64), ("times", np.uint32)))
                total = _starts(times)
                yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(total[starts[1:]] - total[starts[:-1]]), pa.array(np.diff(starts))], [*fields, "n_words", "n_distinct"])
    return run


def term_matrix(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, measures: Measures = lambda texts: {},
                measured: tuple[str, ...] = (), shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix as ``(dictionary, shards)``.

    ``dictionary``: ``word_id, word``, a row per distinct word. ``shards``:
    ``shard, rows, starts, columns, times``: ``rows`` has the columns ``keep``
    (all but the text by default) and the ``measured`` ones of each row, then
    come the CSR arrays as little-endian bytes, ``starts`` (int64, one more than
    rows), ``columns`` (int64 word ids) and ``times`` (uint32). Words are maximal
    runs of ``[^\\x20\\x09-\\x0D]``; 64-bit hashes stand for them. Null and empty
    texts are rows without a nonzero; every row of the table is a row, repeated
    ones too; an empty table has neither words nor shards.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    text = fresh(docs.select(*keep), "scanned")["scanned"]
    scanned = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(text))
    row = T.StructType([scanned.schema[c] for c in keep] + [T.StructField(m, T.LongType()) for m in measured])
    out = T.StructType().add("shard", T.LongType()).add("rows", T.ArrayType(row)).add("n_own", T.LongType())
    for c in ("starts", "columns", "times", "sizes", "words"):
        out = out.add(c, T.BinaryType())
    arrow = scanned.sparkSession.createDataFrame([], out).toArrow().schema
    built = stored(scanned.mapInArrow(_build(text, keep, measures, shard_words, arrow), out), "term-shards")
    entries = built.agg(F.sum("n_own")).first()[0] or 0
    ranges = max(1, math.ceil(entries / range_words))
    cut = built.select("shard", "sizes", "words").mapInArrow(_cut(ranges), "range int, shard long, sizes binary, words binary")
    numbered = stored(cut.groupBy("range").applyInArrow(_number, "range int, shard long, numbers binary, sizes binary, words binary"), "term-numbers")
    dictionary = numbered.where(F.col("shard").isNull()).select("range", "sizes", "words").mapInArrow(_words, "word_id long, word string")
    own = built.select("shard", "rows", "starts", "columns", "times")
    numbers = numbered.where(F.col("shard").isNotNull()).select("shard", "range", "numbers")
    shards = own.groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(_encode(own.limit(0).toArrow().schema), own.schema)
    return dictionary, shards


def row_measures(shards: DataFrame) -> DataFrame:
    """The fields of ``rows`` with the row's sum ``n_words`` and its number of nonzeros ``n_distinct``."""
    row = shards.schema["rows"].dataType.elementType
    return shards.select("rows", "starts", "times").mapInArrow(
        _row_measures(row.names), T.StructType([*row, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())]))


FILTERS = "ABCDE"

_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True


def _characters(texts: tx.Texts) -> dict[str, np.ndarray]:
    def per_text(flags):
        total = _starts(flags)
        return total[texts.offsets[1:]] - total[texts.offsets[:-1]]
    return {"n_upper": per_text(_UPPER[texts.data]), "n_chars": per_text((texts.data & 0xC0) != 0x80), "n_marks": per_text(_SYMBOL[texts.data])}


def failures(docs: DataFrame, id_col: str, text_col: str, part_col: str, least_words: int, least_distinct_pct: int, most_upper_pct: int) -> DataFrame:
    """``id, part, same`` (digest of the text) and ``fails``, bits 0 to 3 for the
    filters A to D, of every row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"), F.col(f"`{text_col}`").alias("text"))
    _, shards = term_matrix(rows, measures=_characters, measured=("n_upper", "n_chars", "n_marks"))
    tests = (F.col("n_words") < least_words, 100 * F.col("n_distinct") < least_distinct_pct * F.col("n_words"),
             100 * F.col("n_upper") > most_upper_pct * F.col("n_chars"), F.col("n_marks") > 0)
    bits = sum((F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(tests)), F.lit(0))
    return row_measures(shards).select("id", "part", "same", bits.alias("fails"))


def patterns(flagged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, fails, good, toxic, n``: rows of each part by the set of filters
    that they fail, E (bit 4, a text that a smaller id has) among them.

    Equal texts are counted per part and label before they meet, so a text that
    a third of all rows share is a few rows from the first shuffle on."""
    marks = (labels.select(F.col(f"`{id_col}`").alias("of"), "quality", "toxic").where(F.col("of").isNotNull()).groupBy("of")
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    rows = flagged.groupBy("id", "part", "same", "fails").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(False)
    rows = rows.join(marks, F.col("id") == F.col("of"), "left").select(
        "id", "part", "same", "fails", "n", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
    groups = rows.groupBy("same", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnumbered"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"))
    groups = stored(groups, "audit-texts")
    first = groups.groupBy("same").agg(F.min("least.id").alias("first")).select(F.col("same").alias("text"), "first")
    groups = groups.join(first, F.col("same") == F.col("text"))
    kept = F.col("unnumbered") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(F.lit(0))
    both = F.array(F.struct(F.col("fails"), kept.alias("n")), F.struct(F.col("fails").bitwiseOR(F.lit(16)).alias("fails"), (F.col("n") - kept).alias("n")))
    return (groups.select("part", "good", "toxic", F.explode(both).alias("p")).groupBy("part", F.col("p.fails").alias("fails"), "good", "toxic")
            .agg(F.sum("p.n").alias("n")).where(F.col("n") > 0))


def _steps() -> str:
    """SQL of all orders and steps as one array: the step's filter, its bit and the set of the filters before it."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order):
            out.append(f"named_struct('filter_order', '{name}', 'step', {step + 1}, 'f', {f}, 'bit', {1 << f}, 'before', {before})")
            before |= 1 << f
    return f"array({', '.join(out)})"


def interactions(counted: DataFrame) -> DataFrame:
    """The audit's rows from :func:`patterns`.

    What is left behind a set of filters does not depend on their order: 32 sums
    a part (and as many of good and of toxic rows) give every step of every order."""
    n, sets = len(FILTERS), range(1 << len(FILTERS))

    def left(name: str, condition: str) -> Column:
        return F.expr("array(" + ", ".join(f"coalesce(sum(n) FILTER (WHERE fails & {s} = 0 AND {condition}), 0L)" for s in sets) + ")").alias(name)

    def removed(column: str, bit: str, before: str) -> str:
        return f"(element_at({column}, {before} + 1) - element_at({column}, {before} + {bit} + 1))"

    alone = F.expr("array(" + ", ".join(f"coalesce(sum(n) FILTER (WHERE fails = {1 << f}), 0L)" for f in range(n)) + ")").alias("alone")
    parts = counted.groupBy("part").agg(left("left_all", "true"), left("left_good", "good"), left("left_toxic", "toxic"), alone)
    # How many orders put just the filters of a set before f.
    orders = {s: math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) for s in sets if s.bit_count() < n}
    shapley = [" + ".join(f"{times} * {removed('left_all', str(1 << f), str(s))}" for s, times in orders.items() if not s >> f & 1) for f in range(n)]
    rows = parts.selectExpr("*", f"array({', '.join(shapley)}) AS shapleys", f"explode({_steps()}) AS s").select("*", "s.*")
    here = removed("left_all", "bit", "before")
    return rows.selectExpr("part", "filter_order", "step", f"element_at(left_all, before + 1) - {here} AS kept", f"{here} AS removed",
                           f"{removed('left_all', 'bit', '0')} - {here} AS redundant", "element_at(alone, f + 1) AS unique_fails",
                           f"{removed('left_good', 'bit', 'before')} AS good_lost", f"{removed('left_toxic', 'bit', 'before')} AS toxic_lost",
                           "element_at(shapleys, f + 1) AS shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          least_words: int = 50, least_distinct_pct: int = 65, most_upper_pct: int = 5) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` for every part, order of the five filters
    and step.

    Failures: A fewer than ``least_words`` words; B ``100 * distinct words <
    least_distinct_pct * words``; C ``100 * [A-Z] > most_upper_pct *`` code
    points; D any of ``#$%&*|``; E equal to a text with a smaller id, removed or
    not. A null text is an empty one, a null part the empty string. A row without
    an id has no smaller one and is none; rows that share an id do not fail E by
    one another. A row is good or toxic if any label row of its id says 1.
    Repeated rows count as often as they stand there; an empty table gives an
    empty result. Columns that are not named are not read.
    """
    flagged = stored(failures(docs, id_col, text_col, part_col, least_words, least_distinct_pct, most_upper_pct), "audit-rows")
    return interactions(stored(patterns(flagged, labels, id_col), "audit-patterns"))
