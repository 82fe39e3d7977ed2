"""Small document frames and brute-force helpers for the operators of the llm subpackage."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def docs(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def wide(spark, rows):
    """Documents whose other columns bear the names that operators use themselves."""
    names = ("size", "score", "kept", "node", "shard", "key", "judged", "row", "position", "taken")
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, "s", len(t or ""), *names) for i, t in rows], schema), names


LONG = " ".join(f"word{i % 997}" for i in range(30_000))
EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, LONG), (5, LONG), (None, "a text without an id"), (7, "a text without an id")]
