"""Personal data against the plain patterns of Python's ``re``."""

import random
import re

import pytest
from llm_frames import EDGE_ROWS, docs, wide

from entiscore.llm import pii
from entiscore.llm.queries import op13_pii

EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute_base(text):
    t, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(EMAIL, t)]
    out += [("ip", *m.span()) for m in re.finditer(IP, t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(CARD, t):
        d = re.sub("[^0-9]", "", m.group())
        out += [("card", *m.span())] if 12 <= len(d) <= 19 and luhn(d) else []
    out += [("phone", *m.span()) for m in re.finditer(PHONE, t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


def found(df, column="spans"):
    return [[(s["kind"], s["start"], s["end"]) for s in r[column]] for r in df.collect()]


def base_of(rows):
    return [[s for s in r if s[0] in BASE] for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans_against_plain_patterns(spark, seed):
    rnd = random.Random(seed)
    pieces = ["a", "b.c", "@", "x@y", "a@b.c", ".", "..", "1", "23", "255", "256", "0255", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "79927398713", "0000 0000 0000",
              "+1", "(905)", " ", " ", "-", "--", "é", "日本", "😀", "+", "_", "%", "\n", "555-4930", "12345678901234567890", "²", "٣"]
    rows = [(i, "".join(rnd.choices(pieces, k=rnd.randint(0, 40)))) for i in range(600)]
    got = found(pii.spans(docs(spark, rows).coalesce(1)))
    assert base_of(got) == [brute_base(t) for _, t in rows]


def test_many_matches_and_long_runs(spark):
    many = " ".join(f"u{i}@mail.example é +1 (905) 555-{i:04d}" for i in range(1500))
    runs = ["a" * 150_000, "1" * 150_000, "a.b" * 50_000 + "@", "x@" + "a." * 60_000, "1." * 60_000, "+1" + " " * 100_000, "A" * 100_000, "DE" + "12 " * 40_000, "1-" * 60_000]
    rows = [(0, many)] + [(i + 1, t) for i, t in enumerate(runs)]
    got = found(pii.spans(docs(spark, rows).coalesce(1)))
    assert base_of(got)[0] == brute_base(many) and len(got[0]) >= 3000
    assert base_of(got)[1:] == [[], [], [], [("email", 0, len(runs[3]) - 1)], [("ip", 8 * i, 8 * i + 7) for i in range(15_000)], [], [], [], []]


def test_checksums_and_context(spark):
    cases = [
        ("DE89 3704 0044 0532 0130 00 IS MINE", [("iban", 0, 27)]), ("to GB82WEST12345698765432.", [("iban", 3, 25)]), ("BE68 5390 0754 7034 WITH", [("iban", 0, 19)]),
        ("GB82WEST12345698765433", []), ("XX82WEST12345698765432", []), ("xGB82WEST12345698765432", []), ("GB82WEST12345698765432X", []), ("gb82west12345698765432", []),
        ("SSN: 078-05-1120", [("ssn", 5, 16)]), ("078-05-1120", []), ("social security 666-05-1120", []), ("ssn order 078-05-1120", []), ("ssn 078-05-1120-1", []), ("ssn 078-05-0000", []),
    ]
    frame = docs(spark, list(enumerate(t for t, _ in cases))).coalesce(1)
    assert [[s for s in r if s[0] not in BASE] for r in found(pii.spans(frame))] == [w for _, w in cases]
    scores = {r["text"]: r["spans"][0]["score"] for r in pii.spans(docs(spark, [(1, "visa card 4111111111111111"), (2, "order 4111111111111111"), (3, "4111111111111111")])).collect()}
    assert scores["visa card 4111111111111111"] > scores["4111111111111111"] > scores["order 4111111111111111"]


def test_masked_texts(spark):
    rows = [(1, "mail a@b.de or +1 (905) 555-4930!"), (2, None), (3, ""), (4, "é 1.2.3.4, 4111111111111111"), (5, "nothing")]
    got = {r["doc_id"]: r["masked"] for r in pii.masked(docs(spark, rows)).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE]!", 2: None, 3: "", 4: "é [IP], [CARD]", 5: "nothing"}


def test_edge_rows_and_clashing_columns(spark):
    frame, names = wide(spark, EDGE_ROWS + [(9, "a@b.c")])
    out = pii.spans(frame.withColumnRenamed("row", "spans").withColumnRenamed("key", "t"))
    assert [c for c in out.columns if c not in (*names, "t")] == ["doc_id", "text", "source", "n_chars", "spans"]
    assert sorted((repr(r["doc_id"]), len(r["spans"])) for r in out.collect()) == sorted((repr(i), int(i == 9)) for i, _ in EDGE_ROWS + [(9, None)])
    assert pii.spans(frame.limit(0)).count() == 0


def test_query_uses_no_python_and_no_shuffle(spark, capsys):
    op13_pii(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
