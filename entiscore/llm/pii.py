"""Personal data: patterns propose spans, checksums and other validators confirm
them, words nearby adjust their score.

Everything is a DataFrame expression over one row, so nothing is shuffled. A
kind's matches are taken with ``regexp_extract_all`` and the text between them
with ``split`` by the same pattern; summed lengths of both give the positions,
in code points. The sums are taken in blocks, so that a text of very many
matches costs far less than the square of their number.

The patterns are written so that a search over a long run of characters that
ends in no match is not begun again at each of them: possessive repeats, and
starts only where a run starts (or where the last match ended, ``\\G``). Their
matches are those of the plain forms beside them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.tables import fresh

NEAR = 40          # code points on either side of a span in which its context words are looked for, up to the next match of its kind
RAISE, LOWER = 20, 30
LEAST_SCORE = 50   # of a span, for kinds that are not base kinds
BLOCK = 256        # lengths that are summed at once

# Length of an IBAN by country, as registered.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 "
    "GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 "
    "MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``pattern`` is a Java regular expression,
    ``present`` an SQL test of ``t`` (the text) without which nothing can
    match, ``valid`` an SQL test of a match ``p`` (fields ``found``, ``digits``,
    ``after``: the code point behind it or ''). ``cut``, SQL of ``x``, may shorten
    the match or refuse it (null).
    ``score`` is that of a confirmed span; ``up`` and ``down`` are context words
    that raise and lower it. Spans of a ``base`` kind stay whatever their score."""

    name: str
    pattern: str
    present: str
    valid: str
    score: int
    up: str
    down: str = ""
    cut: str = ""
    base: bool = False


_DIGIT = "has_digit"
# From the right, every second digit counts double (less 9 above 9).
_LUHN = """aggregate(sequence(1, length(p.digits)), 0, (a, i) -> a + CASE WHEN (length(p.digits) - i) % 2 = 0 THEN ascii(substr(p.digits, i, 1)) - 48
    ELSE 2 * (ascii(substr(p.digits, i, 1)) - 48) - CASE WHEN ascii(substr(p.digits, i, 1)) > 52 THEN 9 ELSE 0 END END) % 10 = 0"""
# Letters count as two digits, A as 10; the country and the check digits come last.
_MOD97 = """aggregate(transform(sequence(1, length(p.found)), i -> ascii(substr(concat(substr(p.found, 5), substr(p.found, 1, 4)), i, 1))), 0,
    (a, c) -> CASE WHEN c = 32 THEN a WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"""
_LENGTH = "element_at(map(" + ", ".join(f"'{c[:2]}', {c[2:]}" for c in IBAN_LENGTHS.split()) + "), substr(x, 1, 2))"

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
         "contains(t, '@')", "true", 80, "e-?mail|contact|write to|kontakt|correo|courriel", "example|noreply|no-reply", base=True),
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
         _DIGIT, "forall(split(p.found, '[.]'), q -> length(trim(LEADING '0' FROM q)) <= 3 AND coalesce(try_cast(q AS int), 0) <= 255)",
         60, "ip|host|server|address|client|login", "version|release|section|chapter", base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",  # [0-9]([\x20-]?[0-9])+
         _DIGIT, f"CASE WHEN length(p.digits) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
         70, "card|visa|mastercard|credit|debit|payment|karte|tarjeta|carte", "order|invoice|serial|isbn|tracking", base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"contains(t, '+') AND {_DIGIT}", "length(p.digits) BETWEEN 9 AND 15",
         70, "phone|tel|call|fax|mobile|cell|whatsapp|telefon|tel.fono", "equals|sum", base=True),
    Kind("iban", r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11,30}+", _DIGIT,
         f"CASE WHEN p.found IS NOT NULL AND NOT p.after RLIKE '[A-Za-z0-9]' THEN {_MOD97} ELSE false END", 80, "iban|bank|account|konto|bic|swift|cuenta|compte",
         cut=f"nullif(regexp_extract(x, concat('^(?:[A-Z0-9] ?){{', coalesce({_LENGTH}, 99) - 1, '}}[A-Z0-9]'), 0), '')"),
    Kind("ssn", r"[0-9](?<![0-9][0-9])[0-9]*+(?:-[0-9]++)++", _DIGIT,  # [0-9]+(-[0-9]+)+
         "p.found RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' AND substr(p.digits, 1, 3) NOT IN ('000', '666') AND substr(p.digits, 1, 1) <> '9' "
         "AND substr(p.digits, 4, 2) <> '00' AND substr(p.digits, 6, 4) <> '0000'", 40, "ssn|social security|tax id|taxpayer", "part no|order|invoice"),
)


def _word(words: str) -> str:
    return f"p.near RLIKE r'(?i)(?:^|[^A-Za-z0-9])(?:{words})(?:[^A-Za-z0-9]|$)'"


def _sum(array: str, start: str, n: str) -> str:
    return f"aggregate(slice({array}, {start}, {n}), 0L, (a, n) -> a + n)"


def spans(docs: DataFrame, text_col: str = "text", out_col: str = "spans", keep: list[str] | None = None, kinds: tuple[Kind, ...] = KINDS,
          least_score: int = LEAST_SCORE) -> DataFrame:
    """The rows with ``out_col``: ``array<struct<start, rank, end, kind, score>>``
    of all spans of personal data, by start and then by the order of ``kinds``
    (``rank``). Positions are code points, the end is exclusive.

    Matches of one kind do not overlap; those of different kinds may. A match
    that its validator refuses is dropped and not tried again. ``score`` (0 to
    100) is the kind's, raised or lowered by context words within ``NEAR`` code
    points; a span of a kind that is no base kind needs ``least_score``. ``keep``
    names the columns to carry (all by default). A null or empty text has an
    empty array; each row is judged by itself, so repeated rows and ids are no
    matter; an empty table gives an empty result; columns of any other name are
    carried, one named like ``out_col`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out_col.lower()]
    hidden = {c: f"__carried{i}" for i, c in enumerate(keep)}
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()], text.alias("t"))
    carried = list(hidden.values())
    rows = rows.selectExpr("*", "t RLIKE '[0-9]' AS has_digit")
    rows = rows.selectExpr(*carried, "t", *[f"CASE WHEN {k.present} THEN regexp_extract_all(t, r'{k.pattern}', 0) ELSE array() END AS found_{k.name}" for k in kinds])
    rows = rows.selectExpr(*carried, *[f"found_{k.name}" for k in kinds],
                           *[f"CASE WHEN size(found_{k.name}) > 0 THEN split(t, r'{k.pattern}', -1) END AS gap_{k.name}" for k in kinds])
    rows = rows.selectExpr(*carried, *[f"""transform(found_{k.name}, (f, i) -> named_struct('whole', f, 'gap', length(gap_{k.name}[i]), 'behind', left(gap_{k.name}[i + 1], 1),
        'near', concat(right(gap_{k.name}[i], {NEAR}), ' ', left(gap_{k.name}[i + 1], {NEAR})))) AS match_{k.name}""" for k in kinds])
    rows = rows.selectExpr(*carried, *[f"match_{k.name}" for k in kinds], *[f"transform(match_{k.name}, m -> CAST(m.gap + length(m.whole) AS long)) AS long_{k.name}" for k in kinds])
    blocks = "transform(sequence(0, (greatest(size(long_{0}), 1) - 1) div " + str(BLOCK) + "), b -> " + _sum("long_{0}", f"CAST(b * {BLOCK} + 1 AS int)", str(BLOCK)) + ") AS block_{0}"
    rows = rows.selectExpr("*", *[blocks.format(k.name) for k in kinds])
    rows = rows.selectExpr("*", *[f"transform(block_{k.name}, (n, b) -> {_sum(f'block_{k.name}', '1', 'b')}) AS before_{k.name}" for k in kinds])

    def placed(k: Kind) -> str:
        start = f"before_{k.name}[i div {BLOCK}] + {_sum(f'long_{k.name}', f'CAST(i div {BLOCK} * {BLOCK} + 1 AS int)', f'CAST(i % {BLOCK} AS int)')} + m.gap"
        cut = f"transform(array(m.whole), x -> {k.cut})[0]" if k.cut else "m.whole"
        return f"transform(match_{k.name}, (m, i) -> named_struct('start', {start}, 'found', {cut}, 'whole', m.whole, 'behind', m.behind, 'near', m.near)) AS match_{k.name}"

    rows = rows.selectExpr(*carried, *[placed(k) for k in kinds])
    rows = rows.selectExpr(*carried, *[f"""transform(match_{k.name}, m -> named_struct('start', m.start, 'found', m.found, 'digits', regexp_replace(m.found, '[^0-9]', ''),
        'after', CASE WHEN length(m.found) < length(m.whole) THEN substr(m.whole, length(m.found) + 1, 1) ELSE m.behind END, 'near', m.near)) AS match_{k.name}""" for k in kinds])

    def confirmed(k: Kind, rank: int) -> str:
        score = f"{k.score} + CASE WHEN {_word(k.up)} THEN {RAISE} ELSE 0 END" + (f" - CASE WHEN {_word(k.down)} THEN {LOWER} ELSE 0 END" if k.down else "")
        struct = f"named_struct('start', p.start, 'rank', {rank}, 'end', p.start + length(p.found), 'kind', '{k.name}', 'score', greatest(0, least(100, {score})))"
        kept = f"transform(filter(match_{k.name}, p -> {k.valid}), p -> {struct})"
        return kept if k.base else f"filter({kept}, s -> s.score >= {int(least_score)})"

    every = ", ".join(confirmed(k, r) for r, k in enumerate(kinds))
    return rows.selectExpr(*[f"`{h}` AS `{c}`" for c, h in hidden.items()], f"sort_array(concat({every})) AS `{out_col}`")


def listed(spans: str, only: tuple[str, ...] | None = None) -> str:
    """SQL of ``kind:start:end``, comma-joined, of an array that :func:`spans` made."""
    kept = f"filter({spans}, s -> s.kind IN ({', '.join(repr(k) for k in only)}))" if only else spans
    return f"array_join(transform({kept}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def masked(docs: DataFrame, text_col: str = "text", out_col: str = "masked", **settings) -> DataFrame:
    """The rows with ``out_col``: the text with ``[KIND]`` in place of each span; of
    spans that overlap, the first stands for all it overlaps. A null text stays null."""
    names = fresh(docs, "pii_found")
    found = spans(docs, text_col, names["pii_found"], **settings)
    rows = found.withColumn(names["pii_found"], F.expr(f"""aggregate(`{names['pii_found']}`, named_struct('at', 0L, 'out', CAST(array() AS array<string>)), (a, s) ->
        CASE WHEN s.start < a.at THEN named_struct('at', a.at, 'out', a.out)
        ELSE named_struct('at', s.end, 'out', concat(a.out, array(substr(`{text_col}`, CAST(a.at + 1 AS int), CAST(s.start - a.at AS int)), concat('[', upper(s.kind), ']')))) END)"""))
    text = F.expr(f"CASE WHEN `{text_col}` IS NOT NULL THEN concat(array_join(`{names['pii_found']}`.out, ''), substr(`{text_col}`, CAST(`{names['pii_found']}`.at + 1 AS int))) END")
    return rows.withColumn(out_col, text).drop(names["pii_found"])
