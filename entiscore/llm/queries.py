"""The thin queries of the numbered operators over the driver tables, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.llm.pii import IBAN_LENGTHS


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents that belong to a licence family."""
    from entiscore.llm import licenses

    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan(docs, licenses.train(spark, docs))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of the smallest feasible capacity."""
    from entiscore.llm.sharding import shard

    out = shard(_table(spark, sf_dir, "documents", "doc_id", "text"), 24, keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "capacity")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best occurrence of each benchmark item, whatever its length, in each document that holds it, up to a tenth of the item's words edited."""
    from entiscore.llm import decontamination

    return decontamination.leaks(_table(spark, sf_dir, "documents", "doc_id", "text"),
                                 _table(spark, sf_dir, "benchmark", "item_id", "text"), least_words=1).drop("row")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 50-word windows that a document with a smaller id has too."""
    from entiscore.llm import substrings

    out = substrings.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their links at a 4-word-shingle Jaccard of 0.85 or more."""
    from entiscore.llm import jaccard

    return jaccard.components(_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 under the curriculum, in the order of their first use."""
    from entiscore.llm.mixing import mix

    plan = mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source"), keep=["doc_id"])
    first = plan.withColumn("first_position", F.try_element_at("positions", F.lit(1)))
    return (first.select("doc_id", "size", "source_size", "target", "taken", "passes", "cut", "first_position")
            .orderBy(F.col("first_position").asc_nulls_last(), "doc_id"))


def _fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from labels outside the held-out third."""
    from entiscore.llm import toxicity

    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic").filter(_fold("doc_id", 3) != 1)
    out = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return out.select("doc_id", F.coalesce(_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt outside the held-out quarter."""
    from entiscore.llm import langid

    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(docs.filter(_fold("doc_id", 4) != 2))
    out = langid.predict(docs, model, keep=["doc_id"])
    return out.select("doc_id", F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of the rule cascade on all documents."""
    from entiscore.llm import quality

    return quality.cascade(_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back. A response's size and
    digest are those of the payload as read; a revisit's stand in its headers."""
    from entiscore.llm import warc

    back = warc.read(spark, warc.archive(_table(spark, sf_dir, "pages", "page_id", "url", "html"))).drop("payload")
    page = lambda c: F.regexp_extract(c, "^urn:page:(.+)$", 1)
    return back.select(F.nullif(page("record_id"), F.lit("")).cast("long").alias("page_id"), "payload_bytes",
                       F.coalesce("actual_digest", "payload_digest").alias("payload_digest"), "record_type",
                       F.nullif(page("refers_to"), F.lit("")).cast("long").alias("refers_to"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    from entiscore.llm import lexical

    return lexical.search(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of all documents, alone and together, in every order."""
    from entiscore.llm import audit

    return audit.audit(_table(spark, sf_dir, "documents", "doc_id", "text", "source"), _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from entiscore.llm import pii

    base = tuple(k.name for k in pii.KINDS if k.base)
    found = pii.spans(_table(spark, sf_dir, "documents", "doc_id", "text"), out_col="found", keep=["doc_id"])
    return found.selectExpr("doc_id", *[f"CAST(size(filter(found, s -> s.kind = '{k}')) AS long) AS n_{k}" for k in base],
                            f"sha2({pii.listed('found', base)}, 256) AS base_sha256", f"{pii.listed('found')} AS spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_licenses": op3_licenses,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_substrings": op7_substrings,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_search": op11_search,
    "op12_audit": op12_audit,
    "op13_pii": op13_pii,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
        n AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
        stats AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
        b AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        q AS (SELECT i, t, count(*) AS times FROM (SELECT i, unnest(ts) AS t FROM b) GROUP BY i, t),
        tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
        w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, stats GROUP BY t, n_docs),
        gain AS (SELECT n.r, n.doc_id, tf.t, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n.n * n_docs) // n_terms))) AS g
            FROM tf JOIN n USING (r) JOIN w USING (t), stats),
        s AS (SELECT i, r, doc_id, CAST(sum(times * g) AS BIGINT) AS score FROM q JOIN gain USING (t) GROUP BY i, r, doc_id),
        ranked AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN b USING (i) WHERE rank <= 20""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        q AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS d FROM p),
        f AS (SELECT d, min(page_id) AS first FROM q WHERE n >= 100 GROUP BY d)
        SELECT q.page_id, q.n AS payload_bytes, q.d AS payload_digest,
               CASE WHEN q.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN q.page_id > f.first THEN f.first END AS refers_to
        FROM q LEFT JOIN f ON q.d = f.d""",
    "op12_audit": f"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
        m AS (SELECT text AS t, min(doc_id) AS first FROM d GROUP BY text),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT row_number() OVER () AS r, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
            concat(CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END,
                CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN d.doc_id > m.first THEN 'E' ELSE '' END) AS fails
            FROM d JOIN m ON d.text = m.t LEFT JOIN l ON l.doc_id = d.doc_id),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS o FROM x a, x b, x c, x d, x e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
        counted AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        seen AS (SELECT part, o, step, o[step] AS x, fails, good, toxic, n, length(translate(fails, o[1:step], '')) < length(fails) AS gone,
            length(translate(fails, o[1:step - 1], '')) < length(fails) AS gone_before, contains(fails, o[step]) AS failing FROM counted, steps),
        s AS (SELECT part, o, step, x, sum(n) FILTER (NOT gone) AS kept, sum(n) FILTER (gone AND NOT gone_before) AS removed,
            sum(n) FILTER (failing AND gone_before) AS redundant, sum(n) FILTER (fails = x) AS unique_fails,
            sum(n) FILTER (gone AND NOT gone_before AND good) AS good_lost, sum(n) FILTER (gone AND NOT gone_before AND toxic) AS toxic_lost
            FROM seen GROUP BY part, o, step, x)
        SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
            CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
            CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
            CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley FROM s""",
    "op13_pii": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        kinds AS (SELECT * FROM (VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
            (2, 'card', '[0-9]([ -]?[0-9])+'), (3, 'phone', '\+[0-9][ ().0-9-]+[0-9]'),
            (4, 'iban', '(^|[^A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}( ?[A-Z0-9]){{11,30}}'), (5, 'ssn', '[0-9]+(-[0-9]+)+')) AS k(rank, kind, p)),
        m AS (SELECT r, rank, kind, regexp_extract_all(t, p) AS f, string_split_regex(t, p) AS g FROM d, kinds WHERE regexp_matches(t, p)),
        e AS (SELECT r, rank, kind, f, g, unnest(range(1, len(f) + 1)) AS i FROM m),
        placed AS (SELECT r, rank, kind, f[i] AS x, concat(right(g[i], 40), ' ', left(g[i + 1], 40)) AS near, left(g[i + 1], 1) AS behind,
            CAST(list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS pos FROM e),
        own AS (SELECT * REPLACE (CASE WHEN kind = 'iban' AND regexp_matches(x, '^[^A-Za-z0-9]') THEN x[2:] ELSE x END AS x,
            CASE WHEN kind = 'iban' AND regexp_matches(x, '^[^A-Za-z0-9]') THEN pos + 1 ELSE pos END AS pos) FROM placed),
        sized AS (SELECT *, regexp_replace(x, '[^0-9]', '', 'g') AS digits, CASE WHEN kind = 'iban' THEN list_filter(range(1, length(x) + 1),
            lambda n: length(replace(x[1:n], ' ', '')) = CAST(regexp_extract('{IBAN_LENGTHS}', concat(x[1:2], '([0-9]+)'), 1) AS INTEGER))[1] END AS cut
            FROM own WHERE kind <> 'iban' OR contains('{IBAN_LENGTHS}', x[1:2])),
        found AS (SELECT * REPLACE (CASE WHEN kind = 'iban' THEN x[1:cut] ELSE x END AS x), CASE WHEN cut < length(x) THEN x[cut + 1] ELSE behind END AS after FROM sized
            WHERE kind <> 'iban' OR cut IS NOT NULL),
        spans AS (SELECT r, rank, kind, pos, concat_ws(':', kind, pos, pos + length(x)) AS span FROM found WHERE CASE kind
            WHEN 'email' THEN true
            WHEN 'ip' THEN list_bool_and(list_transform(string_split(x, '.'), lambda q: length(ltrim(q, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(q, '0') AS INTEGER), 0) <= 255))
            WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN (length(digits) - i) % 2 = 0
                THEN ascii(digits[i]) - 48 ELSE 2 * (ascii(digits[i]) - 48) - CASE WHEN digits[i] > '4' THEN 9 ELSE 0 END END)) % 10 = 0
            WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
            WHEN 'iban' THEN NOT regexp_matches(after, '[A-Za-z0-9]') AND list_reduce(list_prepend(0, list_transform(string_split(concat(x[5:], x[1:4]), ''), lambda c: ascii(c))),
                lambda a, c: CASE WHEN c = 32 THEN a WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1
            ELSE regexp_full_match(x, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') AND digits[1:3] NOT IN ('000', '666') AND digits[1] <> '9' AND digits[4:5] <> '00' AND digits[6:9] <> '0000'
                AND regexp_matches(near, '(?i)(^|[^A-Za-z0-9])(ssn|social security|tax id|taxpayer)([^A-Za-z0-9]|$)')
                AND NOT regexp_matches(near, '(?i)(^|[^A-Za-z0-9])(part no|order|invoice)([^A-Za-z0-9]|$)') END),
        s AS (SELECT r, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
            count(*) FILTER (rank = 3) AS n_phone, string_agg(span, ',' ORDER BY pos, rank) FILTER (rank < 4) AS base, string_agg(span, ',' ORDER BY pos, rank) AS spans FROM spans GROUP BY r)
        SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (r)""",
    "op5_quality": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
        spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d),
        wins AS (SELECT doc_id, i, ws[i:i + 4] AS k FROM spots),
        twice AS (SELECT doc_id, k FROM wins GROUP BY doc_id, k HAVING count(*) > 1),
        rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM
            (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM wins JOIN twice USING (doc_id, k)) GROUP BY doc_id),
        lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dups FROM
            (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
        single AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY doc_id, w),
        top AS (SELECT doc_id, max(n) AS n, sum(n) FILTER (WHERE regexp_matches(w, '[A-Za-z]|[^\\x00-\\x7F]')) AS lettered FROM single GROUP BY doc_id),
        m AS (SELECT d.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.dups, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
            coalesce(lines.n, 0) AS n_lines, coalesce(top.n, 0) AS top_n, coalesce(top.lettered, 0) AS lettered,
            len(regexp_extract_all(text, '[A-Z]')) AS upper_n, len(regexp_extract_all(text, '[A-Za-z]')) AS letter_n
            FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN top USING (doc_id)),
        f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND n_symbols <= 0.1 * n_words AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND n_dup_lines <= 0.5 * n_lines
            AND lettered >= 0.8 * n_words AND upper_n <= 0.5 * letter_n AND top_n <= 0.25 * n_words AS kept FROM f""",
    "op7_substrings": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
        spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d),
        wins AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM spots),
        hits AS (SELECT wins.doc_id, i FROM wins JOIN (SELECT k, min(doc_id) AS first FROM wins GROUP BY k) USING (k) WHERE first < doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM hits),
        each_word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM d),
        kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY j) AS t, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_ngram_jaccard": f"""
        WITH RECURSIVE low AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        d AS (SELECT doc_id, {_WORDS} AS ws FROM low),
        sh AS (SELECT DISTINCT doc_id, ws[i:i + 3] AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.c AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) least ON least.a = d.doc_id""",
}
