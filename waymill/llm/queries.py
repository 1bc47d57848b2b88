"""The registered queries: each applies one operator to its whole table.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``; ``ORACLES`` has SQL with the same
result where SQL can express it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry.tables import Tables
from ..storage import new_folder
from .archives import read_archives, write_archives
from .columns import fold, word_count
from .conversations import damaged, repaired
from .fingerprint import fingerprint_edits
from .hosts import host_rules
from .interactions import audit_filters, judge_documents
from .jaccard import near_duplicates
from .language import identify_languages, learn_languages
from .mixing import mix_sources
from .pieces import encode_pieces
from .repeats import repeated_strings
from .scoring import score_documents
from .toxicity import fit_toxicity, score_toxicity
from .windows import repeated_windows

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    x AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS first FROM p),
    y AS (SELECT *, first IS NOT NULL AND (page_id IS NULL OR page_id <> first) AS again FROM x)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform([1, 11, 21, 31], lambda i: translate(lpad(to_base(('0x' || substr(s, i, 10))::BIGINT, 32),
               8, '0'), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN first END AS refers_to
    FROM y
    """
)
def op1_archives(t: Tables) -> DataFrame:
    """All pages written as records and read back."""
    packages = write_archives(t.pages, new_folder(t.spark, "archives"), revisit_bytes=0)
    records = read_archives(packages, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_fingerprints(t: Tables) -> DataFrame:
    """All documents and their edited texts."""
    return fingerprint_edits(t.documents.select("doc_id", "text"))


@query()
def op3_lm_scores(t: Tables) -> DataFrame:
    """All documents, learning from those outside the held-out fold."""
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    scored = score_documents(t.documents.select("doc_id", "text"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "scored_by")


@query()
def op4_toxicity(t: Tables) -> DataFrame:
    """All documents against labelled examples outside the held-out fold."""
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    labels = t.labels.filter(~held_out).select("doc_id", "toxic")
    docs = t.documents.select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), threshold=0.3)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.col("evidence.example").alias("evidence"))


@query(
    r"""
    WITH d AS (SELECT doc_id, source,
                      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
                 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight FROM d GROUP BY source),
    o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS k,
                 coalesce(sum(cap) OVER (ORDER BY cap / weight, source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS held,
                 sum(weight) OVER (ORDER BY cap / weight, source
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS free FROM s),
    l AS (SELECT ((SELECT sum(source_size)::BIGINT FROM s) - held)::DOUBLE / free::DOUBLE AS level FROM o
          WHERE cap >= weight * (((SELECT sum(source_size)::BIGINT FROM s) - held)::DOUBLE / free::DOUBLE)
          ORDER BY k LIMIT 1),
    t AS (SELECT source, source_size, least(weight * level, cap::DOUBLE) AS target,
                 (('0x' || substr(md5(concat('0/', CASE WHEN source IS NULL THEN '0' ELSE '1' || source END)), 1, 6))::BIGINT
                  % 1024 * 2 + 1) / 2048.0::DOUBLE AS shift FROM s, l),
    p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
                 CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0 END AS each,
                 row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, '')),
                                    d.doc_id NULLS FIRST) AS i
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           least(floor(shift + i * each) - floor(shift + (i - 1) * each), 3)::BIGINT AS copies,
           (least(floor(shift + i * each) - floor(shift + (i - 1) * each), 3) * size)::BIGINT AS taken
    FROM p
    """
)
def op5_source_mix(t: Tables) -> DataFrame:
    """All documents, sized in words, mixed to weights of 1, 2, 3 in turn."""
    sized = t.documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix_sources(sized, weights=(1, 2, 3), share=1, most=3)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query()
def op6_pieces(t: Tables) -> DataFrame:
    """All documents segmented and decoded again."""
    coded = encode_pieces(t.documents.select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query()
def op7_suffix_dedup(t: Tables) -> DataFrame:
    """All documents without their byte strings of 200 that occur again."""
    found = repeated_strings(t.documents.select("doc_id", "text"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
    g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM w, unnest(range(1, len(ws) - 1)) x(i)),
    rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(3) y(k) GROUP BY r),
    li AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
           FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
           WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
    m AS (SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 coalesce(li.n_lines, 0)::BIGINT AS n_lines, coalesce(li.dup, 0)::BIGINT AS n_dup_lines,
                 coalesce(cov.n, 0)::BIGINT AS n_repeat_words
          FROM w LEFT JOIN li USING (r) LEFT JOIN cov USING (r)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    f AS (SELECT *, base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 30 * n_lines
                    OR word_chars < 2.0 * n_words OR word_chars > 12.0 * n_words AS failed FROM b),
    h AS (SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f FROM f GROUP BY source),
    z AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(n * n) AS sq, sum(f * f / n) AS ratio FROM h),
    y AS (SELECT *, (f + 0.5) / (n + 1) AS rate, n - sq / n - (k - 1) AS freedom FROM z),
    x AS (SELECT *, least(greatest(CASE WHEN freedom <= 0 THEN 1.0
                 ELSE ((ratio - f * f / n) / (rate * (1 - rate)) - (k - 1)) / freedom END, 1e-4), 0.5) AS within FROM y),
    v AS (SELECT h.source, (h.f + x.rate * (1 / within - 1)) / (h.n + (1 / within - 1)) <= 0.5 AS host_kept FROM h, x)
    SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND host_kept AS kept
    FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
    """
)
def op8_host_rules(t: Tables) -> DataFrame:
    """All documents against the rules, and their sources as hosts."""
    judged = host_rules(t.documents.select("doc_id", "text", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    r"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
    g AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
    e AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS x FROM g),
    f AS MATERIALIZED (SELECT r, n, x FROM e WHERE x IN (SELECT x FROM e GROUP BY x HAVING count(*) > 1)),
    p AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM f a JOIN f b USING (x) WHERE a.r <> b.r
          GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach(a, b) AS (SELECT r, r FROM g UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a)
    SELECT g.doc_id, any_value(len(g.s))::BIGINT AS n_shingles, min(o.doc_id) AS component_id
    FROM g JOIN reach ON reach.a = g.r JOIN g o ON o.r = reach.b GROUP BY g.r, g.doc_id
    """
)
def op9_near_duplicates(t: Tables) -> DataFrame:
    """All documents, by sets of five-word shingles with 80 percent or more in common."""
    return near_duplicates(t.documents.select("doc_id", "text"), words=5, percent=80)


@query()
def op10_language(t: Tables) -> DataFrame:
    """The language of all documents, learnt outside the held-out fold."""
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    filters = learn_languages(t.documents.filter(~held_out).select("lang", "text"))
    found = identify_languages(t.documents.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query(
    r"""
    WITH least AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first FROM documents GROUP BY 1),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
    w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    d AS (SELECT part, CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
                 || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
                 || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
                 || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                 || CASE WHEN w.doc_id > first THEN 'E' ELSE '' END AS fails, good, toxic
          FROM w JOIN least USING (t) LEFT JOIN marks ON marks.doc_id = w.doc_id),
    m AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM d GROUP BY 1, 2),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM f a, f b, f c, f d, f e
          WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    r AS (SELECT m.*, filter_order, list_min(list_transform(['A', 'B', 'C', 'D', 'E'],
                 lambda x: CASE WHEN contains(fails, x) THEN instr(filter_order, x) ELSE 9 END)) AS gone FROM m, o),
    c AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS l,
                 sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN gone < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN gone = step THEN good ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN gone = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
          FROM r, (SELECT unnest(range(1, 6))::INTEGER AS step) GROUP BY 1, 2, 3)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM c
    """
)
def op11_filter_audit(t: Tables) -> DataFrame:
    """Five filters over all documents, in all orders, by source."""
    return audit_filters(judge_documents(t.documents, t.labels), "ABCDE")


@query(
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM d, unnest(range(1, len(w) - 18)) x(i)),
    r AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
    c AS (SELECT DISTINCT doc_id, i + k AS i FROM r, range(20) y(k)),
    k AS (SELECT d.doc_id, x.i, w[x.i] AS word, c.i IS NOT NULL AS gone
          FROM d CROSS JOIN unnest(range(1, len(w) + 1)) x(i) LEFT JOIN c ON c.doc_id = d.doc_id AND c.i = x.i),
    a AS (SELECT doc_id, sum(gone::INT) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN a USING (doc_id)
    """
)
def op12_substring_dedup(t: Tables) -> DataFrame:
    """All documents without the words of windows of 20 that occur earlier."""
    found = repeated_windows(t.documents.select("doc_id", "text"), window=20)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


@query(
    r"""
    WITH RECURSIVE
    b AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    x AS (SELECT DISTINCT k, flatten(list_transform(range(1, length(k) + 1),
                 lambda i: list_concat([ascii(substr(k, i, 1))::BIGINT], list_transform(range(8), lambda j: -1::BIGINT)))) AS s FROM b),
    y AS (SELECT k, xor(list_reduce(list_concat([4294967295::BIGINT], s), lambda c, v: CASE WHEN v >= 0 THEN xor(c, v)
                 WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 20 AS h FROM x),
    d AS (SELECT conv_id AS id, coalesce(conv_id::VARCHAR, 'none') AS c, turn, CASE WHEN h = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                 CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS t
          FROM b JOIN y USING (k), range(CASE WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(t)) AS i, substr(role, 1, 1) AS r FROM d),
    f AS (SELECT *, NOT regexp_matches(t, '[^\x20\x09-\x0D]') AS blank,
                 row_number() OVER (PARTITION BY c, role, t ORDER BY i) > 1 AS again,
                 lag(r) OVER (PARTITION BY c ORDER BY i) || r AS pair FROM n),
    g AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND NOT regexp_matches(t, '[.!?][\x20\x09-\x0D]*$') AS cut FROM f),
    v(p, q, k) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
    o(r, p, q, cost, a) AS (VALUES ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'), ('a', 2, 3, 0, 'K'),
                 ('', 0, 2, 2, 'R'), ('', 1, 2, 2, 'R'), ('', 3, 2, 2, 'R'), ('', 2, 3, 2, 'R'),
                 ('-', 0, 0, 3, 'D'), ('-', 1, 1, 3, 'D'), ('-', 2, 2, 3, 'D'), ('-', 3, 3, 3, 'D')),
    w AS (SELECT o.r, v.p, o.q, 2 * v.k + o.cost AS cost, repeat('I', v.k) || o.a AS a FROM v JOIN o ON v.q = o.p),
    e AS (SELECT g.c, g.i, w.p, w.q, min({'cost': w.cost + CASE WHEN cut AND w.r <> '-' THEN 1 ELSE 0 END, 'a': w.a}) AS best
          FROM g JOIN w ON w.r = '-' OR NOT gone AND w.r IN ('', g.r) GROUP BY ALL),
    s AS (SELECT DISTINCT c, 0::BIGINT AS i, 0 AS p, {'cost': 0, 'a': ''} AS best FROM g
          UNION ALL
          SELECT s.c, s.i + 1, e.q, min({'cost': s.best.cost + e.best.cost, 'a': s.best.a || e.best.a})
          FROM s JOIN e ON e.c = s.c AND e.i = s.i + 1 AND e.p = s.p GROUP BY 1, 2, 3),
    z AS (SELECT s.c, min({'cost': best.cost + 2 * v.k, 'a': best.a || repeat('I', v.k)}) AS best
          FROM s JOIN v ON v.p = s.p AND v.q IN (0, 3) WHERE s.i = (SELECT max(g.i) FROM g WHERE g.c = s.c) GROUP BY 1),
    l AS (SELECT c, j, substr(best.a, j, 1) AS a FROM z, unnest(range(1, length(best.a) + 1)) u(j)),
    m AS (SELECT *, sum((a <> 'I')::INT) OVER (PARTITION BY c ORDER BY j) AS i FROM l),
    q AS (SELECT m.c, m.a, m.j, g.r, g.role, g.t, row_number() OVER (PARTITION BY m.c ORDER BY j) AS place
          FROM m LEFT JOIN g ON g.c = m.c AND g.i = m.i AND m.a <> 'I' WHERE m.a <> 'D'),
    first AS (SELECT c, bool_or(place = 1 AND a = 'K' AND r = 's')::INT AS head FROM q GROUP BY 1),
    h AS (SELECT c, sha256(string_agg(CASE WHEN a = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
                 || ':' || coalesce(t, ''), chr(10) ORDER BY j)) AS hash FROM q JOIN first USING (c) GROUP BY 1),
    k AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
                 sum((again AND NOT blank)::INT) AS duplicate, sum(cut::INT) AS truncated,
                 coalesce(sum((pair NOT IN ('su', 'ua', 'au'))::INT), 0) AS illegal FROM g GROUP BY 1),
    every AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
           coalesce(best.a, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
    FROM every LEFT JOIN k ON k.c = coalesce(conv_id::VARCHAR, 'none') LEFT JOIN z ON z.c = k.c LEFT JOIN h ON h.c = k.c
    """
)
def op13_conversation_repair(t: Tables) -> DataFrame:
    """All conversations, damaged by their rows' crc32, and repaired."""
    return repaired(t.conversations, damaged(t.conversations))
