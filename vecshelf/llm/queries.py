"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.llm import (
    bpe, cross_tokens, exact_dedup, html_extract, language, mixing, near_dedup, quality, rules, topk, toxicity, turns, url_filter
)
from vecshelf.llm.common import remainder

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

_registry: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _registry[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registry)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_near_dedup(spark, sf):
    return near_dedup.near_groups(table(spark, sf, "documents"), words=4)


@query
def op2_html_extract(spark, sf):
    pages = table(spark, sf, "pages")
    found = html_extract.extracted(pages, html_extract.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")


@query
def op3_url_filter(spark, sf):
    pages = table(spark, sf, "pages")
    edges = url_filter.canonical_links(pages)
    return url_filter.judged(pages, URL_RULES, edges)


@query
def op4_source_mix(spark, sf):
    mixed = mixing.mixed(table(spark, sf, "documents")).withColumn("first_position", F.get("positions", F.lit(0)))
    return mixed.drop("source", "positions").orderBy(F.asc_nulls_last("first_position"), "doc_id")


@query
def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.fit(docs.where(remainder("doc_id", 4) != 2))
    return language.identified(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query
def op6_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    weights = quality.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return quality.scored(docs, weights).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op7_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.decoded(bpe.encoded(table(spark, sf, "documents"), path), path)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op8_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


@query
def op9_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors)


@query
def op10_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    index = toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1))
    return toxicity.scored(docs, index).select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECTED).cast("int").alias("predicted"),
        F.size("evidence").alias("n_evidence"),
    )


@query
def op11_quality_rules(spark, sf):
    found = rules.checked(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.withColumn("failed", F.array_join("failed", ","))


@query
def op12_cross_tokens(spark, sf):
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return cross_tokens.aligned(table(spark, sf, "documents"), *paths)


@query
def op13_turn_repair(spark, sf):
    return turns.repairs(table(spark, sf, "conversations"))


def _inverse_sql(schedule: mixing.Schedule, share: str) -> str:
    """When a schedule's integral reaches a share of its whole, as `mixing.inverse_demand` has it."""
    whole, done, cases = mixing.integral(schedule), 0.0, ""
    for (x, v), (y, w) in zip(schedule, schedule[1:]):
        slope = (w - v) / (y - x)
        need = f"greatest({share} * {whole}::DOUBLE - {done}::DOUBLE, 0::DOUBLE)"
        root = f"({v}::DOUBLE + sqrt(greatest({v * v}::DOUBLE + {2 * slope}::DOUBLE * {need}, 0::DOUBLE)))"
        done += (v + w) / 2 * (y - x)
        cases += (
            f" WHEN {share} * {whole}::DOUBLE <= {done}::DOUBLE THEN "
            f"least({x}::DOUBLE + CASE WHEN {root} > 0 THEN 2 * {need} / {root} ELSE 0 END, {y}::DOUBLE)"
        )
    return f"CASE{cases} ELSE {schedule[-1][0]}::DOUBLE END"


_POSITION = " ".join(
    f"WHEN {i} THEN {_inverse_sql(schedule, 'least((before + size / 2.0::DOUBLE) / target, 1::DOUBLE)')}"
    for i, schedule in enumerate(mixing.SCHEDULES)
)

_OP4 = r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, source_size * 2.0::DOUBLE AS most,
        [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS rnk
    FROM sums
),
levels AS (
    SELECT *, row_number() OVER o AS place,
        (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked WINDOW o AS (ORDER BY most / weight, rnk)
),
targets AS (
    SELECT source, source_size, (rnk - 1) % 3 AS kind, sum(source_size) OVER () * 1.5::DOUBLE AS whole,
        least(most, weight * (SELECT arg_min(level, place) FROM levels WHERE level <= most / weight)) AS target
    FROM levels
),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, t.kind, t.whole,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
taken AS (
    SELECT *, CAST(CASE WHEN size > 0 THEN size * (passes
        + CASE WHEN before + size / 2.0::DOUBLE <= target - passes * source_size THEN 1 ELSE 0 END)
        ELSE 0 END AS BIGINT) AS taken
    FROM placed
)
SELECT doc_id, size, source_size, target, taken,
    CASE WHEN taken > 0 THEN (CASE kind POSITION END) * whole END AS first_position
FROM taken
""".replace("POSITION", _POSITION)

_OP8 = r"""
WITH rows AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
),
groups AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(body) AS text_sha256
FROM rows JOIN groups USING (body)
"""

_OP9 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vectors),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id != c.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
FROM scores
QUALIFY rank <= 20
"""




def _rules_sql() -> str:
    """Figures of whole texts, then exact tails along each grid of cutoffs, as `rules.fit` has them."""
    grid = ", ".join(
        f"({i}, '{rule.name}', {place}, {cutoff})"
        for i, rule in enumerate(rules.RULES) for place, cutoff in enumerate(rule.cutoffs)
    )
    over = " ".join(
        f"WHEN {i} THEN 100 * {'-word_chars' if rule.over == 'minus_chars' else rule.over} > cutoff * {rule.under}"
        for i, rule in enumerate(rules.RULES)
    )
    p, error = rules.RISK / len(rules.RULES), rules.ERROR
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS body FROM documents),
words AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
    FROM (SELECT r, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM texts)
),
windows AS (
    SELECT r, i, string_agg(word, ' ') OVER f AS span, count(*) OVER f AS n
    FROM words WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
),
twice AS (SELECT r, i FROM windows WHERE n = 8 QUALIFY count(*) OVER (PARTITION BY r, span) > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS t(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(body, chr(10))) AS line FROM texts),
line_counts AS (
    SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
word_counts AS (SELECT r, count(*) AS n, sum(length(word)) AS chars FROM words GROUP BY r),
figures AS (
    SELECT doc_id, stratum, CAST(coalesce(w.n, 0) AS BIGINT) AS n_words, CAST(coalesce(w.chars, 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(body, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_lines,
        CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN word_counts w USING (r) LEFT JOIN line_counts l USING (r) LEFT JOIN repeated p USING (r)
),
based AS (
    SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed FROM figures
),
grid(rule, name, place, cutoff) AS (VALUES {grid}),
good AS (SELECT doc_id, avg(quality) >= 0.5 AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
holdout AS (SELECT * FROM based JOIN good USING (doc_id) WHERE NOT base_failed),
sizes AS (
    SELECT stratum, count(*) FILTER (good) AS goods, count(*) FILTER (NOT good) AS bads,
        count(*) OVER () * {len(rules.RULES)} AS tests
    FROM holdout GROUP BY stratum
),
failed AS (
    SELECT stratum, rule, place, cutoff, count(*) FILTER (good AND over) AS good, count(*) FILTER (NOT good AND over) AS bad
    FROM (SELECT *, CASE rule {over} END AS over FROM holdout, grid) GROUP BY ALL
),
tails AS (
    SELECT f.*, s.goods, s.bads, s.tests, CASE WHEN f.good >= s.goods * {p}::DOUBLE THEN 1 ELSE (
        SELECT sum(exp(lgamma(s.goods + 1) - lgamma(i + 1) - lgamma(s.goods - i + 1)
            + i * ln({p}::DOUBLE) + (s.goods - i) * ln({1 - p}::DOUBLE))) FROM range(f.good + 1) AS t(i)
    ) END AS tail
    FROM failed f JOIN sizes s USING (stratum)
),
passed AS (
    SELECT *, bad::DOUBLE / greatest(1, bads) - good::DOUBLE / greatest(1, goods) AS told,
        max(CASE WHEN tail > {error}::DOUBLE / tests THEN 1 ELSE 0 END) OVER (PARTITION BY stratum, rule ORDER BY place) AS broken
    FROM tails
),
chosen AS (
    SELECT stratum, rule, cutoff FROM passed WHERE broken = 0 AND told > 0
    QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY round(told, 12) DESC, place) = 1
),
verdicts AS (
    SELECT b.*, (SELECT string_agg(name, ',' ORDER BY rule) FROM chosen c JOIN (SELECT DISTINCT rule, name FROM grid) g USING (rule)
        WHERE c.stratum = b.stratum AND CASE rule {over} END) AS failed
    FROM based b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed
FROM verdicts
"""


_OP13 = r"""
WITH RECURSIVE keyed AS (
    SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key,
        dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c
    FROM conversations
),
drawn AS (
    SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
            lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)), CAST(4294967295 AS BIGINT)) % 20 AS kind
    FROM keyed
),
damaged AS (
    SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM drawn)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
rows AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM placed
),
paths(state, added, reached, made) AS (VALUES
    (0, 0, 0, []::VARCHAR[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 0, 1, []), (1, 1, 2, ['user:']),
    (1, 2, 3, ['user:', 'assistant:']), (2, 0, 2, []), (2, 1, 3, ['assistant:']), (3, 0, 3, []), (3, 1, 2, ['user:'])),
edits(letter, reached, initial, next, cost) AS (VALUES
    ('D', 0, NULL, 0, 4), ('D', 1, NULL, 1, 4), ('D', 2, NULL, 2, 4), ('D', 3, NULL, 3, 4),
    ('R', 0, NULL, 2, 3), ('R', 1, NULL, 2, 3), ('R', 2, NULL, 3, 3), ('R', 3, NULL, 2, 3),
    ('K', 0, 's', 1, 0), ('K', 0, 'u', 2, 0), ('K', 1, 'u', 2, 0), ('K', 2, 'a', 3, 0), ('K', 3, 'u', 2, 0)),
nodes(c, i, state, cost, audit, lines) AS (
    SELECT DISTINCT c, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '', []::VARCHAR[] FROM keyed
    UNION ALL
    SELECT c, i, next, cost, audit, lines FROM (
        SELECT n.c, r.i, e.next,
            n.cost + 3 * p.added + e.cost + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
            n.audit || repeat('I', p.added) || e.letter AS audit,
            list_concat(n.lines, p.made, CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text]
                ELSE [CASE e.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] END) AS lines
        FROM nodes n JOIN rows r ON r.c = n.c AND r.i = n.i + 1 JOIN paths p ON p.state = n.state
        JOIN edits e ON e.reached = p.reached AND (e.initial IS NULL OR e.initial = r.initial)
        WHERE e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate')
    ) QUALIFY row_number() OVER (PARTITION BY c, next ORDER BY cost, audit) = 1
),
facts AS (
    SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) AS before FROM rows) GROUP BY c
),
ended AS (
    SELECT n.c, n.cost + p.added * 3 AS cost, n.audit || repeat('I', p.added) AS audit, list_concat(n.lines, p.made) AS lines
    FROM nodes n LEFT JOIN facts f ON f.c = n.c JOIN paths p ON p.state = n.state
    WHERE n.i = coalesce(f.n, 0) AND (p.reached = 3 OR n.state = 0 AND p.added = 0)
    QUALIFY row_number() OVER (PARTITION BY n.c ORDER BY n.cost + p.added * 3, n.audit || repeat('I', p.added)) = 1
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
    sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM keyed) k JOIN ended e ON e.c = k.c LEFT JOIN facts f ON f.c = k.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mix": _OP4, "op8_exact_dedup": _OP8, "op9_top_k": _OP9, "op11_quality_rules": _rules_sql(), "op13_turn_repair": _OP13}
