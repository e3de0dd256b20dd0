"""One query for each operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (arc_to_warc, bm25_search, chunk_dedup, compact_windows, html_text, line_dedup, mixing, near_dedup, quality_rules,
                      sentencepiece_codec, suffix_dedup, vector_codes, whitening)
from kiln.llm.common import read_table

__all__ = ["queries", "oracle_sql"]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op2_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_search.search(read_table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        F.get("positions", F.lit(0)).alias("first_position"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(read_table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.near_passages(read_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs, round_trip="round_trip").select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = arc_to_warc.write_archives(read_table(spark, sf_dir, "pages"))
    return arc_to_warc.read_archives(spark, archives)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"), "text")


def op11_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.classes(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(read_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.rows(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_suffix_dedup, op2_bm25_search, op3_html_text, op4_near_dedup, op5_mixing, op6_quality_rules,
        op7_compact_windows, op8_sentencepiece, op9_arc_to_warc, op10_line_dedup, op11_chunk_dedup,
        op12_vector_codes, op13_whitening)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Term weights in whole millionths, so that sums do not depend on their order.
OP2_SQL = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS w FROM documents),
t AS (SELECT doc_id, w, count(*)::DOUBLE AS tf FROM w GROUP BY ALL),
l AS (SELECT doc_id, sum(tf) AS dl FROM t GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, (SELECT sum(dl) FROM l) / (SELECT count(*) FROM documents) AS avg),
f AS (SELECT w, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t, n GROUP BY w),
s AS (SELECT q.doc_id AS query_id, t.doc_id,
             sum(round(1000000 * idf * (t.tf * 2.2 / (t.tf + 1.2 * (1 - 0.75 + 0.75 * dl / avg))))) AS units
      FROM t q JOIN t ON q.w = t.w JOIN f ON f.w = t.w JOIN l ON l.doc_id = t.doc_id, n
      WHERE q.doc_id % 100 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY units DESC, doc_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, doc_id, units / 1000000 AS score FROM r WHERE rank <= 10
"""

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
           FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
          JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (WITH RECURSIVE r(node, c) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN links l ON l.a = r.node AND r.c < l.b)
          SELECT node, min(c) AS c FROM r GROUP BY node)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, reach.c AS component_id, doc_id = reach.c AS kept
FROM documents JOIN reach ON reach.node = doc_id LEFT JOIN n USING (doc_id)
"""

# Demand of a source met before time t, inverted; the knots are those of mixing.SCHEDULES.
OP5_SQL = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix|' || doc_id) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
      FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             (3 * source_size)::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0.0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS lvl
      FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, rank, least(cap, max(lvl) OVER () * weight) AS target FROM l),
b AS (SELECT d.*, source_size, rank, target, floor(target / source_size)::BIGINT AS f,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + size / 2 AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, f + CASE WHEN middle < target - f * source_size THEN 1 ELSE 0 END AS copies FROM b),
u AS (SELECT *, least(1.0, middle / target) AS u FROM c)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies::INTEGER AS copies,
       CASE WHEN copies > 0 THEN least(1.0, CASE rank % 3
         WHEN 0 THEN CASE WHEN u <= 0.625 THEN 2 * u / (1.5 + sqrt(greatest(0.0, 2.25 - 2 * u)))
                     ELSE 0.5 + 2 * (u - 0.625) / (1.0 + sqrt(greatest(0.0, 1.0 - 2 * (u - 0.625)))) END
         WHEN 1 THEN u
         ELSE CASE WHEN u <= 0.375 THEN 2 * u / (0.5 + sqrt(greatest(0.0, 0.25 + 2 * u)))
                     ELSE 0.5 + 2 * (u - 0.375) / (1.0 + sqrt(greatest(0.0, 1.0 + 2 * (u - 0.375)))) END END)
       END AS first_position
FROM u
"""

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i,
             unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS k FROM d),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM h, range(5) t(k) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT d.doc_id, text, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(regexp_extract_all(text, '[A-Z]')) AS caps, len(regexp_extract_all(text, '[A-Za-z]')) AS letters,
             len(regexp_extract_all(text, '!')) AS bangs,
             coalesce(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])), 0) AS same
      FROM d LEFT JOIN r USING (doc_id)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR 100 * n_dup_lines > 50 * n_lines
            OR 100 * caps > 60 * letters OR 100 * bangs > 50 * n_words OR 100 * same > 30 * n_words) AS kept
FROM j
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, unnest(range(len(l) - 2)) AS i,
             unnest(list_transform(range(len(l) - 2), lambda i: array_to_string(l[i + 1:i + 3], chr(10)))) AS k FROM d),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k
      WHERE regexp_matches(k, '[^\x20\x09-\x0D]')),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM o, range(3) t(j) WHERE n > 1),
x AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM d),
e AS (SELECT x.doc_id, x.i, line, c.i IS NOT NULL AS gone FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i),
f AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM e)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       count(*) FILTER (opens)::BIGINT AS n_spans,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM f GROUP BY doc_id
"""


OP11_SQL = r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


def _op12_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Each round assigns parts and takes floors of means, written out one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p.part, min((list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), entry)) AS best
  FROM p JOIN b{r} b ON b.part = p.part GROUP BY vec_id, p.part)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT part, best[2] AS entry, i, sum(x)::DOUBLE AS s, count(*) AS n FROM (
      SELECT p.part, best, unnest(x) AS x, unnest(range(len(x))) AS i FROM p JOIN a{r} a ON a.vec_id = p.vec_id AND a.part = p.part)
    GROUP BY ALL) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(4096 * e::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS MATERIALIZED (SELECT vec_id, k AS part, x[k * len(x) // {parts} + 1:(k + 1) * len(x) // {parts}] AS x FROM v, range({parts}) t(k)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN f USING (vec_id)),
{", ".join(steps)},
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
e AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
      FROM a{rounds} GROUP BY vec_id),
g AS (SELECT e.*, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error FROM e JOIN v USING (vec_id))
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM g, s
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_bm25_search": OP2_SQL, "op4_near_dedup": OP4_SQL, "op5_mixing": OP5_SQL, "op6_quality_rules": OP6_SQL,
            "op10_line_dedup": OP10_SQL, "op11_chunk_dedup": OP11_SQL,
            "op12_vector_codes": _op12_sql()}
