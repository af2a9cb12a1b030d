"""Thin queries over the driver tables, one per operator, and the SQL for those it can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, filter_audit, hard_negatives, html_main, lattice, mixing, onebit_ann, pieces, pii,
               quality_model, quality_rules, simhash, suffix_dedup, token_counts)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    by_text = suffix_dedup.remove_repeats(docs)
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return docs.select("doc_id", digest.alias("digest")) \
        .join(by_text.select("digest", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")), "digest") \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_simhash_dedup")
def op3_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")) \
        .select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


_KNOTS = [mixing.integral(k) for k in mixing.CURRICULUM]


@query("op4_source_mixing", f"""
WITH sized AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT AS ord
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, encode(source))) - 1) % 3 AS kind
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE kind WHEN 0 THEN {_KNOTS[0]}::DOUBLE WHEN 1 THEN {_KNOTS[1]}::DOUBLE ELSE {_KNOTS[2]}::DOUBLE END AS w,
         2 * CAST(source_size AS DOUBLE) AS cap
  FROM per_source),
levelled AS (
  SELECT *, ({mixing.MIX_SHARE}::DOUBLE * (SELECT sum(source_size) FROM per_source)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, kind, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / ((SELECT sum(w) FROM weighed)
             - coalesce(sum(w) OVER (ORDER BY cap / w, kind, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
target AS (
  SELECT source, source_size,
         least(cap, w * (SELECT arg_min(level, cap / w) FROM levelled WHERE cap >= w * level)) AS target
  FROM levelled),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS demand,
         CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, demand - start)) + greatest(0, least(size, demand - source_size - start)) AS BIGINT) AS taken
FROM placed
""")
def op4_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), keep_rows=False) \
        .select("_row.doc_id", "size", "source_size", "target", "taken")


@query("op9_onebit_ann", """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
far AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
           range(1, len(q.v) + 1), lambda i: (c.v[i] - q.v[i]) * (c.v[i] - q.v[i])), lambda x, y: x + y)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id != c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM far)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op9_onebit_ann(spark, sf_dir):
    index, parameters = onebit_ann.build_index(table(spark, sf_dir, "embeddings"))
    queries = index.where(F.col("vec_id") % 100 == 0)
    return onebit_ann.search(index, parameters, queries, k=10)


@query("op10_quality_rules", f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
worded AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM docs),
texts AS (SELECT DISTINCT t, ws, ls FROM worded),
windows AS (
  SELECT t, i, list_slice(ws, i, i + 7) AS g FROM (SELECT t, ws, unnest(range(1, len(ws) - 6)) AS i FROM texts)),
repeats AS (
  SELECT t, i FROM (SELECT t, i, count(*) OVER (PARTITION BY t, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT t, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat
  FROM (SELECT t, i, lead(i) OVER (PARTITION BY t ORDER BY i) AS nxt FROM repeats) GROUP BY t),
lines AS (
  SELECT source, t, line, count(*) AS times, max(words) AS words FROM (
    SELECT DISTINCT ON (source, t, k) source, t, k,
           trim(regexp_replace(regexp_replace(lower(ls[k]), '[0-9]', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line,
           len(regexp_extract_all(ls[k], '[^\\x20\\x09-\\x0D]+')) AS words
    FROM (SELECT DISTINCT source, t, ls, unnest(range(1, len(ls) + 1)) AS k FROM worded))
  GROUP BY source, t, line),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM docs GROUP BY source),
frequent AS (
  SELECT l.source, l.line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.n
  HAVING count(*) > {quality_rules.MIN_LINE_DOCS}
     AND count(*) > least({quality_rules.MAX_LINE_SHARE}::DOUBLE * h.n, {quality_rules.MAX_LINE_DOCS}::DOUBLE)),
lost AS (
  SELECT l.source, l.t, sum(l.times * l.words) AS removed FROM lines l
  JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY l.source, l.t),
measured AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(w.t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n_repeat, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(x.removed, 0) AS BIGINT) AS n_removed_words
  FROM worded w LEFT JOIN covered c ON w.t = c.t
  LEFT JOIN lost x ON w.source IS NOT DISTINCT FROM x.source AND w.t = x.t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND n_words - n_removed_words >= 20 AND n_words - n_removed_words >= {quality_rules.MIN_LEFT_SHARE} * n_words AS kept,
       n_removed_words
FROM measured
""")
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")) \
        .select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "kept", "n_removed_words")


#: where the public tokenizer's model lies; a parameter of the operators
PIECE_MODEL = os.environ.get("TABLELOAD_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@query("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir):
    model = pieces.read_model(PIECE_MODEL)
    coded = lattice.encode(table(spark, sf_dir, "documents"), model, decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.col("ids").alias("token_ids"), F.md5("decoded").alias("decoded_md5"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces.read_model(PIECE_MODEL))


#: stands in for the secret that a user of the operator keeps
PSEUDONYM_KEY = "key of the registered query"


@query("op7_pseudonyms")
def op7_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY) \
        .select("_row.doc_id", "text", "n_replaced")


@query("op5_html_main")
def op5_html_main(spark, sf_dir):
    return html_main.main_text(table(spark, sf_dir, "pages"))


@query("op8_quality_model")
def op8_quality_model(spark, sf_dir):
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_hard_negatives", """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
""")
def op11_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=moved)


@query("op12_winnowing", """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
items AS (
  SELECT item_id, ws, least(10, len(ws)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0),
spans AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS span
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
texts AS (SELECT DISTINCT ws FROM worded WHERE len(ws) > 0),
found AS (
  SELECT ws, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS span
  FROM (SELECT ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM texts JOIN (SELECT DISTINCT n FROM spans) ON len(ws) >= n)),
hits AS (SELECT * FROM found WHERE EXISTS (SELECT 1 FROM spans s WHERE s.span = found.span AND s.n = found.n)),
words_hit AS (
  SELECT ws, count(DISTINCT p) AS n_hit FROM (SELECT ws, unnest(range(i, i + n)) AS p FROM hits) GROUP BY ws),
items_hit AS (
  SELECT ws, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT h.ws, CAST(s.item_id AS VARCHAR) AS item FROM hits h JOIN spans s ON h.span = s.span AND h.n = s.n
        WHERE s.item_id IS NOT NULL)
  GROUP BY ws)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN words_hit h ON w.ws = h.ws LEFT JOIN items_hit i ON w.ws = i.ws
""")
def op12_winnowing(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "_row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op13_filter_audit", """
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic, [
           len(ws) < 200,
           100 * len(list_distinct(ws)) < 50 * len(ws),
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
           regexp_matches(t, '[#$%&*|]'),
           coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM worded w LEFT JOIN marks m ON w.doc_id = m.doc_id),
masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
first_fail AS (
  SELECT part, o, step, fails[o[step]] AS hit,
         len(list_filter(list_slice(o, 1, step - 1), lambda x: fails[x])) = 0 AS reached,
         len(list_filter(fails, lambda x: x)) AS all_fails, n, good, toxic
  FROM masks CROSS JOIN steps),
counted AS (
  SELECT part, o, step,
         sum(CASE WHEN reached AND NOT hit THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN reached AND hit THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN NOT reached AND hit THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN hit AND all_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN reached AND hit THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN reached AND hit THEN toxic ELSE 0 END) AS toxic_lost
  FROM first_fail GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM counted
""")
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
