"""Queries over the given tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm import cotrain, ctw, decontam, jaccard, lengths, mixing, negatives, planes, quality, runs, secret_scan, sharding, templates
from slotcast.llm.store import written
from slotcast.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file on this machine; every machine has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE), vocabulary(WORD_BPE)).drop("lang")


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_site_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op6_jaccard_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op8_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_bit_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = planes.encode_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "ids"), vocabulary(WORD_BPE))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lengths.encoded_lengths(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))
    out = lengths.suffix_table(written(lengths.histogram(made), "length_histogram"))  # read twice, encoded once
    return out.select(F.col("grp").alias("lang"), *out.columns[1:], lengths.is_quantile(0.5).alias("is_median"), lengths.is_quantile(0.99).alias("is_p99"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth text by crc32 of its key repeats from some word on, as op11's contract says."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    source = lambda i: F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")
    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", source(i))), " ")
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


def op11_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    columns = ["doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli]
    return best.select(*columns, runs.digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_combined_automaton_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [secret_scan.of_kind(F.col("spans"), k).alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op13_anchor_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.when(finite, whole).alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_spaced_seed_decontamination, op2_rendezvous_sharding, op3_tokeniser_fertility, op4_cotraining, op5_site_template_removal, op6_jaccard_metric_join, op7_context_tree_weighting, op8_hash_threshold_mix, op9_bit_plane_files, op10_length_histogram, op11_maximal_pair_runs, op12_combined_automaton_secrets, op13_anchor_tree_negatives)}

ORACLE: dict[str, str] = {
    "op8_hash_threshold_mix": """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, r % 3 + 1 AS weight FROM s),
c AS (
  SELECT source, source_size, weight, row_number() OVER (ORDER BY source_size::DOUBLE / weight, r) AS seq_no,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size0,
         coalesce(sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight0
  FROM w),
v AS (SELECT source, source_size, weight, seq_no, (total - 3 * size0)::DOUBLE / (weights - weight0)::DOUBLE AS lvl FROM c),
l AS (SELECT arg_min(lvl, seq_no) AS lvl FROM v WHERE lvl * weight <= 3 * source_size),
t AS (
  SELECT v.source, source_size, coalesce(least((3 * source_size)::DOUBLE, l.lvl * weight), 0) AS target FROM v, l),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS whole FROM t),
b AS (SELECT source, whole, source_size, target, target - whole * source_size AS budget FROM f),
k AS (SELECT source, h, sum(size) AS g FROM d WHERE size > 0 GROUP BY source, h),
u AS (SELECT source, h, g, sum(g) OVER (PARTITION BY source ORDER BY h) AS upto FROM k),
x AS (
  SELECT b.source, b.whole, b.source_size, b.target, coalesce(min(CASE WHEN upto > budget THEN h END), 1::BIGINT << 60) AS edge,
         CASE WHEN bool_or(upto > budget) THEN budget - coalesce(max(CASE WHEN upto <= budget THEN upto END), 0) ELSE 0 END AS rest
  FROM b LEFT JOIN u ON b.source IS NOT DISTINCT FROM u.source GROUP BY b.source, b.whole, b.source_size, b.target, budget),
k2 AS (
  SELECT d.source, d.h, sum(d.size) AS g, any_value(x.rest) AS rest FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
  WHERE d.size > 0 AND d.size <= x.rest AND d.h >= x.edge GROUP BY d.source, d.h),
u2 AS (SELECT source, h, g, rest, sum(g) OVER (PARTITION BY source ORDER BY h) AS upto FROM k2),
more AS (SELECT source, h FROM u2 WHERE upto <= rest OR (upto - g <= rest AND g < 2 * (rest - (upto - g))))
SELECT d.doc_id, d.size, x.source_size, x.target,
       (d.size * (x.whole + CASE WHEN d.h < x.edge OR (m.h IS NOT NULL AND d.size <= x.rest) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
       LEFT JOIN more m ON d.source IS NOT DISTINCT FROM m.source AND d.h = m.h
""",
    "op12_combined_automaton_secrets": """
WITH rules(r, kind, pattern, least, own) AS (VALUES
  (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8, 1),
  (1, 'access', 'AKIA[A-Z0-9]+', 16, 0), (2, 'hex', '[0-9a-f]{32,}', 32, 0), (3, 'github', 'gh[pousr]_[A-Za-z0-9]+', 40, 0),
  (4, 'slack', 'xox[abprs]-[A-Za-z0-9-]+', 20, 0), (5, 'google', 'AIza[A-Za-z0-9_-]+', 39, 0), (6, 'private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 1, 0)),
d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
p AS (  -- all matches of a rule, their secrets, and the texts between them
  SELECT n, r, kind, least, regexp_extract_all(t, pattern) AS m, regexp_extract_all(t, pattern, own) AS v, regexp_split_to_array(t, pattern) AS gap FROM d, rules),
e AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM p WHERE len(m) > 0),
s AS (
  SELECT n, kind, r, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a, length(m[i]) AS size
  FROM e WHERE length(v[i]) >= least),
g AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a::BIGINT || ':' || (a + size)::BIGINT, ',' ORDER BY a, r) FILTER (r < 3) AS base,
         string_agg(kind || ':' || a::BIGINT || ':' || (a + size)::BIGINT, ',' ORDER BY a, r) AS spans
  FROM s GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (n)
""",
    "op13_anchor_tree_negatives": """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::INT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
""",
}
