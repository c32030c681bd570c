"""Registered queries of the numbered operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import functions as F

from lumitrace.llm import decontamination, exact_duplicates, frames, hard_negatives, language, lattice, licenses, line_templates, near_duplicates, neighbours, packing, secrets, toxicity, word_runs

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_license_scans(spark, sf_dir):
    """Licences named in every document."""
    found = licenses.licences(frames.table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentences", "licences", "unmatched")])


def op2_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    return toxicity.toxic_scores(frames.table(spark, sf_dir, "documents"), frames.table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark, sf_dir):
    """Benchmark passages in every document."""
    found = decontamination.contamination(frames.table(spark, sf_dir, "documents"), frames.table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated")


def op4_approximate_neighbours(spark, sf_dir):
    """Ten nearest vectors of every hundredth one."""
    return neighbours.nearest(frames.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op5_minhash_near_dedup(spark, sf_dir):
    """Class of near copies of every document."""
    return near_duplicates.components(frames.table(spark, sf_dir, "documents")).drop("text_key")


def op6_language_id(spark, sf_dir):
    """Language of every document."""
    return language.identify(frames.table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 4096 ids."""
    return packing.pack(frames.table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op8_secret_scans(spark, sf_dir):
    """Secrets in every document."""
    found = secrets.scan(frames.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda b: b["k"] == k)).cast("long").alias(f"n_{secrets.KINDS[k]}")
    number = [count(k) for k in range(3)]
    joined = lambda spans: F.array_join(F.transform(spans, lambda b: b["text"]), ",")
    return found.select("doc_id", *number, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op9_line_dedup(spark, sf_dir):
    """Documents without lines of recurring templates."""
    return line_templates.dedupe_lines(frames.table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark, sf_dir):
    """Log probability of every document."""
    return lattice.score(frames.table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_exact_dedup(spark, sf_dir):
    """Copies of equal text of every document."""
    return exact_duplicates.copies(frames.table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector."""
    rows = frames.table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


def planted_repeats(docs):
    """`docs` with the text of every tenth one, by crc32 of its id, repeated with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    found = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    n = F.size(found).cast("long")
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(found, (a + 1).cast("int"), p.cast("int")), times)), F.lit(1), (n - a).cast("int"))
    text = F.array_join(F.concat(F.slice(found, F.lit(1), a.cast("int")), tail), " ")
    return docs.withColumn("text", F.when(F.col("text").isNotNull() & (h % 10 == 0) & (n > 0), text).otherwise(F.col("text")))


def op13_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document."""
    found = word_runs.periodic_runs(planted_repeats(frames.table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    found = found.withColumn("best", longest)
    length = -F.col("best.less")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_FOLDED = f"translate(coalesce(text, ''), '{frames.UPPER}', '{frames.LOWER}')"

_SHINGLES = rf"""
words AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS s FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id)
"""

_OP3 = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{decontamination.WORD}') AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 13) AS k FROM (SELECT item_id, regexp_extract_all({_FOLDED}, '{decontamination.WORD}') AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[s + 1 : s + k], ' ') AS g FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS s FROM items)),
places AS (SELECT doc_id, k, s, array_to_string(w[s + 1 : s + k], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM docs, (SELECT DISTINCT k FROM items))),
hits AS (SELECT doc_id, item_id, s, p.k FROM places p JOIN windows USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS i FROM (SELECT DISTINCT doc_id, s, k FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP5 = f"""
WITH RECURSIVE {_SHINGLES.strip()},
pairs AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * inter >= 75 * (p.n + q.n - inter)
),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN edges ON other = a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, d.doc_id = m AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""

QUERIES: dict[str, Callable] = {
    f.__name__: f
    for f in (op1_license_scans, op2_toxicity, op3_benchmark_decontamination, op4_approximate_neighbours, op5_minhash_near_dedup, op6_language_id, op7_best_fit_packing, op8_secret_scans, op9_line_dedup, op10_lm_scoring, op11_exact_dedup, op12_hard_negatives, op13_periodic_runs)
}
_OP11 = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_FOLDED} AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

_OP12 = """
WITH used AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
    coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1), lambda k: a.v[k] * c.v[k])), 0)::BIGINT AS score
  FROM used a JOIN used c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS positive_rank
  FROM scores WHERE same QUALIFY positive_rank <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score, positive_rank::INT AS positive_rank FROM (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY s.score DESC, s.other) AS rank
  FROM positives p JOIN scores s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op1_license_scans": licenses.sql(), "op3_benchmark_decontamination": _OP3, "op5_minhash_near_dedup": _OP5, "op11_exact_dedup": _OP11, "op12_hard_negatives": _OP12}
