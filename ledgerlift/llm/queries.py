"""Registered queries of the subpackage, with SQL where it can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm.common import documents, ship
from ledgerlift.llm.filter_audit import steps
from ledgerlift.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import fingerprints

    return fingerprints.with_successor(documents(spark, sf_dir))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import byte_bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, digest=True)


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import packing

    pieces = packing.token_pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048, ids=False)
    return packing.pack(written(pieces, "pieces"), 2048)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import token_counts

    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import sharding

    return sharding.shard(documents(spark, sf_dir))


@query
def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import lang_id

    ship(spark)
    return lang_id.identify(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import quality

    return quality.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import toxicity

    return toxicity.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import jaccard_join

    return jaccard_join.join_classes(documents(spark, sf_dir), words=4, percent=85).select("doc_id", "n_shingles", "component_id", "class_id")


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import neighbours

    ship(spark)
    return neighbours.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import lexical

    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


@query
def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import vector_search

    ship(spark)
    return vector_search.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlift.llm import filter_audit

    ship(spark)
    return filter_audit.audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"), _labels(spark, sf_dir))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL["op1_jaccard_join"] = rf"""WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] FOR i IN range(1, len(ws) - 2)]) END AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b, bool_and(na.n_shingles = nb.n_shingles) AND COUNT(*) = MAX(na.n_shingles) AS equal
    FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY 1, 2 HAVING 100 * COUNT(*) >= 85 * (MAX(na.n_shingles) + MAX(nb.n_shingles) - COUNT(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, n_shingles, LEAST(doc_id, COALESCE((SELECT MIN(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id,
    LEAST(doc_id, COALESCE((SELECT MIN(b) FROM links WHERE a = doc_id AND equal), doc_id)) AS class_id FROM n"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL["op11_lexical_search"] = rf"""WITH
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS ts FROM documents),
a AS (SELECT row, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
z AS (SELECT CAST(COUNT(*) AS BIGINT) AS docs, CAST(SUM(n) AS BIGINT) AS total FROM a),
t AS (SELECT row, term, CAST(COUNT(*) AS BIGINT) AS tf FROM (SELECT row, unnest(ts) AS term FROM d) GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM t JOIN (SELECT DISTINCT term FROM i) USING (term), z GROUP BY term, docs),
s AS (SELECT item_id, doc_id, row, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
    FROM i JOIN w USING (term) JOIN t USING (term) JOIN a USING (row), z GROUP BY 1, 2, 3),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""

_ORDERS = ", ".join(f"('{o}', {k}, {s}, {b}, {n})" for o, k, s, b, n in steps())

SQL["op13_filter_audit"] = rf"""WITH
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws FROM documents),
j AS (SELECT part, CAST(len(ws) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT)
    + 4 * CAST(100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > MIN(doc_id) OVER (PARTITION BY text), false) AS INT) AS fails,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND toxic = 1) AS toxic FROM w),
p AS (SELECT part, fails, COUNT(*) AS n, COUNT(*) FILTER (good) AS good, COUNT(*) FILTER (toxic) AS toxic FROM j GROUP BY 1, 2),
o(filter_order, step, before, bit, orders) AS (VALUES {_ORDERS}),
s AS (SELECT part, filter_order, step, before, bit, SUM(n) FILTER (fails & (before | bit) = 0) AS kept,
    SUM(n) FILTER (fails & before = 0 AND fails & bit <> 0) AS removed, SUM(n) FILTER (fails & before <> 0 AND fails & bit <> 0) AS redundant,
    SUM(n) FILTER (fails = bit) AS unique_fails, SUM(good) FILTER (fails & before = 0 AND fails & bit <> 0) AS good_lost,
    SUM(toxic) FILTER (fails & before = 0 AND fails & bit <> 0) AS toxic_lost FROM p, o GROUP BY 1, 2, 3, 4, 5),
v AS (SELECT part, bit, SUM(removed) AS shapley FROM s GROUP BY 1, 2)
SELECT part, filter_order, CAST(step AS INT) AS step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))} FROM s JOIN v USING (part, bit)"""

SQL["op9_embedding_near_dedup"] = """WITH RECURSIVE
v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) >= 0.9 * a.norm * b.norm),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
found AS (SELECT vec_id, (SELECT COUNT(*) FROM links WHERE a = vec_id) AS n_links,
    LEAST(vec_id, COALESCE((SELECT MIN(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found"""
