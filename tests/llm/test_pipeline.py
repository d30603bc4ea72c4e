"""The pipeline's stages on given and hand-made documents, and what is registered."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as cp
from ledgerlift.session import written
from tests.llm.test_similarity import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_and_registration():
    assert [n for n, _ in cp.STAGES] == ["languages", "toxicity", "near_duplicates", "packing"] and cp.ORACLE_SQL is None
    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


def test_languages_keeps_documents_with_letters(spark, docs, folder):
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "12 34", "en", "s", 5), (9004, "Re.", "en", "s", 3),
                                 (None, "the and", "en", None, None)], docs.select(COLUMNS).schema)
    found = cp.languages(spark, docs.select(COLUMNS).unionByName(odd), folder)
    assert found.columns == COLUMNS
    kept = {r.doc_id for r in found.select("doc_id").collect()}
    assert {r.doc_id for r in docs.filter("length(text) > 40").collect()} <= kept
    assert {9004, None} <= kept and not {9001, 9002, 9003} & kept


def test_toxicity_rejects_toxic_documents_only(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("row", F.lit(1)).withColumn("score", F.lit(2.0))
    kept = written(cp.toxicity_grades(spark, docs, folder), "kept")
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    gone = labels.join(kept, "doc_id", "left_anti").groupBy("toxic").count().collect()
    total = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    gone = {r.toxic: r["count"] for r in gone}
    assert gone[1] >= 0.9 * total[1] and gone.get(0, 0) <= 0.01 * total[0]


def test_near_duplicates_keeps_the_smallest_id_of_each_group(spark, docs, folder):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, expected = brute_components(rows, 5, 80)
    extra = spark.createDataFrame([(5000, None, "en", "s", 0), (5001, None, "en", "s", 0), (5002, "", "en", "s", 0), (5003, "b", "en", "s", 0),
                                   (5003, "a", "en", "s", 0), (None, "a b", "en", "s", 0)], docs.select(COLUMNS).schema)
    found = cp.near_duplicates(spark, docs.select(COLUMNS).unionByName(extra).withColumn("component_id", F.lit("x")), folder)
    assert found.columns == [*COLUMNS, "component_id"]
    kept = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in found.collect())
    first = [(d, t) for d, t in rows if expected[d] == d]
    assert kept == sorted([*first, (5000, ""), (5001, ""), (5002, ""), (5003, "a"), (-1, "a b")])


def test_packing_keeps_every_id(spark, docs, folder):
    some = docs.limit(30).select(COLUMNS).unionByName(spark.createDataFrame([(7000, None, None, None, None)], docs.select(COLUMNS).schema))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for r in sorted(cp.pack(spark, some, folder).collect(), key=lambda r: (r.doc_id, r.piece)):
        assert r.offset + r.length <= cp.CAPACITY
        found[r.doc_id] = found.get(r.doc_id, []) + np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert found == {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in some.collect()}


def test_run_equals_the_stages(spark, folder, docs):
    made = docs
    for _, stage in cp.STAGES:
        made = written(stage(spark, made, folder), "stage")
    found = cp.run(spark, folder)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert found.columns == made.columns and found.select(key).exceptAll(made.select(key)).isEmpty() and found.count() == made.count()


def test_stages_on_nothing(spark, folder, docs):
    made = docs.filter("false")
    for _, stage in cp.STAGES:
        made = written(stage(spark, made, folder), "none")
        assert made.count() == 0
