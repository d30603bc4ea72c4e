"""The corpus pipeline: languages, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.

Every stage works on whatever its predecessor kept: rows with null ids or texts, empty and repeated rows and
further columns included.  Rows of one id are judged one by one by their own text, except in ``near_duplicates``,
where they are one document and all but one row of it go.
"""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import jaccard_join, lang_id, packing, toxicity
from ledgerlift.llm.common import among, ship, without
from ledgerlift.session import written

#: A document's languages must give it so much of its text in one of them.
LEAST_SHARE = 0.5
CAPACITY = 2048
WORDS, PERCENT = 5, 80


def _row(docs: DataFrame) -> Column:
    """The whole row in one column; names may hold dots."""
    return F.struct(*("`" + c.replace("`", "``") + "`" for c in docs.columns))


def _rows(docs: DataFrame) -> DataFrame:
    """The whole row beside id and text, so that no added column can clash with its own."""
    return docs.select("doc_id", "text", _row(docs).alias("row"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those in which no language has half of the text.

    Learned from the documents' own ``lang``; a null or empty text is rejected.
    """
    ship(spark)
    judged = lang_id.predict(_rows(docs), lang_id.train(lang_id.training_rows(docs)), keep=("row",))
    return judged.filter((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def toxicity_grades(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are more likely toxic, of any grade, than not; learned from ``labels``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = toxicity.labelled_sample(docs.select("doc_id", "text"), labels, "toxic", toxicity.SAMPLE)
    return toxicity.grade(_rows(docs), toxicity.fit(sample), keep=("row",)).filter("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id.

    Near duplicates: Jaccard similarity of five-word shingles of 0.8 or more, directly or by a chain.  Documents without
    words are no one's duplicates; rows without an id are kept.  Of repeated rows of a kept id the first by text stays.
    """
    ship(spark)
    found = jaccard_join.join_classes(docs.filter("doc_id IS NOT NULL"), WORDS, PERCENT)
    gone = written(found.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    kept = without(docs, gone, "doc_id")
    many = written(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "many")
    first = among(kept, many, "doc_id").groupBy("doc_id").agg(F.min_by(
        _row(docs), F.struct("text", F.to_json(_row(docs)))).alias("row")).select("row.*")
    return without(kept, many, "doc_id").unionByName(first)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents with their sequence and offset; a null text is an empty one."""
    ship(spark)
    pieces = packing.token_pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    return packing.pack(written(pieces, "pieces"), CAPACITY)


STAGES = [("languages", languages), ("toxicity", toxicity_grades), ("near_duplicates", near_duplicates), ("packing", pack)]

#: SQL cannot express the stages; they are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; what the others return is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
