"""Ranked lexical search: item vocabulary tiles times document impact tiles, in whole numbers held in float64.

* Items are taken in blocks whose vocabulary is bounded; each block is broadcast and meets all documents.  Documents are
  cut into terms once for each block, of which those of its vocabulary are kept with their occurrences.
* The numbers of documents and terms are summed over all documents, document frequencies over the kept terms.
* A task turns its documents into tiles of impacts (terms x documents) and multiplies them with tiles of term weights
  (items x terms).  A tile holds as many terms as keep every partial sum under 2**53, so that products and sums are exact
  in float64; tiles are added as 64-bit integers.  Only terms that occur in the document tile take part.
* Each task keeps the best documents of every item, ties in order of ``doc_id``; the tasks' best are reduced once for
  parts of an item's and once more for each item.

Terms: maximal runs of ASCII letters and digits and of code points beyond ASCII, A-Z lower-cased.  A null text has no
terms.  Every row is a document of its own, so a repeated row may stand twice; a null ``doc_id`` comes after all others of
its score.  Rows of one item are one item.  An item without terms, or none of whose terms any document has, has no rows,
and so has an empty table.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.session import written

TOP = 50
#: Items times distinct terms of a block of items, whose weights a task holds; an item with more terms is a block of its own.
BLOCK_CELLS = 1 << 23
#: Documents and terms of a tile; documents of a tile and items of a block are as many that their scores fit ``TILE_SCORES``.
TILE_DOCS, TILE_TERMS, TILE_SCORES = 512, 2048, 1 << 20
#: No impact is as large, and no partial sum.
IMPACT, EXACT = 1_000_000, 1 << 53
#: Bytes of a text that are cut into terms at a time.
SLICE = 1 << 20
#: Parts of an item in which the tasks' best are reduced first.
PARTS = 64

_SPACE = 32
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else _SPACE for b in range(256))

ROW = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, of about ``SLICE`` bytes at a time."""
    text = text.translate(_TERM)
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            end = (cut if cut >= 0 else text.find(b" ", end)) + 1 or len(text)
        yield text[at:end].split()
        at = end


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in pc.fill_null(column, "").cast(pa.large_binary()):
        yield text.as_py()


def item_terms(items: DataFrame) -> DataFrame:
    """Written distinct (item_id, term) of ``items`` (item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                for some in terms(text):
                    found = list(set(some))
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item_id", "term"])

    return written(items.select("item_id", "text").mapInArrow(run, "item_id bigint, term binary").distinct(), "item-terms")


def blocks(found: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their terms, as many at a time as have a bounded vocabulary; one block is on the driver at a time."""
    held, vocabulary = [], set()
    rows = found.orderBy("item_id", "term").toLocalIterator()
    item, own = None, None

    def full() -> bool:
        return bool(held) and (len(held) + 1) * (len(vocabulary) + sum(t not in vocabulary for t in own)) > BLOCK_CELLS

    for row in rows:
        if own is None or row["item_id"] != item:
            if own is not None:
                if full():
                    yield held
                    held, vocabulary = [], set()
                held.append((item, own))
                vocabulary.update(own)
            item, own = row["item_id"], []
        own.append(bytes(row["term"]))
    if own is not None:
        if full():
            yield held
            held = []
        held.append((item, own))
        yield held


def known_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Written (doc_id, n, terms, tf) of the documents with terms: their number, and those of the vocabulary with occurrences."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value
        for batch in batches:
            ids, ns, ends, at, tf = [], [], [0], [], []
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                n, counts = 0, Counter()
                for some in terms(text):
                    n += len(some)
                    counts.update(filter(place.__contains__, some))
                if n:
                    ids.append(doc)
                    ns.append(n)
                    at += map(place.__getitem__, counts)
                    tf += counts.values()
                    ends.append(len(at))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tf, pa.int64()))], names=["doc_id", "n", "terms", "tf"])

    return written(docs.select("doc_id", "text").mapInArrow(run, ROW), "known-terms")


def frequencies(known: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    rows = known.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # a row for each term
    found = np.zeros(size, np.int64)
    found[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return found


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def tile_terms(weights: np.ndarray) -> int:
    """Terms of a tile, so few that their partial sums stay below 2**53."""
    return max(1, min(TILE_TERMS, (EXACT - 1) // (int(weights.max(initial=1)) * IMPACT or 1)))


def tile_scores(items: np.ndarray, terms: np.ndarray, rows: np.ndarray, impacts: np.ndarray, n_rows: int, step: int) -> np.ndarray:
    """64-bit scores (items x documents) of one tile of documents from its sparse impacts (term, row)."""
    total = np.zeros((len(items), n_rows), np.int64)
    present, place = np.unique(terms, return_inverse=True)
    for a in range(0, len(present), step):
        inside = (place >= a) & (place < a + step)
        part = present[a:a + step]
        tile = np.zeros((len(part), n_rows))
        tile[place[inside] - a, rows[inside]] = impacts[inside]
        total += (items[:, part] @ tile).astype(np.int64)
    return total


class Best:
    """The best documents of each item so far: highest score, then smallest id, nulls last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)
        self.least = np.ones(n_items, np.int64)  # only scores above 0 count; ties with the last one are looked at

    def add(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, at]])
        doc, none = np.concatenate([self.doc, docs[at]]), np.concatenate([self.null, null[at]])
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.top]
        last = order[rank == self.top - 1]
        self.item, self.score, self.doc, self.null = item[rank < self.top], score[kept], doc[kept], none[kept]
        self.least[item[rank == self.top - 1]] = score[last]


def best_of_tasks(known: DataFrame, held: list[tuple[int | None, list[bytes]]], vocabulary: dict[bytes, int], weights: np.ndarray,
                  n: int, total: int, top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of every item of the block, by its place."""
    # Sparse on the way, dense in the worker.
    i = np.repeat(np.arange(len(held)), [len(own) for _, own in held])
    j = np.array([vocabulary[t] for _, own in held for t in own], np.int64)
    sent = known.sparkSession.sparkContext.broadcast((i.astype(np.int32), j.astype(np.int32), weights))
    n_items, step = len(held), tile_terms(weights)
    docs_at_once = max(1, min(TILE_DOCS, TILE_SCORES // n_items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j, weights = sent.value
        used = np.flatnonzero(weights)  # terms without weight score nothing
        column = np.full(len(weights), -1, np.int64)
        column[used] = np.arange(len(used))
        items = np.zeros((n_items, len(used)))
        weighs = column[j] >= 0
        items[i[weighs], column[j[weighs]]] = weights[j[weighs]]
        best = Best(n_items, top)
        for batch in batches:
            for a in range(0, batch.num_rows, docs_at_once):
                some = batch.slice(a, docs_at_once)
                null = some.column(0).is_null().to_numpy(zero_copy_only=False)
                docs = some.column(0).fill_null(0).to_numpy()
                m = np.array([100 - 50 + (50 * k * n) // total for k in some.column(1).to_pylist()], np.int64)
                lists = some.column(2)
                rows = np.repeat(np.arange(some.num_rows), lists.value_lengths().to_numpy())
                terms, tf = column[lists.flatten().to_numpy()], some.column(3).flatten().to_numpy()
                weighs = terms >= 0
                terms, rows, tf = terms[weighs], rows[weighs], tf[weighs]
                impacts = (1_000_000_000 * tf) // (1000 * tf + 20 * m[rows])
                best.add(tile_scores(items, terms, rows, impacts, some.num_rows, step), docs, null)
        yield pa.RecordBatch.from_arrays([pa.array(best.item.astype(np.int32)), pa.array(best.doc, mask=best.null), pa.array(best.score)],
                                         names=["item", "doc_id", "score"])

    return known.mapInArrow(run, "item int, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents (doc_id, text) of every item (item_id, text)."""
    spark = docs.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = None
    for held in blocks(item_terms(items)):
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*(own for _, own in held))))}
        known = known_terms(docs, vocabulary)
        sums = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        n, total = sums["n"], int(sums["total"])
        weights = np.array([weight(d, n) for d in frequencies(known, len(vocabulary)).tolist()], np.int64)
        best = best_of_tasks(known, held, vocabulary, weights, n, total, top).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        for keys in (["item", "part"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
        names = F.broadcast(spark.createDataFrame([(k, item) for k, (item, _) in enumerate(held)], "item int, item_id bigint"))
        best = written(best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
        found = best if found is None else found.union(best)
    return found if found is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
