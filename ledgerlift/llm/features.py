"""Hashed words and structure statistics of texts, and bounded samples of labelled rows."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import fold
from ledgerlift.llm.words import NOT_ALNUM, WHITE, batch_shingles, mix, slices, text_bytes, words
from ledgerlift.session import written

#: Names of the statistics, in order.
STATISTICS = ("log_bytes", "log_words", "word_length", "long_words", "upper", "digits", "symbols", "pipes", "lines",
              "distinct_words", "repeated_words", "non_ascii")

_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90), "digits": (_BYTES >= 48) & (_BYTES <= 57),
    "symbols": NOT_ALNUM & ~WHITE, "pipes": _BYTES == 124, "lines": _BYTES == 10, "non_ascii": _BYTES >= 128,
}


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows' values; 0 for an empty row."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def hashed_words(texts: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of a batch: bucket and count of each row's distinct buckets, their bounds by row, and the row's words."""
    shift = np.uint64(64 - (buckets - 1).bit_length())
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        h, _, rows = words(data, offsets[a:b + 1], NOT_ALNUM)
        key, counts = np.unique(rows * buckets + (h >> shift).astype(np.int64), return_counts=True)
        row, bucket = np.divmod(key, buckets)
        yield a, bucket, counts, np.searchsorted(row, np.arange(b - a + 1)), np.bincount(rows, minlength=b - a)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; a null text is an empty one."""
    data, offsets = text_bytes(texts)
    out = []
    for a, b in slices(offsets):
        ends = offsets[a:b + 1] - offsets[a]
        part = data[offsets[a]:offsets[b]]
        h, lengths, rows = words(data, offsets[a:b + 1], WHITE)
        counts = np.bincount(rows, minlength=b - a)
        heads = np.concatenate([[0], np.cumsum(counts)])
        size, count = np.maximum(np.diff(ends), 1), np.maximum(counts, 1)
        share = {name: _sums(held[part], ends) / size for name, held in _CLASSES.items()}
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        distinct = np.bincount(_distinct_rows(rows, h), minlength=b - a)
        table = {
            "log_bytes": np.log1p(np.diff(ends)), "log_words": np.log1p(counts), "word_length": _sums(lengths, heads) / count,
            "long_words": _sums(lengths > 16, heads) / count, "distinct_words": distinct / count,
            "repeated_words": _sums(again, heads) / count, **share,
        }
        out.append(np.column_stack([table[name] for name in STATISTICS]))
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def _distinct_rows(rows: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The row of every distinct word of each row."""
    order = np.lexsort((h, rows))
    first = np.ones(len(order), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    return rows[order][first]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: tuple[int, int]) -> DataFrame:
    """Rows (text, label): at most ``most`` documents of the labels 0 and 1, outside the held-out third.

    The lowest hashes of the id are taken, so the sample is fixed and spread over the table; the ids are
    bounded and broadcast, so no text is shuffled.  A document labelled twice has its smaller label, and of
    copies and near copies (equal least hash of their five-word shingles) one is kept.  The sample is written.
    """
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 3) != 1))
             .groupBy("doc_id").agg(F.min(label).alias("label")))
    chosen = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[value])
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id").alias("at"), F.col("label").cast("int").alias("label"))
    marked = rows.mapInArrow(_marks, "text string, at bigint, label int, mark bigint, other bigint")
    for column in ("mark", "other"):
        marked = marked.groupBy(column).agg(F.min(F.struct("at", "label", "text", *({"mark", "other"} - {column}))).alias("row")).select(
            column, "row.*")
    return written(marked.select("text", "label"), "sample")


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two least hashes of the shingles; a text without words has its place in the sample instead."""
    for batch in batches:
        found = []
        for a, hashes, bounds in batch_shingles(batch.column(0), 5):
            n = len(bounds) - 1
            own = batch.column(1).slice(a, n).to_numpy().astype(np.int64)
            full = np.diff(bounds) > 0
            pair = np.column_stack([own, own])
            for k in (0, 1):
                if full.any():
                    pair[full, k] = np.minimum.reduceat(mix(hashes + np.uint64(k)), bounds[:-1][full]).view(np.int64)
            found.append(pair)
        pair = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["text", "at", "label", "mark", "other"])


def collected(sample: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bounded sample's features on the driver: buckets, counts, bounds, statistics, labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column(0))
            for a, bucket, counts, bounds, total in hashed_words(batch.column(0), buckets):
                n = len(total)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(bucket, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(counts, pa.int32())),
                    pa.array(list(stats[a:a + n]), pa.list_(pa.float64())),
                    batch.column(1).slice(a, n),
                ], names=["buckets", "counts", "stats", "label"])

    rows = sample.mapInArrow(run, "buckets array<int>, counts array<int>, stats array<double>, label int").toArrow()
    n = rows.num_rows
    lists, counts = rows.column("buckets").combine_chunks(), rows.column("counts").combine_chunks()
    sizes = lists.value_lengths().to_numpy() if n else np.zeros(0, int)
    return (lists.flatten().to_numpy(), counts.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]).astype(int),
            np.array(rows.column("stats").to_pylist(), float).reshape(n, len(STATISTICS)), rows.column("label").to_numpy())
