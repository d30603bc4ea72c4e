"""Toxicity grades by ordinal regression with cumulative links.

P(grade >= j) = sigmoid(w.x - threshold_j): one weight for each feature, shared by all grades, and
ordered thresholds.  Features are the presence and the density of words and word beginnings, hashed,
that mark toxic documents in the training sample, and whether any is there that clean ones hardly have.  Labels are 0 and 1; a toxic training document's grade 1 to 3 is
the third that its share of marking words lies in.  The expected grade is the sum of P(grade >= j).
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import claim, fold
from ledgerlift.llm.features import labelled_sample
from ledgerlift.llm.quality import sigmoid
from ledgerlift.llm.words import NOT_ALNUM, prefixes, slices, text_bytes, words

BUCKETS, GRADES = 1 << 18, 3
#: Word beginnings, in bytes, that are features beside whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Sampled rows of the labels 0 and 1 at most.
SAMPLE = (20_000, 5000)
#: A marking feature occurs so many times as often in toxic documents as in others, with so high a likelihood ratio.
LEAST_RATIO, LEAST_EVIDENCE = 3.0, 25.0
#: Features so many times as often in toxic documents are strong: one of them, whichever, counts by itself.
STRONG_RATIO = 50.0
STEPS, RATE, RIDGE = 500, 0.1, 1e-5


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of a batch: distinct bucket and count of each row's features, their bounds by row, and the row's words."""
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        own = offsets[a:b + 1]
        h, _, rows = words(data, own, NOT_ALNUM)
        total = np.bincount(rows, minlength=b - a)
        found = [(h, rows), *(prefixes(data, own, NOT_ALNUM, size) for size in BEGINNINGS)]
        key = np.concatenate([r * BUCKETS + (x >> shift).astype(np.int64) for x, r in found])
        key, counts = np.unique(key, return_counts=True)
        row, bucket = np.divmod(key, BUCKETS)
        yield a, bucket, counts, np.searchsorted(row, np.arange(b - a + 1)), total


def density(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Occurrences in 1,000 words on a logarithmic scale."""
    return np.log1p(1000 * counts / np.maximum(total, 1)) * 0.5


@dataclass
class Ordinal:
    chosen: np.ndarray  # sorted buckets
    present: np.ndarray  # weight of a bucket's presence
    dense: np.ndarray  # weight of its density
    strong: np.ndarray  # whether it is a strong one
    any_strong: float  # weight of the presence of any strong one
    thresholds: np.ndarray  # ascending

    def at_least(self, bucket: np.ndarray, counts: np.ndarray, bounds: np.ndarray, total: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), … of every row."""
        margin = np.zeros(len(total))
        if len(self.chosen):
            at = np.searchsorted(self.chosen, bucket).clip(max=len(self.chosen) - 1)
            hit = np.flatnonzero(self.chosen[at] == bucket)
            row = np.searchsorted(bounds, hit, side="right") - 1
            part = self.present[at[hit]] + self.dense[at[hit]] * density(counts[hit], total[row])
            margin = np.bincount(row, part, minlength=len(total)).astype(float)  # whole numbers if no row has a hit
            margin += self.any_strong * (np.bincount(row, self.strong[at[hit]], minlength=len(total)) > 0)
        return sigmoid(margin[:, None] - self.thresholds)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have a feature; at most ``BUCKETS`` rows a label and task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy()
        for a, bucket, _, bounds, total in features(batch.column(0)):
            owner = label[a:a + len(total)][np.repeat(np.arange(len(total)), np.diff(bounds))]
            for value in (0, 1):
                counts[value] += np.bincount(bucket[owner == value], minlength=BUCKETS)
    for value in (0, 1):
        some = np.flatnonzero(counts[value])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), value, np.int32)), pa.array(some, pa.int32()),
                                          pa.array(counts[value][some])], names=["label", "bucket", "n"])


def marking(sample: DataFrame, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that mark toxic documents, sorted, and which of them are strong."""
    found = sample.mapInArrow(_frequencies, "label int, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, BUCKETS))
    counts[found["label"].to_numpy(int), found["bucket"].to_numpy(int)] = found["n"]
    clean, toxic = counts
    share = sizes[1] / sum(sizes)
    both = clean + toxic

    def part(n, expected):
        return n * np.log(np.maximum(n, 1) / np.maximum(expected, 1e-9))

    evidence = 2 * (part(toxic, both * share) + part(clean, both * (1 - share)))
    ratio = ((toxic + 0.01) / sizes[1]) / ((clean + 0.5) / sizes[0])
    good = np.flatnonzero((evidence >= LEAST_EVIDENCE) & (ratio >= LEAST_RATIO))
    return good, ratio[good] >= STRONG_RATIO


@dataclass
class Sparse:
    """The entries of a matrix with few of them, for products with a vector."""
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    @property
    def T(self) -> "Sparse":
        return Sparse(self.column, self.row, self.value, self.shape[::-1])

    def __matmul__(self, vector: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * vector[self.column], minlength=self.shape[0]).astype(float)


def fit(sample: DataFrame) -> Ordinal:
    """Fit on a bounded, written sample.  Without toxic or clean rows, or without marking features, nothing is toxic."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    never = Ordinal(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, bool), 0.0, np.array([30.0] * GRADES))
    if len(sizes) < 2:
        return never
    chosen, strong = marking(sample, (sizes[0], sizes[1]))
    if not len(chosen):
        return never

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, bucket, counts, bounds, total in features(batch.column(0)):
                at = np.searchsorted(chosen, bucket).clip(max=len(chosen) - 1)
                held = chosen[at] == bucket
                ends = np.concatenate([[0], np.cumsum(held)])[bounds]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(a, len(total)), pa.array(total, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[held], pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts[held], pa.int32())),
                ], names=["label", "words", "at", "n"])

    rows = sample.mapInArrow(run, "label int, words bigint, at array<int>, n array<int>").toArrow()
    toxic = rows.column("label").to_numpy() == 1
    at, n = rows.column("at").combine_chunks(), rows.column("n").combine_chunks()
    row, n = np.repeat(np.arange(len(toxic)), at.value_lengths().to_numpy()), n.flatten().to_numpy()
    at, total = at.flatten().to_numpy(), rows.column("words").to_numpy()
    share = np.bincount(row, n, minlength=len(toxic)) / np.maximum(total, 1)
    grade = np.where(toxic, 1 + (share[:, None] > np.quantile(share[toxic], [1 / 3, 2 / 3])).sum(1), 0)
    marked = np.unique(row[strong[at]])
    x = Sparse(np.concatenate([row, row, marked]), np.concatenate([at, len(chosen) + at, np.full(len(marked), 2 * len(chosen))]),
               np.concatenate([np.ones(len(row)), density(n, total[row]), np.ones(len(marked))]), (len(toxic), 2 * len(chosen) + 1))
    weights, thresholds = descend(x, grade)
    return Ordinal(chosen, weights[:len(chosen)], weights[len(chosen):-1], strong, float(weights[-1]), thresholds)


def descend(x: np.ndarray | Sparse, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the likelihood; the gaps between thresholds are exponentials, so their order holds."""
    n, width = x.shape
    rows = np.arange(n)
    parameters = np.zeros(width + GRADES)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, thresholds = parameters[:width], _ordered(parameters[width:])
        above = sigmoid((x @ weights.astype(np.float32)).astype(float)[:, None] - thresholds)
        # P(grade = g) = full[g] - full[g + 1]
        full = np.column_stack([np.ones(n), above, np.zeros(n)])
        spread = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        chance = np.maximum(full[rows, grade] - full[rows, grade + 1], 1e-9)
        left, right = spread[rows, grade] / chance, spread[rows, grade + 1] / chance
        slope = np.zeros((n, GRADES + 2))
        slope[rows, grade] += left
        slope[rows, grade + 1] -= right
        by_threshold = slope[:, 1:GRADES + 1].sum(0)
        gaps = np.exp(parameters[width + 1:])
        gradient = np.concatenate([
            (x.T @ (right - left).astype(np.float32)) / n + RIDGE * weights,
            [by_threshold.sum() / n], gaps * by_threshold[::-1].cumsum()[::-1][1:] / n])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        parameters = parameters - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return parameters[:width], _ordered(parameters[width:])


def _ordered(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def grade(df: DataFrame, model: Ordinal, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` (P(grade >= 1)), ``severity`` (expected grade), ``grade`` (grades at least as likely as not) and ``predicted`` (grade > 0).

    A null text is an empty one.  No shuffle.
    """
    kept = df.select(*keep, df[text].alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        tool = sent.value
        for batch in batches:
            parts = [tool.at_least(*found) for _, *found in features(batch.column(batch.num_columns - 1))]
            above = np.concatenate(parts) if parts else np.zeros((0, GRADES))
            level = (above >= 0.5).sum(1)
            held = {batch.schema.field(i).name: batch.column(i) for i in range(batch.num_columns - 1)}
            yield pa.RecordBatch.from_pydict(held | {
                "score": pa.array(above[:, 0], pa.float64()), "severity": pa.array(above.sum(1), pa.float64()),
                "grade": pa.array(level.astype(np.int32)), "predicted": pa.array((level > 0).astype(np.int32))})

    return kept.mapInArrow(run, f"{ddl}, score double, severity double, grade int, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, severity, grade, predicted`` of every document."""
    model = fit(labelled_sample(docs.select("doc_id", "text"), labels, "toxic", SAMPLE))
    return grade(docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out")), model, keep=("doc_id", "held_out"))
