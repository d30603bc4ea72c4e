"""Quality scores by a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(bias + w.x + sum over pairs <v_i, v_j> x_i x_j).  The pairs are summed in linear time: half of
(sum v_i x_i)**2 - sum (v_i x_i)**2, by factor.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import fold
from ledgerlift.llm.features import STATISTICS, collected, hashed_words, labelled_sample, statistics

BUCKETS, FACTORS = 1 << 14, 8
#: Labelled rows of each class the machine is fitted on.
SAMPLE_PER_CLASS = 5000
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.05, 1e-5


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.centre) / self.scale, -4, 4) * 0.5

    def margin(self, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sum-of-squares identity over rows of (index, value); every row has at least the statistics."""
        heads = bounds[:-1]
        part = self.factors[index] * value[:, None]
        total = np.add.reduceat(part, heads, axis=0)
        squares = np.add.reduceat(part * part, heads, axis=0)
        return self.bias + np.add.reduceat(self.weights[index] * value, heads) + 0.5 * (total * total - squares).sum(1)


def joined(bucket: np.ndarray, counts: np.ndarray, bounds: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of (index, value): words by the logarithm of their count, scaled to length one, then the statistics."""
    n, width = dense.shape
    sizes = np.diff(bounds)
    value = np.log1p(counts)
    row = np.repeat(np.arange(n), sizes)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    out = np.concatenate([[0], np.cumsum(sizes + width)])
    index, values = np.empty(out[-1], np.int64), np.empty(out[-1])
    at = np.arange(len(bucket)) + width * row
    index[at], values[at] = bucket, value / np.maximum(norm, 1e-9)[row]
    tail = (out[1:] - width)[:, None] + np.arange(width)
    index[tail], values[tail] = BUCKETS + np.arange(width), dense
    return index, values, out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(sample: DataFrame, prior: float) -> Machine:
    """Fit on a bounded sample on the driver; ``prior`` is the share of label 1, to which the classes are weighted.

    Without rows of both labels the score is the prior (1/2 without any).
    """
    bucket, counts, bounds, stats, label = collected(sample, BUCKETS)
    size = BUCKETS + len(STATISTICS)
    centre = stats.mean(0) if len(stats) else np.zeros(len(STATISTICS))
    scale = stats.std(0) + 1e-6 if len(stats) else np.ones(len(STATISTICS))
    rng = np.random.default_rng(5)
    machine = Machine(float(np.log((prior + 1e-6) / (1 - prior + 1e-6))), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), centre, scale)
    if len(np.unique(label)) < 2:
        machine.factors[:] = 0
        return machine
    order = np.lexsort((bucket[bounds[:-1].clip(max=max(len(bucket) - 1, 0))], stats[:, 0], label))  # whatever order the rows came in
    index, value, heads = joined(bucket, counts, bounds, machine.dense(stats))
    ones = label.mean()
    weight = np.where(label == 1, prior / ones, (1 - prior) / (1 - ones))
    past_w, past_v, past_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        for some in np.array_split(rng.permutation(order), max(1, len(order) // BATCH)):
            sizes = heads[some + 1] - heads[some]
            own = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(heads[some] - own[:-1], sizes) + np.arange(own[-1])
            i, x = index[at], value[at]
            row = np.repeat(np.arange(len(some)), sizes)
            slope = (sigmoid(machine.margin(i, x, own)) - label[some]) * weight[some] / len(some)
            part = machine.factors[i] * x[:, None]
            total = np.add.reduceat(part, own[:-1], axis=0)
            used, number = np.unique(i, return_inverse=True)
            gw = np.bincount(number, slope[row] * x) + DECAY * machine.weights[used]
            each = slope[row][:, None] * x[:, None] * (total[row] - part)
            gv = np.column_stack([np.bincount(number, each[:, k]) for k in range(FACTORS)]) + DECAY * machine.factors[used]
            gb = slope.sum()
            past_w[used] += gw * gw
            past_v[used] += gv * gv
            past_b += gb * gb
            machine.weights[used] -= RATE * gw / np.sqrt(past_w[used])
            machine.factors[used] -= RATE * gv / np.sqrt(past_v[used])
            machine.bias -= RATE * gb / np.sqrt(past_b)
    return machine


def score(df: DataFrame, machine: Machine, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` and ``predicted`` of every whole text; a null text is an empty one.  No shuffle."""
    kept = df.select(*keep, df[text].alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    sent = df.sparkSession.sparkContext.broadcast(machine)  # a fixed number of parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = sent.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            dense = tool.dense(statistics(texts))
            out = []
            for a, bucket, counts, bounds, total in hashed_words(texts, BUCKETS):
                out.append(sigmoid(tool.margin(*joined(bucket, counts, bounds, dense[a:a + len(total)]))))
            found = np.concatenate(out) if out else np.zeros(0)
            held = {batch.schema.field(i).name: batch.column(i) for i in range(batch.num_columns - 1)}
            yield pa.RecordBatch.from_pydict(held | {"score": pa.array(found, pa.float64()), "predicted": pa.array((found >= 0.5).astype(np.int32))})

    return kept.mapInArrow(run, f"{ddl}, score double, predicted int")


def prior_of(labels: DataFrame, label: str) -> float:
    """Share of label 1 among the rows that may be learned from, 1/2 without any."""
    got = labels.filter(F.col(label).isNotNull() & (fold("doc_id", 3) != 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return 0.5 if got is None else float(got)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    machine = fit(labelled_sample(docs.select("doc_id", "text"), labels, "quality", (SAMPLE_PER_CLASS, SAMPLE_PER_CLASS)), prior_of(labels, "quality"))
    return score(docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out")), machine, keep=("doc_id", "held_out"))
