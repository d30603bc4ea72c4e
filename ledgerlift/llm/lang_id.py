"""Language identification as a mixture of languages.

A language is a distribution over hashed byte n-grams of lower-cased letters.  A document is a
mixture of them: expectation-maximisation finds its proportions, and the set of languages grows
from the best single one by the language that raises the likelihood most, as long as the gain
exceeds the penalty for one more proportion (Bayesian information criterion).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import claim, fold
from ledgerlift.llm.words import mix, slices, text_bytes

NGRAM, BUCKETS = 4, 1 << 15
#: Weight of the uniform distribution in every language's.
SMOOTHING = 0.5
ROUNDS = 20
UNKNOWN = "und"

# ASCII letters in lower case, bytes of longer code points as they are, all else one space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


_PAD = np.full(NGRAM - 1, 0x20, np.uint8)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the rows between ``offsets`` and the bounds of each row's.

    Grams that begin with a space and go on with one carry nothing and are left out.
    """
    first = int(offsets[0])
    part = _FOLD[data[first:int(offsets[-1])]].astype(np.uint32)
    n = len(part)
    ends = offsets - first
    if n < NGRAM:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    code = np.zeros(n - NGRAM + 1, np.uint64)
    for j in range(NGRAM):
        code = (code << np.uint64(8)) | part[j:n - NGRAM + 1 + j].astype(np.uint64)
    starts = np.arange(len(code))
    row = np.searchsorted(ends, starts, side="right") - 1
    good = (starts + NGRAM <= ends[row + 1]) & ~((part[:len(code)] == 0x20) & (part[1:len(code) + 1] == 0x20))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row[good], minlength=len(offsets) - 1))])
    return (mix(code[good]) >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64), bounds


def train(df: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and the log probability of each bucket in each, from rows (text, lang) of all rows given.

    Counts are summed in every task, so a task sends at most ``BUCKETS`` rows a language; the driver
    gets languages x buckets numbers, whatever the size of the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lang_id")
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, offsets = text_bytes(batch.column(0))
            for a, b in slices(offsets):
                grams, bounds = ngrams(data, offsets[a:b + 1])
                owner = np.repeat(np.arange(b - a), np.diff(bounds))
                names, number = np.unique(langs[a:b].astype(str), return_inverse=True)
                for k, name in enumerate(names.tolist()):
                    got = np.bincount(grams[number[owner] == k], minlength=BUCKETS)
                    counts[name] = counts[name] + got if name in counts else got
        for name, found in counts.items():
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(found[some], pa.int64())],
                                             names=["lang", "bucket", "n"])

    found = (df.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
             .toPandas())
    langs = sorted(found["lang"].unique())
    table = np.zeros((len(langs), BUCKETS))
    table[found["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"]
    table += SMOOTHING
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def proportions(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chosen languages and their proportions from the n-grams' log probabilities (grams x languages), and the log-likelihood."""
    n, languages = logs.shape
    top = logs.max(1, keepdims=True)
    scaled = np.exp(logs - top)
    base = float(top.sum())
    single = logs.sum(0)
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    penalty = 0.5 * np.log(max(n, 2))
    while len(chosen) < languages:
        # The gradient at the present mixture names the language to add.
        mixed = scaled[:, chosen] @ share
        gain = (scaled / np.maximum(mixed, 1e-30)[:, None]).sum(0)
        gain[chosen] = -np.inf
        more = int(np.argmax(gain))
        if gain[more] <= n:
            break
        part = scaled[:, [*chosen, more]]
        pi = np.append(share * 0.9, 0.1)
        for _ in range(ROUNDS):
            joint = part * pi
            pi = (joint / np.maximum(joint.sum(1, keepdims=True), 1e-30)).mean(0)
        likelihood = float(np.log(np.maximum(part @ pi, 1e-30)).sum()) + base
        if likelihood - best <= penalty:
            break
        chosen, share, best = [*chosen, more], pi, likelihood
    return np.array(chosen), share, best


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``lang_pred``, ``score`` (the language's proportion) and ``langs`` (all chosen, with proportions).

    The largest proportion wins, of equal ones the first language.  A text that is null or has no letter is
    ``und`` with score 0 and no languages; so is every text if nothing was learned.  A text shorter than an n-gram is
    read with spaces around it.
    """
    langs, logs = model
    kept = df.select(*keep, df[text].alias("_text"), df[text].rlike(r"\p{L}").alias("_letters"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-2])
    table = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))  # buckets x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lang_id")
        for batch in batches:
            held = {batch.schema.field(i).name: batch.column(i) for i in range(batch.num_columns - 2)}
            letters = batch.column(batch.num_columns - 1).to_pylist()
            data, offsets = text_bytes(batch.column(batch.num_columns - 2))
            names, scores, sets = [], [], []
            for a, b in slices(offsets):
                grams, bounds = ngrams(data, offsets[a:b + 1])
                for i in range(b - a):
                    if not letters[a + i] or not langs:
                        names.append(UNKNOWN), scores.append(0.0), sets.append([])
                        continue
                    own = grams[bounds[i]:bounds[i + 1]]
                    if not len(own):  # too short for an n-gram without the spaces around it
                        text = np.concatenate([_PAD[:1], data[offsets[a + i]:offsets[a + i + 1]], _PAD])
                        own = ngrams(text, np.array([0, len(text)]))[0]
                    chosen, share, _ = proportions(table.value[own])
                    order = np.lexsort((chosen, -share))
                    names.append(langs[chosen[order[0]]]), scores.append(float(min(1.0, share[order[0]])))
                    sets.append([{"lang": langs[chosen[k]], "share": float(share[k])} for k in order])
            held |= {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()),
                     "langs": pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))}
            yield pa.RecordBatch.from_pydict(held)

    return kept.mapInArrow(run, f"{ddl}, lang_pred string, score double, langs array<struct<lang: string, share: double>>")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows (text, lang) to learn from: a known language, and a document outside the held-out fifth."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", 5) != 0)).select("text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, langs`` of every document, learned from its own labelled rows."""
    model = train(training_rows(docs))
    return predict(docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out")), model, keep=("doc_id", "held_out"))
