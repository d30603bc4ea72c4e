"""Interaction of document filters from relations of failing ids.

* One pass over the texts finds which filters each row fails; the filter on repeated texts compares its id with the
  smallest id of its text, which the digests of all texts give.
* For each filter a table of the rows that fail it is written (``filter=<letter>`` of one folder).  A row has a number
  of its own beside its id, since ids may repeat or be null.
* Whatever the order before it, a filter meets what its prefix, as a set, has left.  So every set of filters is a
  prefix: rows left-anti-joined with the failing rows of the set are its survivors, a filter's failing rows
  left-anti-joined with them are what it removes behind the set, left-semi-joined what is redundant, and those
  left-anti-joined with the other filters fail it alone.  Sets are exploded behind the exchange by row number, so each
  relation is shuffled once, in narrow rows, and no row number is hot.
* The orders are then read from the counts of the sets.

Rows with a null text have an empty one.  A null ``doc_id`` is no one's smaller id and has none.  Rows of one id are
judged one by one; their labels are those of the id, where the larger of repeated labels counts.  A null part is the
empty string.  An empty table has no parts and no rows.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import by_heavy_keys
from ledgerlift.operators.picks import summed
from ledgerlift.session import scratch_path, written

#: In the order of their bits.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 100, 80, 10
SYMBOL = re.compile(rb"[#$%&*|]")
UPPER = bytes(range(65, 91))
#: Bytes of UTF-8 that begin no code point.
FOLLOWING = bytes(range(0x80, 0xC0))
#: Bytes of a text looked at at a time; the words of texts up to ``HASHED`` bytes are held themselves, of longer ones their hashes.
SLICE, HASHED = 1 << 20, 8 << 20

MEASURED = "doc_id bigint, part string, digest binary, fails int"


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of about ``SLICE`` bytes that end where a word does, but for a word that is longer itself."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        if end < len(text):
            cut = max(text.rfind(w, at, end) for w in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                cut = min((p for w in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := text.find(w, end)) >= 0), default=len(text) - 1)
            end = cut + 1
        yield text[at:end]
        at = end


def word_counts(text: bytes) -> tuple[int, int]:
    """Words (runs without ASCII white space) and distinct words."""
    if len(text) <= SLICE:
        found = text.split()
        return len(found), len(set(found))
    total, known, hashes = 0, set(), []
    for part in _slices(text):
        found = part.split()
        total += len(found)
        if len(text) <= HASHED:
            known.update(found)
        else:
            hashes.append(np.unique(np.fromiter(map(hash, found), np.int64, len(found))))
    return total, len(np.unique(np.concatenate(hashes))) if hashes else len(known)


def failing(text: bytes) -> int:
    """Bits of the filters that look at the text alone."""
    words, distinct = word_counts(text)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text) - len(text.translate(None, FOLLOWING)) if not text.isascii() else 0
    return ((words < LEAST_WORDS) | (100 * distinct < LEAST_DISTINCT * words) << 1
            | (100 * upper > MOST_UPPER * (len(text) - points)) << 2 | (SYMBOL.search(text) is not None) << 3)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(2), "").cast(pa.large_binary())
        digests, bits = [], []
        for text in texts:
            text = text.as_py()
            digests.append(hashlib.sha256(text).digest())
            bits.append(failing(text))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(bits, pa.int32())],
                                         names=["doc_id", "part", "digest", "fails"])


def measure(docs: DataFrame, part: str = "lang") -> DataFrame:
    """Written (row, doc_id, part, fails): the bits of all filters that each row of ``docs`` (doc_id, text, part) fails."""
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    own = written(rows.mapInArrow(_measure, MEASURED).withColumn("row", F.monotonically_increasing_id()), "measured")
    # Equal texts, pre-aggregated; only texts that several ids have can fail.
    first = written(own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                    .filter("first < last").select("digest", "first", "n"), "repeated")
    repeated = by_heavy_keys(own, first, "digest", own.count())
    bit = 1 << FILTERS.index("E")
    return written(repeated.select("row", "doc_id", "part", F.when(F.col("doc_id") > F.col("first"), F.col("fails").bitwiseOR(F.lit(bit)))
                                   .otherwise(F.col("fails")).alias("fails")), "judged")


def failing_ids(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """The written id tables, one for each filter: (row, doc_id, part, good, toxic, filter)."""
    marks = summed(labels.filter("quality = 1 OR toxic = 1"), ["doc_id"], F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                   F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = judged.filter("fails <> 0").join(marks, "doc_id", "left").select(
        "row", "doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "fails")
    failed = F.array_compact(F.array(*(F.when(F.col("fails").bitwiseAND(F.lit(1 << k)) != 0, F.lit(f)) for k, f in enumerate(FILTERS))))
    found = known.withColumn("filter", F.explode(failed)).drop("fails")
    path = scratch_path(judged.sparkSession, "failing")
    found.write.partitionBy("filter").parquet(path)
    return judged.sparkSession.read.schema(found.schema).parquet(path)


def set_counts(judged: DataFrame, ids: DataFrame) -> DataFrame:
    """Written counts by part, set of filters (bits) and, but for survivors, filter (bit).

    ``kind`` is ``kept`` (survivors of the set), ``removed`` (by the filter behind the set, with ``good`` and ``toxic``),
    ``redundant`` (fails the filter, gone by the set) or ``unique`` (fails the filter alone).
    """
    every = (1 << len(FILTERS)) - 1
    bit = F.expr(f"shiftleft(1, instr('{FILTERS}', filter) - 1)")
    failed = ids.select("row", "part", "good", "toxic", bit.alias("bit")).repartition("row")
    other = failed.select(F.col("row").alias("_row"), F.col("bit").alias("_bit")).hint("shuffle_hash")
    same, within = F.col("row") == F.col("_row"), F.col("set").bitwiseAND(F.col("_bit")) != 0
    rows = judged.select("row", "part").repartition("row")
    sets = F.sequence(F.lit(0), F.lit(every))
    survivors = rows.withColumn("set", F.explode(sets)).join(other, same & within, "left_anti")
    behind = failed.withColumn("set", F.explode(F.filter(sets, lambda s: s.bitwiseAND(F.col("bit")) == 0)))
    removed = behind.join(other, same & within, "left_anti")
    redundant = behind.join(other, same & within, "left_semi")
    alone = failed.join(other, same & (F.col("bit") != F.col("_bit")), "left_anti")

    def counted(df: DataFrame, kind: str, *keys: str) -> DataFrame:
        lost = [F.count_if(c) if kind == "removed" else F.lit(0).cast("bigint") for c in ("good", "toxic")]
        return df.groupBy("part", *keys).agg(F.count("*").alias("n"), lost[0].alias("good"), lost[1].alias("toxic")).select(
            "part", F.lit(kind).alias("kind"), *(F.col(k) if k in keys else F.lit(0).alias(k) for k in ("set", "bit")), "n", "good", "toxic")

    return written(counted(survivors, "kept", "set").union(counted(removed, "removed", "set", "bit"))
                   .union(counted(redundant, "redundant", "set", "bit")).union(counted(alone, "unique", "bit")), "sets")


def steps() -> list[tuple[str, int, int, int, int]]:
    """(order, step, set before, bit, orders that have this filter behind this set) of all orders."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            found.append(("".join(order), k + 1, before, bit, factorial(k) * factorial(len(order) - k - 1)))
            before |= bit
    return found


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for every part, order of the filters and step; see the module for the columns' rules."""
    judged = measure(docs, part)
    counts = set_counts(judged, failing_ids(judged, labels))
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, *s) for i, s in enumerate(steps())], "at int, filter_order string, step int, set int, bit int, orders bigint")
    parts = counts.filter("kind = 'kept' AND set = 0").select("part")
    asked = parts.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(steps()) - 1)))).join(F.broadcast(table), "at")  # 600 rows

    def lookup(kind: str, keys: list[str], **columns: str) -> DataFrame:
        return counts.filter(F.col("kind") == kind).select("part", *keys, *(F.col(c).alias(n) for n, c in columns.items()))

    removed = lookup("removed", ["set", "bit"], removed="n", good_lost="good", toxic_lost="toxic")
    weights = F.broadcast(spark.createDataFrame(sorted({s[2:] for s in steps()}), "set int, bit int, orders bigint"))  # 80 rows
    shares = removed.join(weights, ["set", "bit"]).groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    kept = lookup("kept", ["set"], kept="n").withColumnRenamed("set", "left")
    found = (asked.withColumn("left", F.col("set").bitwiseOR(F.col("bit")))
             .join(kept, ["part", "left"], "left").join(removed, ["part", "set", "bit"], "left")
             .join(lookup("redundant", ["set", "bit"], redundant="n"), ["part", "set", "bit"], "left")
             .join(lookup("unique", ["bit"], unique_fails="n"), ["part", "bit"], "left").join(shares, ["part", "bit"], "left"))
    numbers = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return found.select("part", "filter_order", "step", *(F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers))
