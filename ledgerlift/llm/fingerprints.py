"""One-permutation MinHash fingerprints of documents.

Every shingle hash is computed once: its high bits name a bin, the bin keeps the smallest of the
other bits.  An empty bin copies a filled one, found by a walk of hashed probes that is the same
for all documents (optimal densification).  The lowest ``bits`` of every bin are packed into the
fingerprint; two fingerprints agree in a bin by chance with 2**-bits, which ``likeness`` takes out.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.words import batch_shingles, mix

BINS, BITS, WORDS = 256, 4, 5

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def densify(least: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has a filled one."""
    n, bins = least.shape
    out = least.copy()
    row, cell = np.nonzero((least == _EMPTY) & (least != _EMPTY).any(1)[:, None])
    attempt = 0
    while len(row):
        probe = mix(np.arange(bins, dtype=np.uint64) * np.uint64(0x100000001B3) + np.full(1, attempt + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        donor = (probe % np.uint64(bins)).astype(np.int64)[cell]
        found = least[row, donor]
        hit = found != _EMPTY
        out[row[hit], cell[hit]] = found[hit]
        row, cell = row[~hit], cell[~hit]
        attempt += 1
    return out


def pack_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` (1, 2, 4 or 8) of every value, packed into bytes row by row."""
    low = (values & np.uint64((1 << bits) - 1)).astype(np.uint8)
    spread = np.unpackbits(low[:, :, None], axis=2, bitorder="little")[:, :, :bits]
    return np.packbits(spread.reshape(len(values), -1), axis=1, bitorder="little")


def fingerprints(texts: pa.Array, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> list[str]:
    """Lowercase hex, 0 for a text without words; equal texts have equal fingerprints."""
    shift = np.uint64(64 - (bins - 1).bit_length())
    out: list[str] = []
    for _, hashes, bounds in batch_shingles(texts, words):
        n = len(bounds) - 1
        row = np.repeat(np.arange(n), np.diff(bounds))
        least = np.full(n * bins, _EMPTY)
        np.minimum.at(least, row * bins + (hashes >> shift).astype(np.int64), mix(hashes) >> np.uint64(1))
        least = least.reshape(n, bins)
        empty = (least == _EMPTY).all(1)
        # Mixed with the bin, so that two copies of one value agree by chance independently.
        packed = pack_bits(mix(densify(least) + np.arange(bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), bits)
        packed[empty] = 0
        out += ["" if e else p.tobytes().hex() for e, p in zip(empty.tolist(), packed)]
    return out


def likeness(a: str, b: str, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints, chance agreement taken out, in [0, 1].

    Texts without words have an empty fingerprint: like each other, unlike all others.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x = np.frombuffer(bytes.fromhex(a), np.uint8) ^ np.frombuffer(bytes.fromhex(b), np.uint8)
    cells = np.unpackbits(x, bitorder="little").reshape(-1, bits)
    agree = 1.0 - cells.any(1).mean()
    chance = 2.0 ** -bits
    return float(min(1.0, max(0.0, (agree - chance) / (1 - chance))))


def add_fingerprint(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fingerprint`` of every whole text; a null text is an empty one.  No shuffle."""
    kept = df.select(*keep, df[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = {b.schema.field(i).name: b.column(i) for i in range(b.num_columns - 1)}
            yield pa.RecordBatch.from_pydict(held | {"fingerprint": pa.array(fingerprints(b.column(b.num_columns - 1)), pa.string())})

    return kept.mapInArrow(run, f"{schema}, fingerprint string")


EDITS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")

#: Ranges of ids at most; their borders are literals of the plan.
MAX_RANGES = 20_000


def _spot(borders: list[int]) -> F.Column:
    """Number of borders at or below ``doc_id``, looked up in two steps."""
    if not borders:
        return F.lit(0)
    width = max(1, int(len(borders) ** 0.5))
    groups = [borders[i:i + width] for i in range(0, len(borders), width)]

    def below(array: str) -> str:
        return f"size(filter({array}, b -> b <= doc_id))"

    def literal(values: list[int]) -> str:
        return f"array({', '.join(f'{v}L' for v in values)})"

    group = below(literal([g[0] for g in groups]))
    inner = below(f"element_at(array({', '.join(map(literal, groups))}), {group})")
    return F.expr(f"if(doc_id < {borders[0]}L, 0, ({group} - 1) * {width} + {inner})").cast("int")


def with_successor(df: DataFrame, rows: int = 4096) -> DataFrame:
    """Every document (doc_id, text) against the next one by descending id and against an edited text.

    The edited text has its last half replaced by as many first code points of the next document.
    Ids are cut into ranges of about ``rows`` documents.  A document goes to its own range; the first
    of a range also to the range before, whose last document needs it.  So the texts are shuffled
    once and no window spans the table.  After the last document comes the first.  Null texts are
    empty, rows of one id follow each other in the order of their texts.  Rows without id have no place in
    the order: they have a fingerprint, and NULL in what depends on the next document.
    """
    every = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    df = every.filter("doc_id IS NOT NULL")
    ids = df.select("doc_id")
    parts = max(1, min(MAX_RANGES, ids.count() // rows))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] if parts > 1 else []
    borders = sorted(set(cuts or []))
    heads = {r["spot"]: r["head"] for r in  # a row for each range
             ids.groupBy(_spot(borders).alias("spot")).agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    openers = df.sparkSession.createDataFrame([(heads[s], order[i - 1]) for i, s in enumerate(order)], "doc_id bigint, also int")
    own = F.struct(_spot(borders).alias("spot"), F.lit(False).alias("lent"))
    lent = F.struct(F.col("also").alias("spot"), F.lit(True).alias("lent"))
    sent = df.join(F.broadcast(openers), "doc_id", "left").select(
        "doc_id", "text", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, lent))).alias("to"))
    dealt = sent.select("to.spot", "to.lent", "doc_id", "text").repartitionById(len(order) or 1, _place("spot", order))
    placed = dealt.sortWithinPartitions("spot", "lent", F.col("doc_id").desc(), "text").mapInArrow(_compare, EDITS)
    loose = every.filter("doc_id IS NULL").withColumn("n_chars", F.length("text").cast("bigint"))
    return placed.unionByName(add_fingerprint(loose, keep=("doc_id", "n_chars")), allowMissingColumns=True)


def _place(column: str, order: list[int]) -> F.Column:
    return F.pmod(F.col(column), F.lit(len(order) or 1))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range: its own documents in descending order, then what follows the last."""
    spot, last, own = None, None, False  # last: (doc, text, fingerprint) that waits for the next
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            part = batch.slice(a, 1000)
            values, marks = part.column(3).to_pylist(), fingerprints(part.column(3))
            pairs = []
            for s, lent, doc, text, mark in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), values, marks):
                if s == spot and own:
                    pairs.append((*last, text, mark))
                spot, last, own = s, (doc, text, mark), not lent
            if pairs:
                edited = [text[:len(text) - len(text) // 2] + after[:len(text) // 2] for _, text, _, after, _ in pairs]
                changed = fingerprints(pa.array(edited, pa.large_string()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([p[0] for p in pairs], pa.int64()),
                    pa.array([len(p[1]) for p in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                    pa.array([p[2] for p in pairs], pa.string()),
                    pa.array(changed, pa.string()),
                    pa.array([likeness(p[2], c) for p, c in zip(pairs, changed)], pa.float64()),
                    pa.array([likeness(p[2], p[4]) for p in pairs], pa.float64()),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
