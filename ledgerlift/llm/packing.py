"""Best-fit packing of token sequences by a hierarchy of rounds.

Documents are tokenized, closed by a separator id and cut where they are longer than a sequence.
Every task packs its pieces best-fit, the longest first, and emits bins that are nearly full.
The others go up a tree as items, several tasks' into one, and are packed best-fit again, until
one task is left.  A task passes on at most ``carry`` bins, its emptiest; fuller ones stay as they
are, so that the last task's work has a bound.

That bound costs no sequence.  Of two bins that best-fit has made, the contents of the later did not fit
beside the earlier, so together they exceed a sequence: all bins of a task but one are more than half full.
Above, a merge therefore always takes in one of these small bins, of which the whole tree has no more than
tasks in its first round, and ``carry`` is never below their number.  Wherever a small bin would fit beside a
bin that was not passed on, it also fits beside any that was passed on instead, being emptier, and these
outnumber the small bins that may have taken them.
"""

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlift.llm.common import claim
from ledgerlift.llm.token_counts import CACHED_CHARS, CLOSING, ODD_SPACE, byte_alphabet
from ledgerlift.session import written

#: Words kept with their ids in a worker, in two generations.
CACHED = 300_000

#: Words of Latin letters, none of which normalisation or lower case turns into several.
LATIN = regex.compile("[A-Za-z\\xC0-\\xD6\\xD8-\\xF6\\xF8-\\u012F\\u0131-\\u024F]+")


#: The file's own split of a chunk; on ASCII text it means the same here.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder:
    """Ids of whole texts, by the library on every distinct word between white space.

    For tokenizers that drop white space and split letters from what follows them, the ids of a text are the
    ids of its chunks in order, and those of a chunk with one sign behind a letter are its word's and the sign's.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
        self.tool = Tokenizer.from_file(path)
        state = {part: json.loads(own.__getstate__()) for part in ("normalizer", "pre_tokenizer") if (own := getattr(self.tool, part))}
        kinds = [n["type"] for n in state.get("normalizer", {}).get("normalizers", [])]
        first = state.get("pre_tokenizer", {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex", "")
        # Where the file splits letters, digits and signs so, the model can be asked for a lower-cased piece at once.
        known = kinds == ["NFC", "Replace", "Lowercase"] and first == SPLIT and getattr(self.tool.model, "end_of_word_suffix", None)
        self.split = regex.compile(SPLIT) if known else None
        self.model = self.tool.model
        self.shown = {b: c for b, c in enumerate(byte_alphabet())}
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ask(self, piece: str) -> bytes:
        """Ids of a piece that the split leaves whole, of Latin letters or of other printable ASCII."""
        shown = piece.lower() if piece.isascii() else piece.lower().encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.cache.get(piece) or self.old.get(piece)
        if known is None:
            known = self._ask(piece)
            if not piece.isalpha():  # signs and digits are few
                self.cache[piece] = known
        return known

    def _learn(self, chunks: set[str]) -> None:
        """Have the ids of ``chunks`` in the cache: words first, which others are made of."""
        cache, old, later, rest = self.cache, self.old, [], []
        for c in chunks:
            if (known := old.get(c)) is not None:
                cache[c] = known
            elif self.split and LATIN.fullmatch(c):
                cache[c] = self._ask(c)
            else:
                later.append(c)
        for c in later:
            if self.split and c[-1] in CLOSING and LATIN.fullmatch(c, 0, len(c) - 1):
                cache[c] = self._piece(c[:-1]) + self._piece(c[-1])
            elif self.split and c.isascii() and c.isprintable() and "<|" not in c:
                cache[c] = b"".join(map(self._piece, self.split.findall(c.lower())))
            else:
                rest.append(c)
        for a in range(0, len(rest), 10_000):
            some = rest[a:a + 10_000]
            for c, e in zip(some, self.tool.encode_batch_fast(some, add_special_tokens=False)):
                cache[c] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        cut = [t.split() if t and not ODD_SPACE.search(t) else [t] if t else [] for t in texts]
        if len(self.cache) > CACHED // 2:
            self.old, self.cache = self.cache, {}
        missing = set().union(*cut).difference(self.cache)
        self._learn(missing)
        ids = self.cache.__getitem__
        out = [b"".join(map(ids, chunks)) for chunks in cut]
        for c in missing:
            if len(c) > CACHED_CHARS:
                del self.cache[c]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def token_pieces(df: DataFrame, path: str, capacity: int, separator: int = 0, ids: bool = True, slice_bytes: int = 1 << 20) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; a null text is an empty one and has only the separator.  No shuffle."""
    mark = array("I", [separator]).tobytes()
    schema = PIECES if ids else PIECES.removesuffix(", ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing", encoder.cache_clear)
        tool = encoder(path)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            ends, at = np.cumsum(lengths, dtype=np.int64), 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + slice_bytes, side="right")))
                docs, texts = batch.column(0).slice(at, end - at).to_pylist(), batch.column(1).slice(at, end - at).to_pylist()
                rows = []
                for doc, coded in zip(docs, tool.encode(texts)):
                    coded += mark
                    for k, a in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded[a:a + 4 * capacity]
                        rows.append((doc, k, a // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:6 if ids else 5]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names[:len(kinds)])
                at = end

    return df.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item positions: the longest item first, each to the fullest bin it fits in.

    Bins lie by their free room; the set of rooms in use is one whole number, whose lowest
    set bit at or above the item's length is the best fit.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[item]
        fitting = used >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = rooms[room].pop()
            if not rooms[room]:
                used ^= 1 << room
        else:
            room, place = capacity, len(bins)
            bins.append([])
        bins[place].append(item)
        rooms[room - length].append(place)
        used |= 1 << (room - length)
    return bins


BIN = "bin bigint, fill int, open boolean, parts array<struct<bin: bigint, shift: int>>"
PART = pa.struct([("bin", pa.int64()), ("shift", pa.int32())])


def _round(capacity: int, full: int, carry: int, level: int):
    """A task's open bins as items of one more round; bins without parts are made of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, parts = [], []
        for batch in batches:
            fills += batch.column(1).to_pylist()
            parts += [[(p["bin"], p["shift"]) for p in row] for row in batch.column(2).to_pylist()]
        made = []
        for held in best_fit(fills, capacity):
            inner, fill = [], 0
            for i in held:
                inner += [(b, shift + fill) for b, shift in parts[i]]
                fill += fills[i]
            made.append((fill, inner))
        made.sort(key=lambda b: b[0])
        base = _base(level)
        for a in range(0, len(made), 20_000):
            some = made[a:a + 20_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([base + a + i for i in range(len(some))], pa.int64()),
                pa.array([fill for fill, _ in some], pa.int32()),
                pa.array([fill < full and a + i < carry for i, (fill, _) in enumerate(some)], pa.bool_()),
                pa.array([[{"bin": b, "shift": s} for b, s in inner] for _, inner in some], pa.list_(PART)),
            ], names=["bin", "fill", "open", "parts"])

    return run


def _base(level: int) -> int:
    """First number of this task's bins: level and partition in the high bits."""
    return (level << 57) | (TaskContext.get().partitionId() << 32)


def _first(capacity: int, items: int):
    """Pieces of a task into bins, ``items`` at a time.

    The tokenizer and its words are released first.  Only lengths and places are made into Python objects; the
    other columns go on in the batches they came in, each of which is let go once it is passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("placing")
        base, number = _base(0), 0
        held: list[pa.RecordBatch] = []

        def pack(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            lengths = [n for batch in rows for n in batch.column("length").to_pylist()]
            bin_of, offset, total = array("q", [0]) * len(lengths), array("i", [0]) * len(lengths), array("i", [0]) * len(lengths)
            for place in best_fit(lengths, capacity):
                fill = 0
                for i in place:
                    bin_of[i], offset[i] = base + number, fill
                    fill += lengths[i]
                for i in place:
                    total[i] = fill
                number += 1
            at = 0
            rows.reverse()
            while rows:
                batch = rows.pop()
                end = at + batch.num_rows
                placed = [pa.array(np.asarray(c[at:end])) for c in (bin_of, total, offset)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *placed], names=[*batch.schema.names, "bin", "fill", "shift"])
                at = end

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= items:
                yield from pack(held)
                held = []
        if held:
            yield from pack(held)

    return run


def pack(pieces: DataFrame, capacity: int, fan_in: int = 16, nearly_full: float = 0.995, items: int = 500_000,
         carry: int = 50_000) -> DataFrame:
    """``pieces`` (a written table with ``length``) with ``sequence_id`` and ``offset``.

    ``items`` bounds what one task packs at a time, ``carry`` (at least the tasks of the first round) the bins
    it passes up the tree; see above why that makes no more sequences.
    No piece is longer than ``capacity``.  Sequences are gapless from 0; ids are any numbers.
    """
    full = int(capacity * nearly_full)
    columns = pieces.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    placed = written(pieces.mapInArrow(_first(capacity, items), f"{ddl}, bin bigint, fill int, shift int"), "placed")
    # A bin is one row per bin: the piece at its beginning.
    bins = placed.filter("shift = 0").select("bin", "fill")
    closed = []
    rising = bins.filter(F.col("fill") < full).select("bin", "fill", F.array(F.struct("bin", F.lit(0).alias("shift"))).alias("parts"))
    level, tasks = 1, max(1, -(-len(placed.inputFiles()) // fan_in))
    carry = max(carry, tasks)
    while True:
        dealt = rising.repartition(tasks, F.xxhash64("bin")) if tasks > 1 else rising.coalesce(1)
        made = written(dealt.mapInArrow(_round(capacity, full, carry, level), BIN), "bins")
        if tasks == 1:
            closed.append(made)
            break
        closed.append(made.filter(~F.col("open")))
        rising = made.filter("open").select("bin", "fill", "parts")
        level, tasks = level + 1, -(-tasks // fan_in)
    moved = closed[0]
    for other in closed[1:]:
        moved = moved.union(other)
    moved = moved.select(F.col("bin").alias("_sequence"), F.explode("parts").alias("part")).select(
        "_sequence", F.col("part.bin").alias("bin"), F.col("part.shift").alias("_shift"))
    return placed.join(moved, "bin", "left").select(
        *columns, F.coalesce("_sequence", "bin").alias("sequence_id"),
        (F.col("shift") + F.coalesce("_shift", F.lit(0))).cast("bigint").alias("offset"))
