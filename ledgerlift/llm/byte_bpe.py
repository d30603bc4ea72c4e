"""Byte-level BPE by rank files: encoding with a segment tree, decoding by table.

Each match of the split pattern is merged on its own.  A segment tree over its byte positions
holds, for every live position, the rank of the pair it forms with the next live token, and in
each inner node the leftmost smallest rank below it.  The root is the next merge; a merge changes
three leaves and their paths to the root.

Pieces up to ``LANES`` bytes are merged many at a time, one tree a row, in steps of numpy;
longer ones, however long, one by one.
"""

import base64
import gc
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame


LANES = 64
#: Chunks kept with their ids in a worker, in two generations; the older one goes when the newer is full.
CACHED = 600_000
#: Longer chunks are not kept.
CACHED_CHARS = 64

# White space of Unicode, which is what \s means to the tokenizers' own pattern engine.
SPACE = "\t-\r \x85\xa0  -     　"
#: Cuts of a text that the split pattern always makes, too.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")



def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pattern(pattern: str) -> "regex.Pattern":
    inside = pattern.replace("[^\\s", f"[^{SPACE}").replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]")
    return regex.compile(inside)


class Merger:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = merge_pattern(pattern)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.none = max(ranks.values()) + 1
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.none + right] = rank
        found = sorted(self.pairs.items())
        self.keys = np.array([k for k, _ in found] + [np.iinfo(np.int64).max], np.int64)
        self.merged = np.array([v for _, v in found] + [self.none], np.int64)
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.none + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], self.none)

    def merge_long(self, piece: bytes) -> list[int]:
        """One segment tree as a list; a node is rank * length + position, so the smaller is the one to merge."""
        n = len(piece)
        tokens = self.single[np.frombuffer(piece, np.uint8)].tolist()
        if n < 2:
            return tokens
        width = 1 << (n - 1).bit_length()
        far = self.none * n
        tree = [far] * (2 * width)
        pairs, none = self.pairs, self.none
        for i in range(n - 1):
            rank = pairs.get(tokens[i] * none + tokens[i + 1])
            if rank is not None:
                tree[width + i] = rank * n + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        def pair_at(place: int) -> int:
            after = following[place]
            rank = pairs.get(tokens[place] * none + tokens[after]) if after < n else None
            return far if rank is None else rank * n + place

        while tree[1] < far:
            rank, at = divmod(tree[1], n)
            gone = following[at]
            tokens[at], tokens[gone] = rank, -1
            following[at] = following[gone]
            if following[gone] < n:
                previous[following[gone]] = at
            put(gone, far)
            put(at, pair_at(at))
            if previous[at] >= 0:
                put(previous[at], pair_at(previous[at]))
        return [t for t in tokens if t >= 0]

    def merge_lanes(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most ``width`` bytes, a row each with -1 at merged places, and their counts."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        tokens = np.full((n, width + 1), -1, np.int64)
        held = np.arange(width)[None, :] < lengths[:, None]
        tokens[:, :width][held] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        far = self.none * width
        tree = np.full((n, 2 * width), far, np.int64)
        row, place = np.nonzero(held[:, 1:])
        rank = self.ranks_of(tokens[row, place], tokens[row, place + 1])
        tree[row, width + place] = np.where(rank < self.none, rank * width + place, far)
        node = width
        while node > 1:
            tree[:, node // 2:node] = np.minimum(tree[:, node:2 * node:2], tree[:, node + 1:2 * node:2])
            node //= 2
        following = np.tile(np.arange(1, width + 1), (n, 1))
        previous = np.tile(np.arange(-1, width - 1), (n, 1))
        live = np.flatnonzero(tree[:, 1] < far)
        while len(live):
            rank, at = np.divmod(tree[live, 1], width)
            gone = following[live, at]
            after = following[live, gone]
            tokens[live, at] = rank
            tokens[live, gone] = -1
            following[live, at] = after
            inner = after < lengths[live]
            previous[live[inner], after[inner]] = at[inner]
            before = previous[live, at]
            linked = before >= 0
            self._put(tree, live, gone, np.full(len(live), far), width)
            self._put(tree, live, at, self._pair(tokens, live, at, after, lengths, width, far), width)
            if linked.any():
                lanes, left = live[linked], before[linked]
                self._put(tree, lanes, left, self._pair(tokens, lanes, left, at[linked], lengths, width, far), width)
            live = live[tree[live, 1] < far]
        kept = tokens[:, :width]
        return kept, (kept >= 0).sum(1)

    def _pair(self, tokens, lanes, left, right, lengths, width, far):
        inner = right < lengths[lanes]
        rank = self.ranks_of(tokens[lanes, left], tokens[lanes, np.where(inner, right, left)])
        return np.where(inner & (rank < self.none), rank * width + left, far)

    @staticmethod
    def _put(tree, lanes, place, value, width):
        node = place + width
        tree[lanes, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[lanes, node] = np.minimum(tree[lanes, 2 * node], tree[lanes, 2 * node + 1])

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of every piece."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_width.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, rows in by_width.items():
            if width > LANES:
                for i in rows:
                    out[i] = np.array(self.merge_long(pieces[i]), "<u4").tobytes()
                continue
            for a in range(0, len(rows), 1 << 15):
                some = rows[a:a + (1 << 15)]
                kept, counts = self.merge_lanes([pieces[i] for i in some], width)
                flat = kept[kept >= 0].astype("<u4").tobytes()
                ends = np.cumsum(counts) * 4
                start = 0
                for i, end in zip(some, ends.tolist()):
                    out[i] = flat[start:end]
                    start = end
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers."""
        cut = [CHUNK.findall(t) if t else [] for t in texts]
        if len(self.cache) > CACHED // 2:
            self.old, self.cache = self.cache, {}
        cache, old, missing = self.cache, self.old, []
        for c in set().union(*cut):
            if c not in cache:
                if c in old:
                    cache[c] = old[c]
                else:
                    missing.append(c)
        if missing:
            split = [[c] if c.isalpha() or c[0] == " " and c[1:].isalpha() else self.pattern.findall(c) for c in missing]
            pieces = list({p for s in split for p in s})
            known = dict(zip(pieces, self.merge_all([p.encode() for p in pieces])))
            for c, s in zip(missing, split):
                cache[c] = known[c] if len(s) == 1 else b"".join([known[p] for p in s])
        out = [b"".join([cache[c] for c in chunks]) for chunks in cut]
        for c in missing:
            if len(c) > CACHED_CHARS:
                del cache[c]
        return out

    def decode(self, ids: bytes) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def merger(path: str, pattern: str) -> Merger:
    return Merger(read_ranks(path), pattern)


def grouped(values: list, sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``most``."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield at, i
            at, total = i, 0
        total += size
    if at < len(values):
        yield at, len(values)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           digest: bool = False, chars: int = 4_000_000) -> DataFrame:
    """Columns ``keep``, ``n_tokens``, ``ids`` (little-endian 32-bit) and ``decoded`` (the bytes of the ids).

    A null text is an empty text: no ids.  With ``digest`` the two byte columns are replaced by
    their SHA-256 in lowercase hex (``ids_sha256``, ``decoded_sha256``) before they leave the task.
    One row out per row in; no shuffle.
    """
    kept = df.select(*keep, df[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    added = "ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = merger(path, pattern)
        gc.disable()  # millions of small objects without cycles
        for rows in batches:
            texts = rows.column(rows.num_columns - 1).to_pylist()
            for a, b in grouped(texts, [len(t or "") for t in texts], chars):
                ids = tool.encode(texts[a:b])
                decoded = [tool.decode(i) for i in ids]
                columns = {rows.schema.field(i).name: rows.column(i).slice(a, b - a) for i in range(rows.num_columns - 1)}
                columns["n_tokens"] = pa.array([len(i) // 4 for i in ids], pa.int64())
                if digest:
                    columns["ids_sha256"] = pa.array([hashlib.sha256(i).hexdigest() for i in ids])
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded])
                else:
                    columns["ids"], columns["decoded"] = pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
        gc.enable()

    return kept.mapInArrow(run, f"{schema}, n_tokens bigint, {added}")
