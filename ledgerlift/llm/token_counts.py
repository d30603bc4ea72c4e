"""Token counts of whole texts and of all their prefixes for a word-end BPE vocabulary.

A prefix dynamic programme over the symbols of a piece.  BPE without word ends has one valid
token sequence for every prefix, and it ends in the one token whose neighbour on the left, the
last token of the shorter prefix, forms a valid pair with it.  So ``open_count[i]`` is
``open_count[i - length] + 1`` for that token, and ``closed_count[i]`` the same with the last
symbol marked as a word's end: the count of the text cut after symbol ``i``.  Counts of the
chunks before it are added, and every question about a prefix is an array look-up.
"""

import gc
import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Chunks kept with their counts in a worker, in two generations.
CACHED = 600_000
CACHED_CHARS = 64

#: White space to ``str.split`` but not to the tokenizer.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


ONE = (1,)
CLOSING = frozenset(".,;:!?")


def _lengths(tokens: set[str]) -> dict[str, tuple[int, ...]]:
    """Lengths of the tokens that end in these two symbols, the longest first."""
    found: dict[str, set[int]] = {}
    for t in tokens:
        found.setdefault(t[-2:], {1}).add(len(t))
    return {end: tuple(sorted(sizes, reverse=True)) for end, sizes in found.items()}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in names]
    names.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [names[b] for b in range(256)]


class PrefixCounter:
    """Counts for one tokenizer file with byte-level pieces, lower case and word ends."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or not self.end:
            raise ValueError("not a lower-casing BPE file with word ends")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.bytes = byte_alphabet()
        # Merges by priority; a token's split is the merge that makes it first.
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str, int]] = {}
        for i, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if left + right not in vocab:
                continue
            self.rank[left, right] = i
            self.parts.setdefault(left + right, (left, right, i))
        self.fits: dict[tuple[str, str], bool] = {}
        # Tokens that their own text merges to; the others never stand alone.
        whole = [t for t, (left, right, rank) in self.parts.items() if self._apart(left, right, rank)]
        self.open = {t for t in whole if not t.endswith(self.end)}
        self.closed = {t[:-len(self.end)] for t in whole if t.endswith(self.end)}
        self.open_lengths, self.closed_lengths = _lengths(self.open), _lengths(self.closed)
        self.cache: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.states: dict[str, tuple[str, int]] = {}

    def _apart(self, a: str, b: str, merged: int | None = None) -> bool:
        """Whether the merges within two tokens come before any merge over their border.

        Undo the later merge of the two, again and again (of equals the right one), and look at
        the pair at the border: it must not merge before what has been undone.  ``merged`` is the
        rank of the pair itself where it is known to merge at last.
        """
        bound, by_right = len(self.rank) + 1, False
        if merged is None and (a, b) in self.rank:
            return False
        while True:
            x, y = self.parts.get(a), self.parts.get(b)
            if x is None and y is None:
                return True
            if y is None or x is not None and x[2] > y[2]:
                a, bound, by_right = x[1], x[2], False
            else:
                b, bound, by_right = y[0], y[2], True
            rank = self.rank.get((a, b))
            # A pair of equal rank goes to the leftmost place first.
            if rank is not None and (rank < bound or rank == bound and by_right):
                return False

    def neighbours(self, left: str, right: str) -> bool:
        """Whether two tokens stay apart when their text is merged."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[left, right] = self._apart(left, right)
        return known

    def state(self, prefix: str) -> tuple[str, int]:
        """Last token and token count of a prefix that goes on, kept for words that begin alike."""
        got = self.states.get(prefix)
        if got is not None:
            return got
        n = len(prefix)
        for size in self.open_lengths.get(prefix[-2:], ONE):
            if size > n or size > 1 and prefix[n - size:] not in self.open:
                continue
            token = prefix[n - size:]
            if size == n:
                got = token, 1
                break
            last, count = self.state(prefix[:n - size])
            if self.neighbours(last, token):
                got = token, count + 1
                break
        if len(self.states) > 300_000:
            self.states.clear()
        self.states[prefix] = got
        return got

    def closing(self, prefix: str, before) -> int:
        """Token count of a piece that ends here; ``before(i)`` is the state after ``i`` symbols."""
        n = len(prefix)
        for size in self.closed_lengths.get(prefix[-2:], ONE):
            if size > n or size > 1 and prefix[n - size:] not in self.closed:
                continue
            if size == n:
                return 1
            last, count = before(n - size)
            if self.neighbours(last, prefix[n - size:] + self.end):
                return count + 1
        raise AssertionError(prefix)

    def last_count(self, symbols: str) -> int:
        got = self.pieces.get(symbols)
        if got is None:
            if len(symbols) > CACHED_CHARS:
                return self.piece(symbols, last_only=True)[-1]
            got = self.closing(symbols, lambda i: self.state(symbols[:i]))
            if len(self.pieces) > CACHED // 2:
                self.pieces.clear()
            self.pieces[symbols] = got
        return got

    def piece(self, symbols: str, last_only: bool = False) -> list[int]:
        """Token count of the piece cut after 1, 2, … symbols, in one run over its symbols."""
        states: list[tuple[str, int]] = [("", 0)]
        closed = []
        for i in range(1, len(symbols) + 1):
            ending = symbols[max(0, i - 2):i]
            if not last_only or i == len(symbols):
                closed.append(self._step(symbols, i, states, self.closed_lengths.get(ending, ONE), self.closed, self.end)[1])
            states.append(self._step(symbols, i, states, self.open_lengths.get(ending, ONE), self.open, ""))
        return closed

    def _step(self, symbols, i, states, lengths, tokens, mark) -> tuple[str, int]:
        for size in lengths:
            token = symbols[i - size:i]
            if size > i or size > 1 and token not in tokens:
                continue
            last, count = states[i - size]
            if size == i or self.neighbours(last, token + mark):
                return token, count + 1
        raise AssertionError("no token ends here")

    def chunk(self, text: str) -> int:
        """Tokens of a text without white space; special strings in it are one token each."""
        if self.specials is None or "<" not in text:
            return self._ordinary(text)
        pieces, at = 0, 0
        for m in self.specials.finditer(text):
            pieces += self._ordinary(text[at:m.start()]) + 1
            at = m.end()
        return pieces + self._ordinary(text[at:])

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        return "".join([c.lower() for c in unicodedata.normalize("NFC", text)])

    def symbols(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return "".join([self.bytes[b] for b in piece.encode()])

    def _ordinary(self, text: str) -> int:
        text = self.normal(text)
        if text.isalpha():
            return self.last_count(self.symbols(text))
        if text[-1:] in CLOSING and text[:-1].isalpha():
            return self.last_count(self.symbols(text[:-1])) + self.last_count(text[-1])
        return sum([self.last_count(self.symbols(p)) for p in self.split.findall(text)])

    def count(self, text: str | None) -> int:
        """Tokens of the whole text: the last entry of its prefix counts."""
        return self.boundaries(text)[-1] if text else 0

    def chunks(self, text: str) -> list[str]:
        return regex.findall(r"\P{White_Space}+", text) if ODD_SPACE.search(text) else text.split()

    def boundaries(self, text: str) -> list[int]:
        """Counts of the prefixes that end before the first and after every chunk."""
        return [0, *accumulate(map(self.known, self.chunks(text)))]

    def known(self, chunk: str) -> int:
        got = self.cache.get(chunk)
        if got is not None:
            return got
        got = self.old.get(chunk)
        if got is None:
            got = self.chunk(chunk)
        if len(chunk) <= CACHED_CHARS:
            if len(self.cache) > CACHED // 2:
                self.old, self.cache = self.cache, {}
            self.cache[chunk] = got
        return got

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of ``text[:i]`` for every i from 0 to its length, exactly as the library gives it."""
        out, total = [0], 0
        space = regex.compile(r"\p{White_Space}+|\P{White_Space}+")
        for m in space.finditer(text):
            part = m.group()
            if part[0].isspace() and not ODD_SPACE.match(part):
                out += [total] * len(part)
                continue
            out += [total + n for n in self._within(part)]
            total = out[-1]
        return out

    def _within(self, chunk: str) -> list[int]:
        """Counts of a chunk's prefixes; one run of the programme where the chunk is one piece of letters."""
        if chunk.isalpha() and len(self.normal(chunk)) == len(chunk) and unicodedata.is_normalized("NFC", chunk):
            raw = [c.encode() for c in self.normal(chunk)]
            closed = self.piece(self.symbols(self.normal(chunk)))
            return [closed[end - 1] for end in accumulate(map(len, raw))]
        return [self.chunk(chunk[:i]) for i in range(1, len(chunk) + 1)]

    def fitting(self, text: str | None, limit: int) -> int:
        """Code points of the longest prefix with at most ``limit`` tokens that ends at a chunk's end or inside the next chunk."""
        if not text:
            return 0
        counts = self.prefix_counts(text)
        # Counts inside a chunk may fall back by a token, so the last one that fits is looked for.
        if counts[-1] <= limit:
            return len(text)
        running = list(accumulate(counts, max))
        return bisect_right(running, limit) - 1


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    with open(path, encoding="utf-8") as source:
        return PrefixCounter(source.read())


def _added(df: DataFrame, text: str, keep: tuple[str, ...], ddl: str, rows) -> DataFrame:
    kept = df.select(*keep, df[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small objects without cycles
        for batch in batches:
            held = {batch.schema.field(i).name: batch.column(i) for i in range(batch.num_columns - 1)}
            yield pa.RecordBatch.from_pydict(held | rows(batch.column(batch.num_columns - 1)))
        gc.enable()

    return kept.mapInArrow(run, f"{schema}, {ddl}")


def count_tokens(df: DataFrame, path: str, limit: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text; a null text has none.  No shuffle."""

    def rows(texts: pa.Array) -> dict[str, pa.Array]:
        tool = counter(path)
        values = texts.to_pylist()
        counts = [tool.count(t) for t in values]
        return {
            "n_bytes": pa.array([len(t.encode()) if t else 0 for t in values], pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()),
            "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
        }

    return _added(df, text, keep, "n_bytes bigint, n_tokens bigint, over_limit boolean", rows)


def prefix_table(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``prefix_tokens``: the token count of every prefix, by code points; a null text has [0]."""

    def rows(texts: pa.Array) -> dict[str, pa.Array]:
        tool = counter(path)
        return {"prefix_tokens": pa.array([tool.prefix_counts(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))}

    return _added(df, text, keep, "prefix_tokens array<int>", rows)


def truncate(df: DataFrame, path: str, limit: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``fitting_chars``: code points of the longest prefix all of whose prefixes have at most ``limit`` tokens."""

    def rows(texts: pa.Array) -> dict[str, pa.Array]:
        tool = counter(path)
        return {"fitting_chars": pa.array([tool.fitting(t, limit) for t in texts.to_pylist()], pa.int64())}

    return _added(df, text, keep, "fitting_chars bigint", rows)
