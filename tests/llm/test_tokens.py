"""Byte-level BPE, token counts and packing against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlift.llm import byte_bpe, packing, token_counts
from ledgerlift.session import written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = " \t\n\x1c\x85 abcABC'sllre012½éüß漢字🙂́ǅ<|endoftext|>"
KINDS = "doc_id long, text string, _text string, piece long"
EDGES = [None, "", " ", "\n \n", "a", "a" * 5000, "ab" * 700, "=_-" * 300, "é" * 99, "I'll go.  Now", "x<|endoftext|>Yes <|startoftext|>", "\x1c a\x1fb"]
SLOW = settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@pytest.fixture(scope="module")
def merger():
    return byte_bpe.merger(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def rank_encoder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def edge_table(spark, texts):
    rows = [(i, t, "other", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:1] + [(None, "no id", None, None)], KINDS)


@SLOW
@given(st.text(alphabet=st.sampled_from(ALPHABET), max_size=80))
def test_ids_are_the_librarys(merger, rank_encoder, text):
    assert np.frombuffer(merger.encode([text])[0], "<u4").tolist() == rank_encoder.encode_ordinary(text)


def test_long_pieces_and_round_trip(merger, rank_encoder):
    texts = [t or "" for t in EDGES] + random_texts(400, 3)
    coded = merger.encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [rank_encoder.encode_ordinary(t) for t in texts]
    assert [merger.decode(c).decode() for c in coded] == texts
    piece = bytes(random.Random(1).choice(b"abcdeth") for _ in range(3000))
    lanes = merger.merge_lanes([piece[i:i + 60] for i in range(0, 3000, 60)], 64)[0]
    for i, row in enumerate(lanes):
        assert [t for t in row.tolist() if t >= 0] == merger.merge_long(piece[60 * i:60 * i + 60])


def test_encode_frame(spark, merger, rank_encoder):
    found = byte_bpe.encode(edge_table(spark, EDGES), RANKS, public_tokenizers.PATTERN, keep=("doc_id", "piece")).collect()
    assert len(found) == len(EDGES) + 2
    for r in found:
        text = "no id" if r.doc_id is None else EDGES[r.doc_id] or ""
        assert bytes(r.decoded).decode() == text
        assert r.n_tokens == len(rank_encoder.encode_ordinary(text)) == len(r.ids) // 4
    empty = edge_table(spark, []).filter("false")
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN, digest=True).count() == 0


@SLOW
@given(st.text(alphabet=st.sampled_from(ALPHABET), max_size=40))
def test_every_prefix_has_the_librarys_count(counter, library, text):
    expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert counter.prefix_counts(text) == expected
    assert counter.count(text) == expected[-1]


@SLOW
@given(st.text(alphabet=st.sampled_from("aeinrstdh"), min_size=1, max_size=60))
def test_words_of_frequent_letters(counter, library, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_and_truncate_frames(spark, library):
    table = edge_table(spark, EDGES)
    for r in token_counts.count_tokens(table, WORD_BPE, 3).collect():
        text = "no id" if r.doc_id is None else EDGES[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 3)
    for r in token_counts.truncate(table, WORD_BPE, 3).filter("doc_id IS NOT NULL").collect():
        text = EDGES[r.doc_id] or ""
        counts = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        fits = next((i for i, c in enumerate(counts) if c > 3), len(text) + 1) - 1
        assert r.fitting_chars == fits
    prefixes = token_counts.prefix_table(table.filter("doc_id IN (0, 9)"), WORD_BPE).distinct().collect()
    assert {r.doc_id: len(r.prefix_tokens) for r in prefixes} == {0: 1, 9: len(EDGES[9]) + 1}
    assert token_counts.count_tokens(table.filter("false"), WORD_BPE, 3).count() == 0


def check_packing(found, capacity):
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_hold_the_librarys_ids(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(40)
    docs = docs.unionByName(edge_table(spark, EDGES).selectExpr("doc_id + 10000 AS doc_id", "text").filter("doc_id > 10000"))
    found = packing.token_pieces(docs, WORD_BPE, 64).collect()
    ids = {}
    for r in sorted(found, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(ids.setdefault(r.doc_id, [])) and r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        ids[r.doc_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    for r in docs.collect():
        assert ids[r.doc_id] == [*library.encode(r.text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("parts, options", [(1, {}), (7, {"fan_in": 2}), (9, {"fan_in": 3, "items": 50, "carry": 5}), (5, {"nearly_full": 0.5})])
def test_every_piece_has_its_place(spark, parts, options):
    rng = random.Random(parts)
    rows = [(i, 0, rng.choice([100, 100, rng.randint(1, 100), rng.randint(1, 30)])) for i in range(1500)]
    pieces = written(spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(parts), "pieces")
    found = packing.pack(pieces, 100, **options).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in found) == rows
    used = check_packing(found, 100)
    if not options.get("nearly_full") and "carry" not in options:
        assert used <= 1.03 * sum(r[2] for r in rows) / 100 + 1


@pytest.mark.parametrize("seed", [1, 2])
def test_bins_that_are_not_passed_on_cost_no_sequence(spark, seed):
    """Many bins more than half full, few small ones; only three bins go up from each task, or all."""
    rng = random.Random(seed)
    rows = [(i, 0, rng.choice([rng.randint(51, 70), rng.randint(51, 99), rng.randint(1, 45)]) if i % 7 else rng.randint(51, 60)) for i in range(900)]
    pieces = written(spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(9), "pieces")
    few, every = (check_packing(packing.pack(pieces, 100, fan_in=3, carry=c, items=40).collect(), 100) for c in (1, 50_000))
    assert few == every


def test_placing_holds_no_tokenizer_and_no_copy(monkeypatch):
    """Pieces are placed without the words of the tokenizing stage, and their ids go on in the batch they came in."""
    import pyarrow as pa

    from ledgerlift.llm import common

    monkeypatch.setattr(packing, "_base", lambda level: 0)
    common.claim("packing", packing.encoder.cache_clear)
    packing.encoder(WORD_BPE).encode(["some words"])
    ids = pa.array([b"a" * 400, None, b"c" * 200], pa.binary())
    given = [pa.RecordBatch.from_arrays([pa.array([100, 60, n], pa.int64()), ids], names=["length", "ids"]) for n in (50, 41)]
    found = list(packing._first(100, 6)(iter(given)))
    assert packing.encoder.cache_info().currsize == 0
    assert [b.column("ids").buffers()[2].address for b in found] == [ids.buffers()[2].address] * 2
    assert [list(zip(*(b.column(c).to_pylist() for c in ("length", "bin", "fill", "shift")))) for b in found] == [
        [(100, 0, 100, 0), (60, 2, 60, 0), (50, 4, 91, 0)], [(100, 1, 100, 0), (60, 3, 60, 0), (41, 4, 91, 50)]]


def test_packing_nothing(spark):
    pieces = packing.token_pieces(edge_table(spark, []).filter("doc_id IS NOT NULL"), WORD_BPE, 64)
    assert packing.pack(written(pieces, "none"), 64).count() == 0


@SLOW
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_takes_the_fullest_bin(lengths):
    bins = packing.best_fit(lengths, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 20 for b in bins)
    rooms, expected = [], 0
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(20 - n)
            expected += 1
    assert len(bins) == expected
