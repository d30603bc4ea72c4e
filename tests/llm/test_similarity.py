"""Jaccard join, fingerprints and vector neighbours against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from checks.compare import differences
from ledgerlift.llm import fingerprints, jaccard_join, neighbours, queries
from ledgerlift.llm.words import words as hash_words
from ledgerlift.llm.words import text_bytes

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = "doc_id long, text string, token long, id long"


def shingles(text, k):
    found = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(found[i:i + k]) for i in range(max(1, len(found) - k + 1))) if found else frozenset()


def reachable(nodes, linked):
    """Smallest node reachable, by repeated smallest labels."""
    label = {n: n for n in nodes}
    while True:
        before = dict(label)
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def brute_components(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    ids = sorted(d for d in sets if sets[d])
    linked = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                linked.append((a, b))
    return {d: len(s) for d, s in sets.items()}, reachable(sets, linked)


def table(spark, rows):
    return spark.createDataFrame([(d, t, 1, None) for d, t in rows], KINDS).repartition(5)


def made_up(seed, n=160):
    """Random texts, copies, near copies in chains and around one text, and a passage that a third shares."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, hot = text(40), text(120)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:
            words = hot[:]
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.6 and rows:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 2)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(vocabulary))
        elif kind < 0.8:
            words = text(rng.randint(10, 60)) + passage
        else:
            words = text(rng.randint(1, 200))
        rows.append((i * 7 % (10 * n) + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed, k, percent", [(1, 4, 85), (2, 5, 80), (3, 1, 50)])
def test_components_equal_brute_force(spark, seed, k, percent):
    rows = made_up(seed) + [(900_001, None), (900_002, ""), (900_003, " \n"), (900_004, "One two"), (900_005, "one  TWO"), (900_006, "one")]
    sizes, expected = brute_components(rows, k, percent)
    found = jaccard_join.join_classes(table(spark, rows), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {d: (sizes[d], expected[d]) for d in sizes}


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sizes, expected = brute_components(rows, 4, 85)
    found = jaccard_join.join_classes(docs, 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {d: (sizes[d], expected[d]) for d in sizes}


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_agree_with_their_sql(spark, folder, duck, name):
    assert differences(queries.QUERIES[name](spark, folder), duck, queries.SQL[name]) == []


def test_frequent_shingles_change_no_result(spark, monkeypatch):
    """Whatever counts as frequent, the order stays one order for all sets."""
    rows = made_up(5)
    _, expected = brute_components(rows, 4, 85)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 300)
    found = jaccard_join.join_classes(table(spark, rows), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_join_of_nothing_repeated_ids_and_rows_without_id(spark):
    assert jaccard_join.join_classes(table(spark, []), 4, 85).count() == 0
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (8, "a b c d e f"), (None, "x y z"), (None, "a b c d e f"), (9, None)]
    found = jaccard_join.join_classes(table(spark, rows), 4, 85).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found) == [
        (0, 1, 0), (0, 3, 3), (3, 3, 3), (3, 3, 3), (8, 3, 3), (9, 0, 9)]


def test_bitmaps_never_overrate_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 90)).astype(np.uint64)]))
        if not len(b):
            continue
        maps = [np.frombuffer(jaccard_join.bitmap(s), np.uint64) for s in (a, b)]
        held = jaccard_join._Rows(np.zeros((2, 5), np.int64), np.concatenate(maps), np.array([len(m) for m in maps]))
        assert held.distances(np.array([0]), np.array([1]))[0] <= len(np.setxor1d(a, b))


def test_words_are_hashed_as_cut():
    import pyarrow as pa

    texts = ["One two\tTHREE", None, "", "  x ", "one\vtwo é" + " " + "y" * 3000]
    data, offsets = text_bytes(pa.array(texts))
    hashes, lengths, rows = hash_words(data, offsets)
    cut = [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    assert rows.tolist() == [i for i, _ in cut] and lengths.tolist() == [len(w.encode()) for _, w in cut]
    assert len({(int(h)) for h in hashes}) == len({w for _, w in cut})


def test_fingerprints_estimate_similarity():
    rng = random.Random(4)

    errors = []
    for _ in range(120):
        a = ["w%d" % rng.randrange(10**6) for _ in range(rng.randint(60, 400))]
        b = a[:]
        for _ in range(rng.randint(0, 12)):
            b[rng.randrange(len(b))] = "x%d" % rng.randrange(10**6)
        x, y = fingerprints.fingerprints(pa.array([" ".join(a), " ".join(b)]))
        sa, sb = shingles(" ".join(a), 5), shingles(" ".join(b), 5)
        errors.append(fingerprints.likeness(x, y) - len(sa & sb) / len(sa | sb))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    short = fingerprints.fingerprints(pa.array(["one", "two", "one", "", None, " "]))
    assert short[0] == short[2] and fingerprints.likeness(short[0], short[1]) < 0.1 and short[3:] == ["", "", ""]
    assert fingerprints.likeness("", "") == 1.0 and fingerprints.likeness(short[0], "") == 0.0


@pytest.mark.parametrize("count, rows", [(1, 4096), (7, 2), (300, 16)])
def test_each_document_meets_the_next(spark, count, rows):
    rng = random.Random(count)
    docs = [(i * 3, None if i == 4 else " ".join("é%d" % rng.randrange(50) for _ in range(rng.randint(0, 30)))) for i in range(count)]
    found = {r.doc_id: r for r in fingerprints.with_successor(table(spark, docs + [(None, "x")]), rows).collect()}
    loose = found.pop(None)
    assert len(found) == count and loose.n_chars == 1
    assert loose.fingerprint == fingerprints.fingerprints(pa.array(["x"]))[0]
    assert loose.edited_sha256 is loose.edited_fingerprint is loose.near_edited is loose.near_next is None
    order = sorted(docs, reverse=True)
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % count][1] or ""
        half = len(t) // 2
        assert found[d].n_chars == len(t)
        assert found[d].edited_sha256 == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
        assert 0 <= found[d].near_edited <= 1 and 0 <= found[d].near_next <= 1
    by_text = {}
    for d, t in docs:
        assert by_text.setdefault(t or "", found[d].fingerprint) == found[d].fingerprint
    assert fingerprints.with_successor(table(spark, []), rows).count() == 0


def test_rows_without_id_are_all_fingerprinted(spark):
    found = fingerprints.with_successor(table(spark, [(None, "a b"), (None, "a b"), (None, None)])).collect()
    assert sorted(r.fingerprint for r in found) == ["", *fingerprints.fingerprints(pa.array(["a b", "a b"]))]


def test_repeated_ids_follow_each_other(spark):
    found = fingerprints.with_successor(table(spark, [(1, "a b"), (2, "c d"), (2, "e f"), (2, "e f")]), 1)
    assert sorted(r.doc_id for r in found.collect()) == [1, 2, 2, 2]


def brute_vectors(rows):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.linalg.norm(x)
    ids = sorted(good)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9]
    label = reachable([i for i, _ in rows], linked)
    return {i: (sum(i in p for p in linked), label[i]) for i, _ in rows}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(4)


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + (0.02 if i % 3 else 1.0) * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # copies
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None]), (2004, []), (2005, [1.0, 2.0]),
             (2006, [2.0, 4.0]), (2007, [1e38] * 16), (2008, [3e38] * 16), (2009, [float("inf")] * 16)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(vectors(spark, rows)).collect()}
    assert found == brute_vectors(rows)


def test_no_vectors(spark):
    assert neighbours.near_duplicates(vectors(spark, [])).count() == 0
    found = neighbours.near_duplicates(vectors(spark, [(5, None), (None, [1.0])])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in found) == [(0, 0, 0, True), (5, 0, 5, True)]


def nodes_of(spark, x):
    rows = [(i, len(v), bytes(np.asarray(v, float) / np.linalg.norm(v)), 1) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, dim int, vec binary, n long").repartition(4).localCheckpoint()


def test_pairs_are_found_however_many_partitions(spark, monkeypatch):
    """Isolated pairs just above the threshold, in a table of 80 partitions whose pivots exceed a block."""
    monkeypatch.setattr(neighbours, "PARTITION_ROWS", 100)
    monkeypatch.setattr(neighbours, "GROUP", 12)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.standard_normal((4000, 64))
    y -= (y * x).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    pairs = np.stack([x, 0.91 * x + np.sqrt(1 - 0.91 ** 2) * y], 1).reshape(-1, 64)
    _, labels = neighbours.descend(nodes_of(spark, pairs), 0.9, 9, neighbours.WIDTH, neighbours.TREES)
    component = {r.node: r.component for r in labels.collect()}
    met = sum(component.get(2 * i, -1) == component.get(2 * i + 1, -2) for i in range(4000))
    assert met >= 0.95 * 4000, met


def test_audit_sees_lost_pairs_beside_a_large_group(spark, monkeypatch):
    """A third of the vectors is one group; of the isolated pairs, one in a hundred vectors, every link is lost."""
    rng = np.random.default_rng(3)
    group = rng.standard_normal(32) * 3 + 0.3 * rng.standard_normal((1000, 32))
    pairs = np.repeat(rng.standard_normal((15, 32)), 2, axis=0) + 0.01 * rng.standard_normal((30, 32))
    x = np.concatenate([group, pairs, rng.standard_normal((1970, 32))])
    nodes = nodes_of(spark, x)
    counts = spark.createDataFrame([(i, 999) for i in range(1000)], "id long, links long")
    recall, enough = neighbours.audit(nodes, counts, 0.9)
    assert recall < 0.1 and enough
    whole = counts.union(spark.createDataFrame([(i, 1) for i in range(1000, 1030)], "id long, links long"))
    assert neighbours.audit(nodes, whole, 0.9) == (1.0, True)
    monkeypatch.setattr(neighbours, "MOST_AUDITED", 512)
    assert neighbours.audit(nodes.filter("id >= 1030"), counts.limit(0), 0.9) == (1.0, False)
