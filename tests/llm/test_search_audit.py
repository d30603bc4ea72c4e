"""Lexical search, vector search and the filter audit against brute force and SQL."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from ledgerlift.llm import filter_audit, lexical, queries, vector_search
from ledgerlift.llm.common import by_heavy_keys
from ledgerlift.session import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", ["op11_lexical_search", "op13_filter_audit"])
def test_sql(spark, folder, duck, name):
    assert differences(queries.QUERIES[name](spark, folder), duck, queries.SQL[name]) == []


# Lexical search


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, top):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(k for _, _, k in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    found = []
    for item, own in wanted.items():
        scored = []
        for d, c, k in counted:
            m = 100 - 50 + (50 * k * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda r: r[:3])
        found += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(scored[:top])]
    return found


def made_up_docs(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(120)] + ["Ünï", "日本", "ÀB"]
    rows = []
    for i in range(n):
        own = [rng.choice(vocabulary[:rng.choice([5, 40, 123])]) for _ in range(rng.choice([0, 1, 3, 30, 200]))]
        rows.append((i, rng.choice([" ", "-", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in own)))
    rows += [(1000 + i, rows[7][1] + " w3 w4 Zz") for i in range(60)]  # ties across the cut
    rows += [(5, rows[5][1]), (None, "w3 w4 w9"), (None, "w3 w4 w9"), (2000, None), (2001, "..."), (2002, "w1 " * 5000 + "w2")]
    return rows


ITEMS = [(1, "w3, W4 zZ"), (2, None), (3, "nothing here"), (4, "w0 w1 w2 w3 日本 ünï"), (4, "w9"), (None, "w5"), (5, "w0 w0 w0")]


def lexical_rows(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item int, score int").repartition(5)
    return [tuple(r) for r in lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), **more).select(
        "item_id", "rank", "doc_id", "score").collect()]


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("top", [1, 50])
def test_lexical_brute_force(spark, top):
    docs = made_up_docs(1)
    assert by_key(lexical_rows(spark, docs, ITEMS, top=top)) == by_key(brute_search(docs, ITEMS, top))


def test_lexical_tiles_and_blocks(spark, monkeypatch):
    """One term a tile, few documents, one item a block, texts cut into small slices."""
    docs = made_up_docs(2, 80)
    for name, value in (("TILE_TERMS", 1), ("TILE_DOCS", 7), ("BLOCK_CELLS", 4), ("SLICE", 5)):
        monkeypatch.setattr(lexical, name, value)
    assert len(list(lexical.blocks(lexical.item_terms(spark.createDataFrame(ITEMS, "item_id long, text string"))))) == 5
    assert by_key(lexical_rows(spark, docs, ITEMS)) == by_key(brute_search(docs, ITEMS, 50))


def test_lexical_partial_sums_are_exact():
    """However large the weights, a tile's terms cannot sum to 2**53."""
    for top in (0, 1, 25_000, 10**8, 8 * 10**9):
        step = lexical.tile_terms(np.array([top]))
        assert step == 1 or step * top * lexical.IMPACT < lexical.EXACT
    rng = np.random.default_rng(3)
    w, impacts = rng.integers(0, 25_000, (3, 4000)), rng.integers(0, 10**6, 4000)
    rows, cols = np.zeros(4000, np.int64), np.arange(4000)
    assert (lexical.tile_scores(w.astype(float), cols, rows, impacts, 1, 2048)[:, 0] == w @ impacts).all()


def test_lexical_empty(spark):
    assert lexical_rows(spark, [], ITEMS) == [] and lexical_rows(spark, [(1, "w3")], []) == []
    assert lexical_rows(spark, [(1, None)], ITEMS) == []


# Vector search


def brute_nearest(rows, top):
    """Answers as (query, rank, id, score) of distinct rows, cosines in double precision."""
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    found = []
    for i, v in kept:
        if i % 50:
            continue
        near = []
        for j, w in kept:
            if j != i and len(w) == len(v):
                a, b = np.array(v), np.array(w)
                near.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 12), j))
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:top])]
    return sorted(found)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, 4.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(4)


def nearest(spark, rows, **more):
    got = vector_search.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, **more)
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in got.collect())


def test_vector_search_all_leaves_is_exact(spark):
    """Copies of one vector, halves and doubles of others, odd rows; with every leaf visited nothing is lost."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).round(3).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(120)]  # a third are copies, queries among them
    rows += [(500 + i, [2.0 * x for x in rows[3][1]]) for i in range(8)]
    rows += [(700, None), (750, []), (800, [0.0] * 6), (850, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (900, [float("nan")] * 6), (950, [float("inf")] + [1.0] * 5)]
    rows += [(1000, [1.0, 2.0]), (1001, [1.0, 2.0]), (1050, [1.0] * 5), (None, rows[0][1]), rows[50], rows[50], (1100, [1e200] * 6), (1101, [1e-200] * 6)]
    exact = {i: v for i, v in rows}
    assert exact[1050] and nearest(spark, rows, wanted=1.1, leaf_rows=20) == brute_nearest(
        [(i, v if i not in (1100, 1101) else [1.0] * 6) for i, v in rows], 5)


def test_vector_search_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 24))
    rows = [(i, (centres[i % 30] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(3000)]
    got, true = nearest(spark, rows, leaf_rows=40), brute_nearest(rows, 5)
    assert len(got) == len(true)
    assert len({r[:1] + r[2:3] for r in got} & {r[:1] + r[2:3] for r in true}) >= 0.9 * len(true)
    assert {r[:1] + r[2:] for r in got if r[:1] + r[2:3] in {t[:1] + t[2:3] for t in true}} <= {r[:1] + r[2:] for r in true}


def test_visits_widen_until_recall(spark):
    """Without clusters few visits are too few; the walk's order of leaves is complete."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((2000, 16))
    nodes = written(vector_search.scaled_vectors(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])), "nodes")
    trees = vector_search.fit(nodes, 20, 1)
    tree = trees[16]
    assert sorted(tree.walk(x[0] / np.linalg.norm(x[0]), tree.leaves)) == list(range(tree.leaves))
    placed = written(vector_search.placed(nodes, trees), "placed")
    few, _ = vector_search.calibrate(placed, nodes, trees, 5, 0.3)
    many, share = vector_search.calibrate(placed, nodes, trees, 5, 0.95)
    assert few < many <= tree.leaves and share >= 0.95


def test_vector_search_empty(spark):
    assert nearest(spark, []) == [] and nearest(spark, [(50, None)]) == [] and nearest(spark, [(50, [1.0])]) == []


# Filter audit


def brute_audit(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    rows = []
    for d, text, part in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t]}
        own = [(q, x) for i, q, x in labels if i is not None and i == d]
        rows.append((part or "", {f for f in fails if fails[f]}, any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    found = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                lines.append((f, "".join(order), k + 1, len(left), len(gone), sum(f in r[1] for r in own) - len(gone),
                              sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        found += [(part, *line[1:], shapley[line[0]]) for line in lines]
    return sorted(found)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, docs, labels):
    d = spark.createDataFrame([(i, t, p, 1, "x") for i, t, p in docs], "doc_id long, text string, lang string, row int, digest string").repartition(3)
    return sorted(tuple(r) for r in filter_audit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).select(COLUMNS).collect())


def test_filter_audit_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for i in range(200):
        words = ["w%d" % rng.randrange(rng.choice([20, 5000])) for _ in range(rng.choice([3, 99, 100, 300]))]
        if rng.random() < 0.3:
            words = [w.upper() + "ABC" for w in words]
        if rng.random() < 0.2:
            words.append(rng.choice("#$%&*|"))
        docs.append((i, rng.choice([" ", "\n", "\x0b"]).join(words), rng.choice(["en", "de", None, ""])))
    docs += [(500 + i, docs[3][1], rng.choice(["en", "de"])) for i in range(90)]  # a third are copies
    docs += [(None, docs[3][1], "en"), (None, None, None), (3, docs[3][1], "en"), (3, docs[4][1], "de"), (900, None, "fr"), (901, "", "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 600, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    assert audited(spark, docs, labels) == brute_audit(docs, labels)


def test_filter_audit_empty(spark):
    assert audited(spark, [], []) == []
    assert audited(spark, [(1, "a b", "en")], []) == brute_audit([(1, "a b", "en")], [])


def test_word_counts_of_long_texts(monkeypatch):
    """Sliced and hashed counts are those of the whole text."""
    rng = random.Random(9)
    text = "".join(rng.choice(["a", "bb", "ccc ", " ", "\n", "\x0b", "é"]) for _ in range(3000)).encode()
    whole = filter_audit.word_counts(text)
    monkeypatch.setattr(filter_audit, "SLICE", 17)
    assert filter_audit.word_counts(text) == whole
    monkeypatch.setattr(filter_audit, "HASHED", 100)
    assert filter_audit.word_counts(text) == whole
    assert filter_audit.word_counts(b"x" * 200) == (1, 1) and filter_audit.word_counts(b"x" * 40 + b" ") == (1, 1)


def test_heavy_keys(spark, rows):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 2), (None, 3)], "k string, v int")
    totals = written(spark.createDataFrame([("a", 7, 50), ("b", 8, 1)], "k string, t int, n long"), "totals")
    assert rows(by_heavy_keys(df, totals, "k", 30_000), "k", "v", "t") == rows(df.join(totals.drop("n"), "k", "left"), "k", "v", "t")
