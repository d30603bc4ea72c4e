"""Languages, quality, toxicity and shards: held-out accuracy, stated cases, balance."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import features, lang_id, quality, sharding, toxicity

MIDDLE = "/root/testdata/sf0.01"


def fold(doc, parts):
    return zlib.crc32(str(doc).encode()) % parts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MIDDLE}/labels.parquet")


def test_languages_of_held_out_documents(docs):
    found = {r.doc_id: r for r in lang_id.identify(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(found) == len(rows) and all(found[r.doc_id].held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    held = [found[r.doc_id].lang_pred == r.lang for r in rows if found[r.doc_id].held_out]
    assert np.mean(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_and_id_are_no_input(docs):
    """With the labels of held-out rows changed, and rows in another order, predictions stay."""
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang")))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(d).collect()} for d in (docs, other.repartition(3)))
    assert one == two


def test_mixed_documents_have_both_languages(spark, docs):
    model = lang_id.train(lang_id.training_rows(docs))
    halves = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max(F.struct(F.least(F.length("text"), F.lit(3000)).alias("n"), "text"))["text"].alias("text")).collect()}
    rows = [(1, halves["fr"][:2000] + " " + halves["de"][:1000]), (2, halves["en"][:1500])]
    found = {r.doc_id: r for r in lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {p.lang for p in found[1].langs} == {"fr", "de"} and found[1].lang_pred == "fr" and 0.5 < found[1].score < 0.85
    assert [p.lang for p in found[2].langs] == ["en"] and found[2].score > 0.95


def test_stated_cases_of_languages(spark, docs):
    model = lang_id.train(lang_id.training_rows(docs))
    rows = [(1, None, 1), (2, "", 1), (3, "12 !? \n", 1), (4, "Re.", 1), (4, "Re.", 1), (None, "the and", 1), (5, "é" * 100_000, 1)]
    found = lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string, score long"), model).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == 7 and [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0.0
    assert by[4].lang_pred in model[0] and by[None].lang_pred == "en"
    nothing = lang_id.train(lang_id.training_rows(docs.filter("false")))
    assert nothing[0] == []
    unlearned = lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string, score long"), nothing).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}
    assert lang_id.identify(docs.filter("false")).count() == 0


def test_proportions_raise_the_likelihood():
    rng = np.random.default_rng(1)
    table = np.log(rng.dirichlet(np.full(50, 0.3), 3).T + 1e-6)
    for mix in ([1, 0, 0], [0.7, 0, 0.3], [0.4, 0.3, 0.3]):
        grams = np.concatenate([rng.choice(50, int(2000 * m), p=np.exp(table[:, k]) / np.exp(table[:, k]).sum()) for k, m in enumerate(mix)])
        chosen, share, likelihood = lang_id.proportions(table[grams])
        assert set(chosen.tolist()) == {k for k, m in enumerate(mix) if m}
        assert abs(share.sum() - 1) < 1e-9 and likelihood >= table[grams].sum(0).max() - 1e-6


def test_quality_of_held_out_documents(docs, labels):
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    rows = labels.collect()
    held = [(found[r.doc_id].predicted, r.quality) for r in rows if found[r.doc_id].held_out]
    assert len(held) > 80 and all(found[r.doc_id].held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert np.mean([p == q for p, q in held]) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())


def test_sum_of_squares_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    size = quality.BUCKETS + len(features.STATISTICS)
    machine = quality.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(1), np.ones(1))
    index, value, bounds = rng.integers(0, size, 30), rng.normal(size=30), np.array([0, 12, 30])
    expected = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        i, x = index[a:b], value[a:b]
        pairs = sum(machine.factors[i[j]] @ machine.factors[i[k]] * x[j] * x[k] for j in range(len(i)) for k in range(j))
        expected.append(0.3 + machine.weights[i] @ x + pairs)
    assert np.allclose(machine.margin(index, value, bounds), expected)


EDGES = [(1, None), (2, ""), (3, "\n"), (3, "\n"), (4, "x" * 50_000), (None, "a b c")]


def test_stated_cases_of_classifiers(spark, docs, labels):
    table = spark.createDataFrame([(d, t, "s", 0.5) for d, t in EDGES], "doc_id long, text string, _text string, score double")
    for fn in (quality.classify, toxicity.classify):
        for known in (labels, labels.filter("false"), labels.filter("quality = 1 AND toxic = 0")):
            found = fn(table, known).collect()
            assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
            assert len({r.score for r in found if r.doc_id in (1, 2, 3)} | {0}) <= 3
        assert fn(table.filter("false"), labels).count() == 0
    odd = labels.union(spark.createDataFrame([(None, None, None), (1, None, None)], labels.schema)).union(labels.limit(5))
    assert quality.classify(docs.limit(50), odd).count() == toxicity.classify(docs.limit(50), odd).count() == 50


def test_toxic_documents_are_found(spark):
    """Marking words, and marking beginnings in another language's words, at varying density."""
    rng = np.random.default_rng(3)
    plain = ["w%d" % i for i in range(300)] + ["achtung", "vertrag", "stille"]
    rows, marks = [], []
    for i in range(3000):
        words = rng.choice(plain, rng.integers(20, 200)).tolist()
        toxic = int(rng.random() < 0.2)
        if toxic:
            bad = ["rotten", "vile"] if i % 2 else ["grmbl" + e for e in ("en", "ung", "er", "lich", "haft", "e")]
            for _ in range(rng.integers(1, 2 + len(words) // 15)):
                words[rng.integers(len(words))] = str(rng.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic if words != [] and any(w.startswith(("rotten", "vile", "grmbl")) for w in words) else 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    held = [(r, marks[d][2]) for d, r in found.items() if r.held_out]
    assert np.mean([r.predicted == t for r, t in held if t]) >= 0.97 and np.mean([r.predicted == t for r, t in held if not t]) >= 0.99
    assert all(r.predicted == int(r.grade > 0) and 0 <= r.severity <= toxicity.GRADES for r in found.values())
    severity = {d: r.severity for d, r in found.items()}
    share = {d: np.mean([w.startswith(("rotten", "vile", "grmbl")) for w in t.split()]) for d, t in rows}
    strong = [severity[d] for d in found if share[d] > 0.06]
    weak = [severity[d] for d in found if 0 < share[d] < 0.02]
    assert np.mean(strong) > np.mean(weak) + 0.5



def test_every_marking_word_counts(spark):
    """Documents with frequent marking words, of 350 buckets, and others with rarer ones only."""
    rng = np.random.default_rng(6)
    made = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(90)]
    frequent, rare = made[:50], made[50:]
    rows, marks = [], []
    for i in range(4000):
        words = ["w%d" % k for k in rng.integers(0, 300, 40)]
        kind = i % 10
        if kind < 3:
            words += rng.choice(rare if kind == 0 else frequent, 3, replace=False).tolist()
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(kind < 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = toxicity.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).filter("held_out").collect()
    for kind in (0, 1, 2):
        assert np.mean([r.predicted for r in found if r.doc_id % 10 == kind]) >= 0.95
    assert np.mean([r.predicted for r in found if r.doc_id % 10 > 2]) <= 0.01



def test_rows_without_marking_features_have_a_score():
    model = toxicity.Ordinal(np.array([5]), np.ones(1), np.ones(1), np.ones(1, bool), 1.0, np.array([1.0, 2.0, 3.0]))
    found = model.at_least(np.array([3, 9]), np.array([1, 2]), np.array([0, 1, 2]), np.array([4, 4]))
    assert np.allclose(found, toxicity.sigmoid(-model.thresholds))


def test_thresholds_are_ordered():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (800, 5)).astype(np.float32)
    level = np.clip((x.sum(1) + rng.normal(0, 0.5, 800)).round().astype(int) - 1, 0, toxicity.GRADES)
    weights, thresholds = toxicity.descend(x, level)
    assert (np.diff(thresholds) > 0).all() and (weights > 0).all()


def check_shards(found, rows, shards=40):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size) for r in found) == sorted((d if d is not None else -1, len((t or "").encode()) + 16) for d, t in rows)
    by = {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    return [sum(r.size for r in by.get(s, [])) for s in range(shards)], [len(by.get(s, [])) for s in range(shards)]


def test_shards_are_even(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sharding.shard(docs).collect()
    bytes_, counts = check_shards(found, rows)
    assert max(bytes_) <= 1.1 * np.mean(bytes_) and min(bytes_) >= 0.9 * np.mean(bytes_)
    assert max(counts) <= 1.3 * np.mean(counts)
    text = dict(rows)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in found)
    homes = {}
    for r in found:
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    size = Counter(t for _, t in rows)
    assert all(len(homes[t]) == 1 for t, n in size.items() if n == 1 or len(t.encode()) * n < 0.4 * np.mean(bytes_) and n < 0.4 * np.mean(counts))


def test_a_hot_group_is_split_over_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "UNITS_PER_TASK", 1000)
    rng = np.random.default_rng(5)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else "t%d " % i * int(rng.integers(1, 60))) for i in range(3000)] + [(None, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, shard int, slot int").repartition(6)
    bytes_, counts = check_shards(sharding.shard(docs).collect(), rows)
    assert max(bytes_) <= 1.05 * np.mean(bytes_) and min(bytes_) >= 0.95 * np.mean(bytes_)
    assert sharding.shard(docs.filter("false")).count() == 0
