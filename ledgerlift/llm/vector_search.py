"""Approximate nearest vectors with a hierarchical k-means tree.

* Equal vectors are one node that holds the smallest ids it needs: ties go to the smaller id, so no answer needs more.
* A tree of k-means splits is fitted for every vector length on a sample of at most ``SAMPLE_BYTES`` of it all; its leaves,
  at most ``MOST_LEAVES`` a tree, have about ``LEAF_ROWS`` nodes each, or as many more as the table is larger.  Every
  node goes to the leaf of the nearest centre at each level; leaves are dealt to blocks of ``BLOCK_ROWS``.
* A query walks its tree best bin first: a queue gives the unvisited branch with the nearest centre, the leaves come in
  that order, and the query is sent to the first ones.
* How many is calibrated: sampled queries are compared with all nodes, and visits are widened until their true neighbours
  lie in visited leaves in at least the wanted share.  All leaves give all neighbours.
* In a block, products pick candidates with a margin, whose cosines are then computed one by one from the vectors.

A null, empty or zero vector, one with null or non-finite components, or without id, takes no part; vectors of different
lengths do not meet.  A repeated row counts once.  An id with several vectors asks with each of them, and its own vectors
are no candidates.  An empty table has no rows.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import by_heavy_keys, checked, runs
from ledgerlift.session import written

TOP = 5
#: Bytes of the vectors in the sample that the trees are fitted on.
SAMPLE_BYTES = 48 << 20
BRANCHES, LEAF_ROWS, MOST_LEAVES, TURNS = 12, 256, 16_384, 8
#: Nodes of a leaf's block, queries that meet it at a time, and parts in which a leaf's queries are taken.
BLOCK_ROWS, QUERY_ROWS, QUERY_PARTS = 4096, 1024, 64
#: Queries of the calibration, share of their true neighbours in visited leaves, first visits and how they widen.
CALIBRATED, WANTED_RECALL, FIRST_VISITS, WIDER = 256, 0.97, 4, 1.5
#: Cosines of products may differ by so much from those computed one by one.
MARGIN = 1e-9

NODE = "id bigint, dim int, vec binary"


def scaled_vectors(df: DataFrame) -> DataFrame:
    """(id, dim, vec) of the vectors that take part, in double precision, scaled by a power of two so that squares are finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, vecs = [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if vec_id is None or not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    continue
                ids.append(vec_id)
                dims.append(len(x))
                vecs.append((np.ldexp(x, -int(np.frexp(top)[1])) + 0.0).tobytes())  # no negative zeros
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                             names=["id", "dim", "vec"])

    return df.select("vec_id", "embedding").mapInArrow(run, NODE)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` with those of ``b``, each computed alike wherever the pair stands."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


class Tree:
    """Centres of all branches; ``first`` is a branch's first child, or below zero the leaf ``~first``."""

    def __init__(self, x: np.ndarray, leaf_rows: float, seed: int):
        self.centres: list[np.ndarray] = [np.zeros(x.shape[1])]
        self.first, self.count, self.leaves = [-1], [0], 0
        rng = np.random.default_rng(seed)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop(0)
            parts = self._split(x[rows], min(BRANCHES, int(np.ceil(len(rows) / leaf_rows))), rng) if len(rows) > leaf_rows else []
            if len(parts) < 2:
                self.first[at] = ~self.leaves
                self.leaves += 1
                continue
            self.first[at], self.count[at] = len(self.centres), len(parts)
            for centre, own in parts:
                todo.append((len(self.centres), rows[own]))
                self.centres.append(centre)
                self.first.append(-1)
                self.count.append(0)
        self.centres = np.array(self.centres)
        self.first, self.count = np.array(self.first), np.array(self.count)

    @staticmethod
    def _split(x: np.ndarray, k: int, rng) -> list[tuple[np.ndarray, np.ndarray]]:
        """Centres and rows of the parts of k-means on unit vectors; empty ones go."""
        centres = x[rng.choice(len(x), k, replace=False)]
        for _ in range(TURNS):
            own = (x @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
            used = np.unique(own)
            centres = np.stack([x[own == c].mean(0) for c in used])
        own = (x @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        return [(centres[c], np.flatnonzero(own == c)) for c in np.unique(own)]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each unit vector reaches by the nearest centre at every level."""
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.first[at] >= 0)
            if not len(inner):
                return ~self.first[at]
            for node in np.unique(at[inner]):
                rows = inner[at[inner] == node]
                c = self.centres[self.first[node]:self.first[node] + self.count[node]]
                at[rows] = self.first[node] + (x[rows] @ c.T - 0.5 * (c * c).sum(1)).argmax(1)

    def walk(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        found, queue = [], [(0.0, 0)]
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            first = int(self.first[node])
            if first < 0:
                found.append(~first)
                continue
            off = self.centres[first:first + int(self.count[node])] - q
            for k, d in enumerate(np.einsum("ij,ij->i", off, off).tolist()):
                heapq.heappush(queue, (d, first + k))
        return found


def fit(nodes: DataFrame, leaf_rows: int, seed: int) -> dict[int, Tree]:
    """A tree for every vector length; lengths without a sampled vector have no entry and one leaf."""
    size = nodes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("vec")), F.lit(0)).alias("bytes")).first()
    share, scale = min(1.0, SAMPLE_BYTES / max(1, size["bytes"])), 1 << 30
    spread = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(scale))
    sample = nodes.filter(spread < int(share * scale)).select("dim", "vec").toArrow()  # bounded by SAMPLE_BYTES
    dims, found = sample.column(0).to_numpy(), {}
    for dim in np.unique(dims).tolist():
        x = _unit(_matrix(sample.filter(pa.array(dims == dim)).column(1).combine_chunks(), dim))
        found[dim] = Tree(x, max(leaf_rows * share, len(x) / MOST_LEAVES, 1.0), seed)
    return found


def placed(nodes: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Nodes with their ``leaf``."""
    sent = nodes.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, leaf = batch.column(1).to_numpy(), np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims).tolist():
                if dim in sent.value:
                    own = dims == dim
                    leaf[own] = sent.value[dim].leaf_of(_unit(_matrix(batch.filter(pa.array(own)).column(2), dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "dim", "vec", "leaf"])

    return nodes.select("id", "dim", "vec").mapInArrow(run, f"{NODE}, leaf int")


def walked(queries: DataFrame, trees: dict[int, Tree], visits: int) -> DataFrame:
    """Queries (id, dim, vec) with ``leaves``, the first ``visits`` of their walk."""
    sent = queries.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for dim, vec in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                q = _unit(np.frombuffer(vec, np.float64)[None])[0]
                found.append(sent.value[dim].walk(q, visits) if dim in sent.value else [0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=["id", "dim", "vec", "leaves"])

    return queries.select("id", "dim", "vec").mapInArrow(run, f"{NODE}, leaves array<int>")


def _nearest(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, cosine) of the ``top`` nearest nodes of every query and those within the margin of the last one."""
    sims = _unit(q) @ _unit(x).T
    k = min(top, len(ids))
    last = np.partition(sims, len(ids) - k, axis=1)[:, len(ids) - k]
    a, b = np.nonzero(sims >= last[:, None] - MARGIN)
    score = cosines(q[a], x[b])
    order = np.lexsort((ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    kept = np.arange(len(a)) - np.searchsorted(a, a) < top
    return queries[a[kept]], ids[b[kept]], score[kept]


FOUND = "query bigint, id bigint, score double"


def _found(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "id", "score"])


def _ranked(found: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top)


def true_neighbours(nodes: DataFrame, queries: pa.Table, top: int) -> DataFrame:
    """(query, id, score, rank): the ``top`` nearest of all ``nodes`` (id, dim, vec) to each of the bounded ``queries`` (id, dim, vec)."""
    ids, dims = queries.column(0).to_numpy(), queries.column(1).to_numpy()
    tables = {dim: (ids[dims == dim], _matrix(queries.filter(pa.array(dims == dim)).column(2).combine_chunks(), dim)) for dim in np.unique(dims).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).to_numpy()
            for dim, (asked, q) in tables.items():
                part = batch.filter(pa.array(own == dim))
                if part.num_rows:
                    yield _found([_nearest(part.column(0).to_numpy(), _matrix(part.column(2), dim), asked, q, top)])

    return _ranked(nodes.select("id", "dim", "vec").mapInArrow(run, FOUND), top)


def calibrate(nodes: DataFrame, queries: DataFrame, trees: dict[int, Tree], top: int, wanted: float) -> tuple[int, float]:
    """Visits with which the sampled queries' walks hold at least ``wanted`` of their true neighbours, and their share."""
    most = max((t.leaves for t in trees.values()), default=1)
    asked = queries.orderBy(F.xxhash64("id")).limit(CALIBRATED).toArrow()
    true = true_neighbours(nodes, asked, top).join(nodes.select("id", "leaf"), "id").select("query", "leaf").toArrow()  # CALIBRATED x top
    leaf: dict[int, list[int]] = {}
    for q, n in zip(true.column(0).to_pylist(), true.column(1).to_pylist()):
        leaf.setdefault(q, []).append(n)
    places = []
    for q, dim, vec in zip(*(asked.column(k).to_pylist() for k in range(3))):
        tree = trees.get(dim)
        order = {n: k for k, n in enumerate(tree.walk(_unit(np.frombuffer(vec, np.float64)[None])[0], tree.leaves))} if tree else {0: 0}
        places += [order[n] for n in leaf.get(q, [])]
    visits = min(FIRST_VISITS, most)
    while (share := float(np.mean(np.array(places) < visits)) if places else 1.0) < wanted and visits < most:
        visits = min(most, int(np.ceil(visits * WIDER)))
    return visits, share


def _blocks(top: int):
    """Nearest nodes of the queries in each block (dim, leaf, block, asks, id, vec): its nodes first, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, x = None, None, None
        for part in runs(batches, 4):
            dim, leaf, block, asks = (part.column(k)[0].as_py() for k in range(4))
            if not asks:
                place, ids, x = (dim, leaf, block), part.column(4).to_numpy(), _matrix(part.column(5).combine_chunks(), dim)
            elif place == (dim, leaf, block):
                for some in part.combine_chunks().to_batches(max_chunksize=QUERY_ROWS):
                    yield _found([_nearest(ids, x, some.column(4).to_numpy(), _matrix(some.column(5), dim), top)])

    return run


def search_nodes(nodes: DataFrame, queries: DataFrame, trees: dict[int, Tree], visits: int, top: int) -> DataFrame:
    """(query, id, score, rank) of the ``top`` nearest of ``nodes`` (id, dim, vec, leaf) in the visited leaves of each of ``queries``."""
    blocks = F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")
    sizes = checked(written(nodes.groupBy("dim", "leaf").agg(blocks), "leaf-sizes"))
    here = nodes.join(sizes, ["dim", "leaf"]).select(
        "dim", "leaf", F.pmod(F.xxhash64("id"), F.col("blocks").cast("bigint")).cast("int").alias("block"), F.lit(0).alias("asks"), "id", "vec")
    sent = walked(queries, trees, visits).withColumn("leaf", F.explode("leaves")).join(sizes, ["dim", "leaf"]).select(
        "dim", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        (F.pmod(F.xxhash64("id"), F.lit(QUERY_PARTS)) + 1).cast("int").alias("asks"), "id", "vec")
    dealt = here.union(sent).repartition("dim", "leaf", "block").sortWithinPartitions("dim", "leaf", "block", "asks")
    return _ranked(dealt.mapInArrow(_blocks(top), FOUND), top)


def search(df: DataFrame, asks: Column, top: int = TOP, wanted: float = WANTED_RECALL, leaf_rows: int = LEAF_ROWS, seed: int = 12) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``df`` (vec_id, embedding) that fulfils the condition ``asks`` on its
    ``vec_id`` the ``top`` nearest other rows found, nearest first, ties by ``vec_id``."""
    units = written(scaled_vectors(df).distinct(), "vectors")
    # An answer that leaves out one id needs one node more than it has ranks, and of each node so many ids.
    need = top + 1
    first = F.row_number().over(Window.partitionBy("dim", "vec").orderBy("id"))
    least = units.withColumn("k", first).filter(F.col("k") <= need).select("dim", "vec", "id")
    nodes = written(least.groupBy("dim", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                    .select(F.col("ids")[0].alias("id"), "dim", "vec", "ids"), "nodes")
    trees = fit(nodes, leaf_rows, seed)
    inside = written(placed(nodes, trees), "leaves")
    pairs = written(units.withColumnRenamed("id", "vec_id").filter(asks).select(F.col("vec_id").alias("query_id"), "dim", "vec"), "asking")
    many = pairs.groupBy("dim", "vec").agg(F.count("*").alias("n"))
    queries = written(many.join(nodes, ["dim", "vec"]).select("id", "dim", "vec", "n", F.sha2("vec", 256).alias("digest")), "queries")
    visits, _ = calibrate(inside, queries, trees, need, wanted)
    found = search_nodes(inside, queries, trees, visits, need)
    answers = written(found.join(nodes.select("id", "ids"), "id").groupBy("query").agg(
        F.collect_list(F.struct(F.col("score"), F.col("ids"))).alias("near")).join(queries.select(F.col("id").alias("query"), "digest", "n"), "query")
        .select("digest", "n", "near"), "answers")
    asked = pairs.select("query_id", F.sha2("vec", 256).alias("digest"))
    each = by_heavy_keys(asked, answers, "digest", pairs.count()).select("query_id", "digest", F.explode("near").alias("near")).select(
        "query_id", "digest", "near.score", F.explode("near.ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
