"""Near-duplicate vectors by NN-descent, with an exact count inside what it connects.

* Equal vectors are one node.
* Random projection trees over the whole table give every node a first list of neighbours.  Their upper cuts are
  medians of a sample, and the leaves of these are the shuffle key; a node also goes to the leaves behind the cuts it
  lies next to.  Tasks cut their leaf further, with overlapping halves.
* Each round joins the neighbours of every node, forward and reverse, with each other and keeps for
  both the better ones.  A list holds ``width`` neighbours; one that is saturated, all of it at or above the
  threshold, may grow twofold each round by further neighbours above it.
  Members of a pivot beyond ``GROUP`` meet block by block, except those linked to the pivot, which it connects.
* The rounds end when the pairs above the threshold connect the same nodes to as many components as before and
  lists that are not saturated gain hardly any of them.
* These pairs connect nodes to components.  All links of a node lie in its component, so block
  products in double precision inside each component give every link, the exact number of them for
  each vector, and no false one; pairs never leave a task.
* An audit compares sampled vectors with all others, those with few found links apart from the rest, until enough of
  them have true links.  The mean recall of a node counts, of nodes with few and with many true links the lower one;
  below the wanted recall, or with too few links seen, the search goes on with new trees.
"""

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import components, runs
from ledgerlift.session import written

WIDTH, TREES, MAX_ROUNDS, LEAF = 8, 4, 12, 192
#: Rows of a tree's upper leaf without those lent to it; a block of a node's local join and of a component have about so many members.
PARTITION_ROWS, GROUP, BLOCK = 20_000, 512, 512
#: Sampled rows for each upper leaf; share of a task's rows on either side of a cut that go to both halves.
SAMPLED, OVERLAP = 32, 0.05
#: Lists grow in so many rounds; new pairs above the threshold, as a share of the linked nodes, that are hardly any.
GROWING, HARDLY = 6, 1e-3
#: Similarities are computed in single precision before the block products.
MARGIN = 1e-3
WANTED_RECALL = 0.95
#: Audited nodes with few found links and with more, at first and, of the former, at most; of them so many must have links.
AUDITED, MOST_AUDITED, LINKED = 256, 8192, 100
#: Links up to which a node has few; rows that an audit compares at a time.
FEW, AUDIT_ROWS = 8, 1024

NODE = "id bigint, dim int, vec binary"


def unit_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, dim, vec): vectors of length one in double precision, without null, zero or non-finite ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, vecs = [], [], []
            lists = batch.column(1)
            holes = lists.flatten().null_count > 0
            for vec_id, v in zip(batch.column(0).to_pylist(), lists):
                if not v.is_valid or not len(v.values) or holes and v.values.null_count or vec_id is None:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(all="ignore"):
                    top = np.abs(x).max()
                    if not np.isfinite(top) or top == 0:
                        continue
                    x = x / top
                    ids.append(vec_id)
                    dims.append(len(x))
                    vecs.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                             names=["id", "dim", "vec"])

    return df.select("vec_id", "embedding").mapInArrow(run, NODE)


def _matrix(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _cuts(x: np.ndarray, dim: int, parts: int, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, cuts and children of a random projection tree with ``parts`` leaves; a child below zero is the leaf ``~child``."""
    ways, cuts, kids = [], [], []

    def grow(rows: np.ndarray, parts: int, first: int) -> int:
        if parts == 1:
            return ~first
        way = np.zeros(dim)
        if len(rows) > 1:
            a, b = rng.choice(rows, 2, replace=False)
            way = x[a] - x[b]
        if way @ way < 1e-12:
            way = rng.standard_normal(dim)
        way = way / np.sqrt(way @ way)
        places = x[rows] @ way
        cut = float(np.quantile(places, parts // 2 / parts)) if len(rows) else 0.0
        at = len(ways)
        ways.append(way)
        cuts.append(cut)
        kids.append([0, 0])
        kids[at] = [grow(rows[places <= cut], parts // 2, first), grow(rows[places > cut], parts - parts // 2, first + parts // 2)]
        return at

    grow(np.arange(len(x)), parts, 0)
    return np.array(ways).reshape(-1, dim), np.array(cuts), np.array(kids, np.int64).reshape(-1, 2)


def _leaves(tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray, probes: int) -> np.ndarray:
    """Each row's leaf and those behind the cuts nearest to it, ``probes`` columns; -1 where it has met fewer cuts."""
    ways, cuts, kids = tree

    def down(at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        gaps, others = [], []
        while (inside := at >= 0).any():
            node = np.maximum(at, 0)
            off = np.einsum("ij,ij->i", x, ways[node]) - cuts[node]
            side = (off > 0).astype(np.int64)
            gaps.append(np.where(inside, np.abs(off), np.inf))
            others.append(kids[node, 1 - side])
            at = np.where(inside, kids[node, side], at)
        return ~at, gaps, others

    found = np.full((len(x), probes), -1, np.int64)
    if not len(ways):
        found[:, 0] = 0
        return found
    found[:, 0], gaps, others = down(np.zeros(len(x), np.int64))
    gaps, others, rows = np.stack(gaps), np.stack(others), np.arange(len(x))
    order = np.argsort(gaps, axis=0, kind="stable")
    for k in range(min(probes - 1, len(order))):
        leaf = down(others[order[k], rows])[0]
        found[:, k + 1] = np.where(np.isfinite(gaps[order[k], rows]), leaf, -1)
    return found


def single(nodes: DataFrame, seed: int, trees: int) -> tuple[DataFrame, int]:
    """Rows (id, dim, vec in single precision, place: own and next leaves in each upper tree), and the number of leaves of a tree."""
    parts = {r["dim"]: max(1, r["count"] // PARTITION_ROWS) for r in nodes.groupBy("dim").count().collect()}
    count = nodes.count()
    share = SAMPLED * sum(p for p in parts.values() if p > 1) / max(1, count)
    scale = 1 << 30
    sample = nodes.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(scale)) < int(share * scale)).filter(
        F.col("dim").isin([d for d, p in parts.items() if p > 1])).select("dim", "vec").toArrow()  # SAMPLED rows a leaf
    upper, probes = {}, 1
    for dim, p in parts.items():
        x = _matrix(sample.filter(pa.array(sample.column(0).to_numpy() == dim)).column(1).combine_chunks(), dim)
        upper[dim] = [_cuts(x, dim, p, np.random.default_rng([seed + t, dim])) for t in range(trees)]
        probes = max(probes, 1 + p.bit_length() // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(2), dim)
                place = np.stack([_leaves(tree, x, probes) for tree in upper[dim]], axis=1)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([row.tobytes() for row in x.astype(np.float32)], pa.binary()),
                    pa.array(place.tolist(), pa.list_(pa.list_(pa.int32())))], names=["id", "dim", "vec", "place"])

    rows = nodes.select("id", "dim", "vec").mapInArrow(run, "id bigint, dim int, vec binary, place array<array<int>>")
    return rows, max(1, sum(parts.values()))


EDGE = "u bigint, v bigint, sim float"


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float32())], names=["u", "v", "sim"])


def _tree(seed: int, width: int, threshold: float):
    """Leaves of a random projection tree over each upper leaf (dim, leaf, probe, id, vec), and each row's nearest in them.

    A row lent to an upper leaf lists there what is at or above the threshold only; its list comes from its own leaf.
    """

    def leaves(x: np.ndarray, rng) -> Iterator[np.ndarray]:
        todo = [np.arange(len(x))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                yield rows
                continue
            # Between two random rows, cut at the median, so the depth is bounded even for copies.
            a, b = rng.choice(rows, 2, replace=False)
            side = np.argsort(x[rows] @ (x[a] - x[b]), kind="stable")
            half, lap = len(rows) // 2, int(OVERLAP * len(rows))
            todo += [rows[side[:half + lap]], rows[side[half - lap:]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in runs(batches, 2):
            dim, leaf = (held.column(k)[0].as_py() for k in (0, 1))
            own, ids = held.column(2).to_numpy() == 0, held.column(3).to_numpy()
            x = _matrix(held.column(4).combine_chunks(), dim, np.float32)
            found = []
            for rows in leaves(x, np.random.default_rng([seed, dim, leaf])):
                if len(rows) < 2:
                    continue
                sims = x[rows] @ x[rows].T
                np.fill_diagonal(sims, -2)
                k = min(width, len(rows) - 1)
                near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                u, v, sim = np.repeat(rows, k), rows[near.ravel()], np.take_along_axis(sims, near, 1).ravel()
                kept = own[u] | (sim >= threshold - MARGIN)
                found.append((u[kept] * len(ids) + v[kept], sim[kept]))
            if not found:
                continue
            pair, first = np.unique(np.concatenate([pairs for pairs, _ in found]), return_index=True)
            sim = np.concatenate([sims for _, sims in found])[first]
            u, v = np.divmod(pair, len(ids))
            order = np.lexsort((-sim, u))
            u, v, sim = u[order], v[order], sim[order]
            kept = np.arange(len(u)) - np.searchsorted(u, u) < width
            yield _edges(ids[u[kept]], ids[v[kept]], sim[kept])

    return run


def best(edges: DataFrame, width: int, most: int, threshold: float) -> DataFrame:
    """Each node's ``width`` best neighbours, and up to ``most`` if they are at or above the threshold."""
    distinct = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return distinct.withColumn("rank", rank).filter(
        (F.col("rank") <= width) | (F.col("rank") <= most) & (F.col("sim") >= threshold - MARGIN)).drop("rank")


def _local_join(most: int):
    """Better neighbours among the members (pivot, i, j, dim, id, new, worst, block, vec) of each pair of a pivot's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 3):
            i, j, dim = (rows.column(k)[0].as_py() for k in (1, 2, 3))
            ids, new, worst, block = (rows.column(k).to_numpy() for k in (4, 5, 6, 7))
            x = _matrix(rows.column(8).combine_chunks(), dim, np.float32)
            sims = x @ x.T
            good = (new[:, None] | new[None, :]) & (sims > worst[:, None]) & (ids[:, None] != ids[None, :])
            if i != j:
                good &= block[:, None] != block[None, :]  # each block's own pairs are another group's
            if most < len(ids):  # no list takes more
                sims[~good] = -3
                near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
                a = np.repeat(np.arange(len(ids)), most)
                b = near.ravel()
                kept = good[a, b]
                a, b = a[kept], b[kept]
            else:
                a, b = np.nonzero(good)
            if len(a):
                yield _edges(ids[a], ids[b], sims[a, b])

    return run


def _members(lists: DataFrame, threshold: float) -> DataFrame:
    """(pivot, i, j, id, new, block): neighbours, forward and reverse, of every node with a new one, for each pair of blocks they meet in.

    More than ``GROUP`` members are dealt to blocks, those linked to the pivot, which are in one component, apart from the
    others.  Others meet all members, linked ones meet those of their own block and the others.
    """
    linked = F.col("sim") >= threshold - MARGIN
    both = lists.select(F.col("u").alias("pivot"), F.col("v").alias("id"), "new", linked.alias("linked")).union(
        lists.select(F.col("v").alias("pivot"), F.col("u").alias("id"), "new", linked.alias("linked")))
    both = both.groupBy("pivot", "id").agg(F.max("new").alias("new"), F.max("linked").alias("linked"))
    blocks = both.groupBy("pivot").agg(F.max("new").alias("any"), F.count("*").alias("n"), F.count_if("linked").alias("m")).filter("any").select(
        "pivot", (F.col("n") <= GROUP).alias("one"), F.ceil((F.col("n") - F.col("m")) / GROUP).cast("int").alias("others"),
        F.ceil(F.col("m") / GROUP).cast("int").alias("ties"))
    spot = F.when(F.col("one"), 0).when(F.col("linked"), F.col("others") + F.pmod(F.xxhash64("id"), F.col("ties").cast("bigint"))).otherwise(
        F.pmod(F.xxhash64("id"), F.greatest(F.col("others"), F.lit(1)).cast("bigint"))).cast("int")
    placed = both.join(blocks, "pivot").withColumn("block", spot)
    of_others = F.when(F.col("others") > 0, F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.array().cast("array<int>"))
    met = F.when(F.col("one"), F.array(F.lit(0))).when(F.col("linked"), F.concat(of_others, F.array("block"))).otherwise(
        F.sequence(F.lit(0), F.col("others") + F.col("ties") - 1))
    return placed.withColumn("met", F.explode(met)).select(
        "pivot", F.least("block", "met").alias("i"), F.greatest("block", "met").alias("j"), "id", "new", "block")


def descend(nodes: DataFrame, threshold: float, seed: int, width: int, trees: int,
            start: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Written neighbour lists (u, v, sim, new) after the last round, and the components of their pairs above the threshold."""
    rows, parts = single(nodes, seed, trees)
    single_nodes = written(rows, "single")
    found = None
    for t in range(trees):
        tree = single_nodes.select("dim", "id", "vec", F.posexplode(F.col("place")[t]).alias("probe", "leaf")).filter("leaf >= 0").select(
            "dim", "leaf", "probe", "id", "vec").repartition(parts, "dim", "leaf").sortWithinPartitions("dim", "leaf", "id").mapInArrow(
            _tree(seed + t, width, threshold), EDGE)
        found = tree if found is None else found.union(tree)
    found = found.withColumn("new", F.lit(True))
    if start is not None:
        found = found.union(start.withColumn("new", F.lit(False)))
    lists = written(best(found, width, width, threshold), "lists")
    labels, before = None, None
    for turn in range(1, MAX_ROUNDS + 1):
        most = width << min(turn, GROWING)
        # Saturated lists take what is at or above the threshold only.
        worst = written(lists.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("low")).filter(F.col("n") >= width).select(
            F.col("u").alias("id"), F.least("low", F.lit(threshold - MARGIN)).cast("float").alias("worst"), (F.col("low") >= threshold - MARGIN).alias("saturated")), "worst")
        members = _members(lists, threshold).join(single_nodes.join(worst, "id", "left").select(
            "id", "dim", "vec", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst")), "id")
        dealt = members.select("pivot", "i", "j", "dim", "id", "new", "worst", "block", "vec").repartition("pivot", "i", "j").sortWithinPartitions(
            "pivot", "i", "j", "id")
        better = dealt.mapInArrow(_local_join(most), EDGE).withColumn("new", F.lit(True))
        lists = written(best(lists.withColumn("new", F.lit(False)).unionByName(better), width, most, threshold), "lists")
        linked = lists.filter(F.col("sim") >= threshold - MARGIN)
        labels = written(components(linked.select(F.col("u").alias("a"), F.col("v").alias("b"))), "labels")
        now = labels.agg(F.count("*").alias("nodes"), F.count_if(F.col("node") == F.col("component")).alias("parts")).first()
        if now == before:
            gained = linked.filter("new").join(worst.filter("saturated").select(F.col("id").alias("u")), "u", "left_anti").count()
            if gained <= HARDLY * now["nodes"]:
                break
        before = now
    return lists, labels


def _blocks(threshold: float):
    """For each member of a pair of blocks (component, i, j, dim, id, n, block, vec): what it is linked with there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 4):
            i, j, dim = (rows.column(k)[0].as_py() for k in (1, 2, 3))
            ids, n, block = (rows.column(k).to_numpy() for k in (4, 5, 6))
            x = _matrix(rows.column(7).combine_chunks(), dim)
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if i != j:
                near &= block[:, None] != block[None, :]  # each block's own pairs are another group's
            label = ids.copy()
            while True:
                least = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(1))
                if (least == label).all():
                    break
                label = least
            links = near @ n
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(links[linked].astype(np.int64)), pa.array(label[linked])],
                                             names=["id", "links", "label"])

    return run


def links_within(nodes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Written rows (id, links, label) of every node for each pair of blocks in its component where it has links."""
    members = nodes.join(labels, nodes["id"] == labels["node"]).select("component", "dim", "id", "n", "vec")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("bigint")).cast("int"))
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "dim", "id", "n", "block", "vec")
    dealt = sent.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "dim", "id")
    return written(dealt.mapInArrow(_blocks(threshold), "id bigint, links bigint, label bigint"), "links")


def _true_links(nodes: DataFrame, queries: pa.Table, threshold: float) -> dict[int, int]:
    """Links of the queries (id, dim, vec) against all nodes."""
    ids, dims = queries.column(0).to_numpy(), queries.column(1).to_numpy()
    tables = {dim: (np.flatnonzero(dims == dim), _matrix(queries.filter(pa.array(dims == dim)).column(2).combine_chunks(), dim))
              for dim in np.unique(dims).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            own = batch.column(1).to_numpy()
            for dim, (rows, x) in tables.items():
                part = batch.filter(pa.array(own == dim))
                for a in range(0, part.num_rows, AUDIT_ROWS):
                    some = part.slice(a, AUDIT_ROWS)
                    q, r = np.nonzero(x @ _matrix(some.column(2), dim).T >= threshold)
                    other = ids[rows[q]] != some.column(0).to_numpy()[r]
                    np.add.at(total, rows[q[other]], some.column(3).to_numpy()[r[other]])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "links"])

    true = nodes.select("id", "dim", "vec", "n").mapInArrow(run, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("true"))
    return {r["id"]: r["true"] for r in true.collect()}  # a row for each query


def audit(nodes: DataFrame, counts: DataFrame, threshold: float) -> tuple[float, bool]:
    """Mean recall of a linked node's links, and whether enough nodes with links were seen to say so.

    Audited are nodes with few found links, where lost ones are, and nodes with more.  Weighted by how many such nodes there
    are, they give the recall of nodes with few and with many true links; the lower counts.  The audited with few found
    links grow until ``LINKED`` of them have true ones or all are audited.  1 if none has.
    """
    known = written(nodes.join(counts, "id", "left").select("id", "dim", "vec", F.coalesce("links", F.lit(0)).alias("found")), "audited")
    loose = F.col("found") <= FEW
    sizes = known.agg(F.count_if(loose).alias("loose"), F.count_if(~loose).alias("dense")).first()
    audited = AUDITED
    seen: list[tuple[int, int, float]] = []  # true links, found links, weight

    def look(pool: F.Column, size: int, wanted: int) -> list[tuple[int, int, float]]:
        queries = known.filter(pool).orderBy(F.xxhash64("id")).limit(wanted).toArrow()  # bounded
        if not queries.num_rows:
            return []
        true = _true_links(nodes, queries, threshold)
        return [(true[i], f, size / queries.num_rows) for i, f in zip(queries.column(0).to_pylist(), queries.column(3).to_pylist()) if true[i]]

    dense = look(~loose, sizes["dense"], AUDITED)
    while True:
        seen = look(loose, sizes["loose"], audited)
        enough = len(seen) >= LINKED or audited >= sizes["loose"]
        if enough or audited >= MOST_AUDITED:
            break
        audited = min(4 * audited, MOST_AUDITED)
    recalls = []
    for some in ([r for r in seen + dense if r[0] <= FEW], [r for r in seen + dense if r[0] > FEW]):
        if some:
            recalls.append(sum(min(1.0, f / t) * w for t, f, w in some) / sum(w for _, _, w in some))
    return min(recalls, default=1.0), enough


def near_duplicates(df: DataFrame, threshold: float = 0.9, width: int = WIDTH, trees: int = TREES, seed: int = 9,
                    attempts: int = 3) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``df`` (vec_id, embedding).

    Linked: cosine at or above the threshold, in double precision; vectors of different lengths never are.
    A null, empty or zero vector, one with null or non-finite components, or without id, has no links and is its own component.
    Equal vectors are linked, copies of one another.  Raises if no attempt reaches ``WANTED_RECALL``, and warns if
    even the last audit saw too few linked nodes to tell.
    """
    units = written(unit_vectors(df), "units")
    nodes = written(units.groupBy("dim", "vec").agg(F.min("id").alias("id"), F.count("*").alias("n")), "nodes")
    lists = None
    for attempt in range(attempts):
        lists, labels = descend(nodes, threshold, seed + 100 * attempt, width, trees, lists)
        found = links_within(nodes, labels, threshold)
        counts = written(found.groupBy("id").agg(F.sum("links").alias("links")), "counts")
        recall, enough = audit(nodes, counts, threshold)
        if enough and recall >= WANTED_RECALL:
            break
    else:
        if recall < WANTED_RECALL:
            raise RuntimeError(f"recall {recall:.3f} after {attempts} attempts")
        warnings.warn(f"not audited: under {LINKED} of {MOST_AUDITED} audited vectors with few found links have any", stacklevel=2)
    labels = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")))
    known = written(nodes.join(counts, "id", "left").join(labels, F.col("id") == F.col("node"), "left").select(
        "dim", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "known")
    ids = units.select(F.col("id").alias("vec_id"), "dim", "vec").join(known, ["dim", "vec"]).select("vec_id", "n_links", "component_id")
    rest = df.select("vec_id").join(ids.select("vec_id"), "vec_id", "left_anti").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ids.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
