"""Exact self-join of documents by the Jaccard similarity of their word shingles, and its classes.

Set-relation skipping, as Spark jobs:

* Equal sets are one class before the join.
* Shingles have one global order: rare ones by hash, then the frequent ones.  Two similar sets share
  a shingle among the first ``n - ceil(t n) + 1`` of each; these go into index lists by shingle.
* A list is sorted by blocks of set size and, within a block, by the shingle's position in the set.
  Sizes that cannot fit are skipped as blocks, and a block is left at the first position from which
  too few shingles remain.  What is left is compared by parity bitmaps as long as the sets, whose
  distance never exceeds the sets' difference.
* First every set meets its nearest partner in each list only.  Sets that prove similar share a
  component, and with it all answers to the question what they reach; only partners in other
  components are looked at in the second pass.
* There the sets that are highly similar to the smallest of their component, their hub, stand
  behind it: a partner is compared with the hub once, and its answers for all sets behind the hub are
  derived from the few shingles in which they and it differ from the hub.  No pair of a group becomes a row.

Nothing is dropped or capped: whichever shingles count as frequent, the filters are exact.  Sets are
compared by 64-bit hashes of shingles.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import among, claim, components, runs
from ledgerlift.llm.words import batch_shingles, mix
from ledgerlift.session import written

#: A shingle is frequent if tasks have met it again so often; so many, the most frequent ones, are broadcast at most.
FREQUENT, MOST_FREQUENT = 64, 500_000


def least_share(size: np.ndarray | int, percent: int):
    """Smallest overlap of a set with a similar one: ceil(percent / 100 * size)."""
    return -(-size * percent // 100)


def prefix_length(size: int, percent: int) -> int:
    return size - least_share(size, percent) + 1


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap o of sets of these sizes with 100 o >= percent (a + b - o)."""
    return -(-(a + b) * percent // (100 + percent))


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each of b hash values, set if an odd number of shingles has it; b is the power of two at or below the set's size, 512 at least.

    Two bitmaps differ in at most as many bits as the sets in shingles.  The longer of two is folded to the shorter's length.
    """
    bits = max(512, 1 << max(len(hashes).bit_length() - 1, 0))
    counts = np.bincount((mix(hashes) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1).tobytes()


def _sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text of a batch."""
    for a, hashes, bounds in batch_shingles(texts, words):
        for i in range(len(bounds) - 1):
            yield a + i, np.unique(hashes[bounds[i]:bounds[i + 1]])


def signature(s: np.ndarray) -> int:
    """64 bits of the set; with the size they stand for the set."""
    return int(np.bitwise_xor.reduce(mix(s * np.uint64(0x9E3779B97F4A7C15))).view(np.int64))


def describe(docs: DataFrame, words: int, percent: int, flush: int = 4_000_000) -> DataFrame:
    """Two kinds of rows, written: a document's (doc_id, sig, size, map), and shingles that a task met again (sig, size: how often).

    Only shingles near the front of a set count, in order of hash, and equal sets of a batch count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        met, held = [], 0

        def again() -> pa.RecordBatch:
            nonlocal met, held
            token, n = np.unique(np.concatenate(met) if met else np.zeros(0, np.uint64), return_counts=True)
            met, held = [], 0
            token, n = token[n > 1], n[n > 1]
            return _rows(None, token.view(np.int64), n, None, len(token))

        for batch in batches:
            sig, size, maps, seen = [], [], [], set()
            for _, s in _sets(batch.column(1), words):
                n = len(s)
                sig.append(signature(s) if n else 0)
                size.append(n)
                maps.append(bitmap(s))
                if n and (sig[-1], n) not in seen:
                    seen.add((sig[-1], n))
                    front = prefix_length(n, percent)
                    met.append(s[:front + front // 3 + 4])
                    held += len(met[-1])
            yield _rows(batch.column(0), np.array(sig, np.int64), np.array(size, np.int64), maps, len(sig))
            if held > flush:
                yield again()
        yield again()

    return written(docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, sig bigint, size bigint, map binary"), "sets")


def _rows(doc, sig, size, maps, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, pa.int64()) if doc is None else doc, pa.array(sig, pa.int64()), pa.array(size, pa.int64()),
        pa.nulls(n, pa.binary()) if maps is None else pa.array(maps, pa.binary())], names=["doc_id", "sig", "size", "map"])


def frequent_shingles(described: DataFrame) -> np.ndarray:
    """Sorted hashes of frequent shingles, at most ``MOST_FREQUENT``: a bounded list for the driver.

    A shingle that occurs d times shows up twice in a task about d*d / (2 tasks) times, so a list longer than a few times the root
    of the number of tasks is found.
    """
    found = (described.filter("map IS NULL").groupBy("sig").agg(F.sum("size").alias("n")).filter(F.col("n") >= FREQUENT)
             .orderBy(F.desc("n"), "sig").limit(MOST_FREQUENT).select("sig").toPandas())
    return np.sort(found["sig"].to_numpy(np.int64).view(np.uint64))


def ordered_prefix(s: np.ndarray, frequent: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` shingles in the global order."""
    if not len(frequent):
        return s[:length]

    def is_frequent(part: np.ndarray) -> np.ndarray:
        at = np.searchsorted(frequent, part).clip(max=len(frequent) - 1)
        return frequent[at] == part

    front = s[:length + length // 3 + 8]
    rare = front[~is_frequent(front)]
    if len(rare) < length and len(front) < len(s):
        rare = s[~is_frequent(s)]
    if len(rare) >= length:
        return rare[:length]
    return np.concatenate([rare, s[is_frequent(s)][:length - len(rare)]])


def index_lists(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """Written rows (token, sig, size, pos) of the lists that hold at least two different sets.

    Equal sets are one row per batch.  Lists are formed by a shuffle on the token and streamed in order, so a
    long one is never held.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        for batch in batches:
            seen, parts, sigs, sizes = set(), [], [], []
            for _, s in _sets(batch.column(0), words):
                if not len(s) or (key := (signature(s), len(s))) in seen:
                    continue
                seen.add(key)
                parts.append(ordered_prefix(s, known.value, prefix_length(len(s), percent)))
                sigs.append(key[0])
                sizes.append(key[1])
            if parts:
                lengths = np.array([len(p) for p in parts])
                heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                yield _postings(np.concatenate(parts).view(np.int64), np.repeat(sigs, lengths), np.repeat(sizes, lengths),
                                np.arange(lengths.sum()) - np.repeat(heads, lengths))

    postings = docs.select("text").mapInArrow(post, POSTING).repartition("token").sortWithinPartitions("token", "size", "pos", "sig")
    return written(postings.mapInArrow(_shared_lists, POSTING), "lists")


POSTING = "token bigint, sig bigint, size int, pos int"


def _postings(token, sig, size, pos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(sig, pa.int64()), pa.array(size, pa.int32()),
                                       pa.array(pos, pa.int32())], names=["token", "sig", "size", "pos"])


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct rows of sorted lists, without lists of a single row."""
    waiting = None  # the last distinct row and whether an earlier row of its list went out
    for batch in batches:
        table = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
        if waiting is not None:
            table = np.concatenate([waiting[0][None, :], table])
        distinct = np.ones(len(table), bool)
        distinct[1:] = (table[1:] != table[:-1]).any(1)
        table = table[distinct]
        same = np.zeros(len(table) + 1, bool)  # as the row before
        same[1:-1] = table[1:, 0] == table[:-1, 0]
        if waiting is not None:
            same[0] = waiting[1]
        kept = same[:-1] | same[1:]
        kept[-1] = False  # decided with the next batch
        waiting = table[-1], bool(same[-2])
        out = table[kept]
        if len(out):
            yield _postings(out[:, 0], out[:, 1], out[:, 2], out[:, 3])
    if waiting is not None and waiting[1]:
        out = waiting[0][None, :]
        yield _postings(out[:, 0], out[:, 1], out[:, 2], out[:, 3])


class _Rows:
    """Rows (token, id, size, pos, group and, in the second pass, hub) of sorted lists with their bitmaps, end to end in 64-bit words."""

    def __init__(self, table: np.ndarray, words: np.ndarray, lengths: np.ndarray):
        self.table, self.words, self.lengths = table, words, lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "_Rows":
        numbers = [i for i in range(batch.num_columns) if i != 5]
        table = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in numbers])
        maps = batch.column(5).to_pylist()
        return cls(table, np.frombuffer(b"".join(maps), np.uint64), np.fromiter(map(len, maps), np.int64, len(maps)) // 8)

    def after(self, other: "_Rows | None") -> "_Rows":
        if other is None:
            return self
        return _Rows(np.concatenate([other.table, self.table]), np.concatenate([other.words, self.words]),
                     np.concatenate([other.lengths, self.lengths]))

    def part(self, rows: np.ndarray) -> "_Rows":
        at = np.repeat(self.starts[rows], self.lengths[rows])
        within = np.arange(len(at)) - np.repeat(np.cumsum(self.lengths[rows]) - self.lengths[rows], self.lengths[rows])
        return _Rows(self.table[rows], self.words[at + within], self.lengths[rows])

    def maps(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows of equal length, folded to ``width`` words."""
        found = self.words[self.starts[rows][:, None] + np.arange(self.lengths[rows[0]])]
        while found.shape[1] > width:
            half = found.shape[1] // 2
            found = found[:, :half] ^ found[:, half:]
        return found

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps differ, pair by pair."""
        out = np.zeros(len(a), np.int64)
        kinds, kind = np.unique(np.column_stack([self.lengths[a], self.lengths[b]]), axis=0, return_inverse=True)
        for k, (la, lb) in enumerate(kinds.tolist()):
            width = min(la, lb)
            rows = np.flatnonzero(kind.ravel() == k)
            step = max(1, (1 << 20) // max(la, lb))
            for i in range(0, len(rows), step):
                some = rows[i:i + step]
                out[some] = np.bitwise_count(self.maps(a[some], width) ^ self.maps(b[some], width)).sum(1)
        return out


def _candidates(percent: int, nearest: bool):
    """Pairs of each list that pass the block, position and bitmap filters; ``nearest``: for each set only the closest partner before it.

    Else one set of a pair, one that has another as its hub if there is one, is replaced by its hub: (a: hub, b: partner).

    Rows come by list, size and position.  All rows of a batch look one place back, then two, and so on; a row stops at
    the first row of another list or of a block of too small sets.  Of the last list the rows that may still find
    partners are kept for the next batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        for batch in batches:
            rows = _Rows.of(batch).after(held)
            first = 0 if held is None else len(held.table)
            token, ids, size, pos, group = rows.table.T[:5]
            hub = ids if nearest else rows.table[:, 5]
            lowest, rest = least_share(size, percent), size - pos
            active, back = np.arange(max(first, 1), len(size)), 0
            while len(active):
                back += 1
                active = active[active >= back]
                other = active - back
                here = (token[other] == token[active]) & (size[other] >= lowest[active])
                active, other = active[here], other[here]
                need = needed(size[other], size[active], percent)
                good = (rest[other] >= need) & (rest[active] >= need) & (group[other] != group[active]) & (ids[other] != ids[active])
                a, b = active[good], other[good]
                near = rows.distances(a, b) <= size[a] + size[b] - 2 * need[good]
                a, b = a[near], b[near]
                behind = hub[b] != ids[b]
                left.append(np.where(behind, hub[b], hub[a]))
                right.append(np.where(behind, ids[a], ids[b]))
                if nearest:
                    active = active[~np.isin(active, a)]
                if sum(map(len, left)) > 500_000:
                    yield _distinct(left, right)
                    left, right = [], []
            held = rows.part(np.flatnonzero((token == token[-1]) & (size >= lowest[-1]))) if len(size) else held
        if left:
            yield _distinct(left, right)

    return run


def _distinct(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.column_stack([np.concatenate(left), np.concatenate(right)]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def pairs_of(lists: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct pairs (a, b) from lists (token, id, size, pos, grp, map and, unless ``nearest``, hub), written."""
    rows = lists.select("token", "id", F.col("size").cast("bigint"), F.col("pos").cast("bigint"), "grp", "map", *([] if nearest else ["hub"]))
    dealt = rows.repartition("token").sortWithinPartitions("token", "size", "pos", "id")
    return written(dealt.mapInArrow(_candidates(percent, nearest), "a bigint, b bigint").distinct(), "pairs")


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Written rows (id, items): the shingle hashes of the documents in ``ids`` (column doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [s.view(np.int64) for _, s in _sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.list_(pa.int64()))], names=["id", "items"])

    return written(among(docs.select("doc_id", "text"), ids, "doc_id").mapInArrow(run, "id bigint, items array<bigint>"), "items")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, apart): sizes of both sets and the shingles that only one of them has."""
    a = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    b = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    return pairs.join(a, "a").join(b, "b").select(
        "a", "b", F.size("ia").alias("na"), F.size("ib").alias("nb"),
        F.concat(F.array_except("ia", "ib"), F.array_except("ib", "ia")).alias("apart"))


def similar(percent: int) -> F.Column:
    """100 * overlap >= percent * union, with twice the overlap = both sizes - shingles apart."""
    both = F.col("na") + F.col("nb")
    return (100 + percent) * (both - F.size("apart")) >= 2 * percent * both


#: Sets behind a hub that one task compares with its partners.
BEHIND = 20_000


def derived_links(asked: DataFrame, star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """A link (a, b) for each pair (a: hub, b: partner) of ``asked`` where the partner is similar to a set behind the hub.

    ``star`` has the sets behind a hub a as (a, b, nb, apart).  Two sets differ in the shingles in which one of them, but not
    both, differs from the hub.  So partners too far from the hub are left out, and for the others the differences of all
    sets from the hub decide.  The sets behind a large hub are dealt to several tasks.
    """
    hubs = asked.select("a").distinct()
    # A set behind the hub has at most 100 / percent times its size, and differs from it within the threshold.
    behind = F.col("na") * 100 / percent
    partners = compared(asked, sets).filter(
        F.size("apart") * (100 + percent) <= (100 - percent) * (F.col("nb") + 2 * behind + F.col("na")) + 1)
    sizes = sets.select(F.col("id").alias("a"), F.size("items").alias("n"))
    none = F.array().cast("array<bigint>")
    members = star.join(hubs, "a", "left_semi").select("a", F.lit(0).alias("kind"), F.col("b").alias("id"), F.col("nb").alias("n"), "apart").union(
        sizes.join(hubs, "a", "left_semi").select("a", F.lit(0).alias("kind"), F.col("a").alias("id"), "n", none.alias("apart")))
    members = written(members, "members")
    parts = written(members.groupBy("a").agg(F.ceil(F.count("*") / BEHIND).cast("int").alias("parts")), "parts")
    placed = members.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts").cast("bigint")).cast("int"))
    sent = partners.select("a", F.lit(1).alias("kind"), F.col("b").alias("id"), F.col("nb").alias("n"), "apart").join(parts, "a").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["a", "part", "kind", "id", "n", "apart"]
    dealt = placed.select(*columns).union(sent.select(*columns)).repartition("a", "part").sortWithinPartitions("a", "part", "kind", "id")
    return dealt.mapInArrow(_behind(percent), "a bigint, b bigint")


def _behind(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for rows in runs(batches, 2):
            kind, ids, n = (rows.column(c).to_numpy() for c in ("kind", "id", "n"))
            members = int((kind == 0).sum())
            if members in (0, len(kind)):
                continue
            lists = rows.column("apart").combine_chunks()
            lengths = lists.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            tokens = lists.flatten().to_numpy()
            cut = int(ends[members - 1])
            owner = np.repeat(np.arange(members), lengths[:members])
            order = np.argsort(tokens[:cut], kind="stable")
            sorted_tokens, owner = tokens[:cut][order], owner[order]
            for i in range(members, len(kind)):
                own = tokens[ends[i] - lengths[i]:ends[i]]
                low, high = np.searchsorted(sorted_tokens, own), np.searchsorted(sorted_tokens, own, side="right")
                hit = np.flatnonzero(high > low)
                shared = np.zeros(members, np.int64)
                if len(hit):
                    shared = np.bincount(np.concatenate([owner[low[h]:high[h]] for h in hit]), minlength=members)
                both = n[:members].astype(np.int64) + int(n[i])
                apart = lengths[:members] + lengths[i] - 2 * shared
                linked = np.flatnonzero((100 + percent) * (both - apart) >= 2 * percent * both)
                if len(linked):
                    found.append((int(ids[linked[0]]), int(ids[i])))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return run


def join_classes(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every row of ``docs`` (doc_id, text).

    Sets are similar if 100 * intersection >= percent * union.  ``class_id`` is the smallest id with an equal
    set, ``component_id`` the smallest id reachable by similar sets.  A text that is null or has no words has an
    empty set and is alone.  A row without id links nothing; it has the classes of rows with its set.  Rows of one id are rows of their own but one node.  Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    described = describe(docs, words, percent)
    rows = described.filter("map IS NOT NULL")
    classes = written(rows.filter("size > 0").groupBy("sig", "size").agg(F.min("doc_id").alias("id"), F.min("map").alias("map"))
                      .filter("id IS NOT NULL"), "classes")
    lists = index_lists(docs, frequent_shingles(described), words, percent)
    lists = lists.withColumn("size", F.col("size").cast("bigint")).join(classes, ["sig", "size"]).select("token", "id", "size", "pos", "map")
    lists = written(lists, "lists")

    pairs = pairs_of(lists.withColumn("grp", F.col("id")), percent, nearest=True)
    sets = shingle_sets(docs, _ends(pairs), words)
    links = written(compared(pairs, sets).filter(similar(percent)).select("a", "b"), "links")
    labels = written(components(links), "labels")

    spokes = labels.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    star = written(compared(spokes, sets).filter(similar(percent)), "star")
    hubs = written(labels.join(star.select(F.col("b").alias("node"), F.col("a").alias("hub")), "node", "left").select(
        "node", "component", F.coalesce("hub", "node").alias("hub")), "hubs")
    grouped = lists.join(hubs, lists["id"] == hubs["node"], "left").select(
        "token", "id", "size", "pos", F.coalesce("component", "id").alias("grp"), "map", F.coalesce("hub", "id").alias("hub"))
    asked = pairs_of(grouped, percent, nearest=False)
    second = written(derived_links(asked, star, shingle_sets(docs, _ends(asked), words), percent), "second")
    labels = components(links.union(second))

    found = classes.select("sig", "size", "id").join(labels, F.col("id") == F.col("node"), "left").select(
        "sig", "size", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id"))
    found = written(found, "found")
    return rows.select("doc_id", "sig", "size").join(found, ["sig", "size"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def _ends(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ends")
