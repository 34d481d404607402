"""Exact similarity join of documents by shingle sets, with R-trees over count vectors."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.graph import components
from panelwise.llm.shared import hashed_words, mix, pair, signed, slices, store

#: Coordinates of a count vector.
GROUPS = 64
#: Shingles of the sets that are compared in one task; a larger bundle is cut into blocks.
BLOCK_SHINGLES = 1_000_000
_LEAF = 16
#: Shingles that are looked up at a time when overlaps are counted, at first and at most.
_FEW_SHINGLES, _MANY_SHINGLES = 1 << 12, 1 << 18
_SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: The region of ``prefixes`` holds this many times the share of its shingles that a set may lack in a similar one.
REGION = 2.25
#: A shingle of so many sets is not told from more frequent ones.
FREQUENT = 64


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin."""
    words, begins = hashed_words(column, lower=True)
    joined = words
    for k in range(1, size):
        joined = pair(joined[: len(words) - k], words[k:])
    out = []
    for a, b in zip(begins[:-1], begins[1:]):
        if b - a >= size:
            out.append(np.unique(joined[a : b - size + 1]))
        elif b > a:
            one = words[a : a + 1]
            for k in range(1, b - a):
                one = pair(one, words[a + k : a + k + 1])
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(words[:0])
    ends = np.cumsum([0, *map(len, out)])
    return (np.concatenate(out) if out else words[:0]), ends


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[ends[1:]] - total[ends[:-1]]


def _names(hashes: np.ndarray, ends: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes that name a set."""
    n = np.diff(ends).astype(np.uint64)
    return tuple(pair(_sums(mix(hashes ^ np.uint64(s + 2 * seed)), ends), n) for s in _SEEDS)


def prefixes(hashes: np.ndarray, ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, shingle, spare) of the shingles by which a set may meet similar ones.

    All shingles have one order: first those of a fixed region of the hash space, rare ones before frequent ones, then the
    others; ties by hash. A set similar to another lacks at most n - ceil(n p / 100) of its n shingles there, so the two
    share one of their first n - ceil(n p / 100) + 1 (prefix filtering, which holds for any common order). The region has
    about twice as many shingles as that; if a set has too few there, the first of the others are added. ``spare`` is
    how many of the most frequent of the region's shingles are beyond the prefix.
    """
    sizes = np.diff(ends)
    need = np.where(sizes > 0, sizes + (-sizes * percent) // 100 + 1, 0)
    share = min(1.0, REGION * (100 - percent) / 100)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = hashes <= np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))
    held = np.bincount(owner[inside], minlength=len(sizes))
    taken = np.arange(len(hashes)) - ends[:-1][owner] < np.maximum(held, need)[owner]  # a set's hashes are sorted
    return owner[taken], hashes[taken], np.maximum(held - need, 0)[owner[taken]]


class CountTree:
    """R-tree over count vectors: boxes keep the largest count of each coordinate and the range of set sizes.

    The boxes of a level are rows of one table, so that a search tests all boxes that it reaches in a level at once. As labels
    only merge, a box whose sets have one label is known by the least and greatest label in it.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, percent: int) -> None:
        self.percent = percent
        self.order, cuts = self._dealt(vectors, sizes)
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.place = np.empty(len(sizes), dtype=np.int64)
        self.place[self.order] = np.arange(len(sizes))
        #: From the leaves to the root: where each box's sets or boxes begin (one more at the end), largest counts, least and greatest size.
        self.levels = [(cuts, *self._boxes(cuts, self.vectors, self.sizes, self.sizes))]
        while len(cuts) - 1 > _LEAF:
            _, tops, least, most = self.levels[-1]
            cuts = np.append(np.arange(0, len(cuts) - 1, _LEAF), len(cuts) - 1)
            self.levels.append((cuts, *self._boxes(cuts, tops, least, most)))
        self.labels: list[tuple[np.ndarray, np.ndarray]] | None = None

    @staticmethod
    def _boxes(cuts: np.ndarray, tops: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = cuts[:-1]
        return np.maximum.reduceat(tops, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)

    @staticmethod
    def _dealt(vectors: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sets in the order of leaves, and where leaves begin: halved by what differs most, size or a coordinate."""
        out, todo = [], [np.arange(len(sizes))]
        while todo:
            ids = todo.pop()
            if len(ids) <= _LEAF:
                out.append(ids)
                continue
            spread = vectors[ids].max(axis=0).astype(np.int64) - vectors[ids].min(axis=0)
            by = sizes[ids] if np.ptp(sizes[ids]) >= spread.max() else vectors[ids, int(spread.argmax())]
            ids = ids[np.argsort(by, kind="stable")]
            todo += [ids[len(ids) // 2 :], ids[: len(ids) // 2]]
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def relabel(self, label: np.ndarray) -> None:
        """The labels that hold from now on."""
        self.labels = []
        low = high = label[self.order]
        for cuts, *_ in self.levels:
            low, high = np.minimum.reduceat(low, cuts[:-1]), np.maximum.reduceat(high, cuts[:-1])
            self.labels.append((low, high))

    def near(self, k: int, label: np.ndarray | None = None) -> np.ndarray:
        """Sets that may be similar to set ``k``: the summed coordinate minima bound the overlap from above. Sets of its own
        label are left out. Boxes go by the labels of the last ``relabel``, which may be older than ``label``."""
        x, n, p = self.vectors[self.place[k]], int(self.sizes[self.place[k]]), self.percent
        if label is not None and self.labels is None:
            self.relabel(label)
        at = np.arange(len(self.levels[-1][0]) - 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            cuts, tops, least, most = self.levels[depth]
            fits = (most[at] * 100 >= n * p) & (least[at] * p <= n * 100)
            if label is not None:
                low, high = self.labels[depth]
                fits &= (low[at] != label[k]) | (high[at] != label[k])
            at = at[fits]
            at = at[(100 + p) * np.minimum(tops[at], x).sum(axis=1, dtype=np.int64) >= p * (n + least[at])]
            at = _spans(cuts[at], cuts[at + 1] - cuts[at])
            if not len(at):
                return at
        if label is not None:
            at = at[label[self.order[at]] != label[k]]
        return self.order[at[(100 + p) * np.minimum(self.vectors[at], x).sum(axis=1, dtype=np.int64) >= p * (self.sizes[at] + n)]]


def _spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of each span, one span after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def link_sets(sets: list[np.ndarray], percent: int, labels: list | None = None, asking: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Verified links that join all sets which links join; sets already known to be joined share a label.

    The sets that the tree finds near a set are verified some at a time, more each time: links found first make others needless.
    """
    if not sets:
        return []
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    names, shingles = np.unique(np.concatenate(sets), return_inverse=True)
    asked = np.zeros(len(names), dtype=bool)  # the shingles of the set that asks
    vectors = np.zeros((len(sets), GROUPS), dtype=np.int32)
    for i, s in enumerate(sets):
        vectors[i] = np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    tree = CountTree(vectors, sizes, percent)
    label = np.arange(len(sets)) if labels is None else np.unique(np.array(labels), return_inverse=True)[1]
    tree.relabel(label)
    out, moved = [], 0  # sets that have another label than the tree knows
    for i in range(len(sets)) if asking is None else np.flatnonzero(asking):
        left = tree.near(i, label)
        if not len(left):
            continue
        own = shingles[begins[i] : begins[i] + sizes[i]]
        asked[own] = True
        some = _FEW_SHINGLES
        while len(left):
            to = max(1, int(np.searchsorted(np.cumsum(sizes[left]), some)))
            now, left, some = left[:to], left[to:], min(2 * some, _MANY_SHINGLES)
            total = np.concatenate([[0], np.cumsum(asked[shingles[_spans(begins[now], sizes[now])]])])
            ends = np.cumsum(sizes[now])
            both = total[ends] - total[ends - sizes[now]]
            for j in now[100 * both >= percent * (sizes[i] + sizes[now] - both)].tolist():
                if label[j] != label[i]:
                    out.append((int(i), j))
                    others = label == label[j]
                    label[others] = label[i]
                    moved += int(others.sum())
            left = left[label[left] != label[i]]
        asked[own] = False
        if moved * _LEAF >= len(sets):
            tree.relabel(label)
            moved = 0
    return out


def _describe(size: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                hashes, ends = shingle_sets(batch.column("text"), size)
                f1, f2 = _names(hashes, ends, seed)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("t1", "t2", "id")], pa.array(np.diff(ends)), pa.array(signed(f1)), pa.array(signed(f2))], names=["t1", "t2", "id", "n", "f", "f2"])

    return run


def _offer(size: int, percent: int, seed: int, hold: int = 1_000_000):
    """(shingle, set, spare) of each set's prefix; sets that a task has seen before are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole):
                hashes, ends = shingle_sets(batch.column("text"), size)
                name = signed(_names(hashes, ends, seed)[0])
                who, shingle, spare = prefixes(hashes, ends, percent)
                fresh = np.zeros(len(name), dtype=bool)
                for i, f in enumerate(name.tolist()):
                    if f not in seen:
                        fresh[i] = True
                        seen.add(f)
                if len(seen) > hold:
                    seen.clear()
                new = fresh[who]
                yield pa.RecordBatch.from_arrays([pa.array(signed(shingle[new])), pa.array(name[who[new]]), pa.array(spare[new].astype(np.int32))], names=["h", "f", "spare"])

    return run


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shingle, set): those of shingles that several sets have, with their number up to ``FREQUENT``.

    A run of one shingle may be as long as the table: once it is known to be frequent its rows pass as they come.
    """
    held = [np.zeros(0, dtype=np.int64)] * 3
    last: tuple | None = None  # the row before
    passing: int | None = None  # the shingle whose rows pass as frequent

    def out(rows: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(count.astype(np.int32)), pa.array(rows[2].astype(np.int32))], names=["h", "f", "sets", "spare"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy().astype(np.int64) for c in ("h", "f", "spare")]
        new = np.concatenate([[(rows[0][0], rows[1][0]) != last], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
        last = (rows[0][-1], rows[1][-1])
        rows = [x[new] for x in rows]
        if passing is not None:
            same = rows[0] == passing
            yield out([x[same] for x in rows], np.full(int(same.sum()), FREQUENT))
            rows = [x[~same] for x in rows]
            if len(rows[0]):
                passing = None
        rows = [np.concatenate(x) for x in zip(held, rows)]
        if not len(rows[0]):
            held = rows
            continue
        begin = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))
        count = np.diff(np.append(begin, len(rows[0])))
        each = np.repeat(count, count)
        open_ = begin[-1]  # the last run may go on
        if count[-1] >= FREQUENT:
            passing, open_ = rows[0][-1], len(rows[0])
        ready = (each >= 2) & (np.arange(len(each)) < open_)
        yield out([x[ready] for x in rows], np.minimum(each[ready], FREQUENT))
        held = [x[open_:] for x in rows]
    if len(held[0]) >= 2:
        yield out(held, np.full(len(held[0]), len(held[0])))


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by set, the most frequent shingles first: what is left after each set's spare ones."""
    now, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        f = batch.column("f").to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        count = np.diff(np.append(begin, len(f)))
        place = np.arange(len(f)) - np.repeat(begin, count)
        if f[0] == now:
            place[: count[0]] += done
        now, done = f[-1], place[-1] + 1
        yield batch.select(["h", "f"]).filter(pa.array(place >= batch.column("spare").to_numpy()))


def _meet(percent: int):
    """Rows sorted by (shingle, size, set): each further set of a shingle is linked with the first of those whose sizes no gap
    parts. Of similar sets the smaller has ``percent`` of the larger one's size, so where the next size is beyond that, no set
    before it is similar to one after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h0 = n0 = first0 = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, n, f = (batch.column(c).to_numpy() for c in ("h", "n", "f"))
            apart = (h[1:] != h[:-1]) | (n[:-1] * 100 < n[1:] * percent)
            first = np.concatenate([[h[0] != h0 or n0 * 100 < n[0] * percent], apart])
            at = np.maximum.accumulate(np.where(first, np.arange(len(f)), -1))
            least = np.where(at >= 0, f[np.maximum(at, 0)], first0 if first0 is not None else 0)
            keep = ~first & (least != f)
            h0, n0, first0 = h[-1], n[-1], least[-1]
            links = np.unique(np.stack([f[keep], least[keep]]), axis=1) if keep.any() else np.zeros((2, 0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], names=["a", "b"])

    return run


def _solve(size: int, percent: int):
    """Rows sorted by (bundle, block): the sets of a block are joined."""

    def solve(rows: pa.Table) -> tuple[list, list]:
        f = rows.column("f").to_pylist()
        texts = rows.column("text").combine_chunks()
        hashes, ends = shingle_sets(texts, size)
        sets = [hashes[a:b] for a, b in zip(ends[:-1], ends[1:])]
        asking = np.array(rows.column("asking").to_pylist(), dtype=bool)
        links = link_sets(sets, percent, rows.column("label").to_pylist(), None if asking.all() else asking)
        return [f[a] for a, _ in links], [f[b] for _, b in links]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bundle, block = batch.column("bundle").to_numpy(), batch.column("block").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((bundle[1:] != bundle[:-1]) | (block[1:] != block[:-1])) + 1, [len(bundle)]])
            a, b = [], []
            for x, y in zip(cuts[:-1], cuts[1:]):
                if (bundle[x], block[x]) != name and held:
                    la, lb = solve(pa.Table.from_batches(held))
                    a, b, held = a + la, b + lb, []
                name = (bundle[x], block[x])
                held.append(batch.slice(x, y - x))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        if held:
            a, b = solve(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _joined(rows: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    ready = rows.repartition("bundle", "block").sortWithinPartitions("bundle", "block").select("bundle", "block", "f", "label", "asking", "text")
    return store(ready.mapInArrow(_solve(size, percent), "a long, b long"), name)


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``component_id``.

    A document's set has its distinct runs of ``size`` words (A-Z lower-cased, split at the bytes 9-13 and 32); with
    fewer words, the whole sequence. Documents link when 100 |A and B| >= ``percent`` |A or B|; ``component_id`` is the
    smallest id that links reach (null ids are left out of the minimum). A text without words, or null, has no
    shingles, links with nothing and gets its own id. Repeated rows and equal sets are one class. Columns of these names
    in ``docs`` are replaced.

    Equal sets collapse first. Similar sets share a shingle among their rarest few (``prefixes``) and have about one size; sets
    that do, or are linked by such, form bundles. In a bundle an R-tree over count vectors bounds overlaps and the survivors are
    verified until all links between different components are known. A bundle above ``BLOCK_SHINGLES`` is cut into
    blocks: every block meets the first; what has then not joined the bundle's largest component meets every block.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_shingles", "component_id")]
    body = F.coalesce(F.col(text), F.lit(""))
    key = {"t1": F.xxhash64(body), "t2": F.xxhash64(F.md5(body.cast("binary")))}
    bare = docs.withColumns(key).select(body.alias("text"), *key, F.col(id_column).cast("long").alias("id"))
    seed = 0
    while True:
        described = store(bare.mapInArrow(_describe(size, seed), "t1 long, t2 long, id long, n long, f long, f2 long"), "sets-of-rows")
        sets = store(described.where("n > 0").groupBy("f", "f2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.min(F.struct("t1", "t2")).alias("t")), "sets")
        if not sets.groupBy("f").count().where("count > 1").head(1):
            break
        seed += 1  # two sets of one name: all are named anew
    offered = bare.select("text").mapInArrow(_offer(size, percent, seed), "h long, f long, spare int").repartition("h").sortWithinPartitions("h", "f")
    shared = offered.mapInArrow(_share, "h long, f long, sets int, spare int").repartition("f").sortWithinPartitions("f", F.desc("sets"), F.desc("h"))
    sized = shared.mapInArrow(_choose, "h long, f long").join(sets.select("f", "n").hint("merge"), "f").select("h", "n", "f")
    met = sized.repartition("h").sortWithinPartitions("h", "n", "f").mapInArrow(_meet(percent), "a long, b long")
    bundles = store(components(met), "bundles")

    members = bundles.join(sets, bundles["node"] == sets["f"]).select(F.col("component").alias("bundle"), "f", "n", "t.t1", "t.t2")
    sizes = store(members.groupBy("bundle").agg(F.sum("n").alias("total")), "bundle-sizes")
    blocks = F.ceil(F.col("total") / BLOCK_SHINGLES)
    member = store(members.join(sizes, "bundle").select("bundle", "f", "n", "t1", "t2", blocks.alias("blocks"), F.pmod(F.xxhash64("f"), blocks).alias("own")), "members")
    # One plan at every size: members grow with the rows, so they are never broadcast.
    texts = store(bare.select("text", "t1", "t2").join(member.hint("merge"), ["t1", "t2"]).groupBy("f").agg(F.first("text").alias("text"), *[F.first(c).alias(c) for c in ("bundle", "blocks", "own", "n")]), "texts-of-members")
    meets = F.when(F.col("own") > 0, F.array("own")).when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1))
    links = _joined(texts.select("bundle", F.explode(meets).alias("block"), "f", F.col("f").alias("label"), F.lit(True).alias("asking"), "text"), size, percent, "links-of-blocks")
    if member.where("blocks > 1").head(1):
        links = links.unionByName(_rest(texts.where("blocks > 1"), links, size, percent))
    labels = components(links)
    named = sets.join(labels, sets["f"] == labels["node"], "left").select("f", "n", "id", F.coalesce("component", "f").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = store(named.join(least, "root").select("f", "component_id"), "classes")
    of_text = store(described.groupBy("t1", "t2").agg(F.first("f").alias("f"), F.first("n").alias("n")).join(classes, "f", "left").select("t1", "t2", "n", "component_id"), "classes-of-texts")
    final = docs.withColumns(key).select(F.struct(*keep).alias("row"), *key).join(of_text, ["t1", "t2"])
    own_id = F.col(f"row.{id_column}").cast("long")
    return final.select("row.*", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, own_id).otherwise(F.col("component_id")).alias("component_id"))


def _rest(texts: DataFrame, links: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the sets outside a bundle's largest component and all blocks of the bundle."""
    labels = components(links)
    known = store(texts.join(labels, texts["f"] == labels["node"], "left").select(texts["*"], F.coalesce("component", "f").alias("label")), "labelled")
    largest = known.groupBy("bundle", "label").count().groupBy("bundle").agg(F.max(F.struct("count", "label")).alias("top"))
    flagged = store(known.join(largest, "bundle").withColumn("asking", F.col("label") != F.col("top.label")).drop("top"), "flagged")
    asking = flagged.where("asking").groupBy("bundle").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("askers"))
    both = flagged.join(asking, "bundle")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    turn = F.pmod(F.xxhash64("f", F.lit(3)), F.col("askers"))
    ask = both.where("asking").select("bundle", F.explode(F.transform(every, lambda b: b * F.col("askers") + turn)).alias("block"), "f", "label", "asking", "text")
    answer = both.select("bundle", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("askers") - 1), lambda a: F.col("own") * F.col("askers") + a)).alias("block"), "f", "label", F.lit(False).alias("asking"), "text")
    return _joined(ask.unionByName(answer), size, percent, "links-of-the-rest")
