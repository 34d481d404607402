"""Exact removal of repeated word sequences with prefix-partitioned suffix trees.

A repeat of ``length`` words is found through its suffixes' prefixes. In each run of ``length`` words the prefix of
``PREFIX`` words with the smallest hash is the anchor; equal runs have equal anchors at equal places. Suffixes are split
by anchor prefix; a prefix of one place in the corpus starts no repeat and goes. Where the whole surroundings of an
anchor (all runs with this anchor) occur twice, all of them are repeats: one deep node. The rest are prefixes that occur
in different surroundings. Each such group's suffixes form a subtree, of which nodes at least ``length`` words deep with
two leaves or more are repeats. A group with more than ``GROUP`` surroundings is split by the longest prefix that
matters, ``length`` words; each of those groups is a single deep node and is only counted.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import buffers, hash_spans, hashed_words, merged, mix, pair, signed, slices, store, word_spans

PREFIX = 8
#: Surroundings of one prefix whose suffixes are put into one tree.
GROUP = 2000


def _doubled(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; runs that reach over the end are cut off."""
    out, done, power, width = None, 0, words, 1
    while True:
        if size & width:
            out = power if out is None else pair(out[: len(power) - done] if done else out, power[done:])
            done += width
            out = out[: max(0, len(words) - done + 1)]
        width *= 2
        if width > size:
            return out
        power = pair(power[: -width // 2], power[width // 2 :]) if len(power) > width // 2 else power[:0]


def anchors(words: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each anchor: text number, prefix hash, hash of its surroundings, first run that has it, number of runs."""
    runs, prefixes = _doubled(words, length), _doubled(words, PREFIX)
    wide = length - PREFIX + 1
    if len(runs) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z.view(np.uint64), z.view(np.uint64), z, z
    best = np.arange(len(prefixes))  # the leftmost smallest prefix of the window that starts here
    reach = 1
    while reach < wide:
        step = min(reach, wide - reach)
        other = best[step:]
        here = best[: len(other)]
        best = np.where(prefixes[other] < prefixes[here], other, here)
        reach += step
    best = best[: len(runs)]
    texts = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    first = np.arange(len(runs))
    inside = texts[: len(runs)] == texts[first + length - 1]
    first, best = first[inside], best[inside]
    if not len(first):
        z = np.zeros(0, dtype=np.int64)
        return z, z.view(np.uint64), z.view(np.uint64), z, z
    new = np.concatenate([[True], (best[1:] != best[:-1]) | (first[1:] != first[:-1] + 1)])
    lo = first[new]
    n = np.diff(np.concatenate([np.flatnonzero(new), [len(first)]]))
    place = (best[new] - lo).astype(np.uint64)
    around = pair(pair(runs[lo], runs[lo + n - 1]), mix(place * np.uint64(64) + n.astype(np.uint64)))
    text = texts[lo]
    return text, prefixes[best[new]], around, lo - begins[text], n


_ANCHORS = "t1 long, t2 long, prefix long, around long, lo int, n int"


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, begins = hashed_words(batch.column("text"))
                text, prefix, around, lo, n = anchors(words, begins, length)
                t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t1[text]), pa.array(t2[text]), pa.array(signed(prefix)), pa.array(signed(around)), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=[c.split()[0] for c in _ANCHORS.split(", ")],
                )

    return run


_SURROUNDINGS = "t1 long, t2 long, prefix long, around long, lo int, n int, times long, members long, words binary"


def _surroundings(length: int):
    """The words themselves of the wanted surroundings."""
    names = [c.split()[0] for c in _SURROUNDINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for whole in batches:
            for batch in slices(whole):
                raw, offsets = buffers(batch.column("text"))
                starts, ends, begins = word_spans(raw, offsets)
                out = []
                for k, wanted in enumerate(batch.column("wanted").to_pylist()):
                    name = (batch.column("t1")[k].as_py(), batch.column("t2")[k].as_py())
                    if name == before:
                        continue  # copies follow each other and say the same
                    before = name
                    for w in wanted:
                        a = begins[k] + w["lo"]
                        z = a + w["n"] + length - 2
                        out.append((*name, w["prefix"], w["around"], w["lo"], w["n"], w["times"], w["members"], raw[starts[a] : ends[z]].tobytes()))
                columns = list(zip(*out)) if out else [[] for _ in names]
                types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def deep_nodes(groups: np.ndarray, suffixes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Which suffixes hang under a node of full depth with two leaves or more.

    ``suffixes`` holds the first words of each suffix as numbers. Sorted by group and words, neighbours share their
    longest common prefix; a run of neighbours that share all words is a deep internal node. ``weights`` are the places
    in the corpus that a suffix stands for.
    """
    order = np.lexsort((*suffixes.T[::-1], groups))
    g, s = groups[order], suffixes[order]
    differs = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1]).any(axis=1)])
    node = np.cumsum(differs) - 1
    leaves = np.bincount(node, weights=weights[order])
    out = np.zeros(len(groups), dtype=bool)
    out[order] = leaves[node] >= 2
    return out


_MASKS = "t1 long, t2 long, lo int, mask long"


def _subtrees(length: int):
    """Rows come sorted by prefix; whole groups are handled together, many at a time."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        words = [[known.setdefault(w, len(known)) for w in x.split()] for x in rows.column("words").to_pylist()]
        n = rows.column("n").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        flat = np.fromiter((w for ws in words for w in ws), dtype=np.int32)
        begin = np.cumsum([0, *map(len, words)])[:-1]
        suffixes = flat[(begin[owner] + shift)[:, None] + np.arange(length)[None, :]]
        found = deep_nodes(rows.column("prefix").to_numpy()[owner], suffixes, rows.column("times").to_numpy()[owner])
        masks = np.bincount(owner, weights=np.where(found, 2.0**shift, 0), minlength=len(n)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(rows.column(c).to_numpy()) for c in ("t1", "t2", "lo")] + [pa.array(masks)], names=["t1", "t2", "lo", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 2 * GROUP:
                continue
            rows = pa.Table.from_batches(held)
            prefix = rows.column("prefix").to_numpy()
            cut = int(np.searchsorted(prefix, prefix[-1]))
            for a in _cuts(prefix, 0, cut):
                yield solve(rows.slice(*a))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            rows = pa.Table.from_batches(held)
            prefix = rows.column("prefix").to_numpy()
            for a in _cuts(prefix, 0, len(prefix)):
                yield solve(rows.slice(*a))

    return run


def _cuts(prefix: np.ndarray, at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < end:
        to = min(end, at + 2 * GROUP)
        if to < end:
            to = int(np.searchsorted(prefix, prefix[to]))
        yield at, to - at
        at = to


def _long_prefixes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "words"):
                column = batch.column("words").cast(pa.string())
                words, begins = hashed_words(column)
                one, two = _doubled(words, length), _doubled(mix(words ^ np.uint64(0x5851F42D4C957F2D)), length)
                n = batch.column("n").to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(n)), n)
                shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                at = begins[:-1][owner] + shift
                keep = [pa.array(batch.column(c).to_numpy()[owner]) for c in ("t1", "t2", "lo", "times")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(shift.astype(np.int32)), pa.array(signed(one[at])), pa.array(signed(two[at]))], names=["t1", "t2", "lo", "times", "shift", "h1", "h2"])

    return run


def _removed(length: int, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            texts = rows.field(rows.type.get_field_index(column)).to_pylist()
            n_words, n_removed, kept = [], [], []
            for text, marks in zip(texts, batch.column("marks").to_pylist()):
                words = (text or "").encode().split()
                count = len(words)
                if marks:
                    change = np.zeros(count + 1, dtype=np.int64)
                    for m in marks:
                        mask, at = m["mask"], m["lo"]
                        while mask:
                            low = (mask & -mask).bit_length() - 1
                            ones = ((~(mask >> low)) & ((mask >> low) + 1)).bit_length() - 1  # length of the run of ones
                            change[at + low] += 1
                            change[at + low + ones - 1 + length] -= 1
                            mask &= ~(((1 << ones) - 1) << low)
                    gone = np.cumsum(change[:-1]) > 0
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                n_words.append(count)
                n_removed.append(count - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([rows, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["row", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 35) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space).

    Words are split at the bytes 9-13 and 32. A word goes if a run of ``length`` words of its document covers it whose
    words also start elsewhere, in any document or at another place of the same one. Null and empty texts have no words;
    a text shorter than ``length`` keeps all; repeated rows are copies, so each loses every run. Columns of these names in
    ``docs`` are replaced. Texts are shuffled once, by a 128-bit hash; otherwise only anchors (about one in 14 words)
    and the surroundings of prefixes that differ travel. Counts of a prefix are combined map-side.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text")]
    body = F.coalesce(F.col(text), F.lit(""))
    key = {"t1": F.xxhash64(body), "t2": F.xxhash64(F.lit(17), F.reverse(body))}  # two hashes with different inputs name a text
    bare = docs.withColumns(key).select(body.alias("text"), *key).where(F.length("text") >= 2 * length - 1)
    found = store(bare.mapInArrow(_anchor_rows(length), _ANCHORS), "anchors")
    shared = store(merged(found.groupBy("prefix").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("prefix")), "shared-prefixes")
    live = store(merged(found.join(shared, "prefix", "left_semi")), "shared-anchors")

    around = store(merged(live.groupBy("prefix", "around").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("t1", "t2", "lo", "n")).alias("at"))), "surroundings")
    single = F.sum(F.when(F.col("times") == 1, 1).otherwise(0))
    mixed = store(merged(around.groupBy("prefix").agg(F.count(F.lit(1)).alias("members"), single.alias("single")).where("members > 1 AND single > 0").select("prefix", "members")), "mixed-prefixes")
    members = around.join(mixed, "prefix").select("prefix", "around", "times", "members", "at.*")
    wanted = store(merged(members.groupBy("t1", "t2").agg(F.collect_list(F.struct("prefix", "around", "lo", "n", "times", "members")).alias("wanted"))), "wanted-words")
    sources = bare.join(wanted, ["t1", "t2"]).select("text", "t1", "t2", "wanted")
    bits = store(merged(sources.mapInArrow(_surroundings(length), _SURROUNDINGS).dropDuplicates(["prefix", "around"])), "words")

    small = merged(bits.where(F.col("members") <= GROUP).repartition("prefix")).sortWithinPartitions("prefix").select("t1", "t2", "prefix", "lo", "n", "times", "words")
    trees = small.mapInArrow(_subtrees(length), _MASKS)
    pieces = bits.where(F.col("members") > GROUP).select("t1", "t2", "lo", "n", "times", "words").mapInArrow(_long_prefixes(length), "t1 long, t2 long, lo int, times long, shift int, h1 long, h2 long")
    counted = pieces.groupBy("h1", "h2").agg(F.sum("times").alias("leaves")).where("leaves > 1")
    bit = F.expr("shiftleft(1L, shift)")
    nodes = pieces.join(counted, ["h1", "h2"], "left_semi").groupBy("t1", "t2", "lo").agg(F.sum(bit).alias("mask"))
    whole = live.join(around.where("times > 1"), ["prefix", "around"], "left_semi").select("t1", "t2", "lo", (F.expr("shiftleft(1L, n)") - 1).alias("mask"))
    masks = whole.unionByName(trees).unionByName(nodes).where("mask <> 0")
    marks = store(merged(masks.groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "mask")).alias("marks"))), "marks")
    ready = docs.withColumns(key).select(F.struct(*keep).alias("row"), *key).join(marks, ["t1", "t2"], "left").select("row", "marks")
    schema = ready.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return ready.mapInArrow(_removed(length, text), schema).select("row.*", "n_words", "n_removed", "kept_text")
