"""Runs of words that repeat with a period, found by splitting at words too rare to belong to one."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import hashed_words, slices

#: A run is at least this many periods and this many words long.
PERIODS, LEAST = 4, 6
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 for equal values, and how often each occurs."""
    _, codes, counts = np.unique(values, return_inverse=True, return_counts=True)
    return codes.reshape(-1), counts


def split_at_rare_words(words: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment) of the words that may belong to a run; the places of a segment are consecutive.

    Each word of a run occurs ``PERIODS`` times in it. So a word that is rarer in its segment belongs to no run, and no
    run crosses it: the segment splits there, and its pieces, where other words are rare now, are split again.
    """
    at = np.arange(len(words))
    segment = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    code, kinds = _codes(words)
    kinds = len(kinds)
    stable_at, stable_segment, used = [at[:0]], [at[:0]], 0
    while len(at):
        same, counts = _codes(segment * kinds + code[at])
        often = counts[same] >= PERIODS
        whole = np.ones(int(segment[-1]) + 1, dtype=bool)
        whole[segment[~often]] = False
        done = whole[segment]
        stable_at.append(at[done])
        names, _ = _codes(segment[done])
        stable_segment.append(names + used)
        used += int(names[-1]) + 1 if len(names) else 0
        rest = often & ~done
        at, segment = at[rest], segment[rest]
        if len(at):
            first = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(segment) > 0)])
            segment = np.cumsum(first) - 1
            long = np.bincount(segment)[segment] >= LEAST
            at, segment = at[long], segment[long]
    places, segments = np.concatenate(stable_at), np.concatenate(stable_segment)
    order = np.argsort(places, kind="stable")
    return places[order], segments[order]


def scan_lags(words: np.ndarray, places: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in the segments, by start and period.

    Periods above k / 2 and up to k are scanned together, for k = 1, 2, 4 and so on. In a run of such a period q, as q
    is the smallest, each window of k words comes again first after exactly q words; windows next to each other with
    this lag make up the run, and no others do. Windows of 2 k words are named by the pair of their halves, so names are
    exact, and windows without a copy take no further part.
    """
    n = len(places)
    left = np.zeros(n, dtype=np.int64)  # words from here to the end of the segment
    if n:
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0, [True]]))
        left = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(n)
    name = np.full(n, -1, dtype=np.int64)
    own, _ = _codes(words[places])
    live = np.arange(n)
    name[live], counts = _codes(segment * (n + 1) + own)
    starts, lengths, periods, k = [], [], [], 1
    while len(live):
        live = live[counts[name[live]] > 1]
        order = live[np.argsort(name[live], kind="stable")]
        again = np.flatnonzero(name[order][1:] == name[order][:-1])
        lag = np.zeros(n, dtype=np.int64)
        lag[order[again]] = order[again + 1] - order[again]
        hit = live[(lag[live] > k // 2) & (lag[live] <= k)]
        if len(hit):
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(lag[hit]) != 0), [True]]))
            first, last = hit[cuts[:-1]], hit[cuts[1:] - 1]
            q = lag[first]
            length = last - first + k + q
            long = length >= np.maximum(LEAST, PERIODS * q)
            starts.append(places[first[long]])
            lengths.append(length[long])
            periods.append(q[long])
        wider = np.full(n, -1, dtype=np.int64)
        kept = np.zeros(n, dtype=bool)
        kept[live] = True
        live = live[left[live] >= 2 * k]
        live = live[kept[live + k]]
        if len(live):
            wider[live], counts = _codes(name[live] * (n + 1) + name[live + k])
        name, k = wider, 2 * k
    if not starts:
        return (np.zeros(0, dtype=np.int64),) * 3
    found = np.stack([np.concatenate(c) for c in (starts, lengths, periods)])
    return tuple(found[:, np.lexsort((found[2], found[0]))])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            column = batch.column("text")
            words, begins = hashed_words(column)
            start, length, period = scan_lags(words, *split_at_rare_words(words, begins))
            cover = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            stays = np.cumsum(cover[:-1]) == 0
            owner = np.searchsorted(begins, start, side="right") - 1
            runs = pa.StructArray.from_arrays([pa.array(start - begins[owner]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
            ends = np.searchsorted(owner, np.arange(len(begins)))
            texts = [b" ".join(compress((t or "").encode().split(), stays[a:b].tolist())).decode() for t, a, b in zip(column.to_pylist(), begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.diff(begins)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs).cast(_RUNS), pa.array(texts, pa.string())], names=["row", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are split at the bytes 9-13 and 32 and numbered from 0. A run is a stretch of consecutive words with smallest
    period q (words q apart are the same), at least max(6, 4 q) words long, that no neighbouring word extends; runs may
    overlap. ``collapsed`` has the words, joined by one space, but those that some run holds after its first q words.
    A null or empty text has no words, no runs and an empty ``collapsed``; repeated rows are described each; columns of
    these names in ``docs`` are replaced. One narrow pass: nothing is shuffled, and a task holds the words of about 2 MB
    of text, or of one document that is longer, in a few arrays.
    """
    names = ("n_words", "runs", "collapsed")
    keep = [c for c in docs.columns if c.lower() not in names]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(_describe, f"row {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.select("row.*", *names)
