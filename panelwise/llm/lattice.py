"""Document likelihood under a unigram model of subwords, summed over all segmentations."""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import Any

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import store

#: Bytes of a chunk, or one longer text: the texts and the scores of their words are in memory together.
CHUNK_BYTES = 32 << 20
#: Added to the expected count of each piece.
SMOOTHING = 0.1
#: Passes that learn piece scores from the training words.
ROUNDS = 2

_PART_BITS = 33  # of monotonically_increasing_id
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LN10 = math.log(10)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


class Lattice:
    """All ways to write words with the pieces of a vocabulary; characters without a piece are written in bytes.

    The words of a batch are handled together: an automaton finds the pieces of all of them in one text, and the sums run
    over the k-th characters of all words at once.
    """

    def __init__(self, pieces: list[tuple[str, int]], byte_ids: list[int], scores: list[float]) -> None:
        self.scores, self.byte_ids = np.array(scores), byte_ids
        self.chars = np.sort(np.frombuffer("".join(t for t, _ in pieces if len(t) == 1).encode("utf-32-le"), dtype=np.uint32))
        self.matches = ahocorasick.Automaton()
        self.own = np.array([i for _, i in pieces], dtype=np.int64)
        self.lengths = np.array([len(t) for t, _ in pieces], dtype=np.int64)
        for k, (t, _) in enumerate(pieces):
            self.matches.add_word(t, k)
        self.matches.make_automaton()

    def _edges(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(start, end, log weight, piece, first edge of each depth, nodes of the words' ends, spelling edges and their bytes).

        A word of n characters has the nodes 0 to n, numbered on from word to word. Edges are sorted by depth (the characters
        before their end), then by end. Characters without a piece have edges that spell their bytes; their piece is -1.
        """
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(sizes + 1) - 1
        joined = "\n".join([*texts, ""])  # no piece has a line feed, and words have none
        flat = np.fromiter(chain.from_iterable(self.matches.iter(joined)), dtype=np.int64).reshape(-1, 2)
        end, k = flat[:, 0] + 1, flat[:, 1]
        start, weight, piece = end - self.lengths[k], self.scores[self.own[k]], self.own[k]
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.searchsorted(self.chars, points)
        strange = np.flatnonzero((self.chars[np.minimum(at, len(self.chars) - 1)] != points) & (points != 10))
        spelt = [[self.byte_ids[b] for b in joined[i].encode("utf-8", "surrogatepass")] for i in strange.tolist()]
        if spelt:
            start = np.concatenate([start, strange])
            end = np.concatenate([end, strange + 1])
            weight = np.concatenate([weight, [self.scores[x].sum() for x in spelt]])
            piece = np.concatenate([piece, np.full(len(spelt), -1)])
        begin = np.repeat(ends - sizes, sizes + 1)
        depth = end - begin[end]
        order = np.lexsort((end, depth))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        of = np.repeat(place[len(flat) :], [len(x) for x in spelt]) if spelt else np.zeros(0, dtype=np.int64)
        letters = np.array([b for x in spelt for b in x], dtype=np.int64)
        cuts = np.searchsorted(depth[order], np.arange(1, int(sizes.max(initial=0)) + 2))
        return start[order], end[order], weight[order], piece[order], cuts, ends, of, letters

    @staticmethod
    def _forward(start: np.ndarray, end: np.ndarray, weight: np.ndarray, cuts: np.ndarray, nodes: int) -> np.ndarray:
        """Log of the summed probability of all ways from a word's beginning to each node."""
        alpha = np.zeros(nodes)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x, to = alpha[start[a:b]] + weight[a:b], end[a:b]
            first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(x, first)
            sums = np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(first, b - a)))), first)
            alpha[to[first]] = top + np.log(sums)
        return alpha

    def marginals(self, texts: list[str]) -> np.ndarray:
        """For each text, the log of the summed probability of all segmentations."""
        if not texts:
            return np.zeros(0)
        start, end, weight, _, cuts, ends, _, _ = self._edges(texts)
        return self._forward(start, end, weight, cuts, int(ends[-1]) + 1)[ends]

    def expected(self, texts: list[str], times: np.ndarray) -> np.ndarray:
        """Expected number of each piece in ``times`` copies of each text, forwards and backwards through the lattices."""
        counts = np.zeros(len(self.scores))
        if not texts:
            return counts
        start, end, weight, piece, cuts, ends, of, letters = self._edges(texts)
        alpha = self._forward(start, end, weight, cuts, int(ends[-1]) + 1)
        beta, share = np.zeros(len(alpha)), np.exp(alpha[start] + weight - alpha[end])
        beta[ends] = times  # share of the paths that pass a node, times what is known of it
        for a, b in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist()):
            share[a:b] *= beta[end[a:b]]
            np.add.at(beta, start[a:b], share[a:b])
        known = piece >= 0
        counts += np.bincount(piece[known], weights=share[known], minlength=len(counts))
        if len(of):
            counts += np.bincount(letters, weights=share[of], minlength=len(counts))
        return counts


def _groups(words: list[bytes], chars: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Consecutive runs of words of about so many bytes."""
    at = size = 0
    for k, w in enumerate(words):
        size += len(w) + 1
        if size > chars:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(words):
        yield at, len(words)


def _vocabulary(path: str) -> tuple[list[tuple[str, int]], list[int], list[float], int]:
    """Pieces, ids of the bytes, first log weights (by rank in the model), id of the end piece."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    own = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = [(model.id_to_piece(i), i) for i in own]
    rank = {i: r for r, i in enumerate(sorted(own, key=lambda i: -model.get_score(i)))}
    weights = [1.0 / (10 + rank.get(i, size)) for i in range(size)]
    total = sum(weights)
    return pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], [math.log(w / total) for w in weights], model.eos_id()


def _cut(lengths: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The chunk of each row, counted from 0 in every task: consecutive rows of up to ``CHUNK_BYTES`` in all, one row at least."""
    chunk, left = 0, CHUNK_BYTES
    for sizes in lengths:
        ends, out, at, before = np.cumsum(sizes.to_numpy()), np.empty(len(sizes), dtype=np.int64), 0, 0
        while at < len(sizes):
            to = int(np.searchsorted(ends, before + left, side="right"))
            if to == at and left == CHUNK_BYTES:
                to = at + 1  # a text longer than a chunk
            out[at:to] = chunk
            if to < len(sizes):
                chunk, left = chunk + 1, CHUNK_BYTES
                before = int(ends[to - 1]) if to else 0
            else:
                left = max(0, left - int(ends[-1] - before))
            at = to
        yield pd.Series(out)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, part, number, word, times in training) for each word of a part, numbered in order.

    A part is a run of consecutive rows of one chunk, named by its first row: stored rows are read back in splits that may
    begin within a chunk, and a task may read splits that don't follow each other.
    """
    counts: Counter = Counter()
    seen: set[bytes] = set()  # words of texts that teach nothing
    now = part = last = None

    def flush() -> pa.RecordBatch:
        words = sorted(seen.union(counts))
        n = len(words)
        columns = [pa.array([now] * n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(words, pa.binary()), pa.array([counts[w] for w in words], pa.int64())]
        counts.clear()
        seen.clear()
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "part", "number", "word", "times"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for chunk, row, held, text in zip(*(batch.column(c).to_pylist() for c in ("chunk", "row", "held_out")), texts):
            if now is not None and (chunk != now or row != last + 1):
                yield flush()
                now = None
            if now is None:
                now, part = chunk, row
            last = row
            (seen if held else counts).update(tokens(text))
    if now is not None:
        yield flush()


def learn_pieces(words: DataFrame, path: str, ends: int, rounds: int = ROUNDS) -> tuple[Any, float]:
    """(lattice, log score of the end) learnt from ``words`` (word, times) by expectation maximisation.

    It starts from the ranks of the existing vocabulary. A round adds up expected piece counts in every task; one row per
    piece of the vocabulary reaches the driver.
    """
    pieces, byte_ids, scores, end_id = _vocabulary(path)
    for _ in range(rounds):
        sent = words.sparkSession.sparkContext.broadcast((pieces, byte_ids, scores))

        def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*sent.value)
            counts = np.zeros(len(lattice.scores))
            for batch in batches:
                words, times = batch.column("word").to_pylist(), batch.column("times").to_numpy()
                for a, b in _groups(words):
                    counts += lattice.expected(["▁" + w.decode() for w in words[a:b]], times[a:b])
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["piece", "n"])

        found = words.where("times > 0").select("word", "times").mapInArrow(expected, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = {r["piece"]: r["n"] for r in found} | {end_id: float(ends)}
        usable = [i for _, i in pieces] + byte_ids + [end_id]
        total = sum(counts.values()) + SMOOTHING * len(usable)
        scores = [-math.inf] * len(scores)
        for i in usable:
            scores[i] = math.log((counts.get(i, 0.0) + SMOOTHING) / total)
    return (pieces, byte_ids, scores), scores[end_id]


_OUT = "row long, n_tokens long, n_known long, base_score double, score double"


def score_documents(docs: DataFrame, held_out, path: str, text: str = "text") -> DataFrame:
    """``docs`` with held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    Tokens are the words (A-Z lower-cased, split at the bytes 9-13 and 32) and one end. Rows where the condition
    ``held_out`` is true teach nothing (null: they do teach). ``base_score`` adds log10((c + 1) / (N + V + 1)) with counts
    c of all training tokens. ``score`` is the sum over all segmentations of each word into pieces, times the end. Null
    and empty texts have only the end; unknown characters are written in bytes, so every text has a probability.
    Repeated rows count each time. Columns of these names in ``docs`` are replaced. Texts are stored in chunks of
    about ``CHUNK_BYTES``; the distinct words of what a task reads of a chunk (a part) meet the corpus counts by a join, and come back
    to these texts, wherever stored files are split. So no task needs the whole vocabulary, and a word that all chunks have
    is one row per part.
    """
    names = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in docs.columns if c.lower() not in names]
    place = F.monotonically_increasing_id()
    rows = docs.select(F.struct(*keep).alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held_out"), place.alias("row"))
    size = F.coalesce(F.octet_length(F.col(f"doc.{text}").cast("string")), F.lit(0)).cast("long")
    chunk = F.shiftleft(F.shiftright("row", _PART_BITS), _PART_BITS).bitwiseOR(F.pandas_udf(_cut, "long")(size))
    rows = store(rows.withColumn("chunk", chunk), "rows")
    body = F.col(f"doc.{text}").alias("text")
    local = store(rows.select("chunk", "row", "held_out", body).mapInArrow(_count_words, "chunk long, part long, number int, word binary, times long"), "words-of-chunks")
    words = store(local.groupBy("word").agg(F.sum("times").alias("times")), "words")
    whole = words.where("times > 0").agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = rows.where(~F.col("held_out")).count()
    total, kinds = whole["n"] + ends, whole["v"] + (ends > 0)
    model, end_score = learn_pieces(words, path, ends)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*sent.value)
        for batch in batches:
            words = batch.column("word").to_pylist()
            found = [lattice.marginals(["▁" + w.decode() for w in words[a:b]]) / _LN10 for a, b in _groups(words)]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("times"), pa.array(np.concatenate([[], *found]), pa.float64())], names=["word", "times", "score"])

    scored = store(words.mapInArrow(marginals, "word binary, times long, score double"), "word-scores")
    of_chunk = store(local.select("chunk", "part", "number", "word").join(scored, "word").select("chunk", "part", "number", "times", "score"), "scores-of-chunks")
    floor = math.log10(total + kinds + 1)
    end = (math.log10(ends + 1) - floor, end_score / _LN10, int(ends > 0))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        places, texts = left.column("row").to_numpy(), left.column("text").cast(pa.binary()).to_pylist()
        starts, of = np.unique(right.column("part").to_numpy(), return_inverse=True)
        own = np.searchsorted(starts, places, side="right") - 1  # a part without words has no start and needs none
        found: list[list] = [[], [], [], [], []]
        for part in range(-1, len(starts)):
            mine, here = np.flatnonzero(own == part), np.flatnonzero(of == part)
            words = set()
            for k in mine:
                words.update(tokens(texts[k]))
            words = sorted(words)  # the numbers that _count_words gave
            if len(here) != len(words):
                raise ValueError(f"{len(here)} words were counted where the texts have {len(words)}")
            number, at = {w: k for k, w in enumerate(words)}, right.column("number").to_numpy()[here]
            times, scores = np.zeros(len(words)), np.zeros(len(words))
            times[at], scores[at] = right.column("times").to_numpy()[here], right.column("score").to_numpy()[here]
            bases, known = np.log10(times + 1) - floor, times > 0
            for k in mine:
                ids = np.array([number[w] for w in tokens(texts[k])], dtype=np.int64)
                row = (int(places[k]), len(ids) + 1, int(known[ids].sum()) + end[2], float(bases[ids].sum()) + end[0], float(scores[ids].sum()) + end[1])
                for column, v in zip(found, row):
                    column.append(v)
        return pa.table([pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["row", "n_tokens", "n_known", "base_score", "score"])

    found = rows.select("chunk", "row", body).groupBy("chunk").cogroup(of_chunk.groupBy("chunk")).applyInArrow(score, _OUT)
    out = rows.join(found, "row")
    return out.select("doc.*", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
