"""Test items inside training texts: a BM25 index of the items, searched by every passage with block-max WAND."""
from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import slices, store

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach to be looked at. A passage with the whole item has 1.
THRESHOLD = 0.65
#: Share of the five-word shingles of the question, and of the answer, that must stand in the passage.
OVERLAP = 0.8
SHINGLE = 5
#: Items of one index, which is sent to every task. More items make more indexes, each with its own pass over the texts.
INDEX_ITEMS = 4096
INDEX_BYTES = 16 << 20
#: Largest number of item blocks with own maxima for each term.
BLOCKS = 256
#: Rows of block maxima that are held at a time.
ROWS = 4096
#: Least distance of passage starts, in words; a passage has twice as many, and no item is longer than the distance.
STRIDE = 64

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
FINDING = "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of a single sentence, the last third of its words."""
    parts = [w for s in _SENTENCE.split(text or "") if (w := words_of(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 3) if words else 0
    return words[:cut] or words, words[cut:]


def _shingles(words: list[str]) -> set[tuple[str, ...]]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


class Index:
    """Normalised BM25 weights: an item's weights add up to 1."""

    def __init__(self, items: list[tuple[int | None, str]], holders: dict[str, int], total: int, average: float) -> None:
        self.items = [(i, *question_and_answer(t), len(words_of(t))) for i, t in items]
        self.ids: dict[str, int] = {}
        self.postings: list[tuple[list[int], list[float]]] = []
        for number, (_, text) in enumerate(items):
            counts = Counter(words_of(text))
            length = sum(counts.values())
            scale = K1 * (1 - B + B * length / average) if average else K1
            weights = {w: math.log(1 + (total - holders[w] + 0.5) / (holders[w] + 0.5)) * n * (K1 + 1) / (n + scale) for w, n in counts.items()}
            own = sum(weights.values())
            for w, x in weights.items():
                at = self.ids.setdefault(w, len(self.ids))
                if at == len(self.postings):
                    self.postings.append(([], []))
                self.postings[at][0].append(number)
                self.postings[at][1].append(x / own)
        self.size = max(1, -(-len(items) // BLOCKS))
        self.top = np.zeros((len(self.ids), -(-len(items) // self.size)), dtype=np.float32)
        for t, (who, weights) in enumerate(self.postings):
            np.maximum.at(self.top[t], np.array(who) // self.size, np.array(weights, dtype=np.float32) * np.float32(1 + 1e-6))
        self.most = self.top.max(axis=1) if len(self.ids) else np.zeros(0, dtype=np.float32)
        self.stride = max([STRIDE, *(n for *_, n in self.items)])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose score reaches the threshold, item after item; blocks that can't hold one are passed over."""
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        out = []

        def forward(c: list, item: int) -> bool:
            who = self.postings[c[2]][0]
            c[1] = bisect_left(who, item, c[1])
            if c[1] < len(who):
                c[0] = who[c[1]]
                return True
            return False

        while cursors:
            cursors.sort()
            bound, last = 0.0, -1
            for k, c in enumerate(cursors):
                bound += float(self.most[c[2]])
                if bound >= threshold:
                    last = k
                    break
            if last < 0:
                break
            pivot = cursors[last][0]
            while last + 1 < len(cursors) and cursors[last + 1][0] == pivot:
                last += 1
            block = pivot // self.size
            if sum(float(self.top[c[2], block]) for c in cursors[: last + 1]) < threshold:
                after = (block + 1) * self.size
                if last + 1 < len(cursors):
                    after = min(after, cursors[last + 1][0])
                target, chosen = max(after, pivot + 1), range(last + 1)
            elif cursors[0][0] == pivot:
                score = sum(self.postings[c[2]][1][c[1]] for c in cursors[: last + 1])
                if score >= threshold:
                    out.append((pivot, score))
                target, chosen = pivot + 1, range(last + 1)
            else:
                target, chosen = pivot, [k for k in range(last + 1) if cursors[k][0] < pivot]
            gone = {k for k in chosen if not forward(cursors[k], target)}
            if gone:
                cursors = [c for k, c in enumerate(cursors) if k not in gone]
        return out

    def findings(self, texts: list[str | None]) -> list[list[dict]]:
        """The items that each text holds."""
        out: list[list[dict]] = [[] for _ in texts]
        if not self.items or not self.ids:
            return out
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words])
        chunks = np.maximum(1, -(-sizes // self.stride))
        base = np.concatenate([[0], np.cumsum(chunks)])
        get = self.ids.get
        flat = np.fromiter((get(w, -1) for ws in words for w in ws), dtype=np.int64, count=int(sizes.sum()))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chunk = np.repeat(base[:-1], sizes) + place // self.stride
        key = np.unique((chunk * len(self.ids) + flat)[flat >= 0])
        term, chunk = key % len(self.ids), key // len(self.ids)
        if not len(term):
            return out
        begin = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
        bound = np.zeros((base[-1] + 1, self.top.shape[1]), dtype=np.float32)
        for a, z in _runs(begin, len(term), ROWS):  # a row of block maxima for each word of a text would take a hundred times its bytes
            bound[chunk[begin[a:z]]] = np.add.reduceat(self.top[term[begin[a] : begin[z] if z < len(begin) else None]], begin[a:z] - begin[a], axis=0)
        owner = np.repeat(np.arange(len(texts)), chunks)
        last = np.append(owner[1:] != owner[:-1], True)
        both = bound[:-1] + np.where(last[:, None], 0, bound[1:])
        ends = np.append(begin, len(chunk))
        where = dict(zip(chunk[begin].tolist(), range(len(begin))))
        for c in np.flatnonzero((both * np.float32(1 + 1e-5) >= THRESHOLD).any(axis=1)).tolist():
            d = int(owner[c])
            terms = {int(t) for x in (c, c + 1) if x in where and owner[min(x, len(owner) - 1)] == d for t in term[ends[where[x]] : ends[where[x] + 1]]}
            at = (c - int(base[d])) * self.stride
            passage, shingles = words[d][at : at + 2 * self.stride], {}
            for number, score in self.search(sorted(terms), THRESHOLD - 1e-9):
                item, question, answer, _ = self.items[number]
                q, a = (_share(part, passage, shingles) for part in (question, answer))
                if q >= OVERLAP and a >= OVERLAP:
                    out[d].append({"item_id": item, "score": score, "question_overlap": q, "answer_overlap": a, "number": number})
        return [list({f["number"]: f for f in sorted(found, key=lambda f: f["score"])}.values()) if found else found for found in out]


def _runs(begin: np.ndarray, end: int, size: int) -> Iterator[tuple[int, int]]:
    """The groups that begin there in runs of about ``size`` members, one group at least."""
    ends, a = np.append(begin[1:], end), 0
    while a < len(begin):
        z = max(a + 1, int(np.searchsorted(ends, begin[a] + size, side="right")))
        yield a, z
        a = z


def _share(part: list[str], passage: list[str], known: dict[int, set]) -> float:
    wanted = _shingles(part)
    if not wanted:
        return 1.0
    size = min(SHINGLE, len(part))
    if size not in known:
        known[size] = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(wanted & known[size]) / len(wanted)


def _words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(g, w, n == 0, len(ws)) for g, t in zip(frame["part"], frame["text"]) for ws in [words_of(t)] for n, w in enumerate(dict.fromkeys(ws))]
        yield pd.DataFrame(rows, columns=["part", "word", "first", "length"])


def indexes(items: DataFrame, id_column: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes of at most about ``INDEX_ITEMS`` items and ``INDEX_BYTES`` of text; statistics are of all items."""
    rows = items.select(F.col(id_column).cast("long").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size["n"] // INDEX_ITEMS), -(-size["chars"] // INDEX_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    words = store(rows.select("part", "text").mapInPandas(_words, "part long, word string, first boolean, length long"), "item-words")
    filled = words.where("first").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("words")).first()
    holders = store(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "item-word-counts")
    for part in range(parts):
        own = holders.join(words.where(F.col("part") == part).select("word").distinct(), "word", "left_semi").collect()
        texts = rows.where((F.col("part") == part) & (F.length("text") > 0)).orderBy("item", "text").collect()
        yield Index([(r["item"], r["text"]) for r in texts], {r["word"]: r["n"] for r in own}, filled["n"], (filled["words"] or 0) / max(1, filled["n"]))


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", id_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``findings``: the test items whose question and answer stand in the text (an empty list if none).

    Words are runs of letters and digits, lower-cased. Each text is cut into overlapping passages that are long enough
    for every item. The sum of a passage's block maxima bounds its score with every item of the block; only passages
    with a block above ``THRESHOLD`` are searched, which returns all items above it; then the five-word shingles of
    question and answer are compared with the passage (parts of fewer words as a whole). Repeated items count once, items
    without words never match, null texts have no findings, no items mean no findings. A column ``findings`` of ``docs``
    is replaced. Documents are not shuffled; the indexes are sent to the tasks and their size is bounded.
    """
    keep = [c for c in docs.columns if c.lower() != "findings"]
    now = docs.select(*keep, F.expr(f"cast(array() as {FINDING})").alias("findings"))
    for turn, index in enumerate(indexes(items, id_column, item_text)):
        if turn:
            now = store(now, "searched")
        sent = docs.sparkSession.sparkContext.broadcast(index)
        now = now.mapInArrow(_search(sent, text), now.schema)
    return now


def _search(sent, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for whole in batches:
            for batch in slices(whole, text):
                new = index.findings(batch.column(text).to_pylist())
                at = batch.schema.get_field_index("findings")
                kind = batch.schema.field(at).type
                if any(new):
                    merged = [[*old, *({k: f[k] for k in ("item_id", "score", "question_overlap", "answer_overlap")} for f in more)] for old, more in zip(batch.column(at).to_pylist(), new)]
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(merged, kind))
                yield batch

    return run
