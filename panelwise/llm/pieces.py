"""SentencePiece encoding by a prefix table of last tokens, and decoding."""
from __future__ import annotations

import heapq
import os
import re
import sys
import tempfile
from array import array
from collections.abc import Callable, Hashable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from panelwise.llm.shared import slices

_SPACE = "▁"
_PARTS = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
#: Bytes of text that is encoded at a time.
PIECE = 1 << 20
#: Bytes of each of the two generations of a worker's cache of words, which outlives its tasks.
CACHE_BYTES = 40 << 20
#: What a cache's entry takes besides its key and value, about.
ENTRY_BYTES = 64
#: Places for tested pairs of tokens, eight bytes each; two pairs of one place drive each other out.
PAIRS = 1_048_573
_CODECS: dict[str, "Codec"] = {}


class Recent(dict):
    """What ``find`` makes of a key (never None). The entries are a generation of about ``CACHE_BYTES``, whatever the size
    of keys and values; a full one becomes ``old`` and the one before it goes. What is asked for again moves up.
    """

    def __init__(self, find: Callable[[Hashable], object]) -> None:
        self.find, self.held, self.old = find, 0, {}

    def __missing__(self, key: Hashable) -> object:
        found = self.old.pop(key, None)
        if found is None:
            found = self.find(key)
        size = ENTRY_BYTES + sys.getsizeof(key) + sys.getsizeof(found)
        if size > CACHE_BYTES:
            return found
        if self.held + size > CACHE_BYTES:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[key] = found
        return found


class Codec:
    """The merge-type vocabulary of a model file: identity normalisation, a space put in front, byte fallback."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        self.ids = {t: i for i, t in enumerate(self.texts) if not special[i]}
        self.scores = [model.get_score(i) for i in range(size)]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else t.replace(_SPACE, " ").encode() for i, t in enumerate(self.texts)]
        self.is_byte = np.zeros(size, dtype=bool)
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
            self.is_byte[i] = True
        self.matches = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.matches.add_word(t, (i, len(t)))
        self.matches.make_automaton()
        self.chars = {t for t in self.ids if len(t) == 1}
        self.pairs = array("q", [-1]) * PAIRS
        self.whole = [None] * size
        self.words = Recent(lambda t: self._packed(t[1:] if t.startswith("\n") else _SPACE + t))  # a newline: no space in front
        self.newline = self._packed("\n")

    def merged(self, text: str) -> list[int]:
        """The definition: the adjacent pair whose union has the best score is merged first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (k := self.ids.get(both := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.scores[k], i, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        out: list[int] = []
        for p in parts:
            if p is not None:
                k = self.ids.get(p)
                out.extend([k] if k is not None else [self.byte_ids[b] for b in p.encode()])
        return out

    def _alone(self, i: int) -> bool:
        if self.whole[i] is None:
            self.whole[i] = self.merged(self.texts[i]) == [i]
        return self.whole[i]

    def _together(self, key: int) -> bool:
        """May token j follow token i, for the key i * pieces + j: the text of both is encoded as these two."""
        held = self.pairs[key % PAIRS]
        if held >> 1 != key:
            i, j = divmod(key, len(self.texts))
            held = self.pairs[key % PAIRS] = key << 1 | (self.merged(self.texts[i] + self.texts[j]) == [i, j])
        return bool(held & 1)

    def _known(self, text: str) -> list[int]:
        """A text of known characters without runs of spaces: the table of last tokens, read from its end."""
        last, pairs, size = [-1] * (len(text) + 1), self.pairs, len(self.texts)
        for end, (i, n) in self.matches.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if n == end:
                if self._alone(i):
                    last[end] = i
                continue
            if (before := last[end - n]) < 0:
                continue
            held = pairs[(key := before * size + i) % PAIRS]
            if held & 1 if held >> 1 == key else self._together(key):
                last[end] = i
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(self.texts[last[at]])
        return out[::-1]

    def _segments(self, text: str) -> list[int]:
        """Tokens don't reach over the begin of a run of spaces, nor over characters without a piece."""
        if _SPACE not in text[1:] and self.chars.issuperset(text):
            return self._known(text)
        out: list[int] = []
        for part in _PARTS.findall(text):
            if part.startswith(_SPACE * 2):  # the pieces of runs have equal scores, so order decides
                if self.chars.issuperset(part) and len(part) < 4096:
                    out += self.merged(part)
                    continue
                run = len(part) - len(part.lstrip(_SPACE))
                stop = next((k for k in range(run, len(part)) if part[k] not in self.chars), len(part))
                out += self.merged(part[:stop])
                part = part[stop:]
            run = []
            for c in part:
                if c in self.chars:
                    run.append(c)
                    continue
                if run:
                    out += self._known("".join(run))
                    run = []
                out += [self.byte_ids[b] for b in c.encode()]
            if run:
                out += self._known("".join(run))
        return out

    def _packed(self, text: str) -> bytes:
        """Ids as bytes of int32."""
        return array("i", self._segments(text)).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _SPACE in text:
            return self._packed(_SPACE + text.replace(" ", _SPACE))
        out: list[bytes] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.newline)
            words = line.split(" ")
            if k == 0:
                out.extend(map(self.words.__getitem__, words) if "" not in words or words == [""] else [self.words["\n" + _SPACE + line.replace(" ", _SPACE)]])
            elif "" not in words[1:]:
                if words[0]:
                    out.append(self.words["\n" + words[0]])
                out.extend(map(self.words.__getitem__, words[1:]))
            else:
                out.append(self.words["\n" + line.replace(" ", _SPACE)])
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Pieces in a row, without the space put in front; bytes that are no character become U+FFFD each."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(ids):
                to = at + 1
                while to < len(ids) and self.is_byte[ids[to]] == self.is_byte[ids[at]]:
                    to += 1
                part = b"".join(map(self.bytes.__getitem__, ids[at:to].tolist()))
                out.append(_bytes_apart(part) if self.is_byte[ids[at]] else part.decode("utf-8"))
                at = to
            text = "".join(out)
        return text[1:] if text.startswith(" ") and len(ids) and not self.is_byte[ids[0]] else text


def _bytes_apart(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def codec(model: bytes) -> Codec:
    """The codec of a model file's bytes, one in each worker."""
    key = model[:64].hex() + str(hash(model))
    if key not in _CODECS:
        handle, path = tempfile.mkstemp()
        try:
            with os.fdopen(handle, "wb") as f:
                f.write(model)
            _CODECS[key] = Codec(path)
        finally:
            os.unlink(path)
    return _CODECS[key]


def encode_and_decode(df: DataFrame, model_path: str, text: str = "text", decode: bool = True) -> DataFrame:
    """``df`` with ``ids`` array<int> (no begin or end ids) and, unless switched off, ``decoded`` string.

    Each text is encoded whole, as the library with this model does it; null counts as empty: no ids, decoded ''. Texts
    meet no other text, so nothing is shuffled and repeated rows cost their own work. Columns ``ids`` and ``decoded`` of
    ``df`` are replaced. The model file is read on the driver (half a megabyte) and sent with the task.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    rows = df.select(*[c for c in df.columns if c.lower() not in ("ids", "decoded")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(model)
        for whole in batches:
            for batch in slices(whole, text, PIECE):
                found = [known.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
                ends = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(f) // 4 for f in found], out=ends[1:])
                flat = np.frombuffer(b"".join(found), dtype=np.int32)
                columns = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decode:
                    columns.append(pa.array([known.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "ids", *["decoded"] * decode])

    extra = [StructField("ids", ArrayType(IntegerType())), *[StructField("decoded", StringType())] * decode]
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *extra]))
