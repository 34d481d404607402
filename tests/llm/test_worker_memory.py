"""What a Python worker holds while it works, and what it keeps for later tasks."""
import gc
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from panelwise.llm import language, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


class _Sent:
    def __init__(self, value) -> None:
        self.value = value


@pytest.fixture
def traced():
    """Calls a function: its result, MB held at most meanwhile, MB kept afterwards besides the result."""

    def run(f):
        gc.collect()
        tracemalloc.start()
        try:
            out = f()
            gc.collect()
            kept, peak = tracemalloc.get_traced_memory()
        finally:
            tracemalloc.stop()
        return out, peak / 1e6, kept / 1e6

    return run


def test_codec_keeps_bounded_bytes_of_words_and_long_lines(traced, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 200_000, raising=False)
    codec = pieces.Codec(MODEL)
    texts = [f"line {i}\n" + "  ".join(f"some{i} value{i % 7} again" for _ in range(100)) for i in range(300)]
    texts += [" ".join(f"word{i}x{k}" for k in range(20)) for i in range(300)]
    _, _, kept = traced(lambda: [codec.encode(t) for t in texts] and None)
    assert kept < 1.5  # 3.1 when entries were counted, whatever their size


def test_codec_with_tiny_caches_encodes_like_the_library(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 400, raising=False)
    monkeypatch.setattr(pieces, "PAIRS", 3, raising=False)
    codec, library = pieces.Codec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["one two one two three", "a  b\n\n  c d", "", " ", "\n", "x\ny\nx y\n x", "▁a ▁▁b", "Zürich 東京 \x01 é", "one " * 200, "n" * 500]
    for text in [*texts, *texts]:
        assert np.frombuffer(codec.encode(text), dtype=np.int32).tolist() == library.encode(text)


def _texts() -> list[str | None]:
    return [None, "", "7 8", *[("The river %d was there, " % i) * 40 for i in range(2000)], "ends here. ", " begins here", "q" * 5000]


def _runs(texts: list[str | None]) -> dict:
    n = len(texts)
    model = np.log(np.random.default_rng(3).random((3, 1 << 16)) + 0.1).astype(np.float32)
    declared = pa.array([("en", "fr", None)[i % 3] for i in range(n)])
    nothing, text = pa.nulls(n, pa.string()), pa.array(texts, pa.string())
    count = pa.RecordBatch.from_arrays([text, declared], names=["text", "declared"])
    best = pa.RecordBatch.from_arrays([text, declared, nothing, nothing], names=["text", "declared", "suffix", "host"])
    row = pa.StructArray.from_arrays([pa.array(range(n)), text], names=["id", "text"])
    fuse = pa.RecordBatch.from_arrays([row, declared, nothing, pa.nulls(n, pa.list_(pa.float64()))], names=["row", "declared", "suffix", "prior"])
    return {
        "count": lambda: pa.Table.from_batches(language._count(["en", "fr"])(iter([count]))).to_pydict(),
        "best": lambda: pa.Table.from_batches(language._best(_Sent(model))(iter([best]))).to_pydict(),
        "fuse": lambda: pa.Table.from_batches(language._fuse(_Sent((model, {}, {}, np.array([0.5, 0.5]))), ["en", "fr"], "text")(iter([fuse]))).drop_columns(["row"]).to_pydict(),
    }


@pytest.mark.parametrize("step", ["count", "best", "fuse"])
def test_language_holds_few_trigrams_at_a_time(traced, step):
    _, peak, _ = traced(_runs(_texts())[step])
    assert peak < 45  # 2 MB of text as arrays took 66 to 68


@pytest.mark.parametrize("step", ["count", "best", "fuse"])
def test_language_does_not_depend_on_the_pieces(monkeypatch, step):
    run = _runs(_texts()[:60] + _texts()[-3:])[step]
    whole = run()
    monkeypatch.setattr(language, "PIECE", 64)
    assert run() == whole
