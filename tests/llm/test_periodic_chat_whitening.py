"""Runs, chat texts and whitening against plain definitions."""
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwise.llm import chat, periodic, whitening
from panelwise.llm.queries import QUERIES

TEXT = "doc_id long, text string"


def plain_runs(words):
    out = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                run = words[i : j + q]
                if not any(all(run[k] == run[k + d] for k in range(len(run) - d)) for d in range(1, q)):
                    out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def found_runs(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["row", "text"])
    out = [b.to_pylist() for b in periodic._describe(iter([batch]))]
    return [([(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) for b in out for r in b]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab") | st.sampled_from("abcde"), max_size=60), max_size=4))
def test_runs_of_few_words(texts):
    got = found_runs([" ".join(t) for t in texts])
    for t, (runs, text) in zip(texts, got):
        assert runs == plain_runs(t)
        assert text.encode() == collapsed([w.encode() for w in t], runs)


def test_runs_of_planted_periods():
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        t = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 2) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            a, p = rng.randint(0, len(t)), rng.randint(1, 12)
            block = [str(rng.randint(0, 9)) for _ in range(p)]
            t[a:a] = (block * 9)[: rng.randint(p, 9 * p)]
        texts.append(t)
    for t, (runs, text) in zip(texts, found_runs(["\t ".join(t) + "\n" for t in texts])):
        assert runs == plain_runs(t)
        assert text.encode() == collapsed([w.encode() for w in t], runs)


def test_one_long_text_of_one_period():
    (runs, text), = found_runs([" ".join(["start", *(f"w{i % 977}" for i in range(80_000)), "end"])])
    assert runs == [(1, 80_000, 977)] and len(text.split()) == 979
    (runs, text), = found_runs([" ".join(["x"] * 300_000)])
    assert runs == [(0, 300_000, 1)] and text == "x"


def test_runs_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "b b b b b b b", None), (3, "", "z"), (4, " \x85  ", "z")], f"{TEXT}, runs string")
    got = sorted(periodic.find_runs(docs).collect(), key=str)
    assert [(r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in got] == [(1, 0, 0, ""), (1, 0, 0, ""), (3, 0, 0, ""), (4, 1, 0, "\x85 "), (None, 7, 1, "b")]
    assert periodic.find_runs(docs.limit(0)).count() == 0


def altered(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_op11(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op11_frequency_split_runs"](spark, small).collect()
    assert len(got) == len(docs) and any(r.n_runs for r in got)
    for r in got:
        words = altered(r.doc_id, docs[r.doc_id])
        if len(words) > 1500:
            continue
        runs = plain_runs(words)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "{", "}", "0", "1", "<|end|>", "<|turn|>", "<|says|>", "</s>", "[INST]", "<", "|", "a", "\n"]), max_size=20).map("".join), st.text(max_size=8) | st.just("assistant"))
def test_template_is_reversible(text, role):
    t = chat.Template()
    formatted, a, b = t.render(role, text)
    assert t.read(formatted) == [(role, text)]
    assert not any(c in t.escape(text) for c in t._all)
    assert t.unescape(formatted[a:b]) == (text if role == "assistant" else "")
    twice = formatted + t.render("assistant", "<|end|>")[0]
    assert t.read(twice) == [(role, text), ("assistant", "<|end|>")]


def plain_fold(events):
    """Events (conversation, message, place, kind, role, text) one after the other, by place."""
    out = {}
    first = {}
    for e in sorted(events, key=lambda e: (e[2], e[3] or "", e[4] or "", e[5] or "")):
        first.setdefault((e[0], e[1], e[2]), e)
    for conv, message, place, kind, role, text in first.values():
        talk = out.setdefault(conv, {})
        m = talk.get(message)
        if kind == "message" and m is None:
            talk[message] = [role or "", text or "", True]
        elif m is not None and kind == "delta":
            m[1] += text or ""
        elif m is not None and kind in ("edit", "regenerate"):
            m[1] = text or ""
            for k in talk:
                if message < k < place:
                    talk[k][2] = False
    return {c: [(m, talk[m][0], talk[m][1]) for m in sorted(talk) if talk[m][2]] for c, talk in out.items()}


def test_log_of_events(spark):
    rng = random.Random(5)
    events = []
    for conv in range(30):
        opened = []
        for place in range(rng.randint(0, 40)):
            kind = rng.choice(["message", "message", "delta", "delta", "delta", "edit", "regenerate", "seen", None])
            if kind == "message" or not opened:
                opened.append(place)
                kind = "message"
            message = place if kind == "message" else rng.choice(opened + [997])
            row = (conv, message, place, kind, rng.choice(["user", "assistant", None]), rng.choice(["x", "</s>", "", None, str(place)]))
            events += [row] * rng.choice([1, 1, 1, 2])
    log = spark.createDataFrame(events, "c long, m long, s long, kind string, role string, text string").repartition(5)
    got = {}
    for r in chat.rebuild_and_render(log, "c", ["m"], ["s"]).collect():  # rows of a conversation are in order
        got.setdefault(r.c, []).append((r.m, r.role, r.text))
        assert chat.Template().read(r.formatted) == [(r.role, r.text)]
    assert got == {c: v for c, v in plain_fold(events).items() if v}
    assert chat.rebuild_and_render(log.limit(0), "c", ["m"], ["s"]).count() == 0


def plain_digest(turns):
    t = chat.Template()
    whole = "".join(t.render(r or "", x or "")[0] for r, x in turns)
    learnt = "".join(x or "" for r, x in turns if r == "assistant")
    digest = hashlib.sha256("".join(f"{r or ''}\n{x or ''}\n" for r, x in turns).encode()).hexdigest()
    return (len(turns), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(whole))


def test_op12(spark, small, tmp_path):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_event_sourced_chat"](spark, small).collect()}
    want = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(spark.read.parquet(f"{small}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: plain_digest(t) for c, t in want.items()}

    long = "äß<|end|>\\{0}" * 3000
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (1, 1, "assistant", long), (None, 3, None, "x"), (None, None, "assistant", "y"), (2, 0, "assistant", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_event_sourced_chat"](spark, str(tmp_path)).collect()}
    assert got[1] == plain_digest([("user", None), ("assistant", long), ("assistant", long)])
    assert got[None] == plain_digest([("assistant", "y"), (None, "x")])
    assert got[2] == plain_digest([("assistant", "")])


def test_exact_products():
    rng = np.random.default_rng(1)
    y = rng.integers(-(1 << 61), 1 << 61, (50, 4))
    assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def plain_polynomial(a):
    """Faddeev and LeVerrier, in integers."""
    n, m, c = len(a), np.zeros((len(a), len(a)), dtype=object), [1]
    for k in range(1, n + 1):
        m = a @ m + c[-1] * np.array(np.eye(n), dtype=int).astype(object)
        c.append(-int(np.trace(a @ m)) // k)
    return c[::-1]


@pytest.mark.parametrize("dim, rank", [(1, 1), (2, 1), (5, 5), (12, 12), (12, 4), (3, 0)])
def test_characteristic_polynomial(spark, dim, rank):
    rng = np.random.default_rng(dim)
    b = rng.integers(-1000, 1000, (dim, rank)).astype(object)
    a = (b @ b.T if rank else np.zeros((dim, dim), dtype=int)).astype(object)
    if rank == dim == 12:
        a[0, :] = a[:, 0] = 0  # no pivot in the first column
        a[0, 0] = 7
    poly = whitening.characteristic_polynomial(spark, a)
    assert poly == plain_polynomial(a)
    roots = [v / 2**bits for v, bits, times in whitening.largest_roots(poly, dim) for _ in range(times)]
    exact = np.linalg.eigvalsh(a.astype(float))[::-1][: len(roots)]
    assert len(roots) == (rank if rank < dim else dim) and np.allclose(roots, exact, rtol=1e-8)


def test_equal_eigenvalues():
    poly = [1]
    for root in (0, 0, 3, 7, 7, 7, 100):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    found = whitening.largest_roots(poly, 7)
    assert [(round(v / 2**b), t) for v, b, t in found] == [(100, 1), (7, 3), (3, 1)]
    vectors = whitening.null_space(np.diag([7, 100, 7, 3, 7, 0, 0]).astype(object), whitening.Decimal(7), 3)
    assert np.allclose(vectors @ vectors.T, np.eye(3)) and np.allclose(vectors[:, [1, 3, 5, 6]], 0)


def check_whitening(rows, got, count=8):
    x = {i: np.floor(1024 * np.array(v)) + 100000 for i, v in rows}
    m = np.array(list(x.values()))
    centred = m - m.mean(axis=0)
    cov = centred.T @ centred / len(m)
    values, vectors = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values) if values[k] > 1e-9 * max(values.max(), 1e-30)][:count]
    total = [int(v) for v in m.sum(axis=0)]
    for (key, v), (i, w) in zip(sorted(x.items()), sorted(got.items())):
        assert key == i and len(w["whitened"]) == len(order) and w["n"] == len(m)
        assert w["deviation"] == sum((len(m) * int(e) - s) ** 2 for e, s in zip(v, total))
        for k, value in enumerate(w["whitened"]):
            assert abs(abs(value) - abs((v - m.mean(axis=0)) @ vectors[:, order[k]]) / np.sqrt(values[order[k]])) < 1e-6
            assert w["explained"][k] == pytest.approx(values[order[k]] / np.trace(cov), rel=1e-9)
        assert w["identity_error"] < 1e-9


def test_whitening(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    table = QUERIES["op13_exact_polynomial_whitening"](spark, small)
    assert table.count() == 8 * len(rows)
    got = {}
    for r in table.orderBy("component").collect():
        w = got.setdefault(r.vec_id, {"n": r.n, "deviation": r.deviation, "identity_error": r.identity_error, "whitened": [], "explained": []})
        w["whitened"].append(r.whitened)
        w["explained"].append(r.explained)
    check_whitening(rows, got)


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, whitening string"
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [nan, 0.0, 0.0]), (94, [inf, 0.0, 0.0]), (95, [1.0, 2.0])]
    good = [(i, [float(i % 5), float(i % 3), 2.0]) for i in range(20)]
    df = spark.createDataFrame([(i, v, "x") for i, v in bad + good], schema)
    got = {r.vec_id: r.whitening.asDict() for r in whitening.whiten(df).collect()}
    check_whitening(good, got)
    assert len(got[0]["whitened"]) == 2  # the third dimension never changes
    same = spark.createDataFrame([(1, [0.5, 0.5], "x")] * 3, schema)
    assert [(r.whitening.n, r.whitening.deviation, r.whitening.whitened, r.whitening.identity_error) for r in whitening.whiten(same).collect()] == [(3, 0, [], 0.0)] * 3
    assert whitening.whiten(df.limit(0)).columns == ["vec_id", "embedding", "whitening"] and whitening.whiten(df.limit(0)).count() == 0
    far = spark.createDataFrame([(1, [3e38, 1.0], "x"), (2, [-3e38, 2.0], "x"), (3, [0.0, 3.0], "x")], schema)
    assert [r.whitening.deviation for r in whitening.whiten(far).collect()] == [None, None, 3072**2]
