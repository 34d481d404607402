"""The definitions, written plainly."""
from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import sentencepiece

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def repeats(texts, length=35):
    words = [(t or "").encode().split() for t in texts]
    runs = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if runs[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def shingles(text, size):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def classes(rows, size=3, percent=90):
    """{row number: (set size, least id)} of rows (id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(len(s), rows[i][0] if not s else least.get(root(i))) for i, s in enumerate(sets)]


def ways(text, pieces, byte):
    """(probability, pieces) of every segmentation; a character without a piece is written as its bytes."""
    if not text:
        yield 1.0, []
        return
    if text[0] not in pieces:
        n = len(text[0].encode())
        for p, rest in ways(text[1:], pieces, byte):
            yield p * byte**n, ["byte"] * n + rest
    for end in range(1, len(text) + 1):
        if text[:end] in pieces:
            for p, rest in ways(text[end:], pieces, byte):
                yield p * pieces[text[:end]], [text[:end], *rest]


def expected_pieces(text, pieces, byte):
    counts, all_ways = Counter(), list(ways(text, pieces, byte))
    total = sum(p for p, _ in all_ways)
    for p, used in all_ways:
        for x in used:
            counts[x] += p / total
    return counts


def learnt_scores(rows, held, model_path, rounds, smoothing):
    """log10 probabilities of the texts under weights learnt by plain expectation maximisation."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    own = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(own, key=lambda i: -model.get_score(i))
    raw = {i: 1 / (10 + r) for r, i in enumerate(ranked)}
    total = sum(raw.values()) + (size - len(own)) / (10 + size)
    weight = {i: raw.get(i, 1 / (10 + size)) / total for i in range(size)}
    byte = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
    names = {model.id_to_piece(i): i for i in own}
    texts = [[w.decode() for w in (t or "").encode().translate(LOWER).split()] for _, t in rows]

    def lattice(word):
        def go(rest):
            if not rest:
                yield 1.0, []
                return
            if rest[0] not in names:
                ids = [byte[b] for b in rest[0].encode()]
                for p, more in go(rest[1:]):
                    yield p * math.prod(weight[i] for i in ids), ids + more
            for end in range(1, len(rest) + 1):
                if rest[:end] in names:
                    i = names[rest[:end]]
                    for p, more in go(rest[end:]):
                        yield p * weight[i], [i, *more]

        return list(go("▁" + word))

    taught = Counter(w for t, h in zip(texts, held) if not h for w in t)
    for _ in range(rounds):
        counts = Counter({model.eos_id(): float(sum(not h for h in held))})
        for word, n in taught.items():
            found = lattice(word)
            total = sum(p for p, _ in found)
            for p, ids in found:
                for i in ids:
                    counts[i] += n * p / total
        usable = [*own, *byte.values(), model.eos_id()]
        total = sum(counts.values()) + smoothing * len(usable)
        weight = {i: (counts[i] + smoothing) / total for i in usable}
    logs = {w: math.log10(sum(p for p, _ in lattice(w))) for t in texts for w in t}
    return {d: sum(logs[w] for w in t) + math.log10(weight[model.eos_id()]) for (d, _), t in zip(rows, texts)}


def segmentations(text, pieces):
    """Sum of the products of piece probabilities over all segmentations."""
    total = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        total[end] = sum(total[s] * pieces[text[s:end]] for s in range(end) if text[s:end] in pieces)
    return total[-1]
