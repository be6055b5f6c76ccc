import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from panelrisk.llm import spelling
from panelrisk.llm.wavelet import WaveletMatrix, rotation_order

LETTERS = "abcdeéü"


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs):
    counts = Counter()
    for doc, text in docs:
        for run in spelling.RUN.findall("".join(c.lower() if c.isascii() else c for c in text or "")):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def texts(draw, stems, documents):
    """Documents of stems, each now and then with one changed letter."""
    out = []
    for _ in range(documents):
        words = []
        for w in draw.choice(stems, 200, p=draw.dirichlet(np.full(len(stems), 0.3))):
            kind, at, c = draw.integers(12), draw.integers(len(w)), draw.choice(list(LETTERS))
            words.append(w[:at] + c + w[at + 1:] if kind == 0 else w[:at] + c + w[at:] if kind == 1 else w[:at] + w[at + 1:] if kind == 2 else w)
        out.append(draw.choice([" ", "1", "-"]).join(words).upper() if draw.random() < 0.3 else " ".join(words))
    return out


@pytest.mark.parametrize("shard", [8192, 40])
def test_against_brute_force(spark, make, shard, monkeypatch):
    monkeypatch.setattr(spelling, "SHARD", shard)  # 40: halves with more words than a shard holds
    draw = np.random.default_rng(11)
    stems = ["".join(draw.choice(list(LETTERS), draw.integers(5, 12))) for _ in range(60)]
    docs = texts(draw, stems, 40) + [" ".join("prefix" + draw.choice(list(LETTERS)) + draw.choice(list(LETTERS)) for _ in range(3000))]
    found = rows(spelling.variants(make(docs)))
    assert len(found) == len(set(found)) and set(found) == brute(list(enumerate(docs)))
    assert len(found) > 100 and sum(r[4] for r in found) > 100


def test_nulls_empty_texts_and_tables(spark, make):
    text = "Straße straße STRASSE " * 3 + "x" * 50_000 + " a-b"
    docs = make([text, None, "", "wordone " * 9, "wordone " * 9, "wordtwo"], [0, 1, 2, None, 7, 7])
    assert set(rows(spelling.variants(docs))) == brute(list(zip([0, 1, 2, None, 7, 7], [text, None, "", "wordone " * 9, "wordone " * 9, "wordtwo"])))
    assert rows(spelling.variants(make([]))) == [] and rows(spelling.variants(make([None, ""]))) == []


def test_ties_take_the_smallest_and_roots_follow(spark):
    counts = {"planet": 5, "planets": 30, "planetz": 30, "planetsx": 200, "abcdef": 5, "abcdeg": 25}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = {(r["word"], r["near"]) for r in spelling.near_pairs(words).collect()}
    assert pairs == {(a, b) for a in counts for b in counts if one_apart(a, b)}
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(w, "d") for w in "abcx"}


def test_index_searches_both_ways():
    words = ["banana", "bananas", "cabana", "havana", "savanna"]
    index = spelling.TwoWayIndex(words)
    for pattern in ("ana", "ban", "van", "s"):
        codes = np.searchsorted(index.alphabet, [ord(c) for c in pattern])
        for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2], [1, 2, 0]):
            if len(pattern) == 1:
                order = [0]
            state, placed = index.all(1), []
            for i in order:
                state = index.extend(state, codes[[i]], bool(placed) and i > max(placed))
                placed.append(i)
            ring = "\0" + "\0".join(words)
            expected = sum((ring + ring).startswith(pattern, i) for i in range(len(ring)))
            assert state[3].sum() == expected


def test_wavelet_and_rotations():
    draw = np.random.default_rng(3)
    for sigma in (1, 2, 7, 118):
        s = draw.integers(0, sigma, 500)
        m = WaveletMatrix(s, sigma)
        c, lo = draw.integers(0, sigma, 60), draw.integers(0, 500, 60)
        hi = np.array([draw.integers(a, 501) for a in lo])
        a, b, smaller = m.range(c, lo, hi)
        for k in range(60):
            assert m.rank(c[[k]], hi[[k]])[0] == b[k] == np.sum(s[:hi[k]] == c[k]) and a[k] == np.sum(s[:lo[k]] == c[k])
            assert smaller[k] == np.sum(s[lo[k]:hi[k]] < c[k])
        row, symbol, a, b, smaller = m.symbols(lo, hi)
        there = pd.DataFrame({"row": row, "symbol": symbol, "n": b - a, "smaller": smaller}).set_index(["row", "symbol"])
        for k in range(60):
            values, n = np.unique(s[lo[k]:hi[k]], return_counts=True)
            assert dict(zip(values, n)) == (there.loc[k]["n"].to_dict() if len(values) else {})
    text = "mississippi$"
    order = rotation_order(np.array([ord(c) for c in text]))
    assert [text[i:] + text[:i] for i in order] == sorted(text[i:] + text[:i] for i in range(len(text)))
