import collections
import hashlib
import random

import pytest

from panelrisk.llm import repeats


def brute(texts, depth):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + depth] for b in raw for i in range(len(b) - depth + 1))
    out = []
    for b in raw:
        mask = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if seen[b[i:i + depth]] > 1:
                mask[i:i + depth] = b"\x01" * depth
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        out.append((len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    draw = random.Random(6)
    word = lambda n, a="abcdé ": "".join(draw.choice(a) for _ in range(n))
    passage = word(90)
    out = [None, "", word(30), "a" * 500, word(300, "ab"), "ab" * 100]
    out += [word(50) + passage + word(50) for _ in range(12)]
    base = word(400)
    out += [base, base, base[:200] + "#" + base[200:], base[:90] + "?" * 3 + base[95:]]
    return out


@pytest.mark.parametrize("local", [2048, 1])
def test_same_as_brute_force(make, monkeypatch, local):
    monkeypatch.setattr(repeats, "LOCAL", local)  # 1: every mixed group goes the crowded way
    given = texts()
    rows = {r["doc_id"]: r for r in repeats.remove_repeats(make(given), depth=40, digit=12).collect()}
    for i, e in enumerate(brute(given, 40)):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == e, i


def test_repeated_rows_and_empty_table(make):
    rows = repeats.remove_repeats(make(["x" * 50 + "yz" * 9] * 2, ids=[7, 7]), depth=40, digit=12).collect()
    assert [r["n_removed"] for r in rows] == [68, 68]
    assert repeats.remove_repeats(make([]), depth=40, digit=12).count() == 0
