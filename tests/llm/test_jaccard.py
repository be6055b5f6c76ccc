import random
import re

import pyarrow as pa
import pytest

from panelrisk.llm import jaccard


def brute(texts):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    part = list(range(len(sets)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def texts():
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    common = some(60)
    out = [None, "", "  ", "one two", "One  TWO", "one two three four five"]
    base = some(120)
    for _ in range(40):  # a large group of near copies, some too far from each other
        w = list(base)
        for _ in range(draw.randint(0, 5)):
            w[draw.randrange(len(w))] = draw.choice(vocabulary)
        out.append(" ".join(w))
    out += [" ".join(some(20) + common + some(draw.randint(5, 80))) for _ in range(40)]
    return out + out[6:9]


@pytest.mark.parametrize("rounds,frequent,block", [(8, 1 << 17, 256), (1, 4, 4), (0, 0, 3)])
def test_same_as_brute_force(make, monkeypatch, rounds, frequent, block):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    given = texts()
    rows = {r["doc_id"]: r for r in jaccard.linked_groups(make(given), frequent=frequent).collect()}
    for i, (n, c) in enumerate(brute(given)):
        assert (rows[i]["n_shingles"], rows[i]["component_id"]) == (n, c), i


def test_nulls_repeated_rows_and_empty_table(make):
    text = "a b c d e f g h"
    rows = jaccard.linked_groups(make([text, text, text, ""], ids=[5, 5, None, None])).collect()
    assert sorted(r["component_id"] or -1 for r in rows) == [-1, 5, 5, 5]
    assert jaccard.linked_groups(make([])).count() == 0


def test_one_of_each_group_stays(make):
    given = texts()
    docs = make(given)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {i for i, (n, c) in enumerate(brute(given)) if n == 0 or c == i}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    twice = jaccard.keep_one(make(["a b c d e f"] * 3, ids=[1, 1, 2]))
    assert [r["doc_id"] for r in twice.collect()] == [1]


def entries(comp, both, lead, n, pos):
    return [{"sid": 10 * c + i, "n": n, "pos": pos, "comp": 10 * c + i, "lead": lead, "both": o, "ln": 100}
            for c, o in zip(comp, both) for i in range(2)]


def opened(x, y, same=False):
    def columns(rows):
        return {k: [r[k] for r in rows] for k in rows[0]}

    batch = pa.RecordBatch.from_pylist([{"same": same, "x": columns(x), "y": columns(y)}])
    return [tuple(r.values()) for out in jaccard._opened(iter([batch])) for r in out.to_pylist()]


def test_answers_of_a_leader_link_or_exclude():
    # 100 n-grams each: an overlap of 89 links; 96 + 95 - 100 = 91 is enough, 100 - 100 + 80 is not
    near, other = entries([1], [96], 7, 100, 2), entries([2], [95], 7, 100, 2)
    assert opened(near, other) == [(a, b, True) for a in (10, 11) for b in (20, 21)]
    assert opened(near, entries([3], [80], 7, 100, 2)) == []
    # nothing is derived from another leader, positions alone exclude
    assert {s for *_, s in opened(near, entries([4], [80], 8, 100, 2))} == {False}
    assert opened(near, entries([5], [95], 8, 100, 12)) == []
    assert len(opened(near, near, same=True)) == 1


def test_many_block_pairs_are_told_apart_at_once(monkeypatch):
    def block(*entries):
        return {k: list(v) for k, v in zip(("sid", "n", "pos", "comp", "lead", "both", "ln"), zip(*entries))}

    a, b, c = (1, 10, 0, 1, 9, 10, 10), (2, 10, 0, 2, 9, 10, 10), (3, 10, 0, 3, 3, 10, 10)
    late, large, mate = (4, 10, 5, 4, 4, 10, 10), (5, 20, 0, 5, 5, 20, 20), (6, 10, 0, 3, 6, 10, 10)
    one, two, three = block(a, b, c), block(late, large), block(mate)
    kind = pa.struct([(k, pa.list_(pa.int64())) for k in one])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([True, False, False]), pa.array([one, one, one], kind), pa.array([one, two, three], kind)],
        names=["same", "x", "y"])
    want = {(1, 2, True), (1, 3, False), (2, 3, False), (1, 6, False), (2, 6, False)}
    for size, batches in ((1 << 18, 1), (1, 3)):
        monkeypatch.setattr(jaccard, "OPENED", size)
        out = list(jaccard._opened(iter([batch])))
        assert len(out) == batches
        assert {tuple(r.values()) for o in out for r in o.to_pylist()} == want
