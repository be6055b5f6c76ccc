import random
import re

from panelrisk.llm import decontamination as D


def words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


def brute(texts, items, window=10):
    patterns = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for p, owners in patterns.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= owners
        out.append((len(w), len(hit), sorted(found)))
    return out


def cases():
    draw = random.Random(5)
    some = lambda n: " ".join(draw.choice("the of to and a in ox é be no".split()) for _ in range(n))
    items = [(1, some(25)), (22, some(12)), (3, "Two words"), (4, ""), (5, None), (6, some(10)), (7, "Two, WORDS!")]
    texts = [None, "", "...", "two. words", some(5000), items[0][1].upper(), "x " + items[1][1] + " y " + items[0][1],
             items[5][1] + " " + items[5][1], "only clean text here", "only clean text here"]
    return texts, items


def test_same_as_brute_force(make, spark):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (D.BLOCK_BYTES, 64):  # one block, and many
        rows = {r["doc_id"]: r for r in D.locate_windows(make(texts), bench, block_bytes=block).collect()}
        for i, expected in enumerate(brute(texts, items)):
            r = rows[i]
            assert (r["n_words"], sum(b - a for a, b in r["spans"]), sorted(r["items"])) == expected
    assert D.digest(D.locate_windows(make(texts), bench)).where("contaminated").count() == sum(
        e[1] > 0 for e in brute(texts, items))


def test_removal_keeps_columns_and_clean_texts(make, spark):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make(texts)
    clean = D.remove_windows(docs, bench)
    assert clean.columns == docs.columns
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    for i, (t, e) in enumerate(zip(texts, brute(texts, items))):
        if not e[1]:
            assert after[i] == t
        else:
            assert len(words(after[i])) == e[0] - e[1]


def test_empty_tables(make, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in D.digest(D.locate_windows(make(["a b"]), none)).collect()] == [0]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.locate_windows(make([]), some).count() == 0


def test_scan_and_removal_share_a_worker(make, spark):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = D.remove_windows(make(texts), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    kept = {r["doc_id"]: r["text"] for r in D.remove_windows(make(texts), bench).collect()}
    blocks = D.locate_windows(make(texts), bench, block_bytes=64)
    spans = {r["doc_id"]: r["byte_spans"] for r in blocks.collect()}
    for i, t in enumerate(texts):
        assert kept[i] == (t if t is None else D.cut_spans(t.encode(), spans[i]).decode())
