import collections
import math
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelrisk.llm import bytesops as B, language, quality, scoring
from panelrisk.llm.eliasfano import EliasFano, NgramTrie
from panelrisk.llm.sampling import remainder
from panelrisk.storage import run_dir

ODD = [None, "", " \n ", "...", "12 34", "x" * 300_000, "same", "same"]


def held(spark):
    return remainder(F.col("doc_id"), 5) == 0


def test_remainder_is_crc32(make):
    ids = [0, 7, 10**12, -3]
    rows = make(["a"] * 4, ids=ids).select("doc_id", remainder(F.col("doc_id"), 5).alias("m")).collect()
    assert [r["m"] for r in rows] == [zlib.crc32(str(i).encode()) % 5 for i in ids]


# -- quality

def test_quality_on_held_out_rows(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels, ~held(spark))
    assert 0.6 < model.prior <= 0.98
    rows = quality.score_documents(docs, model).select("row.doc_id", "score", "predicted").join(labels, "doc_id")
    rows = rows.where(held(spark)).collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.95


def test_negative_risk_is_walked_back():
    draw = np.random.default_rng(0)
    p, n = draw.normal(1, 1, (300, 5)), draw.normal(-1, 1, (100, 5))
    u = np.vstack([draw.normal(1, 1, (200, 5)), draw.normal(-1, 1, (200, 5))])
    model = quality.fit(
        p, u, np.vstack([p, n]), np.r_[np.ones(300), np.zeros(100)], np.arange(len(p)) % 3, np.arange(len(u)) % 3)
    assert 0.3 < model.prior < 0.75
    assert (model.margin(p) > 0).mean() > 0.9 and (model.margin(n) < 0).mean() > 0.9


def test_quality_of_odd_texts(make, spark):
    labels = spark.createDataFrame([(6, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = make(ODD)
    model = quality.train(docs, labels, F.lit(True))
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["row"]["text"] == "same"}) == 1
    assert quality.train(docs, labels.limit(0), F.lit(True)) is None
    assert {r["score"] for r in quality.score_documents(docs, None).collect()} == {0.5}
    assert quality.score_documents(make([]), model).count() == 0


# -- language

def test_language_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/../sf0.01/documents.parquet")
    model = language.train(docs, ~held(spark), per_language=60)
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held(spark)).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and not all(r["rejected"] for r in rows)


def test_language_of_odd_texts(make):
    docs = make(["the cat and the dog"] * 5, lang="en").unionByName(make(["le chat et le chien"] * 5, ids=range(10, 15), lang="fr"))
    model = language.train(docs, F.lit(True))
    rows = {r["doc_id"]: r for r in language.identify(make([*ODD, "the dog", "le chien", "жжж ъъъ"]), model).collect()}
    assert [rows[i]["lang_pred"] for i in range(5)] == ["und"] * 5 and rows[0]["score"] == 0
    assert rows[8]["lang_pred"] == "en" and rows[9]["lang_pred"] == "fr" and rows[10]["rejected"]
    assert language.train(make([]), F.lit(True)) is None
    assert [r["lang_pred"] for r in language.identify(make(["a"]), None).collect()] == ["und"]


def test_language_is_learned_from_whole_texts(make):
    english = "the cat and the dog went over there with that thing "
    french = "le chat et le chien sont allés là-bas avec cette chose "
    docs = make([english * 100] * 3, lang="en").unionByName(
        make([english * 500 + french * 1500], ids=[10], lang="fr"))
    model = language.train(docs, F.lit(True))
    rows = language.identify(make(["le chien est avec cette chose", "the dog and that thing"]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in rows} == {0: "fr", 1: "en"}


def test_smoothed_shares_sum_to_one():
    """After every context the model spends at most one, and all of it over the seen characters."""
    texts = ["abracadabra", "barbara"]
    chars, first = language.letters(texts)
    counts, prefix = {}, language._char_hash(chars)
    for order in range(1, language.ORDER + 1):
        gram, last = language.grams(chars, first, order)
        found, where, n = np.unique(gram, return_index=True, return_counts=True)
        spot = last[where]
        from panelrisk.llm import bytesops as B

        counts[order] = [np.zeros(len(found), np.int64), found, B.span_hash(prefix, spot - order + 1, spot),
                         B.span_hash(prefix, spot - order + 2, spot + 1), n]
    model = language.build(["x"], counts, np.array([np.inf]))
    total = 0.0
    for c in "abrcd ":  # each as the next letter of one context
        at, begin = language.letters(["abr" + c])
        total += math.exp(-model.entropies(at, begin)[0, 0] * len(at) + model.entropies(at[:-1], np.array([0, len(at) - 1]))[0, 0] * (len(at) - 1))
    assert 0.9 < total <= 1.0 + 1e-6


# -- scoring

def reference(texts, out):
    toks = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [None] for t in texts]
    c = collections.Counter(w for t, o in zip(toks, out) if not o for w in t)
    n, v = sum(c.values()), len(c)
    return [(len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for t in toks]


@pytest.mark.parametrize("head", [2.0 ** -20, 0.2])
def test_scores_same_as_brute_force(make, head):
    texts = [*ODD, "the cat sat", "the cat ran", "the dog sat on the cat", "The CAT sat"] * 3
    ids = list(range(len(texts)))
    out = [zlib.crc32(str(i).encode()) % 5 == 1 for i in ids]
    rows = scoring.score_documents(make(texts), remainder(F.col("doc_id"), 5) == 1, head=head, keep=0.001).collect()
    for r in rows:
        n, known, total, base = reference(texts, out)[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, out[r["doc_id"]])
        assert abs(r["base_score"] - base) < 1e-8 * max(1, abs(base)) and r["score"] <= 1e-9
    if head > 0.1:
        return  # no word is frequent enough for an n-gram: both scores are the base
    cats = [r for r in rows if texts[r["doc_id"]] == "the cat sat"]
    assert all(r["score"] > r["base_score"] for r in cats)


def test_scoring_without_training_rows(make):
    rows = scoring.score_documents(make(["a b", None]), F.lit(True)).collect()
    assert [r["train_tokens"] for r in rows] == [0, 0] and all(r["n_known"] == 0 for r in rows)
    assert scoring.score_documents(make([]), F.lit(False)).count() == 0


def test_elias_fano_reads_and_finds():
    draw = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 50), (2000, 1 << 50)):
        values = np.sort(draw.integers(0, top, n))
        ef = EliasFano(values)
        assert (ef.get(np.arange(n)) == values.astype(np.uint64)).all()
        if n:
            probe = np.concatenate([values, draw.integers(0, top, 50)]).astype(np.uint64)
            at = ef.find(probe, np.zeros(len(probe), np.int64), np.full(len(probe), n))
            assert ((at >= 0) == np.isin(probe, values.astype(np.uint64))).all()
            assert (ef.get(at[at >= 0]) == probe[at >= 0]).all()


def test_trie_is_mapped_from_files(tmp_path):
    pairs = np.array([[0, 1], [0, 2], [1, 0], [1, 2], [2, 0]])
    triples = np.array([[0, 1, 0], [0, 1, 2], [1, 2, 0]])
    trie = NgramTrie(3, pairs, -np.arange(1.0, 6), -np.ones(3), triples, -np.arange(1.0, 4), -np.ones(5))
    trie.save(str(tmp_path))
    for t in (trie, NgramTrie.load(str(tmp_path))):
        at = t.pair(np.array([0, 0, 2, 2]), np.array([1, 0, 0, 2]))
        assert at.tolist() == [0, -1, 4, -1]
        third = t.triple(np.array([0, 0]), np.array([1, 1]), np.array([2, 3]))
        assert third.tolist() == [0, 1] and np.allclose(t.triple_p.get(third), [-1, -2])


def test_words_with_the_same_hash_input_order():
    h, row = scoring.tokens(pa.array(["b a", None, "a"]))
    assert row.tolist() == [0, 0, 0, 1, 2, 2] and h[1] == h[4] and h[2] == h[3] == h[5] == scoring.END


@pytest.mark.parametrize("part, hot", [(scoring.PART, 0), (3000, 0), (3000, 2)])
def test_every_repeated_ngram_counts_at_any_size(make, part, hot):
    """300,000 filler tokens raise the share of one occurrence above 2^-19; both n-grams occur twice only."""
    draw = np.random.default_rng(5)
    filler = [" ".join(f"w{i}" for i in draw.integers(0, 3000, 3000)) for _ in range(100)]
    if hot:  # a word with a quarter of all tokens is dealt over several parts
        filler = [re.sub(r"w\d*[02468]\b (?=w\d*[13579]\b)", "hot ", t) for t in filler]
    train = [*filler, "ape bee cow", "ape bee cow", "the ape", "the ape"]
    texts = ["ape bee cow", "the ape bee", filler[0]]
    docs = make([*train, *texts])
    rows = {r["doc_id"]: r for r in scoring.score_documents(docs, F.col("doc_id") >= len(train), part=part).collect()}
    toks = [t.split() + [None] for t in [*filler, "ape bee cow", "ape bee cow", "the ape", "the ape"]]
    c1 = collections.Counter(w for t in toks for w in t)
    c2 = collections.Counter(p for t in toks for p in zip(t, t[1:]))
    c3 = collections.Counter(p for t in toks for p in zip(t, t[1:], t[2:]))
    c2, c3 = ({k: n for k, n in c.items() if n > 1} for c in (c2, c3))
    n, v = sum(c1.values()), len(c1)
    back2, back3 = collections.Counter(), collections.Counter()
    for (a, _), k in c2.items():
        back2[a] += (k - 0.75) / c1[a]
    for (a, b, _), k in c3.items():
        back3[a, b] += (k - 0.75) / c2[a, b]

    def p(u, a, w):
        low = (c1[w] + 0.5) / (n + 0.5 * (v + 1))
        if a is not False:
            low = max(c2.get((a, w), 0) - 0.75, 0) / c1[a] + (1 - back2[a]) * low if c1[a] > 1 else low
        if u is not False and (u, a) in c2:
            low = max(c3.get((u, a, w), 0) - 0.75, 0) / c2[u, a] + max(1 - back3[u, a], 1e-9) * low
        return math.log10(low)

    for k, text in enumerate(texts):
        t = text.split() + [None]
        want = sum(p(t[i - 2] if i > 1 else False, t[i - 1] if i else False, w) for i, w in enumerate(t))
        s = rows[len(train) + k]
        # one byte a value: outliers share a mean with others of their quantile
        assert abs(s["score"] - want) < (0.01 if text is filler[0] else 0.06) * abs(s["base_score"])
    same = [rows[k]["score"] for k in (0, len(train) + 2)]  # a row of training and its copy
    assert abs(same[0] - same[1]) < 1e-3 and rows[0]["train_tokens"] == n


def test_levels_go_once_they_are_looked_up(make, spark):
    filler = [" ".join(f"w{i % 7} x{i % 5}" for i in range(300)) for _ in range(10)]
    before = set(Path(run_dir(spark)).glob("scoring-*"))
    scored = scoring.score_documents(make(filler), F.lit(False), part=500)  # very frequent words are dealt
    assert scored.count() == 10
    made = [p for p in Path(run_dir(spark)).glob("scoring-*") if p not in before]
    assert len(made) == 1 and list(made[0].glob("levels/words-*")) and not list(made[0].glob("levels/part-*"))


def test_scratch_of_a_worker_stays_small():
    """Python workers share the memory of their executor; a batch of 20 MB must not take several times as much."""
    column = pa.array([" ".join(f"word{(i * 7 + k) % 997}" for k in range(260)) for i in range(10_000)])
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    B.powers(1)
    tracemalloc.start()
    try:
        for piece in B.pieces(batch, "text", quality.ROWS):
            quality.features(piece.column("text"))
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()


def test_membership_from_slots():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 70_000):
        keys = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        probe = np.concatenate([keys, keys + np.uint64(1), draw.integers(0, 1 << 63, 99, dtype=np.uint64)])
        assert (B.membership_from(B.key_starts(keys), keys, probe) == B.membership(keys, probe)).all()


def test_a_part_gets_no_followers_that_it_does_not_have(make, spark):
    """Followers of a very frequent word went whole to each of its parts: parts times followers, both grow with the texts."""
    draw = np.random.default_rng(8)
    texts = [" ".join(f"a{i % 50} hot w{i}" for i in draw.integers(0, 400, 300)) for _ in range(60)]
    docs = make(texts).select("text", F.lit(False).alias("held_out"))
    scratch = scoring.Scratch(spark, "followers")
    model, _ = scoring.train(docs, scratch, part=2000)
    assert list(model.spread.values()) == [9]
    rows = scoring._hot_followers(docs, model, scratch).toPandas()
    v, w, high, low = np.concatenate([scoring._unpack(b, 4, n) for b, n in zip(rows["blob"], rows["n"])], axis=1).astype(np.int64)
    part = np.repeat(rows["part"].to_numpy(), rows["n"])
    words = np.unique(scoring.tokens(pa.array([" ".join(f"a{i}" for i in range(50))]))[0])
    followers = {}  # of each part, by the words before that are dealt to it
    for t in texts:
        h = scoring.tokens(pa.array([t]))[0]
        n = model.vocabulary.numbers(h)
        at = np.flatnonzero(np.isin(h[:-2], words))
        for k, x in zip(model.part_of(n[at], n[at + 1]), n[at + 2]):
            followers.setdefault(int(k), collections.Counter())[int(x)] += 1
    total = sum(followers.values(), collections.Counter())
    got = collections.defaultdict(dict)
    for k, x, a, b in zip(part, w, high, low):
        got[int(k)][int(x)] = int(a << 31 | b)
    assert got == {k: {x: total[x] for x in c if total[x] > 1} for k, c in followers.items()}
    assert len(w) <= len(total) * len(followers) // 3
    left = 1 - sum(c - 0.75 for c in total.values() if c > 1) / model.vocabulary.counts(v[:1])[0]
    assert abs(model.back[1][0] - max(left, 1e-9)) < 1e-9
