import re

from pyspark.sql import functions as F

from panelrisk.llm import pii

KEY = "test key"


def test_one_surrogate_for_one_value_in_every_form(make):
    texts = [
        "Mr. John Smith met Mrs Smith. SMITH. Call +1 (913) 555-3797 or +1 913 555 3797!",
        "card 4444-3333-2222-1111 / 4444333322221111, a.b@mail.example.com A.B@Mail.example.com",
        "10.0.0.1 and 10.0.0.1. token = \"e7fbfec6a80404dc513b99d3fdbf2a6e\" E7FBFEC6A80404DC513B99D3FDBF2A6E",
        "Господин Иван Петров, 078-05-1120, DE89370400440532013000",
    ]
    out = {r["doc_id"]: r for r in pii.replace_values(make(texts), KEY).collect()}
    a, b, c, d = (out[i]["text"] for i in range(4))
    first = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+)\. SMITH\. Call (.*) or (.*)!$", a)
    assert first and first[2] == first[3] != "Smith" and first[1] in pii.GIVEN[("m", "latin")]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", first[4]) and re.sub(r"\D", "", first[4]) == re.sub(r"\D", "", first[5])
    cards = re.match(r"card (\d{4}-\d{4}-\d{4}-\d{4}) / (\d{16}), (\S+) (\S+)$", b)
    assert cards and cards[1].replace("-", "") == cards[2] != "4444333322221111" and cards[3] == cards[4]
    assert "mail.example.com" not in b and cards[3].endswith(".example.org")
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", c)
    assert len(set(ips)) == 1 and ips[0] != "10.0.0.1" and c.count(ips[0]) == 2
    tokens = re.findall(r"\b[0-9a-fA-F]{32}\b", c)
    assert len(tokens) == 2 and tokens[0].upper() == tokens[1] and tokens[1].isupper()
    assert re.match(r"Господин [А-Яа-я]+ [А-Яа-я]+, \d{3}-\d{2}-\d{4}, DE[0-9]{20}$", d)
    assert d.split()[1] in pii.GIVEN[("m", "cyrillic")]


def test_different_values_stay_different(make):
    texts = [f"{a}.{b}.1.2 and {i:03d}-12-{a:04d}" for i, (a, b) in enumerate((a, b) for a in range(30) for b in range(20))]
    rows = pii.replace_values(make(texts), KEY).collect()
    ips = [r["text"].split(" ")[0] for r in rows]
    assert len(set(ips)) == len(texts) and not set(ips) & {t.split(" ")[0] for t in texts}
    assert len({r["text"].split(" ")[2] for r in rows}) == len(texts)


def test_crowded_format_is_resolved_or_refused(make):
    # ten of a hundred three-part numbers that share all but two digits
    docs = make([f"x{i}@ab.example.com" for i in range(10)] + [f"y{i}@ab.example.com" for i in range(10)])
    rows = pii.replace_values(docs, KEY).collect()
    assert len({r["text"] for r in rows}) == 20


def test_more_values_than_short_surrogates(make):
    texts = [f"{i % 10}@d{i}.com" for i in range(10_500)]
    rows = pii.replace_values(make(texts), KEY).collect()
    assert len({r["text"] for r in rows}) == len(texts) and not {r["text"] for r in rows} & set(texts)


def test_numbers_get_longer_where_their_format_is_full(spark):
    values = spark.createDataFrame([("ssn", "123456789")], "kind string, canon string")
    drawn = values.selectExpr("*", "explode(sequence(0, 20)) as draw").select("draw", pii._drawn(KEY).alias("s")).collect()
    assert [len(r["s"]) for r in sorted(drawn)] == [9] * 16 + [10, 11, 12, 13, 14]
    made = spark.createDataFrame([("ssn", "123-45-6789", "98765432101")], "kind string, surface string, surrogate string")
    assert made.select(pii._rendered()).first()[0] == "987-65-432101"


HOSTILE = ["mail a@" + "b." * 100_000 + "com now", "a" * 200_000 + "@x", "a@" * 100_000, "a@b-" * 50_000, "1" * 200_000,
           "+1 " * 66_000, "ab12" * 50_000, "DE89 3704 " * 20_000, "AB12 " * 40_000, "1.2.3." * 32_000, "Mr " * 66_000,
           "Mr A" + "b" * 200_000, "Mr A" + "-Bc" * 66_000, "Dr O'" * 40_000, "(12) " * 40_000, "123-45-" * 28_000]


def test_long_hostile_texts_are_read(make):
    rows = {r["doc_id"]: r for r in pii.replace_values(make(HOSTILE), KEY).collect()}
    assert len(rows) == len(HOSTILE) and rows[6]["n_entities"] == 1 and rows[0]["n_entities"] == 0
    assert len(rows[6]["text"]) == 200_000 and rows[6]["text"] != HOSTILE[6]


def test_names_of_other_scripts_and_joined_names(make):
    texts = ["Dr Παπαδόπουλος", "Mr O'Brien-Jones", "Mr Jean-Luc Picard", "Mme D’Arc"]
    out = {r["doc_id"]: r["text"] for r in pii.replace_values(make(texts), KEY).collect()}
    assert re.fullmatch(r"Dr [Α-Ωα-ω]+", out[0]) and "παπ" not in out[0].lower()
    assert re.fullmatch(r"Mr [A-Z][a-z]+", out[1]) and re.fullmatch(r"Mr [A-Z][a-z]+ [A-Z][a-z]+", out[2])
    assert not {"Luc", "Picard", "Brien", "Jones", "Arc"} & set(re.findall(r"[A-Z][a-z]+", " ".join(out.values())))


def test_clean_texts_and_columns_pass(make):
    texts = [None, "", "Nothing here, 12 of 13.", "In 1999 the 3.5 and 10:30", "Mr and Mrs", "x" * 100_000, "a@b"]
    docs = make(texts)
    out = pii.replace_values(docs, KEY)
    assert out.columns == [*docs.columns, "n_entities"]
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in out.collect()}
    assert got == {i: (t, 0) for i, t in enumerate(texts)}
    assert pii.replace_values(make([]), KEY).count() == 0
    same = pii.replace_values(make(["at 9.8.7.6"] * 3, ids=[1, 1, None]), KEY).collect()
    assert len(same) == 3 and len({r["text"] for r in same}) == 1


def test_another_key_gives_other_surrogates(make):
    docs = make(["1.2.3.4"])
    assert pii.replace_values(docs, "a").first()["text"] != pii.replace_values(docs, "b").first()["text"]


def test_main_path_is_native(make):
    plan = pii.find_values(make(["1.2.3.4"]).withColumnRenamed("uid", "old").selectExpr("doc_id as uid", "text"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_plain_numbers_and_spaced_accounts(make):
    values = ["555-123-4567", "212.555.0147", "+14155552671", "+49 30 1234567", "3782 822463 10005",
              "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"]
    out = {r["doc_id"]: r["text"] for r in pii.replace_values(make([f"x {v}, y" for v in values]), KEY).collect()}
    for i, v in enumerate(values):
        new = out[i][2:-3]
        assert new != v and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", v)
    assert out[5].replace(" ", "") == out[6].replace(" ", "")


def test_given_names_stay_different_and_are_no_names_of_the_corpus(make):
    real = [*pii.GIVEN[("m", "latin")], *(f"N{a}{b}o" for a in "aeiou" for b in ("l", "m", "n", "r", "s", "t"))]
    out = [r["text"] for r in pii.replace_values(make([f"Mr {g} Smith" for g in real]), KEY).collect()]
    given = [t.split(" ")[1] for t in out]
    assert len(set(given)) == len(real) and not set(given) & set(real) and len({t.split(" ")[2] for t in out}) == 1
    assert all(set(g.split("-")) <= set(pii.GIVEN[("m", "latin")]) for g in given)


def test_surrogates_are_no_values_of_a_like_kind(spark, monkeypatch):
    drawn = F.when(F.col("draw") == 0, "4155552671000").otherwise(F.concat("canon", F.col("draw").cast("string")))
    monkeypatch.setattr(pii, "_drawn", lambda key: drawn)
    values = spark.createDataFrame([("phone", "14155552671"), ("card", "4155552671000")], "kind string, canon string")
    made = {r["kind"]: r["surrogate"] for r in pii.surrogates(values, KEY, pii.Scratch(spark, "pii")).collect()}
    assert made == {"phone": "141555526711", "card": "41555526710001"}
