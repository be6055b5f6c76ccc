import hashlib
import random
import time

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import regex  # noqa: E402
from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers  # noqa: E402

from panelrisk.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.BPE(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


PARTS = ["a", "e", "th", "ing", "'s", "'RE", "Σ", "İ", "é", "é", "\x1c", "\x1f", "\x85", " ", "　",
         " ", "  ", "\n", "<|endoftext|>", "<|startoftext|>", "9", "१", "½", "!", "...", "日本", "😀", "́", "ß",
         "ﬁ", "\x00", "_", "http://", "﻿", "​"]


def test_matches_the_library_on_odd_texts(own, library):
    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


POINTS = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]


@pytest.mark.parametrize("kind", ["L", "N"])
def test_every_code_point_is_classed_as_in_the_library(kind):
    split = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True)
    own = regex.compile(f"[{bpe.letter_class(kind)}]")
    for first in range(0, len(POINTS), 512):
        text = " ".join(map(chr, POINTS[first:first + 512]))
        assert own.findall(text) == [piece for piece, _ in split.pre_tokenize_str(text)], hex(POINTS[first])


def test_every_code_point_has_the_normal_form_of_the_library():
    steps = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    for c in POINTS:
        text = f"{chr(c)} a{chr(c)}\u0300\u0315 a\u0315{chr(c)}"
        assert bpe.normal_form(text) == steps.normalize_str(text), hex(c)


def test_code_points_that_the_tables_name(own, library):
    spans = " ".join([bpe.LETTERS, bpe.NUMBERS, bpe.STARTERS, *bpe.CAPITALS])
    for first, last in bpe._spans(spans):
        for c in range(first, last + 1)[:40]:
            text = f"!a{chr(c)}1{chr(c)}\u0300\u0315 a\u0315{chr(c)}"
            assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_composition_is_that_of_the_library(own, library):
    text = "\U00011935\U00011930 \U00011938 a\u0315\u0898\u0300"
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_a_long_word_takes_linear_time(own, library):
    draw = random.Random(5)
    word = "".join(draw.choice("aeinrstlo") for _ in range(300_000))
    began = time.monotonic()
    ids = own.encode(word)
    assert time.monotonic() - began < 20
    assert ids == library.encode(word, add_special_tokens=False).ids


def test_long_words_go_through_a_bounded_window(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 16)
    draw = random.Random(4)
    for letters in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "a", "th"):
        word = "".join(draw.choice(letters) for _ in range(4000))
        assert own.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_lookahead_covers_the_longest_chain():
    # a border moves by c, then by b: "abcd" stays open until "d" is seen
    assert bpe.sufficient_lookahead([("c", "d"), ("b", "cd")]) == 2
    assert bpe.sufficient_lookahead([("b", "cd"), ("c", "d")]) == 1
    assert bpe.sufficient_lookahead([]) == 1


def test_decoding_in_steps(own, library):
    ids = own.encode("Naïve 日本 <|endoftext|> don't")
    for make, whole in ((bpe.TokenText, library.decode(ids, skip_special_tokens=False)),):
        d = make(own)
        assert "".join(d.feed([i]) for i in ids) == whole
    plain = bpe.PlainText(own)
    text = "".join(plain.feed([i]) for i in ids)
    assert text == bpe.PlainText(own).feed(ids, last=True) and text.startswith("naïve 日本 ")


def test_documents(make, library, spark):
    texts = [None, "", "One two  three", "One two  three", "x" * 200_000 + " end", "\n\t"]
    found = {r["doc_id"]: r for r in bpe.encode_documents(make(texts), PATH, with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i]["token_ids"] == ids and found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(make([]), PATH).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(make(["one two"]), PATH, with_ids=True), PATH)
    assert back.first()["text"] == "one two "
