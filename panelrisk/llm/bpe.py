"""BPE encoding as a streaming transducer with bounded lookahead, and decoding.

A merge list tells how far left a change of the text can still move a token
border: every merge moves it by the length of its left part, and the next merge
that can move it needs a later rank and a right part that begins with the token
now at the border. The longest such chain is the sufficient lookahead. Tokens
that end that far before the end of what was read never change, so they are
emitted and forgotten: a text of any length is encoded with a window of a few
hundred symbols. Short words, whose end is in sight, are kept in a bounded memo.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B

WINDOW = 1024     # symbols of a long word in memory, beside the lookahead
MEMO_LENGTH = 96  # characters of a piece between spaces that may be kept
MEMO_SIZE = 1 << 19
READ = 1 << 16    # characters of a text handled at once
SHORT = 64        # symbols up to which a scan finds the next merge faster than a heap

# Where the Unicode tables of the tokenizer library differ from those of Python 3.13 (15.1).
# Its letters, numbers and lower case are newer, its composition is older.
LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E "
    "11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0")
NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
CAPITALS = {  # distance to the small letter
    "1C89 A7CC A7CE A7D2 A7D4 A7DA": 1, "A7CB": -42343, "A7DC": -42561, "10D50-10D65": 32, "16EA0-16EB8": 27}
STARTERS = (  # marks that do not move past others there, and a sign that does not compose
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF "
    "10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 "
    "11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF")


def _spans(ranges: str) -> list[tuple[int, int]]:
    ends = [r.split("-") for r in ranges.split()]
    return [(int(e[0], 16), int(e[-1], 16)) for e in ends]


def _class(spans: list[tuple[int, int]]) -> str:
    """Inside of a pattern's brackets."""
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in spans)


@functools.cache
def letter_class(kind: str) -> str:
    """The code points of category L or N as the tokenizer library knows them."""
    spans = _spans({"L": LETTERS, "N": NUMBERS}[kind])
    begin = None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] == kind
        if inside and begin is None:
            begin = code
        elif not inside and begin is not None:
            spans.append((begin, code - 1))
            begin = None
    return _class(spans)


_SMALL = {c: c + d for ranges, d in CAPITALS.items() for a, b in _spans(ranges) for c in range(a, b + 1)}
_CAPITAL = re.compile(f"[{_class([(c, c) for c in _SMALL])}]")
_STARTER = re.compile(f"([{_class(_spans(STARTERS))}])")


def normal_form(text: str) -> str:
    """Composed and in lower case, letter by letter: no final form of sigma."""
    if text.isascii():
        return text.lower()
    # marks on the two sides of a starter neither move nor compose across it
    text = "".join(unicodedata.normalize("NFC", part) for part in _STARTER.split(text))
    if _CAPITAL.search(text):
        text = text.translate(_SMALL)
    return text.replace("Σ", "σ").lower()


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return letters


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols after which no token border to the left can move any more."""
    left_parts: dict[str, set[str]] = {}
    reach: dict[str, int] = {}
    longest = 1
    for a, b in merges:
        begins, todo = {b}, [b]
        while todo:
            for part in left_parts.get(todo.pop(), ()):
                if part not in begins:
                    begins.add(part)
                    todo.append(part)
        moved = max((reach.get(t, 0) for t in begins), default=0) + len(a)
        reach[a] = max(reach.get(a, 0), moved)
        left_parts.setdefault(a + b, set()).add(a)
        longest = max(longest, moved)
    return longest


class BPE:
    """Vocabulary file with word ends, byte-level letters and a split pattern."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model.get("end_of_word_suffix") or ""
        self.ranks = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        plain = [(a.replace(self.end, ""), b.replace(self.end, "")) for a, b in pairs] if self.end else pairs
        self.lookahead = sufficient_lookahead(plain)
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.final = [self.vocab[c + self.end] for c in letters]
        self.pieces = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces.update({i: t for t, i in self.special.items()})
        self.sizes = {
            i: len(t[:-len(self.end)] if self.end and t.endswith(self.end) else t)
            for i, t in self.pieces.items()
        }
        self.split_ascii, self.split = self._steps(spec)
        self.digits = {i: str(i) for i in self.pieces}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.words: dict[str, tuple[int, ...]] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.byte_of = {c: b for b, c in enumerate(letters)}

    @staticmethod
    def _steps(spec: dict):
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("this normalizer or decoder is not supported")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("this split is not supported")
        # runs of space are made one space, which the pattern then leaves out; they need no step
        pattern = split["pattern"]["Regex"]
        for kind in "LN":
            pattern = pattern.replace(rf"[\p{{{kind}}}]", f"[{letter_class(kind)}]").replace(rf"\p{{{kind}}}", letter_class(kind))
        return regex.compile(split["pattern"]["Regex"]), regex.compile(pattern)

    def merge(self, ids: list[int]) -> list[int]:
        """Tokens of a run of symbols: the lowest rank first, from the left."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        ranks, never = self.ranks, len(self.made)
        todo = [ranks.get(pair, never) for pair in zip(ids, ids[1:])]
        while todo:
            rank = min(todo)
            if rank == never:
                break
            at = todo.index(rank)
            ids[at:at + 2] = [self.made[rank]]
            del todo[at]
            if at:
                todo[at - 1] = ranks.get((ids[at - 1], ids[at]), never)
            if at < len(todo):
                todo[at] = ranks.get((ids[at], ids[at + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        ranks, made, n = self.ranks, self.made, len(ids)
        after, before, dead = [*range(1, n + 1)], [*range(-1, n - 1)], -1
        heap = [(rank, at) for at, pair in enumerate(zip(ids, ids[1:])) if (rank := ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] == dead or right >= n or ranks.get((ids[at], ids[right])) != rank:
                continue  # one of the two was merged meanwhile
            ids[at], ids[right] = made[rank], dead
            after[at] = right = after[right]
            left = before[at]
            if right < n:
                before[right] = at
                if (rank := ranks.get((ids[at], ids[right]))) is not None:
                    heapq.heappush(heap, (rank, at))
            if left >= 0 and (rank := ranks.get((ids[left], ids[at]))) is not None:
                heapq.heappush(heap, (rank, left))
        return [i for i in ids if i != dead]

    def stream_word(self, symbols: Iterator[int]) -> Iterator[list[int]]:
        """Tokens of one word of any length, emitted as soon as they are stable."""
        held: list[int] = []
        size = self.lookahead + WINDOW
        for symbol in symbols:
            held.append(symbol)
            if len(held) <= size:
                continue
            tokens, stable, out = self.merge(held[:]), len(held) - 1 - self.lookahead, 0
            emitted = 0
            for t in tokens:
                if out + self.sizes[t] > stable:
                    break
                out += self.sizes[t]
                emitted += 1
            yield tokens[:emitted]
            held = held[out:]
        if held:
            yield self.merge(held)

    def _word(self, word: str) -> tuple[int, ...]:
        known = self.words.get(word)
        if known is None:
            raw = word.encode("utf-8")
            known = tuple(self.merge([*[self.inner[b] for b in raw[:-1]], self.final[raw[-1]]]))
            if len(self.words) >= MEMO_SIZE:
                self.words.clear()
            self.words[word] = known
        return known

    def _symbols(self, word: str) -> Iterator[int]:
        last = len(word) - 1
        for at, letter in enumerate(word):
            raw = letter.encode("utf-8")
            for b in raw[:-1]:
                yield self.inner[b]
            yield self.final[raw[-1]] if at == last else self.inner[raw[-1]]

    def _stretch(self, text: str) -> Iterator[list[int] | tuple[int, ...]]:
        for part in self.special_split.split(text):
            if part in self.special:
                yield (self.special[part],)
                continue
            split = self.split_ascii if part.isascii() else self.split
            for m in split.finditer(normal_form(part)):
                word = m.group()
                if len(word) <= MEMO_LENGTH:
                    yield self._word(word)
                else:
                    yield from self.stream_word(self._symbols(word))

    def _part(self, part: str) -> tuple[int, ...]:
        """Tokens between two spaces: no word, special token or letter composition crosses a space."""
        known = tuple(i for ids in self._stretch(part) for i in ids)
        if len(part) <= MEMO_LENGTH:
            if len(self.parts) >= MEMO_SIZE:
                self.parts.clear()
            self.parts[part] = known
        return known

    def forget(self) -> None:
        """Empty the memo: a worker that goes on to other stages must not carry it along."""
        self.words, self.parts = {}, {}

    def stream(self, text: str) -> Iterator[list[int]]:
        """Token ids of a text in order, some at a time."""
        at, parts = 0, self.parts
        while at < len(text):
            end = at + READ
            if end < len(text):
                space = _SPACE.search(text, end)
                end = space.start() if space else len(text)
            ids: list[int] = []
            for part in _PARTS(text[at:end]):
                known = parts.get(part)
                if known is not None:
                    ids += known
                elif len(part) <= READ:
                    ids += self._part(part)
                else:
                    if ids:
                        yield ids
                        ids = []
                    for some in self._stretch(part):
                        yield list(some)
            if ids:
                yield ids
            at = end

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in self.stream(text or "") for i in ids]


# white space of the split pattern; str.split() would also take U+001C to U+001F
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]")
_NOT_SPACE = re.compile("[^\t-\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1f]")


def _PARTS(text: str) -> list[str]:
    return _NOT_SPACE.findall(text) if _ODD.search(text) else text.split()


class TokenText:
    """Incremental decoder of a vocabulary without a decoder step: pieces joined by one space."""

    def __init__(self, bpe: BPE):
        self.bpe, self.first = bpe, True

    def feed(self, ids: list[int]) -> str:
        text = " ".join(map(self.bpe.pieces.__getitem__, ids))
        if self.first or not ids:
            self.first = self.first and not ids
            return text
        return " " + text


class PlainText:
    """Incremental decoder to readable text: bytes to UTF-8 across tokens, word ends to spaces.

    Bytes of an unfinished letter wait for the next token; bytes that can never
    form a letter become U+FFFD.
    """

    def __init__(self, bpe: BPE):
        self.bpe, self.state = bpe, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        raw = bytearray()
        end, byte_of = self.bpe.end, self.bpe.byte_of
        for i in ids:
            piece = self.bpe.pieces[i]
            if piece in self.bpe.special:
                raw += piece.encode()
                continue
            ends = bool(end) and piece.endswith(end)
            raw += bytes(byte_of[c] for c in (piece[:-len(end)] if ends else piece))
            raw += b" " * ends
        return self.state.decode(bytes(raw), last)


_loaded: dict[str, BPE] = {}


def load(content: str) -> BPE:
    """One model per Python worker and vocabulary."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = BPE(content)
    return _loaded[key]


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Token count and digests of ids and decoded text; the ids too if asked for.

    Null text is empty: no tokens, digests of the empty string. Repeated rows are
    encoded each on its own; only ``doc_id`` and ``text`` are read. The vocabulary
    file is read once by the driver (a few megabytes) and broadcast.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("n_tokens", T.LongType())
    schema = schema.add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    if with_ids:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        try:
            for batch in batches:
                for piece in B.pieces(batch, "text"):
                    yield _encode_batch(bpe, piece, schema.names, with_ids)
        finally:
            bpe.forget()

    return source.mapInArrow(run, schema)


def _encode_batch(bpe: BPE, batch: pa.RecordBatch, names: list[str], with_ids: bool) -> pa.RecordBatch:
    counts, id_digests, text_digests, every = [], [], [], []
    for text in batch.column("text"):
        ids_hash, text_hash, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
        decoder = TokenText(bpe)
        for ids in bpe.stream(text.as_py() or ""):
            ids_hash.update(((" " if n else "") + " ".join(map(bpe.digits.__getitem__, ids))).encode())
            text_hash.update(decoder.feed(ids).encode())
            n += len(ids)
            if with_ids:
                kept += ids
        counts.append(n)
        id_digests.append(ids_hash.hexdigest())
        text_digests.append(text_hash.hexdigest())
        every.append(kept)
    columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
               pa.array(text_digests, pa.string())]
    if with_ids:
        columns.append(pa.array(every, pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names=names)


def decode_documents(tokens: DataFrame, vocabulary: str, ids: str = "token_ids") -> DataFrame:
    """(doc_id, text): readable text of token ids; null ids give null."""
    with open(vocabulary, encoding="utf-8") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(f.read())
    source = tokens.select("doc_id", F.col(ids).alias("ids"))
    schema = T.StructType([source.schema["doc_id"]]).add("text", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        for batch in batches:
            out = [
                None if i is None else PlainText(bpe).feed(i, last=True)
                for i in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())],
                                             names=["doc_id", "text"])

    return source.mapInArrow(run, schema)
