import re

import numpy as np
import pyarrow as pa

from panelrisk.llm import bytesops as B

TEXTS = ["", None, "Ab c", " é  ß\tx", "a" * 300, "one two\none two", "\x00\x1f end"]


def test_words_match_the_pattern():
    data, offsets = B.flat_text(pa.array(TEXTS))
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, offsets, B.SPACE)
    got = [[data[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first[:-1], first[1:])]
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()) for t in TEXTS]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in low]


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    prefix = B.prefix_hash(data)
    at = np.arange(7)
    h = B.span_hash(prefix, at, at + 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4


def test_pieces_cover_a_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * (B.PIECE // 2)] * 5 + [None, "y" * (2 * B.PIECE)]})
    parts = list(B.pieces(batch, "text"))
    assert sum(p.num_rows for p in parts) == 7 and len(parts) >= 3
    assert list(B.pieces(batch.slice(0, 0), "text")) == []
