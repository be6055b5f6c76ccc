import zlib

from panelrisk.llm.sharding import shard_by_bytes


def test_contiguous_and_near_equal(make):
    texts = [None, "", "é" * 7] + ["x" * (37 * i % 211) for i in range(400)] + ["same"] * 300
    rows = sorted(shard_by_bytes(make(texts), 8).collect(), key=lambda r: r["doc_id"])
    assert len(rows) == len(texts)
    shards, sizes = [r["shard"] for r in rows], {}
    assert shards == sorted(shards) and set(shards) == set(range(8))
    slots = {}
    for r, t in zip(rows, texts):
        raw = (t or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
        assert r["law"] == "bytes" and r["grown_shard"] is None
        assert r["slot"] == slots.get(r["shard"], 0)
        slots[r["shard"]] = r["slot"] + 1
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * (211 + 16)


def test_ties_nulls_and_empty(make):
    rows = shard_by_bytes(make(["a", "a", "b"], ids=[None, None, None]), 2).collect()
    assert len(rows) == 3 and {r["shard"] for r in rows} == {0, 1}
    assert shard_by_bytes(make([]), 4).count() == 0
