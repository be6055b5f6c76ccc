"""Exact removal of long strings that occur more than once, by depth-limited passes.

A window is a string of ``depth`` bytes. Suffixes are ordered only as far as a
window reaches, most significant digit first, and groups of one leave at once:

1. The first digit is a string of ``DIGIT`` bytes, taken not at every byte but
   where its hash is the smallest in a window. Equal windows have the same
   smallest place, so a window that repeats is in a group of its first digit.
2. The second digit is everything the windows of one place cover. Places equal
   in it repeat as a whole and need no further order.
3. What is left are places whose first digit repeats and whose surroundings
   differ. Their windows are ordered to full depth; equal groups are exactly
   the repeated windows.

Counts are combined before each shuffle, so a passage that sits in a third of all
documents is one row per task. A group with more than ``LOCAL`` different
surroundings is not brought to one task: its windows are counted as single rows.
Equality is decided by 64-bit hashes of the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B
from panelrisk.llm.scratch import Scratch

DEPTH = 200
DIGIT = 50
LOCAL = 2048   # different surroundings of one digit that a task orders by itself
CHUNK = 4096   # surroundings ordered at once


def places(data: np.ndarray, offsets: np.ndarray, depth: int, digit: int):
    """(row, place, first window, last window, digit hash, surroundings hash) of a piece.

    Every window of a row belongs to exactly one place. Numbers are relative to the piece.
    """
    none = np.zeros(0, np.int64)
    if len(data) < depth:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = B.prefix_hash(data)
    at = np.arange(len(data) - digit + 1)
    hashes = B.span_hash(prefix, at, at + digit)
    # smallest hash first, then the leftmost place: both depend on the window only
    low = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    width, done = depth - digit + 1, 1
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < width:
        low = np.minimum(low[:len(low) - (width - done)], low[width - done:])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(place)]
    start = np.flatnonzero(np.arange(len(place)) + depth <= offsets[rows + 1])
    place, rows = place[start], rows[start]
    if not len(start):
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(rows) != 0)]))
    first = start[new]
    last = start[np.concatenate([new[1:] - 1, [len(start) - 1]])]
    own = place[new]
    return rows[new], own, first, last, hashes[own], B.span_hash(prefix, first, last + depth)


def _uid(key: str, text: str) -> Column:
    # rows equal in id and text may share what is found for them
    return F.xxhash64(F.col(key), F.col(text))


def _index(docs: DataFrame, depth: int, digit: int) -> DataFrame:
    """(uid, first, last, digit, around) of every place of every text."""
    schema = "uid long, first int, last int, digit long, around long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                data, offsets = B.flat_text(piece.column("text"))
                row, _, first, last, head, around = places(data, offsets, depth, digit)
                uid = piece.column("uid").to_numpy()[row]
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid), pa.array((first - offsets[row]).astype(np.int32)),
                    pa.array((last - offsets[row]).astype(np.int32)),
                    pa.array(head.view(np.int64)), pa.array(around.view(np.int64)),
                ], names=["uid", "first", "last", "digit", "around"])

    return docs.select("uid", "text").mapInArrow(run, schema)


def _squeezed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The texts compressed, so that shuffles carry less."""
    schema = T.StructType([docs.schema[c] for c in columns]).add("z", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [pack.compress((t.as_py() or "").encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(z, pa.binary())], names=schema.names)

    return docs.select(*columns, "text").mapInArrow(run, schema)


def _surroundings(squeezed: DataFrame, asked: DataFrame, depth: int) -> DataFrame:
    """Bytes around each asked place; for crowded digits one row per window instead.

    ``asked`` has (uid, spots) with spots an array of (first, last, crowded, digit).
    """
    schema = "digit long, uid long, first int, last int, bytes binary, window long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for uid, z, spots in zip(batch.column("uid").to_pylist(), batch.column("z"), batch.column("spots").to_pylist()):
                raw = unpack.decompress(z.as_py())
                for s in spots:
                    text = raw[s["first"]:s["last"] + depth]
                    if not s["crowded"]:
                        out.append((s["digit"], uid, s["first"], s["last"], text, None))
                        continue
                    prefix = B.prefix_hash(np.frombuffer(text, np.uint8))
                    at = np.arange(len(text) - depth + 1)
                    for k, h in enumerate(B.span_hash(prefix, at, at + depth).view(np.int64).tolist()):
                        out.append((None, uid, s["first"] + k, s["first"] + k, None, h))
                if len(out) >= 20_000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["digit", "uid", "first", "last", "bytes", "window"])

    return squeezed.join(asked, "uid").select("uid", "z", "spots").mapInArrow(run, schema)


def _ordered(groups: DataFrame, depth: int) -> DataFrame:
    """(uid, first, last) runs of repeated windows; rows of one digit are together and in order."""

    def resolve(uid: np.ndarray, first: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        windows = sizes - depth + 1
        owner = np.repeat(np.arange(len(texts)), windows)
        within = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (ends - sizes)[owner] + within
        h = B.span_hash(B.prefix_hash(data), at, at + depth)
        order = np.argsort(h, kind="stable")
        same = np.diff(h[order]) == 0
        again = np.zeros(len(h), bool)
        again[order[1:]] = same
        again[order[:-1]] |= same
        hit = np.flatnonzero(again)
        if len(hit):
            cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0))
            a = hit[np.concatenate([[0], cut + 1])]
            b = hit[np.concatenate([cut, [len(hit) - 1]])]
        else:
            a = b = hit
        return pa.RecordBatch.from_arrays([
            pa.array(uid[owner[a]]), pa.array((first[owner[a]] + within[a]).astype(np.int32)),
            pa.array((first[owner[b]] + within[b]).astype(np.int32)),
        ], names=["uid", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("digit", "uid", "first", "bytes")])
            for r in rows:
                if len(held) >= CHUNK and r[0] != held[-1][0]:
                    yield close(held)
                    held = []
                held.append(r)
        if held:
            yield close(held)

    def close(held: list[tuple]) -> pa.RecordBatch:
        return resolve(np.array([r[1] for r in held], np.int64), np.array([r[2] for r in held], np.int64),
                       [r[3] for r in held])

    return groups.mapInArrow(run, "uid long, first int, last int")


def repeated_windows(docs: DataFrame, scratch: Scratch, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """(uid, first, last): runs of window starts whose window occurs elsewhere too."""
    index = scratch.write(_index(docs, depth, digit), "index")
    # second digit, counted with one place that stands for its equals
    kinds = scratch.write(
        index.groupBy("digit", "around").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "first", "last")).alias("one")),
        "kinds")
    shared = (
        kinds.groupBy("digit").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"))
        .where("total >= 2").drop("total")
    )
    kept = scratch.write(kinds.join(shared, "digit"), "kept")
    scratch.drop("kinds")
    whole = index.join(kept.where("n >= 2").select("digit", "around"), ["digit", "around"], "left_semi")
    whole = scratch.write(whole.select("uid", "first", "last"), "whole")
    scratch.drop("index")
    # different surroundings of one digit, each once
    asked = (
        kept.where("kinds >= 2")
        .select("digit", "one.*", (F.col("kinds") > LOCAL).alias("crowded"))
        .groupBy("uid").agg(F.collect_list(F.struct("first", "last", "crowded", "digit")).alias("spots"))
    )
    squeezed = _squeezed(docs, ["uid"])
    around = scratch.write(_surroundings(squeezed, asked, depth), "around")
    scratch.drop("kept")
    local = _ordered(
        around.where("window is null").select("digit", "uid", "first", "bytes")
        .repartition("digit").sortWithinPartitions("digit"), depth)
    single = around.where("window is not null").select("window", "uid", "first", "last")
    often = single.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("window")
    crowded = single.join(often, "window", "left_semi").select("uid", "first", "last")
    partial = scratch.write(local.unionByName(crowded), "partial")
    scratch.drop("around")
    return whole.unionByName(partial)


def _coverage(runs: list[int], size: int, depth: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in sorted(runs):
        a, b = r >> 32, (r & 0xFFFFFFFF) + depth
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, size)) for a, b in out]


def remove_repeats(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT, with_bytes: bool = False) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs and digest of what is left.

    Null text is empty. Texts shorter than ``depth`` bytes lose nothing. Repeated
    rows remove each other; only ``doc_id`` and ``text`` are read. With
    ``with_bytes`` the kept bytes come too (they may end inside a letter).
    """
    if not 0 < digit <= depth:
        raise ValueError("the first digit must fit into a window")
    scratch = Scratch(docs.sparkSession, "repeats")
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("uid", _uid("doc_id", "text"))
    runs = repeated_windows(source, scratch, depth, digit)
    by_row = runs.groupBy("uid").agg(
        F.collect_list(F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))).alias("runs"))
    joined = _squeezed(source, ["doc_id", "uid"]).join(by_row, "uid", "left").select("doc_id", "z", "runs")
    schema = T.StructType([source.schema["doc_id"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("kept_sha256", T.StringType())
    if with_bytes:
        schema = schema.add("kept", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, found in zip(batch.column("z"), batch.column("runs").to_pylist()):
                raw = unpack.decompress(z.as_py())
                spans = _coverage(found or [], len(raw), depth)
                left, at = [], 0
                for a, b in spans:
                    left.append(raw[at:a])
                    at = b
                left.append(raw[at:])
                kept = b"".join(left)
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            columns.append(pa.array([o[3] for o in out], pa.string()))
            if with_bytes:
                columns.append(pa.array([o[4] for o in out], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return joined.mapInArrow(run, schema)
