"""Documents linked by word n-gram sets of high Jaccard similarity, and their groups.

Exact join with a prefix index. The n-grams of a set are put in one global order,
frequent ones last; linked sets share an n-gram among the first (1 - t)|x| + 1.
Two relations between sets save work:

* Block skipping. Two sets whose first common n-gram stands at positions i and j share
  at most min(|x| - i, |y| - j) n-grams. An index list of more than ``BLOCK`` entries is
  cut into blocks of like sizes and positions. Only block summaries are joined with each
  other; blocks are opened together if the bounds of the two allow any link, and pairs
  are told apart inside a task. A linked pair passes at its first common n-gram,
  whatever happens at later ones.
* Derived answers. In every list all members are first compared with one leader, the set
  whose n-grams are in most other sets. Members linked to it
  share its group, so their mutual comparisons are skipped. The overlap of a member
  with its leader bounds its overlap with every other member of the same leader:
  |x & y| + |y & z| - |y| <= |x & z| <= |y & z| + |x| - |x & y|. A pair is linked, or
  excluded, from these two numbers alone where they suffice; only the rest is compared
  by whole texts. Equal sets are one.

Nothing is left out: a pair is skipped only if a bound excludes it, or if both
sets are in one group already. The order of n-grams decides speed, never results:
``FREQUENT`` bounds the list of n-grams that are put last.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelrisk.llm import bytesops as B
from panelrisk.llm.scratch import Scratch

WORDS = 5
THRESHOLD = (80, 100)   # intersection * 100 >= union * 80
FREQUENT = 1 << 17      # n-grams put last in the order (one megabyte)
LOCAL_COUNT = 3         # rows of a batch that share an n-gram before it may count as frequent
STALLED = 0.7           # share of open entries that a round of leaders must not leave
ROUNDS = 8              # leaders tried before lists are read block by block
BLOCK = 256             # entries of a block of an index list
POSITIONS = 40          # blocks tell positions apart by this part of a set
COMPARED = 128          # pairs whose texts are in memory at once
OPENED = 1 << 18        # pairs of entries of opened blocks told apart at once
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and the first place of each text.

    A text with fewer words has its whole sequence as its only n-gram.
    """
    data, offsets = B.flat_text(column)
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, offsets, B.SPACE)
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    h = B.word_hashes(data, starts, ends)
    total = np.diff(first)
    size = np.minimum(total, words)
    count = np.where(total > 0, total - size + 1, 0)
    row = np.repeat(np.arange(n), count)
    begin = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    gram = np.zeros(len(row), np.uint64)
    for k in range(words):
        live = size[row] > k
        at = np.minimum(begin + k, len(h) - 1)
        gram = np.where(live, gram * _STEP + h[at], gram)
    gram = B.mix(gram + size[row].astype(np.uint64))
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[fresh], gram[fresh]
    return gram, np.searchsorted(row, np.arange(n + 1))


def frequent_grams(docs: DataFrame, words: int, limit: int) -> np.ndarray:
    """Hashes of frequent n-grams, rarer ones first; at most ``limit``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingles(p.column("text"), words)[0] for p in B.pieces(batch, "text")]
            found, n = np.unique(np.concatenate(grams or [np.zeros(0, np.uint64)]), return_counts=True)
            often = n >= LOCAL_COUNT
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(n[often])], names=["gram", "n"])

    rows = (
        docs.select("text").mapInArrow(count, "gram long, n long")
        .groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(limit)
        .select("gram").toPandas()  # at most ``limit`` numbers
    )
    return rows["gram"].to_numpy(np.int64).view(np.uint64)[::-1]


def _prefixes(docs: DataFrame, frequent: np.ndarray, words: int) -> DataFrame:
    """(doc_id, uid, sid, n, prefix) with sid the hash of the whole set and prefix its first n-grams."""
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order))
    schema = T.StructType([docs.schema["doc_id"], docs.schema["uid"]])
    schema = schema.add("sid", T.LongType()).add("n", T.IntegerType())
    schema = schema.add("prefix", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rank = shared.value
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                grams, first = shingles(piece.column("text"), words)
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                power = B.powers(int(n.max(initial=0)) + 1)[0]
                within = np.arange(len(grams)) - first[row]
                sums = np.zeros(len(grams) + 1, np.uint64)
                np.cumsum(B.mix(grams) * power[within], out=sums[1:])
                sid = B.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64))
                at = B.membership(keys, grams)
                late = np.where(at >= 0, rank[at] + 1 if len(keys) else 0, 0)
                placed = np.lexsort((grams, late, row))
                length = np.where(n > 0, n - -(-n * THRESHOLD[0] // THRESHOLD[1]) + 1, 0)
                keep = within < length[row]
                values = grams[placed][keep].view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("uid"), pa.array(sid.view(np.int64)), pa.array(n.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ], names=schema.names)

    return docs.select("doc_id", "uid", "text").mapInArrow(run, schema)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, z): one compressed text per wanted set; ``wanted`` has (uid, sid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [pack.compress((t.as_py() or "").encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(z, pa.binary())], names=["uid", "z"])

    squeezed = docs.select("uid", "text").mapInArrow(run, "uid long, z binary")
    # rows equal in id and text share a uid
    return squeezed.join(wanted, "uid").dropDuplicates(["uid"]).select("sid", "z")


def _compare(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, both, link) of each pair of sets, by their whole texts: common n-grams, and if they are enough."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        unpack = zstandard.ZstdDecompressor()
        raw = pa.array([unpack.decompress(z.as_py()) for z in column], pa.large_binary())
        out: list[np.ndarray] = []
        for piece in B.pieces(pa.RecordBatch.from_arrays([raw], names=["text"]), "text"):
            grams, first = shingles(piece.column("text"), words)
            out += [grams[i:j] for i, j in zip(first[:-1], first[1:])]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, COMPARED):
                batch = whole.slice(at, COMPARED)
                common, link = [], []
                for x, y in zip(sets(batch.column("za")), sets(batch.column("zb"))):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    common.append(both)
                    link.append(both * THRESHOLD[1] >= (len(x) + len(y) - both) * THRESHOLD[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(common, pa.int32()), pa.array(link, pa.bool_())],
                    names=["a", "b", "both", "link"])

    left = texts.select(F.col("sid").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("sid").alias("b"), F.col("z").alias("zb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "za", "zb").mapInArrow(
        run, "a long, b long, both int, link boolean")


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send at most ``rows`` rows at once to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) with the smallest node of each connected part; edges are (a, b).

    Labels spread to neighbours and jump along themselves until nothing changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.write(both.distinct(), f"{name}-edges")
    labels = scratch.write(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), f"{name}-0")
    step = 0
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = (
            labels.join(heard, "node").join(jump, "label", "left")
            .select("node", F.least("label", "heard", "further").alias("label"),
                    (F.least("heard", "further") < F.col("label")).alias("moved"))
        )
        new = scratch.write(new, f"{name}-{step + 1}")
        scratch.drop(f"{name}-{step}")
        step += 1
        labels = new.select("node", "label")
        if new.where("moved").limit(1).count() == 0:
            scratch.drop(f"{name}-edges")
            return labels


def _possible(x: str, y: str) -> str:
    """SQL: the sizes and positions of two entries allow a link whose first common n-gram is here."""
    t, s = THRESHOLD
    least = f"{t} * ({x}.n + {y}.n)"  # overlap * (s + t) >= t * (|x| + |y|)
    most = f"least({x}.n - {x}.pos, {y}.n - {y}.pos)"
    return f"{most} * {s + t} >= {least} and least({x}.n, {y}.n) * {s} >= greatest({x}.n, {y}.n) * {t}"


def linked_groups(docs: DataFrame, words: int = WORDS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Null or empty text has no n-grams and links with nothing: its component is its
    own id. Repeated rows are each returned. Rows without an id take part and get
    the smallest id of their group, null if it has none. Only ``doc_id`` and
    ``text`` are read.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    source = source.withColumn("uid", F.xxhash64("doc_id", "text"))
    sets = scratch.write(_prefixes(source, frequent_grams(source, words, frequent), words), "sets")
    labels = _group_sets(source, sets, scratch, words)
    own = sets.select("doc_id", "sid", "n").join(labels.drop("shared"), "sid", "left")
    own = scratch.write(own.select("doc_id", "n", F.coalesce("comp", "sid").alias("comp")), "own")
    smallest = own.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least_id"))
    return own.join(smallest, "comp", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _group_sets(source: DataFrame, sets: DataFrame, scratch: Scratch, words: int) -> DataFrame:
    """(sid, shared, comp) of the sets that may be linked to another one."""
    entries = (
        sets.where("n > 0").dropDuplicates(["sid"])
        .select("sid", "n", F.posexplode("prefix").alias("pos", "gram"))
    )
    entries = scratch.write(entries, "entries")
    met = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("_c")).where("_c >= 2")
    lists = scratch.write(entries.join(met, "gram"), "lists")
    scratch.drop("entries")
    # a text for each set that met another: any of its documents
    # how much a set shares with others: the least changed of many near copies has fewest n-grams of its own
    wanted = scratch.write(lists.groupBy("sid").agg((F.sum("_c") / F.max("n")).alias("shared")), "wanted")
    lists = lists.drop("_c")
    reps = sets.join(wanted.select("sid"), "sid", "left_semi").groupBy("sid").agg(F.min("uid").alias("uid"))
    texts = scratch.write(_texts(source, reps), "texts")
    comp = wanted.select("sid", "shared", F.col("sid").alias("comp"))
    answers = checked = before = None
    for turn in range(ROUNDS + 1):
        lists, size = _open_lists(lists, comp, scratch, turn)
        scratch.drop("lists" if not turn else f"lists-{turn - 1}")
        if not size:
            break
        # leaders go on while they settle lists; what they leave is read block by block
        last = turn == ROUNDS or (before is not None and size > STALLED * before)
        before = size
        if last:
            pairs = scratch.write(_block_pairs(lists, answers, scratch), "pairs")
            comp = _joined(comp, pairs.where("sure").select("a", "b"), scratch, turn)
            of = comp.select("sid", "comp")
            pairs = (
                pairs.where("not sure").select("a", "b")
                .join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b").where("ca <> cb").select("a", "b")
            )
        else:
            pairs = scratch.write(_leader_pairs(lists, turn), f"leaders-{turn}")
        open_pairs = pairs.select("a", "b")
        if checked is not None:
            open_pairs = open_pairs.join(checked, ["a", "b"], "left_anti")
        with small_batches(source.sparkSession, COMPARED):
            found = scratch.write(_compare(open_pairs, texts, words), f"found-{turn}")
        comp = _joined(comp, found.where("link").select("a", "b"), scratch, turn + (ROUNDS + 1) * last)
        if last:
            break
        done = found.select("a", "b")
        checked = done if checked is None else checked.unionByName(done)
        answers = _answers(pairs.join(found, ["a", "b"]), answers)
    return comp


def _answers(found: DataFrame, before: DataFrame | None) -> DataFrame:
    """(sid, lead, both, ln): the overlap of a set with the leader that shares most, and that leader's size."""
    member = F.when(F.col("lead") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("sid")
    new = found.select(member, F.struct("shared", "lead", "both", "ln").alias("best"))
    rows = new if before is None else new.unionByName(before)
    return rows.groupBy("sid").agg(F.max("best").alias("best"))


def _open_lists(lists: DataFrame, comp: DataFrame, scratch: Scratch, turn: int) -> tuple[DataFrame, int]:
    """Lists that still hold several groups, and the number of their entries."""
    now = lists.drop("comp", "shared").join(comp, "sid")
    mixed = now.groupBy("gram").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi")
    kept = scratch.write(now.join(mixed.select("gram"), "gram", "left_semi"), f"lists-{turn}")
    return kept, kept.count()


def _leader_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """(a, b, lead, ln, shared): every entry with the leader of its list, where sizes and positions allow a link.

    All lists prefer leaders in the same order, so near copies meet the same one;
    later turns take it from another half of the sets.
    """
    half = F.xxhash64("sid").bitwiseAND(F.lit(1 << turn)) if turn else F.lit(0)
    chosen = F.struct((half != 0).alias("half"), "shared", "sid", "n", "pos", "comp")
    leaders = lists.groupBy("gram").agg(F.max(chosen).alias("y"))
    x = lists.join(leaders, "gram").where("comp <> y.comp").selectExpr("struct(sid, n, pos) as x", "y")
    return x.where(_possible("x", "y")).selectExpr(
        "least(x.sid, y.sid) as a", "greatest(x.sid, y.sid) as b", "y.sid as lead", "y.n as ln", "y.shared as shared",
    ).dropDuplicates(["a", "b"])


def _block_pairs(lists: DataFrame, answers: DataFrame | None, scratch: Scratch) -> DataFrame:
    """(a, b, sure): pairs of different groups that bounds do not exclude; ``sure`` ones are linked by their answers.

    A list of up to ``BLOCK`` entries is one block. Longer ones are cut by size and
    position; groups with many entries there have blocks of their own.
    """
    entries = lists.drop("shared")
    if answers is None:
        entries = entries.withColumn("best", F.lit(None).cast("struct<lead:long,both:int,ln:int>"))
    else:
        entries = entries.join(answers, "sid", "left")
    entries = entries.select(
        "gram", "sid", "n", "pos", "comp", F.coalesce("best.lead", "sid").alias("lead"),
        F.coalesce("best.both", "n").alias("both"), F.coalesce("best.ln", "n").alias("ln"))
    total = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("total"))
    like = F.floor(F.log("n") / F.log(F.lit(THRESHOLD[1] / THRESHOLD[0]))) * (POSITIONS + 1) + F.floor(F.col("pos") * POSITIONS / F.col("n"))
    entries = scratch.write(entries.join(total, "gram").withColumn(
        "like", F.when(F.col("total") > BLOCK, like).otherwise(F.lit(-1)).cast("long")), "classed")
    long_lists = entries.where(F.col("total") > BLOCK)
    parts = long_lists.groupBy("gram", "like", "comp").agg(F.count(F.lit(1)).alias("own"))
    sums = parts.where(F.col("own") <= BLOCK).groupBy("gram", "like").agg(F.sum("own").alias("others"))
    salted = (
        long_lists.join(parts, ["gram", "like", "comp"]).join(sums, ["gram", "like"], "left")
        .withColumn("mine", F.when(F.col("own") > BLOCK, F.col("comp")))
        .withColumn("salt", F.when(F.col("own") > BLOCK, F.expr(f"pmod(xxhash64(sid), ceil(own / {BLOCK}))"))
                    .otherwise(F.expr(f"pmod(xxhash64(comp), ceil(others / {BLOCK}))")))
    )
    short = entries.where(F.col("total") <= BLOCK).withColumn("mine", F.lit(None).cast("long")).withColumn("salt", F.lit(0).cast("long"))
    fields = ("sid", "n", "pos", "comp", "lead", "both", "ln")
    names = ("gram", "like", "mine", "salt", *fields)
    blocks = salted.select(*names).unionByName(short.select(*names)).groupBy("gram", "like", "mine", "salt").agg(
        *(F.collect_list(x).alias(x) for x in fields),  # about BLOCK entries
        F.min("n").alias("small"), F.max("n").alias("large"), F.max(F.col("n") - F.col("pos")).alias("most"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    blocks = scratch.write(blocks.withColumn("block", F.xxhash64("like", "mine", "salt")), "blocks")
    scratch.drop("classed")
    t, s = THRESHOLD
    brief = blocks.select("gram", "block", "small", "large", "most", "lo", "hi")
    met = brief.alias("x").join(brief.alias("y"), F.expr(
        f"x.gram = y.gram and x.block <= y.block and not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)"
        f" and least(x.most, y.most) * {s + t} >= {t} * (x.small + y.small)"
        f" and x.large * {s} >= y.small * {t} and y.large * {s} >= x.small * {t}",
    )).selectExpr("x.gram as gram", "x.block as bx", "y.block as by")
    left = blocks.selectExpr("gram", "block as bx", "struct({}) as x".format(", ".join(fields)))
    right = blocks.selectExpr("gram", "block as by", "struct({}) as y".format(", ".join(fields)))
    both = met.join(left, ["gram", "bx"]).join(right, ["gram", "by"])
    pairs = both.selectExpr("bx = by as same", "x", "y").mapInArrow(_opened, "a long, b long, sure boolean")
    return pairs.groupBy("a", "b").agg(F.max("sure").alias("sure"))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of entries of two blocks that their sizes, positions and answers do not exclude.

    Most blocks are short, so about ``OPENED`` pairs of many block pairs are told apart at once.
    """
    for batch in batches:
        (x, x_size), (y, y_size) = _entries(batch.column("x")), _entries(batch.column("y"))
        same = batch.column("same").to_numpy(zero_copy_only=False).astype(bool)
        x_first, y_first = np.cumsum(x_size) - x_size, np.cumsum(y_size) - y_size
        pairs = x_size * y_size
        ends = np.cumsum(pairs)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + OPENED, "right")))
            row = np.repeat(np.arange(first, last), pairs[first:last])
            at = np.arange(len(row)) + before - (ends - pairs)[row]
            u, v = x_first[row] + at // y_size[row], y_first[row] + at % y_size[row]
            apart = (x["comp"][u] != y["comp"][v]) & (~same[row] | (x["sid"][u] < y["sid"][v]))
            yield _told_apart(x, y, u[apart], v[apart])
            first = last


def _entries(blocks: pa.StructArray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Values of the entries of all blocks one after the other, and the size of each block."""
    lists = dict(zip((f.name for f in blocks.type), blocks.flatten()))
    size = pc.list_value_length(lists["sid"]).to_numpy(zero_copy_only=False).astype(np.int64)
    return {k: v.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k, v in lists.items()}, size


def _told_apart(x: dict, y: dict, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """(a, b, sure) of the pairs of places u in x and v in y that are not excluded."""
    t, s = THRESHOLD
    n, m = x["n"][u], y["n"][v]
    most = np.minimum(n - x["pos"][u], m - y["pos"][v])
    can = (most * (s + t) >= t * (n + m)) & (np.minimum(n, m) * s >= np.maximum(n, m) * t)
    u, v, n, m, most = (c[can] for c in (u, v, n, m, most))
    led = x["lead"][u] == y["lead"][v]
    o, p = x["both"][u], y["both"][v]
    most = np.where(led, np.minimum(most, np.minimum(p + n - o, o + m - p)), most)
    sure = led & ((o + p - x["ln"][u]) * (s + t) >= t * (n + m))
    can = most * (s + t) >= t * (n + m)
    u, v, sure = u[can], v[can], sure[can]
    if sure.any():
        # one sure pair for two groups is enough, and settles the others of these groups
        groups = np.sort(np.column_stack([x["comp"][u], y["comp"][v]]), axis=1)
        _, number = np.unique(groups, axis=0, return_inverse=True)
        number = number.reshape(-1)
        settled = np.zeros(number.max() + 1, bool)
        settled[number[sure]] = True
        keep = ~settled[number]
        at = np.flatnonzero(sure)
        keep[at[np.unique(number[at], return_index=True)[1]]] = True
        u, v, sure = u[keep], v[keep], sure[keep]
    a, b = x["sid"][u], y["sid"][v]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sure)], names=["a", "b", "sure"])


def _joined(comp: DataFrame, links: DataFrame, scratch: Scratch, turn: int) -> DataFrame:
    """Groups after new links between them."""
    if not links.limit(1).count():
        return comp
    of = comp.select(F.col("sid").alias("a"), F.col("comp").alias("ca"))
    to = comp.select(F.col("sid").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(of, "a").join(to, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    label = components(edges.distinct(), scratch, f"cc-{turn}").select(F.col("node").alias("comp"), "label")
    out = comp.join(label, "comp", "left").select("sid", "shared", F.coalesce("label", "comp").alias("comp"))
    return scratch.write(out, f"comp-{turn + 1}")


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents with one of each group: the one of the smallest id.

    Documents without n-grams all stay, so do rows without an id; repeated rows
    of a kept document are one.
    """
    groups = linked_groups(docs, words)
    kept = groups.where("n_shingles > 0 and doc_id = component_id").select("doc_id").distinct()
    lone = groups.where("n_shingles = 0 and doc_id is not null").select("doc_id").distinct()
    whole = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    empty = docs.join(lone.join(kept, "doc_id", "left_anti"), "doc_id", "left_semi")
    return whole.unionByName(empty).unionByName(docs.where("doc_id is null"))
