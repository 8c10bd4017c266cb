"""Jaccard join on word n-grams by vertical partitioning of a global n-gram order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, written
from .linking import linked_classes, members_of
from .windows import Hashes, mixed

FRAGMENTS = 6
TILE, TILE_GRAMS = 128, 1 << 17  # sets and n-grams of a block
BUCKET_BITS = 21  # counters of the frequency sketch: 8 MB, whatever the size of the corpus
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_TURNS = np.random.default_rng(7).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


def shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``words``-word shingles.

    A-Z are lower-cased, words are what blanks and the characters 9 to 13 separate. A text of fewer words has one shingle, the
    whole sequence; one without words has none.
    """
    joined = b"\n".join(texts).lower()
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = SPACE[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    word = Hashes(data).of(start, end) if len(start) else np.zeros(0, np.uint64)
    first = np.searchsorted(start, bounds)
    total = np.zeros(len(word), np.uint64)
    for k in range(min(words, len(word))):
        total[:len(word) - k] += word[k:] * _TURNS[k]
    total = mixed(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            found = np.sort(total[a:b - words + 1])
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            out.append(found[new])
        elif b > a:
            out.append(mixed((word[a:b] * _TURNS[words:words + b - a]).sum(keepdims=True)))
        else:
            out.append(word[:0])
    return out


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part["value"].to_pylist()]


class Order:
    """The global n-gram order: by estimated document frequency, then by hash; cut into fragments of equal mass.

    The frequency is a counter of a fixed table of 2**BUCKET_BITS, which every occurrence in the corpus is counted into: it is
    never too small, and too large by what else falls into the counter. Any order gives right results; this one puts frequent n-grams last.
    """

    def __init__(self, counts: np.ndarray, fragments: int):
        self.counts = np.minimum(counts, (1 << 20) - 1).astype(np.uint32)
        value, number = np.unique(counts, return_counts=True)
        mass = np.cumsum(value * number)
        pivots = []
        for q in range(1, fragments):
            goal = mass[-1] * q / fragments
            at = int(np.searchsorted(mass, goal))
            before = mass[at - 1] if at else 0
            share = (goal - before) / max(1, mass[at] - before)
            pivots.append((min(int(value[at]), (1 << 20) - 1) << 44) + int(share * ((1 << 44) - 1)))
        self.pivots = np.array(pivots, np.uint64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        count = self.counts[(grams & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)]
        return count.astype(np.uint64) << np.uint64(44) | grams >> np.uint64(BUCKET_BITS)


def global_order(docs: DataFrame, text: str, words: int, fragments: int) -> Order:
    """Count the n-grams of all texts into the fixed table. The driver gets the table, never n-grams."""
    size, parts = 1 << BUCKET_BITS, 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, number = np.zeros(size, np.uint32), [], 0

        def add_held() -> None:
            grams = np.concatenate([np.zeros(0, np.uint64), *held])
            np.add(total, np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size), out=total, casting="unsafe")
            held.clear()

        for part in slices(batches, "value", 2 << 20):
            for grams in shingles(_texts(part), words):
                held.append(grams)
                number += len(grams)
            if number > size:
                add_held()
                number = 0
        add_held()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()), pa.array([zlib.compress(t.tobytes(), 1) for t in np.split(total, parts)], pa.binary())],
            names=["p", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, raw in zip(batch["p"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums[p] = sums.get(p, np.zeros(size // parts, np.int64)) + np.frombuffer(zlib.decompress(raw), np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(t.tobytes(), 1) for t in sums.values()], pa.binary())],
            names=["p", "counts"])

    kind = "p int, counts binary"
    rows = (docs.select(docs[text].cast("binary").alias("value")).mapInArrow(count, kind)
            .repartition(parts, "p").mapInArrow(add, kind).collect())
    counts = np.zeros(size, np.int64)
    for row in rows:
        counts[row["p"] * (size // parts):(row["p"] + 1) * (size // parts)] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return Order(counts, fragments)


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def _prefixes(docs: DataFrame, order, id: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, k1, k2, n, rare, short): two hashes of each document's set, its size, its rarest n-grams, and how many of them
    suffice where it is the smaller side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for part in slices(batches, "value", 2 << 20):
            k1, k2, size, rare, short = [], [], [], [], []
            for grams in shingles(_texts(part), words):
                n = len(grams)
                k1.append(int(mixed(grams * _TURNS[50]).sum().view(np.int64)))
                k2.append(int(mixed(grams ^ _TURNS[51]).sum().view(np.int64)))
                size.append(n)
                keep = n - _ceil(percent * n, 100) + 1 if n else 0
                key = by.keys(grams)
                if keep < n:
                    near = np.argpartition(key, keep - 1)[:keep]
                    grams, key = grams[near], key[near]
                rare.append(grams[np.lexsort((grams, key))].view(np.int64))
                short.append(n - _ceil(2 * percent * n, 100 + percent) + 1 if n else 0)
            yield pa.RecordBatch.from_arrays(
                [part["key"], pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(rare, pa.list_(pa.int64())), pa.array(short, pa.int32())], names=["id", "k1", "k2", "n", "rare", "short"])

    return docs.select(docs[id].alias("key"), docs[text].cast("binary").alias("value")).mapInArrow(
        run, f"id {dict(docs.dtypes)[id]}, k1 long, k2 long, n long, rare array<long>, short int")


def _segments(docs: DataFrame, order, id: str, text: str, words: int) -> DataFrame:
    """(node, fragment, segment): each document's n-grams by fragment of the global order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for part in slices(batches, "value", 2 << 20):
            rows, fragment, segment = [], [], []
            for row, grams in enumerate(shingles(_texts(part), words)):
                where = np.searchsorted(by.pivots, by.keys(grams), side="right")
                turn = np.argsort(where, kind="stable")
                cut = np.searchsorted(where[turn], np.arange(1, len(by.pivots) + 1))
                for f, own in enumerate(np.split(grams[turn], cut)):
                    if len(own):
                        rows.append(row)
                        fragment.append(f)
                        segment.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part["key"].take(pa.array(rows, pa.int64())), pa.array(fragment, pa.int32()), pa.array(segment, pa.list_(pa.int64()))],
                names=["node", "fragment", "segment"])

    return docs.select(docs[id].alias("key"), docs[text].cast("binary").alias("value")).mapInArrow(
        run, f"node {dict(docs.dtypes)[id]}, fragment int, segment array<long>")


def _near(pairs: DataFrame, order, percent: int, kind: str) -> DataFrame:
    """Pairs (a, an, x, b, bn, y) that may link by their rarest n-grams x and y, without those.

    Below the last n-gram of either prefix both sets are known: that is the first fragment, and where they differ there in more
    n-grams than two linked sets of their sizes may differ in all, the pair is out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for batch in batches:
            keep = []
            columns = (batch[c].to_numpy(zero_copy_only=False) for c in ("an", "x", "bn", "y"))
            for an, x, bn, y in zip(*columns, strict=True):
                x, y = x.view(np.uint64), y.view(np.uint64)
                p, q = by.keys(x), by.keys(y)
                end = min(p[-1], q[-1])
                x, y = x[p < end], y[q < end]
                differ = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
                keep.append(differ * (100 + percent) <= (an + bn) * (100 - percent))
            yield batch.select(["a", "b", "an", "bn"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "an", "x", "bn", "y").mapInArrow(run, f"a {kind}, b {kind}, an long, bn long")


def overlaps(a: tuple, b: tuple, rows: int, columns: int) -> np.ndarray:
    """How many n-grams of one fragment each two sets of two blocks share: ``a`` and ``b`` are (set of each n-gram, n-gram)."""
    common = np.intersect1d(a[1], b[1])
    total = np.zeros((rows, columns), np.float32)  # exact below 2**24
    for at in range(0, len(common), 1 << 13):
        part = common[at:at + (1 << 13)]
        sides = []
        for (owner, grams), n in ((a, rows), (b, columns)):
            place = np.minimum(np.searchsorted(part, grams), len(part) - 1)
            hit = part[place] == grams
            side = np.zeros((n, len(part)), np.float32)
            side[owner[hit], place[hit]] = 1
            sides.append(side)
        total += sides[0] @ sides[1].T
    return total


def crowd_links(crowded: DataFrame, parts: DataFrame, percent: int, kind: str, spare: list) -> DataFrame:
    """Links (a, b) that connect all that link among the members (key, node, n) of each key.

    A key's members are dealt by hash into blocks of about TILE sets and TILE_GRAMS n-grams; every two blocks meet in one task, which
    counts the overlaps fragment by fragment as products of 0/1 matrices, sums them and returns one link per set that
    links there, to the least node it is connected to. A crowd of m sets costs (m / TILE) ** 2 / 2 tasks and no row per pair.
    """
    sizes = crowded.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_GRAMS)).cast("int").alias("blocks"))
    dealt = crowded.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    held = dealt.join(parts, "node").groupBy("key", "blocks", "block").agg(F.collect_list(F.struct("node", "n", "fragment", "segment")).alias("sets"))
    held = written(held, "crowd-blocks")
    spare.append(held)
    one = held.select("key", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"), F.col("sets").alias("a"))
    tiles = one.join(held.select("key", F.col("block").alias("j"), F.col("sets").alias("b")), ["key", "j"]).select("i", "j", "a", "b")

    def read(column: pa.Array) -> tuple[np.ndarray, np.ndarray, dict]:
        sets = column.flatten()
        node, n, fragment, segment = (sets.field(k) for k in range(4))
        nodes, first, owner = np.unique(node.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        own = {}
        lengths = segment.value_lengths().to_numpy(zero_copy_only=False)
        each, grams, which = np.repeat(owner, lengths), segment.flatten().to_numpy(zero_copy_only=False), np.repeat(
            fragment.to_numpy(zero_copy_only=False), lengths)
        for f in np.unique(which):
            own[int(f)] = each[which == f], grams[which == f]
        return nodes, n.to_numpy(zero_copy_only=False)[first], own

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                (a, an, x), (b, bn, y) = read(one["a"]), read(one["b"])
                both = np.zeros((len(a), len(b)), np.int64)
                for f in x.keys() & y.keys():
                    both += overlaps(x[f], y[f], len(a), len(b)).astype(np.int64)
                i, j = np.nonzero(both * 100 >= (an[:, None] + bn[None, :] - both) * percent)
                names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
                i, j = place[i], place[len(a) + j]
                root = np.arange(len(names))
                while True:
                    low = np.minimum(root[i], root[j])
                    before = root.copy()
                    np.minimum.at(root, i, low)
                    np.minimum.at(root, j, low)
                    if (root == before).all():
                        break
                moved = np.flatnonzero(root != np.arange(len(names)))
                yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], names=["a", "b"])

    return written(tiles.mapInArrow(compared, f"a {kind}, b {kind}").distinct(), "crowd-links")


def join(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text",
         fragments: int = FRAGMENTS) -> DataFrame:
    """One row per document: ``id``, n_shingles, component_id, the smallest id reachable by links.

    Two documents link when 100 * |intersection| >= ``percent`` * |union| of their sets of ``words``-word shingles. Null or
    empty texts and texts without words have 0 shingles and link with nothing. Documents with equal sets are one node, so copies
    are never compared. Rows that share an id are one node too; rows without an id have no component. Other columns are not read.

    The n-grams are put in one global order, rarest first. A link needs a common n-gram among the rarest of both, so each node is posted
    under those only; of the nodes that share one, candidates are chosen by ``linking``, and those that differ too much in the rarest n-grams
    alone are dropped. The order is cut into ``fragments``; the overlap of a pair is counted fragment by fragment, each a join of its own
    key, and the counts are summed per pair.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id]
    order = spark.sparkContext.broadcast(global_order(docs, text, words, fragments))
    sets = written(_prefixes(docs, order, id, text, words, percent), "sets")
    nodes = (sets.where("n > 0 and id is not null").groupBy("k1", "k2")
             .agg(F.min("id").alias("node"), F.min("n").alias("n"), F.first("rare").alias("rare"), F.min("short").alias("short")))
    nodes = written(nodes, "nodes")
    postings = nodes.select("node", "n", "short", F.posexplode("rare").alias("rank", "key")).select(
        "key", "node", "n", "rank", (F.col("rank") < F.col("short")).alias("index"))
    members = members_of(postings, "members")
    whole = docs.select(docs[id].alias("node"), docs[text].alias("body"))
    segments: list[DataFrame] = []
    spare = [sets, nodes, members]

    def segments_of(asked: DataFrame) -> DataFrame | None:
        """Segments of these nodes and of all asked for before."""
        for earlier in segments:
            asked = asked.join(earlier.select("node"), "node", "left_anti")
        asked = written(asked, "asked")
        spare.append(asked)
        if not asked.isEmpty():
            texts = whole.join(asked.hint("shuffle_hash"), "node", "left_semi")
            segments.append(written(_segments(texts, order, "node", "body", words), "segments"))
        return reduce(DataFrame.unionByName, segments) if segments else None

    def dense(crowded: DataFrame) -> DataFrame:
        parts = segments_of(crowded.select("node").distinct())
        # rows that share an id bring a fragment more than once
        return crowd_links(crowded, parts.groupBy("node", "fragment").agg(F.max("segment").alias("segment")), percent, kind, spare)

    def verify(pairs: DataFrame) -> DataFrame:
        side = nodes.select("node", "n", "rare")
        known = (pairs.join(side.toDF("a", "an", "x"), "a").join(side.toDF("b", "bn", "y"), "b"))
        near = written(_near(known, order, percent, kind), "near")
        spare.append(near)
        parts = segments_of(near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct())
        if parts is None:
            return near.select("a", "b")
        left = near.join(parts.toDF("a", "fragment", "x"), "a")
        both = left.join(parts.toDF("b", "fragment", "y"), ["b", "fragment"])
        partial = both.select("a", "b", "an", "bn", "fragment", F.size(F.array_intersect("x", "y")).cast("long").alias("part"))
        # rows that share an id bring a fragment more than once
        partial = partial.groupBy("a", "b", "an", "bn", "fragment").agg(F.max("part").alias("part"))
        overlap = partial.groupBy("a", "b", "an", "bn").agg(F.sum("part").alias("both"))
        return overlap.where(F.col("both") * 100 >= (F.col("an") + F.col("bn") - F.col("both")) * percent).select("a", "b")

    roots = linked_classes(members, percent, verify, "ngram", 1, dense)
    per_set = nodes.select("k1", "k2", "node").join(roots, "node", "left").select("k1", "k2", F.coalesce("root", "node").alias("root"))
    result = written(
        sets.select("id", "k1", "k2", "n").join(per_set, ["k1", "k2"], "left")
        .select(F.col("id").alias(id), F.col("n").alias("n_shingles"),
                F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).cast(kind).alias("component_id")), "ngram-join")
    discard(*spare, *segments, roots)
    return result


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents whose class holds one of a smaller id; rows without an id stay."""
    found = join(docs, words, percent, id, text)
    gone = found.where(F.col(id) != F.col("component_id")).select(F.col(id).alias("__gone")).distinct()
    return docs.join(gone, docs[id] == F.col("__gone"), "left_anti")


def one_per_class(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near copies, the one of the smallest id; rows without an id come last.

    A row is known by two 64-bit hashes of its id and text: rows that are equal in both are one, rows of one id with different texts are different
    documents, and rows without an id are compared like others. Texts without words are in no class and stay.
    """
    key = [docs[id], docs[text].cast("binary")]
    rows = docs.withColumns({"__row": F.xxhash64(*key, F.lit(3)), "__two": F.xxhash64(F.lit(11), *reversed(key))})
    again = rows.groupBy("__row").agg(F.count("*").alias("c"), (F.min("__two") != F.max("__two")).alias("__clash")).where("c > 1")
    again = written(again.select("__row", "__clash"), "repeated-rows")
    if again.isEmpty():
        rows = rows.drop("__two")
    else:
        repeated = rows.join(again, "__row").withColumn("__row", F.when(F.col("__clash"), F.xxhash64("__row", "__two")).otherwise(F.col("__row")))
        whole = F.struct(*docs.columns)
        one = repeated.groupBy("__row", "__two").agg(F.min_by(whole, F.to_json(whole)).alias("one")).select("one.*", "__row")
        rows = rows.join(again, "__row", "left_anti").select(*docs.columns, "__row").unionByName(written(one, "one-of-each"))
    found = join(rows, words, percent, "__row", text).where("n_shingles > 0")
    ids = rows.select("__row", F.col(id).alias("id"))
    found = written(found.join(ids, "__row").select("__row", "id", "component_id"), "classes-of-rows")
    kept = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__row")).alias("kept")).select("kept.__row")
    gone = written(found.join(kept, "__row", "left_anti").select(F.col("__row").alias("__gone")), "gone")
    return rows.join(gone, F.col("__row") == F.col("__gone"), "left_anti").select(*docs.columns)
