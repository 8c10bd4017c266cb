"""Document fingerprints from spots: a common word and the chain of content words that follows it."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import classes, cleaned, discard, partitions, slices, written
from .linking import linked_classes, members_of
from .ngram_join import BUCKET_BITS, Order, crowd_links

# fixed values: common words of English, German, French and Spanish that open a spot
ANCHORS = frozenset((
    "the a an is are was be of to and that in it for on with as by at this "
    "der die das ist und von zu den ein eine nicht mit auf sich "
    "le la les de des et est un une que en dans pour pas "
    "el los y es no por con para una se del al"
).split())
CHAIN = 2  # content words of a chain
DISTANCE = 1  # steps between them
HEAD = 0.3  # share of a set by which a pair is looked at first
GAP = 8  # where so many words before hold no anchor, every word opens a spot
WORD = re.compile(r"\w+")
SIGMA = "\u03a3"
_TURNS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class _Codes(dict):
    """64-bit hash of a word, its lowest bit set for anchors; bounded."""

    def __init__(self, anchors: frozenset[str], most: int = 300_000):
        super().__init__()
        self.anchors, self.most = anchors, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = code = (xxhash.xxh3_64_intdigest(word) & ~1) | (word in self.anchors)
        return code


Read = tuple[str, list[str], np.ndarray]


class Spots:
    """Sorted distinct 32-bit signatures of texts: hashes of an anchor and the chain of content words after it.

    In stretches without anchors, and before the first one, every word stands for one, so that texts of few or no common words have
    signatures that follow their content too. A text with words but without a whole chain has one signature, the hash of all its words; one without words has none.
    """

    def __init__(self, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE):
        self.chain, self.distance = chain, distance
        self.codes = _Codes(anchors)

    def read(self, text: str) -> Read:
        """The lower-cased text, its words and their codes."""
        low = text.lower()
        words = WORD.findall(low)
        return low, words, np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))

    def joined(self, one: Read, two: Read) -> np.ndarray:
        """Codes of the words of two texts put together; a word that the cut divides is one again."""
        (left, words, codes), (right, more, rest) = one, two
        if left and right and WORD.match(left[-1]) and WORD.match(right[0]):
            return np.concatenate([codes[:-1], np.array([self.codes[words[-1] + more[0]]], np.uint64), rest[1:]])
        return np.concatenate([codes, rest])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return self.of([self.read(t)[2] for t in texts], texts.__getitem__)

    def of(self, rows: list[np.ndarray], text: Callable[[int], str]) -> list[np.ndarray]:
        """Signatures of texts whose words have these codes; ``text`` gives a text by its place."""
        sizes = np.array([len(r) for r in rows], np.int64)
        codes = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        ends = np.cumsum(sizes)
        anchor = (codes & np.uint64(1)).astype(bool)
        at = np.arange(len(codes))
        before = np.maximum.accumulate(np.where(anchor, at, -1)) if len(at) else at
        own = np.repeat(ends - sizes, sizes)
        before = np.where(before < own, own - GAP - 1, before)  # the text before counts for nothing
        spot, content = np.flatnonzero(anchor | (at - before > GAP)), np.flatnonzero(~anchor)
        first = np.cumsum(~anchor)[spot]  # the content word after each anchor, in `content`
        last = first + (self.chain - 1) * self.distance
        owner = np.searchsorted(ends, spot, side="right")
        fits = last < len(content)
        spot, first, last, owner = spot[fits], first[fits], last[fits], owner[fits]
        fits = content[last] < ends[owner]
        spot, first, owner = spot[fits], first[fits], owner[fits]
        total = codes[spot] * _TURNS[0]
        for k in range(self.chain):
            total = (total ^ (total >> np.uint64(31))) * _TURNS[3] + codes[content[first + k * self.distance]] * _TURNS[1 + k % 2]
        total = (total ^ (total >> np.uint64(29))) * _TURNS[3]
        found = np.unique((owner.astype(np.uint64) << np.uint64(32)) | (total >> np.uint64(32)))
        cut = np.searchsorted(found, np.arange(1, len(rows), dtype=np.uint64) << np.uint64(32))
        out = [own.astype(np.uint32) for own in np.split(found, cut)]
        for k in np.flatnonzero(sizes):
            if not len(out[k]):
                out[k] = np.array([xxhash.xxh32_intdigest(" ".join(WORD.findall(text(int(k)).lower())))], np.uint32)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 1 for two empty ones. Sets of very unequal size need no look at their members
    beyond the smaller one's."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if not len(a):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


_SPOTS: list[Spots] = []


def _spots() -> Spots:
    if not _SPOTS:
        _SPOTS.append(Spots())
    return _SPOTS[0]


def _packed(signatures: np.ndarray) -> bytes:
    return signatures.astype(">u4").tobytes()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, fingerprint (binary: the sorted signatures, four bytes each), size.

    Null and empty texts and texts without words have an empty fingerprint. Equal texts have equal fingerprints; rows are
    handled one by one, other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = _spots()
        for part in slices(batches, "value"):
            found = spots([t or "" for t in part["value"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part["key"], pa.array([_packed(f) for f in found], pa.binary()), pa.array([len(f) for f in found], pa.int32())],
                names=[id, "fingerprint", "size"])

    return docs.select(docs[id].alias("key"), docs[text].alias("value")).mapInArrow(
        run, f"{id} {dict(docs.dtypes)[id]}, fingerprint binary, size int")


def _ranked(by: Order, signatures: np.ndarray) -> np.ndarray:
    """Places of signatures in the order: by their counter, then by themselves."""
    own = signatures.astype(np.uint64)
    return by.keys(own << np.uint64(BUCKET_BITS) | own & np.uint64((1 << BUCKET_BITS) - 1))


def rarity(prints: DataFrame) -> Order:
    """Counts the signatures of the column fingerprint in a table of 2**BUCKET_BITS counters, whatever the number of rows; the driver gets only that."""
    size, parts, kind = 1 << BUCKET_BITS, 16, "p int, counts binary"

    def rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        packed = [zlib.compress(c.astype(np.int64).tobytes(), 1) for c in sums.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["p", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in slices(batches, "fingerprint"):
            found = np.frombuffer(b"".join(part["fingerprint"].to_pylist()), ">u4")
            total += np.bincount(found.astype(np.int64) & (size - 1), minlength=size)
        yield rows(dict(enumerate(np.split(total, parts))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, raw in zip(batch["p"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums[p] = sums.get(p, 0) + np.frombuffer(zlib.decompress(raw), np.int64)
        yield rows(sums)

    found = prints.select("fingerprint").mapInArrow(count, kind).repartition(parts, "p").mapInArrow(add, kind).collect()
    counts = np.zeros((parts, size // parts), np.int64)
    for row in found:
        counts[row["p"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return Order(counts.reshape(-1), 1)


def _known(column: str) -> list:
    """Two 64-bit hashes by which a fingerprint is known."""
    return [F.xxhash64(column).alias("k1"), F.xxhash64(F.lit(7), column).alias("k2")]


def near_duplicates(prints: DataFrame, percent: int = 80, id: str = "doc_id", spend: bool = False) -> DataFrame:
    """One row per row of ``fingerprints``: ``id``, component_id, the smallest id reachable by links.

    Two documents link when the Jaccard similarity of their signatures is ``percent`` or more; equal fingerprints are one node, empty ones
    link with nothing, rows without an id have no component, rows that share an id are one node. ``prints`` is read twice and had better be written; with
    ``spend`` it is deleted once it has been read.

    Sizes are cut into partitions, each ``100 / percent`` times as long as the one before: a set is posted under its own partition and, as
    the larger side, looked up in the one below too, so sets of incompatible length never meet. Within one, sets meet under the rarest of
    their signatures (``rarity``), as many as a link needs. Pairs are compared by the first HEAD of both in that order, and those that may still link
    whole; what is left of crowded postings is
    compared block by block, without a row per pair.
    """
    kind = dict(prints.dtypes)[id]
    sets = prints.where(F.col("size") > 0).where(prints[id].isNotNull())
    nodes = written(sets.groupBy("fingerprint").agg(F.min(id).alias("node"), F.first("size").alias("n")), "prints")
    ids = written(prints.select(F.col(id).alias("key"), *_known("fingerprint"), (F.col("size") > 0).alias("any")), "prints-of-ids")
    if spend:
        discard(prints)
    spark = prints.sparkSession
    cleaned(spark)
    step = float(np.log(100 / percent))
    order = spark.sparkContext.broadcast(rarity(nodes))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for batch in slices(batches, "fingerprint", 1 << 20):
            row, key, rank, index = [], [], [], []
            for number, (raw, n) in enumerate(zip(batch["fingerprint"].to_pylist(), batch["n"].to_pylist(), strict=True)):
                sigs = np.frombuffer(raw, ">u4").astype(np.uint64)
                turn = np.argsort(_ranked(by, sigs))
                keep = n + (-percent * n // 100) + 1
                short = n + (-2 * percent * n // (100 + percent)) + 1
                own = int(np.log(n) / step + 1e-9)
                least = int(np.exp(own * step) * (1 - 1e-9))  # of its own partition no smaller set can link
                for part, many in ((own, min(keep, n + (-percent * (n + least) // (100 + percent)) + 1)), (own - 1, keep)):
                    row += [number] * many
                    key.append((sigs[turn[:many]] << np.uint64(31) | np.uint64(part + 1)).view(np.int64))
                    rank += range(many)
                    index += [part == own and k < short for k in range(many)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key) if key else [], pa.int64()), batch["node"].take(pa.array(row, pa.int64())),
                 batch["n"].take(pa.array(row, pa.int64())), pa.array(rank, pa.int32()), pa.array(index, pa.bool_())],
                names=["key", "node", "n", "rank", "index"])

    postings = nodes.select("fingerprint", "node", "n").mapInArrow(
        post, f"key long, node {kind}, n int, rank int, index boolean").withColumn("n", F.col("n").cast("long"))
    members = members_of(postings, "spots")
    cleaned(spark)
    spare = [ids, nodes, members]

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "fingerprint", 1 << 20):
            own = [np.frombuffer(raw, ">u4").astype(np.uint32).view(np.int32) for raw in batch["fingerprint"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([0] * len(own), pa.int32()), pa.array(own, pa.list_(pa.int32()))],
                                             names=["node", "fragment", "segment"])

    def dense(crowded: DataFrame) -> DataFrame:
        cleaned(spark)
        asked = nodes.join(crowded.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("fingerprint").alias("fingerprint"))
        parts = asked.select("node", "fingerprint").mapInArrow(unpacked, f"node {kind}, fragment int, segment array<int>")
        return crowd_links(crowded, parts, percent, kind, spare)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for batch in slices(batches, "fingerprint", 1 << 20):
            own = [np.frombuffer(raw, ">u4") for raw in batch["fingerprint"].to_pylist()]
            first = [_packed(x[np.argsort(_ranked(by, x))[:int(HEAD * len(x)) + 1]]) for x in own]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], pa.array(first, pa.binary())], names=["node", "n", "head"])

    def may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for batch in batches:
            keep = []
            for an, x, bn, y in zip(*(batch[c].to_pylist() for c in ("an", "x", "bn", "y")), strict=True):
                x, y = (_ranked(by, np.frombuffer(raw, ">u4")) for raw in (x, y))
                end = min(x[-1], y[-1])  # up to here both sets are known
                x, y = x[x <= end], y[y <= end]
                differ = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
                keep.append(differ * (100 + percent) <= (an + bn) * (100 - percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [100 * likeness(np.frombuffer(x, ">u4"), np.frombuffer(y, ">u4")) >= percent - 1e-9
                    for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        cleaned(spark)
        links = f"a {kind}, b {kind}"

        def asked(pairs: DataFrame) -> DataFrame:
            names = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
            return nodes.join(names, "node", "left_semi").select("node", "n", "fingerprint")

        side = asked(pairs).mapInArrow(heads, f"node {kind}, n int, head binary")
        near = pairs.join(side.toDF("a", "an", "x"), "a").join(side.toDF("b", "bn", "y"), "b").mapInArrow(may_link, links)
        near = written(near.distinct(), "spots-near")
        spare.append(near)
        cleaned(spark)
        side = asked(near).select("node", "fingerprint")
        return near.join(side.toDF("a", "x"), "a").join(side.toDF("b", "y"), "b").mapInArrow(compare, links)

    roots = linked_classes(members, percent, verify, "spots", dense=dense)
    rooted = nodes.join(roots, "node", "left").select(*_known("fingerprint"), F.coalesce("root", "node").alias("root"))
    result = written(ids.join(rooted, ["k1", "k2"], "left").select(F.col("key").alias(id), F.when(
        F.col("key").isNotNull(), F.coalesce(F.when(F.col("any"), F.col("root")), "key")).alias("component_id")), "spot-classes")
    discard(*spare, roots)
    cleaned(spark)
    low, high = F.min("component_id"), F.max("component_id")
    if result.where(F.col(id).isNotNull()).groupBy(id).agg((low != high).alias("split")).where("split").isEmpty():
        return result
    # texts that share an id belong to several classes: those are one
    one = classes(result.where(F.col(id) != F.col("component_id")).select(F.col(id).alias("a"), F.col("component_id").alias("b")), "shared-ids")
    joined = written(result.join(one.toDF(id, "root"), id, "left").select(id, F.coalesce("root", "component_id").alias("component_id")), "spot-classes")
    discard(result, one)
    return joined


RESULT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(texts: list[str], after: list[str]) -> list[tuple]:
    """RESULT of each text, its next document being the one at the same place of ``after``."""
    spots = _spots()
    edited, codes, known = [], [], {}
    for text, next_ in zip(texts, after, strict=True):
        cut = len(text) // 4
        head, tail = text[:len(text) - cut], next_[:cut]
        edited.append(head + tail)
        if SIGMA in text or SIGMA in tail:  # its small form depends on what follows, also across the cut
            known.setdefault(text, spots.read(text)[2])
            codes.append(spots.read(edited[-1])[2])
        else:  # the words before the cut are read once for both texts
            start = spots.read(head)
            known.setdefault(text, spots.joined(start, spots.read(text[len(head):])))
            codes.append(spots.joined(start, spots.read(tail)))
    for text in after:  # mostly the same texts, moved by one
        if text not in known:
            known[text] = spots.read(text)[2]
    marks = dict(zip(known, spots.of(list(known.values()), list(known).__getitem__), strict=True))
    return [(len(t), hashlib.sha256(e.encode()).hexdigest(), _packed(marks[t]), _packed(f), likeness(marks[t], f), likeness(marks[t], marks[n]))
            for t, n, e, f in zip(texts, after, edited, spots.of(codes, edited.__getitem__), strict=True)]


def _ranges(docs: DataFrame, key: str, number: int):
    """A column that numbers about ``number`` ranges of the ids in order, null ids in the first; the same for equal ids at any time."""
    shares = [k / number for k in range(1, number)] or [0.5]
    row = docs.agg(F.percentile_approx(key, shares, 100 * number)).first()
    bounds = np.unique(np.array(row[0] or [], np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="left").astype(np.int32))

    return place(F.coalesce(F.col(key), F.lit(-(1 << 63))))


def against_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", groups: DataFrame | None = None) -> DataFrame:
    """Per document: ``id`` and RESULT, each fingerprint compared with that of the edited text and of the next document.

    The edited text has its last floor(n / 4) characters replaced by the first as many, or all, of the next document, by ascending id
    (nulls first, equal ids by text); the last document's next is the first. Null texts are empty; a single document is its own next.
    Ids are whole numbers. With ``groups`` (``id``, component_id; one row at most per id) component_id follows: that of the id, or the id itself.

    Documents are dealt by ranges of ids and read in order, each meeting the next one of its range. The last document of each range
    meets the first of the range after it in a second, small step, for which only those are read. Groups travel with the documents: the row of an id
    comes right before its texts, so neither texts nor fingerprints are shuffled for them.
    """
    kind = dict(docs.dtypes)[id]
    number = 2 * partitions(docs.sparkSession)
    rows = docs.select(docs[id].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("value"))
    place = _ranges(rows.select("key"), "key", number)
    ranged = rows.withColumn("range", place)
    order = [F.col("range"), F.col("key").asc_nulls_first(), F.col("value").asc_nulls_first()]
    given = groups
    if groups is None:
        groups = docs.sparkSession.createDataFrame([], "key long, component_id long")
    else:
        groups = groups.where(groups[id].isNotNull()).select(groups[id].cast("long").alias("key"), F.col("component_id").cast("long"))
    dealt = ranged.withColumn("component_id", F.lit(None).cast("long")).unionByName(
        groups.withColumns({"value": F.lit(None).cast("string"), "range": place}))
    dealt = dealt.repartition(number, "range").sortWithinPartitions(*order)
    names = [f.split()[0] for f in RESULT.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())

    def results(part: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        own = (pa.array([r[i] for r in found], k) for i, k in enumerate(kinds))
        return pa.RecordBatch.from_arrays([part["key"], part["component_id"], *own], names=["key", "component_id", *names])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, {}
        for part in slices(batches, "value", 2 << 20):
            named = part.filter(part["value"].is_null())
            if named.num_rows:  # of the groups before, only the last may have texts still to come
                known = dict([*list(known.items())[-1:], *zip(named["key"].to_pylist(), named["component_id"].to_pylist(), strict=True)])
                part = part.filter(part["value"].is_valid())
                if not part.num_rows:
                    continue
            component = pa.array([known.get(k, k) for k in part["key"].to_pylist()], pa.int64())
            part = pa.RecordBatch.from_arrays([part["key"], part["value"], part["range"], component], names=["key", "value", "range", "component_id"])
            both = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            texts, ranges = both["value"].to_pylist(), both["range"].to_numpy()
            pairs = np.flatnonzero(ranges[1:] == ranges[:-1]).tolist()
            if pairs:
                yield results(both.take(pa.array(pairs)), _compared([texts[k] for k in pairs], [texts[k + 1] for k in pairs]))
            held = both.slice(both.num_rows - 1)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "value"):
            yield results(part, _compared(part["value"].to_pylist(), part["after"].to_pylist()))

    # first and last of each range: by id alone, then by text among equal ids
    ids = ranged.select("range", "key").groupBy("range").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("range").collect()
    wanted = sorted({k for r in ids for k in (r["lo"], r["hi"]) if k is not None})
    spark = docs.sparkSession
    outer = spark.createDataFrame([(k,) for k in wanted], "edge long")  # two ids a range
    edge = ranged.join(F.broadcast(outer), F.col("key").eqNullSafe(F.col("edge")), "left").where("edge is not null or key is null")
    pair = F.struct("key", "value")
    ends = written(edge.groupBy("range").agg(F.min(pair).alias("first"), F.max(pair).alias("last")), "ends")
    turn = [r["range"] for r in ids]
    follows = spark.createDataFrame(list(zip(turn, [*turn[1:], *turn[:1]], strict=True)), "range int, then int")
    after = ends.select(F.col("range").alias("then"), F.col("first.value").alias("after"))
    lasts = ends.join(F.broadcast(follows), "range").join(after, "then").select("last.*", "after").join(groups, "key", "left")
    lasts = lasts.withColumn("component_id", F.coalesce("component_id", "key"))
    schema = f"key long, component_id long, {RESULT}"
    found = dealt.mapInArrow(inside, schema).unionByName(lasts.mapInArrow(between, schema))
    own = [] if given is None else [F.col("component_id").cast(kind)]
    return found.select(F.col("key").cast(kind).alias(id), *names, *own)


def with_classes(docs: DataFrame, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``against_edits`` with the component_id of ``near_duplicates``; null ids have none."""
    prints = written(fingerprints(docs, id, text), "fingerprints")
    found = near_duplicates(prints, percent, id, spend=True)
    groups = written(found.where(F.col(id) != F.col("component_id")).distinct(), "spot-groups")
    discard(found)
    cleaned(docs.sparkSession)
    return against_edits(docs, id, text, groups)
