"""Remove byte strings that repeat: windows are dealt to shards by their least gram, each shard's suffix array finds the repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, partitions, slices, written
from .suffix_array import repeated
from .windows import Hashes, runs

LENGTH = 400
SHARD_BYTES = 1 << 19  # contents sorted together; keys are added until it is reached
GROUP_BYTES = 8 << 20  # a key's contents beyond it are compared by window hashes, dealt over many tasks
SPANS = "array<struct<start:long,end:long>>"
KEY = ("__k1", "__k2")


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``docs`` with the text as bytes and two hashes of id and text, which stand for the document."""
    body = F.coalesce(docs[text].cast("binary"), F.lit(b""))
    return (docs.withColumn("__body", body).withColumn("__k1", F.xxhash64(docs[id], "__body"))
            .withColumn("__k2", F.xxhash64(F.lit(5), "__body", docs[id])))


def _gram(length: int) -> int:
    return max(1, min(64, length // 6))


def _runs(bodies: DataFrame, length: int) -> DataFrame:
    """(k1, k2, key, content, start, n, again): runs of windows of each text, by the hash of their least gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__body", 1 << 20):
            texts = part["__body"].to_pylist()
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
            key, text, start, end, content, again = runs(np.frombuffer(b"".join(texts), np.uint8), bounds, length, _gram(length))
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [part["__k1"].take(owner), part["__k2"].take(owner), pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                 pa.array(start - bounds[text]), pa.array(end - start), pa.array(again)],
                names=["__k1", "__k2", "key", "content", "start", "n", "again"])

    return bodies.select(*KEY, "__body").mapInArrow(run, "__k1 long, __k2 long, key long, content long, start long, n long, again boolean")


def _contents(bodies: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, content, times, bytes) of the runs ``wanted`` (k1, k2, key, content, start, n, times), cut from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__body", 4 << 20):
            rows = [(w["key"], w["content"], w["times"], body[w["start"]:w["start"] + w["n"]])
                    for body, list_ in zip(part["__body"].to_pylist(), part["wanted"].to_pylist(), strict=True) for w in list_]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["key", "content", "times", "bytes"])

    lists = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("key", "content", "start", "n", "times")).alias("wanted"))
    return (bodies.select(*KEY, "__body").join(lists.hint("shuffle_hash"), list(KEY)).select("__body", "wanted")
            .mapInArrow(run, "key long, content long, times long, bytes binary"))


def _by_suffixes(contents: DataFrame, length: int) -> DataFrame:
    """(key, content, spans) through suffix arrays over whole keys, as many together as make a shard."""
    def solve(found: dict) -> pa.RecordBatch:
        bytes_, times = [b for b, _ in found.values()], np.array([t for _, t in found.values()])
        spans = repeated(bytes_, times, length) if found else []
        kept = [(k, s) for k, s in zip(found, spans, strict=True) if s]
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in kept], pa.int64()), pa.array([k[1] for k, _ in kept], pa.int64()),
             pa.array([[{"start": a, "end": b} for a, b in s] for _, s in kept],
                      pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["key", "content", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, last = {}, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != last and size >= SHARD_BYTES:
                    yield solve(found)
                    found, size = {}, 0
                last = row["key"]
                # repeated rows give a run's bytes more than once
                if (last, row["content"]) not in found:
                    found[last, row["content"]] = (row["bytes"], row["times"])
                    size += len(row["bytes"])
        yield solve(found)

    dealt = contents.repartition(2 * partitions(contents.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, f"key long, content long, spans {SPANS}")


def _by_hashes(contents: DataFrame, length: int) -> DataFrame:
    """(key, content, spans) for keys too large for one task: window hashes, packed and dealt by value, are counted.

    Two windows with equal 64-bit hashes under the same 64-bit key are taken as equal.
    """
    parts = 4 * partitions(contents.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes", 1 << 20):
            rows = part.to_pylist()
            hashes, who, at = [], [], []
            for number, row in enumerate(rows):
                begin = np.arange(len(row["bytes"]) - length + 1)
                hashes.append(Hashes(np.frombuffer(row["bytes"], np.uint8)).of(begin, begin + length) ^ np.uint64(row["key"] & (2**64 - 1)))
                who.append(np.full(len(begin), number))
                at.append(begin)
            hashes, who, at = np.concatenate(hashes), np.concatenate(who), np.concatenate(at)
            to = (hashes % np.uint64(parts)).astype(np.int64)
            ids = np.array([(r["key"], r["content"], r["times"]) for r in rows], np.int64).reshape(-1, 3)
            for p in np.unique(to).tolist():
                own = to == p
                packed = np.column_stack([hashes[own].view(np.int64), ids[who[own]], at[own]])
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([packed.tobytes()], pa.binary())], names=["p", "rows"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.frombuffer(r, np.int64).reshape(-1, 5) for batch in batches for r in batch["rows"].to_pylist()]
        if not rows:
            return
        rows = np.unique(np.concatenate(rows), axis=0)  # repeated rows of a run count once, by its `times`
        _, same = np.unique(rows[:, 0], return_inverse=True)
        rows = rows[np.bincount(same, weights=rows[:, 3])[same] > 1]
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 1]), pa.array(rows[:, 2]), pa.array(rows[:, 4])], names=["key", "content", "at"])

    counted = contents.mapInArrow(deal, "p int, rows binary").repartition(parts, "p").mapInArrow(count, "key long, content long, at long")
    spans = F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + length).alias("end")))
    return counted.groupBy("key", "content").agg(spans.alias("spans"))


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, group_bytes: int = GROUP_BYTES,
          column: str = "spans") -> DataFrame:
    """``docs`` with ``__body`` (the text's bytes) and ``column``, the stretches to remove, which may overlap; null for none.

    A byte is to be removed when a ``length``-byte string that covers it starts in at least two places of all texts. Null texts are
    empty, texts shorter than ``length`` have nothing to remove, repeated rows are repeated texts, other columns are passed on.

    Each text is cut into runs of windows with the same least gram; a repeated window lies in runs of the same key. Runs of
    a key that occurs once are dropped, unless their least gram repeats inside; runs whose key has one content only are repeated whole; of the rest, one copy of each content
    goes to the key's shard and its suffix array. So copies and hot passages are collapsed before any text moves.
    """
    bodies = _keyed(docs, id, text)
    found = written(_runs(bodies, length), "runs")
    # a copied document brings the same rows as often as it occurs
    keys = found.groupBy("key").agg(F.count("*").alias("c"), F.min("content").alias("lo"), F.max("content").alias("hi"),
                                    F.max("again").alias("any")).where("c > 1 or any")
    common = written(found.join(keys, "key"), "common")
    whole = common.where("lo = hi and c > 1").select(*KEY, "start", (F.col("start") + F.col("n")).alias("end"))
    mixed = common.where("lo <> hi or c = 1")
    one = (mixed.groupBy("key", "content").agg(F.count("*").alias("times"), F.min(F.struct(*KEY, "start", "n")).alias("one"))
           .select("key", "content", "times", "one.*"))
    contents = written(_contents(bodies, one), "contents")
    sizes = contents.groupBy("key").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > group_bytes).select("key")
    large = written(sizes, "large-keys")
    if large.isEmpty():
        solved = _by_suffixes(contents, length)
    else:
        solved = _by_suffixes(contents.join(large, "key", "left_anti"), length).unionByName(
            _by_hashes(contents.join(large, "key", "left_semi"), length))
    part = (mixed.join(solved, ["key", "content"]).select(*KEY, F.col("start").alias("base"), F.explode("spans").alias("s"))
            .select(*KEY, (F.col("base") + F.col("s.start")).alias("start"), (F.col("base") + F.col("s.end")).alias("end")))
    per_text = whole.unionByName(part).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias(column))
    per_text = written(per_text, "spans")
    discard(found, common, contents, large)
    return bodies.join(per_text.hint("shuffle_hash"), list(KEY), "left").drop(*KEY)


def kept(body: bytes, cuts: list[dict] | None) -> tuple[bytes, int, int]:
    """(remaining bytes, removed bytes, maximal removed stretches)."""
    if not cuts:
        return body, 0, 0
    parts, at, removed, number, end = [], 0, 0, 0, -1
    for a, b in sorted((c["start"], c["end"]) for c in cuts):
        if a > end:
            number += 1
            parts.append(body[at:a])
        removed += max(0, b - max(a, end if end > a else a))
        at = end = max(end, b)
    parts.append(body[at:])
    return b"".join(parts), removed, number


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, remaining: str | None = None) -> DataFrame:
    """Per document: ``id``, n_bytes, n_removed, n_spans, kept_sha256 and, under the name ``remaining`` if there is one, the remaining text.

    The digest is of the remaining bytes; in the text a character cut in two goes whole. Null texts are empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__body"):
            bodies = part["__body"].to_pylist()
            cut = [kept(body, s) for body, s in zip(bodies, part["spans"].to_pylist(), strict=True)]
            columns = {id: part["key"], "n_bytes": pa.array([len(b) for b in bodies], pa.int64()), "n_removed": pa.array([c[1] for c in cut], pa.int64()),
                       "n_spans": pa.array([c[2] for c in cut], pa.int64()),
                       "kept_sha256": pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string())}
            if remaining is not None:
                columns[remaining] = pa.array([c[0].decode("utf-8", "ignore") for c in cut], pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    found = spans(docs.select(docs[id], docs[text]), id, text, length)
    schema = f"{id} {dict(docs.dtypes)[id]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return found.select(F.col(id).alias("key"), "__body", "spans").mapInArrow(run, schema if remaining is None else f"{schema}, {remaining} string")


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; a character cut in two goes whole. Null texts stay null."""
    columns = docs.columns
    found = spans(docs, id, text, length, column="__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__body"):
            new = [kept(body, s)[0].decode("utf-8", "ignore")
                   for body, s in zip(part["__body"].to_pylist(), part["__spans"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if c == text else part[c] for c in columns], names=columns)

    touched = found.where("__spans is not null").select(*columns, "__body", "__spans").mapInArrow(run, docs.schema)
    return found.where("__spans is null").select(*columns).unionByName(touched)
