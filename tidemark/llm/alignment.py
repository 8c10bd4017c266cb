"""Alignment of two tokenizers over a corpus: same-bytes tokens are counted in a vector, other pairs in a shuffle."""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, written
from .tokenizing import remembered, vocabulary

HEAD = 1 << 18  # pairs of the highest counts that each task holds; the rest are joined
HELD = 1 << 20  # pairs a task counts before it passes them on
SLICE_BYTES = 2 << 20
UNLIKE = 0xFFFFFFFF  # no token's id


class Aligner:
    """Both vocabularies. ``same`` maps an A id to the B id of the same bytes, -1 without one.

    A pair (a, b) has one code: a itself where b = same[a], else n_a + a * n_b + b.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = vocabulary(a_path, True), vocabulary(b_path, True)
        self.a_bytes, _ = self.a.token_bytes()
        self.b_bytes, single = self.b.token_bytes()
        self.a_size = np.array([len(t) for t in self.a_bytes])
        self.b_size = np.array([len(t) for t in self.b_bytes])
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        place: dict[bytes, int] = {}
        for k in sorted(range(self.n_b), key=lambda k: k in single):
            place.setdefault(self.b_bytes[k], k)
        self.same = np.array([place.get(t, -1) for t in self.a_bytes])
        self.known: dict[str, tuple[bytes, bytes]] = {}
        # decimal ids with what follows them: A's , or | and B's , or ;
        self.shown = [b"%d%s" % (k, mark) for n, last in ((self.n_a, b"|"), (self.n_b, b";")) for k in range(n) for mark in (b",", last)]

    def _record(self, stretch: str, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        """Ids of a space and the stretch on both sides; a mark follows where they do not give back its bytes."""
        raw = b" " + stretch.encode()
        alike = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
        return array("I", a if alike else [*a, UNLIKE]).tobytes(), array("I", b if alike else [*b, UNLIKE]).tobytes()

    def _learn(self, fresh: list[str]) -> Iterator[tuple[str, tuple[bytes, bytes]]]:
        return zip(fresh, map(self._record, fresh, self.a.encoded([" " + s for s in fresh]), self.b.encoded(fresh)), strict=True)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for each text; none where a text is empty or either side does not give back a space and the text.

        Where both sides may be split at the same spaces, A before and B after them, each distinct stretch is encoded once.
        """
        cut = self.b.stretches if (self.a.step, self.b.step) == (0, 1) else lambda text: [text]
        parts = [cut(t) if t else [] for t in texts]
        a, b = [], []
        with remembered(self.known, parts, self._learn) as record:
            for text, part in zip(texts, parts, strict=True):
                found = list(map(record, part))
                left, right = (np.frombuffer(b"".join(map(itemgetter(k), found)), np.uint32).astype(np.int64) for k in (0, 1))
                if (left == UNLIKE).any():  # stretches that do not match alone may still do so together
                    left, right = left[left != UNLIKE], right[right != UNLIKE]
                    raw = b" " + text.encode()
                    if not (b"".join(map(self.a_bytes.__getitem__, left)) == raw == b"".join(map(self.b_bytes.__getitem__, right))):
                        left = right = left[:0]
                a.append(left)
                b.append(right)
        return a, b

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Per text: n_a, n_b, n_groups, n_links, groups (as text), and the codes of its links with how often each occurs.

        The texts lie end to end, so both sides end together at every text's end. Between two neighbouring ends of either side lies
        one link, as the overlap of two tokens has no end inside.
        """
        left, right = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (left, right))
        a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_text = np.repeat(np.arange(len(texts)), n_a)
        a_last, b_last = np.isin(a_end, b_end), np.isin(b_end, a_end)
        groups = np.bincount(a_text[a_last], minlength=len(texts))

        # A's tokens of a group, then B's
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        total = int(a_last.sum())
        per_a, per_b = np.bincount(a_group, minlength=total), np.bincount(b_group, minlength=total)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[a_group]] = 2 * a + a_last
        order[np.arange(len(b)) + np.cumsum(per_a)[b_group]] = 2 * (self.n_a + b) + b_last
        bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        shown = [b"".join(map(self.shown.__getitem__, order[x:y].tolist()))[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]

        ends = np.concatenate([a_end, b_end[~b_last]])
        ends.sort(kind="stable")
        ia, ib = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        x, y = a[ia], b[ib]
        code = np.where(self.same[x] == y, x, self.n_a + x * self.n_b + y)
        width = self.n_a * (self.n_b + 1)
        key, times = np.unique(a_text[ia] * width + code, return_counts=True)
        owner = key // width
        return {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": np.bincount(a_text[ia], minlength=len(texts)), "groups": shown,
                "codes": key - owner * width, "times": times, "starts": np.searchsorted(owner, np.arange(len(texts) + 1))}


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """Once per worker process."""
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row per row: row, ``id``, n_a, n_b, n_groups, n_links, groups_sha256, codes, times and, if asked for, groups as text.

    codes are the distinct pairs linked in the text (see ``Aligner``), times how many of its links each has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for part in slices(batches, "value", SLICE_BYTES):
            found = both.align([t or "" for t in part["value"].to_pylist()])
            starts = pa.array(found["starts"], pa.int32())
            out = {"row": part["row"], id: part["key"]} | {n: pa.array(found[n], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
            out["groups_sha256"] = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]])
            out["codes"] = pa.ListArray.from_arrays(starts, pa.array(found["codes"], pa.int64()))
            out["times"] = pa.ListArray.from_arrays(starts, pa.array(found["times"], pa.int32()))
            if groups:
                out["groups"] = pa.array([g.decode() for g in found["groups"]])
            yield pa.RecordBatch.from_pydict(out)

    kind = dict(docs.dtypes)[id]
    return (docs.select(F.monotonically_increasing_id().alias("row"), docs[id].alias("key"), docs[text].alias("value"))
            .mapInArrow(run, f"row long, `{id}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                             "codes array<long>, times array<int>" + (", groups string" if groups else "")))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, length of each row's list)."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def pair_counts(found: DataFrame, n_a: int, held: int = HELD) -> DataFrame:
    """code, n: in how many rows of ``found`` the pair is linked.

    A task counts same-bytes pairs in one vector as long as A's vocabulary and the others in sorted arrays of at most about
    ``held`` pairs, so that a pair of nearly all texts leaves a task as few rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(n_a, np.int64)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def merged():
            new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *waiting]), return_counts=True)
            both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)

        def rows(k, n):
            for at in range(0, len(k), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(k[at:at + (1 << 16)]), pa.array(n[at:at + (1 << 16)])], names=["code", "n"])

        for batch in batches:
            codes, _ = _flat(batch["codes"])
            vector += np.bincount(codes[codes < n_a], minlength=n_a)
            waiting.append(codes[codes >= n_a])
            size += len(waiting[-1])
            if size >= held:
                keys, counts = merged()
                waiting, size = [], 0
                if len(keys) >= held:
                    yield from rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        yield from rows(*merged())
        used = np.flatnonzero(vector)
        yield from rows(used, vector[used])

    return found.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _threshold(counts: DataFrame, n_a: int, head: int) -> int:
    """The least count from which on at most ``head`` other pairs have it, from a histogram of some hundreds of rows."""
    step = F.floor(F.log2("n") * 8).cast("int")
    rows = counts.where(F.col("code") >= n_a).groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    least, total = np.iinfo(np.int64).max, 0
    for r in sorted(rows, key=lambda r: -r.step):
        total += r.pairs
        if total > head:
            break
        least = r.least
    return int(least)


def _columns(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy().astype(np.int64) for c in df.toArrow().columns]


def compare(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """One row per row: ``id``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text, B the text, to which it adds the space itself; special strings are ordinary text. Offsets at which
    tokens of both end cut them into groups. A link is a token of A and one of B whose bytes overlap; a pair's count is the number of
    rows that hold it linked. count_sum sums the counts over links, n_best counts the links whose count is the highest of their A id.

    Texts that are null, empty, or that either side does not give back byte by byte (a model's own mark for a space, for one)
    have no tokens: zeros and an empty digest. Rows are handled one by one: repeated rows count as rows of their own, ids may repeat or
    be null, other columns are not read, an empty table gives no rows.

    Every task holds one number per A id twice and the ``head`` most frequent other pairs; pairs below them, each of few rows
    beside the head's, are joined with their counts. The driver gets these bounded tables and nothing else.
    """
    spark = docs.sparkSession
    both = aligner(a_path, b_path)
    n_a, n_b = both.n_a, both.n_b
    found = written(aligned(docs, a_path, b_path, id, text), "aligned")
    counts = written(pair_counts(found, n_a), "pair-counts")
    counts = counts.withColumn("a", F.expr(f"if(code < {n_a}, code, (code - {n_a}) div {n_b})"))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # one row per A id at most
    ids, numbers = _columns(highest)
    top = np.zeros(n_a, np.int64)
    top[ids] = numbers
    ids, numbers = _columns(counts.where(F.col("code") < n_a).select("code", "n"))
    vector = np.zeros(n_a, np.int64)
    vector[ids] = numbers
    least = _threshold(counts, n_a, head)
    others = counts.where(F.col("code") >= n_a)
    keys, numbers = _columns(others.where(F.col("n") >= least).select("code", "n"))
    order = np.argsort(keys)
    tables = spark.sparkContext.broadcast((vector, top, np.append(keys[order], np.iinfo(np.int64).max), np.append(numbers[order], 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, top, keys, numbers = tables.value
        for batch in batches:
            (codes, sizes), (times, _) = _flat(batch["codes"]), _flat(batch["times"])
            row = np.repeat(np.arange(batch.num_rows), sizes)
            alike = codes < n_a
            n = np.zeros(len(codes), np.int64)
            n[alike] = vector[codes[alike]]
            at = np.searchsorted(keys, codes)
            known = keys[at] == codes
            n[known] = numbers[at[known]]
            best = n == top[np.where(alike, codes, (codes - n_a) // n_b)]
            rest = ~(alike | known)
            best[rest] = False

            def summed(values, row=row, batch=batch):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, row, values)
                return pa.array(out)

            starts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=batch.num_rows))]), pa.int32())
            yield pa.RecordBatch.from_pydict({
                **{c: batch[c] for c in kept}, "n_best": summed(best * times), "count_sum": summed(n * times),
                "codes": pa.ListArray.from_arrays(starts, pa.array(codes[rest])),
                "times": pa.ListArray.from_arrays(starts, pa.array(times[rest], pa.int32()))})

    kept = ["row", id, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = dict(found.dtypes)
    judged = written(found.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in kept)
                                      + ", n_best long, count_sum long, codes array<long>, times array<int>"), "judged")
    rest = judged.where(F.size("codes") > 0).select("row", F.explode(F.arrays_zip("codes", "times")).alias("e"))
    rest = rest.select("row", F.col("e.codes").alias("code"), F.col("e.times").cast("long").alias("times"))
    rare = (others.where(F.col("n") < least).join(F.broadcast(highest), "a")
            .select("code", "n", (F.col("n") == F.col("highest")).cast("int").alias("best")))
    late = (rest.join(rare, "code").groupBy("row")
            .agg(F.sum(F.col("n") * F.col("times")).alias("s"), F.sum(F.col("best") * F.col("times")).alias("b")))
    result = written(
        judged.join(late, "row", "left")
        .select(id, "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("b", F.lit(0))).alias("n_best"),
                (F.col("count_sum") + F.coalesce("s", F.lit(0))).alias("count_sum"), "groups_sha256"), "compared")
    tables.unpersist()
    discard(found, counts, judged)
    return result
