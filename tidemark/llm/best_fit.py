"""Pack token pieces into sequences: bounded-space online best-fit over a bitset of free space."""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices, written
from .windows import Hashes

SEQUENCE = 2048
OPEN_BINS = 4096
PER_GROUP = 200_000  # pieces packed by one task; a group leaves a few sequences partly empty


class Merges:
    """Ids of many pre-tokens at once: in each round every word joins its pair of lowest rank, leftmost first.

    For byte-level vocabularies with a mark at word ends, as lists of merges.
    """

    def __init__(self, path: str):
        with open(path) as file:
            model = json.load(file)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        # bytes that print stand for themselves, the others for the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(sorted({*range(256)} - {*shown}))}
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)])
        self.last = np.array([vocabulary[letters[b] + end] for b in range(256)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        self.keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs])
        # one rank per hash of a pair; the few pairs that meet another one are looked up in order
        place = self._place(self.keys)
        self.first = np.zeros(1 << 19, np.int32)
        self.first[place[::-1]] = np.arange(len(pairs))[::-1]
        met = np.flatnonzero(self.first[place] != np.arange(len(pairs)))
        self.met = met[np.argsort(self.keys[met])]
        self.meets = np.zeros(1 << 19, bool)
        self.meets[place[met]] = True
        self.made = np.array([vocabulary[a + b] for a, b in pairs])
        self.none = len(pairs)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        place = self._place(key)
        rank = self.first[place].astype(np.int64)
        miss = self.keys[rank] != key
        rank[miss] = self.none
        again = np.flatnonzero(miss & self.meets[place])
        if len(again):
            own = self.keys[self.met]
            at = np.minimum(np.searchsorted(own, key[again]), len(own) - 1)
            found = own[at] == key[again]
            rank[again[found]] = self.met[at[found]]
        return rank

    @staticmethod
    def _place(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).astype(np.int64)

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word; words are not empty."""
        sizes = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[data]
        ends = np.cumsum(sizes)
        symbol[ends - 1] = self.last[data[ends - 1]]
        rank = np.full(len(symbol), self.none)
        rank[:-1] = self._rank(symbol[:-1], symbol[1:])
        rank[ends - 1] = self.none
        word, out = np.arange(len(words)), [b""] * len(words)
        while len(word):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
            done = best >> 32 >= self.none
            if done.any():
                raw = symbol.astype("<u4").tobytes()
                for w, a, n in zip(word[done].tolist(), starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[w] = raw[4 * a:4 * (a + n)]
            at = best[~done] & 0xFFFFFFFF
            symbol[at] = self.made[rank[at]]
            keep = np.repeat(~done, sizes)
            keep[at + 1] = False
            new = (np.cumsum(keep) - 1)[at]
            symbol, rank = symbol[keep], rank[keep]
            word, sizes = word[~done], sizes[~done] - 1
            if not len(word):
                break
            ends = np.cumsum(sizes)
            follows = np.append(symbol[1:], 0)
            rank[new] = self._rank(symbol[new], follows[new])
            before = new[new > 0] - 1
            rank[before] = self._rank(symbol[before], follows[before])
            rank[ends - 1] = self.none
        return out


@functools.cache
def loaded(path: str) -> tuple[Tokenizer, Merges]:
    """Once per worker process, from the tokenizer files installed there."""
    return Tokenizer.from_file(path), Merges(path)


class Words:
    """Token ids of a text by space-separated chunks: equal chunks have equal ids, so each is tokenized once.

    Valid for tokenizers whose pre-tokens never hold white space. Chunks of characters below U+0300, which no
    normal form changes, are split and merged here, all new ones of a batch together; others go through the library one by one.
    ``keep`` bounds the chunks and words that are remembered.
    """

    SPLIT = regex.compile(r" |'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed: the tokenizer's own, and a space
    BEYOND = re.compile("[^\x00-\u02ff]")
    GAP = 0xFFFFFFFF  # no token's id

    def __init__(self, path: str, keep: int = 600_000):
        self.tokenizer, self.merges = loaded(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([self.BEYOND.pattern, *special]))
        self.keep = keep
        self.known: dict[str, bytes] = {"": b""}
        self.gap = {" ": struct.pack("<I", self.GAP)}
        self.words = dict(self.gap)

    def _learn(self, chunks: list[str]) -> None:
        if self.other.search(" ".join(chunks)):
            for c in filter(self.other.search, chunks):
                ids = self.tokenizer.encode(c, add_special_tokens=False).ids
                self.known[c] = struct.pack(f"<{len(ids)}I", *ids)
            chunks = [c for c in chunks if c not in self.known]
        parts = self.SPLIT.findall(" ".join(chunks).lower())
        if len(self.words) > self.keep // 2:
            self.words = dict(self.gap)
        new = list(set(parts) - self.words.keys())
        if new:
            self.words.update(zip(new, self.merges([p.encode() for p in new]), strict=True))
        raw = b"".join(map(self.words.__getitem__, parts))
        ends = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == self.GAP)).tolist()
        if chunks:
            self.known.update((c, raw[a:b]) for c, a, b in zip(chunks, [0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True))

    def _ids(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.known.get, chunks))
        fresh = [c for c, ids in zip(chunks, found, strict=True) if ids is None]
        if fresh:
            if len(self.known) + len(fresh) > self.keep:
                self.known = {"": b""}
                fresh = chunks
            self._learn(fresh)
            found = [self.known[c] if ids is None else ids for c, ids in zip(chunks, found, strict=True)]
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; each distinct chunk of the batch is looked up once."""
        raw = [t.encode() for t in texts]
        joined = b" ".join(raw)
        data = np.frombuffer(joined, np.uint8)
        gaps = np.flatnonzero(data == 32)
        start, end = np.concatenate([[0], gaps + 1]), np.append(gaps, len(data))
        full = end > start
        start, end = start[full], end[full]
        key = Hashes(data).of(start, end) + (end - start).astype(np.uint64)
        order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[new]
        found = self._ids([joined[a:b].decode() for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, at = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        count = size[which]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat(at[which] - total[:-1], count) + np.arange(total[-1])]
        bounds = total[np.searchsorted(start, np.cumsum([0, *(len(r) + 1 for r in raw)]))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def pieces(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", most: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """One row per piece: ``id``, piece, start, length, ids_crc32.

    A document is its token ids and then ``end_id``; a null or empty text is ``end_id`` alone. Documents of more than
    ``most`` ids are cut into pieces of ``most``, the last one shorter. Whole texts are tokenized; repeated rows give repeated pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)  # what it remembers goes with the task
        last, width = end_id.to_bytes(4, "little"), 4 * most
        for part in slices(batches, "value", 4 << 20):
            keys, numbers, lengths, sums = [], [], [], []
            for row, ids in enumerate(words.encode_all([t or "" for t in part["value"].to_pylist()])):
                ids += last
                for number, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at:at + width]
                    keys.append(row)
                    numbers.append(number)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [part["key"].take(pa.array(keys, pa.int64())), pa.array(numbers, pa.int32()),
                 pa.array([n * most for n in numbers], pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=[id, "piece", "start", "length", "ids_crc32"])

    return docs.select(docs[id].alias("key"), docs[text].alias("value")).mapInArrow(
        run, f"{id} {dict(docs.dtypes)[id]}, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Open bins keyed by free space: bit f of ``free`` is set while some open bin has f places left.

    A piece goes to the bin with the least space that holds it: the lowest set bit from its length on. Beyond ``most_open``
    bins the fullest closes first. Memory is bounded by ``most_open``.
    """

    def __init__(self, size: int, most_open: int):
        self.size, self.most_open = size, most_open
        self.free, self.open, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """(number of the bin, place in it)."""
        at = self.free >> length
        if at:
            space = length + (at & -at).bit_length() - 1
            number = self._take(space)
        else:
            number, space = self.made, self.size
            self.made += 1
            while self.open >= self.most_open:
                self._take((self.free & -self.free).bit_length() - 1)
        left = space - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return number


def pack(found: DataFrame, id: str = "doc_id", size: int = SEQUENCE, most_open: int = OPEN_BINS,
         per_group: int = PER_GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces (``id``, piece, length, ...): no sequence exceeds ``size``, none has a gap.

    Pieces are dealt by hash into groups of about ``per_group``, so a hot document or source spreads over all of them, and
    each group is packed as a stream. Its blocks of 8,192 pieces arrive longest first, which lets the short ones fill what the
    long ones leave; bins stay open from block to block. Only lengths move, never ids. A length over ``size`` is an error.
    """
    groups = max(1, -(-found.count() // per_group))
    kinds = [f for f in found.schema.fields if f.name not in ("sequence_id", "offset")]
    names = [f.name for f in kinds]
    ordered = (found.select(*names, F.xxhash64(id, "piece", "length").alias("__h"))
               .withColumn("__g", F.pmod("__h", F.lit(groups))))
    ordered = ordered.repartition(groups, "__g").sortWithinPartitions("__g", "__h", id, "piece", *(
        ["ids_crc32"] if "ids_crc32" in names else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                lengths, owner = part["length"].to_pylist(), part["__g"].to_pylist()
                number, place = [0] * len(lengths), [0] * len(lengths)
                for row in sorted(range(len(lengths)), key=lambda i: (owner[i], -lengths[i])):
                    if owner[row] != group:
                        group, bins = owner[row], Bins(size, most_open)
                    if not 0 < lengths[row] <= size:
                        raise ValueError(f"a piece of {lengths[row]} tokens does not fit {size}")
                    number[row], place[row] = bins.put(lengths[row])
                columns = [part[n] for n in names]
                columns += [pa.array([(g << 40) + n for g, n in zip(owner, number, strict=True)], pa.int64()),
                            pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    return ordered.select(*names, "__g").mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", size: int = SEQUENCE,
                   most_open: int = OPEN_BINS) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece. An empty table packs to no rows."""
    return pack(written(pieces(docs, path, id, text, size), "pieces"), id, size, most_open)
