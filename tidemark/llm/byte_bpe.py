"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, the rest by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import slices

MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: one base64 token and its id a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def _slot(h: int, turn: int, n: int) -> int:
    h = ((h ^ (turn * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & MASK
    return (h >> 20) % n


class PerfectHash:
    """A minimal perfect hash of the vocabulary: n tokens, n slots, one small number per bucket of tokens.

    Buckets of two tokens or more are placed first, largest first, each with the first turn that sends all of its tokens
    to free slots; a bucket of one token stores its slot itself as -slot - 1. A lookup is one hash, one bucket read,
    one slot read and one comparison with the token stored there, so an unknown string is never taken for a token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        tokens = list(ranks)
        self.n = len(tokens)
        self.buckets = max(1, self.n)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for token in tokens:
            h = xxhash.xxh3_64_intdigest(token)
            groups.setdefault(h % self.buckets, []).append((h, token))
        self.turn = [0] * self.buckets
        self.token: list[bytes | None] = [None] * self.n
        self.id = [0] * self.n
        ordered = sorted(groups.items(), key=lambda item: (-len(item[1]), item[0]))
        taken = bytearray(self.n)
        free = None
        for bucket, members in ordered:
            if len(members) == 1:
                if free is None:
                    free = iter([slot for slot in range(self.n) if not taken[slot]])
                spots = [next(free)]
                self.turn[bucket] = -spots[0] - 1
            else:
                turn = 1
                while True:
                    spots = [_slot(h, turn, self.n) for h, _ in members]
                    if len(set(spots)) == len(spots) and not any(taken[s] for s in spots):
                        break
                    turn += 1
                self.turn[bucket] = turn
            for spot, (_, token) in zip(spots, members, strict=True):
                taken[spot] = 1
                self.token[spot], self.id[spot] = token, ranks[token]

    def get(self, token: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(token)
        turn = self.turn[h % self.buckets]
        spot = -turn - 1 if turn < 0 else _slot(h, turn, self.n)
        return self.id[spot] if self.token[spot] == token else None


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token outside the vocabulary: the pair of lowest rank, leftmost first, merges until none is left.

    Parts are linked by their start bytes. A heap entry (rank, start, middle, end) is valid only while both of its parts
    still have those bounds. The work grows as n log n, so a pre-token of a million bytes is no special case.
    """
    n, rank_of, push, pop = len(piece), ranks.get, heapq.heappush, heapq.heappop
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it has been merged into another
    begin = list(range(-1, n))  # start of the part that ends at this byte
    heap = []
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, start, middle, stop = pop(heap)
        if end[start] != middle or end[middle] != stop:
            continue
        end[start], end[middle], begin[stop] = stop, 0, start
        if stop < n:
            after = end[stop]
            rank = rank_of(piece[start:after])
            if rank is not None:
                push(heap, (rank, start, stop, after))
        if start:
            left = begin[start]
            rank = rank_of(piece[left:stop])
            if rank is not None:
                push(heap, (rank, left, start, stop))
    out, at = [], 0
    while at < n:
        stop = end[at]
        out.append(ranks[piece[at:stop]])
        at = stop
    return out


class Codec:
    """Encodes text to ids and ids back to bytes. ``keep`` bounds the pre-tokens whose ids are remembered."""

    def __init__(self, path: str, pattern: str, keep: int = 300_000):
        ranks = read_ranks(path)
        self.lookup, self.ranks = PerfectHash(ranks).get, ranks
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{path} lacks {len(missing)} single bytes")
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.keep = keep
        self.known: dict[str, bytes] = {}

    def _ids(self, part: str) -> bytes:
        piece = part.encode()
        whole = self.lookup(piece)
        found = struct.pack(f"<{len(ids := [whole] if whole is not None else merged(piece, self.ranks))}I", *ids)
        if len(self.known) >= self.keep:
            self.known.clear()
        if len(part) <= 64:
            self.known[part] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, resolve = self.known.get, self._ids
        return b"".join([known(part) or resolve(part) for part in self.find(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process; the vocabulary is read from the tokenizer files installed there."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _mapped(docs: DataFrame, id: str, text: str, fields: str, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "value"):
            yield make(part)

    return docs.select(docs[id].alias("key"), docs[text].alias("value")).mapInArrow(
        run, f"{id} {dict(docs.dtypes)[id]}, {fields}")


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``ids`` (array of long). Null and empty texts have no ids.

    Rows are handled one by one: repeated rows and repeated or null ids give as many rows, other columns are not read.
    """
    def make(part):
        coder = codec(path, pattern)
        ids = [np.frombuffer(coder.encode(t), dtype="<u4").astype(np.int64) if t else [] for t in part["value"].to_pylist()]
        return pa.RecordBatch.from_arrays([part["key"], pa.array(ids, pa.list_(pa.int64()))], names=[id, "ids"])

    return _mapped(docs, id, text, "ids array<long>", make)


def decode(encoded: DataFrame, path: str, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row: ``id`` and ``decoded`` (binary). Null ids decode to no bytes; an unknown id is an error."""
    def run(batches):
        coder = codec(path, pattern)
        for part in batches:
            out = [coder.decode(np.array(v, dtype="<u4").tobytes()) if v else b"" for v in part["value"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["key"], pa.array(out, pa.binary())], names=[id, "decoded"])

    return encoded.select(encoded[id].alias("key"), encoded[ids].alias("value")).mapInArrow(
        run, f"{id} {dict(encoded.dtypes)[id]}, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: n_tokens, ids_sha256, decoded_sha256. Null text counts as empty."""
    def make(part):
        coder = codec(path, pattern)
        counts, first, second = [], [], []
        for value in part["value"].to_pylist():
            ids = coder.encode(value or "")
            counts.append(len(ids) // 4)
            first.append(hashlib.sha256(ids).hexdigest())
            second.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [part["key"], pa.array(counts, pa.int64()), pa.array(first), pa.array(second)],
            names=[id, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(docs, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
