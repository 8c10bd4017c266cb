"""Suffix arrays by induced sorting, and permuted common prefixes.

Strings over few symbols are sorted with array operations, one bucket and wave at a time; the reduced strings of the recursion
have large alphabets and small buckets, and are induced by plain loops.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last symbol is the unique smallest."""
    n = len(text)
    at = np.where(text[:-1] != text[1:], np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = text[at] < text[at + 1]
    return small


def _grouped(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order by symbol, the sorted symbols, count per symbol)."""
    order = np.argsort(symbols, kind="stable")
    return order, symbols[order], np.bincount(symbols, minlength=size)


def _induce(text: np.ndarray, small: np.ndarray, marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array induced from the leftmost-smaller positions ``marks``, given in order within each bucket."""
    n, size = len(text), len(starts)
    sa = np.full(n, -1, np.int64)
    order, symbols, marked = _grouped(text[marks], size)
    place = np.arange(len(marks)) - (np.cumsum(marked) - marked)[symbols]
    sa[(ends - marked)[symbols] + place] = marks[order]
    head, used = starts.copy(), np.flatnonzero(ends > starts)

    def put(at: np.ndarray, larger: bool) -> None:
        at = at[at > 0] - 1
        at = at[small[at] != larger]
        if not len(at):
            return
        if len(at) == 1:
            c = text[at[0]]
            if larger:
                sa[head[c]] = at[0]
                head[c] += 1
            else:
                tail[c] -= 1
                sa[tail[c]] = at[0]
            return
        order, symbols, count = _grouped(text[at], size)
        rank = np.arange(len(at)) - (np.cumsum(count) - count)[symbols]
        if larger:
            sa[head[symbols] + rank] = at[order]
            head[:] += count
        else:
            tail[:] -= count
            sa[tail[symbols] + count[symbols] - 1 - rank] = at[order]

    for c in used:
        low = starts[c]
        while low < head[c]:
            low, at = head[c], sa[low:head[c]].copy()
            put(at, True)
        if marked[c]:
            put(sa[ends[c] - marked[c]:ends[c]].copy(), True)
    tail = ends.copy()
    for c in used[::-1]:
        high = ends[c]
        while tail[c] < high:
            high, at = tail[c], sa[tail[c]:high][::-1].copy()
            put(at, False)
        if head[c] > starts[c]:
            put(sa[starts[c]:head[c]][::-1].copy(), False)
    return sa


def _named(text: np.ndarray, marks: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """(name of each mark in text order, number of names): equal substrings between marks share a name."""
    n = len(text)
    stop = np.zeros(n + 1, np.int64)
    stop[marks[:-1]] = marks[1:]
    stop[marks[-1]] = n - 1
    length = stop[ordered] - ordered + 1
    new = np.ones(len(ordered), bool)
    left = np.flatnonzero(length[1:] == length[:-1])
    a, b, k = ordered[left], ordered[left + 1], 0
    width = length[left]
    while len(left):
        same = text[a + k] == text[b + k]
        done = same & (width == k + 1)
        new[left[done] + 1] = False
        go = same & ~done
        left, a, b, width, k = left[go], a[go], b[go], width[go], k + 1
    name = np.empty(n, np.int64)
    name[ordered] = np.cumsum(new) - 1
    return name[marks], int(new.sum())


def _induce_plain(text: np.ndarray, small: np.ndarray, marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``_induce``, with loops, for alphabets about as large as the string."""
    n, size = len(text), len(starts)
    placed = np.full(n, -1, np.int64)
    order, symbols, marked = _grouped(text[marks], size)
    placed[(ends - marked)[symbols] + np.arange(len(marks)) - (np.cumsum(marked) - marked)[symbols]] = marks[order]
    sa = placed.tolist()
    # symbol left of each position if that one is larger (smaller); -1 also for the first and for an empty place
    larger, smaller = np.full((2, n + 1), -1, np.int64)
    left = text[:-1].astype(np.int64)
    larger[1:n] = np.where(small[:-1], -1, left)
    smaller[1:n] = np.where(small[:-1], left, -1)
    left, head = larger.tolist(), starts.tolist()
    for i in sa:
        c = left[i]
        if c >= 0:
            at = head[c]
            sa[at] = i - 1
            head[c] = at + 1
    left, tail = smaller.tolist(), ends.tolist()
    for i in reversed(sa):
        c = left[i]
        if c >= 0:
            tail[c] = at = tail[c] - 1
            sa[at] = i - 1
    return np.array(sa)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``, small non-negative integers whose last one is the unique smallest."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable")
    size = int(text.max()) + 1
    small = _types(text)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.cumsum(np.bincount(text, minlength=size))
    starts = np.concatenate([[0], ends[:-1]])
    induce = _induce if size * 64 < n else _induce_plain
    is_mark = np.zeros(n, bool)
    is_mark[marks] = True
    sa = induce(text, small, marks, starts, ends)
    ordered = sa[is_mark[sa]]
    names, count = _named(text, marks, ordered)
    if count < len(marks):
        ordered = marks[suffix_array(names)]
    return induce(text, small, ordered, starts, ends)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, shared) by text position: the suffix just smaller, -1 for the smallest, and the symbols shared with it.

    Where the symbols left of both are equal, the value is one less than at the position before; only the other
    positions are compared, eight symbols at a time. ``text`` has to be bytes.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    fixed = np.ones(n, bool)
    both = np.flatnonzero(before > 0)
    both = both[both > 0]
    fixed[both] = text[both - 1] != text[before[both] - 1]
    shared = np.zeros(n, np.int64)
    at = np.flatnonzero(fixed & (before >= 0))
    # past the end the two sides differ at the unique last symbol at the latest
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), 0, (1,))
    a, b, k = at, before[at], 0
    while len(at):
        x = words[np.minimum(a + k, n)] ^ words[np.minimum(b + k, n)]
        ended = x != 0
        low = x[ended] & (~x[ended] + np.uint64(1))
        shared[at[ended]] = k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        go = ~ended
        at, a, b, k = at[go], a[go], b[go], k + 8
    anchor = np.maximum.accumulate(np.where(fixed, np.arange(n), 0))
    return before, np.maximum(shared[anchor] - (np.arange(n) - anchor), 0)


def _by_strings(contents: list[bytes], often: np.ndarray, length: int) -> np.ndarray:
    """Mask over the joined contents (one place between two) of string starts that repeat; for bytes that no text has."""
    count: dict[bytes, int] = {}
    for content, times in zip(contents, often.tolist(), strict=True):
        for i in range(len(content) - length + 1):
            key = content[i:i + length]
            count[key] = count.get(key, 0) + times
    hits = [[i + length <= len(c) and count[c[i:i + length]] > 1 for i in range(len(c) + 1)] for c in contents]
    return np.array([h for row in hits for h in row], bool)


def repeated(contents: list[bytes], often: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """Per content the stretches covered by ``length``-byte strings that start twice in all contents together.

    ``often`` says how many times each content occurs; one that occurs twice is covered whole. Stretches that touch are one.
    """
    sizes = np.array([len(c) for c in contents], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined = np.frombuffer(b"\xfd".join(contents) + b"\xfd\xfe", np.uint8)
    if np.bincount(joined, minlength=256)[0xfd:].sum() == len(contents) + 1:
        data = joined + np.uint8(3)  # the places between become 0, moved up by one for the last symbol
        data[joined == 0xfe] = 0
        data[joined == 0xfd] = 1
        before, shared = common_prefixes(data, suffix_array(data))
        long = np.flatnonzero(shared >= length)
        hit = np.zeros(len(data), bool)
        hit[long] = True
        hit[before[long]] = True
    else:  # not UTF-8
        hit = _by_strings(contents, often, length)
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    at = np.flatnonzero(hit[:len(owner)])
    at = at[at + length <= (start + sizes)[owner[at]]]
    out: list[list[tuple[int, int]]] = [[] for _ in contents]
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] > at[:-1] + length) | (owner[at[1:]] != owner[at[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        for a, b in zip(at[first].tolist(), at[last].tolist(), strict=True):
            o = int(owner[a])
            out[o].append((a - int(start[o]), b - int(start[o]) + length))
    for o in np.flatnonzero(often >= 2).tolist():
        if sizes[o] >= length:
            out[o] = [(0, int(sizes[o]))]
    return out
