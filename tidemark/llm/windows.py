"""Rolling hashes of byte windows, and runs of windows that share their least gram."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of each."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[k] = np.multiply.accumulate(step)
    return _POWERS[0][:n], _POWERS[1][:n + 1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Prefix sums of ``data`` (uint8); the hash of any stretch is a difference of two, shifted to a common power."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from each position on."""
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by running minima from both ends of blocks of that width."""
    n = len(values)
    full = -(-n // width) * width
    block = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    block[:n] = values
    block = block.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """Runs of neighbouring ``length``-byte windows with the same least gram, inside texts ``bounds[i]:bounds[i + 1]``.

    Returns (key, text, start, end, content, again): the least gram's hash, the text's number, the bytes start:end (of
    ``data``) that the run's windows cover, their hash, and whether that gram is least at more than one place of the run. Equal
    windows have equal keys wherever they stand, with the gram at the same place, so a window can repeat only in another run
    of its key or in a run with ``again``. A text of n bytes has about 2 n / (length - gram) runs.
    """
    sizes = np.diff(bounds)
    none = np.zeros(0, np.int64)
    if not (sizes >= length).any():
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64), none.astype(bool)
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    # the low bits hold the place, so the least value is the leftmost of equal grams
    mask = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    place = least((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & mask
    edge = np.zeros(len(data) + 1, np.int32)
    fits = np.flatnonzero(sizes >= length)
    edge[bounds[:-1][fits]] += 1
    edge[bounds[1:][fits] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(edge[:-1]))
    place = place[at]
    moved = np.ones(len(at), bool)
    moved[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(moved)  # windows with one least place
    key, head = grams[place[begin]], at[begin]
    text = np.searchsorted(bounds, head, side="right") - 1
    first = np.ones(len(begin), bool)
    first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(first)
    last = np.append(begin[run[1:]], len(at)) - 1
    start, end = head[run], at[last] + length
    return key[run], text[run], start, end, hashes.of(start, end), np.diff(np.append(run, len(begin))) > 1
