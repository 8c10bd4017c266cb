"""License notices in texts: MinHash bands over windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices
from .windows import Hashes, mixed

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
)
_ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes "
                "software developed by the organization.")
_CONDITIONS = {"SA": ("ShareAlike", "Share-Alike"), "NC": ("NonCommercial", "Non-Commercial"), "ND": ("NoDerivatives", "No-Derivatives")}
# the names of each CC license as they are written
_CC = {f"CC-{short}-4.0": [f"CC {short} 4.0", *("-".join(("Attribution", *way)) + " 4.0" for way in product(*(_CONDITIONS[c] for c in short.split("-")[1:])))]
       for short in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")}


# fixed values: notices as their licenses word them
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
                   "OF ANY KIND, either express or implied."),
    *((name, f"This work is licensed under the GNU {kind}General Public License, version {version}.") for name, kind, version in (
        ("GPL-3.0", "", "3"), ("GPL-2.0", "", "2"), ("LGPL-3.0", "Lesser ", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-2.0", "Library ", "2"),
        ("AGPL-3.0", "Affero ", "3"))),
    *((name, f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as "
             f"published by the Free Software Foundation{mark.replace(':', ',')} either version {version} of the License, or (at your option) any later "
             "version.") for name, work, mark, kind, version in (
        ("GPL-3.0", "program", ":", "", "3"), ("GPL-2.0", "program", ";", "", "2"), ("LGPL-3.0", "library", ":", "Lesser ", "3"),
        ("LGPL-2.1", "library", ";", "Lesser ", "2.1"), ("LGPL-2.0", "library", ";", "Library ", "2"), ("AGPL-3.0", "program", ":", "Affero ", "3"))),
    ("BSD-1-Clause", _BSD[0]),
    ("BSD-2-Clause", f"{_BSD[0]} {_BSD[1]}"),
    ("BSD-3-Clause", f"{_BSD[0]} {_BSD[1]} {_BSD[2]}"),
    ("BSD-4-Clause", f"{_BSD[0]} {_BSD[1]} {_ADVERTISING} {_BSD[2]}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *((name, f"Licensed under {written[0]}.") for name, written in _CC.items()),
    *((name, f"This work is licensed under a Creative Commons {long} International License.") for name, written in _CC.items() for long in written[1:]),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _version(number: str) -> tuple[str, ...]:
    return tuple(f"{word}{number}" for word in ("version ", "v", "v ", "license "))


# what a stretch must say besides, by license: one phrase of each group, as its words are read
NEEDS = {
    "Apache-2.0": (("apache license",), _version("2")),
    "GPL-3.0": (("gnu general public",), _version("3")),
    "GPL-2.0": (("gnu general public",), _version("2")),
    "LGPL-3.0": (("gnu lesser general",), _version("3")),
    "LGPL-2.1": (("gnu lesser general",), _version("2 1")),
    "LGPL-2.0": (("gnu library general", "gnu lesser general"), _version("2")),
    "AGPL-3.0": (("gnu affero general",), _version("3")),
    "BSD-2-Clause": (("redistributions in binary form",),),
    "BSD-3-Clause": (("endorse or promote",),),
    "BSD-4-Clause": (("endorse or promote",), ("advertising materials",)),
    "ISC": (("permission notice appear in all",),),
    "MPL-2.0": (("mozilla public license",), ("2 0",)),
    **{name: (tuple(written),) for name, written in _CC.items()},
}
WORDS = 3  # words of a shingle: the shortest notices have five
CONTAINED = 0.8
BEYOND = 3  # words after the last shingle that may still name the version
WINDOWS = (8, 16, 32, 64, 128)  # words; a window moves on by a quarter
BANDS, ROWS = 40, 1
# A piece of more than 3/8 and at most 3/4 of a window's words lies whole in some window and shares at least a quarter of their joint shingles
# even where a fifth of its own are changed, so it is retrieved with probability 1 - (1 - 0.25**ROWS)**BANDS > 0.9999.
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_TURNS = np.random.default_rng(11).integers(1, 2**63, size=max(WORDS, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def collision(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Probability that two sets of a Jaccard similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hash at each word, hash, start and end of each word, first word of each text and the end) of the joined texts.

    Words are runs of letters, digits and bytes above 127, A-Z lower-cased; shingles that leave a text have hash 0.
    """
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = LETTER[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    first = np.searchsorted(start, bounds)
    word = Hashes(data).of(start, end) if len(start) else np.zeros(0, np.uint64)
    total = np.zeros(len(word), np.uint64)
    for k in range(WORDS):
        total[:len(word) - k] += word[k:] * _TURNS[k]
    total = mixed(total)
    for k in range(1, WORDS):
        total[(first[1:] - k)[first[1:] - k >= first[:-1]]] = 0
    return total, word, start, end, first


def minhash(grams: np.ndarray) -> list[int]:
    """One value per band: the mixed minima of its rows."""
    rows = np.minimum.reduce(mixed(grams[None, :] ^ _TURNS[:BANDS * ROWS, None]), axis=1)
    return np.bitwise_xor.reduce(mixed(rows.reshape(BANDS, ROWS) + np.arange(ROWS, dtype=np.uint64)), axis=1).tolist()


class Index:
    """Bands of the templates' pieces by window size, every template's shingles, and the phrases its license needs."""

    def __init__(self, templates=TEMPLATES):
        self.templates = templates
        self.needs = {name: [[words_of([phrase.encode()])[1] for phrase in group] for group in groups] for name, groups in NEEDS.items()}
        self.sets: list[np.ndarray] = []
        self.bands: dict[tuple[int, int, int], set[int]] = {}
        self.sizes: list[int] = []
        self.places: list[dict[int, list[int]]] = []
        for number, (_, text) in enumerate(templates):
            grams, _, start, _, _ = words_of([text.encode()])
            size = len(start)
            if size < WORDS:
                raise ValueError(f"a template needs {WORDS} words: {text}")
            grams = grams[:size - WORDS + 1]
            self.sets.append(np.unique(grams))
            self.sizes.append(size)
            self.places.append({})
            for at, gram in enumerate(grams.tolist()):
                self.places[-1].setdefault(gram, []).append(at)
            longest = WINDOWS[-1] * 3 // 4
            for at in range(0, max(1, size - longest // 2), longest // 2):
                piece = min(size - at, longest)
                window = next(w for w in WINDOWS if piece <= w * 3 // 4)
                for band, value in enumerate(minhash(grams[at:at + piece - WORDS + 1])):
                    self.bands.setdefault((window, band, value), set()).add(number)
        self.all = np.unique(np.concatenate(self.sets))
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.all & np.uint64(0xFFFF)).astype(np.int64)] = True

    def known(self, grams: np.ndarray) -> np.ndarray:
        """Places of shingles that some template has."""
        near = np.flatnonzero(self.low[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.all, grams[near]), len(self.all) - 1)
        return near[self.all[at] == grams[near]]

    def retrieved(self, grams: np.ndarray, hits: np.ndarray) -> set[int]:
        """Templates that share a band with a window of the text. Windows without a known shingle have none to share."""
        found: set[int] = set()
        for window in WINDOWS:
            step = window // 4
            starts = np.unique(np.concatenate([hits // step - k for k in range((window - WORDS) // step + 1)])) * step
            for start in starts[starts >= 0].tolist():
                part = grams[start:start + window - WORDS + 1]
                part = part[part != 0]
                if len(part):
                    for band, value in enumerate(minhash(part)):
                        found |= self.bands.get((window, band, value), set())
        return found

    def holds(self, grams: np.ndarray, words: np.ndarray, number: int, part: np.ndarray) -> bool:
        """Whether the shingles at the places ``part`` are ``CONTAINED`` of the template's, and the stretch says what its license needs."""
        if not len(part) or len(np.unique(grams[part])) < CONTAINED * len(self.sets[number]) - 1e-9:
            return False
        near = words[part[0]:part[-1] + WORDS + BEYOND]
        return all(any(_says(near, phrase) for phrase in group) for group in self.needs.get(self.templates[number][0], ()))

    def verified(self, grams: np.ndarray, words: np.ndarray, number: int) -> list[np.ndarray]:
        """Places of the template's shingles in each stretch that ``holds``. Hits further apart than half of the template, or
        ten words, are different stretches, and so are those before and after the template starts over."""
        own = self.sets[number]
        at = np.minimum(np.searchsorted(own, grams), len(own) - 1)
        hits = np.flatnonzero(own[at] == grams)
        out = []
        for part in np.split(hits, np.flatnonzero(np.diff(hits) > max(10, self.sizes[number] // 2)) + 1):
            if len(part):
                out += self.copies(grams, words, number, part)
        return out

    def copies(self, grams: np.ndarray, words: np.ndarray, number: int, part: np.ndarray) -> list[np.ndarray]:
        """The most copies of the template that follow each other in ``part``. It is cut where the place in the template falls back by as
        much as it does between two copies that miss the most they may; pieces that hold too little alone, as a foreign shingle inside
        a copy can cause, are put together again, and what is left of a copy goes to the one before it."""
        places, longest = self.places[number], self.sizes[number] - WORDS + 1
        least = max(1, longest - 1 - 2 * (longest - int(np.ceil(CONTAINED * len(self.sets[number]) - 1e-9))))
        cuts, last, before, found = [], 0, 0, {}
        for k, (at, gram) in enumerate(zip(part.tolist(), grams[part].tolist(), strict=True)):
            place = min(places[gram], key=lambda p: abs(p - last - at + before)) if k else places[gram][0]
            if last - place >= least:
                cuts.append(k)
            last, before = place, at
            found[at] = place
        enough = CONTAINED * len(self.sets[number]) - 1e-9
        pieces = np.split(part, cuts)
        out: list[np.ndarray] = []
        held: Counter[int] = Counter()
        first = end = 0

        def copy_in(pieces: list[np.ndarray]) -> np.ndarray | None:
            run = np.concatenate(pieces)
            if len(np.unique(grams[run])) < enough:
                return None
            chain = _chain(run, np.array([found[at] for at in run.tolist()]))
            if self.holds(grams, words, number, chain):
                return chain
            # parts of one copy in another order
            return run if run[-1] - run[0] <= 1.5 * longest and self.holds(grams, words, number, run) else None

        for k, piece in enumerate(pieces):
            held.update(grams[piece].tolist())
            if len(held) < enough:
                continue
            if copy_in(pieces[first:k + 1]) is not None:
                start = k
                while (copy := copy_in(pieces[start:k + 1])) is None:
                    start -= 1
                self._leave(grams, out, pieces[end:start])
                out.append(copy)
                first = end = k + 1
                held.clear()
            else:  # enough shingles of another license's notice: go on from the fewest pieces that have as many
                while len(less := held - Counter(grams[pieces[first]].tolist())) >= enough:
                    held, first = less, first + 1
        self._leave(grams, out, pieces[end:])
        return out

    @staticmethod
    def _leave(grams: np.ndarray, out: list[np.ndarray], pieces: list[np.ndarray]) -> None:
        """Give the pieces after a copy to it as long as most of their shingles are none that it has."""
        for piece in pieces:
            if not out or np.isin(grams[piece], grams[out[-1]]).mean() > 0.5:
                return
            out[-1] = np.concatenate([out[-1], piece])

    def matches(self, grams: np.ndarray, words: np.ndarray, numbers) -> list[tuple[int, int, int]]:
        """(first word, end, template). Where stretches of several templates use the same shingles of the text, the one that explains the most
        comes first; another stays only if the places left to it hold its template as well."""
        found = [(number, part) for number in sorted(numbers) for part in self.verified(grams, words, number)]
        # a place inside that the template does not explain counts a tenth
        found.sort(key=lambda f: (int(f[1][-1] - f[1][0]) - 11 * len(f[1]), len(self.sets[f[0]]), f[0], f[1][0]))
        free, out = np.ones(len(grams), bool), []
        for number, part in found:
            part = part[free[part]]
            if self.holds(grams, words, number, part):
                free[part] = False
                out.append((int(part[0]), int(part[-1]) + WORDS, number))
        return out


def _chain(at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The most of the places ``at`` whose places in the template rise, as close together as in the template where there is a choice. The next
    place is sought among 1,024 shingles of the template."""
    score, before = np.ones(len(at)), np.full(len(at), -1)
    for k in range(1, len(at)):
        low = max(0, k - 1024)
        earlier = low + np.flatnonzero(place[low:k] < place[k])
        if len(earlier):
            off = np.abs((at[k] - at[earlier]) - (place[k] - place[earlier]))
            value = score[earlier] - off / (1.0 + 2 * (at[-1] - at[0] + place.max())) / len(at)
            best = int(value.argmax())
            score[k], before[k] = 1 + value[best], earlier[best]
    k, out = int(score.argmax()), []
    while k >= 0:
        out.append(k)
        k = int(before[k])
    return at[out[::-1]]


def _says(words: np.ndarray, phrase: np.ndarray) -> bool:
    n = len(words) - len(phrase) + 1
    return n > 0 and bool(np.all([words[k:k + n] == p for k, p in enumerate(phrase)], axis=0).any())


def found_in(texts: list[bytes], index: Index, retrieve: bool = True) -> list[list[tuple[int, int, str]]]:
    """Per text the matches (start, end, license) in characters, sorted; of templates that say the same, the best.

    ``retrieve`` False compares every template with every text, which tests use.
    """
    grams, words, start, end, first = words_of(texts)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    hits = index.known(grams)
    owner = np.searchsorted(first, hits, side="right") - 1
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for t in np.unique(owner).tolist():
        a, b = int(first[t]), int(first[t + 1])
        own = grams[a:b]
        numbers = index.retrieved(own, hits[owner == t] - a) if retrieve else range(len(index.sets))
        spans = set()
        for x, y, number in index.matches(own, words[a:b], numbers):
            i, j = int(start[a + x] - bounds[t]), int(end[a + y - 1] - bounds[t])
            spans.add((len(texts[t][:i].decode("utf-8", "replace")), len(texts[t][:j].decode("utf-8", "replace")), index.templates[number][0]))
        out[t] = sorted(spans)
    return out


MATCHES = "array<struct<start:long,end:long,license:string>>"
_INDEX: list[Index] = []


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``matches``, the notices found, sorted by start; empty where there are none.

    Whole texts are read. Null and empty texts have no matches; rows are handled one by one, other columns are not read.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _INDEX:
            _INDEX.append(Index())
        for part in slices(batches, "value", 2 << 20):
            found = found_in([t or b"" for t in part["value"].to_pylist()], _INDEX[0])
            rows = [[{"start": a, "end": b, "license": name} for a, b, name in row] for row in found]
            yield pa.RecordBatch.from_arrays([part["key"], pa.array(rows, kind)], names=[id, "matches"])

    return docs.select(docs[id].alias("key"), docs[text].cast("binary").alias("value")).mapInArrow(
        run, f"{id} {dict(docs.dtypes)[id]}, matches {MATCHES}")
