"""Tokenizer libraries inside tasks: safe places to split a text, batches balanced by bytes."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from operator import attrgetter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

BATCH_BYTES = 1 << 20  # UTF-8 bytes handed to the library at once
KEEP, KEPT_CHARS = 400_000, 64  # stretches that are remembered, and how long they may be
MARK = "▁"  # a space inside the pieces of a sentencepiece model


@contextmanager
def remembered(known: dict, parts: list[list[str]], learn) -> Iterator:
    """A lookup of what ``learn`` finds for each distinct stretch of ``parts``.

    One copy of every stretch that is not in ``known`` is learnt. Beyond the block at most about KEEP short stretches are remembered.
    """
    if len(known) > KEEP:
        known.clear()
    fresh = list(set().union(*parts) - known.keys())
    known.update(learn(fresh))
    yield known.__getitem__
    for stretch in fresh:
        if len(stretch) > KEPT_CHARS:
            del known[stretch]


class Vocabulary:
    """One tokenizer file: ``.json`` through tokenizers, ``.model`` through sentencepiece.

    No tokens are added at the ends, nothing is truncated or padded. ``plain`` takes special strings inside texts as ordinary
    text; without it they are what the library makes of them.

    Safe places to split are single spaces between two letters, digits or other printing ASCII characters, where no normal form,
    pattern or merge of the three known kinds of tokenizers reaches across:

    * white space that is dropped and never stands inside a token: split there, without the space;
    * byte-level pre-tokens that take a space in front: split before the space;
    * sentencepiece with a space put before each text: split there without the space, if no piece of the vocabulary
      has a space after another character.

    A tokenizer of another kind gets whole texts.
    """

    BETWEEN = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
    BEFORE = re.compile(r"(?<=[\w!-~])(?= [\w!-~])")

    def __init__(self, path: str, plain: bool = False):
        self.step: int | None = None  # characters skipped at a safe place; None: there are none
        if path.endswith(".model"):
            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = None
            names = [self.model.id_to_piece(k) for k in range(len(self.model))]
            first = self.model.encode("x", out_type=str, num_threads=1)[:1]
            if first and first[0].startswith(MARK) and not any(MARK in n.lstrip(MARK) for n in names):
                self.step = 1
        else:
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = plain
            with open(path) as file:
                self.step = self._step(json.load(file))
        self.known: dict[str, int] = {}

    @staticmethod
    def _step(made: dict) -> int | None:
        spaced = any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in made["added_tokens"])
        before = made["pre_tokenizer"] or {}
        if spaced:
            return None
        if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and made["normalizer"] is None:
            return 0
        parts = before.get("pretokenizers", [before])
        split = parts[0]
        if split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] and r"[^\s" in split["pattern"].get("Regex", ""):
            if not any(p.get("add_prefix_space") or p.get("use_regex") for p in parts[1:]):
                return 1
        return None

    def _batches(self, texts: list[str]) -> Iterator[list[str]]:
        """Runs of texts of about BATCH_BYTES, at two bytes a character."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) * 2)
        bounds = np.flatnonzero(np.diff(ends // BATCH_BYTES, prepend=0)).tolist()
        for start, end in zip([0, *bounds], [*bounds, len(texts)], strict=True):
            if end > start:
                yield texts[start:end]

    def encoded(self, texts: list[str]) -> Iterator[list[int]]:
        """Token ids of each text."""
        for batch in self._batches(texts):
            if self.library is None:
                yield from self.model.encode(batch, num_threads=1)
            else:
                yield from map(attrgetter("ids"), self.library.encode_batch_fast(batch, add_special_tokens=False))

    def lengths(self, texts: list[str]) -> Iterator[int]:
        """Number of tokens of each text; the ids themselves stay in the library."""
        for batch in self._batches(texts):
            yield from map(len, self.model.encode(batch, num_threads=1) if self.library is None
                           else self.library.encode_batch_fast(batch, add_special_tokens=False))

    def stretches(self, text: str) -> list[str]:
        """What lies between the safe places; the tokens of a text are those of its stretches, one after the other."""
        return [text] if self.step is None else (self.BETWEEN if self.step else self.BEFORE).split(text)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text."""
        parts = list(map(self.stretches, texts))
        with remembered(self.known, parts, lambda fresh: zip(fresh, self.lengths(fresh), strict=True)) as count:
            return np.array([sum(map(count, p)) for p in parts], np.int64)

    def token_bytes(self) -> tuple[list[bytes], set[int]]:
        """The bytes of each id, and the ids that stand for one byte only where no piece does."""
        if self.library is None:
            out, single = [], set()
            for k in range(len(self.model)):
                name = self.model.id_to_piece(k)
                if self.model.is_byte(k):
                    out.append(bytes([int(name[3:5], 16)]))
                    single.add(k)
                else:
                    out.append(name.replace(MARK, " ").encode())
            return out, single
        # bytes that print stand for themselves, the others for the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*shown}))}
        added = {k: t.content for k, t in self.library.get_added_tokens_decoder().items()}
        names = self.library.get_vocab(with_added_tokens=True)
        out = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            out[k] = name.encode() if k in added else bytes(letters[c] for c in name)
        return out, set()


@functools.cache
def vocabulary(path: str, plain: bool = False) -> Vocabulary:
    """Once per worker process, from the tokenizer files installed there; a task keeps to its own core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabulary(path, plain)
