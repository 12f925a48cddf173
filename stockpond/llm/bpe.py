"""Byte-level BPE by prefix sharing: a trie of distinct words, one last token per prefix.

The encoding of a prefix is the encoding of a shorter prefix plus one last token. So the last
token alone is kept for each prefix, and a prefix that many words share is worked out once.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from stockpond.llm.native import free_name

NEVER = 1 << 30

# How the public vocabulary splits text into words before it merges bytes.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# Bounds of what a Python worker keeps: encoded words, pairs of tokens, characters in work.
KEPT_WORDS = 600_000
KEPT_PAIRS = 500_000
CHARS_AT_ONCE = 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones stand for themselves."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixEncoder:
    """Encodes words depth first along their trie; all state is bounded by the limits above."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        self.token_bytes = {i: bytes(letters[c] for c in name) for name, i in names.items()}
        self.ids = {b: i for i, b in self.token_bytes.items()}
        self.longest = max(map(len, self.ids))
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for order, (left, right) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in spec["model"]["merges"]):
            a, b, whole = names[left], names[right], names[left + right]
            self.rank[a << 17 | b] = order
            self.parts[whole] = (a, b, order)
        self.token_bytes |= {i: text.encode() for text, i in self.special.items()}
        self.word = regex.compile(WORD_PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.fits: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one end of a token, from its byte upwards, each with the merge that takes it in."""
        key = (token, side)
        if key not in self.edges:
            pieces, taken = [], NEVER
            while True:
                pieces.append((token, taken))
                if token not in self.parts:
                    break
                taken, token = self.parts[token][2], self.parts[token][side]
            self.edges[key] = pieces[::-1]
        return self.edges[key]

    def _fit(self, first: int, second: int) -> bool:
        """Whether the two tokens stay two: no merge across their border comes due before its sides grow on."""
        left, right, i, j = self._edge(first, 1), self._edge(second, 0), 0, 0
        while True:
            (a, a_taken), (b, b_taken) = left[i], right[j]
            due = self.rank.get(a << 17 | b, NEVER)
            if due < a_taken and due <= b_taken:
                return False
            if a_taken == b_taken == NEVER:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                j += 1

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of each word.

        Sorted words are their trie in depth-first order: ``last`` is the path from the root,
        and only the prefixes below the fork from the word before are new.
        """
        out: dict[str, bytes] = {}
        known, fits, longest = self.ids.get, self.fits, self.longest
        last, size = [0], [0]
        before = b""
        for data, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            fork = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                fork += 1
            del last[fork + 1 :], size[fork + 1 :]
            for end in range(fork + 1, len(data) + 1):
                # Just one token fits, so the order is free: first the last token with one byte more.
                grown = size[-1] + 1
                for length in (grown, *range(1, grown), *range(grown + 1, min(end, longest) + 1)):
                    token = known(data[end - length : end])
                    if token is None:
                        continue
                    if length == end:
                        break
                    pair = last[end - length] << 17 | token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = fits[pair] = self._fit(last[end - length], token)
                    if fit:
                        break
                last.append(token)
                size.append(length)
            chain, end = [], len(data)
            while end:
                chain.append(last[end])
                end -= size[end]
            out[word] = struct.pack(f"<{len(chain)}I", *chain[::-1])
            before = data
            if len(fits) > KEPT_PAIRS:
                fits.clear()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self.split.split(t) if self.split else [t] for t in texts]
        cut = [[[p] if p in self.special else self.word.findall(p) for p in pieces] for pieces in parts]
        new = {w for pieces in cut for words in pieces for w in words}
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        new.difference_update(self.words)
        new.difference_update(self.special)
        self.words |= self.encode_words(new)
        self.words |= {text: np.array([i], "<u4").tobytes() for text, i in self.special.items()}
        words = self.words
        return [b"".join([words[w] for piece in pieces for w in piece]) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def slices(texts: list[str], most: int = CHARS_AT_ONCE) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    run, chars = [], 0
    for text in texts:
        if run and chars + len(text) > most:
            yield run
            run, chars = [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield run


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with two more columns: token ids as little-endian 32-bit integers (binary), and
    the text decoded from those ids.

    Row by row, without a shuffle, so repeated rows and clashing ids are no matter. A null text
    counts as an empty one: no ids, empty text. A column already called ``ids`` or ``decoded``
    is replaced. Special tokens written out in a text are encoded as such and decoded again.
    ``path``: vocabulary file, at the same place on every executor.
    """

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = PrefixEncoder(path)
        for batch in batches:
            packed: list[bytes] = []
            for run in slices(batch.tolist()):
                packed += encoder.encode(run)
            yield pd.DataFrame({"ids": packed, "decoded": [encoder.decode(p) for p in packed]})

    pair = free_name(docs, "_bpe")
    made = docs.withColumn(pair, both(F.coalesce(F.col(text), F.lit(""))))
    return made.withColumns({ids: F.col(f"{pair}.ids"), decoded: F.col(f"{pair}.decoded")}).drop(pair)
