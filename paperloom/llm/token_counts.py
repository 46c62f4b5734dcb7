"""Token counts by byte-pair merging, without making token identifiers.

A word starts as one symbol per byte. Its adjacent pairs that the vocabulary can
merge stand in a heap by rank and position; the lowest is popped and merged in a
doubly linked list until none is left. The count is the number of symbols at
first less the number of merges.

Edge cases: a null or empty text, or one of white space alone, has 0 tokens; a
word of any length is merged whole, in n log n steps. The vocabulary's special
strings count one token each wherever they stand in a text, as its library does.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct words that a Python worker remembers; beyond that it forgets all and
#: counts them anew, so this bounds memory and never changes a count.
CACHE_WORDS = 400_000

#: str.split() also splits at U+001C to U+001F, which are no white space in Unicode.
_CONTROL = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Merger:
    """Counts the tokens of whole texts under one word-BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.width = len(vocab)
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, (a, b) in enumerate(model["merges"]):
            self.rank[vocab[a] * self.width + vocab[b]] = r
            self.merged.append(vocab[a + b])
        symbols = _byte_symbols()
        self.inner = [vocab[symbols[b]] for b in range(256)]
        self.last = [vocab[symbols[b] + end] for b in range(256)]
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.pieces = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")).findall
        self.words: dict[str, int] = {}
        self.runs = _Runs(self)

    def merge(self, word: str) -> int:
        """Symbols that are left of one word."""
        raw = word.encode("utf-8", "surrogatepass")
        n, rank, width = len(raw), self.rank, self.width
        if n == 1:
            return 1
        ids = [*map(self.inner.__getitem__, raw)]
        ids[-1] = self.last[raw[-1]]
        heap = []
        for i in range(n - 1):
            r = rank.get(ids[i] * width + ids[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        heapq.heapify(heap)
        after, before, left, pop, push = list(range(1, n + 1)), list(range(-1, n - 1)), n, heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            r, i = top >> 40, top & 0xFFFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get(ids[i] * width + ids[j]) != r:
                continue  # one of the two was merged away meanwhile
            ids[i], ids[j] = self.merged[r], -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(ids[i] * width + ids[k])
                if r is not None:
                    push(heap, r << 40 | i)
            h = before[i]
            if h >= 0:
                r = rank.get(ids[h] * width + ids[i])
                if r is not None:
                    push(heap, r << 40 | h)
        return left

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if "<" in text and self.special.search(text):
            return sum(map(self._plain, self.special.split(text))) + len(self.special.findall(text))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if not text.isascii():
            # per character, so a capital sigma at a word's end gets no final form
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        runs = filter(None, _WHITE.split(text)) if _CONTROL.search(text) else text.split()
        n = sum(map(self.runs.__getitem__, runs))
        if len(self.runs) > CACHE_WORDS:
            self.runs.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        return n


class _Runs(dict):
    """Tokens of each run between white space, found when first asked for."""

    def __init__(self, merger: Merger):
        self.merger = merger

    def __missing__(self, run: str) -> int:
        words, n = self.merger.words, 0
        for piece in self.merger.pieces(run):
            c = words.get(piece)
            if c is None:
                c = self.merger.merge(piece)
                if len(piece) <= 64:
                    words[piece] = c
            n += c
        if len(run) <= 64:
            self[run] = n
        return n


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_count(text: Column, vocabulary: str) -> Column:
    """Tokens of each text; ``vocabulary`` is the path of its file on every machine."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(merger(vocabulary).count).astype("int64")

    return count(F.coalesce(text, F.lit("")))


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``; no row is dropped and nothing is shuffled."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(text, vocabulary).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
