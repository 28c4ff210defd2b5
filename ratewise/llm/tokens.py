"""Token counts: byte-pair merging with a heap and a linked list.

A pre-token's bytes are the initial symbols of a doubly linked list; a heap
holds the adjacent pairs that the vocabulary can merge, by rank and place.  The
lowest pair is popped again and again, merged, and its two new neighbour pairs
are pushed; entries that a merge has made stale are skipped.  The count is the
initial symbols minus the merges; no identifiers are made.

The merge table and the special strings are read from a byte-level BPE ``.json``
file, whose path is a parameter (each executor opens its own copy).  The counts
equal those of the tokenizers library without added special tokens; a special
string inside a text counts as one token, as that library does by default.  Texts
with code points that Python's Unicode tables do not know are cut into pre-tokens by
that library, whose tables are newer; they are counted like the others.

Counts of pre-tokens are remembered per Python worker in a table of bounded
size.  Cases: null or empty text has 0 bytes and 0 tokens; a text of one huge
word takes n log n steps; repeated ids stay separate rows; an empty table gives
no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from heapq import heapify, heappop, heappush
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain, read, small_batches

#: Remembered pre-tokens per Python worker, and the longest one remembered.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 40


@functools.cache
def _classes() -> tuple[str, str, str]:
    """Character classes of letters, numbers and white space for ``re``, whose
    own classes differ from the Unicode properties that the vocabulary uses."""
    def ranges(test: Callable[[int], bool]) -> str:
        out, start = [], None
        for c in range(sys.maxunicode + 2):
            hit = c <= sys.maxunicode and test(c)
            if hit and start is None:
                start = c
            elif not hit and start is not None:
                out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
        return "".join(out)

    kind = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    # The code points with the Unicode White_Space property.
    white = ("\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000")
    return ranges(lambda c: kind[c] == "L"), ranges(lambda c: kind[c] == "N"), white


def _pattern(letter: str, number: str, white: str) -> re.Pattern:
    """The pre-token pattern of byte-level BPE vocabularies of this family."""
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+"
                      rf"| ?[^{white}{letter}{number}]+|[{white}]+(?![^{white}])|[{white}]+")


_ASCII = _pattern("A-Za-z", "0-9", "\\t-\\r ")
# ``re``'s own classes, quick, and right for texts without the characters of _odd().
_USUAL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@functools.cache
def _odd() -> re.Pattern:
    """Numbers that ``re`` counts as letters, separators it counts as space, code points
    unassigned here, and (for a quick test) everything beyond the basic plane."""
    odd = "".join(chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) in ("No", "Nl", "Cn"))
    return re.compile(f"[\x1c-\x1f{odd}\U00010000-\U0010ffff]")


@functools.cache
def _exact() -> re.Pattern:
    return _pattern(*_classes())


@functools.cache
def _unassigned() -> re.Pattern:
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        hit = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if hit and start is None:
            start = c
        elif not hit and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(out) + "]")


def _library_split(text: str) -> list[str]:
    """The pre-tokens by the tokenizers library, whose Unicode tables are newer."""
    from tokenizers.pre_tokenizers import ByteLevel
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in split]


def pre_tokens(text: str) -> list[str]:
    if text.isascii():
        return _ASCII.findall(text)
    if not _odd().search(text):
        return _USUAL.findall(text)
    return _library_split(text) if _unassigned().search(text) else _exact().findall(text)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: itself
    if it is printable Latin-1, else the next free code point from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def load_merges(path: str) -> tuple[dict[int, int], list[int], list[int], list[str]]:
    """``({left << 24 | right: rank}, merged symbol of each rank, symbol of each
    byte, special strings)`` of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    of_byte = [0] * 256
    for ch, b in _byte_of_char().items():
        of_byte[b] = vocab[ch]
    ranks, merged = {}, []
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks.setdefault(vocab[left] << 24 | vocab[right], rank)
        merged.append(vocab[left + right])
    return ranks, merged, of_byte, [t["content"] for t in spec.get("added_tokens", [])]


def merge_count(data: bytes, ranks: dict[int, int], merged: list[int], of_byte: list[int]) -> int:
    """Tokens of one pre-token: symbols minus merges."""
    n = len(data)
    if n < 2:
        return n
    shift = n.bit_length()
    place = (1 << shift) - 1
    sym = [of_byte[b] for b in data]
    at = [ranks.get(a << 24 | b, -1) for a, b in zip(sym, sym[1:])]  # rank of the pair at a symbol
    heap = [r << shift | i for i, r in enumerate(at) if r >= 0]
    if not heap:
        return n
    heapify(heap)
    at.append(-1)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    left = n
    while heap:
        e = heappop(heap)
        i, rank = e & place, e >> shift
        if at[i] != rank:
            continue  # an earlier merge took one of the two
        new = sym[i] = merged[rank]
        j = nxt[i]
        at[j] = -1
        left -= 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            r = at[i] = ranks.get(new << 24 | sym[k], -1)
            if r >= 0:
                heappush(heap, r << shift | i)
        else:
            at[i] = -1
        h = prv[i]
        if h >= 0:
            r = at[h] = ranks.get(sym[h] << 24 | new, -1)
            if r >= 0:
                heappush(heap, r << shift | h)
    return left


class _Counts(dict):
    """Pre-token -> tokens, computed when missing; bounded."""

    def __init__(self, path: str):
        super().__init__()
        *self.tables, specials = load_merges(path)
        self.special = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len,
                                                                          reverse=True))) if specials else None

    def __missing__(self, word: str) -> int:
        n = merge_count(word.encode("utf-8", "replace"), *self.tables)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = n
        return n

    def text(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.__getitem__, pre_tokens(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.text(p) for p in parts if p)


@functools.cache
def counter(path: str) -> _Counts:
    """One per Python worker, kept over tasks."""
    return _Counts(path)


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``documents``."""
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = counter(tokenizer_path)
        for pdf in batches:
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "n_bytes": [len(t) if t.isascii() else len(t.encode("utf-8", "replace"))
                            for t in pdf["text"]],
                "n_tokens": [tokens.text(t) for t in pdf["text"]]})

    docs = plain(documents, doc_id="long", text="string")
    counted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(read(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), 512)
