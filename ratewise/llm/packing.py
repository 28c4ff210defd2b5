"""Best-fit packing of tokenised documents into fixed-size sequences.

Exact-complement hashing: the lengths of all pieces form a histogram (at most
``size`` entries, however many pieces there are), and the sums of two and of three
available lengths are indexed, kept up to date as counts run out.  From the longest
length on, the gap it leaves is looked up among single lengths, pairs and triples, and
a combination that fills it (exactly first, or but for a hundredth of the size) is
consumed as often as the counts allow.  A gap without such a filling takes its best fit
at once.  A *pattern* is a multiset of lengths with a number of sequences, so the
plan's size depends on ``size`` alone.

Pieces find their place without a global sort: they are ranked within
``(length, salt)``, the ranks are shifted by the counts of the smaller salts,
and a rank within a length falls into exactly one interval of the plan.

Documents are tokenised once, into a stored table of piece lengths and
checksums.  A document longer than ``size`` is cut into ``size``-token pieces,
its first piece taking the remainder.

Cases: null or empty text is the end token alone; repeated document ids stay
separate pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, plain, read, small_batches, stored
from .tokens import CACHE_CHARS, CACHE_ENTRIES, pre_tokens

#: Most rows of one (length, salt) group, where the number of salts allows it.
GROUP_ROWS, MAX_SALTS = 100_000, 4096
#: A gap counts as filled if less than the SLACK-th part of a sequence stays empty: a
#: pair or triple that fills it to the last token would take short lengths from others.
SLACK = 100
#: Pre-tokens that are encoded side by side.
JOINED = 256


# --- token ids -----------------------------------------------------------------------

class _Ids(dict):
    """Pre-token -> its ids as little-endian bytes, as the tokenizers library gives
    them; bounded, and what the table held before it was last full is looked up before
    anything is encoded again.  The new pre-tokens of a block of texts are encoded in one
    call; those of a space and letters stand side by side in one text, which the library
    cuts at the same places.  Vocabularies whose pre-tokens are not those of
    :func:`pre_tokens` are encoded text by text."""

    def __init__(self, path: str):
        super().__init__()
        # a task has one core, so the library's own threads would only wait for it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and not spec.get("normalizer")
                        and all(not t[k] for t in spec.get("added_tokens", [])
                                for k in ("single_word", "lstrip", "rstrip")))
        self.added = {t["content"]: np.uint32(t["id"]).tobytes() for t in spec.get("added_tokens", [])}
        self.special = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        #: No special string could arise where pre-tokens of letters meet.
        self.joins = not any(t.replace(" ", "").isalpha() for t in self.added)
        self.before: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of pre-tokens."""
        letters, others = [], []
        for w in words:
            (letters if self.joins and w[0] == " " and w[1:].isalpha() else others).append(w)
        groups = [letters[i:i + JOINED] for i in range(0, len(letters), JOINED)]
        told = self.tokenizer.encode_batch(["".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, told):
            data, word = np.array(e.ids, "<u4").tobytes(), e.word_ids
            ends = [4 * i for i in range(1, len(word)) if word[i] != word[i - 1]]
            if len(ends) + 1 == len(group):
                yield from zip(group, map(data.__getitem__, map(slice, [0, *ends], [*ends, len(data)])))
            else:  # cut at other places
                others += group
        yield from zip(others, self._encode(others))

    def _split(self, text: str) -> list[str]:
        """Pre-tokens and special strings, in order."""
        if self.special is None or not self.special.search(text):
            return pre_tokens(text)
        return [w for p in self.special.split(text) if p
                for w in ([p] if p in self.added else pre_tokens(p))]

    def texts(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        split = [self._split(t) for t in texts]
        known = [list(map(self.get, ws)) for ws in split]
        new = {w for ws, xs in zip(split, known) if None in xs for w, x in zip(ws, xs) if x is None}
        if len(self) + len(new) > CACHE_ENTRIES:
            self.before = dict(self)
            self.clear()
        found = {w: self.before[w] for w in new if w in self.before}
        found.update(self._encode_words([w for w in new if w not in found]))
        self.update((w, x) for w, x in found.items() if len(w) <= CACHE_CHARS)
        return [b"".join([found[w] if x is None else x for w, x in zip(ws, xs)] if None in xs else xs)
                for ws, xs in zip(split, known)]


def _text_blocks(texts: list[str], size: int = 1 << 18) -> Iterator[list[str]]:
    """``texts`` in blocks of about ``size`` characters."""
    block, held = [], 0
    for t in texts:
        block.append(t)
        held += len(t)
        if held >= size:
            yield block
            block, held = [], 0
    yield block


def _ids(path: str) -> _Ids:
    """One per Python worker, kept over tasks until another operator's begin."""
    return kept(("ids", path), lambda: _Ids(path))


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens."""
    first = n % size or size
    if n <= size:
        return [(0, n)]
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(documents: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2,
           keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every document."""
    small_batches(documents.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (
        ", ids array<int>" if keep_ids else "")
    end = np.uint32(end_id).tobytes()

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids(tokenizer_path)
        for pdf in batches:
            rows = []
            encoded = (x for block in _text_blocks(pdf["text"].tolist()) for x in ids.texts(block))
            for doc_id, data in zip(pdf["doc_id"], encoded):
                data += end
                for k, (start, length) in enumerate(cut(len(data) // 4, size)):
                    part = data[4 * start:4 * (start + length)]
                    row = (doc_id, k, start, length, zlib.crc32(part))
                    rows.append(row + (np.frombuffer(part, "<u4").astype("i4"),) if keep_ids else row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    docs = plain(documents, doc_id="long", text="string")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        tokenise, schema)


# --- the plan, on the histogram of lengths ----------------------------------------------

class _Lengths:
    """The available lengths with their counts, and an index of the sums of two and of
    three of them, kept up to date as lengths run out."""

    def __init__(self, histogram: dict[int, int], size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        for length, n in histogram.items():
            self.count[length] = n
        self.have = (self.count > 0).astype(np.int64)
        # ordered ways to write a sum by two and by three available lengths
        self.pair = np.convolve(self.have, self.have)[:size + 1]
        self.triple = np.convolve(self.pair, self.have)[:size + 1]

    def _run_out(self, x: int) -> None:
        def shifted(a: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate((np.zeros(min(by, len(a)), np.int64), a))[:self.size + 1]

        self.have[x] = 0
        one = np.zeros(self.size + 1, np.int64)
        one[0] = 1
        self.pair -= 2 * shifted(self.have, x) + shifted(one, 2 * x)
        self.triple -= 3 * shifted(self.pair, x) + 3 * shifted(self.have, 2 * x) + shifted(one, 3 * x)

    def take(self, need: Counter, n: int) -> None:
        for x, k in need.items():
            self.count[x] -= n * k
            if not self.count[x]:
                self._run_out(x)

    def _two(self, total: int, most: int, used: Counter) -> tuple[int, ...] | None:
        a = np.arange((total + 1) // 2, min(most, total - 1) + 1)
        a = a[(self.have[a] & self.have[total - a]) > 0]
        for x in map(int, a[::-1]):
            if self._left(Counter((x, total - x)), used):
                return x, total - x
        return None

    def _left(self, need: Counter, used: Counter) -> bool:
        return all(self.count[x] - used[x] >= k for x, k in need.items())

    def one(self, total: int, used: Counter) -> tuple[int, ...] | None:
        return (total,) if self.count[total] > used[total] else None

    def two(self, total: int, used: Counter) -> tuple[int, ...] | None:
        return self._two(total, total, used) if self.pair[total] else None

    def three(self, total: int, used: Counter) -> tuple[int, ...] | None:
        if not self.triple[total]:
            return None
        a = np.arange((total + 2) // 3, total - 1)
        a = a[(self.have[a] > 0) & (self.pair[total - a] > 0)]
        for x in map(int, a[::-1]):
            if self.count[x] > used[x] and (two := self._two(total - x, x, used + Counter((x,)))):
                return (x, *two)
        return None

    def filling(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """Lengths for a gap that are still there when ``used`` are taken: one, else two,
        else three that fill it but for SLACK of the size, the fullest first and of equals
        those with the largest length; else the largest single that fits."""
        close = range(gap, max(0, gap - self.size // SLACK - 1), -1)
        for way in (self.one, self.two, self.three):
            for total in close:
                if found := way(total, used):
                    return found
        return next((found for total in range(close.stop, 0, -1) if (found := self.one(total, used))), None)


def plan(histogram: dict[int, int], size: int) -> list[tuple[Counter, int]]:
    """``[(lengths of a sequence, number of such sequences)]``.

    From the longest length on, its gap is filled by a single length, a pair or a triple.
    A gap that none of them fills takes its best fit at once, and what is left of it is
    filled in the same way, so that small lengths are not spent on others before.  Each
    combination is taken as often as the counts allow, so the plan's cost depends on
    ``size`` alone."""
    lengths = _Lengths(histogram, size)
    patterns: list[tuple[Counter, int]] = []
    for top in range(size, 0, -1):
        while lengths.count[top]:
            pattern, gap = Counter((top,)), size - top
            while gap and (found := lengths.filling(gap, pattern)):
                pattern.update(found)
                gap -= sum(found)
            n = int(min(lengths.count[x] // k for x, k in pattern.items()))
            lengths.take(pattern, n)
            patterns.append((pattern, n))
    return patterns


def intervals(patterns: list[tuple[Counter, int]], size: int) -> dict[int, np.ndarray]:
    """For each length, rows ``(first rank, first sequence, copies in a
    sequence, offset)``, by first rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length, k in sorted(pattern.items(), reverse=True):
            out.setdefault(length, []).append((used[length], sequence, k, offset))
            used[length] += n * k
            offset += length * k
        sequence += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces (columns
    ``doc_id, piece, start, length``, others are kept)."""
    spark = pieces.sparkSession
    total = pieces.count()
    salts = int(min(MAX_SALTS, max(16, total // GROUP_ROWS)))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("n")), "lengths")
    # at most ``size`` rows reach the driver
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    places = intervals(plan(histogram, size), size)

    before = counts.select("length", "_salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("_salt")) - F.col("n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt")
                               .orderBy("doc_id", "piece", "start"))
    ranked = salted.withColumn("_rank", rank).join(before, ["length", "_salt"]).withColumn(
        "_rank", F.col("_rank") - 1 + F.col("_before")).select(*pieces.columns, "_rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(), pdf.pop("_rank").to_numpy()
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                rows = places[int(one)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                nth = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + nth // row[:, 2]
                offset[at] = row[:, 3] + nth % row[:, 2] * one
            yield pdf.assign(sequence_id=sequence, offset=offset)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, f"{fields}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer_path: str, size: int = 1024,
                   end_id: int = 2) -> DataFrame:
    return pack(stored(pieces(documents, tokenizer_path, size, end_id), "pieces"), size)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack_documents(read(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))
