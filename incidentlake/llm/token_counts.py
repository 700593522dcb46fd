"""Token counts of a byte-level BPE vocabulary, without emitting identifiers.

A text is cut into pre-tokens by the vocabulary's pattern; each pre-token is a
linked list of byte symbols, and a heap yields the adjacent pair of lowest rank
until none is left. The count is the initial symbols minus the merges made.
Counts of space-delimited pieces are kept in a bounded dictionary per Python
worker, since a space followed by a non-space always begins a new pre-token.

Defined results: null and empty texts have 0 bytes and 0 tokens; the special
strings of the vocabulary file inside a text count as one token each (the
tokenizer library's default); repeated rows give repeated results; extra columns
are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._ship import ship

CACHE_ENTRIES = 600_000
# Fixed value: the byte-level pre-token pattern of the vocabulary. White space is
# spelt out, since regex engines differ on U+001C to U+001F.
_WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairCounter(dict):
    """Number of tokens by piece; a missing piece is counted and remembered."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.byte_id = [vocab[c] for c in byte_symbols()]
        # (left << 32 | right) -> (rank << 32 | merged)
        self.pairs = {vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.find = regex.compile(PATTERN).findall
        self.odd_space = regex.compile(rf" (?=[{_WHITE}]|$)").search
        self.unusual = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]").search
        self.limit = cache_entries
        self.path, self.library = path, None

    def __missing__(self, piece: str) -> int:
        n = sum(map(self.merge, self.find(" " + piece)))
        if len(self) >= self.limit:
            self.clear()
        self[piece] = n
        return n

    def merge(self, token: str) -> int:
        """Tokens of one pre-token, by heap and linked list."""
        symbol = [self.byte_id[b] for b in token.encode("utf-8")]
        n = len(symbol)
        if n == 1:
            return 1
        pairs, get = self.pairs, self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = get(symbol[i] << 32 | symbol[i + 1])
            if found is not None:
                heap.append((found >> 32, i, symbol[i], symbol[i + 1], found & 0xFFFFFFFF))
        heapify(heap)
        left = n
        while heap:
            _, i, a, b, merged = heappop(heap)
            if symbol[i] != a:
                continue
            j = after[i]
            if j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = merged, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                found = pairs.get(merged << 32 | symbol[k])
                if found is not None:
                    heappush(heap, (found >> 32, i, merged, symbol[k], found & 0xFFFFFFFF))
            h = before[i]
            if h >= 0:
                found = pairs.get(symbol[h] << 32 | merged)
                if found is not None:
                    heappush(heap, (found >> 32, h, symbol[h], merged, found & 0xFFFFFFFF))
        return left

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a stretch without special strings. Characters whose
        class could differ between Unicode versions go by the library's own cut."""
        if self.unusual(text) is None:
            return self.find(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        raw = text.encode("utf-8")
        spans, at = [], 0
        for token, _ in self.library.pre_tokenize_str(text):
            spans.append(raw[at : at + len(token)].decode("utf-8"))
            at += len(token)
        return spans

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        if self.unusual(text) is not None or self.odd_space(text) is not None:
            return sum(map(self.merge, self.pre_tokens(text)))
        head, *rest = text.split(" ")
        return sum(map(self.merge, self.find(head))) + sum(map(self.__getitem__, rest))


_counters: dict[str, PairCounter] = {}


def _counter(path: str) -> PairCounter:
    """The counter of this Python worker: its dictionary serves all its tasks."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = PairCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_tokens`` and
    ``over_limit``. ``vocabulary`` is the path of a byte-level BPE file in the
    tokenizer library's JSON form, present on every executor."""
    ship(docs.sparkSession)
    new = ("n_bytes", "n_tokens", "over_limit")
    names = [c for c in docs.columns if c != text and c.lower() not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            counts = [counter.count(x.as_py() or "") for x in batch.column("__text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(counts, pa.int64())], names=[*names, "n_tokens"])

    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    rows = docs.select(*(F.col(f"`{c}`") for c in names), size.alias("n_bytes"), F.col(f"`{text}`").alias("__text"))
    names = [*names, "n_bytes"]
    kept = [f for f in rows.schema if f.name in names]
    counted = rows.mapInArrow(run, T.StructType([*kept, T.StructField("n_tokens", T.LongType())]))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
