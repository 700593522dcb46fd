"""Periodic runs of words inside a text: seed and extend along diagonals.

A run is a stretch of words with smallest period q (words q apart are the same),
at least ``max(min_length, min_exponent * q)`` words long, which no neighbouring
word extends. On the diagonal of lag q (word x against word x + q) a run of n
words is a stretch of n - q equal pairs, so it holds a pair of equal k-grams q
apart for every k up to the least overlap that its length guarantees. Lags go in
classes 1, 2-3, 4-7, ..., and each class has k-grams of the least overlap that
its lags guarantee, 5, 6, 12, 24, ... words by default.

Seeds are the pairs of occurrences of one k-gram in one text. Neighbouring
occurrences are enough: as k is no less than any lag of its class, an occurrence
between the first k-gram of a run and its copy q words later would give the run
a second period r < q, and by the theorem of Fine and Wilf one that divides q,
so that q would not be the smallest. For the same reason a seed's lag is the
smallest period of a stretch that is long enough. A class therefore has fewer
seeds than the text has words, whatever repeats. A seed is extended in both
directions unless the table of its lag says that the diagonal is covered as far
as the seed.

k-grams are compared exactly: a name for every repeated stretch of 1, 2, 4, ...
words, two of which name a k-gram. What occurs once drops out at every step, so
texts without long repeats end after two or three.

Each text is searched by itself (``find_runs`` adds columns, nothing is
shuffled); memory follows the longest text. Defined results: a null text, or one
without words, has no runs and collapses to the empty text; repeated rows give
repeated results; all other columns are kept, but for columns of the names of
the two results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._columns import free_name, let, whole
from incidentlake.llm._ship import ship

MIN_LENGTH, MIN_EXPONENT = 6, 4
_RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))
_WORD = r"[^\x20\x09-\x0D]+"


def _repeated(key: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the keys at the positions ``at``; -1 elsewhere and where a key occurs once."""
    out = np.full(size, -1, np.int64)
    if len(at):
        _, rank, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = count[rank] > 1
        out[at[twice]] = rank[twice]
    return out


def _joined(name: np.ndarray, gap: int) -> np.ndarray:
    """Names of the stretches made of two named ones, the second ``gap`` words on."""
    size = max(len(name) - gap, 0)
    first, second = name[:size], name[gap:]
    at = np.flatnonzero((first >= 0) & (second >= 0))
    return _repeated(first[at] * len(name) + second[at], at, size)


def _least_overlap(low: int, high: int, min_length: int, min_exponent: int) -> int:
    lags = np.arange(low, high + 1)
    return int((np.maximum(min_length, min_exponent * lags) - lags).min())


def _first_difference(codes: np.ndarray, x: int, lag: int) -> int:
    """The first y >= x where words y and y + lag differ, or the end of the diagonal."""
    end, step = len(codes) - lag, 64
    while x < end:
        stop = min(x + step, end)
        differ = codes[x:stop] != codes[x + lag : stop + lag]
        k = int(differ.argmax())
        if differ[k]:
            return x + k
        x, step = stop, step * 2
    return end


def _last_difference(codes: np.ndarray, x: int, lag: int) -> int:
    """The last y < x where words y and y + lag differ, or -1."""
    step = 64
    while x > 0:
        stop = max(x - step, 0)
        differ = codes[stop:x] != codes[stop + lag : x + lag]
        where = np.flatnonzero(differ)
        if len(where):
            return stop + int(where[-1])
        x, step = stop, step * 2
    return -1


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by
    start, then period."""
    if min_exponent < 3 or min_length <= min_exponent:
        raise ValueError("neighbouring occurrences suffice for exponents of 3 or more and lengths beyond one repeat")
    n, found = len(codes), []
    names = {1: _repeated(codes, np.arange(n), n)}
    size, low = 1, 1
    while max(min_length, min_exponent * low) <= n:
        high = 2 * low - 1
        k = _least_overlap(low, high, min_length, min_exponent)
        while size * 2 <= k:
            names = {size * 2: _joined(names[size], size)}
            size *= 2
        if not (names[size] >= 0).any():
            break  # no stretch of that many words occurs twice, let alone a longer one
        grams = _joined(names[size], k - size) if k > size else names[size]
        at = np.flatnonzero(grams >= 0)
        order = at[np.argsort(grams[at], kind="stable")]
        here, lag = order[:-1], np.diff(order)
        seed = (grams[order[:-1]] == grams[order[1:]]) & (lag >= low) & (lag <= high)
        here, lag = here[seed], lag[seed]
        by_place = np.argsort(here, kind="stable")
        covered: dict[int, int] = {}
        for x, q in zip(here[by_place].tolist(), lag[by_place].tolist(), strict=True):
            if x < covered.get(q, 0):
                continue
            end = covered[q] = _first_difference(codes, x + k, q)
            start = _last_difference(codes, x, q) + 1
            if end - start + q >= max(min_length, min_exponent * q):
                found.append((start, end - start + q, q))
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: no run contains it after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def _searched(column: pa.Array, min_length: int, min_exponent: int) -> tuple[pa.Array, pa.Array]:
    bounds, every, texts = [0], [], []
    for text in column.cast(pa.binary()).to_pylist():
        words = (text or b"").split()  # at U+0020 and U+0009 to U+000D
        runs = []
        if len(words) >= min_length:
            codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            runs = runs_of(codes.astype(np.int64), min_length, min_exponent)
        if runs:
            words = [words[i] for i in np.flatnonzero(_kept(len(words), runs)).tolist()]
        every += runs
        bounds.append(len(every))
        texts.append(b" ".join(words))
    fields = np.array(every, np.int64).reshape(-1, 3)
    flat = pa.StructArray.from_arrays([pa.array(fields[:, i]) for i in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat), pa.array(texts, pa.binary()).cast(pa.string())


def find_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, keep_text: bool = True) -> DataFrame:
    """``docs`` with the runs of each text (``start``, ``length`` and ``period``
    in words, by start, then period) and the collapsed text: of every run the
    first period alone, the words joined by one space. ``keep_text=False``
    leaves the text out."""
    ship(docs.sparkSession)
    others = whole(docs, text, runs, collapsed)
    columns = [*others, F.col(f"`{text}`")] if keep_text and text not in (runs, collapsed) else others
    kept = docs.select(*columns)
    names, width = [*kept.columns, runs, collapsed], len(kept.columns)
    rows = docs.select(*others, F.col(f"`{text}`").alias(free_name([runs, collapsed, *docs.columns], "searched")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _searched(batch.columns[-1], min_length, min_exponent)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *found], names=names)

    return rows.mapInArrow(run, T.StructType([*kept.schema, T.StructField(runs, _RUNS), T.StructField(collapsed, T.StringType())]))


def repeat_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The table of the registered query: in every tenth document, by the
    checksum h of its id, the words from a on are replaced by repeats of the
    words a to a + p - 1, where a and p follow from floor(h / 10) and the number
    of words. Rows without id or words stay as they are."""
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        def cut(x):
            n, a, p = x["n"], x["a"], x["p"]
            places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
            return F.array_join(places, " ")

        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(n.alias("n"), a.alias("a"), p.alias("p")), cut)

    column = F.col(f"`{text}`")
    chosen = (h % 10 == 0) & column.rlike(_WORD)
    tail = F.when(chosen, let(F.regexp_extract_all(column, F.lit(f"({_WORD})")), repeated)).otherwise(column)
    return docs.select(*whole(docs, text), tail.alias(text))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per row: number of runs, the longest (ties: first start, then least
    period), its exponent in thousandths, and checksums of all runs and of the
    collapsed text."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    rows = found.select(F.col(f"`{doc_id}`").alias("doc_id"), F.size(runs).cast("long").alias("n_runs"), longest.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
