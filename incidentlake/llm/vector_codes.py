"""Vector code compression: product codebooks of integers, exact nearest entries.

A vector's components become integers and are cut into equal parts; each part
position has a codebook of at most 256 entries. Rounds of assignment and
replacement (an entry becomes the floor of its parts' mean) refine the codebooks;
a vector's code is the number of the nearest entry of each part.

The nearest entry is found by memoised grid cells. Space is cut into boxes of
equal width; a part's box is its cell. For a cell not met before, the least and
the greatest distance between the box and every entry are computed: an entry
whose least distance exceeds the greatest distance of another is dominated, so
it is nearest to no point of the box. The entries left are kept for the cell,
and each part is compared exactly, in integers, with those of its cell only.
Cells are kept for the length of a task, in a table of bounded size that starts
anew when it is full; neither the table nor the width of a cell changes a result.

Each round is one pass over the stored integers: tasks send a sum and a count
per entry they met, which Spark adds up; codebooks (entries x components, bounded
by the parameters) go through the driver and to every task.

Defined results: rows without vector, with null or non-finite components, or
with components so large that squared distances do not fit 64 bits (beyond about
1.9e8 for 64 components, in integers) are left out, as are rows whose vector has
not the commonest length (ties: the longer) among multiples of the number of
parts. Rows may repeat an id; the first entries are the rows of smallest id,
then of smallest vector (null ids last). Fewer rows than entries give smaller
codebooks; no row gives no code. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlake.llm._ship import ship
from incidentlake.llm._stored import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CACHE_CELLS = 50_000  # a part position and task; about 200 bytes each
_BLOCK_VALUES = 1 << 21  # integers in a temporary array


def cell_width(entries: np.ndarray) -> int:
    """Half the mean distance of the entries' components from their mean, at least 1."""
    spread = np.abs(entries - entries.mean(axis=0)).mean() if len(entries) else 0.0
    return max(1, int(spread / 2))


class NearestEntry:
    """Nearest entries of one codebook, by memoised cells."""

    def __init__(self, entries: np.ndarray, width: int | None = None, cells: int = CACHE_CELLS):
        self.entries = np.ascontiguousarray(entries, np.int64)
        self.width = width or cell_width(self.entries)
        self.limit = cells
        self.rows = max(1, _BLOCK_VALUES // max(1, self.entries.size))
        self._forget()
        self.met = self.computed = self.compared = 0  # parts, cells and exact distances so far

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.left = np.zeros((self.rows, len(self.entries)), bool)

    def undominated(self, cell: np.ndarray) -> np.ndarray:
        """Which entries can be nearest to a point of each cell."""
        low = cell[:, None, :] * self.width
        high = low + self.width - 1
        below, above = low - self.entries, self.entries - high
        near = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=2)
        far = np.square(np.maximum(np.abs(below), np.abs(above))).sum(axis=2)
        return near <= far.min(axis=1, keepdims=True)

    def _candidates(self, part: np.ndarray) -> np.ndarray:
        """A row of ``left`` for each part."""
        cell = np.floor_divide(part, self.width)
        packed = cell.view(np.dtype((np.void, cell.itemsize * cell.shape[1]))).ravel()
        keys, first, back = np.unique(packed, return_index=True, return_inverse=True)
        keys = [k.tobytes() for k in keys]
        new = [i for i, k in enumerate(keys) if k not in self.slot]
        if len(self.slot) + len(new) > self.limit:
            self._forget()
            new = range(len(keys))
        if len(new):
            known, self.computed = len(self.slot), self.computed + len(new)
            while len(self.left) < known + len(new):
                self.left = np.concatenate([self.left, np.zeros_like(self.left)])
            self.left[known : known + len(new)] = self.undominated(cell[first[list(new)]])
            self.slot.update((keys[i], known + k) for k, i in enumerate(new))
        return self.left[np.array([self.slot[k] for k in keys])[back]]

    def __call__(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each part's nearest entry; ties go to
        the lower number."""
        index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for a in range(0, len(parts), self.rows):
            part = np.ascontiguousarray(parts[a : a + self.rows])
            row, entry = np.nonzero(self._candidates(part))
            d = np.square(part[row] - self.entries[entry]).sum(axis=1)
            begin = np.searchsorted(row, np.arange(len(part)))
            least = np.minimum.reduceat(d, begin)
            hit = np.flatnonzero(d == least[row])
            first = hit[np.searchsorted(row[hit], np.arange(len(part)))]
            index[a : a + self.rows], distance[a : a + self.rows] = entry[first], least
            self.met, self.compared = self.met + len(part), self.compared + len(d)
        return index, distance


@dataclass(frozen=True)
class Codebooks:
    """One array of integers per part position: entries x components."""

    entries: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        """Of all components, decimal, by part, entry and place, comma-joined."""
        text = ",".join(str(x) for part in self.entries for x in part.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()

    def vector(self, code: str) -> list[int]:
        """The integers that a code of two hex digits per part stands for."""
        return [x for part, i in zip(self.entries, bytes.fromhex(code), strict=True) for x in part[i].tolist()]


def integers(vectors: DataFrame, vec_id: str, vector: str, label: str | None = None, *, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """``id``, ``label`` and ``x`` (floor of scale times each component) of the
    rows that can be compressed, stored."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(math.inf), F.lit(False)))
    named = F.lit(None).cast("string") if label is None else F.col(f"`{label}`")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), named.alias("label"), F.when(finite & (F.size(v) > 0) & (F.size(v) % parts == 0), v).alias("v")).where("v is not null")
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    n = length["n"] if length else parts
    most = math.isqrt((2**63 - 1) // n) // 2 - 1
    fits = F.forall("v", lambda c: F.abs(c.cast("double")) * scale < most)
    return stored(rows.where((F.size("v") == n) & fits).select("id", "label", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("x")), "vector-integers")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), -1)


def _split(books: Codebooks, x: np.ndarray) -> list[np.ndarray]:
    return np.split(x, len(books.entries), axis=1)


def _sums(books: Codebooks):
    """Per part and entry met by the task: how many parts, and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [NearestEntry(e) for e in books.entries]
        total = [np.zeros((len(e), e.shape[1] + 1), np.int64) for e in books.entries]
        for batch in batches:
            if not len(batch):
                continue
            for nearest, part, sums in zip(search, _split(books, _matrix(batch.column("x"))), total, strict=True):
                index, _ = nearest(part)
                np.add.at(sums, index, np.hstack([np.ones((len(part), 1), np.int64), part]))
        for k, sums in enumerate(total):
            used = np.flatnonzero(sums[:, 0])
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "sums"])

    return run


def first_entries(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the rows of smallest id."""
    first = rows.select("id", "x").orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
    x = np.array([r["x"] for r in first] or np.zeros((0, parts)), np.int64)
    return Codebooks(tuple(np.split(x, parts, axis=1)))


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of its parts' mean; entries that
    are nearest to no part stay."""
    width = books.entries[0].shape[1]
    sums = rows.select("x").mapInArrow(_sums(books), "part int, entry int, sums array<bigint>")
    added = sums.groupBy("part", "entry").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(width + 1))).alias("sums")).collect()
    after = [e.copy() for e in books.entries]
    for r in added:
        count, *total = r["sums"]
        after[r["part"]][r["entry"]] = [t // count for t in total]
    return Codebooks(tuple(after))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``rows`` (from ``integers``)."""
    ship(rows.sparkSession)
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    books = first_entries(rows, parts, entries)
    for _ in range(rounds if len(books.entries[0]) else 0):
        books = refined(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``id``, ``label``, ``code`` and ``error`` (squared distance, summed over
    the parts) of ``rows``."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [NearestEntry(e) for e in books.entries]
        for batch in batches:
            if not len(batch):
                continue
            found = [nearest(part) for nearest, part in zip(search, _split(books, _matrix(batch.column("x"))), strict=True)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = np.sum([d for _, d in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"id {kind['id']}, label {kind['label']}, code string, error bigint")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Code and error of every vector, the summed error of its label's vectors
    (null is a label) and the checksum of the final codebooks."""
    rows = integers(vectors, vec_id, vector, label)
    books = train(rows)
    codes = stored(encode(rows, books), "vector-codes")
    by_label = codes.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
