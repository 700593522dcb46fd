"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts the hashed 1- to 3-grams of every labelled text (a Spark
aggregation), ``predict`` scores every text against the log-probability matrix,
which is broadcast: ``n_buckets`` rows by one column per language.

Texts are lower-cased character by character; everything that is not a letter
is a space, and runs of spaces are one. Defined results:

* null text, empty text, no letter: language ``und``, score 0.0.
* ties between languages: the name that sorts first.
* no labelled row at all: every text is ``und``.
* repeated rows and extra columns: each input row gives one output row with all
  its columns; clashing output names replace the input's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentlake.llm._ship import ship
from incidentlake.llm._text import code_points, mix, slices, utf8

UNDETERMINED = "und"
N_BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 512
SMOOTHING = 0.1
_FLUSH_LANGUAGES = 64
_SPACE = np.uint32(0x20)
_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space if it is no letter."""
    if not _table:
        table = np.full(0x110000, _SPACE, dtype=np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _table.append(table)
    return _table[0]


def hashed_grams(data: np.ndarray, bounds: np.ndarray, n_buckets: int, orders=ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams row by row, and the n+1 row bounds in them."""
    points, at = code_points(data, bounds)
    letters = _letters()[points]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    gap = letters == _SPACE
    drop = gap.copy()
    drop[1:] &= gap[:-1] & (row[1:] == row[:-1])
    if len(drop):
        drop[0] = False
    letters, row = letters[~drop], row[~drop]
    buckets, owners = [], []
    code = np.zeros(len(letters), np.uint64)
    for k in range(1, max(orders) + 1):
        n = len(letters) - k + 1
        if n <= 0:
            break
        code = code[:n] * np.uint64(0x100000001B3) + letters[k - 1 :].astype(np.uint64) + np.uint64(1)
        if k not in orders:
            continue
        keep = row[:n] == row[k - 1 :]
        if k == 1:
            keep &= letters != _SPACE
        hashed = mix(code[keep] + np.uint64(k << 56)) % np.uint64(n_buckets)
        buckets.append(hashed.astype(np.int64))
        owners.append(row[:n][keep])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(bounds) - 1)
    return np.concatenate(buckets)[order], np.concatenate([[0], np.cumsum(counts)])


def _count_grams(n_buckets: int):
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def emit(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], schema=schema
            )
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            lang = np.array(batch.column("lang").to_pylist(), dtype=object)
            for a, b in slices(bounds):
                part = data[bounds[a] : bounds[b]]
                grams, at = hashed_grams(part, bounds[a : b + 1] - bounds[a], n_buckets)
                owner = np.repeat(lang[a:b], np.diff(at)) if len(grams) else lang[:0]
                for x in set(lang[a:b]):
                    if x not in counts:
                        if len(counts) >= _FLUSH_LANGUAGES:
                            yield from emit(counts)
                        # one more than none, so that a language without letters is known too
                        counts[x] = np.zeros(n_buckets + 1, np.int64)
                    counts[x][:n_buckets] += np.bincount(grams[owner == x], minlength=n_buckets)
                    counts[x][n_buckets] += int((lang[a:b] == x).sum())
        yield from emit(counts)

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", n_buckets: int = N_BUCKETS,
        smoothing: float = SMOOTHING, max_languages: int = MAX_LANGUAGES) -> dict:
    """Model from all rows with a label: ``languages`` (sorted), ``log_prob``
    (languages x buckets) and ``log_prior``. The counts are summed by Spark; what
    reaches the driver is at most ``n_buckets + 1`` numbers per language."""
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull())
    found = rows.select("lang").distinct().limit(max_languages + 1).count()
    if found > max_languages:  # before any count reaches the driver
        raise ValueError(f"more than {max_languages} label values; the broadcast matrix is bounded to {max_languages} languages")
    counts = rows.mapInArrow(_count_grams(n_buckets), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    place = {x: i for i, x in enumerate(languages)}
    matrix = np.zeros((len(languages), n_buckets + 1))
    owner = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
    matrix[owner, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    docs, grams = matrix[:, n_buckets], matrix[:, :n_buckets] + smoothing
    return {
        "languages": languages,
        "log_prob": np.log(grams / grams.sum(axis=1, keepdims=True)),
        "log_prior": np.log(docs / docs.sum()) if len(languages) else docs,
        "n_buckets": n_buckets,
    }


def _score(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = np.array([*model["languages"], UNDETERMINED], dtype=object)
        for batch in batches:
            data, bounds = utf8(batch.column("__text"))
            best, share = np.full(len(batch), len(languages) - 1), np.zeros(len(batch))
            for a, b in slices(bounds) if len(languages) > 1 else ():
                part = data[bounds[a] : bounds[b]]
                grams, at = hashed_grams(part, bounds[a : b + 1] - bounds[a], model["n_buckets"])
                size = np.diff(at)
                some = np.flatnonzero(size)
                if not len(some):
                    continue
                total = np.stack([np.add.reduceat(p[grams], at[some]) for p in model["log_prob"]]) + model["log_prior"][:, None]
                total /= np.sqrt(size[some])  # evidence of overlapping grams is not independent
                weight = np.exp(total - total.max(axis=0))
                best[a + some] = total.argmax(axis=0)
                share[a + some] = weight.max(axis=0) / weight.sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(languages[best], pa.string()), pa.array(share)], names=[*names, "lang_pred", "score"]
            )

    return run


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1). Only the text is read."""
    spark = docs.sparkSession
    ship(spark)
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*(f for f in docs.schema if f.name in names), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_score(spark.sparkContext.broadcast(model), names), schema)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled documents that are not held out, predict all."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model).withColumn("held_out", held_out())
