"""Large CSV files with quoted line breaks, read by many tasks.

Spark's reader gives a file to one task if values may hold line breaks, as only
someone who has read all before knows whether a line begins inside a value. Here
byte ranges are read as lines, and that knowledge is a prefix scan:

1. For each line: would a value be open at its end if none is at its beginning,
   and if one is? Two bits, by a regular expression that follows the parser's
   rules for quotes. Each task joins the bits of its range: two bits a range.
2. An exclusive scan over the ranges of a file (a window over one row per range)
   says whether a value is open where a range begins.
3. Each task joins the lines of its range to records. What a range begins or ends
   with may be a part of a record; only ranges at such places are read once more,
   and their parts are put together.
4. Records are texts, which Spark's own CSV parser reads, as in its reader.

What the driver holds is one number per range of the files with several ranges
(10^6 for 100 TB at 128 MB). Line ends are \\n or \\r\\n; a range is what Spark's
text reader makes it (``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPEN = rf"^(?:{_FIELD},)*+{_QUOTED}\z"

# Kinds of what step 3 gives.
RECORD, HEADER, HEAD, TAIL, MIDDLE = range(5)
_KEY = ("file", "size", "start")


def open_at_end(line: Column) -> tuple[Column, Column]:
    """Whether a quoted value is open at a line's end: if none was open at its
    beginning, and if one was."""
    quoted = F.contains(line, F.lit('"'))
    fresh = F.when(quoted, line.rlike(_OPEN)).otherwise(F.lit(False))
    inside = F.when(quoted, F.concat(F.lit('"'), line).rlike(_OPEN)).otherwise(F.lit(True))
    return fresh, inside


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(list(paths))
    fresh, inside = open_at_end(F.col("value"))
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        fresh.alias("fresh"),
        inside.alias("inside"),
        F.endswith("value", F.lit("\r")).alias("cr"),
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        "value",
    )


def _range_ends():
    """Tasks: a row per range, whether a value is open at its end in either case,
    whether its first line ends with \\r, and its bytes."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["file", "size", "start", "fresh", "inside", "cr", "bytes"]
        at, ends, cr, total = None, [False, True], False, 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in names[:3]], axis=1)
            bits = [batch.column(c).to_numpy(zero_copy_only=False) for c in names[3:]]
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                key = tuple(keys[a].tolist())
                if key != at:
                    if at is not None:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, (*at, *ends, cr, total), strict=True))])
                    at, ends, cr, total = key, [False, True], bool(bits[2][a]), 0
                total += int(bits[3][a:b].sum())
                fresh, inside = bits[0][a:b], bits[1][a:b]
                same = np.flatnonzero(fresh == inside)  # such a line ends alike in either case
                last = int(same[-1]) if len(same) else -1
                turns = bool(np.count_nonzero(fresh[last + 1 :] & ~inside[last + 1 :]) % 2)
                ends = [(bool(fresh[last]) if last >= 0 else e) ^ turns for e in ends]
        if at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*at, *ends, cr, total), strict=True))])

    return run


def _line_end_last(total: Column | int, size: Column | int) -> Column | bool:
    """Whether lines of so many bytes, their ends included, fill a file of that
    size; the text reader takes a byte order mark (3 bytes) away."""
    return (total == size) | (total == size - 3)


def range_states(lines: DataFrame) -> DataFrame:
    """A row per range: ``opened`` and ``closed``, whether a value is open where
    it begins and where it ends (0 or 1), whether the lines of its file end with
    \\r\\n, as the first one does, whether it is the last range of a file with a
    line end behind the last line, and the number of its file's ranges."""
    shape = "file bigint, size bigint, start bigint, fresh boolean, inside boolean, cr boolean, bytes bigint"
    ends = lines.select(*_KEY, "fresh", "inside", "cr", "bytes").mapInArrow(_range_ends(), shape)
    before = Window.partitionBy("file", "size").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "size").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("file", "size")
    turn = (F.col("fresh") & ~F.col("inside")).cast("long")
    fixed = F.when(F.col("fresh") == F.col("inside"), F.struct(F.col("fresh").cast("long").alias("value"), F.sum(turn).over(upto).alias("turns")))
    counted = ends.select("*", F.coalesce(F.sum(turn).over(before), F.lit(0)).alias("turns"), fixed.alias("fixed"))
    last = F.last("fixed", ignorenulls=True).over(before)
    opened = F.pmod(F.coalesce(last["value"], F.lit(0)) + F.col("turns") - F.coalesce(last["turns"], F.lit(0)), F.lit(2)).cast("int")
    ended = _line_end_last(F.sum("bytes").over(whole), F.col("size")) & (F.col("start") == F.max("start").over(whole))
    scanned = counted.select(*_KEY, "fresh", "inside", opened.alias("opened"), F.max(F.col("cr") & (F.col("start") == 0)).over(whole).alias("crlf"), ended.alias("ended"), F.count("*").over(whole).alias("ranges"))
    return scanned.select(*_KEY, "opened", F.when(F.col("opened") == 1, F.col("inside")).otherwise(F.col("fresh")).cast("int").alias("closed"), "crlf", "ended", "ranges")


def _records(states: dict[tuple[int, int, int], tuple[int, bool, bool]], header: list[str]):
    """Tasks: the records and parts of records of each range, in order."""

    def run(batches: Iterator) -> Iterator:
        import csv

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        schema = pa.schema([("file", pa.int64()), ("size", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()), ("crlf", pa.bool_()), ("record", pa.string())])

        def rows(key, kind, texts):
            n = len(texts)
            columns = [pa.array(np.full(n, x, np.int64)) for x in key] + [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, crlf)), texts.cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def check_header(text):
            names = next(csv.reader([text.lstrip("﻿").rstrip("\r")], doublequote=True), [])
            if [x.lower() for x in names] != [x.lower() for x in header]:
                raise ValueError(f"CSV header does not match the schema: {names} instead of {header}")

        key, state, crlf, ended, seen, first, pending, own = None, 0, False, None, 0, False, [], True
        # pending: lines of an open record; own: it began in this range; first: no record of this file yet

        def finish():
            if pending:
                if state and (seen in (key[1], key[1] - 3) if ended is None else ended):
                    pending.append("")  # the file's last line end belongs to the value that is still open
                text = "\n".join(pending)
                if key in states:
                    yield rows(key, TAIL if own else MIDDLE, pa.array([text]))
                else:  # no other range can close it
                    yield closed(text)

        def closed(text):
            nonlocal first
            if own and first:
                check_header(text)
                first = False
                return rows(key, HEADER, pa.array([text]))
            return rows(key, RECORD if own else HEAD, pa.array([text]))

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("file", "size", "start")], axis=1)
            bits = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fresh", "inside", "bytes")]
            values = batch.column("value")
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if tuple(keys[a].tolist()) != key:
                    yield from finish()
                    key = tuple(keys[a].tolist())
                    if key[2] and key not in states:
                        raise RuntimeError("the CSV files changed while they were read")
                    state, crlf, ended = states.get(key) or (0, bool(batch.column("cr")[a].as_py()), None)
                    seen, pending, first = 0, [], key[2] == 0
                    own = not state
                fresh, inside = bits[0][a:b], bits[1][a:b]
                seen += int(bits[2][a:b].sum())
                n = b - a
                place = np.maximum.accumulate(np.where(fresh == inside, np.arange(n), -1))
                turns = np.cumsum(fresh & ~inside)
                known = place >= 0
                after = np.where(known, fresh[place], bool(state)) ^ ((turns - np.where(known, turns[place], 0)) % 2 == 1)
                begin = np.flatnonzero(~np.concatenate([[bool(state)], after[:-1]]))
                state = int(after[-1])
                part = values.slice(a, n)
                lead = int(begin[0]) if len(begin) else n
                if lead:
                    pending += part.slice(0, lead).to_pylist()
                if not len(begin):
                    if state == 0:
                        yield closed("\n".join(pending))
                        pending, own = [], True
                    continue
                if pending:
                    yield closed("\n".join(pending))
                    pending = []
                own = True
                if state:
                    pending = part.slice(int(begin[-1])).to_pylist()
                    stop, begin = int(begin[-1]), begin[:-1]
                else:
                    stop = n
                if not len(begin):
                    continue
                if len(begin) == stop - lead:
                    texts = part.slice(lead, len(begin))
                else:
                    bounds = np.append(begin, stop).astype(np.int32) - lead
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), part.slice(lead, stop - lead)), "\n")
                if first:
                    check_header(texts[0].as_py())
                    yield rows(key, HEADER, texts.slice(0, 1))
                    texts, first = texts.slice(1), False
                if len(texts):
                    yield rows(key, RECORD, texts)
        yield from finish()

    return run


def read_records(spark: SparkSession, paths: Sequence[str], header: Sequence[str]) -> DataFrame:
    """One row per CSV record of the files, its text in ``record``, and whether
    the lines of its file end with \\r\\n; the first record of every file has to
    be the header."""
    lines = _lines(spark, paths)
    states = range_states(lines).where("ranges > 1").collect()
    opened = {(r["file"], r["size"], r["start"]): (r["opened"], r["crlf"], r["ended"]) for r in states}
    shape = "file bigint, size bigint, start bigint, kind int, crlf boolean, record string"
    run = _records(opened, list(header))
    records = lines.mapInArrow(run, shape).where(F.col("kind") == RECORD).select("crlf", "record")
    crossing = [(r["file"], r["size"], r["start"]) for r in states if r["opened"] or r["closed"]]
    if crossing:
        places = spark.createDataFrame(crossing, "file bigint, size bigint, start bigint")
        parts = lines.join(F.broadcast(places), list(_KEY), "left_semi").mapInArrow(run, shape).where(F.col("kind") >= HEAD)
        order = Window.partitionBy("file", "size").orderBy("start", "kind")
        chain = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
        pieces = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
        joined = parts.withColumn("chain", chain).groupBy("file", "size", "chain").agg(F.first("crlf").alias("crlf"), F.array_join(pieces["record"], "\n").alias("record"))
        records = records.unionByName(joined.select("crlf", "record"))
    whole = F.regexp_replace("record", r"\r\z", "")
    return records.select("crlf", F.when(F.col("crlf"), whole).otherwise(F.col("record")).alias("record"))


def read_ranges(spark: SparkSession, paths: Sequence[str], schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The rows that Spark's CSV reader gives for ``schema`` (header, quotes
    doubled, malformed lines kept) with line breaks in quoted values."""
    corrupt = options["columnNameOfCorruptRecord"]
    header = [f.name for f in schema if f.name != corrupt]
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    records = read_records(spark, paths, header).where("record <> ''")
    # as the parser has it: \r\n is \n in the values of a file with such line ends, not in its malformed lines
    unix = F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    parsed = records.select("record", F.from_csv(unix, ddl, {**options, "lineSep": "\n"}).alias("parsed"))
    bad = F.when(F.col("parsed").getField(corrupt).isNotNull(), F.regexp_replace("record", r"\r?\n\z", ""))
    return parsed.select(*(F.col("parsed").getField(c).alias(c) for c in header), bad.alias(corrupt))


def has_large_file(spark: SparkSession, paths: Sequence[str], size: int) -> bool:
    """Whether a file is larger than ``size`` bytes: a look at the folders' total,
    then, where that is larger, a job that lists files without reading them."""
    context = spark.sparkContext
    conf = context._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(path) or [])
    if total <= size:
        return False
    files = spark.read.format("binaryFile").load(list(paths))
    packed = F.lower("path").rlike(r"\.(gz|zst|deflate|lz4|snappy)$")
    return not files.where((F.col("length") > size) & ~packed).select("path").isEmpty()
