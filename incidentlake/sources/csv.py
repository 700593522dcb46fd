"""Raw CSV source for the Bronze layer."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from incidentlake.schemas import CORRUPT_RECORD, RAW_COLUMNS
from incidentlake.sources.csv_ranges import has_large_file, read_ranges


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def csv_options(multiline: bool = True) -> dict[str, str]:
    """Reader options for the raw log, shared by batch and streaming reads.

    RFC 4180 quoting (a quote inside a quoted field is doubled); empty text and
    quoted "" are NULL (``emptyValue`` is left alone on purpose); malformed
    lines are kept and flagged in ``_corrupt_record``. Quoted line breaks are
    part of a value unless ``multiline`` is off. Every file's header is checked
    against the declared names, so a reordered file raises instead of shifting
    columns.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "quote": '"',
        "escape": '"',
        "nullValue": "",
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        "encoding": "UTF-8",
    }


def raw_read_schema(columns: Sequence[str] = RAW_COLUMNS) -> T.StructType:
    """All-text schema of the raw columns plus the corrupt-record column."""
    return T.StructType(
        [T.StructField(c, T.StringType(), True) for c in columns]
        + [T.StructField(CORRUPT_RECORD, T.StringType(), True)]
    )


def _reader(spark: SparkSession, multiline: bool):
    return spark.read.options(**csv_options(multiline))


def _read_first_line(jvm, fs, codecs, status) -> str | None:
    name = status.getPath().getName()
    if not status.isFile() or name.startswith(("_", ".")) or status.getLen() == 0:
        return None
    raw = fs.open(status.getPath())
    try:
        codec = codecs.getCodec(status.getPath())
        stream = codec.createInputStream(raw) if codec else raw
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()


def _first_line(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """First line of a data file under ``paths``, read through the Hadoop
    FileSystem API: any URI scheme, globs, directories, compression codecs.
    Reads one line on the driver; no Spark job. Any file will do, since the
    reader checks every file's header against these names."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        for st in fs.globStatus(hpath) or []:
            # an iterator: a folder of millions of files is not listed whole
            files = fs.listLocatedStatus(st.getPath())
            while files.hasNext():
                line = _read_first_line(jvm, fs, codecs, files.next())
                if line:
                    return line.lstrip("\ufeff")
    return None


def header_columns(spark: SparkSession, paths: str | Sequence[str], multiline: bool = True):
    """Column names from the header line of the first file (reads one line).

    A header with a quoted line break falls back to Spark's own header
    inference (a one-task job)."""
    plist = _paths(paths)
    line = _first_line(spark, plist)
    if line is None or line.count('"') % 2:
        return _reader(spark, multiline).csv(plist).columns
    return next(csv.reader([line], quotechar='"', doublequote=True))


def _range_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` in bytes."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def read_raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    multiline: bool = True,
    columns: Sequence[str] | None = None,
    from_header: bool = False,
    infer_types: bool = False,
) -> DataFrame:
    """Read raw CSV log files as text columns plus ``_corrupt_record``.

    * Columns are declared, not inferred: every value lands as text and typing
      happens in Silver, so one bad value can never retype or drop a column.
      ``infer_types=True`` takes the types from Spark's inference (one extra
      pass); malformed lines are flagged all the same.
    * The header is checked against the declared names in every file
      (``enforceSchema=false``); a reordered file raises instead of silently
      shifting columns. ``from_header=True`` takes the names and order from
      the first file's header instead (one line read).
    * Malformed lines (too many or too few fields) are kept, with the original
      line in ``_corrupt_record``, so they can be counted and stored apart
      instead of vanishing.
    * Quoted line breaks belong to the value. Where a file is larger than
      ``spark.sql.files.maxPartitionBytes``, files are read by byte ranges that
      find their record boundaries themselves (``sources.csv_ranges``); else a
      file is a task, which saves the first pass. ``multiline=False`` is for
      logs known to hold one line per record; the Bronze job then fails if a
      rejected line shows that a quoted break was cut.
    """
    plist = _paths(paths)
    if from_header:
        names = header_columns(spark, plist, multiline)
        missing = [c for c in (columns or RAW_COLUMNS) if c not in names]
        if missing:
            raise ValueError(f"CSV header lacks columns: {missing}")
    else:
        names = list(columns or RAW_COLUMNS)
    reader = _reader(spark, multiline)
    if infer_types:
        inferred = reader.option("inferSchema", True).csv(plist).schema
        kept = [f for f in inferred if f.name != CORRUPT_RECORD]
        schema = T.StructType([*kept, T.StructField(CORRUPT_RECORD, T.StringType(), True)])
        return _reader(spark, multiline).schema(schema).csv(plist)
    if multiline and has_large_file(spark, plist, _range_bytes(spark)):
        return read_ranges(spark, plist, raw_read_schema(names), csv_options(multiline))
    return reader.schema(raw_read_schema(names)).csv(plist)
