"""Files read by byte ranges against Spark's reader with one task per file: random
quotes, line breaks inside values, rejects, ranges smaller than a record."""

import random

import pytest
from pyspark.sql import functions as F

from incidentlake.schemas import CORRUPT_RECORD
from incidentlake.sources import read_raw_csv
from incidentlake.sources.csv import csv_options, raw_read_schema
from incidentlake.sources.csv_ranges import _lines as lines_of
from incidentlake.sources.csv_ranges import open_at_end, range_states, read_ranges

COLUMNS = ["a", "b c", "d"]


def field(rng):
    body = "".join(rng.choice(['x', 'é', ' ', ',', '""', '\n', 'word', '\r\n', '1']) for _ in range(rng.randrange(0, 12)))
    kind = rng.random()
    if kind < 0.55:
        return f'"{body}"'
    if kind < 0.9:
        return "".join(rng.choice("xyz 12é") for _ in range(rng.randrange(0, 9)))
    return rng.choice(['p"q', '"x"y', ' "z"', '"a" b', 'x""y'])  # stray quotes


def table(rng, rows, end, broken=0.1):
    out = [",".join(COLUMNS)]
    for _ in range(rows):
        n = 3 if rng.random() > broken else rng.choice([1, 2, 4, 5])
        out.append(",".join(field(rng) for _ in range(n)))
    return end.join(out) + (end if rng.random() < 0.5 else "")


def plain(spark, path):
    return spark.read.options(**csv_options()).schema(raw_read_schema(COLUMNS)).csv(path)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.select("a", "`b c`", "d", CORRUPT_RECORD).collect()), key=str)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_the_reader_with_one_task(spark, scratch, small_ranges, seed):
    rng = random.Random(seed)
    for k in range(3):
        with open(f"{scratch}/f{k}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(table(rng, rng.randrange(1, 60), "\n" if seed % 3 else "\r\n"))
    want = sorted_rows(plain(spark, scratch))
    got = read_raw_csv(spark, scratch, columns=COLUMNS)
    assert sorted_rows(got) == want
    assert any(r[3] for r in want) and any(r[0] and "\n" in r[0] for r in want)


def test_values_longer_than_ranges_and_an_open_end(spark, scratch, small_ranges):
    with open(f"{scratch}/f.csv", "w", newline="") as f:
        f.write("a,b c,d\n" + 'x,"' + "long\n" * 200 + '",y\n' + '1,"' + 'q""\n' * 90 + '",2\n' + '"5",6,7\n' + '"never closed\n' * 1)
    got = sorted_rows(read_raw_csv(spark, scratch, columns=COLUMNS))
    assert got == sorted_rows(plain(spark, scratch))
    assert ("x", "long\n" * 200, "y", None) in got
    states = range_states(lines_of(spark, [scratch])).collect()
    assert len(states) > 10 and sum(r["opened"] for r in states) > 5


def test_open_end_of_a_small_file_beside_a_large_one(spark, scratch, small_ranges):
    for name, text in (("f", '1,"x\ny",2\n' * 60), ("g", '3,"open\n'), ("h", '3,"open')):
        with open(f"{scratch}/{name}.csv", "w", newline="") as f:
            f.write("a,b c,d\n" + text)
    assert sorted_rows(read_raw_csv(spark, scratch, columns=COLUMNS)) == sorted_rows(plain(spark, scratch))


def test_a_record_over_many_arrow_batches(spark, scratch, small_ranges):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        with open(f"{scratch}/f.csv", "w", newline="") as f:
            f.write("a,b c,d\n" + ('x,"' + "long\n" * 9 + '",y\n' + "1,2,3\n" * 5) * 12)
        assert sorted_rows(read_raw_csv(spark, scratch, columns=COLUMNS)) == sorted_rows(plain(spark, scratch))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_file_is_read_by_many_tasks(spark, scratch):
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("a"), F.lit('say "hi"\nthere').alias("b c"), F.lit("z").alias("d"))
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{scratch}/one")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        got = read_raw_csv(spark, f"{scratch}/one", columns=COLUMNS)
        assert got.select(F.spark_partition_id()).distinct().count() > 4
        assert got.where(F.col(CORRUPT_RECORD).isNull()).agg(F.count("a"), F.count_distinct("a"), F.min("`b c`"), F.max("`b c`")).first() == (60_000, 60_000, 'say "hi"\nthere', 'say "hi"\nthere')
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_files_stay_with_the_reader(spark, scratch):
    with open(f"{scratch}/f.csv", "w") as f:
        f.write('a,b c,d\n1,"x\ny",2\n')
    got = read_raw_csv(spark, scratch, columns=COLUMNS)
    assert "csv" in got._jdf.queryExecution().toString().lower() and "MapInArrow" not in got._jdf.queryExecution().toString()
    assert got.count() == 1


def test_headers_are_checked_in_every_file(spark, scratch, small_ranges):
    for name, header in (("f", "a,b c,d"), ("g", "b c,a,d")):
        with open(f"{scratch}/{name}.csv", "w") as f:
            f.write(header + "\n" + "1,2,3\n" * 60)
    with pytest.raises(Exception, match="header does not match"):
        read_raw_csv(spark, scratch, columns=COLUMNS).count()


def test_empty_files_and_blank_lines(spark, scratch, small_ranges):
    open(f"{scratch}/e.csv", "w").close()
    with open(f"{scratch}/h.csv", "w") as f:
        f.write("A,B c,D\n")
    with open(f"{scratch}/f.csv", "w") as f:
        f.write("a,b c,d\n\n1,2,3\n\n\n   \n" + '"",,""\n' * 50 + "4,5,6")
    assert sorted_rows(read_ranges(spark, [scratch], raw_read_schema(COLUMNS), csv_options())) == sorted_rows(plain(spark, scratch))


def test_line_states(spark):
    """What is open at the end of a line: if nothing was at its beginning, and if
    a value was (None: the parser would not get there)."""
    cases = {
        "": (False, True), "a,b": (False, True), '"a': (True, False), 'a,"b': (True, False), 'x"': (False, False),
        '""': (False, True), '"a""': (True, False), '"a","': (True, None), 'p"q,"r': (True, None), '"x"y,"z': (True, None),
    }
    rows = spark.createDataFrame([(c,) for c in cases], "v string")
    for line, fresh, inside in rows.select("v", *open_at_end(F.col("v"))).collect():
        assert fresh == cases[line][0] and cases[line][1] in (None, inside), line
