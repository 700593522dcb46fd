"""Raw CSV reader (FIXTURES.md §4 cases), layer readers and source discovery."""

import pytest
from pyspark.sql import functions as F

from incidentlake.operators.bronze import accepted, land, load_profile, rejected
from incidentlake.sinks import write_layer
from incidentlake.sources import first_existing, read_layer, read_raw_csv
from incidentlake.sources.csv import header_columns

COLS = ["Timestamp", "Attack Type", "Source Port", "Payload Data", "Alerts/Warnings", "Anomaly Scores"]
HEADER = ",".join(COLS)
ROWS = [
    '2024-01-01 00:00:00,DDoS,80,"a, b",x,1.5',
    '2024-01-01 00:00:01,DDoS,80,"line1\nline2",x,1.5',
    '2024-01-01 00:00:02,DDoS,80,"",x,1.5',
    "2024-01-01 00:00:03,DDoS,80,  ,x,1.5",
    '2024-01-01 00:00:04,DDoS,80,"q""uote",x,1.5',
    "bad,DDoS,80,p,x,1.5",
    "2024-01-01 00:00:06,DDoS,80,p,x,1.5,extra",
    "2024-01-01 00:00:07,DDoS,80",
    "2024-01-01 00:00:08,DDoS,80,NA,x,1.5",
]


def write(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    return path


def test_csv_dirt_cases(spark, scratch):
    p = write(f"{scratch}/log.csv", HEADER, ROWS)
    df = read_raw_csv(spark, p, multiline=True, columns=COLS)
    good = {r["Timestamp"]: r["Payload Data"] for r in accepted(df).collect()}
    assert good == {
        "2024-01-01 00:00:00": "a, b",
        "2024-01-01 00:00:01": "line1\nline2",
        "2024-01-01 00:00:02": None,
        "2024-01-01 00:00:03": "  ",
        "2024-01-01 00:00:04": 'q"uote',
        "bad": "p",
        "2024-01-01 00:00:08": "NA",
    }
    bad = [r["_corrupt_record"] for r in rejected(df).collect()]
    assert sorted(bad) == sorted([ROWS[6], ROWS[7]])


def test_load_profile_counts_stored_bronze(spark, scratch):
    p = write(f"{scratch}/log.csv", HEADER, ROWS)
    write_layer(land(read_raw_csv(spark, p, multiline=True, columns=COLS)), f"{scratch}/bronze")
    prof = load_profile(read_layer(spark, f"{scratch}/bronze")).first()
    assert (prof["rows"], prof["rejected"]) == (7, 2)
    stored = read_layer(spark, f"{scratch}/bronze")
    assert "_ingested_at" in stored.columns
    assert dict(stored.dtypes)["_ingested_at"] == "timestamp"


def test_splittable_mode_without_line_breaks(spark, scratch):
    rows = [r for r in ROWS if "\n" not in r]
    p = write(f"{scratch}/log.csv", HEADER, rows)
    df = read_raw_csv(spark, p, multiline=False, columns=COLS)
    # Counting straight off the CSV scan is refused by Spark (only the corrupt
    # column would be read), so whole rows are collected here.
    assert len(accepted(df).collect()) == 6
    assert len(rejected(df).collect()) == 2


def test_header_mismatch_raises(spark, scratch):
    swapped = [COLS[1], COLS[0]] + COLS[2:]
    p = write(f"{scratch}/log.csv", ",".join(swapped), ["DDoS,2024-01-01 00:00:00,80,p,x,1.5"])
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, p, columns=COLS).collect()


def test_columns_from_header_follow_file_order(spark, scratch):
    swapped = [COLS[1], COLS[0]] + COLS[2:]
    p = write(f"{scratch}/log.csv", ",".join(swapped), ["DDoS,2024-01-01 00:00:00,80,p,x,1.5"])
    assert header_columns(spark, p) == swapped
    row = read_raw_csv(spark, p, columns=COLS, from_header=True).first()
    assert (row["Timestamp"], row["Attack Type"]) == ("2024-01-01 00:00:00", "DDoS")
    with pytest.raises(ValueError, match="lacks"):
        read_raw_csv(spark, p, columns=COLS + ["Protocol"], from_header=True)


def test_infer_types_option(spark, scratch):
    p = write(f"{scratch}/log.csv", HEADER, [r for r in ROWS if "\n" not in r][:2])
    df = read_raw_csv(spark, p, columns=COLS, infer_types=True)
    assert dict(df.dtypes)["Source Port"] == "int"
    assert "_corrupt_record" in df.columns
    p = write(f"{scratch}/dirt.csv", HEADER, ROWS)
    flagged = [r["_corrupt_record"] for r in rejected(read_raw_csv(spark, p, columns=COLS, infer_types=True)).collect()]
    assert sorted(flagged) == sorted([ROWS[6], ROWS[7]])


def test_first_existing(spark, scratch):
    p = write(f"{scratch}/b.csv", HEADER, [])
    assert first_existing(spark, [f"{scratch}/missing.csv", p]) == p
    with pytest.raises(FileNotFoundError):
        first_existing(spark, [f"{scratch}/missing.csv"])


def test_quoted_empty_is_null_but_blank_is_kept(spark, scratch):
    p = write(f"{scratch}/log.csv", HEADER, ['2024-01-01 00:00:00,"",80,"",  ,'])
    r = read_raw_csv(spark, p, columns=COLS).select(*[F.col(f"`{c}`") for c in COLS]).first()
    assert r["Attack Type"] is None and r["Payload Data"] is None
    assert r["Alerts/Warnings"] == "  " and r["Anomaly Scores"] is None


def test_csv_writer_keeps_surrounding_spaces(spark, scratch):
    df = spark.createDataFrame([(" tcp ", None, "a,\"b\"")], "p string, q string, r string")
    from incidentlake.sinks import write_csv

    write_csv(df, f"{scratch}/out")
    back = read_raw_csv(spark, f"{scratch}/out", columns=["p", "q", "r"]).first()
    assert (back["p"], back["q"], back["r"]) == (" tcp ", None, 'a,"b"')


def test_read_bronze_and_rejects_split_stored_rows(spark, scratch):
    from incidentlake.sources import read_bronze, read_rejects

    p = write(f"{scratch}/log.csv", HEADER, ROWS)
    write_layer(land(read_raw_csv(spark, p, multiline=True, columns=COLS)), f"{scratch}/bronze")
    good = read_bronze(spark, f"{scratch}/bronze")
    assert "_corrupt_record" not in good.columns and good.count() == 7
    assert sorted(r["_corrupt_record"] for r in read_rejects(spark, f"{scratch}/bronze").collect()) == sorted(
        [ROWS[6], ROWS[7]])


def test_header_read_handles_compression_and_quoted_names(spark, scratch):
    from incidentlake.sinks import write_csv

    df = spark.createDataFrame([("1", "x")], "`a,b` string, `c` string")
    (df.write.option("header", True).option("compression", "gzip").csv(f"{scratch}/gz"))
    assert header_columns(spark, f"{scratch}/gz") == ["a,b", "c"]
    assert header_columns(spark, f"{scratch}/gz/*.csv.gz") == ["a,b", "c"]
    back = read_raw_csv(spark, f"{scratch}/gz", columns=["a,b", "c"], from_header=True).first()
    assert (back["a,b"], back["c"]) == ("1", "x")
    write_csv(df, f"{scratch}/plain")
    assert header_columns(spark, [f"{scratch}/missing-*", f"{scratch}/plain"]) == ["a,b", "c"]
