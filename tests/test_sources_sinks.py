"""Readers and writers: options, errors, round trips, month overwrites."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rategauge.operators import add_tracking
from rategauge.schemas import AVERAGE_CSV, AVERAGE_TABLE, RANKED_CSV, RAW_LISTING
from rategauge.sinks import overwrite_months, overwrite_partition, write_csv, write_parquet
from rategauge.sources import listings as listing_source
from rategauge.sources import (
    month_file,
    read_average_table,
    read_listings,
    read_over_under_tables,
    read_ranked_table,
    require_rows,
)
from rategauge.sources.guards import reading
from tests.helpers import plan, rows

HEADER = "id,name,neighbourhood_cleansed,price,last_scraped\n"


def csv_file(tmp_path, body, name="listings_2025-01.csv", header=HEADER):
    path = tmp_path / name
    path.write_text(header + body)
    return str(path)


def test_month_file():
    assert month_file("s3a://bucket/in/", "2025-01") == "s3a://bucket/in/listings_2025-01.csv"
    assert month_file("in", "2025-01", "homes", "txt") == "in/homes_2025-01.txt"


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = csv_file(tmp_path, '1,"He said ""hi"",\nthere",Soho,"$1,234.50",2025-01-02\n')
    df = read_listings(spark, path)
    assert rows(df) == [("1", 'He said "hi",\nthere', "Soho", "$1,234.50", "2025-01-02")]
    assert {t for _, t in df.dtypes} == {"string"}


def test_csv_reads_only_the_asked_columns(spark, tmp_path):
    path = csv_file(tmp_path, "1,a,Soho,$1,2025-01-02\n")
    text = plan(read_listings(spark, path).select("id", "price"))
    assert "ReadSchema: struct<id:string,price:string>" in text


def test_csv_schema_and_inference(spark, tmp_path):
    path = csv_file(tmp_path, "1,a,Soho,12.5,2025-01-02\n")
    inferred = dict(read_listings(spark, path, infer_schema=True).dtypes)
    assert (inferred["id"], inferred["price"], inferred["last_scraped"]) == ("int", "double", "date")
    schema = StructType([StructField(n, StringType()) for n in HEADER.strip().split(",")])
    assert rows(read_listings(spark, path, schema=schema)) == [("1", "a", "Soho", "12.5", "2025-01-02")]


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = csv_file(tmp_path, "1,Soho,$1,2025-01-02\n", header="id,price,neighbourhood_cleansed,last_scraped\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_listings(spark, path, schema=RAW_LISTING).collect()


def test_many_files_and_single_line_reading(spark, tmp_path):
    first = csv_file(tmp_path, "1,a,Soho,$1,2025-01-02\n")
    second = csv_file(tmp_path, "2,b,Soho,$2,2025-02-02\n", "listings_2025-02.csv")
    assert rows(read_listings(spark, [first, second]), "id") == [("1",), ("2",)]
    assert rows(read_listings(spark, f"{tmp_path}/listings_*.csv", multi_line=False), "id") == [("1",), ("2",)]


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        read_listings(spark, "/nonexistent/listings_2031-01.csv")
    with pytest.raises(FileNotFoundError):
        read_average_table(spark, "/nonexistent/table")


def test_other_read_errors_keep_their_cause():
    with pytest.raises(RuntimeError) as caught:
        with reading("x"):
            raise KeyError("boom")
    assert isinstance(caught.value.__cause__, KeyError)


def test_empty_input_is_refused(spark, tmp_path):
    df = read_listings(spark, csv_file(tmp_path, ""))
    with pytest.raises(ValueError):
        require_rows(df)
    filled = read_listings(spark, csv_file(tmp_path, "1,a,b,c,d\n", "two.csv"))
    assert require_rows(filled) is filled


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        read_average_table(spark, str(tmp_path), fmt="xls")


NASTY = [
    ("1", 'say "hi"', "a,b", "  padded  "),
    ("2", "line\nbreak", "back\\slash", "\\"),
    ("3", "quote at end\"", '"', "\ttab\t"),
    ("4", None, "\\\"mixed\\\",", "é £ 漢"),
]


@pytest.mark.parametrize("single", [True, False])
def test_csv_round_trip_keeps_text(spark, tmp_path, single):
    df = spark.createDataFrame(NASTY, RAW_LISTING).repartition(3)
    path = write_csv(df, str(tmp_path / "out"), single_file=single)
    assert rows(read_listings(spark, path, schema=RAW_LISTING)) == rows(df)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1 if single else len(parts) > 1


def test_csv_turns_empty_text_into_null(spark, tmp_path):
    df = spark.createDataFrame([("1", "", "x", "y")], RAW_LISTING)
    assert rows(read_listings(spark, write_csv(df, str(tmp_path / "o")))) == [("1", None, "x", "y")]


def test_writers_replace_what_was_there(spark, tmp_path):
    for write, read in ((write_csv, read_listings), (write_parquet, lambda s, p: s.read.parquet(p))):
        path = str(tmp_path / write.__name__)
        write(spark.createDataFrame([(10, True), (20, False)], "id long, flag boolean"), path)
        write(spark.createDataFrame([(3, True)], "id long, flag boolean"), path)
        assert [str(r.id) for r in read(spark, path).collect()] == ["3"]


def test_write_errors_are_wrapped(spark, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("not a directory")
    df = spark.createDataFrame([(30, True)], "code long, flag boolean")
    for write in (write_csv, write_parquet):
        with pytest.raises(RuntimeError) as caught:
            write(df, f"{blocker}/sub")
        assert caught.value.__cause__ is not None


MONTHLY = "id int, year_month string"


def counts(spark, path):
    stored = spark.read.schema(MONTHLY).parquet(path)
    return dict(rows(stored.groupBy("year_month").count()))


def months_frame(spark, sizes):
    data = [(i, m) for m, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, MONTHLY)


def test_month_overwrite_is_idempotent_and_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(months_frame(spark, {"2025-01": 3, "2025-02": 4}), path, ["year_month"])
    newer = months_frame(spark, {"2025-01": 99, "2025-02": 7, "2025-03": 2})
    for _ in range(2):
        overwrite_months(newer, path, ["2025-02", "2025-03"])
        assert counts(spark, path) == {"2025-01": 3, "2025-02": 7, "2025-03": 2}


def test_month_that_became_empty_is_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(months_frame(spark, {"2025-01": 3, "2025-02": 4}), path, ["year_month"])
    overwrite_months(months_frame(spark, {"2025-01": 1}), path, ["2025-01", "2025-02"])
    assert counts(spark, path) == {"2025-01": 1}
    overwrite_months(months_frame(spark, {}), path, ["2025-01"])
    assert counts(spark, path) == {}


def test_partition_overwrite_drops_stale_subpartitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for sizes in ({"a": 2, "b": 3}, {"a": 1}):
        overwrite_partition(months_frame(spark, sizes), path, "run_month", "2025-01", ["year_month"])
    overwrite_partition(months_frame(spark, {"z": 5}), path, "run_month", "2025-02", ["year_month"])
    assert counts(spark, path) == {"a": 1, "z": 5}


def test_month_filter_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(months_frame(spark, {"2025-01": 3, "2025-02": 4}), path, ["year_month"])
    text = plan(spark.read.schema(MONTHLY).parquet(path).filter(F.col("year_month") == "2025-01"))
    assert "PartitionFilters: [isnotnull(year_month" in text


def test_fixed_table_schemas():
    assert [f.dataType.simpleString() for f in AVERAGE_CSV] == [
        "string", "string", "int", "decimal(10,2)", *["string"] * 4]
    assert [f.dataType.simpleString() for f in RANKED_CSV] == [
        *["string"] * 5, "decimal(10,2)", "int", *["decimal(10,2)"] * 3, *["string"] * 4]
    assert AVERAGE_TABLE.names == AVERAGE_CSV.names
    assert all(f.nullable for f in [*AVERAGE_CSV, *RANKED_CSV])


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_tables(spark, tmp_path, multi_line):
    when, tail = "2031-08-01 00:00:00", ("f.csv", "adhoc", "night_7")
    average = spark.createDataFrame([("2031-07", "Quay, old", 3, 9.5, when, *tail)], AVERAGE_CSV.names)
    path = write_csv(average, str(tmp_path / "a"))
    read = read_average_table(spark, path, fmt="csv", multi_line=multi_line)
    assert read.schema == AVERAGE_CSV
    assert rows(read, "neighbourhood_cleansed", F.col("avg_price").cast("string")) == [("Quay, old", "9.50")]

    ranked = spark.createDataFrame(
        [("2031-07", "Quay", f"k{i}", f"{i}.00", "2031-07-09", i, 3, 9.5, i - 9.5, 1.5, when, *tail) for i in (4, 6, 40)],
        RANKED_CSV.names,
    )
    paths = [write_csv(ranked, str(tmp_path / side)) for side in ("over", "under")]
    for df in read_over_under_tables(spark, *paths, fmt="csv", multi_line=multi_line):
        assert df.schema == RANKED_CSV and rows(df, RANKED_CSV.names[2]) == [("k4",), ("k40",), ("k6",)]
    with pytest.raises(ValueError):
        read_ranked_table(spark, paths[0], "sideways", fmt="csv")


def test_tracking(spark):
    from datetime import datetime

    df = spark.createDataFrame([(1,)], "id int")
    tracked = add_tracking(df, "/in/listings_2025-01.csv", "batch_1", processed_at=datetime(2025, 1, 2))
    assert tracked.columns == ["id", "processing_timestamp", "source_file", "run_type", "final_log_file_name"]
    row = tracked.first()
    assert (row.source_file, row.run_type, row.final_log_file_name) == (
        "listings_2025-01.csv", "scheduled", "batch_1")
    assert row.processing_timestamp == datetime(2025, 1, 2)
    assert add_tracking(df, "x", "b").first().processing_timestamp is not None


LINES = [
    ("a,b,c", True),
    ('"a","b, c",""', True),
    ('"say ""hi""",2', True),
    ('"",', True),
    ('1,"opens', False),
    ('closes",2', False),
    ('5" pipe,"abc', False),
    ('"a"b,c', False),
    ('"a""', False),
    (' "a"', False),
    ("", True),
    ('"' + '""' * 200_000 + '",1', True),
    ('"' + "x" * 200_000, False),
]


def test_whole_lines(spark):
    frame = spark.createDataFrame(LINES, "value string, want boolean")
    got = frame.select("want", listing_source.is_whole_line(F.col("value")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_data_decide_how_files_are_read(spark, tmp_path, small_splits):
    plain = "id,name\n" + "".join(f'{k},"n, ""{k}"""\n' for k in range(2000))
    broken = "id,name\n" + "".join(f'{k},"line\nbreak {k}"\n' for k in range(2000, 4000))
    (tmp_path / "plain.csv").write_text(plain)
    (tmp_path / "broken.csv").write_text(broken)
    (tmp_path / "small.csv").write_text('id,name\n9999,"a\nb"\n')
    path = str(tmp_path)
    found = [[os.path.basename(f) for f in files] for files in listing_source.broken_files(spark, [path])]
    assert [sorted(files) for files in found] == [["broken.csv", "small.csv"], ["plain.csv"]]
    read = read_listings(spark, path)
    assert rows(read) == rows(read_listings(spark, path, multi_line=True))
    assert read.count() == 4001
    split = read_listings(spark, f"{path}/plain.csv")
    assert split.rdd.getNumPartitions() > 5 and split.count() == 2000
    assert read_listings(spark, f"{path}/broken.csv").rdd.getNumPartitions() == 1


def test_monthly_runs_split_plain_files(spark, tmp_path, small_splits):
    from rategauge.plans import MonthlyRun, run_month

    path = tmp_path / "listings_2025-01.csv"
    path.write_text("id,neighbourhood_cleansed,price,last_scraped\n" + "".join(f"{k},Soho,${k + 1}.00,2025-01-03\n" for k in range(2000)))
    store = run_month(spark, MonthlyRun("2025-01", str(path), str(tmp_path / "out"), "batch"))
    assert len(store.classified("accepted").inputFiles()) > 5
