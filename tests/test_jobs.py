"""Sources, sinks, declared schemas and the four jobs."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.plans.daily import COLUMNS, daily
from daybook.plans.jobs import (
    clean_job, csv_job, daily_job, read_clean, snapshot_job, standardise, text_parquet_job,
)
from daybook.sources.readers import jdbc_options, read_csv_export, read_files, read_table
from daybook.sources.schemas import campaign_schema, conform, member_schema, transaction_schema
from daybook.sources.writers import write_text_parquet
from tests import small


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_daily_job_writes_over_the_last_result(spark, tmp_path):
    path = str(tmp_path / "daily")
    for _ in range(2):
        daily_job(*small.raw(spark), small.CONFIG, path)
    written = read_files(spark, path)
    assert tuple(written.columns) == COLUMNS
    assert rows(written) == rows(daily(small.tables(spark), small.CONFIG))


@pytest.mark.parametrize("semantics", ["corrected", "reference"])
def test_daily_on_written_clean_tables(spark, tmp_path, semantics):
    cfg = replace(small.CONFIG, semantics=semantics)
    clean_job(*small.raw(spark), cfg, str(tmp_path))
    clean = read_clean(spark, str(tmp_path))
    assert dict(clean.transactions.dtypes)["invoice_date"] == "date"
    assert rows(daily(clean, cfg)) == rows(daily(small.tables(spark, cfg), cfg))


def test_snapshot_counts_while_it_writes_and_appends(spark, tmp_path):
    path, source = str(tmp_path / "snapshot"), spark.range(0, 1000, 1, 7).withColumn("part", F.col("id") % 3)
    assert snapshot_job(source, path) == 1000
    assert snapshot_job(source, path) == 1000
    assert read_files(spark, path).count() == 2000
    assert snapshot_job(source.limit(0), path, mode="overwrite") == 0
    assert read_files(spark, path).count() == 0
    parted = str(tmp_path / "parted")
    assert snapshot_job(source, parted, mode="overwrite", partition_by=["part"]) == 1000
    assert read_files(spark, parted).filter("part = 1").count() == 333


def test_csv_export_and_back(spark, tmp_path):
    path = str(tmp_path / "csv")
    source = spark.createDataFrame(
        [("a", ' "quoted", text ', None), ("b", "", "back\\slash"), (None, "x", "ü")], "A string, `B b` string, c string"
    )
    csv_job(source, path, first_column="MonthYear")
    back = read_csv_export(spark, path)
    assert back.columns == ["monthyear", "b_b", "c"]
    assert rows(back) == sorted(
        [("a", ' "quoted", text ', None), ("b", None, "back\\slash"), (None, "x", "ü")], key=str
    )


def test_csv_export_with_messy_headers(spark, tmp_path):
    for number in (1, 2):
        text = f"Month,Sale Value,Sale Value,,Conversion %\n2024,{number},2,3,4%\n"
        (tmp_path / f"part{number}.csv").write_text(text)
    frame = read_csv_export(spark, str(tmp_path), first_column="MonthYear")
    assert frame.columns == ["monthyear", "sale_value", "sale_value_1", "unnamed", "conversion_pct"]
    assert rows(frame) == [("2024", "1", "2", "3", "4%"), ("2024", "2", "2", "3", "4%")]


def test_csv_export_by_name(spark, tmp_path):
    """Files with their columns in another order, with one missing, and an empty one."""
    for name, text in {"a": "A,B\nx,1\n", "b": "B,A\n2,y\n", "c": "A\nz\n", "d": ""}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    frame = read_csv_export(spark, str(tmp_path))
    assert frame.columns == ["a", "b"]
    assert rows(frame) == [("x", "1"), ("y", "2"), ("z", None)]


def test_clean_tables_by_month(spark, tmp_path):
    clean_job(*small.raw(spark), small.CONFIG, str(tmp_path), by_month=True)
    back = read_clean(spark, str(tmp_path))
    assert "invoice_month" in back.transactions.columns
    assert rows(daily(back, small.CONFIG)) == rows(daily(small.tables(spark), small.CONFIG))


def test_text_parquet(spark, tmp_path):
    source = spark.createDataFrame([(1, 2.5, dt.date(2024, 1, 2), None)], "`A a` int, `A a2` double, d date, e string")
    text_parquet_job(source, str(tmp_path / "job"), first_column="MonthYear")
    back = read_files(spark, str(tmp_path / "job"))
    assert back.dtypes == [("monthyear", "string"), ("a_a2", "string"), ("d", "string"), ("e", "string")]
    assert rows(back) == [("1", "2.5", "2024-01-02", None)]
    write_text_parquet(source.select("d"), str(tmp_path / "sink"))
    assert rows(read_files(spark, str(tmp_path / "sink"))) == [("2024-01-02",)]
    assert standardise(source).columns == ["a_a", "a_a2", "d", "e"]


def test_catalog_table(spark):
    small.raw(spark)[0].createOrReplaceTempView("member_view")
    assert read_table(spark, "member_view").count() == len(small.MEMBER_ROWS)


def test_database_read_is_always_split():
    settings = dict(url="jdbc:x", table="t", partition_column="id", lower_bound=1, upper_bound=900)
    options = jdbc_options(**settings, num_partitions=8, connection={"user": "u", "driver": "d"})
    assert options == {
        "user": "u", "driver": "d", "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "900", "numPartitions": "8", "fetchsize": "10000",
    }
    with pytest.raises(ValueError):
        jdbc_options(**settings, num_partitions=1)


def test_declared_schemas(spark):
    member = member_schema("club")
    assert len(member) == 185 and len(transaction_schema()) == 27 and len(campaign_schema()) == 44
    assert len({field.name.lower() for field in member}) == len(member)
    assert "clubrewardsstatus" in member.names and "firstprofileupdateddate" in member.names
    kinds = [field.dataType.simpleString() for field in member]
    assert kinds.count("boolean") == 35 and kinds.count("date") == 11
    assert not member["id"].nullable and member["enrollmentdate"].dataType.simpleString() == "timestamp_ntz"


def test_conform(spark):
    raw = spark.createDataFrame(
        [("7", "2024-01-05", "12.34567", "x", "extra"), ("?", "never", "many", "3", None)],
        "ID string, invoice_date string, Eligible_Amount string, qty string, other string",
    )
    got = conform(raw, transaction_schema())
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in transaction_schema()]
    picked = got.select("id", "invoice_date", "eligible_amount", "qty", "remarks")
    assert rows(picked) == [
        (7, dt.date(2024, 1, 5), Decimal("12.3457"), None, None), (None, None, None, 3, None),
    ]


def test_csv_headers_of_many_files_come_from_one_scan(spark, tmp_path):
    """1,000 files of 5 column orders: at most two Spark jobs to plan the read, and one scan in the plan."""
    orders = ["a,b,c", "c,b,a", "b,a,c", "a,c", "c,a,b,d"]
    for i in range(1000):
        names = orders[i % 5].split(",")
        (tmp_path / f"part{i}.csv").write_text(",".join(names) + "\n" + ",".join(f"{name}{i}" for name in names) + "\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    frame = read_csv_export(spark, str(tmp_path))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    expected = {
        tuple(f"{name}{i}" if name in orders[i % 5].split(",") else None for name in "abcd") for i in range(1000)
    }
    assert set(map(tuple, frame.select(*"abcd").collect())) == expected


def test_csv_headers_with_line_breaks_and_marks(spark, tmp_path):
    (tmp_path / "one.csv").write_text('﻿key,"first ""name""\nof all",x\n1,"a\nb",2\n', encoding="utf-8")
    (tmp_path / "two.csv").write_text('x,key\n"5",6\n')
    (tmp_path / "none.csv").write_text("")
    frame = read_csv_export(spark, str(tmp_path), multiLine="true")
    assert sorted(frame.columns) == ["first_nameof_all", "key", "x"]
    assert set(map(tuple, frame.select("key", "first_nameof_all", "x").collect())) == {("1", "a\nb", "2"), ("6", None, "5")}
