"""Rejects, split points and published results."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from daybook.plans.jobs import daily_job
from daybook.sources.published import Folder, PublishedMeanwhile, publish, read_published
from daybook.sources.readers import read_files
from daybook.sources.rejects import (
    REJECTS, conform_job, conform_keeping_rejects, quarantine, read_conformed, read_quarantine, reject_counts,
)
from daybook.sources.schemas import conform
from daybook.sources.splits import literal, split_points, split_predicates
from tests import small
from tests.test_plans import plan_of

DECLARED = "id INT NOT NULL, day DATE, qty BIGINT, price DECIMAL(6,2), ok BOOLEAN, note STRING, gone INT, due INT NOT NULL"
RAW = "ID string, Day string, qty string, price string, ok string, note string, _kept int"
RAW_ROWS = [
    ("1", "2024-01-05", " 7 ", "12.345", "true", "", 1),
    ("2", "05/01/2024", "7.5", "12345.6", "maybe", None, 2),
    (None, None, None, None, None, None, None),
    ("99999999999", "2024-02-30", "many", "1e1", "1", "x", 3),
    ("", "", "", "", "", "", 4),
]


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(DECLARED)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_rejects_have_their_reasons(spark, schema):
    raw = spark.createDataFrame(RAW_ROWS, RAW)
    kept = conform_keeping_rejects(raw, schema)
    assert kept.columns == [*schema.names, REJECTS]
    assert rows(kept.drop(REJECTS)) == rows(conform(raw, schema))
    cells = set(map(tuple, quarantine(kept).filter("column <> 'due'").collect()))
    assert cells == {
        ("day", "unreadable", "05/01/2024"), ("qty", "not whole", "7.5"), ("price", "out of range", "12345.6"),
        ("ok", "unreadable", "maybe"), ("id", "missing", None), ("id", "out of range", "99999999999"),
        ("day", "unreadable", "2024-02-30"), ("qty", "unreadable", "many"),
        *[(name, "unreadable", "") for name in ("id", "day", "qty", "price", "ok")],
    }
    assert rows(reject_counts(kept).filter("column = 'due'")) == [("due", "missing", 5)]
    assert quarantine(kept, "id").columns == ["id", "column", "reason", "cell"]


def test_typed_columns_and_empty_tables(spark, schema):
    typed = spark.createDataFrame([(1, 300), (2, None)], "id int, n int")
    kept = conform_keeping_rejects(typed, T.StructType.fromDDL("id INT, n TINYINT"))
    assert rows(quarantine(kept)) == [("n", "out of range", "300")]
    assert rows(quarantine(conform_keeping_rejects(typed, T.StructType.fromDDL("id INT")))) == []
    assert quarantine(conform_keeping_rejects(typed.limit(0), schema)).count() == 0


def test_conform_job_is_one_scan_and_counts_in_the_write(spark, schema, tmp_path):
    spark.createDataFrame(RAW_ROWS * 100, RAW).write.parquet(f"{tmp_path}/raw")
    raw, path = spark.read.parquet(f"{tmp_path}/raw"), f"{tmp_path}/out"
    assert plan_of(conform_keeping_rejects(raw, schema), "simple").count("FileScan") == 1
    counts = conform_job(raw, schema, path)
    assert counts == {(r["column"], r["reason"]): r["n"] for r in read_quarantine(spark, path).groupBy("column", "reason").agg(F.count("*").alias("n")).collect()}
    assert counts["id", "missing"] == 100
    assert rows(read_conformed(spark, path)) == rows(conform(raw, schema))
    assert "day" not in plan_of(read_quarantine(spark, path)).split("ReadSchema")[1].splitlines()[0]


def brute_points(values, parts):
    known = sorted(v for v in values if v is not None)
    points = []
    for k in range(1, parts):
        fits = [v for v in sorted(set(known)) if sum(x < v for x in known) * parts >= k * len(known)]
        if fits and fits[0] not in points:
            points.append(fits[0])
    return points


TEXTS = ["it's", "back\\slash", "", "é", "😀", "A", "a", "zz", "a b", 'q"']


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "bigint", "decimal(8,2)"])
def test_every_row_is_in_one_part(spark, kind):
    rng = random.Random(kind)
    make = {
        "string": lambda: rng.choice(TEXTS) * rng.randrange(1, 4),
        "date": lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(300)),
        "timestamp_ntz": lambda: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**12)),
        "bigint": lambda: rng.randrange(-50, 50),
        "decimal(8,2)": lambda: Decimal(rng.randrange(-5000, 5000)) / 100,
    }[kind]
    hot = make()
    values = [None if rng.random() < 0.1 else hot if rng.random() < 1 / 3 else make() for _ in range(400)]
    frame = spark.createDataFrame([(v,) for v in values], f"`the value` {kind}").repartition(6)
    points = split_points(frame, "the value", 7)
    assert points == brute_points(values, 7)
    predicates = split_predicates("`the value`", points, "\\\\")
    counts = [frame.where(p).count() for p in predicates]
    assert sum(counts) == len(values) and len(predicates) == len(points) + 1
    # rows the points do not know, and nulls
    more = spark.createDataFrame([(make(),) for _ in range(50)] + [(None,)], f"`the value` {kind}")
    assert sum(more.where(p).count() for p in predicates) == 51


def test_splits_of_little(spark):
    texts = spark.createDataFrame([("a",)] * 5 + [(None,)], "t string")
    assert split_points(texts, "t", 4) == [] and split_points(texts.limit(0), "t", 4) == []
    assert split_predicates("t", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        split_points(spark.range(3).selectExpr("id / 2 AS x"), "x", 2)
    with pytest.raises(ValueError):
        split_points(texts, "t", 1)
    assert literal("a'b\\") == "'a''b\\'" and literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and literal(5) == "5"


def test_a_failed_write_leaves_the_published_result(spark, tmp_path):
    path = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert publish(spark.range(10), path) == 10
    reader = read_published(spark, path)
    broken = spark.range(0, 1000, 1, 4).selectExpr("CASE WHEN id = 900 THEN raise_error('broken') ELSE id END AS id")
    with pytest.raises(Exception, match="broken"):
        publish(broken, path)
    assert read_published(spark, path).count() == 10
    assert len(Folder(spark, path).names("versions")) == 1
    assert publish(read_published(spark, path).union(spark.range(5)), path) == 15
    assert read_published(spark, path).count() == 15
    assert reader.count() == 10  # who reads the earlier result still can
    assert read_published(spark, path, 0).count() == 10
    publish(spark.range(1), path)
    assert len(Folder(spark, path).names("versions")) == 2 and Folder(spark, path).numbers() == [1, 2]


def test_of_two_writers_one_publishes(spark, tmp_path):
    path = str(tmp_path / "result")
    publish(spark.range(3), path)
    folder = Folder(spark, path)
    with pytest.raises(PublishedMeanwhile):
        folder.name(0, "other")
    assert read_published(spark, path).count() == 3


def test_staged_daily_job(spark, tmp_path):
    daily_job(*small.raw(spark), small.CONFIG, str(tmp_path / "plain"))
    for _ in range(2):
        daily_job(*small.raw(spark), small.CONFIG, str(tmp_path / "staged"), staged=True)
    assert rows(read_published(spark, str(tmp_path / "staged"))) == rows(read_files(spark, str(tmp_path / "plain")))
