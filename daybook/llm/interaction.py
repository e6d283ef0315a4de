"""Audit of how filters interact: what each removes, in every order of application, per part of the corpus.

All files of the documents are read as a stream of available-now micro-batches. A document's own failures
are a mask of bits. Whether its text stands under a smaller doc_id is kept as state by text: a
table keyed by the text's digest holds the smallest doc_id so far and the counts of its rows. A batch
counts every row as a copy first, then gives the holder of each text its copy bit back. If a smaller id
arrives later, the earlier holder's mask is retracted from its part's counter and counted again as a copy.
So the counters are right for all files read so far after any batch, in whatever order the files come.

    files -> masks -> flags of the labels -> counts by part and mask
                                         \\-> smallest id by text, against the state -> promotions and retractions

Each batch writes its changes of the state and of the counters under its own number, so a batch that is run again
after a failure replaces its own tables and counts once. The state is the log of promotions: ids of a text only
fall, so its last entry is the one with the smallest id, and no batch rewrites what earlier ones wrote.

Scale: texts are read once and never shuffled, only digests (32 bytes) and masks are. Rows are combined by text,
part, mask and flags on the map side before a text's rows meet, so a text that fills a third of the table
comes down to a few rows per task, and what meets in one group is at most its distinct combinations. The report is
made from at most 32 counters per part. The number of batches is a parameter; the last one may be smaller.

Defined cases: a null text is empty; a null source is the part ''; a row without doc_id is no copy of any row, and none
is a copy of it; rows of one doc_id and text are copies of smaller ids only, not of each other; a document
has a label if any row of `labels` for its id has it. An empty table has no parts, so no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from itertools import permutations
from math import ceil, factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import settle
from daybook.sources.scratch import scratch

#: Micro-batches that the files present are read in.
BATCHES = 4
WORD_BREAK = r"[\x20\x09-\x0D]+"
COPY = "E"
COUNTS = "part string, mask int, good boolean, toxic boolean, n long"
CHANGES = f"key binary, doc_id long, {COUNTS}, arrived boolean"


def few_words(text: Column) -> Column:
    """Under 200 words."""
    return F.size(_words(text)) < 200


def repetitive(text: Column) -> Column:
    """Less than half of the words are different ones."""
    return F.size(F.array_distinct(_words(text))) * 100 < F.size(_words(text)) * 50


def shouting(text: Column) -> Column:
    """More than 2 in 100 characters are capitals."""
    return F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 2


def symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Filters by letter: each gives whether a text fails. The copies' letter comes after them.
FILTERS: Mapping[str, Callable[[Column], Column]] = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def masked(docs: DataFrame, filters: Mapping[str, Callable[[Column], Column]] = FILTERS) -> DataFrame:
    """key (the text's digest), doc_id, part, mask: one bit per filter that the text fails."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails(text), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
    return docs.select(
        F.unhex(F.sha2(text, 256)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"), reduce(lambda a, b: a + b, bits, F.lit(0)).alias("mask"),
    )


def flags(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row per labelled document."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.bool_or(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.bool_or(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )


def counted(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """Equal rows as one row with their number n, with the flags of the labels."""
    # rows without id meet no label; spread by their text, they do not gather in one task
    labelled = flagged.select(F.col("doc_id").alias("at"), F.lit(True).alias("named"), "good", "toxic")
    at = rows.withColumns({"at": F.coalesce("doc_id", F.xxhash64("key")), "named": F.col("doc_id").isNotNull()})
    return (
        at.join(labelled, ["at", "named"], "left")
        .groupBy("at", "named", "key", "doc_id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                 F.coalesce("toxic", F.lit(False)).alias("toxic"))
        .agg(F.count("*").alias("n"))
        .drop("at", "named")
    )


class Audit:
    """The state by text and the counters by part, below `folder`; `add` takes a micro-batch."""

    def __init__(self, spark: SparkSession, labels: DataFrame, filters=FILTERS, folder: str | None = None):
        self.spark, self.filters = spark, filters
        self.folder = folder or scratch(spark, "audit")
        self.copy = 1 << len(filters)
        self.flagged = settle(flags(labels), "flags")
        for name, columns in (("changes", CHANGES), ("counters", COUNTS)):  # before the first batch there is nothing
            self.write(spark.createDataFrame([], columns), name, -1)

    def table(self, name: str, columns: str) -> DataFrame:
        """What all batches so far have written, with the batch's number."""
        return self.spark.read.schema(f"{columns}, batch long").parquet(f"{self.folder}/{name}")

    def write(self, rows: DataFrame, name: str, batch: int) -> DataFrame:
        path = f"{self.folder}/{name}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def add(self, docs: DataFrame, batch: int) -> None:
        # the stream's own session plans without adaptive execution; from here on the caller's session does the work
        rows = self.write(masked(docs, self.filters), "rows", batch)
        combined = self.write(counted(rows, self.flagged), "combined", batch)
        named = F.col("doc_id").isNotNull()
        as_copies = combined.select(
            "part", (F.col("mask") + F.when(named, self.copy).otherwise(0)).alias("mask"), "good", "toxic", "n"
        )
        changes = self.write(self.changes(combined.where(named), batch), "changes", batch)
        # a promotion turns a copy into the holder, a retraction the holder into a copy
        sign = F.when(F.col("arrived"), F.col("n")).otherwise(-F.col("n"))
        both = F.array(
            F.struct(F.col("mask"), sign.alias("n")), F.struct((F.col("mask") + self.copy).alias("mask"), (-sign).alias("n"))
        )
        moved = changes.select("part", F.inline(both), "good", "toxic").select("part", "mask", "good", "toxic", "n")
        self.write(total(as_copies.union(moved)), "counters", batch)

    def changes(self, combined: DataFrame, batch: int) -> DataFrame:
        """The rows that become holders of their text with this batch, and the earlier holders that stop being it."""
        kind = ["key", "part", "mask", "good", "toxic"]
        # of every combination only the rows with its smallest id can hold the text
        smallest = combined.groupBy(*kind).agg(F.min_by("n", "doc_id").alias("n"), F.min("doc_id").alias("doc_id"))
        held = ["key", "doc_id", "part", "mask", "good", "toxic", "n"]
        state = self.table("changes", CHANGES).where(F.col("arrived") & (F.col("batch") < batch))
        both = smallest.select(*held, F.lit(True).alias("arrived")).union(state.select(*held, F.lit(False)))
        text = Window.partitionBy("key")
        known = both.withColumns({
            "least": F.min("doc_id").over(text),
            "before": F.min(F.when(~F.col("arrived"), F.col("doc_id"))).over(text),
        })
        promoted = F.col("arrived") & (F.col("doc_id") == F.col("least"))
        retracted = ~F.col("arrived") & (F.col("doc_id") == F.col("before")) & (F.col("least") < F.col("before"))
        return known.where(promoted | retracted).select(*held, "arrived")

    def counters(self) -> DataFrame:
        """part, mask, good, toxic, n over all batches."""
        return total(self.table("counters", COUNTS).drop("batch"))

    def report(self) -> DataFrame:
        return interactions(self.counters(), "".join(self.filters) + COPY)


def total(counts: DataFrame) -> DataFrame:
    return counts.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def interactions(counters: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the part's counters (one per mask, at most 2^filters)."""
    n = F.col("n")
    per_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )
    per_part = per_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")
    steps = per_part.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))

    def bits(some: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.contains(some, F.lit(c)), 1 << i).otherwise(0) for i, c in enumerate(letters)])

    order, step = F.col("filter_order"), F.col("step")
    steps = steps.withColumns({
        "own": bits(F.substr(order, step, F.lit(1))), "earlier": bits(F.substr(order, F.lit(1), step - 1)),
    })

    def sum_where(condition, value) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda so_far, m: so_far + F.when(condition(m["mask"]), value(m)).otherwise(0))

    def fails(mask):
        return mask.bitwiseAND(F.col("own")) != 0

    def came(mask):
        """Not removed by an earlier step."""
        return mask.bitwiseAND(F.col("earlier")) == 0

    def removed(mask):
        return fails(mask) & came(mask)

    return steps.select(
        "part", "filter_order", "step",
        sum_where(lambda mask: ~fails(mask) & came(mask), lambda m: m["n"]).alias("kept"),
        sum_where(removed, lambda m: m["n"]).alias("removed"),
        sum_where(lambda mask: fails(mask) & ~came(mask), lambda m: m["n"]).alias("redundant"),
        sum_where(lambda mask: mask == F.col("own"), lambda m: m["n"]).alias("unique_fails"),
        sum_where(removed, lambda m: m["good"]).alias("good_lost"),
        sum_where(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        # a filter removes a document in the orders where it comes first of those the document fails: one in so many
        sum_where(fails, lambda m: m["n"] * (F.lit(factorial(len(letters))) / F.bit_count(m["mask"])).cast("long")).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, filters=FILTERS, batches: int = BATCHES) -> DataFrame:
    """The report over all document files at `path`, read as available-now micro-batches."""
    docs = spark.read.parquet(path)
    state = Audit(spark, labels, filters)
    files = len(docs.inputFiles())
    # as a pattern, since a stream takes a path without one for a folder, and a table may be a single file
    folder, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", max(1, ceil(files / batches)))
    query = (
        stream.parquet(f"{folder}/{{{name}}}")
        .select("doc_id", "text", "source")
        .writeStream.foreachBatch(state.add)
        .option("checkpointLocation", scratch(spark, "audit-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return state.report()
