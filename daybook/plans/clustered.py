"""Purchases and members stored by card, so that measures by card need no shuffle by card.

    clean tables -> one row per card and day  ┐ bucketed and sorted by card,
                 -> one row per member card   ┴ the same number of buckets

The layout is what makes it work, so it is fixed here: both tables are bucketed by ``card_no`` into the same number of
buckets and sorted by it, one file per bucket. What is stored is reduced already: a card with a third of all purchases is
combined on the map side over its days first, and has at most one row per day in its bucket. So reading a bucket
in one task is safe, which it would not be with the purchases themselves.

Buckets are a property of catalog tables: the tables are external ones under the given name, and a session that
reads them needs the catalog that knows them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from daybook.config import Config
from daybook.operators.cards import card_days, card_days_in_parts, member_cards_with_days
from daybook.sources.tables import Tables

CARD = "card_no"
_DAYS, _CARDS = "card_days", "member_cards"


def cluster_job(tables: Tables, cfg: Config, name: str, path: str, buckets: int) -> None:
    """Writes the two tables ``<name>_card_days`` and ``<name>_member_cards`` below ``path``. ``buckets``: so many
    that one holds 100 to 200 MB."""
    days = (card_days_in_parts if cfg.exact_amounts else card_days)(tables.transactions, cfg)
    for table, rows in ((_DAYS, days), (_CARDS, member_cards_with_days(tables.members, cfg))):
        # dealt out as the buckets are, so that each bucket is one file
        spread = rows.repartition(buckets, CARD)
        writer = spread.write.mode("overwrite").format("parquet").option("path", f"{path}/{table}")
        writer.bucketBy(buckets, CARD).sortBy(CARD).saveAsTable(f"{name}_{table}")


def read_clustered(spark: SparkSession, tables: Tables, name: str) -> Tables:
    """The tables with what ``cluster_job`` stored; measures by card start from that, others from the tables."""
    clustered = Tables.from_clean(tables.members, tables.transactions, tables.campaigns)
    clustered.card_days, clustered.cards = [spark.read.table(f"{name}_{table}") for table in (_DAYS, _CARDS)]
    return clustered
