"""Daily views kept current by what changed.

A batch of changes is rows with a sign: +1 for a row as it is now, -1 for one as it was. Summed by the columns that a
view groups and counts distinct by, they are added to a stored table of counts; a view is an aggregate of that table, in
which a value is there as long as its count is above zero. So distinct counts stay exact under updates and deletions,
and no batch reads the base rows again. Each stored row names the batch that last changed it, and a batch becomes
visible as one generation, so a batch that is applied again changes nothing.

Sketches do the same for distinct counts within an error where rows are only added: one sketch a day and group,
merged with the stored one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.operators import bucketed

SIGN = "_sign"
_KEY = "_key"
#: log2 of the registers of a sketch: a standard error of 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12


def signed(after: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The rows of a batch as they are now and, where they replace others, as those were."""
    plus = after.withColumn(SIGN, F.lit(1).cast("long"))
    return plus if before is None else plus.unionByName(before.select(*after.columns).withColumn(SIGN, F.lit(-1).cast("long")))


def replaced(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the target that a batch of updates replaces."""
    return target.join(batch.select(*keys).distinct(), keys, "left_semi")


def summed(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Net change ``n`` for each combination of the columns that changed at all."""
    return changes.groupBy(*columns).agg(F.sum(SIGN).alias("n")).where("n <> 0")


def _keyed(df: DataFrame, columns: list[str]) -> DataFrame:
    """One text key for all columns, so that nulls are values like any other."""
    return df.withColumn(_KEY, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def add_counts(changes: DataFrame, path: str, columns: list[str], batch: int, buckets: int | None = None) -> bucketed.Written:
    """Adds the signed rows of a numbered batch to the counts at ``path``. Batches come in rising order.

    What is net of a batch is dealt out to the buckets once; the steps behind it stay in them."""
    at, old = bucketed.version(changes.sparkSession, path), bucketed.read_target(changes.sparkSession, path)
    dealt = at.buckets if at is not None else buckets or bucketed.DEFAULT_BUCKETS
    net = _keyed(summed(changes, columns), columns).repartition(dealt, _KEY)
    if old is not None:
        held = old.select(_KEY, F.col("n").alias("_n"), F.col("batch").alias("_batch"))
        net = held.join(net, _KEY, "right").where(F.coalesce("_batch", F.lit(-1)) < batch).withColumn("n", F.col("n") + F.coalesce("_n", F.lit(0)))
    rows = net.select(_KEY, *columns, "n", F.lit(batch).cast("long").alias("batch"))
    return bucketed.replace_into(rows, path, [_KEY], ["n"], buckets)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """The combinations that are there, with their counts ``n``."""
    return bucketed.read_target(spark, path).where("n > 0").drop(_KEY, "batch")


VOLUME = ["metric_date", "direction", "message_type", "contact_wa_id"]
FUNNEL = ["metric_date", "status", "turn_message_id"]


def volume_rows(messages: DataFrame) -> DataFrame:
    return messages.select(F.to_date("message_timestamp").alias("metric_date"), *VOLUME[1:])


def volume_daily(counted: DataFrame) -> DataFrame:
    """``message_volume_daily`` from its counts."""
    return counted.groupBy(*VOLUME[:3]).agg(F.sum("n").alias("message_count"), F.count("contact_wa_id").alias("unique_contacts"))


def funnel_rows(statuses: DataFrame) -> DataFrame:
    return statuses.select(F.to_date("status_timestamp").alias("metric_date"), *FUNNEL[1:]).where("turn_message_id is not null")


def status_daily(counted: DataFrame) -> DataFrame:
    """Messages that reached each status, by day, from their counts."""
    return counted.groupBy("metric_date").agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_messages") for s in ("sent", "delivered", "read", "failed")])


# --- sketches ----------------------------------------------------------------------------------------------------------


def sketched(rows: DataFrame, by: list[str], distinct: str) -> DataFrame:
    """Rows and a mergeable sketch of the distinct values of a column, for each group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, SKETCH_BITS).alias("sketch"))


def merged_sketches(parts: DataFrame, by: list[str]) -> DataFrame:
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def add_sketches(rows: DataFrame, path: str, by: list[str], distinct: str, batch: int, buckets: int | None = None) -> bucketed.Written:
    """Merges the sketches of a numbered batch of added rows with those at ``path``; days that are open again are merged,
    not counted anew. A batch that is applied again changes nothing."""
    new = _keyed(sketched(rows, by, distinct), by)
    old = bucketed.read_target(rows.sparkSession, path)
    if old is not None:
        held = old.select(_KEY, F.col("n").alias("_n"), F.col("batch").alias("_batch"), F.col("sketch").alias("_sketch"))
        new = held.join(new, _KEY, "right").where(F.coalesce("_batch", F.lit(-1)) < batch)
        new = new.withColumns({"n": F.col("n") + F.coalesce("_n", F.lit(0)),
                               "sketch": F.when(F.col("_sketch").isNull(), F.col("sketch")).otherwise(F.hll_union("sketch", "_sketch"))})
    return bucketed.replace_into(new.select(_KEY, *by, "n", "sketch", F.lit(batch).cast("long").alias("batch")), path, [_KEY], ["n"], buckets)


def sketch_estimates(spark: SparkSession, path: str) -> DataFrame:
    return bucketed.read_target(spark, path).drop(_KEY, "batch").withColumn("unique_values", F.hll_sketch_estimate("sketch")).drop("sketch")
