"""Published views: whole versions, and daily views by month."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.operators import pointer
from tidemerge.sources import files

_MONTH = "_month"


def publish(df: DataFrame, path: str, version: str, view: str | None = None) -> DataFrame:
    """Write a recomputed view to its own version folder and, once whole, point the view at it.

    Readers of the older version are not disturbed; writing the same version again is harmless.
    """
    spark, folder = df.sparkSession, f"{path}/version={version}"
    df.write.mode("overwrite").parquet(folder)
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{folder}`")
    return spark.read.parquet(folder)


def publish_all(spark: SparkSession, views: dict[str, Callable[[], DataFrame]], path: str, version: str,
                register: bool = True) -> DataFrame:
    """Publish each view, going on when one fails. One outcome row per view."""
    outcome = []
    for name, build in views.items():
        try:
            publish(build(), f"{path}/{name}", version, name if register else None)
            outcome.append((name, "published", None))
        except Exception as error:  # noqa: BLE001 - one bad view must not stop the others
            outcome.append((name, "failed", str(error)))
    return spark.createDataFrame(outcome, "view_name string, outcome string, error_message string")


def _month_number(day: Column) -> Column:
    """Months in their order; rows without a day form the first."""
    return F.coalesce(F.year(day) * 12 + F.month(day), F.lit(0))


def _months(spark: SparkSession, folder: str) -> set[int]:
    return {int(c.split("=")[1]) for c in files.children(spark, folder) if c.startswith(f"{_MONTH}=")}


def refresh_months(rows: DataFrame, path: str, touched: DataFrame | None = None, day: str = "metric_date") -> int:
    """Publishes the months of a daily view that a batch changed: ``rows`` holds all their days and replaces them.

    ``touched`` lists the days (column ``day``) of the batch when months may have lost all rows; these are removed. The
    view's other months are copied into the new version (a view is small beside its base); readers switch with the
    pointer. Returns the number of months written.
    """
    spark = rows.sparkSession
    number, at = pointer.newest(spark, path)
    folder = f"{path}/months-{number + 1}"
    rows.withColumn(_MONTH, _month_number(F.col(day))).repartition(_MONTH).write.mode("overwrite").partitionBy(_MONTH).parquet(folder)
    written = _months(spark, folder)
    gone = {r[0] for r in touched.select(_month_number(F.col(day))).distinct().collect()} if touched is not None else set()
    kept = set(at["months"]) - written - gone if at else set()
    if kept:
        old = spark.read.parquet(f"{path}/{at['folder']}").where(F.col(_MONTH).isin(sorted(kept)))
        old.repartition(_MONTH).write.mode("append").partitionBy(_MONTH).parquet(folder)
    pointer.publish(spark, path, number + 1, {"folder": f"months-{number + 1}", "months": sorted(written | kept)})
    for name in files.children(spark, path):
        if name.startswith("months-") and int(name[7:]) < number:
            files.delete(spark, f"{path}/{name}")
    return len(written)


def read_months(spark: SparkSession, path: str, last: int | None = None) -> DataFrame | None:
    """The published months, or only the folders of the newest ``last`` ones; each of them has a row."""
    _, at = pointer.newest(spark, path)
    if at is None:
        return None
    months = at["months"] if last is None else at["months"][-last:]
    rows = spark.read.option("mergeSchema", "true").parquet(f"{path}/{at['folder']}")
    return rows.where(F.col(_MONTH).isin(months)).drop(_MONTH)
