"""Versions of a folder: small numbered files, of which the newest is the one that counts. Writing one publishes it."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidemerge.sources import files

#: Older pointers that stay, so that what they name can be told from what a dead write left.
KEPT = 3


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in files.children(spark, f"{path}/_versions") if n.endswith(".json") and n[:-5].isdigit())


def newest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest version; (0, None) before the first."""
    numbers = _numbers(spark, path)
    if not numbers:
        return 0, None
    return numbers[-1], json.loads(files.read_text(spark, f"{path}/_versions/{numbers[-1]:010d}.json"))


def publish(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Readers see ``content`` from now on. A second writer of the same number is refused."""
    files.write_new(spark, f"{path}/_versions/{number:010d}.json", json.dumps(content))
    for old in _numbers(spark, path)[:-KEPT]:
        files.delete(spark, f"{path}/_versions/{old:010d}.json")
