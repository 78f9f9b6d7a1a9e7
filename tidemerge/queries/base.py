"""Registration of queries and of the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemerge.queries.stand_in_sql import STAND_INS
from tidemerge.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# --- fixed values: columns and target types of the input tables
INPUT_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The input tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUT_TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.folder, name, INPUT_TABLES[name])

    @cached_property
    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in INPUT_TABLES}

    @cached_property
    def paths(self) -> dict[str, str]:
        return {name: f"{self.folder}/{name}.parquet" for name in INPUT_TABLES}

    @cached_property
    def discovered(self) -> dict[str, DataFrame]:
        """All tables with the schema their files declare."""
        return {name: read_table(self.spark, self.folder, name) for name in INPUT_TABLES}


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in INPUT_TABLES[table].split(", ")]


def as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines print them alike."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd").alias(f.name)
        out.append(c)
    return df.select(*out)


def stamp_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def report_columns_sql() -> dict[str, str]:
    """The columns of the status reports, as SQL over ``s_state``."""
    return {
        "last_synced": day_sql("last_synced_at"),
        "mode": "if(historical_completed_at IS NULL, 'historical', 'incremental')",
        "hist_done": day_sql("historical_completed_at"),
        "total_rows": "format('{:,}', total_rows_synced)",
        "last_error": "error_message[1:60]",
    }


def columns_sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _with_stand_ins(sql: str) -> str:
    """Prepend the stand-in tables the SQL mentions, in their order of definition."""
    used, grown = set(), True
    while grown:
        text = sql + " ".join(STAND_INS[u] for u in used)
        found = {n for n in STAND_INS if re.search(rf"\b{n}\b", text)}
        grown, used = found != used, found
    ctes = ", ".join(f"{n} AS ({STAND_INS[n].strip()})" for n in STAND_INS if n in used)
    body = sql.strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a key, with its SQL check."""
    def wrap(build: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: as_text(build(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = _with_stand_ins(sql)
        return build
    return wrap
