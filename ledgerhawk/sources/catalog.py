"""Warehouse tables in the session catalog (the reference's DDL step).

``init_warehouse`` declares every table of a warehouse root as an external
Parquet table (``CREATE TABLE IF NOT EXISTS … USING parquet PARTITIONED BY …
LOCATION``), so the data can be queried with SQL; ``refresh_warehouse``
picks up what was landed and published since and drops the partitions of replaced or stale
versions; ``register_state_views`` exposes the dimensions as they stood after a given day
under the reference's names (``dim_clients`` … or ``dim_clients_hist`` …).
"""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..schemas import AUDIT, DIMS, LANDING, REPORT
from .landing import BAD_CELLS_FIELD, PART_COL
from .warehouse import QUALITY, VERSION, Warehouse, dim_schema, fact_schema


def _ddl(schema: StructType, extra: list[tuple[str, str]]) -> str:
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    cols += [f"`{n}` {t}" for n, t in extra]
    return ", ".join(cols)


def _tables(wh: Warehouse) -> dict[str, tuple[str, str, list[str]]]:
    """name -> (column DDL, location, partition columns)."""
    landing = StructType([*LANDING.fields, BAD_CELLS_FIELD])
    by_day = [("load_dt", "date"), (VERSION, "string")]

    def daily(schema: StructType, table: str, extra: tuple = (), more: tuple = ()) -> tuple[str, str, list[str]]:
        return (_ddl(schema, [*extra, *by_day, *more]), wh.path(table), [n for n, _ in (*by_day, *more)])

    t = {
        "srs_load": (_ddl(landing, [("batch_dt", "date"), (PART_COL, "string")]), f"{wh.root.rstrip('/')}/landing",
                     ["batch_dt", PART_COL]),
        "fact_transactions": (_ddl(fact_schema(), [("trans_dt", "date"), (VERSION, "string")]), wh.path("fact_transactions"),
                              ["trans_dt", VERSION, "oper_type", "oper_result"]),
        "report": daily(REPORT, "report"),
        "meta": daily(AUDIT, "audit"),
        "quality": daily(QUALITY, "quality"),
        "quarantine": daily(landing, "quarantine", (("reason", "string"),)),
    }
    for name, spec in DIMS.items():
        if wh.mode == "scd1":
            t[f"dim_{name}_snapshots"] = daily(dim_schema(spec, "scd1"), f"dim_{name}")
        else:
            t[f"dim_{name}_hist_snapshots"] = daily(dim_schema(spec, "scd2"), f"dim_{name}_hist", more=(("state", "string"),))
    return t


def init_warehouse(spark: SparkSession, root: str, mode: str = "scd1", database: str | None = None,
                   recreate: bool = False) -> list[str]:
    """Declare the warehouse tables (data stays where it is). With
    ``recreate`` the catalog entries are dropped first (external tables:
    files are kept)."""
    wh = Warehouse(spark, root, mode)
    prefix = ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        prefix = f"`{database}`."
    names = []
    for name, (cols, location, parts) in _tables(wh).items():
        full = f"{prefix}`{name}`"
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{location}'")
        names.append(full)
    refresh_warehouse(spark, names, wh)
    return names


def refresh_warehouse(spark: SparkSession, tables: list[str], wh: Warehouse) -> None:
    """Register the partitions that the manifest of ``wh`` names, and only those."""
    now = wh.manifest()
    locations = {location: name for name, (_, location, _) in _tables(wh).items()}
    tables_of = {name: location.rsplit("/", 1)[1] for location, name in locations.items()}
    for t in tables:
        spark.sql(f"ALTER TABLE {t} RECOVER PARTITIONS")
        table = tables_of[t.split(".")[-1].strip("`")]
        if table != "landing":
            for (text,) in spark.sql(f"SHOW PARTITIONS {t}").collect():
                parts = [p.split("=", 1) for p in text.split("/")]
                day, version = parts[0][1], parts[1][1]
                if now.version(day, table) != version or now.kind(day) is None:
                    spec = ", ".join(f"`{c}` = '{unquote(v)}'" for c, v in parts)
                    spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION ({spec})")  # external: files stay
        spark.sql(f"REFRESH TABLE {t}")


def register_state_views(spark: SparkSession, root: str, d: date | str, mode: str = "scd1") -> list[str]:
    """Temporary views of the dimensions as of the end of day ``d``:
    ``dim_<name>`` (SCD1) or ``dim_<name>_hist`` (SCD2, full history)."""
    wh = Warehouse(spark, root, mode)
    names = []
    for name in DIMS:
        if mode == "scd1":
            wh.read_dim(name, d).createOrReplaceTempView(f"dim_{name}")
            names.append(f"dim_{name}")
        else:
            wh.read_hist(name, d).createOrReplaceTempView(f"dim_{name}_hist")
            names.append(f"dim_{name}_hist")
    return names
