"""Data-quality counts of many days in one pass, equal to the daily ones (:mod:`ledgerhawk.plans.checks`).

A dimension is not looked at day by day: each of its versions counts from the day it begins to the day
it ends, so a violation is a step up on one day and a step down on another. Steps are summed map-side per
day, and one running sum over the days gives every day's count. A parent that came after its child ends the
child's violation that day. Facts, rejects and reports belong to one day: a step up, and down on the next.
No row is multiplied by the days it lasts, and facts meet their parents as counts per (key, day)."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..config import REFERENCE_DOMAINS, Domains
from ..operators.keys import FACT_KEY
from ..schemas import DIMS, NOT_NULL, REPORT
from ..sources.warehouse import QUALITY, Warehouse, dim_schema, fact_schema

#: Foreign keys (child, column, parent) and declared widths other than 50.
FOREIGN_KEYS = (("accounts", "client", "clients"), ("cards", "account_num", "accounts"),
                ("transactions", "card_num", "cards"), ("transactions", "terminal", "terminals"))
WIDTHS = {"terminal_address": 100, "account_num": 100, "fio": 150, "fraud_type": 100}

_DIM, _FACT = "valid_from_day", "trans_dt"


def text_widths(schema: StructType) -> dict[str, int]:
    """Declared width of every text column."""
    return {f.name: WIDTHS.get(f.name, 50) for f in schema.fields if isinstance(f.dataType, StringType)}


def _faults(table: str, schema: StructType, domains: Domains) -> dict[tuple[str, str], Column]:
    """What can be wrong with one row by itself: (check, column) -> condition."""
    found = {("null", c): F.col(c).isNull() for c in NOT_NULL[table]}
    found |= {("width", c): F.length(c) > n for c, n in text_widths(schema).items()}
    if table == "transactions":
        found |= {("domain", c): F.col(c).isNull() | ~F.col(c).isin(*allowed)
                  for c, allowed in (("oper_type", domains.oper_types), ("oper_result", domains.oper_results))}
    return found


def _schemas() -> dict[str, StructType]:
    return {n: dim_schema(s, "scd1") for n, s in DIMS.items()} | {"transactions": fact_schema(), "report": REPORT}


def _kinds(domains: Domains) -> list[tuple[str, str, str]]:
    """Every (check, table, column) that is counted, also where the count is zero."""
    kinds = [("duplicate_keys", n, s.key) for n, s in DIMS.items()]
    kinds.append(("duplicate_keys", "transactions", ",".join(FACT_KEY)))
    kinds += [("orphans", child, fk) for child, fk, _ in FOREIGN_KEYS]
    return kinds + [(check, table, c) for table, schema in _schemas().items() for check, c in _faults(table, schema, domains)]


def _fault_steps(rows: DataFrame, table: str, domains: Domains) -> DataFrame:
    """Steps per day of every fault of the rows (columns ``day`` and ``sign`` beside the table's), in one aggregate."""
    faults = list(_faults(table, _schemas()[table], domains).items())
    sums = rows.groupBy("day").agg(*[F.sum(F.when(wrong, F.col("sign")).otherwise(0)).alias(f"n{i}")
                                     for i, (_, wrong) in enumerate(faults)])
    each = [F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n")) for i, ((check, c), _) in enumerate(faults)]
    return sums.select("day", F.explode(F.array(*each)).alias("e")).select("e.*", "day")


def _steps(rows: DataFrame, since: Column, until: Column, start: date) -> DataFrame:
    """Every row on the day from which it counts (``start`` at the earliest) and on the day it no longer does."""
    def at(day: Column, sign: int) -> Column:
        return F.struct(F.when(day.isNotNull(), F.greatest(day, F.lit(start))).alias("day"), F.lit(sign).alias("sign"))

    both = rows.select("*", F.explode(F.array(at(since, 1), at(until, -1))).alias("step"))
    return both.where(F.col("step.day").isNotNull()).select(*rows.columns, "step.day", "step.sign")


def _one_day(rows: DataFrame, day: str) -> DataFrame:
    """Rows that count on one day only."""
    return rows.select(*[c for c in rows.columns if c != day], F.explode(F.array(
        F.struct(F.col(day).alias("day"), F.lit(1).alias("sign")),
        F.struct(F.date_add(day, 1).alias("day"), F.lit(-1).alias("sign")))).alias("step")).select("*", "step.*").drop("step")


def _named(steps: DataFrame, check: str, table: str, column: str) -> DataFrame:
    """Sums per day of ``n * sign`` as steps of one check."""
    return steps.groupBy("day").agg(F.sum(F.col("n") * F.col("sign")).alias("n")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "n", "day")


def _crowded(steps: DataFrame, key: str) -> DataFrame:
    """Steps (``n``, ``day``) of how many keys several versions hold at once. A key's
    window has one row per day on which something changes."""
    per = steps.select(key, "day", "sign").repartition(key).groupBy(key, "day").agg(F.sum("sign").alias("change"))
    order = Window.partitionBy(key).orderBy("day")
    many = per.select(key, "day", (F.sum("change").over(order) > 1).cast("int").alias("many"))
    return many.select("day", (F.col("many") - F.lag("many", 1, 0).over(order)).alias("n"), F.lit(1).alias("sign"))


def quality_by_day(versions: dict[str, DataFrame], fact: DataFrame, start: date, end: date,
                   domains: Domains = REFERENCE_DOMAINS, quarantine: DataFrame | None = None,
                   report: DataFrame | None = None) -> DataFrame:
    """``check_name, table_name, column_name, n_rows, load_dt`` of every day from ``start`` to ``end``, zero counts included.

    ``versions``: the dimensions' versions in force at some time of the range, with ``valid_from_day`` and
    ``valid_to_day`` (exclusive; NULL: still open); a day sees those in force at its end. ``fact`` has its
    day as ``trans_dt``, ``quarantine`` and ``report`` as ``load_dt``. A stored key stays stored, as no
    load deletes one."""
    parts, since = [], {}
    for name, spec in DIMS.items():
        v = versions[name].select(*spec.columns, "valid_from_day", "valid_to_day")
        steps = _steps(v, F.col("valid_from_day"), F.col("valid_to_day"), start).drop("valid_from_day", "valid_to_day")
        parts.append(_fault_steps(steps, name, domains))
        parts.append(_named(_crowded(steps, spec.key), "duplicate_keys", name, spec.key))
        since[name] = v.where(F.col(spec.key).isNotNull()).groupBy(F.col(spec.key).alias("parent")).agg(
            F.min("valid_from_day").alias("since"))
    fact = fact.select(*fact_schema().fieldNames(), _FACT)
    parts.append(_fault_steps(_one_day(fact, _FACT), "transactions", domains))
    twice = fact.na.drop(subset=list(FACT_KEY)).groupBy(_FACT, *FACT_KEY).count().where("count > 1").select(_FACT)
    if quarantine is not None:
        refused = quarantine.where(F.array_contains(F.split("reason", ","), "duplicate_key"))
        twice = twice.union(refused.select("load_dt"))
    parts.append(_named(_one_day(twice.groupBy(_FACT).agg(F.count(F.lit(1)).alias("n")), _FACT),
                        "duplicate_keys", "transactions", ",".join(FACT_KEY)))
    for child, fk, parent in FOREIGN_KEYS:
        if child == "transactions":
            held = fact.where(F.col(fk).isNotNull()).groupBy(fk, _FACT).agg(F.count(F.lit(1)).alias("n"))
            alone = held.join(since[parent], F.col(fk) == F.col("parent"), "left").where(
                F.col("since").isNull() | (F.col("since") > F.col(_FACT)))
            steps = _one_day(alone.groupBy(_FACT).agg(F.sum("n").alias("n")), _FACT)
        else:
            held = versions[child].where(F.col(fk).isNotNull()).groupBy(fk, _DIM, "valid_to_day").agg(F.count(F.lit(1)).alias("n"))
            alone = held.join(since[parent], F.col(fk) == F.col("parent"), "left").where(
                F.col("since").isNull() | (F.col("since") > F.col(_DIM)))
            steps = _steps(alone, F.col(_DIM), F.least("valid_to_day", "since"), start)  # least ignores NULLs
        parts.append(_named(steps, "orphans", child, fk))
    if report is not None:
        parts.append(_fault_steps(_one_day(report, "load_dt"), "report", domains))
    names = ["check_name", "table_name", "column_name"]
    summed = reduce(DataFrame.unionByName, parts).where(F.col("day") <= F.lit(end)).groupBy(*names, "day").agg(F.sum("n").alias("n"))
    kinds = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(names, k, strict=True)]) for k in _kinds(domains)])
    days = summed.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"), kinds.alias("kinds"))
    spine = days.select("day", F.explode("kinds").alias("k")).select("k.*", "day")
    so_far = Window.partitionBy(*names).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    counted = spine.join(summed, [*names, "day"], "left").withColumn("n_rows", F.sum(F.coalesce("n", F.lit(0))).over(so_far))
    return counted.select(*names, F.col("n_rows").cast("long").alias("n_rows"), F.col("day").alias("load_dt"))


def recount_reports(wh: Warehouse, start: date, end: date, domains: Domains = REFERENCE_DOMAINS) -> None:
    """After the load ``wh`` wrote reports: the report's counts of those days that hold quality counts, beside
    the counts of the other tables, which stay as they are."""
    days = [date.fromisoformat(d) for d in wh.manifest().days_of("quality") if start.isoformat() <= d <= end.isoformat()]
    if not days:
        return
    stored = wh.read_quality_range(start, end)
    of_report = stored.where("table_name = 'report'").select(*[c for c in stored.columns if c != "n_rows"])
    steps = _fault_steps(wh.read_report_range(start, end).withColumnRenamed("load_dt", "day").withColumn("sign", F.lit(1)),
                         "report", domains).withColumnsRenamed({"day": "load_dt", "n": "n_rows"})
    counted = of_report.join(steps, of_report.columns, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))
    wh.write_range(stored.where("table_name <> 'report'").unionByName(counted).select(*QUALITY.fieldNames(), "load_dt"),
                   "quality", ["load_dt"], days)
