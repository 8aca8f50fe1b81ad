"""Quality counts of a range in one pass: equal to those of daily loads, and to a plain count per day."""

import random
from datetime import date, timedelta

import pytest

from ledgerhawk.config import REFERENCE_DOMAINS
from ledgerhawk.plans.checks import quality_counts
from ledgerhawk.plans.daily import run_day
from ledgerhawk.plans.etl import backfill
from ledgerhawk.plans.quality_days import quality_by_day
from ledgerhawk.plans.report import report_range
from ledgerhawk.schemas import DIMS, REPORT
from ledgerhawk.sources.warehouse import Warehouse, dim_schema, fact_schema
from test_pipeline import land_rows, operation

DAYS = [date(2024, 5, 1) + timedelta(days=i) for i in range(3)]


def faulty_days():
    """A card whose account and client come a day later, values outside their domains, NULLs, over-long
    text that a later version mends, a terminal that is never known, and keys used again within and across days."""
    rows = {d: [operation(10 * k + i, f"{d} 1{i}:00", f"C{i}") for i in range(3)] for k, d in enumerate(DAYS)}
    late_owner = list(operation(1, f"{DAYS[0]} 15:00", "NEW"))
    late_owner[4] = None
    long_name = list(operation(100, f"{DAYS[0]} 16:00", "C9"))
    long_name[6] = "x" * 60
    odd = list(operation(101, f"{DAYS[1]} 17:00", "C1", oper_type="gift"))
    odd[4], odd[5] = None, None
    rows[DAYS[0]] += [tuple(late_owner), tuple(long_name), rows[DAYS[0]][0]]
    rows[DAYS[1]] += [tuple(odd), operation(102, f"{DAYS[1]} 18:00", "NEW"), operation(103, f"{DAYS[1]} 19:00", "C9"),
                      operation(0, f"{DAYS[1]} 20:00", "C0")]
    return rows


def counts(df):
    return sorted((r.check_name, r.table_name, r.column_name, str(r.load_dt), r.n_rows) for r in df.collect())


@pytest.mark.parametrize("mode", ["scd1", "scd2"])
def test_backfill_counts_as_daily_loads_do(spark, tmp_path, mode):
    daily, whole = str(tmp_path / "daily"), str(tmp_path / "whole")
    for d, rows in faulty_days().items():
        land_rows(spark, daily, d, rows)
        land_rows(spark, whole, d, rows)
        run_day(spark, daily, d, mode)
    run_day(spark, whole, DAYS[0], mode)  # the range starts from a stored state
    backfill(spark, whole, DAYS[1], DAYS[2], mode)
    got = Warehouse(spark, whole, mode).read_quality()
    want = counts(Warehouse(spark, daily, mode).read_quality())
    assert [x for x in counts(got) if x[1] != "report"] == [x for x in want if x[1] != "report"]
    assert {x[0] for x in want if x[4]} >= {"duplicate_keys", "orphans", "null", "domain", "width"}
    report_range(spark, whole, DAYS[1], DAYS[2], mode, REFERENCE_DOMAINS)
    assert counts(Warehouse(spark, whole, mode).read_quality()) == want


def test_any_versions_against_counts_per_day(spark):
    """Random versions (several at once, NULLs, no end), facts and reports, also from before the range."""
    rng = random.Random(7)
    first = date(2024, 5, 1)

    def at(i):
        return first + timedelta(days=i)

    def value(field, key):
        kind = field.dataType.simpleString()
        if kind == "string":
            return rng.choice([None, key, "x" * 120, f"K{rng.randrange(6)}"])
        return None

    versions, states, days = {}, {}, [at(i) for i in range(3, 9)]
    for n, spec in DIMS.items():
        fields = [f for f in dim_schema(spec, "scd1").fields if f.name in spec.columns]
        rows = []
        for k in range(6):
            start, key = rng.randrange(8), None if k == 5 else f"K{k}"
            for _ in range(rng.randrange(1, 4)):
                end = start + rng.randrange(3)
                rows.append((key, *[value(f, key) for f in fields[1:]], at(start), at(end)))
                start = max(start, end - rng.randrange(2))
            rows.append((key, *[value(f, key) for f in fields[1:]], at(start), None))
        schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["valid_from_day date", "valid_to_day date"])
        versions[n] = spark.createDataFrame(rows, schema)
        states[n] = {d: [r[:-2] for r in rows if r[-2] <= d and (r[-1] is None or r[-1] > d)] for d in days}
    schema = fact_schema()
    facts = [(f"t{rng.randrange(25)}", None, rng.choice([None, "K1", "K3", "K9"]), rng.choice([None, "gift", REFERENCE_DOMAINS.oper_types[0]]), None,
              rng.choice([None, REFERENCE_DOMAINS.success]), rng.choice(["K0", "K4", "T"]), rng.choice(days)) for _ in range(80)]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    fact = spark.createDataFrame(facts, names + ", trans_dt date")
    reports = [(None, rng.choice([None, "P"]), "f" * rng.choice([3, 151]), None, "t", None, rng.choice(days)) for _ in range(9)]
    report_names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORT.fields)
    report = spark.createDataFrame(reports, report_names + ", load_dt date")
    got = counts(quality_by_day(versions, fact, days[0], days[-1], report=report))
    for d in (days[0], days[2], days[-1]):
        tables = {n: spark.createDataFrame(states[n][d], versions[n].drop("valid_from_day", "valid_to_day").schema) for n in DIMS}
        tables |= {"transactions": fact.where(fact.trans_dt == d).drop("trans_dt"), "report": report.where(report.load_dt == d).drop("load_dt")}
        want = sorted((r.check_name, r.table_name, r.column_name, str(d), r.n_rows) for r in quality_counts(tables).collect())
        assert [x for x in got if x[3] == str(d)] == want
    assert {x[3] for x in got} == {str(d) for d in days}
