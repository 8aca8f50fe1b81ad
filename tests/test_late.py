"""apply_late equals a replay with the rows in time, and writes only the days that change."""

import random
from datetime import date, timedelta

import pytest

from ledgerhawk.plans.daily import run_day
from ledgerhawk.plans.etl import backfill
from ledgerhawk.plans.late import apply_late
from ledgerhawk.schemas import DIMS
from ledgerhawk.sources.warehouse import Warehouse
from test_pipeline import land_rows, operation

DAYS = [date(2024, 5, 1) + timedelta(days=i) for i in range(3)]


FOUR = [*DAYS, date(2024, 5, 4)]


def corpus(seed):
    """Operations with attributes that change back and forth; some of them, and a repeated key, come late."""
    rng = random.Random(seed)
    on_time, late, n = {d: [] for d in DAYS}, {d: [] for d in DAYS}, 0
    for k, d in enumerate(DAYS):
        for _ in range(10):
            n += 1
            card = f"C{rng.randrange(4)}"
            op = list(operation(n, f"{d} {rng.randrange(24):02d}:{rng.randrange(60):02d}", card,
                                passport_to=rng.choice(["2024-01-01", "2030-01-01"])))
            op[8] = f"T{rng.randrange(2)}"
            op[-2] = rng.choice(["Here", "There"])
            op[3] = rng.choice(["A1" + card, "A2" + card])
            if k < 2 and rng.random() < 0.25:
                late[DAYS[rng.randrange(k + 1, 3)]].append(tuple(op))
            else:
                on_time[d].append(tuple(op))
    # a new client and terminal that nobody saw in time; a late row with the key of a later operation
    op = list(operation(900, f"{DAYS[1]} 05:00", "NEW"))
    op[8] = "T9"
    late[DAYS[2]].append(tuple(op))
    later = list(on_time[DAYS[2]][0])
    later[1] = operation(0, f"{DAYS[1]} 06:00")[1]
    late[DAYS[2]].append(tuple(later))
    return on_time, late


def states(wh, report=True):
    read = wh.read_dim if wh.mode == "scd1" else wh.read_hist
    frames = {("fact",): wh.read_fact(), ("audit",): wh.read_audit().drop("action_date")}
    if report:
        frames[("report",)] = wh.read_report().drop("report_dt")
    frames |= {(n, d): read(n, d) for n in DIMS for d in DAYS}
    return {k: sorted(str(r) for r in f.select(*sorted(f.columns)).collect()) for k, f in frames.items()}


def land_all(spark, roots, on_time, late):
    for d in DAYS:
        land_rows(spark, roots[0], d, on_time[d] + late[d])
    own = {d: [r for rows in late.values() for r in rows if r[1].date() == d] for d in DAYS}
    for d in DAYS:
        land_rows(spark, roots[1], d, on_time[d] + own[d])


@pytest.fixture(scope="module")
def in_time(spark, tmp_path_factory):
    """The same operations, landed with their own days and loaded day by day, in both modes."""
    on_time, late = corpus(3)
    root = str(tmp_path_factory.mktemp("in_time"))
    land_all(spark, [str(tmp_path_factory.mktemp("other")), root], on_time, late)
    for mode in ("scd1", "scd2"):
        for d in DAYS:
            run_day(spark, root, d, mode)
    return on_time, late, {mode: states(Warehouse(spark, root, mode)) for mode in ("scd1", "scd2")}


@pytest.mark.parametrize("mode", ["scd2", "scd1"])
def test_equals_a_replay_in_time(spark, in_time, tmp_path, mode):
    on_time, late, expected = in_time
    root, want = str(tmp_path), expected[mode]
    for d in DAYS:
        land_rows(spark, root, d, on_time[d] + late[d])
        run_day(spark, root, d, mode)
    wh = Warehouse(spark, root, mode)
    assert wh.read_fact().count() < len(want["fact",])
    assert DAYS[1] in apply_late(spark, root, mode)
    got = states(wh)
    for k in want:
        assert got[k] == want[k], k
    number = wh.manifest().number
    assert apply_late(spark, root, mode) == [] and wh.manifest().number == number + 1 and states(wh) == want


def test_only_dirty_days_are_written(spark, tmp_path):
    """A late row whose change ends with the next day's changes its own day and the next, no other day."""
    root, mode = str(tmp_path), "scd2"

    def op(i, d, city):
        return operation(i, f"{d} 10:00")[:-2] + (city, "Street")

    for i, d in enumerate(FOUR):
        rows = [op(i, d, "Here" if i < 2 else "Else")]
        if d == FOUR[3]:
            rows.append(operation(77, f"{DAYS[1]} 12:00")[:-2] + ("There", "Street"))
        land_rows(spark, root, d, rows)
        run_day(spark, root, d, mode)
    wh = Warehouse(spark, root, mode)
    before = wh.manifest().days
    assert apply_late(spark, root, mode) == [DAYS[1], DAYS[2]]
    after = wh.manifest().days
    for d in FOUR:
        changed = {t for t in after[str(d)]["tables"] if t != "late_applied" and after[str(d)]["tables"][t] != before[str(d)]["tables"].get(t)}
        expected = {DAYS[1]: {"fact_transactions", "fact_keys", "fact_blooms", "quarantine", "dim_terminals_hist", "audit", "report", "quality"},
                    DAYS[2]: {"dim_terminals_hist", "audit", "report", "quality"}}.get(d, set())
        assert changed == expected, d
    assert [(r.terminal_city, str(r.start_dt), str(r.end_dt)) for r in wh.read_hist("terminals", FOUR[3]).orderBy("start_dt").collect()] == [
        ("Here", f"{DAYS[0]} 10:00:00", f"{DAYS[1]} 12:00:00"), ("There", f"{DAYS[1]} 12:00:00", f"{DAYS[2]} 10:00:00"),
        ("Else", f"{DAYS[2]} 10:00:00", "None")]


def test_after_a_backfill(spark, tmp_path):
    """scd2: late rows splice into a backfilled range; scd1 stores no states there and refuses."""
    on_time, late = corpus(5)
    roots = [str(tmp_path / "late"), str(tmp_path / "in_time")]
    land_all(spark, roots, on_time, late)
    for root in roots:
        backfill(spark, root, DAYS[0], DAYS[-1], "scd2")
    backfill(spark, roots[0], DAYS[0], DAYS[-1], "scd1")
    with pytest.raises(ValueError):
        apply_late(spark, roots[0], "scd1")
    apply_late(spark, roots[0], "scd2")
    got, want = (states(Warehouse(spark, r, "scd2"), report=False) for r in roots)
    for k in want:
        assert got[k] == want[k], k
