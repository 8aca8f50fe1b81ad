from datetime import date, datetime, timezone

import pytest

from ledgerhawk.config import as_date, check_mode, default_run_ts


@pytest.mark.parametrize("text", ["2020-05-01", "2020-5-1", " 2020-05-01 ", "2020-05-01 10:00:00",
                                  "2020-05-01T10:00:00", date(2020, 5, 1), datetime(2020, 5, 1, 10)])
def test_day_parameter(text):
    assert as_date(text) == date(2020, 5, 1)


def test_bad_day_parameter():
    with pytest.raises(ValueError):
        as_date("2020-13-01")


def test_default_run_ts_is_now():
    assert abs((datetime.fromisoformat(default_run_ts()) - datetime.now(timezone.utc).replace(tzinfo=None))
               .total_seconds()) < 60


@pytest.mark.parametrize("mode,gate", [("scd1", "typo_gate"), ("scd1", "literal"), ("scd2", "all_or_nothing"),
                                       ("scd3", "per_key")])
def test_unknown_modes_and_gates_are_refused(mode, gate):
    with pytest.raises(ValueError):
        check_mode(mode, gate)
