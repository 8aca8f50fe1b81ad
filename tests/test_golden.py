"""Golden counts of FIXTURES.md §3 on the driver tables (whole tables)."""

import pytest

from ledgerhawk.config import (
    FRAUD_AMOUNT_PROBE,
    FRAUD_CITY_HOP,
    FRAUD_EXPIRED_ACCOUNT,
    FRAUD_EXPIRED_PASSPORT,
)
from ledgerhawk.plans import registry

ALL_DAYS = {
    "/root/testdata/sf0.001": (232, 418, 93, 2),
    "/root/testdata/sf0.01": (1993, 2039, 808, 1),
    "/root/testdata/sf0.1": (19528, 19432, 8283, 24),
}
REPORT_DAY = {
    "/root/testdata/sf0.001": (5, 9, 7, 0),
    "/root/testdata/sf0.01": (57, 54, 24, 1),
    "/root/testdata/sf0.1": (596, 495, 274, 4),
}
ORDER = (FRAUD_EXPIRED_PASSPORT, FRAUD_EXPIRED_ACCOUNT, FRAUD_CITY_HOP, FRAUD_AMOUNT_PROBE)


def by_rule(df):
    got = {r.fraud_type: r["count"] for r in df.groupBy("fraud_type").count().collect()}
    return tuple(got.get(t, 0) for t in ORDER)


@pytest.mark.parametrize("sf_dir", sorted(ALL_DAYS))
def test_all_days_report(spark, sf_dir):
    assert by_rule(registry.q_report_all_days(spark, sf_dir)) == ALL_DAYS[sf_dir]


@pytest.mark.parametrize("sf_dir", sorted(REPORT_DAY))
def test_report_day(spark, sf_dir):
    assert by_rule(registry.q_report_day_scd2(spark, sf_dir)) == REPORT_DAY[sf_dir]


@pytest.mark.parametrize("sf_dir,counts", [
    ("/root/testdata/sf0.01", {"clients": (150, 438), "accounts": (362, 362), "cards": (150, 362),
                               "terminals": (100, 390)}),
    ("/root/testdata/sf0.1", {"clients": (1500, 4371), "accounts": (3656, 3656), "cards": (1500, 3656),
                              "terminals": (1000, 3900)}),
])
def test_dimension_rows_after_last_day(spark, sf_dir, counts):
    lnd = registry.fixture_landing(spark, sf_dir)
    for name, (n1, n2) in counts.items():
        assert registry.scd1_state(lnd, name, registry.LAST_DAY).count() == n1, name
        assert registry.scd2_state(lnd, name, registry.LAST_DAY).count() == n2, name
