"""Results do not depend on the session time zone (timestamp_ntz throughout)."""

from conftest import SF0001
from ledgerhawk.plans import registry


def test_report_independent_of_session_time_zone(spark):
    utc = sorted(map(tuple, registry.q_report_all_days(spark, SF0001).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = sorted(map(tuple, registry.q_report_all_days(spark, SF0001).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert la == utc and len(utc) == 232 + 418 + 93 + 2
