"""Data-quality jobs on deliberately dirtied inputs."""

from datetime import datetime

from ledgerhawk.operators import (
    domain_violations,
    duplicate_keys,
    history_violations,
    null_violations,
    numeric_violations,
    orphans,
    width_violations,
)


def t(s):
    return datetime.fromisoformat(s)


def test_keys_orphans_nulls_domain_width(spark):
    df = spark.createDataFrame([("C1", "A1", "payment"), ("C1", "A2", "bogus"), ("C2", None, None),
                                ("C3", "A9", "refill")], "card_num string, account_num string, oper_type string")
    acc = spark.createDataFrame([("A1",), ("A2",)], "account_num string")
    assert [r.card_num for r in duplicate_keys(df, ["card_num"]).collect()] == ["C1"]
    assert [r.card_num for r in orphans(df, "account_num", acc, "account_num").collect()] == ["C3"]
    nulls = {r.column_name: r.n_null for r in null_violations(df, df.columns).collect()}
    assert nulls == {"card_num": 0, "account_num": 1, "oper_type": 1}
    bad = sorted(str(r.oper_type) for r in domain_violations(df, "oper_type", ("payment", "refill")).collect())
    assert bad == ["None", "bogus"]
    wide = {r.column_name: r.n_too_long for r in width_violations(df, {"oper_type": 5}).collect()}
    assert wide == {"oper_type": 2}


def test_numeric_range(spark):
    df = spark.createDataFrame([(1.5,), (123456789.0,), (None,)], "amt double")
    assert numeric_violations(df, "amt").count() == 1


def test_history_violations(spark):
    h = spark.createDataFrame([
        ("K1", t("2024-01-01 00:00:00"), t("2024-01-02 00:00:00")),
        ("K1", t("2024-01-03 00:00:00"), None),                      # gap before it
        ("K2", t("2024-01-01 00:00:00"), None),
        ("K2", t("2024-01-02 00:00:00"), None),                      # two open
        ("K3", t("2024-01-01 00:00:00"), t("2024-01-02 00:00:00")),  # closed, no successor
    ], "key string, start_dt timestamp_ntz, end_dt timestamp_ntz")
    got = sorted((r.key, r.problem) for r in history_violations(h, "key").collect())
    assert got == [("K1", "gap_or_overlap"), ("K2", "several_open"), ("K2", "several_open"),
                   ("K3", "closed_last")]
