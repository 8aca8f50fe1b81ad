from datetime import datetime
from decimal import Decimal

from ledgerhawk.schemas import FACT_SOURCE

FACT_DDL = ("trans_id string, trans_date timestamp_ntz, card_num string, oper_type string, "
            "amt decimal(10,2), oper_result string, terminal string")


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def fact(spark, rows):
    """rows: (trans_id, 'YYYY-MM-DD HH:MM:SS[.ffffff]', card, amt, result, terminal)."""
    data = [(i, ts(t), c, "payment", Decimal(str(a)) if a is not None else None, r, term)
            for i, t, c, a, r, term in rows]
    return spark.createDataFrame(data, FACT_DDL).select(*FACT_SOURCE)


def terminals(spark, rows):
    """rows: (terminal_id, city)."""
    return spark.createDataFrame([(t, "POS", c, "addr") for t, c in rows],
                                 "terminal_id string, terminal_type string, terminal_city string, "
                                 "terminal_address string")


def owner_dims(spark, cards, passport_valid_to="2030-01-01 00:00:00", account_valid_to="2030-01-01 00:00:00"):
    """One account and client per card, valid far in the future by default."""
    c = spark.createDataFrame([(k, f"A{k}") for k in cards], "card_num string, account_num string")
    a = spark.createDataFrame([(f"A{k}", ts(account_valid_to), f"K{k}") for k in cards],
                              "account_num string, valid_to timestamp_ntz, client string")
    cl = spark.createDataFrame(
        [(f"K{k}", "Last", "First", "Middle", ts("1980-01-01 00:00:00"), f"P{k}", ts(passport_valid_to), "+7")
         for k in cards],
        "client_id string, last_name string, first_name string, patronymic string, "
        "date_of_birth timestamp_ntz, passport_num string, passport_valid_to timestamp_ntz, phone string")
    return {"cards": c, "accounts": a, "clients": cl}
