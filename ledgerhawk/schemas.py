"""Table schemas and dimension specs (landing, staging, dims, fact, report, audit)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S = StringType()
TS = TimestampNTZType()
AMT = DecimalType(10, 2)

# Landing ("garbage") table: one denormalised row per transaction.
LANDING = StructType(
    [
        StructField("trans_id", S),
        StructField("date", TS),
        StructField("card", S),
        StructField("account", S),
        StructField("account_valid_to", TS),
        StructField("client", S),
        StructField("last_name", S),
        StructField("first_name", S),
        StructField("patronymic", S),
        StructField("date_of_birth", TS),
        StructField("passport", S),
        StructField("passport_valid_to", TS),
        StructField("phone", S),
        StructField("oper_type", S),
        StructField("amount", AMT),
        StructField("oper_result", S),
        StructField("terminal", S),
        StructField("terminal_type", S),
        StructField("city", S),
        StructField("address", S),
    ]
)

# Declared widths (VARCHAR(n)) used by the width check.
LANDING_WIDTHS = {f.name: 50 for f in LANDING.fields if f.dataType == S}


@dataclass(frozen=True)
class DimSpec:
    """A dimension: natural key, attributes, and where they come from in landing."""

    name: str
    key: str
    attrs: tuple[str, ...]
    source: dict  # dim column -> landing column

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, *self.attrs)


CLIENTS = DimSpec(
    "clients",
    "client_id",
    ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
     "passport_valid_to", "phone"),
    {"client_id": "client", "last_name": "last_name", "first_name": "first_name",
     "patronymic": "patronymic", "date_of_birth": "date_of_birth",
     "passport_num": "passport", "passport_valid_to": "passport_valid_to", "phone": "phone"},
)
ACCOUNTS = DimSpec(
    "accounts",
    "account_num",
    ("valid_to", "client"),
    {"account_num": "account", "valid_to": "account_valid_to", "client": "client"},
)
CARDS = DimSpec(
    "cards",
    "card_num",
    ("account_num",),
    {"card_num": "card", "account_num": "account"},
)
TERMINALS = DimSpec(
    "terminals",
    "terminal_id",
    ("terminal_type", "terminal_city", "terminal_address"),
    {"terminal_id": "terminal", "terminal_type": "terminal_type",
     "terminal_city": "city", "terminal_address": "address"},
)
DIMS = {d.name: d for d in (CLIENTS, ACCOUNTS, CARDS, TERMINALS)}

# Fact columns <- landing columns.
FACT_SOURCE = {
    "trans_id": "trans_id",
    "trans_date": "date",
    "card_num": "card",
    "oper_type": "oper_type",
    "amt": "amount",
    "oper_result": "oper_result",
    "terminal": "terminal",
}
FACT_COLUMNS = tuple(FACT_SOURCE)

REPORT = StructType(
    [
        StructField("fraud_dt", TS),
        StructField("passport", S),
        StructField("fio", S),
        StructField("phone", S),
        StructField("fraud_type", S),
        StructField("report_dt", TS),
    ]
)
REPORT_COLUMNS = tuple(f.name for f in REPORT.fields)

AUDIT = StructType(
    [
        StructField("table_name", S),
        StructField("action", S),
        StructField("amount", IntegerType()),
        StructField("action_date", TS),
    ]
)

# NOT NULL columns declared by the reference DDL (checked as data quality).
NOT_NULL = {
    "clients": ("client_id", "last_name", "first_name", "patronymic", "date_of_birth",
                "passport_num", "passport_valid_to", "phone"),
    "accounts": ("account_num", "valid_to", "client"),
    "cards": ("card_num", "account_num"),
    "terminals": ("terminal_id", "terminal_type", "terminal_city", "terminal_address"),
    "transactions": ("trans_id", "trans_date", "card_num", "oper_type", "amt",
                     "oper_result", "terminal"),
    "report": REPORT_COLUMNS,
}
