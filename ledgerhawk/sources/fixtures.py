"""Landing rows derived from the driver's star-schema tables.

Row source: ``events`` joined to ``customer`` (client), its ``nation`` (middle
name), a ``supplier`` chosen by ``event_id`` over the whole range of supplier
keys (terminal) and that supplier's ``nation`` (city). ``dn`` is the day number from 2024-01-01, used
so that accounts, passports and addresses change every few days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDING

FIXTURE_EPOCH = "2024-01-01"
DN = f"datediff(to_date(ts), DATE'{FIXTURE_EPOCH}')"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_days(base: str, n) -> F.Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int")).cast("timestamp_ntz")


def fixture_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landing rows (every day) with the ``LANDING`` schema."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n_keys = s.select((F.max("s_suppkey") + 1).alias("n")).scalar()
    n1 = n.select(F.col("n_nationkey").alias("n1_key"), F.col("n_name").alias("n1_name"))
    n2 = n.select(F.col("n_nationkey").alias("n2_key"), F.col("n_name").alias("n2_name"))
    terminals = s.join(n2, F.col("s_nationkey") == F.col("n2_key"))

    j = (
        e.withColumn("terminal_key", F.col("event_id") % n_keys)
        .join(c, F.col("c_custkey") == F.col("user_id"))
        .join(n1, F.col("n1_key") == F.col("c_nationkey"))
        .join(terminals, F.col("s_suppkey") == F.col("terminal_key"))
    )
    uid, ck, sk = F.col("user_id"), F.col("c_custkey"), F.col("s_suppkey")
    et = F.col("event_type")
    cols = {
        "trans_id": F.col("event_id").cast("string"),
        "date": F.col("ts").cast("timestamp_ntz"),
        "card": F.concat(F.lit("C"), uid.cast("string")),
        "account": F.concat(F.lit("A"), uid.cast("string"), F.lit("-"),
                            F.expr(f"({DN} + user_id % 20) div 20").cast("string")),
        "account_valid_to": _plus_days("2024-01-10", uid % 40),
        "client": ck.cast("string"),
        "last_name": F.col("c_name"),
        "first_name": F.col("c_mktsegment"),
        "patronymic": F.col("n1_name"),
        "date_of_birth": _plus_days("1970-01-01", ck % 9000),
        "passport": F.concat(F.lit("P"), ck.cast("string"), F.lit("-"),
                             F.expr(f"({DN} + c_custkey % 15) div 15").cast("string")),
        "passport_valid_to": _plus_days("2024-01-05", (ck * 7) % 60),
        "phone": F.concat(F.lit("+7"), ck.cast("string")),
        "oper_type": F.when(et == "purchase", "payment").when(et == "signup", "refill").otherwise("withdrawal"),
        "amount": F.col("value").cast("decimal(10,2)"),
        "oper_result": F.when(et == "purchase", "success").otherwise("refused"),
        "terminal": F.concat(F.lit("T"), sk.cast("string")),
        "terminal_type": F.when(sk % 2 == 0, "ATM").otherwise("POS"),
        "city": F.col("n2_name"),
        "address": F.concat(F.lit("addr-"), sk.cast("string"), F.lit("-"),
                            F.expr(f"({DN} + s_suppkey) div 10").cast("string")),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in LANDING.fields])
