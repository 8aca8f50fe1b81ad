"""The fact's primary key (transaction, operation type, result) without a database.

A day's rows are compared with each other and with the days before. Each loaded day has
an index: its keys by hash, sorted, and Bloom filters over them, cut into slices of about
``SLICE`` keys. A batch probes the filters of all earlier days (one equi-join on the
slice, bits tested in the join's output); only days in which some key may be are
then read, and only against the keys that may be there. Without duplicates that is, but for
the filters' false positives (one probe in about 400), no day at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed: the fact's primary key.
FACT_KEY = ("trans_id", "oper_type", "oper_result")
#: Keys a Bloom filter is sized for, its 64-bit words (16 bits a key), and bits set per key.
SLICE, WORDS, HASHES = 256, 64, 4


def _complete(key: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def repeated_in(rows: DataFrame, place: list[str], key: tuple[str, ...] = FACT_KEY) -> DataFrame:
    """The rows whose key another row has that comes before it in the order of ``place`` (which must
    tell all rows apart). Rows with a NULL in their key are no duplicates. Keys are counted
    map-side first, so a key that many rows share is no long task."""
    found = rows.where(_complete(key))
    first = found.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*place)).alias("_first")) \
        .where("_n > 1").drop("_n")
    return found.join(first, list(key)).where(F.struct(*place) > F.col("_first")).select(*rows.columns)


def _bit(i: int) -> Column:
    return F.pmod(F.xxhash64("h", F.lit(i)), F.lit(64 * WORDS))


def key_rows(fact: DataFrame, *keep: str) -> DataFrame:
    """``h`` and the key of every row with a complete key, once."""
    return fact.where(_complete(FACT_KEY)).select(*FACT_KEY, *keep).distinct() \
        .select(F.xxhash64(*FACT_KEY).alias("h"), *FACT_KEY, *keep)


def blooms(keys: DataFrame) -> DataFrame:
    """``load_dt, slices, slice, bits``: the Bloom filters of each day of ``keys (h, load_dt)``."""
    sizes = keys.groupBy("load_dt").agg(F.count(F.lit(1)).alias("n")).select("load_dt", F.pow(
        F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.lit(SLICE))))).cast("bigint").alias("slices"))
    sliced = keys.join(sizes, "load_dt").withColumn("slice", F.pmod("h", "slices"))
    bits = sliced.select("load_dt", "slices", "slice", F.explode(F.array(*[_bit(i) for i in range(HASHES)])).alias("bit")) \
        .select("load_dt", "slices", "slice", F.expr(f"bit div {WORDS}").alias("word"),
                F.expr(f"shiftleft(1L, cast(bit % {WORDS} as int))").alias("bits"))
    empty = sizes.select("load_dt", "slices", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice")) \
        .withColumn("word", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(WORDS - 1).cast("bigint")))) \
        .withColumn("bits", F.lit(0).cast("bigint"))
    words = bits.unionByName(empty).groupBy("load_dt", "slices", "slice", "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy("load_dt", "slices", "slice").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits"))


def may_hold(keys: DataFrame, filters: DataFrame, sizes: list[int]) -> DataFrame:
    """``load_dt`` and the columns of ``keys (h, ...)`` whose bits a day's ``filters`` all have;
    ``sizes``: the numbers of slices that occur (powers of two, so few)."""
    probes = keys.withColumn("slices", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes]))) \
        .withColumn("slice", F.pmod("h", "slices"))
    hit = reduce(lambda a, b: a & b, [
        F.expr(f"(shiftright(bits[cast(pmod(xxhash64(h, {i}), {64 * WORDS}) div {WORDS} as int)],"
               f" cast(pmod(xxhash64(h, {i}), {64 * WORDS}) % {WORDS} as int)) & 1L) = 1L") for i in range(HASHES)])
    return probes.join(filters, ["slices", "slice"]).where(hit).select("load_dt", *keys.columns)
