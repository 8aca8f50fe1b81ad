"""Quality rules: base limits, then robust multivariate outliers per language and source.

Everything is DataFrame work. Statistics of the whole text come from array
functions within the row. The rows that pass the base limits are then described
by transformed statistics, and each (language, source) cell gets a minimum
covariance determinant estimate:

* two starting estimates: classical mean and covariance; medians and quartile
  ranges (of values rounded to 1/64, so that the exact percentiles have bounded state);
* C-steps: Mahalanobis distances, the ``H_SHARE`` of rows nearest (found by counting
  rows per distance bucket, 1/8 of a power of two wide), their mean and covariance;
* per cell the start whose covariance has the smaller determinant goes on, then
  one reweighted estimate and a consistency factor from the median distance.

A covariance gets ``FLOORS`` on its diagonal, so that a statistic that is almost
constant in a cell does not reject on rounding. Cells with under ``MIN_ROWS`` rows
are pooled: first the rest of their language, then the rest of everything; a pool
that is still smaller rejects nothing.

Defined cases: a NULL text has no words and fails the base limits; NULL languages
and sources are cells of their own; repeated rows count as often as they occur;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, prepared

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
H_SHARE = 0.75
MIN_ROWS = 60
C_STEPS = 2
#: Chi-square quantiles with five degrees of freedom: median, 97.5 %, and 1 - 1e-7.
CHI2_MEDIAN, CHI2_WEIGHT, CHI2_CUTOFF = 4.3515, 12.8325, 41.8
#: Variances added to the diagonal, in the order of FEATURES.
FLOORS = (0.25, 0.0025, 0.04, 0.25, 1.0)
FEATURES = ("x_words", "x_length", "x_symbols", "x_lines", "x_repeats")
_P = len(FEATURES)
_SPACE = "[\\x20\\x09-\\x0D]+"
_BUCKETS = 8


def with_statistics(df: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of ``text``."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, _SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumns({"__w": words, "__l": lines, "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")})
    n = F.size("__w")
    df = df.select("*", n.cast("long").alias("n_words"), F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
                   (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                   F.ceil(F.log2(n + F.lit(2.0))).cast("int").alias("__b")).drop("__l", "text")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))

    # high bits of the window's hash, then its place: sorting brings equal windows together
    packed = F.when(F.col("n_words") >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.col("__hi").bitwiseAND(window(i)).bitwiseOR(i.cast("long")))))
    df = df.withColumn("__hi", F.expr("shiftleft(-1L, __b)")).withColumn("__s", packed)

    def at(j: Column) -> Column:
        return F.get("__s", j).bitwiseAND(F.bitwise_not("__hi")).cast("int")

    near = F.filter(F.sequence(F.lit(0), F.size("__s") - 1), lambda j: F.coalesce(
        F.get("__s", j).bitwiseXOR(F.get("__s", j + 1)).bitwiseAND(F.col("__hi")) == 0, F.lit(False)))
    equal = F.filter(near, lambda j: reduce(  # the hash says so; the words decide
        lambda a, b: a & b, [F.get("__w", at(j) + k) == F.get("__w", at(j + 1) + k) for k in range(3)]))
    starts = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda j: F.array(at(j), at(j + 1))))))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__w", "__s", "__b", "__hi")


def base_failed(min_words: int = MIN_WORDS, max_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_percent * F.col("n_words"))


def _features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))

    def share(c: str) -> Column:
        return F.log1p(F.lit(100.0) * F.col(c) / n)

    return {"x_words": F.log1p(F.col("n_words").cast("double")), "x_length": F.log((F.col("word_chars") + 1.0) / n),
            "x_symbols": share("n_symbols"), "x_lines": share("n_dup_lines"), "x_repeats": share("n_repeat_words")}


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(_P) for j in range(i + 1)]


def _with_cholesky(est: DataFrame) -> DataFrame:
    """From means m0.. and covariances c{i}{j}: floors, the lower factor l{i}{j} and log determinant."""
    for i, j in _pairs():
        rest = F.col(f"c{i}{j}") + (FLOORS[i] if i == j else 0.0)
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] / 2))) if i == j
                             else rest / F.col(f"l{j}{j}"))
    return est.withColumn("logdet", sum((F.log(f"l{i}{i}") for i in range(1, _P)), F.log("l00")) * 2)


def _estimate(rows: DataFrame, *by: str) -> DataFrame:
    """Mean and covariance of the rows of each cell, with the factor."""
    x = [F.col(c) for c in FEATURES]
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}{j}") for i, j in _pairs()])
    return _with_cholesky(sums)


def _with_distance(rows: DataFrame) -> DataFrame:
    """``d2`` by forward substitution with the cell's factor."""
    for i, c in enumerate(FEATURES):
        rest = F.col(c) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, _P)), F.col("y0") * F.col("y0"))) \
        .withColumn("bucket", F.floor(F.log2(F.col("d2") + 1e-9) * _BUCKETS).cast("int"))


def _share_bucket(rows: DataFrame, share: float, *by: str) -> DataFrame:
    """Per cell the least distance bucket up to which ``share`` of its rows lie."""
    counts = rows.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("k"))
    below = Window.partitionBy(*by).orderBy("bucket")
    cell = Window.partitionBy(*by)
    return counts.withColumns({"upto": F.sum("k").over(below), "all": F.sum("k").over(cell)}) \
        .where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy(*by).agg(F.min("bucket").alias("limit"))


def _factors(est: DataFrame, *more: str) -> DataFrame:
    return est.select("cell", *more, *[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i, j in _pairs()])


def _c_step(rows: DataFrame, est: DataFrame) -> DataFrame:
    near = _with_distance(rows.join(_factors(est, "start"), "cell"))
    limits = _share_bucket(near, H_SHARE, "cell", "start")
    return keep(_estimate(near.join(limits, ["cell", "start"]).where("bucket <= limit"), "cell", "start"))


def with_cells(rows: DataFrame) -> DataFrame:
    """The estimation cell of each row: its (language, source), or a pool of small cells."""
    own, lang = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    large = F.col("n") >= MIN_ROWS
    rest = counts.where(~large).groupBy("lang").agg(F.sum("n").alias("rest"))
    cells = counts.alias("c").join(rest.alias("r"), F.col("c.lang").eqNullSafe(F.col("r.lang")), "left").select(
        F.to_json(F.struct("c.lang", "c.source")).alias("own"),
        F.when(large, F.concat(F.lit("cell "), F.to_json(F.struct("c.lang", "c.source"))))
        .when(F.col("rest") >= MIN_ROWS, F.concat(F.lit("rest "), F.to_json(F.struct("c.lang"))))
        .otherwise("rest").alias("cell"))
    # written, so that Spark knows how few they are: of a join it expects the product, and would broadcast the rows instead
    return rows.withColumn("own", own).join(keep(cells), "own").drop("own")


def mcd(rows: DataFrame, c_steps: int = C_STEPS) -> DataFrame:
    """Per cell: means, factor and consistency factor ``scale`` of the reweighted estimate."""
    rows = keep(rows.select("cell", *FEATURES))
    quartiles = rows.groupBy("cell").agg(*[
        F.percentile(F.round(F.col(c) * 64) / 64, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}")
        for i, c in enumerate(FEATURES)])
    spread = _with_cholesky(quartiles.select(
        "cell", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(_P)],
        *[(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
          for i, j in _pairs()]))
    est = keep(_factors(spread.withColumn("start", F.lit(1)), "start")
               .unionByName(_factors(_estimate(rows, "cell").withColumn("start", F.lit(0)), "start")))
    for step in range(2 * c_steps):
        est = _c_step(rows, est)
        if step + 1 == c_steps:  # the start with the smaller determinant goes on
            best = est.groupBy("cell").agg(F.min_by(F.struct(*est.columns[1:]), F.struct("logdet", "start")).alias("e"))
            est = keep(best.select("cell", "e.*"))
    scale = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("limit") + 0.5) / _BUCKETS) / CHI2_MEDIAN)

    def scaled(by: DataFrame) -> DataFrame:
        far = _with_distance(rows.join(_factors(by), "cell"))
        return far.join(_share_bucket(far, 0.5, "cell").select("cell", scale.alias("scale")), "cell")

    final = keep(_estimate(scaled(est).where(F.col("d2") <= CHI2_WEIGHT * F.col("scale")), "cell"))
    half = _share_bucket(_with_distance(rows.join(_factors(final), "cell")), 0.5, "cell")
    return keep(_factors(final.join(half, "cell").withColumn("scale", scale), "n", "scale"))


def verdicts(docs: DataFrame, cutoff: float = CHI2_CUTOFF) -> DataFrame:
    """Every row's statistics, ``base_failed``, ``kept`` and scaled squared ``distance``;
    lang, source and the text's hash (``text_hash``) go along."""
    docs = prepared(docs, doc_id="bigint", text="string", lang="string", source="string")
    stats = keep(with_statistics(docs.withColumn("text_hash", F.xxhash64("text")))
                 .withColumn("base_failed", base_failed()).withColumns(_features()))
    rows = keep(with_cells(stats.where(~F.col("base_failed"))))
    judged = _with_distance(rows.join(mcd(rows), "cell", "left"))
    distance = F.col("d2") / F.col("scale")
    small = F.col("n").isNull() | (F.col("n") < MIN_ROWS * H_SHARE / 2)
    keys = ["doc_id", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
            "n_repeat_words", "base_failed"]
    good = judged.select(*keys, (small | F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
                         distance.alias("distance"))
    return good.unionByName(stats.where("base_failed").select(
        *keys, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))


def without_outliers(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that are kept."""
    keys = ["doc_id", "lang", "source", "text_hash"]
    out = verdicts(docs).where(~F.col("kept")).select(*[F.col(c).alias(f"__lh_{c}") for c in keys])
    own = {"doc_id": F.col("doc_id").cast("bigint"), "lang": F.col("lang"), "source": F.col("source"),
           "text_hash": F.xxhash64("text")}
    same = reduce(lambda a, b: a & b, [own[c].eqNullSafe(F.col(f"__lh_{c}")) for c in keys])
    return docs.join(out, same, "left_anti")
