"""Profile of the screening and category tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostra import constants as K
from rostra.functions import text as tx
from rostra.functions.numbers import round_scaled
from rostra.operators.ordering import add_rank


def summary(screening: DataFrame, categories: DataFrame) -> DataFrame:
    """Rows, positive rate, distinct roles, exact median word counts, category rows and categories; one row.

    Exact medians come from counts per distinct word count: the state is one entry per distinct length.
    """
    main = screening.select(
        "label", "job_role", tx.word_count(F.col("resume")).alias("rw"),
        tx.word_count(F.col("job_description")).alias("jw")).agg(
        F.count("*").alias("rows"), F.round(F.avg("label"), 4).alias("positive_rate"),
        F.countDistinct("job_role").alias("unique_roles"), F.percentile("rw", F.lit(0.5)).alias("resume_words_median"),
        F.percentile("jw", F.lit(0.5)).alias("jd_words_median"))
    cats = categories.agg(F.struct(F.count("*").alias("n"), F.countDistinct("category").alias("c")).alias("s")).scalar()
    return main.select("*", cats["n"].alias("category_rows"), cats["c"].alias("categories"))


def label_distribution(screening: DataFrame) -> DataFrame:
    name = F.when(F.col("label") == 0, "Not matched").when(F.col("label") == 1, "Matched")
    return screening.groupBy(name.alias("label_name")).agg(F.count("*").alias("rows"))


def top_values(df: DataFrame, column: str, n: int | None) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    return counts if n is None else counts.orderBy(F.desc("rows"), column).limit(n)


def top_skills(profiles: DataFrame, n: int = 20) -> DataFrame:
    return top_values(profiles.select(F.explode("skills").alias("skill")), "skill", n)


def length_histogram(df: DataFrame, text: str, bins: int = 40) -> DataFrame:
    """Equal-width bins of the word count, the last one closed on the right. Empty bins are listed.

    Words are counted once per text; the bounds and bins then come from the counts per distinct length.
    """
    lengths = df.select(tx.word_count(F.col(text)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    ends = lengths.agg(F.struct(F.min("w").cast("double").alias("lo"), F.max("w").cast("double").alias("hi")).alias("e")).scalar()
    # Without any spread the bins surround the single value.
    lo = F.when(ends["lo"] == ends["hi"], ends["lo"] - 0.5).otherwise(ends["lo"])
    hi = F.when(ends["lo"] == ends["hi"], ends["hi"] + 0.5).otherwise(ends["hi"])
    width = (hi - lo) / bins
    counted = lengths.groupBy(
        F.least(F.floor((F.col("w") - lo) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.sum("n").alias("rows"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(counted, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"), F.coalesce("rows", F.lit(0)).alias("rows")))


def exact_quantiles(df: DataFrame, groups: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """Exact, interpolated quantiles of a column per group: ``shares`` maps new names to shares of the rows.

    Rows are ranked over range partitions, so a group of any size is spread over many tasks; only the two rows around each
    quantile go on.
    """
    ranked = add_rank(df.select(*groups, F.col(column).cast("double").alias("__x")).where("__x is not null"), groups, [F.col("__x")], "__rank", "__size")
    out = []
    for name, share in shares.items():
        place = (F.col("__size") - 1) * F.lit(share)
        low, high = F.floor(place), F.ceil(place)
        below = F.max(F.when(F.col("__rank") - 1 == low, F.col("__x")))
        above = F.max(F.when(F.col("__rank") - 1 == high, F.col("__x")))
        apart = F.max(place - low)
        out.append(F.when(apart == 0, below).otherwise((1 - apart) * below + apart * above).alias(name))
    return ranked.groupBy(*groups).agg(*out)


def box_stats(features: DataFrame, column: str, label: str = "label") -> DataFrame:
    """Quartiles and whiskers (the furthest values within 1.5 interquartile ranges) per label."""
    q = exact_quantiles(features, [label], column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col(column)
    return (features.select(label, column).join(F.broadcast(q), label).groupBy(label, "q1", "median", "q3").agg(
        F.min(F.when(value >= F.col("q1") - reach, value)).alias("whisker_low"),
        F.max(F.when(value <= F.col("q3") + reach, value)).alias("whisker_high"))
        .withColumn("feature", F.lit(column)))


def feature_correlation(features: DataFrame, label: str = "label") -> DataFrame:
    """Correlation of every feature with the label, three decimals; null for a constant column. One pass."""
    y = F.col(label).cast("double")
    # The built-in correlation fails on a constant column; dividing here gives null instead.
    one = features.agg(*[F.try_divide(F.covar_pop(f, y), F.stddev_pop(f) * F.stddev_pop(y)).alias(f) for f in K.FEATURE_NAMES])
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), round_scaled(F.col(f), 3).alias("correlation"))
                        for f in K.FEATURE_NAMES])
    return one.select(F.explode(entries).alias("e")).select("e.*").orderBy(F.desc_nulls_last("correlation"), "feature")


def overview(screening: DataFrame) -> DataFrame:
    return screening.agg(F.count("*").alias("applications"), F.countDistinct("job_role").alias("job_roles"),
                         F.avg("label").alias("match_rate"))


def role_list(screening: DataFrame) -> DataFrame:
    return screening.select("job_role").distinct().orderBy("job_role")


def usage_rollup(log: DataFrame) -> DataFrame:
    """Calls, characters and seconds by purpose, model and outcome."""
    by = ["purpose", "model", "ok"]
    sums = log.groupBy(*by).agg(
        F.count("*").alias("calls"), F.sum("prompt_chars").alias("prompt_chars"),
        F.sum("output_chars").alias("output_chars"), F.round(F.avg("seconds"), 6).alias("avg_seconds"))
    medians = exact_quantiles(log, by, "seconds", {"median_seconds": 0.5}).select(
        F.struct(*by).alias("of"), F.round("median_seconds", 6).alias("median_seconds"))
    return sums.join(medians, F.struct(*by).eqNullSafe(F.col("of")), "left").drop("of")


def latest(log: DataFrame, n: int = 50, order: str = "ts", tie: str | None = None) -> DataFrame:
    """The last rows of the log, oldest first. Only ``n`` rows leave each partition."""
    keys = [order] + ([tie] if tie else [])
    return log.orderBy(*[F.desc(k) for k in keys]).limit(n).orderBy(*keys)
