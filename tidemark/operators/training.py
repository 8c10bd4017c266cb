"""Trailing training windows, winsorizing, scaling, tree ensembles and score reuse.

A fit pools the trailing rows of all symbols at a cutoff, with winsor bounds and scaling per symbol, so the
fitting itself is distributed ``pyspark.ml`` work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..params import FEATURES, RULES, Rules
from ..session import materialize
from . import series


def labeled(features: DataFrame) -> DataFrame:
    """Rows with a known label, missing inputs set to 0 (only here, at the model's edge)."""
    return features.filter(F.col("target").isNotNull()).fillna(0, FEATURES)


def training_window(features: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The last 180 labeled rows per symbol, ``back`` counting from the newest. A top-k per symbol: cut per
    map task before the shuffle."""
    newest = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return labeled(features).withColumn("back", F.row_number().over(newest)).filter(F.col("back") <= rules.train_window)


def training_rows(features: DataFrame, cutoffs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Training rows of every (symbol, cutoff): the 180 labeled rows before the cutoff's own row, for cutoffs
    with at least 80 of them. An equi join on (symbol, ordinal), not a range join.

    ``cutoffs``: dates at which a model is wanted. ``features`` is read by several branches.
    """
    numbered = series.ordinals(features.drop("rn"), name="fn")
    at = numbered.join(F.broadcast(cutoffs.select("date").distinct()), "date", "left_semi").filter(
        F.col("fn") - 1 >= rules.min_history
    )
    wanted = at.select(
        "symbol", F.col("date").alias("cutoff"), F.col("fn").alias("cutoff_fn"),
        F.explode(F.sequence(F.greatest(F.col("fn") - rules.train_window, F.lit(1)), F.col("fn") - 1)).alias("fn"),
    )
    rows = wanted.join(labeled(numbered), ["symbol", "fn"])
    return rows.withColumn("back", F.col("cutoff_fn") - F.col("fn")).drop("cutoff_fn", "fn")


def split(window: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The newest 20 rows are held out."""
    return window.withColumn("holdout", F.col("back") <= rules.holdout)


def winsor_bounds(rows: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:
    """1st and 99th percentile of every input per group. A group is one training window (at most 180 rows),
    which bounds the exact percentile's state."""
    q = F.array(F.lit(P.WINSOR_LOW), F.lit(P.WINSOR_HIGH))
    return rows.groupBy(*keys).agg(*[F.percentile(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), q).alias(c) for c in FEATURES])


def clip(rows: DataFrame, bounds: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:
    """Bounds fitted on one set applied to another."""
    named = bounds.select(*keys, F.struct(*FEATURES).alias("_b"))
    clipped = {c: F.least(F.greatest(F.col(c).cast("double"), F.col("_b")[c][0]), F.col("_b")[c][1]) for c in FEATURES}
    return rows.join(named, keys).withColumns(clipped).drop("_b")


def scale_stats(rows: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:
    """Mean and population standard deviation of every input; a deviation of 0 scales by 1."""

    def pair(c: str) -> Column:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        std = F.stddev_pop(x)
        return F.array(F.avg(x), F.when(std == 0, F.lit(1.0)).otherwise(std)).alias(c)

    return rows.groupBy(*keys).agg(*[pair(c) for c in FEATURES])


def scale(rows: DataFrame, stats: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:
    named = stats.select(*keys, F.struct(*FEATURES).alias("_s"))
    scaled = {c: (F.col(c) - F.col("_s")[c][0]) / F.col("_s")[c][1] for c in FEATURES}
    return rows.join(named, keys).withColumns(scaled).drop("_s")


def tall(wide: DataFrame, first: str, second: str, keys: list[str] = ["symbol"]) -> DataFrame:
    """Pairs per input as one row per (group, feature)."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c)[0].alias(first), F.col(c)[1].alias(second)) for c in FEATURES
    ])
    return wide.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")


def class_weights(rows: DataFrame, keys: list[str] = []) -> DataFrame:
    """n / (2 * n_class): one row per class and group."""
    counts = rows.groupBy(*keys, "target").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    return counts.withColumn("weight", total / (2.0 * F.col("n")))


def accuracy() -> Column:
    return F.avg((F.col("prediction") == F.col("target")).cast("double"))


def prepared(train: DataFrame, score: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Winsorize and scale both sets with what the training side gives, weight the classes, assemble."""
    from pyspark.ml.feature import VectorAssembler

    bounds = winsor_bounds(train)
    fitted, applied = clip(train, bounds), clip(score.fillna(0, FEATURES), bounds)
    stats = scale_stats(fitted)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="x")
    weights = class_weights(train).select("target", "weight")  # two rows
    fitted = scale(fitted, stats).join(F.broadcast(weights), "target")
    return assembler.transform(fitted), assembler.transform(scale(applied, stats))


def forest(trees: int):
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(
        featuresCol="x", labelCol="target", weightCol="weight", numTrees=trees, maxDepth=6,
        minInstancesPerNode=5, seed=42, probabilityCol="p_forest", predictionCol="y_forest", rawPredictionCol="r_forest",
    )


def boosted(trees: int):
    """Boosted trees. ``pyspark.ml`` has no L2 leaf penalty; the minimum gain and node size are the
    regularisers it shares."""
    from pyspark.ml.classification import GBTClassifier

    model = GBTClassifier(
        featuresCol="x", labelCol="target", maxIter=trees, maxDepth=4, stepSize=0.05, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", minInstancesPerNode=5, minInfoGain=0.0005, seed=42, predictionCol="y_boosted",
    )
    return model.setProbabilityCol("p_boosted").setRawPredictionCol("r_boosted")


def _up(column: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(column))[1]


def at_cutoff(features: DataFrame, cutoff, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """(training rows, rows to score) for one cutoff date, pooled over symbols."""
    before = features.filter(F.col("date") < F.lit(cutoff))
    window = training_window(before, rules)
    enough = window.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= rules.min_history)
    window = window.join(enough.select("symbol"), "symbol", "left_semi")
    today = features.filter(F.col("date") == F.lit(cutoff))
    return window, today


def score_cutoff(features: DataFrame, cutoff, trees: int = 50, rules: Rules = RULES) -> DataFrame:
    """Ensemble probability of every symbol at the cutoff. The refit uses the whole window. A symbol without enough history gets probability 0
    and no signal, and so do all where none has enough."""
    window, today = at_cutoff(features, cutoff, rules)
    every = today.select("symbol", "date").distinct()
    if window.isEmpty():
        return ensemble(every.withColumns({"rf_prob": F.lit(0.0), "xgb_prob": F.lit(0.0)}), rules)
    train, score = prepared(window, today)
    train, score = materialize(train), materialize(score)
    both = boosted(trees).fit(train).transform(forest(trees).fit(train).transform(score))
    found = both.select("symbol", "date", _up("p_forest").alias("rf_prob"), _up("p_boosted").alias("xgb_prob"))
    whole = every.join(found, ["symbol", "date"], "left").fillna(0.0, ["rf_prob", "xgb_prob"])
    return ensemble(whole, rules)


def top_features(model, k: int = 5) -> Column:
    """The names of a fitted tree model's ``k`` most important inputs, as a constant array."""
    ranked = sorted(zip(FEATURES, model.featureImportances.toArray().tolist()), key=lambda pair: (-pair[1], pair[0]))
    return F.array(*[F.lit(name) for name, _ in ranked[:k]])


def signal_result(features: DataFrame, cutoff, trees: int = 50, rules: Rules = RULES) -> DataFrame:
    """The whole signal result of every symbol at the cutoff, one row each: both probabilities, their mean, the signal, both
    accuracies on the symbol's newest rows (fitted without them), the number of training rows and the forest's top inputs.

    A symbol without enough history is ``insufficient``: probabilities and accuracies 0, no signal, no top inputs.
    """
    window, today = at_cutoff(features, cutoff, rules)
    rows = training_window(features.filter(F.col("date") < F.lit(cutoff)), rules).groupBy("symbol").agg(F.count(F.lit(1)).alias("train_rows"))
    keys = today.select("symbol", "date").distinct().join(rows, "symbol", "left").withColumn("train_rows", F.coalesce("train_rows", F.lit(0).cast("bigint")))
    keys = keys.withColumn("insufficient", F.col("train_rows") < rules.min_history)
    figures = ["rf_prob", "xgb_prob", "rf_accuracy", "xgb_accuracy"]
    none = F.array().cast("array<string>")
    if window.isEmpty():
        whole = keys.withColumns({c: F.lit(0.0) for c in figures} | {"top_features": none})
        return ensemble(whole, rules)
    marked = split(materialize(window), rules)
    held_in, held_out = prepared(marked.filter(~F.col("holdout")), marked.filter("holdout"))
    held_in = materialize(held_in)
    tested = boosted(trees).fit(held_in).transform(forest(trees).fit(held_in).transform(held_out))
    hit = lambda c: F.avg((F.col(c) == F.col("target")).cast("double"))
    accuracy_ = tested.groupBy("symbol").agg(hit("y_forest").alias("rf_accuracy"), hit("y_boosted").alias("xgb_accuracy"))
    train, score = prepared(marked.drop("holdout"), today)
    train = materialize(train)
    first = forest(trees).fit(train)
    found = boosted(trees).fit(train).transform(first.transform(score)).select(
        "symbol", _up("p_forest").alias("rf_prob"), _up("p_boosted").alias("xgb_prob"), top_features(first).alias("top_features"))
    whole = keys.join(found, "symbol", "left").join(accuracy_, "symbol", "left").fillna(0.0, figures)
    return ensemble(whole.withColumn("top_features", F.coalesce("top_features", none)), rules)


def signal_results(features: DataFrame, cutoffs: list, trees: int = 50, parallelism: int = 4, rules: Rules = RULES) -> DataFrame:
    """``signal_result`` at several cutoffs, fitted at the same time. Pass materialized features."""
    return _each(features, cutoffs, lambda cutoff: signal_result(features, cutoff, trees, rules), parallelism)


def _each(features: DataFrame, cutoffs: list, one, parallelism: int) -> DataFrame:
    from functools import reduce
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    run = inheritable_thread_target(features.sparkSession)(lambda cutoff: materialize(one(cutoff)))
    with ThreadPool(parallelism) as pool:
        return reduce(DataFrame.unionByName, pool.map(run, cutoffs))


def walk_forward(features: DataFrame, cutoffs: list, trees: int = 50, parallelism: int = 4, rules: Rules = RULES) -> DataFrame:
    """Scores at several cutoffs. Each cutoff is its own pair of fits; they are independent, so ``parallelism``
    of them submit their Spark jobs at the same time. Pass materialized features."""
    return _each(features, cutoffs, lambda cutoff: score_cutoff(features, cutoff, trees, rules), parallelism)


def ensemble(scores: DataFrame, rules: Rules = RULES) -> DataFrame:
    mean = (F.col("rf_prob") + F.col("xgb_prob")) / 2
    return scores.withColumn("ensemble_prob", mean).withColumn("signal", F.col("ensemble_prob") >= rules.signal_threshold)


def holdout_accuracy(features: DataFrame, cutoff, trees: int = 50, rules: Rules = RULES) -> DataFrame:
    """Fit on all but the newest 20 rows per symbol, accuracy of both models on those 20."""
    window, _ = at_cutoff(features, cutoff, rules)
    marked = split(window, rules)
    train, held = prepared(marked.filter(~F.col("holdout")), marked.filter("holdout"))
    train = materialize(train)
    both = boosted(trees).fit(train).transform(forest(trees).fit(train).transform(held))
    hit = lambda c: F.avg((F.col(c) == F.col("target")).cast("double"))
    return both.agg(hit("y_forest").alias("rf_accuracy"), hit("y_boosted").alias("xgb_accuracy"), F.count(F.lit(1)).alias("n"))


def importances(model) -> DataFrame:
    """(feature, importance) of a fitted tree model: one row per input."""
    from pyspark.sql import SparkSession

    rows = [(name, float(value)) for name, value in zip(FEATURES, model.featureImportances.toArray())]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def top_importances(table: DataFrame, k: int = 5) -> DataFrame:
    return table.orderBy(F.col("importance").desc(), "feature").limit(k)


def retrain_dates(days: DataFrame, every: int) -> DataFrame:
    """Days on which a symbol is scored anew: the first one, then always the first day at least ``every``
    days after the previous one. That is a chain, so it folds over the symbol's sorted day numbers; only the
    days are collected, at most 366 integers a year whatever the data size.
    """
    number = F.datediff("date", F.lit("1970-01-01").cast("date"))
    lists = days.groupBy("symbol").agg(F.sort_array(F.collect_set(number)).alias("days"))
    start = F.array().cast("array<int>")

    def step(chosen: Column, day: Column) -> Column:
        due = (F.size(chosen) == 0) | (day - F.element_at(chosen, -1) >= every)
        return F.when(due, F.concat(chosen, F.array(day))).otherwise(chosen)

    # element_at is not evaluated for an empty list: the size test comes first
    chosen = F.aggregate("days", start, lambda c, x: F.when(F.size(c) == 0, F.array(x)).otherwise(step(c, x)))
    return lists.select("symbol", F.explode(chosen).alias("_n")).select(
        "symbol", F.date_add(F.lit("1970-01-01").cast("date"), F.col("_n")).alias("date")
    )


def reuse_scores(days: DataFrame, scores: DataFrame, within: int | None = None) -> DataFrame:
    """Every (symbol, date) with the score of its latest scored day. ``scores`` has the scored days only.

    With ``within`` a score is used on its day and the ``within`` - 1 days after it; later days have none until the next one.
    """
    joined = days.join(scores.select("symbol", "date", F.struct("date", "prob").alias("_s")), ["symbol", "date"], "left")
    filled = series.running(joined.withColumn("_year", F.year("date")), ["symbol"], ["date"], "_year", _f=("last", "_s"))
    fresh = F.lit(True) if within is None else F.datediff("date", F.col("_f.date")) < within
    return filled.select("symbol", "date", F.when(fresh, F.col("_f.date")).alias("scored_on"), F.when(fresh, F.col("_f.prob")).alias("prob"))


def with_insufficient(days: DataFrame, scores: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Days without enough history get probability 0 and no signal."""
    joined = days.join(scores, ["symbol", "date"], "left")
    return joined.withColumn("prob", F.coalesce("prob", F.lit(0.0))).withColumn(
        "signal", F.col("prob") >= rules.signal_threshold
    )
