"""Price models and rules."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.dedup import latest_per_key
from offerloom.operators.series import impute_median
from offerloom.sources.scratch import shared_dir, written

FEATURES = ("cost_price", "stock", "comp_p10", "comp_p50", "comp_p90", "comp_min", "comp_max")
BINS = 32  # of each feature, as MLlib has by default


def training_table(internal: DataFrame, daily: DataFrame) -> DataFrame:
    """Internal data with the latest competitor aggregates of each SKU; features without nulls, label sale_price."""
    d = internal.join(latest_per_key(daily, "sku_key", "date").drop("date"), "sku_key")
    return impute_median(d, list(FEATURES)).withColumn("label", F.col("sale_price").cast("double"))


def split_rows(table: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """80 % of the rows to learn from and the others, by a hash of the SKU, so alike on every run; all rows twice if there are fewer than 3."""
    if len(table.limit(3).take(3)) < 3:
        return table, table
    part = F.pmod(F.xxhash64("sku_key", F.lit(seed)), F.lit(5))
    return table.where(part != 0), table.where(part == 0)


def train_price_model(table: DataFrame, rounds: int = 300, step: float = 0.1, seed: int = 42, scale: bool = False, max_depth: int = 5, rows_per_task: int = 25_000, most_vectors: int = 10_000) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on one part of :func:`split_rows`, and the scored other part.

    Rows of one feature vector get the same prediction in every round, so they are one row of the fit: their mean label, weighted by
    their number. Of more than ``most_vectors`` vectors MLlib would draw a sample to choose each feature's ``BINS`` - 1 thresholds; these
    are quantiles of all rows then, and vectors of the same bins are one row. The rows of the fit are written, so no round works them
    out again, and read in tasks of ``rows_per_task``, as each level of each tree is a job; every ten rounds the residuals are cut
    from their lineage in the shared folder.
    """
    context = table.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(table.sparkSession))
    train, test = split_rows(written(table, "training"), seed)
    columns, stages, bins = list(FEATURES), [], BINS
    if len(train.select(columns).distinct().take(most_vectors + 1)) > most_vectors:
        binned = [f"{c}_bin" for c in columns]
        stages.append(QuantileDiscretizer(numBucketsArray=[BINS] * len(columns), inputCols=columns, outputCols=binned, handleInvalid="skip"))
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(f'{b} + 0 AS {b}_number' for b in binned)} FROM __THIS__"))  # numbers, no categories
        columns, bins = [f"{b}_number" for b in binned], 32 * BINS  # that many bins let MLlib look at a million rows, so it takes every bin's end as a threshold
    stages.append(VectorAssembler(inputCols=columns, outputCol="raw" if scale else "features", handleInvalid="skip"))
    if scale:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True))
    prepare = Pipeline(stages=stages).fit(train)
    label = F.avg(F.coalesce("label", F.lit(float("nan")))).alias("label")  # a row without label is refused by the fit
    cells = written(prepare.transform(train).groupBy("features").agg(label, F.count(F.lit(1)).cast("double").alias("weight")), "cells")
    trees = GBTRegressor(maxIter=rounds, stepSize=step, seed=seed, maxDepth=max_depth, maxBins=bins, checkpointInterval=10, weightCol="weight")
    model = PipelineModel([*prepare.stages, trees.fit(cells.repartition(-(-cells.count() // rows_per_task) or 1))])
    return model, model.transform(test)


def suggest_prices_ml(model: PipelineModel, table: DataFrame, sku: str | None = None) -> DataFrame:
    """C17: predicted price of all SKUs or of one, with the features it rests on."""
    d = table if sku is None else table.where(F.col("sku_key") == sku)
    return model.transform(d).select("sku_key", F.round("prediction", 2).alias("suggested_price"), *FEATURES)


def suggest_prices_rule(df: DataFrame, default_margin: float = 0.35) -> DataFrame:
    """Market median, raised to cost plus margin, MAP, p10 and minimum, then capped at the market's maximum.

    A missing margin is ``default_margin``, one of zero 0.12. p10 and minimum default to the median. The cap comes last and may cut
    below the margin.
    """
    col = lambda c, kind="double": F.col(c) if c in df.columns else F.lit(None).cast(kind)
    margin = F.coalesce(col("min_margin"), F.lit(default_margin))
    margin = F.when(margin == 0, 0.12).otherwise(margin)
    p50 = F.col("comp_p50")
    p10, low = F.coalesce(col("comp_p10"), p50), F.coalesce(col("comp_min"), p50)
    floor = F.greatest(p50, F.col("cost_price") * (1 + margin), F.when(col("map_price") != 0, col("map_price")), p10, low)
    price: Column = F.round(F.least(floor, col("comp_max")), 2)
    text = F.format_string("Based on the market median (%.2f), with a margin of at least %.0f%%, not above the market's maximum (%s).", p50.cast("double"), (margin * 100).cast("double"), F.coalesce(col("comp_max").cast("string"), F.lit("none")))
    evidence = F.struct("cost_price", "comp_p50", margin.alias("min_margin"), col("map_price").alias("map_price"), p10.alias("comp_p10"), low.alias("comp_min"), col("comp_max").alias("comp_max"))
    return df.select("sku_key", price.alias("suggested_price"), text.alias("rationale"), evidence.alias("evidence"))
