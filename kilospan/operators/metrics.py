"""Scoring forecasts and comparing models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.functions.errors import all_errors
from kilospan.plans.ranks import global_rank
from kilospan.plans.series import first_rows
from kilospan.plans.sizes import checkpointed, left_lookup


def forecast_metrics(
    df: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted",
    places: int | None = 4,
) -> DataFrame:
    """MAE, MSE, RMSE, MAPE and R² per group, in one pass."""
    errors = [c.alias(n) for n, c in all_errors(actual, predicted, places).items()]
    return df.groupBy(*by).agg(*errors)


def mape_pivot(results: DataFrame, entity: str, models: list[str]) -> DataFrame:
    """Entities by models, with a last row "Average" of the column means."""
    # every result counts once in its entity's row and once in the last one
    names = F.array(F.col(entity).cast("string"), F.lit("Average"))
    rows = results.select(F.posexplode(names).alias("__last", entity), "model", "mape")
    by_model = [F.avg(F.when(F.col("model") == m, F.col("mape"))).alias(m) for m in models]
    return rows.groupBy("__last", entity).agg(*by_model).drop("__last")


def mape_by_model(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(F.avg("mape").alias("mean_mape"))


def best_model_per_entity(results: DataFrame, entity: str, models: list[str]) -> DataFrame:
    """The model with least MAPE; on a tie the one named first in ``models``."""
    place = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    least = F.struct(F.col("mape"), place.alias("place"), F.col("model"))
    best = results.where(F.col("mape").isNotNull()).groupBy(entity).agg(F.min(least).alias("b"))
    return best.select(
        entity, F.col("b.model").alias("best_model"), F.col("b.mape").alias("best_mape")
    )


def best_model_distribution(best: DataFrame) -> DataFrame:
    return best.groupBy("best_model").agg(F.count(F.lit(1)).alias("n_entities"))


def best_model_overall(results: DataFrame) -> DataFrame:
    return mape_by_model(results).orderBy("mean_mape", "model").limit(1)


def best_worst_entities(results: DataFrame, entity: str, n: int) -> DataFrame:
    """The ``n`` lowest and ``n`` highest MAPE entities of the best model overall.

    The results, one row per entity and model, are kept for the three looks at them.
    """
    results = checkpointed(results.select(entity, "model", "mape"))
    winner = best_model_overall(results).select(F.col("model").alias("__winner"))
    model = results.join(winner, F.col("model") == F.col("__winner")).select(entity, "mape")

    def ends(order: list[Column], label: str) -> DataFrame:
        picked = model.orderBy(*order).limit(n)
        place = F.row_number().over(Window.orderBy(*order))
        return picked.select(F.lit(label).alias("side"), place.alias("place"), entity, "mape")

    best = ends([F.asc("mape"), F.asc(entity)], "best")
    worst = ends([F.desc("mape"), F.desc(entity)], "worst")
    return best.unionByName(worst)


def horizon_head(df: DataFrame, keys: list[str], ts: str, steps: int) -> DataFrame:
    """The first ``steps`` rows of each series."""
    return first_rows(df, keys, F.asc(ts), steps).drop("__place")


def horizon_kpis(
    df: DataFrame, keys: list[str], ts: str, actual: str = "actual", predicted: str = "predicted",
    reserve_pct: float = 15.0,
) -> DataFrame:
    """Peak and its first time, base load, mean errors and reserve of a horizon."""
    order = F.struct(-F.col(predicted), F.col(ts))
    peak_at = F.min_by(ts, F.when(F.col(predicted).isNotNull(), order))
    return df.groupBy(*keys).agg(
        F.max(predicted).alias("peak"),
        F.date_format(peak_at, "HH:mm").alias("peak_time"),
        F.min(predicted).alias("base"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("pct_error").alias("mean_pct_error"),
        (F.max(predicted) * F.lit(1 + reserve_pct / 100.0)).alias("reserve"),
    )


def leaderboard(metrics: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Models with their category, ranked by RMSE; missing metrics stay NULL and last."""
    rows = metrics if registry is None else left_lookup(registry, metrics, ["model"])
    return global_rank(rows, [F.col("rmse").asc_nulls_last()], "rank")


def evaluate(predictions: DataFrame, entity: str, models: list[str], n: int = 5) -> dict[str, DataFrame]:
    """Every comparison table of a set of predictions."""
    results = forecast_metrics(predictions, [entity, "model"])
    best = best_model_per_entity(results, entity, models)
    return {
        "metrics": results,
        "pivot": mape_pivot(results, entity, models),
        "by_model": mape_by_model(results),
        "best": best,
        "distribution": best_model_distribution(best),
        "ends": best_worst_entities(results, entity, n),
    }
