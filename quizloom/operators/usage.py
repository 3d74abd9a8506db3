"""Token usage and its cost."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import TOKEN_PRICES

COUNTERS = ["input_tokens", "output_tokens", "total_tokens"]


def usage_by_exam(usage: DataFrame) -> DataFrame:
    """Counter sums per exam and for the run; the run's row has a null exam."""
    totals = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTERS]
    return usage.rollup("exam").agg(*totals, (F.grouping("exam") == 1).alias("is_total"))


def model_class(model: Column) -> Column:
    return F.when(F.contains(F.lower(model), F.lit("flash")), "flash").otherwise("pro")


def token_cost(model: Column, prices: dict[str, tuple[float, float]] = TOKEN_PRICES) -> Column:
    """USD for one row's counters at its own model's prices."""

    def price(side: int) -> Column:
        chosen = F.lit(prices["pro"][side])
        return F.when(model_class(model) == "flash", F.lit(prices["flash"][side])).otherwise(chosen)

    read = F.coalesce("input_tokens", F.lit(0)) / 1_000_000 * price(0)
    written = F.coalesce("output_tokens", F.lit(0)) / 1_000_000 * price(1)
    return read + written


def cost_by_exam(usage: DataFrame) -> DataFrame:
    """Cost per exam and for the run; counters are summed before they are priced."""
    by_model = usage.groupBy("exam", model_class(F.col("model")).alias("model")).agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTERS]
    )
    return by_model.rollup("exam").agg(
        F.sum(token_cost(F.col("model"))).alias("cost_usd"),
        (F.grouping("exam") == 1).alias("is_total"),
    )
