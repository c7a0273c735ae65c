"""Planned and actual cost of generation runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# USD for a million tokens (input, cached, output) and a million token hours; names that stand for models.
PRICES = {"gemini-2.5-flash": (0.30, 0.03, 2.50, 1.00), "gemini-2.5-pro": (1.25, 0.125, 10.00, 4.50)}
ALIASES = {"flash": "gemini-2.5-flash", "pro": "gemini-2.5-pro"}
BATCH_DISCOUNT = 0.5
CHARS_PER_TOKEN = 4.0
INPUT_TOKENS, OUTPUT_TOKENS = 1100, 600


def prices(spark: SparkSession) -> DataFrame:
    """(model, input_p, cached_p, output_p, storage_p); a row for each known model."""
    return spark.createDataFrame([(k, *v) for k, v in PRICES.items()], "model string, input_p double, cached_p double, output_p double, storage_p double")


def resolve_model(name: Column) -> Column:
    """The model that a name or alias stands for; an unknown one is an error."""
    known = F.create_map(*(F.lit(x) for pair in (*ALIASES.items(), *((k, k) for k in PRICES)) for x in pair))
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(name))), F.raise_error(F.concat(F.lit("unknown model "), name)))


def token_estimate(chars: Column) -> Column:
    return F.greatest(F.lit(0), F.floor(chars / CHARS_PER_TOKEN))


def _discount(mode: Column) -> Column:
    return F.when(mode == "batch", BATCH_DISCOUNT).otherwise(1.0)


def planned(runs: DataFrame, input_tokens: int = INPUT_TOKENS, output_tokens: int = OUTPUT_TOKENS, hours: float = 1.0, rounded: bool = True) -> DataFrame:
    """Runs (model, mode, n_questions, doc_tokens) with what filling and keeping the cache, a question, and all cost.

    A model without a price is an error. Sums are rounded to 4 decimals, a question's cost to 6, halves up.
    """
    rows = runs.join(F.broadcast(prices(runs.sparkSession)), "model", "left")
    known = F.when(F.col("input_p").isNull(), F.raise_error(F.concat(F.lit("no price for model "), "model"))).otherwise(F.col("input_p"))
    create, keep = F.col("doc_tokens") * known / 1e6, F.col("doc_tokens") * F.col("storage_p") * hours / 1e6
    each = F.col("doc_tokens") * F.col("cached_p") / 1e6 + input_tokens * F.col("input_p") * _discount(F.col("mode")) / 1e6 + output_tokens * F.col("output_p") * _discount(F.col("mode")) / 1e6
    cut = F.round if rounded else (lambda c, _: c)
    return rows.select(*runs.columns, cut(create, 4).alias("create_usd"), cut(keep, 4).alias("storage_usd"), cut(each, 6).alias("question_usd"), cut(create + keep + each * F.col("n_questions"), 4).alias("total_usd"))


def actual(runs: DataFrame, digits: int = 6) -> DataFrame:
    """Runs (model, mode, input_tokens, output_tokens, cached_tokens, token_hours) with cost_usd; 0 for unknown models."""
    rows = runs.join(F.broadcast(prices(runs.sparkSession)), "model", "left")
    fresh = F.greatest(F.col("input_tokens") - F.col("cached_tokens"), F.lit(0))
    cost = fresh * F.col("input_p") * _discount(F.col("mode")) / 1e6 + F.col("cached_tokens") * F.col("cached_p") / 1e6 + F.col("output_tokens") * F.col("output_p") * _discount(F.col("mode")) / 1e6 + F.col("token_hours") * F.col("storage_p") / 1e6
    return rows.select(*runs.columns, F.coalesce(F.round(cost, digits), F.lit(0.0)).alias("cost_usd"))


def selected(nodes: DataFrame, runs: DataFrame, questions_each: int = 1) -> DataFrame:
    """planned() of runs (run_id, doc_id, model, mode, doc_tokens) for the selected sections (doc_id, node_id) alone."""
    asked = nodes.groupBy("doc_id").agg((F.countDistinct("node_id") * questions_each).alias("n_questions"))
    return planned(runs.join(asked, "doc_id"))


def bundle_total(bundles: DataFrame) -> DataFrame:
    """(bundle_id, cost_usd): the cost of all runs in each bundle, unknown ones counting 0."""
    each = F.aggregate("runs", F.lit(0.0), lambda a, r: a + F.coalesce(r["cost_usd"].cast("double"), F.lit(0.0)))
    return bundles.select("bundle_id", F.round(F.coalesce(each, F.lit(0.0)), 6).alias("cost_usd"))


def scenario_totals(rows: DataFrame, digits: int = 6) -> DataFrame:
    """One row with the sums of scenarios() and the savings that follow from them."""
    sums = rows.agg(F.count("*").alias("documents"), F.sum("n_chunks").alias("n_chunks"), F.sum("tokens").alias("tokens"), *(F.round(F.sum(c), digits).alias(c) for c in ("immediate_usd", "no_cache_usd", "batch_usd")))
    return sums.withColumn("savings_pct", F.when(F.col("no_cache_usd") > 0, F.round(100 * (1 - F.col("batch_usd") / F.col("no_cache_usd")), 4)).otherwise(0.0))


def scenarios(documents: DataFrame, model: str = "gemini-2.5-flash", digits: int = 6) -> DataFrame:
    """Documents (doc_id, n_chunks, chars), one question a chunk: cost at once, without cache, in batches, and savings."""
    into, cached, out, keep = PRICES[model]
    tokens = token_estimate(F.col("chars"))
    n = F.col("n_chunks")
    once = tokens * (into + keep) / 1e6 + n * (tokens * cached + INPUT_TOKENS * into + OUTPUT_TOKENS * out) / 1e6
    bare = n * ((tokens + INPUT_TOKENS) * into + OUTPUT_TOKENS * out) / 1e6
    batch = tokens * (into + keep) / 1e6 + n * (tokens * cached + BATCH_DISCOUNT * (INPUT_TOKENS * into + OUTPUT_TOKENS * out)) / 1e6
    rows = documents.select("doc_id", "n_chunks", tokens.alias("tokens"), F.round(once, digits).alias("immediate_usd"), F.round(bare, digits).alias("no_cache_usd"), F.round(batch, digits).alias("batch_usd"))
    return rows.withColumn("savings_pct", F.when(F.col("no_cache_usd") > 0, F.round(100 * (1 - F.col("batch_usd") / F.col("no_cache_usd")), 4)).otherwise(0.0))
