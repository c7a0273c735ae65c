"""A generation run over a store: sections chosen, questions suggested and solved, judged and saved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium import shared
from folium.functions import cost
from folium.operators import generation, rules
from folium.sources.store import Store


def run(store: Store, run_id: int, path: str, client: generation.Client, model: str = "flash", mode: str = "immediate", doc_id: int | None = None, limit: int | None = None, regenerate: bool = False, **asking) -> DataFrame:
    """Ask for questions of the store's sections and save them; returns the run's newest row.

    Answers are kept under path, so that a run that was broken off goes on with the same run_id and path. Of each section
    up to five questions are suggested; each is solved by itself. Solutions that break a rule of shape are failures, and
    so are sections without a suggestion. Where the correct option isn't a literal quotation, a question needs review.
    """
    spark = store.spark
    chosen, nodes_at = shared.stored(_chosen(store, path, doc_id, limit, regenerate))
    total = chosen.count()
    name = spark.range(1).select(cost.resolve_model(F.lit(model))).first()[0]
    begun = spark.range(1).select(F.lit(run_id).cast("bigint").alias("run_id"), F.lit(doc_id).cast("bigint").alias("doc_id"), F.lit(name).alias("model"), F.lit(mode).alias("mode"), F.current_timestamp().alias("started_at"), F.lit(total).alias("nodes_total"))
    unset = {"status": F.lit("running"), "completed_at": F.lit(None).cast("timestamp"), "nodes_completed": F.lit(0), "nodes_failed": F.lit(0), "cost_estimate_usd": F.lit(0.0)}
    store.append("runs", begun.withColumns(unset))

    told = rules.merged(rules.table(spark), rules.from_metadata(store.table("documents")))
    prompts = generation.prompts(chosen, store.table("chunks")).join(chosen.select("node_id", "doc_id", "sort_key"), "node_id").join(told, "doc_id", "left").withColumn("name", F.coalesce("name", F.lit("manual")))
    first = generation.answer(prompts.select(F.col("node_id").cast("string").alias("key"), F.concat(generation.creator_instructions(), F.lit("\n\n"), "prompt").alias("prompt")), f"{path}/suggested", client, **asking)
    drafts = generation.suggested(first).withColumn("node_id", F.col("key").cast("bigint")).drop("key")
    second = drafts.join(prompts, "node_id").select(F.concat_ws(":", F.col("node_id").cast("string"), F.col("draft").cast("string")).alias("key"), F.concat(generation.solver_instructions(F.col("question")), F.lit("\n\n"), "prompt").alias("prompt"))
    answers = generation.answer(second, f"{path}/solved", client, **asking)

    found = generation.strip_options(generation.solved(answers)).withColumns({"node_id": F.split("key", ":")[0].cast("bigint"), "draft": F.split("key", ":")[1].cast("int")})
    found = found.withColumn("question_id", F.xxhash64(F.lit(run_id), "node_id", "draft"))
    sound = found.join(generation.shape_errors(found).select("question_id").distinct(), "question_id", "left_anti")
    sound = sound.join(chosen.select("node_id", "doc_id", "sort_key"), "node_id").withColumns({"run_id": F.lit(run_id).cast("bigint"), "created_at": F.current_timestamp()})
    sound, sound_at = shared.stored(generation.numbered(sound))
    store.save_questions(sound)
    texts = store.table("chunks").groupBy("node_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    correct = F.filter("options", lambda o: o["role"] == "correct")[0]["text"]
    doubtful = generation.citation_status(sound.select("question_id", "node_id", correct.alias("correct")), texts).filter("status = 'needs_review'")
    store.review(doubtful.select("question_id"), "needs_review", 1)

    completed = sound.count()
    silent = chosen.join(drafts.select("node_id").distinct(), "node_id", "left_anti").count()
    failed = silent + second.count() - completed
    spent = first.unionByName(answers).agg(F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"))
    spent = cost.actual(spent.select(F.lit(name).alias("model"), F.lit(mode).alias("mode"), "input_tokens", "output_tokens", F.lit(0).alias("cached_tokens"), F.lit(0.0).alias("token_hours"))).first()["cost_usd"]
    ended = {"status": F.lit("partial" if failed else "succeeded"), "completed_at": F.current_timestamp(), "nodes_completed": F.lit(completed), "nodes_failed": F.lit(failed), "cost_estimate_usd": F.lit(spent)}
    store.append("runs", begun.withColumns(ended))
    for p in (nodes_at, sound_at):
        shared.delete(spark, p)
    return store.current_runs().filter(F.col("run_id") == run_id)


def _chosen(store: Store, path: str, doc_id: int | None, limit: int | None, regenerate: bool) -> DataFrame:
    """The run's sections: those it chose when it began, if it was broken off."""
    spark, at = store.spark, f"{path}/sections"
    if not generation._exists(spark, f"{at}/_SUCCESS"):
        rows = generation.select_nodes(store.table("nodes"), store.table("chunks"), store.table("questions"), doc_id, regenerate=regenerate, limit=limit)
        rows.write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)
