"""Question generation: choosing sections, calling a client, judging drafts, reconciling batches, totals."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.functions.text import cited, collapse, draft_option_key, page_label, safe_int, strip, without_options

#: A client takes a prompt and returns a record with text, input_tokens, output_tokens and error.
Client = Callable[[str], dict]
# Seconds before the second attempt, what chance adds, and how many drafts a response may have.
WAIT, JITTER, DRAFTS = 15.0, (1.0, 5.0), (1, 5)


def select_nodes(nodes: DataFrame, chunks: DataFrame, questions: DataFrame, doc_id: int | None = None, node_id: int | None = None, regenerate: bool = False, limit: int | None = None) -> DataFrame:
    """Sections to generate for: with chunks, not introductions, without questions unless regenerating; in tree order."""
    rows = nodes if doc_id is None else nodes.filter(F.col("doc_id") == doc_id)
    rows = rows.join(chunks.select("node_id").distinct(), "node_id", "left_semi").filter(~F.col("title").ilike("%introducci%"))
    if node_id is not None:
        rows = rows.filter(F.col("node_id") == node_id)
    if not regenerate:
        rows = rows.join(questions.select("node_id").distinct(), "node_id", "left_anti")
    return rows if limit is None else rows.orderBy("sort_key", "node_id").limit(limit)


def without_questions_of(questions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Questions that stay when those of the given sections are taken out."""
    return questions.join(nodes.select("node_id").distinct(), "node_id", "left_anti")


def strip_options(questions: DataFrame, text: str = "question_text") -> DataFrame:
    return questions.withColumn(text, without_options(F.col(text)))


def citation_status(questions: DataFrame, texts: DataFrame) -> DataFrame:
    """(question_id, status): needs_review where the correct option isn't a literal quotation of the section's text.

    questions has question_id, node_id and correct (null without a correct option: the check is skipped).
    """
    rows = questions.join(texts.select("node_id", "text"), "node_id", "left")
    doubt = F.col("correct").isNotNull() & ~F.coalesce(cited(F.col("correct"), F.coalesce("text", F.lit(""))), F.lit(False))
    return rows.select("question_id", F.when(doubt, "needs_review").otherwise("pending").alias("status"))


def shape_errors(questions: DataFrame) -> DataFrame:
    """(question_id, rule) of drafts (question_text, justification, options: array of role and text) that break a rule."""
    texts = F.transform("options", lambda o: draft_option_key(o["text"]))
    roles = lambda r: F.size(F.filter("options", lambda o: o["role"] == r))
    outside = lambda c, most: (F.length(c) < 1) | (F.length(c) > most)
    rules = {
        "question_length": outside("question_text", 1000),
        "justification_length": outside("justification", 2000),
        "option_length": F.exists("options", lambda o: (F.length(o["text"]) < 1) | (F.length(o["text"]) > 500)),
        "four_options": F.size("options") != 4,
        "roles": (roles("correct") != 1) | (roles("confusa") != 1) | (roles("distractor") != 2),
        "repeated_options": F.size(F.array_distinct(texts)) < F.size(texts),
    }
    broken = F.array_compact(F.array(*(F.when(c, name) for name, c in rules.items())))
    return questions.select("question_id", F.explode(broken).alias("rule"))


def stub_client(prompt: str) -> dict:
    """Answers without any network: the prompt's last line as the question."""
    return {"text": f"¿{prompt.strip().splitlines()[-1][:80]}?" if prompt.strip() else None, "input_tokens": len(prompt) // 4, "output_tokens": 20, "error": None if prompt.strip() else "empty prompt"}


def _wait(attempt: int) -> float:
    """Seconds before another attempt: WAIT, doubled each time, and some more by chance."""
    return WAIT * 2**attempt + random.uniform(*JITTER)


def generate(prompts: DataFrame, client: Client = stub_client, retries: int = 8, wait: Callable[[int], float] = _wait, threads: int = 1) -> DataFrame:
    """(key, response, input_tokens, output_tokens, error, seconds) of prompts (key, prompt); seconds is the call's latency.

    Overloads (429, 503) are tried again after wait(attempt) seconds. A task makes so many calls at a time as `threads` says.
    """

    def call(prompt: str) -> dict:
        for attempt in range(retries):
            try:
                return client(prompt)
            except Exception as e:  # noqa: BLE001  the client's failure is a result
                if attempt + 1 == retries or not any(x in str(e) for x in ("429", "503")):
                    return {"text": None, "input_tokens": 0, "output_tokens": 0, "error": f"{type(e).__name__}: {e}"}
                time.sleep(wait(attempt))
        raise AssertionError

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def timed(prompt: str | None) -> tuple[dict, float]:
            began = time.monotonic()
            return call(prompt or ""), time.monotonic() - began

        for batch in batches:
            if threads > 1:
                with ThreadPoolExecutor(threads) as pool:
                    answers = list(pool.map(timed, batch["prompt"]))
            else:
                answers = [timed(p) for p in batch["prompt"]]
            found, seconds = [x for x, _ in answers], [s for _, s in answers]
            yield pd.DataFrame({"key": batch["key"], "response": [x["text"] for x in found], "input_tokens": [x["input_tokens"] for x in found], "output_tokens": [x["output_tokens"] for x in found], "error": [x["error"] for x in found], "seconds": seconds})

    kind = prompts.schema["key"].dataType.simpleString()
    return prompts.select("key", "prompt").mapInPandas(run, f"key {kind}, response string, input_tokens long, output_tokens long, error string, seconds double")


def drafts(responses: DataFrame) -> DataFrame:
    """(key, draft, question_text, justification, options, error) of responses whose text is a JSON list of drafts.

    A list has one to five drafts, each with question_text, justification and options (role, text). Other texts, and
    lists of another length, give one row with error and without a draft.
    """
    option = "struct<role:string, text:string>"
    parsed = F.from_json("response", f"array<struct<question_text:string, justification:string, options:array<{option}>>>")
    rows = responses.withColumn("found", parsed)
    sound = F.coalesce(F.size("found").between(*DRAFTS), F.lit(False))
    error = F.coalesce("error", F.when(F.col("found").isNull(), "not a list of drafts").when(~sound, "a response has one to five drafts"))
    listed = F.when(sound & F.col("error").isNull(), F.col("found"))
    rows = rows.select("key", error.alias("error"), F.posexplode_outer(listed).alias("draft", "x"))
    return rows.select("key", "draft", "x.question_text", "x.justification", "x.options", "error")


def answer(prompts: DataFrame, path: str, client: Client = stub_client, per_round: int = 500, threads: int = 8, retries: int = 8, wait: Callable[[int], float] = _wait) -> DataFrame:
    """generate(), kept under a path round by round: a job that is killed and begun again asks only for what is left.

    The prompts (key, prompt) are written once, in files of per_round; a stream takes a file at a time, and its progress
    is logged when the file's answers are there. A round that was broken off is asked anew, and replaces what it left.
    """
    spark = prompts.sparkSession
    if not _exists(spark, f"{path}/prompts/_SUCCESS"):
        prompts.select("key", "prompt").write.mode("overwrite").option("maxRecordsPerFile", per_round).parquet(f"{path}/prompts")
    schema = prompts.select("key", "prompt").schema

    def ask(batch: DataFrame, number: int) -> None:
        tasks = max(1, spark.sparkContext.defaultParallelism)
        generate(batch.repartition(tasks), client, retries, wait, threads).write.mode("overwrite").parquet(f"{path}/answers/round={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/prompts")
    stream.writeStream.foreachBatch(ask).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    kind = f"key {schema['key'].dataType.simpleString()}, response string, input_tokens long, output_tokens long, error string, seconds double"
    answers = spark.read.schema(kind).parquet(f"{path}/answers") if _exists(spark, f"{path}/answers") else spark.createDataFrame([], kind)
    return answers.select("key", "response", "input_tokens", "output_tokens", "error", "seconds")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _topics(name: str) -> Column:
    return F.coalesce(F.nullif(F.array_join(name, ", "), F.lit("")), F.lit("(ninguno)"))


def creator_instructions() -> Column:
    """What a model is told that is to suggest questions, from the rules' columns (folium.operators.rules)."""
    return F.concat(
        F.lit("Eres evaluador de adiestramiento. Propón de una a tres preguntas cuya respuesta esté, palabra por palabra, en el texto. No des opciones ni respuestas.\nDocumento: "), "name",
        F.lit("\nTemas preferentes: "), _topics("preferred_topics"), F.lit("\nTemas excluidos: "), _topics("forbidden_topics"), F.lit('\nResponde solo con JSON: {"questions": ["..."]}'),
    )


def solver_instructions(question: Column) -> Column:
    """What a model is told that is to give the options of one question."""
    return F.concat(
        F.lit("Da cuatro opciones para la pregunta: una correct (cita literal del texto), una confusa y dos distractor, y una justificación.\nDocumento: "), "name",
        F.lit("\nEstilo: "), F.coalesce(F.nullif("style_guide", F.lit("")), F.lit("(ninguno)")), F.lit("\nTemas preferentes: "), _topics("preferred_topics"), F.lit("\nTemas excluidos: "), _topics("forbidden_topics"),
        F.lit("\nIndicaciones: "), F.coalesce(F.nullif("extra_instructions", F.lit("")), F.lit("(ninguna)")),
        F.lit('\nResponde solo con JSON: {"question_text": "...", "justification": "...", "options": [{"role": "correct", "text": "..."}, ...]}\nPregunta: '), question,
    )


def suggested(responses: DataFrame, most: int = DRAFTS[1]) -> DataFrame:
    """(key, draft, question) of responses that are JSON objects with a list `questions`; options in them are cut off.

    Other responses, and questions of which nothing is left, give nothing; of more than `most` questions the first stay.
    """
    listed = F.slice(F.from_json("response", "questions array<string>")["questions"], 1, most)
    rows = responses.filter("error is null").select("key", F.posexplode(listed).alias("draft", "question"))
    return rows.withColumn("question", strip(without_options(F.col("question")))).filter("question != ''")


def solved(responses: DataFrame) -> DataFrame:
    """(key, question_text, justification, options) of responses that are one question as a JSON object."""
    x = F.from_json("response", "question_text string, justification string, options array<struct<role:string, text:string>>")
    rows = responses.filter("error is null").select("key", x.alias("x")).select("key", "x.*")
    return rows.filter("question_text is not null and justification is not null and options is not null")


def numbered(questions: DataFrame) -> DataFrame:
    """generation_order within each run, by section order and draft: the same each time, whatever finished first."""
    return questions.withColumn("generation_order", F.row_number().over(Window.partitionBy("run_id").orderBy("sort_key", "draft")))


def reconcile(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Responses (batch, n, key) with the key of their request: their own, or the next of the batch's requests in order.

    Only responses without a key use up requests. Those beyond the requests have no key.
    """
    place = F.sum(F.when(F.col("key").isNull(), 1).otherwise(0)).over(Window.partitionBy("batch").orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    rows = responses.withColumn("place", F.when(F.col("key").isNull(), place))
    known = requests.select("batch", F.row_number().over(Window.partitionBy("batch").orderBy("n")).alias("place"), F.col("key").alias("by_place"))
    return rows.join(known, ["batch", "place"], "left").select("batch", "n", F.coalesce("key", "by_place").alias("key"))


def batch_outcomes(items: DataFrame) -> DataFrame:
    """(batch, n, outcome, tokens) of items (error, response, valid, usage): what became of each request."""
    outcome = (
        F.when(F.col("error").isNotNull(), "error").when(F.col("response").isNull(), "no_response").when(collapse(F.col("response")) == "", "empty")
        .when(~F.coalesce("valid", F.lit(False)), "invalid").otherwise("ok")
    )
    tokens = F.when(outcome.isin("error", "no_response"), 0).otherwise(safe_int(F.col("usage")))
    return items.select("batch", "n", outcome.alias("outcome"), tokens.alias("tokens"))


def run_totals(outcomes: DataFrame) -> DataFrame:
    """Per run: completed, failed, token sums, and succeeded if nothing failed, else partial."""
    out = outcomes.groupBy("run_id").agg(F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("failed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens", "cached_tokens")))
    return out.withColumn("status", F.when(F.col("failed") == 0, "succeeded").otherwise("partial"))


def prompts(nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(node_id, prompt): where a section stands and its text."""
    text = chunks.filter(strip(F.col("text")) != "").groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("t"))
    rows = nodes.join(text, "node_id", "left")
    body = F.coalesce(F.nullif(F.array_join(F.transform("t", lambda x: x["text"]), "\n\n"), F.lit("")), F.lit("(sin texto)"))
    where = [F.concat(F.lit(f"{name}: "), c) for name, c in (("Bloque", F.concat_ws(" ", "level_label", "ordinal")), ("Título", F.col("title")), ("Páginas", page_label(F.col("page_start"), F.col("page_end"))), ("Ruta", F.col("breadcrumb")))]
    return rows.select("node_id", F.concat_ws("\n", *where, F.lit(""), body).alias("prompt"))
