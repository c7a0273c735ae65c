"""Read-side queries over documents, sections, chunks, questions and runs. Declarative only: Catalyst picks the joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Statuses that questions can have; the first two are served.
STATUSES = ("pending", "valid", "needs_review", "rejected")
SERVED = STATUSES[:2]


def served(status: Column) -> Column:
    return status.isin(*SERVED)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def global_kpis(documents: DataFrame, nodes: DataFrame, chunks: DataFrame, stamp: str = "ingested_at") -> DataFrame:
    """One row: documents, sections, chunks, and when the newest document came."""
    parts = documents.select(F.lit("d").alias("k"), F.col(stamp).alias("t")).unionByName(nodes.select(F.lit("n").alias("k"), F.lit(None).cast(documents.schema[stamp].dataType).alias("t"))).unionByName(chunks.select(F.lit("c").alias("k"), F.lit(None).cast(documents.schema[stamp].dataType).alias("t")))
    return parts.agg(*(F.count_if(F.col("k") == k).alias(name) for k, name in (("d", "n_documents"), ("n", "n_nodes"), ("c", "n_chunks"))), F.max("t").alias("last_ingested"))


def counts_per_document(documents: DataFrame, nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    n = nodes.groupBy("doc_id").agg(F.count("*").alias("n_nodes"))
    c = chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks"))
    return documents.select("doc_id").join(n, "doc_id", "left").join(c, "doc_id", "left").select("doc_id", _zero("n_nodes"), _zero("n_chunks"))


def counts_per_node(nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    c = chunks.groupBy("node_id").agg(F.count("*").alias("n_chunks"))
    return nodes.select("doc_id", "node_id", "sort_key").join(c, "node_id", "left").select("doc_id", "node_id", "sort_key", _zero("n_chunks"))


def questions_per_run(runs: DataFrame, questions: DataFrame) -> DataFrame:
    q = questions.groupBy("run_id").agg(F.count("*").alias("n_questions"))
    return runs.join(q, "run_id", "left").select("run_id", "model", "mode", "status", _zero("n_questions"))


def question_kpis(chunks: DataFrame, questions: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: questions by status, served, sections with text and with a question, their share, and cost."""
    by = questions.agg(F.count("*").alias("n_questions"), *(F.count_if(F.col("status") == s).alias(s) for s in STATUSES), F.count_if(served(F.col("status"))).alias("served"), F.count_distinct("node_id").alias("nodes_with_question"))
    text = chunks.agg(F.count_distinct("node_id").alias("nodes_with_text"))
    cost = runs.agg(F.coalesce(F.sum("cost_estimate_usd"), F.lit(0.0)).alias("cost_usd"))
    rows = by.unionByName(text, allowMissingColumns=True).unionByName(cost, allowMissingColumns=True)
    one = rows.agg(*(F.max(c).alias(c) for c in rows.columns))
    return one.withColumn("coverage_pct", _share(F.col("nodes_with_question"), F.col("nodes_with_text")))


def coverage(documents: DataFrame, chunks: DataFrame, questions: DataFrame, runs: DataFrame) -> DataFrame:
    """Per document: sections with chunks, sections with questions, share, valid questions, runs."""
    c = chunks.groupBy("doc_id").agg(F.count_distinct("node_id").alias("nodes_with_chunks"))
    q = questions.groupBy("doc_id").agg(F.count_distinct("node_id").alias("nodes_questioned"), F.count_if(F.col("status") == "valid").alias("validated"))
    r = runs.groupBy("doc_id").agg(F.count("*").alias("n_runs"))
    out = documents.select("doc_id").join(c, "doc_id", "left").join(q, "doc_id", "left").join(r, "doc_id", "left")
    out = out.select("doc_id", *map(_zero, ("nodes_with_chunks", "nodes_questioned", "validated", "n_runs")))
    return out.withColumn("coverage_pct", _share(F.col("nodes_questioned"), F.col("nodes_with_chunks")))


def status_by_node(questions: DataFrame) -> DataFrame:
    """(node_id, statuses): all statuses of a section's questions, in order."""
    return questions.groupBy("node_id").agg(F.array_sort(F.collect_list("status")).alias("statuses"))


def tree_badges(nodes: DataFrame, questions: DataFrame) -> DataFrame:
    """(doc_id, node_id, badge): served and all questions of a section, or a warning that it has none."""
    q = questions.groupBy("node_id").agg(F.count_if(served(F.col("status"))).alias("s"), F.count("*").alias("n"))
    badge = F.when(F.col("n").isNull(), "⚠ sin pregunta").otherwise(F.concat(F.lit("❓"), F.col("s").cast("string"), F.lit("/"), F.col("n").cast("string")))
    return nodes.select("doc_id", "node_id").join(q, "node_id", "left").select("doc_id", "node_id", badge.alias("badge"))


def siblings(nodes: DataFrame) -> DataFrame:
    """(doc_id, local_id, sibling): sections under the same parent, or without any."""
    key = lambda rows, name: rows.select("doc_id", F.coalesce("parent_pos", F.lit(-1)).alias("p"), F.col("local_id").alias(name))
    pairs = key(nodes, "local_id").join(key(nodes, "sibling"), ["doc_id", "p"])
    return pairs.filter("local_id != sibling").select("doc_id", "local_id", "sibling")


def children(nodes: DataFrame) -> DataFrame:
    """(doc_id, local_id, children): sort keys of a section's children, in order; empty for leaves."""
    c = nodes.filter("parent_pos is not null").groupBy("doc_id", F.col("parent_pos").alias("pos")).agg(F.array_sort(F.collect_list("sort_key")).alias("children"))
    return nodes.join(c, ["doc_id", "pos"], "left").select("doc_id", "local_id", F.coalesce("children", F.expr("cast(array() as array<string>)")).alias("children"))


def ancestors(nodes: DataFrame) -> DataFrame:
    """(doc_id, local_id, depth, ancestor): all sections above one, the root with depth 0.

    A section's ancestors have the proper prefixes of its sort key, so one equi-join finds them all. Where levels
    were skipped a prefix may name no section.
    """
    parts = F.split("sort_key", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    own = nodes.filter(F.size(parts) > 1).select("doc_id", "local_id", "pos", F.explode(prefixes).alias("key"))
    above = nodes.select("doc_id", F.col("sort_key").alias("key"), F.col("local_id").alias("ancestor"), F.col("pos").alias("above"))
    found = own.join(above, ["doc_id", "key"]).filter("above < pos")
    depth = F.row_number().over(Window.partitionBy("doc_id", "local_id").orderBy(F.length("key"))) - 1
    return found.select("doc_id", "local_id", depth.alias("depth"), "ancestor")


def display_tree(nodes: DataFrame, hidden: str = "introducci") -> DataFrame:
    """Sections with a title that doesn't hold `hidden`, of which all ancestors are such sections too."""
    visible = nodes.filter((F.col("title") != "") & ~F.lower("title").contains(hidden))
    gone = nodes.join(visible.select("doc_id", "local_id"), ["doc_id", "local_id"], "left_anti").select("doc_id", F.col("local_id").alias("ancestor"))
    under = ancestors(nodes).join(gone, ["doc_id", "ancestor"], "left_semi").select("doc_id", "local_id").distinct()
    return visible.join(under, ["doc_id", "local_id"], "left_anti")


def list_questions(questions: DataFrame, nodes: DataFrame, doc_id: int | None = None, statuses: tuple[str, ...] | None = None, run_id: int | None = None, node_id: int | None = None, text: str | None = None, limit: int = 500) -> DataFrame:
    """Questions with their section, filtered by what is given, in the order of sections and generation."""
    rows = questions
    for name, value in (("doc_id", doc_id), ("run_id", run_id), ("node_id", node_id)):
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    if statuses:
        rows = rows.filter(F.col("status").isin(*statuses))
    if text:
        like = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        rows = rows.filter(F.col("question_text").ilike(like) | F.col("justification").ilike(like))
    rows = rows.join(nodes.select("node_id", "sort_key", "title"), "node_id")
    return rows.orderBy("sort_key", "generation_order", "question_id").limit(limit)


def page(rows: DataFrame, order: list[str], limit: int = 1000, offset: int = 0) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(limit)


def open_batches(runs: DataFrame) -> DataFrame:
    return runs.filter("mode = 'batch' and status = 'running'")


def missing_questions(nodes: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """Sections with text and without a question."""
    return nodes.join(chunks.select("node_id").distinct(), "node_id", "left_semi").join(questions.select("node_id").distinct(), "node_id", "left_anti")


def options_of(questions: DataFrame, options: DataFrame) -> DataFrame:
    """(question_id, options): the options' texts and roles in their order."""
    grouped = options.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("order_in_question", "role", "text"))).alias("o"))
    return questions.select("question_id").join(grouped, "question_id", "left").select("question_id", F.coalesce(F.transform("o", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), F.expr("cast(array() as array<string>)")).alias("options"))


def latest_status(log: DataFrame, key: str, status: str, stamp: str, tie: str) -> DataFrame:
    """The newest entry of each key in a log of status changes; ties go to the greater `tie`."""
    newest = log.groupBy(key).agg(F.max_by(F.struct(status, stamp, tie), F.struct(stamp, tie)).alias("x"))
    return newest.select(key, f"x.{status}", f"x.{stamp}", f"x.{tie}")
