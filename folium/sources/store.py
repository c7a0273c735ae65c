"""The store of documents, sections, chunks, runs and questions: Parquet tables under one folder.

Tables are append-only; what changes is a log, and the newest entry holds. A document, its sections and its chunks are
appended under the number of a save, and the save is logged last, by one append of one file: until then readers see
the save before it. Saving a document again replaces it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.operators import lookup
from folium.operators.explore import STATUSES, latest_status

SCHEMAS = {
    "documents": "doc_id bigint, code string, title string, edition string, branch string, source_path string, page_count int, extractor string, ingested_at timestamp, metadata_json string",
    "nodes": "node_id bigint, doc_id bigint, local_id bigint, parent_id bigint, level int, level_label string, ordinal string, title string, breadcrumb string, page_start int, page_end int, sort_key string, is_anexo boolean",
    "chunks": "doc_id bigint, local_id bigint, node_id bigint, ordinal int, text string, char_count int, page_start int, page_end int, has_table boolean, has_image_ref boolean",
    "runs": "run_id bigint, doc_id bigint, model string, mode string, status string, started_at timestamp, completed_at timestamp, nodes_total int, nodes_completed int, nodes_failed int, cost_estimate_usd double",
    "questions": "question_id bigint, run_id bigint, node_id bigint, doc_id bigint, generation_order int, question_text string, justification string, created_at timestamp",
    "options": "question_id bigint, order_in_question int, role string, text string, is_correct boolean",
    "reviews": "question_id bigint, status string, validated_at timestamp, seq bigint",
}


#: Tables of which a document's newest logged save counts.
SAVED = ("documents", "nodes", "chunks")
_SAVES = "doc_id bigint, save_id string, saved_at timestamp"


def node_id(doc_id: Column, local_id: Column) -> Column:
    """A section's number from its document's and its own: both in one where they fit, else a 64-bit hash of the two.

    Documents that are numbered by a hash (of a file's name, say) have ids of all sizes.
    """
    fits = doc_id.between(-(1 << 42), (1 << 42) - 1) & local_id.between(0, (1 << 20) - 1)
    return F.when(local_id.isNull(), None).when(fits, F.try_add(F.try_multiply(doc_id, F.lit(1 << 20)), local_id)).otherwise(F.xxhash64(doc_id, local_id.cast("long")))


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def create(self) -> Store:
        """Empty tables where there are none yet."""
        for name in SCHEMAS:
            self.spark.createDataFrame([], self._schema(name)).write.mode("append").parquet(f"{self.path}/{name}")
        self.spark.createDataFrame([], _SAVES).write.mode("append").parquet(f"{self.path}/saves")
        return self

    @staticmethod
    def _schema(name: str) -> str:
        return SCHEMAS[name] + ", save_id string" * (name in SAVED)

    def table(self, name: str) -> DataFrame:
        """The rows that hold: all of a log, of each document those of its newest save."""
        rows = self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{name}")
        if name not in SAVED:
            return rows
        saves = self.spark.read.schema(_SAVES).parquet(f"{self.path}/saves")
        newest = saves.groupBy("doc_id").agg(F.max_by("save_id", F.struct("saved_at", "save_id")).alias("save_id"))
        return rows.join(newest, ["doc_id", "save_id"], "left_semi").drop("save_id").select(*(f.name for f in self.spark.createDataFrame([], SCHEMAS[name]).schema))

    def append(self, name: str, rows: DataFrame, order: tuple[str, ...] = ()) -> None:
        """Append rows, those of each file in the given order."""
        columns = [f.name for f in self.spark.createDataFrame([], self._schema(name)).schema]
        rows = rows.select(*(F.col(c) for c in columns))
        (rows.sortWithinPartitions(*order) if order else rows).write.mode("append").parquet(f"{self.path}/{name}")

    def save_document(self, documents: DataFrame, nodes: DataFrame, chunks: DataFrame) -> None:
        """Documents with their sections (doc_id, local_id, parent_pos, pos, …) and chunks (doc_id, local_id, …).

        Chunks of unknown sections are left out. A document that was saved before is replaced; a save that fails half way
        leaves rows that no log names.
        """
        save = F.lit(uuid.uuid4().hex).alias("save_id")
        number = lambda c: node_id(F.col("doc_id"), c)
        above = nodes.select("doc_id", F.col("pos").alias("parent_pos"), F.col("local_id").alias("_up"))
        rows = nodes.join(above, ["doc_id", "parent_pos"], "left").withColumns({"node_id": number(F.col("local_id")), "parent_id": number(F.col("_up"))})
        self.append("documents", documents.withColumn("save_id", save))
        self.append("nodes", rows.withColumn("save_id", save), ("doc_id", "local_id"))
        self.append("chunks", chunks.join(nodes.select("doc_id", "local_id"), ["doc_id", "local_id"]).withColumns({"node_id": number(F.col("local_id")), "save_id": save}), ("doc_id", "local_id", "ordinal"))
        saved = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), save, F.current_timestamp().alias("saved_at"))
        saved.distinct().coalesce(1).write.mode("append").parquet(f"{self.path}/saves")

    def save_questions(self, questions: DataFrame) -> None:
        """Questions with an array of options (role, text); their order is the array's, the role says which is correct."""
        self.append("questions", questions)
        options = questions.select("question_id", F.posexplode("options").alias("order_in_question", "o"))
        self.append("options", options.select("question_id", "order_in_question", "o.role", "o.text", (F.col("o.role") == "correct").alias("is_correct")))

    def review(self, question_ids: DataFrame, status: str, seq: int) -> None:
        """Log a status of questions, with the time."""
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}; known: {STATUSES}")
        self.append("reviews", question_ids.select("question_id", F.lit(status).alias("status"), F.current_timestamp().alias("validated_at"), F.lit(seq).cast("long").alias("seq")))

    def questions(self) -> DataFrame:
        """Questions with their newest status; pending without one."""
        newest = latest_status(self.table("reviews"), "question_id", "status", "validated_at", "seq").drop("seq")
        return self.table("questions").join(newest, "question_id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))

    def document(self, doc_id: int) -> DataFrame:
        """One document's row, or none."""
        return lookup.pick(self.table("documents"), "doc_id", doc_id)

    def tree(self, doc_id: int) -> DataFrame:
        return lookup.tree(self.table("nodes"), self.table("chunks"), doc_id)

    def section(self, node_id: int) -> DataFrame:
        return lookup.section(self.table("nodes"), self.table("chunks"), node_id)

    def question(self, question_id: int) -> DataFrame:
        """One question with its newest status, its options and where its section stands, or no row."""
        one = lookup.pick(self.questions(), "question_id", question_id)
        return lookup.cards(one, lookup.pick(self.table("options"), "question_id", question_id), self.table("nodes"))

    def current_runs(self) -> DataFrame:
        """Runs by their newest entry: a run is logged when it begins and when it ends."""
        order = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("completed_at"))
        return self.table("runs").withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")

    def exists(self, name: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
