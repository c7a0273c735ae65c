"""The search index as tables: postings in blocks with bounds, in generations, with deletes.

A generation holds the postings of the texts that one change brought: for each token and block of texts one row, with the
texts, their lengths and the token's places, and what bounds every score in the block (the most places, the least length).
Beside it lie the texts that it brought or took away; of a text the newest generation counts. A generation is there once
its log entry is; a merge writes the live postings anew, and its entry stands for all generations before. There is one
writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium import shared
from folium.operators import search

#: Texts in a block, on average.
BLOCK = 256
#: Blocks that are read first, for a score that the others have to reach.
FIRST_BLOCKS = 64
#: Tokens of texts that one task brings into order.
TASK_TOKENS = 2 << 20
_SCHEMAS = {
    "texts": "key bigint, dl int, generation bigint",
    "postings": "token string, block int, entries array<struct<key:bigint, dl:int, at:array<int>>>, n bigint, most int, shortest int, generation bigint",
}


class Index:
    """An index of texts by a bigint key under a path."""

    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK):
        self.spark, self.path, self.block = spark, path.rstrip("/"), block

    def generations(self) -> list[int]:
        """The generations that count, oldest first: a merged one stands for all before it."""
        where, files = self._files("log")
        names = [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []
        logged = {kind: {int(n[len(kind) + 1 :]) for n in names if n.startswith(f"{kind}=")} for kind in ("added", "merged")}
        return sorted(g for g in logged["added"] | logged["merged"] if g >= max(logged["merged"], default=g))

    def _files(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _logged(self, generation: int) -> bool:
        return any(files.exists(where) for where, files in (self._files("log", f"{kind}={generation}") for kind in ("added", "merged")))

    def _log(self, kind: str, generation: int) -> None:
        """One folder's name is the entry: it is there or not."""
        where, files = self._files("log", f"{kind}={generation}")
        files.mkdirs(where)

    def _read(self, name: str, generations: list[int]) -> DataFrame:
        paths = [f"{self.path}/{name}/generation={g}" for g in generations]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMAS[name])
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*paths)

    def apply(self, changes: DataFrame, generation: int | None = None) -> int:
        """Take in (key, text) of new and changed texts; a null text deletes. Returns the generation.

        Of several changes of a text in one call the greatest text counts. With a number given, a call that runs again
        (after a failure, say) writes its own generation anew; a number that is logged already changes nothing.
        """
        have = self.generations()
        generation = (max(have, default=-1) + 1) if generation is None else generation
        if self._logged(generation):
            return generation
        texts = changes.groupBy("key").agg(F.max("text").alias("text"))
        texts, path = shared.stored(texts.select("key", "text", F.size(search.tokens(F.col("text"))).alias("dl")))
        # whole texts are dealt out, so that a token's places in a block are brought together where they are found
        dealt = self._dealt(texts.filter("dl > 0"), texts)
        rows = dealt.select("block", "key", "dl", F.explode(search.token_places(F.col("text"))).alias("e"))
        self._write(rows.select("e.token", "block", "key", "dl", "e.at"), generation)
        texts.select("key", F.when(F.col("dl") > 0, F.col("dl")).alias("dl")).write.mode("overwrite").parquet(f"{self.path}/texts/generation={generation}")
        self._log("added", generation)
        shared.delete(self.spark, path)
        return generation

    def _dealt(self, rows: DataFrame, texts: DataFrame, *others: DataFrame) -> DataFrame | tuple[DataFrame, ...]:
        """Rows with a key, and their block among `texts`, dealt out by that; others with a key alike."""
        t = texts.agg(F.count("*").alias("n"), F.sum("dl").alias("tokens")).first()
        blocks = max(1, t["n"] // self.block)
        block, parts = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"), max(1, min(blocks, -(-(t["tokens"] or 0) // TASK_TOKENS)))
        out = tuple(x.withColumn("block", block).repartition(parts, "block") for x in (rows, *others))
        return out if others else out[0]

    def _write(self, rows: DataFrame, generation: int) -> None:
        """Postings of (token, block, key, dl, at), which are dealt out by block already."""
        blocks = rows.groupBy("token", "block").agg(F.collect_list(F.struct("key", "dl", "at")).alias("entries"), F.count("*").alias("n"), F.max(F.size("at")).alias("most"), F.min("dl").alias("shortest"))
        shared.write(blocks.sortWithinPartitions("token", "block"), f"{self.path}/postings/generation={generation}", "overwrite")

    def texts(self, have: list[int] | None = None) -> DataFrame:
        """(key, dl, generation) of the live texts."""
        newest = self._read("texts", self.generations() if have is None else have).groupBy("key").agg(F.max(F.struct(F.col("generation").cast("bigint").alias("generation"), "dl")).alias("x"))
        return newest.select("key", "x.dl", "x.generation").filter("dl is not null")

    def _entries(self, words: list[str], blocks: DataFrame | None, have: list[int]) -> DataFrame:
        """(generation, block, token, key, dl, at) of tokens; only their row groups are read, and of those some blocks at most."""
        rows = self._read("postings", have).filter(F.col("token").isin(words)).withColumn("generation", F.col("generation").cast("bigint"))
        if blocks is not None:
            rows = rows.join(blocks, ["generation", "block"], "left_semi")
        return rows.select("generation", "block", "token", F.explode("entries").alias("e")).select("generation", "block", "token", "e.*")

    def tokens(self, words: list[str], blocks: DataFrame | None = None) -> DataFrame:
        """(key, token, pos) of live texts, for search.places."""
        have = self.generations()
        live = self._entries(words, blocks, have).join(self.texts(have).select("key", "generation"), ["key", "generation"], "left_semi")
        return live.select("key", "token", F.explode("at").alias("pos"))

    def hits(self, query: search.Query) -> DataFrame:
        """(key) of the live texts that a query matches."""
        return search.hits(self.tokens(search.words_of(query)), query, "key")

    def top(self, query: search.Query, limit: int = 50) -> DataFrame:
        """(key, rank) of the best matches: the rows of search.bm25 over an index built anew.

        The blocks of the query's words are ranked by what their texts can reach at most. The first of them are read for
        the score of the limit-th match; blocks whose bound is below that are left out. How often phrases occur is counted
        over all texts that hold their words, since a score depends on it.
        """
        words, all_, have = search.words_of(query), search._all_phrases(query), self.generations()
        held = [i for i, p in enumerate(all_) if p in search.phrases(query)]
        sizes, path = shared.stored(self.texts(have))
        t = sizes.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
        empty = self.spark.createDataFrame([], "key bigint, rank double")
        if not t["n"] or not words:
            return empty
        live = sizes.select("key", "generation")
        single = all(len(all_[i].words) == 1 for i in held)
        if single:
            # the places stay unread: a word's texts are counted by their keys
            rows = self._read("postings", have).filter(F.col("token").isin(words)).withColumn("generation", F.col("generation").cast("bigint"))
            keys = rows.select("generation", "token", F.explode("entries.key").alias("key")).join(live, ["key", "generation"], "left_semi")
            by_word = {r["token"]: r["n"] for r in keys.groupBy("token").agg(F.count("*").alias("n")).collect()}
            df = {i: by_word.get(all_[i].words[0], 0) for i in held}
        else:
            found = search.places(self.tokens(words), query, "key")
            counted = found.agg(F.count("*").alias("some"), *(F.count_if(F.size(f"p{i}") > 0).alias(f"df{i}") for i in held)).first()
            df = {i: counted[f"df{i}"] for i in held}

        def scored(blocks: DataFrame | None) -> DataFrame:
            found = search.matched(search.places(self.tokens(words, blocks), query, "key"), query).join(sizes.select("key", "dl"), "key")
            score = sum((search.weight(F.size(f"p{i}"), F.col("dl"), t["n"], df[i], t["avgdl"]) for i in held), F.lit(0.0))
            return found.select("key", (-score).alias("rank"))

        heads = self._read("postings", have).filter(F.col("token").isin(words)).select(F.col("generation").cast("bigint").alias("generation"), "block", "token", "most", "shortest")
        # a phrase comes no more often than the rarest of its words
        bounds = heads.groupBy("generation", "block").agg(*(F.max(F.when(F.col("token") == w, F.struct("most", "shortest"))).alias(f"h{k}") for k, w in enumerate(words)), F.min("shortest").alias("shortest"))
        number = {w: k for k, w in enumerate(words)}
        most = {i: F.least(*(F.coalesce(F.col(f"h{number[w]}.most"), F.lit(0)) for w in all_[i].words), F.lit(1 << 30)) for i in held}
        bound = sum((search.weight(most[i], F.col("shortest"), t["n"], df[i], t["avgdl"]) for i in held), F.lit(0.0))
        bounds, at = shared.stored(bounds.select("generation", "block", bound.alias("bound")))
        first = bounds.orderBy(F.desc("bound"), "generation", "block").limit(FIRST_BLOCKS)
        best = scored(first).orderBy("rank", "key").limit(limit).agg(F.count("*").alias("n"), F.max("rank").alias("rank")).first()
        reach = -best["rank"] if best["n"] == limit else 0.0
        # a bound that is reached exactly may still win by its key; rounding must not lose it
        out = scored(bounds.filter(F.col("bound") >= reach * (1 - 1e-9))).orderBy("rank", "key").limit(limit)
        out, _ = shared.stored(out)
        for p in (path, at):
            shared.delete(self.spark, p)
        return out.orderBy("rank", "key")

    def merge(self) -> int | None:
        """Bring all generations together into one without dead texts; returns it, or None if there is nothing to do.

        Readers see the old generations until the log entry is there; their files stay for readers that began before.
        """
        have = self.generations()
        if len(have) < 2:
            return None
        texts, path = shared.stored(self.texts(have))
        generation = max(have) + 1
        rows = self._read("postings", have).withColumn("generation", F.col("generation").cast("bigint"))
        rows = rows.select("generation", "token", F.explode("entries").alias("e")).select("generation", "token", "e.*")
        # the live texts of a block are one row, which meets its postings where these are brought together
        rows, live = self._dealt(rows, texts, texts.select("key", "generation"))
        live = live.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("key", "generation"))).alias("live"))
        rows = rows.join(live.hint("shuffle_hash"), "block").filter(F.try_element_at("live", F.col("key")) == F.col("generation"))
        self._write(rows.select("token", "block", "key", "dl", "at"), generation)
        texts.select("key", "dl").write.mode("overwrite").parquet(f"{self.path}/texts/generation={generation}")
        self._log("merged", generation)
        shared.delete(self.spark, path)
        return generation
