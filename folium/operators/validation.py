"""Checks of bundles: rules over exploded parts, each giving rows (bundle_id, path, rule, message); no rows, no errors.

A bundle is a row with manual, nodes, runs and questions as nested columns (see folium.sources.bundles.SCHEMA).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folium import shared
from folium.functions.text import option_key, strip
from folium.operators.explore import STATUSES

# Versions, limits, enumerations and what looks like a secret.
VERSIONS = (1,)
LIMITS = {"code": 64, "edition": 64, "title": 512, "branch": 64, "level_label": 32, "ordinal": 64, "node_title": 1024, "ref": 64, "question": 1000, "justification": 2000, "option": 500, "model": 64, "profile": 32}
MODES = ("immediate", "batch")
RUN_STATUSES = ("succeeded", "failed", "partial", "cancelled")
UNSERVED = ("needs_review", "rejected")
ROLES = {"correct": 1, "confusa": 1, "distractor": 2}
STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"
SECRETS = {"google_key": r"AIza[0-9A-Za-z_\-]{20,}", "openai_key": r"\bsk-[A-Za-z0-9]{20,}\b", "connection_string": r"\b[a-z][a-z0-9+.\-]*://[^\s:/@]+:[^\s@]+@", "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----"}
SECRET_NAMES = r"(?i)^(api[_-]?keys?|secrets?|passwords?|passwd|tokens?|credentials?|authorizations?)$"
SECRET_LENGTH = 12


def _found(rows: DataFrame, bad: Column, path: Column, rule: str, message: str) -> DataFrame:
    return rows.filter(F.coalesce(bad, F.lit(False))).select("bundle_id", path.alias("path"), F.lit(rule).alias("rule"), F.lit(message).alias("message"))


def _text(c: Column, most: int, needed: bool = True) -> Column:
    """Whether a text is missing, blank or too long."""
    blank = c.isNull() | (strip(c) == "") if needed else F.lit(False)
    return blank | F.coalesce(F.length(c) > most, F.lit(False))


def _at(name: str, i: str = "i") -> Column:
    return F.concat(F.lit(f"$.{name}["), F.col(i).cast("string"), F.lit("]"))


def nodes_of(bundles: DataFrame) -> DataFrame:
    return bundles.select("bundle_id", F.posexplode("nodes").alias("i", "x")).select("bundle_id", "i", "x.*")


def runs_of(bundles: DataFrame) -> DataFrame:
    return bundles.select("bundle_id", F.posexplode("runs").alias("i", "x")).select("bundle_id", "i", "x.*")


def questions_of(bundles: DataFrame) -> DataFrame:
    return bundles.select("bundle_id", F.posexplode("questions").alias("i", "x")).select("bundle_id", "i", "x.*")


def _repeated(rows: DataFrame, keys: list[str], order: str = "i") -> DataFrame:
    """Second and later rows of a key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("bundle_id", *keys).orderBy(order))).filter("_n > 1")


def header_errors(bundles: DataFrame) -> DataFrame:
    root = F.lit("$")
    rules = [
        (~F.coalesce(F.col("version").isin(*VERSIONS), F.lit(False)), "version", "unknown version"),
        (F.col("manual").isNull(), "manual", "manual is missing"),
        (F.col("manual").isNotNull() & _text(F.col("manual.title"), LIMITS["title"]), "manual_title", "title is missing, blank or too long"),
        (F.col("manual").isNotNull() & _text(F.col("manual.code"), LIMITS["code"]), "manual_code", "code is missing, blank or too long"),
        (_text(F.col("manual.edition"), LIMITS["edition"], False) | _text(F.col("manual.branch"), LIMITS["branch"], False), "manual_optional", "edition or branch is too long"),
        (~F.coalesce(F.col("generated_at").rlike(STAMP), F.lit(False)), "generated_at", "not an ISO stamp"),
        (F.col("nodes").isNull() | F.col("runs").isNull() | F.col("questions").isNull(), "lists", "nodes, runs and questions must be lists"),
    ]
    return _broken(bundles, root, rules)


def cycles(nodes: DataFrame) -> DataFrame:
    """(bundle_id, ref) of sections whose way up never ends: in a circle, or below one.

    Pointer doubling: each round a section's link jumps over twice as many ancestors as before, and drops out where the
    way ends. Whoever is left after more jumps than its bundle has sections goes round. So a chain of n sections takes
    log2(n) joins, whose rows shrink; of a ref that stands twice the smaller parent counts.
    """
    keys = nodes.filter("ref is not null").groupBy("bundle_id", "ref").agg(F.min("parent_ref").alias("up"))
    most = keys.groupBy("bundle_id").agg(F.count("*").alias("most"))
    left, path = shared.stored(keys.filter("up is not null").join(most, "bundle_id").select("bundle_id", "ref", "up", "most"))
    jumped = 1
    while not left.filter(F.col("most") >= jumped).isEmpty():
        over = left.select("bundle_id", F.col("ref").alias("up"), F.col("up").alias("next"))
        behind = path
        left, path = shared.stored(left.join(over, ["bundle_id", "up"]).select("bundle_id", "ref", F.col("next").alias("up"), "most"))
        shared.delete(nodes.sparkSession, behind)
        jumped *= 2
    return left.select("bundle_id", "ref")


def _broken(rows: DataFrame, path: Column, rules: list[tuple[Column, str, str]]) -> DataFrame:
    """Findings by all rules in one pass: of each row the array of those that it breaks."""
    told = F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.lit(message).alias("message"))) for bad, rule, message in rules))
    return rows.select("bundle_id", path.alias("path"), F.explode(F.filter(told, lambda e: e.isNotNull())).alias("e")).select("bundle_id", "path", "e.rule", "e.message")


_SAID = "array<struct<kind:string, key:string, second:string, defines:boolean, i:int, path:string, rule:string, message:string>>"


def _own(rules: list[tuple[Column, str, str]], path: Column, i: Column) -> Column:
    """The rules that a part breaks, as sayings of their own kind that no others meet."""
    each = (F.when(F.coalesce(bad, F.lit(False)), _saying("own", path, None, False, i, path, rule, message)) for bad, rule, message in rules)
    return F.filter(F.array(*each), lambda e: e.isNotNull())


def _saying(kind: str, key: Column, second: Column | None, defines: bool, i: Column, path: Column, rule: str, message: str) -> Column:
    """A key that a part defines or refers to, and what is wrong if it is repeated, or refers to nothing."""
    fields = {"kind": F.lit(kind), "key": key.cast("string"), "second": F.lit(None).cast("string") if second is None else second.cast("string"), "defines": F.lit(defines), "i": i.cast("int"), "path": path, "rule": F.lit(rule), "message": F.lit(message)}
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def _settled(bundles: DataFrame, *sayings: Column) -> DataFrame:
    """Findings from arrays of sayings: bundles are read once, and keys meet in one shuffle.

    Of kind `own` all are findings; of others those that define a key again, and those whose key nobody defines.
    """
    rows = bundles.select("bundle_id", F.explode(F.concat(*(F.coalesce(x.cast(_SAID), F.expr(f"cast(array() as {_SAID})")) for x in sayings))).alias("e")).select("bundle_id", "e.*")
    keys = ["bundle_id", "kind", "key", "second"]
    known = F.max("defines").over(Window.partitionBy(*keys)) & F.col("key").isNotNull()
    place = F.row_number().over(Window.partitionBy(*keys, "defines").orderBy("i"))
    rows = rows.withColumns({"known": known, "place": place})
    wrong = (F.col("kind") == "own") | F.when(F.col("defines"), F.col("place") > 1).otherwise(~F.col("known"))
    return rows.filter(wrong & F.col("rule").isNotNull()).select("bundle_id", "path", "rule", "message")


def _place(name: str, i: Column) -> Column:
    return F.concat(F.lit(f"$.{name}["), i.cast("string"), F.lit("]"))


def node_errors(bundles: DataFrame) -> DataFrame:
    """Findings on sections and chunks. A ref or ordinal that is repeated is one for each time but the first."""

    def section(x: Column, i: Column) -> Column:
        at = _place("nodes", i)
        bad = _text(x["ref"], LIMITS["ref"]) | _text(x["level_label"], LIMITS["level_label"]) | _text(x["title"], LIMITS["node_title"], False) | _text(x["ordinal"], LIMITS["ordinal"], False)
        numbers = x["level"].isNull() | (x["level"] < 0) | (x["page_start"] < 0)
        own = _own([(bad, "node_fields", "a text is missing, blank or too long"), (numbers, "node_numbers", "a number is missing or negative")], at, i)
        keys = F.array(
            F.when(x["ref"].isNotNull(), _saying("node", x["ref"], None, True, i, at, "node_ref_unique", "ref is repeated")),
            F.when(x["parent_ref"].isNotNull(), _saying("node", x["parent_ref"], None, False, i, at, "parent_exists", "parent_ref names no section")),
        )

        def chunk(c: Column, j: Column) -> Column:
            where = F.concat(at, F.lit(".chunks["), j.cast("string"), F.lit("]"))
            wrong = c["ordinal"].isNull() | (c["ordinal"] < 0) | c["text"].isNull() | (strip(c["text"]) == "")
            again = _saying("ordinal", i, c["ordinal"], True, j, where, "chunk_ordinal_unique", "ordinal is repeated")
            return F.concat(_own([(wrong, "chunk_fields", "a chunk's text or ordinal is wrong")], where, j), F.array(again))

        chunks = F.coalesce(F.flatten(F.transform(x["chunks"], chunk)), F.expr(f"cast(array() as {_SAID})"))
        return F.concat(own.cast(_SAID), F.filter(keys, lambda e: e.isNotNull()).cast(_SAID), chunks.cast(_SAID))

    named = F.filter("nodes", lambda x: x["ref"].isNotNull())
    root = [((F.size(named) > 0) & ~F.exists(named, lambda x: x["parent_ref"].isNull()), "root", "no section is a root")]
    settled = _settled(bundles, F.flatten(F.transform("nodes", section)), _own(root, F.lit("$.nodes"), F.lit(0)))
    looped = cycles(nodes_of(bundles)).groupBy("bundle_id").agg(F.min("ref").alias("ref"))
    return settled.unionByName(_found(looped, F.lit(True), F.lit("$.nodes"), "cycle", "sections are their own ancestors"))


def run_errors(bundles: DataFrame) -> DataFrame:
    rows = runs_of(bundles)
    counters = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(True)) for c in ("nodes_total", "nodes_completed", "nodes_failed")])
    stamp = lambda c: ~F.coalesce(F.col(c).rlike(STAMP), F.lit(False))
    own = _broken(rows, _at("runs"), [
        (_text(F.col("ref"), LIMITS["ref"] * 4) | _text(F.col("model"), LIMITS["model"]), "run_fields", "a text is missing, blank or too long"),
        (~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)), "run_mode", "unknown mode"),
        (~F.coalesce(F.col("status").isin(*RUN_STATUSES), F.lit(False)), "run_status", "unknown status, or still running"),
        (stamp("started_at") | (F.col("completed_at").isNotNull() & stamp("completed_at")), "run_stamps", "not an ISO stamp"),
        (counters | F.coalesce(F.col("cost_usd") < 0, F.lit(False)), "run_counters", "a counter is missing or negative"),
    ])
    return own.unionByName(_found(_repeated(rows, ["ref"]), F.lit(True), _at("runs"), "run_ref_unique", "ref is repeated"))


def question_errors(bundles: DataFrame) -> DataFrame:
    """Findings on questions and options, on what they refer to, and on a run's second question for a section."""

    def question(x: Column, i: Column) -> Column:
        at, options = _place("questions", i), x["options"]
        role = lambda r: F.size(F.filter(options, lambda o: o["role"] == r))
        right = F.filter(options, lambda o: o["is_correct"])
        texts = F.transform(options, lambda o: option_key(o["text"]))
        places = F.transform(options, lambda o: o["order_in_question"])
        roles = reduce(lambda a, b: a | b, [role(r) != n for r, n in ROLES.items()])
        own = _own([
            (_text(x["question"], LIMITS["question"]) | _text(x["justification"], LIMITS["justification"]), "question_fields", "a text is missing, blank or too long"),
            (~F.coalesce(x["status"].isin(*STATUSES), F.lit(False)), "question_status", "unknown status"),
            (F.coalesce(F.size(options), F.lit(0)) != 4, "four_options", "there must be four options"),
            (F.exists(options, lambda o: _text(o["text"], LIMITS["option"])), "option_fields", "an option is missing, blank or too long"),
            (roles, "option_roles", "one correct, one confusa and two distractor options are wanted"),
            ((F.size(right) != 1) | F.exists(right, lambda o: o["role"] != "correct"), "option_correct", "exactly the option with the role correct must be marked"),
            (F.size(F.array_distinct(texts)) < F.size(texts), "option_texts", "two options say the same"),
            (F.size(F.array_distinct(places)) < F.size(places), "option_order", "two options have the same place"),
        ], at, i)
        keys = F.array(
            _saying("node", x["node_ref"], None, False, i, at, "node_exists", "node_ref names no section"), _saying("run", x["run_ref"], None, False, i, at, "run_exists", "run_ref names no run"),
            _saying("pair", x["run_ref"], x["node_ref"], True, i, at, "pair_unique", "a run has one question a section"),
        )
        return F.concat(own.cast(_SAID), keys.cast(_SAID))

    def defined(name: str, kind: str) -> Column:
        # no finding here, whatever is repeated: that is for the checks on sections and runs
        key = lambda x, i: F.struct(F.lit(kind).alias("kind"), x["ref"].alias("key"), F.lit(None).cast("string").alias("second"), F.lit(True).alias("defines"), i.alias("i"), *(F.lit(None).cast("string").alias(c) for c in ("path", "rule", "message")))
        return F.transform(name, key)

    return _settled(bundles, F.flatten(F.transform("questions", question)), defined("nodes", "node"), defined("runs", "run"))


def _strings(value: Column, kind: T.DataType, path: Column, name: Column) -> Column | None:
    """All strings under a value as an array of (path, name, value); null where its type can't hold any."""
    empty = F.expr("cast(array() as array<struct<path:string, name:string, value:string>>)")
    if isinstance(kind, T.StringType):
        return F.array(F.struct(path.alias("path"), name.alias("name"), value.alias("value")))
    if isinstance(kind, T.StructType):
        parts = [_strings(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")), F.lit(f.name)) for f in kind.fields]
        parts = [F.coalesce(x, empty) for x in parts if x is not None]
        return F.concat(*parts) if parts else None
    if isinstance(kind, T.ArrayType):
        if _strings(value, kind.elementType, path, name) is None:
            return None
        each = F.transform(value, lambda x, i: F.coalesce(_strings(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), name), empty))
        return F.coalesce(F.flatten(each), empty)
    if isinstance(kind, T.MapType):
        if _strings(value, kind.valueType, path, name) is None:
            return None
        each = F.transform(F.map_entries(value), lambda e: F.coalesce(_strings(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"].cast("string")), e["key"].cast("string")), empty))
        return F.coalesce(F.flatten(each), empty)
    return None


def secrets(rows: DataFrame, key: str = "bundle_id", columns: tuple[str, ...] | None = None) -> DataFrame:
    """(key, path, rule) of strings anywhere in the rows that look like secrets, or whose names do and that are long enough.

    All columns but the key are looked through, however deeply strings lie in structs, lists and maps.
    """
    names = columns or tuple(c for c in rows.columns if c != key)
    found = [_strings(F.col(c), rows.schema[c].dataType, F.lit(f"$.{c}"), F.lit(c)) for c in names]
    pairs = rows.select(F.col(key).alias("bundle_id"), F.explode(F.concat(*(x for x in found if x is not None))).alias("e")).select("bundle_id", "e.*")
    named = pairs["name"].rlike(SECRET_NAMES) & (F.length(strip(pairs["value"])) >= SECRET_LENGTH)
    by_value = F.lit(None).cast("string")
    for label, pattern in reversed(SECRETS.items()):
        by_value = F.when(pairs["value"].rlike(pattern), label).otherwise(by_value)
    return pairs.select("bundle_id", "path", F.when(named, "name").otherwise(by_value).alias("rule")).filter("rule is not null")


def errors(bundles: DataFrame) -> DataFrame:
    """All errors of bundles whose header is right; of others the header's errors alone."""
    head = header_errors(bundles)
    sound = bundles.join(head.select("bundle_id").distinct(), "bundle_id", "left_anti")
    parts = [head, node_errors(sound), run_errors(sound), question_errors(sound)]
    hidden = secrets(sound).select("bundle_id", "path", "rule", F.lit("looks like a secret").alias("message"))
    return reduce(DataFrame.unionByName, [*parts, hidden])


def warnings(bundles: DataFrame) -> DataFrame:
    """(bundle_id, path, rule, message): failed sections, no or unserved questions, by status too, texts without a question."""
    rows, q, n = runs_of(bundles), questions_of(bundles), nodes_of(bundles)
    per = bundles.select("bundle_id").join(q.groupBy("bundle_id").agg(F.count("*").alias("n"), F.count_if(F.col("status").isin("pending", "valid")).alias("s")), "bundle_id", "left").fillna(0, ["n", "s"])
    unserved = q.filter(F.col("status").isin(*UNSERVED)).groupBy("bundle_id", "status").agg(F.count("*").alias("n"))
    bare = n.filter(F.size("chunks") > 0).join(q.select("bundle_id", F.col("node_ref").alias("ref")).distinct(), ["bundle_id", "ref"], "left_anti")
    return reduce(DataFrame.unionByName, [
        _found(rows, F.col("nodes_failed") > 0, _at("runs"), "failed_nodes", "some sections failed"),
        _found(per, F.col("n") == 0, F.lit("$.questions"), "no_questions", "there are no questions"),
        _found(per, (F.col("n") > 0) & (F.col("s") == 0), F.lit("$.questions"), "none_served", "no question is served"),
        _found(unserved, F.lit(True), F.concat(F.lit("$.questions."), "status"), "unserved_status", "questions of this status are not served"),
        _found(bare, F.lit(True), _at("nodes"), "uncovered", "a section with text has no question"),
    ])


def counts(bundles: DataFrame) -> DataFrame:
    """(bundle_id, nodes, chunks, runs, questions, served, and questions of each status)."""
    q = questions_of(bundles).groupBy("bundle_id").agg(F.count_if(F.col("status").isin("pending", "valid")).alias("served"), *(F.count_if(F.col("status") == s).alias(f"status_{s}") for s in STATUSES))
    sizes = bundles.select("bundle_id", F.size("nodes").alias("nodes"), F.aggregate("nodes", F.lit(0), lambda a, x: a + F.coalesce(F.size(x["chunks"]), F.lit(0))).alias("chunks"), F.size("runs").alias("runs"), F.size("questions").alias("questions"))
    return sizes.join(q, "bundle_id", "left").fillna(0)
