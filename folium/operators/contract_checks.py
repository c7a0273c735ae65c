"""Checks of bundles as they arrive: JSON of any shape, held against the delivery contract.

A bundle is (bundle_id, json). The text becomes a VARIANT, so that a text, a number and a boolean in the wrong place can be
told apart. A bundle is parsed once: one pass gives for its head and for each section, run and question an array of
findings and an array of the keys that it says, and only those are kept. What ties rows together (references, repeats)
goes through one aggregate by bundle and key. Findings are (bundle_id, path, rule, message).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium import shared
from folium.operators.explore import STATUSES
from folium.operators.validation import LIMITS, MODES, ROLES, RUN_STATUSES, SECRET_LENGTH, SECRET_NAMES, SECRETS, STAMP, UNSERVED, VERSIONS, cycles

MESSAGES = {
    "json": "not a JSON object", "version": "unknown version", "missing": "the field is missing", "type": "the field has the wrong type", "blank": "the text is blank", "length": "the text is too long",
    "range": "the number is negative", "stamp": "not an ISO stamp in UTC", "enum": "not one of the known values", "running": "the run has not ended", "number": "must be a number that is not negative", "object": "must be an object", "list": "must be a list",
    "unique": "stands there before", "reference": "names nothing in the bundle", "root": "no section is a root", "cycle": "sections are their own ancestors",
    "four_options": "there must be four options", "roles": "one correct, one confusa and two distractor options are wanted", "correct": "exactly the option with the role correct must be marked", "same_text": "two options say the same", "same_place": "two options have the same place", "secret": "looks like a secret",
}
_FOUND = "array<struct<path:string, rule:string>>"
_NONE = f"cast(array() as {_FOUND})"
#: The keys that a part defines or refers to: of which kind, and where it stands.
_SAID = "array<struct<kind:string, key:string, defines:boolean, path:string>>"
#: What a JSON text shows somewhere if a secret may be in it.
TRACE = "|".join([r'(?i:"(?:api[_-]?keys?|secrets?|passwords?|passwd|tokens?|credentials?|authorizations?)"\s*:)', *(p.replace(r"\b", "") for p in SECRETS.values())])
#: What such a text holds in lower case, whatever the pattern says besides: looking for these is far cheaper.
TRACES = ('"api', '"secret', '"passw', '"token', '"credential', '"authorization', "aiza", "sk-", "://", "-----begin ")


def _kind(x: str, key: str) -> str:
    return f"coalesce(schema_of_variant(try_variant_get({x}, '$.{key}', 'variant')), 'VOID')"


def _value(x: str, key: str, kind: str = "string") -> str:
    return f"try_variant_get({x}, '$.{key}', '{kind}')"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


class Fields:
    """Rules on the fields of objects, of each of which its fields and their kinds are taken once.

    A rule sees its object as `it`, of which `it.field` has the kind `k` and the variant `v`, and its place in a list as `j`;
    `path` gives where it stands, as SQL. `lists` names fields that are lists of objects, with the rules on those; they
    stand in `it` as they are, and null if they are no list.
    """

    def __init__(self, path: str, **lists: Fields):
        self.path, self.lists, self.keys, self.rules = path, lists, [], []

    def rule(self, key: str, told: str) -> Fields:
        self.keys.append(key)
        self.rules.append(f"named_struct('path', '.{key}', 'rule', {told})")
        return self

    def _add(self, key: str, needed: bool, *cases: tuple[str, str]) -> Fields:
        kind = f"it.{key}.k"
        absent = f"when {kind} = 'VOID' then " + ("'missing'" if needed else "null")
        told = " ".join(f"when {c.replace('KIND', kind)} then '{r}'" for c, r in cases)
        return self.rule(key, f"case {absent} {told} end")

    def text(self, key: str, limit: int | None = None, needed: bool = True, empty: bool = False) -> Fields:
        value = _of(key)
        cases = [("KIND <> 'STRING'", "type")]
        if not empty:
            cases.append((rf"not {value} rlike '(?U)\\S'", "blank"))
        if limit:
            cases.append((f"length({value}) > {limit}", "length"))
        return self._add(key, needed, *cases)

    def whole(self, key: str, needed: bool = True) -> Fields:
        # a number beyond 64 bits is a decimal without places; 1.0 is one of one digit
        return self._add(key, needed, (r"KIND <> 'BIGINT' and not KIND rlike '^DECIMAL\\((19|[23]\\d),0\\)$'", "type"), (f"{_of(key, 'decimal(38,0)')} < 0", "range"))

    def truth(self, key: str) -> Fields:
        return self.rule(key, f"if(it.{key}.k <> 'BOOLEAN', 'type', null)")

    def free(self, key: str) -> Fields:
        return self._add(key, False, ("not KIND like 'OBJECT%'", "object"))

    def stamp(self, key: str, needed: bool = True) -> Fields:
        pattern = STAMP.replace("\\", "\\\\")
        return self._add(key, needed, (f"KIND <> 'STRING' or not {_of(key)} rlike '{pattern}'", "stamp"))

    def known(self, key: str, values, *special: tuple[str, str]) -> Fields:
        value, kind = _of(key), f"it.{key}.k"
        told = " ".join(f"when {kind} = 'STRING' and {value} = '{v}' then '{r}'" for v, r in special)
        return self.rule(key, f"case {told} when {kind} <> 'STRING' or {value} not in ({_quoted(values)}) then 'enum' end")

    def number(self, key: str) -> Fields:
        return self.rule(key, f"if(it.{key}.k rlike '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' and {_of(key, 'double')} >= 0, null, 'number')")

    def listed(self, key: str) -> Fields:
        """A field of `lists` that must be there."""
        self.rules.append(f"named_struct('path', '.{key}', 'rule', if(it.{key} is null, 'list', null))")
        return self

    def type(self) -> str:
        """The type as which an object's fields are taken from a variant; what is no object is null by it."""
        return f"struct<{', '.join([*(f'{k}:variant' for k in self.keys), *(f'{k}:array<{x.type()}>' for k, x in self.lists.items())])}>"

    def shaped(self, objects: str) -> str:
        """An array of such structs, with the kinds of fields."""
        each = [*(f"'{k}', named_struct('k', coalesce(schema_of_variant(s.{k}), 'VOID'), 'v', s.{k})" for k in self.keys), *(f"'{k}', s.{k}" for k in self.lists)]
        return f"transform({objects}, s -> if(s is null, null, named_struct({', '.join(each)})))"

    def told(self) -> str:
        """The findings on `it`; their paths are put together for these alone."""
        return f"transform(filter(array({', '.join(self.rules)}), e -> e.rule is not null), e -> named_struct('path', concat({self.path}, e.path), 'rule', e.rule))"

    def of_shaped(self, shaped: str, *more: str) -> str:
        """The findings on an array of shaped() as one array, with `more` arrays of findings on each; one finding if it is no object."""
        told = f"cast({self.told()} as {_FOUND})"
        told = f"concat({', '.join([told, *more])})" if more else told
        return f"flatten(transform({shaped}, (it, j) -> if(it is null, cast(array(named_struct('path', {self.path}, 'rule', 'object')) as {_FOUND}), {told})))"

    def sql(self, x: str, *more: str) -> str:
        """The findings on one object, a variant."""
        return self.of_shaped(self.shaped(f"array(try_variant_get({x}, '$', '{self.type()}'))"), *more)


def _of(key: str, kind: str = "string", it: str = "it") -> str:
    return f"try_variant_get({it}.{key}.v, '$', '{kind}')"


def _let(name: str, value: str, told: str) -> str:
    """Findings `told` by a value that is taken once; none where it is null."""
    return f"coalesce(flatten(transform(array({value}), {name} -> {told})), {_NONE})"


def _repeats(values: str, path: str) -> str:
    """Findings on values (an array of struct v, j) that an earlier one equals; `path` names place e.j. Sorted once."""
    return f"aggregate(array(array_sort({values})), {_NONE}, (a, s) -> transform(filter(s, (e, k) -> k > 0 and get(s, k - 1).v = e.v), e -> named_struct('path', {path}, 'rule', 'unique')))"


def parsed(bundles: DataFrame) -> DataFrame:
    """(bundle_id, json, v): the text as a variant, null where it isn't JSON."""
    return bundles.select("bundle_id", "json", F.expr("try_parse_json(json)").alias("v"))


def _head_rules() -> str:
    """What is wrong with the head of a bundle v: JSON, version, generator, the document's fields, the lists."""
    root = Fields("'$'").stamp("generated_at")
    for key in ("nodes", "runs", "questions"):
        root.rules.append(f"named_struct('path', '.{key}', 'rule', if({key} is null, 'list', null))")
    maker = Fields("'$.generator'").text("tool").text("version").sql("it.generator.v")
    manual = Fields("'$.manual'").text("code", LIMITS["code"]).text("title", LIMITS["title"]).text("source_path").text("extractor_used").whole("page_count").stamp("ingested_at").free("metadata").text("edition", LIMITS["edition"], False).text("branch", LIMITS["branch"], False).sql("it.manual.v")
    hint = Fields("'$.catalog_hint'").text("grado_code", needed=False).text("materia_code", needed=False).sql("it.catalog_hint.v")
    version = f"it.bundle_version.k = 'BIGINT' and {_of('bundle_version', 'bigint')} in ({', '.join(map(str, VERSIONS))})"
    one = lambda path, rule: f"cast(array(named_struct('path', '{path}', 'rule', '{rule}')) as {_FOUND})"
    absent = lambda key, found: f"if(it.{key}.k = 'VOID', {one(f'$.{key}', 'object')}, {found})"
    hinted = f"if(it.catalog_hint.k = 'VOID', {_NONE}, {hint})"
    own = f"cast({root.told()} as {_FOUND})"
    root.keys += ["bundle_version", "generator", "manual", "catalog_hint"]
    # without a known version nothing else means anything
    told = f"case when it is null then {one('$', 'json')} when not coalesce({version}, false) then {one('$.bundle_version', 'version')} else concat({own}, {absent('generator', maker)}, {absent('manual', manual)}, {hinted}) end"
    return f"flatten(transform({root.shaped(f"array(try_variant_get(v, '$', '{root.type()}'))")}, it -> {told}))"


def _node_rules() -> str:
    """Findings on a section and its chunks, each by itself."""
    chunk = Fields("concat(at, '.chunks[', j, ']')").whole("ordinal").text("text").whole("char_count").whole("page_start").whole("page_end").truth("has_table").truth("has_image_ref").free("metadata")
    own = Fields("at", chunks=chunk).text("ref", LIMITS["ref"]).text("parent_ref", needed=False, empty=True).whole("level").text("level_label", LIMITS["level_label"]).text("ordinal", LIMITS["ordinal"], empty=True).text("title", LIMITS["node_title"]).text("breadcrumb", empty=True).whole("page_start").whole("page_end", False).truth("is_anexo").free("metadata").listed("chunks")
    ordinals = f"filter(transform(cs, (c, j) -> named_struct('v', if(c.ordinal.k = 'BIGINT', {_of('ordinal', 'bigint', 'c')}, null), 'j', j)), e -> e.v is not null)"
    repeated = _repeats(ordinals, "concat(at, '.chunks[', e.j, '].ordinal')")
    return own.sql("x", _let("cs", chunk.shaped("it.chunks"), f"concat({chunk.of_shaped('cs')}, coalesce({repeated}, {_NONE}))"))


def _run_rules() -> str:
    own = Fields("at").text("ref").text("model", LIMITS["model"]).text("profile_used", LIMITS["profile"]).known("mode", MODES).known("status", RUN_STATUSES, ("running", "running")).stamp("started_at").stamp("completed_at", False)
    for key in ("nodes_total", "nodes_completed", "nodes_failed", "cost_input_tokens", "cost_output_tokens", "cost_cached_tokens"):
        own.whole(key)
    return own.number("cost_estimate_usd").free("rules_snapshot").free("metadata").sql("x")


def _question_rules() -> str:
    """Findings on a question and its options, each by itself."""
    option = Fields("concat(at, '.options[', j, ']')").known("role", ROLES).whole("order_in_question").text("text", LIMITS["option"]).free("metadata").truth("is_correct")
    own = Fields("at", options=option).text("run_ref").text("node_ref").whole("generation_order").text("question_text", LIMITS["question"]).text("justification", LIMITS["justification"]).stamp("created_at").stamp("validated_at", False).free("metadata").known("validation_status", STATUSES).listed("options")
    only = lambda key, kind, sql: f"filter(transform(os, o -> if(o.{key}.k = '{kind}', {sql}, null)), e -> e is not null)"
    role = only("role", "STRING", _of("role", it="o"))
    marked = f"filter(os, o -> o.is_correct.k = 'BOOLEAN' and {_of('is_correct', 'boolean', 'o')})"
    same = only("text", "STRING", rf"lower(trim(regexp_replace({_of('text', it='o')}, '(?U)\\s+', ' ')))")
    places = only("order_in_question", "BIGINT", _of("order_in_question", "bigint", "o"))
    wrong_roles = " or ".join(f"size(filter({role}, r -> r = '{r}')) <> {n}" for r, n in ROLES.items())
    told = [(f"size(os) <> {sum(ROLES.values())}", "four_options"), (wrong_roles, "roles"), (f"size({marked}) <> 1 or not coalesce({_of('role', it=f'get({marked}, 0)')} = 'correct', false)", "correct"), (f"size(array_distinct({same})) < size({same})", "same_text"), (f"size(array_distinct({places})) < size({places})", "same_place")]
    whole = f"cast(filter(array({', '.join(f"named_struct('path', at, 'rule', if({bad}, '{rule}', null))" for bad, rule in told)}), e -> e.rule is not null) as {_FOUND})"
    return own.sql("x", _let("os", option.shaped("it.options"), f"concat({option.of_shaped('os')}, {whole})"))


def _said(*keys: tuple[str, str, bool, str]) -> str:
    """The keys of a part, of (kind, field, whether it defines the key, what is added to the path); only texts count."""
    each = (f"if({_kind('x', field)} = 'STRING', named_struct('kind', '{kind}', 'key', {_value('x', field)}, 'defines', {str(defines).lower()}, 'path', concat(at, '.{field}')), null)" for kind, field, defines in keys)
    return f"cast(filter(array({', '.join(each)}), e -> e is not null) as {_SAID})"


def surveyed(bundles: DataFrame) -> DataFrame:
    """(bundle_id, part, i, found, said, up, v) in one pass over bundles, each parsed once.

    A bundle with a wrong head is one row of part `head`. Of others there is a row for each section (`up` is its parent's
    ref), run and question, and one of part `whole` with the bundle as v where its text shows a trace of a secret.
    """
    names = ("nodes", "runs", "questions")
    lists = (f"transform({name}, (x, i) -> named_struct('part', '{name}', 'i', i, 'x', x))" for name in names)
    one = lambda part, x: f"array(named_struct('part', '{part}', 'i', 0, 'x', {x}))"
    nothing = "cast(array() as array<struct<part:string, i:int, x:variant>>)"
    whole = f"if(traced, {one('whole', 'v')}, {nothing})"
    parts = f"if(size(head) > 0, {one('head', 'cast(null as variant)')}, concat({', '.join(f'coalesce({x}, {nothing})' for x in lists)}, {whole}))"
    rows = parsed(bundles).withColumns({name: F.expr(f"try_variant_get(v, '$.{name}', 'array<variant>')") for name in names})
    # what is escaped shows as such in the text alone
    text = F.when(F.contains("json", F.lit("\\u")) | F.contains("json", F.lit("\\/")), F.to_json("v")).otherwise(F.col("json"))
    traced = reduce(Column.__or__, (F.contains(F.lower(text), F.lit(x)) for x in TRACES)) & text.rlike(TRACE)
    rows = rows.select("bundle_id", "v", *names, F.expr(_head_rules()).alias("head"), traced.alias("traced")).select("bundle_id", "head", F.explode(F.expr(parts)).alias("p"))
    rows = rows.select("bundle_id", "head", "p.*").withColumn("at", F.expr("concat('$.', part, '[', i, ']')"))
    pair = f"if({_kind('x', 'run_ref')} = 'STRING' and {_kind('x', 'node_ref')} = 'STRING', array(named_struct('kind', 'pair', 'key', to_json(array({_value('x', 'run_ref')}, {_value('x', 'node_ref')})), 'defines', true, 'path', at)), cast(array() as {_SAID}))"
    said = {
        "nodes": _said(("node", "ref", True), ("node", "parent_ref", False)), "runs": _said(("run", "ref", True)),
        "questions": f"concat({_said(('node', 'node_ref', False), ('run', 'run_ref', False))}, {pair})",
    }
    found = {"head": "head", "nodes": _node_rules(), "runs": _run_rules(), "questions": _question_rules()}
    case = lambda rules, other: f"case part {' '.join(f"when '{k}' then {x}" for k, x in rules.items())} else {other} end"
    return rows.selectExpr("bundle_id", "part", "i", f"{case(found, _NONE)} as found", f"{case(said, f'cast(array() as {_SAID})')} as said", f"if(part = 'nodes', {_value('x', 'parent_ref')}, null) as up", "if(part = 'whole', x, null) as v")


def reference_findings(parts: DataFrame) -> DataFrame:
    """Repeated keys, and references to nothing, of surveyed bundles, by one aggregate over (bundle, kind, key).

    Tasks add up before they shuffle, so a key that all rows name is no burden; then only rows of the keys that are wrong
    are looked at again.
    """
    rows = parts.select("bundle_id", "i", F.explode("said").alias("e")).select("bundle_id", "i", "e.*")
    keys = ["bundle_id", "kind", "key"]
    wrong = rows.groupBy(*keys).agg(F.count_if("defines").alias("n")).filter("n <> 1")
    later = F.row_number().over(Window.partitionBy(*keys, "defines").orderBy("i"))
    rows = rows.join(wrong, keys).withColumn("k", F.when(F.col("defines"), later))
    lost = (F.col("n") == 0) & ~F.col("defines")
    return rows.filter(lost | (F.col("k") > 1)).select("bundle_id", "path", F.when(lost, "reference").otherwise("unique").alias("rule"))


def tree_findings(parts: DataFrame) -> DataFrame:
    """Surveyed bundles without a root, and those whose sections go round."""
    own = F.filter("said", lambda e: (e["kind"] == "node") & e["defines"])
    edges = parts.filter("part = 'nodes'").select("bundle_id", F.explode(own).alias("e"), F.col("up").alias("parent_ref")).select("bundle_id", F.col("e.key").alias("ref"), "parent_ref")
    rootless = edges.groupBy("bundle_id").agg(F.count_if(F.col("parent_ref").isNull()).alias("roots")).filter("roots = 0")
    looped = cycles(edges).select("bundle_id").distinct()
    at = F.lit("$.nodes").alias("path")
    return rootless.select("bundle_id", at, F.lit("root").alias("rule")).unionByName(looped.select("bundle_id", at, F.lit("cycle").alias("rule")))


def secret_findings(parts: DataFrame) -> DataFrame:
    """Texts anywhere in surveyed bundles that look like secrets, or whose field's name does and that are long enough.

    Bundles whose whole text shows no trace are not looked into. The others are walked level by level, objects and lists
    alike, until no level holds any; an object's secret field is reported once and not looked into.
    """
    spark = parts.sparkSession
    level = parts.filter("part = 'whole'").select("bundle_id", F.lit("$").alias("path"), F.lit("").alias("name"), "v")
    by_value = F.lit(False)
    for pattern in SECRETS.values():
        by_value = by_value | F.col("s").rlike(pattern)
    found, paths = None, []
    while True:
        kind = F.expr("schema_of_variant(v)")
        level = level.withColumns({"s": F.when(kind == "STRING", F.expr("variant_get(v, '$', 'string')")), "leaf": ~kind.rlike("^(OBJECT|ARRAY)")})
        level, path = shared.stored(level)
        paths.append(path)
        named = F.col("name").rlike(SECRET_NAMES) & (F.length(F.expr(r"regexp_replace(s, '(?U)^\\s+|\\s+$', '')")) >= SECRET_LENGTH)
        hits = level.filter(F.col("s").isNotNull() & (named | by_value)).select("bundle_id", "path", F.lit("secret").alias("rule"))
        found = hits if found is None else found.unionByName(hits)
        inner = level.filter("not leaf")
        if inner.isEmpty():
            break
        inner.createOrReplaceTempView("folium_level")
        step = "if(p.key is null, concat(path, '[', p.pos, ']'), concat(path, '.', p.key))"
        level = spark.sql(f"select bundle_id, {step} as path, coalesce(p.key, name) as name, p.value as v from folium_level, lateral variant_explode(v) p")
    spark.catalog.dropTempView("folium_level")
    out, path = shared.stored(found)
    for p in paths:
        shared.delete(spark, p)
    return out


def errors(bundles: DataFrame) -> DataFrame:
    """(bundle_id, path, rule, message) of everything that breaks the contract; bundles with a wrong head only have that.

    Null and empty texts are no JSON. Fields that the contract doesn't know play no part; of fields that stand twice in
    an object none is taken, so that the bundle counts as no JSON. No bundles have no errors.
    """
    parts, _ = shared.stored(surveyed(bundles))
    own = parts.select("bundle_id", F.explode("found").alias("e")).select("bundle_id", "e.path", "e.rule")
    told = [own, reference_findings(parts), tree_findings(parts), secret_findings(parts)]
    messages = F.create_map(*(F.lit(x) for pair in MESSAGES.items() for x in pair))
    return reduce(DataFrame.unionByName, told).withColumn("message", messages[F.col("rule")])


def _sizes(docs: DataFrame) -> DataFrame:
    """(bundle_id, nodes, chunks, runs, questions, served, status_...) in one pass over each bundle."""
    list_ = lambda name: f"coalesce(try_variant_get(v, '$.{name}', 'array<variant>'), array())"
    status = f"transform({list_('questions')}, x -> {_value('x', 'validation_status')})"
    chunks = f"aggregate({list_('nodes')}, 0, (a, x) -> a + coalesce(size(try_variant_get(x, '$.chunks', 'array<variant>')), 0))"
    rows = docs.selectExpr("bundle_id", f"size({list_('nodes')}) as nodes", f"{chunks} as chunks", f"size({list_('runs')}) as runs", f"size({list_('questions')}) as questions", f"{status} as status")
    counted = {f"status_{s}": F.expr(f"size(filter(status, x -> x = '{s}'))") for s in sorted(STATUSES)}
    return rows.withColumns(counted).withColumn("served", F.expr(" + ".join(f"status_{s}" for s in STATUSES if s not in UNSERVED))).drop("status")


def counts(bundles: DataFrame) -> DataFrame:
    """How much each bundle holds, and how many questions of each status."""
    return _sizes(parsed(bundles))


def warnings(bundles: DataFrame) -> DataFrame:
    """(bundle_id, rule, n): sections that runs left out, no questions, none or some of them not served, texts without a question."""
    docs = parsed(bundles)
    failed = f"filter(transform(coalesce(try_variant_get(v, '$.runs', 'array<variant>'), array()), x -> if({_kind('x', 'nodes_failed')} = 'BIGINT', {_value('x', 'nodes_failed', 'bigint')}, 0)), n -> n > 0)"
    asked = f"transform(coalesce(try_variant_get(v, '$.questions', 'array<variant>'), array()), x -> {_value('x', 'node_ref')})"
    with_text = f"transform(filter(coalesce(try_variant_get(v, '$.nodes', 'array<variant>'), array()), x -> {_kind('x', 'ref')} = 'STRING' and coalesce(size(try_variant_get(x, '$.chunks', 'array<variant>')), 0) > 0), x -> {_value('x', 'ref')})"
    rows = _sizes(docs).join(docs.selectExpr("bundle_id", f"size({failed}) as failed_runs", f"size(array_except({with_text}, {asked})) as bare"), "bundle_id")
    told = [
        ("failed_nodes", F.col("failed_runs")), ("no_questions", F.when(F.col("questions") == 0, 1)), ("none_served", F.when((F.col("questions") > 0) & (F.col("served") == 0), 1)),
        *((f"unserved_{s}", F.col(f"status_{s}")) for s in UNSERVED), ("uncovered", F.col("bare")),
    ]
    each = F.explode(F.array(*(F.struct(F.lit(rule).alias("rule"), n.cast("int").alias("n")) for rule, n in told)))
    return rows.select("bundle_id", each.alias("e")).select("bundle_id", "e.rule", "e.n").filter("n > 0")
