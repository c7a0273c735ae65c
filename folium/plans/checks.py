"""Registered queries on bundles, their checks, rules and layout sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium import shared
from folium.operators import contract_checks, generation, rules, validation
from folium.plans import standins as S
from folium.sources import bundle_files, bundles, contract, extractors, layout

SQL: dict[str, str] = {}


def _bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as documents, orders as sections and runs, lines as chunks; with faults by number."""
    o, li, c = S.table(spark, sf, "orders"), S.table(spark, sf, "lineitem"), S.table(spark, sf, "customer")
    chunks = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct((F.col("l_linenumber") % 6).cast("int").alias("ordinal"), F.when(F.col("l_quantity") > 2, F.col("l_returnflag")).otherwise(" ").alias("text"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end")))).alias("chunks"))
    parent = F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") - F.col("o_orderkey") % 4).cast("string")).when(F.col("o_custkey") % 50 == 7, F.col("o_orderkey").cast("string"))
    node = F.struct(F.col("o_orderkey").cast("string").alias("ref"), parent.alias("parent_ref"), (F.col("o_orderkey") % 7 - 1).cast("int").alias("level"), F.when(F.col("o_orderkey") % 9 == 0, "").otherwise("Capítulo").alias("level_label"), F.lit("I").alias("ordinal"), F.col("o_orderpriority").alias("title"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), F.coalesce("chunks", F.expr(f"cast(array() as array<{bundles.CHUNK}>)")).alias("chunks"))
    nodes = o.join(chunks, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_custkey").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    run = F.struct((F.col("o_orderkey") % 50).cast("string").alias("ref"), F.lit("m").alias("model"), F.when(F.col("o_orderstatus") == "F", "batch").when(F.col("o_orderstatus") == "O", "immediate").otherwise("other").alias("mode"), F.when(F.col("o_orderkey") % 5 == 0, "running").otherwise("succeeded").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"), F.lit(None).cast("string").alias("completed_at"), F.lit(1).alias("nodes_total"), F.lit(1).alias("nodes_completed"), (F.col("o_orderkey") % 6 - 1).cast("int").alias("nodes_failed"), F.col("o_totalprice").alias("cost_usd"))
    runs = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    role = F.element_at(F.array(*map(F.lit, ("correct", "confusa", "distractor", "distractor"))), ((F.col("l_linenumber") - 1) % 4 + 1).cast("int"))
    option = F.struct(F.col("l_linenumber").cast("int").alias("order_in_question"), role.alias("role"), F.concat(F.lit(" "), "l_returnflag", F.lit("  "), "l_linestatus").alias("text"), (F.col("l_linenumber") == 1).alias("is_correct"))
    options = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(option)).alias("options"))
    question = F.struct((F.col("o_orderkey") % 40).cast("string").alias("run_ref"), (F.col("o_orderkey") - F.col("o_orderkey") % 3).cast("string").alias("node_ref"), F.col("o_orderpriority").alias("question"), F.when(F.col("o_orderkey") % 16 == 1, "see sk-abcdefghijklmnopqrstuvwx").otherwise("j").alias("justification"), F.when(F.col("o_orderkey") % 8 == 0, "draft").when(F.col("o_orderkey") % 8 == 3, "rejected").otherwise("valid").alias("status"), "options")
    questions = o.join(options, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.array_sort(F.collect_list(question)).alias("questions"))
    rows = c
    for name, part, kind in (("nodes", nodes, bundles.NODE), ("runs", runs, bundles.RUN), ("questions", questions, bundles.QUESTION)):
        rows = rows.join(part.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").withColumn(name, F.coalesce(name, F.expr(f"cast(array() as array<{kind}>)")))
    manual = F.when(F.col("c_custkey") % 20 != 0, F.struct(F.col("c_name").alias("code"), F.lit(None).cast("string").alias("edition"), F.when(F.col("c_custkey") % 15 == 0, "  ").otherwise(F.col("c_mktsegment")).alias("title"), F.lit(None).cast("string").alias("branch"), F.lit(None).cast("string").alias("source_sha256")))
    secret = F.create_map(F.lit("note"), F.when(F.col("c_custkey") % 10 == 0, "postgres://user:hunter2@host/db").when(F.col("c_custkey") % 10 == 1, "AIzaSyA1234567890abcdefghij").otherwise("plain"), F.lit("api_key"), F.when(F.col("c_custkey") % 10 == 3, "a rather long one").otherwise("short"), F.lit("cost_input_tokens"), F.lit("123456789012345"))
    return rows.select(F.col("c_custkey").cast("string").alias("bundle_id"), F.when(F.col("c_custkey") % 30 == 0, 9).otherwise(1).alias("version"), F.when(F.col("c_custkey") % 25 == 0, "2024-01-01T00:00:00+02:00").otherwise("2024-01-01T00:00:00Z").alias("generated_at"), manual.alias("manual"), secret.alias("metadata"), "nodes", "runs", "questions")


_SOUND = "sound as (select c_custkey from customer where c_custkey % 30 <> 0 and c_custkey % 20 <> 0 and c_custkey % 15 <> 0 and c_custkey % 25 <> 0)"
_RUNS = "r as (select o_custkey::varchar as bundle_id, row_number() over (partition by o_custkey order by (o_orderkey % 50)::varchar, mode, case when o_orderkey % 5 = 0 then 'running' else 'succeeded' end, o_orderdate, o_orderkey % 6, o_totalprice) - 1 as i, (o_orderkey % 50)::varchar as ref, mode, o_orderkey, o_orderkey % 6 - 1 as failed from (select *, case o_orderstatus when 'F' then 'batch' when 'O' then 'immediate' else 'other' end as mode from orders) where o_custkey in (select c_custkey from sound))"


def bundle_header_errors(spark: SparkSession, sf: str) -> DataFrame:
    return validation.header_errors(_bundles(spark, sf)).select("bundle_id", "rule")


SQL["bundle_header_errors"] = """select c_custkey::varchar as bundle_id, 'version' as rule from customer where c_custkey % 30 = 0 union all select c_custkey::varchar, 'manual' from customer where c_custkey % 20 = 0
union all select c_custkey::varchar, 'manual_title' from customer where c_custkey % 15 = 0 and c_custkey % 20 <> 0
union all select c_custkey::varchar, 'generated_at' from customer where c_custkey % 25 = 0"""


def orphan_parent(spark: SparkSession, sf: str) -> DataFrame:
    return validation.node_errors(_bundles(spark, sf)).groupBy("bundle_id", "rule").agg(F.count("*").alias("n"))


SQL["orphan_parent"] = """with n as (select o_custkey::varchar as bundle_id, o_orderkey, case when o_orderkey % 4 <> 0 then o_orderkey - o_orderkey % 4 when o_custkey % 50 = 7 then o_orderkey end as parent from orders),
c as (select o_custkey::varchar as bundle_id, l_orderkey, l_linenumber, l_linenumber % 6 as ordinal, l_quantity from lineitem join orders on o_orderkey = l_orderkey),
e as (
  select bundle_id, 'parent_exists' as rule from n where parent is not null and not exists (select 1 from n p where p.bundle_id = n.bundle_id and p.o_orderkey = n.parent)
  union all select bundle_id, 'node_numbers' from n where o_orderkey % 7 = 0
  union all select bundle_id, 'node_fields' from n where o_orderkey % 9 = 0
  union all select bundle_id, 'root' from n group by bundle_id having count(parent) = count(*)
  union all select distinct bundle_id, 'cycle' from n where parent = o_orderkey
  union all select bundle_id, 'chunk_fields' from c where l_quantity <= 2
  union all select bundle_id, 'chunk_ordinal_unique' from c qualify row_number() over (partition by bundle_id, l_orderkey, ordinal order by l_linenumber) > 1
) select bundle_id, rule, count(*) as n from e group by all"""


def run_checks(spark: SparkSession, sf: str) -> DataFrame:
    b = _bundles(spark, sf)
    sound = b.join(validation.header_errors(b).select("bundle_id").distinct(), "bundle_id", "left_anti")
    return validation.run_errors(sound).select("bundle_id", "path", "rule")


SQL["run_checks"] = f"""with {_SOUND}, {_RUNS}, x as (
  select bundle_id, i, 'run_mode' as rule from r where mode = 'other' union all select bundle_id, i, 'run_status' from r where o_orderkey % 5 = 0 union all select bundle_id, i, 'run_counters' from r where failed < 0
  union all select bundle_id, i, 'run_ref_unique' from r qualify row_number() over (partition by bundle_id, ref order by i) > 1)
select bundle_id, '$.runs[' || i || ']' as path, rule from x"""


def role_counts(spark: SparkSession, sf: str) -> DataFrame:
    return validation.question_errors(_bundles(spark, sf)).groupBy("bundle_id", "rule").agg(F.count("*").alias("n"))


SQL["role_counts"] = """with l as (select l_orderkey, count(*) as n, count(*) filter ((l_linenumber - 1) % 4 = 0) as a, count(*) filter ((l_linenumber - 1) % 4 = 1) as b, count(*) filter ((l_linenumber - 1) % 4 > 1) as c,
  count(distinct l_returnflag || l_linestatus) as texts, count(distinct l_linenumber) as places, count(*) filter (l_linenumber = 1) as marked from lineitem group by l_orderkey),
q as (select o_custkey::varchar as bundle_id, o_orderkey, o_orderkey - o_orderkey % 3 as node, o_orderkey % 40 as run, l.* from orders join l on l_orderkey = o_orderkey),
e as (
  select bundle_id, 'question_status' as rule from q where o_orderkey % 8 = 0 union all select bundle_id, 'four_options' from q where n <> 4 union all select bundle_id, 'option_roles' from q where a <> 1 or b <> 1 or c <> 2
  union all select bundle_id, 'option_correct' from q where marked <> 1 union all select bundle_id, 'option_texts' from q where texts < n union all select bundle_id, 'option_order' from q where places < n
  union all select bundle_id, 'node_exists' from q where not exists (select 1 from orders o where o.o_custkey::varchar = q.bundle_id and o.o_orderkey = q.node)
  union all select bundle_id, 'run_exists' from q where not exists (select 1 from orders o where o.o_custkey::varchar = q.bundle_id and o.o_orderkey % 50 = q.run)
  union all select bundle_id, 'pair_unique' from q qualify row_number() over (partition by bundle_id, run, node order by o_orderkey) > 1
) select bundle_id, rule, count(*) as n from e group by all"""


def secret_scan_flat(spark: SparkSession, sf: str) -> DataFrame:
    return validation.secrets(_bundles(spark, sf), columns=("metadata",))


SQL["secret_scan_flat"] = "select c_custkey::varchar as bundle_id, case when c_custkey % 10 = 3 then '$.metadata.api_key' else '$.metadata.note' end as path, case c_custkey % 10 when 0 then 'connection_string' when 1 then 'google_key' else 'name' end as rule from customer where c_custkey % 10 in (0, 1, 3)"


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Everywhere in whole bundles: metadata, sections, chunks, runs, questions and options."""
    return validation.secrets(_bundles(spark, sf)).groupBy("bundle_id", F.regexp_replace("path", r"\d+", "#").alias("place"), "rule").agg(F.count("*").alias("n"))


SQL["secret_scan"] = f"""with f as ({SQL["secret_scan_flat"]})
select bundle_id, path as place, rule, 1::bigint as n from f
union all select o_custkey::varchar, '$.questions[#].justification', 'openai_key', count(*) from orders where o_orderkey % 16 = 1 and o_orderkey in (select l_orderkey from lineitem) group by 1"""


def bundle_warnings(spark: SparkSession, sf: str) -> DataFrame:
    return validation.warnings(_bundles(spark, sf)).groupBy("bundle_id", "rule").agg(F.count("*").alias("n"))


SQL["bundle_warnings"] = """with q as (select o_custkey, o_orderkey, o_orderkey - o_orderkey % 3 as node, o_orderkey % 8 not in (0, 3) as served, o_orderkey % 8 = 3 as rejected from orders where o_orderkey in (select l_orderkey from lineitem)),
e as (
  select o_custkey as c, 'failed_nodes' as rule from orders where o_orderkey % 6 - 1 > 0
  union all select c_custkey, 'no_questions' from customer where c_custkey not in (select o_custkey from q)
  union all select o_custkey, 'none_served' from q group by o_custkey having not bool_or(served)
  union all select o_custkey, 'unserved_status' from q where rejected group by o_custkey
  union all select o.o_custkey, 'uncovered' from orders o where o_orderkey in (select l_orderkey from lineitem) and not exists (select 1 from q where q.o_custkey = o.o_custkey and q.node = o.o_orderkey)
) select c::varchar as bundle_id, rule, count(*) as n from e group by all"""


def bundle_counts(spark: SparkSession, sf: str) -> DataFrame:
    return validation.counts(_bundles(spark, sf))


SQL["bundle_counts"] = """with l as (select l_orderkey, count(*) as n from lineitem group by 1)
select c_custkey::varchar as bundle_id, count(o_orderkey)::int as nodes, coalesce(sum(l.n), 0)::int as chunks, count(o_orderkey)::int as runs, count(l.n)::int as questions, count(l.n) filter (o_orderkey % 8 not in (0, 3)) as served,
0::bigint as status_pending, count(l.n) filter (o_orderkey % 8 not in (0, 3)) as status_valid, 0::bigint as status_needs_review, count(l.n) filter (o_orderkey % 8 = 3) as status_rejected
from customer left join orders on o_custkey = c_custkey left join l on l_orderkey = o_orderkey group by c_custkey"""


def bundle_json(spark: SparkSession, sf: str) -> DataFrame:
    return bundles.as_json(_bundles(spark, sf)).select("bundle_id", "sha256", F.length("json").alias("n_chars"))


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, ("manual", "codigo_legal", "ley_organica", None))), (F.col("c_custkey") % 4 + 1).cast("int"))
    topics = F.when(F.col("c_custkey") % 3 == 0, F.array("c_mktsegment"))
    over = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"), name.alias("profile"), topics.alias("forbidden_topics"), F.lit(None).cast("array<string>").alias("preferred_topics"), F.when(F.col("c_custkey") % 5 == 0, "").alias("style_guide"), F.lit(None).cast("string").alias("extra_instructions"))
    return rules.merged(rules.table(spark), over)


def merge_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _rules(spark, sf).select("doc_id", "name", F.array_join("forbidden_topics", "|").alias("forbidden_topics"), F.array_join("preferred_topics", "|").alias("preferred_topics"), "style_guide", "extra_instructions")


_DEFAULTS = ", ".join("('{}', '{}', '{}', '{}', '{}')".format(r.name, "|".join(r.forbidden_topics), "|".join(r.preferred_topics), r.style_guide, r.extra_instructions) for r in rules.DEFAULTS.values())
SQL["merge_rules"] = f"""with d(name, f, p, s, e) as (values {_DEFAULTS}), o as (select c_custkey as doc_id, coalesce(['manual', 'codigo_legal', 'ley_organica', null][c_custkey % 4 + 1], 'manual') as name, c_mktsegment from customer)
select doc_id, name, case when doc_id % 3 = 0 then c_mktsegment else f end as forbidden_topics, p as preferred_topics, case when doc_id % 5 = 0 then '' else s end as style_guide, e as extra_instructions from o join d using (name)"""


def model_instructions(spark: SparkSession, sf: str) -> DataFrame:
    return _rules(spark, sf).select("doc_id", generation.creator_instructions().alias("creator"), generation.solver_instructions(F.concat(F.lit("¿"), "name", F.lit("?"))).alias("solver"))


SQL["model_instructions"] = f"""with m as ({SQL["merge_rules"]}), t as (select *, coalesce(nullif(replace(preferred_topics, '|', ', '), ''), '(ninguno)') as wanted, coalesce(nullif(replace(forbidden_topics, '|', ', '), ''), '(ninguno)') as shunned from m)
select doc_id, 'Eres evaluador de adiestramiento. Propón de una a tres preguntas cuya respuesta esté, palabra por palabra, en el texto. No des opciones ni respuestas.' || chr(10) || 'Documento: ' || name
  || chr(10) || 'Temas preferentes: ' || wanted || chr(10) || 'Temas excluidos: ' || shunned || chr(10) || 'Responde solo con JSON: {{"questions": ["..."]}}' as creator,
  'Da cuatro opciones para la pregunta: una correct (cita literal del texto), una confusa y dos distractor, y una justificación.' || chr(10) || 'Documento: ' || name || chr(10) || 'Estilo: ' || coalesce(nullif(style_guide, ''), '(ninguno)')
  || chr(10) || 'Temas preferentes: ' || wanted || chr(10) || 'Temas excluidos: ' || shunned || chr(10) || 'Indicaciones: ' || coalesce(nullif(extra_instructions, ''), '(ninguna)')
  || chr(10) || 'Responde solo con JSON: {{"question_text": "...", "justification": "...", "options": [{{"role": "correct", "text": "..."}}, ...]}}' || chr(10) || 'Pregunta: ¿' || name || '?' as solver from t"""


def html_elements(spark: SparkSession, sf: str) -> DataFrame:
    return layout.from_html(S.table(spark, sf, "pages")).groupBy("page_id", "kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


SQL["html_elements"] = r"""with b as (select page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') as h from pages),
e as (select page_id, unnest(regexp_extract_all(h, '(?is)<h1\b[^>]*>.*?</h1>|<h2\b[^>]*>.*?</h2>|<h3\b[^>]*>.*?</h3>|<h4\b[^>]*>.*?</h4>|<h5\b[^>]*>.*?</h5>|<h6\b[^>]*>.*?</h6>|<p\b[^>]*>.*?</p>|<li\b[^>]*>.*?</li>|<table\b[^>]*>.*?</table>')) as raw from b),
t as (select page_id, lower(regexp_extract(raw, '^<(\w+)', 1)) as tag, trim(regexp_replace(regexp_replace(raw, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as text from e)
select page_id, case when tag = 'h1' then 'title' when starts_with(tag, 'h') then 'heading' when tag = 'p' then 'narrative' when tag = 'li' then 'list_item' else 'table' end as kind, count(*) as n, sum(length(text))::bigint as chars from t group by all"""


def vendor_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Event types as labels, and polygons from orders."""
    label = F.element_at(F.array(*map(F.lit, ("title", "section_header", "text", "list-item", "picture", "chart", "footnote", "table"))), (F.col("event_id") % 8 + 1).cast("int"))
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("value").alias("x1"), F.lit(1.0).alias("y1"))
    items = S.table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), label.alias("label"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("  "), "event_type")).alias("text"), F.when(F.col("event_id") % 3 == 0, "- ").alias("marker"), F.when(F.col("event_id") % 7 != 0, F.array(F.struct((F.col("event_id") % 9).cast("int").alias("page_no"), box.alias("bbox")))).otherwise(F.array().cast("array<struct<page_no:int, bbox:struct<x0:double, y0:double, x1:double, y1:double>>>")).alias("prov"))
    return layout.normalise(items, "docling").select("doc_id", "pos", "page_number", "kind", "text", F.col("bbox.x1").alias("x1"))


SQL["vendor_labels"] = """with i as (select user_id as doc_id, event_id as pos, ['title', 'heading', 'narrative', 'list_item', 'figure', 'other', 'page_footer', 'table'][event_id % 8 + 1] as kind,
  case when event_id % 5 <> 0 then event_type else '' end as bare, event_id, value from events)
select doc_id, pos, case when event_id % 7 <> 0 then event_id % 9 else 0 end::int as page_number, kind, case when event_id % 3 = 0 then trim('- ' || bare) else bare end as text, case when event_id % 7 <> 0 then value end as x1
from i where bare <> '' or event_id % 3 = 0 or kind in ('table', 'figure')"""

def layout_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as the second vendor's JSON, a line each, read back through the layout source."""
    label = "element_at(array('Title', 'Header', 'NarrativeText', 'ListItem', 'Table', 'Image', 'Footer', 'FigureCaption', 'PageBreak', 'UncategorizedText'), i % 10 + 1)"
    points = "array(array(cast(i as double), 1d), array(cast(i % 3 as double), 2d))"
    item = f"named_struct('type', {label}, 'text', x, 'metadata', named_struct('page_number', i div 20, 'coordinates', if(i % 4 = 0, named_struct('points', {points}), null)))"
    docs = S.table(spark, sf, "documents").selectExpr(f"to_json(named_struct('doc_id', doc_id, 'elements', transform(split(text, '\n'), (x, i) -> {item}))) as line")
    path = shared.folder(spark)
    # the source takes files of this ending; what Spark calls its files is not ours to choose
    docs.write.text(f"{path}/lines.jsonl")
    return extractors.read(spark, path, "unstructured").select("doc_id", "pos", "page_number", "physical_page_index", "kind", F.sha2("text", 256).alias("text_sha256"), F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"))


SQL["layout_elements"] = """with l as (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents),
e as (select doc_id, i, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as text, ['title', 'page_header', 'narrative', 'list_item', 'table', 'figure', 'page_footer', 'narrative', 'other', 'other'][i % 10 + 1] as kind from l)
select doc_id, (row_number() over (partition by doc_id order by i) - 1)::int as pos, (i // 20)::int as page_number, greatest(i // 20 - 1, 0)::int as physical_page_index, kind, sha256(text) as text_sha256,
  case when i % 4 = 0 then least(i, i % 3)::double end as x0, case when i % 4 = 0 then greatest(i, i % 3)::double end as x1
from e where text <> '' or kind in ('table', 'figure')"""


def _contract(spark: SparkSession, sf: str) -> DataFrame:
    """(bundle_id, json) by the delivery contract, with wrong types, references and circles by number."""
    o, li, c = S.table(spark, sf, "orders"), S.table(spark, sf, "lineitem"), S.table(spark, sf, "customer")
    q = lambda x: f"concat('\"', {x}, '\"')"
    chunk = f"""concat('{{"ordinal": ', l_linenumber % 6, ', "text": ', if(l_quantity > 2, {q('l_returnflag')}, if(l_quantity = 2, '" "', '7')), ', "char_count": ', if(l_orderkey % 13 = 0, 'null', '1'), ', "page_start": 1, "page_end": ', if(l_orderkey % 17 = 0, 'true', '1'), ', "has_table": ', if(l_orderkey % 19 = 0, '"no"', 'false'), ', "has_image_ref": true}}')"""
    chunks = li.groupBy("l_orderkey").agg(F.expr(f"array_join(transform(array_sort(collect_list(named_struct('n', l_linenumber, 'j', {chunk}))), x -> x.j), ',')").alias("chunks"))
    parent = "case when o_custkey % 50 = 7 then cast(lead(o_orderkey, 1, first(o_orderkey) over (partition by o_custkey order by o_orderkey)) over (partition by o_custkey order by o_orderkey) as string) when o_orderkey % 4 <> 0 then cast(o_orderkey - o_orderkey % 4 as string) end"
    # JSON packs well, so that tables too large for memory look small enough to be broadcast: these are merged
    o = o.withColumn("parent", F.expr(parent)).join(chunks.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    node = f"""concat('{{"ref": ', {q('o_orderkey')}, ', "parent_ref": ', coalesce({q('parent')}, 'null'), ', "level": ', case o_orderkey % 7 when 0 then '-1' when 1 then '"1"' when 2 then '1.0' when 3 then 'true' else '2' end, ', "level_label": ', case o_orderkey % 9 when 0 then '""' when 1 then '5' else '"Capítulo"' end, if(o_orderkey % 11 = 0, '', ', "ordinal": ""'), ', "title": ', {q('o_orderpriority')}, ', "breadcrumb": "", "page_start": 1, "is_anexo": ', if(o_orderkey % 23 = 0, 'null', 'false'), ', "metadata": ', if(o_orderkey % 29 = 0, '[]', '{{}}'), ', "chunks": [', coalesce(chunks, ''), ']}}')"""
    run = f"""concat('{{"ref": ', {q('o_orderkey % 50')}, ', "model": "m", "profile_used": "manual", "mode": ', case o_orderstatus when 'F' then '"batch"' when 'O' then '"immediate"' else '"other"' end, ', "status": ', if(o_orderkey % 5 = 0, '"running"', '"succeeded"'), ', "started_at": ', if(o_orderkey % 31 = 0, '"2024-01-01 00:00:00"', '"2024-01-01T00:00:00Z"'), ', "completed_at": null, "nodes_total": 1, "nodes_completed": 1, "nodes_failed": ', o_orderkey % 6 - 1, ', "cost_input_tokens": 98765432109876543210, "cost_output_tokens": 0, "cost_cached_tokens": ', if(o_orderkey % 37 = 0, '1.5', '0'), ', "cost_estimate_usd": ', if(o_orderkey % 41 = 0, '"1"', '0.5'), '}}')"""
    parts = o.groupBy("o_custkey").agg(*(F.expr(f"array_join(transform(array_sort(collect_list(named_struct('k', o_orderkey, 'j', {x}))), x -> x.j), ',')").alias(k) for k, x in (("nodes", node), ("runs", run))))
    rows = c.join(parts.hint("merge"), F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("k", F.col("c_custkey"))
    text = f"""concat('{{"bundle_version": ', if(k % 30 = 0, '"1"', '1'), ', "generated_at": ', if(k % 25 = 0, '5', '"2024-01-01T00:00:00Z"'), ', "generator": ', case k % 28 when 0 then 'null' when 1 then '{{"tool": 1, "version": "1"}}' else '{{"tool": "t", "version": "1"}}' end,
      ', "manual": {{"code": ', {q('c_name')}, ', "title": ', case k % 15 when 0 then '" "' when 1 then 'false' else {q('c_mktsegment')} end, ', "source_path": "a.pdf", "extractor_used": "docling", "page_count": ', case k % 12 when 0 then '"3"' when 1 then '-3' else '3' end, ', "ingested_at": ', if(k % 22 = 0, 'null', '"2024-01-01T00:00:00Z"'), '}}, "catalog_hint": ', case k % 26 when 0 then '[]' when 1 then '{{"grado_code": 1}}' else 'null' end,
      ', "nodes": ', if(k % 35 = 0, '{{}}', concat('[', coalesce(nodes, ''), ']')), ', "runs": [', coalesce(runs, ''), '], "questions": []}}')"""
    return rows.select(F.col("c_custkey").cast("string").alias("bundle_id"), F.expr(text).alias("json"))


def contract_errors(spark: SparkSession, sf: str) -> DataFrame:
    found = contract_checks.errors(_contract(spark, sf))
    return found.groupBy("bundle_id", F.regexp_replace("path", r"\d+", "#").alias("place"), "rule").agg(F.count("*").alias("n"))


SQL["contract_errors"] = """with h as (
  select c_custkey as k, '$.bundle_version' as place, 'version' as rule from customer where c_custkey % 30 = 0
  union all select x.* from (
    select c_custkey as k, '$.generated_at' as place, 'stamp' as rule from customer where c_custkey % 25 = 0
    union all select c_custkey, '$.generator', 'object' from customer where c_custkey % 28 = 0 union all select c_custkey, '$.generator.tool', 'type' from customer where c_custkey % 28 = 1
    union all select c_custkey, '$.manual.title', case c_custkey % 15 when 0 then 'blank' else 'type' end from customer where c_custkey % 15 < 2
    union all select c_custkey, '$.manual.page_count', case c_custkey % 12 when 0 then 'type' else 'range' end from customer where c_custkey % 12 < 2
    union all select c_custkey, '$.manual.ingested_at', 'missing' from customer where c_custkey % 22 = 0
    union all select c_custkey, '$.catalog_hint', 'object' from customer where c_custkey % 26 = 0 union all select c_custkey, '$.catalog_hint.grado_code', 'type' from customer where c_custkey % 26 = 1
    union all select c_custkey, '$.nodes', 'list' from customer where c_custkey % 35 = 0) x where k % 30 <> 0),
o as (select *, o_custkey as k, case when o_custkey % 50 = 7 then null when o_orderkey % 4 <> 0 then o_orderkey - o_orderkey % 4 end as parent from orders where o_custkey not in (select k from h)),
c as (select o.k, lineitem.* from lineitem join o on o_orderkey = l_orderkey),
e as (
  select * from h
  union all select k, '$.nodes[#].level', case o_orderkey % 7 when 0 then 'range' else 'type' end from o where o_orderkey % 7 < 4
  union all select k, '$.nodes[#].level_label', case o_orderkey % 9 when 0 then 'blank' else 'type' end from o where o_orderkey % 9 < 2
  union all select k, '$.nodes[#].ordinal', 'missing' from o where o_orderkey % 11 = 0
  union all select k, '$.nodes[#].is_anexo', 'type' from o where o_orderkey % 23 = 0 union all select k, '$.nodes[#].metadata', 'object' from o where o_orderkey % 29 = 0
  union all select k, '$.nodes[#].chunks[#].text', case when l_quantity = 2 then 'blank' else 'type' end from c where l_quantity <= 2
  union all select k, '$.nodes[#].chunks[#].char_count', 'missing' from c where l_orderkey % 13 = 0 union all select k, '$.nodes[#].chunks[#].page_end', 'type' from c where l_orderkey % 17 = 0
  union all select k, '$.nodes[#].chunks[#].has_table', 'type' from c where l_orderkey % 19 = 0
  union all select k, '$.nodes[#].chunks[#].ordinal', 'unique' from c qualify row_number() over (partition by k, l_orderkey, l_linenumber % 6 order by l_linenumber) > 1
  union all select k, '$.nodes[#].parent_ref', 'reference' from o where parent is not null and not exists (select 1 from o p where p.k = o.k and p.o_orderkey = o.parent)
  union all select k, '$.nodes', 'root' from o group by k having count(*) filter (parent is null and k % 50 <> 7) = 0
  union all select distinct k, '$.nodes', 'cycle' from o where k % 50 = 7
  union all select k, '$.runs[#].mode', 'enum' from o where o_orderstatus not in ('F', 'O') union all select k, '$.runs[#].status', 'running' from o where o_orderkey % 5 = 0
  union all select k, '$.runs[#].started_at', 'stamp' from o where o_orderkey % 31 = 0 union all select k, '$.runs[#].nodes_failed', 'range' from o where o_orderkey % 6 = 0
  union all select k, '$.runs[#].cost_cached_tokens', 'type' from o where o_orderkey % 37 = 0 union all select k, '$.runs[#].cost_estimate_usd', 'number' from o where o_orderkey % 41 = 0
  union all select k, '$.runs[#].ref', 'unique' from o qualify row_number() over (partition by k, o_orderkey % 50 order by o_orderkey) > 1
) select k::varchar as bundle_id, place, rule, count(*) as n from e group by all"""


def _store_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    """Customers as documents, orders as sections and runs, lines as chunks and options, for contract.build."""
    o, li, c = S.table(spark, sf, "orders"), S.table(spark, sf, "lineitem"), S.table(spark, sf, "customer")
    docs = c.selectExpr("c_custkey as doc_id", "if(c_custkey % 7 = 0, 'cjm ', 'M ') || c_custkey as code", "cast(null as string) as edition", "c_name as title", "c_mktsegment as branch", "'a.pdf' as source_path", "c_nationkey as page_count", "'text' as extractor", "timestamp'2024-01-02 03:04:05' as ingested_at", "timestamp'2024-02-03 04:05:06' as generated_at", "if(c_custkey % 3 = 0, concat('{\"nation\": ', c_nationkey, '}'), null) as metadata_json")
    nodes = o.selectExpr("o_orderkey as node_id", "o_custkey as doc_id", "lpad(o_orderkey, 12, '0') as sort_key", "if(o_orderkey % 4 <> 0, o_orderkey - 1, null) as parent_id", "1 as level", "'Capítulo' as level_label", "'I' as ordinal", "o_orderpriority as title", "o_orderstatus as breadcrumb", "1 as page_start", "cast(null as int) as page_end", "o_orderkey % 5 = 0 as is_anexo")
    chunks = li.selectExpr("l_orderkey as node_id", "l_linenumber as ordinal", "l_returnflag || '\"' || l_linestatus as text", "3 as char_count", "1 as page_start", "2 as page_end", "l_linenumber = 2 as has_table", "false as has_image_ref")
    runs = o.filter("o_orderstatus = 'F'").selectExpr("o_orderkey as run_id", "o_custkey as doc_id", "concat('m', o_orderkey) as model", "'batch' as mode", "'succeeded' as status", "o_orderdate as started_at", "cast(null as timestamp) as completed_at", "1 as nodes_total", "1 as nodes_completed", "0 as nodes_failed", "0.5d as cost_estimate_usd")
    questions = o.filter("o_orderstatus = 'F'").selectExpr("o_orderkey as question_id", "o_orderkey as run_id", "o_orderkey as node_id", "o_custkey as doc_id", "0 as generation_order", "o_orderpriority as question_text", "'j' as justification", "'valid' as status", "o_orderdate as created_at")
    options = li.filter("l_linenumber <= 4").selectExpr("l_orderkey as question_id", "l_linenumber as order_in_question", "element_at(array('correct', 'confusa', 'distractor', 'distractor'), l_linenumber) as role", "concat('o', l_linenumber) as text", "l_linenumber = 1 as is_correct")
    return docs, nodes, chunks, runs, questions, options


def contract_json(spark: SparkSession, sf: str) -> DataFrame:
    built = contract.build(*_store_tables(spark, sf))
    return built.select("bundle_id", "code", F.sha2("json", 256).alias("sha256"), F.length("json").alias("n_chars"))


SQL["contract_json"] = r"""with q(x) as (select '"'), iso as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as stamp, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') as flat from orders),
c as (select l_orderkey, string_agg('{"ordinal":' || l_linenumber || ',"text":"' || l_returnflag || '\"' || l_linestatus || '","char_count":3,"page_start":1,"page_end":2,"has_table":' || (l_linenumber = 2) || ',"has_image_ref":false,"metadata":{}}', ',' order by l_linenumber, l_returnflag, l_linestatus) as j,
  string_agg('{"role":"' || ['correct', 'confusa', 'distractor', 'distractor'][l_linenumber] || '","order_in_question":' || l_linenumber || ',"text":"o' || l_linenumber || '","is_correct":' || (l_linenumber = 1) || ',"metadata":{}}', ',' order by l_linenumber) filter (l_linenumber <= 4) as o from lineitem group by 1),
n as (select o_custkey, string_agg('{"ref":"' || lpad(o_orderkey::varchar, 12, '0') || '","parent_ref":' || coalesce('"' || lpad(p.k::varchar, 12, '0') || '"', 'null') || ',"level":1,"level_label":"Capítulo","ordinal":"I","title":"' || o_orderpriority || '","breadcrumb":"' || o_orderstatus || '","page_start":1,"page_end":null,"is_anexo":' || (o_orderkey % 5 = 0) || ',"metadata":{},"chunks":[' || coalesce(c.j, '') || ']}', ',' order by o_orderkey) as j
  from orders left join c on l_orderkey = o_orderkey left join (select o_orderkey as k from orders) p on o_orderkey % 4 <> 0 and p.k = o_orderkey - 1 group by 1),
r as (select o_custkey, string_agg('{"ref":"m' || o_orderkey || '--batch--' || flat || '","model":"m' || o_orderkey || '","mode":"batch","status":"succeeded","profile_used":"manual","rules_snapshot":{},"started_at":"' || stamp || '","completed_at":null,"nodes_total":1,"nodes_completed":1,"nodes_failed":0,"cost_input_tokens":0,"cost_output_tokens":0,"cost_cached_tokens":0,"cost_estimate_usd":0.5,"metadata":{}}', ',' order by o_orderkey) as j,
  string_agg('{"run_ref":"m' || o_orderkey || '--batch--' || flat || '","node_ref":"' || lpad(o_orderkey::varchar, 12, '0') || '","generation_order":0,"question_text":"' || o_orderpriority || '","justification":"j","validation_status":"valid","validated_at":null,"created_at":"' || stamp || '","metadata":{},"options":[' || coalesce(c.o, '') || ']}', ',' order by o_orderkey) as q
  from orders join iso using (o_orderkey) left join c on l_orderkey = o_orderkey where o_orderstatus = 'F' group by 1),
b as (select c_custkey::varchar as bundle_id, case when c_custkey % 7 = 0 then 'cjm ' else 'M ' end || c_custkey as code, '{"bundle_version":1,"generated_at":"2024-02-03T04:05:06Z","generator":{"tool":"folium","version":"1","pipeline_commit":null},"manual":{"code":"' || case when c_custkey % 7 = 0 then 'cjm ' else 'M ' end || c_custkey || '","edition":null,"title":"' || c_name || '","branch":"' || c_mktsegment || '","source_path":"a.pdf","source_sha256":null,"page_count":' || c_nationkey || ',"extractor_used":"text","ingested_at":"2024-01-02T03:04:05Z","metadata":' || case when c_custkey % 3 = 0 then '{"nation":' || c_nationkey || '}' else '{}' end || '},"catalog_hint":{"grado_code":"SARG_2","materia_code":"' || case when c_custkey % 7 = 0 then 'JUS_MIL' else 'OPS_MIL' end || '"},"nodes":[' || coalesce(n.j, '') || '],"runs":[' || coalesce(r.j, '') || '],"questions":[' || coalesce(r.q, '') || ']}' as j
  from customer left join n on n.o_custkey = c_custkey left join r on r.o_custkey = c_custkey)
select bundle_id, code, sha256(j) as sha256, length(j)::int as n_chars from b"""


def bundle_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles of customers written as files twice, the second time some of them, and what lies there then."""
    rows = S.table(spark, sf, "customer").selectExpr("c_mktsegment || ' ' || c_nationkey as code", "timestamp'2024-05-06 00:00:00' as generated_at", "to_json(struct(c_custkey, c_name)) as json", "c_custkey % 2 as part")
    path = shared.folder(spark)
    none = spark.createDataFrame([], "name string")
    bundle_files.write(bundle_files.versioned(rows.filter("part = 0"), none), path)
    bundle_files.write(bundle_files.versioned(rows.filter("part = 1").withColumn("generated_at", F.expr("generated_at + interval 1 day")), bundle_files.names(spark, path)), path)
    return bundle_files.read(spark, path).select("name", "state", F.get_json_object("json", "$.c_name").alias("c_name"))


SQL["bundle_file_names"] = """with r as (select c_custkey % 2 as part, c_name, regexp_replace(lower(c_mktsegment || ' ' || c_nationkey), '[^a-z0-9._-]+', '-', 'g') as slug, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' as j from customer),
n as (select *, row_number() over (partition by slug, part order by j) + case when part = 1 then count(*) filter (part = 0) over (partition by slug) else 0 end as v from r)
select slug || '--' || case part when 0 then '20240506' else '20240507' end || '--v' || v || '.json' as name, 'ok' as state, c_name from n"""

QUERIES = [bundle_header_errors, orphan_parent, run_checks, role_counts, secret_scan_flat, secret_scan, bundle_warnings, bundle_counts, bundle_json, merge_rules, model_instructions, html_elements, vendor_labels, layout_elements, contract_errors, contract_json, bundle_file_names]
