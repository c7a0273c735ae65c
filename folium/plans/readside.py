"""Registered queries on the read side, on generation runs and on cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import cost
from folium.operators import explore, generation, lookup
from folium.plans import standins as S
from folium.plans import structure

SQL: dict[str, str] = {}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "documents").select("doc_id")


def global_kpis(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("ingested_at"))
    return explore.global_kpis(docs, S.nodes(spark, sf), S.chunks(spark, sf))


SQL["global_kpis"] = f"with {S.STORE} select (select count(*) from events) as n_documents, (select count(*) from nodes) as n_nodes, (select count(*) from chunks) as n_chunks, (select max(ts) from events) as last_ingested"


def counts_default_zero(spark: SparkSession, sf: str) -> DataFrame:
    return explore.counts_per_document(_docs(spark, sf), S.nodes(spark, sf), S.chunks(spark, sf))


SQL["counts_default_zero"] = f"""with {S.STORE} select d.doc_id, coalesce(n.c, 0) as n_nodes, coalesce(k.c, 0) as n_chunks from documents d
left join (select doc_id, count(*) as c from nodes group by 1) n using (doc_id) left join (select doc_id, count(*) as c from chunks group by 1) k using (doc_id)"""


def chunks_per_node(spark: SparkSession, sf: str) -> DataFrame:
    return explore.counts_per_node(S.nodes(spark, sf), S.chunks(spark, sf))


SQL["chunks_per_node"] = f"with {S.STORE} select n.doc_id, n.node_id, sort_key, count(c.node_id) as n_chunks from nodes n left join chunks c using (node_id) group by all"


def questions_per_run(spark: SparkSession, sf: str) -> DataFrame:
    return explore.questions_per_run(S.runs(spark, sf), S.questions(spark, sf))


SQL["questions_per_run"] = f"with {S.STORE}, {S.RUNS} select r.run_id, model, mode, r.status, count(q.run_id) as n_questions from runs r left join questions q using (run_id) group by all"


def question_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return explore.question_kpis(S.chunks(spark, sf), S.questions(spark, sf), S.runs(spark, sf).filter("status != 'running'"))


SQL["question_kpis"] = f"""with {S.STORE}, {S.RUNS},
q as (select count(*) as n_questions, count(*) filter (status = 'pending') as pending, count(*) filter (status = 'valid') as valid, count(*) filter (status = 'needs_review') as needs_review,
  count(*) filter (status = 'rejected') as rejected, count(*) filter (status in ('pending', 'valid')) as served, count(distinct node_id) as nodes_with_question from questions),
t as (select count(distinct node_id) as nodes_with_text from chunks), c as (select coalesce(sum(cost_estimate_usd), 0) as cost_usd from runs where status <> 'running')
select *, case when nodes_with_text > 0 then 100.0::double * nodes_with_question / nodes_with_text else 0 end as coverage_pct from q, t, c"""


def coverage_table(spark: SparkSession, sf: str) -> DataFrame:
    return explore.coverage(_docs(spark, sf), S.chunks(spark, sf), S.questions(spark, sf), S.runs(spark, sf))


SQL["coverage_table"] = f"""with {S.STORE}, {S.RUNS}
select d.doc_id, coalesce(c.n, 0) as nodes_with_chunks, coalesce(q.n, 0) as nodes_questioned, coalesce(q.v, 0) as validated, coalesce(r.n, 0) as n_runs,
  case when coalesce(c.n, 0) > 0 then 100.0::double * coalesce(q.n, 0) / c.n else 0 end as coverage_pct
from documents d left join (select doc_id, count(distinct node_id) as n from chunks group by 1) c using (doc_id)
left join (select doc_id, count(distinct node_id) as n, count(*) filter (status = 'valid') as v from questions group by 1) q using (doc_id)
left join (select doc_id, count(*) as n from runs group by 1) r using (doc_id)"""


def status_by_node(spark: SparkSession, sf: str) -> DataFrame:
    return explore.status_by_node(S.questions(spark, sf)).select("node_id", F.array_join("statuses", ",").alias("statuses"))


SQL["status_by_node"] = f"with {S.STORE} select node_id, string_agg(status, ',' order by status) as statuses from questions group by node_id"


def tree_badges(spark: SparkSession, sf: str) -> DataFrame:
    return explore.tree_badges(S.nodes(spark, sf), S.questions(spark, sf))


SQL["tree_badges"] = f"""with {S.STORE} select n.doc_id, n.node_id, case when q.n is null then '⚠ sin pregunta' else '❓' || s || '/' || q.n end as badge from nodes n
left join (select node_id, count(*) filter (status in ('pending', 'valid')) as s, count(*) as n from questions group by 1) q using (node_id)"""


def siblings(spark: SparkSession, sf: str) -> DataFrame:
    return explore.siblings(S.nodes(spark, sf))


SQL["siblings"] = f"with {S.CLASSIFIED} select a.doc_id, a.local_id, b.local_id as sibling from parents a join parents b on a.doc_id = b.doc_id and a.parent_pos is not distinct from b.parent_pos and a.local_id <> b.local_id"


def children(spark: SparkSession, sf: str) -> DataFrame:
    return explore.children(S.nodes(spark, sf)).select("doc_id", "local_id", F.array_join("children", "|").alias("children"))


SQL["children"] = f"with {S.CLASSIFIED} select a.doc_id, a.local_id, coalesce(string_agg(b.sort_key, '|' order by b.sort_key), '') as children from parents a left join parents b on a.doc_id = b.doc_id and b.parent_pos = a.pos group by a.doc_id, a.local_id"


def ancestors(spark: SparkSession, sf: str) -> DataFrame:
    return explore.ancestors(S.nodes(spark, sf))


SQL["ancestors"] = f"""with recursive {S.CLASSIFIED},
up as (select doc_id, local_id, parent_pos as pos from parents where parent_pos is not null
  union all select u.doc_id, u.local_id, p.parent_pos from up u join parents p on p.doc_id = u.doc_id and p.pos = u.pos where p.parent_pos is not null)
select u.doc_id, u.local_id, row_number() over (partition by u.doc_id, u.local_id order by u.pos) - 1 as depth, p.local_id as ancestor from up u join parents p on p.doc_id = u.doc_id and p.pos = u.pos"""


def display_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The word that hides sections is one that the prose has."""
    return explore.display_tree(S.nodes(spark, sf), "guerra").select("doc_id", "local_id", "title")


SQL["display_tree"] = f"""with recursive {S.CLASSIFIED},
ok as (select doc_id, pos, local_id, parent_pos, title from parents where title <> '' and not contains(lower(title), 'guerra')),
down as (select doc_id, pos, local_id, title from ok where parent_pos is null union all select o.doc_id, o.pos, o.local_id, o.title from ok o join down d on d.doc_id = o.doc_id and d.pos = o.parent_pos)
select doc_id, local_id, title from down"""


def select_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return generation.select_nodes(S.nodes(spark, sf), S.chunks(spark, sf), S.questions(spark, sf)).select("doc_id", "node_id", "sort_key")


SQL["select_nodes"] = f"""with {S.STORE} select doc_id, node_id, sort_key from nodes where node_id in (select node_id from chunks) and node_id not in (select node_id from questions) and title not ilike '%introducci%'"""


def missing_questions(spark: SparkSession, sf: str) -> DataFrame:
    return explore.missing_questions(S.nodes(spark, sf), S.chunks(spark, sf), S.questions(spark, sf)).groupBy("doc_id").agg(F.count("*").alias("n"))


SQL["missing_questions"] = f"with {S.STORE} select doc_id, count(*) as n from nodes n where exists (select 1 from chunks c where c.node_id = n.node_id) and not exists (select 1 from questions q where q.node_id = n.node_id) group by doc_id"


def list_questions(spark: SparkSession, sf: str) -> DataFrame:
    return explore.list_questions(S.questions(spark, sf), S.nodes(spark, sf), statuses=("pending", "valid"), text="TION").select("question_id", "node_id", "sort_key", "title", "status", "question_text")


SQL["list_questions"] = f"""with {S.STORE} select question_id, q.node_id, sort_key, title, status, question_text from questions q join nodes n using (node_id)
where status in ('pending', 'valid') and (question_text ilike '%tion%' or justification ilike '%tion%') order by sort_key, generation_order, question_id limit 500"""


def paginate_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return explore.page(S.chunks(spark, sf), ["node_id", "ordinal"], 1000, 200).select("node_id", "ordinal", "text")


SQL["paginate_chunks"] = f"with {S.STORE} select node_id, ordinal, text from chunks order by node_id, ordinal limit 1000 offset 200"


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    return explore.recent_runs(S.runs(spark, sf)).select("run_id", "model", "mode", "status")


SQL["recent_runs"] = f"with {S.RUNS} select run_id, model, mode, status from runs order by run_id desc limit 10"


def open_batches(spark: SparkSession, sf: str) -> DataFrame:
    return explore.open_batches(S.runs(spark, sf)).select("run_id", "model")


SQL["open_batches"] = f"with {S.RUNS} select run_id, model from runs where mode = 'batch' and status = 'running'"


def question_options(spark: SparkSession, sf: str) -> DataFrame:
    turns = S.table(spark, sf, "conversations")
    options = turns.select(F.col("conv_id").alias("question_id"), F.col("turn").alias("order_in_question"), "role", "text")
    out = explore.options_of(turns.select((F.col("conv_id") + F.col("turn") % 2 * 1000000).alias("question_id")).distinct(), options)
    return out.select("question_id", F.array_join("options", "|").alias("options"))


SQL["question_options"] = """select q.question_id, coalesce(string_agg(role || ': ' || text, '|' order by turn, role, text), '') as options
from (select distinct conv_id + turn % 2 * 1000000 as question_id from conversations) q left join conversations c on c.conv_id = q.question_id group by q.question_id"""


def latest_status(spark: SparkSession, sf: str) -> DataFrame:
    return explore.latest_status(S.table(spark, sf, "events"), "user_id", "event_type", "ts", "event_id")


SQL["latest_status"] = "select user_id, event_type, ts, event_id from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


def literal_citation(spark: SparkSession, sf: str) -> DataFrame:
    """A piece of each document, or of its neighbour, is held against its text."""
    docs = S.table(spark, sf, "documents")
    texts = docs.select(F.col("doc_id").alias("node_id"), "text")
    q = docs.select((F.col("doc_id") + F.col("doc_id") % 2).alias("node_id"), F.col("doc_id").alias("question_id"), F.when(F.col("doc_id") % 5 != 0, F.regexp_replace(F.substring("text", 3, 25), " ", "  \t")).alias("correct"))
    return generation.citation_status(q, texts)


SQL["literal_citation"] = """with q as (select doc_id + doc_id % 2 as node_id, doc_id as question_id, case when doc_id % 5 <> 0 then replace(substr(text, 3, 25), ' ', '  ' || chr(9)) end as correct from documents)
select question_id, case when correct is not null and not contains(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), trim(regexp_replace(correct, '\\s+', ' ', 'g'))) then 'needs_review' else 'pending' end as status
from q left join documents d on d.doc_id = q.node_id"""


def strip_inline_options(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "documents").select("doc_id", F.concat("text", F.when(F.col("doc_id") % 2 == 0, " a) uno B. dos").otherwise(" fin")).alias("question_text"))
    return generation.strip_options(docs)


SQL["strip_inline_options"] = "select doc_id, trim(string_split_regex(text || case when doc_id % 2 = 0 then ' a) uno B. dos' else ' fin' end, '(?i)\\b[A-D][.)]\\s')[1], ' ' || chr(10)) as question_text from documents"


def question_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as drafts: turns are options, roles follow their order."""
    role = F.element_at(F.array(*map(F.lit, ("correct", "confusa", "distractor", "distractor"))), (F.col("turn") % 4 + 1).cast("int"))
    turns = S.table(spark, sf, "conversations").select("conv_id", F.struct("turn", role.alias("role"), F.col("text").alias("text")).alias("o"))
    drafts = turns.groupBy(F.col("conv_id").alias("question_id")).agg(F.array_sort(F.collect_list("o")).alias("options"))
    drafts = drafts.withColumns({"question_text": F.col("options")[0]["text"], "justification": F.col("options")[0]["role"]})
    return generation.shape_errors(drafts)


SQL["question_shape"] = """with t as (select conv_id, turn, ['correct', 'confusa', 'distractor', 'distractor'][turn % 4 + 1] as role, text from conversations),
d as (select conv_id as question_id, arg_min(text, turn) as q, list(role) as roles, list(trim(lower(text), ' ' || chr(10))) as texts, max(length(text)) as most, min(length(text)) as least from t group by conv_id),
r as (select question_id, length(q) not between 1 and 1000 as question_length, least < 1 or most > 500 as option_length, len(roles) <> 4 as four_options,
  len(list_filter(roles, lambda x: x = 'correct')) <> 1 or len(list_filter(roles, lambda x: x = 'confusa')) <> 1 or len(list_filter(roles, lambda x: x = 'distractor')) <> 2 as roles,
  len(list_distinct(texts)) < len(texts) as repeated_options from d)
select question_id, rule from (unpivot r on question_length, option_length, four_options, roles, repeated_options into name rule value broken) where broken"""


def reconcile_batch(spark: SparkSession, sf: str) -> DataFrame:
    e = S.table(spark, sf, "events")
    responses = e.select(F.col("user_id").alias("batch"), F.col("event_id").alias("n"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("own-"), F.col("event_id").cast("string"))).alias("key"))
    requests = e.select(F.col("user_id").alias("batch"), F.col("event_id").alias("n"), F.concat(F.lit("request-"), F.col("event_id").cast("string")).alias("key"))
    return generation.reconcile(responses, requests)


SQL["reconcile_batch"] = """with r as (select user_id as batch, event_id as n, case when event_id % 3 = 0 then 'own-' || event_id end as key from events),
p as (select *, case when key is null then sum(case when key is null then 1 else 0 end) over (partition by batch order by n) end as place from r),
q as (select user_id as batch, 'request-' || event_id as by_place, row_number() over (partition by user_id order by event_id) as place from events)
select p.batch, p.n, coalesce(key, by_place) as key from p left join q on q.batch = p.batch and q.place = p.place"""


def batch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    e = S.table(spark, sf, "events")
    items = e.select(F.col("user_id").alias("batch"), F.col("event_id").alias("n"), F.when(F.col("event_id") % 11 == 0, "x").alias("error"), F.when(F.col("event_id") % 7 != 0, F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.col("props"))).alias("response"), (F.col("value") > 1).alias("valid"), F.when(F.col("event_id") % 4 == 0, "no number").otherwise((F.col("event_id") % 1000).cast("string")).alias("usage"))
    return generation.batch_outcomes(items)


SQL["batch_outcomes"] = """with o as (select user_id as batch, event_id as n, case when event_id % 11 = 0 then 'error' when event_id % 7 = 0 then 'no_response' when event_id % 5 = 0 or trim(props) = '' then 'empty' when props is null then 'no_response' when not coalesce(value > 1, false) then 'invalid' else 'ok' end as outcome,
  case when event_id % 4 = 0 then 0 else event_id % 1000 end as usage from events)
select batch, n, outcome, case when outcome in ('error', 'no_response') then 0 else usage end::int as tokens from o"""


def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    li = S.table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("run_id"), (F.col("l_returnflag") != "R").alias("ok"), F.col("l_partkey").alias("input_tokens"), F.col("l_suppkey").alias("output_tokens"), F.col("l_linenumber").cast("long").alias("cached_tokens"))
    return generation.run_totals(rows)


SQL["run_totals"] = """select l_orderkey as run_id, count(*) filter (l_returnflag <> 'R') as completed, count(*) filter (l_returnflag = 'R') as failed, sum(l_partkey)::bigint as input_tokens, sum(l_suppkey)::bigint as output_tokens,
sum(l_linenumber)::bigint as cached_tokens, case when count(*) filter (l_returnflag = 'R') = 0 then 'succeeded' else 'partial' end as status from lineitem group by l_orderkey"""


def _usage(spark: SparkSession, sf: str) -> DataFrame:
    li = S.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.sum("l_partkey").alias("input_tokens"), F.sum("l_suppkey").alias("output_tokens"), F.sum("l_linenumber").alias("cached_tokens"), F.sum("l_quantity").alias("token_hours"))
    return S.runs(spark, sf).select("run_id", "model", "mode").join(li, "run_id")


def cost_actual(spark: SparkSession, sf: str) -> DataFrame:
    return cost.actual(_usage(spark, sf), 10).select("run_id", "model", "mode", "cost_usd")


_PRICES = "p(model, i, c, o, s) as (values ('gemini-2.5-flash', 0.30::double, 0.03::double, 2.50::double, 1.00::double), ('gemini-2.5-pro', 1.25::double, 0.125::double, 10.00::double, 4.50::double))"
SQL["cost_actual"] = f"""with {S.RUNS}, {_PRICES},
u as (select l_orderkey as run_id, sum(l_partkey) as a, sum(l_suppkey) as b, sum(l_linenumber) as k, sum(l_quantity) as h from lineitem group by 1)
select run_id, r.model, mode, coalesce(round(greatest(a - k, 0) * i * (case when mode = 'batch' then 0.5::double else 1 end) / 1e6::double + k * c / 1e6::double + b * o * (case when mode = 'batch' then 0.5::double else 1 end) / 1e6::double + h * s / 1e6::double, 10), 0) as cost_usd
from runs r join u using (run_id) left join p on p.model = r.model"""


def cost_estimate(spark: SparkSession, sf: str) -> DataFrame:
    runs = _usage(spark, sf).filter("model != 'unknown-model'").select("run_id", "model", "mode", F.col("output_tokens").alias("n_questions"), F.col("input_tokens").alias("doc_tokens"))
    out = cost.planned(runs, rounded=False)
    return out.select(*runs.columns, *(F.round(c, 9).alias(c) for c in ("create_usd", "storage_usd", "question_usd", "total_usd")))


SQL["cost_estimate"] = f"""with {S.RUNS}, {_PRICES},
u as (select l_orderkey as run_id, sum(l_partkey)::bigint as doc_tokens, sum(l_suppkey)::bigint as n_questions from lineitem group by 1),
e as (select run_id, r.model, mode, n_questions, doc_tokens, doc_tokens * i / 1e6::double as a, doc_tokens * s * 1.0::double / 1e6::double as b,
  doc_tokens * c / 1e6::double + 1100 * i * (case when mode = 'batch' then 0.5::double else 1 end) / 1e6::double + 600 * o * (case when mode = 'batch' then 0.5::double else 1 end) / 1e6::double as q
  from runs r join u using (run_id) join p on p.model = r.model)
select run_id, model, mode, n_questions, doc_tokens, round(a, 9) as create_usd, round(b, 9) as storage_usd, round(q, 9) as question_usd, round(a + b + q * n_questions, 9) as total_usd from e"""


def cost_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.chunks(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(F.length("text")).alias("chars"))
    return cost.scenarios(docs, digits=10)


SQL["cost_scenarios"] = f"""with {S.STORE},
d as (select doc_id, count(*) as n, floor(sum(length(text)) / 4.0)::bigint as t from chunks group by doc_id),
s as (select doc_id, n as n_chunks, t as tokens, round(t * (0.30::double + 1.00::double) / 1e6::double + n * (t * 0.03::double + 1100 * 0.30::double + 600 * 2.50::double) / 1e6::double, 10) as immediate_usd,
  round(n * ((t + 1100) * 0.30::double + 600 * 2.50::double) / 1e6::double, 10) as no_cache_usd,
  round(t * (0.30::double + 1.00::double) / 1e6::double + n * (t * 0.03::double + 0.5::double * (1100 * 0.30::double + 600 * 2.50::double)) / 1e6::double, 10) as batch_usd from d)
select *, case when no_cache_usd > 0 then round(100 * (1 - batch_usd / no_cache_usd), 4) else 0 end as savings_pct from s"""


def generation_stub(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of all sections through the client that needs no network."""
    asked = generation.prompts(S.nodes(spark, sf), S.chunks(spark, sf)).select(F.col("node_id").alias("key"), "prompt")
    return generation.generate(asked)


def _paged(spark: SparkSession, sf: str) -> DataFrame:
    """Sections that end as many pages on as they are deep."""
    return S.nodes(spark, sf).withColumn("page_end", F.col("page_start") + F.col("level"))


_PAGES = "case when level = 0 then 'p. ' || page_number else 'pp. ' || page_number || '-' || (page_number + level) end"
_TRAILS = f"trails as ({structure.SQL['breadcrumbs']})"


def tree_labels(spark: SparkSession, sf: str) -> DataFrame:
    nodes = lookup.with_counts(S.nodes(spark, sf), S.chunks(spark, sf)).join(explore.tree_badges(S.nodes(spark, sf), S.questions(spark, sf)).drop("doc_id"), "node_id")
    return nodes.select("doc_id", "node_id", lookup.label(F.col("badge")).alias("label"))


SQL["tree_labels"] = f"""with {S.STORE}, c as (select node_id, count(*) as n from chunks group by 1), q as (select node_id, count(*) filter (status in ('pending', 'valid')) as s, count(*) as n from questions group by 1)
select doc_id, node_id, case level when 0 then '📚' when 1 then '📖' when 2 then '📄' when 3 then '•' else '·' end || case when upper(level_label) <> 'PARTE' then ' **' || level_label || ' ' || ordinal || '**' else '' end
  || case when title = '' then '' when upper(level_label) <> 'PARTE' then ' — ' || title else ' ' || title end || case when c.n > 0 then '   ·  ' || c.n || ' chunk(s)' else '' end
  || '   ·  ' || case when q.n is null then '⚠ sin pregunta' else '❓' || s || '/' || q.n end as label
from nodes left join c using (node_id) left join q using (node_id)"""


def chunk_previews(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.previews(S.chunks(spark, sf), 60).select("node_id", "ordinal", "preview")


SQL["chunk_previews"] = f"with {S.STORE} select node_id, ordinal, case when length(text) > 60 then text[1:60] || '…' else text end as preview from chunks"


def section_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The sections that questions are about, looked up by their numbers."""
    found = lookup.pick(S.nodes(spark, sf), "node_id", S.questions(spark, sf))
    return lookup.with_counts(found, S.chunks(spark, sf)).select("node_id", "sort_key", "title", "n_chunks")


SQL["section_lookup"] = f"with {S.STORE} select node_id, sort_key, title, (select count(*) from chunks c where c.node_id = n.node_id) as n_chunks from nodes n where exists (select 1 from questions q where q.node_id = n.node_id)"


def question_cards(spark: SparkSession, sf: str) -> DataFrame:
    turns = S.table(spark, sf, "conversations")
    options = turns.select((F.col("conv_id") * 100 + F.col("turn") % 2).alias("question_id"), F.col("turn").cast("int").alias("order_in_question"), "role", "text")
    cards = lookup.cards(S.questions(spark, sf), options, _paged(spark, sf))
    shown = F.array_join(F.transform("options", lambda o: F.concat(F.lit("("), o["role"], F.lit(") "), o["text"])), "|")
    return cards.select("question_id", "breadcrumb", "pages", "question_text", "status", shown.alias("options"))


SQL["question_cards"] = f"""with {S.STORE}, {_TRAILS}, o as (select conv_id * 100 + turn % 2 as question_id, string_agg('(' || role || ') ' || text, '|' order by turn, role, text) as options from conversations group by 1)
select question_id, breadcrumb, {_PAGES} as pages, question_text, status, coalesce(options, '') as options from questions left join nodes n using (node_id) left join trails t on t.doc_id = n.doc_id and t.local_id = n.local_id left join o using (question_id)"""


def sibling_places(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.neighbours(S.nodes(spark, sf))


SQL["sibling_places"] = f"""with {S.CLASSIFIED} select doc_id, local_id, row_number() over w as place, count(*) over (partition by doc_id, parent_pos) as "of", lag(local_id) over w as previous, lead(local_id) over w as next from parents window w as (partition by doc_id, parent_pos order by pos)"""


def generation_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return generation.prompts(_paged(spark, sf), S.chunks(spark, sf))


SQL["generation_prompts"] = f"""with {S.STORE}, {_TRAILS}, b as (select node_id, string_agg(text, chr(10) || chr(10) order by ordinal) as body from chunks group by 1)
select node_id, 'Bloque: ' || level_label || ' ' || ordinal || chr(10) || 'Título: ' || title || chr(10) || 'Páginas: ' || {_PAGES} || chr(10) || 'Ruta: ' || breadcrumb || chr(10) || chr(10) || coalesce(body, '(sin texto)') as prompt
from nodes join trails using (doc_id, local_id) left join b using (node_id)"""


QUERIES = [global_kpis, counts_default_zero, chunks_per_node, questions_per_run, question_kpis, coverage_table, status_by_node, tree_badges, siblings, children, ancestors, display_tree, select_nodes, missing_questions, list_questions, paginate_chunks, recent_runs, open_batches, question_options, latest_status, literal_citation, strip_inline_options, question_shape, reconcile_batch, batch_outcomes, run_totals, cost_actual, cost_estimate, cost_scenarios, generation_stub, tree_labels, chunk_previews, section_lookup, question_cards, sibling_places, generation_prompts]
