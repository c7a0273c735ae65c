"""The given tables seen as documents with elements, sections, chunks, questions and runs; and the same in SQL.

Sentences are elements. Every 16 of them some become headings by their position, so that the heading grammar and
the section tree have something to find in prose that has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import headings
from folium.operators import hierarchy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROMANS = "array('I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII')"


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", r"[.\n] ?")).alias("pos", "line"))
    rows = rows.selectExpr(
        "doc_id",
        "pos",
        "cast(floor(pos / 20) as int) + 1 as page_number",
        """case when pos % 16 in (0, 3, 6, 9, 12, 14) then 'heading' when pos % 25 = 7 then 'page_header' when pos % 11 = 4 then 'table'
           when pos % 13 = 5 then 'figure' when pos % 10 = 1 then 'list_item' else 'narrative' end as kind""",
        f"""case pos % 16 when 0 then element_at(array('PRIMERA', 'SEGUNDA', 'TERCERA'), cast(floor(pos / 16) % 3 as int) + 1) || ' PARTE'
           when 3 then 'Capítulo ' || element_at({_ROMANS}, cast(floor(pos / 8) % 8 as int) + 1) || if(doc_id % 3 = 0, ' - De la guerra', '')
           when 9 then 'Capítulo ' || element_at({_ROMANS}, cast(floor(pos / 8) % 8 as int) + 1)
           when 6 then 'Primera Sección' when 12 then 'Segunda sección'
           when 14 then '- Subsección (' || chr(cast(65 + doc_id % 5 as int)) || ')'
           else if(pos % 17 = 8, '  ', line) end as text""",
    )
    return rows


ELEMENTS = """
sentences as (select doc_id, unnest(regexp_split_to_array(text, '[.\\n] ?')) as line, generate_subscripts(regexp_split_to_array(text, '[.\\n] ?'), 1) - 1 as pos from documents),
elements as (
  select doc_id, pos::int as pos, (pos // 20)::int + 1 as page_number,
    case when pos % 16 in (0, 3, 6, 9, 12, 14) then 'heading' when pos % 25 = 7 then 'page_header' when pos % 11 = 4 then 'table'
      when pos % 13 = 5 then 'figure' when pos % 10 = 1 then 'list_item' else 'narrative' end as kind,
    case pos % 16 when 0 then ['PRIMERA', 'SEGUNDA', 'TERCERA'][(pos // 16) % 3 + 1] || ' PARTE'
      when 3 then 'Capítulo ' || ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII'][(pos // 8) % 8 + 1] || case when doc_id % 3 = 0 then ' - De la guerra' else '' end
      when 9 then 'Capítulo ' || ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII'][(pos // 8) % 8 + 1]
      when 6 then 'Primera Sección' when 12 then 'Segunda sección'
      when 14 then '- Subsección (' || chr((65 + doc_id % 5)::int) || ')'
      else case when pos % 17 = 8 then '  ' else line end end as text
  from sentences
)"""


def _sql_match(kind: str, level: int) -> str:
    pattern, ordinal_at, title_at = headings.PATTERNS[kind]
    pattern = f"'(?i){pattern}'".replace("[-–:.\\s]", "[–:.\\s-]")
    source = f"regexp_replace(text, '(?i)Terce\\s*r\\s*a', 'Tercera')" if kind == "SECCION" else "text"
    part = lambda k: f"regexp_extract({source}, {pattern}, {k})"
    ordinal = f"upper({part(ordinal_at)})"
    if kind == "SUBSECCION":
        ordinal = f"'(' || upper({part(1)}) || ')'"
    elif kind == "SECCION":
        raw = f"coalesce(nullif({part(1)}, ''), {part(2)})"
        ordinal = f"upper({raw}[1:1]) || lower({raw}[2:])"
    title = f"trim({part(title_at)})" if title_at else "''"
    return f"when regexp_matches({source}, {pattern}) then {{'kind': '{kind}', 'level': {level}, 'label': '{headings.LABELS[kind]}', 'ordinal': {ordinal}, 'remainder': {title}}}"


#: Kept elements with their heading under the manual profile.
CLASSIFIED = f"""{ELEMENTS},
kept as (select * from elements where trim(text) <> ''),
classified as (select doc_id, pos, page_number, kind, text, case {" ".join(_sql_match(k, headings.MANUAL.depths[k]) for k in headings.MANUAL.kinds)} end as h from kept),
ahead as (select *, lead(text) over w as next_text, lead(h is not null) over w as next_is from classified window w as (partition by doc_id order by pos)),
heads as (
  select doc_id, pos, page_number, h.level as level, h.label as level_label, h.ordinal as ordinal,
    row_number() over (partition by doc_id order by pos) - 1 as local_id,
    case when h.remainder <> '' then h.remainder when not next_is and length(trim(next_text)) <= 200 and not starts_with(lower(trim(next_text)), 'artículo') then trim(next_text) else '' end as title
  from ahead where h is not null and kind <> 'page_header'
),
parents as (
  select x.*, (select max(p.pos) from heads p where p.doc_id = x.doc_id and p.pos < x.pos and p.level < x.level) as parent_pos,
    (select string_agg(lpad(n::varchar, 2, '0'), '.' order by k) from (
      select k, (select count(*) from heads c where c.doc_id = x.doc_id and c.level = k and c.pos <= x.pos
        and c.pos > coalesce((select max(l.pos) from heads l where l.doc_id = x.doc_id and l.level < k and l.pos <= x.pos), -1)) as n
      from range(0, x.level + 1) t(k))) as sort_key
  from heads x
),
body as (
  select c.doc_id, c.pos, c.page_number, c.kind, c.text, (select max(local_id) from heads x where x.doc_id = c.doc_id and x.pos < c.pos) as local_id
  from classified c where (h is null) and kind <> 'page_header'
)"""



def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.annotate(elements(spark, sf_dir))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with node_id, unique across documents."""
    return hierarchy.nodes(annotated(spark, sf_dir)).withColumn("node_id", F.col("doc_id") * 10000 + F.col("local_id"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body elements as chunks of their sections: (doc_id, node_id, ordinal, text, page_start, page_end)."""
    rows = hierarchy.body(annotated(spark, sf_dir)).filter("local_id is not null")
    return rows.select("doc_id", (F.col("doc_id") * 10000 + F.col("local_id")).alias("node_id"), F.col("pos").alias("ordinal"), "text", F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as questions of sections."""
    rows = table(spark, sf_dir, "conversations")
    status = F.element_at(F.array(*map(F.lit, ("pending", "valid", "needs_review", "rejected"))), ((F.col("conv_id") + F.col("turn")) % 4 + 1).cast("int"))
    return rows.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("question_id"),
        (F.col("conv_id") * 10000 + F.col("turn") % 6).alias("node_id"),
        F.col("conv_id").alias("doc_id"),
        (F.col("conv_id") % 7).alias("run_id"),
        F.col("turn").alias("generation_order"),
        F.col("text").alias("question_text"),
        F.col("role").alias("justification"),
        status.alias("status"),
    )


#: Sections, chunks and questions as above.
STORE = f"""{CLASSIFIED},
nodes as (select *, doc_id * 10000 + local_id as node_id from parents),
chunks as (select doc_id, doc_id * 10000 + local_id as node_id, pos as ordinal, text, page_number as page_start, page_number as page_end from body where local_id is not null),
questions as (
  select conv_id * 100 + turn as question_id, conv_id * 10000 + turn % 6 as node_id, conv_id as doc_id, conv_id % 7 as run_id, turn as generation_order,
    text as question_text, role as justification, ['pending', 'valid', 'needs_review', 'rejected'][(conv_id + turn) % 4 + 1] as status
  from conversations
)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as generation runs; lines give token counts."""
    o = table(spark, sf_dir, "orders")
    model = F.when(F.col("o_orderkey") % 3 == 0, "gemini-2.5-pro").when(F.col("o_orderkey") % 3 == 1, "gemini-2.5-flash").otherwise("unknown-model")
    mode = F.when(F.col("o_orderstatus") == "F", "batch").otherwise("immediate")
    status = F.when(F.col("o_orderstatus") == "P", "running").when(F.col("o_orderkey") % 5 == 0, "running").otherwise("succeeded")
    return o.select(F.col("o_orderkey").alias("run_id"), model.alias("model"), mode.alias("mode"), status.alias("status"), F.col("o_orderdate").alias("started_at"), F.col("o_totalprice").alias("cost_estimate_usd"), F.col("o_custkey").alias("doc_id"))


RUNS = """
runs as (
  select o_orderkey as run_id, case o_orderkey % 3 when 0 then 'gemini-2.5-pro' when 1 then 'gemini-2.5-flash' else 'unknown-model' end as model,
    case when o_orderstatus = 'F' then 'batch' else 'immediate' end as mode,
    case when o_orderstatus = 'P' or o_orderkey % 5 = 0 then 'running' else 'succeeded' end as status,
    o_orderdate as started_at, o_totalprice as cost_estimate_usd, o_custkey as doc_id
  from orders
)"""
