"""Registered queries on elements, headings, sections and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium import shared
from folium.functions import headings
from folium.operators import chunking, elements, hierarchy, quality
from folium.plans import standins as S

SQL: dict[str, str] = {}


def elements_explode(spark: SparkSession, sf: str) -> DataFrame:
    return elements.from_lines(S.table(spark, sf, "documents")).select("doc_id", "pos", "page_number", "physical_page_index", "kind", "text")


SQL["elements_explode"] = """
with l as (select doc_id, unnest(string_split(text, chr(10))) as text, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::int as pos from documents)
select doc_id, pos, pos // 20 + 1 as page_number, pos // 20 as physical_page_index, 'narrative' as kind, text from l
"""


def drop_filter(spark: SparkSession, sf: str) -> DataFrame:
    return elements.drop_counts(S.elements(spark, sf), headings.LEGAL_CODE)


SQL["drop_filter"] = f"with {S.ELEMENTS} select doc_id, count(*) as n_elements, count(*) filter (trim(text) = '') as n_dropped from elements group by doc_id"


def classify_headings(spark: SparkSession, sf: str) -> DataFrame:
    rows = elements.kept(S.elements(spark, sf)).withColumn("h", headings.classify(F.col("text"))).filter("h is not null")
    return rows.select("doc_id", "pos", F.col("h.kind").alias("heading_kind"), "h.level", F.col("h.label").alias("level_label"), "h.ordinal", "h.remainder")


SQL["classify_headings"] = f"with {S.CLASSIFIED} select doc_id, pos, h.kind as heading_kind, h.level as level, h.label as level_label, h.ordinal as ordinal, h.remainder as remainder from classified where h is not null"


def hierarchy_parent(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "pos", "local_id", "level", "parent_pos")


SQL["hierarchy_parent"] = f"with {S.CLASSIFIED} select doc_id, pos, local_id, level, parent_pos from parents"


def hierarchy_sort_key(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "local_id", "sort_key")


SQL["hierarchy_sort_key"] = f"with {S.CLASSIFIED} select doc_id, local_id, sort_key from parents"


def title_lookahead(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "local_id", "level_label", "ordinal", "title")


SQL["title_lookahead"] = f"with {S.CLASSIFIED} select doc_id, local_id, level_label, ordinal, title from parents"


def body_attach(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.body(S.annotated(spark, sf)).select("doc_id", "pos", "local_id")


SQL["body_attach"] = f"with {S.CLASSIFIED} select doc_id, pos, local_id from body"


def unattached(spark: SparkSession, sf: str) -> DataFrame:
    """Without parts as headings, some text comes before the first heading."""
    late = S.elements(spark, sf).filter("pos > 0")
    return hierarchy.body(hierarchy.annotate(late)).filter("local_id is null").groupBy("doc_id").agg(F.count("*").alias("n"))


SQL["unattached"] = f"""with {S.CLASSIFIED}, first as (select doc_id, min(pos) as pos from heads where pos > 0 group by doc_id)
select c.doc_id, count(*) as n from classified c left join first f using (doc_id) where c.pos > 0 and h is null and kind <> 'page_header' and (f.pos is null or c.pos < f.pos) group by c.doc_id"""


def page_end_last(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "local_id", "page_start", "page_end", "n_body")


SQL["page_end_last"] = f"""with {S.CLASSIFIED} select p.doc_id, p.local_id, any_value(p.page_number) as page_start, arg_max(b.page_number, b.pos) as page_end, count(b.pos) as n_body
from parents p left join body b using (doc_id, local_id) group by p.doc_id, p.local_id"""


def breadcrumbs(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "local_id", "breadcrumb")


SQL["breadcrumbs"] = f"""with recursive {S.CLASSIFIED},
own as (select doc_id, pos, local_id, parent_pos, trim(level_label || ' ' || ordinal) || case when title <> '' then ' — ' || title else '' end as label from parents),
up as (
  select doc_id, pos, local_id, label as breadcrumb from own where parent_pos is null
  union all
  select o.doc_id, o.pos, o.local_id, u.breadcrumb || ' › ' || o.label from own o join up u on o.doc_id = u.doc_id and o.parent_pos = u.pos
)
select doc_id, local_id, breadcrumb from up"""


def node_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.annotated(spark, sf)
    return chunking.merged(hierarchy.nodes(rows), hierarchy.body(rows), 0).select("doc_id", "local_id", "text", "has_table", "has_image_ref")


_PART = "case when kind in ('heading', 'title') then null when kind = 'table' then chr(10) || '[TABLA]' || chr(10) || text || chr(10) || '[/TABLA]' || chr(10) when kind = 'figure' then '[FIGURA: ' || text || ']' else text end"
_TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_SECTIONS = f"""texts as (
  select doc_id, local_id, string_agg(part, chr(10) || chr(10) order by pos) as text, bool_or(kind = 'table') as has_table, bool_or(kind = 'figure') as has_image_ref
  from (select *, nullif({_TRIM.format(_PART)}, '') as part from body where local_id is not null) group by doc_id, local_id having count(part) > 0
)"""
SQL["node_text"] = f"with {S.CLASSIFIED}, {_SECTIONS} select doc_id, local_id, text, has_table, has_image_ref from texts"


def merge_small_nodes(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.annotated(spark, sf)
    kept = chunking.merged(hierarchy.nodes(rows), hierarchy.body(rows), 150)
    return kept.select("doc_id", "local_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def _merge_sql() -> str:
    """The same by levels, written out: sections as (list of positions), deepest first."""
    steps = ["own as (select p.doc_id, p.local_id, p.pos, p.level, p.parent_pos, coalesce((select list(b.pos order by b.pos) from body b where b.doc_id = p.doc_id and b.local_id = p.local_id), []) as els from parents p)"]
    ups = []
    for level in (3, 2, 1, 0):
        more = "[]" if not ups else "coalesce((select flatten(list(u.els order by u.local_id desc)) from (" + " union all ".join(f"select * from up{k}" for k in ups) + ") u where u.doc_id = o.doc_id and u.parent_pos = o.pos), [])"
        steps.append(f"at{level} as (select o.doc_id, o.local_id, o.parent_pos, o.els || {more} as els from own o where level = {level})")
        steps.append(f"flat{level} as (select doc_id, local_id, any_value(parent_pos) as parent_pos, any_value(els) as els, string_agg(part, chr(10) || chr(10) order by i) as text from (select a.*, i, nullif({_TRIM.format(_PART)}, '') as part from (select *, unnest(els) as pos, generate_subscripts(els, 1) as i from at{level}) a join body b on b.doc_id = a.doc_id and b.pos = a.pos) group by doc_id, local_id having count(part) > 0)")
        steps.append(f"up{level} as (select doc_id, parent_pos, local_id, els from flat{level} where length(text) < 150 and parent_pos is not null)")
        ups.append(level)
    out = " union all ".join(f"select doc_id, local_id, length(text) as n_chars, sha256(text) as text_sha256 from flat{k} where not (length(text) < 150 and parent_pos is not null)" for k in ups)
    return f"with {S.CLASSIFIED}, {', '.join(steps)} {out}"


SQL["merge_small_nodes"] = _merge_sql()
_PACK = chunking.Sizes(300, 240, 40, 0)


def pack_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.annotated(spark, sf)
    sections = chunking.merged(hierarchy.nodes(rows), hierarchy.body(rows), 0)
    return chunking.chunks(sections, _PACK).select("doc_id", "local_id", "ordinal", "text", "char_count", "page_start", "page_end")


_CHUNKS = f"""{_SECTIONS},
paras as (select t.doc_id, t.local_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: trim(x) <> '') as ps, text from texts t),
walk as (
  select doc_id, local_id, ps, 2 as i, ps[1] as now, null::varchar as done from paras where length(text) > {_PACK.most}
  union all
  select doc_id, local_id, ps, i + 1,
    case when length(now) + length(ps[i]) + 2 <= {_PACK.soft} then now || chr(10) || chr(10) || ps[i] else right(now, {_PACK.overlap}) || chr(10) || chr(10) || ps[i] end,
    case when length(now) + length(ps[i]) + 2 <= {_PACK.soft} then null else now end
  from walk where i <= len(ps)
),
pieces as (
  select doc_id, local_id, 1 as i, text as piece from paras where length(text) <= {_PACK.most}
  union all select doc_id, local_id, i, done from walk where done is not null
  union all select doc_id, local_id, i + 1, now from walk where i = len(ps) + 1
),
ends as (select doc_id, local_id, arg_max(page_number, pos) as page_end from body group by doc_id, local_id),
packed as (
  select x.doc_id, x.local_id, (row_number() over (partition by x.doc_id, x.local_id order by x.i) - 1)::int as ordinal, piece as text, length(piece)::int as char_count,
    p.page_number as page_start, coalesce(e.page_end, p.page_number) as page_end
  from pieces x join parents p on p.doc_id = x.doc_id and p.local_id = x.local_id left join ends e on e.doc_id = x.doc_id and e.local_id = x.local_id
)"""
SQL["pack_overlap"] = f"with recursive {S.CLASSIFIED}, {_CHUNKS} select * from packed"


def _report(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    e = S.elements(spark, sf)
    # headings are looked for once; sections, chunks and the report come from what that gave
    rows, _ = shared.stored(hierarchy.annotate(e).select("doc_id", "pos", "page_number", "kind", "text", "heading", "title", "level", "local_id", "parent_pos", "sort_key", "owner", "is_body"))
    n = hierarchy.nodes(rows)
    c, _ = shared.stored(chunking.chunks(chunking.merged(n, hierarchy.body(rows), 0), _PACK))
    return e, e.groupBy("doc_id").agg(F.max("page_number").alias("page_count")), n, c


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to elements, sections, chunks and a report on each document."""
    _, docs, n, c = _report(spark, sf)
    return quality.report(docs, n, c)


SQL["quality_report"] = f"""with recursive {S.CLASSIFIED}, {_CHUNKS},
d as (select doc_id, max(page_number) as page_count from elements group by doc_id),
n as (select p.doc_id, count(*) as n_nodes, count(*) filter (not exists (select 1 from packed c where c.doc_id = p.doc_id and c.local_id = p.local_id)) as orphan_nodes from parents p group by p.doc_id),
c as (select doc_id, count(*) as n_chunks, sum(char_count) / count(*) as avg_chunk_chars from packed group by doc_id),
g as (select doc_id, count(distinct page) as pages_covered from (select doc_id, unnest(generate_series(page_start, page_end)) as page from packed) group by doc_id)
select d.doc_id, coalesce(n_nodes, 0) as n_nodes, coalesce(n_chunks, 0) as n_chunks, coalesce(orphan_nodes, 0) as orphan_nodes, coalesce(pages_covered, 0) as pages_covered,
  100.0::double * coalesce(pages_covered, 0) / page_count as coverage_pct, coalesce(avg_chunk_chars, 0)::double as avg_chunk_chars
from d left join n using (doc_id) left join c using (doc_id) left join g using (doc_id)"""


def level_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return quality.level_distribution(S.nodes(spark, sf))


SQL["level_distribution"] = f"with {S.CLASSIFIED} select doc_id, level_label, count(*) as n from heads group by doc_id, level_label"


def extraction_metrics(spark: SparkSession, sf: str) -> DataFrame:
    e, _, n, c = _report(spark, sf)
    return quality.extraction_metrics(e, n, c)


SQL["extraction_metrics"] = f"""with recursive {S.CLASSIFIED}, {_CHUNKS},
e as (select doc_id, count(*) as n_elements, count(*) filter (kind in ('title', 'heading')) as n_headings, count(*) filter (kind = 'table') as n_tables from elements group by doc_id),
l as (select doc_id, count(*) as n from parents p where not exists (select 1 from parents c where c.doc_id = p.doc_id and c.parent_pos = p.pos) group by doc_id),
c as (select doc_id, count(*) as n from packed group by doc_id)
select doc_id, n_elements, n_headings, n_tables, coalesce(l.n, 0) as n_leaves, coalesce(c.n, 0) as n_chunks from e left join l using (doc_id) left join c using (doc_id)"""


def profile_autodetect(spark: SparkSession, sf: str) -> DataFrame:
    """Documents begin with phrases of the genres in turn."""
    phrases = F.element_at(F.array(*map(F.lit, ("LIBRO PRIMERO ", "TÍTULO PRIMERO Artículo 1 ", "Manual de campo ", "Artículo 2 ", "Nada "))), (F.col("doc_id") % 5 + 1).cast("int"))
    first = F.when(F.col("pos") == 3, F.concat(phrases, F.when(F.col("doc_id") % 10 == 0, "Código de ").otherwise(""), "text")).otherwise(F.col("text"))
    lines = elements.from_lines(S.table(spark, sf, "documents")).withColumn("text", first)
    return elements.genres(lines)


SQL["profile_autodetect"] = """
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
e as (select doc_id, pos, case when pos = 3 then ['LIBRO PRIMERO ', 'TÍTULO PRIMERO Artículo 1 ', 'Manual de campo ', 'Artículo 2 ', 'Nada '][doc_id % 5 + 1] || case when doc_id % 10 = 0 then 'Código de ' else '' end || line else line end as text from l),
b as (select *, coalesce(sum(length(text)) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as before from e where text <> ''),
s as (select doc_id, lower(string_agg(text, ' ' order by pos)) as t from b where before < 4000 group by doc_id),
f as (select doc_id, regexp_matches(t, '\\blibro\\s+primero\\b') as book, regexp_matches(t, '\\bt[íi]tulo\\s+primero\\b') as title, regexp_matches(t, '\\bart[íi]culo\\s+\\d') as article,
  contains(t, 'código de') or contains(t, 'codigo de') as code, regexp_matches(t, '\\b(primera|segunda|tercera)\\s+parte\\b') as part, contains(t, 'manual de') as manual from s)
select d.doc_id, case when book and (title or article or code) then 'codigo_legal' when title and article and not book and not part then 'ley_organica'
  when part or manual then 'manual' when article then 'ley_organica' else 'manual' end as profile
from (select distinct doc_id from documents) d left join f using (doc_id)
"""


def symbol_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return quality.symbol_frequencies(S.table(spark, sf, "documents"))


SQL["symbol_frequencies"] = "select symbol, count(*) as n from (select unnest(string_split(regexp_replace(text, '[\\pL\\pN\\pM\\s]', '', 'g'), '')) as symbol from documents) where symbol <> '' group by symbol order by n desc, symbol limit 15"

def fraction_order(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sections whose lines are articles and fractions out of order."""
    kind = "case when l_linenumber % 4 = 1 then 'Artículo ' || l_suppkey || '. x' when l_linenumber % 7 = 5 then 'texto' else element_at(array('I', 'II', 'III', 'IV', 'V', 'VI'), cast((l_partkey + l_linenumber) % 6 as int) + 1) || '.- ' || l_suppkey end"
    parts = S.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.expr(f"transform(array_sort(collect_list(named_struct('n', l_linenumber, 't', {kind}))), x -> x.t)").alias("parts"))
    return parts.select("l_orderkey", F.array_join(chunking.reordered(F.col("parts")), "|").alias("parts"))


SQL["fraction_order"] = """with recursive l as (select l_orderkey, l_linenumber, case when l_linenumber % 4 = 1 then 'Artículo ' || l_suppkey || '. x' when l_linenumber % 7 = 5 then 'texto' else ['I', 'II', 'III', 'IV', 'V', 'VI'][(l_partkey + l_linenumber) % 6 + 1] || '.- ' || l_suppkey end as t,
  case when l_linenumber % 4 = 1 or l_linenumber % 7 = 5 then 0 else (l_partkey + l_linenumber) % 6 + 1 end as v, l_linenumber % 4 = 1 as a from lineitem),
p as (select l_orderkey, list({'t': t, 'v': v, 'a': a} order by l_linenumber, t) as x from l group by 1),
w as (
  select l_orderkey, x, 0 as n from p
  union all
  select l_orderkey, x[:j] || [x[i]] || x[j + 1:i - 1] || x[i + 1:], n + 1 from (
    select l_orderkey, x, n, i, j from (
      select *, list_max(list_filter(range(1, i), lambda k: x[k].v > 0 and x[k].v < x[i].v)) as j from (select l_orderkey, x, n, unnest(range(2, len(x) + 1)) as i from w where n < 10) where x[i].v >= 2
    ) where j is not null and len(list_filter(x[j:i - 1], lambda e: e.a)) > 0 qualify row_number() over (partition by l_orderkey order by i) = 1
  )
)
select l_orderkey, array_to_string(list_transform(x, lambda e: e.t), '|') as parts from w qualify row_number() over (partition by l_orderkey order by n desc) = 1"""


def _legal_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of documents, seven of thirteen of which become headings and running heads of laws, by position."""
    rows = S.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.selectExpr(
        "doc_id", "pos", "cast(1 as int) as page_number", "'narrative' as kind",
        """case pos % 13 when 0 then 'LIBRO ' || element_at(array('PRIMERO', 'Segundo', 'DÉCIMO TERCERO', 'DECIMOPRIMERO', 'vigésimo', 'ÚNICO'), cast(doc_id % 6 as int) + 1) || ' De la organización'
           when 1 then 'TITULO ' || element_at(array('PRELIMINAR', 'IV', '12', 'Cuarto'), cast(doc_id % 4 as int) + 1)
           when 2 then if(doc_id % 2 = 0, ' Capítulo II bis', 'CAPITULO X - De las armas')
           when 3 then 'Artículo ' || (doc_id % 40 + 1) || element_at(array('o.- Uno', 'o. Bis.- Dos', '.- Tres', 'o. septimus.-', 'º Cinco'), cast(doc_id % 5 as int) + 1)
           when 4 then '  1 de 141 ' when 5 then 'CÁMARA DE DIPUTADOS DEL H. CONGRESO DE LA UNIÓN' when 6 then 'Última Reforma DOF 13-06-2014'
           when 7 then if(doc_id % 2 = 0, 'Anexo "B" - Formato', 'ANEXO C') else line end as text""",
    )


def legal_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Books, titles, chapters and articles of laws, and the annexes of manuals."""
    lines, parts = _legal_lines(spark, sf), []
    for p in (headings.LEGAL_ARTICLES, headings.MANUAL_ANNEXES):
        rows = elements.kept(lines, p).withColumn("h", headings.classify(F.col("text"), p)).filter("h is not null")
        parts.append(rows.select(F.lit(p.name).alias("profile"), "doc_id", "pos", F.col("h.kind").alias("heading_kind"), "h.level", F.col("h.label").alias("level_label"), "h.ordinal", "h.remainder"))
    return parts[0].unionByName(parts[1])


SQL["legal_headings"] = """with l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
h as (select *, pos % 13 as k, case pos % 13
  when 0 then ['PRIMERO', 'SEGUNDO', 'DÉCIMO TERCERO', 'DECIMOPRIMERO', 'VIGÉSIMO', 'ÚNICO'][doc_id % 6 + 1] when 1 then ['PRELIMINAR', 'IV', '12', 'CUARTO'][doc_id % 4 + 1]
  when 2 then case when doc_id % 2 = 0 then 'II BIS' else 'X' end when 3 then (doc_id % 40 + 1) || 'o' || ['', ' Bis', '', ' Septimus', ''][doc_id % 5 + 1] when 7 then case when doc_id % 2 = 0 then 'B' else 'C' end end as ordinal,
  case pos % 13 when 0 then 'De la organización' when 2 then case when doc_id % 2 = 0 then '' else 'De las armas' end when 3 then ['Uno', 'Dos', 'Tres', '', 'Cinco'][doc_id % 5 + 1]
    when 7 then case when doc_id % 2 = 0 then 'Formato' else '' end else '' end as remainder from l)
select 'codigo_legal_articulos' as profile, doc_id, pos, ['LIBRO', 'TITULO', 'CAPITULO', 'ARTICULO'][k + 1] as heading_kind, k::int as level, ['LIBRO', 'TÍTULO', 'Capítulo', 'Artículo'][k + 1] as level_label, ordinal, remainder from h where k < 4
union all select 'manual_anexos', doc_id, pos, case k when 2 then 'CAPITULO' else 'ANEXO' end, case k when 2 then 1 else 0 end, case k when 2 then 'Capítulo' else 'Anexo' end, ordinal, remainder from h where k in (2, 7)"""


def legal_drops(spark: SparkSession, sf: str) -> DataFrame:
    parts = [elements.drop_counts(_legal_lines(spark, sf), p).withColumn("profile", F.lit(p.name)) for p in (headings.LEGAL_ARTICLES, headings.LEGAL_CODE, headings.ORGANIC_LAW)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL["legal_drops"] = """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
p as (select unnest(['codigo_legal_articulos', 'codigo_legal', 'ley_organica']) as profile)
select profile, doc_id, count(*) as n_elements, count(*) filter (pos % 13 in (4, 5) or (pos % 13 = 6 and profile <> 'codigo_legal') or (pos % 13 > 7 and trim(line) = '') or (pos % 13 > 7 and profile = 'ley_organica' and contains(lower(line), 'dof'))) as n_dropped
from l, p group by profile, doc_id"""

QUERIES = [elements_explode, drop_filter, classify_headings, hierarchy_parent, hierarchy_sort_key, title_lookahead, body_attach, unattached, page_end_last, breadcrumbs, node_text, merge_small_nodes, pack_overlap, quality_report, level_distribution, extraction_metrics, profile_autodetect, legal_headings, legal_drops, fraction_order, symbol_frequencies]
