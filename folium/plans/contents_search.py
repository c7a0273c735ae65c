"""Registered queries on contents pages, search, export values and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium import shared
from folium.functions import text as T
from folium.operators import contents, hierarchy, quality, search
from folium.plans import standins as S
from folium.sources.bundles import next_versions
from folium.sources.postings import Index

SQL: dict[str, str] = {}


def _toc_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"[.\n] ?")).alias("pos", "line"))
    return rows.selectExpr(
        "doc_id",
        "pos",
        """case when pos % 12 = 0 then element_at(array('PRIMERA', 'Segunda', 'TERCERA'), cast(floor(pos / 12) % 3 as int) + 1) || ' PARTE'
           when pos % 12 = 5 then 'Capítulo III' when pos % 12 = 7 then '  iv ' when pos % 12 = 9 then '' when pos % 12 = 10 then '17'
           when pos % 2 = 0 then repeat(' ', cast(doc_id % 3 * 4 as int)) || line || ' ..... ' || if(pos % 8 = 4, 'xii', cast(pos + 3 as string)) else line end as text""",
    )


_TOC = """
raw as (select doc_id, unnest(regexp_split_to_array(text, '[.\\n] ?')) as line, generate_subscripts(regexp_split_to_array(text, '[.\\n] ?'), 1) - 1 as pos from documents),
toc as (select doc_id, pos::int as pos, case when pos % 12 = 0 then ['PRIMERA', 'Segunda', 'TERCERA'][(pos // 12) % 3 + 1] || ' PARTE'
  when pos % 12 = 5 then 'Capítulo III' when pos % 12 = 7 then '  iv ' when pos % 12 = 9 then '' when pos % 12 = 10 then '17'
  when pos % 2 = 0 then repeat(' ', (doc_id % 3 * 4)::int) || line || ' ..... ' || case when pos % 8 = 4 then 'xii' else (pos + 3)::varchar end else line end as text from raw),
sig as (select *, trim(text) as s, trim(text) = '' or regexp_matches(trim(text), '^\\d+$') or regexp_matches(replace(trim(text), ' ', ''), '(?i)^[ivxlcdm]+$') as skip from toc),
typed as (select *, not skip and regexp_matches(s, '(?i)^\\s*(primera|segunda|tercera|cuarta|quinta|sexta|s[eé]ptima|octava|novena|d[eé]cima)\\s+PARTE\\s*$') as is_part from sig),
marked as (select *, not skip and not is_part and regexp_matches(text, '(?i)^\\s*(.+?)[.…\\s]{3,}[.…]\\s*(\\d+|[ivxlcdm]+)\\s*$') as is_entry from typed),
solid as (select *, row_number() over (partition by doc_id order by pos) as r from marked where not skip)"""


def toc_density_runs(spark: SparkSession, sf: str) -> DataFrame:
    page = F.floor(F.col("pos") / 12).cast("int") + 1
    lines = _toc_lines(spark, sf).withColumn("text", F.when((page % 4 == 0) | (page + F.col("doc_id") % 3 == 2), F.regexp_replace("text", r"\.", "")).otherwise(F.col("text")))
    pages = lines.withColumn("page", page).groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return contents.page_runs(pages.withColumn("text", F.regexp_replace("text", " (?=[0-9x])", " .. ")))


SQL["toc_density_runs"] = f"""with {_TOC},
l as (select doc_id, pos, pos // 12 + 1 as page, case when (pos // 12 + 1) % 4 = 0 or pos // 12 + 1 + doc_id % 3 = 2 then replace(text, '.', '') else text end as text from toc),
m as (select doc_id, pos, page, regexp_replace(text, ' ([0-9x])', ' .. \\1', 'g') as text from l),
p as (select doc_id, page, count(*) as n, count(*) filter (regexp_matches(text, '[.…]{{2,}}')) as k from m group by doc_id, page having page <= 30),
c as (select doc_id, page, page - row_number() over (partition by doc_id order by page) as run from p where k >= 5 and k >= 0.2 * n),
r as (select doc_id, run, min(page) as first_page, max(page) as last_page from c group by doc_id, run)
select doc_id, min(first_page)::int as first_page, arg_min(last_page, first_page)::int as last_page from r group by doc_id"""


def toc_entries(spark: SparkSession, sf: str) -> DataFrame:
    return contents.entries(_toc_lines(spark, sf))


_SQL_DEPTH = "case when regexp_matches({0}, '(?i)^\\s*(primera|segunda|tercera|cuarta|quinta|sexta|s[eé]ptima|octava|novena|d[eé]cima)\\s+parte\\b') then 0 when regexp_matches({0}, '(?i)^\\s*cap[ií]tulo\\b') then 1 when regexp_matches({0}, '(?i)^\\s*(((primera|segunda|tercera|cuarta|quinta|sexta|s[eé]ptima|octava|novena|d[eé]cima|[úu]nica)\\s+secci[oó]n)|secci[oó]n)\\b') then 2 when regexp_matches({0}, '(?i)^\\s*subsecci[oó]n\\b') then 3 when regexp_matches({0}, '(?i)^\\s*anexo\\b') then 0 else least((length({1}) - length(ltrim({1}))) // 4, 4) end"
_ENTRY_SQL = f"""
heads as (select m.*, case when is_part then coalesce((select case when n.is_entry then '' else n.s end from marked n where n.doc_id = m.doc_id and n.pos between m.pos + 1 and m.pos + 3 and not n.skip and not n.is_part order by n.pos limit 1), '') end as part_title from marked m),
looked as (
  select e.doc_id, e.pos, e.text,
    (select b.s from solid b where b.doc_id = e.doc_id and b.r between e.r - 3 and e.r - 1 and regexp_matches(b.s, '(?i)^[\\s–·-]*(cap[ií]tulo\\s+[ivxlcdm]+|(primera|segunda|tercera)\\s+parte)\\s*$') order by b.r desc limit 1) as marker,
    (select max(x.pos) from solid x where x.doc_id = e.doc_id and x.is_part and x.pos < e.pos) as part_at,
    coalesce((select max(x.pos) from solid x where x.doc_id = e.doc_id and x.is_entry and x.pos < e.pos), -1) as last_entry
  from solid e where e.is_entry
),
cut as (select *, regexp_replace(regexp_extract(text, '(?i)^\\s*(.+?)[.…\\s]{{3,}}[.…]\\s*(\\d+|[ivxlcdm]+)\\s*$', 1), '^[ ·–\\t-]+|[ ·–\\t-]+$', '', 'g') as raw, regexp_extract(text, '(?i)^\\s*(.+?)[.…\\s]{{3,}}[.…]\\s*(\\d+|[ivxlcdm]+)\\s*$', 2) as no from looked),
found as (
  select doc_id, pos + 1 as line_number, case when part_at > last_entry then 1 else 0 end as n, case when marker is not null then marker || ' — ' || raw else raw end as title,
    case when no = 'xii' then 12 else no::int end as page, (case when marker is not null then {_SQL_DEPTH.format('marker', 'marker')} else {_SQL_DEPTH.format('raw', 'text')} end)::int as depth from cut
  union all
  select c.doc_id, c.pos + 1, 0, upper(split_part(h.s, ' ', 1)) || ' PARTE' || case when h.part_title <> '' then ' — ' || h.part_title else '' end, case when c.no = 'xii' then 12 else c.no::int end, 0
  from cut c join heads h on h.doc_id = c.doc_id and h.pos = c.part_at where c.part_at > c.last_entry
)"""
SQL["toc_entries"] = f"with {_TOC}, {_ENTRY_SQL} select * from found"


def toc_confidence(spark: SparkSession, sf: str) -> DataFrame:
    lines = _toc_lines(spark, sf)
    return contents.summary(lines, contents.entries(lines))


SQL["toc_confidence"] = f"""with {_TOC}, {_ENTRY_SQL},
s as (select doc_id, count(*) filter (not skip and not is_part) as c, count(*) filter (is_entry) as m from marked group by doc_id),
n as (select doc_id, count(*) as n_entries from found group by doc_id)
select doc_id, coalesce(n_entries, 0) as n_entries, m / greatest(c, 1) as confidence, m / greatest(c, 1) >= 0.4 and coalesce(n_entries, 0) >= 5 as found from s left join n using (doc_id)"""


def toc_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Every third section stands in the contents, besides two entries that no section has."""
    # headings are looked for once; entries and sections, each read twice, come from what that gave
    nodes, _ = shared.stored(S.annotated(spark, sf).filter("heading is not null").select("doc_id", "local_id", "title"))
    entries = nodes.filter("local_id % 3 = 0 and title != ''").select("doc_id", F.concat(F.lit("— "), "title", F.lit("!")).alias("title")).unionByName(nodes.filter("local_id < 2").select("doc_id", F.concat(F.lit("falta "), F.col("local_id").cast("string")).alias("title")))
    return quality.contents_gaps(entries, nodes)


_KEY = "trim(regexp_replace(regexp_replace(lower(title), '[!-/:-@\\[-`{{-~—·]', '', 'g'), '\\s+', ' ', 'g'))".replace("{{", "{")
SQL["toc_gaps"] = f"""with {S.CLASSIFIED},
e as (select doc_id, '— ' || title || '!' as title from parents where local_id % 3 = 0 and title <> '' union all select doc_id, 'falta ' || local_id from parents where local_id < 2),
a as (select *, {_KEY} as key from e), b as (select doc_id, title, {_KEY} as key from parents where {_KEY} <> '')
select doc_id, 'contents' as side, title from a where not exists (select 1 from b where b.doc_id = a.doc_id and b.key = a.key)
union all select doc_id, 'body', title from b where not exists (select 1 from a where a.doc_id = b.doc_id and a.key = b.key)"""


def page_offset_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Contents that name each document's chapters two pages too early, the parts three."""
    e = S.elements(spark, sf)
    heads = e.filter("pos % 16 in (0, 3, 9)").select("doc_id", "pos", "page_number", "text")
    entries = heads.select("doc_id", F.col("pos").alias("line_number"), F.lit(0).alias("n"), F.col("text").alias("title"), (F.col("page_number") - F.when(F.col("pos") % 16 == 0, 3).otherwise(2)).alias("page"))
    return contents.page_offset(entries, e)


SQL["page_offset_mode"] = f"""with {S.ELEMENTS},
t as (select doc_id, pos, text as title, page_number - case when pos % 16 = 0 then 3 else 2 end as page, row_number() over (partition by doc_id order by pos) as k from elements where pos % 16 in (0, 3, 9)),
a as (select doc_id, k, page, {_KEY} as want from t where k <= 50),
b as (select doc_id, pos, page_number, {_KEY.replace('title', 'text')} as have from elements where kind = 'heading'),
m as (select a.doc_id, a.k, arg_min(b.page_number - a.page, b.pos) as off from a join b on a.doc_id = b.doc_id and (contains(have, want) or contains(want, have)) and page_number >= page group by a.doc_id, a.k),
c as (select doc_id, off, count(*) as n, min(k) as k from m group by doc_id, off)
select doc_id, off::int as "offset" from c qualify row_number() over (partition by doc_id order by n desc, k) = 1"""


def _contents(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and chapters of each document as entries of its contents, two pages too early."""
    heads = S.elements(spark, sf).filter("pos % 16 in (0, 3, 9)")
    return heads.select("doc_id", F.col("pos").alias("line_number"), F.lit(0).alias("n"), F.col("text").alias("title"), (F.col("page_number") - 2).alias("page"), F.when(F.col("pos") % 16 == 0, 0).otherwise(1).alias("depth"))


def contents_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = contents.as_nodes(_contents(spark, sf))
    return nodes.select("doc_id", "local_id", "level", "level_label", "ordinal", F.col("section_title").alias("title"), "page_start", "parent_pos", "sort_key")


_CONTENTS_SQL = f"""{S.ELEMENTS},
c as (select *, case when pos % 16 = 0 then 0 else 1 end as level, row_number() over (partition by doc_id order by pos) - 1 as local_id, count(*) filter (pos % 16 = 0) over (partition by doc_id order by pos) as part,
  max(case when pos % 16 = 0 then pos end) over (partition by doc_id order by pos) as part_pos from elements where pos % 16 in (0, 3, 9))"""
SQL["contents_nodes"] = f"""with {_CONTENTS_SQL}
select doc_id, local_id, level, case level when 0 then 'PARTE' else 'Capítulo' end as level_label, case level when 0 then split_part(text, ' ', 1) else split_part(text, ' ', 2) end as ordinal,
  case when level = 0 then text when contains(text, ' - ') then 'De la guerra' else text end as title, page_number - 2 as page_start, case when level = 1 then part_pos * 2 end as parent_pos,
  lpad(part::varchar, 2, '0') || case level when 1 then '.' || lpad((row_number() over (partition by doc_id, part order by pos) - 1)::varchar, 2, '0') else '' end as sort_key
from c"""


def contents_body(spark: SparkSession, sf: str) -> DataFrame:
    """Elements dealt to the contents' sections; without their first headings, the first of them go by page."""
    found = _contents(spark, sf)
    rows = contents.annotate(found, S.elements(spark, sf).filter("pos > 3"))
    return hierarchy.body(rows).select("doc_id", "pos", "local_id")


SQL["contents_body"] = f"""with {_CONTENTS_SQL},
e as (select *, level as own_level from (select *, case when pos % 16 = 0 then 0 when pos % 16 in (3, 9) then 1 end as level from elements) where pos > 3 and kind <> 'page_header' and trim(text) <> ''),
a as (select doc_id, k, page, {_KEY.replace('title', 'text')} as want from (select doc_id, text, page_number - 2 as page, row_number() over (partition by doc_id order by pos) as k from c) where k <= 50),
b as (select doc_id, pos, page_number, {_KEY.replace('title', 'text')} as have from e where kind = 'heading'),
m as (select a.doc_id, a.k, arg_min(b.page_number - a.page, b.pos) as off from a join b on a.doc_id = b.doc_id and (contains(have, want) or contains(want, have)) and page_number >= page group by a.doc_id, a.k),
o as (select doc_id, off from (select doc_id, off, count(*) as n, min(k) as k from m group by doc_id, off) qualify row_number() over (partition by doc_id order by n desc, k) = 1),
p as (select e.*, page_number - coalesce(off, 0) as printed from e left join o using (doc_id)),
h as (select p.doc_id, p.pos, arg_min(c.local_id, abs(p.printed - c.page_number + 2) * 100000 + c.local_id) as opened from p join c on c.doc_id = p.doc_id and c.level = p.level and split_part(c.text, ' ', p.level + 1) = split_part(p.text, ' ', p.level + 1) group by p.doc_id, p.pos)
select p.doc_id, p.pos, coalesce((select arg_max(opened, h.pos) from h where h.doc_id = p.doc_id and h.pos <= p.pos),
  (select arg_max(local_id, c.level * 100000 + local_id) from c where c.doc_id = p.doc_id and c.page_number - 2 <= p.printed)) as local_id
from p where not exists (select 1 from h where h.doc_id = p.doc_id and h.pos = p.pos)"""


def asof_page_node(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.elements(spark, sf).select("doc_id", F.col("page_number").alias("page")).distinct()
    return contents.page_node(pages, S.nodes(spark, sf))


SQL["asof_page_node"] = f"""with {S.CLASSIFIED}, p as (select distinct doc_id, page_number as page from elements)
select p.doc_id, p.page, arg_max(n.local_id, n.level * 100000 + n.local_id) as local_id from p left join parents n on n.doc_id = p.doc_id and n.page_number <= p.page group by p.doc_id, p.page"""


def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The texts are read twice: for their lengths, and for the query's own words; both are kept, as narrow tables."""
    docs = S.table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    query = search.parse("the of")
    sizes, _ = shared.stored(search.text_lengths(docs))
    indexed, _ = shared.stored(search.index(docs).filter(F.col("token").isin(search.words_of(query))))
    return search.bm25(indexed, query, 50, sizes=sizes).select("chunk_id", F.round("rank", 9).alias("rank"))


def bm25_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same through an index that is built for all words."""
    index = Index(spark, shared.folder(spark))
    index.apply(S.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text"))
    return index.top(search.parse("the of"), 50).select(F.col("key").alias("chunk_id"), F.round("rank", 9).alias("rank"))


_TOKENS = "tokens as (select doc_id as chunk_id, unnest(list_filter(regexp_split_to_array(translate(lower(text), 'áàâäãåéèêëíìîïóòôöõúùûüñçýÿ', 'aaaaaaeeeeiiiiooooouuuuncyy'), '[^\\pL\\pN]+'), lambda x: x <> '')) as token, generate_subscripts(list_filter(regexp_split_to_array(translate(lower(text), 'áàâäãåéèêëíìîïóòôöõúùûüñçýÿ', 'aaaaaaeeeeiiiiooooouuuuncyy'), '[^\\pL\\pN]+'), lambda x: x <> ''), 1) as pos from documents)"
SQL["bm25_topk"] = f"""with {_TOKENS},
s as (select chunk_id, count(*) as dl, count(*) filter (token = 'the') as a, count(*) filter (token = 'of') as b from tokens group by chunk_id),
t as (select count(*) as n, avg(dl) as avgdl, count(*) filter (a > 0) as da, count(*) filter (b > 0) as db from s)
select chunk_id, round(-(greatest(1e-6, ln((n - da + 0.5) / (da + 0.5))) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + greatest(1e-6, ln((n - db + 0.5) / (db + 0.5))) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) as rank
from s, t where a > 0 and b > 0 order by -(greatest(1e-6, ln((n - da + 0.5) / (da + 0.5))) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + greatest(1e-6, ln((n - db + 0.5) / (db + 0.5))) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl))), chunk_id limit 50"""
SQL["bm25_blocks"] = SQL["bm25_topk"]


def phrase_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    return search.hits(search.index(docs), search.parse('("of the" NOT NEAR("of the" and, 3)) OR "de la" AND (une OR NEAR(la en que, 6))'))


SQL["phrase_search"] = f"""with {_TOKENS},
two as (select a.chunk_id, a.token || ' ' || b.token as p, a.pos from tokens a join tokens b on a.chunk_id = b.chunk_id and b.pos = a.pos + 1 where a.token in ('of', 'de')),
near as (select distinct a.chunk_id from two a join tokens b on a.chunk_id = b.chunk_id and b.token = 'and' where p = 'of the' and (b.pos >= a.pos and b.pos - a.pos <= 5 or a.pos >= b.pos and a.pos - b.pos <= 4)),
w as (select chunk_id, token, pos from tokens where token in ('la', 'en', 'que')),
clump as (select distinct x.chunk_id from w x where (select count(distinct y.token) from w y where y.chunk_id = x.chunk_id and y.pos >= x.pos and y.pos - x.pos <= 7) = 3)
select distinct chunk_id from two where p = 'of the' and chunk_id not in (from near)
  or p = 'de la' and (chunk_id in (select chunk_id from tokens where token = 'une') or chunk_id in (from clump))"""


def search_excerpts(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    query = search.parse("the OR of OR und OR que")
    return docs.join(search.hits(search.index(docs), query), "chunk_id", "left_semi").select("chunk_id", search.excerpt(F.col("text"), query).alias("excerpt"))


SQL["search_excerpts"] = r"""with d as (select doc_id as chunk_id, regexp_split_to_array(regexp_replace(text, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g'), '[ \t\n\x0B\f\r]+') as ws from documents),
p as (select chunk_id, unnest(ws) as w, generate_subscripts(ws, 1) - 1 as spot from d),
h as (select *, list_distinct(list_filter(regexp_split_to_array(lower(w), '[^\pL\pN]+'), lambda x: x in ('the', 'of', 'und', 'que'))) as found from p),
e as (select chunk_id, spot, unnest(found) as word from h),
n as (select a.chunk_id, a.spot, count(distinct b.word) as n from (select distinct chunk_id, spot from e) a join e b on b.chunk_id = a.chunk_id and b.spot >= a.spot and b.spot < a.spot + 16 group by 1, 2),
best as (select chunk_id, spot as first from n qualify row_number() over (partition by chunk_id order by n desc, spot) = 1),
lasts as (select b.chunk_id, b.first, max(m) as last from best b join (select chunk_id, word, spot as m from e) x on x.chunk_id = b.chunk_id and m >= first and m < first + 16
  and not exists (select 1 from e y where y.chunk_id = x.chunk_id and y.word = x.word and y.spot >= first and y.spot < x.m) group by 1, 2),
s as (select chunk_id, greatest(0, first - ceil((16 - (last - first + 1)) / 2.0))::int as start from lasts)
select h.chunk_id, case when any_value(start) > 0 then '…' else '' end || string_agg(case when len(found) > 0 then '<mark>' || w || '</mark>' else w end, ' ' order by spot) filter (spot >= start and spot < start + 16) || case when max(spot) + 1 > any_value(start) + 16 then '…' else '' end as excerpt
from h join s on s.chunk_id = h.chunk_id group by h.chunk_id"""


def index_generations(spark: SparkSession, sf: str) -> DataFrame:
    """All texts, then the Spanish ones in capitals with another word and the German ones deleted, then merged."""
    docs = S.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text", "lang")
    index = Index(spark, shared.folder(spark))
    index.apply(docs)
    index.apply(docs.filter("lang = 'es'").select("key", F.concat(F.upper("text"), F.lit(" quetzal")).alias("text")))
    index.apply(docs.filter("lang = 'de'").select("key", F.lit(None).cast("string").alias("text")))
    before = index.hits(search.parse("quetzal OR der OR the")).select(F.lit("before").alias("stage"), F.col("key").alias("chunk_id"))
    before, _ = shared.stored(before)
    index.merge()
    return before.unionByName(index.top(search.parse("quetzal OR der OR the"), 1 << 30).select(F.lit("merged").alias("stage"), F.col("key").alias("chunk_id")))


SQL["index_generations"] = f"""with {_TOKENS}, h as (select distinct doc_id as chunk_id from documents left join tokens on chunk_id = doc_id where lang = 'es' or (lang is distinct from 'de' and token in ('der', 'the')))
select unnest(['before', 'merged']) as stage, chunk_id from h"""


def index_backfill(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "lang")
    have = search.index(docs.filter("lang = 'en'"))
    return search.index(search.stale(docs, have)).groupBy("chunk_id").agg(F.count("*").alias("n_tokens"))


SQL["index_backfill"] = f"with {_TOKENS}, h as (select distinct chunk_id from tokens join documents on doc_id = chunk_id where lang = 'en') select chunk_id, count(*) as n_tokens from tokens where chunk_id not in (select chunk_id from h) group by chunk_id"


def run_ref_iso(spark: SparkSession, sf: str) -> DataFrame:
    return S.runs(spark, sf).select("run_id", T.iso(F.col("started_at")).alias("started_iso"), T.run_ref(F.col("model"), F.col("mode"), F.col("started_at")).alias("run_ref"))


SQL["run_ref_iso"] = f"with {S.RUNS} select run_id, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') as started_iso, model || '--' || mode || '--' || strftime(started_at, '%Y%m%dT%H%M%SZ') as run_ref from runs"


def slug_version(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as codes; their sizes are the versions that files have."""
    slug = T.slug(F.concat(F.lit(" "), "p_brand", F.lit("_Ñ/"), "p_type", F.lit("--.")))
    name = F.concat(slug, F.lit("--2024010"), (F.col("p_partkey") % 9 + 1).cast("string"), F.lit("--v"), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ".json").otherwise(".json.gz"))
    return next_versions(S.table(spark, sf, "part").select(name.alias("name")))


SQL["slug_version"] = "select coalesce(nullif(regexp_replace(regexp_replace(lower(trim(' ' || p_brand || '_Ñ/' || p_type || '--.')), '[^a-z0-9._-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g'), ''), 'manual') as slug, max(p_size) + 1 as next_version from part group by 1"


def sha256_digest(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


SQL["sha256_digest"] = "select doc_id, sha256(text) as sha256 from documents"


def roman_to_int(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers spelled in roman digits by place, and read again; and a wrong spelling."""
    n = F.col("p_partkey") % 3999 + 1
    places = [F.element_at(F.array(*map(F.lit, digits.split(","))), (F.floor(n / 10**k) % 10 + 1).cast("int")) for k, digits in ((3, ",M,MM,MMM,,,,,,"), (2, ",C,CC,CCC,CD,D,DC,DCC,DCCC,CM"), (1, ",X,XX,XXX,XL,L,LX,LXX,LXXX,XC"), (0, ",I,II,III,IV,V,VI,VII,VIII,IX"))]
    return S.table(spark, sf, "part").select("p_partkey", T.roman_to_int(F.concat(*places)).alias("value"), T.roman_to_int(F.lower("p_name")).alias("of_name"))


SQL["roman_to_int"] = """with n as (select p_partkey, lower(p_name) as s from part),
v as (select p_partkey, list_transform(string_split(s, ''), lambda c: case c when 'i' then 1 when 'v' then 5 when 'x' then 10 when 'l' then 50 when 'c' then 100 when 'd' then 500 when 'm' then 1000 else 0 end) as v from n)
select p_partkey, (p_partkey % 3999 + 1)::int as value, list_sum(list_transform(v, lambda x, i: case when x < coalesce(v[i + 1], 0) then -x else x end))::int as of_name from v"""


def page_labels(spark: SparkSession, sf: str) -> DataFrame:
    return S.nodes(spark, sf).select("doc_id", "local_id", T.page_label(F.col("page_start"), F.col("page_end")).alias("label"))


SQL["page_labels"] = f"""with {S.CLASSIFIED}, e as (select doc_id, local_id, arg_max(page_number, pos) as page_end from body group by 1, 2)
select p.doc_id, p.local_id, case when e.page_end is null or e.page_end = p.page_number then 'p. ' || p.page_number else 'pp. ' || p.page_number || '-' || e.page_end end as label from parents p left join e using (doc_id, local_id)"""


def guess_code(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/data/x/"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("manual_dn m "), F.col("p_partkey").cast("string"))).otherwise(F.regexp_replace("p_name", " ", "-")), F.lit(".v2.pdf"))
    return S.table(spark, sf, "part").select("p_partkey", T.guess_code(F.regexp_replace(path, "_", " ")).alias("code"), T.guess_title(path).alias("title"), T.subject_hint(F.col("p_brand")).alias("subject"))


SQL["guess_code"] = """with p as (select p_partkey, p_brand, case when p_partkey % 2 = 0 then 'manual_dn m ' || p_partkey else replace(p_name, ' ', '-') end || '.v2' as stem from part)
select p_partkey, case when p_partkey % 2 = 0 then 'DN M ' || p_partkey else replace(stem, '_', ' ') end as code, trim(translate(stem, '_-', '  ')) as title, case when starts_with(upper(p_brand), 'CJM') then 'JUS_MIL' else 'OPS_MIL' end as subject from p"""

QUERIES = [toc_density_runs, toc_entries, toc_confidence, toc_gaps, page_offset_mode, asof_page_node, contents_nodes, contents_body, bm25_topk, bm25_blocks, phrase_search, search_excerpts, index_generations, index_backfill, run_ref_iso, slug_version, sha256_digest, roman_to_int, page_labels, guess_code]
