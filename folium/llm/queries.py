"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.llm import bpe, divergence, filter_audit, language_id, lm_scoring, mixing, near_dedup, nearest, quality_model, quality_rules, scratch, sharding, url_filter
from folium.llm.suffix_dedup import without_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_vocabulary() -> str:
    """The public word-end vocabulary that is installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.group(_table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scoring.score(docs, language_id.fold(F.col("doc_id"), 5) == 1, word_vocabulary())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(*columns)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language_id.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    samples = language_id.dictionaries(docs.filter(~held_out))
    return language_id.identify(docs, samples).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = sharding.ShardStore(spark, scratch.folder(spark))
    docs = _table(spark, sf_dir, "documents")
    store.append(docs, sharding.arrival_of(F.col("doc_id")), F.octet_length(F.coalesce("text", F.lit(""))))
    store.compact()
    return store.read().select("doc_id", "shard", "n_bytes")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(_table(spark, sf_dir, "documents"), word_vocabulary()))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # whole documents are exploded and shuffled; the digest is of the text that arrives
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"), "copy", "copies", "place")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(language_id.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = quality_model.score(docs, labels, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = filter_audit.failures(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audit(flags, "ABCDE")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_near_dedup, op3_url_filter, op4_lm_scores, op5_quality_rules, op6_language_id, op7_sharding, op8_nearest, op9_bpe, op10_source_mix, op11_source_divergence, op12_quality_model, op13_filter_audit)}


def _url_sql() -> str:
    """The URL filter, one step for each length of context."""
    order, both = url_filter.ORDER, ("allow", "block")
    steps = [f"p0 as (select gram, {', '.join(f'1.0 / {url_filter.CLASSES}::double as p_{v}' for v in both)} from counts)"]
    for k in range(order + 1):
        steps.append(f"s{k} as (select right(gram, {k + 1}) as s, {', '.join(f'sum({v}) as n_{v}' for v in both)} from counts group by 1)")
        steps.append(f"a{k} as (select left(s, {k}) as x, {', '.join(f'sum(n_{v}) as all_{v}, count(*) filter (n_{v} > 0) as kinds_{v}' for v in both)} from s{k} group by 1)")
        smooth = ", ".join(f"case when all_{v} = 0 then p_{v} else (n_{v} + kinds_{v} * p_{v}) / (all_{v} + kinds_{v}) end as p_{v}" for v in both)
        steps.append(f"p{k + 1} as (select gram, {smooth} from p{k} join s{k} on s = right(gram, {k + 1}) join a{k} on x = substr(gram, {order + 1 - k}, {k}))")
    rules = " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}|{v}'" for (h, p), v in sorted(url_filter.RULES.items(), key=lambda x: -len("".join(x[0]))))
    return f"""
with u as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
j as (select *, case {rules} end as j from h),
r as (select row_number() over () as r, page_id, url, host, path, string_split(j, '|')[1] as rule, string_split(j, '|')[2] as ruled, coalesce(page_id % 5, 1) = 0 as fold from j),
t as (select r, ruled, fold, '^^^' || regexp_replace(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0/.\\-_?=&%:#~]', '*', 'g') || '$' as t from r),
g as (select r, ruled, fold, substr(t, i, 4) as gram from (select *, unnest(range(1, length(t) - 2)) as i from t)),
counts as (select gram, count(*) filter (not fold and ruled = 'allow') as allow, count(*) filter (not fold and ruled = 'block') as block from g group by gram),
{", ".join(steps)},
scores as (select r, avg(ln(p_allow) - ln(p_block)) as score from g join p{order + 1} using (gram) group by r),
bins as (select floor(score / 0.01)::bigint as bin, count(*) filter (ruled = 'allow') as allow, count(*) filter (ruled = 'block') as block from scores join r using (r) where fold and ruled is not null group by 1),
sums as (select bin, coalesce((lag(bin) over (order by bin) + 1 + bin) / 2, bin) as cut, sum(allow) over () as allows, sum(block) over () as blocks, coalesce(sum(allow) over (order by bin rows between unbounded preceding and 1 preceding), 0) as a, coalesce(sum(block) over (order by bin rows between unbounded preceding and 1 preceding), 0) as b from bins),
best as (select cut * 0.01::double as cut from sums where allows > 0 and blocks > 0 order by round(b / blocks + 1 - a / allows, 9) desc, abs(bin), bin limit 1)
select page_id, host, path, rule, coalesce(ruled, case when score >= coalesce((select cut from best), 0) then 'allow' else 'block' end) as verdict, round(score, 9) as score
from r join scores using (r)
"""


_QUALITY_SQL = r"""
with t as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select r, list_filter(regexp_split_to_array(t, '[ \x09-\x0D]+'), lambda x: x <> '') as w from t),
m as (
  select t.r, doc_id, source, len(w) as n_words, length(regexp_replace(t, '[ \x09-\x0D]+', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) as l
  from t join w using (r)
),
g as (
  select r, i, array_to_string(list_slice(w, i, i + 4), chr(1)) as g
  from (select r, w, unnest(generate_series(1, len(w) - 4)) as i from w where len(w) >= 5)
),
p as (select r, i from (select r, i, count(*) over (partition by r, g) as c from g) where c > 1),
q as (select r, sum(least(5, i - before)) as n from (select r, i, coalesce(lag(i) over (partition by r order by i), -9) as before from p) group by r),
d as (
  select m.r, doc_id, source, n_words, word_chars, n_symbols, len(l) as n_lines,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(q.n, 0)::bigint as n_repeat_words
  from m left join q using (r)
),
f as (
  select *, [n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > word_chars,
    10 * n_dup_lines > 3 * n_lines, word_chars < 3 * n_words or word_chars > 12 * n_words] as fails from d
),
h as (select source, rule, count(*) as n, sum(fails[rule]::int) as failed from f, (select unnest([1, 2, 3, 4, 5]) as rule) group by source, rule),
prior as (select rule, avg(failed / n) as mean, var_pop(failed / n) as spread from h group by rule),
weights as (select rule, mean, case when spread <= 1e-12 then 1000 else greatest(2, least(1000, mean * (1 - mean) / spread - 1)) end as weight from prior),
hosts as (select source, max((failed + mean * weight) / (n + weight)) as host_rate from h join weights using (rule) group by source)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words,
  fails[1] or fails[2] as base_failed, not (fails[1] or fails[2]) and host_rate <= 0.5 as kept
from f join hosts on f.source is not distinct from hosts.source
"""

_SHARDS_SQL = f"""
with a as (select coalesce(doc_id // {sharding.ARRIVAL_ROWS}, -1) as arrival, sum(strlen(coalesce(text, ''))) as size, count(*) as n from documents group by 1),
t as (select *, floor(log2(greatest(size, 1)) / 2) as tier, floor(arrival / {sharding.SPAN}.0) as span from a where size < {sharding.TARGET_BYTES // 2}),
g as (select *, (coalesce(sum(size) over (partition by tier, span order by arrival rows between unbounded preceding and 1 preceding), 0) // {sharding.TARGET_BYTES})::bigint as part from t),
m as (select tier, span, part, min(arrival) as first, max(arrival) as last, count(*) as runs from g group by tier, span, part),
s as (select arrival, case when runs > 1 then first || '-' || last || '-t' || tier::int || '-v2' else arrival || '-v1' end as shard from g join m using (tier, span, part)
      union all select arrival, arrival || '-v1' from a where size >= {sharding.TARGET_BYTES // 2})
select doc_id, shard, strlen(coalesce(text, ''))::bigint as n_bytes from documents join s on coalesce(doc_id // {sharding.ARRIVAL_ROWS}, -1) = arrival
"""

_MIX_SQL = """
with e as (select row_number() over () as i, *, md5(concat_ws(chr(31), coalesce('v' || doc_id::varchar, 'n'), coalesce('v' || text, 'n'), coalesce('v' || lang, 'n'), coalesce('v' || source, 'n'), coalesce('v' || n_chars::varchar, 'n'))) as digest from documents),
d as (select *, digest || ':' || case when count(*) over (partition by digest) = 1 then 0 else row_number() over (partition by digest order by i) end as key from e),
s as (select source, count(*) as n, sqrt(count(*)) as w from documents group by source),
r as (select source, (w / sum(w) over ()) * (sum(n) over ())::double / n as rate from s),
parts as (select source, rate, greatest(1, ceil(rate / 100.0))::int as parts, rate / greatest(1, ceil(rate / 100.0)) as m from r),
steps as (select source, rate, parts, m, unnest(range(0, ceil(m + 12 * sqrt(m) + 20)::int + 1)) as k from parts),
logs as (select *, sum(case when k = 0 then -m else ln(m / k) end) over (partition by source order by k) as p from steps where m > 0),
cdf as (select source, k, parts, sum(exp(p)) over (partition by source order by k) as c from logs),
u as (
  select i, d.source, part, ('0x' || substr(md5('0:' || key || ':' || part), 1, 13))::bigint / 4503599627370496.0 as u
  from d join (select source, unnest(range(1, parts + 1)) as part from parts) x on d.source is not distinct from x.source
),
counts as (select i, sum((select count(*) from cdf where cdf.source is not distinct from u.source and cdf.c <= u.u))::int as copies from u group by i)
select doc_id, source, n_chars, sha256(text) as text_sha256, copy::int as copy, copies, ('0x' || substr(md5('place 0:' || key || ':' || copy), 1, 15))::bigint as place
from d join (select i, copies, unnest(range(1, copies + 1)) as copy from counts) using (i)
"""


_DIVERGENCE_SQL = """
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term from w group by all having count(distinct r) >= 10),
c as (select lang, source, term, count(*) as n from w join k using (lang, term) group by all),
g as (select distinct lang, source from d),
dense as (select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
ps as (select lang, source, term, n, (1 + 1000000000 * (n + 2) // (sum(n) over w + 2 * count(*) over w))::hugeint as p from dense window w as (partition by lang, source)),
whole as (select lang, term, sum(n)::hugeint as n from dense group by all),
qs as (select lang, term, (1 + 1000000000 * (n + 2) // (sum(n) over w + 2 * count(*) over w))::hugeint as q from whole window w as (partition by lang)),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint as value
  from ps a join ps b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sums.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source),
terms as (select ps.lang, ps.source, 'term' as part, ps.term as item, ((p - q) * (p - q) // (p + q))::bigint as value
  from ps join qs on ps.lang = qs.lang and ps.term = qs.term where n > 0 and p > q)
select lang, source, part, item, value, rank::int as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (from pairs union all from terms))
where part = 'pair' or rank <= 10
"""

_AUDIT_SQL = """
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[ \x09-\x0D]+'), lambda x: x <> '') as w, min(doc_id) over (partition by t) as first from t),
f as (
  select doc_id, part, case when len(w) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
    || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when first < doc_id then 'E' else '' end as fails
  from w
),
l as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by doc_id),
m as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f left join l on f.doc_id = l.doc_id group by part, fails),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select a.x || b.x || c.x || d.x || e.x as o from x a, x b, x c, x d, x e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select o, step::int as step, substr(o, step, 1) as letter, string_split(left(o, step - 1), '') as earlier from o, range(1, 6) r(step)),
j as (select m.*, o, step, letter, contains(fails, letter) as here, list_has_any(earlier, string_split(fails, '')) and fails <> '' and step > 1 as gone from m, s),
counts as (
  select part, o as filter_order, step, letter, coalesce(sum(n) filter (not gone and not here), 0)::bigint as kept,
    coalesce(sum(n) filter (not gone and here), 0)::bigint as removed, coalesce(sum(n) filter (gone and here), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails = letter), 0)::bigint as unique_fails, coalesce(sum(good) filter (not gone and here), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (not gone and here), 0)::bigint as toxic_lost
  from j group by part, o, step, letter
)
select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint as shapley from counts
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": _url_sql(), "op5_quality_rules": _QUALITY_SQL, "op7_sharding": _SHARDS_SQL, "op10_source_mix": _MIX_SQL, "op11_source_divergence": _DIVERGENCE_SQL, "op13_filter_audit": _AUDIT_SQL}
