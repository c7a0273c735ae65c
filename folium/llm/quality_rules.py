"""Quality rules judged by host: how often its documents fail, shrunk to what is usual, decides for all of them.

DataFrame and SQL functions only. What each text shows is computed in one pass over the texts and kept as a
narrow table; hosts are counted with partial sums, so that one large host is no burden.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import free_names
from folium.llm.scratch import Scratch

#: The rules, each true where a document fails it.
RULES = {
    "too_short": "n_words < 10",
    "repetitive": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "same_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_words": "word_chars < 3 * n_words or word_chars > 12 * n_words",
}
#: A host whose shrunk failure rate of any rule is higher is rejected.
MAX_RATE = 0.5
#: Bounds of the prior's weight, in documents.
MIN_WEIGHT, MAX_WEIGHT = 2.0, 1000.0
WINDOW = 5


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The columns `keep` with n_words, n_lines, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text.

    Words are what stands between the bytes 0x20 and 0x09-0x0D, lines what stands between \\n. n_lines counts
    lines with a word; n_repeat_words counts words that lie in a run of five that the text holds twice or more.
    Null and empty texts have none of anything.
    """
    rows = docs.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = rows.selectExpr(
        *kept,
        r"array_remove(split(t, '[ \\x09-\\x0D]+'), '') as w",
        r"filter(split(t, '\n'), x -> x rlike '[^ \\x09-\\x0D]') as l",
        r"length(translate(t, ' \t\n\u000b\u000c\r', '')) as word_chars",
        "length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols",
    )
    counts = ["size(w) as n_words", "size(l) as n_lines", "word_chars", "n_symbols", "size(l) - size(array_distinct(l)) as n_dup_lines"]
    rows = rows.selectExpr(*kept, *counts, "transform(w, x -> xxhash64(x)) as h")
    carried = [*kept, "n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines"]
    rows = rows.selectExpr(*carried, f"if(n_words < {WINDOW}, array(), transform(slice(h, 1, n_words - {WINDOW - 1}), (x, i) -> xxhash64(x, {', '.join(f'h[i + {k}]' for k in range(1, WINDOW))}))) as g")
    # only texts in which a run comes again need its places
    rows = rows.selectExpr(*carried, "if(size(array_distinct(g)) = size(g), null, sort_array(transform(g, (x, i) -> struct(x as h, i as i)))) as s")
    rows = rows.selectExpr(*carried, "sort_array(transform(filter(s, (x, k) -> x.h <=> get(s, k - 1).h or x.h <=> get(s, k + 1).h), x -> x.i)) as p")
    repeated = f"coalesce(aggregate(p, struct(-{WINDOW} as last, 0 as n), (a, i) -> struct(i as last, a.n + least({WINDOW}, i - a.last) as n), a -> a.n), 0)"
    names = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines"]
    return rows.selectExpr(*(f"{k} as `{c}`" for k, c in zip(kept, keep, strict=True)), *(f"cast({c} as long) as {c}" for c in names), f"cast({repeated} as long) as n_repeat_words")


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Of each host and rule: documents, failures and the failure rate, shrunk by a beta prior fitted to all hosts.

    The prior has the mean of the hosts' rates; its weight follows from their variance, within bounds (the upper
    one if all rates are equal or there is one host). A null host is a host too.
    """
    # sums by host first, one row each; then the few sums by rule
    wide = measured.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *(F.sum(F.expr(f"int({v})")).alias(k) for k, v in RULES.items()))
    long = wide.selectExpr("host", "n", "stack({}, {}) as (rule, failed)".format(len(RULES), ", ".join(f"'{k}', {k}" for k in RULES)))
    prior = long.groupBy("rule").agg(F.avg(F.expr("failed / n")).alias("mean"), F.coalesce(F.var_pop(F.expr("failed / n")), F.lit(0.0)).alias("spread"))
    weight = f"case when spread <= 1e-12 then {MAX_WEIGHT} else greatest({MIN_WEIGHT}, least({MAX_WEIGHT}, mean * (1 - mean) / spread - 1)) end"
    prior = prior.selectExpr("rule", "mean", f"{weight} as weight")
    return long.join(F.broadcast(prior), "rule").selectExpr("host", "rule", "n", "failed", "(failed + mean * weight) / (n + weight) as rate")


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] = ("doc_id",), max_rate: float = MAX_RATE) -> DataFrame:
    """Each row's `keep` columns, host, measures, host_rate (its host's worst), base_failed and kept.

    base_failed: fewer than ten words, or more than a fifth of the words in repeated runs of five. kept is false
    for those, and for all documents of hosts that fail a rule at a shrunk rate over max_rate. Rows with null ids,
    texts or hosts and repeated rows are judged like others, texts of any length are judged whole, and no rows give
    none. Of the new columns, those whose names are among the kept ones get underscores; other columns play no part.
    """
    columns = tuple(dict.fromkeys((*keep, host)))
    inside = tuple(f"c{k}" for k in range(len(columns)))
    own = Scratch(docs.sparkSession)
    measured = own.keep(measures(docs.select(*(F.col(c).alias(k) for c, k in zip(columns, inside, strict=True)), F.col(text).alias("text")), "text", inside))
    its_host = inside[columns.index(host)]
    # a small table of known size: the planner sends it to all tasks while it is small, else splits large hosts
    verdicts = own.keep(host_rates(measured, its_host).groupBy("host").agg(F.max("rate").alias("host_rate")))
    rows = measured.join(verdicts, F.col(its_host).eqNullSafe(F.col("host")), "left").drop("host")
    failed = F.expr(f"({RULES['too_short']}) or ({RULES['repetitive']})")
    rows = rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_rate))
    return rows.toDF(*columns, *free_names(columns, rows.columns[len(columns) :]))
