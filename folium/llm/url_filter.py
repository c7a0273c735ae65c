"""URL filters: rules for hosts and paths, and for the rest two character models that rules' verdicts teach.

DataFrame and SQL functions only. Both models are variable-order Markov models over at most three characters of
context, smoothed by Witten-Bell interpolation with all shorter contexts. Characters fall into 40 classes, so
that a model has 40 ** 4 entries at most, however many URLs there are; that is the bound under which it is sent
to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.llm.scratch import Scratch
from folium.llm.suffix_dedup import text_id

#: (host, start of the path) -> verdict; a rule fits its host and all subdomains.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
ORDER = 3
CLASSES = 40
_KEPT = "abcdefghijklmnopqrstuvwxyz0/.-_?=&%:#~"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of the URLs that rules judge, those whose id leaves this remainder calibrate the threshold; the others teach.
FOLDS, CALIBRATES = 5, 0
#: Steps of the threshold's search, in units of log-likelihood per character.
GRAIN = 0.01


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case and the path; both empty for null and for urls without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), rules: dict[tuple[str, str], str] = RULES) -> DataFrame:
    """The columns `keep` with url, host, path, rule and the rule's verdict; rule and verdict are null where none fits.

    Of several rules that fit the longest wins, and of equally long ones the first in order.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(*keep, F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for (h, p), v in sorted(rules.items(), key=lambda x: (len(x[0][0] + x[0][1]), *(-ord(c) for c in x[0][0] + x[0][1]))):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def _grams(rows: DataFrame, *keep: str) -> DataFrame:
    """Every character of a url with its context: ORDER + 1 characters of the classed url, marked at both ends."""
    text = F.translate(F.coalesce("url", F.lit("")), f"{_UPPER}123456789", _LOWER + "0" * 9)
    text = F.regexp_replace(text, f"[^{_KEPT.replace('-', chr(92) + '-')}]", "*")
    # characters in an array, so that a gram costs the same anywhere in a long url
    rows = rows.select(*keep, F.split(F.concat(F.lit("^" * ORDER), text, F.lit("$")), "").alias("_t"))
    gram = f"concat({', '.join(f'_t[i + {k}]' for k in range(ORDER + 1))})"
    return rows.select(*keep, F.explode(F.expr(f"transform(sequence(0, array_position(_t, '$') - {ORDER + 1}), i -> {gram})")).alias("gram"))


def model(judged: DataFrame, own: Scratch) -> DataFrame:
    """For each gram of any url: the log of its last character's likelihood after the others, as accepted less as rejected.

    judged has url, verdict (allow or block; else it teaches nothing) and teaches.
    """
    counts = own.stored(_grams(judged.select("url", F.when(F.col("teaches"), F.col("verdict")).alias("verdict")), "verdict").groupBy("gram").agg(*(F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in ("allow", "block"))))
    table = counts.select("gram")
    for v in ("allow", "block"):
        table = table.withColumn(f"p_{v}", F.lit(1.0 / CLASSES))
    for k in range(ORDER + 1):
        # counts of the last k + 1 characters, and of the k before the last with how many others follow them
        short, context = F.expr(f"right(gram, {k + 1})"), F.expr(f"substring(gram, {ORDER + 1 - k}, {k})")
        sums = counts.groupBy(short.alias("s")).agg(*(F.sum(v).alias(f"n_{v}") for v in ("allow", "block")))
        around = sums.groupBy(F.expr(f"left(s, {k})").alias("x")).agg(*(f for v in ("allow", "block") for f in (F.sum(f"n_{v}").alias(f"all_{v}"), F.sum(F.expr(f"int(n_{v} > 0)")).alias(f"kinds_{v}"))))
        table = table.withColumns({"s": short, "x": context}).join(F.broadcast(sums), "s").join(F.broadcast(around), "x")
        for v in ("allow", "block"):
            table = table.withColumn(f"p_{v}", F.expr(f"if(all_{v} = 0, p_{v}, (n_{v} + kinds_{v} * p_{v}) / (all_{v} + kinds_{v}))"))
        table = table.select("gram", "p_allow", "p_block")
    return own.stored(table.select("gram", (F.ln("p_allow") - F.ln("p_block")).alias("ratio")))


def threshold(scored: DataFrame) -> float:
    """The score from which urls are accepted: where the calibrating urls of both verdicts are told apart best.

    Best is the greatest sum of both verdicts' shares that fall on their side; of several such places the one
    nearest to 0, then the smallest. The threshold lies halfway between the scores on both sides of that place.
    Without urls of both verdicts it is 0.
    """
    bins = scored.filter("calibrates").groupBy(F.floor(F.col("score") / GRAIN).alias("bin")).agg(*(F.count(F.when(F.col("ruled") == v, 1)).alias(v) for v in ("allow", "block")))
    # at most a few thousand bins: scores per character are logs of probabilities that smoothing bounds
    below = bins.selectExpr("bin", "coalesce((lag(bin) over (order by bin) + 1 + bin) / 2, bin) as cut", "sum(allow) over () as allows", "sum(block) over () as blocks", "coalesce(sum(allow) over (order by bin rows between unbounded preceding and 1 preceding), 0) as allow_below", "coalesce(sum(block) over (order by bin rows between unbounded preceding and 1 preceding), 0) as block_below")
    best = below.filter("allows > 0 and blocks > 0").selectExpr("bin", "cut", "round(block_below / blocks + 1 - allow_below / allows, 9) as told").orderBy(F.desc("told"), F.abs("bin"), "bin").first()
    return best["cut"] * GRAIN if best else 0.0


def judge(pages: DataFrame, url: str = "url", page_id: str = "page_id", rules: dict[tuple[str, str], str] = RULES) -> DataFrame:
    """Each row's id, host, path, rule, verdict and score (per character, as accepted less as rejected).

    Where a rule fits, its verdict holds; else allow if the score reaches the threshold. Null urls are scored as
    empty ones; null ids and repeated rows are rows like others; urls of any length are judged whole. Without rules
    that fit, scores and threshold are 0 and all is allowed; an empty table gives no rows. Other columns of pages,
    whatever their names, play no part.
    """
    with Scratch(pages.sparkSession) as own:
        return _judged(pages, url, page_id, rules, own)


def _judged(pages: DataFrame, url: str, page_id: str, rules: dict[tuple[str, str], str], own: Scratch) -> DataFrame:
    rows = ruled(pages, url, (page_id,), rules)
    fold = F.coalesce(F.pmod(F.col(page_id), F.lit(FOLDS)), F.lit(CALIBRATES + 1))
    judged = rows.select("url", F.col("ruled").alias("verdict"), (F.col("ruled").isNotNull() & (fold != CALIBRATES)).alias("teaches"))
    ratios = model(judged, own)
    # one score for each different url; a task's own characters are summed before anything moves, under a short key
    rows = rows.withColumn("of", text_id(F.col("url")))
    scores = _grams(rows.select("url", "of"), "of").join(F.broadcast(ratios), "gram").groupBy(F.col("of").alias("u")).agg(F.avg("ratio").alias("score"))
    calibrates = (F.col("ruled").isNotNull() & (fold == CALIBRATES)).alias("calibrates")
    rows = rows.join(scores, F.col("of") == F.col("u"), "left").select(page_id, "host", "path", "rule", "ruled", "score", calibrates)
    rows = own.keep(rows)
    limit = threshold(rows)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= limit, "allow").otherwise("block"))
    return rows.select(page_id, "host", "path", "rule", verdict.alias("verdict"), F.round("score", 9).alias("score"))
