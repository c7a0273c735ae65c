"""Tables of contents: which pages hold them, their entries, and how they fit the body."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.functions import headings
from folium.functions.text import is_roman_only, match_key, page_number, strip
from folium.operators import elements as E
from folium.operators.hierarchy import with_places

# How lines of contents, levels and depths look, and when pages count as contents.
ENTRY = r"(?iUd)^\s*(.+?)[.…\s]{3,}[.…]\s*(\d+|[ivxlcdm]+)\s*$"
LEADERS = "[.…]{2,}"
_NAMES = "Primera|Segunda|Tercera|Cuarta|Quinta|Sexta|S[eé]ptima|Octava|Novena|D[eé]cima"
PART = rf"(?iUd)^\s*({_NAMES})\s+PARTE\s*$"
MARKER = rf'(?iUd)^[\s\-–·]*(?:Cap[ií]tulo\s+[IVXLCDM]+|(?:{_NAMES}|[ÚU]nica)\s+Secci[oó]n|Secci[oó]n\s+(?:{_NAMES}|[ÚU]nica)|Subsecci[oó]n\s*\([A-Z]\)|(?:{_NAMES})\s+PARTE|Anexo\s*"?[A-Z]"?)\s*$'
DEPTHS = (
    (rf"(?iU)^\s*(?:{_NAMES})\s+parte\b", 0),
    (r"(?iU)^\s*cap[ií]tulo\b", 1),
    (rf"(?iU)^\s*(?:{_NAMES}|[uú]nica)\s+secci[oó]n\b", 2),
    (rf"(?iU)^\s*secci[oó]n\s+(?:{_NAMES}|[uú]nica)\b", 2),
    (r"(?iU)^[\s\-–·]*subsecci[oó]n\b", 3),
    (r"(?iU)^\s*anexo\b", 0),
)
MIN_LEADER_LINES, MIN_LEADER_SHARE, SCANNED_PAGES = 5, 0.2, 30
MIN_CONFIDENCE, MIN_ENTRIES = 0.4, 5


def page_runs(pages: DataFrame, scanned: int = SCANNED_PAGES) -> DataFrame:
    """(doc_id, first_page, last_page) of the first run of pages that look like contents, among the first pages.

    pages has doc_id, page (from 1) and text. Such a page has at least MIN_LEADER_LINES lines with leaders, and
    they are MIN_LEADER_SHARE of its lines at least.
    """
    lines = F.split("text", "\n")
    leaders = F.size(F.filter(lines, lambda x: x.rlike(LEADERS)))
    like = pages.filter(F.col("page") <= scanned).withColumn("_l", leaders).filter((F.col("_l") >= MIN_LEADER_LINES) & (F.col("_l") >= MIN_LEADER_SHARE * F.size(lines)))
    order = Window.partitionBy("doc_id").orderBy("page")
    runs = like.withColumn("_run", F.col("page") - F.row_number().over(order)).groupBy("doc_id", "_run").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    return runs.groupBy("doc_id").agg(F.min(F.struct("first_page", "last_page")).alias("r")).select("doc_id", "r.first_page", "r.last_page")


def infer_depth(title, line):
    """Depth by the kind that the title names, else by the line's indent, four blanks a level."""
    indent = F.length(line) - F.length(F.regexp_replace(line, r"(?U)^\s+", ""))
    out = F.least(F.floor(indent / 4).cast("int"), F.lit(4))
    for pattern, depth in reversed(DEPTHS):
        out = F.when(title.rlike(pattern), F.lit(depth)).otherwise(out)
    return out


def _lines(lines: DataFrame) -> DataFrame:
    bare = strip(F.col("text"))
    empty = (bare == "") | bare.rlike(r"(?U)^\d+$") | is_roman_only(bare)
    rows = lines.withColumns({"_s": bare, "_skip": empty})
    return rows.withColumns({"_part": ~F.col("_skip") & F.col("_s").rlike(PART), "_entry": ~F.col("_skip") & F.col("text").rlike(ENTRY)}).withColumn("_entry", F.col("_entry") & ~F.col("_part"))


def entries(lines: DataFrame) -> DataFrame:
    """(doc_id, line_number, n, title, page, depth) of the entries in contents lines (doc_id, pos, text).

    A line with a part's name is held until the next entry and comes before it, with its page and depth 0 and, if
    one of the next three lines is plain text, that as its title. Of the three lines with substance before an entry
    the nearest that names a level goes in front of its title and sets its depth.
    """
    rows = _lines(lines)
    order = Window.partitionBy("doc_id").orderBy("pos")
    ahead = None
    for k in (3, 2, 1):
        s = {c: F.lead(c, k).over(order) for c in ("_s", "_skip", "_part", "_entry")}
        usable = F.coalesce(~s["_skip"] & ~s["_part"], F.lit(False))
        here = F.when(usable & s["_entry"], F.lit("")).when(usable, s["_s"])
        ahead = here if ahead is None else F.coalesce(here, ahead)
    rows = rows.withColumn("_label", F.when(F.col("_part"), F.concat(F.upper(F.regexp_extract("_s", PART, 1)), F.lit(" PARTE"), F.when(F.coalesce(ahead, F.lit("")) != "", F.concat(F.lit(" — "), ahead)).otherwise(""))))
    # substance alone from here on: look back over it, and carry the pending part to the next entry
    rows = rows.filter(~F.col("_skip"))
    marker = F.coalesce(*(F.when(F.lag("_s", k).over(order).rlike(MARKER), F.lag("_s", k).over(order)) for k in (1, 2, 3)))
    since = order.rowsBetween(Window.unboundedPreceding, -1)
    last_entry = F.coalesce(F.max(F.when(F.col("_entry"), F.col("pos"))).over(since), F.lit(-1))
    part = F.max_by("_label", F.when(F.col("_part"), F.col("pos"))).over(since)
    part_at = F.max(F.when(F.col("_part"), F.col("pos"))).over(since)
    rows = rows.withColumns({"_marker": marker, "_pending": F.when(part_at > last_entry, part)}).filter("_entry")
    raw = F.regexp_replace(F.regexp_extract("text", ENTRY, 1), r"^[ \-·–\t]+|[ \-·–\t]+$", "")
    title = F.when(F.col("_marker").isNotNull(), F.concat("_marker", F.lit(" — "), raw)).otherwise(raw)
    depth = F.when(F.col("_marker").isNotNull(), infer_depth(F.col("_marker"), F.col("_marker"))).otherwise(infer_depth(raw, F.col("text")))
    own = F.struct(title.alias("title"), depth.cast("int").alias("depth"))
    both = F.when(F.col("_pending").isNotNull(), F.array(F.struct(F.col("_pending").alias("title"), F.lit(0).alias("depth")), own)).otherwise(F.array(own))
    rows = rows.select("doc_id", (F.col("pos") + 1).alias("line_number"), page_number(F.regexp_extract("text", ENTRY, 2)).alias("page"), F.posexplode(both).alias("n", "e"))
    return rows.select("doc_id", "line_number", "n", "e.title", "page", "e.depth")


def summary(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, n_entries, confidence, found): entries' share of the lines that could be entries, and whether it will do."""
    rows = _lines(lines)
    shares = rows.groupBy("doc_id").agg(F.count_if(~F.col("_skip") & ~F.col("_part")).alias("c"), F.count_if("_entry").alias("m"))
    n = found.groupBy("doc_id").agg(F.count("*").alias("n_entries"))
    out = shares.join(n, "doc_id", "left").select("doc_id", F.coalesce("n_entries", F.lit(0)).alias("n_entries"), (F.col("m") / F.greatest("c", F.lit(1))).alias("confidence"))
    return out.withColumn("found", (F.col("confidence") >= MIN_CONFIDENCE) & (F.col("n_entries") >= MIN_ENTRIES))


def as_nodes(found: DataFrame, profile: headings.Profile | None = headings.MANUAL) -> DataFrame:
    """Contents entries as sections: their titles' kind, or the label of their depth; places as in the body's tree.

    section_title is what follows the heading's name and number in the title, or the title without such a name.
    """
    rows = found.withColumn("pos", F.col("line_number") * 2 + F.col("n")).withColumn("h", headings.under(profile, lambda p: headings.classify(F.col("title"), p)))
    said = F.coalesce(F.nullif(F.col("h.remainder"), F.lit("")), headings.without_prefix(F.col("title")))
    rows = rows.withColumns({"level": F.coalesce("h.level", F.least("depth", F.lit(3))), "level_label": F.coalesce("h.label", headings.depth_label(F.col("depth"))), "ordinal": F.coalesce("h.ordinal", F.lit("")), "page_start": F.col("page"), "section_title": said, "is_anexo": F.coalesce("h.is_anexo", F.lit(False))})
    return with_places(rows).drop("h")


def found_in(elements: DataFrame) -> DataFrame:
    """The entries of documents in which a table of contents is found, with last_page, the last of the pages it stands on.

    It stands on the first run of pages that look like one. elements are lines with doc_id, pos, page_number and text;
    contents that are too short or unsure are no contents.
    """
    pages = elements.groupBy("doc_id", F.col("page_number").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("text"))
    runs = page_runs(pages)
    lines = elements.join(runs, "doc_id").filter(F.col("page_number").between(F.col("first_page"), F.col("last_page"))).select("doc_id", "pos", "text")
    said = entries(lines)
    sure = summary(lines, said).filter("found").select("doc_id")
    return said.join(sure, "doc_id", "left_semi").join(runs.select("doc_id", "last_page"), "doc_id")


def annotate(found: DataFrame, elements: DataFrame, profile: headings.Profile | None = headings.MANUAL) -> DataFrame:
    """Elements of documents with contents, dealt to the entries as sections: rows as hierarchy.annotate gives them.

    Entries are sections, the title being what follows the heading's name. An element that is the heading of an entry
    (the same name and number, and titles that agree) opens its section; of several entries that with the nearest
    page. Elements behind belong to the section opened last, those before the first to the deepest section that begins on
    their printed page or before. All other elements but furniture are body, headings that no entry names among them.
    Where found says on which page the contents end (last_page), nothing up to there opens a section.
    """
    if profile is None:
        found = found.join(elements.select("doc_id", "profile").distinct(), "doc_id")
    nodes = as_nodes(found, profile)
    heading = F.struct(F.lit("").alias("kind"), F.col("level").cast("int").alias("level"), F.col("level_label").alias("label"), "ordinal", F.lit("").alias("remainder"), F.col("is_anexo"))
    carried = ["profile"] * (profile is None)
    heads = nodes.select("doc_id", "pos", F.col("page_start").alias("page_number"), F.lit("heading").alias("kind"), F.col("title").alias("text"), heading.alias("heading"), F.col("section_title").alias("title"), F.col("level").cast("int").alias("level"), F.col("local_id"), "parent_pos", "sort_key", F.lit(None).cast("bigint").alias("owner"), F.lit(False).alias("is_body"), *carried)

    ahead = page_offset(found, elements)
    rows = E.kept(elements, profile).filter(~F.col("kind").isin(*E.FURNITURE)).withColumn("h", headings.under(profile, lambda p: headings.classify(F.col("text"), p)))
    if "last_page" in found.columns:
        ahead = found.groupBy("doc_id").agg(F.max("last_page").alias("last_page")).join(ahead, "doc_id", "left")
        rows = rows.join(ahead, "doc_id", "left").withColumn("h", F.when(F.col("page_number") > F.col("last_page"), F.col("h")))
    else:
        rows = rows.join(ahead, "doc_id", "left")
    rows = rows.withColumn("printed", F.col("page_number") - F.coalesce("offset", F.lit(0)))
    opens = rows.filter("h is not null").select("doc_id", "pos", "printed", F.col("h.label").alias("level_label"), F.col("h.ordinal").alias("ordinal"), match_key(F.col("h.remainder")).alias("own"))
    named = nodes.select("doc_id", "local_id", "level_label", "ordinal", "page_start", match_key(F.col("section_title")).alias("want"))
    agree = (F.col("own") == "") | (F.col("want") == "") | F.col("own").contains(F.col("want")) | F.col("want").contains(F.col("own"))
    met = opens.join(named, ["doc_id", "level_label", "ordinal"]).filter(agree)
    met = met.groupBy("doc_id", "pos").agg(F.min_by("local_id", F.struct(F.abs(F.col("printed") - F.col("page_start")), "local_id")).alias("opened"))
    rows = rows.join(met, ["doc_id", "pos"], "left")
    so_far = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("active", F.last("opened", ignorenulls=True).over(so_far))
    by_page = page_node(rows.filter("active is null").select("doc_id", F.col("printed").alias("page")).distinct(), nodes)
    rows = rows.join(by_page.select("doc_id", F.col("page").alias("printed"), F.col("local_id").alias("of_page")), ["doc_id", "printed"], "left")
    owner = F.coalesce("active", "of_page").cast("bigint")
    body = rows.filter("opened is null").select("doc_id", "pos", "page_number", "kind", "text", F.lit(None).cast(heads.schema["heading"].dataType).alias("heading"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("int").alias("level"), F.lit(None).cast(heads.schema["local_id"].dataType).alias("local_id"), F.lit(None).cast(heads.schema["parent_pos"].dataType).alias("parent_pos"), F.lit(None).cast("string").alias("sort_key"), owner.alias("owner"), F.lit(True).alias("is_body"), *carried)
    return heads.unionByName(body)


def page_offset(found: DataFrame, elements: DataFrame, first: int = 50) -> DataFrame:
    """(doc_id, offset): by how much body pages are ahead of printed ones; the commonest, of those the first entry's.

    Each of the first entries is looked for among the body's headings: equal or contained titles, the first heading
    that isn't before the printed page.
    """
    order = Window.partitionBy("doc_id").orderBy("line_number", "n")
    some = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= first).select("doc_id", "k", "page", match_key(F.col("title")).alias("want")).filter("want != ''")
    heads = elements.filter("kind = 'heading'").select("doc_id", "pos", "page_number", match_key(F.col("text")).alias("have")).filter("have != ''")
    met = some.join(heads, "doc_id").filter((F.col("have").contains(F.col("want")) | F.col("want").contains(F.col("have"))) & (F.col("page_number") >= F.col("page")))
    each = met.groupBy("doc_id", "k").agg(F.min_by(F.col("page_number") - F.col("page"), "pos").alias("offset"))
    counts = each.groupBy("doc_id", "offset").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    return counts.groupBy("doc_id").agg(F.min_by("offset", F.struct(-F.col("n"), "k")).alias("offset"))


def page_node(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, page, local_id): the deepest section that begins on a page or before; of equal ones the later.

    An as-of lookup without a join of ranges: sections and pages pass one window in the order of pages.
    """
    n = nodes.select("doc_id", F.col("page_start").alias("page"), F.struct("level", "local_id").alias("x"), F.lit(0).alias("is_page"))
    p = pages.select("doc_id", "page", F.lit(None).cast(n.schema["x"].dataType).alias("x"), F.lit(1).alias("is_page"))
    best = F.max("x").over(Window.partitionBy("doc_id").orderBy("page", "is_page").rowsBetween(Window.unboundedPreceding, 0))
    return n.unionByName(p).withColumn("b", best).filter("is_page = 1").select("doc_id", "page", F.col("b.local_id").alias("local_id")).distinct()
