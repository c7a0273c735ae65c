"""Section trees from flat elements, by window functions over each document.

All windows share one partitioning and order, so a corpus needs one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from folium.functions import headings
from folium.functions.text import strip
from folium.operators import elements as E

#: Levels that headings can have: 0 to this.
DEEPEST = 4
#: A following text is a title only up to this length.
LONGEST_TITLE = 200


def _doc() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("pos")


def _before() -> WindowSpec:
    return _doc().rowsBetween(Window.unboundedPreceding, -1)


def _so_far() -> WindowSpec:
    return _doc().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_places(rows: DataFrame, level: str = "level") -> DataFrame:
    """Rows (doc_id, pos, level; null off headings) with local_id, parent_pos and sort_key of each heading.

    The parent is the nearest earlier heading of a lower level. sort_key counts headings of each level since the
    last lower one, two digits a level.
    """
    depth = range(DEEPEST + 1)
    lower = {k: F.max(F.when(F.col(level) < k, F.col("pos"))).over(_before()) for k in depth}
    count = {k: F.count(F.when(F.col(level) == k, 1)).over(_so_far()) for k in depth}
    rows = rows.withColumns({f"_c{k}": count[k] for k in depth} | {f"_p{k}": lower[k] for k in depth} | {"local_id": (F.count(level).over(_so_far()) - 1)})
    since = {k: F.coalesce(F.last(F.when(F.col(level) < k, F.col(f"_c{k}")), ignorenulls=True).over(_so_far()), F.lit(0)) for k in depth}
    rows = rows.withColumns({f"_s{k}": since[k] for k in depth})
    parent = F.lit(None).cast("int")
    for k in depth:
        parent = F.when(F.col(level) == k, F.col(f"_p{k}")).otherwise(parent)
    number = {k: F.col(f"_c{k}") - F.col(f"_s{k}") for k in depth}
    digits = {k: F.when(number[k] < 10, F.concat(F.lit("0"), number[k].cast("string"))).otherwise(number[k].cast("string")) for k in depth}
    wide = F.concat_ws(".", *(F.when(F.col(level) >= k, digits[k]) for k in depth))
    heading = F.col(level).isNotNull()
    rows = rows.withColumns({"parent_pos": F.when(heading, parent), "sort_key": F.when(heading, wide)})
    return rows.drop(*(f"_{x}{k}" for x in "cps" for k in depth))


def annotate(elements: DataFrame, profile: headings.Profile | None = headings.MANUAL) -> DataFrame:
    """Kept elements with heading (struct or null), title, owner (local_id of the heading they belong to) and places.

    A heading without a title on its line takes the next kept element's text, unless that is a heading, longer than
    LONGEST_TITLE or an article; that element stays body text as well. Page furniture is neither heading nor body,
    but can be a title. Elements before the first heading have no owner. With None as the profile each document is read
    under the one that its column `profile` names, all in the same pass.
    """
    furniture = F.col("kind").isin(*E.FURNITURE)
    rows = E.kept(elements, profile).withColumn("heading", headings.under(profile, lambda p: headings.classify(F.col("text"), p)))
    # classified once: behind the shuffle that all windows share
    rows = rows.withColumns({"_next": F.lead("text").over(_doc()), "_next_is": F.lead(F.col("heading").isNotNull()).over(_doc())})
    rows = rows.withColumn("heading", F.when(~furniture, F.col("heading")))
    ahead = strip(F.col("_next"))
    usable = ~F.col("_next_is") & (F.length(ahead) <= LONGEST_TITLE) & ~F.lower(ahead).startswith("artículo")
    title = F.when(F.col("heading.remainder") != "", F.col("heading.remainder")).otherwise(F.when(usable, ahead).otherwise(""))
    rows = rows.withColumns({"title": F.when(F.col("heading").isNotNull(), F.coalesce(title, F.lit(""))), "level": F.col("heading.level")})
    rows = with_places(rows)
    owner = F.last(F.when(F.col("heading").isNotNull(), F.col("local_id")), ignorenulls=True).over(_so_far())
    return rows.withColumns({"owner": owner, "is_body": F.col("heading").isNull() & ~furniture}).drop("_next", "_next_is")


def nodes(annotated: DataFrame, profile: headings.Profile | None = headings.MANUAL) -> DataFrame:
    """One row a heading, with parent, breadcrumb, pages and annotations.

    page_end is the page of the last body element, null without one. Notes of body elements come in order.
    """
    found = annotated.filter("heading is not null").select("doc_id", "pos", "local_id", "parent_pos", "sort_key", "level", F.col("heading.label").alias("level_label"), F.col("heading.ordinal").alias("ordinal"), "title", F.col("heading.is_anexo").alias("is_anexo"), F.col("page_number").alias("page_start"))
    notes = headings.under(profile, lambda p: headings.noted(F.col("text"), p))
    body = annotated.filter("is_body and owner is not null").groupBy("doc_id", F.col("owner").alias("local_id")).agg(
        F.max_by("page_number", "pos").alias("page_end"),
        F.count("*").alias("n_body"),
        F.transform(F.array_sort(F.collect_list(F.when(F.size(notes) > 0, F.struct("pos", F.map_entries(notes).alias("note"))))), lambda x: F.map_from_entries(x["note"])).alias("annotations"),
    )
    found = found.join(body, ["doc_id", "local_id"], "left").withColumns({"n_body": F.coalesce("n_body", F.lit(0)), "annotations": F.coalesce("annotations", F.expr("cast(array() as array<map<string,string>>)"))})
    own = F.concat(strip(F.concat_ws(" ", "level_label", "ordinal")), F.when(F.col("title") != "", F.concat(F.lit(" — "), F.col("title"))).otherwise(""))
    found = found.withColumn("breadcrumb", own)
    # one heading of each level at most stands above another: their own labels, by level, in one pass
    levels = range(DEEPEST + 1)
    last = {k: F.last(F.when(F.col("level") == k, F.struct("pos", F.col("breadcrumb").alias("b"))), ignorenulls=True).over(_before()) for k in levels}
    found = found.withColumns({f"_a{k}": last[k] for k in levels})
    above = []
    for k in reversed(levels):
        # an ancestor of level k is no older than the newest heading of a lower level
        lower = F.greatest(F.lit(-1), *(F.coalesce(F.col(f"_a{j}.pos"), F.lit(-1)) for j in levels if j < k)) if k else F.lit(-1)
        above.insert(0, F.when((F.col("level") > k) & (F.col(f"_a{k}.pos") > lower), F.col(f"_a{k}.b")))
    return found.withColumn("breadcrumb", F.concat_ws(" › ", *above, "breadcrumb")).drop(*(f"_a{k}" for k in levels))


def body(annotated: DataFrame) -> DataFrame:
    """(doc_id, local_id, pos, page_number, kind, text) of body elements; local_id null before the first heading."""
    return annotated.filter("is_body").select("doc_id", F.col("owner").alias("local_id"), "pos", "page_number", "kind", "text")
