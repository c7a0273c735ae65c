"""Section texts and bounded, overlapping chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.functions.text import strip
from folium.operators.hierarchy import DEEPEST

# The fractions that can be put back, and how often.
ROMANS = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX", "XX"]
FRACTION = r"^([IVXLC]+)\s*(?:Bis|Ter|Quáter)?\.?\s*[-.]"
ARTICLE = r"^artículo\s+\d+"
MOVES = 10


@dataclass(frozen=True)
class Sizes:
    """Characters: beyond `most` a text is cut, into pieces of about `soft` that repeat `overlap`; below `merge` it goes up."""

    most: int = 2500
    soft: int = 2100
    overlap: int = 200
    merge: int = 500


DEFAULT = Sizes(1500, 1200, 120, 300)
MANUALS = Sizes()
LEGAL = Sizes(merge=0)


def sizes_for(profile: str) -> Sizes:
    """Legal genres keep every section to itself."""
    return MANUALS if profile.startswith("manual") else LEGAL


def reordered(parts: Column) -> Column:
    """Fractions that stand behind a later article go back behind the nearest lower fraction, MOVES times at most.

    One fold finds the first fraction to move: it keeps the last place of each fraction and of an article. What it finds
    is cut out and put back by slices, and the search begins anew.
    """
    romans = F.array(*map(F.lit, ROMANS))
    number = lambda x: F.array_position(romans, F.upper(F.regexp_extract(strip(x), "(?iU)" + FRACTION, 1))).cast("int")
    items = F.transform(parts, lambda x: F.struct(x.alias("text"), number(x).alias("value"), strip(x).rlike("(?iU)" + ARTICLE).alias("article")))
    none = F.lit(-1)

    def look(a: Column, x: Column) -> Column:
        lower = F.when(x["value"] >= 2, F.array_max(F.slice(a["last"], F.lit(1), F.greatest(x["value"] - 1, F.lit(1))))).otherwise(none)
        here = (a["at"] < 0) & (lower >= 0) & (a["article"] >= lower)
        last = F.when(x["value"] > 0, F.transform(a["last"], lambda e, k: F.when(k == x["value"] - 1, a["i"]).otherwise(e))).otherwise(a["last"])
        return F.struct((a["i"] + 1).alias("i"), last.alias("last"), F.when(x["article"], a["i"]).otherwise(a["article"]).alias("article"), F.when(here, a["i"]).otherwise(a["at"]).alias("at"), F.when(here, lower).otherwise(a["behind"]).alias("behind"))

    start = F.struct(F.lit(0).alias("i"), F.array_repeat(none, len(ROMANS)).alias("last"), none.alias("article"), none.alias("at"), none.alias("behind"))

    def move(x: Column) -> Column:
        def put(f: Column) -> Column:
            moved = F.concat(F.slice(x, F.lit(1), f["behind"] + 1), F.slice(x, f["at"] + 1, F.lit(1)), F.slice(x, f["behind"] + 2, f["at"] - f["behind"] - 1), F.slice(x, f["at"] + 2, F.size(x)))
            return F.when(f["at"] < 0, x).otherwise(moved)

        return F.element_at(F.transform(F.array(F.aggregate(x, start, look)), put), 1)

    mended = F.aggregate(F.sequence(F.lit(1), F.lit(MOVES)), items, lambda x, _: move(x))
    return F.transform(mended, lambda x: x["text"])


def parts_of(body: Column) -> Column:
    """The text parts of a section's elements (array of struct with kind and text), in order."""
    text = lambda x: (
        F.when(x["kind"].isin("heading", "title"), None)
        .when(x["kind"] == "table", F.concat(F.lit("\n[TABLA]\n"), F.coalesce(x["text"], F.lit("")), F.lit("\n[/TABLA]\n")))
        .when(F.coalesce(x["text"], F.lit("")) == "", None)
        .when(x["kind"] == "figure", F.concat(F.lit("[FIGURA: "), x["text"], F.lit("]")))
        .otherwise(x["text"])
    )
    return F.filter(F.transform(body, text), lambda x: x.isNotNull())


def section_text(parts: Column) -> Column:
    """Parts stripped, blank ones left out, joined by an empty line."""
    return F.array_join(F.filter(F.transform(parts, strip), lambda x: x != ""), "\n\n")


def gather(frame: DataFrame, body: str = "body") -> DataFrame:
    """Adds text, has_table and has_image_ref to rows with an array of elements; order is mended where it can be wrong:
    in the few sections that hold both an article and a fraction."""
    frame = frame.withColumn("_parts", parts_of(F.col(body)))
    doubtful = (F.size("_parts") >= 3) & F.exists("_parts", lambda x: strip(x).rlike("(?iU)" + ARTICLE)) & F.exists("_parts", lambda x: strip(x).rlike("(?iU)" + FRACTION))
    flags = {"has_table": F.exists(body, lambda x: x["kind"] == "table"), "has_image_ref": F.exists(body, lambda x: x["kind"] == "figure")}
    return frame.withColumns({"text": section_text(F.when(doubtful, reordered(F.col("_parts"))).otherwise(F.col("_parts")))} | flags).drop("_parts")


_BODY = "array<struct<pos:int, kind:string, text:string>>"


def merged(nodes: DataFrame, body: DataFrame, merge: int | Column = MANUALS.merge) -> DataFrame:
    """Nodes that keep text, with body, text and flags: texts shorter than `merge` have gone to their parents.

    Level by level from the deepest: a node's elements are its own, then those of the children that came up, the
    last child first. Annexes, and what came up to them, give nothing; nodes without text give nothing. Each level
    is one window over parents with their children, so the plan grows with the number of levels only.
    """
    own = body.filter("local_id is not null").groupBy("doc_id", "local_id").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "kind", "text"))).alias("body"))
    rows = nodes.join(own, ["doc_id", "local_id"], "left").withColumn("body", F.coalesce("body", F.expr(f"cast(array() as {_BODY})")))
    if isinstance(merge, int) and not merge:
        return gather(rows.filter("not is_anexo")).filter("text != ''")
    rows = rows.withColumn("_came", F.expr(f"cast(array() as array<struct<local_id:bigint, body:{_BODY}>>)"))
    for level in range(DEEPEST, -1, -1):
        last_first = F.flatten(F.transform(F.reverse(F.array_sort("_came")), lambda x: x["body"]))
        rows = rows.withColumn("body", F.when(F.col("level") == level, F.concat("body", last_first)).otherwise(F.col("body")))
        if not level:
            break
        rows = gather(rows.withColumn("_here", F.when(F.col("level") == level, F.col("body"))), "_here").drop("_here", "has_table", "has_image_ref")
        going = (F.col("level") == level) & ~F.col("is_anexo") & (F.col("text") != "") & (F.length("text") < merge) & F.col("parent_pos").isNotNull()
        rows = rows.withColumn("_going", F.coalesce(going, F.lit(False))).drop("text").withColumn("_key", F.when(F.col("_going"), F.col("parent_pos")).otherwise(F.col("pos")))
        family = Window.partitionBy("doc_id", "_key")
        came = F.collect_list(F.when(F.col("_going"), F.struct(F.col("local_id").cast("bigint").alias("local_id"), "body"))).over(family)
        rows = rows.withColumn("_came", F.concat("_came", came)).filter("not _going").drop("_going", "_key")
    return gather(rows.filter("not is_anexo")).filter("text != ''").drop("_came")


def pack(text: Column, sizes: Sizes = MANUALS) -> Column:
    """A text as an array of pieces. Paragraphs are packed up to `soft`; a single long one is never cut."""
    paragraphs = F.filter(F.split(text, "\n\n"), lambda p: strip(p) != "")
    start = F.struct(F.expr("cast(array() as array<string>)").alias("out"), F.lit("").alias("now"))

    def step(a, p):
        joined = F.concat(a["now"], F.lit("\n\n"), p)
        tail = F.when(F.lit(sizes.overlap > 0), F.concat(F.right(a["now"], F.lit(sizes.overlap)), F.lit("\n\n"), p)).otherwise(p)
        return (
            F.when(a["now"] == "", F.struct(a["out"].alias("out"), p.alias("now")))
            .when(F.length(a["now"]) + F.length(p) + 2 <= sizes.soft, F.struct(a["out"].alias("out"), joined.alias("now")))
            .otherwise(F.struct(F.array_append(a["out"], a["now"]).alias("out"), tail.alias("now")))
        )

    packed = F.aggregate(paragraphs, start, step, lambda a: F.when(a["now"] != "", F.array_append(a["out"], a["now"])).otherwise(a["out"]))
    return F.when(F.length(text) <= sizes.most, F.array(text)).otherwise(packed)


def chunks(sections: DataFrame, sizes: Sizes = MANUALS) -> DataFrame:
    """(doc_id, local_id, ordinal, text, char_count, page_start, page_end, has_table, has_image_ref) of sections."""
    last = F.when(F.col("page_end").isNull() | (F.col("page_end") == 0), F.col("page_start")).otherwise(F.col("page_end"))
    pieces = sections.select("doc_id", "local_id", "page_start", last.alias("page_end"), "has_table", "has_image_ref", F.posexplode(pack(F.col("text"), sizes)).alias("ordinal", "text"))
    return pieces.withColumn("char_count", F.length("text")).select("doc_id", "local_id", "ordinal", "text", "char_count", "page_start", "page_end", "has_table", "has_image_ref")
