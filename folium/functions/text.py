"""Text, numerals, codes and stamps. Built-in expressions only; white space and case follow Unicode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values of the roman digits.
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Stripped, with one blank for each run of white space."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def capitalize(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def is_roman_only(text: Column) -> Column:
    """Whether the text, blanks aside, is made of roman digits; 'mil' counts."""
    return F.replace(text, F.lit(" ")).rlike("(?i)^[ivxlcdm]+$")


def roman_to_int(text: Column) -> Column:
    """Subtractive value of roman digits, other letters counting 0; null for null."""
    values = F.create_map(*(F.lit(x) for pair in ROMAN.items() for x in pair))
    digits = F.filter(F.split(F.reverse(F.lower(text)), ""), lambda c: c != "")
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))

    def add(a, c):
        v = F.coalesce(F.try_element_at(values, c), F.lit(0))
        return F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), v.alias("last"))

    return F.when(text.isNotNull(), F.aggregate(digits, zero, add, lambda a: a["sum"]))


def page_number(text: Column) -> Column:
    """Arabic or roman page number."""
    clean = F.lower(strip(text))
    return F.coalesce(F.when(clean.rlike(r"^\d{1,9}$"), clean.try_cast("int")), roman_to_int(clean))


def slug(value: Column) -> Column:
    """Lower-case letters, digits and ._- only, other runs as one dash; 'manual' if nothing is left."""
    clean = F.regexp_replace(F.lower(strip(value)), "[^a-z0-9._-]+", "-")
    clean = F.regexp_replace(clean, r"^[-.]+|[-.]+$", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("manual"))


def iso(stamp: Column) -> Column:
    """UTC stamp to the second; null stays null. The session's time zone is to be UTC."""
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_ref(model: Column, mode: Column, started: Column) -> Column:
    return F.concat_ws("--", model, mode, F.translate(iso(started), "-:", ""))


def bundle_name(code: Column, day: Column, version: Column) -> Column:
    """{slug}--{yyyymmdd}--v{n}.json"""
    return F.concat(slug(code), F.lit("--"), F.date_format(day, "yyyyMMdd"), F.lit("--v"), version.cast("string"), F.lit(".json"))


def option_key(text: Column) -> Column:
    """What two options' texts are compared by in bundles: white space collapsed, lower case."""
    return F.lower(collapse(text))


def draft_option_key(text: Column) -> Column:
    """What two options' texts are compared by in drafts: stripped, lower case."""
    return F.lower(strip(text))


def without_options(question: Column) -> Column:
    """A drafted question up to the first inline option A-D."""
    return strip(F.split(question, r"(?iU)\b[A-D][.)]\s", 2)[0])


def cited(option: Column, text: Column) -> Column:
    """Whether the option's words stand literally in the text, whatever the white space."""
    return F.contains(collapse(text), collapse(option))


def page_label(first: Column, last: Column) -> Column:
    return F.when(last.isNull() | (last == first), F.concat(F.lit("p. "), first.cast("string"))).otherwise(F.concat(F.lit("pp. "), first.cast("string"), F.lit("-"), last.cast("string")))


def preview(text: Column, size: int = 400) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("…"))).otherwise(text)


def stem(path: Column) -> Column:
    """File name without folders and last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def guess_code(path: Column) -> Column:
    """A code like 'DN M 1455' in the file name, upper case, else the stem."""
    found = F.regexp_extract(stem(path), r"(?i)\b(DN\s*M\s*\d+)", 1)
    return F.coalesce(F.nullif(F.upper(found), F.lit("")), stem(path))


def guess_title(path: Column) -> Column:
    return strip(F.translate(stem(path), "_-", "  "))


def subject_hint(code: Column) -> Column:
    return F.when(F.upper(code).startswith("CJM"), F.lit("JUS_MIL")).otherwise(F.lit("OPS_MIL"))


def safe_int(value: Column) -> Column:
    """The whole number, or 0 where there is none."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def match_key(title: Column) -> Column:
    """Titles as they are compared across contents and body: lower case, no punctuation, one blank between words."""
    return collapse(F.translate(F.lower(title), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~—·", ""))


def shown_page(page: Column, pages: Column) -> Column:
    """The page index to show for a page number: inside the document, from 0."""
    return F.greatest(F.lit(0), F.least(page - 1, pages - 1))
