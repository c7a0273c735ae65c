"""Ranked full-text search: an inverted index as a table, conjunctive and phrase queries, BM25, excerpts."""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.text import strip

# Assumption: the usual constants, and a floor for words that most texts hold.
K1, B, FLOOR = 1.2, 0.75, 1e-6


def _accented() -> dict[str, str]:
    """Each lower-case Latin letter that decomposes into one of a-z and marks, with that letter."""
    parts = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if chr(c).islower()}
    return {c: d[0] for c, d in parts.items() if len(d) > 1 and d[0].isascii() and all(map(unicodedata.combining, d[1:]))}


ACCENTED, PLAIN = "".join(_accented()), "".join(_accented().values())


def fold(text: Column) -> Column:
    """Lower case without accents, whether they are part of a letter or marks behind it."""
    return F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{Mn}+", "")


def tokens(text: Column) -> Column:
    """Runs of letters and digits, folded."""
    return F.array_remove(F.split(fold(text), r"(?U)[^\p{L}\p{N}]+"), "")


def token_places(text: Column) -> Column:
    """Each token of a text once, with its places in order: array of struct (token, at)."""
    ordered = F.sort_array(F.transform(tokens(text), lambda t, i: F.struct(t.alias("token"), i.alias("pos"))))

    def runs(o: Column) -> Column:
        starts = F.filter(F.transform(o, lambda x, i: i), lambda i: (i == 0) | (F.get(o, i - 1)["token"] != F.get(o, i)["token"]))

        def each(s: Column) -> Column:
            upto = lambda k: F.coalesce(F.get(s, k + 1), F.size(o))
            return F.transform(s, lambda at, k: F.struct(F.get(o, at)["token"].alias("token"), F.transform(F.slice(o, at + 1, upto(k) - at), lambda x: x["pos"]).alias("at")))

        return F.flatten(F.transform(F.array(starts), each))

    return F.flatten(F.transform(F.array(ordered), runs))


def index(chunks: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """(key, token, pos) of all texts."""
    return chunks.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "token")).select(key, "token", "pos")


def stale(chunks: DataFrame, indexed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Texts that the index doesn't have yet."""
    return chunks.join(indexed.select(key).distinct(), key, "left_anti")


def updated(indexed: DataFrame, changed: DataFrame, deleted: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """The index after texts changed and others were deleted."""
    gone = changed.select(key).union(deleted.select(key)).distinct()
    return indexed.join(gone, key, "left_anti").unionByName(index(changed, key, text))


@dataclass(frozen=True)
class Phrase:
    """Tokens in a row."""

    words: tuple[str, ...]


@dataclass(frozen=True)
class Near:
    """Phrases with at most so many tokens between the end of the first and the start of the last, in any order."""

    phrases: tuple[Phrase, ...]
    within: int = 10


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


@dataclass(frozen=True)
class Without:
    """What matches the first and not the second."""

    wanted: object
    unwanted: object


Query = Phrase | Near | All | Any | Without


def _words(text: str) -> tuple[str, ...]:
    plain = text.lower().translate(str.maketrans(ACCENTED, PLAIN))
    return tuple(w for w in re.split(r"[^\w]+|_", "".join(c for c in plain if unicodedata.category(c) != "Mn")) if w)


def _of(kind: type, parts: list) -> Query | None:
    """Parts together; those without words are left out, and one alone stands for itself."""
    real = [p for p in parts if p is not None]
    return (kind(tuple(real)) if len(real) > 1 else real[0]) if real else None


class _Syntax:
    """OR binds least, then AND, then NOT, then words side by side; brackets and NEAR(words, n) stand for one part."""

    def __init__(self, text: str):
        if text.count('"') % 2:
            raise ValueError("a quotation is not closed")
        self.left = re.findall(r'"[^"]*"|[(),]|[^\s(),"]+', text)[::-1]

    def next_is(self, *words: str) -> bool:
        return bool(self.left) and self.left[-1] in words

    def chain(self, word: str, part, kind: type) -> Query | None:
        parts = [part()]
        while self.next_is(word):
            self.left.pop()
            parts.append(part())
        return _of(kind, parts)

    def alternatives(self) -> Query | None:
        return self.chain("OR", lambda: self.chain("AND", self.difference, All), Any)

    def difference(self) -> Query | None:
        found = self.side_by_side()
        while self.next_is("NOT"):
            self.left.pop()
            unwanted = self.side_by_side()
            found = found if found is None or unwanted is None else Without(found, unwanted)
        return found

    def side_by_side(self) -> Query | None:
        parts = [self.part()]
        while self.left and not self.next_is("AND", "OR", "NOT", ")", ","):
            parts.append(self.part())
        return _of(All, parts)

    def part(self) -> Query | None:
        if not self.left or self.next_is("AND", "OR", "NOT", ")", ","):
            raise ValueError("words are missing" + (f" before {self.left[-1]}" if self.left else " at the end"))
        word = self.left.pop()
        if word == "(":
            found = self.alternatives()
            self.close()
            return found
        if word == "NEAR" and self.next_is("("):
            self.left.pop()
            phrases = []
            while self.left and not self.next_is(",", ")"):
                phrases.append(self.phrase(self.left.pop()))
            within = 10
            if self.next_is(","):
                self.left.pop()
                if not self.left or not self.left[-1].isdigit():
                    raise ValueError("NEAR wants a number behind the comma")
                within = int(self.left.pop())
            self.close()
            real = tuple(p for p in phrases if p)
            return Near(real, within) if len(real) > 1 else real[0] if real else None
        return self.phrase(word)

    def close(self) -> None:
        if not self.next_is(")"):
            raise ValueError("a bracket is not closed")
        self.left.pop()

    @staticmethod
    def phrase(text: str) -> Phrase | None:
        words = _words(text)
        return Phrase(words) if words else None


def parse(query: str) -> Query | None:
    """Words are all wanted, each as a phrase of its parts. With AND, OR, NOT, NEAR(, brackets or quotes around words their
    syntax holds, and ValueError tells what is wrong with it. None if there are no words."""
    if not any(x in query for x in (" AND ", " OR ", " NOT ", "NEAR(", '"')) and not re.search(r"(^|\s)\(.*\)(\s|$)", query):
        return _of(All, [_Syntax.phrase(w) for w in query.split()])
    syntax = _Syntax(query)
    found = syntax.alternatives()
    if syntax.left:
        raise ValueError(f"{syntax.left[-1]} has nothing before it")
    return found


def phrases(query: Query | None) -> list[Phrase]:
    """The phrases that a match can hold, each once, in order; those behind NOT are none of them."""
    if query is None:
        return []
    if isinstance(query, Phrase):
        return [query]
    parts = query.phrases if isinstance(query, Near) else (query.wanted,) if isinstance(query, Without) else query.parts
    return list(dict.fromkeys(p for x in parts for p in phrases(x)))


def _all_phrases(query: Query) -> list[Phrase]:
    if isinstance(query, Without):
        return list(dict.fromkeys(_all_phrases(query.wanted) + _all_phrases(query.unwanted)))
    if isinstance(query, All | Any):
        return list(dict.fromkeys(p for x in query.parts for p in _all_phrases(x)))
    return phrases(query)


def words_of(query: Query) -> list[str]:
    return sorted({w for p in _all_phrases(query) for w in p.words})


def _matches(query: Query, at: dict[Phrase, Column]) -> Column:
    """Whether the starts of phrases in a text fulfil a query."""
    if isinstance(query, Phrase):
        return F.size(at[query]) > 0
    if isinstance(query, Without):
        return _matches(query.wanted, at) & ~_matches(query.unwanted, at)
    if isinstance(query, All | Any):
        parts = [_matches(x, at) for x in query.parts]
        return reduce(Column.__and__ if isinstance(query, All) else Column.__or__, parts)
    ways = []
    for first in query.phrases:
        others = [at[p] for p in query.phrases if p != first]
        reach = len(first.words) + query.within
        ways.append(_clump(at[first], others, reach))
    return reduce(Column.__or__, ways)


def _clump(first: Column, others: list[Column], reach: int) -> Column:
    """Whether some start has one of each of the others at or behind it, no further than `reach`."""

    def here(s: Column) -> Column:
        return reduce(Column.__and__, [F.exists(o, lambda t: (t >= s) & (t - s <= reach)) for o in others], F.lit(True))

    return F.exists(first, here)


def places(indexed: DataFrame, query: Query, key: str = "chunk_id") -> DataFrame:
    """(key, p0, p1, ...) of texts with a word of the query: where each of its phrases starts, in _all_phrases' order."""
    words = words_of(query)
    found = indexed.filter(F.col("token").isin(words)).groupBy(key).agg(*(F.collect_set(F.when(F.col("token") == w, F.col("pos"))).alias(f"w{i}") for i, w in enumerate(words)))
    at = {w: F.col(f"w{i}") for i, w in enumerate(words)}

    def starts(p: Phrase) -> Column:
        out = at[p.words[0]]
        for k, w in enumerate(p.words[1:], 1):
            out = F.array_intersect(out, F.transform(at[w], lambda x: x - F.lit(k)))  # noqa: B023
        return out

    return found.select(key, *(starts(p).alias(f"p{i}") for i, p in enumerate(_all_phrases(query))))


def matched(found: DataFrame, query: Query) -> DataFrame:
    """Those places() that fulfil the query."""
    return found.filter(_matches(query, {p: F.col(f"p{i}") for i, p in enumerate(_all_phrases(query))}))


def hits(indexed: DataFrame, query: Query, key: str = "chunk_id") -> DataFrame:
    """(key) of the texts that a query matches. Its words alone leave the index, then one aggregation decides."""
    return matched(places(indexed, query, key), query).select(key)


def lengths(indexed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(key, dl): the number of tokens of each text, to be stored beside the index."""
    return indexed.groupBy(key).agg(F.count("*").alias("dl"))


def text_lengths(chunks: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """The same from the texts, without an index; texts without tokens have none of their own."""
    return chunks.select(key, F.size(tokens(F.col(text))).cast("long").alias("dl")).filter("dl > 0")


def weight(tf: Column, dl: Column, n: float, df: float, avgdl: float) -> Column:
    """BM25's share of a phrase that stands tf times in a text of dl tokens, and in df of n texts."""
    idf = max(FLOOR, math.log((n - df + 0.5) / (df + 0.5)))
    return F.lit(idf) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(avgdl or 1.0)))


def bm25(indexed: DataFrame, query: Query, limit: int = 50, key: str = "chunk_id", sizes: DataFrame | None = None) -> DataFrame:
    """(key, rank) of the best matches, the more negative the better; ties by key. Each of the query's phrases weighs by itself.

    With `sizes`, the stored lengths() of the index, only the query's own words are read from the index.
    """
    sizes = lengths(indexed, key) if sizes is None else sizes
    found, all_ = places(indexed, query, key), _all_phrases(query)
    held = [i for i, p in enumerate(all_) if p in phrases(query)]
    t = sizes.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()  # one row, as the next
    df = found.agg(F.count("*").alias("some"), *(F.count_if(F.size(f"p{i}") > 0).alias(f"df{i}") for i in held)).first()
    score = sum((weight(F.size(f"p{i}"), F.col("dl"), t["n"], df[f"df{i}"], t["avgdl"]) for i in held), F.lit(0.0))
    return matched(found, query).join(sizes, key).select(key, (-score).alias("rank")).orderBy("rank", key).limit(limit)


def excerpt(text: Column, query: Query, size: int = 16) -> Column:
    """Up to `size` words with the most different words of the query, matches marked; of equal windows the first.

    One fold over the matches from the last to the first keeps where each word comes next, so that a window that begins
    at a match is judged at once, however long the text is. The window is then moved so that its matches are in the middle.
    """
    words = sorted({w for p in phrases(query) for w in p.words})
    parts, plain = F.split(strip(text), r"(?U)\s+"), F.split(fold(strip(text)), r"(?U)\s+")
    wanted = F.array(*map(F.lit, words))
    of_part = lambda w: F.array_intersect(F.split(w, r"(?U)[^\p{L}\p{N}]+"), wanted)
    found = F.flatten(F.transform(plain, lambda w, i: F.transform(of_part(w), lambda x: F.struct(i.alias("at"), (F.array_position(wanted, x) - 1).cast("int").alias("word")))))
    far = F.array_repeat(F.lit(1 << 30), len(words))
    start = F.struct(far.alias("next"), F.lit(0).alias("n"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(a: Column, hit: Column) -> Column:
        following = F.transform(a["next"], lambda v, i: F.when(i == hit["word"], hit["at"]).otherwise(v))
        inside = F.filter(following, lambda v: v < hit["at"] + size)
        better = F.struct(following.alias("next"), F.size(inside).alias("n"), hit["at"].alias("first"), F.array_max(inside).alias("last"))
        return F.when(F.size(inside) >= a["n"], better).otherwise(F.struct(following.alias("next"), a["n"].alias("n"), a["first"].alias("first"), a["last"].alias("last")))

    best = F.aggregate(F.reverse(found), start, step)

    def shown(a: Column) -> Column:
        begin = F.greatest(F.lit(0), a["first"] - F.ceil((F.lit(size) - (a["last"] - a["first"] + 1)) / 2).cast("int"))
        marked = F.transform(F.slice(parts, begin + 1, size), lambda w: F.when(F.size(of_part(fold(w))) > 0, F.concat(F.lit("<mark>"), w, F.lit("</mark>"))).otherwise(w))
        return F.concat(F.when(begin > 0, "…").otherwise(""), F.array_join(marked, " "), F.when(F.size(parts) > begin + size, "…").otherwise(""))

    return F.element_at(F.transform(F.array(best), shown), 1)
