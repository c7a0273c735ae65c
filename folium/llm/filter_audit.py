"""How filters interact: what each removes, misses or repeats at every step of every order they can be applied in.

A document's removal step is a min-plus product: to its mask (0 where a filter fails it, more than any step elsewhere)
the inverse permutation of an order is added (the step at which each filter stands), and the least sum is the step.
Documents with equal masks are counted first, so the product runs over at most 2^n masks of a part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import numbered
from folium.llm.scratch import Scratch

#: More filters than this have too many orders to list.
MOST_FILTERS = 7
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

_UPPER = "".join(map(chr, range(65, 91)))
#: The filters of the registered query, each true where a text `t` of the words `w` fails it; E is told from other rows.
CONDITIONS = {
    "A": "size(w) < 50",
    "B": "100 * size(array_distinct(w)) < 65 * size(w)",
    "C": f"100 * (length(t) - length(translate(t, '{_UPPER}', ''))) > 5 * length(t)",
    "D": "t rlike '[#$%&*|]'",
}


def orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of n filters in alphabetical order, and of each the step (from 1) at which each filter stands."""
    order = np.array(list(itertools.permutations(range(n))), np.int64).reshape(-1, n)
    return order, np.argsort(order, axis=1) + 1


def removal_steps(masks: np.ndarray, position: np.ndarray) -> np.ndarray:
    """For each mask (a row of booleans, true where a filter fails) and order the step of removal; n + 1 for none."""
    n = masks.shape[1]
    cost = np.where(masks, 0, n + 1)
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), n + 1)


def counts(masks: np.ndarray, weights: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """COUNTS of each part, order and step; `weights` has documents, good and toxic ones of each mask."""
    n = masks.shape[1]
    order, position = orders(n)
    out = np.zeros((len(COUNTS), parts, len(order), n), np.int64)
    step, single = np.arange(1, n + 1), masks.sum(axis=1) == 1
    for at in range(0, len(masks), 1024):
        rows = slice(at, at + 1024)
        removed_at = removal_steps(masks[rows], position)[:, :, None]
        fails = masks[rows][:, order]
        hit = removed_at == step
        n_docs, good, toxic = (weights[rows, k, None, None] for k in range(3))
        shares = (n_docs * (removed_at > step), n_docs * hit, n_docs * (fails & (removed_at < step)), n_docs * (fails & single[rows, None, None]), good * hit, toxic * hit)
        for k, x in enumerate(shares):
            np.add.at(out[k], part[rows], x)
    by_filter = np.zeros((parts, n), np.int64)
    for k in range(n):
        np.add.at(by_filter, (slice(None), order[:, k]), out[1][:, :, k])
    out[-1] = by_filter[:, order]
    return out


def _audit(n: int, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = orders(n)[0]
        labels = ["".join(names[f] for f in o) for o in order.tolist()]
        for batch in batches:
            # a part's masks are 2^n at most, its rows n! * n; a few parts at a time
            for at in range(0, batch.num_rows, 16):
                some = batch.slice(at, 16)
                lists = some.column(1)
                flat = lists.flatten()
                part = lists.value_parent_indices().to_numpy().astype(np.int64)
                bits = flat.field("mask").to_numpy()
                masks = (bits[:, None] >> np.arange(n)) & 1 == 1
                weights = np.stack([flat.field(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
                found = counts(masks, weights, part, some.num_rows)
                each = len(order) * n
                columns = [
                    some.column(0).take(pa.array(np.repeat(np.arange(some.num_rows), each))),
                    pa.array([x for x in labels for _ in range(n)] * some.num_rows),
                    pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(order) * some.num_rows)),
                    *(pa.array(x.reshape(-1)) for x in found),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *COUNTS])

    return run


def audit(flags: DataFrame, filters: Sequence[str], part: str = "part", good: str = "good", toxic: str = "toxic") -> DataFrame:
    """part, filter_order, step and COUNTS, a row for each part, order of the filters and step, zeros included.

    `flags` has a row a document: a boolean column for each filter, true where the document fails it (null: false),
    its part (null: the empty string), and whether it is good and toxic (null: no). After a step, kept counts the
    documents left; removed those that it took; redundant those that fail its filter but went before; unique_fails
    those that fail this filter only; good_lost and toxic_lost are of those removed; shapley sums its filter's
    removed over all orders. Repeated rows count as often as they stand there, a table without rows gives none, and
    other columns of any name play no part. Filters are named by single characters, in the order of which the
    filter orders are made.
    """
    if not 1 <= len(filters) <= MOST_FILTERS or any(len(x) != 1 for x in filters) or len(set(filters)) < len(filters):
        raise ValueError(f"give 1 to {MOST_FILTERS} different filters, named by single characters")
    number = {c: k for k, c in reversed(list(enumerate(flags.columns)))}
    column = lambda name: F.col(f"c{number[name]}")
    true = lambda name: F.coalesce(column(name), F.lit(False)).cast("long")
    mask = sum((true(c) * (1 << k) for k, c in enumerate(filters)), F.lit(0).cast("long"))
    rows = numbered(flags).select(F.coalesce(column(part), F.lit("")).alias("part"), mask.alias("mask"), true(good).alias("good"), true(toxic).alias("toxic"))
    by_mask = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    stacked = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    schema = ", ".join(["part string, filter_order string, step int", *(f"{c} long" for c in COUNTS)])
    return stacked.mapInArrow(_audit(len(filters), list(filters)), schema)


def failures(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """part, A to E, good and toxic of each document; CONDITIONS say what fails A to D.

    E fails a text that a smaller id has too, anywhere in the table. A null text is empty, a null source the empty
    string. A null id is smaller than none and no id is smaller than it, so it never fails E, and it has no labels. Of
    several labels of an id, one of 1 is enough; a null label says nothing. Equal ids with equal texts all fail E or
    none does. Texts are told apart by their SHA-256, so copies meet as digests, and the first of a text is found by a
    minimum that tasks take before they shuffle; each row then asks for its own (digest, id), which no hot text shares.
    """
    number = {c: k for k, c in reversed(list(enumerate(docs.columns)))}
    column = lambda name: F.col(f"c{number[name]}")
    rows = numbered(docs).select(column(doc_id).alias("id"), F.coalesce(column(source), F.lit("")).alias("part"), F.coalesce(column(text), F.lit("")).alias("t"))
    rows = rows.select("id", "part", "t", F.expr(r"array_remove(split(t, '[ \\x09-\\x0D]+'), '')").alias("w"))
    rows = rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), *(F.expr(v).alias(k) for k, v in CONDITIONS.items()))
    # null ids are spread, since a null key would gather them in one task; no label and no first row has such a key
    spread = F.struct(F.col("id").isNull().alias("no_id"), F.coalesce(F.col("id").cast("long"), F.monotonically_increasing_id()).alias("id"))
    own = Scratch(docs.sparkSession)
    rows = own.keep(rows.select(spread.alias("key"), "part", "digest", *CONDITIONS))
    first = rows.filter("not key.no_id").groupBy("digest").agg(F.min("key.id").alias("first"))
    first = first.select("digest", F.struct(F.lit(False).alias("no_id"), F.col("first").alias("id")).alias("key"), F.lit(True).alias("is_first"))
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), *(F.coalesce(F.col(c) == 1, F.lit(False)).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))))
    marks = marks.filter("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    marks = marks.select(F.struct(F.lit(False).alias("no_id"), "id").alias("key"), "good", "toxic")
    found = rows.join(first, ["digest", "key"], "left").join(marks, "key", "left")
    return found.select("part", *CONDITIONS, (~F.col("key.no_id") & F.col("is_first").isNull()).alias("E"), "good", "toxic")
