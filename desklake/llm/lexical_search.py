"""Exact top documents of lexical queries, by impact vectors in buckets of their length (LEMP).

A document's score for an item is a product of two vectors over terms: the item has the root of each term's weight, the document that
root times the term's impact. Only terms of the items at hand count, as no other can add to a score. Vectors are stored in levels
by length, the longest first. Each level is one job that carries the items whose bound, length of the item times greatest length of
the level, still reaches the item's last place (Cauchy-Schwarz). Inside a task a batch is ordered by length and cut at the same
bound; then single coordinates bound the angle: a document stays only if its share in a focus term is close enough to the
item's. What is left is scored exactly in 64-bit integers, so bounds in doubles, widened by ``SLACK``, only ever save work.

Items are taken in blocks of about ``BLOCK_PAIRS`` pairs of item and term; a block, its weights and its last places are what tasks
get, whatever the number of documents. An item is never cut, so a block exceeds that only by its largest item.

Defined cases: null, empty or term-less texts are no documents and rank nowhere; rows with one item_id (null is one) are one item with
the terms of all; repeated document rows rank each; of equal scores the smaller doc_id is first and a null doc_id last; other columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from desklake.llm.common import ascii_lower, stored, words

GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP, BLOCK_PAIRS = 10, 200_000
#: Shares of the documents that are at least as long as those of each level but the last.
LEVELS = (0.01, 0.05, 0.2, 0.5)
FOCUS = 3
SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max


def term_pairs(items: DataFrame) -> DataFrame:
    """item_id and each of its terms once."""
    return items.select("item_id", F.explode(F.array_distinct(words(ascii_lower(F.col("text")), GAPS))).alias("term")).distinct()


def _count_terms(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n (all terms with repeats), and the numbers and counts of the given terms, for documents with any term."""
    numbers = docs.sparkSession.sparkContext.broadcast({term: number for number, term in enumerate(terms)})
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value.get
        for batch in batches:
            ids, sizes, held, times = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                found = TERM.findall((text.as_py() or "").encode().lower())  # bytes lower A-Z only
                if found:
                    own, often = np.unique(np.array([k for k in map(known, found) if k is not None], np.int32), return_counts=True)
                    ids.append(doc_id.as_py())
                    sizes.append(len(found))
                    held.append(own)
                    times.append(often.astype(np.int32))
            if ids:
                edges = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                       *(pa.ListArray.from_arrays(edges, pa.array(np.concatenate(flat), pa.int32())) for flat in (held, times))],
                                      schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, n long, terms array<int>, times array<int>")


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def _edges(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.append(0, np.cumsum(batch.column(name).value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)


def _totals(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum of each stretch between edges, empty ones included."""
    sums = np.append(0, np.cumsum(values, dtype=values.dtype))
    return sums[edges[1:]] - sums[edges[:-1]]


def impacts(times: np.ndarray, sizes: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L."""
    if 90 * documents * int(sizes.max(initial=0)) < 1 << 62:
        m = 10 + (90 * documents * sizes.astype(np.int64)) // all_terms
    else:  # beyond 64 bits on the way
        m = np.array([10 + 90 * documents * int(size) // all_terms for size in sizes], np.int64)
    times = times.astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def _vectors(counted: DataFrame, weights: np.ndarray, documents: int, all_terms: int, whole: bool) -> DataFrame:
    """doc_id, length and, if ``whole``, the terms and impacts of documents that hold a weighted term."""
    spread = counted.sparkSession.sparkContext.broadcast(weights)
    kind = "doc_id long, length double, terms array<int>, impacts array<bigint>" if whole else "length double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = spread.value
        for batch in batches:
            edges, terms = _edges(batch, "terms"), _flat(batch, "terms")
            sizes = np.repeat(batch.column("n").to_numpy(), np.diff(edges))
            impact = impacts(_flat(batch, "times"), sizes, documents, all_terms)
            length = np.sqrt(_totals(weight[terms] * impact.astype(np.float64) ** 2, edges))
            out = pa.record_batch([batch.column("doc_id"), pa.array(length), batch.column("terms"),
                                   pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(impact))] if whole else [pa.array(length)],
                                  names=["doc_id", "length", "terms", "impacts"] if whole else ["length"])
            yield out.filter(pa.array(length > 0))

    return counted.mapInArrow(work, kind)


class _Items:
    """The items of a block as sparse vectors: per item its terms, root weights and length."""

    def __init__(self, terms_of: list[np.ndarray], weights: np.ndarray):
        self.terms = [terms[weights[terms] > 0] for terms in terms_of]
        self.weights = weights
        self.lengths = np.array([math.sqrt(weights[terms].sum()) for terms in self.terms])

    def focus(self, item: int) -> list[tuple[int, float]]:
        """The terms with the greatest shares in the item, with the cosine between item and term."""
        terms = self.terms[item]
        best = terms[np.argsort(-self.weights[terms], kind="stable")[:FOCUS]]
        return [(int(term), math.sqrt(self.weights[term]) / self.lengths[item]) for term in best]


class _Batch:
    """Vectors of a batch, the longest first."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray):
        order = pa.array(np.argsort(-batch.column("length").to_numpy(), kind="stable"))
        batch = batch.take(order)
        self.lengths = batch.column("length").to_numpy()
        self.ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
        self.edges, self.terms, self.impacts = _edges(batch, "terms"), _flat(batch, "terms"), _flat(batch, "impacts")
        owners = np.repeat(np.arange(len(self.lengths)), np.diff(self.edges))
        by_term = np.argsort(self.terms, kind="stable")
        self.listed, self.owners = self.terms[by_term], owners[by_term]
        self.cosines = np.sqrt(weights[self.listed]) * self.impacts[by_term] / self.lengths[self.owners]

    def candidates(self, items: _Items, item: int, least: int) -> np.ndarray:
        """Documents whose score may reach ``least``; more than enough, never fewer."""
        if least <= 0:
            return np.arange(len(self.lengths))
        need = least / (items.lengths[item] * (1 + SLACK))  # no shorter document can reach it
        count = int(np.searchsorted(-self.lengths, -need * (1 - SLACK), side="right"))
        if not count:
            return np.zeros(0, np.int64)
        angle = np.arccos(np.minimum(1.0, need / self.lengths[:count]))  # the widest angle to the item that is still enough
        alive = np.ones(count, bool)
        for term, cosine in items.focus(item):
            first, last = np.searchsorted(self.listed, [term, term + 1])
            own = np.zeros(count)
            inside = self.owners[first:last] < count
            own[self.owners[first:last][inside]] = self.cosines[first:last][inside]
            between = np.arccos(min(1.0, cosine))
            off = np.abs(np.arccos(np.minimum(1.0, own)) - between)
            alive &= off <= angle + 1e-6
        return np.flatnonzero(alive)

    def scores(self, items: _Items, item: int, documents: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores. ``asked`` has a place for every term and is left all zero."""
        asked[items.terms[item]] = items.weights[items.terms[item]]
        sizes = np.diff(self.edges)[documents]
        edges = np.append(0, np.cumsum(sizes))
        at = np.arange(edges[-1]) + np.repeat(self.edges[:-1][documents] - edges[:-1], sizes)
        scores = _totals(asked[self.terms[at]] * self.impacts[at], edges)
        asked[items.terms[item]] = 0
        return scores


def _level(vectors: DataFrame, items: _Items, least: np.ndarray, active: list[int], top: int) -> DataFrame:
    """item, doc_id, score of the best documents each task has seen; none below ``least`` of its item."""
    spread = vectors.sparkSession.sparkContext.broadcast((items, least, active))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least, active = spread.value
        best = {item: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for item in active}
        asked = np.zeros(len(items.weights), np.int64)
        for found in batches:
            batch = _Batch(found, items.weights)
            for item in active:
                held, ids = best[item]
                last = max(int(least[item]), int(held[-1]) if len(held) == top else 0)
                documents = batch.candidates(items, item, last)
                if len(documents):
                    scores = batch.scores(items, item, documents, asked)
                    good = scores >= max(last, 1)
                    held, ids = np.append(held, scores[good]), np.append(ids, batch.ids[documents[good]])
                    order = np.lexsort((ids, -held))[:top]
                    best[item] = held[order], ids[order]
        out = [(item, doc_id, score) for item in active for score, doc_id in zip(best[item][0].tolist(), best[item][1].tolist())]
        numbers, ids, scores = (np.array(column, np.int64) for column in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        yield pa.record_batch([pa.array(numbers), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return vectors.select("doc_id", "length", "terms", "impacts").mapInArrow(work, "item long, doc_id long, score long")


def _best(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, terms: list[str], terms_of: list[np.ndarray], top: int) -> DataFrame:
    """item (its number in the block), rank, doc_id and score."""
    counted = stored(_count_terms(docs, [term.encode() for term in terms]), "counted")
    documents, all_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(terms), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the terms of the block
        held[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    items = _Items(terms_of, weights)
    lengths = _vectors(counted, weights, documents, all_terms, whole=False)
    shares = [1 - share for share in LEVELS]
    bounds = lengths.agg(F.percentile_approx("length", F.array(*map(F.lit, shares))), F.max("length")).first()
    limits = [bounds[1] or 0.0, *(bounds[0] or [0.0] * len(shares))]  # the greatest length of each level
    level = reduce(lambda so_far, limit: so_far + (F.col("length") <= limit).cast("int"), limits[1:], F.lit(0))
    vectors = stored(_vectors(counted, weights, documents, all_terms, whole=True).withColumn("level", level), "vectors", "level")
    best = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long, rank int")
    least = np.zeros(len(items.terms), np.int64)
    for number, longest in enumerate(limits):
        active = np.flatnonzero((items.lengths > 0) & (items.lengths * longest * (1 + SLACK) >= least)).tolist()
        if active:
            found = _level(vectors.where(F.col("level") == number), items, least, active, top)
            best = stored(_best(best.drop("rank").unionByName(found), top), "best")
            for row in best.where(F.col("rank") == top).select("item", "score").collect():  # one row an item
                least[row["item"]] = row["score"]
    return best


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every item, scores above 0 only."""
    spark = docs.sparkSession
    kind = items.select("item_id").schema[0].dataType.simpleString()
    pairs = stored(term_pairs(items), "item-terms")
    blocks = max(1, -(-pairs.count() // block_pairs))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        listed: dict = {}
        for row in dealt.where(F.col("block") == block).select("item_id", "term").collect():  # about block_pairs rows
            listed.setdefault(row["item_id"], []).append(row["term"])
        if not listed:
            continue
        terms = sorted({term for own in listed.values() for term in own})
        number = {term: k for k, term in enumerate(terms)}
        found = _search_block(docs, terms, [np.array([number[term] for term in own]) for own in listed.values()], top)
        names = spark.createDataFrame([(k, item_id) for k, item_id in enumerate(listed)], f"item long, item_id {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
