"""Benchmark decontamination by winnowing.

Items are cut into windows of ``WINDOW`` words; of the hashes of the ``GRAM``-word grams in a window the smallest is its fingerprint.
Any window that a document shares with an item has the same grams, hence the same smallest hash, in both: joining fingerprints
finds every shared window. A hit is then extended to the whole window and compared word by word, so hashes decide nothing.
An item with fewer words is one window; its fingerprint is the hash of all its words, which documents are held against at
that length too.

Fingerprints of the benchmark are broadcast only when their counted number is at most ``BROADCAST_ROWS``; beyond that the joins
are shuffled and Spark splits hot keys. Documents without a word have no hits; items without a word or text have no window. A null
doc_id or item_id is an id like any other, the latter written as empty text; rows equal in id and text are one document
repeated, and each gets the result; columns beside ids and texts are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import ascii_lower, fresh, grams, let, stored, words

WINDOW, GRAM = 10, 5
BROADCAST_ROWS = 200_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def benchmark_words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def _hashes(parts: Column) -> Column:
    return F.transform(parts, lambda word: F.xxhash64(word))


def window_prints(hashes: Column) -> Column:
    """The fingerprint of every full window, in order."""
    spread = WINDOW - GRAM + 1
    return F.when(F.size(hashes) >= WINDOW, let(grams(hashes, GRAM), lambda gram: F.transform(
        F.sequence(F.lit(0), F.size(gram) - spread),
        lambda i: F.least(*[gram[i + j] for j in range(spread)])))).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, fingerprint, length and words of every window of every item."""
    def cut(parts: Column) -> Column:
        long = let(window_prints(_hashes(parts)), lambda prints: F.transform(prints, lambda found, i: F.struct(
            found.alias("print"), F.lit(WINDOW).alias("length"), F.array_join(F.slice(parts, i + 1, WINDOW), " ").alias("words"))))
        short = F.array(F.struct(_short_print(_hashes(parts)).alias("print"), F.size(parts).alias("length"),
                                 F.array_join(parts, " ").alias("words")))
        return F.when(F.size(parts) >= WINDOW, long).when(F.size(parts) > 0, short)
    windows = benchmark.select("item_id", F.explode(let(benchmark_words(F.col("text")), cut)).alias("window"))
    return windows.select("item_id", "window.print", "window.length", "window.words").distinct()


def _short_print(hashes: Column) -> Column:
    """One hash for all words of an item shorter than a window."""
    sized = F.lit(0).cast("long")
    for size in range(1, WINDOW):
        sized = F.when(F.size(hashes) == size, F.xxhash64(*[F.get(hashes, F.lit(j)) for j in range(size)])).otherwise(sized)
    return sized


def _prints(hashes: Column, shorter: list[int]) -> Column:
    """All fingerprints of a document, each once."""
    parts = [window_prints(hashes), *[grams(hashes, size) for size in shorter]]
    return F.array_distinct(F.concat(*parts) if len(parts) > 1 else parts[0])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit (words in shared windows) and the item_ids of those windows, sorted as text."""
    windows = stored(benchmark_windows(benchmark), "benchmark-windows")
    count = windows.count()
    small = F.broadcast if count <= BROADCAST_ROWS else lambda frame: frame
    shorter = sorted(row[0] for row in windows.where(F.col("length") < WINDOW).select("length").distinct().collect())
    source = docs.select("doc_id", "text")
    parts = benchmark_words(F.col("text"))

    prints = source.select("doc_id", F.explode(let(_hashes(parts), lambda h: _prints(h, shorter))).alias("print"))
    matched = prints.join(small(windows.select("print").distinct()), "print", "left_semi")
    matched = matched.groupBy(F.col("doc_id").alias("matched_id")).agg(F.collect_set("print").alias("prints"))

    def window(at: Column, length: int, found: Column) -> Column:
        return F.struct(at.alias("start"), F.lit(length).alias("length"), F.array_join(F.slice(found, at + 1, length), " ").alias("words"))

    def extended(found: Column) -> Column:
        def of(per_window: Column, length: int) -> Column:
            held = F.filter(F.transform(per_window, lambda p, i: F.when(F.array_contains(F.col("prints"), p), i)), lambda i: i.isNotNull())
            return F.transform(held, lambda i: window(i, length, found))
        return let(_hashes(found), lambda h: F.concat(of(window_prints(h), WINDOW), *[of(grams(h, size), size) for size in shorter]))

    joined = source.join(matched, F.col("doc_id").eqNullSafe(F.col("matched_id")), "left")
    held = stored(joined.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.size(parts).cast("long").alias("n_words"),
        F.when(F.col("prints").isNotNull(), let(parts, extended)).alias("windows")), "benchmark-hits")

    base, key = held.select("doc_id", "text_hash", "n_words"), ["doc_id", "text_hash"]
    opened = held.select(*key, F.explode("windows").alias("window")).select(*key, "window.*")
    shared = opened.join(small(windows.select("length", "words").distinct()), ["length", "words"]).distinct()
    n_hit = F.aggregate(F.sort_array(F.collect_set(F.struct("start", "length"))),
                        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), _cover, lambda state: state["n"])
    hit = shared.groupBy(*key).agg(n_hit.alias("n_hit"))
    items = shared.select(*key, "length", "words").distinct().join(small(windows.select("item_id", "length", "words")), ["length", "words"])
    items = items.groupBy(*key).agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"))
    both = hit.join(items, [hit[k].eqNullSafe(items[k]) for k in key]).select(
        hit["doc_id"].alias("hit_id"), hit["text_hash"].alias("hit_hash"), "n_hit", "items")
    return base.join(both, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left").select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _cover(state: Column, window: Column) -> Column:
    end = window["start"] + window["length"]
    new = F.greatest(F.lit(0), end - F.greatest(window["start"], state["end"]))
    return F.struct((state["n"] + new).alias("n"), F.greatest(end, state["end"]).alias("end"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns. Each row goes or stays by its own text, whoever shares its id."""
    hit_id, hit_hash = fresh(docs, "hit_id"), fresh(docs, "hit_hash")
    hit = decontaminate(docs, benchmark).where(F.col("n_hit") > 0).select(
        F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.xxhash64("text") == F.col(hit_hash)), "left_anti")
