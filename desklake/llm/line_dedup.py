"""Line dedup over levelled sorted runs of line hashes.

A run is a folder of (key, documents) sorted by key, where key is the MD5 of a line stripped of blanks and with A-Z lowered. A batch
of documents adds one run to level 0; as soon as a level holds ``FANOUT`` runs they are merged, counts added, into one run of
the next level, so a key is rewritten a logarithmic number of times. ``dedup_batch`` is the incremental use: the batch's lines are
merge-anti-joined with the runs and the batch's own counts before the run is added. ``dedup`` takes a whole table: all batches add
their runs first, then every line is held against the counts of all documents.

Counting combines on the map side, so a line in a third of all documents is one row per task. Defined cases: null or empty text is
one empty line, whose key is empty and never dropped while ``least_chars`` is 1 or more; a null id is an id like any other; every
row counts as a document, repeated rows too; columns beside doc_id and text are passed on; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import BLANKS, ascii_lower, fresh, let, stored

FANOUT = 4
BATCH_BYTES = 256 << 20


def line_keys(text: Column, least_chars: int) -> Column:
    """The key of every line in order; null for lines too short to be judged."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n")

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANKS))
        return F.when(F.char_length(bare) >= least_chars, F.md5(bare))
    return F.transform(lines, key)


class LineRuns:
    """Levels of sorted runs in the shared scratch folder."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def _run(counts: DataFrame) -> DataFrame:
        merged = counts.groupBy("key").agg(F.sum("documents").alias("documents"))
        return stored(merged.sortWithinPartitions("key"), "line-run")

    def add(self, counts: DataFrame, level: int = 0) -> None:
        """A new run; a full level moves up as one run."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._run(counts))
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self.add(_union(full), level + 1)

    def counts(self) -> DataFrame | None:
        """Documents per key over all runs."""
        runs = [run for level in self.levels for run in level]
        return _union(runs).groupBy("key").agg(F.sum("documents").alias("documents")) if runs else None


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _keyed(docs: DataFrame, least_chars: int) -> DataFrame:
    keys = F.array_distinct(F.array_compact(line_keys(F.col("text"), least_chars)))
    return docs.select("doc_id", keys.alias("keys"))


def _counts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.explode("keys").alias("key"), F.lit(1).cast("long").alias("documents")).groupBy("key").agg(
        F.sum("documents").alias("documents"))


def drop_lines(docs: DataFrame, keyed: DataFrame, frequent: DataFrame, least_chars: int) -> DataFrame:
    """All columns of ``docs`` and a struct ``lines`` of n_lines, n_dropped and kept_text, without lines whose key is in ``frequent``.

    Documents meet their frequent keys over doc_id; rows that share an id share the list, which is right as a frequent key goes
    from every document. A column of the input called ``lines`` must be renamed before.
    """
    frequent_keys, listed_id = fresh(docs, "frequent_keys"), fresh(docs, "listed_id")
    opened = keyed.select("doc_id", F.explode("keys").alias("key"))
    found = opened.join(frequent.select("key"), "key", "left_semi")
    listed = found.groupBy("doc_id").agg(F.collect_set("key").alias(frequent_keys))
    listed = listed.select(F.col("doc_id").alias(listed_id), frequent_keys)
    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.join(listed, F.col("doc_id").eqNullSafe(F.col(listed_id)), "left")

    def kept(line: Column) -> Column:
        bare = F.btrim(ascii_lower(line), F.lit(BLANKS))
        return (F.char_length(bare) < least_chars) | ~F.array_contains(F.col(frequent_keys), F.md5(bare))

    def result(all_lines: Column, left: Column) -> Column:
        return F.struct(F.size(all_lines).cast("long").alias("n_lines"), (F.size(all_lines) - F.size(left)).cast("long").alias("n_dropped"),
                        F.array_join(left, "\n").alias("kept_text"))

    touched = let(F.split(text, "\n"), lambda every: let(F.filter(every, kept), lambda left: result(every, left)))
    whole = F.struct(F.size(F.split(text, "\n")).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), text.alias("kept_text"))
    return joined.withColumn("lines", F.when(F.col(frequent_keys).isNotNull(), touched).otherwise(whole)).drop(frequent_keys, listed_id)


def _frequent(docs: DataFrame, least_chars: int, least_documents: int, batch_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The keys of every document, and those that enough documents hold, by way of the runs of all batches."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-total // batch_bytes))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    keyed = stored(_keyed(docs, least_chars).withColumn("batch", batch), "line-keys", "batch")
    runs = LineRuns()
    for number in range(batches):
        runs.add(_counts(keyed.where(F.col("batch") == number)))
    return keyed, runs.counts().where(F.col("documents") >= least_documents)


def dedup(docs: DataFrame, least_chars: int = 1, least_documents: int = 10, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of all documents; lines in ``least_documents`` or more are dropped."""
    source = docs.select("doc_id", "text")
    keyed, frequent = _frequent(source, least_chars, least_documents, batch_bytes)
    return drop_lines(source, keyed, frequent, least_chars).select("doc_id", "lines.*")


def without_frequent_lines(docs: DataFrame, least_chars: int = 1, least_documents: int = 10, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """All documents with all their columns; text, and n_chars if present, without the frequent lines. A null text stays null."""
    source = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    keyed, frequent = _frequent(docs.select("doc_id", "text"), least_chars, least_documents, batch_bytes)
    done = drop_lines(source, keyed, frequent, least_chars)
    changed = F.col("lines.n_dropped") > 0

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        if name == "text":
            return F.when(changed, F.col("lines.kept_text")).otherwise(old).alias(name)
        if name == "n_chars":
            return F.when(changed, F.char_length("lines.kept_text").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)
    return done.select(*[column(name) for name in docs.columns])


def dedup_batch(docs: DataFrame, runs: LineRuns, least_chars: int = 1, least_documents: int = 10) -> DataFrame:
    """The next batch without lines that are frequent so far; its own lines count, and join the runs for later batches."""
    source = docs.select("doc_id", "text")
    keyed = stored(_keyed(source, least_chars), "line-keys")
    earlier, own = runs.counts(), _counts(keyed)
    runs.add(own)
    so_far = own if earlier is None else earlier.unionByName(own).groupBy("key").agg(F.sum("documents").alias("documents"))
    return drop_lines(source, keyed, so_far.where(F.col("documents") >= least_documents), least_chars).select("doc_id", "lines.*")
