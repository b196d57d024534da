"""Exact Jaccard links between documents over word shingles, by a token-group matrix.

1. Shingles that only one document holds can be in no intersection. A document whose other ("shared") shingles are fewer than the
   similarity asks of its whole set has no link (``chunks.shared_keys`` finds them). The rest are candidates, with their shared
   shingles ordered rarest first.
2. Candidates with the same shared shingles and set size are one class: whatever links with one links with all.
3. Two classes that link share a shingle among their first few (prefix filter; fewer in the smaller set of the two). Each class is held against the centre it meets under
   most of these shingles, and verified links make groups of similar classes: their connected components.
4. Token-group matrix: each group stores the union of its shingles. A class that meets another group under a prefix shingle is a query
   to it; the query's overlap with the group's union bounds its overlap with any member, and only groups where the bound reaches
   the similarity are opened and compared member by member. Links inside a group are not looked for: they change nothing.

Sizes are compared in whole numbers. Defined cases: null, empty or blank texts have no shingles and no links; a text with fewer words than a
shingle is one shingle; a null id counts as greater than all others and is a component of its own unless linked; rows that share
an id are compared like others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm import chunks
from desklake.llm.chunks import LAST_ID, Shared, Texts
from desklake.llm.common import fresh, stored
from desklake.llm.graph import components

SHINGLE, PERCENT = 5, 75
SLICE_BYTES = 256 << 10
CENTRES = ("m", "-n")  # what the centre under a shingle has most of, round by round

BROADCAST_ROWS = 200_000  # of two class numbers each

_RANDOM = np.random.default_rng(3)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(steps)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every word; words end at blanks and at document bounds."""
    inside = ~_BLANK[data]
    begins, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    begins[:-1] = inside
    begins[1:-1] &= ~inside[:-1]
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    crossing = edge[inside[edge] & inside[edge - 1]]
    begins[crossing] = ends[crossing] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, max(1, len(data)))[:len(data)], out=total[1:])
        hashed = (total[end] - total[start]) * _powers(_UNBASE, len(data) + 1)[start] + (end - start).astype(np.uint64)
    return _mixed(hashed), np.searchsorted(bounds, start, side="right") - 1


def shingle_hashes(words: np.ndarray, document: np.ndarray, documents: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every shingle, repeats included."""
    count = np.bincount(document, minlength=documents)
    with np.errstate(over="ignore"):
        n = len(words) - size + 1
        if n > 0:
            whole = np.zeros(n, np.uint64)
            for j in range(size):
                whole += words[j:j + n] * _PLACE[j]
            own = document[:n] == document[size - 1:]
            whole, where = _mixed(whole[own]), document[:n][own]
        else:
            whole, where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        few = np.flatnonzero((count > 0) & (count < size))
        first = np.cumsum(count) - count
        short = np.zeros(len(few), np.uint64)
        for j in range(size - 1):
            has = count[few] > j
            short[has] += words[first[few[has]] + j] * _PLACE[size + j]
        short = _mixed(short + count[few].astype(np.uint64))
    return np.concatenate([whole, short]), np.concatenate([where, few])


def _all_shingles(texts: Texts, size: int):
    """(first document, hash, document number) for slices of a chunk."""
    for first, last in texts.slices(SLICE_BYTES):
        base = texts.bounds[first]
        data, bounds = texts.data[base:texts.bounds[last]], texts.bounds[first:last + 1] - base
        words, document = word_hashes(data, bounds)
        hashed, where = shingle_hashes(words, document, last - first, size)
        yield first, last, hashed, where


def shingle_sets(docs: DataFrame, size: int, percent: int, chunk_bytes: int) -> DataFrame:
    """Per document: the MD5 of its text, n_shingles, and for candidates the class (16 bytes) and shared shingles, rarest first."""
    chunked, total = chunks.in_chunks(docs, chunk_bytes)
    buckets = chunks.bucket_count(total / 6)

    def keys_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        found = [(hashed, where + first) for first, _, hashed, where in _all_shingles(texts, size)]
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, document = (np.concatenate(x) for x in zip(*found))
        return keys, document

    def sets(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _sets([], [], [], [], [])
        texts, shared = Texts(rows), Shared(known, buckets)
        prints = [hashlib.md5(texts.data[x:y], usedforsecurity=False).digest() for x, y in zip(texts.bounds[:-1], texts.bounds[1:])]
        counts, classes, tokens = [], [], []
        for first, last, hashed, where in _all_shingles(texts, size):
            level = shared.level(hashed)
            order = np.argsort(where, kind="stable")
            hashed, level = hashed[order], level[order]
            edges = np.searchsorted(where[order], np.arange(last - first + 1))
            for x, y in zip(edges[:-1], edges[1:]):
                own, at = np.unique(hashed[x:y], return_index=True)
                held = level[x:y][at]
                common = held > 0
                candidate = len(own) and int(common.sum()) * 100 >= percent * len(own)
                counts.append(len(own))
                if candidate:
                    kept = own[common][np.argsort(held[common], kind="stable")]
                    classes.append(hashlib.blake2b(kept.tobytes(), digest_size=16, key=len(own).to_bytes(8, "little")).digest())
                    tokens.append(kept.view(np.int64))
                else:
                    classes.append(None)
                    tokens.append(None)
        return _sets(texts.out_ids(), prints, counts, classes, tokens)

    known = chunks.shared_keys(chunked, keys_of, buckets)
    return chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        sets, "doc_id long, text_md5 binary, n_shingles long, class binary, tokens array<long>")


def _sets(ids, prints, counts, classes, tokens) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "text_md5": pa.array(prints, pa.binary()), "n_shingles": pa.array(counts, pa.int64()),
                     "class": pa.array(classes, pa.binary()), "tokens": pa.array(tokens, pa.list_(pa.int64()))})


def _similar(common: Column, n: Column, m: Column, percent: int) -> Column:
    return common * 100 >= (n + m - common) * percent


def _few(frame: DataFrame) -> DataFrame:
    """A stored frame, broadcast when its counted rows are few enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of classes that are similar. ``pairs`` is stored; only the shingles of its classes are moved."""
    asked = _few(pairs.select("u", "v"))
    left = sets.select(F.col("class").alias("u"), F.col("n").alias("n_u"), F.col("tokens").alias("t_u")).join(asked, "u")
    right = sets.select(F.col("class").alias("v"), F.col("n").alias("n_v"), F.col("tokens").alias("t_v")).join(asked, "v")
    both = left.join(right, ["u", "v"])
    return both.where(_similar(F.size(F.array_intersect("t_u", "t_v")), F.col("n_u"), F.col("n_v"), percent)).select("u", "v")


def class_links(classes: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between classes that connect what the similarity connects.

    ``classes`` has class, n (set size) and tokens (shared shingles, rarest first).
    """
    size = F.size("tokens")
    least = F.floor((F.col("n") * percent + 99) / 100).cast("int")  # overlap that any link of this class has at least
    small = F.floor((F.col("n") * 2 * percent + 99 + percent) / (100 + percent)).cast("int")  # the same with a partner no smaller than it
    filed = classes.select("class", "n", size.alias("m"), small.alias("small"), F.posexplode(F.slice("tokens", 1, size - least + 1)).alias("at", "token"))
    # rest: how much two sets can share from here on; lower: whether a smaller set still has to be found here.
    filed = filed.select("class", "n", "m", "token", (F.col("m") - F.col("at")).alias("rest"),
                         (F.col("at") <= F.col("m") - F.col("small")).alias("lower"))
    # A shingle that one class is filed under makes no pair; after equal sets have become one class, most are of this kind.
    several = filed.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("token")
    filed = stored(filed.join(several, "token", "left_semi").select(*filed.columns), "prefixes")

    def fits(n: str, m: str, o: str, p: str) -> Column:
        return _similar(F.least(F.col(m), F.col(p)), F.col(n), F.col(o), percent)

    # Stars: under each shingle one class is the centre, and a class is held against the centre of another group that it meets most
    # often. The first centres have the most shared shingles (originals have more than their edited copies), the next the smallest
    # set.
    links, grouped = classes.select(F.col("class").alias("u"), F.col("class").alias("v")).where("false"), filed.withColumn("group", F.col("class"))
    root = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for by in CENTRES:
        seat = F.expr(by)
        centre = grouped.groupBy("token").agg(F.max_by(F.struct("class", "n", "m", "group"), F.struct(seat, "class")).alias("c"),
                                              F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b")
        met = grouped.join(centre.select("token", F.col("c.class").alias("v"), F.col("c.n").alias("n_v"), F.col("c.m").alias("m_v"),
                                         F.col("c.group").alias("other")), "token")
        met = met.where((F.col("group") != F.col("other")) & fits("n", "m", "n_v", "m_v"))
        voted = met.groupBy(F.col("class").alias("u"), "v").agg(F.count(F.lit(1)).alias("votes"))
        chosen = stored(voted.groupBy("u").agg(F.max(F.struct("votes", "v")).alias("best")).select("u", F.col("best.v").alias("v")), "stars")
        if chosen.isEmpty():  # no class fits the centre it meets; it can still fit another class, which the groups below find
            continue
        links = stored(links.unionByName(_verified(chosen, classes, percent)), "star-links")
        root = components(links)
        grouped = stored(filed.join(root.select(F.col("node").alias("class"), "root"), "class", "left").withColumn(
            "group", F.coalesce("root", "class")).drop("root"), "grouped-prefixes")

    # Groups, and the queries that meet another group under a shingle.
    mixed = grouped.groupBy("token").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b").select("token")
    part = grouped.join(mixed, "token", "left_semi")
    sides = part.where("lower").groupBy("token", "group").agg(F.min("n").alias("n_least"), F.max("rest").alias("rest_most"))
    ask = part.alias("q").join(sides.alias("g"), "token").where(
        (F.col("q.group") != F.col("g.group")) & (F.col("g.n_least") <= F.col("q.n"))
        & _similar(F.least(F.col("q.rest"), F.col("g.rest_most")), F.col("q.n"), F.col("g.n_least"), percent))
    ask = stored(ask.select("q.token", F.col("q.class").alias("class"), F.col("q.n").alias("n_u"), F.col("q.rest").alias("rest_u"),
                            F.col("g.group").alias("group")), "group-meetings")
    queries = stored(ask.select("class", "group").distinct(), "group-queries")
    member = classes.select("class").join(root.select(F.col("node").alias("class"), "root"), "class", "left").select(
        F.coalesce("root", "class").alias("group"), "class")
    wanted = stored(member.join(queries.select("group").distinct(), "group", "left_semi"), "wanted-members")
    union = classes.select("class", "tokens").join(_few(wanted), "class").select("group", F.explode("tokens").alias("token")).groupBy(
        "group").agg(F.collect_set("token").alias("union"))
    bounded = _few(queries).join(classes, "class").join(union, "group").where(
        F.size(F.array_intersect("tokens", "union")) * 100 >= F.col("n") * percent).select("class", "group")
    opened = stored(bounded, "opened-groups")

    # Members of an opened group that are filed under a shingle of the query.
    asking = ask.join(opened, ["class", "group"], "left_semi").withColumnRenamed("class", "u")
    pairs = asking.join(part.where("lower").select(F.col("class").alias("v"), "n", "rest", "token", "group"), ["token", "group"]).where(
        (F.col("n") <= F.col("n_u")) & fits("n_u", "rest_u", "n", "rest")).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return links.unionByName(_verified(stored(pairs, "member-pairs"), classes, percent))


def _linked(docs: DataFrame, size: int, percent: int, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The stored sets of all rows, and for every class with links its component's smallest id and first row.

    A row is an id (null last) and the MD5 of the text.
    """
    sets = stored(shingle_sets(docs, size, percent, chunk_bytes), "shingle-sets")
    candidates = sets.where(F.col("class").isNotNull())
    classes = stored(candidates.groupBy("class").agg(
        F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"), F.min(F.coalesce("doc_id", F.lit(LAST_ID))).alias("least_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")).alias("row")), "classes")
    root = components(class_links(classes.select("class", "n", "tokens"), percent))
    # Members of a class without outside links are linked with each other only if their shared part alone is enough.
    tight = _similar(F.size("tokens"), F.col("n"), F.col("n"), percent)
    linked = classes.select("class", "least_id", "row", tight.alias("tight")).join(
        root.select(F.col("node").alias("class"), "root"), "class", "left")
    told = linked.where(F.col("root").isNotNull() | F.col("tight")).select(
        "class", F.coalesce("root", "class").alias("root"), "least_id", "row")
    smallest = told.groupBy("root").agg(F.min("least_id").alias("component"), F.min("row").alias("first"))
    return sets, told.join(smallest, "root").select("class", "component", "first")


def link_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links."""
    sets, per_class = _linked(docs, size, percent, chunk_bytes)
    known_id = F.coalesce("doc_id", F.lit(LAST_ID))
    return sets.select("doc_id", "n_shingles", "class").join(per_class.select("class", "component"), "class", "left").select(
        "doc_id", "n_shingles", F.nullif(F.coalesce("component", known_id), F.lit(LAST_ID)).alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """All columns of the documents that stay: of every component one, of rows equal in id and text one.

    The one with the smallest id stays (null last), of several with that id the one whose text has the smallest MD5. Rows are told
    apart by id and text, so null and repeated ids neither keep nor drop each other.
    """
    sets, per_class = _linked(docs, size, percent, chunk_bytes)
    placed = sets.select("doc_id", "text_md5", "class").join(per_class.select("class", "first"), "class", "left")
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_md5") == F.col("text_md5"))
    kept_id, kept_md5 = fresh(docs, "kept_id"), fresh(docs, "kept_md5")
    stay = placed.where(F.col("first").isNull() | first).select(F.col("doc_id").alias(kept_id), F.col("text_md5").alias(kept_md5)).distinct()
    own = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = docs.join(stay, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (own == F.col(kept_md5)), "left_semi")
    return joined.dropDuplicates(["doc_id", "text"])
