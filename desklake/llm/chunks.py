"""Documents in chunks, and the exchange that tells each chunk which of its keys other documents hold too.

A chunk is all documents whose id hashes to one number; its size in bytes is a parameter, so the work of a task does not depend on how
much data there is. Keys (64-bit hashes of text parts) are exchanged as blobs, one per chunk and bucket: 26 bits of each key beside
the bucket, sorted, as differences. A key that meets another in these bits counts as shared; users compare the text itself later, so
this costs a few needless comparisons and never a result. A key leaves a chunk once, so one that stands in a third of all
documents is at most one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 500_000
BITS = 26
LAST_ID = np.iinfo(np.int64).max  # stands for a null id

_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """A compressed array; the length in bytes stands first."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], decompressed_size=size, codec=_CODEC, asbytes=True), dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """A sorted array of keys as differences in as few bytes as they take."""
    steps = np.diff(values, prepend=np.uint32(0)).astype(np.uint32)
    width = np.uint16 if steps.size == 0 or steps.max() < 1 << 16 else np.uint32
    return bytes([np.dtype(width).itemsize]) + pack(steps.astype(width))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob[1:], f"<u{blob[0]}"), dtype=np.uint32)


def in_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """doc_id (long), text and chunk number; and the bytes of all texts."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("long").alias("chunk")), total


class Texts:
    """The documents of a chunk ordered by id and text: ids and where each lies in one array of bytes."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        ids = rows.column("doc_id").combine_chunks()
        text = rows.column("text").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.int64())
        text = text.cast(pa.large_string()).fill_null("")
        self.null_ids = np.asarray(ids.is_null())
        self.ids = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        _, offsets, data = text.buffers()
        bounds = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        self.data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data and len(text) else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0] if len(text) else np.zeros(1, np.int64)

    def slices(self, most_bytes: int) -> Iterable[tuple[int, int]]:
        """Runs of whole documents of about ``most_bytes``, a longer document alone: (first, one past the last)."""
        first = 0
        while first < len(self.ids):
            last = int(np.searchsorted(self.bounds, self.bounds[first] + most_bytes, side="right")) - 1
            last = max(first + 1, last)
            yield first, last
            first = last

    def out_ids(self) -> pa.Array:
        return pa.array(self.ids, mask=self.null_ids)


def split_key(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the bits that stand for the key in it."""
    return ((keys & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64), (keys >> np.uint64(64 - BITS)).astype(np.uint32)


def joined_key(bucket: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bucket.astype(np.int64) << BITS) | bits.astype(np.int64)


def bucket_count(keys: float) -> int:
    return max(8, int(-(-keys // BUCKET_KEYS)))


def shared_keys(chunked: DataFrame, keys_of: Callable[[Texts], tuple[np.ndarray, np.ndarray]], buckets: int) -> DataFrame:
    """chunk, bucket, keys and levels: the keys of a chunk that at least two documents hold.

    ``keys_of`` gives a chunk's keys and, for each, the number of its document. A level grows with
    the logarithm of how often the key was met and is the same wherever the key stands.
    """
    def leave(rows: pa.Table) -> pa.Table:
        texts = Texts(rows)
        keys, documents = keys_of(texts)
        bucket, bits = split_key(keys, buckets)
        whole = joined_key(bucket, bits)
        order = np.argsort(whole, kind="stable")
        whole, documents = whole[order], documents[order]
        first = np.flatnonzero(np.diff(whole, prepend=-1))
        times = np.zeros(len(first), np.uint8)
        if len(first):  # how often a key of several documents stands here, else 1
            several = np.minimum.reduceat(documents, first) != np.maximum.reduceat(documents, first)
            times = np.where(several, np.minimum(np.diff(first, append=len(whole)), 255), 1).astype(np.uint8)
        whole = whole[first]
        edges = np.searchsorted(whole, np.arange(buckets + 1, dtype=np.int64) << BITS)
        mask = (1 << BITS) - 1
        own = [(b, pack_sorted((whole[x:y] & mask).astype(np.uint32)), pack(times[x:y]))
               for b, (x, y) in enumerate(zip(edges[:-1], edges[1:])) if y > x]
        chunk = rows.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array([x[0] for x in own], pa.int64()), "chunk": pa.array([chunk] * len(own), pa.int64()),
                         "keys": pa.array([x[1] for x in own], pa.binary()), "times": pa.array([x[2] for x in own], pa.binary())})

    def meet(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        chunks = rows.column("chunk").to_pylist()
        parts = [unpack_sorted(blob) for blob in rows.column("keys").to_pylist()]
        times = np.concatenate([unpack(blob, np.uint8) for blob in rows.column("times").to_pylist()])
        _, where = np.unique(np.concatenate(parts), return_inverse=True)
        held = np.bincount(where, weights=times)
        level = np.where(held >= 2, np.minimum(8 * np.log2(np.maximum(held, 2)), 255), 0).astype(np.uint8)[where]
        level = np.split(level, np.cumsum([len(part) for part in parts])[:-1])
        rest = [(chunk, part[own > 0], own[own > 0]) for chunk, part, own in zip(chunks, parts, level) if own.any()]
        return pa.table({"chunk": pa.array([x[0] for x in rest], pa.int64()), "bucket": pa.array([bucket] * len(rest), pa.int64()),
                         "keys": pa.array([pack_sorted(x[1]) for x in rest], pa.binary()),
                         "levels": pa.array([pack(x[2]) for x in rest], pa.binary())})

    left = chunked.groupBy("chunk").applyInArrow(leave, "bucket long, chunk long, keys binary, times binary")
    return left.groupBy("bucket").applyInArrow(meet, "chunk long, bucket long, keys binary, levels binary")


class Shared:
    """The shared keys of one chunk, to be asked for."""

    def __init__(self, rows: pa.Table, buckets: int):
        self.buckets = buckets
        parts = sorted(zip(rows.column("bucket").to_pylist(), rows.column("keys").to_pylist(), rows.column("levels").to_pylist()))
        found = [(joined_key(np.int64(bucket), unpack_sorted(keys)), unpack(levels, np.uint8)) for bucket, keys, levels in parts]
        self.keys = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
        self.levels = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.uint8)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """0 for a key that no other document holds, else its level."""
        if not len(self.keys):
            return np.zeros(len(keys), np.uint8)
        whole = joined_key(*split_key(keys, self.buckets))
        at = np.minimum(np.searchsorted(self.keys, whole), len(self.keys) - 1)
        return np.where(self.keys[at] == whole, self.levels[at], 0).astype(np.uint8)
