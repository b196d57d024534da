"""Best-two-fit packing of tokenized documents into sequences of fixed length.

Documents are tokenized in batches; only a document longer than a sequence is cut, into full sequences after a first piece that may be
shorter. Pieces then meet in groups of about ``GROUP_PIECES``, dealt by a hash: a bin is filled greedily with the longest piece
that fits; when nothing fits, its smallest piece gives way to two unpacked pieces that fill the wider gap more tightly. A
group leaves at most its last bins unfilled, so the groups cost next to nothing and bound what one task holds.

Ids are those of the ``tokenizers`` vocabulary file. That library makes about 1 MB/s a core here, so texts of ASCII, Latin letters and
common punctuation go through ``tiktoken`` with the same vocabulary as ranks, which splits and merges them alike; any other
text, and any with a special token of the vocabulary, goes through ``tokenizers`` itself.

Defined cases: a null or empty text is the end token alone; a null id is an id like any other; repeated rows are packed each; strings of
special tokens in a text are those tokens, as for ``tokenizers``; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import stored

CAPACITY, END_ID = 2048, 0
GROUP_PIECES = 32_768
SLICE_ROWS = 64
#: Characters that the two libraries might class differently (rarer blanks and letters of later Unicode versions).
UNUSUAL = re.compile(r"[\x1c-\x1f\x85\xa0ɐ-‏ -  -\U0010ffff]")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # the split rule of the vocabulary


def encoder(vocabulary: str, ranks: str | None) -> Callable[[list[str]], Iterator[list[int]]]:
    """A function from texts to their ids. ``ranks`` is the same vocabulary as a rank file; None does without it."""
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(vocabulary)
    special = [token.content for token in plain.get_added_tokens_decoder().values()]
    if ranks is None:
        return lambda texts: (found.ids for found in plain.encode_batch_fast(texts, add_special_tokens=False))
    import tiktoken
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    def ids(texts: list[str]) -> Iterator[list[int]]:
        for text in texts:
            whole = UNUSUAL.search(text) or any(token in text for token in special)
            yield plain.encode(text, add_special_tokens=False).ids if whole else fast.encode_ordinary(text)
    return ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = length % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary, ranks)
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                texts = [text or "" for text in part.column("text").to_pylist()]
                out = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), ids_of(texts)):
                    tokens = np.append(np.array(ids, "<u4"), np.uint32(END_ID))
                    out += [(doc_id, number, start, length, zlib.crc32(tokens[start:start + length].tobytes()))
                            for number, (start, length) in enumerate(cut(len(tokens), capacity))]
                yield pa.record_batch([pa.array(list(column)) for column in zip(*out)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _longest(present: int, most: int) -> int:
    """The longest length at hand up to ``most``; 0 if there is none. Bit n of ``present`` stands for length n."""
    return (present & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 and present & ((1 << (most + 1)) - 1) else 0


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece."""
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for piece, length in enumerate(lengths.tolist()):
        waiting[length].append(piece)
    present = sum(1 << length for length in range(1, capacity + 1) if waiting[length])
    mirrored = sum(1 << (capacity - length) for length in range(1, capacity + 1) if waiting[length])

    def take(length: int) -> int:
        nonlocal present, mirrored
        piece = waiting[length].pop()
        if not waiting[length]:
            present &= ~(1 << length)
            mirrored &= ~(1 << (capacity - length))
        return piece

    def give(length: int, piece: int) -> None:
        nonlocal present, mirrored
        waiting[length].append(piece)
        present |= 1 << length
        mirrored |= 1 << (capacity - length)

    def tightest_two(least: int, most: int) -> tuple[int, int] | None:
        """Two lengths with the largest sum above ``least`` and up to ``most``."""
        for total in range(most, least, -1):
            both = present & (mirrored >> (capacity - total))  # bit n: n and total - n are at hand
            if total % 2 == 0 and both >> (total // 2) & 1 and len(waiting[total // 2]) < 2:
                both &= ~(1 << (total // 2))
            if both:
                one = both.bit_length() - 1
                return one, total - one
        return None

    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    while present:
        gap, held = capacity, []
        while longest := _longest(present, gap):
            held.append((longest, take(longest)))
            gap -= longest
        if gap and present:
            smallest = held[-1][0]
            if two := tightest_two(smallest, gap + smallest):
                length, piece = held.pop()
                held += [(two[0], take(two[0])), (two[1], take(two[1]))]
                give(length, piece)
        at = 0
        for length, piece in held:
            bins[piece], offsets[piece] = number, at
            at += length
        number += 1
    return bins, offsets


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset. Reads ``parts`` twice, so it should be stored."""
    groups = max(1, -(-parts.count() // group_pieces))
    dealt = parts.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        bins, offsets = best_two_fit(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=(group["part"].to_numpy() << 32) | bins, offset=offsets).drop(columns="part")
    return dealt.groupBy("part").applyInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, vocabulary, ranks, capacity), "pieces"), capacity)
