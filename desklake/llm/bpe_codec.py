"""Token ids of whole texts, encoding every distinct chunk once, and the texts decoded from them.

A rolling hash cuts texts into chunks, so that a passage is cut alike wherever it stands. A home is some megabytes of documents; each
of its distinct chunks, and of the seams (the last and first ``EDGE`` characters around a cut), goes once to the bucket its hash names.
The bucket encodes every distinct one once, whatever number of homes asked, and answers with ids and a word near each edge.
Back home the chunks of a document are joined: a seam replaces the ids from a word that the chunk before and the seam both have to a
word that the seam and the chunk after both have. Words are split from left to right without looking back, so scans that meet at
one word start agree from there on, and ``MARGIN`` characters away from an end nothing beyond it matters. Where they do not meet, the
whole text is encoded at home; it came along if some seam lacks a simple word between blanks in either half, which all scans split alike.

The text travels once, in compressed blobs, and its ids once. What a task holds are one home and one bucket; a chunk that stands
everywhere is in its bucket once for each home.

Words of Latin letters are split here and remembered with their ids, which come from the merges of the ``tokenizers`` library; other
chunks, those with the vocabulary's special tokens, and all of a vocabulary with other rules than ``KNOWN`` go through that library whole.

Defined cases: a null or empty text has no ids and decodes to an empty text; null and repeated ids are ids like any other, one row out
for each row in; other columns are ignored; an empty table gives no rows. A text is held whole in a task.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake.llm.chunks import unpack

LEAST_CHUNK, MOST_CHUNK, MASK = 1536, 8192, 1023
WINDOW = 16
EDGE, MARGIN = 64, 16
HOME_BYTES, BUCKET_BYTES = 16 << 20, 48 << 20
MOST_TASKS = 20_000
MEMORY_WORDS = 200_000
NONE = 0xFFFF
#: The rules of the vocabulary for which words are split here.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Characters whose class and small letter are the same everywhere, and which never combine with a neighbour.
USUAL = re.compile("[\t-\r -~¡-¬®-įı-ňŊ-ſ‐-―‘-•…‰‹›€]*")
LETTERS, NUMBERS = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼½¾"
PIECES = re.compile(f"[\t-\r ]*(?:'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\t-\r {LETTERS}{NUMBERS}]+)|[\t-\r ]+")
BLANKS = "\t\n\v\f\r "
BETWEEN_BLANKS = re.compile("(?<=[ \t\n])[^\\s]+(?=[ \t\n])")


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as they are and the others, in turn, as the characters from 256 on."""
    printable = [byte for byte in range(256) if 33 <= byte <= 126 or 161 <= byte <= 255 and byte != 173]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + k) for k, byte in enumerate(others)}


class _Words(dict):
    """Word, blanks before it included, to ids; new ones are asked from the vocabulary's merges, without its rules for whole texts."""

    def __init__(self, model):
        super().__init__()
        self.model, self.alphabet = model, byte_alphabet()

    def __missing__(self, piece: str) -> tuple[int, ...]:
        word = piece.lstrip(BLANKS)
        written = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        ids = self[piece] = tuple([token.id for token in self.model.tokenize(written)]) if word else ()
        return ids


class Codec:
    """One vocabulary in one Python worker."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(vocabulary, encoding="utf-8") as file:
            rules = json.load(file)
        self.splits_here = all(rules.get(name) == rule for name, rule in KNOWN.items()) and not rules["model"].get("dropout")
        self.special = [token["content"] for token in rules.get("added_tokens", [])]
        self.joins_here = rules.get("decoder") is None
        self.tokens = {number: token for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.kind = "<u2" if max(self.tokens, default=0) < 1 << 16 else "<u4"
        self.known = _Words(self.tokenizer.model)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids)) if self.joins_here else self.tokenizer.decode(ids, skip_special_tokens=False)

    def plain(self, text: str) -> bool:
        return self.splits_here and USUAL.fullmatch(text) is not None and not any(token in text for token in self.special)

    def of_words(self, pieces: list[str]) -> list[tuple[int, ...]]:
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
        return list(map(self.known.__getitem__, pieces))

    def whole(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.of_words(PIECES.findall(text.lower())))) if self.plain(text) else self.ids(text)

    def unit(self, text: str, spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
        """The ids, and the last word within each of two spans as (start, end, first id, one past the last id)."""
        if self.plain(text):
            pieces = PIECES.findall(text.lower())
            parts = self.of_words(pieces)
            ids = list(chain.from_iterable(parts))
            words = [_first_words(pieces, parts, spans[0][1]), _last_words(pieces, parts, len(text), len(ids), spans[1][0])]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False)
            ids = found.ids
            words = [_clean_words(found.offsets, found.word_ids)] * 2
        marks: list[int] = []
        for (low, high), own in zip(spans, words):
            inside = [word for word in own if word[0] >= low and word[1] <= high]
            marks += inside[-1] if inside else [NONE] * 4
        return ids, marks


def _first_words(pieces: list[str], parts: list[tuple[int, ...]], limit: int) -> list[tuple[int, int, int, int]]:
    out, place, token = [], 0, 0
    for piece, own in zip(pieces, parts):
        if place >= limit:
            break
        if own:
            out.append((place + len(piece) - len(piece.lstrip(BLANKS)), place + len(piece), token, token + len(own)))
        place, token = place + len(piece), token + len(own)
    return out


def _last_words(pieces: list[str], parts: list[tuple[int, ...]], place: int, token: int, limit: int) -> list[tuple[int, int, int, int]]:
    out = []
    for k in range(len(pieces) - 1, -1, -1):
        if place <= limit:
            break
        piece, own = pieces[k], parts[k]
        if own:
            out.append((place - len(piece.lstrip(BLANKS)), place, token - len(own), token))
        place, token = place - len(piece), token - len(own)
    return out[::-1]


def _clean_words(offsets: list[tuple[int, int]], words: list[int | None]) -> list[tuple[int, int, int, int]]:
    """Words that share no character with their neighbours."""
    out: list[list[int]] = []
    for token, ((start, end), word) in enumerate(zip(offsets, words)):
        if out and word is not None and word == out[-1][4]:
            out[-1][1], out[-1][3] = max(out[-1][1], end), token + 1
        else:
            out.append([start, end, token, token + 1, word])
    return [tuple(w[:4]) for k, w in enumerate(out)
            if (k == 0 or out[k - 1][1] <= w[0]) and (k + 1 == len(out) or w[1] <= out[k + 1][0])]


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def cut_points(data: np.ndarray) -> list[int]:
    """Where the rolling hash of the last ``WINDOW`` bytes ends in zeros, as numbers of bytes before the cut."""
    value = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    width, factor = 1, 0x85EBCA6B
    while width < WINDOW and len(value) > width:
        value = value[:-width] * np.uint32(pow(factor, width, 1 << 32)) + value[width:]
        width *= 2
    return (np.flatnonzero((value >> np.uint32(16)) & np.uint32(MASK) == 0) + width).tolist()


def chunks_of(text: bytes, cuts: list[int] | None = None) -> list[str]:
    """The chunks of a text; all but the last have ``LEAST_CHUNK`` bytes or more. A cut depends on the chunk before it only."""
    cuts = cut_points(np.frombuffer(text, np.uint8)) if cuts is None else cuts
    out, at, size = [], 0, len(text)
    while size - at > LEAST_CHUNK:
        k = bisect_left(cuts, at + LEAST_CHUNK)
        end = min(cuts[k] if k < len(cuts) else size, at + MOST_CHUNK)
        while end < size and text[end] & 0xC0 == 0x80:  # never inside a character
            end += 1
        if end >= size:
            break
        out.append(text[at:end].decode())
        at = end
    out.append(text[at:].decode())
    return out


def _seam(before: str, after: str) -> str:
    return before[-EDGE:] + after[:EDGE]


def _has_whole_word(text: str) -> bool:
    """Whether a simple word stands between blanks, so that every scan over it splits it alike."""
    return any(word.isalnum() and len(word.lower()) == len(word) and is_normalized("NFC", word) for word in BETWEEN_BLANKS.findall(text))


def _surely_meets(before: str, after: str, last: bool) -> bool:
    return _has_whole_word(before[-EDGE:-MARGIN]) and (last and len(after) <= EDGE or _has_whole_word(after[:EDGE - MARGIN]))


def _spans(kind: str, size: int) -> list[tuple[int, int]]:
    """Where a unit's words are asked for: near both ends of a chunk, in both halves of a seam."""
    return [(0, EDGE - MARGIN), (size - EDGE if kind == "c" else EDGE, size - MARGIN)]


def pack(values: np.ndarray) -> bytes:
    """A compressed array with its length in bytes first; slower and smaller than that of ``chunks``."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=9).compress(raw, asbytes=True)


def pack_texts(texts: list[str]) -> bytes:
    data = [text.encode() for text in texts]
    lengths = pack(np.array([len(d) for d in data], "<u2"))
    return len(lengths).to_bytes(4, "little") + lengths + pack(np.frombuffer(b"".join(data), np.uint8))


def unpack_texts(blob: bytes) -> list[str]:
    size = int.from_bytes(blob[:4], "little")
    edges = np.append(0, np.cumsum(unpack(blob[4:4 + size], "<u2"), dtype=np.int64)).tolist()
    data = unpack(blob[4 + size:], np.uint8).tobytes()
    return [data[a:b].decode() for a, b in zip(edges[:-1], edges[1:])]


def _packed(*arrays: np.ndarray) -> bytes:
    parts = [pack(array) for array in arrays]
    return b"".join(len(part).to_bytes(4, "little") + part for part in parts)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(blob[at:at + 4], "little")
        out.append(unpack(blob[at + 4:at + 4 + size], kind))
        at += 4 + size
    return out


class _Home:
    """Documents on their way: which units each is made of, and the distinct units by bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.size = buckets, 0
        self.places: dict[str, tuple[int, int]] = {}
        self.units: dict[int, list[str]] = {}
        self.ids, self.counts, self.refs, self.carried = [], [], [], []

    def add(self, doc_id: int | None, text: str) -> None:
        self.ids.append(doc_id)
        self.size += len(text) + 64
        chunks = chunks_of(text.encode())
        self.counts.append(len(chunks))
        sure = all(_surely_meets(chunks[k - 1], chunks[k], k + 1 == len(chunks)) for k in range(1, len(chunks)))
        self.carried.append("" if sure else text)
        for k, chunk in enumerate(chunks):
            if k:
                self.refs.append(self.place("s" + _seam(chunks[k - 1], chunk)))
            self.refs.append(self.place("c" + chunk))

    def place(self, unit: str) -> tuple[int, int]:
        if unit not in self.places:
            bucket = xxhash.xxh64_intdigest(unit.encode()) % self.buckets
            own = self.units.setdefault(bucket, [])
            self.places[unit] = bucket, len(own)
            own.append(unit)
        return self.places[unit]

    def rows(self, home: int) -> pa.RecordBatch:
        """A row per bucket, and one with what the home itself needs."""
        known = np.array([i is not None for i in self.ids])
        ids = np.array([i or 0 for i in self.ids], "<i8")
        carried = "\0".join(t.replace("\\", "\\\\").replace("\0", "\\0") for t in self.carried).encode()
        own = _packed(ids, known, np.array(self.counts, "<u4"), np.array(self.refs, "<i8").ravel(), np.frombuffer(carried, np.uint8))
        return _rows([(home, bucket, False, pack_texts(units)) for bucket, units in self.units.items()] + [(home, home % self.buckets, True, own)])


SCHEMA = pa.schema([("home", pa.int64()), ("bucket", pa.int64()), ("recipe", pa.bool_()), ("blob", pa.binary())])
COLUMNS = "home long, bucket long, recipe boolean, blob binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(column), kind) for column, kind in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


def _unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\0" if m[1] == "0" else m[1], text, flags=re.S)


class _Encoded:
    """Units of one bucket as they came back."""

    def __init__(self, blob: bytes):
        lengths, counts, ids, marks = _unpacked(blob, "<u2", "<u2", "<u2", "<u2")
        if len(ids) != counts.sum():  # ids of a larger vocabulary take two places
            ids = ids.view("<u4")
        self.lengths, self.ids = lengths, ids
        self.edges = np.append(0, np.cumsum(counts, dtype=np.int64))
        self.marks = marks.reshape(-1, 2, 4)

    def unit(self, k: int) -> tuple[int, list[int], list[list[int]]]:
        return int(self.lengths[k]), self.ids[self.edges[k]:self.edges[k + 1]].tolist(), self.marks[k].tolist()


def _pack_encoded(lengths: list[int], ids: list[np.ndarray], marks: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids)
    kind = "<u2" if not len(flat) or flat.max() < 1 << 16 else "<u4"
    return _packed(np.array(lengths, "<u2"), np.array([len(own) for own in ids], "<u2"), flat.astype(kind), np.concatenate(marks))


def _meet(one: list[int], ids_one: list[int], shift: int, other: list[int], ids_other: list[int]) -> tuple[int, int] | None:
    """The first id of a word that two units share, in both, if they do; ``shift`` is where the second starts in the first."""
    (start, end, first, last), (s, e, f, l) = one, other
    same = start != NONE and s != NONE and (start - shift, end - shift) == (s, e) and ids_one[first:last] == ids_other[f:l]
    return (first, f) if same else None


def joined(units: list[tuple[int, list[int], list]]) -> list[int] | None:
    """The ids of a document from its chunks and seams in turn; None if some of them do not meet."""
    size, ids, marks = units[0]
    out, begin = [], 0
    for k in range(1, len(units), 2):
        (_, seam, halves), (next_size, next_ids, next_marks) = units[k], units[k + 1]
        into = _meet(marks[1], ids, size - EDGE, halves[0], seam)
        if into is None or into[0] < begin:
            return None
        out += ids[begin:into[0]]
        leave = _meet(halves[1], seam, EDGE, next_marks[0], next_ids)
        if leave is not None and leave[0] >= into[1]:
            out += seam[into[1]:leave[0]]
            begin = leave[1]
        elif k + 2 == len(units) and next_size <= EDGE:  # the seam holds the rest of the text
            return out + seam[into[1]:]
        else:
            return None
        size, ids, marks = next_size, next_ids, next_marks
    return out + ids[begin:]


def encode(docs: DataFrame, vocabulary: str, home_bytes: int = HOME_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the text decoded from them, special tokens included.

    ``vocabulary`` is a file of the ``tokenizers`` library at the same path on every executor. Texts are encoded without added tokens.
    """
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, number = _Home(buckets), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                home.add(doc_id.as_py(), text.as_py() or "")
                if home.size >= home_bytes:
                    yield home.rows(number)
                    home, number = _Home(buckets), number + 1
        if home.ids:
            yield home.rows(number)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, present = codec(vocabulary), {}, None
        for batch in batches:
            for home, bucket, recipe, blob in zip(*(batch.column(name) for name in SCHEMA.names)):
                home, bucket, recipe, blob = home.as_py(), bucket.as_py(), recipe.as_py(), blob.as_py()
                if not recipe:
                    if bucket != present:
                        known, present = {}, bucket
                    units = unpack_texts(blob)
                    names = [xxhash.xxh128_digest(unit.encode()) for unit in units]  # shorter to keep than the units
                    for name, unit in zip(names, units):
                        if name not in known:
                            ids, marks = own.unit(unit[1:], _spans(unit[0], len(unit) - 1))
                            known[name] = np.array(ids, own.kind), np.array(marks, "<u2")
                    blob = _pack_encoded([len(unit) - 1 for unit in units], [known[n][0] for n in names], [known[n][1] for n in names])
                yield _rows([(home, bucket, recipe, blob)])

    def assemble(rows: pa.Table) -> pa.Table:
        own = codec(vocabulary)
        parts, recipe = {}, b""
        for bucket, is_recipe, blob in zip(*(rows.column(name).to_pylist() for name in ("bucket", "recipe", "blob"))):
            if is_recipe:
                recipe = blob
            else:
                parts[bucket] = _Encoded(blob)
        ids, known, counts, refs, carried = _unpacked(recipe, "<i8", "?", "<u4", "<i8", "u1")
        refs, at = refs.reshape(-1, 2).tolist(), 0
        out_ids, out_texts = [], []
        for count, text in zip(counts.tolist(), carried.tobytes().decode().split("\0")):
            found = joined([parts[bucket].unit(k) for bucket, k in refs[at:at + 2 * count - 1]])
            at += 2 * count - 1
            if found is None:
                found = own.whole(_unescaped(text))
            out_ids.append(np.array(found, "<u4").tobytes())
            out_texts.append(own.decode(found))
        return pa.table([pa.array(ids, mask=~known), pa.array(out_ids, pa.binary()), pa.array(out_texts, pa.string())], names=["doc_id", "ids", "decoded"])

    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(send, COLUMNS)
    # A task takes one bucket, or at great size several in turn; hashed to tasks, some would take three and others none.
    tasks = min(buckets, MOST_TASKS)
    dealt = sent.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket")
    answered = dealt.mapInArrow(answer, COLUMNS)
    return answered.groupBy("home").applyInArrow(assemble, "doc_id long, ids binary, decoded string")
