"""Removal of repeated byte strings by suffix sorting, deep after shallow.

Every ``span``-byte window of every text is a suffix cut to ``span`` bytes. Windows are gathered by the smallest hash of the ``GRAM``-byte
strings in them: equal windows share it, and neighbouring windows with the same one form a segment, so a window travels with its
neighbours. Segments whose hash no other document holds (``chunks.shared_keys``) cannot hold a repeated window and stay at home.
The others are sorted in their bucket: multikey quicksort over words of eight bytes to a depth of ``SHALLOW`` bytes, then blind
tries order the groups whose common prefix is longer. First whole segments are sorted, so equal ones become one with the
smallest document id; then the windows of segments that share a hash and still differ. A window goes where a document with
a smaller id holds it too. Copies of a segment inside one chunk are folded before they travel, which bounds a
hot passage by the number of chunks.

Defined cases: a null text is empty; a null id counts as greater than all others; rows that share an id never remove from each other and
each gives a row; texts shorter than ``span`` stay whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from desklake.llm import chunks
from desklake.llm.chunks import Shared, Texts, pack, unpack

SPAN, GRAM = 50, 24
SHALLOW = 16
LEAF = 1 << 16       # below this many suffixes a quicksort part is sorted at once
MOST_WINDOWS = 64    # windows in a segment
SLICE_BYTES = 256 << 10
SORTED_AT_ONCE = 200_000

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)  # a fixed value for each byte
_STEP = np.uint64(0x9E3779B97F4A7C15)


# --- windows and segments -------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size``-byte string, by doubling."""
    whole, covered, power, hashed = None, 0, 1, _BYTE[data]
    with np.errstate(over="ignore"):
        while True:
            if size & power:
                n = len(data) - covered - power + 1
                part = hashed[covered:covered + n]
                whole = part.copy() if whole is None else whole[:n] * (_STEP ^ np.uint64(power << 1)) + part
                covered += power
            if power * 2 > size:
                break
            hashed = hashed[:-power] * (_STEP + np.uint64(power * 2)) + hashed[power:]
            power *= 2
        whole ^= whole >> np.uint64(31)
        whole *= np.uint64(0xBF58476D1CE4E5B9)
        whole ^= whole >> np.uint64(29)
    return whole


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:len(values) - (width - reach)], values[width - reach:]) if width > reach else values


def segments(texts: Texts, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, start in the chunk, windows and document number of all segments of a chunk."""
    found = []
    for first, last in texts.slices(SLICE_BYTES):
        base = texts.bounds[first]
        data = texts.data[base:texts.bounds[last]]
        if len(data) < span:
            continue
        least = sliding_min(gram_hashes(data, GRAM), span - GRAM + 1)
        bounds = texts.bounds[first:last + 1] - base
        outside = np.zeros(len(data) + 1, np.int8)  # windows that would cross the end of their document
        begin = np.maximum(bounds[1:] - span + 1, bounds[:-1])
        np.add.at(outside, begin, 1)
        np.add.at(outside, bounds[1:], -1)
        inside = np.cumsum(outside[:len(least)], dtype=np.int8) == 0
        cut = np.empty(len(least), bool)
        cut[0] = True
        np.not_equal(least[1:], least[:-1], out=cut[1:])
        starts = bounds[:-1]
        cut[starts[starts < len(cut)]] = True
        cut[1:] |= inside[1:] != inside[:-1]
        at = np.flatnonzero(cut)
        size = np.diff(at, append=len(least))
        keep = inside[at]
        at, size = at[keep], size[keep]
        if len(size) and size.max() > MOST_WINDOWS:
            pieces = -(-size // MOST_WINDOWS)
            order = np.repeat(np.arange(len(at)), pieces)
            step = np.arange(len(order)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at, size = at[order] + step * MOST_WINDOWS, np.minimum(size[order] - step * MOST_WINDOWS, MOST_WINDOWS)
        document = np.searchsorted(bounds, at, side="right") - 1 + first
        found.append((least[at], at + base, size, document))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


# --- deep-shallow sorting -------------------------------------------------------------------------

def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words: three-way partitions by one word at a time, small parts at once."""
    ordered, parts = [], [(np.arange(len(words)), 0)]
    while parts:
        rows, level = parts.pop()
        if len(rows) <= LEAF or level == words.shape[1] - 1:
            rest = words[rows, level:]
            ordered.append(rows[np.lexsort(rest.T[::-1])])
            continue
        column = words[rows, level]
        pivot = np.sort(column[:: max(1, len(column) // 63)])[31]
        same = column == pivot
        less = column < pivot
        for part, deeper in ((rows[~(less | same)], level), (rows[same], level + 1), (rows[less], level)):
            if len(part):
                parts.append((part, deeper))
    return np.concatenate(ordered) if ordered else np.zeros(0, np.int64)


def blind_tries(strings: np.ndarray, order: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Order inside groups of strings that agree to ``depth``; all groups grow their tries at once.

    The first string of a group is a path of its trie. Every other string leaves that path at its first differing byte: it is filed
    by the position of that branch, the side of it and the branching byte, without looking at anything between. Strings
    filed alike form the subtrie below the branch and are treated the same way, from the byte after it.
    """
    order = order.copy()
    end = strings.shape[1]
    active = np.arange(len(order))
    start = np.full(len(order), depth)
    while len(active):
        head = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(head, append=len(group))
        many = np.repeat(size, size) > 1
        active, start, group, = active[many], start[many], group[many]
        if not len(active):
            break
        head = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(head, append=len(group))
        own = strings[order[active]]
        path = np.repeat(own[head], size, axis=0)
        other = own != path
        other &= np.arange(end)[None, :] >= start[:, None]
        differs = other.any(axis=1)
        branch = np.where(differs, other.argmax(axis=1), end)
        row, at = np.arange(len(own)), np.minimum(branch, end - 1)
        byte = np.where(differs, own[row, at], 0).astype(np.int64)
        filed = np.where(~differs, end, np.where(byte < path[row, at], branch, 2 * end - branch))
        code = (filed.astype(np.int64) << 8) | byte
        by = np.lexsort((code, group))
        order[active] = order[active][by]
        code, group, branch, differs = code[by], group[by], branch[by], differs[by]
        new = np.ones(len(by), bool)
        new[1:] = (group[1:] != group[:-1]) | (code[1:] != code[:-1])
        group = np.cumsum(new)
        start = branch + 1
        active, start, group = active[differs], start[differs], group[differs]
    return order


def deep_shallow(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of equally long byte strings, and for each string in that order the number of its group of equals."""
    n, end = strings.shape
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth = min(SHALLOW, end)
    top = np.zeros((n, SHALLOW), np.uint8)
    top[:, :depth] = strings[:, :depth]
    words = top.view(">u8").astype(np.uint64)
    order = multikey_quicksort(words)
    new = np.ones(n, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    group = np.cumsum(new)
    if end > depth:
        order = blind_tries(strings, order, group, depth)
    new[1:] = (strings[order[1:]] != strings[order[:-1]]).any(axis=1)
    return order, np.cumsum(new) - 1


def cut_out(data: np.ndarray, at: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes: what stands at ``at``, zero beyond ``length``, and the length in the last byte."""
    reach = np.arange(width - 1)
    rows = np.zeros((len(at), width), np.uint8)
    rows[:, :-1] = data[np.minimum(at[:, None] + reach, len(data) - 1)]
    rows[:, :-1][reach[None, :] >= length[:, None]] = 0
    rows[:, -1] = length
    return rows


def smallest(order: np.ndarray, group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each string the smallest id among its equals."""
    out = np.empty(len(ids), np.int64)
    if len(ids):
        head = np.flatnonzero(np.diff(group, prepend=-1))
        out[order] = np.minimum.reduceat(ids[order], head)[group]
    return out


# --- the job --------------------------------------------------------------------------------------

def _by_bucket(bucket: np.ndarray, buckets: int):
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, order[x:y]) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:])) if y > x]


def _slabs(keys: np.ndarray, most: int):
    """Bounds of runs of about ``most`` sorted keys that never part equal ones."""
    edges, first = np.append(np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1 if len(keys) else 0)), len(keys)), 0
    while first < len(keys):
        last = edges[min(len(edges) - 1, np.searchsorted(edges, first + most, side="left"))]
        last = int(last) if last > first else len(keys)
        yield first, last
        first = last


def remove_repeats(docs: DataFrame, span: int = SPAN, chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every document."""
    chunked, total = chunks.in_chunks(docs, chunk_bytes)
    buckets = chunks.bucket_count(2 * total / (span - GRAM + 2))
    width = span + MOST_WINDOWS  # the longest segment has span - 1 + MOST_WINDOWS bytes; one more for its length

    def keys_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        key, _, _, document = segments(texts, span)
        return key, texts.ids[document] if len(document) else document

    def leave(rows: pa.Table, known: pa.Table) -> pa.Table:
        """Segments with a shared key go to their bucket; those with an equal in an earlier document of the chunk are decided here."""
        if not rows.num_rows:
            return _sent([])
        texts, chunk = Texts(rows), rows.column("chunk")[0].as_py()
        key, start, size, document = segments(texts, span)
        held = np.flatnonzero(Shared(known, buckets).level(key))
        key, start, size, ids = key[held], start[held], size[held], texts.ids[document[held]]
        by = np.argsort(key, kind="stable")
        key, start, size, ids = key[by], start[by], size[by], ids[by]
        late = np.zeros(len(key), bool)
        for x, y in _slabs(key, SORTED_AT_ONCE):
            strings = cut_out(texts.data, start[x:y], size[x:y] + span - 1, width)
            order, group = deep_shallow(strings)
            late[x:y] = ids[x:y] > smallest(order, group, ids[x:y])
        out = []
        if late.any():
            out.append((chunk % buckets, chunk, 1, *_ranges(start[late], size[late]), b"", b"", b""))
        by = np.flatnonzero(~late)
        by = by[np.argsort(start[by], kind="stable")]
        key, start, size, ids = key[by], start[by], size[by], ids[by]
        for b, own in _by_bucket(chunks.split_key(key, buckets)[0], buckets):
            length = size[own] + span - 1
            place = np.repeat(start[own] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
            out.append((b, chunk, 0, *_ranges(start[own], size[own]), pack((key[own] >> np.uint64(32)).astype(np.uint32)),
                        pack(np.diff(ids[own], prepend=0)), pack(texts.data[place])))
        return _sent(out)

    def meet(rows: pa.Table) -> pa.Table:
        """Sorts the segments of a bucket and tells each chunk which bytes go."""
        out, parts = [], []
        for number in range(rows.num_rows):
            chunk, kind, start, size, key, ids, text = (rows.column(c)[number].as_py() for c in
                                                        ("chunk", "kind", "start", "size", "key", "ids", "text"))
            if kind:
                out.append((chunk, start, size))
            else:
                start, size = _unpack_ranges(start, size)
                parts.append((np.full(len(start), chunk), start, size, unpack(key, np.uint32), np.cumsum(unpack(ids, np.int64)),
                              unpack(text, np.uint8)))
        if not parts:
            return _told(out)
        chunk, start, size, key, ids, text = (np.concatenate(x) for x in zip(*parts))
        length = size + span - 1
        place = np.cumsum(length) - length
        by = np.argsort(key, kind="stable")
        gone = []
        for x, y in _slabs(key[by], SORTED_AT_ONCE):
            own = by[x:y]
            order, group = deep_shallow(cut_out(text, place[own], length[own], width))
            least = smallest(order, group, ids[own])
            late = ids[own] > least
            gone.append((chunk[own[late]], start[own[late]], size[own[late]]))
            # What is left is compared window by window, one segment for its equals, where a hash has several different ones.
            distinct = order[np.flatnonzero(np.diff(group, prepend=-1))]
            kinds, where, count = np.unique(key[own[distinct]], return_inverse=True, return_counts=True)
            open_ = distinct[count[where] > 1]
            open_ = open_[np.argsort(key[own[open_]], kind="stable")]
            verdict = {}
            for p, q in _slabs(key[own[open_]], SORTED_AT_ONCE // 8):
                part = open_[p:q]
                windows = size[own[part]]
                segment = np.repeat(np.arange(len(part)), windows)
                step = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = place[own[part]][segment] + step
                strings = text[at[:, None] + np.arange(span)]
                worder, wgroup = deep_shallow(strings)
                wids = least[part][segment]
                hit = wids > smallest(worder, wgroup, wids)
                gone_to = group_of(order, group, part)
                for s, w in zip(segment[hit], step[hit]):
                    verdict.setdefault(int(gone_to[s]), []).append(int(w))
            if verdict:
                rank = np.empty(len(own), np.int64)
                rank[order] = group
                kept = np.flatnonzero(~late)
                kept = kept[np.isin(rank[kept], np.fromiter(verdict, np.int64))]
                pairs = [(i, w) for i in kept for w in verdict[int(rank[i])]]
                i, w = (np.array(v, np.int64) for v in zip(*pairs))
                gone.append((chunk[own[i]], start[own[i]] + w, np.ones(len(i), np.int64)))
        chunk, start, size = (np.concatenate(x) for x in zip(*gone))
        by = np.lexsort((start, chunk))
        heads = np.flatnonzero(np.diff(chunk[by], prepend=-1))
        for x, y in zip(heads, np.append(heads[1:], len(by))):
            out.append((int(chunk[by[x]]), *_ranges(start[by[x:y]], size[by[x:y]])))
        return _told(out)

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _result([], [], [], [], [])
        texts = Texts(rows)
        n = len(texts.data)
        edge = np.zeros(n + 1, np.int32)
        for start, size in zip(told.column("start").to_pylist(), told.column("size").to_pylist()):
            start, size = _unpack_ranges(start, size)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + size + span - 1, -1)
        gone = np.cumsum(edge)[:n] > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        begins = texts.bounds[:-1][texts.bounds[:-1] < n]
        opens[begins] = gone[begins]
        total_gone, total_open = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(opens))
        lo, hi = texts.bounds[:-1], texts.bounds[1:]
        removed = total_gone[hi] - total_gone[lo]
        kept = [texts.data[a:b].tobytes() if not r else texts.data[a:b][~gone[a:b]].tobytes() for a, b, r in zip(lo, hi, removed)]
        return _result(texts.out_ids(), hi - lo, removed, total_open[hi] - total_open[lo], kept)

    known = chunks.shared_keys(chunked, keys_of, buckets)
    sent = chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        leave, "bucket long, chunk long, kind long, start binary, size binary, key binary, ids binary, text binary")
    told = sent.groupBy("bucket").applyInArrow(meet, "chunk long, start binary, size binary")
    return chunked.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def group_of(order: np.ndarray, group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The group numbers of some strings."""
    rank = np.empty(len(order), np.int64)
    rank[order] = group
    return rank[strings]


def _table(rows: list[tuple], names: str, longs: int) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names.split())
    return pa.table({name: pa.array(list(values), pa.int64() if i < longs else pa.binary())
                     for i, (name, values) in enumerate(zip(names.split(), columns))})


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[bytes, bytes]:
    """Where segments start and how many windows they have, in order of start."""
    by = np.argsort(start, kind="stable")
    return chunks.pack_sorted(start[by].astype(np.uint32)), pack(size[by].astype(np.uint8))


def _unpack_ranges(start: bytes, size: bytes) -> tuple[np.ndarray, np.ndarray]:
    return chunks.unpack_sorted(start).astype(np.int64), unpack(size, np.uint8).astype(np.int64)


def _sent(rows: list[tuple]) -> pa.Table:
    return _table(rows, "bucket chunk kind start size key ids text", 3)


def _told(rows: list[tuple]) -> pa.Table:
    return _table(rows, "chunk start size", 1)


def _result(ids, n_bytes, removed, spans, kept) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})
