"""Maximal periodic runs of words in every text, found by recompression.

The words of a block of texts become one sequence of numbers with a number of its own between texts. Recompression builds a grammar over
it: runs of one symbol and then pairs of neighbouring symbols are replaced everywhere at once, until one symbol is left. Equal stretches
are parsed alike but near their ends, so the longest common extension of two positions is walked up and down the levels in a few steps
a level, for all asked positions together; nodes are skipped only if their symbols are equal, which makes the answer exact.

A run of period p that is long enough holds a multiple g of p at which the words from g and from g + p agree over ``probe`` words, so these
grid points are the candidates. Extensions to both sides of one point give the run and cover the points that lie in it. Multiples
of a run's period find the same stretch again; the smallest period names it.

Defined cases: a null, empty or blank text has no words and no runs; null and repeated ids are ids like any other, one row out for each
row in; equal runs of repeated rows are found for each; other columns are ignored; an empty table gives no rows. A text is held
whole in a task, with some two hundred bytes of working memory a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_POWER = 24, 3
BLOCK_WORDS = 200_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class Level:
    """One sequence of the grammar: its symbols, and where each node of the next sequence starts in it (none at the top)."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray | None):
        size = len(symbols)
        self.symbols, self.starts = symbols, starts
        self.ended = np.append(symbols, -1)  # one past the end equals nothing
        edges = np.append(np.flatnonzero(np.diff(symbols, prepend=-1)), size)
        self.until = np.append(np.repeat(edges[1:], np.diff(edges)), size)  # one past the equal symbols from here
        self.first = np.zeros(size + 1, bool)
        if starts is not None:
            self.first[starts] = self.first[size] = True
            self.up = np.append(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, size))), len(starts))
            self.down = np.append(starts, size)

    def mirrored(self) -> Level:
        if self.starts is None:
            return Level(self.symbols[::-1].copy(), None)
        return Level(self.symbols[::-1].copy(), (len(self.symbols) - self.down[1:])[::-1])


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Starts and names of the runs of equal symbols; None if no symbol is repeated at once."""
    starts = np.flatnonzero(np.diff(symbols, prepend=-1))
    if len(starts) == len(symbols):
        return None
    lengths = np.diff(np.append(starts, len(symbols)))
    return starts, _named(symbols[starts] * (lengths.max() + 1) + lengths)


def _pairs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names after replacing every pair of a left symbol and a right one; a hash parts the symbols."""
    kinds = int(symbols.max()) + 1
    for attempt in range(1, 65):
        factor = np.uint64(int(ODD) * (2 * attempt + 1) % (1 << 64))
        side = ((np.arange(1, kinds + 1, dtype=np.uint64) * factor >> np.uint64(37)) & np.uint64(1)).astype(np.int8)
        step = np.diff(side[symbols])
        second = np.flatnonzero(step == 1) if np.count_nonzero(step == 1) >= np.count_nonzero(step == -1) else np.flatnonzero(step == -1)
        if len(second):
            break
    else:  # any one pair of neighbours will do
        second = np.flatnonzero((symbols[:-1] == symbols[0]) & (symbols[1:] == symbols[1]))
    follower = np.zeros(len(symbols), np.int64)
    follower[second] = symbols[second + 1] + 1
    kept = np.ones(len(symbols), bool)
    kept[second + 1] = False
    starts = np.flatnonzero(kept)
    return starts, _named(symbols[starts] * (kinds + 1) + follower[starts])


class Grammar:
    """A run-length grammar of a sequence of numbers from 0, answering longest common extensions."""

    def __init__(self, symbols: np.ndarray | None, levels: list[Level] | None = None):
        self.levels = levels or []
        while levels is None and symbols is not None:
            if len(symbols) < 2:
                self.levels.append(Level(symbols, None))
                break
            starts, names = _blocks(symbols) or _pairs(symbols)
            self.levels.append(Level(symbols, starts))
            symbols = names

    def mirrored(self) -> Grammar:
        """The grammar of the reversed sequence."""
        return Grammar(None, [level.mirrored() for level in self.levels])

    def extension(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far the sequences from ``one`` and from ``other`` agree, for pairs of different positions."""
        reached, x, y, asked = one.copy(), one.copy(), other.copy(), np.arange(len(one))
        fallen = []
        for level in self.levels:  # upwards while whole nodes agree
            above, here = [], np.arange(len(asked))
            down = []
            while len(here):
                a, b = x[here], y[here]
                same = level.ended[a] == level.ended[b]
                rise = same & level.first[a] & level.first[b]
                step = same & ~rise
                down.append(here[~same])
                above.append(here[rise])
                by = np.minimum(level.until[a[step]] - a[step], level.until[b[step]] - b[step])
                here = here[step]
                x[here] += by
                y[here] += by
            lost = np.concatenate(down) if down else here
            fallen.append((asked[lost], x[lost], y[lost]))
            rest = np.concatenate(above) if above else here
            if not len(rest):
                break
            asked, x, y = asked[rest], level.up[x[rest]], level.up[y[rest]]
        asked, x, y = (np.zeros(0, np.int64) for _ in range(3))
        for number in range(len(fallen) - 1, -1, -1):  # downwards to the first word that differs
            level = self.levels[number]
            if len(asked):
                x, y = level.down[x], level.down[y]
            asked, x, y = (np.concatenate(both) for both in zip((asked, x, y), fallen[number]))
            here = np.flatnonzero(level.ended[x] == level.ended[y])
            while len(here):
                by = np.minimum(level.until[x[here]] - x[here], level.until[y[here]] - y[here])
                x[here] += by
                y[here] += by
                here = here[level.ended[x[here]] == level.ended[y[here]]]
        reached[asked] = x
        return reached - one


def probe_words(least_words: int, least_power: int) -> int:
    """The most words over which a grid point of any run surely agrees with the next."""
    return min(max(least_words, least_power * period) - 2 * period + 1 for period in range(1, least_words + 2))


def _probes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in turn; equal words give equal hashes."""
    value, width = words.astype(np.uint64) * ODD + np.uint64(1), 1
    value ^= value >> np.uint64(29)
    single, total, done = value, None, 0
    while size:
        if size & 1:
            total = value if total is None else total[:len(total) - width] * (ODD + np.uint64(2 * width)) + value[done:]
            total = total[:max(0, len(single) - done - width + 1)]
            done += width
        size >>= 1
        if size:
            value = value[:-width] * (ODD ^ np.uint64(4 * width)) + value[width:] if len(value) > width else value[:0]
            width *= 2
    return total


def _chains(probes: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(period, grid point, how many grid points in turn) wherever a grid point and the next have equal probes."""
    found = []
    ordered = np.sort(probes)
    if not (ordered[1:] == ordered[:-1]).any():
        return found
    for period in range(1, min(longest, len(probes) - 1) + 1):
        equal = probes[:-period:period] == probes[period::period]
        if equal.any():
            at = np.flatnonzero(equal)
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            counts = np.diff(np.append(begins, len(at)))
            found += [(period, point * period, count) for point, count in zip(at[begins].tolist(), counts.tolist())]
    return found


def runs_of(texts: list[list[bytes]], least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> list[np.ndarray]:
    """For every list of words the runs as rows (start, length, period), by start and then period."""
    probe = probe_words(least_words, least_power)
    found: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    sequence, chains, offset = [], [], 1
    for number, words in enumerate(texts):
        if len(words) < least_words:
            continue
        numbers = pd.factorize(np.array(words, dtype=object))[0]
        own = _chains(_probes(numbers, probe), len(words) // least_power)
        if own:
            sequence.append(words)
            chains.append(np.array([(number, offset, *chain) for chain in own], np.int64))
            offset += len(words) + 1
    if not chains:
        return found
    flat = np.array([word for words in sequence for word in words], dtype=object)
    numbers, kinds = pd.factorize(flat)
    edges = np.cumsum([0, *(len(words) for words in sequence)])
    symbols = np.insert(numbers.astype(np.int64), edges, len(kinds) + np.arange(len(edges)))
    grammar = Grammar(symbols)
    backward = grammar.mirrored()
    number, base, period, point, count = np.concatenate(chains).T
    kept = []
    while len(number):
        x = base + point
        end = x + period + grammar.extension(x, x + period)
        start = x - backward.extension(len(symbols) - x, len(symbols) - x - period)
        whole = end - start >= np.maximum(least_words, least_power * period)
        kept.append(np.stack([number, start - base, end - start, period], 1)[whole])
        covered = -(-(end - x - period) // period)
        left = count > covered
        number, base, period, point, count = (a[left] for a in (number, base, period, point + covered * period, count - covered))
    rows = np.concatenate(kept)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(True, (np.diff(rows[:, :3], axis=0) != 0).any(1))] if len(rows) else rows  # the smallest period names a stretch
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[a:b, 1:] for a, b in zip(bounds[:-1], bounds[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those of a run after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period, then the smallest start, then the smallest period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start and then period), the strongest run, and the collapsed text.

    A run is a stretch of at least ``least_words`` words and ``least_power`` (3 or more) periods that no neighbouring word extends.
    """
    if least_power < 3:
        raise ValueError("least_power must be 3 or more")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("best", run), ("collapsed", pa.string())])

    def answer(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts, least_words, least_power)
        best = [strongest(runs) for runs in found]
        as_struct = [None if b is None else dict(zip(("start", "length", "period"), b)) for b in best]
        flat = np.concatenate(found)
        values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(run))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), values)
        kept = [collapsed(words, runs).decode() for words, runs in zip(texts, found)]
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), lists, pa.array(as_struct, run),
                                pa.array(kept, pa.string())], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids.append(doc_id.as_py())
                texts.append((text.as_py() or "").encode().split())  # bytes part at the six ASCII blanks
                size += len(texts[-1])
                if size >= BLOCK_WORDS:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield answer(ids, texts)

    of_run = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, f"doc_id long, n_words long, runs array<{of_run}>, best {of_run}, collapsed string")
