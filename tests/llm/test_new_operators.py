"""Lexical search and periodic runs against plain Python, with odd and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SMALL
from desklake.llm import bpe_codec, lexical_search, periodic_runs
from desklake.llm.queries import op13_periodic_runs, with_planted_periods
from test_operators import FOLD, LAST, by_text, nothing, odd, rows_of  # noqa: F401


def ranks_by_hand(rows, items, top):
    def terms(text):
        return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    docs = [(doc_id, Counter(terms(text))) for doc_id, text in rows if terms(text)]
    held = Counter(term for _, own in docs for term in own)
    total = sum(sum(own.values()) for _, own in docs)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, own in asked.items():
        scored = []
        for doc_id, times in docs:
            m = 10 + 90 * sum(times.values()) * len(docs) // total
            score = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * held[t] + 1))) * (10 ** 9 * times[t] // (1000 * times[t] + 8 * m))
                        for t in own if t in times)
            scored += [(-score, LAST if doc_id is None else doc_id)] if score > 0 else []
        out += [(item_id, rank, None if i == LAST else i, -score) for rank, (score, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def awkward_texts():
    """Texts that are hard to cut and join: no blanks, combining marks, special tokens everywhere, letters that grow, shared passages."""
    draw = random.Random(11)
    alphabets = ["ab .'", "aé'sß ", "日本語テキ、", "a\u0301e\u0327\u0300 ", "İıſŉ'LL ", "<|endoftext|>", "0123½² \x85\xa0\u2028", "가\u1100\u1161 x", "\x00\x1c\\ 'D"]
    texts = ["".join(draw.choices(letters, k=draw.choice((50, 600, 3000, 9000)))) for letters in alphabets for _ in range(6)]
    texts += ["<|endoftext|>" * 300, "x" * 501 + "<|startoftext|>y " * 200, "word " * 2000, "ab" * 5000, "a" + "\u0301" * 5000]
    passage = "".join(draw.choices("etaoin shrdlu,.'s é", k=4000))
    texts += ["".join(draw.choices("abc de", k=draw.randrange(900))) + passage + str(k) for k in range(12)]
    texts += ["".join(draw.choice(alphabets[:5]) if draw.random() < 0.3 else draw.choice("qwertz uiop's 12 ") for _ in range(5000)) for _ in range(6)]
    return texts


def test_chunks_follow_the_content():
    draw = random.Random(4)
    passage = "".join(draw.choices("etaoin shrdlu", k=20_000))
    one, other = bpe_codec.chunks_of(("x" * 700 + passage).encode()), bpe_codec.chunks_of(("another beginning " * 90 + passage).encode())
    assert len(set(one) & set(other)) > 0.6 * len(one)
    for text in awkward_texts():
        chunks = bpe_codec.chunks_of(text.encode())
        assert "".join(chunks) == text
        assert all(bpe_codec.LEAST_CHUNK <= len(c.encode()) <= bpe_codec.MOST_CHUNK + 3 for c in chunks[:-1])


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k", "byte_bpe_50k"])
def test_ids_and_texts_are_those_of_the_library(spark, odd, vocabulary):  # noqa: F811
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(f"{vocabulary}.json")
    plain = Tokenizer.from_file(path)
    rows = list(enumerate(awkward_texts())) + rows_of(spark.read.parquet(f"{SMALL}/documents.parquet")) + rows_of(odd)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bucket", "2 as home", "3 as ids").repartition(3)
    got = [(r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe_codec.encode(docs, path, home_bytes=100_000, bucket_bytes=60_000).collect()]
    want = []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, np.array(ids, "<u4").tobytes(), plain.decode(ids, skip_special_tokens=False)))
    assert by_text(got) == by_text(want)
    assert bpe_codec.encode(docs.where("false"), path).count() == 0


def test_every_distinct_unit_is_sent_once_a_home_and_most_texts_stay(spark):
    home = bpe_codec._Home(buckets=5)
    texts = [text for _, text in rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))] * 2
    for k, text in enumerate(texts):
        home.add(k, text or "")
    units = [unit for own in home.units.values() for unit in own]
    assert len(units) == len(set(units)) <= len(home.refs) / 2
    assert sum(map(bool, home.carried)) < 0.1 * len(texts)


ITEMS = [(1, "Quick FOX, the hill"), (2, "line"), (2, "ab watch"), (3, None), (4, "--"), (None, "éàü one two"), (5, "absent"), (6, "dog dog first")]


@pytest.mark.parametrize("block_pairs", [200_000, 3])
def test_search_on_odd_rows(spark, odd, nothing, block_pairs):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as item", "3 as score")
    for top in ((1, 3, 10) if block_pairs > 3 else (3,)):
        got = [tuple(row) for row in lexical_search.search(odd, items, top, block_pairs).collect()]
        assert by_text(got) == by_text(ranks_by_hand(rows_of(odd), ITEMS, top))
    assert lexical_search.search(nothing, items).count() == lexical_search.search(odd, items.where("false")).count() == 0


def test_search_on_random_vectors_with_ties(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(2000), " ".join(f"t{min(int(draw.expovariate(0.08)), 90)}" for _ in range(draw.choice((3, 8, 20, 200))))) for _ in range(1500)]
    rows += [(5000 + i, "t1 t2 t3") for i in range(40)]
    items = [(i, " ".join(f"t{draw.randrange(90)}" for _ in range(draw.choice((1, 2, 6, 15))))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(row) for row in lexical_search.search(docs, spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert by_text(got) == by_text(ranks_by_hand(rows, items, 10))


def test_coordinate_bounds_leave_out_documents_but_no_answer():
    import pyarrow as pa
    draw = np.random.default_rng(2)
    weights = np.array([5000, 3000, 2000, 700, 0])
    held = [np.flatnonzero(draw.random(5) < 0.5).astype(np.int32) for _ in range(800)]
    shares = [draw.integers(1, 900_000, len(own)) for own in held]
    lengths = np.array([math.sqrt((weights[own] * share.astype(float) ** 2).sum()) for own, share in zip(held, shares)])
    batch = lexical_search._Batch(pa.record_batch([pa.array(range(800)), pa.array(lengths), pa.array([own.tolist() for own in held], pa.list_(pa.int32())), pa.array(
        [s.tolist() for s in shares], pa.list_(pa.int64()))], names=["doc_id", "length", "terms", "impacts"]).filter(pa.array(lengths > 0)), weights)
    items = lexical_search._Items([np.array([0, 2]), np.array([1, 3, 4]), np.array([0, 1, 2, 3])], weights)
    every = np.arange(len(batch.ids))
    for item in range(3):
        scores = batch.scores(items, item, every, np.zeros(5, np.int64))
        least = int(np.sort(scores)[-10])
        chosen = batch.candidates(items, item, least)
        assert set(np.flatnonzero(scores >= least)) <= set(chosen) and len(chosen) < len(every) / 2


def runs_by_hand(words, least=24, power=3):
    found = {}
    for period in range(1, len(words) // power + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > at and end + period - at >= max(least, power * period):
                found.setdefault((at, end + period - at), period)
            at = max(end, at + 1)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda run: (run[0], run[2]))


def kept_by_hand(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def some_words(draw, kind):
    n, base = draw.randrange(160), [draw.choice("abc") for _ in range(draw.randrange(1, 21))]
    if kind == 0:
        return draw.choices("ab", k=n)
    if kind == 1:
        return draw.choices("xyz", k=draw.randrange(20)) + [base[i % len(base)] for i in range(n)] + draw.choices("xyz", k=draw.randrange(9))
    if kind == 2:
        return [word for _ in range(n // 8) for word in draw.choices("ab", k=draw.randrange(1, 4)) * draw.randrange(1, 20)]
    return (["a"] * draw.randrange(1, 30) + ["b"]) * draw.randrange(1, 6) + ["a"] * draw.randrange(60)


@pytest.mark.parametrize("least,power", [(24, 3), (6, 3), (10, 4)])
def test_runs_of_random_words(least, power):
    draw = random.Random(7)
    texts = [some_words(draw, i % 4) for i in range(300)]
    for words, runs in zip(texts, periodic_runs.runs_of([[w.encode() for w in words] for words in texts], least, power)):
        assert [tuple(run) for run in runs.tolist()] == runs_by_hand(words, least, power)


def test_grammar_extensions_are_exact():
    draw = np.random.default_rng(3)
    for kinds, size in ((1, 300), (2, 700), (3, 50), (400, 500)):
        symbols = draw.integers(0, kinds, size)
        symbols[size // 2:] = symbols[:size - size // 2]
        grammar = periodic_runs.Grammar(symbols)
        x, y = draw.integers(0, size, (2, 500))
        x, y = x[x != y], y[x != y]
        for one, got in ((symbols, grammar.extension(x, y)), (symbols[::-1], grammar.mirrored().extension(x, y))):
            for a, b, length in zip(x, y, got):
                assert (one[a:a + length] == one[b:b + length]).all()
                assert max(a, b) + length == size or one[a + length] != one[b + length]


@pytest.mark.parametrize("source", ["odd", "small", "nothing"])
def test_runs_of_documents(spark, request, source):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if source == "small" else request.getfixturevalue(source)
    want = []
    for doc_id, text in rows_of(docs):
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        runs = runs_by_hand(words)
        best = min(runs, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=None)
        want.append((doc_id, len(words), runs, best, kept_by_hand(words, runs)))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["best"] and tuple(r["best"]), r["collapsed"]) for r in periodic_runs.find_runs(docs).collect()]
    assert by_text(got) == by_text(want)


def test_planted_periods_and_digests(spark, odd):  # noqa: F811
    planted = {row["doc_id"]: row["text"] for row in with_planted_periods(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    got = {row["doc_id"]: row for row in op13_periodic_runs(spark, SMALL).collect()}
    for doc_id, text in rows_of(spark.read.parquet(f"{SMALL}/documents.parquet")):
        words, checksum = (text or "").split(), zlib.crc32(str(doc_id).encode())
        words, n = re.findall("[^\x20\x09-\x0D]+", text or ""), len(re.findall("[^\x20\x09-\x0D]+", text or ""))
        if checksum % 10 == 0 and n:
            g = checksum // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            assert planted[doc_id] == " ".join(words)
        runs = runs_by_hand(words)
        assert got[doc_id]["n_runs"] == len(runs)
        assert got[doc_id]["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % run for run in runs).encode()).hexdigest()
        assert got[doc_id]["collapsed_sha256"] == hashlib.sha256(kept_by_hand(words, runs).encode()).hexdigest()
        assert (got[doc_id]["exponent_milli"] is None) == (not runs)
    assert with_planted_periods(odd).count() == odd.count()
