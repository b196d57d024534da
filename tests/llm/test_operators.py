"""Operators against brute force, DuckDB and exact round trips, with odd and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from check_oracles import compare, connect
from conftest import SMALL
from desklake.llm import (chat_format, decontaminate, jaccard_join, language_id, line_dedup, packing, quality_rules, sharding,
                          suffix_dedup, url_filter)
from desklake.llm.oracle import ORACLE_SQL
from desklake.llm.queries import vocabulary_files

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = float("inf")

#: Nulls, empty and blank texts, ties, a repeated row, a long text, and columns whose names the operators use inside.
PASSAGE = "the quick brown fox jumps over the lazy dog while seven other foxes watch from the hill. "
ODD = [
    (1, PASSAGE + "first tail"), (2, PASSAGE + "second tail"), (2, PASSAGE + "second tail"), (3, None), (4, ""), (5, " \n\t"),
    (None, PASSAGE + "first tail"), (6, "Line\nline \n LINE\n\nother"), (7, "ab " * 3000), (8, "éàü " * 50 + PASSAGE), (9, "<s>[INST] a\\b </s>"),
    (10, PASSAGE + "first tail"), (11, "one two"), (12, "One  TWO"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([Row(doc_id=i, text=t, lang="en", key="k", n=1, chunk=2, token=3) for i, t in ODD],
                                 "doc_id long, text string, lang string, key string, n long, chunk long, token long")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_against_duckdb(spark, name):
    assert compare(spark, connect(SMALL), SMALL, name) is None


def rows_of(frame):
    return [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]


def by_text(rows):
    return sorted(rows, key=repr)


def removed_by_hand(rows, span=50):
    first, out = {}, []
    for i, text in sorted(rows, key=lambda row: LAST if row[0] is None else row[0]):
        data = (text or "").encode()
        for at in range(len(data) - span + 1):
            first.setdefault(data[at:at + span], LAST if i is None else i)
    for i, text in rows:
        data, gone = (text or "").encode(), set()
        for at in range(len(data) - span + 1):
            if first[data[at:at + span]] < (LAST if i is None else i):
                gone.update(range(at, at + span))
        spans = sum(1 for at in gone if at - 1 not in gone)
        out.append((i, len(data), len(gone), spans, bytes(b for at, b in enumerate(data) if at not in gone)))
    return out


@pytest.mark.parametrize("source", ["odd", "small", "nothing"])
def test_suffix_dedup(spark, request, source):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if source == "small" else request.getfixturevalue(source)
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.remove_repeats(docs, chunk_bytes=40_000).collect()]
    assert by_text(got) == by_text(removed_by_hand(rows_of(docs)))


def test_deep_shallow_sorts_like_python():
    random = np.random.default_rng(1)
    strings = random.integers(97, 99, (3000, 30), dtype=np.uint8)
    strings[:, :20] = strings[random.integers(0, 5, 3000), :20]
    order, group = suffix_dedup.deep_shallow(strings)
    told = [strings[i].tobytes() for i in order]
    assert told == sorted(told)
    assert len(set(told)) == group[-1] + 1


def components_by_hand(rows, size=5):
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
        sets.append({tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), LAST), LAST if i is None else i)
    return [(i, len(sets[x]), None if least[find(x)] == LAST else least[find(x)]) for x, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("source", ["odd", "small", "nothing"])
def test_jaccard_join(spark, request, source):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if source == "small" else request.getfixturevalue(source)
    got = [tuple(row) for row in jaccard_join.link_documents(docs, chunk_bytes=40_000).collect()]
    assert by_text(got) == by_text(components_by_hand(rows_of(docs)))


def test_sharding(spark, odd, nothing):
    tree = sharding.balanced_tree(2, 2, 3)
    grown = sharding.grow(tree)
    placed = sharding.assign(spark.read.parquet(f"{SMALL}/documents.parquet"), tree, group_rows=5).collect()
    for shard in range(12):
        assert sorted(r["slot"] for r in placed if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in placed)))
    assert {r["grown_shard"] for r in placed if r["grown_shard"] != r["shard"]} == {12}
    twice = sharding.assign(odd, grown).collect()
    assert all(r["grown_shard"] in (r["shard"], 13) for r in twice)
    assert by_text((r["doc_id"], r["size"], r["text_crc32"]) for r in twice) == by_text(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows_of(odd))
    assert sharding.assign(nothing, tree).count() == 0


def test_packing(spark, odd, nothing):
    vocabulary, ranks = vocabulary_files()
    fast = packing.pack_documents(odd, vocabulary, ranks, capacity=64).collect()
    plain = packing.pack_documents(odd, vocabulary, None, capacity=64).collect()
    assert by_text(r[:5] for r in fast) == by_text(r[:5] for r in plain)
    bins = {}
    for r in sorted(fast, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 64
    assert packing.pack_documents(nothing, vocabulary, ranks).count() == 0


def test_best_two_fit_prefers_a_tighter_pair():
    bins, _ = packing.best_two_fit(np.array([70, 20, 16, 14]), 100)
    assert sorted(np.bincount(bins).tolist()) == [1, 3]  # 70 + 16 + 14 instead of 70 + 20


def test_language_id(spark, odd, nothing):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs.where("doc_id % 3 > 0"))
    told = language_id.predict(docs.where("doc_id % 3 = 0"), model).join(docs, "doc_id").selectExpr("avg(int(lang = lang_pred)) as right").first()
    assert told["right"] >= 0.9
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(odd, model).where("doc_id in (3, 4, 5)").collect()} == {3: "und", 4: "und", 5: "und"}
    assert language_id.predict(nothing, model).count() == 0
    assert language_id.fit(nothing) is None


def test_url_filter(spark):
    link = '<a href="http://{}/">x</a>'
    pages = spark.createDataFrame([
        (1, "http://a.net/x", ""), (2, "https://WWW.Example.net/en/1?q", link.format("good.info")), (3, "http://good.info/", ""),
        (4, "http://farm.info/", link.format("a.net")), (5, None, None), (6, "nothing", ""), (7, "http://x.org/fr/#a", None)],
        "page_id long, url string, html string")
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"), url_filter.Rule("allow", "org", "/fr/")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {1: ("a.net", "/x", "net/", "block"), 2: ("www.example.net", "/en/1", "example.net/en/", "allow"),
                   3: ("good.info", "/", None, "allow"), 4: ("farm.info", "/", None, "block"), 5: ("", "", None, "allow"),
                   6: ("", "", None, "allow"), 7: ("x.org", "/fr/", "org/fr/", "allow")}
    assert url_filter.judge(pages.where("false"), rules).count() == 0


def test_chat_round_trip(spark):
    texts = ["plain", "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\s>[\\INST]", "[/INST", None, "", "a<"]
    turns = spark.createDataFrame([(i % 2, i, "assistant" if i % 3 else "us<s>er", t) for i, t in enumerate(texts)],
                                  "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(turns)
    read = formatted.select("conv_id", "formatted", chat_format.parse(F.col("formatted")).alias("turns"), chat_format.loss_spans(
        F.col("formatted")).alias("spans")).collect()
    for row in read:
        assert [(t["role"], t["text"]) for t in row["turns"]] == [
            ("assistant" if i % 3 else "us<s>er", t or "") for i, t in enumerate(texts) if i % 2 == row["conv_id"]]
        for start, length in row["spans"]:
            assert not re.search(r"</?s>|\[/?INST\]", row["formatted"][start:start + length])


def test_decontaminate_short_items_and_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "the LAZY dog"), (2, "Fox jumps over the lazy dog while seven other foxes watch now"), (3, None), (4, "--")],
                                      "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.decontaminate(odd, benchmark).collect()}
    assert got[1] == (11, ["1", "2"]) and got[3] == (0, []) and got[None] == (11, ["1", "2"])
    assert decontaminate.decontaminate(odd, benchmark.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(odd, benchmark).count() == odd.count()
    assert decontaminate.decontaminate(nothing, benchmark).count() == 0


def test_line_dedup(spark, odd, nothing):
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.dedup(odd, least_documents=1).collect()}
    assert got[6] == (5, 4, "") and got[3] == (1, 0, "")
    runs = line_dedup.LineRuns(fanout=2)
    docs = spark.createDataFrame([(i, f"same\nown {i}") for i in range(4)], "doc_id long, text string")
    dropped = [line_dedup.dedup_batch(docs.where(F.col("doc_id") == i), runs, least_documents=3).first()["n_dropped"] for i in range(4)]
    assert dropped == [0, 0, 1, 1] and [len(level) for level in runs.levels] == [0, 0, 1]
    assert line_dedup.dedup(nothing).count() == 0


def test_quality_rules_on_odd_rows(odd, nothing):
    got = {r["doc_id"]: r for r in quality_rules.judge(odd).collect()}
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and got[7]["n_repeat_words"] == 3000
    assert got[1]["kept"] and quality_rules.clean(nothing).columns == nothing.columns


def test_pipeline_keeps_what_each_stage_decides(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "test")
        assert docs.columns == columns, name
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontaminate.decontaminate(docs, benchmark).where("n_hit > 0").count() == 0
    rows = rows_of(docs)
    assert all(i == component for i, _, component in components_by_hand(rows))
    pieces = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").count().count()
    assert pieces == len(rows)


def test_registered(spark):
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in contract.queries()}
    assert hashlib and "pipeline" in contract.queries()
