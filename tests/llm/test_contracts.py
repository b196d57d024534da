"""Special tokens, the loss mask, clashing column names and batches beyond four levels of runs."""

from __future__ import annotations

import hashlib

import numpy as np
import zlib
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from desklake.llm import chat_format, decontaminate, jaccard_join, line_dedup, packing
from desklake.llm.queries import vocabulary_files
from test_operators import PASSAGE, by_text, nothing, odd, rows_of  # noqa: F401


def test_packing_reads_special_tokens_as_the_library_does(spark):
    from tokenizers import Tokenizer
    vocabulary, ranks = vocabulary_files()
    plain = Tokenizer.from_file(vocabulary)
    texts = ["<|endoftext|> hi", "plain text", "a<|endoftext|>", "<|endoftext|", "ünï <|endoftext|> €"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for way in (ranks, None):
        got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pieces(docs, vocabulary, way).collect()}
        for doc_id, text in enumerate(texts):
            ids = np.array(plain.encode(text, add_special_tokens=False).ids + [packing.END_ID], "<u4")
            assert got[doc_id] == (len(ids), zlib.crc32(ids.tobytes()))
    assert plain.encode(texts[0], add_special_tokens=False).ids == [50256, 23105]


def test_loss_figures_are_cut_by_the_mask(spark):
    rows = [(1, 0, "user", "ask </s> [INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", "é"), (1, 3, "assistant", "ünd\\ €"),
            (None, 0, "assistant", "no id"), (2, 0, None, None)]
    formatted = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = {i: "".join(t or "" for c, _, role, t in rows if c == i and role == "assistant") for i in (1, 2, None)}
    assert {r["conv_id"]: (r["loss_chars"], r["loss_sha256"]) for r in chat_format.digests(formatted).collect()} == {
        i: (len(text), hashlib.sha256(text.encode()).hexdigest()) for i, text in want.items()}
    moved = formatted.withColumn("spans", F.transform("spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["length"].alias("length"))))
    told = {r["conv_id"]: r["loss_sha256"] for r in chat_format.digests(moved).collect()}
    assert all(told[i] != hashlib.sha256(want[i].encode()).hexdigest() for i in (1, None))
    assert chat_format.digests(formatted.where("false")).count() == 0


CLASHES = ["hit_id", "Hit_Hash", "kept_id", "kept_md5", "lines", "listed_id", "frequent_keys", "row", "batch", "text_hash", "quality_measures"]


def test_stages_take_odd_rows_empty_tables_and_clashing_names(spark, odd, nothing):  # noqa: F811
    for docs in (odd, nothing):
        wide = docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.char_length("text").alias("n_chars"),
                           *[F.lit(k).alias(name) for k, name in enumerate(CLASHES)])
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, wide, SMALL)
            assert kept.columns == wide.columns, name
            assert kept.count() <= docs.count(), name
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    wide = odd.withColumn("hit_id", F.lit(1)).withColumn("hit_hash", F.lit(2))
    assert by_text(rows_of(decontaminate.clean(wide, benchmark))) == by_text((i, t) for i, t in rows_of(odd) if PASSAGE.strip() not in (t or ""))
    wide = odd.withColumn("kept_id", F.lit(1)).withColumn("kept_md5", F.lit(2))
    assert by_text(rows_of(jaccard_join.keep_one(wide))) == by_text(rows_of(jaccard_join.keep_one(odd)))


def test_many_batches_give_what_one_gives(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"line {k}" for k in range(i % 7, 40, 1 + i % 5))) for i in range(120)], "doc_id long, text string")
    one = line_dedup.dedup(docs, least_documents=60).collect()
    many = line_dedup.dedup(docs, least_documents=60, batch_bytes=1200).collect()
    assert by_text(one) == by_text(many) and sum(r["n_dropped"] for r in one) > 0
