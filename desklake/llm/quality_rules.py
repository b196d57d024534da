"""Line-first cleaning: lines that fail a punctuation, navigation or boilerplate rule go, then documents that lost too much.

A line without a word is kept as it is and never judged. Defined cases: a null or empty text has no words and fails the base rules;
a null id is an id like any other; repeated rows are judged each for itself; columns beside doc_id and text are passed on by
``clean`` and ignored by ``judge``; an empty table gives no rows. All of it is a function of one row, so nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import BLANK_RUN, BLANKS, grams, let, words

#: Phrases of page furniture, matched in lower case anywhere in a line of at most ``boilerplate_words`` words.
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "accept cookies",
               "enable javascript", "click here", "read more", "sign in to", "log in to", "subscribe to our newsletter",
               "share this article", "back to top", "skip to content")
SYMBOLS = r"[^#*$%&|<>]+"  # what is not one of the counted symbols
STOPS = r"[.!?:;,…。！？、，؟،।]"
SEPARATORS = r"[^|»›·•]+"


@dataclass(frozen=True)
class Rules:
    """Thresholds: a line fails at or beyond each, a document when it lost more than ``lost_percent`` of its word characters."""
    unstopped_words: int = 5       # words in a line without any sentence punctuation
    symbol_percent: int = 10       # symbols among the characters of a line's words
    shouted_runs: int = 3          # runs of two or more ! or ?
    separators: int = 3            # menu separators in a line ...
    separator_percent: int = 15    # ... and their share of its words
    boilerplate_words: int = 20
    lost_percent: int = 50
    repeat_percent: int = 20
    least_words: int = 10


def _count(text: Column, all_but: str) -> Column:
    return F.char_length(F.regexp_replace(text, all_but, ""))


def failing_rule(line: Column, rules: Rules = Rules()) -> Column:
    """Name of the first rule a line with words fails; null when it passes."""
    def named(parts: Column) -> Column:
        n_words, chars = F.size(parts), F.char_length(F.array_join(parts, ""))
        separators = _count(line, SEPARATORS)
        navigation = (separators >= rules.separators) & (separators * 100 >= n_words * rules.separator_percent)
        punctuation = (((n_words >= rules.unstopped_words) & ~line.rlike(STOPS))
                       | (_count(line, SYMBOLS) * 100 >= chars * rules.symbol_percent)
                       | (F.size(F.split(line, "[!?]{2,}")) > rules.shouted_runs))
        boilerplate = (n_words <= rules.boilerplate_words) & F.lower(line).rlike("|".join(BOILERPLATE))
        return F.when(navigation, "navigation").when(punctuation, "punctuation").when(boilerplate, "boilerplate")
    return let(words(line), named)


def repeated_words(parts: Column, window: int = 5) -> Column:
    """How many words lie in a window of words that occurs twice or more in the same text."""
    def covered(starts: Column) -> Column:
        spans = F.transform(starts, lambda start, j: F.least(F.lit(window), F.coalesce(F.get(starts, j + 1) - start, F.lit(window))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span)

    def twice(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(a["gram"] == b["gram"], F.lit(False))
        hit = F.filter(pairs, lambda pair, j: same(pair, F.get(pairs, j - 1)) | same(pair, F.get(pairs, j + 1)))
        return let(F.sort_array(F.transform(hit, lambda pair: pair["at"])), covered)

    def counted(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(let(ordered, twice))

    hashes = F.transform(parts, lambda word: F.xxhash64(word))
    return let(hashes, lambda h: let(grams(h, window), counted))


def measures(text: Column, rules: Rules = Rules()) -> Column:
    """Struct of the counts, and of what the rules make of the lines."""
    text = F.coalesce(text, F.lit(""))

    def of_words(parts: Column) -> Column:
        return F.struct(F.size(parts).cast("long").alias("n_words"), F.char_length(F.array_join(parts, "")).cast("long").alias("word_chars"),
                        repeated_words(parts).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        full = F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != "")
        failing = F.filter(full, lambda line: failing_rule(line, rules).isNotNull())
        return F.struct(let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                        _count(F.array_join(failing, ""), BLANK_RUN).cast("long").alias("lost_chars"))

    return F.struct(let(words(text), of_words).alias("words"), let(F.split(text, "\n"), of_lines).alias("lines"),
                    _count(text, SYMBOLS).cast("long").alias("n_symbols"))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id with all counts, base_failed and kept."""
    found = docs.select("doc_id", let(measures(F.col("text"), rules), lambda x: x).alias("found"))
    flat = found.select("doc_id", "found.words.n_words", "found.words.word_chars", "found.n_symbols", "found.lines.n_dup_lines",
                        "found.words.n_repeat_words", "found.lines.lost_chars")
    return flat.withColumn("base_failed", _base_failed(rules)).withColumn("kept", ~F.col("base_failed") & _keeps_enough(rules))


def _base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_percent)


def _keeps_enough(rules: Rules) -> Column:
    return F.col("lost_chars") * 100 <= F.col("word_chars") * rules.lost_percent


def cleaned_text(text: Column, rules: Rules = Rules()) -> Column:
    """The text without the lines that fail a rule."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line:
                                 (F.btrim(line, F.lit(BLANKS)) == "") | failing_rule(line, rules).isNull()), "\n")


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that stay, without failing lines; all columns of the input, n_chars brought up to date if present."""
    mark = "quality_measures"
    while mark in docs.columns:
        mark += "_"
    found = docs.withColumn(mark, measures(F.col("text"), rules))
    n_words, lost = F.col(f"{mark}.words.n_words"), F.col(f"{mark}.lines.lost_chars")
    good = ((n_words >= rules.least_words) & (F.col(f"{mark}.words.n_repeat_words") * 100 <= n_words * rules.repeat_percent)
            & (lost * 100 <= F.col(f"{mark}.words.word_chars") * rules.lost_percent))
    kept = found.where(good).withColumn("text", F.when(lost > 0, cleaned_text(F.col("text"), rules)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(lost > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return kept.drop(mark)
