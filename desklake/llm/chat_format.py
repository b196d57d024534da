"""Chat formatting by grammar round trip.

Grammar of a formatted conversation: ``turn*`` with ``turn = "<s>" role "[INST]" text "</s>"``. Roles and texts may hold control
strings of their own, so every rendered turn is parsed again: where role and text do not come back as they were, the control
strings inside them get a backslash (``<s>`` becomes ``<\\s>``, ``<\\s>`` becomes ``<\\\\s>``), and parsing takes one backslash away
from each. That is a bijection and leaves no bare control string in a text, so the second round is always identical.

Turns follow ``turn``, then role and text where turns are tied; a null turn comes first. A null role or text is empty. A null conv_id
is a conversation of its own; repeated rows are repeated turns; other columns are ignored; an empty table gives no rows. A
conversation is one row of the result, as its text and digests are, so its size is bounded by what one formatted text may hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import let

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
BARE = r"</?s>|\[/?INST\]"
#: Control strings with any number of backslashes after their first character; with at least one.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def raw_turns(formatted: Column) -> Column:
    """The turns as (role, text), still escaped: bare control strings cut a turn into nothing, role and text."""
    def cut(parts: Column) -> Column:
        turns = F.sequence(F.lit(0), F.floor(F.size(parts) / 3).cast("int") - 1)
        return F.when(F.size(parts) >= 3, F.transform(turns, lambda i: F.struct(
            parts[i * 3 + 1].alias("role"), parts[i * 3 + 2].alias("text")))).otherwise(
            F.array().cast("array<struct<role:string,text:string>>"))
    return let(F.split(formatted, BARE), cut)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    return F.transform(raw_turns(formatted), lambda turn: F.struct(
        unescape(turn["role"]).alias("role"), unescape(turn["text"]).alias("text")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted text and the spans of it (start, length in characters) that are trained on."""
    order = ["turn", "role", "text"]
    source = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = render(F.col("role"), F.col("text"))
    same = F.coalesce(parse(plain) == F.array(F.struct("role", "text")), F.lit(False))
    safe = source.withColumn("same", same).select(
        "conv_id", *order,
        F.when(F.col("same"), F.col("role")).otherwise(escape(F.col("role"))).alias("safe_role"),
        F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text"))).alias("safe_text"))
    rendered = safe.select("conv_id", F.struct(*order, render(F.col("safe_role"), F.col("safe_text")).alias("piece")).alias("turn"))
    gathered = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    whole = gathered.select("conv_id", F.array_join(F.transform("turns", lambda turn: turn["piece"]), "").alias("formatted"))
    return whole.withColumn("spans", loss_spans(F.col("formatted")))


def loss_spans(formatted: Column) -> Column:
    """Where the texts of the trained role stand: array of (start, length), in characters from 0."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + len(OPEN) + F.char_length(turn["role"]) + len(MIDDLE)
        length = F.char_length(turn["text"])
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct((start + length + len(CLOSE)).alias("at"), F.when(
            turn["role"] == TRAINED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))
    return F.aggregate(raw_turns(formatted), zero, step, lambda state: state["spans"])


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when they are read back: the turns by the parser, what is trained on by the spans alone."""
    read = formatted.select("conv_id", "formatted", "spans", parse(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("spans", lambda span: unescape(F.substr("formatted", span["start"] + 1, span["length"]))), "")
    full = read.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), told.alias("told"), trained.alias("trained"))
    return full.select("conv_id", "n_turns", F.sha2("told", 256).alias("turns_sha256"), F.char_length("trained").cast("long").alias("loss_chars"),
                       F.sha2("trained", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))
