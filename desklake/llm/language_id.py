"""Language identification by a byte convolutional network, trained in numpy.

A text is read as UTF-8 bytes in windows of ``WINDOW``; the last one is filled with zero bytes. Bytes are embedded, filters of several
widths slide over the window, each filter's largest answer is kept, and a softmax over those gives the window's language. A
document's probabilities are those of its windows, weighted by their bytes; all windows of the whole text count.

Training takes a bounded, documented sample: per language about ``TRAIN_DOCS`` labelled documents, those with the smallest hashes of id
and text (never more than twice as many of a language), and of each up to ``TRAIN_WINDOWS`` windows spread over the text. Rows equal in
language, id and text are one document there, and every language is drawn and bounded by itself, so neither null or repeated ids nor
another language can push one out. Which documents may be learnt from is for the caller to say. The weights, some 10 kB, travel
with the function.

Defined cases: null text and texts without a letter are ``und`` with score 0; a null id or label is allowed (unlabelled rows are never learnt
from); repeated rows are judged each for itself; other columns are ignored; an empty table gives no rows, and a table without a
label gives ``und`` everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW, EMBED, FILTERS, WIDTHS = 128, 8, 8, (2, 3, 4)
TRAIN_DOCS, TRAIN_WINDOWS = 400, 4
EPOCHS, BATCH, RATE = 12, 64, 0.01
UNKNOWN = "und"
AT_ONCE = 256  # windows


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray           # (256, EMBED)
    filters: list[np.ndarray]       # per width (width * EMBED, FILTERS)
    biases: list[np.ndarray]
    out: np.ndarray                 # (FILTERS * widths, languages)
    out_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.out, self.out_bias]


def new_model(languages: list[str], seed: int = 7) -> Model:
    random = np.random.default_rng(seed)
    normal = lambda *shape: random.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32)
    return Model(languages, random.normal(0, 0.5, (256, EMBED)).astype(np.float32), [normal(w * EMBED, FILTERS) for w in WIDTHS],
                 [np.zeros(FILTERS, np.float32) for _ in WIDTHS], normal(FILTERS * len(WIDTHS), len(languages)),
                 np.zeros(len(languages), np.float32))


def _views(embedded: np.ndarray, width: int) -> np.ndarray:
    """(windows, places, width * EMBED): what a filter of this width sees at each place."""
    n, length, size = embedded.shape
    flat = embedded.reshape(n, length * size)
    return np.lib.stride_tricks.sliding_window_view(flat, width * size, axis=1)[:, ::size]


def forward(model: Model, windows: np.ndarray, keep: bool = False):
    """Probabilities of (n, WINDOW) bytes; with ``keep`` also what training needs."""
    embedded, pooled, kept = model.embedding[windows], [], []
    for width, weights, bias in zip(WIDTHS, model.filters, model.biases):
        views = _views(embedded, width)
        answers = np.ascontiguousarray(views).reshape(-1, width * EMBED) @ weights
        answers = answers.reshape(len(windows), -1, FILTERS)
        if keep:
            best = answers.argmax(axis=1)
            kept.append((views, best))
        pooled.append(np.maximum(answers.max(axis=1) + bias, 0))
    features = np.concatenate(pooled, axis=1)
    scores = features @ model.out + model.out_bias
    scores -= scores.max(axis=1, keepdims=True)
    odds = np.exp(scores)
    odds /= odds.sum(axis=1, keepdims=True)
    return (odds, features, kept) if keep else odds


def _gradients(model: Model, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    odds, features, kept = forward(model, windows, keep=True)
    n = len(windows)
    error = odds.copy()
    error[np.arange(n), labels] -= 1
    error /= n
    back = (error @ model.out.T) * (features > 0)
    embedding, filters, biases = np.zeros_like(model.embedding), [], []
    for number, (width, weights) in enumerate(zip(WIDTHS, model.filters)):
        views, best = kept[number]
        own = back[:, number * FILTERS:(number + 1) * FILTERS]
        seen = views[np.arange(n)[:, None], best]                      # (n, FILTERS, width * EMBED)
        filters.append(np.einsum("nf,nfk->kf", own, seen))
        biases.append(own.sum(axis=0))
        to_bytes = (own[:, :, None] * weights.T[None]).reshape(n, FILTERS, width, EMBED)
        places = best[:, :, None] + np.arange(width)
        np.add.at(embedding, windows[np.arange(n)[:, None, None], places], to_bytes)
    return [embedding, *filters, *biases, features.T @ error, error.sum(axis=0)]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adam over shuffled batches; the same input gives the same model."""
    model, random = new_model(languages, seed), np.random.default_rng(seed)
    weights = model.arrays()
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            step += 1
            for w, g, m, v in zip(weights, _gradients(model, windows[part], labels[part]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def byte_windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some texts, the text each belongs to and the bytes it covers."""
    count = -(-np.diff(bounds) // WINDOW)
    text = np.repeat(np.arange(len(count)), count)
    start = bounds[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    size = np.minimum(bounds[1:][text] - start, WINDOW)
    reach = np.arange(WINDOW)
    windows = data[np.minimum(start[:, None] + reach, max(0, len(data) - 1))] if len(data) else np.zeros((0, WINDOW), np.uint8)
    windows[reach[None, :] >= size[:, None]] = 0
    return windows, text, size


def fit(labelled: DataFrame, most_docs: int = TRAIN_DOCS, most_windows: int = TRAIN_WINDOWS) -> Model | None:
    """A model from rows (doc_id, text, lang): bounded by languages * most_docs * most_windows windows on the driver."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    named = usable.withColumn("print", F.xxhash64("doc_id", "text"))
    # Only ids and hashes take part in the choice. A threshold per language comes from a count, so no language is sorted in one task.
    draw = F.shiftrightunsigned("print", 33)
    counts = {row["lang"]: row["n"] for row in named.select("lang", "doc_id", "print").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(None).cast("double")
    for lang, count in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(most_docs / count)).otherwise(share)
    spread = F.transform(F.sequence(F.lit(0), F.lit(most_windows - 1)), lambda i: F.substring(
        F.col("text"), (F.char_length("text") * i / most_windows).cast("int") + 1, F.lit(WINDOW)))
    chosen = named.where(draw <= share * float(1 << 31)).select("lang", "doc_id", "print", spread.alias("windows")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("print", 33), "print", "doc_id", "windows"))
    rows = chosen.withColumn("place", place).where(F.col("place") <= 2 * most_docs).orderBy("lang", "place").collect()
    texts = [(row["lang"], part.encode()[:WINDOW]) for row in rows for part in dict.fromkeys(row["windows"]) if part.strip()]
    if not texts:
        return None
    languages = sorted({lang for lang, _ in texts})
    windows = np.zeros((len(texts), WINDOW), np.uint8)
    for number, (_, part) in enumerate(texts):
        windows[number, :len(part)] = np.frombuffer(part, np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in texts])
    return train(windows, labels, languages)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            _, offsets, data = texts.buffers()
            bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
            total = np.zeros((len(texts), len(model.languages)))
            first = 0
            while first < len(texts):  # whole documents of about AT_ONCE windows; a longer one in pieces
                last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + AT_ONCE * WINDOW, side="right")) - 1)
                last = min(last, len(texts))
                windows, text, size = byte_windows(data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first])
                for at in range(0, len(windows), AT_ONCE):
                    odds = forward(model, windows[at:at + AT_ONCE]) * size[at:at + AT_ONCE, None]
                    np.add.at(total, text[at:at + AT_ONCE] + first, odds)
                first = last
            known = np.asarray(batch.column("letters").fill_null(False)) & (total.sum(axis=1) > 0)
            best = total.argmax(axis=1)
            score = np.where(known, total[np.arange(len(best)), best] / np.maximum(total.sum(axis=1), 1e-9), 0.0)
            named = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(named, pa.string()), pa.array(np.minimum(score, 1.0))],
                                  names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("text").rlike(r"\p{L}").alias("letters"))
    if model is None:
        return source.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return source.mapInArrow(judge, "doc_id long, lang_pred string, score double")
