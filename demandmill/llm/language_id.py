"""Language ID: averaged hashed subword embeddings under a linear softmax.

A word (a run of letters, lower-cased, between ``<`` and ``>``) is the bag of its byte n-grams and of
itself, each hashed to a bucket with an embedding. A text is the average over all n-grams of all its
words; a linear softmax over that average gives the languages. Both layers are trained together by
minibatch stochastic gradient descent in numpy.

Training takes a bounded sample: of each language the ``per_class`` different labelled rows with the
smallest hashes of id and text, each reduced on its executor to ``BUCKETS`` half-precision numbers. A
fifth of them is held back for calibration: a temperature that minimises their log loss, and a rejection
threshold that at most ``max_loss`` of their rightly predicted rows fall under. The driver holds the
sample and a column per language, so the languages must be few (some hundreds).

Null text, or text without a letter (numbers like \u00bd and \u2167 are none), gives ``und`` with score 0 and is
rejected, as is every text when there was nothing to learn from. Rows are scored one by one, so repeated
rows agree; they count once in the sample. Of languages with equal scores the first by name is given.
Texts of any length are scored whole, some megabytes of them at a time. Other columns stay as they are;
columns named like a result are replaced. An empty table gives no rows, and no model.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandmill.llm.common import map_arrow, text_column, with_columns_after

UNKNOWN = "und"
BUCKETS, DIMENSIONS, GRAMS = 4096, 16, (2, 3, 4, 5)
PER_CLASS, MAX_LOSS = 500, 0.001
#: Word characters that are neither letters nor digits: fractions, raised digits, Roman numerals.
NUMBERS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()
)
WORDS = re.compile(r"[^\W\d_]+")
#: Words a worker remembers between texts; past that it starts anew.
REMEMBERED = 200_000


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    low = text.lower()
    if not low.isascii() and not NUMBERS.isdisjoint(low):
        low = "".join(" " if c in NUMBERS else c for c in low)
    return WORDS.findall(low)


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams in one array, and the number of n-grams of each word."""
    coded = [b"<" + w.encode() + b">" for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(coded)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # bytes up to the word's end
    whole = np.fromiter((zlib.crc32(w) for w in coded), np.int64, len(coded)) % BUCKETS
    buckets, owner = [whole], [np.arange(len(coded))]
    key = np.zeros(len(flat), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        ahead = np.zeros(len(flat), np.uint64)
        ahead[: max(0, len(flat) - n + 1)] = flat[n - 1 :]
        key = key * np.uint64(257) + ahead + np.uint64(1)
        if n in GRAMS:
            at = np.flatnonzero(left >= n)
            mixed = (key[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            buckets.append((mixed % np.uint64(BUCKETS)).astype(np.int64))
            owner.append(word[at])
    buckets, owner = np.concatenate(buckets), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.bincount(owner, minlength=len(coded))


def features(text: str) -> np.ndarray | None:
    """Share of each bucket among the text's n-grams; None without letters."""
    words = words_of(text)
    if not words:
        return None
    distinct, count = np.unique(np.array(words, object), return_counts=True)
    buckets, grams = word_buckets(distinct.tolist())
    shares = np.bincount(buckets, np.repeat(count, grams), BUCKETS)
    return shares / shares.sum()


@dataclass
class Model:
    """``bucket_logits`` is embedding times output layer: both are linear, so a text's logits are the
    average of its n-grams' rows plus the bias."""

    languages: list[str]
    embedding: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, shares: np.ndarray) -> np.ndarray:
        return shares @ self.embedding @ self.output + self.bias

    def bucket_logits(self) -> np.ndarray:
        return (self.embedding @ self.output).astype(np.float32)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(
    shares: np.ndarray, labels: np.ndarray, languages: list[str],
    epochs: int = 30, batch: int = 32, rate: float = 0.5, seed: int = 7,
) -> Model:
    """Stochastic gradient descent on both layers, then calibration on every fifth row."""
    rng = np.random.default_rng(seed)
    n, k = len(labels), len(languages)
    held = np.arange(n) % 5 == 4
    train = np.flatnonzero(~held)
    # Averages of many n-grams are short vectors; one factor for all rows makes steps of usual size.
    scale = 1 / max(1e-9, np.sqrt((shares**2).sum(axis=1)).mean())
    embedding = rng.normal(0, 0.3, (BUCKETS, DIMENSIONS))
    output = rng.normal(0, 0.3, (DIMENSIONS, k))
    bias = np.zeros(k)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for at in np.array_split(rng.permutation(train), max(1, math.ceil(len(train) / batch))):
            if not len(at):
                continue
            x = shares[at] * scale
            hidden = x @ embedding
            slope = softmax(hidden @ output + bias)
            slope[np.arange(len(at)), labels[at]] -= 1
            slope /= len(at)
            back = slope @ output.T
            output -= step * (hidden.T @ slope)
            bias -= step * slope.sum(axis=0)
            embedding -= step * (x.T @ back)
    model = Model(languages, embedding * scale, output, bias)
    check = np.flatnonzero(held) if held.any() else train
    _calibrate(model, shares[check], labels[check], MAX_LOSS)
    return model


def _calibrate(model: Model, shares: np.ndarray, labels: np.ndarray, max_loss: float) -> None:
    logits = model.logits(shares)
    rows = np.arange(len(labels))

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / t)[rows, labels], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.1, 10, 81), key=loss)
    chance = softmax(logits / model.temperature)
    right = chance.argmax(axis=1) == labels
    best = np.sort(chance.max(axis=1)[right])
    low = best[int(max_loss * len(best))] if len(best) else 1.0
    model.threshold = float(min(0.5, low))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            shares = features(text)
            if shares is not None:
                raw = (shares * BUCKETS).astype(np.float16).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([raw], pa.binary())], ["lang", "shares"]
                )


def train(docs: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model | None:
    """A model from labelled rows for which ``learn`` holds; None when there are none.

    ``per_class`` bounds the sample, and the same rows are chosen however the table is dealt out.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    hashed = F.xxhash64("doc_id", "text", F.lit("sample")).alias("__h")
    draw = F.shiftrightunsigned("__h", 11) / float(1 << 53)
    # Twice as many as are wanted are looked at in order; more only where rows repeat.
    share = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, min(1.0, 2 * per_class / sizes[lang] + 0.001))]
    )
    near = known.select("lang", "text", hashed).where(draw < F.element_at(share, F.col("lang")))
    different = near.groupBy("lang", "__h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("__h")
    sample = different.withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= per_class)
    # The order of arrival must not decide the model.
    rows = map_arrow(sample.select("lang", "text"), _sampled, "lang string, shares binary").collect()
    rows.sort(key=lambda r: (zlib.crc32(r.shares), bytes(r.shares), r.lang))
    if not rows:
        return None
    shares = np.array([np.frombuffer(r.shares, np.float16) for r in rows], np.float64) / BUCKETS
    place = {lang: i for i, lang in enumerate(languages)}
    return fit(shares, np.array([place[r.lang] for r in rows]), languages)


class _Words(dict):
    """Word to its place in the remembered tables; new words wait for their numbers."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class _Scorer:
    """Scores texts; the sum of logits and the number of n-grams of seen words are remembered."""

    def __init__(self, model: Model) -> None:
        self.model, self.table = model, model.bucket_logits()
        self.forget()

    def forget(self) -> None:
        self.words = _Words()
        self.sums = np.zeros((0, len(self.model.languages)), np.float32)
        self.grams = np.zeros(0, np.int64)

    def learn(self) -> None:
        fresh = list(self.words)[len(self.grams) :]
        if not fresh:
            return
        buckets, grams = word_buckets(fresh)
        starts = np.cumsum(grams) - grams
        self.sums = np.concatenate([self.sums, np.add.reduceat(self.table[buckets], starts, axis=0)])
        self.grams = np.concatenate([self.grams, grams])

    def __call__(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [], []
        for group in _groups(texts):
            if len(self.words) > REMEMBERED:
                self.forget()
            words = [words_of(t) if t else [] for t in group]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            at = np.fromiter(
                map(self.words.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum()
            )
            self.learn()
            known = np.flatnonzero(sizes)
            best, score = np.full(len(words), -1), np.zeros(len(words))
            if len(known):
                starts = (np.cumsum(sizes) - sizes)[known]
                sums = np.add.reduceat(self.sums[at], starts, axis=0, dtype=np.float64)
                logits = sums / np.add.reduceat(self.grams[at], starts)[:, None] + self.model.bias
                chance = softmax(logits / self.model.temperature)
                best[known], score[known] = chance.argmax(axis=1), chance.max(axis=1)
            langs += [UNKNOWN if i < 0 else self.model.languages[i] for i in best]
            scores.append(score)
        return langs, np.concatenate(scores) if scores else np.zeros(0)


def _groups(texts: Iterable[str | None], chars: int = 1 << 20) -> Iterator[list[str | None]]:
    """Runs of texts of about ``chars`` characters in all; a longer text is a run of its own."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def _nothing_known(texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
    n = sum(1 for _ in texts)
    return [UNKNOWN] * n, np.zeros(n)


def _predicted(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer(model) if model else _nothing_known
        low = model.threshold if model else 0.0
        for batch in batches:
            langs, scores = score(t.as_py() for t in text_column(batch))
            taken = [lang != UNKNOWN and s >= low for lang, s in zip(langs, scores)]
            rest = [n for n in batch.schema.names if n not in ("lang_pred", "score", "accepted")]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in rest],
                    pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                    pa.array(taken, pa.bool_()),
                ],
                [*rest, "lang_pred", "score", "accepted"],
            )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred, score`` (calibrated chance of it) and ``accepted``.

    ``docs`` holds ``text``, or whole rows as ``__row``.
    """
    schema = with_columns_after(docs.schema, "lang_pred string, score double, accepted boolean")
    return map_arrow(docs, _predicted(model), schema)
