"""License scans: Dice coefficient over word bigrams between stretches of a text and licence templates.

A text is normalised to lower-case words (letters and digits, ``licence`` spelt ``license``). Against a
template of n bigrams a stretch of m bigrams scores 2 * shared / (n + m), bigrams counted as often as
both hold them. A score of t needs m between t / (2 - t) * n and (2 - t) / t * n, and at least
t / (2 - t) * n shared: the first bounds the stretches, the second drops almost every template before any
stretch is looked at. A stretch that scores best starts and ends with a shared bigram, so only such
stretches are scored.

For each template the text's best stretches that do not overlap are reported, best first; of equal ones
the first. Stretches of different templates may overlap (a notice is part of a header).

Null text, text of one word, and an empty table give no match. Texts are scanned whole. Rows are scanned
one by one, so repeated rows agree; other columns stay as they are, columns named like a result are
replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from demandmill.llm.common import map_arrow, with_columns_after
from demandmill.llm.license_texts import TEMPLATES

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")
SAME = {"licence": "license", "licences": "licenses", "licenced": "licensed"}


def normalised(text: str) -> list[str]:
    return [SAME.get(w, w) for w in WORD.findall(text.lower())]


class Templates:
    """Bigrams of all templates as numbers; a word no template has is 0."""

    def __init__(self, texts: dict[str, str], threshold: float = THRESHOLD) -> None:
        words = {name: normalised(text) for name, text in texts.items()}
        self.word_id = {w: i + 1 for i, w in enumerate(sorted({w for x in words.values() for w in x}))}
        for spelt, plain in SAME.items():
            if plain in self.word_id:
                self.word_id[spelt] = self.word_id[plain]
        self.base = len(self.word_id) + 2
        self.threshold, self.names = threshold, sorted(words)
        self.bigrams = {n: Counter(self.pairs(words[n]).tolist()) for n in self.names}
        self.sizes = {n: sum(c.values()) for n, c in self.bigrams.items()}
        known = np.unique([b for c in self.bigrams.values() for b in c])
        # Numbers of the known bigrams (0: none), and how often each template has them.
        self.number = np.zeros(self.base * self.base, np.int32)
        self.number[known] = np.arange(1, len(known) + 1)
        self.counts = np.zeros((len(known) + 1, len(self.names)), np.int32)
        for i, name in enumerate(self.names):
            for bigram, n in self.bigrams[name].items():
                self.counts[self.number[bigram], i] = n
        sizes = np.array([self.sizes[n] for n in self.names])
        self.least = threshold / (2 - threshold) * sizes - 1e-9

    def pairs(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter((self.word_id.get(w, 0) for w in words), np.int64, len(words))
        return np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.base + ids[1:], 0)

    def matches(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(template, score, first word, end word)`` of every match, by template and place."""
        pairs = self.pairs(WORD.findall(text.lower()))
        codes = self.number[pairs]
        place = np.flatnonzero(codes)
        if not len(place):
            return []
        codes = codes[place]
        there, often = np.unique(codes, return_counts=True)
        shared = np.minimum(self.counts[there], often[:, None]).sum(0)
        out = []
        for i in np.flatnonzero(shared >= self.least):
            own, name = self.counts[:, i], self.names[i]
            hits = own[codes] > 0
            out += [(name, *m) for m in self._stretches(place[hits], codes[hits], own, self.sizes[name])]
        return sorted(out, key=lambda m: (m[0], m[2]))

    def _stretches(
        self, place: np.ndarray, codes: np.ndarray, own: np.ndarray, n: int
    ) -> list[tuple[float, int, int]]:
        t = self.threshold
        low, high = t / (2 - t) * n - 1e-9, (2 - t) / t * n + 1e-9
        need = int(np.ceil(low))
        # How many of the same bigram stand before each one.
        order = np.argsort(codes, kind="stable")
        first = np.searchsorted(codes[order], codes)
        before = np.empty(len(codes), np.int64)
        before[order] = np.arange(len(codes))
        before -= first
        found, skipped, left = [], np.zeros(len(own), np.int64), 0
        for i in range(len(place) - need + 1):
            a = int(place[i])
            if place[i + need - 1] - a + 1 > high:
                continue  # too few shared bigrams within the longest stretch from here
            j = int(np.searchsorted(place, a + high - 1, side="right"))
            c = codes[i:j]
            while left < i:
                skipped[codes[left]] += 1
                left += 1
            shared = np.cumsum(before[i:j] - skipped[c] < own[c])
            m = place[i:j] - a + 1
            score = np.where(m >= low, 2 * shared / (n + m), 0.0)
            k = int(np.argmax(score))
            if score[k] >= t - 1e-12:
                found.append((float(score[k]), a, int(place[i + k]) + 2))
        kept: list[tuple[float, int, int]] = []
        for score, a, b in sorted(found, key=lambda f: (-f[0], f[1])):
            # Neighbours share a word where one ends and the next begins, never a bigram.
            if all(b - 1 <= x or a >= y - 1 for _, x, y in kept):
                kept.append((score, a, b))
        return kept


MATCH = pa.struct(
    [("template", pa.string()), ("dice", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]
)


def _scanned(texts: dict[str, str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts, threshold)
        fields = ("template", "dice", "first_word", "end_word")
        for batch in batches:
            found = [
                [dict(zip(fields, m)) for m in templates.matches(t)] if t else []
                for t in batch.column("text").to_pylist()
            ]
            rest = [n for n in batch.schema.names if n != "licenses"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in rest], pa.array(found, pa.list_(MATCH))], [*rest, "licenses"]
            )

    return run


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``licenses``: template, Dice coefficient, and the words the stretch takes."""
    added = "licenses array<struct<template string, dice double, first_word long, end_word long>>"
    schema = with_columns_after(docs.schema, added)
    return map_arrow(docs, _scanned(templates or TEMPLATES, threshold), schema)
