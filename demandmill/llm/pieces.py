"""SentencePiece encoding and decoding (BPE models) in vectorised merge rounds.

A text is cut where no piece of the model can reach across: before the spaces in front of a word, and
at characters no piece has. Each word becomes a run of symbols in one flat numpy array. A round looks
up the rank of every adjacent pair, takes each word's smallest by segmented minimum, merges its
leftmost occurrences in all words at once, and compacts the array; words without a pair left leave it.
Symbols without a piece become byte pieces at the end.

All occurrences of a pair may merge together only if its merge can make no pair that ranks as high.
This is read off the model once; for the other pairs (runs of spaces) only the leftmost occurrence
merges in a round, which is the library's order.

Words are remembered between texts up to a bound, so a word is merged once per worker and not once per
occurrence. Null counts as empty; an empty text has no ids. Texts of any length are encoded whole.
Repeated rows and ties need no rule: a text alone decides its ids. Other columns stay as they are;
columns named like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from demandmill.llm.common import map_arrow, with_columns_after

SPACE = "▁"
NEVER = np.iinfo(np.int32).max
#: Words a worker remembers.
REMEMBERED = 250_000
#: Characters encoded at once.
GROUP = 1 << 20


class Pieces:
    """The model's tables."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)
        ]
        self.size, self.unknown = size, model.unk_id()
        usual = [i for i in range(size) if not special[i]]
        self.id_of = {names[i]: i for i in usual}
        if any(model.is_unused(i) for i in usual):
            raise ValueError("models with unused pieces are not supported")
        if any(SPACE in n.lstrip(SPACE) for n in self.id_of):
            raise ValueError("a piece has a space after other characters")
        self.bytes = np.full(256, self.unknown)
        surface = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[3:-1], 16)
                self.bytes[value] = i
                surface.append(bytes([value]))
            elif model.is_control(i):
                surface.append(b"")
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                surface.append(name.replace(SPACE, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.fromiter(map(len, surface), np.int64, size)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        # Equal scores get one rank: among them the leftmost pair comes first.
        scores = np.array([model.get_score(i) for i in range(size)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        pairs = [
            (self.id_of[n[:k]], self.id_of[n[k:]], i)
            for n, i in self.id_of.items()
            for k in range(1, len(n))
            if n[:k] in self.id_of and n[k:] in self.id_of
        ]
        table = np.array(pairs or [(size, size, 0)], np.int64)
        key = table[:, 0] * (size + 1) + table[:, 1]
        order = np.argsort(key)
        self.key, self.merged = key[order], table[order, 2].astype(np.int32)
        self.rank = rank[self.merged]
        # Ranks that must merge one at a time: shared by two pieces, or a merge with the piece may
        # rank as high as the piece.
        alone = np.zeros(rank.max() + 2, bool)
        made, count = np.unique(rank[np.unique(self.merged)], return_counts=True)
        alone[made[count > 1]] = True
        for side in (0, 1):
            part = table[:, side]
            quick = rank[table[:, 2]] <= rank[np.minimum(part, size - 1)]
            alone[rank[part[quick & np.isin(part, self.merged)]]] = True
        self.alone = alone
        breaks = [c for c in "\n\t\r" if not any(c in n for n in self.id_of)]
        cls = re.escape("".join(breaks))
        self.words = re.compile(f" *[^ {cls}]+| +|[{cls}]" if breaks else " *[^ ]+| +")

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER`` if there is none) and piece of each pair; symbols past the ids are characters."""
        known = (left < self.size) & (right < self.size)
        key = np.where(known, left.astype(np.int64) * (self.size + 1) + right, -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        found = self.key[at] == key
        return np.where(found, self.rank[at], NEVER), np.where(found, self.merged[at], -1)

    def symbols(self, chars: str) -> np.ndarray:
        """Ids of characters; a character without a piece is its code point past the ids."""
        points = np.frombuffer(chars.encode("utf-32-le"), np.uint32).astype(np.int64)
        distinct, at = np.unique(points, return_inverse=True)
        ids = [self.id_of.get(chr(p), self.size + int(p)) for p in distinct.tolist()]
        return np.array(ids, np.int64)[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids in one array, and the number of ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.symbols("".join(words).replace(" ", SPACE))
        word = np.repeat(np.arange(len(words)), sizes)
        done_word, done_symbol = [], []
        rank, piece = self._pairs(symbol, word)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            runs = np.diff(np.r_[starts, len(word)])
            least = np.minimum.reduceat(rank, starts)
            least = np.repeat(least, runs)
            over = least == NEVER
            done_word.append(word[over])
            done_symbol.append(symbol[over])
            going = ~over
            symbol, word, rank, piece, least = (x[going] for x in (symbol, word, rank, piece, least))
            if not len(symbol):
                break
            hit = rank == least
            place = np.arange(len(hit))
            # Occurrences that overlap: every other one from the left.
            first = hit & ~np.r_[False, hit[:-1]]
            run = np.maximum.accumulate(np.where(first, place, 0))
            hit &= (place - run) % 2 == 0
            single = hit & self.alone[np.minimum(rank, len(self.alone) - 1)]
            if single.any():
                at = np.flatnonzero(single)
                later = at[1:][word[at[1:]] == word[at[:-1]]]
                hit[later] = False
            at = np.flatnonzero(hit)
            symbol[at] = piece[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbol, word, rank, piece = symbol[keep], word[keep], rank[keep], piece[keep]
            at = new[at]
            touched = np.unique(np.r_[at, at[at > 0] - 1])
            rank[touched], piece[touched] = self._pairs(symbol, word, touched)
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        word, symbol = word[order], symbol[order]
        rare = symbol >= self.size
        if rare.any():
            word, symbol = self._fall_back(word, symbol, rare)
        return symbol.astype(np.int32), np.bincount(word, minlength=len(words))

    def _pairs(self, symbol, word, at=None):
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, len(symbol) - 1)
        rank, piece = self.pair(symbol[at], symbol[after])
        apart = (after == at) | (word[after] != word[at])
        rank[apart] = NEVER
        return rank, piece

    def _fall_back(self, word, symbol, rare):
        """Characters without a piece as the pieces of their bytes."""
        coded = {int(s): self.bytes[list(chr(s - self.size).encode())] for s in np.unique(symbol[rare])}
        times = np.ones(len(symbol), np.int64)
        times[rare] = [len(coded[int(s)]) for s in symbol[rare]]
        out = np.repeat(symbol, times)
        out[np.repeat(rare, times)] = np.concatenate([coded[int(s)] for s in symbol[rare]])
        return np.repeat(word, times), out


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class Encoder:
    """Encodes texts; remembers words."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.words, self.known = _Words(), 0
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array, and the number of ids of each text."""
        if len(self.words) > REMEMBERED:
            self.forget()
        at: list[int] = []
        ends = []
        for text in texts:
            if text:
                spaced = " " + text.replace(SPACE, " ")
                at.extend(map(self.words.__getitem__, self.pieces.words.findall(spaced)))
            ends.append(len(at))
        if len(self.words) > self.known:
            ids, sizes = self.pieces.merge(list(self.words)[self.known :])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.known = len(self.words)
        words = np.array(at, np.int64)
        starts, sizes = (np.cumsum(self.sizes) - self.sizes)[words], self.sizes[words]
        ids = self.ids[_ranges(starts, sizes)]
        upto = np.r_[0, np.cumsum(sizes)][np.array(ends, np.int64)]
        return ids, np.diff(np.r_[0, upto])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of every run, in a row."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def decode(pieces: Pieces, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of runs of ids: surfaces in a row, without the space that encoding put in front.

    Bytes that are no UTF-8 become one U+FFFD each.
    """
    spans = pieces.surface_size[ids]
    flat = pieces.surface[_ranges(pieces.surface_start[ids], spans)]
    upto = np.r_[0, np.cumsum(spans)][np.r_[0, np.cumsum(sizes)]]
    raw, out = flat.tobytes(), []
    ends = np.cumsum(sizes)
    for n in range(len(sizes)):
        text = raw[upto[n] : upto[n + 1]]
        if text[:1] == b" ":
            own = ids[ends[n] - sizes[n] : ends[n]]
            if own[np.argmax(pieces.surface_size[own] > 0)] != pieces.unknown:
                text = text[1:]
        try:
            out.append(text.decode())
        except UnicodeDecodeError:
            out.append(text.decode(errors="bytewise"))
    return out


def _bytewise(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("bytewise", _bytewise)


def _transcoded(model: str, with_text: bool):
    names = ["ids", "decoded"] if with_text else ["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        encoder = Encoder(pieces)
        for batch in batches:
            texts = batch.column("text")
            upto = np.r_[0, np.cumsum(pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False))]
            # Batches are cut so that the flat arrays stay small; one long text is one part.
            cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1] + GROUP, GROUP)))
            cuts = np.unique(np.r_[0, np.minimum(cuts, batch.num_rows), batch.num_rows])
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                ids, sizes = encoder(part.column("text").to_pylist())
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                made = [pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]
                if with_text:
                    made.append(pa.array(decode(pieces, ids, sizes), pa.string()))
                rest = [n for n in part.schema.names if n not in names]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in rest], *made], [*rest, *names]
                )

    return run


def encode(docs: DataFrame, model: str, with_text: bool = False) -> DataFrame:
    """``docs`` with ``ids`` of ``text``, and with ``decoded``, the text of those ids, if asked.

    ``model`` is the path of a model file that every executor can open.
    """
    added = "ids array<int>" + ", decoded string" * with_text
    return map_arrow(docs, _transcoded(model, with_text), with_columns_after(docs.schema, added))


def _decoded(model: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            lists = batch.column(column)
            sizes = np.array([len(x or ()) for x in lists.to_pylist()], np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            rest = [n for n in batch.schema.names if n != "decoded"]
            texts = pa.array(decode(pieces, ids, sizes), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in rest], texts], [*rest, "decoded"]
            )

    return run


def decode_ids(rows: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids in ``column``; null ids give an empty text."""
    schema = with_columns_after(rows.schema, "decoded string")
    return map_arrow(rows, _decoded(model, column), schema)
