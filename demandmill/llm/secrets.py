"""Secret scans: a worklist of decoded layers, each scanned like the text itself.

The text is layer 0. Escapes in a layer (URL ``%41``, Unicode ``\\u0041``) are undone in place and make
one new layer; every readable part of a base64 run makes one, whatever stands before or behind it in the
run and over line breaks, and gzip, zlib, bzip2 or xz data in a run is unpacked and makes one. New layers
go on the worklist until none is left; a layer with the text and the origins of one seen before is
dropped, so cycles end and equal runs at other places stay. Every layer's characters know the span of the
original text they come from, and what is found in a layer is reported at that span.

Kinds and patterns are fixed by ``KINDS``; a match that is too short is dropped after it has taken its
characters. Spans are code points, end exclusive; those of layer 0 are the base spans and always stay.
A span found again in a layer is not repeated.

Null text counts as empty and has no spans. Texts are scanned whole. One document's layers together are
unpacked up to ``MAX_DECODED`` characters (a text can hold a decompression bomb); a document that goes
beyond is marked ``complete`` = false and keeps what was found. Repeated rows get equal results; other
columns stay as they are, columns named like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.llm.common import LOWER, map_arrow, with_columns_after

#: Kind, pattern, group that counts, least characters of it. Fixed values.
KINDS = [
    (
        "assign",
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE | re.ASCII,
        ),
        2, 8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
]
ORDER = {kind: n for n, (kind, *_) in enumerate(KINDS)}
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: The long form of the hex pattern finds the same long runs and skips short ones quickly.
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
ESCAPE = re.compile(
    r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+"
)
#: The shortest text with a secret, 14 characters, is 19 characters of base64; nested ones are longer.
LEAST_BYTES, LEAST_RUN = 14, 19
#: A long run, or one that a line break follows, with the runs that only line breaks part from it.
RUNS = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{19,}+|[A-Za-z0-9+/_-]++(?=[ \t]*+[\r\n]))"
    r"(?:[ \t]*+[\r\n][ \t\r\n]*+[A-Za-z0-9+/_-]++)*+"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
STANDARD = str.maketrans("-_", "+/")
ZLIB = (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
UTF8 = re.compile(
    rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
    rb"|\xf4[\x80-\x8f][\x80-\xbf]{2})++"
)
#: Bytes of compressed data unpacked at a time.
PIECE = 4096
MAX_DECODED = 1 << 26

_RUN_CLASS = bytes(
    120 if chr(c).isalnum() and c < 128 or c in b"+/_-" else 32 for c in range(256)
)
_HEX_CLASS = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))

#: Line breaks are left out of a run.
BREAK = re.compile(rb"(?<![ \t])[ \t]*+[\r\n][ \t\r\n]*+")

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """Base spans of one text: every kind, leftmost, not overlapping within a kind."""
    found = []
    for kind, pattern, group, least in KINDS:
        pattern = LONG_HEX if kind == "hex" else pattern
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end()))
    return found


@dataclass
class Layer:
    """A text and, for its characters, the start and end of where they come from."""

    text: str
    start: np.ndarray
    end: np.ndarray
    depth: int

    def origin(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def key(self) -> bytes:
        """Equal for layers of one text whose characters come from the same places."""
        parts = hashlib.sha256(self.text.encode())
        parts.update(np.ascontiguousarray(self.start, np.int64))
        parts.update(np.ascontiguousarray(self.end, np.int64))
        return parts.digest()


def _unescaped(piece: str) -> list[tuple[str, int, int]]:
    """Characters of one run of escapes with the part of the run that made them."""
    if piece[0] == "%" or piece[1] == "x":
        step, digits = (3, 1) if piece[0] == "%" else (4, 2)
        raw = bytes(int(piece[i + digits : i + step], 16) for i in range(0, len(piece), step))
        out, at = [], 0
        while at < len(raw):
            size = next((n for n in (1, 2, 3, 4) if _is_text(raw[at : at + n])), 0)
            if size:
                out.append((raw[at : at + size].decode(), at * step, (at + size) * step))
            else:  # a byte that is no UTF-8 stays as it is
                size = 1
                out += [(c, at * step + i, at * step + i + 1) for i, c in enumerate(piece[at * step : (at + 1) * step])]
            at += size
        return out
    if piece[1] == "U" or piece[2] == "{":
        point = int(piece[2:].strip("{}"), 16)
        if point > 0x10FFFF or 0xD800 <= point < 0xE000:
            return [(c, i, i + 1) for i, c in enumerate(piece)]
        return [(chr(point), 0, len(piece))]
    units = [int(piece[i + 2 : i + 6], 16) for i in range(0, len(piece), 6)]
    out, at = [], 0
    while at < len(units):
        unit = units[at]
        if 0xD800 <= unit < 0xDC00 and at + 1 < len(units) and 0xDC00 <= units[at + 1] < 0xE000:
            point = 0x10000 + ((unit - 0xD800) << 10) + units[at + 1] - 0xDC00
            out.append((chr(point), 6 * at, 6 * at + 12))
            at += 2
        else:
            char = "�" if 0xD800 <= unit < 0xE000 else chr(unit)
            out.append((char, 6 * at, 6 * at + 6))
            at += 1
    return out


def _is_text(raw: bytes) -> bool:
    try:
        return bool(raw.decode())
    except UnicodeDecodeError:
        return False


def unescape(layer: Layer) -> Layer | None:
    """The layer with its escapes undone in place; None without any."""
    texts, starts, ends, last = [], [], [], 0
    for m in ESCAPE.finditer(layer.text):
        a = m.start()
        texts.append(layer.text[last:a])
        starts.append(layer.start[last:a])
        ends.append(layer.end[last:a])
        for char, i, j in _unescaped(m[0]):
            lo, hi = layer.origin(a + i, a + j)
            texts.append(char)
            starts.append(np.array([lo]))
            ends.append(np.array([hi]))
        last = m.end()
    if not last:
        return None
    texts.append(layer.text[last:])
    starts.append(layer.start[last:])
    ends.append(layer.end[last:])
    return Layer("".join(texts), np.concatenate(starts), np.concatenate(ends), layer.depth + 1)


def unpack(raw: bytes, room: int, start: int = 0) -> tuple[bytes, int, bool]:
    """Data of the compressed stream at ``start`` of ``raw`` and of those of its kind that follow at once.

    Also the bytes they take, and whether all of their data is there. A broken stream gives what comes
    before the break and takes one byte, so what follows is looked at.
    """
    out, size, at = [], 0, start
    kind = raw[start : start + 2]
    while at < len(raw) and raw[at : at + 2] == kind:
        tool, step, begun = _unpacker(raw[at : at + 6]), PIECE, at
        if tool is None:
            break
        while at < len(raw) and not tool.eof:
            before = tool.copy() if step > 1 and hasattr(tool, "copy") else None
            try:
                got = tool.decompress(raw[at : at + step], room - size)
            except (zlib.error, OSError, lzma.LZMAError, EOFError):
                if before is None:
                    return b"".join(out), begun + 1 - start, True
                tool, step = before, 1  # up to the very byte that breaks it
                continue
            at = min(at + step, len(raw))
            out.append(got)
            size += len(got)
            if size >= room:
                return b"".join(out), len(raw) - start, False
        at -= len(tool.unused_data)
    return b"".join(out), at - start, True


def _unpacker(head: bytes):
    if head.startswith(b"\x1f\x8b"):
        return zlib.decompressobj(31)
    if head.startswith(ZLIB):
        return zlib.decompressobj()
    if head.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if head.startswith(b"\xfd7zXZ\x00"):
        return lzma.LZMADecompressor(format=lzma.FORMAT_XZ)
    return None


def _texts(raw: bytes) -> Iterator[tuple[int, int]]:
    """Start and end of the parts of ``raw`` that are text and may hold something."""
    if not may_hold(raw):
        parts = []
    elif _is_text(raw):
        parts = [(0, len(raw))]
    else:
        parts = [m.span() for m in UTF8.finditer(raw)]
    return ((a, b) for a, b in parts if b - a >= LEAST_BYTES and may_hold(raw[a:b]))


def _packed(raw: bytes, room: int) -> Iterator[tuple[bytes, int, int, bool]]:
    """Data of every compressed stream in ``raw``, the bytes it takes, and whether all of it is there.

    Streams within the data of a stream count as its bytes.
    """
    work, seen = [(raw, None)], set()
    while work:
        within, span = work.pop()
        at = 0
        while m := MAGIC.search(within, at):
            data, taken, whole = unpack(within, room, m.start())
            at = m.start() + max(1, taken)
            place = span or (m.start(), at if taken > 1 else len(raw))
            if len(data) < LEAST_BYTES or (data, place) in seen:
                continue
            room = max(1, room - len(data))
            seen.add((data, place))
            work.append((data, place))
            yield data, *place, whole


def _joined_runs(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Characters of every base64 run, and their places.

    Runs parted by line breaks only are taken each by itself, as blocks (an empty line, or a line
    shorter than the one before, ends a block) and all together.
    """
    for found in RUNS.finditer(text):
        if found.end() - found.start() < LEAST_RUN:
            continue
        lines = [(m.start(), m.end()) for m in LINE.finditer(text, found.start(), found.end())]
        cuts = [0]
        for i in range(1, len(lines)):
            (a, b), (c, d) = lines[i - 1], lines[i]
            gap = text[b:c]
            shorter = i - 1 > cuts[-1] and b - a < lines[i - 2][1] - lines[i - 2][0]
            if shorter or gap.count("\n") > 1 or "\n" not in gap and gap.count("\r") > 1:
                cuts.append(i)
        parts = {(i, i + 1) for i in range(len(lines))} | set(zip(cuts, [*cuts[1:], len(lines)]))
        for i, j in sorted(parts | {(0, len(lines))}):
            if sum(b - a for a, b in lines[i:j]) >= LEAST_RUN:
                places = np.concatenate([np.arange(a, b) for a, b in lines[i:j]])
                yield "".join(text[a:b] for a, b in lines[i:j]).translate(STANDARD), places


def decoded_runs(layer: Layer, room: int) -> Iterator[tuple[Layer, bool, int]]:
    """A layer for every part of a base64 run that holds text, and for what is unpacked from one.

    With each, whether it is whole, and by how much unpacking made it longer.

    A run may begin or end with characters that are not of the encoded part (``blob_``, a path), so
    each of the four ways to deal it into groups is tried and its readable parts are kept.
    """
    for chars, places in _joined_runs(layer.text):
        for skip in range(4):
            run = chars[skip:]
            run = run[: len(run) - (len(run) % 4 == 1)]
            raw = base64.b64decode(run + "=" * (-len(run) % 4))
            # Byte i of the run lies in characters 4i/3 to 4(i + 1)/3.
            own = places[skip : skip + len(run)]
            for a, b in _texts(raw):
                text = raw[a:b].decode()
                sizes = np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
                to = a + np.cumsum(sizes)
                first, last = (to - sizes) * 4 // 3, np.minimum(-(-to * 4 // 3), len(run)) - 1
                yield Layer(text, layer.start[own[first]], layer.end[own[last]], layer.depth + 1), True, 0
            for data, a, b, whole in _packed(raw, room):
                at = own[a * 4 // 3 : min(-(-b * 4 // 3), len(run))]
                lo, hi = int(layer.start[at].min()), int(layer.end[at].max())
                for x, y in _texts(data):
                    text = data[x:y].decode()
                    starts, ends = np.full(len(text), lo), np.full(len(text), hi)
                    yield Layer(text, starts, ends, layer.depth + 1), True, max(0, y - x - (b - a))
                if not whole:
                    yield Layer("", own[:0], own[:0], layer.depth + 1), False, 0


def find(text: str, max_decoded: int = MAX_DECODED) -> tuple[list[tuple[str, int, int, int]], bool]:
    """``(kind, start, end, layer)`` of a text and its layers by start, kind, end; and completeness."""
    spans = {span: 0 for span in scan(text)}
    place = np.arange(len(text))
    work = [Layer(text, place, place + 1, 0)]
    seen = {work[0].key()}
    room, complete = max_decoded, True
    while work:
        layer = work.pop()
        plain = unescape(layer)
        made = [(plain, True, 0)] if plain else []
        for new, whole, grown in chain(made, decoded_runs(layer, max(1, room))):
            complete &= whole
            if not new.text:
                continue
            key = new.key()
            if key in seen:
                continue
            # Undone escapes and base64 are no longer than what they come from; only unpacking grows.
            if grown > room:
                complete = False
                continue
            room -= grown
            seen.add(key)
            work.append(new)
            for kind, a, b in scan(new.text):
                spans.setdefault((kind, *new.origin(a, b)), new.depth)
    rows = sorted((a, ORDER[kind], b, kind, depth) for (kind, a, b), depth in spans.items())
    return [(kind, a, b, depth) for a, _, b, kind, depth in rows], complete


def may_hold(raw: bytes) -> bool:
    """False only for texts in which nothing can be found or decoded: one quick look at the bytes."""
    low = raw.translate(LOWER)
    return (
        any(word in low for word in KEYWORDS)
        or b"%" in raw
        or b"\\" in raw
        or len(max(BREAK.sub(b"", raw).translate(_RUN_CLASS).split(), key=len, default=b"")) >= 16
    )


SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layer", pa.int32())]
)


def _scanned(max_decoded: int):
    names = ["spans", "complete"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, complete = [], []
            for raw in batch.column("text").cast(pa.binary()):
                raw = raw.as_py()
                found, whole = find(raw.decode(), max_decoded) if raw and may_hold(raw) else ([], True)
                spans.append([dict(zip(("kind", "start", "end", "layer"), s)) for s in found])
                complete.append(whole)
            rest = [n for n in batch.schema.names if n not in names]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in rest],
                    pa.array(spans, pa.list_(SPAN)), pa.array(complete, pa.bool_()),
                ],
                [*rest, *names],
            )

    return run


def scan_secrets(docs: DataFrame, max_decoded: int = MAX_DECODED) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, layer; layer 0 is the text itself) and ``complete``."""
    added = "spans array<struct<kind string, start long, end long, layer int>>, complete boolean"
    return map_arrow(docs, _scanned(max_decoded), with_columns_after(docs.schema, added))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )
