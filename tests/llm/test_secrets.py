"""Secret scans against the plain patterns and against layers built by hand."""

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import time
import zlib
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandmill.llm import queries, secrets

SECRET = "password = hunter2hunter2"


def plain(text):
    """The base patterns as they are written, ASCII letters in either case for the first."""
    out = []
    assign = (
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def base(text):
    raw = text.encode()
    found = secrets.find(text)[0] if secrets.may_hold(raw) else []
    return [f"{k}:{a}:{b}" for k, a, b, layer in found if layer == 0]


parts = st.sampled_from(
    ["password", "PassWd", "secret", "ſecret", "toKen", "api_key", "APIKEY", ":", "=", " ", "'", '"',
     "abcdefgh", "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef", "é", "😀", "\n", "%41", "\\u0041", "Z"]
)


@settings(max_examples=600, deadline=None)
@given(st.lists(parts, max_size=14).map("".join))
def test_base_spans(text):
    assert base(text) == plain(text)


def test_documents(spark, sf):
    rows = {r.doc_id: r for r in queries.op10_secret_scan(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = plain(d.text or "")
        assert rows[d.doc_id].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(rows[d.doc_id].spans.split(","))


def b64(raw):
    return base64.b64encode(raw).decode()


LAYERS = {
    "base64": lambda s: b64(s.encode()),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode(),
    "gzip": lambda s: b64(gzip.compress(s.encode())),
    "zlib": lambda s: b64(zlib.compress(s.encode())),
    "bzip2": lambda s: b64(bz2.compress(s.encode())),
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "braces": lambda s: "".join(f"\\u{{{ord(c):x}}}" for c in s),
    "bytes": lambda s: "".join(f"\\x{b:02x}" for b in s.encode()),
}


@pytest.mark.parametrize("outer", LAYERS)
@pytest.mark.parametrize("inner", LAYERS)
def test_nested_layers(inner, outer):
    hidden = LAYERS[outer](LAYERS[inner](SECRET))
    text = f"é before {hidden} after"
    found, complete = secrets.find(text)
    assert complete and secrets.may_hold(text.encode())
    start = text.index(hidden)
    hits = [(a, b) for k, a, b, layer in found if k == "assign" and layer]
    assert hits and all(start <= a < b <= start + len(hidden) for a, b in hits)


def test_span_of_the_part_that_holds_it():
    text = "x" + quote("é ") + "tok%65n=abcdefgh y"
    assert secrets.find(text)[0] == [("assign", text.index("tok"), len(text) - 2, 1)]
    run = b64(b"some words in front token: abcdefgh12 and behind")
    (_, a, b, _), = secrets.find(run)[0]
    inside = base64.b64decode(run[a // 4 * 4 : -(-b // 4) * 4])
    assert b"token: abcdefgh12" in inside and len(inside) < 25


@pytest.mark.parametrize("layer", LAYERS)
def test_equal_runs_at_other_places(layer):
    hidden = LAYERS[layer](SECRET)
    text = f"{hidden} first\n{hidden} second\n{LAYERS['base64'](SECRET)} third"
    found, complete = secrets.find(text)
    assert complete
    runs = [(m.start(), m.end()) for m in re.finditer(re.escape(hidden), text)]
    runs.append((text.index(" second\n") + 8, text.index(" third")))
    for start, end in runs:
        assert any(k == "assign" and start <= a < b <= end for k, a, b, _ in found)


def wrapped(run, width, end="\n"):
    return end.join(run[i : i + width] for i in range(0, len(run), width))


def hit_in(text, start, end):
    found, complete = secrets.find(text)
    assert complete and secrets.may_hold(text.encode())
    return any(k == "assign" and layer and start <= a < b <= end for k, a, b, layer in found)


@pytest.mark.parametrize("before", ["blob_", "cfg-", "x/", "k/v/", "/d/", "abc", "ab", "x", "é/"])
@pytest.mark.parametrize("after", ["", "/rest", "-tail", "_x"])
@pytest.mark.parametrize("layer", ["base64", "urlsafe", "gzip", "zlib", "bzip2"])
def test_run_inside_a_longer_one(layer, before, after):
    for pad in range(3):
        run = LAYERS[layer]("x" * pad + " " + SECRET).rstrip("=")
        text = f"see {before}{run}{after} end"
        start = len(f"see {before}")
        assert hit_in(text, max(0, start - 4), start + len(run) + len(after))


@pytest.mark.parametrize("layer", ["base64", "urlsafe", "gzip", "zlib", "bzip2"])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r", "\n    "])
@pytest.mark.parametrize("width", [10, 16, 64, 75, 76])
def test_wrapped_run(layer, end, width):
    noise = hashlib.sha512(b"n").hexdigest().replace("a", " ") * 3
    run = wrapped(LAYERS[layer](noise + SECRET + " " + noise), width, end)
    text = f"é head:\n{run}\nlast words"
    start = text.index(run)
    assert hit_in(text, start, start + len(run) + 12)


def test_runs_on_neighbouring_lines():
    run = b64(b"password = hunter2hunter")
    assert not run.endswith("=")
    text = f"{run}\n{run}\n{run}"
    for n in range(3):
        start = n * (len(run) + 1)
        assert hit_in(text, start, start + len(run))


def test_readable_part_of_binary_data():
    text = b64(b"\xff\xfe\x00\x01" + SECRET.encode() + b"\x00\xff" * 9)
    assert hit_in(text, 0, len(text))


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zlib.compress])
def test_every_member_of_compressed_data(pack):
    for members in [["plain words", SECRET], ["plain words", "more", SECRET, "end"]]:
        text = b64(b"".join(pack(m.encode()) for m in members))
        assert hit_in(text, 0, len(text))


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zlib.compress])
def test_secret_over_two_members(pack):
    text = b64(pack(SECRET[:6].encode()) + pack(SECRET[6:].encode()))
    assert hit_in(text, 0, len(text))


@pytest.mark.parametrize("head", ["x^", "BZh", "BZh9 ", "x\x01"])
def test_text_that_begins_like_compressed_data(head):
    text = b64((head + " " + SECRET).encode())
    assert hit_in(text, 0, len(text))


def test_broken_stream_gives_what_comes_first():
    raw = gzip.compress((SECRET + " " + "words " * 9).encode())
    text = b64(raw[:-8] + b"\0" * 8)
    assert hit_in(text, 0, len(text))


def test_cycle_and_broken_layers():
    for text in ["%41" * 9, "%25" * 50, "%2525252541", "%FF%FE%41", "\\ud800\\u0041", "A" * 64, "=" * 40,
                 b64(b"\x1f\x8b broken"), b64(zlib.compress(b"x" * 500)[:-8]), "\\u{110000}", "\\U00110000"]:
        found, complete = secrets.find(text)
        assert found == [] and complete


def test_bomb_is_reported():
    text = b64(zlib.compress(b" " * 5_000_000)) + " token=abcdefghij"
    found, complete = secrets.find(text, max_decoded=100_000)
    assert not complete and len(found) == 1
    assert secrets.find(text)[1]


def test_frames(docs_of):
    rows = [(1, None), (2, ""), (3, SECRET), (3, SECRET), (None, "x " * 100_000 + SECRET)]
    df = docs_of(rows).withColumns({"spans": F.lit(1), "base": F.lit("clash")})
    out = secrets.scan_secrets(df).collect()
    assert sorted(len(r.spans) for r in out) == [0, 0, 1, 1, 1]
    assert all(r.complete and r.base == "clash" for r in out)
    assert secrets.scan_secrets(docs_of([])).count() == 0


def test_only_unpacking_is_charged():
    """Layers that are no longer than their text are scanned whatever their size."""
    hidden = base64.b64encode(b"password = hunter2hunter2").decode()
    text = "%41" + "x" * 5000 + " " + hidden
    found, complete = secrets.find(text, max_decoded=100)
    assert complete and [s[0] for s in found] == ["assign"]


def test_false_heads_of_streams_cost_little():
    raw = base64.b64encode(b"BZh9" * 60_000).decode()
    begin = time.time()
    assert secrets.find(raw) == ([], True)
    assert time.time() - begin < 20
