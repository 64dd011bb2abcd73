"""Secrets: base patterns over texts and over every layer that can be unwrapped from them.

The text of a document is the first layer of a worklist.  Each layer is scanned
with the base patterns and unwrapped in every way that applies:

- ``url``: the whole layer with its percent escapes decoded (a chain of encoded
  percent signs, as in ``%252541``, in one step);
- ``unicode``: the whole layer with ``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``,
  ``\\xXX``, ``&#N;`` and ``&#xX;`` escapes decoded, or UTF-16 made UTF-8;
- ``fold``: the whole layer without the line breaks inside wrapped base64;
- ``base64``: each run of 19 or more base64 letters (the shortest that can hold a
  secret), either alphabet, at each of the four alignments;
- ``compressed``: gzip, zlib, bzip2, xz and zstandard streams, also a stream
  inside a layer that has other bytes around it.

What comes out is a new item, with a map from its bytes to the bytes of the
layer it came from, until no layer gives a new one.  A layer whose content was
already met at the same place is not done again, so streams that unpack to
themselves and the two orders of two unwrappings end (cycle detection).  Spans
of secrets in a layer are mapped back, layer by layer, to the smallest span of
the text that encodes them; one in a compressed layer has the span of the stream.

A document's layers depend on no other document, so one map pass over the
documents, without a shuffle, does the work; a lost task is run again.  Texts
that have nothing to unwrap (almost all) take part only in the base scan over
whole Arrow buffers.

Defined cases: a null text counts as empty; spans are code point offsets, end
exclusive; ids are copied, so null and repeated ids and repeated rows come back as
they are; an empty table gives an empty result; only the id and text columns are
read.  A text of any length is scanned whole: base runs are found with byte masks,
and layers keep only the places of their escapes.  When a document's layers come to
more than 32 times its length plus ``most_unpacked`` bytes, what else is found in it
is reported as a span of kind ``unopened`` and not opened, so that a decompression
bomb can't take down an executor and isn't passed over either.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.bytetext import buffers, chunks, lower

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
UNOPENED = "unopened"
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
# The shortest secret is 14 bytes (a five letter word, a sign, eight characters): 19 letters of base64.
MIN_RUN = 19
MOST_UNPACKED = 1 << 26

Span = tuple[int, int, int]                 # kind, start, end: bytes of a layer

# A chain of encoded signs ("%2525..", "&#38;#38;..") is decoded in one step.
_PERCENT = re.compile(rb"%(?:25)*([0-9A-Fa-f]{2})")
_ESCAPE = re.compile(rb"\\u(?:005[cC]u)*([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
                     rb"|&#(?:38;#)*([0-9]{1,7});|&#[xX](?:26;#[xX])*([0-9A-Fa-f]{1,6});")
_FOLD = re.compile(rb"(?<=[A-Za-z0-9+/_-]{60})\r?\n(?=[A-Za-z0-9+/_-])")
_SIGNS = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_OPENERS: dict[bytes, Callable] = {
    b"\x1f": lambda: zlib.decompressobj(31), b"\x78": lambda: zlib.decompressobj(15),
    b"B": bz2.BZ2Decompressor, b"\xfd": lzma.LZMADecompressor,
    b"\x28": lambda: zstandard.ZstdDecompressor().decompressobj()}


class Back(NamedTuple):
    """How a span of a layer maps to a span of the layer it came from, and on from there."""
    step: Callable[[int, int], tuple[int, int]]
    rest: Back | None

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The span of the text."""
        way = self
        while way is not None:
            a, b = way.step(a, b)
            way = way.rest
        return a, b


class Layer(NamedTuple):
    """Bytes and their way back to the text; data None: known to be there, not unpacked."""
    data: bytes | None
    back: Back


def find(data: bytes) -> list[Span]:
    """Base spans of a layer: leftmost, not overlapping within a kind; too short ones go."""
    out = [(0, *m.span()) for m in ASSIGN.finditer(data) if m.end() - m.start(1) >= MIN_ASSIGN] \
        if any(k in data.lower() for k in KEYWORDS) else []
    out += [(1, *m.span()) for m in ACCESS.finditer(data) if m.end() - m.start() >= MIN_ACCESS]
    a, b = _runs(_HEX[np.frombuffer(data, np.uint8)], MIN_HEX)
    return out + [(2, int(s), int(e)) for s, e in zip(a, b, strict=True)]


def _table(letters: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(letters, np.uint8)] = True
    return t


_HEX = _table(b"0123456789abcdef")
_LETTERS = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _runs(inside: np.ndarray, least: int, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` true places; none crosses a ``cut``."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0] = edge[-1] = True
    if cut is not None:
        edge[cut] = True
    at = np.flatnonzero(edge)
    a, b = at[:-1], at[1:]
    keep = b - a >= least
    a, b = a[keep], b[keep]
    keep = inside[a] if len(a) else np.zeros(0, bool)
    return a[keep], b[keep]


def _replaced(layer: Layer, pattern: re.Pattern, make: Callable[[re.Match], bytes | None]) -> Layer | None:
    """The layer with matches of the pattern replaced; None where nothing changes."""
    out, marks, at = bytearray(), array("q"), 0
    for m in pattern.finditer(layer.data):
        new = make(m)
        if new is not None:
            out += layer.data[at:m.start()]
            marks.extend((len(out), len(out) + len(new), m.start(), m.end()))
            out += new
            at = m.end()
    if not marks:
        return None
    out += layer.data[at:]
    place = np.frombuffer(marks, np.int64).reshape(-1, 4)     # new start and end, old start and end

    def old(byte: int, end: bool) -> int:
        """Old start (or end) of what a byte came from: itself, or the whole of its escape."""
        k = int(np.searchsorted(place[:, 1], byte, side="right"))       # the first escape that ends after it
        if k < len(place) and place[k, 0] <= byte:
            return int(place[k, 3 if end else 2])
        return byte + end + (int(place[k - 1, 3] - place[k - 1, 1]) if k else 0)

    return Layer(bytes(out), Back(lambda a, b: (old(a, False), old(b - 1, True)), layer.back))


def _code_point(m: re.Match) -> bytes | None:
    digits = next(g for g in m.groups() if g is not None)
    n = int(digits, 10 if m.group(5) is not None else 16)
    return chr(n).encode("utf-8", "surrogatepass") if n < 0x110000 else None


def _wide(layer: Layer) -> Layer | None:
    """UTF-16 of mostly Latin letters as UTF-8."""
    data = layer.data
    if len(data) < 2 * MIN_RUN or data.count(0) * 5 < 2 * len(data):
        return None
    skip = 2 if data[:2] in (b"\xff\xfe", b"\xfe\xff") else 0
    low = 0 if data[skip + 1:200:2].count(0) >= data[skip:200:2].count(0) else 1
    units = np.frombuffer(data[skip:len(data) - (len(data) - skip) % 2], np.uint8).reshape(-1, 2)
    narrow = np.where(units[:, 1 - low] == 0, units[:, low], np.uint8(0x3F)).tobytes()
    return Layer(narrow, Back(lambda a, b: (skip + 2 * a, skip + 2 * b), layer.back))


def _base64(layer: Layer) -> Iterator[Layer]:
    """Decoded runs of base64 letters, at each alignment."""
    a, b = _runs(_LETTERS[np.frombuffer(layer.data, np.uint8)], MIN_RUN)
    for start, end in zip(a.tolist(), b.tolist(), strict=True):
        run = layer.data[start:end].replace(b"-", b"+").replace(b"_", b"/")
        for skip in range(4):
            letters = run[skip:]
            if len(letters) < MIN_RUN:
                break
            letters = letters[:len(letters) - (len(letters) % 4 == 1)]
            data = binascii.a2b_base64(letters + b"=" * (-len(letters) % 4))
            first = start + skip
            yield Layer(data, Back(lambda a, b, n=first: (n + 8 * a // 6, n - (-8 * b // 6)), layer.back))


def _unpacked(data: bytes, at: int, most: int) -> tuple[bytes | None, int] | None:
    """What the stream at a place unpacks to (None: over ``most`` bytes) and where it ends."""
    sign = data[at:at + 1]
    opener, parts, size, given = _OPENERS[sign](), [], 0, at
    pump, step = (_pump_zlib, 1 << 16) if sign in b"\x1f\x78" else (_pump, 1 << 16)
    if sign == b"\x28":
        pump, step = (lambda z, piece: [z.decompress(piece)]), 256      # a block holds 128 KB at most
    try:
        while not opener.eof and given < len(data):
            piece = data[given:given + step]
            given += len(piece)
            for out in pump(opener, piece):
                parts.append(out)
                size += len(out)
                if size > most:
                    return None, given
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        pass                            # broken off, or no stream at all: what came out so far counts
    return (b"".join(parts), given - len(opener.unused_data)) if size else None


def _pump_zlib(opener, piece: bytes) -> Iterator[bytes]:
    """Output for one piece of input, a megabyte at a time."""
    yield opener.decompress(piece, 1 << 20)
    while opener.unconsumed_tail:
        yield opener.decompress(opener.unconsumed_tail, 1 << 20)


def _pump(opener, piece: bytes) -> Iterator[bytes]:
    """The same for bzip2 and xz, which keep their input."""
    yield opener.decompress(piece, 1 << 20)
    while not opener.needs_input and not opener.eof:
        yield opener.decompress(b"", 1 << 20)


def scan_text(data: bytes, most_unpacked: int = MOST_UNPACKED) -> tuple[list[Span], list[tuple[str, int, int, str]]]:
    """Base spans of a text, and the spans of its layers as (kind, start, end, way to the layer)."""
    base = find(data)
    known = {(KINDS[k], a, b) for k, a, b in base}
    more: dict[tuple[str, int, int], str] = {}
    text = Layer(data, Back(lambda a, b: (a, b), None))
    work: deque[tuple[Layer, str]] = deque([(text, "")])
    met = {_print(text)}
    left = most_unpacked + 32 * len(data)
    while work:
        layer, way = work.popleft()
        if way and not way.endswith("fold"):        # folding only serves base64
            for k, a, b in find(layer.data):
                span = (KINDS[k], *layer.back.span(a, b))
                if span not in known:
                    more.setdefault(span, way)
        for name, child in _children(layer, left):
            mark = _print(child) if child.data is not None else b""
            if mark in met:
                continue
            if child.data is None or len(child.data) > left:
                more.setdefault((UNOPENED, *child.back.span(0, len(child.data or b"?"))), f"{way}/{name}")
                continue
            left -= len(child.data)
            met.add(mark)
            work.append((child, f"{way}/{name}"))
    return base, sorted((k, a, b, way[1:]) for (k, a, b), way in more.items())


def _print(layer: Layer) -> bytes:
    """Content and place of a layer."""
    a, b = layer.back.span(0, len(layer.data)) if layer.data else (0, 0)
    return hashlib.blake2b(layer.data, digest_size=16).digest() + a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _children(layer: Layer, most: int) -> Iterator[tuple[str, Layer]]:
    """What a layer unwraps to."""
    data = layer.data
    if b"%" in data and (x := _replaced(layer, _PERCENT, lambda m: bytes([int(m.group(1), 16)]))):
        yield "url", x
    if (b"\\" in data or b"&#" in data) and (x := _replaced(layer, _ESCAPE, _code_point)):
        yield "unicode", x
    if b"\n" in data and (x := _replaced(layer, _FOLD, lambda m: b"")):
        yield "fold", x
    if b"\x00" in data and (x := _wide(layer)):
        yield "unicode", x
    for x in _base64(layer):
        yield "base64", x
    end = 0
    for m in _SIGNS.finditer(data):
        got = _unpacked(data, m.start(), most) if m.start() >= end else None
        if got is not None:
            out, end = got
            yield "compressed", Layer(out, Back(lambda a, b, s=m.start(), e=end: (s, e), layer.back))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("layer", pa.string())]))


def _batch_base(d: np.ndarray, o: np.ndarray) -> dict[int, list[Span]]:
    """Base spans of those documents of a chunk that have any, as byte offsets in the document."""
    found: dict[int, list[Span]] = {}
    whole, small = d.tobytes(), lower(d).tobytes()
    doc = lambda place: int(np.searchsorted(o, place, side="right")) - 1        # noqa: E731
    holders: set[int] = set()
    for word in KEYWORDS:
        at = small.find(word)
        while at >= 0:
            i = doc(at)
            holders.add(i)
            at = small.find(word, int(o[i + 1]))        # the next document
    for i in sorted(holders):
        for m in ASSIGN.finditer(whole[o[i]:o[i + 1]]):
            if m.end() - m.start(1) >= MIN_ASSIGN:
                found.setdefault(i, []).append((0, *m.span()))
    at = whole.find(b"AKIA")
    while at >= 0:
        i = doc(at)
        for m in ACCESS.finditer(whole[o[i]:o[i + 1]]):
            if m.end() - m.start() >= MIN_ACCESS:
                found.setdefault(i, []).append((1, *m.span()))
        at = whole.find(b"AKIA", int(o[i + 1]))
    a, b = _runs(_HEX[d], MIN_HEX, o)
    for s, e in zip(a.tolist(), b.tolist(), strict=True):
        i = doc(s)
        found.setdefault(i, []).append((2, s - int(o[i]), e - int(o[i])))
    return found


def _to_unwrap(d: np.ndarray, o: np.ndarray) -> set[int]:
    """Documents of a chunk that have anything to unwrap."""
    a, _ = _runs(_LETTERS[d], MIN_RUN, o)
    at = np.flatnonzero((d == 0x25) | (d == 0x5C) | (d == 0) | (d == 0x1F) | (d == 0x78) & _next(d, b"\x01\x5e")
                        | (d == 0x26) & _next(d, b"#") | (d == 0x42) & _next(d, b"Z"))
    return set((np.searchsorted(o, np.concatenate([a, at]), side="right") - 1).tolist())


def _next(d: np.ndarray, letters: bytes) -> np.ndarray:
    out = np.zeros(len(d), bool)
    out[:-1] = _table(letters)[d[1:]]
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 most_unpacked: int = MOST_UNPACKED) -> DataFrame:
    """Per document: id, ``base`` spans, and ``hidden`` spans found in its unwrapped layers.

    Spans are structs (kind, start, end, layer): code points of the whole text,
    and the way to the layer, as ``url/base64`` (empty for base spans).  Base
    spans come by start, then kind; hidden ones likewise, without those that the
    base scan has found too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for first, last, d, o in chunks(data, off):
                base, hidden = [[] for _ in range(last - first)], [[] for _ in range(last - first)]
                plain = _batch_base(d, o)
                for i in sorted(plain.keys() | _to_unwrap(d, o)):
                    text = d[o[i]:o[i + 1]]
                    rows = [(KINDS[k], a, b, "") for k, a, b in plain.get(i, [])]
                    extra = scan_text(text.tobytes(), most_unpacked)[1]
                    base[i], hidden[i] = _in_points(text, rows), _in_points(text, extra)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(base, _FOUND), pa.array(hidden, _FOUND)],
                    ["_id", "base", "hidden"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    span = "array<struct<kind: string, start: bigint, end: bigint, layer: string>>"
    return rows.mapInArrow(run, f"_id {kind}, base {span}, hidden {span}").withColumnRenamed("_id", id_col)


_ORDER = {k: i for i, k in enumerate((*KINDS, UNOPENED))}


def _in_points(text: np.ndarray, spans: list) -> list[dict]:
    """Byte spans as code point spans, by start and kind."""
    if not spans:
        return []
    places = np.array([(a + 1, b) for _, a, b, _ in spans], np.int64)
    points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])[places] - [1, 0]
    rows = [{"kind": s[0], "start": int(p[0]), "end": int(p[1]), "layer": s[3]}
            for s, p in zip(spans, points, strict=True)]
    return sorted(rows, key=lambda r: (r["start"], _ORDER[r["kind"]], r["end"]))
