"""Secret scan with a worklist of decoded layers.

The whole text is the first layer. Every layer is searched for secrets, then unwrapped: percent escapes and Unicode
escapes over the whole layer, and each run of base64, whose bytes may be compressed text. What comes out is a new layer
with the place of each of its characters in the original text, so that whatever is found in it has a span there. Layers
go on the worklist until none is left; one that came before from the same place is not taken again. Bytes are unpacked
until nothing new comes out, over all members, which also ends archives that unpack to themselves; what they unpack to
is searched piece by piece, whatever its size. Bytes that are no readable UTF-8 are searched as Latin-1. Texts are
searched one by one, without a shuffle.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
#: Fixed patterns: a key word with a value, an access key, a run of hexadecimal digits; and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
#: What any `ASSIGN` match holds, in lower case.
KEY_STEMS = ("passw", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{4,})*={0,2}")
PIECE = re.compile(r"[A-Za-z0-9]{16,}={0,2}")
#: What is unpacked at a time, and most bytes of a layer that are held at once.
PIECE_BYTES, LAYER_BYTES = 1 << 20, 64 << 20
#: Bytes that any pattern or encoding here can hold; unpacked data may be parted behind all others.
HELD = np.zeros(256, bool)
HELD[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-\"': \r\n%\\{}&#;")] = True
#: A stretch of `LAYER_BYTES` without such a place is searched in parts that overlap by so much, and counted in `cut_layers`:
#: only an encoded run of that length inside compressed data is not decoded as a whole.
OVERLAP = 1 << 10
#: Any secret, as it stands or encoded, has so many characters in a row.
PRINTABLE = re.compile(rb"[\x20-\x7e\r\n]{16}")
BROKEN = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError)

FOUND = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string,n_layers:bigint,cut_layers:bigint>"


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets in a text as it stands; a kind by its number, ends exclusive."""
    out = []
    low = text.lower()
    if any(stem in low for stem in KEY_STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


@dataclass
class Layer:
    """A text and, for each character, the first and the last place (exclusive) of the original that it came from."""
    text: str
    first: np.ndarray | None = None
    last: np.ndarray | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.first is None:
            return start, end
        return int(self.first[start:end].min()), int(self.last[start:end].max())

    def derived(self, text: str, begins: np.ndarray, ends: np.ndarray) -> Layer:
        """A layer whose characters came from the ranges begins..ends of this one."""
        if self.first is None:
            return Layer(text, begins, ends)
        return Layer(text, self.first[begins], self.last[ends - 1])


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match of `pattern` that `decode` can read put in; None if it reads none."""
    parts, begins, ends, at, any_ = [], [], [], 0, False

    def plain(a: int, b: int) -> None:
        parts.append(layer.text[a:b])
        begins.append(np.arange(a, b))
        ends.append(np.arange(a + 1, b + 1))
    for m in pattern.finditer(layer.text):
        chars = decode(m[0])
        if chars is None:
            continue
        any_ = True
        plain(at, m.start())
        parts.append("".join(c for c, _, _ in chars))
        begins.append(np.array([m.start() + i for _, i, _ in chars]))
        ends.append(np.array([m.start() + j for _, _, j in chars]))
        at = m.end()
    if not any_:
        return None
    plain(at, len(layer.text))
    return layer.derived("".join(parts), np.concatenate(begins).astype(np.int64), np.concatenate(ends).astype(np.int64))


def _utf8(data: bytes, width: int) -> list[tuple[str, int, int]] | None:
    """Characters of bytes that were written `width` characters each."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        out.append((c, at * width, (at + n) * width))
        at += n
    return out


def _percent(run: str):
    data = bytes.fromhex(run.replace("%", ""))
    return _utf8(data, 3) or [(chr(b), 3 * k, 3 * k + 3) for k, b in enumerate(data)]


def _escape(run: str):
    if run.startswith("\\x"):
        data = bytes.fromhex(run.replace("\\x", ""))
        return _utf8(data, 4) or [(chr(b), 4 * k, 4 * k + 4) for k, b in enumerate(data)]
    if run.startswith("&#"):
        c = html.unescape(run)
        return None if not c or "\ud800" <= c[0] <= "\udfff" else [(c[0], 0, len(run))]
    if run.startswith(("\\U", "\\u{")):
        n = int(run.strip("\\uU{}"), 16)
        return None if n > 0x10FFFF or 0xD800 <= n < 0xE000 else [(chr(n), 0, len(run))]
    units, out, k = [int(run[i + 2:i + 6], 16) for i in range(0, len(run), 6)], [], 0
    while k < len(units):
        n, width = units[k], 1
        if 0xD800 <= n < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1] < 0xE000:
            n, width = 0x10000 + (n - 0xD800 << 10) + (units[k + 1] - 0xDC00), 2
        out.append((chr(n) if not 0xD800 <= n < 0xE000 else "�", 6 * k, 6 * (k + width)))
        k += width
    return out


def _tool(data: bytes):
    """A new decompressor for gzip, zlib, bzip2 or xz data; None for other data."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(data) > 2 and data[0] == 0x78 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def unpacked(source: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """Number of the member and bytes, piece by piece; none if the source is not compressed.

    Bytes behind the last member are a member as they stand. A broken member ends with what could be read of it.
    """
    rest, member = b"", 0
    while True:
        while len(rest) < 6 and (more := next(source, None)) is not None:
            rest += more
        tool = _tool(rest)
        if tool is None:
            if member and rest:
                yield member, rest
                yield from ((member, piece) for piece in source)
            return
        while not tool.eof:
            try:
                out = tool.decompress(rest, PIECE_BYTES)
            except BROKEN:
                return
            rest = getattr(tool, "unconsumed_tail", b"")
            if out:
                yield member, out
            elif not tool.eof and not rest:
                rest = next(source, b"")
                if not rest:
                    return
        rest, member = tool.unused_data, member + 1


def _opened(data: bytes, path: tuple[int | None, ...]) -> Iterator[bytes]:
    """What `data` unpacks to in as many steps as the path has; each takes one member, or all with None."""
    def taken(pieces: Iterator[tuple[int, bytes]], which: int | None) -> Iterator[bytes]:
        return (piece for member, piece in pieces if which is None or member == which)
    pieces = iter([data])
    for which in path:
        pieces = taken(unpacked(pieces), which)
    return pieces


def contents(data: bytes) -> Iterator[tuple[str, bool]]:
    """All that `data` unpacks to, and all that this unpacks to, in parts as Latin-1; and whether a part is cut off."""
    todo, known = deque([(data, ())]), {hashlib.sha256(data).digest()}
    while todo:
        origin, path = todo.popleft()
        mark, small, size, at, head, packed = hashlib.sha256(), [], 0, None, b"", []
        held: list[bytes] = []
        for member, piece in unpacked(_opened(origin, path)):
            mark.update(piece)
            size += len(piece)
            if size > LAYER_BYTES:
                small = None
            else:
                small.append(piece)
            if member != at:
                packed += [at] if at is not None and _tool(head) is not None else []
                at, head = member, b""
            head += piece[:6 - len(head)] if len(head) < 6 else b""
            places = np.flatnonzero(~HELD[np.frombuffer(piece, np.uint8)])
            if len(places):
                yield (b"".join(held) + piece[:places[-1] + 1]).decode("latin-1"), False
                piece, held = piece[places[-1] + 1:], []
            held.append(piece)
            if sum(map(len, held)) > LAYER_BYTES:
                part = re.sub(b" +", b" ", b"".join(held))  # any number of spaces matches like one
                held = [part]
                if len(part) > LAYER_BYTES // 2:
                    yield part.decode("latin-1"), True
                    held = [part[-OVERLAP:]]
        if any(held):
            yield b"".join(held).decode("latin-1"), False
        if size and mark.digest() not in known:
            known.add(mark.digest())
            packed += [at] if _tool(head) is not None else []
            if 0 in packed:
                todo.append((origin, (*path, None)) if small is None else (b"".join(small), ()))
            todo += [(origin, (*path, member)) for member in packed if member]


def _readable(data: bytes) -> str | None:
    """The text of UTF-8 data without control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", text) else None


def _base64(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """The layers in runs of base64; a run that is none as a whole may have one behind a slash or another such sign."""
    for m in BASE64.finditer(layer.text):
        sure, inner = _run(layer, m.start(), m[0])
        yield from inner
        if not sure:
            for part in PIECE.finditer(m[0]):
                if len(part[0]) < len(m[0].rstrip("=")):
                    yield from _run(layer, m.start() + part.start(), part[0])[1]


def _run(layer: Layer, at: int, run: str) -> tuple[bool, Iterator[tuple[Layer, bool]]]:
    """Readable text with the place of each character, or unpacked text with the place of the whole run; if there is
    neither, False and the bytes as Latin-1."""
    end, run = at + len(run), run.rstrip("=")
    places = np.array([i for i, c in enumerate(run) if c not in "\r\n"]) + at if "\n" in run else np.arange(at, at + len(run))
    chars = run.replace("\r", "").replace("\n", "").replace("-", "+").replace("_", "/")

    def placed(text: str, sizes: np.ndarray, skip: int) -> Layer:
        after = np.cumsum(sizes)
        begins = places[skip + (after - sizes) * 4 // 3]
        ends = places[np.minimum(skip + -(-after * 4 // 3), len(places)) - 1] + 1
        return layer.derived(text, begins, ends)

    def whole(text: str) -> Layer:
        first, last = layer.span(at, end)
        return Layer(text, np.broadcast_to(np.int64(first), len(text)), np.broadcast_to(np.int64(last), len(text)))
    others = []
    for skip in range(4):
        own = chars[skip:]
        own = own[:-1] if len(own) % 4 == 1 else own
        if len(own) < 12:
            break
        try:
            data = base64.b64decode(own + "=" * (-len(own) % 4))
        except binascii.Error:
            continue
        if _tool(data) is not None:
            inner = contents(data)
            first = next(inner, None)
            if first is not None:
                return True, ((whole(text), cut) for text, cut in chain([first], inner))
        text = _readable(data)
        if text is not None:
            sizes = np.ones(len(text), np.int64) if text.isascii() else np.array([len(c.encode()) for c in text])
            return True, iter([(placed(text, sizes, skip), False)])
        if PRINTABLE.search(data):
            others.append((data.decode("latin-1"), skip))
    return False, ((placed(text, np.ones(len(text), np.int64), skip), False) for text, skip in others)


def _inner(layer: Layer) -> Iterator[tuple[Layer | None, bool, bool]]:
    """The layers one step inside a layer, whether each is cut off, and whether it is the last.

    Escapes over the whole layer come last: who takes the last one needs this layer no more. So text that is escaped any
    number of times over holds one layer at a time; those of base64 are held while they get shorter by a quarter each.
    """
    percent, escapes = "%" in layer.text, "\\" in layer.text or "&#" in layer.text
    for inner, cut in _base64(layer):
        yield inner, cut, False
    if escapes:
        yield _replaced(layer, ESCAPE, _escape), False, not percent
    if percent:
        yield _replaced(layer, PERCENT, _percent), False, True


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base spans, all spans, how many layers were searched, and how many were cut; spans as (start, kind, end)."""
    base = find(text)
    spans, seen, layers, cut = set(base), set(), 1, 0
    # a layer's inner ones are made one at a time, and searched before the next
    work = [_inner(Layer(text))]
    while work:
        inner, short, last = next(work[-1], (None, None, True))
        if last:
            work.pop()
        if inner is not None and inner.text:
            cut += short
            mark = hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(), *inner.span(0, len(inner.text))
            if mark not in seen:
                seen.add(mark)
                layers += 1
                for start, kind, end in find(inner.text):
                    a, b = inner.span(start, end)
                    spans.add((a, kind, b))
                work.append(_inner(inner))
    return base, sorted(spans), layers, cut


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of spans in the order of start, kind and end, with commas."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _finder():
    @F.arrow_udf(FOUND)
    def found(text: pa.Array) -> pa.Array:
        rows = []
        for value in text:
            base, spans, layers, cut = scan(value.as_py() or "")
            kinds = [kind for _, kind, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(),
                         joined(spans), layers, cut))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "cut_layers"]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
    return found


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id and what was found in every row's whole text; other columns are left out.

    `base_sha256` is of the spans in the text as it stands, `spans` has those and what the layers added, mapped to code
    points of the text. NULL is an empty text and has none. Rows are searched one by one: repeated rows and ids are all
    kept, and an empty table gives no rows.
    """
    return docs.select("doc_id", _finder()("text").alias("f")).select("doc_id", "f.*")
