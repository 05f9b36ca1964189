"""Secret scans through nested encodings, by a recursive decoding worklist.

A text is the first layer. Every layer is searched for secrets and for encoded runs:
percent-encoded and Unicode-escaped text, decoded in place together with the printable
text around it, and base64 runs, possibly of compressed bytes (gzip, zlib, bzip2, xz,
zstandard). Each decoded run is a new layer, which goes on the worklist unless a layer of
the same content and place has been seen, so that runs which decode to themselves or to
each other end. Characters of a layer carry the span of the original text they come from;
a secret found in one is reported with that span. What cannot be decoded is replaced and
hides nothing else. A base64 run that is no clean text as a whole is also read by its
lines and parts and at all four alignments; each reading that shows a secret is reported.
Layers that differ from one another in the length of chains of codes of the percent sign alone
(``%252525``) are skipped.

Each text is handled by itself in Arrow batches: no shuffle, no state between rows, and
a lost task is simply done again. Memory is that of one batch and one text's layers.

Defined cases: a null text counts as empty and has no spans; empty tables give an empty
result; repeated rows are scanned each; equal spans of one kind count once; extra
columns are not read. Compressed runs are read to the end of their last stream. One that
unpacks to more than ``MAX_UNPACKED`` bytes is scanned in overlapping pieces of that size,
one at a time, and counted in ``n_oversized`` (more than ``MAX_COMPRESSIONS`` compressions
directly in each other are not unwrapped); of an encoded run inside it that is longer
than the overlap and crosses two pieces, each piece is read by itself.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import gzip
import hashlib
import io
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.llm.tokens import chunks

# The kinds of secrets, in the order that spans of one start are listed in.
KINDS = ("assign", "access", "hex")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ASSIGN_LEAST = 12
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# A secret is printable ASCII: text around codes is decoded as far as that goes.
_STRETCH = re.compile(r"[\x20-\x7e]+")
_CODES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# A chain of codes of the percent sign, which loses one code a layer.
_CHAIN = re.compile(r"%(?:25){4,}")
# Codes of bytes, which may be compressed ones; from the start of a run, so that one without any code is read once.
_PLAIN = r"[A-Za-z0-9._~:/?\[\]@!$&'()*+,;=-]"
_PERCENT = re.compile(rf"(?<!{_PLAIN})(?:{_PLAIN}*%[0-9A-Fa-f]{{2}})+{_PLAIN}*")
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|u\{([0-9A-Fa-f]{1,6})\}|x([0-9A-Fa-f]{2}))")
# A run of base64 of 16 characters or more, in lines of 60 to 76 characters or in one piece.
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{1,76}|[A-Za-z0-9+/_-]{16,})={0,2}"
)
_BREAK = re.compile(r"[\r\n]+")
_LINE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_PARTS = (re.compile(r"[A-Za-z0-9+_-]{16,}"), re.compile(r"[A-Za-z0-9+/]{16,}"), re.compile(r"[A-Za-z0-9+]{16,}"))
# No secret, and no encoded one, is shorter.
_LEGIBLE = re.compile(rb"[\x20-\x7e]{16}")
_ESCAPED_BYTES = re.compile("[\udc80-\udcff]")

MAX_UNPACKED = 64 << 20
# Layers of compression, one directly in the other: streams that unpack to ever longer ones of their kind exist.
MAX_COMPRESSIONS = 100


@dataclass(frozen=True)
class Layer:
    """A text, and for each character where it begins and ends in the original.

    ``begins`` and ``ends`` are None for the original itself; numbers where all
    characters come from the same place.
    """

    text: str
    begins: array | int | None
    ends: array | int | None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.begins is None:
            return start, end
        if isinstance(self.begins, int):
            return self.begins, self.ends
        return self.begins[start], self.ends[end - 1]


class Written:
    """A layer being made of pieces of another."""

    def __init__(self, layer: Layer):
        self.layer, self.text, self.begins, self.ends = layer, [], array("q"), array("q")

    def copy(self, start: int, end: int) -> None:
        layer = self.layer
        self.text.append(layer.text[start:end])
        if layer.begins is None:
            self.begins.extend(range(start, end))
            self.ends.extend(range(start + 1, end + 1))
        elif isinstance(layer.begins, int):
            self.begins.extend([layer.begins] * (end - start))
            self.ends.extend([layer.ends] * (end - start))
        else:
            self.begins.extend(layer.begins[start:end])
            self.ends.extend(layer.ends[start:end])

    def put(self, char: str, span: tuple[int, int]) -> None:
        self.text.append(char)
        self.begins.append(span[0])
        self.ends.append(span[1])

    def done(self) -> Layer:
        return Layer("".join(self.text), self.begins, self.ends)


def secrets(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the secrets that stand in the text itself."""
    out = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def _clean(data: bytes) -> bool:
    """Whether decoded bytes are text as a whole."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    odd = sum(not (c.isprintable() or c in "\t\n\r") for c in text)
    return bool(text) and odd * 20 <= len(text)


class _Zlib:
    """Reads zlib streams one after the other."""

    def __init__(self, source):
        self.source, self.engine, self.rest = source, zlib.decompressobj(), b""

    def read1(self, size: int) -> bytes:
        while True:
            if self.engine.eof:
                self.rest = self.engine.unused_data or self.source.read1(io.DEFAULT_BUFFER_SIZE)
                self.engine = zlib.decompressobj()
            data = self.rest or self.source.read1(io.DEFAULT_BUFFER_SIZE)
            out = self.engine.decompress(data, size)
            self.rest = self.engine.unconsumed_tail
            if out or not data and not self.engine.eof:
                return out


class _Readable(io.RawIOBase):
    """A decompressing reader that ends where its input is broken."""

    def __init__(self, inner):
        self.inner = inner

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            data = self.inner.read1(len(buffer))
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return 0
        buffer[: len(data)] = data
        return len(data)


class _Zstd:
    def __init__(self, source):
        import zstandard

        self.error = zstandard.ZstdError
        self.reader = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)

    def read1(self, size: int) -> bytes:
        try:
            return self.reader.read1(size)
        except self.error:
            return b""


def _reader(source):
    """What decompresses ``source``, by its first bytes."""
    head = source.peek(6)[:6]
    if head[:2] == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=source)
    if head[:1] == b"\x78" and len(head) > 2 and (head[0] * 256 + head[1]) % 31 == 0:
        return _Zlib(source)
    if head[:3] == b"BZh":
        return bz2.BZ2File(source)
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMAFile(source)
    return _Zstd(source) if head[:4] == b"\x28\xb5\x2f\xfd" else None


def _opened(data: bytes, depth: int) -> io.BufferedReader:
    """The bytes below some layers of compression."""
    source = io.BufferedReader(io.BytesIO(data))
    for _ in range(depth):
        source = io.BufferedReader(_Readable(_reader(source)))
    return source


def _whole_digest(data: bytes, depth: int) -> bytes:
    source, digest = _opened(data, depth), hashlib.sha256()
    while block := source.read(1 << 20):
        digest.update(block)
    return digest.digest()


def _unpacked(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Pieces of the unpacked bytes, unpacked as often as they are compressed; whether a piece is the second.

    A layer that equals an earlier one as a whole ends the unwrapping; layers are compared where they begin alike.
    """
    source, depth, heads, digests = _opened(data, 0), 0, {}, {}
    inner = _reader(source)
    if inner is None:
        return
    while inner is not None and depth < MAX_COMPRESSIONS:
        alike = heads.setdefault(bytes(source.peek(io.DEFAULT_BUFFER_SIZE)), [])
        alike.append(depth)
        if len(alike) > 1:
            digests |= {d: _whole_digest(data, d) for d in alike if d not in digests}
            if any(digests[d] == digests[depth] for d in alike[:-1]):
                break
        source, depth = io.BufferedReader(_Readable(inner)), depth + 1
        inner = _reader(source)
    piece, count = b"", 0
    while block := source.read(MAX_UNPACKED - len(piece)):
        piece, count = piece + block, count + 1
        yield piece, count == 2
        piece = piece[-(MAX_UNPACKED // 8) :]


def _bytes_layers(data: bytes, place: tuple[int, int]) -> Iterator[tuple[Layer | None, bool]]:
    """The layers that decoded bytes make; whether they are found to be oversized."""
    packed = False
    for piece, oversized in _unpacked(data):
        packed = True
        yield (Layer(piece.decode("utf-8", "replace"), *place) if _LEGIBLE.search(piece) else None), oversized
    if not packed and _LEGIBLE.search(data):
        yield Layer(data.decode("utf-8", "replace"), *place), False


def _percent_layer(layer: Layer, start: int, end: int) -> Layer | None:
    out, last = Written(layer), start
    codes = list(_CODES.finditer(layer.text, start, end))
    chains = [_CHAIN.match(layer.text, m.start(), end) for m in codes if m.end() - m.start() == 3]
    if chains and len(chains) == len(codes) and all(chains):
        # The next layers differ in the chains' own digits only, until the shortest has two codes left.
        cut = min(m.end() - m.start() for m in chains) - 5
        for m in chains:
            out.copy(last, m.start())
            last = m.start() + 1 + cut
            out.put("%", layer.span(m.start(), last))
        out.copy(last, end)
        return out.done()
    for m in codes:
        out.copy(last, m.start())
        last, at = m.end(), m.start()
        for char in bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"):
            odd = _ESCAPED_BYTES.match(char)
            size = 3 if odd else 3 * len(char.encode())
            out.put("\ufffd" if odd else char, layer.span(at, at + size))
            at += size
    if last == start:
        return None
    out.copy(last, end)
    return out.done()


def _percent_bytes(layer: Layer, start: int, end: int) -> Iterator[tuple[Layer | None, bool]]:
    """The layers of a run whose bytes are compressed."""
    run = layer.text[start:end].encode()
    data = re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m[1].decode()), run)
    for piece, oversized in _unpacked(data):
        yield Layer(piece.decode("utf-8", "replace"), *layer.span(start, end)), oversized


def _escape_layer(layer: Layer, start: int, end: int) -> Layer | None:
    out, last = Written(layer), start
    for m in _ESCAPE.finditer(layer.text, start, end):
        if last < m.start():
            out.copy(last, m.start())
        last = m.end()
        code = int(m[1] or m[2] or m[3], 16)
        code = code if code <= 0x10FFFF else 0xFFFD
        place = layer.span(m.start(), last)
        # Two halves of a surrogate pair are one character.
        if out.text and 0xD800 <= ord(out.text[-1][-1]) < 0xDC00 <= code < 0xE000:
            code = 0x10000 + ((ord(out.text.pop()) - 0xD800) << 10) + code - 0xDC00
            place = (out.begins.pop(), place[1])
            out.ends.pop()
        out.put(chr(code), place)
    if last == start:
        return None
    out.copy(last, end)
    return out.done()


def _from_base64(run: str) -> bytes:
    """The bytes of a run, without the rest that is none."""
    run = run[: len(run) - (len(run) % 4 == 1)]
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), altchars=None, validate=True)
    except (binascii.Error, ValueError):
        return b""


def _base64_layers(layer: Layer, start: int, end: int) -> Iterator[tuple[Layer | None, bool]]:
    text = layer.text[start:end]
    plain = lambda run: run.rstrip("=").replace("-", "+").replace("_", "/")
    whole = plain(_BREAK.sub("", text))
    data = _from_base64(whole)
    yield from _bytes_layers(data, layer.span(start, end))
    if len(whole) % 4 != 1 and _clean(data):
        return
    packed = next(_unpacked(data), None) is not None
    # The parts of a compressed run are none by themselves, but another may begin on a later line.
    patterns = (_LINE,) if packed else (_LINE, *_PARTS)
    pieces = {(m.start(), m.end()) for pattern in patterns for m in pattern.finditer(text)}
    if packed:
        pieces = {(a, b) for a, b in pieces if a > 0}
    for a, b in sorted(pieces):
        run = plain(text[a:b])
        for skip in range(4):
            if (a, b, skip) != (0, len(text), 0):
                yield from _bytes_layers(_from_base64(run[skip:]), layer.span(start + a, start + b))
    if "\n" in text and not packed:
        for skip in range(1, 4):
            yield from _bytes_layers(_from_base64(whole[skip:]), layer.span(start, end))


def encoded_runs(layer: Layer) -> Iterator[tuple[Layer | None, bool]]:
    text = layer.text
    if "%" in text:
        for m in _PERCENT.finditer(text):
            yield from _percent_bytes(layer, *m.span())
    if "%" in text or "\\" in text:
        for m in _STRETCH.finditer(text):
            for code, decoded in (("%", _percent_layer), ("\\", _escape_layer)):
                if text.find(code, *m.span()) >= 0:
                    yield decoded(layer, *m.span()), False
    for m in _BASE64.finditer(text):
        yield from _base64_layers(layer, *m.span())


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans, all spans (both by start, then kind), and the number of layers scanned in pieces."""
    base = secrets(text)
    # Layers are made one at a time, so that the pieces of a large one are never all in memory.
    found, oversized, seen, work = set(base), 0, set(), [encoded_runs(Layer(text, None, None))]
    while work:
        inner, large = next(work[-1], (None, None))
        if large is None:
            work.pop()
            continue
        oversized += large
        if inner is None or not inner.text:
            continue
        place = inner.span(0, len(inner.text))
        mark = (hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(), place)
        if mark in seen:
            continue
        seen.add(mark)
        found.update((kind, *inner.span(a, b)) for kind, a, b in secrets(inner.text))
        work.append(encoded_runs(inner))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(found, key=order), oversized


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"


def secret_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``base_spans``, ``all_spans`` (arrays of kind, start, end) and ``n_oversized`` of every row."""

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            scanned = [scan(value or "") for value in batch.column(1).to_pylist()]
            as_rows = [
                [[dict(zip(("kind", "start", "end"), span, strict=True)) for span in spans] for spans in (base, every)]
                for base, every, _ in scanned
            ]
            columns = [
                batch.column(0),
                pa.array([r[0] for r in as_rows], _SPANS),
                pa.array([r[1] for r in as_rows], _SPANS),
                pa.array([cut for _, _, cut in scanned], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "base_spans", "all_spans", "n_oversized"])

    schema = f"`{key}` {dict(df.dtypes)[key]}, base_spans {_SPANS_DDL}, all_spans {_SPANS_DDL}, n_oversized long"
    return df.select(key, text).mapInArrow(scan_batches, schema)


def span_list(spans: str):
    """The column ``spans`` as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and the digest of the base spans, and all spans as text."""

    def of_kind(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secret_spans(df, key, text).select(
        key,
        *[of_kind(kind) for kind in KINDS],
        F.sha2(span_list("base_spans"), 256).alias("base_sha256"),
        span_list("all_spans").alias("spans"),
        "n_oversized",
    )


def redacted(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``df`` with every span that holds a secret replaced by ``mark``.

    Spans that touch or overlap are replaced as one. Texts without secrets, null
    included, stay as they are.
    """
    at = df.columns.index(text)
    schema = df.schema

    def redact(value: str | None) -> str | None:
        spans = scan(value)[1] if value else []
        if not spans:
            return value
        out, last = [], 0
        for _, start, end in spans:
            if start > last or not out:
                out += [value[last:start], mark]
            last = max(last, end)
        return "".join([*out, value[last:]])

    def redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, at):
            new = pa.array([redact(v) for v in batch.column(at).to_pylist()], pa.string())
            columns = [*batch.columns[:at], new, *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(redact_batches, schema)
