"""Secret scans through nested encodings (operator 13).

A text is the first layer on a worklist.  Each layer is scanned for secrets, and
its URL escapes, Unicode escapes, base64 runs and what these hold in compressed
form are unwrapped into further layers, until no layer gives a new one.  A layer
knows for each of its characters the span of the original text it came from:
escapes and base64 map character by character, compressed bytes map to the whole
run that held them.  A layer with the content and origin of an earlier one isn't
opened again, which ends cycles (an archive may hold itself) and keeps two orders
of unwrapping from doubling the work.

Documents are independent, so this is one pass without a shuffle.  Bytes that
can't hold a secret or an encoding are told apart by a few searches over the
whole text before any pattern runs.

A layer that would unpack to more than ``layer_bytes`` (or, in xz, ask for more
than four times that as its window) is reported as a span of
kind ``oversize`` instead of being opened: one short run can stand for terabytes.

Defined cases: null and empty texts have no spans; repeated rows are scanned
each; a null key is kept; an empty table gives no rows; other columns never take
part.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martkit.llm.common import byte_values, table

LAYER_BYTES = 64 << 20
KINDS = ("assign", "access", "hex", "oversize")  # in the order of ties
SPANS = "array<struct<kind:string,start:int,end:int,layers:string>>"

# fixed values: the patterns of secrets, and the least size of what they match
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_SIZE = 6
# maximal runs, so the least size can stand in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX_SIZE = 24
HEX = re.compile(rf"[0-9a-f]{{{HEX_SIZE},}}")

# the shortest secret, "token=" and six characters, takes 16 in base64
BASE64_SIZE = 16
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{BASE64_SIZE},}}(?:\r?\n[A-Za-z0-9+/_-]+)*={{0,2}}")
DROPPED, LINE = re.compile("[\r\n=]"), re.compile(r"[^\r\n]+")
SEGMENT = re.compile(rf"[A-Za-z0-9]{{{BASE64_SIZE},}}={{0,2}}")
READABLE = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")  # as long as the shortest secret
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ESCAPE = re.compile(r"[0-9A-Fa-f]+")
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def _class(pattern: str) -> bytes:
    held = re.compile(pattern)
    return bytes(b < 128 and held.match(chr(b)) is not None for b in range(256))


HEX_BYTES, BASE64_BYTES = _class("[0-9a-f]"), _class("[A-Za-z0-9+/_-]")


def scan(text: str, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand in a text as it is."""
    raw = text.encode("utf-8", "surrogatepass") if raw is None else raw
    found, low = [], raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_SIZE]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    if b"\1" * HEX_SIZE in raw.translate(HEX_BYTES):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def may_hold_layers(raw: bytes) -> bool:
    return b"%" in raw or b"\\" in raw or b"&#" in raw or b"\1" * BASE64_SIZE in raw.translate(BASE64_BYTES)


# --- layers: (name, text, start of each character, end of each) in the layer above


def text_of(raw: bytes, starts: np.ndarray, ends: np.ndarray):
    """(text, starts, ends) of bytes in UTF-8 or UTF-16 without control characters."""
    try:
        text = raw.decode("utf-8")
        lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        if not CONTROL.search(text):
            return text, starts[lead], ends[np.append(lead[1:], len(raw)) - 1]
    except UnicodeDecodeError:
        pass
    even = raw[: len(raw) & ~1]
    marked = even[:2] in (b"\xff\xfe", b"\xfe\xff")
    for name, zero in (("utf-16-le", 1), ("utf-16-be", 0)):
        if marked and even[:2] != (b"\xff\xfe" if zero else b"\xfe\xff"):
            continue
        body = even[2 * marked :]
        if not body or (not marked and body[zero::2].count(0) * 2 < len(body) // 2):
            continue
        try:
            text = body.decode(name)
        except UnicodeDecodeError:
            continue
        if not CONTROL.search(text):
            width = np.array([2 if ord(c) < 1 << 16 else 4 for c in text])
            stops = 2 * marked + np.cumsum(width)
            return text, starts[stops - width], ends[stops - 1]
    return None


class Oversize(Exception):
    pass


def inflated(raw: bytes, limit: int) -> tuple[str, bytes] | None:
    """(name, content) of compressed bytes; those after a stream's end are ignored."""
    if raw[:2] == b"\x1f\x8b":
        name, opener = "gzip", zlib.decompressobj(31)
    elif len(raw) > 2 and raw[0] & 15 == 8 and raw[0] >> 4 < 8 and (raw[0] << 8 | raw[1]) % 31 == 0:
        name, opener = "zlib", zlib.decompressobj()
    elif raw[:3] == b"BZh":
        name, opener = "bz2", bz2.BZ2Decompressor()
    elif raw[:6] == b"\xfd7zXZ\0":
        name, opener = "xz", lzma.LZMADecompressor(memlimit=4 * limit)
    else:
        return None
    try:
        out = opener.decompress(raw, limit + 1)
    except (zlib.error, OSError, EOFError):
        return None
    except lzma.LZMAError as error:
        if "limit" in str(error):
            raise Oversize from error
        return None
    if len(out) > limit:
        raise Oversize
    return (name, out) if out else None


def opened(raw: bytes, starts: np.ndarray, ends: np.ndarray, limit: int):
    """(name, text, starts, ends) of bytes that are text or hold it compressed."""
    name, seen = "", set()
    while raw and (digest := hashlib.sha256(raw).digest()) not in seen:
        seen.add(digest)
        plain = text_of(raw, starts, ends)
        if plain:
            return name, *plain
        inner = inflated(raw, limit)
        if inner is None:
            return None
        name, raw = f"{name}>{inner[0]}", inner[1]
        starts, ends = np.full(len(raw), starts[0]), np.full(len(raw), ends[-1])
    return None


def url_bytes(run: str) -> tuple[str, list[int]]:
    """Decoded text and the number of escapes of each character."""
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        return text, [1] * len(text)
    return text, [len(c.encode("utf-8")) for c in text]


def unescaped(text: str, pattern: re.Pattern):
    """The whole text with its escapes replaced, or None if it has none."""
    out, starts, ends, at = [], [], [], 0

    def plain(a: int, b: int) -> None:
        out.append(text[a:b])
        starts.append(np.arange(a, b))
        ends.append(np.arange(a + 1, b + 1))

    for m in pattern.finditer(text):
        plain(at, m.start())
        at = m.end()
        if pattern is URL:
            chars, sizes = url_bytes(m[0])
            stops = m.start() + 3 * np.cumsum(sizes)
            begins = stops - 3 * np.array(sizes)
        else:
            chars, begins, stops = unicode_chars(m[0], m.start())
        out.append(chars)
        starts.append(np.asarray(begins, np.int64))
        ends.append(np.asarray(stops, np.int64))
    if not at:
        return None
    plain(at, len(text))
    return "".join(out), np.concatenate(starts), np.concatenate(ends)


ONE_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")


def unicode_chars(run: str, offset: int) -> tuple[str, list[int], list[int]]:
    chars, begins, stops, at = [], [], [], 0
    while at < len(run):
        # \u and \x have as many digits as their pattern says, whatever follows
        fixed = {"\\u": 6, "\\U": 10, "\\x": 4}.get(run[at : at + 2]) if run[at : at + 3] != "\\u{" else None
        m = ONE_UNICODE.match(run, at, at + fixed if fixed else len(run))
        code = int(m[3]) if m[3] else int(m[1] or m[2] or m[4], 16)
        joins = chars and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(chars[-1]) < 0xDC00
        if joins:
            chars[-1] = chr(0x10000 + ((ord(chars[-1]) - 0xD800) << 10) + code - 0xDC00)
            stops[-1] = offset + m.end()
        else:
            chars.append(chr(code) if code < 0x110000 else "\ufffd")
            begins.append(offset + at)
            stops.append(offset + m.end())
        at = m.end()
    return "".join(chars), begins, stops


class Run:
    """The digits of a base64 run and where they stand in the layer."""

    def __init__(self, text: str, a: int, b: int):
        self.a, self.b, self.text = a, b, text[a:b]
        self.digits = DROPPED.sub("", self.text).translate({45: "+", 95: "/"})

    def bytes_from(self, skip: int) -> bytes:
        size = len(self.digits) - skip
        size -= size % 4 == 1
        return base64.b64decode(self.digits[skip : skip + size] + "=" * (-size % 4))

    def spans(self, skip: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of each byte read from the ``skip``-th digit on."""
        held = np.array([i for i, c in enumerate(self.text, self.a) if c not in "\r\n="], dtype=np.int64)
        bits = 8 * np.arange(size)
        return held[skip + bits // 6], held[skip + (bits + 7) // 6] + 1


def may_open(raw: bytes) -> bool:
    """Whether bytes may be text or compressed, at little cost."""
    if not raw:
        return False
    if raw[:2] in (b"\x1f\x8b", b"BZ", b"\xfd7", b"\xff\xfe", b"\xfe\xff") or raw[0] & 15 == 8 or raw.count(0) * 4 >= len(raw):
        return True
    try:
        return not CONTROL.search(raw.decode("utf-8"))
    except UnicodeDecodeError:
        return False


def line_groups(lines: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Lines as wrapped base64 has them: of one length, the last one shorter."""
    groups, width = [], 0
    for a, b in lines:
        if groups and width and b - a <= width:
            groups[-1].append((a, b))
            width = width if b - a == width else 0
        else:
            groups.append([(a, b)])
            width = b - a
    return groups


def unbased(text: str, limit: int) -> Iterator[tuple]:
    """Layers of the base64 runs.  A run that doesn't hold text, or text in
    compressed form, as a whole is tried by wrapped lines, single lines and then
    between the signs that may be its own or not; what is left may start at any
    digit, so the readable stretches of its four readings are layers."""

    def whole(run: Run) -> tuple | None:
        for skip in range(4):
            raw = run.bytes_from(skip)
            if not may_open(raw):
                continue
            try:
                layer = opened(raw, *run.spans(skip, len(raw)), limit)
            except Oversize:
                return "oversize", None, np.array([run.a]), np.array([run.b])
            if layer:
                return f"base64{layer[0]}", *layer[1:]
        return None

    for m in BASE64.finditer(text):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in LINE.finditer(m[0])]
        for group in line_groups(lines):
            left, layer = group, None
            if len(group) > 1:
                layer, left = whole(Run(text, group[0][0], group[-1][1])), []
                if layer is None:
                    layer, left = (whole(Run(text, group[0][0], group[-2][1])) if len(group) > 2 else None), group[-1:]
                if layer is None:
                    left = group
            if layer:
                yield layer
            for a, b in left:
                if b - a < BASE64_SIZE:
                    continue
                run = Run(text, a, b)
                layer = whole(run)
                if layer:
                    yield layer
                    continue
                parts = [x.span() for x in SEGMENT.finditer(text, a, b)]
                found = [x for x in (whole(Run(text, *p)) for p in parts if p != (a, b)) if x]
                yield from found
                for skip in range(0 if found else 4):
                    raw = run.bytes_from(skip)
                    for x in READABLE.finditer(raw):
                        starts, ends = run.spans(skip, len(raw))
                        yield "base64", x[0].decode("ascii"), starts[slice(*x.span())], ends[slice(*x.span())]


def layers(text: str, limit: int) -> Iterator[tuple]:
    for name, pattern, sign in (("url", URL, "%"), ("unicode", UNICODE, None)):
        if sign is None or sign in text:
            found = unescaped(text, pattern)
            if found:
                yield name, *found
    yield from unbased(text, limit)


def secrets_in(raw: bytes, limit: int = LAYER_BYTES) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, layers) in order; layers is empty for what stands in the
    text as it is, else the names of the encodings around it, outermost first."""
    deep = may_hold_layers(raw)
    text = raw.decode("utf-8", "replace")
    found = {(s, KINDS.index(k), e): "" for k, s, e in scan(text, raw)}
    work = deque([(text, None, None, "")] if deep else [])
    seen = {(0, len(text), hashlib.sha256(raw).digest())}
    while work:
        text, starts, ends, path = work.popleft()
        for name, inner, a, b in layers(text, limit):
            if starts is not None:
                a, b = starts[a], ends[b - 1]
            names = f"{path}>{name}" if path else name
            if inner is None:
                found.setdefault((int(a[0]), KINDS.index(name), int(b[0])), names)
                continue
            if not inner:
                continue
            content = inner.encode("utf-8", "surrogatepass")
            mark = (int(a[0]), int(b[-1]), hashlib.sha256(content).digest())
            if mark in seen:
                continue
            seen.add(mark)
            for kind, s, e in scan(inner, content):
                found.setdefault((int(a[s]), KINDS.index(kind), int(b[e - 1])), names)
            if may_hold_layers(content):
                work.append((inner, a, b, names))
    return [(KINDS[k], s, e, found[s, k, e]) for s, k, e in sorted(found)]


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", layer_bytes: int = LAYER_BYTES) -> DataFrame:
    """One row per document: key and spans (kind, start, end, layers)."""
    plain = docs.select(F.col(key).alias("k"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("x"))
    schema = StructType([StructField("k", plain.schema["k"].dataType), *StructType.fromDDL(f"spans {SPANS}").fields])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layers", pa.string())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "layers"), s, strict=True)) for s in secrets_in(raw, layer_bytes)] for raw in byte_values(batch.column("x"))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(spans, kind)], ["k", "spans"])

    return plain.mapInArrow(rows, schema).select(F.col("k").alias(key), "spans")


def spans_text(spans):
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def q_op13(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents"))
    base = found.withColumn("base", F.filter("spans", lambda s: s["layers"] == ""))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return base.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


QUERIES = {"op13_secret_scan": q_op13}
ORACLE_SQL: dict[str, str] = {}
