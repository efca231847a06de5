"""Secret scan with a recursive decoding worklist.

Three kinds of secrets are looked for in every whole text, each leftmost and
non-overlapping: ``assign`` (a key word, a separator and a value), ``access``
(access key ids) and ``hex`` (long hexadecimal runs). Then the text is unwrapped:

* percent escapes and Unicode escapes (backslash u/x forms, a string's backslash
  before quotes, slashes and control letters, numeric and named character
  references) are decoded over the whole layer; where percent escapes stand beside
  plus signs, the plus signs are blanks in a second reading (a form's body);
* base64 runs (either alphabet; also wrapped, with any line length and indent)
  are decoded each by itself, when they hold text (UTF-8 or UTF-16) or a known
  compressed stream.
  What adjoins a run may belong to its alphabet (``path/to/<base64>``), so a run
  that isn't text as a whole is decoded at each of its four alignments, which
  meet every place where base64 can start; readable stretches of the bytes and
  streams anywhere in them count;
* gzip, zlib, bzip2, xz and zstandard streams are inflated, all members of them;
  they are sought in base64 and in bytes written as escapes (``%1f%8b``, ``\\x1f``).
  Deflate data without a header is inflated where it is all that a run holds.

Each result is a new layer on the worklist; it is scanned and unwrapped again
until nothing new appears. A layer seen before at the same place (by digest) is
not followed again, which ends cycles such as streams that inflate to
themselves. Hits are mapped back to code points of the original text: through
escapes character by character, through base64 and compression to the whole
encoded run, or to the characters of it that hold the stretch or stream.

A stream that inflates to more than ``max_inflated`` bytes (64 MiB unless given;
its members together) is refused from the member on that exceeds them, as a bomb,
and counted in ``unread``. Damaged members aren't read, and decoded bytes that
aren't readable text are passed over between readable stretches (of ten
characters at least); neither is counted.

Nulls and edges: a null text is an empty one (no spans); a null id is kept;
repeated rows are scanned each; very long texts are scanned whole, in one task's
memory; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from html.entities import html5
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship_package, text_or_empty

KINDS = ("assign", "access", "hex")
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIN_VALUE = 6

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|(?:\\u|%u)([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
                    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|\\([\"'\\/bfnrt])|&([A-Za-z][A-Za-z0-9]{1,31};)")
SHORT = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)+={0,2}")
URL_RUN = re.compile(r"[!$-;=?-Z\[\]_a-z~]{6,}")
ODD_PERCENT = re.compile(r"%[0189A-Fa-f][0-9A-Fa-f]")
PERCENT_BYTE = re.compile(r"(?P<hex>%[0-9A-Fa-f]{2})|.")
LINE = re.compile(r"[\t\x20-\x7e]{6,}")
BYTE = re.compile(r"(?P<hex>\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|%u[0-9A-Fa-f]{4}"
                  r"|&#[xX][0-9A-Fa-f]{1,6};)|(?P<decimal>&#[0-9]{1,7};)|(?P<short>\\[abfnrtv0\\'\"])|.")
LEAST_RUN = 16
LEAST_TEXT = 10
#: ASCII characters of two bytes each, lower or higher byte first.
WIDE = (("utf-16-le", re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){%d,}" % LEAST_TEXT)),
        ("utf-16-be", re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){%d,}" % LEAST_TEXT)))
READABLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){%d,}" % LEAST_TEXT)
STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
MAX_INFLATED = 64 << 20

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,layers:string>>, redacted string, unread int"
_TO_STANDARD = str.maketrans("-_", "+/")


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret that stands in ``text`` itself."""
    out = []
    low = text.lower()
    if any(w in low for w in KEY_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class _Map:
    """From places of a layer to places of the original text."""

    def __init__(self, parent: _Map | None, pieces, whole: tuple[int, int] | None = None):
        # pieces: (start here, start in parent, end in parent, same length), by start
        self.parent, self.pieces, self.whole = parent, pieces, whole
        self.starts = [p[0] for p in pieces]

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.parent is None:
            return start, end
        first, last = (self.pieces[bisect_right(self.starts, i) - 1] for i in (start, end - 1))
        return self.parent.span(first[1] + (start - first[0] if first[3] else 0),
                                last[1] + (end - last[0]) if last[3] else last[2])


def _replaced(text: str, spots) -> tuple[str, list]:
    """The layer with ``spots`` (start, end, decoded) put in, and its pieces."""
    out, pieces, at, here = [], [], 0, 0
    for start, end, decoded in spots:
        if start > at:
            out.append(text[at:start])
            pieces.append((here, at, start, True))
            here += start - at
        out.append(decoded)
        pieces.append((here, start, end, False))
        here, at = here + len(decoded), end
    if at < len(text):
        out.append(text[at:])
        pieces.append((here, at, len(text), True))
    return "".join(out), pieces


def _percent_spots(text: str):
    for m in PERCENT.finditer(text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        at = m.start()
        i = 0
        while i < len(raw):
            for n in (1, 2, 3, 4):  # one character at a time, so that spans stay exact
                try:
                    char = raw[i:i + n].decode()
                except UnicodeDecodeError:
                    continue
                if char:
                    yield at + 3 * i, at + 3 * (i + n), char
                    break
            else:
                n = 1  # not UTF-8: left as it is
            i += n


def _form_spots(text: str):
    """Percent escapes, and plus signs as blanks in runs that have some."""
    spots = list(_percent_spots(text)) if "+" in text else []
    blanks = [(run.start() + i, run.start() + i + 1, " ") for run in URL_RUN.finditer(text) if PERCENT.search(run[0])
              for i, c in enumerate(run[0]) if c == "+"] if spots else []
    yield from sorted(spots + blanks) if blanks else []


def _escape_spots(text: str):
    high = None  # first half of a surrogate pair
    for m in ESCAPE.finditer(text):
        if m[7] or m[8]:
            plain = SHORT.get(m[7], m[7]) if m[7] else html5.get(m[8])
            if plain:
                yield m.start(), m.end(), plain
            high = None
            continue
        digits = next(g for g in m.groups() if g is not None)
        code = int(digits, 10 if m[6] is not None else 16)
        if high and m.start() == high[1] and 0xDC00 <= code < 0xE000:
            yield high[0], m.end(), chr(0x10000 + ((high[2] - 0xD800) << 10) + code - 0xDC00)
            high = None
            continue
        high = (m.start(), m.end(), code) if 0xD800 <= code < 0xDC00 else None
        if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
            yield m.start(), m.end(), chr(code)


class Bomb(ValueError):
    """A stream inflates beyond the limit."""


#: Input that a zstandard frame is fed at a time, which bounds what comes out at once.
STEP = 256


def _member(data, limit: int) -> tuple[bytes, int, bool] | None:
    """Content, length and completeness of the compressed member at the start of ``data``; None if there isn't one."""
    head = bytes(data[:6])
    try:
        if head[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            decoder, out, size = zstandard.ZstdDecompressor().decompressobj(), [], 0
            for at in range(0, len(data), STEP):
                out.append(decoder.decompress(data[at:at + STEP]))
                size += len(out[-1])
                if size > limit:
                    raise Bomb
                if decoder.eof:
                    return b"".join(out), min(at + STEP, len(data)) - len(decoder.unused_data), True
            return b"".join(out), len(data), False
        if head[:2] == b"\x1f\x8b":
            decoder = zlib.decompressobj(31)
        elif head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0:
            decoder = zlib.decompressobj()
        elif head[:3] == b"BZh":
            decoder = bz2.BZ2Decompressor()
        elif head == b"\xfd7zXZ\x00":
            decoder = lzma.LZMADecompressor()
        else:
            return None
        out = decoder.decompress(data, limit + 1)
        if len(out) > limit:
            raise Bomb
        return out, len(data) - len(decoder.unused_data) if decoder.eof else len(data), decoder.eof
    except Bomb:
        raise
    except Exception:  # a run of letters may look like a stream's first bytes
        return None


def _as_text(data: bytes) -> str | None:
    kind = "utf-8"
    if b"\x00" in data and len(data) % 2 == 0:  # every other byte of Latin text
        halves = data[::2].count(0), data[1::2].count(0)
        if max(halves) * 4 > len(data):
            kind = "utf-16-be" if halves[0] > halves[1] else "utf-16-le"
    try:
        text = data.decode(kind)
    except UnicodeDecodeError:
        return None
    text = text.removeprefix("\ufeff")
    odd = sum(not c.isprintable() and c not in "\t\n\r" for c in text) if not text.isprintable() else 0
    return text if text and odd * 20 <= len(text) else None


def _streams(data: bytes, limit: int):
    """(start, end, content or None for a refused bomb) of the compressed streams anywhere in ``data``.

    Members that follow each other are one stream.
    """
    view, at = memoryview(data), 0
    while m := STREAM.search(data, at):
        start = end = m.start()
        out, size, bomb, read = [], 0, False, start + 1
        try:
            while made := _member(view[end:], limit - size):
                out.append(made[0])
                size, end = size + len(made[0]), end + made[1]
                if made[2]:  # one that is cut off, or only looks like a stream, hides nothing after its first byte
                    read = end
        except Bomb:
            bomb, read = True, max(read, end + 1)
        if size:
            yield start, end, b"".join(out)
        if bomb:
            yield start, len(data), None
        at = read


def _headless(data: bytes, limit: int) -> str | None:
    """The text that ``data`` is as deflate data without a header, if it is that to its end."""
    decoder = zlib.decompressobj(-15)
    try:
        out = decoder.decompress(data, limit + 1)
    except zlib.error:
        return None
    if len(out) > limit or not decoder.eof or decoder.unused_data or len(out) < LEAST_TEXT:
        return None
    return _as_text(out)


def _layers(data: bytes, limit: int, steps: str):
    """(start, end, steps, text or None for a refused bomb): what ``data`` holds, through nested streams.

    It is the text that all of it is, or else the content of its streams and its readable stretches.
    """
    work, seen = [(data, None, steps)], set()
    while work:
        data, about, steps = work.pop()
        mark = hashlib.sha256(data).digest()
        if mark in seen:
            continue
        seen.add(mark)
        text = _as_text(data) if len(data) >= LEAST_TEXT else None
        if text is not None:
            yield *(about or (0, len(data))), steps, text
            continue
        for start, end, content in _streams(data, limit):
            if content is None:
                yield *(about or (start, end)), steps, None
            else:
                work.append((content, about or (start, end), steps + ">inflate"))
        plain = about is None and _headless(data, limit)
        if plain:
            yield 0, len(data), steps + ">inflate", plain
        for m in READABLE.finditer(data):
            yield *(about or m.span()), steps, m[0].decode("utf-8", "replace")
        if b"\x00" in data:
            for kind, wide in WIDE:
                for m in wide.finditer(data):
                    yield *(about or m.span()), steps, m[0].decode(kind)


def _decoded_runs(text: str, limit: int):
    """(start, end, steps, text or None for a refused bomb) of what each base64 run holds."""
    runs = [(m.start(), m.end(), m[0], None) for m in BASE64.finditer(text)]
    for m in WRAPPED64.finditer(text):
        kept = [i for i in range(m.start(), m.end()) if not text[i].isspace()]
        if len(kept) >= LEAST_RUN:
            runs.append((m.start(), m.end(), "".join(m[0].split()), kept))
    for first, last, run, places in runs:
        body = run.rstrip("=").translate(_TO_STANDARD)
        for skip in range(4):
            part = body[skip:]
            if len(part) % 4 == 1:
                part = part[:-1]
            data = binascii.a2b_base64(part + "=" * (-len(part) % 4))
            whole = False
            for a, b, steps, content in _layers(data, limit, "base64"):
                whole |= skip == 0 and (a, b) == (0, len(data))
                start, end = skip + a * 4 // 3, min(len(body), skip - (-b * 4 // 3))
                yield (first if a == skip == 0 else places[start] if places else first + start,
                       last if b == len(data) else places[end - 1] + 1 if places else first + end, steps, content)
            if whole:
                break


def _escaped_streams(text: str, limit: int):
    """(start, end, steps, text or None for a refused bomb) of streams whose bytes are written as escapes."""
    runs = []
    if "%" in text:
        for m in URL_RUN.finditer(text):
            if ODD_PERCENT.search(m[0]):
                runs.append(("url", m, PERCENT_BYTE))
    if "\\" in text or "&#" in text:
        for m in LINE.finditer(text):
            if ESCAPE.search(m[0]):
                runs.append(("unicode", m, BYTE))
    for name, run, pattern in runs:
        data, places = bytearray(), array("q")
        for t in pattern.finditer(run[0]):
            data.append(_byte(t))
            places.append(t.start())
        places.append(len(run[0]))
        versions = [bytes(data)]
        if name == "url" and "+" in run[0]:  # a blank, where a form was encoded
            versions.append(bytes(0x20 if c == 0x2B and run[0][p] == "+" else c for c, p in zip(data, places)))
        for made in versions:
            for a, b, content in _streams(made, limit):
                start, end = run.start() + places[a], run.start() + places[b]
                if content is None:
                    yield start, end, name, None
                else:
                    for *_, steps, inner in _layers(content, limit, f"{name}>inflate"):
                        yield start, end, steps, inner


def _byte(token) -> int:
    """The byte that an escape or a character stands for; 0 for what is no byte."""
    kind, t = token.lastgroup, token[0]
    if kind == "hex":
        return int(re.sub(r"[^0-9A-Fa-f]", "", t[2 if t[0] in "\\&" else 1:]) or "0", 16) & 0xFF
    if kind == "decimal":
        return int(t[2:-1]) & 0xFF
    if kind == "short":
        return b"\a\b\f\n\r\t\v\0\\'\""["abfnrtv0\\'\"".index(t[1])]
    return ord(t) & 0xFF


def scan_text(text: str, limit: int = MAX_INFLATED) -> tuple[list[tuple[str, int, int, str]], int]:
    """All spans (kind, start, end, layers) in order of start, kind and end; number of refused streams."""
    found: dict[tuple[str, int, int], str] = {}
    unread = 0
    seen = set()
    work = [(text, _Map(None, []), "", (0, len(text)))]
    while work:
        layer, place, steps, about = work.pop()
        mark = (hashlib.sha256(layer.encode("utf-8", "surrogatepass")).digest(), about) if steps else None
        if mark in seen:
            continue
        seen.add(mark)
        for kind, start, end in find_secrets(layer):
            found.setdefault((kind, *place.span(start, end)), steps)
        for name, hint, spots in (("url", "%", _percent_spots), ("url", "%", _form_spots), ("unicode", "\\&%", _escape_spots)):
            if any(c in layer for c in hint) and (at := list(spots(layer))):
                inner, pieces = _replaced(layer, at)
                work.append((inner, _Map(place, pieces), f"{steps}>{name}" if steps else name, about))
        for start, end, how, inner in chain(_decoded_runs(layer, limit), _escaped_streams(layer, limit)):
            whole = place.span(start, end)
            if inner is None:
                unread += 1
            else:
                work.append((inner, _Map(place, [], whole), f"{steps}>{how}" if steps else how, whole))
    order = sorted(found, key=lambda k: (k[1], KINDS.index(k[0]), k[2]))
    return [(*k, found[k]) for k in order], unread


def redact(text: str, spans, mark: str = "[SECRET]") -> str:
    """``text`` with every stretch that spans cover replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted((s[1], s[2]) for s in spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False,
                 max_inflated: int = MAX_INFLATED) -> DataFrame:
    """(doc_id, spans, redacted, unread) per row.

    A span has its kind, its code points in the original text (end exclusive) and
    the layers it was found under ('' for the text itself, else e.g.
    ``url>base64>inflate``). ``redacted`` holds the text with all spans masked,
    or null unless asked for.
    """
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layers", pa.string())])

    def scan(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            results = [scan_text(t, max_inflated) for t in texts]
            spans = [[dict(zip(("kind", "start", "end", "layers"), s)) for s in r[0]] for r in results]
            masked = [redact(t, r[0]) if redacted else None for t, r in zip(texts, results)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(struct)), pa.array(masked, pa.string()),
                 pa.array([r[1] for r in results], pa.int32())], names=["doc_id", "spans", "redacted", "unread"])

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(scan, SPANS)


def redact_secrets(docs: DataFrame, *, text_col: str = "text", max_inflated: int = MAX_INFLATED) -> DataFrame:
    """``docs`` with every span of its texts masked; all columns, their order and null texts stay."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # mapInArrow takes no dots or backticks in names

    def mask(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            made = [t and redact(t, scan_text(t, max_inflated)[0]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(made, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return plain.mapInArrow(mask, plain.schema).toDF(*docs.columns)
