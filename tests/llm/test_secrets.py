"""Secret scan: base kinds, every kind of layer, their nesting, mapping, cycles and bombs."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import re
import urllib.parse
import zlib

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import secrets as S
from blotter.llm.queries import op1_secret_scan
from conftest import SF_SMALL

SECRET = "password = hunter2secret"
KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
HEX = "0123456789abcdef01234567"


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def found(text):
    return [(k, a, b) for k, a, b, _ in S.scan_text(text)[0]]


def plain(text):
    """The three base kinds, spelled out the long way."""
    out = []
    key = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)
                   for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer("(" + key + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0]), s[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "SeCrEt", "token", "api_key", "APIKEY", "Kapi", "=", ": ", "'", '"', " ", "abc123", "==",
                                 KEY, "AKIA", HEX, "0f", "g", "é", "\n", "Passwd="]), max_size=14).map("".join))
def test_base_kinds(text):
    assert sorted(S.find_secrets(text), key=lambda s: (s[1], S.KINDS.index(s[0]), s[2])) == plain(text)


@pytest.mark.parametrize("wrap", [
    lambda s: urllib.parse.quote(s, safe=""), lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: "".join(f"&#{ord(c)};" for c in s),
    lambda s: "".join(f"\\x{ord(c):02x}" for c in s), lambda s: "".join(f"\\u{{{ord(c):x}}}" for c in s),
    b64, lambda s: b64(b64(s)), lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    lambda s: b64(gzip.compress(s.encode())), lambda s: b64(zlib.compress(s.encode())), lambda s: b64(bz2.compress(s.encode())),
    lambda s: b64(lzma.compress(s.encode())), lambda s: b64(zstandard.ZstdCompressor().compress(s.encode())),
    lambda s: b64(gzip.compress(zlib.compress(s.encode()))), lambda s: b64(gzip.compress(b64(s).encode())),
    lambda s: urllib.parse.quote(b64(gzip.compress(urllib.parse.quote(s, safe="").encode())), safe=""),
])
def test_every_layer_and_nesting(wrap):
    coded = wrap(SECRET)
    text = f"é before <{coded}> after"
    start = text.index("<") + 1
    spans = found(text)
    assert any(k == "assign" for k, _, _ in spans)
    for k, a, b in spans:
        assert start <= a < b <= start + len(coded)
    assert found("nothing <" + wrap("a plain sentence of words") + "> here") == []


QUOTED = 'the "password": "hunter2secret" is here'
FORMS = [lambda s: json.dumps(json.dumps(s)), lambda s: s.replace('"', "&quot;"), lambda s: s.replace(":", "&colon;").replace('"', "&#34;"),
         urllib.parse.quote_plus, lambda s: b64(s.encode("utf-16-le")), lambda s: b64(s.encode("utf-16")),
         lambda s: b64(s.encode("utf-16-be")), lambda s: b64(b"\x07\xfe\x91" + s.encode("utf-16-le")),
         lambda s: b64(zlib.compress(s.encode(), wbits=-15))]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("outer", [lambda s: s, b64, urllib.parse.quote_plus, lambda s: json.dumps(s), lambda s: b64(gzip.compress(s.encode()))])
def test_string_escapes_named_references_forms_and_wide_text(form, outer):
    text = f"see <{outer(form(QUOTED))}> end"
    assert any(k == "assign" for k, _, _ in found(text)), text
    assert not any(k == "assign" for k, _, _ in found(S.redact(text, S.scan_text(text)[0])))
    assert found(f"see <{outer(form('a plain sentence with words'))}> end") == []


def test_spans_through_string_escapes_and_references_are_exact():
    assert found('x {"a": "{\\"token\\": \\"hunter2secret\\"}"}') == [("assign", 12, 36)]
    assert found("é password&colon;&quot;hunter2secret&quot;") == [("assign", 2, 36)]
    assert found("a=1&q=password+%3D+hunter2secret&z=1") == [("assign", 6, 32)]
    assert found("C:\\new\\tokens &unknown; 1 + 1 %20") == []


@pytest.mark.parametrize("before", ["https://x.com/", "id-", "path/to/", "a_", "x/y-z_", "data\n"])
@pytest.mark.parametrize("coded", [b64(SECRET), base64.urlsafe_b64encode(SECRET.encode() + b"?>~" * 3).decode().rstrip("="),
                                   b64(gzip.compress(SECRET.encode())), b64(zstandard.ZstdCompressor().compress(SECRET.encode()))])
@pytest.mark.parametrize("after", ["", "/more", " end"])
def test_base64_beside_letters_of_its_alphabet(before, coded, after):
    text = f"see {before}{coded}" + (after if "=" not in coded else " end")
    spans = found(text)
    assert any(k == "assign" for k, _, _ in spans)
    assert not any(k == "assign" for k, _, _ in found(S.redact(text, S.scan_text(text)[0])))


@pytest.mark.parametrize("width, indent, coder", [(64, "", base64.b64encode), (20, "", base64.b64encode), (100, "", base64.b64encode),
                                                  (76, "    ", base64.b64encode), (48, "\t", base64.urlsafe_b64encode)])
def test_wrapped_base64_of_any_shape(width, indent, coder):
    noise = hashlib.sha512(b"1").digest() + hashlib.sha512(b"2").digest()
    for payload in (gzip.compress(noise.hex().replace("a", " z").encode() + b" " + SECRET.encode()), noise * 2 + SECRET.encode()):
        coded = coder(payload).decode()
        text = "key:\n" + "\n".join(indent + coded[i:i + width] for i in range(0, len(coded), width)) + "\n\nend"
        assert any(k == "assign" for k, _, _ in found(text))


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress])
def test_every_member_and_escaped_bytes_are_read(pack):
    first, second = pack(b"a plain sentence of words"), pack(SECRET.encode())
    for data in (first + second, first + b"\0\0-" + second):
        escaped = "".join(f"%{c:02x}" for c in data)
        for coded in (b64(data), escaped, urllib.parse.quote(data, safe=""), urllib.parse.quote_plus(data), repr(data)[2:-1],
                      escaped.replace("%", "\\x"), "".join(f"\\u{c:04x}" for c in data), "".join(f"&#{c};" for c in data)):
            text = f"see <{coded}> end"
            assert any(k == "assign" for k, _, _ in found(text)), coded
            assert all(4 < a < b <= 5 + len(coded) for _, a, b in found(text) if b - a > 10)
    assert S.scan_text(b64(pack(b"a b " * 2000) + pack(b"c d " * 2000)), limit=10_000)[1] == 1
    spans, unread = S.scan_text(b64(second + pack(b"c d " * 20_000)), limit=10_000)
    assert spans and unread == 1


def test_damaged_and_unprintable_layers_are_scanned():
    for data in (SECRET.encode() + b" \xff", b"\xff" + SECRET.encode(), b"\0" * 40 + SECRET.encode() + b"\1" * 9, gzip.compress(b"\xfe\0" + SECRET.encode())):
        assert any(k == "assign" for k, _, _ in found("x <" + b64(data) + "> y"))


def test_spans_map_through_escapes_character_by_character():
    text = "x %70assword%3Dhunter2 y"
    assert found(text) == [("assign", 2, text.index(" y"))]
    text = "see \\u0041KIA" + "Z" * 16 + " end"
    assert found(text) == [("access", 4, 4 + 6 + 3 + 16)]


def test_base_spans_stay_beside_longer_decoded_ones():
    assert found("token=abcdef%41%42") == [("assign", 0, 12), ("assign", 0, 18)]


def test_layers_are_named():
    spans, _ = S.scan_text("u " + urllib.parse.quote(b64(gzip.compress(SECRET.encode())), safe="") + "%20")
    assert any(s[3].endswith("base64>inflate") for s in spans)


def test_cycles_end_and_bombs_are_counted():
    text = b64("A" * 30)
    for _ in range(12):
        text = b64(text)
    assert found(text) == []
    spans, unread = S.scan_text("z " + b64(zlib.compress(b"a" * 100_000)), limit=10_000)
    assert spans == [] and unread == 1
    assert S.scan_text("z " + b64(zlib.compress(b"a" * 9_000)), limit=10_000)[1] == 0


def test_redaction_covers_overlaps():
    text = "a token=abcdef%41%42 b " + KEY + " c"
    assert S.redact(text, S.scan_text(text)[0]) == "a [SECRET] b [SECRET] c"


def test_operator_edges(spark):
    rows = [(1, None), (2, ""), (None, SECRET), (3, "x " + HEX + " " + b64(SECRET)), (3, "x " + HEX + " " + b64(SECRET)),
            (4, "word " * 50_000 + KEY)]
    df = spark.createDataFrame([(*r, "k", 7) for r in rows], "doc_id long, text string, kind string, spans int")
    got = {(r.doc_id, len(r.spans)): r for r in S.scan_secrets(df, redacted=True).collect()}
    assert {k: v.redacted for k, v in got.items() if k[0] in (1, 2, None)} == {(1, 0): "", (2, 0): "", (None, 1): "[SECRET]"}
    assert [(s.kind, s.start, s.end, s.layers) for s in got[(3, 2)].spans] == [
        ("hex", 2, 26, ""), ("assign", 27, 27 + len(b64(SECRET)), "base64")]
    assert [(s.start, s.end) for s in got[(4, 1)].spans] == [(250_000, 250_020)]
    assert S.scan_secrets(df.limit(0)).collect() == []
    masked = S.redact_secrets(df).orderBy("doc_id").collect()
    assert S.redact_secrets(df).columns == df.columns and masked[0].text == "[SECRET]" and masked[1].text is None


def test_query_digest(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op1_secret_scan(spark, SF_SMALL).collect():
        base = plain(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in S.KINDS)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
