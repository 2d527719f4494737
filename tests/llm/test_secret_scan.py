import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import tracemalloc
import zlib
from urllib.parse import quote, quote_plus

import pytest

from backlog.llm import secret_scan as S

KEY = "password=hunter2xyz"


def brute_base(text):
    """The patterns as they are given, leftmost without overlap, failing matches dropped."""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


TEXTS = [
    "", "token=a token=abcdef", "secret:token:abcdef", "API_KEY = 'abc.def-9' apikey:\"zzzzzz", "Paſſword=abcdefgh toKen=abcdefgh",
    "AKIA" + "A" * 16 + " AKIA123 xAKIAAKIA" + "B2" * 10, "0" * 24 + "g" + "f" * 23 + " é " + "ab" * 13, "passwd\t=abcdefg passwd  :  abcdefg", "token==abcdef",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base(text):
    assert sorted(S.base_spans(text)) == sorted(brute_base(text))


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize("wrapped", [
    quote(KEY, safe=""), "".join(f"%{c:02x}" for c in KEY.encode()), "".join(f"\\u{ord(c):04x}" for c in KEY), "".join(f"\\x{ord(c):02x}" for c in KEY),
    "".join(f"&#{ord(c)};" for c in KEY), "".join(f"&#x{ord(c):x};" for c in KEY), "".join(f"\\u{{{ord(c):x}}}" for c in KEY),
    b64(gzip.compress(KEY.encode())), b64(zlib.compress(KEY.encode())), b64(bz2.compress(KEY.encode())), b64(lzma.compress(KEY.encode())),
    b64(gzip.compress(gzip.compress(KEY.encode()))), quote(b64(gzip.compress(KEY.encode())), safe=""),
    quote("".join(f"\\u{ord(c):04x}" for c in KEY), safe=""), "".join(f"%{c:02x}" for c in gzip.compress(KEY.encode())),
])
def test_layers_map_to_the_whole_wrapping(wrapped):
    found = S.Scan().run(f"é {wrapped} z").found
    assert any(kind == "assign" and a == 2 and b >= 2 + len(wrapped.rstrip("=").replace("%3D", "")) for kind, a, b in found)


def test_base64_maps_to_its_digits():
    inner = f"padding {KEY} more"
    text = f"x {b64(inner.encode())} y"
    (kind, a, b), = S.Scan().run(text).found
    assert kind == "assign" and (a, b) == (2 + 8 * 8 // 6, 2 + (8 * 27 - 1) // 6 + 1)


def test_base64_in_lines_maps_to_its_digits():
    """The secret crosses a line end, so no line alone holds it."""
    inner = "p" * 40 + f" {KEY} " + "q" * 200
    for end in ("\n", "\r\n"):
        digits = b64(inner.encode())
        text = "x " + end.join(digits[k:k + 64] for k in range(0, len(digits), 64)) + " y"
        found = S.Scan().run(text).found
        (kind, a, b), = [f for f in found if f[2] - f[1] < len(digits)]
        at = lambda d: 2 + d + len(end) * (d // 64)
        assert (kind, a, b) == ("assign", at(8 * 41 // 6), at((8 * 60 - 1) // 6) + 1)


def test_compressed_base64_in_lines_and_streams_in_a_row():
    data = gzip.compress(bytes(range(97, 123)) * 4) + gzip.compress(KEY.encode()) + bz2.compress(b"token=zyxwvuts")
    wrapped = base64.encodebytes(data + zlib.compress(b" secret: abcdefgh")).decode().strip()
    assert len(wrapped.split("\n")) > 1
    assert ("assign", 2, 2 + len(wrapped)) in S.Scan().run(f"x {wrapped} y").found
    one, other = gzip.compress(b"nothing here "), gzip.compress(KEY.encode())
    assert S.Scan().run(b64(one + other)).found and not S.Scan().run(b64(one)).found
    assert not S.Scan().run(b64(one + other[:12] + b"broken")).found


def test_nested_base64_ten_deep_and_fixpoint():
    data = KEY.encode()
    for _ in range(10):
        data = base64.b64encode(data)
    scan = S.Scan().run(data.decode())
    assert scan.found and scan.layers == 11
    assert S.Scan().run("%2525252525" * 3).layers <= 7  # ends though escapes make new escapes


def test_bomb_is_counted_not_scanned():
    scan = S.Scan(max_layer_bytes=1000).run(b64(gzip.compress(b"a" * 5000)))
    assert scan.cut and not scan.found


def test_a_large_layer_takes_little_more_than_its_text():
    inner = b"word " * 2_000_000 + KEY.encode() + b" \\u0041"
    tracemalloc.start()
    scan = S.Scan()
    layer, = scan.whole(S.Layer("x" * 100), 10, 90, gzip.compress(inner))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * len(inner) and layer.span(3, 9) == (10, 90) and layer.text.endswith("u0041")
    assert S.Scan().run(f"x {b64(gzip.compress(inner))} y").found


def test_scan_and_redact(docs_of, with_clashes):
    rows = [(k, t) for k, t in enumerate([*TEXTS, None, f"a {b64(KEY.encode() + b' and so on')} b", f"{KEY} {'ab' * 20}"])] + [(0, "")]
    docs = with_clashes(docs_of(*rows))
    out = S.scan(docs).collect()
    assert len(out) == len(rows)
    for r, (_, text) in zip(sorted(out, key=lambda r: r.doc_id), sorted(rows, key=lambda r: r[0])):
        base = brute_base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (s[1], S.KINDS.index(s[0]))))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in base) for k in S.KINDS)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    clean = S.redacted(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r.text is None or (not S.Scan().run(r.text).found and r.n_chars == len(r.text))
    assert S.scan(docs_of()).count() == 0 and S.redacted(docs_of()).count() == 0


def test_overlapping_secrets_get_one_mask():
    assert S.redact("x token=" + "ab" * 15 + " y") == "x [secret] y"
    assert S.redact("plain text") == "plain text" and S.redact(None) is None


@pytest.mark.parametrize("inner", [
    *[f"voilà {c} {KEY} fin".encode() for c in ("\u00a0", "\u00ad", "\ufeff", "👩\u200d💻", "\u3000", "\u2028", "\ue000", "\x1b[31m", "\x00")],
    f"voilà {KEY}".encode("latin-1"), *[f"voilà 漢 {KEY} fin".encode(c) for c in ("utf-16", "utf-16-le", "utf-16-be", "utf-32")],
    f"\u00a0{b64(KEY.encode())} ".encode(),
])
def test_layers_with_odd_characters_are_scanned(inner):
    for data in (inner, gzip.compress(inner)):
        text = f"é {b64(data)} z"
        spans = S.Scan().run(text).found
        assert {"assign"} == {kind for kind, *_ in spans} and all(2 <= a < b <= len(text) - 2 for _, a, b in spans)
        assert not S.Scan().run(S.redact(text)).found


def test_odd_characters_map_to_their_digits():
    for before in (b"\xff\x00 caf\xe9 ", "\u00a0é ".encode()):
        (kind, a, b), = {f for f in S.Scan().run(f"x {b64(before + KEY.encode() + b' more')} y").found}
        n = len(before)
        assert kind == "assign" and (a, b) == (2 + 8 * n // 6, 2 + (8 * (n + len(KEY)) - 1) // 6 + 1)


@pytest.mark.parametrize("before", ["https://x.org/cb/", "id_", "data-", "a", "ab", "abc", "abcd", "/", "x/y_z-"])
@pytest.mark.parametrize("after", ["", "/", "-x", "_yz", "/abc/def"])
def test_base64_behind_other_characters(before, after):
    for pad in range(3):
        for data in (KEY.encode() + b" " * pad, zlib.compress(KEY.encode() + b" " * pad), gzip.compress(KEY.encode())):
            digits = b64(data).rstrip("=") + after
            text = f"é {before}{digits} z"
            spans = S.Scan().run(text).found
            assert any(kind == "assign" and 2 <= a <= b <= len(text) - 2 for kind, a, b in spans)
            assert not S.Scan().run(S.redact(text)).found


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("write", [
    quote, quote_plus, lambda x: "name=" + quote(x, safe=""), lambda x: "path/" + quote(x), repr, lambda x: repr(x)[2:-1],
    lambda x: "".join(f"\\x{c:02x}" for c in x), lambda x: "".join(f"\\u{c:04x}" for c in x), lambda x: "".join(f"&#{c};" for c in x),
    lambda x: "".join(f"&#x{c:x};" for c in x),
])
def test_compressed_bytes_under_escapes(pack, write):
    for n in range(4):
        text = f"漢 {write(pack(f'{n * 7} {KEY} {n}'.encode()))} z"
        spans = S.Scan().run(text).found
        assert any(kind == "assign" and 2 <= a < b <= len(text) - 2 for kind, a, b in spans)
        assert not S.Scan().run(S.redact(text)).found


def test_valid_characters_around_an_invalid_sequence():
    """The decoder takes the first bytes of a broken character together."""
    text = "%70assword%3Dhunter%32xyz%E2%82%20%F0%9F%92%3D"
    (kind, a, b), = S.Scan().run(text).found
    assert kind == "assign" and (a, b) == (0, text.index("%E2"))
    text = "%E2%82%70%61%73%73%77%6F%72%64%3D%68%75%6E%74%65%72%32"
    assert S.Scan().run(text).found == {("assign", 6, len(text))}


def test_streams_that_hold_themselves_end():
    scan = S.Scan()
    assert len(scan.whole(S.Layer("x" * 10), 0, 10, b"x\x9c" * 1000 + b"token=abcdefg")) == 1


def headers_in_a_row(n: int, rest: bytes = b"") -> str:
    """Base64 of zlib headers and stored blocks, each of which holds all that follows."""
    return base64.b64encode(b"x\x01\x00\xff\xff\x00\x00" * n + rest).decode()


def test_headers_in_a_row_take_little_time():
    """Each stream holds the next one, and each content is another; 100 KB of them, with a secret behind and without."""
    for rest in (b"", b" password=hunter2222 "):
        text = headers_in_a_row(10_700, rest)
        began = time.perf_counter()
        found = S.Scan().run(text).found
        assert time.perf_counter() - began < 5 and bool(found) == bool(rest)
        assert not rest or not S.Scan().run(S.redact(text)).found


def test_streams_at_the_end_of_another_each_have_their_span():
    """The rest of the digits from each header on holds the secret, until its name is cut."""
    found = S.Scan().run(headers_in_a_row(30, b" password=hunter2222 ")).found
    ends = {b for _, a, b in found}
    starts = sorted(a for _, a, b in found if b == max(ends))
    assert starts == [8 * 7 * k // 6 for k in range(30)]


def test_one_content_in_many_places_is_scanned_once(monkeypatch):
    blob = base64.b64encode(gzip.compress(KEY.encode() + b" x" * 5000)).decode()
    texts = []
    scanned = S.base_spans
    monkeypatch.setattr(S, "base_spans", lambda text: texts.append(len(text)) or scanned(text))
    found = S.Scan().run(" ; ".join([blob] * 50)).found
    assert len(found) == 50 and sum(n > 5000 for n in texts) <= 2


@pytest.fixture(scope="module")
def seventy_megabytes():
    words = " ".join(random.Random(3).choices("some words that hold nothing at all".split(), k=2_000)) + " "
    return words.encode() * (70_000_000 // len(words) + 1) + KEY.encode() + b" end"


def test_a_secret_at_70_mb_of_a_layer(seventy_megabytes):
    """Longer than a piece: found, masked, and never held whole."""
    text = f"x {base64.b64encode(gzip.compress(seventy_megabytes)).decode()} y"
    scan = S.Scan().run(text)
    assert ("assign", 2, len(text) - 2) in scan.found and not scan.cut
    assert S.redact(text) == "x [secret] y"
    small = S.Scan(max_layer_bytes=1 << 20).run(text)
    assert small.cut and not small.found


def test_pieces_of_a_long_layer(monkeypatch):
    """Secrets at every place of a layer, also where a piece ends; a stream within that a piece's end cuts."""
    monkeypatch.setattr(S, "PIECE", 4000)
    monkeypatch.setattr(S, "OVERLAP", 500)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        for at in range(3300, 4700, 290):
            inner = b"- " * (at // 2) + KEY.encode() + b" -" * 4000
            assert S.Scan().run(base64.b64encode(pack(inner)).decode()).found
        deep = random.Random(1).randbytes(7000) + b" " + KEY.encode() + b" " + random.Random(2).randbytes(3000)
        for at in (0, 3990, 9000):
            outer = b"- " * (at // 2) + pack(deep) + b" -" * 300
            assert S.Scan().run(base64.b64encode(gzip.compress(outer)).decode()).found


def test_chunks_of_a_content():
    data = random.Random(4).randbytes(50_000)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        twice = pack(data[:20_000]) + pack(data[20_000:])
        assert b"".join(S.Content(b"abc" + twice, 3).chunks()) == data
        packed = gzip.compress(b"abc" + twice)
        assert b"".join(S.Content(S.Content(packed, 0), 3).chunks()) == data
        assert data.startswith(b"".join(S.Content(twice[:30_000], 0).chunks()))
