"""Secret scans: base patterns over a text and over every layer that can be unwrapped from it.

A worklist starts with the text. Each layer is scanned, then unwrapped: percent escapes and Unicode escapes in
place, base64 runs, also those wrapped in lines and from each of four digits on, and compressed bytes wherever they
begin, also several streams in a row, into layers of their own, until no layer yields a new one; a layer
seen before is not taken again, so cycles end. What is decoded or inflated is scanned whatever bytes it holds
besides. Spans found in a layer are mapped to the code points of the
text that it came from: to the escapes, to the base64 digits, or to the whole compressed run. As all of a
stream's content maps to that run, each content is scanned once, for the kinds that it holds, whatever the number
of places it comes from; a content beyond `PIECE` bytes is scanned in overlapping pieces and never held whole.

A null text is an empty one, without spans. Repeated rows get one result each; an empty table gives an empty
result. Other columns pass through `redacted` and are not read by `scan`. `max_layer_bytes` guards against
decompression bombs only: streams of a document that would hold more together are counted in `layers_cut` and not
scanned.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote_to_bytes

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import add_columns, free_name

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones can be passed over
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: Bytes as quote, encodeURIComponent and escape write them: some as they are, the others as %XX.
QUOTED = re.compile(r"(?<![A-Za-z0-9_.~!*'()@/+-])[A-Za-z0-9_.~!*'()@/+-]*+(?:%[0-9A-Fa-f]{2}[A-Za-z0-9_.~!*'()@/+-]*+)++")
#: What else stands for a byte in the literals of programs.
LITERAL = re.compile(UNICODE.pattern + r"|\\([0-7]{1,3})|\\([abfnrtv\\'\"])")
NAMED = dict(zip("abfnrtv\\'\"", "\a\b\f\n\r\t\v\\'\""))
#: How streams begin that _opener knows.
MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Digits of the shortest text that has a span: 12 characters.
SHORTEST = 16
#: Base64 in lines, as in mail and key files.
WRAPPED = re.compile(r"(?:[A-Za-z0-9+/_-]{60,76}\r?\n)+[A-Za-z0-9+/_-]{1,76}={0,2}")
LINE_END = str.maketrans("", "", "\r\n=")
#: What every span, escape and base64 run has in it.
HINT = re.compile(rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}")
TEXT_CONTROLS = str.maketrans("", "", "\t\n\x0b\x0c\r")
MASK = "[secret]"
#: Longer contents are scanned in pieces, each with the end of the one before.
PIECE, OVERLAP = 1 << 24, 1 << 20
#: What the streams of a document may hold together.
MOST = 1 << 34


@dataclass
class Layer:
    """A text whose character i came from the code points starts[i] to ends[i] of the document."""

    text: str
    starts: np.ndarray | None = None  # None: the document itself
    ends: np.ndarray | None = None
    sure: bool = True  # no base64 read from a later digit, which is mostly noise

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if not self.starts.strides[0]:  # one place for all characters
            return int(self.starts[0]), int(self.ends[0])
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def origin(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the characters a[k] to b[k] (exclusive) of this layer came from."""
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])

    def mark(self) -> bytes:
        """The same for layers of the same text and places only."""
        text = hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest()
        if self.starts is None:
            return text
        if not self.starts.strides[0]:  # one place for all characters
            return text + f"{self.starts[0]} {self.ends[0]}".encode()
        return text + hashlib.sha256(self.starts.tobytes()).digest()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), leftmost and without overlaps within a kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _joined(spans) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def _readable(data: bytes) -> bool:
    """Whether the bytes are UTF-8 without control characters."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return bool(text) and text.translate(TEXT_CONTROLS).isprintable()


def _texts(data: bytes, plain: bool = True) -> list[tuple[str, bytes]]:
    """What the bytes say, and the bytes that say it: as UTF-8, and without NULs, as all patterns are ASCII and
    UTF-16 and UTF-32 write that with NULs. A byte that is no UTF-8 becomes one character. Bytes that are no plain
    text, or all if `plain` is false, are left out if they hold nothing that a span or a layer begins with."""
    found = [data] if HINT.search(data) or plain and _readable(data) else []
    if b"\0" in data and HINT.search(bare := data.replace(b"\0", b"")):
        found.append(bare)
    return [(x.decode("utf-8", "surrogateescape"), x) for x in found]


def _opener(data):
    """The decompressor for a stream, by its first bytes; None if it is none."""
    head = bytes(data[:6])
    if head[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] == 0x78 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if head == b"\xfd7zXZ\x00" else None


def _literal(m: re.Match) -> str:
    """The character of a match of LITERAL; a question mark where there is none."""
    kind, digits = m.lastindex, m[m.lastindex]
    if kind == 8:
        return NAMED[digits]
    code = int(digits, {6: 10, 7: 8}.get(kind, 16))
    return chr(code) if code < 0x110000 else "?"


def _stored(data: bytes, at: int) -> tuple[int, int]:
    """Where the stored blocks that a stream begins with have their first byte of content, and where the last of them
    ends, beyond the data if it is cut off. Their content is what stands there; (0, 0) if it begins otherwise."""
    if data[at] == 0x78 and at + 1 < len(data) and not data[at + 1] & 0x20 and (0x7800 + data[at + 1]) % 31 == 0:
        block = at + 2
    elif data[at:at + 4] == b"\x1f\x8b\x08\0":
        block = at + 10
    else:
        return 0, 0
    first = end = 0
    while block + 5 <= len(data) and not data[block] & 6:
        size = data[block + 1] | data[block + 2] << 8
        if size ^ (data[block + 3] | data[block + 4] << 8) != 0xFFFF:
            break
        first, end = first or block + 5, block + 5 + size
        if data[block] & 1:
            break
        block = end
    return first, end


def _fed(opener, data) -> Iterator[bytes]:
    """What a decompressor makes of some more bytes, piece by piece."""
    while True:
        out = opener.decompress(data, PIECE)
        if out:
            yield out
        data = getattr(opener, "unconsumed_tail", b"")
        # zlib may hold more where the piece is full; the others say whether they do.
        if opener.eof or getattr(opener, "needs_input", len(out) < PIECE and not data):
            return


@dataclass
class Content:
    """The content of the stream at `at` of another content; it is decompressed anew each time it is read."""

    source: "Content | bytes"
    at: int

    def chunks(self) -> Iterator[bytes]:
        skip, opener, rest = self.at, None, b""
        for part in [self.source] if isinstance(self.source, bytes) else self.source.chunks():
            part, skip = part[skip:], max(0, skip - len(part))
            rest = rest + part if rest else part
            while rest:
                if opener is None and (opener := _opener(rest)) is None:
                    if len(rest) < SHORTEST and not isinstance(self.source, bytes):
                        break  # how a stream begins is told by its first bytes
                    return
                try:
                    yield from _fed(opener, rest)
                except (zlib.error, OSError, lzma.LZMAError, EOFError):
                    return
                rest, opener = (opener.unused_data, None) if opener.eof else (b"", opener)

    def pieces(self) -> Iterator[tuple[int, bytes, bool]]:
        """(first byte, bytes, whether more follow); every piece begins with the end of the one before."""
        held, base = b"", 0
        for chunk in self.chunks():
            if len(held) >= PIECE:
                yield base, held, True
                base, held = base + len(held) - OVERLAP, held[-OVERLAP:]
            held += chunk
        yield base, held, False


@dataclass
class Scan:
    """The worklist over one document."""

    max_layer_bytes: int = MOST
    found: set = field(default_factory=set)
    known: dict = field(default_factory=dict)  # the kinds that a content holds, by its digest
    spent: list = field(default_factory=lambda: [0])  # bytes that came out of streams
    layers: int = 0
    cut: int = 0

    def run(self, text: str) -> "Scan":
        return self.worklist([Layer(text)])

    def worklist(self, layers: Iterable[Layer]) -> "Scan":
        seen: set[bytes] = set()
        for layer in layers:
            self._unwrap_all(layer, seen)
        return self

    def _unwrap_all(self, layer: Layer, seen: set[bytes]) -> None:
        work = [layer]
        while work:
            layer = work.pop()
            if (mark := layer.mark()) in seen:
                continue
            seen.add(mark)
            spans = base_spans(layer.text)
            self.layers += layer.sure or bool(spans)
            self.found.update((kind, *layer.span(a, b)) for kind, a, b in spans)
            work += self.unwrapped(layer)

    def unwrapped(self, layer: Layer) -> list[Layer]:
        text, out = layer.text, []
        if "%" in text:
            out += self.percent(layer)
        if "\\" in text or "&#" in text:
            out += self.unicode(layer)
        runs, lines = [], False
        for m in BASE64.finditer(text):
            runs.append(m)
            lines = lines or m.end() - m.start() >= 60 and text[m.end():m.end() + 1] in ("\r", "\n")
        if lines:
            runs += WRAPPED.finditer(text)
        for m in runs:
            out += self.base64(layer, m)
        return out

    def base64(self, layer: Layer, m: re.Match) -> list[Layer]:
        """A run may begin with characters that are none of it, so it is read from each of four digits on.

        What is read from a later digit counts as a layer only if it holds a span."""
        digits = m.group().translate(LINE_END).replace("-", "+").replace("_", "/")
        out, places = [], None
        for skip in range(4):
            n = len(digits) - skip
            n -= n % 4 == 1
            if n < SHORTEST:
                break
            data = base64.b64decode(digits[skip:skip + n] + "=" * (-n % 4))
            texts = _texts(data, skip == 0)
            if not texts and not MAGIC.search(data):
                continue
            if places is None:  # digit d stands at places[d]
                places = m.start() + np.flatnonzero([c not in "\r\n" for c in m.group()])

            def spot(a: int, b: int) -> tuple[int, int]:
                """Byte k lies in the digits 8k/6 to (8k+7)/6."""
                end = m.end() if b == len(data) else int(places[skip + (8 * b - 1) // 6]) + 1
                return layer.span(int(places[skip + 8 * a // 6]), end)

            self.streams(data, spot)
            for inner, used in texts:
                sizes = np.array([len(c.encode("utf-8", "surrogateescape")) for c in inner])
                last = np.cumsum(sizes)
                at = np.arange(len(data)) if used is data else np.flatnonzero(np.frombuffer(data, np.uint8))
                a, b = places[skip + 8 * at[last - sizes] // 6], places[skip + (8 * at[last - 1] + 7) // 6] + 1
                out.append(Layer(inner, *layer.origin(a, b), sure=skip == 0))
        return out

    def whole(self, layer: Layer, start: int, end: int, data: bytes) -> list[Layer]:
        """Layers all of whose characters came from one run."""
        return list(self._contents(data, layer.span(start, end)))

    def _contents(self, data: bytes, span: tuple[int, int] = (0, 0)) -> Iterator[Layer]:
        """Some bytes, and what the streams in them hold, and so on, as layers of one span."""
        work, opened = [iter([(data, False)])], set()
        while work:
            if (found := next(work[-1], None)) is None:
                work.pop()
                continue
            data, more = found
            if (mark := hashlib.sha256(data).digest()) in opened:
                continue
            opened.add(mark)
            for inner, _ in _texts(data):
                # Views of one number each: a large layer takes no more memory than its text.
                yield Layer(inner, *(np.broadcast_to(np.int64(place), len(inner)) for place in span))
            work.append(self._inside(data))

    def _inside(self, data: bytes) -> Iterator[tuple[bytes, bool]]:
        """What the streams in the bytes hold; long contents come in pieces. What stands in the bytes themselves, or
        at the end of a content that has come, is left out."""
        last = b""
        for at, _, inner, _, rest in self._opened(data):
            if inner is None:
                for _, piece, more in self._long(Content(data, at)):
                    yield piece, more
            elif rest is None and not last.endswith(inner):
                last = inner
                yield inner, False

    def _long(self, content: Content) -> Iterator[tuple[int, bytes, bool]]:
        """The pieces of a long content. A stream that a piece's end cuts, and that the next piece does not hold from
        its beginning, is read on from the content itself."""
        for base, piece, more in content.pieces():
            self.spent[0] += len(piece)
            if self.spent[0] > self.max_layer_bytes:
                self.cut += 1
                return
            yield base, piece, more
            for at, end, _, ended, rest in self._opened(piece) if more else ():
                if not ended and end == len(piece) and at < len(piece) - OVERLAP:
                    yield from self._long(Content(content, base + at))

    def _opened(self, data: bytes) -> Iterator[tuple[int, int, bytes | None, bool, int | None]]:
        """(start, end, content, whether it is whole, rest) of the compressed streams in the bytes.

        A content is empty if the bytes end before it begins. A long one is None. One that is the rest of the bytes is not opened: `rest` says where it begins. Streams
        within a whole one, or within blocks that one holds as they are, are found in its content."""
        at = 0
        while m := MAGIC.search(data, at):
            start, at = m.start(), m.start() + 1
            first, last = _stored(data, start)
            if last >= len(data) and last - first <= 0xFFFF:  # one block
                if first < len(data):
                    yield start, len(data), b"", False, first
                continue
            inner, end, ended = self.inflated(memoryview(data)[start:])
            if ended:
                at = start + end
            elif inner or inner is None:
                at = max(at, min(last, len(data)))
            if inner or end:
                yield start, start + end, inner, ended, None

    def streams(self, data: bytes, spot: Callable[[int, int], tuple[int, int]]) -> None:
        """Adds the kinds that the streams in the bytes hold; `spot` tells the span of the bytes from a to b.

        A content at the end of another one holds no more kinds than that, so of many such contents only those
        are scanned where a kind ends to be found."""
        ends: list[tuple[bytes, list[tuple[tuple[int, int], int]]]] = [(data, [])]
        last = b""
        for at, end, inner, _, rest in self._opened(data):
            span = spot(at, end)
            if rest is not None:
                ends[0][1].append((span, rest))
            elif inner is None:
                self._add(span, self._kinds(piece for _, piece, _ in self._long(Content(data, at))))
            elif not inner:
                continue
            elif last.endswith(inner):
                ends[-1][1].append((span, len(last) - len(inner)))
            else:
                last = inner
                ends.append((inner, [(span, 0)]))
        for content, tails in ends:
            self._add_tails(content, tails)

    def _add(self, span: tuple[int, int], kinds: Iterable[str]) -> None:
        self.found.update((kind, *span) for kind in kinds)

    def _add_tails(self, content: bytes, tails: list[tuple[tuple[int, int], int]]) -> None:
        """Adds the kinds that the content holds from each place on; the places ascend, the kinds get fewer."""
        tails = sorted(tails, key=lambda t: t[1])

        def add(low: int, high: int, least: frozenset) -> None:
            """`least`: what the last of the tails holds."""
            if low > high:
                return
            most = self.kinds(content[tails[low][1]:])
            if most == least:
                for span, _ in tails[low:high + 1]:
                    self._add(span, most)
                return
            self._add(tails[low][0], most)
            middle = (low + 1 + high) // 2
            if middle > low:
                inside = self.kinds(content[tails[middle][1]:])
                add(low + 1, middle - 1, inside)
                add(middle, high, least)

        if tails:
            add(0, len(tails) - 1, self.kinds(content[tails[-1][1]:]))

    def kinds(self, content: bytes) -> frozenset:
        """The kinds of spans in some bytes and in all that they hold; the same bytes are scanned once."""
        mark = hashlib.sha256(content).digest()
        if mark not in self.known:
            self.known[mark] = frozenset()  # what holds itself adds nothing
            self.known[mark] = self._kinds([content])
        return self.known[mark]

    def _kinds(self, contents: Iterable[bytes]) -> frozenset:
        inside = Scan(self.max_layer_bytes, known=self.known, spent=self.spent)
        for content in contents:
            inside.worklist(inside._contents(content))
        self.layers += inside.layers
        self.cut += inside.cut
        return frozenset(kind for kind, _, _ in inside.found)

    def inflated(self, data) -> tuple[bytes | None, int, bool]:
        """What gzip, zlib, bzip2 or xz streams, one behind the other, hold; empty if there is none, None if it is
        longer than a piece. Where they end, and whether the last of them is whole."""
        out, opener, end, whole, size, length = [], _opener(data), 0, False, len(data), 0
        while opener is not None:
            try:
                for more in _fed(opener, data):
                    length += len(more)
                    self.spent[0] += len(more)
                    if self.spent[0] > self.max_layer_bytes:
                        self.cut += 1
                        return b"", 0, False
                    if length <= PIECE:
                        out.append(more)
                    else:
                        out.clear()
            except (zlib.error, OSError, lzma.LZMAError, EOFError):
                break
            data, whole = opener.unused_data, opener.eof
            end = size - len(data)
            opener = _opener(data)
        return (b"".join(out) if length <= PIECE else None), end, whole

    def percent(self, layer: Layer) -> list[Layer]:
        """All runs of percent escapes decoded in place; compressed bytes among them are opened."""
        pieces = []
        for m in PERCENT.finditer(layer.text):
            at = m.start()
            for c in bytes.fromhex(m.group().replace("%", "")).decode("utf-8", "surrogateescape"):
                size = len(c.encode("utf-8", "surrogateescape"))
                if not 0xDC80 <= ord(c) < 0xDD00:  # a byte that is no UTF-8 stays escaped
                    pieces.append((at, at + 3 * size, c))
                at += 3 * size
        for m in QUOTED.finditer(layer.text) if pieces or PERCENT.search(layer.text) else ():
            run = m.group()
            for spelling in {run, run.replace("+", "%20")}:  # a plus is itself, or a blank
                data = unquote_to_bytes(spelling)
                if MAGIC.search(data):
                    places = [m.start() + x.start() for x in re.finditer("%..|.", run)] + [m.end()]
                    self.streams(data, lambda a, b, places=places: layer.span(places[a], places[b]))
        return self.replaced(layer, pieces)

    def unicode(self, layer: Layer) -> list[Layer]:
        """All Unicode escapes decoded in place; surrogate pairs make one character. Compressed bytes are opened."""
        pieces = []
        for m in UNICODE.finditer(layer.text):
            kind = m.lastindex
            code = int(m.group(kind), 10 if kind == 6 else 16)
            if 0xDC00 <= code < 0xE000 and pieces and pieces[-1][1] == m.start() and isinstance(pieces[-1][2], int):
                start, _, high = pieces.pop()
                pieces.append((start, m.end(), chr(0x10000 + ((high - 0xD800) << 10) + code - 0xDC00)))
            elif 0xD800 <= code < 0xDC00:
                pieces.append((m.start(), m.end(), code))  # a high half waits for the low one
            elif code < 0x110000 and not 0xD800 <= code < 0xE000:
                pieces.append((m.start(), m.end(), chr(code)))
        if pieces:
            own, = self.replaced(Layer(layer.text), [(x.start(), x.end(), _literal(x)) for x in LITERAL.finditer(layer.text)])
            self.streams(own.text.encode("latin-1", "replace"), lambda a, b: layer.span(int(own.starts[a]), int(own.ends[b - 1])))
        return self.replaced(layer, [p for p in pieces if isinstance(p[2], str)])

    def replaced(self, layer: Layer, pieces: list[tuple[int, int, str]]) -> list[Layer]:
        if not pieces:
            return []
        text, out, starts, ends, at = layer.text, [], [], [], 0
        for a, b, c in pieces:
            out += [text[at:a], c]
            starts += [np.arange(at, a), [a]]
            ends += [np.arange(at, a) + 1, [b]]
            at = b
        out.append(text[at:])
        starts.append(np.arange(at, len(text)))
        ends.append(np.arange(at, len(text)) + 1)
        places = (np.concatenate(x).astype(np.int64) for x in (starts, ends))
        return [Layer("".join(out), *layer.origin(*places), sure=layer.sure)]


RESULT = {
    "n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_sha256": T.StringType(),
    "spans": T.StringType(), "n_layers": T.LongType(), "layers_cut": T.LongType(),
}


def _row(text: str | None, max_layer_bytes: int = MOST) -> tuple:
    text = text or ""
    base = base_spans(text)
    scan = Scan(max_layer_bytes).run(text)
    counts = [sum(s[0] == kind for s in base) for kind in KINDS]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(scan.found), scan.layers, scan.cut)


def scan(docs: DataFrame, max_layer_bytes: int = MOST) -> DataFrame:
    """(doc_id, counts and digest of the base spans, all spans as kind:start:end, layers)."""

    def per_batch(texts: list) -> dict:
        return dict(zip(RESULT, map(list, zip(*[_row(t, max_layer_bytes) for t in texts]))))

    return add_columns(docs.select("doc_id", "text"), ["text"], per_batch, RESULT).drop("text")


def redact(text: str | None, mask: str = MASK, max_layer_bytes: int = MOST) -> str | None:
    """The text with a mask in place of every secret; secrets that overlap get one."""
    if not text:
        return text
    out, at, reach = [], 0, -1
    for a, b in sorted((s[1], s[2]) for s in Scan(max_layer_bytes).run(text).found):
        if a >= reach:
            out += [text[at:a] if at < a else "", mask]
        at = reach = max(reach, b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents with masked secrets, and n_chars, where there is one, as the text is now."""
    new = free_name(docs, "masked")
    out = add_columns(docs, ["text"], lambda texts: {new: [redact(t, mask) for t in texts]}, {new: T.StringType()})
    own = {"text": F.col(new).alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        # Untouched rows keep the number that they came with.
        own["n_chars"] = F.when(F.col(new) == F.col("text"), F.col("n_chars")).when(F.col(new).isNotNull(), F.length(new).cast(kind)).otherwise(F.col("n_chars")).alias("n_chars")
    return out.select(*[own.get(c, F.col(c)) for c in docs.columns])
