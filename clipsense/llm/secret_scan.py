"""Secret scan with a worklist of decoded layers.

The text itself is the first layer. Each layer is scanned for secrets and for
encoded stretches: URL escapes, Unicode escapes, base64 and, below base64,
gzip or zlib data. What decodes becomes a new layer on the worklist, unless the
text has had the same layer from the same stretch before, so the work ends when
nothing new unfolds. Every layer keeps, for each of its characters, where that
stretch lies in the original text; a secret found below is reported as the
stretch it came from. Every decoded layer is scanned and unwrapped further,
readable or not. Base64 on following lines is decoded as one stretch, and every
stretch from each of its first four characters, so that it may follow others of
its alphabet (a path, an underscore); gzip and zlib data may lie anywhere in it,
in several members. A secret below it is reported as the lines that hold it.

URL and Unicode escapes of a layer are undone each alone and both at once. All
three layers are scanned and searched for base64; escapes are undone further
only in the last, so that escapes nested n deep give 3 n layers in whatever order
they are mixed. An escaped escape sign (``%2525``, ``&#38;#38;``, ``\\x5cx5c``) goes in
one step, however often it is escaped. ``MOST_ROUNDS`` such steps below each other
are done one by one; after that, all that are left are undone at once, from left
to right, and the outcome is the next layer.

Kinds: ``assign``, ``access`` and ``hex`` in the text itself; below it the
codecs in the order of unwrapping and the kind, such as ``base64>url>assign``.
Unpacked data beyond ``PIECE`` bytes are scanned in pieces that overlap by
``OVERLAP``, which a secret must fit in to be found whole wherever it lies; one
piece is in memory at a time for each layer it lies below. What unpacks to more than ``MOST_BYTES``
in one text, all layers together, is reported as kind ``oversized``.

Defined cases: a null text counts as empty and has no secrets; repeated rows
get equal results; rows with a null id stay; any further columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.llm.texts import per_row, with_value

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

UNICODE_ONCE = r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{2,7});|&#[xX]([0-9A-Fa-f]{2,6});"
#: An escaped escape sign, however often, before what it escapes; else one escape.
UNICODE = re.compile(r"\\(?:u005[cC]|x5[cC])+(?=[ux])|&(?:#38;|#[xX]26;)+(?=#)|" + UNICODE_ONCE)
URL = re.compile(r"%(?:25)+(?=[0-9A-Fa-f]{2})|(?:%[0-9A-Fa-f]{2})+")
EITHER = re.compile(f"{UNICODE.pattern}|(?:{URL.pattern})")
UNICODE_AT_END = re.compile(f"(?:{UNICODE_ONCE})$")
URL_AT_END = re.compile(r"%[0-9A-Fa-f]{2}$")
HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: Runs on following lines are one stretch; a single run is looked at from 16 characters on, as is what is joined.
BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+|[A-Za-z0-9+/_-]++(?=[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]))"
    r"(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+(?:(?:[ \t]*+\r?\n[ \t]*+)?=){0,2}"
)
LEAST_CODE = 16
#: Heads of gzip and zlib data; zlib with a preset dictionary cannot be unpacked.
HEAD = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Bytes unpacked at once.
CHUNK = 65_536
UNPACKED = 1_048_576
#: Unpacked data are scanned in pieces of so many bytes, which overlap.
PIECE = 64_000_000
OVERLAP = 1_000_000
#: Bytes that one text may unpack to, so that data that unpack without end do not hold a task.
MOST_BYTES = 4_000_000_000
#: Steps of escapes that are undone one by one.
MOST_ROUNDS = 64

Found = tuple[int, int, str]


def find(text: str) -> list[Found]:
    """start, end and kind of the secrets that stand in the text as it is, in order."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS) or "K" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _mark(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Layer:
    """A decoded text and where its pieces stand in the layer it came from."""

    def __init__(self, text: str, codecs: str, parent: Layer | None, pieces: list[tuple[int, int, int, bool]], escapes: int | None = 0):
        self.text, self.codecs, self.parent = text, codecs, parent
        #: Start here, start and end in the parent, and whether the piece was taken over as it is.
        self.pieces = pieces
        self.starts = [piece[0] for piece in pieces]
        #: Steps of escapes undone on the way here; none if no further are to be undone.
        self.escapes = escapes

    def place(self, start: int, end: int) -> tuple[int, int]:
        """The stretch of the original text that a stretch of this layer came from."""
        layer = self
        while layer.parent is not None:
            at, first, _, same = layer.pieces[bisect_right(layer.starts, start) - 1]
            up_start = first + start - at if same else first
            at, first, last, same = layer.pieces[bisect_right(layer.starts, end - 1) - 1]
            start, end, layer = up_start, first + end - at if same else last, layer.parent
        return start, end

    def mark(self) -> bytes:
        """Equal for equal texts from the same stretch whose escapes are to be undone alike."""
        origin = self.place(0, len(self.text)) if self.text else (0, 0)
        return _mark(f"{origin} {self.escapes is None} {self.text}".encode("utf-8", "surrogatepass"))

    def repeats(self, text: str) -> bool:
        """Whether this layer or one above it is the text."""
        layer: Layer | None = self
        while layer is not None and layer.text != text:
            layer = layer.parent
        return layer is not None


def _url(run: re.Match) -> str:
    if "%" not in run[0][1:] and len(run[0]) > 3:
        return "%"
    return binascii.unhexlify(run[0].replace("%", "")).decode("utf-8", "replace")


def _unicode(escape: re.Match) -> str:
    code = escape[3] or escape[1] or escape[2] or escape[4]
    if not code:
        return escape[0][0]
    number = int(code) if escape[3] else int(code, 16)
    return chr(number) if number < 0xD800 or 0xDFFF < number <= 0x10FFFF else escape[0]


def _either(escape: re.Match) -> str:
    return _url(escape) if escape[0].startswith("%") else _unicode(escape)


def _replaced(layer: Layer, pattern: re.Pattern, decode, codec: str, escapes: int | None) -> Layer | None:
    """The whole layer with each match decoded in place."""
    parts: list[str] = []
    pieces: list[tuple[int, int, int, bool]] = []
    length = at = 0
    for m in pattern.finditer(layer.text):
        for text, start, end, same in ((layer.text[at:m.start()], at, m.start(), True), (decode(m), *m.span(), False)):
            if text:
                parts.append(text)
                pieces.append((length, start, end, same))
                length += len(text)
        at = m.end()
    if not at:
        return None
    if at < len(layer.text):
        parts.append(layer.text[at:])
        pieces.append((length, at, len(layer.text), True))
    return Layer("".join(parts), f"{layer.codecs}{codec}>", layer, pieces, escapes) if parts else None


def _all_undone(layer: Layer) -> Layer:
    """The layer with all its escapes undone, also those that come about by that: what an escape gives
    is put behind what has been read, and the end is looked at again."""
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    for at, sign in enumerate(layer.text):
        out.append(sign)
        spans.append((at, at + 1))
        while out[-1] == ";" or out[-1] in HEX_DIGITS:
            end = "".join(out[-10:])
            m = URL_AT_END.search(end) or UNICODE_AT_END.search(end)
            if m is None:
                break
            decoded = chr(int(m[0][1:], 16)) if m[0][0] == "%" else _unicode(m)
            if decoded == m[0]:
                break
            span = spans[-len(m[0])][0], spans[-1][1]
            del out[-len(m[0]) :], spans[-len(m[0]) :]
            out.append(decoded)
            spans.append(span)
    pieces = [(k, *span, False) for k, span in enumerate(spans)]
    return Layer("".join(out), f"{layer.codecs}escapes>", layer, pieces, None)


def _escape_layers(layer: Layer) -> Iterator[Layer]:
    """What the layer is without its escapes: URL and Unicode escapes each alone, and both."""
    text, steps = layer.text, layer.escapes
    url, unicode = "%" in text, "\\" in text or "&#" in text
    if steps is None or not (url or unicode):
        return
    if steps >= MOST_ROUNDS:
        yield _all_undone(layer)
        return
    if url and unicode:
        found = [
            _replaced(layer, URL, _url, "url", None), _replaced(layer, UNICODE, _unicode, "unicode", None),
            _replaced(layer, EITHER, _either, "url+unicode", steps + 1),
        ]
        if found[0] is None or found[1] is None:  # one kind alone
            found = [_replaced(layer, URL, _url, "url", steps + 1), _replaced(layer, UNICODE, _unicode, "unicode", steps + 1)]
    else:
        found = [_replaced(layer, URL, _url, "url", steps + 1) if url else _replaced(layer, UNICODE, _unicode, "unicode", steps + 1)]
    yield from (x for x in found if x is not None)


def _decoded(code: str, skip: int) -> bytes:
    """What base64 gives from a place on; a last character that no byte is complete with is left out."""
    size = len(code) - skip
    size -= size % 4 == 1
    return base64.b64decode(code[skip : skip + size] + "=" * (-size % 4))


class Budget:
    """Bytes that may still be unpacked."""

    def __init__(self, left: int):
        self.left = left


def _member(data: bytes, at: int, bits: int, budget: Budget) -> Iterator[bytes | tuple[int, bool]]:
    """What one gzip or zlib member holds, or what can be read of it, bit by bit; last, where it ends, and whether it is complete."""
    stream = zlib.decompressobj(bits)
    while at < len(data) and not stream.eof and budget.left > 0:
        piece = data[at : at + CHUNK]
        before = stream.copy()
        try:
            out = stream.decompress(piece, UNPACKED)
        except zlib.error:
            out = bytearray()
            for i in range(len(piece)):
                try:
                    out += before.decompress(piece[i : i + 1])
                except zlib.error:
                    at += i
                    break
            yield bytes(out)
            yield at, False
            return
        budget.left -= len(out)
        yield out
        at += len(piece) - len(stream.unused_data) - len(stream.unconsumed_tail)
    yield at, stream.eof


def _unpacked(data: bytes, budget: Budget) -> Iterator[tuple[str, bytes | None, int, int]]:
    """Codec, content and place of all gzip and zlib data within data, members that follow each other as one.

    Content comes in overlapping pieces, nothing for what is beyond the budget.
    The end of a piece that is not the last is that of its data as far as read.
    """
    at = 0
    while head := HEAD.search(data, at):
        codec, bits = ("gzip", 31) if data[head.start()] == 0x1F else ("zlib", 15)
        start, held, size, more = head.start(), bytearray(), 0, True
        first = start
        while more:
            end, whole = start, False
            for out in _member(data, start, bits, budget):
                if isinstance(out, tuple):
                    end, whole = out
                    continue
                held += out
                size += len(out)
                if len(held) >= PIECE:
                    yield codec, bytes(held), first, len(data)
                    del held[:-OVERLAP]
            at = max(at, end if whole else start + 1)
            # gzip files may be padded with zeros.
            following = HEAD.match(data, _after_zeros(data, end)) if whole else None
            more = following is not None and (codec == "gzip") == (following[0][0] == 0x1F)
            start = following.start() if more else start
        if size:
            yield codec, bytes(held), first, end
        if budget.left <= 0:
            yield codec, None, first, end
            return


def _after_zeros(data: bytes, at: int) -> int:
    while at < len(data) and not data[at]:
        at += 1
    return at


def _bytes_layers(data: bytes, budget: Budget) -> Iterator[tuple[str, str | None, int, int]]:
    """Decoded data as texts, a character for each byte, with the codecs passed and the place in the data.

    No text where the budget is spent. A piece is done with all that unpacks from it before the next.
    """
    seen = {_mark(data)}
    # All patterns are ASCII, so that other characters may stay in bytes, valid or not.
    yield "", data.decode("latin-1"), 0, len(data)
    work = [("", 0, len(data), _unpacked(data, budget))]
    while work:
        passed, first, last, inner = work[-1]
        found = next(inner, None)
        if found is None:
            work.pop()
            continue
        codec, content, start, end = found
        place = (first, last) if passed else (start, end)
        if content is None:
            yield f"{passed}>{codec}", None, *place
        elif (mark := _mark(content)) not in seen:
            seen.add(mark)
            yield f"{passed}>{codec}", content.decode("latin-1"), *place
            work.append((f"{passed}>{codec}", *place, _unpacked(content, budget)))


class Lines:
    """The lines of a base64 stretch, and where their characters are in what is joined."""

    def __init__(self, text: str, first: int, last: int):
        self.spans = [m.span() for m in RUN.finditer(text, first, last)]
        self.code = "".join(text[start:end] for start, end in self.spans).replace("-", "+").replace("_", "/")
        self.spans[-1] = (self.spans[-1][0], last)
        self.starts = [0, *accumulate(end - start for start, end in self.spans[:-1])]

    def place(self, skip: int, first: int, last: int) -> tuple[int, int]:
        """The lines that hold the given bytes, of those decoded from a place on."""
        return self.spans[self._line(skip + first * 8 // 6)][0], self.spans[self._line(skip + (last * 8 - 1) // 6)][1]

    def pieces(self, skip: int, size: int) -> list[tuple[int, int, int, bool]]:
        """The pieces of a layer of all bytes decoded from a place on: those of one line, or across a break."""
        cuts = {0, size}
        for start in self.starts[1:]:
            cuts |= {max(0, (start - skip) * 6 // 8), max(0, -((skip - start) * 6 // 8))}
        at = sorted(cut for cut in cuts if cut <= size)
        return [(a, *self.place(skip, a, b), False) for a, b in pairwise(at)]

    def _line(self, at: int) -> int:
        return bisect_right(self.starts, at) - 1


def unfold(layer: Layer, budget: Budget) -> Iterator[Layer | Found]:
    """What unfolds from a layer, one by one, and the stretches that unpack to too much."""
    yield from _escape_layers(layer)
    for m in BASE64.finditer(layer.text):
        lines = Lines(layer.text, *m.span())
        if len(lines.code) < LEAST_CODE:
            continue
        # What stands before the code, up to a sign that base64 has too, or on a line before, shifts it by up to three.
        for skip in range(4):
            data = _decoded(lines.code, skip)
            for passed, inner, first, last in _bytes_layers(data, budget):
                codecs = f"{layer.codecs}base64{passed}>"
                if inner is None:
                    yield *layer.place(*lines.place(skip, first, last)), f"{codecs}oversized"
                elif passed:
                    yield Layer(inner, codecs, layer, [(0, *lines.place(skip, first, last), False)])
                elif data:
                    yield Layer(inner, codecs, layer, lines.pieces(skip, len(data)))


def below(layer: Layer) -> tuple[list[Layer], list[Found]]:
    """All that unfolds from a layer, and the stretches that unpack to too much."""
    found = list(unfold(layer, Budget(MOST_BYTES)))
    return [x for x in found if isinstance(x, Layer) and not layer.repeats(x.text)], [x for x in found if isinstance(x, tuple)]


def scan(text: str) -> tuple[list[Found], list[Found]]:
    """Secrets of the text as it is, and those below its encodings, by place."""
    base = find(text)
    known = set(base)
    added: list[Found] = []
    root, budget = Layer(text, "", None, []), Budget(MOST_BYTES)
    seen: set[bytes] = set()
    work = [unfold(root, budget)]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if isinstance(layer, tuple):
            added.append(layer)
            continue
        mark = layer.mark()
        if mark in seen or layer.text == text:
            continue
        seen.add(mark)
        for start, end, kind in find(layer.text):
            place = layer.place(start, end)
            if (*place, kind) not in known:
                known.add((*place, kind))
                added.append((*place, f"{layer.codecs}{kind}"))
        work.append(unfold(layer, budget))
    return base, sorted(added, key=lambda x: (x[0], x[2], x[1]))


def join(spans: list[Found]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every stretch of a secret, plain or encoded, replaced by a mark."""
    base, added = scan(text)
    parts, at = [], 0
    for start, end, _ in sorted([*base, *added]):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _row(doc_id: int | None, text: str | None) -> tuple:
    base, added = scan(text or "")
    kinds = [kind for _, _, kind in base]
    every = sorted([*base, *added], key=lambda x: (x[0], KINDS.index(x[2]) if x[2] in KINDS else len(KINDS), x[2], x[1]))
    return (
        doc_id, *(kinds.count(kind) for kind in KINDS), hashlib.sha256(join(base).encode()).hexdigest(), join(every), len(added),
    )


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Counts, digest and spans of the secrets of every document."""
    return per_row(
        documents, ["doc_id", "text"], lambda: _row,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_added bigint",
    )


def redact_secrets(documents: DataFrame) -> DataFrame:
    """The documents, with all columns, with a mark in place of every secret."""
    rows = documents.select(F.struct(*[c for c in documents.columns if c != "text"]).alias("rest"), "text")
    clean = with_value(rows, ["text"], lambda: lambda text: None if text is None else redact(text), "clean", "string")
    return clean.select(*[F.col("clean").alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in documents.columns])
