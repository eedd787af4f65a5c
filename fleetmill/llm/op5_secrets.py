r"""Secret scans with a recursive decoding worklist.

Three base kinds are scanned in every whole text: ``assign`` (a secret's name, a sign and a value
of 8 or more characters), ``access`` (a cloud key id of 16 or more) and ``hex`` (a run of 32 or
more digits). Then a worklist unwraps what the text holds in other forms: percent-encoding,
Unicode and hexadecimal escapes and character references, base64, and compressed (zlib, gzip) or
base64 data inside base64, nested as deep as it goes. Each decoded layer is scanned like a text and
searched for further layers until none is new: layers are remembered by their content, so a layer
that decodes to an earlier one ends there. Base64 is read in single runs and, as it is often
wrapped, in runs joined across single line breaks; a run that is no text as a whole (it stands
beside a path, a prefix or other characters of its alphabet) is read at all four alignments for the
readable or compressed stretches in it. Every hit in a layer is mapped back through the layers to
the span of the original characters that it was decoded from.

A hit in a decoded layer has the kind ``layer/kind`` (such as ``base64/assign``, the outermost
layer's name). Escapes rewrite a text in place, so a hit that stands there undecoded is not
reported again.

One layer is worked on at a time, each level holding one child. Compressed data, to their end and
all members of them, are inflated in a stream and scanned in windows cut where no hit or run can
stand across (in a longer run, with an overlap), so memory does not grow with what they unpack to.
Deflate unpacks to at most 1,032 times its size, and so much is always read; only bombs nested in
bombs go beyond. They can't be read to an end (some have none), so a run that unpacks to over EXPAND
times its size, all levels together, is reported itself as ``compressed/unread`` beside what was
found in it, and is redacted as a secret is: nothing unread passes as clean.

Null texts are empty ones: no spans, the hash of an empty string. Very long texts are read whole.
Spans that tie (the same place) are ordered by kind. Repeated rows are scanned each, an empty table
gives no rows, and columns other than doc_id and text are not read (``redact_secrets`` keeps them).
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain
from urllib.parse import unquote_to_bytes

from pyspark.sql import DataFrame, SparkSession

from fleetmill.llm.common import map_texts, read

KINDS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{32,}"),
}
ORDER = {k: i for i, k in enumerate((*KINDS, "unread"))}
#: Bytes that a byte of base64 may unpack to, over all levels of compression, and those granted to any.
EXPAND, GRANTED = 1100, 64 << 20
#: Bytes inflated at a time; characters of a window, and the overlap where it has to be cut in a run.
CHUNK, WINDOW, OVERLAP = 256 << 10, 1 << 20, 64 << 10
#: One escape, or several that only together make a character.
ESCAPE = {
    "url": re.compile(r"%[0-7][0-9A-Fa-f]|(?:%[89A-Fa-f][0-9A-Fa-f])+"),
    "unicode": re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:amp|lt|gt|quot|apos);"),
}
ONE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|(&[^;]*;)")
#: A run that could be base64. The shortest secret has 14 bytes, so 19 characters; shorter ones matter
#: only where they can be the start of zlib data, which is at least 7 bytes long.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{10,}={0,2}")
LEAST = 19
#: What the first two bytes of zlib data look like in base64, at its three places.
ZLIB_HINT = re.compile(r"e[AFJN]|[HXn3](?:g[A-P]|h[e]|ic|ja)|[BFJNRVZdhlptx159]4[AXn2]")
#: Characters that hits, escapes and runs consist of: a window is not cut beside one.
SPANNING = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-\"':% \t\r\n\\&#;{}"
#: Runs joined across single line breaks, and one line of them.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_=-]+")
#: Readable stretches that could hold a secret, and what compressed data begin with.
STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){10,}")
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
NAMES = ("password", "passwd", "secret", "token", "api")

Span = tuple[int, int, str]


def base_spans(text: str) -> Iterator[Span]:
    low = text.lower()
    if any(name in low for name in NAMES):
        for m in KINDS["assign"].finditer(text):
            if m.end(2) - m.start(2) >= 8:
                yield m.start(), m.end(), "assign"
    if "AKIA" in text:
        for m in KINDS["access"].finditer(text):
            if m.end() - m.start() >= 16:
                yield m.start(), m.end(), "access"
    for m in KINDS["hex"].finditer(text):
        yield m.start(), m.end(), "hex"


class Layer:
    """A decoded text as consecutive stretches: where each begins in it, the span of the original
    text that it comes from, and whether it was copied character by character or decoded."""

    __slots__ = ("text", "name", "at", "spans")

    def __init__(self, name: str, parts: list[tuple[str, int, int, bool]]):
        self.text, self.name, self.at, self.spans, size = "".join(p for p, *_ in parts), name, [], [], 0
        for piece, start, end, copied in parts:
            self.at.append(size)
            self.spans.append((start, end, copied))
            size += len(piece)

    def cut(self, start: int, end: int) -> list[tuple[str, int, int, bool]]:
        """The stretches of a part of the text."""
        out, k = [], bisect_right(self.at, start) - 1
        while k < len(self.at) and self.at[k] < end:
            a, b = max(start, self.at[k]), min(end, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
            first, last, copied = self.spans[k]
            if a < b:
                out.append((self.text[a:b], first + a - self.at[k], first + b - self.at[k], True) if copied else (self.text[a:b], first, last, False))
            k += 1
        return out

    def origin(self, start: int, end: int) -> tuple[int, int]:
        parts = self.cut(start, end)
        return parts[0][1], parts[-1][2]


def _unescape(run: str) -> str:
    def one(m: re.Match) -> str:
        digits = m[1] or m[2] or m[3]
        if digits is None:
            return html.unescape(m[4])
        code = int(digits, 16)
        return chr(code) if code < 0x110000 else "\ufffd"

    out = ONE.sub(one, run)
    try:  # halves of a surrogate pair written apart
        return out.encode("utf-16", "surrogatepass").decode("utf-16")
    except UnicodeDecodeError:
        return out.encode("utf-8", "replace").decode("utf-8")


def escaped_layers(layer: Layer) -> Iterator[Layer]:
    """The text with its escapes of one form decoded in place."""
    text = layer.text
    for name, pattern in ESCAPE.items():
        if not ("%" in text if name == "url" else "\\" in text or "&" in text):
            continue
        parts, done = [], 0
        for m in pattern.finditer(text):
            plain = unquote_to_bytes(m[0]).decode("utf-8", "replace") if name == "url" else _unescape(m[0])
            parts += layer.cut(done, m.start())
            if plain:
                parts.append((plain, *layer.origin(*m.span()), False))
            done = m.end()
        if done and (parts := parts + layer.cut(done, len(text))):
            yield Layer(layer.name or name, parts)


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and sum(c.isprintable() or c in "\t\n\r" for c in text) >= 0.95 * len(text) else None


def _decode(body: str) -> bytes:
    return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))


class Unread(Exception):
    """More was unpacked than granted."""


class Grant:
    """What compressed data may still unpack to, over all levels; whether a stream broke off."""

    def __init__(self, left: int):
        self.left, self.broken = left, False

    def take(self, n: int) -> None:
        self.left -= n
        if self.left < 0:
            raise Unread


def _inflated(chunks: Iterator[bytes], grant: Grant) -> Iterator[bytes]:
    """The data that compressed ``chunks`` hold, member after member; what is not compressed comes
    out as it is, and so does nothing behind damaged data."""
    pending, engine, any_out = b"", None, False
    for chunk in chunks:
        if engine is None and not any_out:
            pending += chunk
            if len(pending) < 3:
                continue
            if not MAGIC.match(pending):
                yield pending
                yield from chunks
                return
            chunk, engine = pending, zlib.decompressobj(wbits=47)
        while chunk and engine:
            try:
                out = engine.decompress(chunk, CHUNK)
            except zlib.error:
                if not any_out:
                    yield chunk
                    yield from chunks
                return
            grant.take(len(out))
            if out:
                any_out = True
                yield out
            if engine.eof:
                chunk = engine.unused_data
                engine = zlib.decompressobj(wbits=47) if MAGIC.match(chunk) else None
            else:
                chunk = engine.unconsumed_tail
    if engine is None and not any_out:
        yield pending
    while engine and not engine.eof:  # what the engine still holds
        try:
            out = engine.decompress(engine.unconsumed_tail, CHUNK)
        except zlib.error:
            return
        if not out:
            grant.broken = True
            return
        grant.take(len(out))
        yield out


def _unpacked(raw: bytes | memoryview, grant: Grant) -> Iterator[bytes] | None:
    """What is left when nested compression is undone, in chunks; None if nothing was compressed."""
    if not MAGIC.match(raw):
        return None
    chunks, levels = iter((bytes(raw),)), 0
    while True:
        chunks = _inflated(chunks, grant)
        first = b""
        for more in chunks:
            first += more
            if len(first) >= 3:
                break
        levels += 1
        if levels == 1 and first == raw:
            return None
        if not MAGIC.match(first) or levels > 1 and first == before:
            return chain((first,), chunks)
        before, chunks = first, chain((first,), chunks)


def _windows(chunks: Iterator[bytes]) -> Iterator[tuple[str, bool]]:
    """Chunks as text, in parts cut where nothing stands across, and whether a part had to be cut in
    a run. Bytes that are no text become one character each, beside which parts can be cut."""
    decoder, held, size, enough = codecs.getincrementaldecoder("utf-8")("replace"), [], 0, WINDOW
    for chunk in chain(chunks, (None,)):
        text = decoder.decode(chunk or b"", chunk is None)
        held.append(text)
        size += len(text)
        if chunk is not None and size < enough:
            continue
        text, held, size = "".join(held), [], 0
        if chunk is None:
            yield text, False
            return
        cut = len(text.rstrip(SPANNING))
        if cut:
            yield text[:cut], False
            held = [text[cut:]]
        elif len(text) < 8 * WINDOW:
            held = [text]
        else:
            yield text, True
            held = [text[-OVERLAP:]]
        size = len(held[0])
        enough = size + WINDOW


def _compressed_kinds(raw: bytes | memoryview, grant: Grant, cut: bool) -> set[str]:
    """Kinds of the hits in compressed data, read in a stream."""
    kinds: set[str] = set()
    grant.broken = False
    try:
        chunks = _unpacked(raw, grant)
        for text, part in _windows(chunks) if chunks else ():
            if part or not text.isspace():
                kinds.update(kind.rpartition("/")[2] for _, _, kind in scan_layers(text, grant, part))
    except Unread:
        kinds.add("unread")
    if cut and grant.broken:  # it goes on behind this window
        kinds.add("unread")
    return kinds


def _stretches(body: str) -> Iterator[tuple[str | memoryview, int, int]]:
    """Texts, or what begins like compressed data, anywhere in a run, at any alignment, with the
    characters that they are from."""
    for shift in range(4):
        part = body[shift:]
        raw = _decode(part[: len(part) - 1 if len(part) % 4 == 1 else len(part)])
        for m in STRETCH.finditer(raw):
            if text := m[0].decode("utf-8", "ignore"):
                yield text, shift + m.start() // 3 * 4, min(len(body), shift - (-m.end() // 3) * 4)
        for m in MAGIC.finditer(raw):
            yield memoryview(raw)[m.start() :], shift + m.start() // 3 * 4, len(body)


def _runs(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs that could be base64: the characters, and where each line of them begins (in the run, in
    the text)."""
    for m in BASE64.finditer(text):
        body = m[0].rstrip("=")
        if len(body) >= LEAST or ZLIB_HINT.search(body):
            yield body, [(0, m.start())]
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            lines, at, joined = [], 0, LINE.findall(m[0])
            for line in LINE.finditer(m[0]):
                lines.append((at, m.start() + line.start()))
                at += len(line[0])
            if at >= 10:
                yield "".join(joined).rstrip("="), lines


def packed_layers(layer: Layer, grant: Grant | None, cut: bool) -> Iterator[Layer | tuple[int, int, str]]:
    """Texts inside base64 runs, and the hits in compressed ones. Without a grant, each run of the
    layer gets its own."""
    for body, lines in _runs(layer.text):
        starts = [at for at, _ in lines]

        def place(i: int) -> int:
            at, there = lines[bisect_right(starts, i) - 1]
            return there + i - at

        own = grant or Grant(GRANTED + EXPAND * len(body))
        found: list[tuple[str | memoryview, int, int]] | Iterator = ()
        whole = False
        if len(body) % 4 != 1:
            raw = _decode(body)
            text = _readable(raw)
            whole = text is not None or MAGIC.match(raw) is not None
            found = [(text if text is not None else memoryview(raw), 0, len(body))] if whole else ()
        for what, first, last in found if whole and isinstance(found[0][0], str) else chain(found, _stretches(body)):
            end = place(last - 1) + 1
            while last == len(body) and end < len(layer.text) and layer.text[end] == "=" and end - place(last - 1) <= 2:
                end += 1
            start, end = layer.origin(place(first), end)
            if isinstance(what, str):
                yield Layer(layer.name or "base64", [(what, start, end, False)])
            else:
                yield from ((start, end, f"{layer.name or 'compressed'}/{kind}") for kind in sorted(_compressed_kinds(what, own, cut)))


def scan_layers(text: str, grant: Grant | None = None, cut: bool = False) -> Iterator[Span]:
    """Hits of a text and of all layers in it, those of the text itself without a layer's name. The
    layers are walked depth first, each made when its turn comes. ``cut``: the text is a part of a run."""
    seen: set[bytes] = set()
    todo: list[Iterator[Layer | Span]] = [iter([Layer("", [(text, 0, len(text), True)])] if text else [])]
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        if isinstance(layer, tuple):
            yield layer
            continue
        key = hashlib.sha256(f"{layer.spans[0][0]}:{layer.spans[-1][1]}:{layer.text}".encode("utf-8", "surrogatepass")).digest()
        if key in seen:
            continue
        seen.add(key)
        for start, end, kind in base_spans(layer.text):
            yield (*layer.origin(start, end), f"{layer.name}/{kind}") if layer.name else (start, end, kind)
        todo.append(chain(escaped_layers(layer), packed_layers(layer, grant, cut)))


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """The base spans, and those of decoded layers, each by start and kind."""
    base, more = [], set()
    for span in scan_layers(text or ""):
        if "/" in span[2]:
            more.add(span)
        else:
            base.append(span)
    taken = {(s, e) for s, e, _ in base}
    return sorted(base, key=_place), sorted((s for s in more if s[:2] not in taken), key=_place)


def _place(span: Span) -> tuple[int, int, int, str]:
    """By start and kind, base kinds first."""
    layer, _, kind = span[2].rpartition("/")
    return span[0], ORDER[kind] + len(ORDER) * bool(layer), span[1], span[2]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs(doc_id long, text)`` -> counts of the base kinds, the hash of their spans, and all
    spans as ``kind:start:end`` (code points of the original text, end exclusive)."""

    def rows(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            base, more = scan(text)
            both = sorted([*base, *more], key=_place)
            shown = [",".join(f"{k}:{a}:{b}" for a, b, k in spans) for spans in (base, both)]
            out["doc_id"].append(doc_id)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for _, _, k in base))
            out["base_sha256"].append(hashlib.sha256(shown[0].encode()).hexdigest())
            out["spans"].append(shown[1])
        return out

    return map_texts(docs.select("doc_id", "text"), rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span, overlapping ones merged, replaced by ``mark`` and
    ``n_chars``, if there, set anew."""

    def redacted(text: str | None) -> str | None:
        if not text:
            return text
        base, more = scan(text)
        out, done = [], 0
        for start, end in sorted((s, e) for s, e, _ in (*base, *more)):
            if start >= done:
                out += [text[done:start], mark]
            done = max(done, end)
        return "".join(out) + text[done:]

    def rows(cols: dict[str, list]) -> dict[str, list]:
        text = [redacted(t) for t in cols["text"]]
        counts = {"n_chars": [n if t == old else len(t) for n, t, old in zip(cols["n_chars"], text, cols["text"], strict=True)]} if "n_chars" in cols else {}
        return {**cols, "text": text, **counts}

    return map_texts(docs, rows, ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))
