"""Text of PDF bytes, page by page: the default extractor, for files with plain or Flate-coded content streams and
one-byte fonts. Anything it can't read is a ValueError; a better library can take its place as a plug-in."""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:\\.|[^()\\]|\((?:\\.|[^()\\])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+]?\d*\.?\d+|/[^\s/\[\]()<>]+|[A-Za-z'\"*]+", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
_PLAIN = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _PLAIN.get(m[1], m[1]), token[1:-1])
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def _shown(content: bytes) -> str:
    """Strings shown by a content stream; moves to another line become line ends, wide gaps in a row spaces."""
    out: list[str] = []
    stack: list = []
    row: list | None = None

    def line() -> None:
        if out and not out[-1].endswith("\n"):
            out.append("\n")

    for token in _TOKEN.findall(content):
        if token == b"[":
            row = []
        elif token == b"]":
            stack, row = [row or []], None
        elif token[:1] in (b"(", b"<"):
            (stack if row is None else row).append(_string(token))
        elif token[:1].isdigit() or token[:1] in (b"-", b"+", b"."):
            (stack if row is None else row).append(float(token))
        else:
            if token in (b"Td", b"TD") and len(stack) > 1 and stack[-1] not in (0, 0.0) or token in (b"T*", b"'", b'"', b"ET", b"Tm"):
                line()
            if token in (b"Tj", b"'", b'"') and stack and isinstance(stack[-1], str):
                out.append(stack[-1])
            elif token == b"TJ" and stack and isinstance(stack[-1], list):
                out += [x if isinstance(x, str) else " " if x < -200 else "" for x in stack[-1]]
            stack = []
    return "".join(out).strip("\n")


def pages_of(data: bytes, max_pages: int | None = None) -> list[str]:
    """The text of each page, in the order of the page tree."""
    if not data.lstrip()[:5] == b"%PDF-":
        raise ValueError("not a PDF file")
    if b"/Encrypt" in data:
        raise ValueError("PDF is encrypted and could not be decrypted")
    objects = {int(m[1]): m[2] for m in _OBJECT.finditer(data)}

    def stream(number: int) -> bytes:
        body = objects.get(number, b"")
        found = _STREAM.search(body)
        if not found:
            return b""
        raw = found[1]
        if b"/FlateDecode" in body[: found.start()]:
            raw = zlib.decompressobj().decompress(raw)
        return raw

    # objects packed into streams
    for number, body in list(objects.items()):
        if b"/ObjStm" in body:
            raw = stream(number)
            first = int(re.search(rb"/First\s+(\d+)", body)[1])
            heads = list(map(int, raw[:first].split()))
            places = list(zip(heads[::2], heads[1::2], strict=False))
            for k, (inner, at) in enumerate(places):
                stop = places[k + 1][1] if k + 1 < len(places) else len(raw) - first
                objects.setdefault(inner, raw[first + at : first + stop])
    is_page = {n for n, body in objects.items() if re.search(rb"/Type\s*/Page\b(?!s)", body)}
    ordered: list[int] = []

    def walk(number: int, seen: frozenset) -> None:
        if number in seen:
            return
        if number in is_page:
            ordered.append(number)
            return
        kids = re.search(rb"/Kids\s*\[(.*?)\]", objects.get(number, b""), re.S)
        for kid in _REF.findall(kids[1]) if kids else ():
            walk(int(kid), seen | {number})

    for number, body in objects.items():
        if re.search(rb"/Type\s*/Pages\b", body) and b"/Parent" not in body:
            walk(number, frozenset())
    ordered = ordered or sorted(is_page)
    out = []
    for number in ordered[:max_pages]:
        contents = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", objects[number], re.S)
        out.append(_shown(b"\n".join(stream(int(n)) for n in _REF.findall(contents[1]))) if contents else "")
    return out
