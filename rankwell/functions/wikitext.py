"""What a reader sees of a wikitext field: a scanner over the marks of the syntax, in one pass for each kind of mark."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_BRACE, _QUOTES = re.compile("[{}]"), re.compile("''+")
_MARK = re.compile(r"[<\[{]|''")
#: Texts of one piece of an Arrow batch; a batch may hold thousands of long ones.
TEXTS_AT_ONCE = 64
_SCHEMES = ("//", "http://", "https://")


def _ahead(text: str, mark: str) -> Callable[[int], int]:
    """The next place of a mark, for places asked in ascending order: no part of the text is looked at twice."""
    found = -1

    def ask(start: int) -> int:
        nonlocal found
        if found < start:
            found = text.find(mark, start)
            found = len(text) if found < 0 else found
        return found

    return ask


def _replaced(text: str, opens: str, shown: Callable[[int], tuple[int, str] | None]) -> str:
    """The text with each mark at `opens` replaced by what `shown` says: where it ends and what is seen of it."""
    out, done, at = [], 0, text.find(opens)
    while at >= 0:
        seen = shown(at)
        if seen is None:
            at = text.find(opens, at + 1)
            continue
        out += (text[done:at], seen[1])
        done = seen[0]
        at = text.find(opens, done)
    return "".join((*out, text[done:]))


def _comments(text: str) -> str:
    close = _ahead(text, "-->")
    return _replaced(text, "<!--", lambda at: (end + 3, "") if (end := close(at + 4)) < len(text) else None)


def _breaks(text: str) -> str:
    close = _ahead(text, ">")

    def shown(at: int) -> tuple[int, str] | None:
        if text[at + 1 : at + 3].lower() != "br" or (end := close(at)) >= len(text):
            return None
        return (end + 1, " ") if not text[at + 3 : end].removesuffix("/").strip() else None

    return _replaced(text, "<", shown)


def _outer_links(text: str) -> str:
    """A link to an address shows the words behind the address, or nothing."""
    close = _ahead(text, "]")

    def shown(at: int) -> tuple[int, str] | None:
        scheme = next((s for s in _SCHEMES if text.startswith(s, at + 1)), None)
        begin = at + 1 + len(scheme or "")
        if scheme is None or (end := close(begin)) >= len(text) or end == begin or text[begin].isspace():
            return None
        address = text[begin:end].split(maxsplit=1)[0]
        return end + 1, text[begin + len(address) : end].lstrip()

    return _replaced(text, "[", shown)


def _inner_links(text: str) -> str:
    """A link to a page shows its label, or the name of the page."""
    close, bar = _ahead(text, "]"), _ahead(text, "|")
    second = _ahead(text, "|")

    def shown(at: int) -> tuple[int, str] | None:
        end = close(at + 2)
        if not text.startswith("]]", end):
            return None
        first = bar(at + 2)
        if first >= end:
            return end + 2, text[at + 2 : end]
        return None if second(first + 1) < end else (end + 2, text[first + 1 : end])

    return _replaced(text, "[[", shown)


def _templates(text: str) -> str:
    """Without double braces and what lies between, from within outwards: braces are held until a pair closes."""
    out: list[str] = []
    held: list[int] = []
    done = 0
    for mark in _BRACE.finditer(text):
        if mark.start() > done:
            out.append(text[done : mark.start()])
        held.append(len(out))
        out.append(mark.group())
        done = mark.end()
        a, b, c, d = held[-4:] if len(held) > 3 else (0, 0, 0, 0)
        if d == c + 1 and b == a + 1 and "".join((out[a], out[b], out[c], out[d])) == "{{}}":
            del out[a:], held[-4:]
    return "".join((*out, text[done:]))


def _tags(text: str) -> str:
    close = _ahead(text, ">")

    def shown(at: int) -> tuple[int, str] | None:
        name = text[at + 1 : at + 3].removeprefix("/")[:1]
        end = close(at) if name.isascii() and name.isalpha() else len(text)
        return (end + 1, "") if end < len(text) else None

    return _replaced(text, "<", shown)


def readable(text: str | None) -> str | None:
    """Links show their label; comments, templates (however nested), tags and emphasis go; breaks and white space
    are one space. Null stays null; marks that are never closed stay. The work grows with the length alone."""
    if text is None:
        return None
    if _MARK.search(text) is None:
        return " ".join(text.split())
    for part in (_comments, _breaks, _outer_links, _inner_links, _templates, _tags):
        text = part(text)
    # five quotes at most make one mark, so one of six is left
    text = _QUOTES.sub(lambda m: "'" * (len(m.group()) % 5 == 1), text)
    return " ".join(text.split())


def strip_markup(text: Column) -> Column:
    """`readable` of a column, in Arrow batches, of which Python holds a piece at a time."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array(map(readable, texts.slice(i, TEXTS_AT_ONCE).to_pylist()), pa.string()) for i in range(0, len(texts), TEXTS_AT_ONCE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.arrow_udf(run, "string")(text)
