"""Text of HTML filings, and their sentences."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_VERSION = 1

# Tags without an end, tags that end a line, tags whose content is never text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav "
    "ol p pre section table tbody tfoot thead tr ul".split()
)
NEVER_TEXT = frozenset("script style title noscript template ix:header".split())

# Words whose full stop ends no sentence.
ABBREVIATIONS = (
    "inc corp co ltd llc lp plc mr mrs ms dr jr sr st vs no nos approx est fig e.g i.e etc u.s u.k jan feb mar apr jun jul aug sep sept oct nov dec q fy ca pp"
).split()

UNREAD = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.IGNORECASE | re.DOTALL)
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""")
INVISIBLE = re.compile(r"""\bstyle\s*=\s*(?:"[^"]*|'[^']*|[^\s>]*)display\s*:\s*none""", re.IGNORECASE)


def decode(content: bytes | str | None) -> str:
    """UTF-8, with or without a mark, else Windows-1252."""
    if isinstance(content, (bytes, bytearray)):
        try:
            return bytes(content).decode("utf-8-sig")
        except UnicodeDecodeError:
            return bytes(content).decode("cp1252", errors="replace")
    return content or ""


def visible(page: str) -> Iterator[str]:
    """The pieces of a page that show, with a line end for a block's edge and a space for a cell's.

    A page is cut at its tags.  Within a hidden element only tags of its own name matter: they nest, and the last one
    that closes ends it.
    """
    pieces = TAG.split(UNREAD.sub("", page))
    yield html.unescape(pieces[0])
    hidden, depth = "", 0
    for closing, name, attributes, text in zip(*[iter(pieces[1:])] * 4, strict=True):
        name, empty = name.lower(), attributes.endswith("/")
        if depth:
            depth += 0 if name != hidden or (empty and not closing) else -1 if closing else 1
        elif not closing and name not in VOID and (name in NEVER_TEXT or INVISIBLE.search(attributes)):
            hidden, depth = name, 0 if empty else 1
        elif name in BLOCK or name in ("td", "th"):
            yield "\n" if name in BLOCK else " "
        if not depth:
            yield html.unescape(text)


def raw_lines(content: bytes | str | None) -> str:
    """Visible text with its layout's line ends, blank lines kept, other spaces collapsed and trimmed."""
    text = "".join(visible(decode(content))).translate(dict.fromkeys(map(ord, "​‌‍⁠﻿")))
    return "\n".join(" ".join(line.split()) for line in text.split("\n"))


def html_lines(column: str | Column) -> Column:
    """``raw_lines`` of a column of pages."""

    def run(content: pd.Series) -> pd.Series:
        return content.map(raw_lines, na_action="ignore")

    return F.pandas_udf(run, T.StringType())(column)


def html_text(column: str | Column) -> Column:
    """The visible text, one block per line, blank lines dropped."""
    return F.array_join(F.filter(F.split(html_lines(column), "\n"), lambda x: x != ""), "\n")


_CLOSERS = r"""["')\]”’]{0,4}"""
_SHORT = "|".join(w.replace(".", r"\.") for w in ABBREVIATIONS)
#: A word, an initial or dotted initials whose full stop may stand inside a sentence.
_DOTTED = rf"(?<![A-Za-z.])(?:(?i:{_SHORT})|[A-Z]|(?:[A-Za-z]\.){{1,4}}[A-Za-z])\."
#: A line end, or the spaces after a sentence's end.
_GAP = rf"(\n|(?<=[.!?]{_CLOSERS})(?<!{_DOTTED}{_CLOSERS})[^\S\n]++(?!\p{{Ll}}))"
BULLETS = r"^(?:[•◦▪▫●○■□·]\s*|[-–—*]\s+)+"
_MARK = "\u0001"


def sentence_pieces(text: str | Column) -> Column:
    """The whole text cut into sentences (at even places) and what stands between them (at odd places).

    A line end always ends a sentence; within a line it ends at ``.``, ``!`` or ``?`` and spaces, unless a small letter follows or
    the full stop belongs to an abbreviation or to initials.
    """
    plain = F.translate(text, _MARK, " ")
    return F.split(F.regexp_replace(plain, _GAP, f"{_MARK}$1{_MARK}"), _MARK)


def sentence_list(text: Column) -> Column:
    """The sentences of a text as an array, leading bullets taken off."""
    found = F.transform(F.filter(sentence_pieces(text), lambda x, i: i % 2 == 0), lambda x: F.regexp_replace(x, BULLETS, ""))
    return F.filter(found, lambda x: x != "")
