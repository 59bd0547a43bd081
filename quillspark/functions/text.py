"""Column -> Column string rules with Python's whitespace and line semantics.

Spark's ``trim`` removes U+0020 only and Java's ``\\s`` is ASCII-only, while the
rules we must agree with use Python's ``str.strip``/``\\s``/``splitlines``.  The
character classes below spell those sets out.  Every pattern uses only syntax
that Java regex and RE2 read the same way (``\\x{hhhh}`` escapes, ``\\A``/``\\z``
anchors), so the same text also serves the DuckDB oracle SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Python whitespace / line-break sets --------------------
# Python str.isspace() / re \s (str patterns): 29 code points.
WS_CLASS = (r"[\t-\r\x1c- \x85\xa0\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Python str.splitlines() boundaries.
LINE_BREAK = r"(?:\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}])"
# The same two sets as literal characters, for char-set functions (btrim, translate).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
LINE_BREAK_CHARS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
# --------------------------------------------------------------------------

STRIP_WS = r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once and written once.

    A rule that looks at its input many times would otherwise multiply the input's
    expression with every step, as soon as a filter on the result is pushed below
    the projections it was built in.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def pystrip(c) -> Column:
    """``str.strip()`` with no argument: a character-set trim, no regex."""
    return F.btrim(col_of(c), F.lit(WS_CHARS))


def strip_chars(c, chars: str) -> Column:
    """``str.strip(chars)``."""
    return F.btrim(col_of(c), F.lit(chars))


def collapse_ws(c, repl: str = " ") -> Column:
    """``re.sub(r"\\s+", repl, s)``."""
    return F.regexp_replace(col_of(c), WS_CLASS + "+", repl)


def last_line(c, stripped: bool = False) -> Column:
    """``s.splitlines()[-1]``; ``""`` where Python would raise on an empty list.

    For stripped text (which cannot end in a line break) every break
    character is mapped to ``\\n`` and the text after the last one is taken:
    no regex, no array.
    """
    c = col_of(c)
    if stripped:
        return F.substring_index(F.translate(c, LINE_BREAK_CHARS, "\n" * len(LINE_BREAK_CHARS)), "\n", -1)
    trimmed = F.regexp_replace(c, LINE_BREAK + r"\z", "")
    return F.element_at(F.split(trimmed, LINE_BREAK), -1)


def first_line_nl(c) -> Column:
    """``s.split("\\n")[0]``."""
    return F.substring_index(col_of(c), "\n", 1)


def is_blank(c) -> Column:
    """True for null or for text that ``strip()`` reduces to ``""``."""
    c = col_of(c)
    return c.isNull() | (pystrip(c) == F.lit(""))


# -- templates -------------------------------------------------------------

_PLACEHOLDER = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")
_UNSUPPORTED = re.compile(r"\{[%#]|\{\{")


def template_parts(template: str) -> list[tuple[str, str]]:
    """Split a ``{{field}}`` template into ("lit", text) / ("field", name).

    Only plain substitution is supported; any other template construct raises.
    A single trailing newline is dropped, as the template engine does by
    default.
    """
    if template.endswith("\n"):
        template = template[:-1]
    parts: list[tuple[str, str]] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        lit = template[pos:m.start()]
        if _UNSUPPORTED.search(lit):
            raise ValueError(f"unsupported template construct in {template!r}")
        if lit:
            parts.append(("lit", lit))
        parts.append(("field", m.group(1)))
        pos = m.end()
    tail = template[pos:]
    if _UNSUPPORTED.search(tail):
        raise ValueError(f"unsupported template construct in {template!r}")
    if tail:
        parts.append(("lit", tail))
    return parts


def template_fields(template: str) -> list[str]:
    return [v for k, v in template_parts(template) if k == "field"]


def render(template: str, columns: dict) -> Column:
    """Fill ``{{field}}`` placeholders from ``columns`` (name -> Column).

    A field that is absent from ``columns`` or null renders as ``""``.
    """
    pieces = []
    for kind, val in template_parts(template):
        if kind == "lit":
            pieces.append(F.lit(val))
        else:
            c = columns.get(val)
            pieces.append(F.lit("") if c is None else F.coalesce(c.cast("string"), F.lit("")))
    if not pieces:
        return F.lit("")
    return F.concat(*pieces)
