"""Answer normalisation and number parsing as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CHARS, WS_CLASS, col_of, collapse_ws, first_line_nl, last_line, let, pystrip, strip_chars

# --- fixed values: grading patterns ---------------------------------------
BOXED = r"\\boxed\{([^}]*)\}"           # first \boxed{...} up to the first }
DOUBLE_BACKSLASH = r"\\\\"              # a pair of backslashes
ANSWER_MARK = r"[Aa]nswer" + WS_CLASS + r"*[:\-]" + WS_CLASS + r"*([^\n]*)"
NUMBER = r"-?[0-9][0-9,]*(\.[0-9]+)?"
# --------------------------------------------------------------------------


def extract_math_answer(c, stripped: bool = False) -> Column:
    """H1: final answer of a MATH-style solution.

    ``stripped=True`` says the input already went through ``pystrip`` (lets a
    caller compute the strip once in its own projection).
    """
    c = col_of(c)
    t = c if stripped else pystrip(c)
    # BOXED without a pattern, which would read on to the end from every box that is not closed
    rest = F.substr(t, F.instr(t, BOX) + len(BOX))
    closed = F.contains(t, F.lit(BOX)) & F.contains(rest, F.lit("}"))
    cand = F.when(closed, F.substring_index(rest, "}", 1)).otherwise(last_line(t, stripped=True))
    cand = F.replace(cand, F.lit("\\\\"), F.lit(""))
    cand = collapse_ws(cand, " ")
    return F.coalesce(strip_chars(cand, " ."), F.lit(""))


def normalize_numeric_answer(c, stripped: bool = False) -> Column:
    """H2: GSM8K-style answer: text after "Answer:"/"answer -", first line, no commas."""
    c = col_of(c)
    t = c if stripped else pystrip(c)
    s = F.when(t.rlike(ANSWER_MARK), F.regexp_extract(t, ANSWER_MARK, 1)).otherwise(t)
    s = F.replace(s, F.lit(","), F.lit(""))
    s = first_line_nl(s)
    return F.coalesce(strip_chars(s, " ."), F.lit(""))


def normalize_for_dataset(dataset, text, stripped: bool = False) -> Column:
    """H5: grader dispatch by dataset name (case-insensitive); others raise."""
    d = F.lower(col_of(dataset))
    return (F.when(d == "math", extract_math_answer(text, stripped))
            .when(d == "gsm8k", normalize_numeric_answer(text, stripped))
            .otherwise(F.raise_error(F.concat(F.lit("no grader for dataset "),
                                               F.coalesce(col_of(dataset), F.lit("null"))))))


# --- boxes whose braces balance (H10, H11) ---------------------------------
BOX = "\\boxed{"
_NO_BRACE = "\u0002"  # stands for one character of an escaped brace


def _brace_pieces(text: Column) -> Column:
    """``text`` cut after every brace that is one (linear: a one-character pattern).

    A brace after one backslash is a character of the text, after two it is a
    brace again; either way the pieces have as many characters as the text.
    """
    shadow = text
    for brace in "{}":
        shadow = F.replace(shadow, F.lit("\\\\" + brace), F.lit(2 * _NO_BRACE + brace))
        shadow = F.replace(shadow, F.lit("\\" + brace), F.lit(2 * _NO_BRACE))
    return F.split(shadow, "(?<=[{}])", -1)


def _after_first_closed_box(pieces: Column) -> Column:
    """Characters that follow the opening brace of the first box that is closed; -1
    without one.  Read from the right: an opening brace is closed when a closing
    brace is still free there."""
    def step(s, p):
        closes = F.endswith(p, F.lit("}"))
        closed = F.endswith(p, F.lit("{")) & (s["free"] > 0)
        return F.struct(
            (s["free"] + F.when(closes, 1).when(closed, -1).otherwise(0)).alias("free"),
            (s["seen"] + F.length(p)).alias("seen"),
            F.when(closed & F.endswith(p, F.lit(BOX)), s["seen"]).otherwise(s["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("free"), F.lit(0).alias("seen"), F.lit(-1).alias("found"))
    return F.aggregate(F.reverse(pieces), start, step, lambda s: s["found"])


def _group_length(pieces: Column) -> Column:
    """Characters before the brace that closes the group the text begins in."""
    def step(s, p):
        depth = s["depth"] + F.when(F.endswith(p, F.lit("{")), 1).when(F.endswith(p, F.lit("}")), -1).otherwise(0)
        seen = s["seen"] + F.length(p)
        return F.struct(depth.alias("depth"), seen.alias("seen"),
                        F.when((s["end"] < 0) & (depth == 0), seen - 1).otherwise(s["end"]).alias("end"))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"), F.lit(-1).alias("end"))
    return F.aggregate(pieces, start, step, lambda s: s["end"])


def boxed_answer(c) -> Column:
    r"""Content of the first ``\boxed{...}`` whose braces balance, at any
    depth; null without one.

    Two folds over the pieces between braces, each linear in the text, with a
    state of three numbers: no pattern walks the nesting.  A box without braces
    or escapes inside needs none of it.
    """
    def nested(text: Column) -> Column:
        """Of a text that begins with a box."""
        def cut(after):
            inner = F.right(text, after)
            return F.when(after >= 0, F.left(inner, _group_length(_brace_pieces(inner))))

        return let(_after_first_closed_box(_brace_pieces(text)), cut)

    def first_box(text: Column) -> Column:
        rest = F.substr(text, F.instr(text, BOX) + len(BOX))
        flat = F.substring_index(rest, "}", 1)
        simple = F.contains(rest, F.lit("}")) & ~F.contains(flat, F.lit("{")) & ~F.endswith(flat, F.lit("\\"))
        return F.when(F.contains(text, F.lit(BOX)), F.when(simple, flat).otherwise(let(F.substr(text, F.instr(text, BOX)), nested)))

    return first_box(col_of(c))


# --- fixed values: LaTeX rewrites (H11), applied in this order -------------
MIXED = "\u0001"  # stands for the space of a mixed number while other spaces go
_WHOLE = r"(?:\{\s*([0-9]+)\s*\}|([0-9]))"     # a number as an argument: {12} or one digit
_ARG = r"(?:\{([^{}]*)\}|([0-9A-Za-z]))"       # any argument
# a fraction inside another's argument is rewritten first; each pass takes one level
FRACTION_PASSES = 3
# (needle, rules): the rules are tried on texts that hold the needle
MARKUP_REWRITES = [
    ("{", [(r"\\(?:text|mathrm|mathbf|mbox|textbf)\s*\{([^{}]*)\}", "$1"),
           (r"\\(?:text|mathrm|mathbf|mbox|textbf|boxed)\s*\{", "{")]),
    ("frac", [(r"([0-9])\s*\\[dtc]?frac\s*" + _WHOLE + r"\s*" + _WHOLE, "$1" + MIXED + "$2$3/$4$5"),
              *[(r"\\[dtc]?frac\s*" + _ARG + r"\s*" + _ARG, "($1$2)/($3$4)")] * FRACTION_PASSES]),
    ("\\", [(r"\\left|\\right", ""), (r"\^\{?\\circ\}?", ""), (r"\\[,;:! ]", ""), (r"\\cdot|\\times", "*"), (r"\\%", "%")]),
]
PLAIN_REWRITES = [
    ("/", [(r"([0-9])\s+([0-9]+)\s*/\s*([0-9]+)", "$1" + MIXED + "$2/$3")]),
    ("$", [(r"\\?\$", "")]),
    ("(", [(r"\(([0-9.\-]+)\)", "$1")]),
]
# --------------------------------------------------------------------------


def _rewritten(text: Column, rewrites) -> Column:
    def rule(needle: str, rules):
        def apply(t: Column) -> Column:
            out = t
            for pat, rep in rules:
                out = F.regexp_replace(out, pat, rep)
            return F.when(F.contains(t, F.lit(needle)), out).otherwise(t)

        return apply

    for needle, rules in rewrites:
        text = let(text, rule(needle, rules))
    return text


def latex_to_plain(c) -> Column:
    r"""Common LaTeX answer markup to plain text without white space, but
    for the one space of a mixed number (``1 1/2``).

    Fractions are read with and without braces (``\frac12``); boxes and text
    commands leave their content; braces that only group go (escaped ones stay).
    The markup rules run on rows with a backslash or a brace only.
    """
    def without_markup(t: Column) -> Column:
        marked = _rewritten(t, MARKUP_REWRITES)
        for brace, kept in (("{", "\u0003"), ("}", "\u0004")):
            marked = F.replace(marked, F.lit("\\" + brace), F.lit(kept))
        marked = F.translate(marked, "\u0003\u0004{}", "{}")
        return F.when(F.contains(t, F.lit("\\")) | F.contains(t, F.lit("{")) | F.contains(t, F.lit("}")), marked).otherwise(t)

    text = col_of(c)
    # white space goes, the mark of a mixed number becomes a space
    plain = F.translate(_rewritten(let(text, without_markup), PLAIN_REWRITES), MIXED + WS_CHARS, " ")
    return F.when(text.rlike(r"[\\{}/$(]|" + WS_CLASS), plain).otherwise(text)


# --- fixed values: units of measure (H12) ------------------------------------
CURRENCY_SIGNS = "$€£¥₹"
PREFIX_WORDS = ["kilo", "centi", "milli", "deci", "deca", "hecto", "micro", "nano", "mega", "giga", "tera"]
PREFIX_SYMBOLS = ["k", "c", "m", "d", "da", "h", "u", "µ", "n", "g", "t"]
PREFIXED_WORDS = ["meter", "metre", "gram", "liter", "litre", "second", "watt", "joule", "byte", "hertz", "pascal", "volt"]
PREFIXED_SYMBOLS = ["m", "g", "l", "s", "hz", "w", "j", "pa", "v", "b"]
UNIT_WORDS = ["dollar", "cent", "euro", "pound", "rupee", "percent", "degree", "unit", "inch", "yard", "mile", "acre", "ounce",
              "ton", "tonne", "gallon", "quart", "pint", "cup", "minute", "hour", "day", "week", "month", "year", "knot"]
IRREGULAR_UNITS = ["foot", "feet", "inches", "penny", "pennies", "pence", "hertz"]
UNIT_SYMBOLS = ["m", "g", "l", "in", "ft", "yd", "mi", "oz", "lb", "lbs", "sec", "secs", "min", "mins", "hr", "hrs", "mph", "kph",
                "usd", "eur", "gbp", "°c", "°f", "°"]
#: Units only after a stroke or "per" (alone they are letters of a formula).
BELOW_STROKE = ["h", "s", "d"]
#: Words after a number that belong to mathematics.
MATH_WORDS = ["sqrt", "sin", "cos", "tan", "cot", "sec", "csc", "log", "exp", "mod", "inf", "infinity", "abc", "xyz", "times", "choose"]
# --------------------------------------------------------------------------


def unit_table() -> list[str]:
    """Every spelling of a single unit, from the lists above."""
    words = PREFIXED_WORDS + UNIT_WORDS + [p + w for p in PREFIX_WORDS for w in PREFIXED_WORDS]
    return sorted({*words, *(w + "s" for w in words), *IRREGULAR_UNITS, *UNIT_SYMBOLS,
                   *(p + s for p in PREFIX_SYMBOLS for s in PREFIXED_SYMBOLS)})


def trie_pattern(words) -> str:
    """Pattern that takes the longest of ``words``: their trie, one branch a letter,
    so no letter is looked at twice."""
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def spell(node: dict) -> str:
        ways = [re.escape(ch) + spell(kid) for ch, kid in sorted(node.items()) if ch]
        if not ways:
            return ""
        joined = ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"
        return f"(?:{joined})?" if "" in node else joined

    return spell(trie)


def unit_pattern() -> str:
    """A unit with its power, and up to three more after a stroke, "per" or a product sign."""
    power = r"(?:\^?\{?-?[23]\}?|[²³])?"
    one = r"(?:(?:square|sq\.?|cubic|cu\.?)" + WS_CLASS + "*)?" + trie_pattern(unit_table()) + power
    below = "(?:" + one + "|" + trie_pattern(BELOW_STROKE) + power + ")"
    return one + "(?:" + WS_CLASS + r"*(?:(?:/|per)" + WS_CLASS + "*" + below + r"|[*·⋅]" + WS_CLASS + "*" + one + ")){0,3}"


def normalize_number_string(c) -> Column:
    """Drop thousands commas, currency signs, and what is measured or counted
    after a number: a percent sign or unit (with prefix, power, ``km/h``, ``sq ft``)
    after a digit; and, where the text is a number and words, the words (``12 red
    apples``) unless they are mathematics.  Other letters never go."""
    unit = r"(?i)([0-9]\.?)" + WS_CLASS + r"*(?:%|" + unit_pattern() + r")\.?\z"
    counted = (r"(?i)\A([+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[ /][0-9]+){0,2})" + WS_CLASS + r"*+(?!(?:" + "|".join(MATH_WORDS) + r")\b)"
               r"[a-z]{3,}+(?:" + WS_CLASS + r"[a-z]++){0,4}\.?\z")

    def bare(s: Column) -> Column:
        """Without a letter or sign of a unit there is nothing to take off."""
        return F.when(s.rlike("[A-Za-z%°µ]"), F.regexp_replace(F.regexp_replace(s, unit, "$1"), counted, "$1")).otherwise(s)

    def no_commas(s: Column) -> Column:
        return F.when(F.contains(s, F.lit(",")), F.regexp_replace(s, "([0-9]),", "$1")).otherwise(s)

    text = col_of(c)
    s = let(let(F.translate(text, CURRENCY_SIGNS, ""), no_commas), bare)
    s = F.regexp_replace(F.btrim(s, F.lit(WS_CHARS)), r"\.\z", "")
    return F.when(text.rlike("[A-Za-z%°µ,." + CURRENCY_SIGNS + "]|" + WS_CLASS), s).otherwise(text)


def number_from_text(c) -> Column:
    """Last number in free text (commas removed), null when there is none."""
    nums = F.regexp_extract_all(col_of(c), F.lit(NUMBER), 0)
    last = F.element_at(nums, -1)
    return F.when(F.size(nums) > 0, F.replace(last, F.lit(","), F.lit("")))


# --- fixed values: number formats (H10) -------------------------------------
_UNSIGNED = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
PLAIN_NUMBER = r"\A[+-]?" + _UNSIGNED + r"\z"
FRACTION = r"\A([+-]?)\(?([+-]?" + _UNSIGNED + r")\)?/\(?([+-]?" + _UNSIGNED + r")\)?\z"
MIXED_NUMBER = r"\A([+-]?)([0-9]+) ([0-9]+)/([0-9]+)\z"
# --------------------------------------------------------------------------


def to_number(c, cleaned: bool = False) -> Column:
    """A decimal (``.5``, ``+5``, ``-3.``), a fraction ``a/b`` or a mixed
    number ``1 1/2`` as DOUBLE; null otherwise.

    ``cleaned=True``: the input already went through ``normalize_number_string``.
    """
    def parsed(s: Column) -> Column:
        def part(pattern: str, group: int) -> Column:
            return F.regexp_extract(s, pattern, group).try_cast("double")

        def sign(pattern: str) -> Column:
            return F.when(F.regexp_extract(s, pattern, 1) == "-", -1.0).otherwise(1.0)

        plain = F.when(s.rlike(PLAIN_NUMBER), s.try_cast("double"))
        fraction = F.when(part(FRACTION, 3) != 0, sign(FRACTION) * part(FRACTION, 2) / part(FRACTION, 3))
        mixed = F.when(part(MIXED_NUMBER, 4) != 0, sign(MIXED_NUMBER) * (
            part(MIXED_NUMBER, 2) + part(MIXED_NUMBER, 3) / part(MIXED_NUMBER, 4)))
        # the two with a stroke are looked at for texts that have one
        return F.when(F.contains(s, F.lit("/")), F.coalesce(mixed, fraction)).otherwise(plain)

    return let(col_of(c) if cleaned else normalize_number_string(c), parsed)


def numbers_match(a, b, tol: float = 1e-6, parsed: bool = False) -> Column:
    """Both parse as numbers and differ by at most ``tol`` (relative above 1).

    ``parsed=True``: ``a`` and ``b`` are already DOUBLE columns from ``to_number``.
    """
    x, y = (col_of(a), col_of(b)) if parsed else (to_number(a), to_number(b))
    scale = F.greatest(F.lit(1.0), F.abs(y))
    return F.coalesce(F.abs(x - y) <= F.lit(tol) * scale, F.lit(False))
