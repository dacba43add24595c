"""Text functions, Column -> Column, built only from Spark's JVM expressions.

All patterns run with ``(?U)`` so that ``\\s``, ``\\d`` and case folding follow
Unicode rules (Python's ``str`` semantics), and word characters are spelled
``[\\p{L}\\p{N}_]`` because Java's ``\\w``/``\\b`` differ from Python's on
superscripts, fractions and combining marks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's ``str.isspace`` accepts (tab, NBSP, the Unicode
# space separators, ...), derived from the rule rather than listed.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


# The same set as a regex character-class body (\uXXXX escapes).
WS_CLASS = "".join(f"\\u{ord(ch):04x}" for ch in WHITESPACE)


def utrim(c) -> Column:
    """Strip every Unicode whitespace character (tab, NBSP, ...) at both ends.

    A character-set ``trim`` (no regex) with the set Python's ``str.strip``
    uses."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def strip_tabs(c) -> Column:
    """Remove tab characters anywhere in the text (nothing put in their place)."""
    return F.translate(_c(c), "\t", "")


def collapse_ws(c) -> Column:
    """Collapse each run of Unicode whitespace into one space."""
    return F.regexp_replace(_c(c), f"[{WS_CLASS}]+", " ")


def title_case(c) -> Column:
    """Python-style title case: a letter is upper-cased when the character
    before it is not a letter (``o'brien's 3rd`` -> ``O'Brien'S 3Rd``)."""
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"(?U)(\p{L}+|\P{L}+)"), 1)
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
    return F.when(_c(c).isNull(), None).otherwise(F.array_join(cased, ""))


def recode(c, mapping: Mapping[str, str], keep: bool = True) -> Column:
    """Replace whole values through ``mapping``.

    ``keep=True`` leaves unmapped values as they are; ``keep=False`` turns
    them into NULL.  Values are looked up in a literal map expression.
    """
    if not mapping:
        return _c(c) if keep else F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, _c(c))
    return F.coalesce(hit, _c(c)) if keep else hit


def has_literal(c, literal: str) -> Column:
    """1 when the text contains ``literal``, else 0 (NULL text counts as no)."""
    return F.coalesce(_c(c).contains(literal), F.lit(False)).cast("int")


def has_any(c, literals: Iterable[str]) -> Column:
    """1 when the text contains any of ``literals`` (plain substrings)."""
    cond = None
    for lit in literals:
        e = _c(c).contains(lit)
        cond = e if cond is None else (cond | e)
    return F.coalesce(cond, F.lit(False)).cast("int")


# Narrative clean-up: the ordered replacements.  Code tokens are removed as
# case-sensitive substrings (no word edges), then parenthesised text, then
# stand-alone digit runs; other punctuation becomes a space.
NARRATIVE_STEPS = [
    (r"(?U)F\d{3,4}", ""),
    (r"(?U)T\d{2}", ""),
    (r"(?U)DIV\d+", ""),
    (r"(?U)CH\d+", ""),
    (r"(?U)ART\d+", ""),
    (r"\([^)]*\)", ""),
    (r"(?U)(?<!" + WORD + r")\d+(?!" + WORD + r")", ""),
    (r"(?U)[^\p{L}\p{N}_" + WS_CLASS + "]", " "),
    (r"\n+", " "),
    ("[" + WS_CLASS + "]+", " "),
]


def clean_text(c) -> Column:
    """Narrative clean-up; NULL becomes ''."""
    e = F.coalesce(_c(c), F.lit(""))
    for pattern, repl in NARRATIVE_STEPS:
        e = F.regexp_replace(e, pattern, repl)
    return F.lower(utrim(e))
