"""Code-list and categorical functions (Column -> Column)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, utrim


def highest_priority(c, allowed: Sequence[str]) -> Column:
    """First token of ``allowed`` (in that order) present in a comma list.

    Tokens are trimmed and must match exactly; NULL text or no accepted token
    gives NULL.
    """
    order = F.array(*[F.lit(a) for a in allowed])
    toks = F.transform(F.split(_c(c), ","), lambda t: utrim(t))
    pos = F.filter(F.transform(toks, lambda t: F.array_position(order, t)), lambda p: p > 0)
    return F.try_element_at(order, F.array_min(pos).cast("int"))


def token_count(c, sep: str = ",") -> Column:
    """Number of pieces of a delimited list, empty pieces included; NULL -> 0."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.size(F.split(_c(c), re.escape(sep), -1)))


def effective_class(initial, final, appealed, not_appealed: str = "No") -> Column:
    """Initial class when the penalty was not appealed, else the final class
    (a missing appeal flag counts as appealed)."""
    return F.when(_c(appealed) == F.lit(not_appealed), _c(initial)).otherwise(_c(final))


# Accepted date layouts: (shape, pattern).  The shape test picks the one
# pattern to try, so a value is parsed once instead of failing through the
# list (a failed parse is expensive).  Pattern None: the ISO rules of a cast
# (unpadded parts, T, fractions).  Numbers are month, day, year unless the year
# comes first.
_CLOCK, _AMPM = r" \d{1,2}:\d{2}", r" \d{1,2}:\d{2}(:\d{2})? ?[AaPp][Mm]"
DATE_LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?Z?$", None),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}{_CLOCK}$", "M/d/yyyy H:mm"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}{_CLOCK}:\d{{2}}$", "M/d/yyyy H:mm:ss"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}{_AMPM}$", "M/d/yyyy h:mm[:ss] a"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}[- ][A-Za-z]{3}[- ]\d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}[- ][A-Za-z]{4,9}[- ]\d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", "MMMM d yyyy"),
)


_MONTH, _DAY, _YEAR = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])", r"\d{4}"

# Plain numbers are put in ISO order and cast: no formatter, and a month or day out of
# range costs no exception.  Of a pattern: (texts of its layout that can be a date, their ISO text).
_NUMBERS = {
    "M/d/yyyy": (rf"^{_MONTH}/{_DAY}/{_YEAR}\z", lambda t: F.concat(
        F.substring_index(t, "/", -1), F.lit("-"), F.translate(F.substring_index(t, "/", 2), "/", "-"))),
    "yyyyMMdd": (rf"^{_YEAR}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])\z", lambda t: F.concat(
        F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 2), F.lit("-"), F.substring(t, 7, 2))),
    "yyyy/M/d": (rf"^{_YEAR}/{_MONTH}/{_DAY}\z", lambda t: F.translate(t, "/", "-")),
}


def parse_date(c, layouts: Sequence[tuple[str, str]] = DATE_LAYOUTS) -> Column:
    """Parse text to a timestamp (no time zone); anything unparsable -> NULL.
    Outer white space is ignored; month names in any case, with or without a
    comma or hyphens; a final Z (universal time) is dropped; years of two digits
    are 1969 to 2068.

    The layouts are tried in a lambda, so the value is computed once however many
    layouts ask for it, and a projection of several dates stays a set of small
    functions: one large generated function would not be compiled by the JVM.
    Layouts with slashes are tried for texts with a slash only, the others for
    the other texts."""
    slashed = [x for x in layouts if x[1] and "/" in x[1]]
    others = [x for x in layouts if x not in slashed]
    value = F.trim(_c(c).cast("string"))
    if slashed and others:
        def read(t):
            return F.when(t.contains("/"), _by_layout(t, slashed)).otherwise(_by_layout(t, others))
    else:
        def read(t):
            return _by_layout(t, layouts)
    return F.try_element_at(F.transform(F.array(value), read), F.lit(1))


def _by_layout(text: Column, layouts: Sequence[tuple[str, str]]) -> Column:
    rules = []
    named = F.initcap(F.regexp_replace(F.regexp_replace(text, "[-,]", " "), " +", " "))
    century = F.regexp_replace(F.regexp_replace(text, r"/(\d{2})$", "/20$1"), r"/20(69|[789]\d)$", "/19$1")
    clock = F.regexp_replace(F.upper(text), r"(\d)([AP]M)$", "$1 $2")
    for shape, fmt in layouts:
        cond = text.rlike(shape)
        if fmt is None:
            val = F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz")
        elif fmt in _NUMBERS and (shape, fmt) in DATE_LAYOUTS and not shape.endswith(r"/\d{2}$"):
            possible, iso = _NUMBERS[fmt]
            rules.append((text.rlike(possible), iso(text).try_cast("timestamp_ntz")))
            val = F.lit(None).cast("timestamp_ntz")
        else:
            said = (named if "MMM" in fmt else clock if fmt.endswith("a")
                    else century if shape.endswith(r"/\d{2}$") else text)
            val = F.try_to_timestamp(said, F.lit(fmt)).cast("timestamp_ntz")
        rules.append((cond, val))
    return reduce(lambda e, rule: e.when(*rule), rules, F)


def yes_no_flag(c, yes: str = "Yes", no: str = "No") -> Column:
    """'Yes' -> 1, 'No' -> 0, anything else -> NULL."""
    return F.when(_c(c) == yes, 1).when(_c(c) == no, 0).cast("int")


def transition_category(label, removed: Sequence[str], dropped: str) -> Column:
    """Outcome class of a class transition: removed / dropped / other."""
    return (F.when(_c(label).isin(*removed), F.lit("removed"))
            .when(_c(label) == dropped, F.lit("dropped"))
            .otherwise(F.lit("other")))


def node_category(label, severe_markers: Sequence[str], removed: Sequence[str], dropped: str,
                  initial_suffix: str = "(Initial)") -> Column:
    """Node class of a flow-graph label (first rule that applies wins)."""
    severe = None
    for m in severe_markers:
        e = _c(label).contains(m)
        severe = e if severe is None else (severe | e)
    return (F.when(severe, F.lit("severe"))
            .when(_c(label).contains(initial_suffix), F.lit("initial"))
            .when(_c(label).isin(*removed), F.lit("removed"))
            .when(_c(label) == dropped, F.lit("dropped"))
            .otherwise(F.lit("other")))
