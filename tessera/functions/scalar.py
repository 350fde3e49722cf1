"""Scalar functions usable in filters and projections.

All map onto built-in Spark expressions, so they stay inside whole-stage
codegen.  String positions follow the reference: 0-based, half-open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import _c


def _a(x) -> Column:
    return _c(x) if isinstance(x, (str, Column)) else F.lit(x)


def str_concat(a, b) -> Column:                       # X01
    return F.concat(_a(a), _a(b))


def str_ends_with(s, suffix) -> Column:               # X02
    return _a(s).endswith(_a(suffix))


def str_starts_with(s, prefix) -> Column:             # X03
    return _a(s).startswith(_a(prefix))


def str_equals_ignore_case(a, b) -> Column:           # X04
    return F.lower(_a(a)) == F.lower(_a(b))


def str_index_of(s, sub) -> Column:                   # X05: 0-based, -1 if missing
    return F.position(_a(sub), _a(s)) - 1


def str_length(s) -> Column:                          # X06
    return F.char_length(_a(s))


def str_to_lower(s) -> Column:                        # X07
    return F.lower(_a(s))


def str_to_upper(s) -> Column:                        # X08
    return F.upper(_a(s))


def str_replace(s, pattern: str, replacement: str, all_: bool = True) -> Column:   # X09
    if all_:
        return F.regexp_replace(_a(s), pattern, replacement)
    return _replace_first(_a(s), pattern, replacement)


def _replace_first(s: Column, pattern: str, replacement: str) -> Column:
    pos = F.regexp_instr(s, F.lit(pattern))
    matched = F.regexp_extract(s, pattern, 0)
    head = F.substring(s, 1, pos - 1)
    tail = s.substr(pos + F.length(matched), F.lit(1 << 30))
    return F.when(pos > 0, F.concat(head, F.regexp_replace(matched, pattern, replacement), tail)).otherwise(s)


def str_substring(s, begin, end) -> Column:           # X10: [begin, end)
    b, e = _a(begin), _a(end)
    return _a(s).substr(b + 1, e - b)


def str_substring_start(s, begin) -> Column:          # X11
    return _a(s).substr(_a(begin) + 1, F.lit(1 << 30))


def str_trim(s, mode: str = "both", chars: str | None = None) -> Column:   # X12
    c = _a(s)
    if chars is None:
        return {"both": F.trim, "leading": F.ltrim, "trailing": F.rtrim}[mode](c)
    return {"both": F.btrim, "leading": F.ltrim, "trailing": F.rtrim}[mode](c, F.lit(chars))


def abs_(x) -> Column:                                # X13
    return F.abs(_a(x))


def ceil_(x) -> Column:                               # X14
    return F.ceil(_a(x))


def floor_(x) -> Column:                              # X15
    return F.floor(_a(x))


def hour_bucket(ts) -> Column:                        # X16: yyyyMMddHH
    return F.date_format(_a(ts), "yyyyMMddHH")


def hours_between(t1, t2, inclusive_ends: bool = True) -> Column:   # X17
    """Hour buckets touched by [t1, t2].  The reference lists only the hours
    strictly between the ends (and so loses both end hours); by default we
    include them, ``inclusive_ends=False`` reproduces the reference."""
    a, b = F.date_trunc("hour", _a(t1)), F.date_trunc("hour", _a(t2))
    seq = F.sequence(a, b, F.expr("interval 1 hour"))
    seq = F.transform(seq, lambda t: F.date_format(t, "yyyyMMddHH"))
    if inclusive_ends:
        return seq
    return F.slice(seq, 2, F.greatest(F.size(seq) - 2, F.lit(0)))


# Whitelist for function calls inside filters (F13), by reference name.
FUNCTIONS = {
    "strConcat": str_concat, "strEndsWith": str_ends_with, "strStartsWith": str_starts_with,
    "strEqualsIgnoreCase": str_equals_ignore_case, "strIndexOf": str_index_of, "strLength": str_length,
    "strToLowerCase": str_to_lower, "strToUpperCase": str_to_upper, "strReplace": str_replace,
    "strSubstring": str_substring, "strSubstringStart": str_substring_start, "strTrim": str_trim, "strTrim2": str_trim,
    "abs": abs_, "abs_2": abs_, "abs_3": abs_, "abs_4": abs_, "ceil": ceil_, "floor": floor_,
}
