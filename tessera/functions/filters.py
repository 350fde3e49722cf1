"""Attribute and temporal filters as Spark columns.

Each leaf is ``cond AND operand IS NOT NULL``: false (never null) on a null
value, and ``~leaf`` is true for it, so two-valued logic holds leaf by leaf and
NOT works as a user expects.  Both conjuncts are plain source filters, so a leaf
reaches the Parquet or JDBC scan.  Compose with ``&``, ``|``, ``~`` or the n-ary
``all_of`` / ``any_of``.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import _c



def _guard(cond: Column, *operands: Column) -> Column:
    return reduce(lambda a, b: a & b.isNotNull(), operands, cond)


def _v(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, _dt.datetime) and x.tzinfo is None:
        return F.lit(x).cast("timestamp_ntz")
    return F.lit(x)


def prop(name: str) -> Column:
    return F.col(name)


# F01 ---------------------------------------------------------------------
def include() -> Column:
    return F.lit(True)


def exclude() -> Column:
    return F.lit(False)


# F02 / F03 -----------------------------------------------------------------
def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def not_(cond: Column) -> Column:
    return ~cond


# F04-F06 -------------------------------------------------------------------
_OPS = {"=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
        ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def _cmp(op: str, a, b, match_case: bool = True) -> Column:
    text = b if isinstance(b, str) else None
    a, b = (_c(a) if isinstance(a, str) else _v(a)), _v(b)
    plain = _OPS[op](a, b)
    if not match_case and op in ("=", "!="):
        # case folds only where a side is text; typeof() is a constant to the optimizer
        is_text = F.lit(True) if text is not None else (F.typeof(a) == "string") | (F.typeof(b) == "string")
        plain = F.when(is_text, _OPS[op](F.lower(a.cast("string")), F.lower(b.cast("string")))).otherwise(plain)
    if text is not None:
        # a text literal against a number column: as a number, or unequal to all numbers
        try:
            number = _OPS[op](a.try_cast("double"), F.lit(float(text)))
        except ValueError:
            number = F.lit(op == "!=")
        plain = F.when(F.typeof(a).rlike("^(tinyint|smallint|int|bigint|float|double|decimal)"), number).otherwise(plain)
    return _guard(plain, a, b)


def eq(a, b, match_case: bool = True) -> Column:
    return _cmp("=", a, b, match_case)


def ne(a, b, match_case: bool = True) -> Column:
    return _cmp("!=", a, b, match_case)


def lt(a, b) -> Column:
    return _cmp("<", a, b)


def le(a, b) -> Column:
    return _cmp("<=", a, b)


def gt(a, b) -> Column:
    return _cmp(">", a, b)


def ge(a, b) -> Column:
    return _cmp(">=", a, b)


# F07 ----------------------------------------------------------------------
def between(a, lo, hi) -> Column:
    return _between(a, lo, hi)


def _between(a, lo, hi) -> Column:
    a, lo, hi = _c(a), _v(lo), _v(hi)
    return _guard(a.between(lo, hi), a, lo, hi)


# F08 ----------------------------------------------------------------------
def like_to_sql(pattern: str, wild: str = "*", single: str = ".", escape: str = "!") -> str:
    """Translate a pattern with custom wildcard / single / escape characters
    into a SQL LIKE pattern that uses ``\\`` as its escape."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == escape and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
            continue
        if ch == wild:
            out.append("%")
        elif ch == single:
            out.append("_")
        elif ch in "%_\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def like(a, pattern: str, wild: str = "*", single: str = ".", escape: str = "!",
         match_case: bool = True, is_date: bool = False) -> Column:
    """PropertyIsLike; date columns are compared on their text with an implicit
    trailing wildcard."""
    col = _c(a)
    sql = like_to_sql(pattern, wild, single, escape)
    if is_date:
        col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        if not sql.endswith("%"):
            sql += "%"
    return _guard(col.like(sql) if match_case else col.ilike(sql), col)


# F09 ----------------------------------------------------------------------
def is_null(a) -> Column:
    return _c(a).isNull()


def is_nil(a) -> Column:
    raise NotImplementedError("PropertyIsNil is not supported; use is_null")


# F10 ----------------------------------------------------------------------
def id_filter(pk: str, fids: Iterable[Any], type_name: str | None = None, pk_type: str = "long") -> Column:
    """Feature-id set filter for a literal (small) set of ids; undecodable ids
    are dropped first.  Large id sets: use ``id_semi_join``."""
    vals = []
    for f in fids:
        s = str(f)
        if type_name and s.startswith(type_name + "."):
            s = s[len(type_name) + 1:]
        try:
            vals.append(int(s) if pk_type in ("long", "int", "bigint") else s)
        except ValueError:
            continue
    if not vals:
        return F.lit(False)
    return _guard(_c(pk).isin(vals), _c(pk))


def composite_id_filter(pks: Sequence[str], fids: Iterable[str], type_name: str | None = None,
                        pk_types: Sequence[str] | None = None) -> Column:
    """F10 for a composite key: fids ``<type>.<k1>.<k2>...``; ids with another
    number of parts or an undecodable part are dropped first."""
    pk_types = pk_types or ["string"] * len(pks)
    alts = []
    for f in fids:
        s = str(f)
        if type_name and s.startswith(type_name + "."):
            s = s[len(type_name) + 1:]
        parts = s.split(".")
        if len(parts) != len(pks):
            continue
        try:
            vals = [int(p) if t in ("long", "int", "bigint") else p for p, t in zip(parts, pk_types)]
        except ValueError:
            continue
        alts.append(all_of(*[_guard(_c(k) == F.lit(v), _c(k)) for k, v in zip(pks, vals)]))
    return any_of(*alts)


def id_semi_join(df: DataFrame, pk: str | Sequence[str], ids: DataFrame, id_col: str = "fid", type_name: str | None = None,
                 pk_type: str | Sequence[str] = "long") -> DataFrame:
    """Id filter for many ids held in a DataFrame, with a key of one or several columns: a left-semi join on all of them, so
    the id set is shuffled / broadcast by Spark instead of inlined in the plan.  Ids that do not decode are dropped."""
    from ..operators.projection import decode_fid as decode

    pks = [pk] if isinstance(pk, str) else list(pk)
    types = [pk_type] * len(pks) if isinstance(pk_type, str) else list(pk_type)
    dec = ids.select(decode(id_col, type_name or "", types, strict=False).alias("__pk")).where(F.col("__pk").isNotNull()).select(
        *[F.col("__pk")[f"pk{i}"].alias(f"__pk{i}") for i in range(len(pks))])
    return df.join(dec, [df[k] == dec[f"__pk{i}"] for i, k in enumerate(pks)], "left_semi")


# F12 / F13 -----------------------------------------------------------------
def arith(op: str, a, b) -> Column:
    a = _c(a) if isinstance(a, str) else _v(a)
    b = _c(b) if isinstance(b, str) else _v(b)
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b}[op]()


def call(name: str, *args) -> Column:
    """Whitelisted function call inside a filter (see scalar.FUNCTIONS)."""
    from .scalar import FUNCTIONS

    if name not in FUNCTIONS:
        raise ValueError(f"function {name!r} is not supported in filters")
    return FUNCTIONS[name](*args)


# temporal (F29-F34) ---------------------------------------------------------
Period = Sequence  # (start, end)


def _is_period(v) -> bool:
    return isinstance(v, (tuple, list)) and len(v) == 2


def after(a, t) -> Column:
    """After an instant; with a period, after its end (both ends satisfied)."""
    if _is_period(t):
        return gt(a, t[1])
    return gt(a, t)


def before(a, t) -> Column:
    if _is_period(t):
        return lt(a, t[0])
    return lt(a, t)


def swapped(name: str, t, a) -> Column:
    """A temporal filter whose literal stands first (``t AFTER a``): the mirrored operator on the
    column; a symmetric one stays itself."""
    table = {"after": before, "before": after, "during": tcontains, "tcontains": during, "tequals": tequals,
             "begins": begun_by, "begunby": begins, "ends": ended_by, "endedby": ends}
    return table[name.lower()](a, t)


def begins(a, period) -> Column:
    _need_period(period, "Begins")
    return _cmp("=", a, period[0])


def ends(a, period) -> Column:
    _need_period(period, "Ends")
    return _cmp("=", a, period[1])


def begun_by(a, period) -> Column:
    _need_period(period, "BegunBy")
    return _cmp("=", a, period[0])


def ended_by(a, period) -> Column:
    _need_period(period, "EndedBy")
    return _cmp("=", a, period[1])


def during(a, period) -> Column:
    _need_period(period, "During")
    return _between(a, period[0], period[1])


def tcontains(a, period) -> Column:
    _need_period(period, "TContains")
    return _between(a, period[0], period[1])


def tequals(a, t) -> Column:
    if _is_period(t):
        raise ValueError("TEquals takes an instant, not a period")
    return _cmp("=", a, t)


def t_after_col(a: str, b: str) -> Column:
    return _cmp(">", F.col(a), F.col(b))


def t_before_col(a: str, b: str) -> Column:
    return _cmp("<", F.col(a), F.col(b))


def t_equals_col(a: str, b: str) -> Column:
    return _cmp("=", F.col(a), F.col(b))


def _need_period(v, name):
    if not _is_period(v):
        raise ValueError(f"{name} needs a period (start, end)")


def unsupported_temporal(name: str):
    """AnyInteracts, Meets, MetBy, OverlappedBy, TOverlaps are declared by the
    reference but never encoded."""
    raise NotImplementedError(f"temporal operator {name} is not supported")
