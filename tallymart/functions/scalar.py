"""Column builders: decode, flag, number, band, key and share expressions.

Each takes column names or ``Column`` objects and returns a ``Column`` made of
built-in functions, so a whole cleaning step stays inside one generated stage.
Parsing never raises: text that does not fit its type becomes NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

MONEY = T.DecimalType(14, 2)


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_of(dtype: T.DataType | str) -> Column:
    """A NULL of the given type."""
    return F.lit(None).cast(dtype)


# --- codes and flags -------------------------------------------------------


def decode(code: ColumnLike, entries: Mapping[str, object], trim: bool = False) -> Column:
    """Look a code up in a small code list; an unknown or NULL code gives NULL.

    The list is folded into one literal map. Use ``operators.joins.lookup_left``
    for lists that do not belong in a plan. Codes match exactly as written
    unless ``trim`` is set.
    """
    keys = F.array(*[F.lit(k) for k in entries])
    values = F.array(*[F.lit(v) for v in entries.values()])
    text = _col(code).cast("string")
    return F.try_element_at(F.map_from_arrays(keys, values), F.trim(text) if trim else text)


def label_to_id(label: ColumnLike, entries: Mapping[str, str]) -> Column:
    """The inverse of ``decode``: a label back to its numeric code."""
    return decode(label, {name: int(code) for code, name in entries.items()})


def yes_no(code: ColumnLike, yes: str = "1", no: str = "2", trim: bool = False) -> Column:
    """TRUE for the yes code, FALSE for the no code, NULL for anything else."""
    text = _col(code).cast("string")
    return decode(text, {yes: True, no: False}, trim)


def is_code(code: ColumnLike, wanted: str) -> Column:
    """Three-valued test of one code: NULL stays NULL."""
    return _col(code) == F.lit(wanted)


def any_true(flags: Sequence[ColumnLike]) -> Column:
    """TRUE when some flag is TRUE; a NULL flag counts as FALSE."""
    return reduce(Column.__or__, [F.coalesce(_col(f), F.lit(False)) for f in flags])


def any_false(flags: Sequence[ColumnLike]) -> Column:
    """TRUE when some flag is FALSE; a NULL flag counts as TRUE (not lacking)."""
    return ~reduce(Column.__and__, [F.coalesce(_col(f), F.lit(True)) for f in flags])


def flag_measure(flag: ColumnLike) -> Column:
    """A flag as an additive 0/1 measure; NULL counts 0."""
    return F.coalesce(_col(flag).cast("int"), F.lit(0))


# --- numbers ---------------------------------------------------------------


def lenient_int(text: ColumnLike) -> Column:
    """Text to int: blanks around it are ignored, a fraction is cut off.

    Only digits with an optional sign and fraction count ('1e3' does not). The
    text is cut at the point, so '7.9999999' is 7.
    """
    cell = F.trim(_col(text).cast("string"))
    number = cell.rlike("^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$")
    whole = F.regexp_replace(F.substring_index(cell, ".", 1), "^[+-]?$", "0")
    return F.when(number, whole.try_cast("int"))


def _dotted(text: ColumnLike) -> Column:
    return F.replace(_col(text).cast("string"), F.lit(","), F.lit("."))


def comma_double(text: ColumnLike) -> Column:
    """'2072,536' to 2072.536; two commas do not make a number."""
    return _dotted(text).try_cast("double")


def comma_money(text: ColumnLike) -> Column:
    """Comma decimal to decimal(14,2), rounded half up; too large gives NULL."""
    return _dotted(text).try_cast(MONEY)


def money_or_zero(amount: ColumnLike) -> Column:
    """A missing amount counts as 0.00."""
    return F.coalesce(_col(amount), F.lit(0).cast(MONEY))


def millions(amount: ColumnLike) -> Column:
    """An amount in millions, two decimals."""
    return F.round(_col(amount) / F.lit(1_000_000), 2)


def share_pct(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part`` in percent of ``whole``, two decimals; NULL when whole is 0."""
    return F.round(F.try_divide(_col(part) * F.lit(100.0), _col(whole)), 2)


def band(
    value: ColumnLike,
    edges: Sequence[tuple[int, str]],
    top: str,
    null_label: str | None = None,
) -> Column:
    """The label of the first edge above the value, else ``top``.

    A NULL value has no band. ``null_label`` names one for it.
    """
    v = _col(value)
    ladder = F.when(v.isNull(), F.lit(null_label).cast("string"))
    for upper, label in edges:
        ladder = ladder.when(v < upper, label)
    return ladder.otherwise(top)


# --- time and keys ---------------------------------------------------------


def decade(year: ColumnLike) -> Column:
    """1997 to '1990s'."""
    return F.concat(F.left(_col(year).cast("string"), F.lit(3)), F.lit("0s"))


def surrogate_key(columns: Sequence[ColumnLike], wide: bool = False) -> Column:
    """A key computed from the natural key, the same in every run.

    Fixed format: the key text joins the parts with '||' and writes 'NULL' for
    a missing part; the key is the first 60 bits of its SHA-256 as a bigint. At
    10^9 keys about 0.4 collisions are to be expected, so nothing in this
    package removes rows by it. ``wide`` gives a full digest as hex instead, of
    parts with their lengths, so that different keys have different texts.
    """
    if wide:
        texts = [_col(c).cast("string") for c in columns]
        sized = [F.nvl(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
        return F.sha2(F.concat_ws("|", *sized), 256)
    parts = [F.nvl(_col(c).cast("string"), F.lit("NULL")) for c in columns]
    digest = F.sha2(F.concat_ws("||", *parts), 256)
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")
