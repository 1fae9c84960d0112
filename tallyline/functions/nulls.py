"""Three-valued logic helpers.

The statistical language the ballot rules were written for treats a missing
value differently from SQL in a handful of places; each helper states its rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is never null: a null is simply not a member."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Negated membership that keeps null rows (plain ``NOT IN`` would lose them)."""
    return ~is_in(c, values)


def holds(condition: Column) -> Column:
    """True only where the condition is known to be true."""
    return F.coalesce(condition, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    """Disjunction of many conditions as a balanced tree, so it nests shallowly."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def if_else(condition: Column, yes, no) -> Column:
    """Vector if-else: an unknown condition gives null, not the else branch."""
    return F.when(condition, yes).when(~condition, no)


def replace_where(c: Column | str, condition: Column, value) -> Column:
    """Overwrite where the condition is known to be true; keep everything else."""
    return F.when(condition, value).otherwise(col(c))


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First rule whose condition is true wins; a null condition never matches."""
    ladder: Column | None = None
    for condition, value in rules:
        ladder = F.when(condition, value) if ladder is None else ladder.when(condition, value)
    if ladder is None:
        return F.lit(default) if not isinstance(default, Column) else default
    return ladder if default is None else ladder.otherwise(default)


def recode(c: Column | str, mapping: dict, keep_unmatched: bool = True) -> Column:
    """Value recode; unmatched values stay, or become null."""
    pairs = [part for key, value in mapping.items() for part in (F.lit(key), F.lit(value))]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return F.coalesce(found, col(c)) if keep_unmatched else found


def lookup(c: Column | str, mapping: dict) -> Column:
    """Named-vector lookup: value for the key, null where there is none."""
    return recode(c, mapping, keep_unmatched=False)


def all_true(condition: Column) -> Column:
    """Aggregate: every row known to be true (one unknown or false row spoils it)."""
    return F.bool_and(holds(condition))


def any_true(condition: Column) -> Column:
    """Aggregate: at least one row known to be true."""
    return F.bool_or(holds(condition))


def all3(condition: Column) -> Column:
    """Aggregate ``all`` in three-valued logic: false beats unknown beats true."""
    some_false = F.bool_or(holds(~condition))
    some_null = F.bool_or(condition.isNull())
    return F.when(some_false, F.lit(False)).when(~some_null, F.lit(True))


def any3(condition: Column) -> Column:
    """Aggregate ``any`` in three-valued logic: true beats unknown beats false."""
    some_true = F.bool_or(holds(condition))
    some_null = F.bool_or(condition.isNull())
    return F.when(some_true, F.lit(True)).when(~some_null, F.lit(False))


def strict_sum(c: Column | str) -> Column:
    """Aggregate sum that is null as soon as one value is null."""
    return F.when(F.count(col(c)) == F.count(F.lit(1)), F.sum(col(c)))


def sum0(c: Column | str) -> Column:
    """Aggregate sum over known values; 0 when there is none."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating ratio; a zero denominator gives null instead of an error."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def number(c: Column | str, kind: str = "int") -> Column:
    """Cast that yields null for text which is not a number."""
    return col(c).try_cast(kind)
