"""Row-level quality checks as predicates, and many of them in one scan.

Each function gives the condition under which a row FAILS (never NULL), so that
checks can be combined. :func:`run_checks` compiles any number of them into one
scan of the table: a bit per check and row, failing rows written once, and from
them the failing rows and the number of failures of every check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.session import scratch_table


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _sure(condition: Column) -> Column:
    """NULL counts as not failing."""
    return F.coalesce(condition, F.lit(False))


def is_null(col: str) -> Column:
    """L2"""
    return _q(col).isNull()


def outside_values(col: str, values: Sequence) -> Column:
    """L4: a non-NULL value outside the list."""
    return _sure(_q(col).isNotNull() & ~_q(col).isin(list(values)))


def is_blank(col: str) -> Column:
    """NULL or blank."""
    return _q(col).isNull() | _sure(F.trim(_q(col)) == "")


def not_true(expr: str | Column, null_fails: bool = True) -> Column:
    """The predicate is false (and, by default, NULL)."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return ~F.coalesce(e, F.lit(not null_fails))


def outside_range(col: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """A non-NULL value outside [min, max] (or the open interval)."""
    c = _q(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    return _sure(c.isNotNull() & ~ok)


def among_values(col: str, values: Sequence) -> Column:
    """A forbidden value."""
    return _sure(_q(col).isin(list(values)))


def any_of(*conditions: Column) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | _sure(c)
    return out


def several_words(cols: Sequence[str]) -> Column:
    """A name part with a space."""
    return any_of(*[_q(c).contains(" ") for c in cols])


def period_above(name_col: str, rank_col: str, allowed_ranks: Sequence[str]) -> Column:
    """A name with a period whose rank is not among the allowed ones."""
    return _sure(_q(name_col).contains(".") & (_q(rank_col).isNull() | ~_q(rank_col).isin(list(allowed_ranks))))


def has_digit(cols: Sequence[str]) -> Column:
    """L22"""
    return any_of(*[_q(c).rlike("[0-9]") for c in cols])


#: Bits used of a long.
_BITS = 63
_FAILED = "__failed"


@dataclass(frozen=True)
class CheckResults:
    """Failing rows of all checks, written once. ``counts``: a row (check,
    n_failures) for every check; ``rows(name)``: the failing rows of one."""

    names: tuple[str, ...]
    failing: DataFrame

    def _bit(self, i: int) -> Column:
        return F.col(_FAILED)[i // _BITS].bitwiseAND(F.lit(1 << (i % _BITS)).cast("long")) != 0

    def rows(self, name: str) -> DataFrame:
        return self.failing.where(self._bit(self.names.index(name))).drop(_FAILED)

    def labelled(self) -> DataFrame:
        """Every failing row once for each check that it fails, as column ``check``."""
        failed = F.array_compact(F.array(*[F.when(self._bit(i), F.lit(n)) for i, n in enumerate(self.names)]))
        return self.failing.withColumn("check", F.explode(failed)).drop(_FAILED)

    @property
    def counts(self) -> DataFrame:
        sums = self.failing.agg(F.array(*[F.count_if(self._bit(i)) for i in range(len(self.names))]).alias("n"))
        named = F.arrays_zip(F.array(*map(F.lit, self.names)).alias("check"), F.col("n"))
        return sums.select(F.explode(named).alias("c")).select(F.col("c.check").alias("check"), F.col("c.n").alias("n_failures"))


def run_checks(df: DataFrame, checks: Mapping[str, Column], keep: Sequence[str] | None = None) -> CheckResults:
    """Run row checks (name -> failing condition) in one scan of ``df``. Failing
    rows keep the columns ``keep`` (default all): a row's identity is enough, and
    a table that fails throughout is then not copied."""
    names = tuple(checks)
    words = []
    for at in range(0, len(names), _BITS):
        word = F.lit(0).cast("long")
        for i, n in enumerate(names[at : at + _BITS]):
            word = word.bitwiseOR(F.when(checks[n], F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        words.append(word)
    flagged = df.select(*[_q(c) for c in (keep or df.columns)], F.array(*words).alias(_FAILED))
    return CheckResults(names, scratch_table(flagged.where(F.exists(_FAILED, lambda w: w != 0)), "checks"))
