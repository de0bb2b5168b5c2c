"""Shares, changes, rates and other measures derived from counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_pct(votes: Column, total: Column) -> Column:
    """Votes as % of total: 0 when there are no votes, null when the total is 0."""
    return F.when(votes == 0, F.lit(0.0)).otherwise(F.try_divide(votes, total) * 100)


def baseline_share_pct(votes: Column, total: Column) -> Column:
    """Share of an earlier result, with the thousandths-then-tenth order of operations."""
    return F.try_divide(votes, total) * 1000 / 10


def diff_pp(share: Column, base: Column, guard: bool = True) -> Column:
    """Change in percentage points; guarded: 0 where the present share is 0."""
    change = share - base
    return F.when(share == 0, F.lit(0.0)).otherwise(change) if guard else change


def turnout_pct(voters: Column, eligible: Column) -> Column:
    return F.try_divide(voters, eligible) * 100


def invalid_pct(invalid: Column, voters: Column) -> Column:
    return F.try_divide(invalid, voters) * 100


def invalid_pct_from_valid(valid: Column, voters: Column) -> Column:
    return F.lit(100.0) - F.try_divide(valid, voters) * 100


def density(population: Column, area: Column) -> Column:
    return F.try_divide(population, area)


def progress_pct(counted: Column, total: Column) -> Column:
    """Whole percent counted, rounded down."""
    return F.floor(F.try_divide(counted, total) * 100)


def is_complete(counted: Column, total: Column) -> Column:
    return counted == total


def clamp_to(value: Column, limit: Column) -> Column:
    """``value`` but at most ``limit``; null when either is null."""
    return F.when(value > limit, limit).when(value <= limit, value)


def project_count(count: Column, factor: Column | float) -> Column:
    """Scale a count by a factor and round down."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.floor(count * factor)


def runner_up(votes: Column, pct: Column, margin: Column) -> dict[str, Column]:
    """Valid votes and the second place, from winner votes, winner % and margin."""
    valid = F.try_divide(votes, pct) * 100
    second = votes - margin
    return {
        "gueltig": valid,
        "zweiter_stimmen": second,
        "zweiter_prozent": F.try_divide(second, valid) * 100,
    }
