"""Bands, rounding and limit arithmetic."""
from pyspark.sql import Column, functions as F


def half_even(c: Column, digits: int = 0) -> Column:
    """Round half to even on the scaled binary value, as numpy does."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def _literal(v) -> str:
    if isinstance(v, float):
        return f"{v!r}D"
    return f"'{v}'" if isinstance(v, str) else str(v)


def band(column: str, rows, closed: str = "left") -> Column:
    """Value of the band that holds the column; null outside all bands.

    ``rows`` are (low, high, value); ``None`` leaves a side open. ``closed``
    names the side that belongs to a band: "left", "right" or "both". A band
    table becomes one CASE expression.
    """
    above, below = (">=" if closed in ("left", "both") else ">"), ("<=" if closed in ("right", "both") else "<")
    cases = []
    for low, high, value in rows:
        tests = [f"`{column}` is not null"]
        tests += [f"`{column}` {above} {_literal(low)}"] if low is not None else []
        tests += [f"`{column}` {below} {_literal(high)}"] if high is not None else []
        cases.append(f"when {' and '.join(tests)} then {_literal(value)}")
    return F.expr(f"case {' '.join(cases)} end")


def matrix(first: str, second: str, cells: dict, default) -> Column:
    """Value of the cell named by two columns."""
    cases = [f"when `{first}` = {_literal(a)} and `{second}` = {_literal(b)} then {_literal(v)}" for (a, b), v in cells.items()]
    return F.expr(f"case {' '.join(cases)} else {_literal(default)} end")


def round_up(c: Column, step: int = 100) -> Column:
    return (F.ceil(c / F.lit(float(step))) * step).cast("double")


def clamp_limit(c: Column, floor: float, cap: float) -> Column:
    """Below the product minimum is no limit at all; above the cap is the cap."""
    return F.when(c < floor, F.lit(0.0)).when(c > cap, F.lit(float(cap))).otherwise(c)


def sum_of(*columns: Column) -> Column:
    """Row-wise sum with nulls as zero."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0))
    return total


def positive_part(c: Column) -> Column:
    return F.when(c > 0, c).otherwise(F.lit(0))


def change_direction(old: Column, new: Column, down: str, up: str) -> Column:
    return F.when(old > new, F.lit(down)).when(old < new, F.lit(up))
