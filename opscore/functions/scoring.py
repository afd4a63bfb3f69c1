"""Target-band scoring.

A target row carries six thresholds ``m_<level>`` and six point values
``p_<level>`` over the levels alerta, bronze, prata, ouro, 1, 2.  A measured
value scores by linear interpolation inside the band it falls into.

The expressions are generated as SQL text and parsed once (``F.expr``): a
band score is a ~40-node CASE tree, and building it node by node through
the Python API costs thousands of driver round trips per call.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arith import safe_div_sql

LEVELS = ("alerta", "bronze", "prata", "ouro", "1", "2")


@dataclass(frozen=True)
class Bands:
    """Threshold and point columns of one target row (``prefix`` for aliases)."""

    prefix: str = ""

    def m(self, i: int) -> str:
        return f"`{self.prefix}m_{LEVELS[i]}`"

    def p(self, i: int) -> str:
        return f"`{self.prefix}p_{LEVELS[i]}`"

    def columns(self) -> list[str]:
        return [f"{k}_{lv}" for k in ("m", "p") for lv in LEVELS]


def _interp(v: str, b: Bands, lo: int, hi: int) -> str:
    # (v - m_lo) / (m_hi - m_lo) * (p_hi - p_lo) + p_lo, in that order
    return (f"{safe_div_sql(f'{v} - {b.m(lo)}', f'{b.m(hi)} - {b.m(lo)}')}"
            f" * ({b.p(hi)} - {b.p(lo)}) + {b.p(lo)}")


def band_score_sql(v: str, bands: Bands = Bands(), direction: str = "up",
                   above: str = "cap", null_policy: str = "top") -> str:
    """SQL text of :func:`band_score` for a SQL operand ``v``."""
    v = f"CAST(({v}) AS DOUBLE)"
    if direction == "up":
        arms = " ".join(f"WHEN {v} < {bands.m(k)} THEN {_interp(v, bands, k - 1, k)}"
                        for k in range(1, 6))
        if above == "cap":
            tail = f"ELSE {bands.p(5)}"
        elif above == "extrapolate":
            tail = (f"WHEN {v} > {bands.m(5)} AND NOT isnan({v}) THEN ({v} - {bands.m(5)}) * "
                    f"{safe_div_sql(bands.p(5), bands.m(5))} + {bands.p(5)}")
        else:
            raise ValueError(f"above={above!r}")
        expr = f"CASE {arms} {tail} END"
    elif direction == "down":
        arms = " ".join(f"WHEN {v} > {bands.m(k)} THEN {_interp(v, bands, k - 1, k)}"
                        for k in range(1, 6))
        arms = f"WHEN isnan({v}) THEN {bands.p(5)} {arms}"
        expr = (f"CASE WHEN {v} > {bands.m(0)} AND NOT isnan({v}) THEN CAST(0 AS DOUBLE) "
                f"ELSE CASE {arms} ELSE {bands.p(5)} END END")
    else:
        raise ValueError(f"direction={direction!r}")
    expr = f"CAST(({expr}) AS DOUBLE)"
    if null_policy == "null":
        return f"(CASE WHEN {v} IS NOT NULL THEN {expr} END)"
    if null_policy != "top":
        raise ValueError(f"null_policy={null_policy!r}")
    return expr


def band_score(v, bands: Bands = Bands(), direction: str = "up",
               above: str = "cap", null_policy: str = "top") -> Column:
    """Score ``v`` (a column name or SQL expression text) against the bands
    of the current row.

    direction='up' (higher is better): the first level k (bronze..2) with
    ``v < m_k`` interpolates between k-1 and k; below ``m_alerta`` the first
    band is extrapolated.  Past ``m_2``:
      above='cap'         -> p_2
      above='extrapolate' -> (v - m_2) * (p_2 / m_2) + p_2 for v > m_2;
                             v == m_2 gives NULL (no band claims it)
    direction='down' (lower is better): v > m_alerta scores 0, then the first
    level k with ``v > m_k`` interpolates, else p_2.

    NaN is neither above nor below a threshold (Spark alone would order it
    above all numbers): it goes to the last arm, p_2 for 'cap' and 'down',
    NULL for 'extrapolate'.

    null_policy='top' keeps the warehouse behaviour where a NULL value falls
    through every test to the last arm (p_2 for 'cap'/'down', NULL for
    'extrapolate'); 'null' returns NULL for a NULL value.
    """
    if isinstance(v, Column):
        raise TypeError("band_score takes a column name or SQL text; add the value as a "
                        "column first")
    operand = f"`{v}`" if v.isidentifier() else v
    return F.expr(band_score_sql(operand, bands, direction, above, null_policy))


def imputed_band_score(v: str, bands: Bands = Bands(), gap: float = 0.2,
                       ndigits: int = 2) -> tuple[Column, Column]:
    """Missing values take ``m_ouro - gap``; value and score are rounded.

    ``v`` is a column name.  Returns (value, score) columns.
    """
    filled = f"round(coalesce(CAST(`{v}` AS DOUBLE), {bands.m(3)} - CAST({gap!r} AS DOUBLE)), {ndigits})"
    score = f"round({band_score_sql(filled, bands)}, {ndigits})"
    return F.expr(filled), F.expr(score)


# Loss-penalty steps (upper bound of the rounded amount, points).
PENALTY_STEPS = [(1000, -5), (1800, -10), (2600, -15), (5000, -20), (10000, -30)]
PENALTY_ABOVE = -50


def step_penalty(amount: Column) -> Column:
    """Points lost for one loss: steps on the amount rounded to units; NULL -> NULL."""
    r = F.round(amount.cast("double"), 0)
    bound, pts = PENALTY_STEPS[0]
    expr = F.when(r <= bound, F.lit(pts))
    for bound, pts in PENALTY_STEPS[1:]:
        expr = expr.when(r <= bound, F.lit(pts))
    return expr.when(r > PENALTY_STEPS[-1][0], F.lit(PENALTY_ABOVE))
