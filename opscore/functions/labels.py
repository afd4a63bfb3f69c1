"""CASE-style business labels and weights, as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arith import safe_div

# Queue names and the weights the scorecard gives them.
FULL_WEIGHT_QUEUES = ("Cancelamento/remarcação", "Remarcação ")  # trailing space is part of the name
QUEUE_WEIGHT_OTHER = 0.7
INTERACTION_DISCOUNT = {1: 1.0, 2: 0.5}
INTERACTION_DISCOUNT_OTHER = 0.1
LIGHT_RECONTACT_QUEUES = ("Cancelamento/remarcação", "Pendências Reembolso")
LIGHT_RECONTACT_WEIGHT = 0.3
NIGHT_STARTS = ("00:00:00", "01:00:00")
OFFICE_START, OFFICE_END = "06:00:00", "15:00:00"
AREA_RENAMES = {"Atendimento Primário": "Relacionamento Primário",
                "Atendimento Especializado": "Relacionamento Especializado"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def queue_weight(fila) -> Column:
    """1 for the two rebooking queues (exact text), else (NULL too) 0.7."""
    return F.when(_col(fila).isin(*FULL_WEIGHT_QUEUES), F.lit(1.0)).otherwise(
        F.lit(QUEUE_WEIGHT_OTHER))


def interaction_discount(n) -> Column:
    """1 contact -> 1, 2 -> 0.5, anything else or NULL -> 0.1."""
    c = _col(n)
    expr = None
    for k, w in INTERACTION_DISCOUNT.items():
        expr = F.when(c == k, F.lit(w)) if expr is None else expr.when(c == k, F.lit(w))
    return expr.otherwise(F.lit(INTERACTION_DISCOUNT_OTHER))


def shift_class(start, end) -> Column:
    """'madrugada' for night starts, 'comercial' for 06:00-15:00, else 'dia'."""
    s, e = _col(start), _col(end)
    return (F.when(s.isin(*NIGHT_STARTS), F.lit("madrugada"))
            .when((s == OFFICE_START) & (e == OFFICE_END), F.lit("comercial"))
            .otherwise(F.lit("dia")))


def percent_guard(p) -> Column:
    """Display guard: a ratio above 1 is shown as 0.

    A NaN is above nothing (as in the warehouse; Spark orders it above all
    numbers), so it is shown as it is.
    """
    c = _col(p)
    return F.when((c > 1) & ~F.isnan(c), F.lit(0.0)).otherwise(c)


def area_rename(area) -> Column:
    c = _col(area)
    expr = None
    for old, new in AREA_RENAMES.items():
        expr = F.when(c == old, F.lit(new)) if expr is None else expr.when(c == old, F.lit(new))
    return expr.otherwise(c)


def refund_kind(money_id, miles_id) -> Column:
    """Only the money refund -> 'Convencional'; only miles -> 'Outros'; else 'Mesclado'."""
    m, mi = _col(money_id), _col(miles_id)
    return (F.when(m.isNotNull() & mi.isNull(), F.lit("Convencional"))
            .when(mi.isNotNull() & m.isNull(), F.lit("Outros"))
            .otherwise(F.lit("Mesclado")))


def account_kind(account_type) -> Column:
    """1 -> 'Corrente'; anything else, NULL included -> 'Poupança'."""
    return F.when(_col(account_type) == 1, F.lit("Corrente")).otherwise(F.lit("Poupança"))


def recontact_weight(fila) -> Column:
    """0.3 for the two light queues, else 1."""
    return F.when(_col(fila).isin(*LIGHT_RECONTACT_QUEUES), F.lit(LIGHT_RECONTACT_WEIGHT)).otherwise(
        F.lit(1.0))


def recontact_ratio(recontacts, resolved) -> Column:
    """recontacts / resolved capped at 1; no resolved count -> 1.

    A NaN ratio (0 / 0) counts as above the cap, the way IEEE-ordering
    engines compare NaN.  A NULL recontact count stays NULL.
    """
    rec, res = _col(recontacts), _col(resolved)
    raw = F.when(res.isNull(), F.lit(1.0)).otherwise(safe_div(rec, res))
    return F.when(F.isnan(raw) | (raw > 1), F.lit(1.0)).otherwise(raw)
