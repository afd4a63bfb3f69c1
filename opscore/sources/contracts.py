"""Input contracts of the logical tables the queries read.

Each table is a ``StructType``.  ``conform`` selects the contract columns in
order and casts them (day columns become DATE, text ids stay text), so every
plan downstream can rely on names and types.  Timestamps are TIMESTAMP_NTZ:
the analytics compare wall-clock days, never instants.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_DT, _TS, _B = T.DateType(), T.TimestampNTZType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_BANDS = [(f"{k}_{lvl}", _D) for k in ("m", "p")
          for lvl in ("alerta", "bronze", "prata", "ouro", "1", "2")]

CONTRACTS: dict[str, T.StructType] = {
    # agent scorecard inputs
    "resolutions": _struct(("data_resolucao", _DT), ("matricula", _L),
                           ("quantidade_interacoes", _I), ("quantidade_incidentes", _D),
                           ("fila", _S), ("atendente", _S)),
    "roster": _struct(("matricula", _L), ("mes_referencia", _DT), ("funcao", _S),
                      ("area", _S), ("horario_inicio", _S), ("horario_fim", _S),
                      ("origem", _S), ("tipo", _S), ("matricula_supervisor", _L),
                      ("supervisor", _S), ("matricula_coordenador", _L),
                      ("coordenador", _S), ("matricula_gerente", _L), ("gerente", _S)),
    "targets": _struct(("ref", _DT), ("indicador", _S), ("tipo", _S), ("origem", _S),
                       *_BANDS),
    "recontacts": _struct(("data_ultima_criacao", _TS), ("data_respondido_cliente", _TS),
                          ("matricula", _L), ("fila", _S), ("area", _S)),
    "absences": _struct(("data_ref", _DT), ("matricula", _L), ("nome_colaborador", _S),
                        ("origem", _S), ("falta_injustificada", _I),
                        ("faltas_justificadas", _I), ("faltas_outros", _I)),
    "contact_calendar": _struct(("created", _TS)),
    "cycle_positions": _struct(("data_posicao", _DT), ("area", _S), ("fila", _S),
                               ("qtde_respondido_dentro_prazo", _I), ("qtde_total", _I),
                               ("qtde_nao_respondido_fora_prazo_resolvido", _I)),
    "monthly_grades": _struct(("ano_ref", _I), ("mes_ref", _I), ("matricula", _L),
                              ("nota_conhecimento", _D), ("nota_dto", _D)),
    "collective_extras": _struct(("ano_ref", _I), ("mes_ref", _I), ("reclamacoes", _D),
                                 ("p_reclamacoes", _D), ("nps", _D), ("p_nps", _D),
                                 ("redes_sociais", _D), ("p_redes_sociais", _D)),
    "losses": _struct(("data_ref", _DT), ("solicitante_matricula", _L),
                      ("reembolso_valor_prejuizo", _S)),
    "csat_answers": _struct(("data_das_respostas", _DT), ("matricula", _S), ("media_", _D)),
    # route demand inputs
    "order_tracking": _struct(("fk_order_id", _L), ("created_at", _TS), ("source", _S)),
    "searches": _struct(("id", _L), ("iata_from", _S), ("iata_to", _S),
                        ("external_user", _S), ("browser_id", _S), ("created_at", _TS)),
    "orders_booked": _struct(("id", _L), ("fk_search_id", _L), ("created_at", _TS),
                             ("last_status", _I)),
    # refund inputs
    "cancelled_flights": _struct(("id", _L), ("order_id", _L), ("total_refund", _D),
                                 ("refund_order_id", _L), ("refund_order_miles_id", _L),
                                 ("reason_id", _I), ("created_at", _TS)),
    "refund_items": _struct(("cancellation_flight_id", _L), ("total_refund", _D)),
    "cancellations": _struct(("id", _L), ("cancellable_id", _L), ("created_name", _S)),
    "refund_bank_data": _struct(("cancellation_id", _L), ("code_bank", _I), ("agency", _S),
                                ("account_number", _S), ("account_type", _I),
                                ("cardholder_name", _S), ("cardholder_document", _S),
                                ("is_active", _B)),
    "banks": _struct(("code_bank", _I), ("short_name", _S)),
    "flight_logs": _struct(("id", _L), ("cancellation_flight_id", _L),
                           ("cancellation_flight_status_id", _I),
                           ("created_original_at", _TS)),
    "flight_statuses": _struct(("id", _I), ("description", _S)),
    "cancel_reasons": _struct(("id", _I), ("description", _S)),
    "refund_reports": _struct(("id", _L), ("status", _S)),
    "refund_extra": _struct(("id", _L), ("status", _S)),
    # search dashboard inputs
    "trip_searches": _struct(("id", _L), ("created_at", _TS), ("destination_id", _L),
                             ("checkin", _DT), ("fk_purchase_searchs_id", _L)),
    "purchase_searches": _struct(("id", _L), ("ap", _S)),
}


class ContractError(ValueError):
    """A table is missing a contract column."""


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the contract columns of ``name`` in order, cast to contract types.

    Casting is a projection, so Catalyst still prunes the scan to the
    columns used downstream.
    """
    schema = CONTRACTS[name]
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ContractError(f"{name}: missing columns {missing}")
    exprs = []
    for f in schema.fields:
        src = f"`{f.name}`"
        if isinstance(f.dataType, T.DateType):
            exprs.append(f"to_date({src}) AS {src}")
        else:
            exprs.append(f"CAST({src} AS {f.dataType.simpleString()}) AS {src}")
    return df.selectExpr(*exprs)


@dataclass(frozen=True)
class ContractReport:
    """What a checked read saw: rows, and by column the NULLs and the values that the contract type cannot
    hold (they became NULL).  ``distinct_keys`` is an estimate (about 1 %), NULL keys left out."""

    rows: int
    nulls: dict[str, int]
    unparsable: dict[str, int]
    distinct_keys: int | None

    @property
    def repeated_keys(self) -> int | None:
        """About how many rows repeat the key of another one; differences within the estimate's error count as none."""
        if self.distinct_keys is None:
            return None
        extra = self.rows - self.distinct_keys
        return extra if extra > 0.03 * self.rows else 0

    @property
    def clean(self) -> bool:
        return not any(self.unparsable.values()) and not self.repeated_keys


class CheckedRead:
    """A table under its contract whose first full evaluation also counts what is wrong with it."""

    def __init__(self, rows: DataFrame, observed: Observation, columns: list[str], keyed: bool):
        self.rows, self._observed, self._columns, self._keyed = rows, observed, columns, keyed

    def report(self) -> ContractReport:
        """The counts, once an action has read ``rows`` (waits for one)."""
        seen = self._observed.get
        return ContractReport(seen["rows"], {c: seen[f"null_{i}"] for i, c in enumerate(self._columns)},
                              {c: seen[f"bad_{i}"] for i, c in enumerate(self._columns)},
                              seen["keys"] if self._keyed else None)


def conform_checked(df: DataFrame, name: str, keys: list[str] | None = None) -> CheckedRead:
    """``conform`` for data that may not fit: a value that cannot be cast becomes NULL instead of failing the job.

    NULLs, such values and distinct ``keys`` are counted by observed metrics of the very scan that the caller's action
    runs, so there is no second read.  All contract columns are read, as all are checked: prefer ``conform`` where
    the data is known to fit.
    """
    schema = CONTRACTS[name]
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ContractError(f"{name}: missing columns {missing}")
    columns = [f.name for f in schema.fields]
    both = df.selectExpr(*[f"`{c}` AS _in_{i}" for i, c in enumerate(columns)],
                         *[f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        counts += [F.count_if(F.col(f"_in_{i}").isNull()).alias(f"null_{i}"),
                   F.count_if(F.col(f"_in_{i}").isNotNull() & F.col(c).isNull()).alias(f"bad_{i}")]
    if keys:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        counts.append(F.approx_count_distinct(F.when(whole, F.xxhash64(*keys)), 0.01).alias("keys"))
    observed = Observation()
    return CheckedRead(both.observe(observed, *counts).select(*columns), observed, columns, bool(keys))
