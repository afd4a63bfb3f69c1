"""The logical input tables as DuckDB SQL over the driver tables.

Same mapping as ``opscore.sources.driver_tables`` (FIXTURES.md section B),
written independently in SQL so the oracle does not share code with the
Spark side.  ``with_views`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

import re

# The target sheet of FIXTURES.md, kept apart from the Spark side's copy.
# Six thresholds per row (alerta, bronze, prata, ouro, 1, 2); the points are the same for all.
LEVELS = ("alerta", "bronze", "prata", "ouro", "1", "2")
POINTS = (0.0, 20.0, 40.0, 60.0, 80.0, 100.0)
TARGET_SHEET = [
    ("Resolutividade", " Individual ", "Primario", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), POINTS),
    ("Produtividade", "individual", "PRIMARIO", (5.0, 15.0, 25.0, 35.0, 45.0, 60.0), POINTS),
    ("Produtividade_madrugada", "individual", "PRIMARIO", (4.0, 12.0, 20.0, 28.0, 36.0, 48.0), POINTS),
    ("Produtividade_comercial", "individual", "PRIMARIO", (6.0, 18.0, 30.0, 42.0, 54.0, 66.0), POINTS),
    ("Ciclo 10 dias", "Coletivo", "PRIMARIO", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), POINTS),
    ("Conhecimento Corporativo", "coletivo", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), POINTS),
    ("Conhecimento Corporativo", "individual", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), POINTS),
    ("DTO", "coletivo", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), POINTS),
    ("DTO", " Individual ", "primario", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), POINTS),
    ("CSAT", "individual", "PRIMARIO", (1.0, 1.5, 2.0, 3.0, 4.0, 5.0), POINTS),
    ("Recorrencia", "individual", "PRIMARIO", (0.5, 0.4, 0.3, 0.2, 0.1, 0.05), POINTS),
]
_NSUP = "(SELECT count(*) FROM supplier)"


def _targets_values() -> str:
    rows = []
    for ind, tipo, orig, m, p in TARGET_SHEET:
        nums = ", ".join(repr(float(x)) for x in (*m, *p))
        rows.append(f"('{ind}', '{tipo}', '{orig}', {nums})")
    return ",\n        ".join(rows)


_BAND_COLS = [f"{k}_{lv}" for k in ("m", "p") for lv in LEVELS]

VIEWS: dict[str, str] = {
    "searches": """
        SELECT o_orderkey AS id, concat('N', CAST(c_nationkey AS VARCHAR)) AS iata_from,
               o_orderpriority AS iata_to, o_orderstatus AS external_user,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
                    THEN 'ExternalSearch' ELSE 'Site' END AS browser_id,
               o_orderdate AS created_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "orders_booked": """
        SELECT o_orderkey AS id, o_orderkey AS fk_search_id, o_orderdate AS created_at,
               CASE o_orderstatus WHEN 'F' THEN 56 WHEN 'O' THEN 60 ELSE 1 END AS last_status
        FROM orders""",
    "order_tracking": """
        SELECT l_orderkey AS fk_order_id, l_shipdate AS created_at,
               CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'N' THEN 'O' ELSE 'P' END AS source
        FROM lineitem""",
    "cancelled_flights": """
        SELECT o_orderkey AS id, o_custkey AS order_id, o_totalprice AS total_refund,
               CASE WHEN o_orderstatus IN ('F', 'P') AND o_orderkey % 10 <> 0
                    THEN o_orderkey END AS refund_order_id,
               CASE WHEN o_orderstatus IN ('O', 'P') AND o_orderkey % 10 <> 0
                    THEN o_orderkey END AS refund_order_miles_id,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS reason_id,
               o_orderdate AS created_at
        FROM orders""",
    "refund_items": """
        SELECT l_orderkey AS cancellation_flight_id, l_extendedprice AS total_refund
        FROM lineitem WHERE l_returnflag = 'R'""",
    "cancellations": """
        SELECT o_orderkey AS id, o_orderkey AS cancellable_id,
               concat('agent_', CAST(o_custkey % 50 AS VARCHAR)) AS created_name
        FROM orders""",
    "refund_bank_data": """
        SELECT o_orderkey AS cancellation_id, CAST(o_custkey % 30 AS INT) AS code_bank,
               '0001' AS agency, CAST(o_custkey AS VARCHAR) AS account_number,
               CASE o_orderkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS account_type,
               'Holder' AS cardholder_name, '000' AS cardholder_document,
               o_orderkey % 4 <> 0 AS is_active
        FROM orders WHERE o_orderkey % 5 <> 0""",
    "banks": "SELECT n_nationkey AS code_bank, n_name AS short_name FROM nation",
    "flight_logs": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS cancellation_flight_id,
               max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END)
                   AS cancellation_flight_status_id,
               max(l_shipdate) AS created_original_at
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "flight_statuses": """
        SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS id,
               concat('status_', l_returnflag) AS description
        FROM lineitem""",
    "cancel_reasons": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS id,
               o_orderpriority AS description
        FROM orders""",
    "refund_reports": """
        SELECT o_orderkey AS id, o_orderstatus AS status FROM orders
        WHERE o_orderstatus <> 'O'""",
    "refund_extra": """
        SELECT o_orderkey AS id, o_orderstatus AS status FROM orders
        WHERE o_orderstatus <> 'F'""",
    "trip_searches": """
        SELECT event_id AS id, ts AS created_at, user_id % 20 AS destination_id,
               CAST(ts AS DATE) + CAST(event_id % 40 AS INT) AS checkin,
               user_id AS fk_purchase_searchs_id
        FROM events""",
    "purchase_searches": "SELECT c_custkey AS id, c_mktsegment AS ap FROM customer",
    "months": f"""
        SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS ref
        FROM orders""",
    "roster": """
        SELECT s_suppkey AS matricula, ref AS mes_referencia,
               CASE WHEN s_suppkey % 5 = 0 THEN 'Chat' WHEN s_suppkey % 5 = 1 THEN 'e-mail'
                    ELSE 'E-MAIL' END AS funcao,
               CASE extra WHEN 0 THEN 'Relacionamento Primário'
                    ELSE 'RELACIONAMENTO PRIMÁRIO' END AS area,
               CASE (s_suppkey + extra) % 3 WHEN 0 THEN '00:00:00' WHEN 1 THEN '06:00:00'
                    ELSE '08:00:00' END AS horario_inicio,
               CASE (s_suppkey + extra) % 3 WHEN 0 THEN '06:00:00' WHEN 1 THEN '15:00:00'
                    ELSE '17:00:00' END AS horario_fim,
               'PRIMARIO' AS origem, 'individual' AS tipo,
               s_nationkey AS matricula_supervisor,
               concat('S', CAST(s_nationkey AS VARCHAR)) AS supervisor,
               s_nationkey % 5 AS matricula_coordenador,
               concat('C', CAST(s_nationkey % 5 AS VARCHAR)) AS coordenador,
               1 AS matricula_gerente, 'G1' AS gerente
        FROM supplier CROSS JOIN months JOIN (VALUES (0), (1)) AS e(extra)
          ON extra = 0 OR (s_suppkey % 11 = 2 AND month(ref) % 2 = 0)""",
    "targets": f"""
        SELECT months.ref, t.indicador, t.tipo, t.origem,
               {", ".join(f"CAST(t.{c} AS DOUBLE) AS {c}" for c in _BAND_COLS)}
        FROM months CROSS JOIN (VALUES
        {_targets_values()}
        ) AS t(indicador, tipo, origem, {", ".join(_BAND_COLS)})""",
    "resolutions": f"""
        SELECT CAST(l_shipdate AS DATE) AS data_resolucao, l_suppkey AS matricula,
               CASE WHEN l_linenumber < 7 THEN l_linenumber END AS quantidade_interacoes,
               l_quantity AS quantidade_incidentes,
               CASE l_returnflag WHEN 'A' THEN 'Cancelamento/remarcação'
                    WHEN 'N' THEN 'Remarcação ' ELSE 'Pendências Reembolso' END AS fila,
               CASE WHEN l_linestatus = 'O' THEN 'x' END AS atendente
        FROM lineitem""",
    "recontacts": f"""
        SELECT l_shipdate AS data_ultima_criacao,
               l_shipdate + INTERVAL '2' DAY AS data_respondido_cliente,
               l_suppkey AS matricula,
               CASE l_returnflag WHEN 'A' THEN 'Cancelamento/remarcação' WHEN 'N' THEN 'Pacote'
                    ELSE 'Pendências Reembolso' END AS fila,
               'Relacionamento Primário' AS area
        FROM lineitem WHERE l_linenumber >= 5""",
    "absences": f"""
        SELECT CAST(o_orderdate AS DATE) AS data_ref, o_custkey % {_NSUP} AS matricula,
               'Nome' AS nome_colaborador, 'PRIMARIO' AS origem,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS falta_injustificada,
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS faltas_justificadas,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS faltas_outros
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "contact_calendar": "SELECT o_orderdate AS created FROM orders",
    "cycle_positions": f"""
        SELECT CAST(l_shipdate AS DATE) AS data_posicao,
               CASE WHEN l_linestatus = 'O' THEN 'Atendimento Primário'
                    ELSE 'Atendimento Especializado' END AS area,
               CASE l_returnflag WHEN 'A' THEN 'Hotel' WHEN 'N' THEN 'Aéreo' END AS fila,
               CASE WHEN l_quantity = l_linenumber - 1 THEN 0
                    ELSE least(l_linenumber, CAST(l_quantity AS INT)) END
                   AS qtde_respondido_dentro_prazo,
               CAST(l_quantity AS INT) AS qtde_total,
               l_linenumber - 1 AS qtde_nao_respondido_fora_prazo_resolvido
        FROM lineitem""",
    "monthly_grades": """
        SELECT year(ref) AS ano_ref, month(ref) AS mes_ref, s_suppkey AS matricula,
               CAST((s_suppkey * 7 + month(ref) * 3) % 50 AS DOUBLE) / 10 + 5
                   AS nota_conhecimento,
               CASE WHEN s_suppkey % 7 = 0 THEN NULL
                    ELSE CAST((s_suppkey * 11 + month(ref)) % 50 AS DOUBLE) / 10 + 5 END
                   AS nota_dto
        FROM supplier CROSS JOIN months WHERE (s_suppkey + month(ref)) % 4 <> 0""",
    "collective_extras": """
        SELECT year(ref) AS ano_ref, month(ref) AS mes_ref,
               CAST(month(ref) AS DOUBLE) AS reclamacoes, CAST(5 AS DOUBLE) AS p_reclamacoes,
               CAST(70 AS DOUBLE) AS nps, CAST(10 AS DOUBLE) AS p_nps,
               CAST(3 AS DOUBLE) AS redes_sociais, CAST(2 AS DOUBLE) AS p_redes_sociais
        FROM months WHERE month(ref) <> 6""",
    "losses": f"""
        SELECT CAST(o_orderdate AS DATE) AS data_ref,
               o_custkey % {_NSUP} AS solicitante_matricula,
               CAST(o_totalprice / 30 AS VARCHAR) AS reembolso_valor_prejuizo
        FROM orders WHERE o_orderstatus = 'P'""",
    "csat_answers": f"""
        SELECT CAST(o_orderdate AS DATE) AS data_das_respostas,
               CAST(o_custkey % {_NSUP} AS VARCHAR) AS matricula,
               CAST(o_orderkey % 6 AS DOUBLE) AS media_
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
}

_DEPS = {"roster": ["months"], "targets": ["months"], "monthly_grades": ["months"],
         "collective_extras": ["months"]}


def _needed(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    order: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPS.get(name, []):
            add(dep)
        if name not in order:
            order.append(name)

    for name in VIEWS:
        if name in words:
            add(name)
    return order


def with_views(body: str) -> str:
    """Prefix ``body`` (a SELECT, optionally starting with WITH) with the
    view CTEs it references."""
    names = _needed(body)
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in names)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"
