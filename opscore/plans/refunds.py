"""Refund ledger (one row per refunded flight with bank, status and totals)
and the union of refund statuses from two report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import account_kind, refund_kind
from ..operators.joins import latest_per_key, split_left_join
from ..operators.setops import union_all


def newest_log_per_flight(logs: DataFrame) -> DataFrame:
    """Newest log per flight by created_original_at; equal times -> highest id."""
    return latest_per_key(
        logs, ["cancellation_flight_id"], ["created_original_at", "id"],
        ["id", "cancellation_flight_status_id", "created_original_at"])


def refund_item_total(flights: DataFrame, items: DataFrame) -> DataFrame:
    """Sum of item refunds per flight; NULL for a flight without items."""
    sums = items.groupBy("cancellation_flight_id").agg(F.sum("total_refund").alias("valor_estorno"))
    f = flights.select("id")
    return f.join(sums, f["id"] == sums["cancellation_flight_id"], "left").select(
        "id", "valor_estorno")


def refund_ledger(flights: DataFrame, cancellations: DataFrame, bank_data: DataFrame,
                  banks: DataFrame, logs: DataFrame, statuses: DataFrame,
                  reasons: DataFrame, items: DataFrame) -> DataFrame:
    """One row per refunded flight with its bank data, newest status and totals.

    Flights meet their cancellation (inner), the active bank row of the
    cancellation (left), the bank name (left), the newest log of the flight
    (inner, ``max_by`` per flight), its status and the reason (inner) and
    the sum of item refunds (left, NULL without items); then DISTINCT.
    """
    base = flights.join(cancellations, flights["id"] == cancellations["cancellable_id"]).select(
        flights["id"].alias("flight_id"), "order_id", "total_refund", "refund_order_id",
        "refund_order_miles_id", "reason_id", flights["created_at"].alias("flight_created_at"),
        cancellations["id"].alias("cancellation_key"), "created_name")
    bank = bank_data.filter(F.col("is_active") == F.lit(True)).select(
        F.col("cancellation_id").alias("cancellation_key"), "code_bank", "agency",
        "account_number", "account_type", "cardholder_name", "cardholder_document")
    # a cancellation may have very many bank rows: its part of the join is split
    j = split_left_join(base, bank, ["cancellation_key"])
    b = banks.select(F.col("code_bank").alias("_bank_code"), "short_name")
    j = j.join(b, j["code_bank"] == b["_bank_code"], "left")
    newest = newest_log_per_flight(logs).select(
        F.col("cancellation_flight_id").alias("_log_flight"),
        F.col("cancellation_flight_status_id").alias("_log_status"), "created_original_at")
    j = j.join(newest, j["flight_id"] == newest["_log_flight"])
    st = statuses.select(F.col("id").alias("_status_id"), F.col("description").alias("STATUSOR"))
    j = j.join(st, j["_log_status"] == st["_status_id"])
    rs = reasons.select(F.col("id").alias("_reason_id"), F.col("description").alias("MOTIVO"))
    j = j.join(rs, j["reason_id"] == rs["_reason_id"])
    sums = (items.groupBy(F.col("cancellation_flight_id").alias("_item_flight"))
            .agg(F.sum("total_refund").alias("VALORESTORNO")))
    j = j.join(sums, j["flight_id"] == sums["_item_flight"], "left")
    return j.select(
        F.col("order_id").alias("ID"), F.col("short_name").alias("BANCO"),
        F.col("code_bank").alias("NUMERO"), F.col("agency").alias("AGEN"),
        F.col("account_number").alias("CONTA"),
        account_kind(F.col("account_type")).alias("CORRENTEPOUPANCA"),
        F.col("cardholder_name").alias("NOMECOMPLETO"),
        F.col("cardholder_document").alias("CPFCNPJ"), "VALORESTORNO",
        F.col("total_refund").alias("VALOR"), F.col("refund_order_id").alias("ORConvencional"),
        F.col("refund_order_miles_id").alias("ORMilhas"),
        refund_kind(F.col("refund_order_id"), F.col("refund_order_miles_id"))
        .alias("TIPOEDEESTORNO"),
        "STATUSOR", F.col("created_name").alias("AGENTE"), "MOTIVO",
        F.col("created_original_at").alias("DATAULTIMAATUALIZACAO"),
        F.col("flight_created_at").alias("DATACRIACAOOR"),
    ).distinct()


def refund_status_union(reports: DataFrame, extra: DataFrame) -> DataFrame:
    """UNION ALL of (id, status) from both refund report tables."""
    return union_all(reports.select("id", "status"), extra.select("id", "status"))
