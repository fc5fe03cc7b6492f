"""Payment responses: the latest one per claim, and a flat typed view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from slotline.functions.json_text import parse_payment
from slotline.functions.text import flag, whole_number

def latest_payment(payments: DataFrame) -> DataFrame:
    """The response with the greatest ``created_at`` per claim; a NULL time wins.

    Spark keeps one row per claim in every map task before it shuffles, so a
    claim with very many responses sends at most one row per task.  Equal times
    are settled by the document text, to give the same row on every run.
    """
    newest = Window.partitionBy("claim_id").orderBy(
        F.col("created_at").desc_nulls_first(), F.col("payment_response_json").desc()
    )
    return payments.withColumn("rank", F.row_number().over(newest)).where("rank = 1").drop("rank")


def responses_of(payments: DataFrame, claims: DataFrame) -> DataFrame:
    """Only the responses of ``claims``: those of a day are few against the history."""
    return payments.join(claims.select(F.col("id").alias("claim_id")), "claim_id", "left_semi")


def latest_payment_lateral(claims: DataFrame, payments: DataFrame) -> DataFrame:
    """The same top-one per claim, written as a lateral subquery."""
    return claims.sparkSession.sql(
        """
        SELECT c.id, p.created_at, p.payment_response_json
        FROM {claims} c
        LEFT JOIN LATERAL (
            SELECT r.created_at, r.payment_response_json
            FROM {payments} r
            WHERE r.claim_id = c.id
            ORDER BY r.created_at DESC NULLS FIRST, r.payment_response_json DESC
            LIMIT 1
        ) p ON TRUE
        """,
        claims=claims,
        payments=payments,
    )


def parsed_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "claim_id", "created_at", parse_payment(F.col("payment_response_json")).alias("payment")
    )


def payment_flat(payments: DataFrame) -> DataFrame:
    """One typed column per payment value; bad numbers and flags become NULL."""
    rate = lambda key: F.col(f"payment.{key}").try_cast("decimal(10,5)")
    text = lambda check, key: F.col(f"payment.{check}.{key}")
    money = lambda check, key: text(check, key).try_cast("decimal(9,2)")
    return parsed_payments(payments).select(
        "claim_id",
        rate("interestRate").alias("interest_rate"),
        whole_number(F.col("payment.interestDaysOver")).alias("interest_days_over"),
        text("beneCheck", "checkNumber").alias("bene_exchk_num"),
        text("beneCheck", "checkStatus").alias("bene_chk_status"),
        money("beneCheck", "claimAmount").alias("bene_check_amt"),
        text("beneCheck", "beneHicNumber").alias("hic"),
        text("beneCheck", "checkIssueDate").alias("bene_status_date"),
        text("beneCheck", "checkStatusDate").alias("bene_last_updt_dt"),
        money("beneCheck", "claimInterestAmount").alias("bene_int_amt"),
        money("beneCheck", "claimRecoupmentAmount").alias("bene_offset"),
        flag(text("beneCheck", "couldNotBeForwarded")).alias("bene_dnf_flg"),
        text("beneCheck", "higlasClaimCheckNumber").alias("bene_ext_eob"),
        text("providerCheck", "checkNumber").alias("prov_exchk_num"),
        text("providerCheck", "checkStatus").alias("prov_chk_status"),
        money("providerCheck", "claimAmount").alias("prov_check_amt"),
        text("providerCheck", "checkStatusDate").alias("prov_last_updt_dt"),
        text("providerCheck", "checkIssueDate").alias("prov_status_date"),
        money("providerCheck", "claimInterestAmount").alias("prov_int_amt"),
        money("providerCheck", "claimRecoupmentAmount").alias("prov_offset"),
        flag(text("providerCheck", "couldNotBeForwarded")).alias("prov_dnf_flg"),
        text("providerCheck", "higlasClaimCheckNumber").alias("prov_ext_eob"),
    )
