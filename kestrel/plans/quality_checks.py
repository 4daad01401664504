"""The declared data tests of the reporting chain (DQ-01..DQ-05), as data.

``source:<Name>`` checks apply to source tables; the rest to models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import Check, run_checks, union_all
from ..session import ensure_checkpoint_dir
from .registry import Build


def _nn_u(model: str, col: str) -> list[Check]:
    return [Check(model, "not_null", (col,)), Check(model, "unique", (col,))]


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, "not_null", (c,)) for c in cols]


def _acc(model: str, col: str, *values: str) -> Check:
    return Check(model, "accepted_values", (col,), tuple(values))


def _combo(model: str, *cols: str) -> Check:
    return Check(model, "unique_combination", tuple(cols))


CHECKS: list[Check] = [
    # sources
    *_nn_u("source:Business", "id"), *_nn_u("source:Lead", "id"),
    Check("source:Lead", "not_null", ("businessId",), severity="warn"),
    *_nn_u("source:Policy", "id"), *_nn_u("source:Quote", "id"), *_nn_u("source:ApplicationSubmission", "id"),
    *_nn_u("source:User", "id"), *_nn_u("source:User", "email"), *_nn_u("source:PolicyTransaction", "id"),
    *_nn_u("source:Carrier", "id"), *_nn_u("source:WarmTransfer", "id"),
    *_nn_u("source:EmployeeContactInformation", "id"), Check("source:EmployeeContactInformation", "unique", ("name",)),
    *_nn_u("source:License", "name"), *_nn_u("source:RingbaCallLog", "id"), *_nn_u("source:RingbaCallEvent", "id"),
    # staging
    *_nn_u("stg_business", "business_id"), _acc("stg_business", "campaign_type", "Test", "Prod"),
    *_nn("stg_business", "created_at"),
    *_nn_u("stg_user", "user_id"), *_nn("stg_user", "email"),
    *_nn_u("stg_lead", "lead_id"),
    *_nn_u("stg_policy", "policy_id"), *_nn("stg_policy", "business_id", "sale_type"),
    *_nn_u("stg_policy_transaction", "policy_transaction_id"),
    *_nn_u("stg_quote", "quote_id"),
    *_nn_u("stg_carrier", "carrier_id"), _acc("stg_carrier", "carrier_group", "Chubb", "GAIG", "Other"),
    *_nn_u("stg_application_submission", "application_submission_id"),
    *_nn_u("stg_opportunity", "opportunity_id"),
    *_nn_u("stg_opportunity_status_history", "opportunity_status_history_id"),
    _acc("stg_opportunity_status_history", "change_type", "STATUS", "ASSIGNEE", "CONFIDENCE"),
    *_nn_u("stg_business_close_status_change", "change_log_id"),
    *_nn("stg_business_close_status_change", "business_id"),
    *_nn_u("stg_warm_transfer", "warm_transfer_id"),
    *_nn_u("stg_campaign_status", "campaign_status_id"),
    *_nn_u("stg_employee_contact_information", "employee_id"),
    Check("stg_employee_contact_information", "unique", ("employee_name",)),
    *_nn_u("stg_license", "license_name"),
    _acc("stg_license", "transfer_type", "Warm Transfer", "Data Lead", "Other Non-Partner", "Partner"),
    *_nn_u("stg_business_classification", "business_classification_id"),
    *_nn_u("stg_partner", "partner_id"),
    *_nn_u("stg_ringba_call", "ringba_call_id"), *_nn("stg_ringba_call", "call_date"),
    *_nn_u("stg_ringba_call_event", "ringba_call_event_id"), *_nn("stg_ringba_call_event", "ringba_call_id"),
    *_nn_u("stg_policy_status_change", "change_log_id"), *_nn("stg_policy_status_change", "policy_id"),
    # intermediate
    *_nn_u("int_business", "business_id"), _acc("int_business", "claimed_status", "OTHER", "CLAIMED", "UNCLAIMED"),
    *_nn_u("int_policy_revenue", "policy_id"),
    *_nn_u("int_warm_transfer", "warm_transfer_id"), *_nn("int_warm_transfer", "partner_name"),
    _acc("int_warm_transfer", "partner_resolved_from", "campaign", "business", "payload", "unknown"),
    *_nn_u("int_ringba_call", "ringba_call_id"), *_nn("int_ringba_call", "partner_name"),
    _combo("int_ringba_call_ae", "ringba_call_id", "account_executive"), *_nn("int_ringba_call_ae", "account_executive"),
    *_nn_u("int_nb_revenue_transaction", "policy_transaction_id"),
    _acc("int_nb_revenue_transaction", "revenue_bucket", "COMMISSION", "TECH_FEE", "ENDORSEMENT", "CANCELLATION"),
    *_nn_u("int_ae_sales_policy", "policy_id"), *_nn("int_ae_sales_policy", "is_ae_sales_policy"),
    # marts
    *_nn("business_funnel_daily", "activity_date", "license_name"),
    *_nn("ae_performance_monthly", "activity_month", "account_executive"),
    *_nn("policy_revenue_summary", "bound_month"),
    _combo("wt_tracker_daily", "business_created_date", "license_name", "claimed_status", "warm_transfer_campaign",
           "credited_account_executive", "workflow_type"),
    *_nn("wt_tracker_daily", "business_created_date"),
    *_nn("wt_pings_daily", "ping_date", "partner_name"),
    *_nn_u("dim_date", "date_day"),
    _combo("nb_sales_daily", "activity_date", "same_month_sale", "license_name", "account_executive"),
    *_nn("nb_sales_daily", "activity_date"),
    _combo("ringba_calls_daily", "call_date", "partner_name", "campaign_name"), *_nn("ringba_calls_daily", "call_date"),
    _combo("ringba_ae_calls_daily", "call_date", "account_executive", "partner_name"),
]


def frame(b: Build, name: str) -> DataFrame:
    return b.source(name.split(":", 1)[1]) if name.startswith("source:") else b.ref(name)


def model_checks(b: Build, checks: list[Check] | None = None, cut_shared: bool = True) -> DataFrame:
    """Run the declared checks over the build (published tables when pinned).

    With ``cut_shared``, each intermediate model (read by several marts) is
    computed once and checkpointed to the shared ``spark.checkpoint.dir``, so
    the marts' checks read it instead of recomputing the chain; the lineage
    is cut there as well. Then one model is checked after the other, and its
    few result rows are kept there too: as one query, the plan of all models and
    every table they broadcast would be in the driver's memory at once."""
    checks = checks or CHECKS
    if cut_shared:
        ensure_checkpoint_dir(b.spark)
        for name in ("int_business", "int_policy_revenue", "int_nb_revenue_transaction", "int_ae_sales_policy",
                     "int_ringba_call", "int_ringba_call_ae", "int_warm_transfer"):
            b.pin(name, b.ref(name).checkpoint(eager=True))
    frames = {ck.model: frame(b, ck.model) for ck in checks}
    if not cut_shared:
        return run_checks(frames, checks)
    return union_all([run_checks({name: df}, [ck for ck in checks if ck.model == name]).checkpoint(eager=True)
                      for name, df in frames.items()])
