"""Intermediate models (INT-01..INT-07): business logic at a clean grain.

Scale notes
-----------
* Every per-business rollup is an aggregation (partial + final), never a
  window, so a business holding a third of all rows is combined map-side
  before its shuffle.
* A fact joined to its dimension on a hot key (one policy or business with a
  third of the ledger) is split at run time by AQE's skew-join handling
  (``spark.sql.adaptive.forceOptimizeSkewedJoin``): the skewed partition is
  cut into several tasks and the one matching dimension partition is
  replicated; the aggregation above then gets its own map-side-combined
  shuffle.
* Dimensions carry no broadcast hint: the planner broadcasts one only when
  its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and
  shuffle-joins it otherwise (``Build.dim``).
* Ledger-level models join one per-policy context table (policy + carrier +
  business + owner) once, instead of shuffling the ledger once per dimension.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import (
    contains_any_upper, days_between, distinct_from, flag, seconds_between, trunc_date, within_days,
)
from ..operators import asof_both, latest_by, left_join_spread_nulls
from .registry import Build, model

c = F.col


def _carriers(b: Build):
    return b.dim("stg_carrier", "carrier_id", "carrier_group", "is_test_carrier")


def _business_dates(b: Build):
    return b.ref("stg_business").select("business_id", c("created_date").alias("business_created_date"))


def _sum_if(cond: Column, x: str) -> Column:
    return F.sum(F.when(cond, c(x)))


def _min_if(cond: Column, x: str) -> Column:
    return F.min(F.when(cond, c(x)))


# ---------------------------------------------------------------------------
# int_business stages (INT-01a .. INT-01j)
# ---------------------------------------------------------------------------

@model("int_business_lead", "intermediate", deps=("stg_lead",))
def int_business_lead(b: Build):
    """INT-01a: latest lead per business (Postgres DESC puts NULL times first)."""
    lead = b.ref("stg_lead").where(c("business_id").isNotNull())
    latest = latest_by(lead, ["business_id"], [c("created_at").isNull(), "created_at", "lead_id"],
                       ["lead_id", "account_executive", "workflow_type_assigned", "made_contact", "is_junk",
                        "score", "created_at", "expiry_time"])
    return latest.select(
        "business_id", "lead_id",
        c("account_executive").alias("lead_account_executive"),
        c("workflow_type_assigned"), "made_contact", "is_junk",
        c("score").alias("lead_score"),
        c("created_at").alias("lead_created_at"),
        c("expiry_time").alias("lead_expiry_time"),
    )


@model("int_business_warm_transfer", "intermediate", deps=("stg_warm_transfer",))
def int_business_warm_transfer(b: Build):
    """INT-01b: per business: count, bid sum, first ping, latest ping's attributes."""
    wt = b.ref("stg_warm_transfer").where(c("business_id").isNotNull())
    latest = F.max_by(F.struct("claimed_status", "status", "campaign_status_id"),
                      F.struct(c("created_at").isNull(), "created_at", "warm_transfer_id"))
    return wt.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("warm_transfer_count"),
        F.sum("bid_price").alias("warm_transfer_bid_price"),
        F.min("created_at").alias("first_warm_transfer_at"),
        latest.alias("__l"),
    ).select(
        "business_id", "warm_transfer_count", "warm_transfer_bid_price", "first_warm_transfer_at",
        c("__l.claimed_status").alias("warm_transfer_claimed_status"),
        c("__l.status").alias("warm_transfer_status"),
        c("__l.campaign_status_id").alias("warm_transfer_campaign_status_id"),
    )


def _policy_context(b: Build):
    """One row per policy of a real carrier and an existing business, with its
    carrier group and the business's creation date. The policy rollup
    aggregates it; the ledger joins it once on policy_id, so at scale the
    ledger is shuffled once (by policy) rather than once per dimension."""
    pol = b.ref("stg_policy").select("policy_id", "business_id", "carrier_id", "created_at", "created_date",
                                     "premium", "is_active", "is_new_business")
    return (pol.join(_carriers(b), "carrier_id").where(~c("is_test_carrier"))
               .join(_business_dates(b), "business_id"))


@model("int_business_policy_rollup", "intermediate", deps=("stg_policy", "stg_carrier", "stg_business"))
def int_business_policy_rollup(b: Build):
    """INT-01c: policy counts, premium and first-bind times (all / NB / Chubb / GAIG)."""
    p = _policy_context(b)
    nb = c("is_new_business")
    d30 = days_between("created_date", "business_created_date") <= 30
    chubb, gaig = c("carrier_group") == "Chubb", c("carrier_group") == "GAIG"
    return p.groupBy("business_id").agg(
        F.min("created_at").alias("first_policy_created_at"),
        F.count(F.lit(1)).alias("policy_count"),
        F.sum("premium").alias("total_premium"),
        F.count_if(c("is_active")).alias("active_policy_count"),
        _sum_if(c("is_active"), "premium").alias("active_premium"),
        _min_if(nb, "created_at").alias("first_nb_policy_created_at"),
        F.count_if(nb).alias("nb_policy_count"),
        _sum_if(nb, "premium").alias("nb_premium"),
        _sum_if(nb & d30, "premium").alias("d30_nb_premium"),
        _min_if(nb & chubb, "created_at").alias("first_nb_chubb_policy_created_at"),
        _sum_if(nb & chubb, "premium").alias("nb_chubb_premium"),
        _sum_if(nb & chubb & d30, "premium").alias("d30_nb_chubb_premium"),
        _min_if(nb & gaig, "created_at").alias("first_nb_gaig_policy_created_at"),
        _sum_if(nb & gaig, "premium").alias("nb_gaig_premium"),
        _sum_if(nb & gaig & d30, "premium").alias("d30_nb_gaig_premium"),
    )


@model("int_business_quote_rollup", "intermediate", deps=("stg_quote", "stg_carrier"))
def int_business_quote_rollup(b: Build):
    """INT-01d: quote counts, quoted premium and first-quote times."""
    q = (b.ref("stg_quote").select("business_id", "carrier_id", "created_at", "quoted_premium")
         .where(c("business_id").isNotNull())
         .join(_carriers(b), "carrier_id").where(~c("is_test_carrier")))
    chubb, gaig = c("carrier_group") == "Chubb", c("carrier_group") == "GAIG"
    return q.groupBy("business_id").agg(
        F.min("created_at").alias("first_quote_created_at"),
        F.count(F.lit(1)).alias("quote_count"),
        F.sum("quoted_premium").alias("total_quoted_premium"),
        _min_if(chubb, "created_at").alias("first_chubb_quote_created_at"),
        _sum_if(chubb, "quoted_premium").alias("chubb_quoted_premium"),
        _min_if(gaig, "created_at").alias("first_gaig_quote_created_at"),
        _sum_if(gaig, "quoted_premium").alias("gaig_quoted_premium"),
    )


@model("int_business_revenue_rollup", "intermediate",
       deps=("stg_policy_transaction", "stg_policy", "stg_carrier", "stg_business"))
def int_business_revenue_rollup(b: Build):
    """INT-01e: signed NB ledger sums in booking-day windows from the business date."""
    t = b.ref("stg_policy_transaction").where(~c("is_partial_installment")).select(
        "policy_id", "created_at", "created_date", "signed_amount", "is_gross_revenue", "is_core_revenue",
        "is_cancellation")
    ctx = _policy_context(b).select("policy_id", "business_id", "is_new_business", "carrier_group",
                                    "business_created_date")
    r = t.join(ctx, "policy_id")
    nb, gross, core, canc = c("is_new_business"), c("is_gross_revenue"), c("is_core_revenue"), c("is_cancellation")
    days = days_between("created_date", "business_created_date")
    chubb, gaig = c("carrier_group") == "Chubb", c("carrier_group") == "GAIG"
    amt = "signed_amount"
    return r.groupBy("business_id").agg(
        _sum_if(nb & gross & (days <= 7), amt).alias("d7_nb_gross_revenue"),
        _sum_if(nb & gross & (days <= 14), amt).alias("d14_nb_gross_revenue"),
        _sum_if(nb & gross & (days <= 30), amt).alias("d30_nb_gross_revenue"),
        _sum_if(nb & gross, amt).alias("nb_gross_revenue"),
        _sum_if(nb & gross & chubb & (days <= 30), amt).alias("d30_nb_chubb_gross_revenue"),
        _sum_if(nb & gross & gaig & (days <= 30), amt).alias("d30_nb_gaig_gross_revenue"),
        _sum_if(nb & core & (days <= 30), amt).alias("d30_nb_core_revenue"),
        _sum_if(nb & core, amt).alias("nb_core_revenue"),
        _sum_if(nb & canc, amt).alias("nb_cancellation_amount"),
        _min_if(nb & canc, "created_at").alias("first_nb_cancellation_booked_at"),
        _sum_if(core, amt).alias("total_core_revenue"),
    )


@model("int_business_close_status", "intermediate", deps=("stg_business_close_status_change",))
def int_business_close_status(b: Build):
    """INT-01f: first time each close status was entered."""
    ch = b.ref("stg_business_close_status_change")
    first = {"Attempted to Contact": "first_attempted_to_contact_at", "Made Contact": "first_made_contact_at",
             "Junk": "first_junk_at", "Customer": "first_customer_status_at"}
    return ch.groupBy("business_id").agg(
        *[_min_if(c("new_close_status") == v, "created_at").alias(a) for v, a in first.items()])


@model("int_business_opportunity_milestones", "intermediate", deps=("stg_opportunity_status_history",))
def int_business_opportunity_milestones(b: Build):
    """INT-01g: first time each opportunity stage was reached (STATUS changes only)."""
    h = b.ref("stg_opportunity_status_history").where(
        (c("change_type") == "STATUS") & c("business_id").isNotNull())
    to = c("to_value")
    return h.groupBy("business_id").agg(
        _min_if(to == "QUOTING", "created_at").alias("first_quoting_status_at"),
        _min_if(to.like("SIT%"), "created_at").alias("first_sit_status_at"),
        _min_if(to == "QUOTED", "created_at").alias("first_quoted_status_at"),
        _min_if(to == "QUOTE_PRESENTED", "created_at").alias("first_quote_presented_at"),
        _min_if(to == "WON", "created_at").alias("first_won_status_at"),
        _min_if(to == "LOST", "created_at").alias("first_lost_status_at"),
    )


@model("int_business_application_milestones", "intermediate", deps=("stg_application_submission",))
def int_business_application_milestones(b: Build):
    """INT-01h: application start / submit milestones."""
    a = b.ref("stg_application_submission").where(c("business_id").isNotNull())
    sub = c("is_submitted")
    return a.groupBy("business_id").agg(
        F.min("created_at").alias("first_application_started_at"),
        F.count_if(sub).alias("submitted_application_count"),
        _min_if(sub, "created_at").alias("first_application_submitted_at"),
        _min_if(sub & c("viewed"), "created_at").alias("first_viewed_application_submitted_at"),
        _min_if(sub & c("is_admin_rater"), "created_at").alias("first_admin_rater_application_at"),
        _min_if(sub & c("is_manual_application"), "created_at").alias("first_manual_application_at"),
    )


def _policy_and_ledger(b: Build):
    """The policy and the revenue rollup (INT-01c, INT-01e) in one aggregation: the
    policies' context is read once, not once for each.

    The ledger is reduced to one row per policy and day (in the map tasks, so one
    policy with a third of the ledger is a few hundred rows), then to one row per policy
    that holds its days. Joined to the context both sides are unique on the policy; each
    of its days becomes a row, the first of which (or the only one) carries the policy's own measures."""
    amt = "signed_amount"
    per_day = b.ref("stg_policy_transaction").where(~c("is_partial_installment")).groupBy("policy_id", "created_date").agg(
        _sum_if(c("is_gross_revenue"), amt).alias("gross"), _sum_if(c("is_core_revenue"), amt).alias("core"),
        _sum_if(c("is_cancellation"), amt).alias("canc"), _min_if(c("is_cancellation"), "created_at").alias("canc_at"))
    ledger = per_day.groupBy("policy_id").agg(
        F.collect_list(F.struct(c("created_date").alias("booked"), "gross", "core", "canc", "canc_at")).alias("days"))
    rows = _policy_context(b).join(ledger, "policy_id", "left").select(
        "business_id", "created_at", "created_date", "premium", "is_active", "is_new_business", "carrier_group",
        "business_created_date", F.posexplode_outer("days").alias("pos", "day")).select("*", "day.*")
    own = F.coalesce(c("pos") == 0, F.lit(True))  # once for each policy
    nb = c("is_new_business")
    bound_d30 = own & (days_between("created_date", "business_created_date") <= 30)
    days = days_between("booked", "business_created_date")
    chubb, gaig = c("carrier_group") == "Chubb", c("carrier_group") == "GAIG"
    return rows.groupBy("business_id").agg(
        F.min("created_at").alias("first_policy_created_at"),
        F.count_if(own).alias("policy_count"),
        _sum_if(own, "premium").alias("total_premium"),
        F.count_if(own & c("is_active")).alias("active_policy_count"),
        _sum_if(own & c("is_active"), "premium").alias("active_premium"),
        _min_if(nb, "created_at").alias("first_nb_policy_created_at"),
        F.count_if(own & nb).alias("nb_policy_count"),
        _sum_if(own & nb, "premium").alias("nb_premium"),
        _sum_if(bound_d30 & nb, "premium").alias("d30_nb_premium"),
        _min_if(nb & chubb, "created_at").alias("first_nb_chubb_policy_created_at"),
        _sum_if(own & nb & chubb, "premium").alias("nb_chubb_premium"),
        _sum_if(bound_d30 & nb & chubb, "premium").alias("d30_nb_chubb_premium"),
        _min_if(nb & gaig, "created_at").alias("first_nb_gaig_policy_created_at"),
        _sum_if(own & nb & gaig, "premium").alias("nb_gaig_premium"),
        _sum_if(bound_d30 & nb & gaig, "premium").alias("d30_nb_gaig_premium"),
        _sum_if(nb & (days <= 7), "gross").alias("d7_nb_gross_revenue"),
        _sum_if(nb & (days <= 14), "gross").alias("d14_nb_gross_revenue"),
        _sum_if(nb & (days <= 30), "gross").alias("d30_nb_gross_revenue"),
        _sum_if(nb, "gross").alias("nb_gross_revenue"),
        _sum_if(nb & chubb & (days <= 30), "gross").alias("d30_nb_chubb_gross_revenue"),
        _sum_if(nb & gaig & (days <= 30), "gross").alias("d30_nb_gaig_gross_revenue"),
        _sum_if(nb & (days <= 30), "core").alias("d30_nb_core_revenue"),
        _sum_if(nb, "core").alias("nb_core_revenue"),
        _sum_if(nb, "canc").alias("nb_cancellation_amount"),
        _min_if(nb, "canc_at").alias("first_nb_cancellation_booked_at"),
        F.sum("core").alias("total_core_revenue"),
    )


# Models of their own; int_business reads the two about policies as one (_policy_and_ledger).
_ROLLUPS = ("int_business_lead", "int_business_warm_transfer", "int_business_policy_rollup",
            "int_business_quote_rollup", "int_business_revenue_rollup", "int_business_close_status",
            "int_business_opportunity_milestones", "int_business_application_milestones")
_OF_POLICIES = ("int_business_policy_rollup", "int_business_revenue_rollup")

# days_to_<name> = <milestone>::date - business created date
_DAYS_TO = (
    ("attempted_to_contact", "first_attempted_to_contact_at"), ("made_contact", "first_made_contact_at"),
    ("junk", "first_junk_at"), ("application_submitted", "first_application_submitted_at"),
    ("quote_presented", "first_quote_presented_at"), ("first_quote", "first_quote_created_at"),
    ("first_chubb_quote", "first_chubb_quote_created_at"), ("first_gaig_quote", "first_gaig_quote_created_at"),
    ("first_policy", "first_policy_created_at"), ("first_nb_policy", "first_nb_policy_created_at"),
    ("first_nb_chubb_policy", "first_nb_chubb_policy_created_at"),
    ("first_nb_gaig_policy", "first_nb_gaig_policy_created_at"),
)
_ZERO_DEFAULT = (
    "submitted_application_count", "quote_count", "total_quoted_premium", "chubb_quoted_premium",
    "gaig_quoted_premium", "policy_count", "active_policy_count", "nb_policy_count", "total_premium",
    "active_premium", "nb_premium", "d30_nb_premium", "nb_chubb_premium", "d30_nb_chubb_premium",
    "nb_gaig_premium", "d30_nb_gaig_premium", "d7_nb_gross_revenue", "d14_nb_gross_revenue",
    "d30_nb_gross_revenue", "nb_gross_revenue", "d30_nb_chubb_gross_revenue", "d30_nb_gaig_gross_revenue",
    "d30_nb_core_revenue", "nb_core_revenue", "nb_cancellation_amount", "total_core_revenue",
)
_MILESTONES = (
    "first_attempted_to_contact_at", "first_made_contact_at", "first_junk_at", "first_customer_status_at",
    "first_application_started_at", "first_application_submitted_at", "first_viewed_application_submitted_at",
    "first_admin_rater_application_at", "first_manual_application_at", "first_quoting_status_at",
    "first_sit_status_at", "first_quoted_status_at", "first_quote_presented_at", "first_won_status_at",
    "first_lost_status_at", "first_quote_created_at", "first_chubb_quote_created_at",
    "first_gaig_quote_created_at", "first_policy_created_at", "first_nb_policy_created_at",
    "first_nb_chubb_policy_created_at", "first_nb_gaig_policy_created_at", "first_nb_cancellation_booked_at",
)


@model("int_business_joined", "intermediate",
       deps=("stg_business", "stg_user", "stg_license", "stg_employee_contact_information",
             "stg_business_classification", "stg_campaign_status") + _ROLLUPS)
def int_business_joined(b: Build):
    """INT-01i: business with its dimensions and every rollup (one row per business).

    The dimensions are joined first, while the rows are narrow: to the business, and
    the campaign to the rollup that names it. Most keys are NULL for many
    businesses (no campaign, nobody credited), so NULLs are spread across buckets.
    All rollups are unique per business_id, so the business-keyed left joins
    reuse one hash partitioning, and no row of all columns is sorted or sent."""
    j = b.ref("stg_business")
    lic = b.dim("stg_license", c("license_name").alias("__lic"), "partner_name", "partner_profile_type",
                "transfer_type")
    emp = b.dim("stg_employee_contact_information", c("employee_name").alias("__emp"),
                c("employee_type").alias("credited_ae_employee_type"), c("team").alias("credited_ae_team"))
    cls = b.dim("stg_business_classification", c("business_classification_id").alias("__cls"),
                "classification_name", "naics_code", "industry", "sub_industry", "naics_sub_industry")
    cmp = b.dim("stg_campaign_status", c("campaign_status_id").alias("__cmp"),
                c("campaign_name").alias("warm_transfer_campaign_name"))
    users = b.ref("stg_user").select(c("user_id").alias("__uid"), c("full_name").alias("owner_name"),
                                     c("email").alias("owner_email"), "is_test_name")
    for dim, left_key, key in ((lic, "license_name", "__lic"), (emp, "credited_account_executive", "__emp"),
                               (cls, "business_classification_id", "__cls"), (users, "user_id", "__uid")):
        j = left_join_spread_nulls(j, dim, left_key, key, spread_by=["business_id"])
    pings = left_join_spread_nulls(b.ref("int_business_warm_transfer"), cmp, "warm_transfer_campaign_status_id", "__cmp",
                                   spread_by=["business_id"])
    for rollup in [*(b.ref(n) for n in _ROLLUPS if n not in (*_OF_POLICIES, "int_business_warm_transfer")), pings,
                   _policy_and_ledger(b)]:
        j = j.join(rollup, "business_id", "left")

    out = [
        "business_id", "user_id", "close_lead_id", "business_name", "owner_name", "owner_email",
        "legal_entity_type", "company_type", "total_annual_revenue", "total_annual_payroll",
        "total_number_of_employees", "years_in_business", "close_status", "is_high_risk",
        (c("is_test_flag") | F.coalesce(c("is_test_name"), F.lit(False))).alias("is_test_business"),
        c("created_at").alias("business_created_at"), c("created_date").alias("business_created_date"),
        c("created_week").alias("business_created_week"), c("created_month").alias("business_created_month"),
        F.datediff(F.lit(b.cfg.as_of), c("created_date")).alias("business_age_days"),
        "license_name", "partner_name", "partner_profile_type",
        F.coalesce(c("transfer_type"), F.lit("Partner")).alias("transfer_type"),
        "warm_transfer_campaign", "campaign_type", "warm_transfer_campaign_name",
        F.when(c("warm_transfer_count").isNull(), F.lit("OTHER")).otherwise(c("warm_transfer_claimed_status"))
        .alias("claimed_status"),
        "warm_transfer_status", "first_warm_transfer_at",
        F.coalesce(c("warm_transfer_bid_price"), F.lit(0)).alias("warm_transfer_bid_price"),
        "credited_account_executive", "credited_ae_team", "credited_ae_employee_type", "account_executive",
        "account_manager", "sold_by", "lead_id", "lead_account_executive",
        F.coalesce(c("workflow_type_assigned"), F.lit("NONE")).alias("workflow_type"),
        "made_contact", "is_junk", "lead_score", "lead_created_at", "lead_expiry_time",
        "classification_name", "naics_code", "industry", "sub_industry", "naics_sub_industry",
        *_MILESTONES,
        *[days_between(ts, "created_date").alias(f"days_to_{n}") for n, ts in _DAYS_TO],
        *[F.coalesce(c(x), F.lit(0)).alias(x) for x in _ZERO_DEFAULT],
    ]
    return j.select(*out)


@model("int_business", "intermediate", deps=("int_business_joined",))
def int_business(b: Build):
    """INT-01 / INT-01j: one row per business with 0/1 cohort flags."""
    j = b.ref("int_business_joined")
    age = c("business_age_days")
    flags = [flag(age >= n).alias(f"is_mature_d{n}") for n in S.MATURITY_DAYS]
    flags += [
        within_days("days_to_attempted_to_contact", 7).alias("d7_attempted_to_contact"),
        within_days("days_to_made_contact", 7).alias("d7_made_contact"),
        within_days("days_to_junk", 7).alias("d7_junk"),
        flag(c("first_quote_created_at").isNotNull()).alias("quoted"),
        within_days("days_to_first_quote", 7).alias("d7_quoted"),
        within_days("days_to_first_quote", 30).alias("d30_quoted"),
        F.when(c("days_to_first_quote") <= 30, c("days_to_first_quote")).alias("days_to_d30_quote"),
        within_days("days_to_quote_presented", 7).alias("d7_quote_presented"),
        flag(c("first_policy_created_at").isNotNull()).alias("converted"),
        *[within_days("days_to_first_policy", n).alias(f"d{n}_converted") for n in S.CONVERSION_DAYS],
        within_days("days_to_first_chubb_quote", 7).alias("d7_chubb_quoted"),
        within_days("days_to_first_nb_chubb_policy", 7).alias("d7_chubb_converted"),
        within_days("days_to_first_nb_chubb_policy", 30).alias("d30_chubb_converted"),
        within_days("days_to_first_gaig_quote", 7).alias("d7_gaig_quoted"),
        within_days("days_to_first_nb_gaig_policy", 7).alias("d7_gaig_converted"),
        within_days("days_to_first_nb_gaig_policy", 30).alias("d30_gaig_converted"),
    ]
    return j.select("*", *flags)


# ---------------------------------------------------------------------------
# INT-02 .. INT-07
# ---------------------------------------------------------------------------

def _campaigns(b: Build):
    """One row per campaign with its partner's name: the fact then joins once, on the campaign."""
    cmp = b.dim("stg_campaign_status", c("campaign_status_id").alias("__cmp"), c("partner_id").alias("__cmp_partner"),
                c("campaign_name").alias("__cmp_name"), c("is_high_revenue_campaign").alias("__cmp_hr"))
    par = b.dim("stg_partner", c("partner_id").alias("__par"), c("partner_name").alias("__partner_name"))
    return cmp.join(par, c("__cmp_partner") == par["__par"], "left").drop("__cmp_partner", "__par")


@model("int_warm_transfer", "intermediate",
       deps=("stg_warm_transfer", "stg_campaign_status", "stg_partner", "int_business"))
def int_warm_transfer(b: Build):
    """INT-02: one row per ping with partner / campaign resolved and the created
    business's outcome. Half the pings have no business, most no campaign: their NULL
    keys are spread over buckets instead of landing in one task."""
    w = left_join_spread_nulls(b.ref("stg_warm_transfer"), _campaigns(b), "campaign_status_id", "__cmp",
                               spread_by=["warm_transfer_id"]).withColumnRenamed("__partner_name", "__cp_name")
    biz = b.ref("int_business").select(
        c("business_id").alias("__bid"), c("partner_name").alias("__b_partner"),
        c("warm_transfer_campaign").alias("__b_campaign"),
        "license_name", "transfer_type", "credited_account_executive", "credited_ae_team", "workflow_type",
        c("is_test_business").alias("__b_test"), "quoted", "d7_quoted", "converted", "d7_converted",
        "d30_converted", "nb_policy_count", "nb_premium", "d30_nb_premium", "d30_nb_gross_revenue",
        "nb_gross_revenue")
    j = left_join_spread_nulls(w, biz, "business_id", "__bid", spread_by=["warm_transfer_id"])
    resolved = (F.when(c("__cp_name").isNotNull(), "campaign").when(c("__b_partner").isNotNull(), "business")
                .when(c("payload_vendor").isNotNull(), "payload").otherwise("unknown"))
    return j.select(
        "warm_transfer_id", "business_id", "campaign_status_id", "created_at", "created_date",
        trunc_date("created_at", "week").alias("created_week"),
        trunc_date("created_at", "month").alias("created_month"),
        F.datediff(F.lit(b.cfg.as_of), c("created_date")).alias("ping_age_days"),
        F.coalesce(c("__cp_name"), c("__b_partner"), c("payload_vendor"), F.lit("Unknown")).alias("partner_name"),
        resolved.alias("partner_resolved_from"),
        F.coalesce(c("__cmp_name"), c("awl_campaign"), c("__b_campaign")).alias("campaign_name"),
        F.coalesce(c("__cmp_hr"), F.lit(False)).alias("is_high_revenue_campaign"),
        "status", "is_accepted", "is_rejected", "is_error", "is_received",
        F.when(c("is_accepted"), c("claimed_status")).alias("claimed_status"),
        "rejection_reason", "rejection_reason_category", "bid_price",
        F.when(c("is_accepted"), c("bid_price")).alias("accepted_bid_price"),
        "license_name", "transfer_type", "credited_account_executive", "credited_ae_team", "workflow_type",
        F.coalesce(c("__b_test"), F.lit(False)).alias("is_test_business"),
        "quoted", "d7_quoted", "converted", "d7_converted", "d30_converted", "nb_policy_count", "nb_premium",
        "d30_nb_premium", "d30_nb_gross_revenue", "nb_gross_revenue",
    )


@model("int_policy_revenue", "intermediate", deps=("stg_policy", "stg_business"))
def int_policy_revenue(b: Build):
    """INT-03: bound policies labelled with the business's license."""
    p = b.ref("stg_policy").where(c("status") == "BOUND")
    bl = b.ref("stg_business").select(c("business_id").alias("__bid"), c("license_name").alias("__b_license"))
    j = left_join_spread_nulls(p, bl, "business_id", "__bid", spread_by=["policy_id"])
    return j.select(
        "policy_id", "business_id", "carrier_id", "quote_id", "close_opportunity_id", "renewed_from_policy_id",
        "policy_type",
        F.coalesce(c("__b_license"), F.lit("(no license)")).alias("license_name"),
        c("license_name").alias("policy_license_name"),
        "billing_type", "sale_type", "sales_channel", "underwriting_carrier", "account_executive",
        "assigned_agent", "is_renewal", "renewal_count", "bor_renewal", "is_auto_bind", "is_paygo",
        "premium", "commissionable_premium", "commission_rate", "estimated_commission", "mmr_fee",
        "effective_date", "expiry_date", c("created_at").alias("bound_at"),
        trunc_date("created_at", "day").alias("bound_date"),
        trunc_date("created_at", "week").alias("bound_week"),
        trunc_date("created_at", "month").alias("bound_month"),
        trunc_date("created_at", "quarter").alias("bound_quarter"),
        F.year("created_at").alias("bound_year"),
        trunc_date("effective_date", "month").alias("effective_month"),
    )


def _business_owner(b: Build, dimensions: bool = True):
    """One row per business: owner flags and, if wanted, existence of its dimension rows."""
    biz = b.ref("stg_business").select("business_id", "user_id", "business_classification_id", "license_name",
                                       "is_test_flag", "created_at")
    users = b.ref("stg_user").select(c("user_id").alias("__uid"), c("first_name").alias("__first"),
                                     c("last_name").alias("__last"), c("is_test_name").alias("__is_test_name"))
    j = left_join_spread_nulls(biz, users, "user_id", "__uid", spread_by=["business_id"])
    if not dimensions:
        return j
    cls = b.dim("stg_business_classification", c("business_classification_id").alias("__cls"))
    lic = b.dim("stg_license", c("license_name").alias("__lic"))
    return (j.join(cls, j["business_classification_id"] == cls["__cls"], "left")
             .join(lic, j["license_name"] == lic["__lic"], "left"))


@model("int_nb_revenue_transaction", "intermediate",
       deps=("stg_policy_transaction", "stg_policy", "stg_carrier", "stg_business", "stg_user"))
def int_nb_revenue_transaction(b: Build):
    """INT-04: ledger rows counted toward net new-business revenue."""
    owner = _business_owner(b, dimensions=False)
    pol = (b.ref("stg_policy").where(c("is_new_business"))
           .select(c("policy_id").alias("__pid"), c("business_id").alias("__p_bid"), "carrier_id",
                   c("created_at").alias("policy_created_at"), c("created_date").alias("__p_date"))
           .join(_carriers(b), "carrier_id"))
    ctx = (pol.join(owner, pol["__p_bid"] == owner["business_id"])  # inner: drops orphan policies
           .where(~c("is_test_carrier") & ~c("is_test_flag") & ~F.coalesce(c("__is_test_name"), F.lit(False)))
           .select("__pid", "business_id", "policy_created_at", "__p_date",
                   c("created_at").alias("business_created_at")))
    t = b.ref("stg_policy_transaction").where(c("transaction_type").isin(*S.NB_REVENUE_TYPES))
    j = t.join(ctx, t["policy_id"] == ctx["__pid"])
    late = c("created_at") >= c("policy_created_at") + F.expr(f"INTERVAL '{S.CANCELLATION_WINDOW_DAYS}' DAY")
    j = j.where(~(c("is_cancellation_driven") & late))
    bucket = F.when(c("transaction_type").isin("TECHNOLOGY_ACCESS_FEE", "AGENCY_FEE"), "TECH_FEE") \
        .otherwise(c("transaction_type"))
    return j.select(
        "policy_transaction_id", "policy_id", "business_id",
        c("created_at").alias("booked_at"), c("created_date").alias("booked_date"),
        "transaction_type", bucket.alias("revenue_bucket"), "direction", "is_cancellation_driven",
        "signed_amount", "policy_created_at", "business_created_at",
        F.datediff(c("created_date"), c("__p_date")).alias("days_policy_to_booking"),
    )


def snapshot_instant(created_at) -> Column:
    """Month start of the creation time + 1 month 5 hours 5 minutes (NTZ)."""
    months, hours, minutes = S.SNAPSHOT_OFFSET
    start = F.trunc(F.to_date(created_at), "month").cast("timestamp_ntz")
    return start + F.expr(f"INTERVAL '{months}' MONTH") + F.expr(f"INTERVAL '{hours}:{minutes:02d}' HOUR TO MINUTE")


def _snapshot_cell(ts) -> Column:
    """Months between the snapshot instants, numbered: a snapshot is the first instant of its cell."""
    _, hours, minutes = S.SNAPSHOT_OFFSET
    shifted = ts - F.expr(f"INTERVAL '{hours}:{minutes:02d}' HOUR TO MINUTE")
    return F.year(shifted) * 12 + F.month(shifted)


@model("int_ae_sales_snapshot_status", "intermediate", deps=("stg_policy", "stg_policy_status_change"))
def int_ae_sales_snapshot_status(b: Build):
    """INT-05a..c: each policy's snapshot instant and the status log around it. All
    snapshots lie on a monthly grid, so the log is reduced to one row per policy and
    month in the map tasks before it meets the policies."""
    pol = b.ref("stg_policy").select("policy_id", snapshot_instant(c("created_at")).alias("snapshot_at"))
    changes = b.ref("stg_policy_status_change")
    looked = asof_both(pol, changes, "policy_id", "snapshot_at", "changed_at", "change_log_id",
                       before_value="new_status", after_value="old_status",
                       before_alias="last_new_status_before", after_alias="first_old_status_after", grid=_snapshot_cell)
    return looked.select("policy_id", "last_new_status_before", "first_old_status_after")


@model("int_ae_sales_policy", "intermediate",
       deps=("stg_policy", "int_ae_sales_snapshot_status", "stg_business", "stg_user", "stg_carrier",
             "stg_business_classification", "stg_license"))
def int_ae_sales_policy(b: Build):
    """INT-05: AE-sales eligibility of each policy at its monthly snapshot."""
    p = b.ref("stg_policy").withColumn("snapshot_at", snapshot_instant(c("created_at")))
    snap = b.ref("int_ae_sales_snapshot_status").withColumnRenamed("policy_id", "__spid")
    car = b.dim("stg_carrier", c("carrier_id").alias("__cid"), c("is_test_carrier").alias("__test_carrier"))
    owner = _business_owner(b).select(
        c("business_id").alias("__bid"), c("is_test_flag").alias("__b_test"), "__uid", "__first", "__last",
        "__cls", "__lic")
    j = (p.join(snap, p["policy_id"] == snap["__spid"], "left")
          .join(car, p["carrier_id"] == car["__cid"], "left"))
    j = left_join_spread_nulls(j, owner, "business_id", "__bid", spread_by=["policy_id"])
    full = F.concat(c("__first"), F.lit(" "), c("__last"))
    ae_rule = F.coalesce(c("__first").isNotNull() & c("__last").isNotNull()
                         & contains_any_upper(full, b.cfg.test_tokens), F.lit(False))
    status_at = F.coalesce(c("last_new_status_before"), c("first_old_status_after"), c("status"))
    out = j.select(
        "policy_id", "business_id",
        c("created_at").alias("policy_created_at"), c("created_date").alias("policy_created_date"),
        "sale_type", "bor_renewal", "premium", c("status").alias("current_status"), "snapshot_at",
        status_at.alias("status_at_snapshot"),
        (c("is_new_business") | F.coalesce(c("bor_renewal"), F.lit(False))).alias("is_eligible_sale_type"),
        F.coalesce(c("premium") > 0, F.lit(False)).alias("has_premium"),
        F.coalesce(c("__test_carrier"), F.lit(False)).alias("is_test_carrier"),
        F.coalesce(c("__b_test"), F.lit(False)).alias("is_test_business_flag"),
        ae_rule.alias("is_test_name_ae_rule"),
        (c("__uid").isNotNull() & c("__cls").isNotNull() & c("__lic").isNotNull()).alias("has_required_joins"),
    )
    verdict = (c("is_eligible_sale_type") & c("has_premium") & distinct_from("status_at_snapshot", F.lit("CANCELLED"))
               & ~c("is_test_carrier") & ~c("is_test_business_flag") & ~c("is_test_name_ae_rule")
               & c("has_required_joins"))
    return out.select("*", verdict.alias("is_ae_sales_policy"))


@model("int_ringba_call_events", "intermediate", deps=("stg_ringba_call_event",))
def int_ringba_call_events(b: Build):
    """INT-06a: per-call event rollup."""
    e = b.ref("stg_ringba_call_event")
    ev = c("event_name")
    return e.groupBy("ringba_call_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("target_name").alias("ae_count_dialed"),
        F.bool_or(ev == "TargetDialed").alias("is_routed"),
        F.bool_or(ev == "ConnectedCall").alias("is_answered"),
        F.bool_or(ev == "DuplicateCall").alias("is_duplicate"),
        F.bool_or(ev == "NoTargetFound").alias("is_no_target_found"),
        F.count_if(ev == "NoAnswer").alias("no_answer_events"),
        _min_if(ev == "TargetDialed", "event_at").alias("first_dialed_at"),
        _min_if(ev == "ConnectedCall", "event_at").alias("answered_at"),
        F.max(F.when(ev == "ConnectedCall", c("target_name"))).alias("answered_by"),
    )


@model("int_ringba_call", "intermediate",
       deps=("stg_ringba_call", "int_ringba_call_events", "stg_campaign_status", "stg_partner"))
def int_ringba_call(b: Build):
    """INT-06: one row per inbound call with partner, campaign and outcome."""
    calls = b.ref("stg_ringba_call")
    ev = b.ref("int_ringba_call_events").withColumnRenamed("ringba_call_id", "__eid")
    j = left_join_spread_nulls(calls.join(ev, calls["ringba_call_id"] == ev["__eid"], "left"), _campaigns(b),
                               "campaign_status_id", "__cmp", spread_by=["ringba_call_id"])
    routed = F.coalesce(c("is_routed"), F.lit(False))
    answered = F.coalesce(c("is_answered"), F.lit(False))
    return j.select(
        "ringba_call_id", "inbound_call_id", "campaign_status_id", "caller_number", "called_at", "call_date",
        trunc_date("call_date", "week").alias("call_week"),
        trunc_date("call_date", "month").alias("call_month"),
        F.when(c("campaign_status_id").isNull(), F.lit("Other"))
        .otherwise(F.coalesce(c("__partner_name"), F.lit("Other"))).alias("partner_name"),
        F.coalesce(c("__cmp_name"), F.lit("(no campaign)")).alias("campaign_name"),
        F.coalesce(c("__cmp_hr"), F.lit(False)).alias("is_high_revenue_campaign"),
        F.coalesce(c("event_count"), F.lit(0)).alias("event_count"),
        F.coalesce(c("ae_count_dialed"), F.lit(0)).alias("ae_count_dialed"),
        routed.alias("is_routed"),
        answered.alias("is_answered"),
        (routed & ~answered).alias("is_missed"),
        (~routed).alias("is_unrouted"),
        F.coalesce(c("is_duplicate"), F.lit(False)).alias("is_duplicate"),
        F.coalesce(c("is_no_target_found"), F.lit(False)).alias("is_no_target_found"),
        F.coalesce(c("no_answer_events"), F.lit(0)).alias("no_answer_events"),
        "answered_by", "first_dialed_at", "answered_at",
        seconds_between("answered_at", "first_dialed_at").alias("seconds_to_answer"),
        "call_length_seconds", "has_converted",
    )


@model("int_ringba_call_ae", "intermediate",
       deps=("stg_ringba_call_event", "int_ringba_call", "stg_employee_contact_information"))
def int_ringba_call_ae(b: Build):
    """INT-07: one row per call x AE the call rang."""
    e = b.ref("stg_ringba_call_event").where(c("target_name").isNotNull())
    ev = c("event_name")
    ca = e.groupBy("ringba_call_id", c("target_name").alias("account_executive")).agg(
        F.bool_or(ev == "TargetDialed").alias("was_dialed"),
        F.bool_or(ev == "ConnectedCall").alias("was_answered"),
        F.count_if(ev == "NoAnswer").alias("no_answer_events"),
        F.count_if(ev == "BusyCall").alias("busy_events"),
        _min_if(ev == "TargetDialed", "event_at").alias("first_dialed_at"),
        _min_if(ev == "ConnectedCall", "event_at").alias("answered_at"),
    )
    calls = b.ref("int_ringba_call").select(
        c("ringba_call_id").alias("__cid"), "call_date", "call_week", "call_month", "partner_name", "campaign_name",
        "caller_number", "is_duplicate", c("is_answered").alias("call_was_answered"), "call_length_seconds")
    emp = b.dim("stg_employee_contact_information", c("employee_name").alias("__emp"),
                c("team").alias("ae_team"), c("employee_type").alias("ae_employee_type"))
    j = (ca.join(calls, ca["ringba_call_id"] == calls["__cid"])
           .join(emp, ca["account_executive"] == emp["__emp"], "left"))
    return j.select(
        "ringba_call_id", "account_executive", "ae_team", "ae_employee_type", "call_date", "call_week",
        "call_month", "partner_name", "campaign_name", "caller_number", "is_duplicate", "call_was_answered",
        "was_dialed", "was_answered", (c("was_dialed") & ~c("was_answered")).alias("was_missed"),
        "no_answer_events", "busy_events", "first_dialed_at", "answered_at",
        F.when(c("was_answered"), c("call_length_seconds")).alias("answered_call_length_seconds"),
    )
