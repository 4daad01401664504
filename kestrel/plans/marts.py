"""Marts (MRT-01..MRT-09): additive daily / monthly reporting tables.

Stored tables carry no order (a global sort would be one more full shuffle
with no meaning for readers); ``ordered(...)`` applies the reference's
ordering when a caller wants it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import MONEY, WIDE, flag, iso_weekday, pct, trunc_date
from ..operators import full_outer_merge
from ..operators.quality import union_all
from .registry import Build, model

c = F.col


def exact_mean(x: str | Column, scale: int = 6) -> Column:
    """avg() of a decimal or integer column, rounded HALF_UP to ``scale`` decimals. The sum
    keeps ``scale`` decimals: pass the column's own if it has more than 6."""
    col = c(x) if isinstance(x, str) else x
    mean = F.sum(col).cast(f"decimal(34,{scale})") / F.count(col).cast("decimal(20,0)")
    return mean.cast(f"decimal(38,{scale})")


def _count_if(cond: Column) -> Column:
    return F.count_if(cond)


@model("dim_date", "marts")
def dim_date(b: Build):
    """MRT-03: one row per day from the spine start to the end of next year."""
    end = b.cfg.spine_end
    n_days = (end - S.SPINE_START).days + 1
    # range() splits the spine over partitions; no single-row explode
    days = b.spark.range(n_days).select(F.date_add(F.lit(S.SPINE_START), c("id").cast("int")).alias("date_day"))
    d = c("date_day")
    today = F.lit(b.cfg.as_of)
    return days.select(
        d,
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"),
        F.trunc(d, "year").alias("year_start"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d <= today).alias("is_past_or_today"),
        (d == today).alias("is_today"),
    )


def _dates(b: Build) -> DataFrame:
    # The spine is bounded by the calendar (about 1,800 rows), not by the data.
    return F.broadcast(b.ref("dim_date").select(
        c("date_day").alias("__day"), "week_start", "month_start", "quarter_start", "year", "is_weekend"))


@model("wt_tracker_daily", "marts", deps=("int_business",))
def wt_tracker_daily(b: Build):
    """MRT-09: business-cohort tracker, one row per cohort grain."""
    biz = b.ref("int_business").where(~c("is_test_business"))
    keys = ["business_created_date", "license_name", "claimed_status", "warm_transfer_campaign",
            "credited_account_executive", "workflow_type", "business_created_week", "business_created_month"]
    attrs = [F.max(x).alias(x) for x in ("is_mature_d7", "is_mature_d14", "is_mature_d30", "partner_name",
                                         "transfer_type", "campaign_type", "credited_ae_team")]
    counts = {
        "d7_attempted_to_contact": "d7_attempted_to_contact_business_count",
        "d7_made_contact": "d7_made_contact_business_count", "d7_junk": "d7_junk_business_count",
        "quoted": "quoted_business_count", "d7_quoted": "d7_quoted_business_count",
        "d30_quoted": "d30_quoted_business_count",
    }
    later = {
        "d7_quote_presented": "d7_quote_presented_business_count", "quote_count": "quote_count",
        "converted": "converted_business_count",
        **{f"d{n}_converted": f"d{n}_converted_business_count" for n in S.CONVERSION_DAYS},
        "nb_policy_count": "nb_policy_count", "nb_premium": "nb_premium", "d30_nb_premium": "d30_nb_premium",
        "d7_nb_gross_revenue": "d7_nb_gross_revenue", "d14_nb_gross_revenue": "d14_nb_gross_revenue",
        "d30_nb_gross_revenue": "d30_nb_gross_revenue", "nb_gross_revenue": "nb_gross_revenue",
        "d30_nb_core_revenue": "d30_nb_core_revenue", "nb_cancellation_amount": "nb_cancellation_amount",
    }
    measures = [F.count(F.lit(1)).alias("business_count"),
                F.sum("warm_transfer_bid_price").alias("total_bid_price"),
                *[F.sum(k).alias(v) for k, v in counts.items()],
                F.coalesce(F.sum("days_to_d30_quote"), F.lit(0)).alias("total_days_to_d30_quote"),
                *[F.sum(k).alias(v) for k, v in later.items()]]
    for carrier in ("chubb", "gaig"):
        measures += [
            F.sum(f"d7_{carrier}_quoted").alias(f"d7_{carrier}_quoted_business_count"),
            F.sum(F.when(c(f"d7_{carrier}_quoted") == 1, c(f"{carrier}_quoted_premium")).otherwise(0))
            .alias(f"d7_{carrier}_quoted_premium"),
            F.sum(f"d7_{carrier}_converted").alias(f"d7_{carrier}_converted_business_count"),
            F.sum(f"d30_{carrier}_converted").alias(f"d30_{carrier}_converted_business_count"),
            F.sum(f"d30_nb_{carrier}_premium").alias(f"d30_nb_{carrier}_premium"),
            F.sum(f"d30_nb_{carrier}_gross_revenue").alias(f"d30_nb_{carrier}_gross_revenue"),
        ]
    return biz.groupBy(*keys).agg(*attrs, *measures)


@model("wt_pings_daily", "marts", deps=("int_warm_transfer",))
def wt_pings_daily(b: Build):
    """MRT-08: ping-level warm-transfer tracker."""
    p = b.ref("int_warm_transfer").where(~c("is_test_business"))
    keys = [c("created_date").alias("ping_date"), "partner_name", "campaign_name", "status", "claimed_status",
            "rejection_reason_category", "rejection_reason", "credited_account_executive",
            c("created_week").alias("ping_week"), c("created_month").alias("ping_month")]
    zero = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return p.groupBy(*keys).agg(
        F.max(flag(c("ping_age_days") >= 7)).alias("is_mature_d7"),
        F.max(flag(c("ping_age_days") >= 30)).alias("is_mature_d30"),
        F.max("credited_ae_team").alias("credited_ae_team"),
        F.bool_or("is_high_revenue_campaign").alias("is_high_revenue_campaign"),
        F.count(F.lit(1)).alias("ping_count"),
        _count_if(c("is_accepted")).alias("accepted_count"),
        _count_if(c("is_rejected")).alias("rejected_count"),
        _count_if(c("is_error")).alias("error_count"),
        _count_if(c("is_received")).alias("received_count"),
        _count_if(c("claimed_status") == "CLAIMED").alias("claimed_count"),
        _count_if(c("claimed_status") == "UNCLAIMED").alias("unclaimed_count"),
        F.count("business_id").alias("business_count"),
        zero("accepted_bid_price").alias("accepted_bid_price"),
        zero("bid_price").alias("offered_bid_price"),
        zero("quoted").alias("quoted_business_count"),
        zero("d7_quoted").alias("d7_quoted_business_count"),
        zero("converted").alias("converted_business_count"),
        zero("d7_converted").alias("d7_converted_business_count"),
        zero("d30_converted").alias("d30_converted_business_count"),
        zero("nb_policy_count").alias("nb_policy_count"),
        zero("nb_premium").alias("nb_premium"),
        zero("d30_nb_premium").alias("d30_nb_premium"),
        zero("d30_nb_gross_revenue").alias("d30_nb_gross_revenue"),
        zero("nb_gross_revenue").alias("nb_gross_revenue"),
    )


@model("policy_revenue_summary", "marts", deps=("int_policy_revenue",))
def policy_revenue_summary(b: Build):
    """MRT-05: bound-policy revenue by 11 dimensions, with two rates."""
    p = b.ref("int_policy_revenue")
    keys = ["bound_month", "bound_quarter", "bound_year", "policy_type", "license_name", "underwriting_carrier",
            "billing_type", "sale_type", "sales_channel", "is_renewal", "is_paygo"]
    base = p.groupBy(*keys).agg(
        F.count("policy_id").alias("policies_bound"),
        F.count_distinct("business_id").alias("unique_businesses"),
        F.sum("premium").alias("gross_written_premium"),
        F.sum("commissionable_premium").alias("total_commissionable_premium"),
        F.sum("estimated_commission").alias("total_estimated_commission"),
        F.sum("mmr_fee").alias("total_mmr_fees"),
        exact_mean("premium").alias("avg_premium"),
        exact_mean("commission_rate").alias("avg_commission_rate"),
        _count_if(~c("is_renewal")).alias("new_business_policies"),
        _count_if(c("is_renewal")).alias("renewal_policies"),
        F.sum(F.when(~c("is_renewal"), c("premium"))).alias("new_business_premium"),
        F.sum(F.when(c("is_renewal"), c("premium"))).alias("renewal_premium"),
    )
    return base.select(
        "*",
        pct("renewal_policies", "policies_bound").alias("renewal_rate_pct"),
        pct("total_estimated_commission", "gross_written_premium").alias("effective_commission_rate_pct"),
    )


@model("ae_performance_monthly", "marts", deps=("int_business", "int_policy_revenue"))
def ae_performance_monthly(b: Build):
    """MRT-01: monthly AE scorecard: leads ⟗ bound policies on (month, AE)."""
    biz = b.ref("int_business").where(c("lead_account_executive").isNotNull() & c("lead_id").isNotNull())
    leads = biz.groupBy(trunc_date("lead_created_at", "month").alias("activity_month"),
                        c("lead_account_executive").alias("account_executive")).agg(
        F.count("lead_id").alias("leads_assigned"),
        _count_if(c("made_contact")).alias("leads_contacted"),
        _count_if(c("is_junk")).alias("leads_marked_junk"),
        exact_mean("lead_score").alias("avg_lead_score"),
    )
    pol = b.ref("int_policy_revenue").where(c("account_executive").isNotNull())
    policies = pol.groupBy(c("bound_month").alias("activity_month"), "account_executive").agg(
        F.count("policy_id").alias("policies_bound"),
        _count_if(~c("is_renewal")).alias("new_policies_bound"),
        _count_if(c("is_renewal")).alias("renewals_bound"),
        F.count_distinct("business_id").alias("unique_businesses_bound"),
        F.sum("premium").alias("total_premium"),
        F.sum("estimated_commission").alias("total_estimated_commission"),
        exact_mean("premium").alias("avg_premium_per_policy"),
        F.count_distinct("policy_type").alias("distinct_policy_types"),
    )
    j = full_outer_merge([leads, policies], ["activity_month", "account_executive"])
    z = lambda x: F.coalesce(c(x), F.lit(0))
    return j.select(
        "activity_month", "account_executive",
        z("leads_assigned").alias("leads_assigned"), z("leads_contacted").alias("leads_contacted"),
        z("leads_marked_junk").alias("leads_marked_junk"), "avg_lead_score",
        z("policies_bound").alias("policies_bound"), z("new_policies_bound").alias("new_policies_bound"),
        z("renewals_bound").alias("renewals_bound"), z("unique_businesses_bound").alias("unique_businesses_bound"),
        z("total_premium").alias("total_premium"), z("total_estimated_commission").alias("total_estimated_commission"),
        "avg_premium_per_policy", z("distinct_policy_types").alias("distinct_policy_types"),
        pct(z("leads_contacted"), c("leads_assigned")).alias("contact_rate_pct"),
        pct(z("unique_businesses_bound"), c("leads_contacted")).alias("contact_to_bind_rate_pct"),
        pct(z("unique_businesses_bound"), c("leads_assigned")).alias("overall_close_rate_pct"),
    )


@model("business_funnel_daily", "marts",
       deps=("stg_business", "stg_application_submission", "stg_quote", "stg_policy"))
def business_funnel_daily(b: Build):
    """MRT-02: daily funnel per business license (apps, quotes, bound policies, signups).

    Each fact is first reduced to one row per business and day, so counting distinct
    businesses later is counting rows. These rows and the business's own meet in one
    aggregation by business, which hands every day the license: the business table is read
    once and nothing is joined. Facts without a business (a NULL key) are reduced to one
    row a day before they are sent."""
    def per_day(df: DataFrame, kind: str, day: Column, *sums: Column) -> DataFrame:
        return df.groupBy("business_id", day.alias("day")).agg(F.count(F.lit(1)).alias("n"), *sums).withColumn("kind", F.lit(kind))

    apps = per_day(b.ref("stg_application_submission").where(~c("is_admin_quoting_tool")), "app", F.to_date("created_at"))
    quotes = per_day(b.ref("stg_quote"), "quote", F.to_date("created_at"))
    # the bound policies of int_policy_revenue, whose license is the business's too
    bound = per_day(b.ref("stg_policy").where(c("status") == "BOUND"), "policy", trunc_date("created_at", "day"),
                    F.sum("premium").alias("premium"), F.sum("estimated_commission").alias("commission"))
    business = b.ref("stg_business").select("business_id", c("license_name"), F.to_date("created_at").alias("day"),
                                            F.lit(1).cast("bigint").alias("n"), F.lit("signup").alias("kind"))
    rows = union_all([apps, quotes, bound, business], allow_missing=True)
    days = F.collect_list(F.struct("kind", "day", "n", "premium", "commission"))  # at most a few entries per calendar day
    each = rows.groupBy("business_id").agg(F.max("license_name").alias("license_name"), days.alias("days")).select(
        "business_id", F.coalesce("license_name", F.lit("(no license)")).alias("license"), F.inline("days"))
    kind = c("kind")

    def businesses(k: str) -> Column:
        return F.count_if((kind == k) & c("business_id").isNotNull())

    def total(k: str, x: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(kind == k, c(x))), F.lit(0))

    # Signups have no license; rows without a day stay apart by kind, as full outer joins on the day keep them.
    grouped = each.groupBy(c("day").alias("activity_date"), F.when(kind != "signup", c("license")).alias("license_name"),
                           F.when(c("day").isNull(), kind).alias("__apart")).agg(
        businesses("app").alias("businesses_with_app"), total("app").alias("applications_started"),
        businesses("quote").alias("businesses_quoted"), total("quote").alias("quotes_generated"),
        businesses("policy").alias("businesses_bound"), total("policy").alias("policies_bound"),
        total("policy", "premium").alias("total_premium_bound"),
        total("policy", "commission").alias("total_estimated_commission"),
        F.sum(F.when(kind == "signup", c("n"))).alias("__signups"))
    # One row per day and license by now: the day's signups go to each of them.
    signups = F.max("__signups").over(Window.partitionBy("activity_date"))
    return grouped.withColumn("businesses_created", F.when(c("activity_date").isNotNull(), signups)) \
        .where(c("license_name").isNotNull()).select(
        "activity_date", "license_name", "businesses_with_app", "applications_started", "businesses_quoted", "quotes_generated",
        "businesses_bound", "policies_bound", "total_premium_bound", "total_estimated_commission",
        pct(c("policies_bound"), c("quotes_generated")).alias("quote_to_bind_rate_pct"), "businesses_created")


@model("nb_sales_daily", "marts",
       deps=("int_nb_revenue_transaction", "int_ae_sales_policy", "stg_business", "stg_license",
             "stg_employee_contact_information", "dim_date"))
def nb_sales_daily(b: Build):
    """MRT-04: daily net NB revenue and AE-sales policies per license and AE.

    The reference flags each business's first counted transaction of a month
    with row_number(). Here each (business, day) aggregate, which combines in the map tasks,
    also keeps its first transaction; the month's first is the smallest of at most 31
    of them. The ledger is read once, no window sorts a hot business in one task, and
    what a hot business sends through the join is bounded by the calendar."""
    zero = F.lit(0).cast(MONEY)
    rev = b.ref("int_nb_revenue_transaction")
    revenue_rows = rev.select(
        "business_id", c("booked_date").alias("activity_date"), c("signed_amount").alias("amount"), "revenue_bucket",
        F.struct(c("booked_at").isNull().alias("undated"), "booked_at", "policy_transaction_id").alias("first"),
        F.lit(0).alias("policy_count"), zero.alias("policy_premium"))
    pol = b.ref("int_ae_sales_policy").where(c("is_ae_sales_policy"))
    policy_rows = pol.select("business_id", c("policy_created_date").alias("activity_date"), zero.alias("amount"),
                             F.lit(1).alias("policy_count"), c("premium").alias("policy_premium"))
    rows = revenue_rows.unionByName(policy_rows, allowMissingColumns=True)
    bucket = c("revenue_bucket")
    sums = ("amount", "commission", "tech_fee", "endorsement", "cancellation", "policy_count", "policy_premium")
    each_day = rows.groupBy("business_id", "activity_date").agg(
        F.sum("amount").alias("amount"),
        F.sum(F.when(bucket == "COMMISSION", c("amount"))).alias("commission"),
        F.sum(F.when(bucket == "TECH_FEE", c("amount"))).alias("tech_fee"),
        F.sum(F.when(bucket == "ENDORSEMENT", c("amount"))).alias("endorsement"),
        F.sum(F.when(bucket == "CANCELLATION", c("amount"))).alias("cancellation"),
        F.sum("policy_count").alias("policy_count"),
        F.sum("policy_premium").alias("policy_premium"),
        F.min("first").alias("first"),
    )
    months = each_day.groupBy("business_id", F.trunc("activity_date", "month").alias("__month")).agg(
        F.collect_list(F.struct("activity_date", *sums, "first")).alias("days"), F.min("first").alias("month_first"))
    per_day = months.select("business_id", "month_first", F.inline("days")).select(
        "business_id", "activity_date", *sums,
        flag(c("first.policy_transaction_id") == c("month_first.policy_transaction_id")).alias("first_in_month"))
    biz = b.ref("stg_business").select(c("business_id").alias("__bid"), c("license_name").alias("__lic"),
                                       "sold_by", c("created_month").alias("__cm"))
    lic = b.dim("stg_license", c("license_name").alias("__l"), "partner_name", "transfer_type")
    emp = b.dim("stg_employee_contact_information", c("employee_name").alias("__e"), "team")
    d = _dates(b)
    j = (per_day.join(biz, per_day["business_id"] == biz["__bid"])
         .join(lic, c("__lic") == lic["__l"], "left")
         .join(emp, c("sold_by") == emp["__e"], "left")
         .join(d, per_day["activity_date"] == d["__day"]))
    return j.groupBy(
        "activity_date",
        (F.trunc("activity_date", "month") == c("__cm")).alias("same_month_sale"),
        F.coalesce(c("__lic"), F.lit("(no license)")).alias("license_name"),
        c("sold_by").alias("account_executive"),
    ).agg(
        F.max("week_start").alias("week_start"), F.max("month_start").alias("month_start"),
        F.max("quarter_start").alias("quarter_start"), F.max("year").alias("year"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.max(F.coalesce(c("transfer_type"), F.lit("Partner"))).alias("transfer_type"),
        F.max("partner_name").alias("partner_name"), F.max("team").alias("ae_team"),
        F.sum("amount").alias("nb_net_revenue"),
        F.sum("commission").alias("commission"), F.sum("tech_fee").alias("tech_fee"),
        F.sum("endorsement").alias("endorsement"), F.sum("cancellation").alias("cancellation"),
        F.sum("first_in_month").alias("business_count"),
        F.sum("policy_count").alias("ae_sales_policies"),
        F.sum("policy_premium").alias("ae_sales_premium"),
    )


@model("ringba_calls_daily", "marts", deps=("int_ringba_call", "dim_date"))
def ringba_calls_daily(b: Build):
    """MRT-07: calls per day x partner x campaign (each call once)."""
    calls = b.ref("int_ringba_call")
    d = _dates(b)
    j = calls.join(d, calls["call_date"] == d["__day"])
    ans = c("is_answered")
    return j.groupBy("call_date", "partner_name", "campaign_name").agg(
        F.max("week_start").alias("week_start"), F.max("month_start").alias("month_start"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.bool_or("is_high_revenue_campaign").alias("is_high_revenue_campaign"),
        F.count(F.lit(1)).alias("calls"),
        _count_if(c("is_routed")).alias("routed_calls"),
        _count_if(ans).alias("answered_calls"),
        _count_if(c("is_missed")).alias("missed_calls"),
        _count_if(c("is_unrouted")).alias("unrouted_calls"),
        _count_if(c("is_duplicate")).alias("duplicate_calls"),
        _count_if(c("is_no_target_found")).alias("no_target_found_calls"),
        _count_if(c("has_converted")).alias("converted_calls"),
        F.sum("ae_count_dialed").alias("ae_dials"),
        F.sum("no_answer_events").alias("no_answer_events"),
        F.coalesce(F.sum(F.when(ans, c("seconds_to_answer"))), F.lit(0)).alias("total_seconds_to_answer"),
        F.coalesce(F.sum(F.when(ans, c("call_length_seconds"))), F.lit(0)).alias("answered_talk_seconds"),
    )


@model("ringba_ae_calls_daily", "marts", deps=("int_ringba_call_ae", "dim_date"))
def ringba_ae_calls_daily(b: Build):
    """MRT-06: calls per day x AE x partner."""
    a = b.ref("int_ringba_call_ae")
    d = _dates(b)
    j = a.join(d, a["call_date"] == d["__day"])
    return j.groupBy("call_date", "account_executive", "partner_name").agg(
        F.max("ae_team").alias("ae_team"), F.max("ae_employee_type").alias("ae_employee_type"),
        F.max("week_start").alias("week_start"), F.max("month_start").alias("month_start"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.count(F.lit(1)).alias("calls_routed"),
        _count_if(c("was_dialed")).alias("calls_dialed"),
        _count_if(c("was_answered")).alias("calls_answered"),
        _count_if(c("was_missed")).alias("calls_missed"),
        _count_if(c("was_missed") & c("call_was_answered")).alias("missed_calls_answered_by_other"),
        _count_if(c("was_answered") & c("is_duplicate")).alias("duplicate_calls_answered"),
        F.sum("no_answer_events").alias("no_answer_events"),
        F.sum("busy_events").alias("busy_events"),
        F.coalesce(F.sum("answered_call_length_seconds"), F.lit(0)).alias("answered_talk_seconds"),
    )


# Output ordering of the reference's stored tables (SRT-01); NULLs first on DESC as in Postgres.
ORDERINGS = {
    "ae_performance_monthly": (("activity_month", "desc"), ("total_premium", "desc")),
    "business_funnel_daily": (("activity_date", "desc"), ("license_name", "asc")),
    "policy_revenue_summary": (("bound_month", "desc"), ("gross_written_premium", "desc")),
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    if name not in ORDERINGS:
        return df
    return df.orderBy(*[F.desc_nulls_first(k) if d == "desc" else F.asc_nulls_last(k) for k, d in ORDERINGS[name]])
