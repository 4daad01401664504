"""Staging models (STG-01..STG-20): one per source, row-preserving renames,
casts, Eastern time and row flags. Each is a single projection (plus the two
ChangeLog filters), so Catalyst prunes unread columns at the scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import settings as S
from ..functions import (
    PRODUCT,
    contains_any_upper, distinct_from, ilike_any, instant_to_eastern, instant_to_utc_wall,
    money, nullif_blank, parsed_json, rate, to_date, trunc_date, utc_wall_to_eastern, variant_has_key, variant_text,
)
from .registry import Build, model

c = F.col


def _false(name: str):
    return F.coalesce(c(name), F.lit(False))


@model("stg_application_submission", "staging")
def stg_application_submission(b: Build):
    a = b.source("ApplicationSubmission")
    admin = _false("isAdminQuotingTool")
    return a.select(
        c("id").alias("application_submission_id"),
        c("businessId").alias("business_id"),
        c("userId").alias("user_id"),
        c("applicationSubmissionBatchId").alias("application_submission_batch_id"),
        c("employeeContactInformationId").alias("employee_contact_information_id"),
        c("policyType").alias("policy_type"),
        c("licenseName").alias("license_name"),
        c("status"),
        c("status").isin(*S.SUBMITTED_STATUSES).alias("is_submitted"),
        c("source").alias("submission_source"),
        _false("isCrossSell").alias("is_cross_sell"),
        _false("isHybrid").alias("is_hybrid"),
        admin.alias("is_admin_quoting_tool"),
        (admin & c("applicationSubmissionBatchId").isNull()).alias("is_admin_rater"),
        (admin & c("applicationSubmissionBatchId").isNotNull()).alias("is_manual_application"),
        _false("isPostPurchaseCrossSell").alias("is_post_purchase_cross_sell"),
        c("isRateCall1").alias("is_rate_call1"),
        _false("isPaygo").alias("is_paygo"),
        _false("reminded").alias("reminded"),
        _false("viewed").alias("viewed"),
        c("missingFields").alias("missing_fields"),
        c("createdAt").alias("created_at"),
        to_date("createdAt").alias("created_date"),
        c("updatedAt").alias("updated_at"),
        to_date("effectiveDate").alias("effective_date"),
        to_date("expiryDate").alias("expiry_date"),
        c("viewedAt").alias("viewed_at"),
    )


@model("stg_business", "staging")
def stg_business(b: Build):
    x = b.source("Business")
    return x.select(
        c("id").alias("business_id"),
        c("userId").alias("user_id"),
        c("businessClassificationId").alias("business_classification_id"),
        c("closeId").alias("close_lead_id"),
        c("leadOriginatorEmployeeId").alias("lead_originator_employee_id"),
        c("createdAtCohortId").alias("created_at_cohort_id"),
        c("name").alias("business_name"),
        F.upper(F.trim(c("legalEntityType"))).alias("legal_entity_type"),
        c("companyType").alias("company_type"),
        c("yearsInBusiness").alias("years_in_business"),
        c("businessStartYear").alias("business_start_year"),
        c("website"),
        c("totalAnnualRevenue").alias("total_annual_revenue"),
        c("totalAnnualPayroll").alias("total_annual_payroll"),
        c("totalNumberOfEmployees").alias("total_number_of_employees"),
        c("numberOfOwnerOfficers").alias("number_of_owner_officers"),
        c("licenseName").alias("license_name"),
        c("warmTransferCampaign").alias("warm_transfer_campaign"),
        F.when(F.lower(c("warmTransferCampaign")).like("%carrier%"), "Test").otherwise("Prod")
        .alias("campaign_type"),
        c("tivlyCampaign").alias("tivly_campaign"),
        c("partnerTrackingId").alias("partner_tracking_id"),
        c("isQualifiedPartnerLead").alias("is_qualified_partner_lead"),
        c("qualifiedPartnerLeadAt").alias("qualified_partner_lead_at"),
        c("hasBeenSold").alias("has_been_sold"),
        c("accountExecutive").alias("account_executive"),
        c("accountManager").alias("account_manager"),
        c("soldBy").alias("sold_by"),
        F.coalesce(c("soldBy"), c("accountExecutive")).alias("credited_account_executive"),
        c("closeStatus").alias("close_status"),
        c("closeJunkParentReason").alias("close_junk_parent_reason"),
        c("closeJunkExplanation").alias("close_junk_explanation"),
        c("isHighRisk").alias("is_high_risk"),
        c("highRiskReason").alias("high_risk_reason"),
        _false("isTest").alias("is_test_flag"),
        c("createdAt").alias("created_at"),
        to_date("createdAt").alias("created_date"),
        trunc_date("createdAt", "week").alias("created_week"),
        trunc_date("createdAt", "month").alias("created_month"),
    )


@model("stg_business_classification", "staging")
def stg_business_classification(b: Build):
    return b.source("BusinessClassification").select(
        c("id").alias("business_classification_id"),
        c("display").alias("classification_name"),
        c("naics17").alias("naics_code"),
        c("industry"),
        c("subIndustry").alias("sub_industry"),
        c("filter3").alias("naics_sub_industry"),
        c("sicCode").alias("sic_code"),
    )


@model("stg_business_close_status_change", "staging")
def stg_business_close_status_change(b: Build):
    log = b.source("ChangeLog").where((c("entityType") == "BUSINESS") & (c("fieldName") == "closeStatus"))
    return log.where(c("newValue").isNotNull() & distinct_from("oldValue", "newValue")).select(
        c("id").alias("change_log_id"),
        c("entityId").alias("business_id"),
        c("oldValue").alias("old_close_status"),
        c("newValue").alias("new_close_status"),
        c("changedBy").alias("changed_by"),
        c("createdAt").alias("created_at"),
    )


@model("stg_campaign_status", "staging")
def stg_campaign_status(b: Build):
    return b.source("CampaignStatus").select(
        c("id").alias("campaign_status_id"),
        c("partnerId").alias("partner_id"),
        c("campaignName").alias("campaign_name"),
        c("campaignExternalId").alias("campaign_external_id"),
        c("ringbaCampaignId").alias("ringba_campaign_id"),
        money("bidCost").alias("bid_cost"),
        _false("available").alias("is_available"),
        _false("isTivlyCampaign").alias("is_tivly_campaign"),
        _false("isHighRevenueCampaign").alias("is_high_revenue_campaign"),
        _false("containsEnterprise").alias("contains_enterprise"),
    )


@model("stg_carrier", "staging")
def stg_carrier(b: Build):
    group = F.lit("Other")
    for name, short in reversed(list(S.TRACKED_CARRIERS.items())):
        group = F.when(c("name") == name, short).otherwise(group)
    return b.source("Carrier").select(
        c("id").alias("carrier_id"),
        c("name").alias("carrier_name"),
        group.alias("carrier_group"),
        _false("isWholesaler").alias("is_wholesaler"),
        _false("agencyBill").alias("is_agency_bill"),
        (c("name") == S.TEST_CARRIER).alias("is_test_carrier"),
    )


@model("stg_employee_contact_information", "staging")
def stg_employee_contact_information(b: Build):
    return b.source("EmployeeContactInformation").select(
        c("id").alias("employee_id"),
        c("name").alias("employee_name"),
        c("email"),
        c("employeeType").alias("employee_type"),
        c("team"),
        c("operationsTeam").alias("operations_team"),
        _false("isActive").alias("is_active"),
        _false("isBelgradeAm").alias("is_belgrade_am"),
        to_date("startDate").alias("start_date"),
        to_date("endDate").alias("end_date"),
    )


@model("stg_lead", "staging")
def stg_lead(b: Build):
    return b.source("Lead").select(
        c("id").alias("lead_id"),
        c("businessId").alias("business_id"),
        c("userId").alias("user_id"),
        c("accountExecutive").alias("account_executive"),
        c("workflowTypeAssigned").alias("workflow_type_assigned"),
        c("previousAccountExecutives").alias("previous_account_executives"),
        c("score"),
        c("madeContact").alias("made_contact"),
        c("isJunk").alias("is_junk"),
        c("timerPaused").alias("timer_paused"),
        c("isCurrentlyOnCallWithAe").alias("is_currently_on_call_with_ae"),
        c("createdAt").alias("created_at"),
        c("expiryTime").alias("expiry_time"),
        c("pausedTime").alias("paused_time"),
    )


@model("stg_license", "staging")
def stg_license(b: Build):
    cfg = b.cfg
    lic = b.source("License").alias("l")
    partner = b.source("Partner").select(c("id").alias("p_id"), c("name").alias("p_name"),
                                         c("profileType").alias("p_profile"))
    channel = (F.when(c("l.name").isin(*cfg.warm_transfer_licenses), "Warm Transfer")
               .when(c("l.name").isin(*cfg.data_lead_licenses), "Data Lead")
               .when(c("l.name").isin(*cfg.house_licenses), "Other Non-Partner")
               .otherwise("Partner"))
    return lic.join(partner, c("l.partnerId") == c("p_id"), "left").select(
        c("l.id").alias("license_id"),
        c("l.name").alias("license_name"),
        c("l.partnerId").alias("partner_id"),
        c("l.parentLicenseId").alias("parent_license_id"),
        c("p_name").alias("partner_name"),
        c("p_profile").alias("partner_profile_type"),
        channel.alias("transfer_type"),
        c("l.integrationType").alias("integration_type"),
        c("l.leadIntakeType").alias("lead_intake_type"),
        c("l.policyType").alias("policy_type"),
        c("l.companyType").alias("company_type"),
        _false("l.instantPayEnabled").alias("is_instant_pay_enabled"),
        _false("l.leadSellingEnabled").alias("is_lead_selling_enabled"),
        c("l.laqPriority").alias("laq_priority"),
        c("l.createdAt").alias("created_at"),
    )


@model("stg_opportunity", "staging")
def stg_opportunity(b: Build):
    return b.source("Opportunity").select(
        c("id").alias("opportunity_id"),
        c("businessId").alias("business_id"),
        c("policyId").alias("policy_id"),
        c("closeOpportunityId").alias("close_opportunity_id"),
        c("employeeContactInformationId").alias("employee_contact_information_id"),
        c("policyType").alias("policy_type"),
        c("status"),
        c("status").like("SIT%").alias("is_surplus_lines"),
        c("confidence"),
        c("description"),
        c("createdAt").alias("created_at"),
        c("updatedAt").alias("updated_at"),
        c("statusLastUpdatedAt").alias("status_last_updated_at"),
    )


@model("stg_opportunity_status_history", "staging")
def stg_opportunity_status_history(b: Build):
    h = b.source("OpportunityStatusHistory").alias("h")
    opp = b.source("Opportunity").select(c("id").alias("o_id"), c("businessId").alias("o_business_id"))
    return h.join(opp, c("h.opportunityId") == c("o_id"), "left").select(
        c("h.id").alias("opportunity_status_history_id"),
        c("h.opportunityId").alias("opportunity_id"),
        c("o_business_id").alias("business_id"),
        c("h.changeType").alias("change_type"),
        c("h.from").alias("from_value"),
        c("h.to").alias("to_value"),
        c("h.createdAt").alias("created_at"),
    )


@model("stg_partner", "staging")
def stg_partner(b: Build):
    return b.source("Partner").select(
        c("id").alias("partner_id"),
        c("name").alias("partner_name"),
        c("profileType").alias("partner_profile_type"),
        _false("payGoEnabled").alias("is_paygo_enabled"),
        c("createdAt").alias("created_at"),
    )


@model("stg_policy", "staging")
def stg_policy(b: Build):
    sale_type = F.coalesce(c("saleType"), F.lit("NEW_BUSINESS"))
    return b.source("Policy").select(
        c("id").alias("policy_id"),
        c("businessId").alias("business_id"),
        c("carrierId").alias("carrier_id"),
        c("quoteId").alias("quote_id"),
        c("externalPolicyId").alias("external_policy_id"),
        c("closeOpportunityId").alias("close_opportunity_id"),
        c("closePolicyId").alias("close_policy_id"),
        c("renewedFromPolicyId").alias("renewed_from_policy_id"),
        c("policyCancellationReasonId").alias("policy_cancellation_reason_id"),
        c("policyType").alias("policy_type"),
        c("licenseName").alias("license_name"),
        c("status"),
        (c("status") == "BOUND").alias("is_active"),
        c("billingType").alias("billing_type"),
        sale_type.alias("sale_type"),
        (sale_type == "NEW_BUSINESS").alias("is_new_business"),
        sale_type.isin(*S.RETAINED_SALE_TYPES).alias("is_retained_sale_type"),
        c("salesChannel").alias("sales_channel"),
        c("underwritingCarrier").alias("underwriting_carrier"),
        c("accountExecutive").alias("account_executive"),
        c("assignedAgent").alias("assigned_agent"),
        money("premium").alias("premium"),
        money("commissionablePremium").alias("commissionable_premium"),
        rate("commissionRate").alias("commission_rate"),
        (money("premium") * rate("commissionRate")).cast(PRODUCT).alias("estimated_commission"),
        money("downPayment").alias("down_payment"),
        money("monthlyPayment").alias("monthly_payment"),
        money("mmrFee").alias("mmr_fee"),
        c("isRenewal").alias("is_renewal"),
        c("renewalCount").alias("renewal_count"),
        c("borRenewal").alias("bor_renewal"),
        c("isCancelRewrite").alias("is_cancel_rewrite"),
        c("isReinstated").alias("is_reinstated"),
        _false("isPartial").alias("is_partial"),
        _false("instantPay").alias("is_instant_pay"),
        _false("isPaygo").alias("is_paygo"),
        c("isAutoBind").alias("is_auto_bind"),
        c("cancellationStatus").alias("cancellation_status"),
        to_date("cancellationDate").alias("cancellation_date"),
        to_date("cancellationEffectiveDate").alias("cancellation_effective_date"),
        c("cancellationReason").alias("cancellation_reason"),
        to_date("reinstatementDate").alias("reinstatement_date"),
        c("borAwayStatus").alias("bor_away_status"),
        to_date("borAwayDate").alias("bor_away_date"),
        to_date("effectiveDate").alias("effective_date"),
        to_date("expiryDate").alias("expiry_date"),
        c("createdAt").alias("created_at"),
        to_date("createdAt").alias("created_date"),
        c("updatedAt").alias("updated_at"),
    )


@model("stg_policy_status_change", "staging")
def stg_policy_status_change(b: Build):
    log = b.source("ChangeLog").where((c("entityType") == "POLICY") & (c("fieldName") == "status"))
    return log.select(
        c("id").alias("change_log_id"),
        c("entityId").alias("policy_id"),
        c("oldValue").alias("old_status"),
        c("newValue").alias("new_status"),
        c("changedBy").alias("changed_by"),
        c("createdAt").alias("changed_at"),
    )


@model("stg_policy_transaction", "staging")
def stg_policy_transaction(b: Build):
    t = c("transactionType")
    core = t.isin(*S.CORE_TYPES)
    bucket = (F.when(t.isin("COMMISSION", "COMMISSION_PARTIAL"), "COMMISSION")
              .when(t.isin("TECHNOLOGY_ACCESS_FEE", "TECHNOLOGY_ACCESS_FEE_PARTIAL", "AGENCY_FEE"), "TECH_FEE")
              .otherwise(t))
    cancel_driven = (t == "CANCELLATION") | (
        core & (c("direction") == "PAYABLE") & F.coalesce(c("description"), F.lit("")).ilike("%cancel%"))
    signed = F.when(c("direction") == "RECEIVABLE", c("amount")).otherwise(-c("amount"))
    return b.source("PolicyTransaction").select(
        c("id").alias("policy_transaction_id"),
        c("policyId").alias("policy_id"),
        t.alias("transaction_type"),
        c("direction"),
        c("status"),
        t.isin(*S.PARTIAL_TYPES).alias("is_partial_installment"),
        core.alias("is_core_revenue"),
        (~t.isin("CANCELLATION", *S.PARTIAL_TYPES)).alias("is_gross_revenue"),
        (t == "CANCELLATION").alias("is_cancellation"),
        cancel_driven.alias("is_cancellation_driven"),
        bucket.alias("revenue_bucket"),
        _false("isParent").alias("is_parent"),
        c("endorsementReason").alias("endorsement_reason"),
        c("description"),
        money("amount").alias("amount"),
        money(signed).alias("signed_amount"),
        money("totalAmount").alias("total_amount"),
        money("amountReceived").alias("amount_received"),
        rate("rate").alias("rate"),
        c("closedOut").alias("closed_out"),
        c("createdAt").alias("created_at"),
        to_date("createdAt").alias("created_date"),
        trunc_date("createdAt", "month").alias("created_month"),
        c("dueBy").alias("due_by"),
    )


@model("stg_quote", "staging")
def stg_quote(b: Build):
    eastern = instant_to_eastern("createdAt")
    return b.source("Quote").select(
        c("id").alias("quote_id"),
        c("businessId").alias("business_id"),
        c("applicationSubmissionId").alias("application_submission_id"),
        c("carrierId").alias("carrier_id"),
        c("opportunityId").alias("opportunity_id"),
        c("licenseName").alias("license_name"),
        c("policyTypeUpdated").alias("policy_type"),
        c("status"),
        c("billingType").alias("billing_type"),
        c("paymentInterval").alias("payment_interval"),
        _false("instantPay").alias("is_instant_pay"),
        _false("isHybridPay").alias("is_hybrid_pay"),
        (c("status") == "MANUAL").alias("is_manual"),
        F.coalesce(c("isVisible"), F.lit(True)).alias("is_visible"),
        c("underwritingCarrier").alias("underwriting_carrier"),
        money("price").alias("quoted_premium"),
        money("agencyFees").alias("agency_fees"),
        money("taxes").alias("taxes"),
        money("technologyFee").alias("technology_fee"),
        money("policyFee").alias("policy_fee"),
        money("mmrFee").alias("mmr_fee"),
        money("otherFees").alias("other_fees"),
        rate("commissionRate").alias("commission_rate"),
        money("downPayment").alias("down_payment"),
        money("installmentAmount").alias("installment_amount"),
        c("numOfInstallments").alias("num_of_installments"),
        eastern.alias("created_at"),
        F.to_date(eastern).alias("created_date"),
        instant_to_utc_wall("createdAt").alias("created_at_utc"),
        c("expiresAt").alias("expires_at"),
    )


@model("stg_ringba_call", "staging")
def stg_ringba_call(b: Build):
    called = utc_wall_to_eastern("callDt")
    return b.source("RingbaCallLog").select(
        c("id").alias("ringba_call_id"),
        c("inboundCallId").alias("inbound_call_id"),
        c("campaignStatusId").alias("campaign_status_id"),
        c("ringbaCampaignId").alias("ringba_campaign_id"),
        c("callerNumber").alias("caller_number"),
        _false("hasConnected").alias("has_connected"),
        _false("hasConverted").alias("has_converted"),
        F.coalesce(c("callLengthInSeconds"), F.lit(0)).alias("call_length_seconds"),
        called.alias("called_at"),
        c("callDt").alias("called_at_utc"),
        c("ingestedAt").alias("ingested_at"),
        F.to_date(F.coalesce(called, c("ingestedAt"))).alias("call_date"),
    )


@model("stg_ringba_call_event", "staging")
def stg_ringba_call_event(b: Build):
    return b.source("RingbaCallEvent").select(
        c("id").alias("ringba_call_event_id"),
        c("ringbaCallLogId").alias("ringba_call_id"),
        c("eventName").alias("event_name"),
        c("targetId").alias("target_id"),
        c("targetName").alias("target_name"),
        c("targetNumber").alias("target_number"),
        money("conversionAmount").alias("conversion_amount"),
        c("failReason").alias("fail_reason"),
        utc_wall_to_eastern("eventTimestamp").alias("event_at"),
        c("eventTimestamp").alias("event_at_utc"),
    )


@model("stg_user", "staging")
def stg_user(b: Build):
    full = F.concat(F.coalesce(c("firstName"), F.lit("")), F.lit(" "), F.coalesce(c("lastName"), F.lit("")))
    return b.source("User").select(
        c("id").alias("user_id"),
        c("email"),
        c("firstName").alias("first_name"),
        c("lastName").alias("last_name"),
        F.trim(full).alias("full_name"),
        c("phone"),
        contains_any_upper(full, b.cfg.test_tokens).alias("is_test_name"),
        c("isActive").alias("is_active"),
        c("subscribedToEmails").alias("subscribed_to_emails"),
        c("createdAt").alias("created_at"),
        c("lastLogin").alias("last_login"),
    )


@model("stg_warm_transfer", "staging")
def stg_warm_transfer(b: Build):
    reason = c("rejectionReason")
    category = F.when(reason.isNull(), F.lit(None).cast("string"))
    for label, patterns in S.REJECTION_BUCKETS:
        category = category.when(ilike_any(reason, patterns), label)
    category = category.otherwise(S.REJECTION_OTHER)
    vendor = F.lit(None).cast("string")
    for key, name in reversed(S.PAYLOAD_VENDOR_KEYS):
        vendor = F.when(variant_has_key("payload", key), name).otherwise(vendor)
    # The payload is parsed once a row, in a projection of its own that the reads below share.
    parsed = b.source("WarmTransfer").withColumn("payload", parsed_json("apiRequestJson"))
    return parsed.select(
        c("id").alias("warm_transfer_id"),
        c("businessId").alias("business_id"),
        c("campaignStatusId").alias("campaign_status_id"),
        c("externalBusinessId").alias("external_business_id"),
        c("status"),
        (c("status") == "ACCEPTED").alias("is_accepted"),
        (c("status") == "REJECTED").alias("is_rejected"),
        (c("status") == "ERROR").alias("is_error"),
        (c("status") == "RECEIVED").alias("is_received"),
        F.coalesce(c("claimedStatus"), F.lit("CLAIMED")).alias("claimed_status"),
        c("soldBy").alias("sold_by"),
        reason.alias("rejection_reason"),
        category.alias("rejection_reason_category"),
        vendor.alias("payload_vendor"),
        nullif_blank(variant_text("payload", "awlCampaign")).alias("awl_campaign"),
        money("bidPrice").alias("bid_price"),
        c("createdAt").alias("created_at"),
        to_date("createdAt").alias("created_date"),
        c("claimedAt").alias("claimed_at"),
        c("laqAssignedAt").alias("laq_assigned_at"),
        c("updatedAt").alias("updated_at"),
    )
