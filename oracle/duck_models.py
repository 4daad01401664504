"""DuckDB oracle for every model: hand-written SQL, independent of the Spark code.

Each entry of ``CTES`` is ``name -> (deps, select_sql)``; ``query_sql(name)``
stitches the needed CTEs in dependency order. Inputs are the driver tables
(pre-registered views); source tables are rebuilt from them with the shared
fixture adapters, rendered in the DuckDB dialect. Postgres semantics the
models rely on are spelled out explicitly here (NULLS FIRST on DESC, exact
HALF_UP rounding of ratios, date - date = integer days).
"""

from __future__ import annotations

from kestrel.sources.adapters import ADAPTERS, render

from . import constants as S

CFG = S.Deployment
AS_OF = f"DATE '{CFG.as_of.isoformat()}'"
SPINE_END = f"DATE '{CFG.spine_end.isoformat()}'"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def q(items) -> str:
    return ", ".join("'" + s.replace("'", "''") + "'" for s in items)


def dec(x: str, s: int = 4) -> str:
    return f"CAST({x} AS DECIMAL(18,{s}))"


def east(x: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {x}))"


def half_up_pct(num: str, den: str) -> str:
    """round(num/den*100, 2) for non-negative num, den > 0, exact (integer arithmetic)."""
    n = f"CAST(({num}) * 100000000 AS HUGEINT)"
    d = f"CAST(({den}) * 100000000 AS HUGEINT)"
    return (f"CASE WHEN coalesce({den}, 0) > 0 THEN "
            f"CAST(((2 * 10000 * {n}) + {d}) // (2 * {d}) AS DECIMAL(38,0)) * 0.01 END")


def half_up_avg(x: str, scale: int = 6) -> str:
    """avg(x) rounded HALF_UP to ``scale`` decimals for non-negative x, exact."""
    num = f"CAST(sum({x}) * 100000000 AS HUGEINT)"
    den = f"CAST(count({x}) * 100000000 AS HUGEINT)"
    p = 10 ** scale
    return (f"CASE WHEN count({x}) > 0 THEN CAST(((2 * {p} * {num}) + {den}) // (2 * {den}) AS DECIMAL(38,0))"
            f" * {'0.' + '0' * (scale - 1) + '1'} END")


# --- sources ---------------------------------------------------------------
for _name, (_inputs, _sql) in ADAPTERS.items():
    cte(f"src_{_name}", (), render(_name, "duckdb").format(**{t: t for t in _inputs}))

# --- staging -----------------------------------------------------------------
cte("stg_application_submission", ("src_ApplicationSubmission",), """
SELECT id AS application_submission_id, businessId AS business_id, userId AS user_id,
  applicationSubmissionBatchId AS application_submission_batch_id,
  employeeContactInformationId AS employee_contact_information_id, policyType AS policy_type,
  licenseName AS license_name, status, status IN ({sub}) AS is_submitted, source AS submission_source,
  coalesce(isCrossSell, false) AS is_cross_sell, coalesce(isHybrid, false) AS is_hybrid,
  coalesce(isAdminQuotingTool, false) AS is_admin_quoting_tool,
  coalesce(isAdminQuotingTool, false) AND applicationSubmissionBatchId IS NULL AS is_admin_rater,
  coalesce(isAdminQuotingTool, false) AND applicationSubmissionBatchId IS NOT NULL AS is_manual_application,
  coalesce(isPostPurchaseCrossSell, false) AS is_post_purchase_cross_sell, isRateCall1 AS is_rate_call1,
  coalesce(isPaygo, false) AS is_paygo, coalesce(reminded, false) AS reminded, coalesce(viewed, false) AS viewed,
  missingFields AS missing_fields, createdAt AS created_at, CAST(createdAt AS DATE) AS created_date,
  updatedAt AS updated_at, CAST(effectiveDate AS DATE) AS effective_date, CAST(expiryDate AS DATE) AS expiry_date,
  viewedAt AS viewed_at
FROM src_ApplicationSubmission""".format(sub=q(S.SUBMITTED_STATUSES)))

cte("stg_business", ("src_Business",), """
SELECT id AS business_id, userId AS user_id, businessClassificationId AS business_classification_id,
  closeId AS close_lead_id, leadOriginatorEmployeeId AS lead_originator_employee_id,
  createdAtCohortId AS created_at_cohort_id, name AS business_name, upper(trim(legalEntityType)) AS legal_entity_type,
  companyType AS company_type, yearsInBusiness AS years_in_business, businessStartYear AS business_start_year,
  website, totalAnnualRevenue AS total_annual_revenue, totalAnnualPayroll AS total_annual_payroll,
  totalNumberOfEmployees AS total_number_of_employees, numberOfOwnerOfficers AS number_of_owner_officers,
  licenseName AS license_name, warmTransferCampaign AS warm_transfer_campaign,
  CASE WHEN lower(warmTransferCampaign) LIKE '%carrier%' THEN 'Test' ELSE 'Prod' END AS campaign_type,
  tivlyCampaign AS tivly_campaign, partnerTrackingId AS partner_tracking_id,
  isQualifiedPartnerLead AS is_qualified_partner_lead, qualifiedPartnerLeadAt AS qualified_partner_lead_at,
  hasBeenSold AS has_been_sold, accountExecutive AS account_executive, accountManager AS account_manager,
  soldBy AS sold_by, coalesce(soldBy, accountExecutive) AS credited_account_executive,
  closeStatus AS close_status, closeJunkParentReason AS close_junk_parent_reason,
  closeJunkExplanation AS close_junk_explanation, isHighRisk AS is_high_risk, highRiskReason AS high_risk_reason,
  coalesce(isTest, false) AS is_test_flag, createdAt AS created_at, CAST(createdAt AS DATE) AS created_date,
  CAST(date_trunc('week', createdAt) AS DATE) AS created_week,
  CAST(date_trunc('month', createdAt) AS DATE) AS created_month
FROM src_Business""")

cte("stg_business_classification", ("src_BusinessClassification",), """
SELECT id AS business_classification_id, display AS classification_name, naics17 AS naics_code, industry,
  subIndustry AS sub_industry, filter3 AS naics_sub_industry, sicCode AS sic_code
FROM src_BusinessClassification""")

cte("stg_business_close_status_change", ("src_ChangeLog",), """
SELECT id AS change_log_id, entityId AS business_id, oldValue AS old_close_status, newValue AS new_close_status,
  changedBy AS changed_by, createdAt AS created_at
FROM src_ChangeLog
WHERE entityType = 'BUSINESS' AND fieldName = 'closeStatus'
  AND newValue IS NOT NULL AND oldValue IS DISTINCT FROM newValue""")

cte("stg_campaign_status", ("src_CampaignStatus",), f"""
SELECT id AS campaign_status_id, partnerId AS partner_id, campaignName AS campaign_name,
  campaignExternalId AS campaign_external_id, ringbaCampaignId AS ringba_campaign_id, {dec('bidCost')} AS bid_cost,
  coalesce(available, false) AS is_available, coalesce(isTivlyCampaign, false) AS is_tivly_campaign,
  coalesce(isHighRevenueCampaign, false) AS is_high_revenue_campaign,
  coalesce(containsEnterprise, false) AS contains_enterprise
FROM src_CampaignStatus""")

cte("stg_carrier", ("src_Carrier",), """
SELECT id AS carrier_id, name AS carrier_name,
  CASE name WHEN 'Chubb' THEN 'Chubb' WHEN 'Great American Insurance Group' THEN 'GAIG' ELSE 'Other' END
    AS carrier_group,
  coalesce(isWholesaler, false) AS is_wholesaler, coalesce(agencyBill, false) AS is_agency_bill,
  name = 'Fake Insurance' AS is_test_carrier
FROM src_Carrier""")

cte("stg_employee_contact_information", ("src_EmployeeContactInformation",), """
SELECT id AS employee_id, name AS employee_name, email, employeeType AS employee_type, team,
  operationsTeam AS operations_team, coalesce(isActive, false) AS is_active,
  coalesce(isBelgradeAm, false) AS is_belgrade_am, CAST(startDate AS DATE) AS start_date,
  CAST(endDate AS DATE) AS end_date
FROM src_EmployeeContactInformation""")

cte("stg_lead", ("src_Lead",), """
SELECT id AS lead_id, businessId AS business_id, userId AS user_id, accountExecutive AS account_executive,
  workflowTypeAssigned AS workflow_type_assigned, previousAccountExecutives AS previous_account_executives,
  score, madeContact AS made_contact, isJunk AS is_junk, timerPaused AS timer_paused,
  isCurrentlyOnCallWithAe AS is_currently_on_call_with_ae, createdAt AS created_at, expiryTime AS expiry_time,
  pausedTime AS paused_time
FROM src_Lead""")

cte("stg_license", ("src_License", "src_Partner"), f"""
SELECT l.id AS license_id, l.name AS license_name, l.partnerId AS partner_id, l.parentLicenseId AS parent_license_id,
  p.name AS partner_name, p.profileType AS partner_profile_type,
  CASE WHEN l.name IN ({q(CFG.warm_transfer_licenses)}) THEN 'Warm Transfer'
       WHEN l.name IN ({q(CFG.data_lead_licenses)}) THEN 'Data Lead'
       WHEN l.name IN ({q(CFG.house_licenses)}) THEN 'Other Non-Partner'
       ELSE 'Partner' END AS transfer_type,
  l.integrationType AS integration_type, l.leadIntakeType AS lead_intake_type, l.policyType AS policy_type,
  l.companyType AS company_type, coalesce(l.instantPayEnabled, false) AS is_instant_pay_enabled,
  coalesce(l.leadSellingEnabled, false) AS is_lead_selling_enabled, l.laqPriority AS laq_priority,
  l.createdAt AS created_at
FROM src_License l LEFT JOIN src_Partner p ON p.id = l.partnerId""")

cte("stg_opportunity", ("src_Opportunity",), """
SELECT id AS opportunity_id, businessId AS business_id, policyId AS policy_id,
  closeOpportunityId AS close_opportunity_id, employeeContactInformationId AS employee_contact_information_id,
  policyType AS policy_type, status, status LIKE 'SIT%' AS is_surplus_lines, confidence, description,
  createdAt AS created_at, updatedAt AS updated_at, statusLastUpdatedAt AS status_last_updated_at
FROM src_Opportunity""")

cte("stg_opportunity_status_history", ("src_OpportunityStatusHistory", "src_Opportunity"), """
SELECT h.id AS opportunity_status_history_id, h.opportunityId AS opportunity_id, o.businessId AS business_id,
  h.changeType AS change_type, h."from" AS from_value, h."to" AS to_value, h.createdAt AS created_at
FROM src_OpportunityStatusHistory h LEFT JOIN src_Opportunity o ON o.id = h.opportunityId""")

cte("stg_partner", ("src_Partner",), """
SELECT id AS partner_id, name AS partner_name, profileType AS partner_profile_type,
  coalesce(payGoEnabled, false) AS is_paygo_enabled, createdAt AS created_at
FROM src_Partner""")

cte("stg_policy", ("src_Policy",), f"""
SELECT id AS policy_id, businessId AS business_id, carrierId AS carrier_id, quoteId AS quote_id,
  externalPolicyId AS external_policy_id, closeOpportunityId AS close_opportunity_id,
  closePolicyId AS close_policy_id, renewedFromPolicyId AS renewed_from_policy_id,
  policyCancellationReasonId AS policy_cancellation_reason_id, policyType AS policy_type,
  licenseName AS license_name, status, status = 'BOUND' AS is_active, billingType AS billing_type,
  coalesce(saleType, 'NEW_BUSINESS') AS sale_type,
  coalesce(saleType, 'NEW_BUSINESS') = 'NEW_BUSINESS' AS is_new_business,
  coalesce(saleType, 'NEW_BUSINESS') IN ({q(S.RETAINED_SALE_TYPES)}) AS is_retained_sale_type,
  salesChannel AS sales_channel, underwritingCarrier AS underwriting_carrier,
  accountExecutive AS account_executive, assignedAgent AS assigned_agent,
  {dec('premium')} AS premium, {dec('commissionablePremium')} AS commissionable_premium,
  {dec('commissionRate', 6)} AS commission_rate, CAST({dec('premium')} * {dec('commissionRate', 6)} AS DECIMAL(24,8)) AS estimated_commission,
  {dec('downPayment')} AS down_payment, {dec('monthlyPayment')} AS monthly_payment, {dec('mmrFee')} AS mmr_fee,
  isRenewal AS is_renewal, renewalCount AS renewal_count, borRenewal AS bor_renewal,
  isCancelRewrite AS is_cancel_rewrite, isReinstated AS is_reinstated, coalesce(isPartial, false) AS is_partial,
  coalesce(instantPay, false) AS is_instant_pay, coalesce(isPaygo, false) AS is_paygo, isAutoBind AS is_auto_bind,
  cancellationStatus AS cancellation_status, CAST(cancellationDate AS DATE) AS cancellation_date,
  CAST(cancellationEffectiveDate AS DATE) AS cancellation_effective_date, cancellationReason AS cancellation_reason,
  CAST(reinstatementDate AS DATE) AS reinstatement_date, borAwayStatus AS bor_away_status,
  CAST(borAwayDate AS DATE) AS bor_away_date, CAST(effectiveDate AS DATE) AS effective_date,
  CAST(expiryDate AS DATE) AS expiry_date, createdAt AS created_at, CAST(createdAt AS DATE) AS created_date,
  updatedAt AS updated_at
FROM src_Policy""")

cte("stg_policy_status_change", ("src_ChangeLog",), """
SELECT id AS change_log_id, entityId AS policy_id, oldValue AS old_status, newValue AS new_status,
  changedBy AS changed_by, createdAt AS changed_at
FROM src_ChangeLog WHERE entityType = 'POLICY' AND fieldName = 'status'""")

cte("stg_policy_transaction", ("src_PolicyTransaction",), f"""
SELECT id AS policy_transaction_id, policyId AS policy_id, transactionType AS transaction_type, direction, status,
  transactionType IN ({q(S.PARTIAL_TYPES)}) AS is_partial_installment,
  transactionType IN ({q(S.CORE_TYPES)}) AS is_core_revenue,
  transactionType NOT IN ('CANCELLATION', {q(S.PARTIAL_TYPES)}) AS is_gross_revenue,
  transactionType = 'CANCELLATION' AS is_cancellation,
  transactionType = 'CANCELLATION' OR (transactionType IN ({q(S.CORE_TYPES)}) AND direction = 'PAYABLE'
    AND coalesce(description, '') ILIKE '%cancel%') AS is_cancellation_driven,
  CASE WHEN transactionType IN ('COMMISSION', 'COMMISSION_PARTIAL') THEN 'COMMISSION'
       WHEN transactionType IN ('TECHNOLOGY_ACCESS_FEE', 'TECHNOLOGY_ACCESS_FEE_PARTIAL', 'AGENCY_FEE') THEN 'TECH_FEE'
       ELSE transactionType END AS revenue_bucket,
  coalesce(isParent, false) AS is_parent, endorsementReason AS endorsement_reason, description,
  {dec('amount')} AS amount,
  {dec("CASE WHEN direction = 'RECEIVABLE' THEN amount ELSE -amount END")} AS signed_amount,
  {dec('totalAmount')} AS total_amount, {dec('amountReceived')} AS amount_received, {dec('rate', 6)} AS rate,
  closedOut AS closed_out, createdAt AS created_at, CAST(createdAt AS DATE) AS created_date,
  CAST(date_trunc('month', createdAt) AS DATE) AS created_month, dueBy AS due_by
FROM src_PolicyTransaction""")

cte("stg_quote", ("src_Quote",), f"""
SELECT id AS quote_id, businessId AS business_id, applicationSubmissionId AS application_submission_id,
  carrierId AS carrier_id, opportunityId AS opportunity_id, licenseName AS license_name,
  policyTypeUpdated AS policy_type, status, billingType AS billing_type, paymentInterval AS payment_interval,
  coalesce(instantPay, false) AS is_instant_pay, coalesce(isHybridPay, false) AS is_hybrid_pay,
  status = 'MANUAL' AS is_manual, coalesce(isVisible, true) AS is_visible,
  underwritingCarrier AS underwriting_carrier, {dec('price')} AS quoted_premium, {dec('agencyFees')} AS agency_fees,
  {dec('taxes')} AS taxes, {dec('technologyFee')} AS technology_fee, {dec('policyFee')} AS policy_fee,
  {dec('mmrFee')} AS mmr_fee, {dec('otherFees')} AS other_fees, {dec('commissionRate', 6)} AS commission_rate,
  {dec('downPayment')} AS down_payment, {dec('installmentAmount')} AS installment_amount,
  numOfInstallments AS num_of_installments,
  timezone('America/New_York', createdAt) AS created_at,
  CAST(timezone('America/New_York', createdAt) AS DATE) AS created_date,
  timezone('UTC', createdAt) AS created_at_utc, expiresAt AS expires_at
FROM src_Quote""")

cte("stg_ringba_call", ("src_RingbaCallLog",), f"""
SELECT id AS ringba_call_id, inboundCallId AS inbound_call_id, campaignStatusId AS campaign_status_id,
  ringbaCampaignId AS ringba_campaign_id, callerNumber AS caller_number,
  coalesce(hasConnected, false) AS has_connected, coalesce(hasConverted, false) AS has_converted,
  coalesce(callLengthInSeconds, 0) AS call_length_seconds, {east('callDt')} AS called_at, callDt AS called_at_utc,
  ingestedAt AS ingested_at, CAST(coalesce({east('callDt')}, ingestedAt) AS DATE) AS call_date
FROM src_RingbaCallLog""")

cte("stg_ringba_call_event", ("src_RingbaCallEvent",), f"""
SELECT id AS ringba_call_event_id, ringbaCallLogId AS ringba_call_id, eventName AS event_name,
  targetId AS target_id, targetName AS target_name, targetNumber AS target_number,
  {dec('conversionAmount')} AS conversion_amount, failReason AS fail_reason,
  {east('eventTimestamp')} AS event_at, eventTimestamp AS event_at_utc
FROM src_RingbaCallEvent""")

_full = "(coalesce(firstName, '') || ' ' || coalesce(lastName, ''))"
cte("stg_user", ("src_User",), f"""
SELECT id AS user_id, email, firstName AS first_name, lastName AS last_name, trim({_full}) AS full_name, phone,
  {' OR '.join(f"upper({_full}) LIKE '%{t}%'" for t in CFG.test_tokens)} AS is_test_name,
  isActive AS is_active, subscribedToEmails AS subscribed_to_emails, createdAt AS created_at,
  lastLogin AS last_login
FROM src_User""")

_reason_case = "CASE WHEN rejectionReason IS NULL THEN NULL\n" + "\n".join(
    "  WHEN " + " OR ".join(f"rejectionReason ILIKE '{p}'" for p in pats) + f" THEN '{label}'"
    for label, pats in S.REJECTION_BUCKETS) + f"\n  ELSE '{S.REJECTION_OTHER}' END"
_vendor_case = "CASE " + " ".join(
    f"WHEN list_contains(json_keys(apiRequestJson), '{k}') THEN '{v}'" for k, v in S.PAYLOAD_VENDOR_KEYS) + " END"
cte("stg_warm_transfer", ("src_WarmTransfer",), f"""
SELECT id AS warm_transfer_id, businessId AS business_id, campaignStatusId AS campaign_status_id,
  externalBusinessId AS external_business_id, status, status = 'ACCEPTED' AS is_accepted,
  status = 'REJECTED' AS is_rejected, status = 'ERROR' AS is_error, status = 'RECEIVED' AS is_received,
  coalesce(claimedStatus, 'CLAIMED') AS claimed_status, soldBy AS sold_by, rejectionReason AS rejection_reason,
  {_reason_case} AS rejection_reason_category,
  {_vendor_case} AS payload_vendor,
  nullif(trim(json_extract_string(apiRequestJson, '$.awlCampaign')), '') AS awl_campaign,
  {dec('bidPrice')} AS bid_price, createdAt AS created_at, CAST(createdAt AS DATE) AS created_date,
  claimedAt AS claimed_at, laqAssignedAt AS laq_assigned_at, updatedAt AS updated_at
FROM src_WarmTransfer""")

# --- int_business stages -------------------------------------------------------
cte("int_business_lead", ("stg_lead",), """
SELECT business_id, lead_id, account_executive AS lead_account_executive, workflow_type_assigned, made_contact,
  is_junk, score AS lead_score, created_at AS lead_created_at, expiry_time AS lead_expiry_time
FROM (SELECT *, row_number() OVER (PARTITION BY business_id
                                   ORDER BY created_at DESC NULLS FIRST, lead_id DESC) AS rn
      FROM stg_lead WHERE business_id IS NOT NULL) x
WHERE rn = 1""")

cte("int_business_warm_transfer", ("stg_warm_transfer",), """
SELECT a.business_id, a.warm_transfer_count, a.warm_transfer_bid_price, a.first_warm_transfer_at,
  l.claimed_status AS warm_transfer_claimed_status, l.status AS warm_transfer_status,
  l.campaign_status_id AS warm_transfer_campaign_status_id
FROM (SELECT business_id, count(*) AS warm_transfer_count, sum(bid_price) AS warm_transfer_bid_price,
             min(created_at) AS first_warm_transfer_at
      FROM stg_warm_transfer WHERE business_id IS NOT NULL GROUP BY business_id) a
JOIN (SELECT business_id, claimed_status, status, campaign_status_id,
             row_number() OVER (PARTITION BY business_id
                                ORDER BY created_at DESC NULLS FIRST, warm_transfer_id DESC) AS rn
      FROM stg_warm_transfer WHERE business_id IS NOT NULL) l
  ON l.business_id = a.business_id AND l.rn = 1""")

cte("int_business_policy_rollup", ("stg_policy", "stg_carrier", "stg_business"), """
SELECT p.business_id,
  min(p.created_at) AS first_policy_created_at, count(*) AS policy_count, sum(p.premium) AS total_premium,
  count(*) FILTER (WHERE p.is_active) AS active_policy_count,
  sum(p.premium) FILTER (WHERE p.is_active) AS active_premium,
  min(p.created_at) FILTER (WHERE p.is_new_business) AS first_nb_policy_created_at,
  count(*) FILTER (WHERE p.is_new_business) AS nb_policy_count,
  sum(p.premium) FILTER (WHERE p.is_new_business) AS nb_premium,
  sum(p.premium) FILTER (WHERE p.is_new_business AND p.created_date - b.created_date <= 30) AS d30_nb_premium,
  min(p.created_at) FILTER (WHERE p.is_new_business AND c.carrier_group = 'Chubb') AS first_nb_chubb_policy_created_at,
  sum(p.premium) FILTER (WHERE p.is_new_business AND c.carrier_group = 'Chubb') AS nb_chubb_premium,
  sum(p.premium) FILTER (WHERE p.is_new_business AND c.carrier_group = 'Chubb'
                         AND p.created_date - b.created_date <= 30) AS d30_nb_chubb_premium,
  min(p.created_at) FILTER (WHERE p.is_new_business AND c.carrier_group = 'GAIG') AS first_nb_gaig_policy_created_at,
  sum(p.premium) FILTER (WHERE p.is_new_business AND c.carrier_group = 'GAIG') AS nb_gaig_premium,
  sum(p.premium) FILTER (WHERE p.is_new_business AND c.carrier_group = 'GAIG'
                         AND p.created_date - b.created_date <= 30) AS d30_nb_gaig_premium
FROM stg_policy p
JOIN stg_carrier c ON c.carrier_id = p.carrier_id
JOIN stg_business b ON b.business_id = p.business_id
WHERE NOT c.is_test_carrier
GROUP BY p.business_id""")

cte("int_business_quote_rollup", ("stg_quote", "stg_carrier"), """
SELECT q.business_id, min(q.created_at) AS first_quote_created_at, count(*) AS quote_count,
  sum(q.quoted_premium) AS total_quoted_premium,
  min(q.created_at) FILTER (WHERE c.carrier_group = 'Chubb') AS first_chubb_quote_created_at,
  sum(q.quoted_premium) FILTER (WHERE c.carrier_group = 'Chubb') AS chubb_quoted_premium,
  min(q.created_at) FILTER (WHERE c.carrier_group = 'GAIG') AS first_gaig_quote_created_at,
  sum(q.quoted_premium) FILTER (WHERE c.carrier_group = 'GAIG') AS gaig_quoted_premium
FROM stg_quote q JOIN stg_carrier c ON c.carrier_id = q.carrier_id
WHERE q.business_id IS NOT NULL AND NOT c.is_test_carrier
GROUP BY q.business_id""")

_nbg = "p.is_new_business AND t.is_gross_revenue"
_days = "t.created_date - b.created_date"
cte("int_business_revenue_rollup", ("stg_policy_transaction", "stg_policy", "stg_carrier", "stg_business"), f"""
SELECT p.business_id,
  sum(t.signed_amount) FILTER (WHERE {_nbg} AND {_days} <= 7) AS d7_nb_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE {_nbg} AND {_days} <= 14) AS d14_nb_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE {_nbg} AND {_days} <= 30) AS d30_nb_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE {_nbg}) AS nb_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE {_nbg} AND c.carrier_group = 'Chubb' AND {_days} <= 30)
    AS d30_nb_chubb_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE {_nbg} AND c.carrier_group = 'GAIG' AND {_days} <= 30)
    AS d30_nb_gaig_gross_revenue,
  sum(t.signed_amount) FILTER (WHERE p.is_new_business AND t.is_core_revenue AND {_days} <= 30)
    AS d30_nb_core_revenue,
  sum(t.signed_amount) FILTER (WHERE p.is_new_business AND t.is_core_revenue) AS nb_core_revenue,
  sum(t.signed_amount) FILTER (WHERE p.is_new_business AND t.is_cancellation) AS nb_cancellation_amount,
  min(t.created_at) FILTER (WHERE p.is_new_business AND t.is_cancellation) AS first_nb_cancellation_booked_at,
  sum(t.signed_amount) FILTER (WHERE t.is_core_revenue) AS total_core_revenue
FROM stg_policy_transaction t
JOIN stg_policy p ON p.policy_id = t.policy_id
JOIN stg_carrier c ON c.carrier_id = p.carrier_id
JOIN stg_business b ON b.business_id = p.business_id
WHERE NOT c.is_test_carrier AND NOT t.is_partial_installment
GROUP BY p.business_id""")

cte("int_business_close_status", ("stg_business_close_status_change",), """
SELECT business_id,
  min(created_at) FILTER (WHERE new_close_status = 'Attempted to Contact') AS first_attempted_to_contact_at,
  min(created_at) FILTER (WHERE new_close_status = 'Made Contact') AS first_made_contact_at,
  min(created_at) FILTER (WHERE new_close_status = 'Junk') AS first_junk_at,
  min(created_at) FILTER (WHERE new_close_status = 'Customer') AS first_customer_status_at
FROM stg_business_close_status_change GROUP BY business_id""")

cte("int_business_opportunity_milestones", ("stg_opportunity_status_history",), """
SELECT business_id,
  min(created_at) FILTER (WHERE to_value = 'QUOTING') AS first_quoting_status_at,
  min(created_at) FILTER (WHERE to_value LIKE 'SIT%') AS first_sit_status_at,
  min(created_at) FILTER (WHERE to_value = 'QUOTED') AS first_quoted_status_at,
  min(created_at) FILTER (WHERE to_value = 'QUOTE_PRESENTED') AS first_quote_presented_at,
  min(created_at) FILTER (WHERE to_value = 'WON') AS first_won_status_at,
  min(created_at) FILTER (WHERE to_value = 'LOST') AS first_lost_status_at
FROM stg_opportunity_status_history
WHERE change_type = 'STATUS' AND business_id IS NOT NULL
GROUP BY business_id""")

cte("int_business_application_milestones", ("stg_application_submission",), """
SELECT business_id, min(created_at) AS first_application_started_at,
  count(*) FILTER (WHERE is_submitted) AS submitted_application_count,
  min(created_at) FILTER (WHERE is_submitted) AS first_application_submitted_at,
  min(created_at) FILTER (WHERE is_submitted AND viewed) AS first_viewed_application_submitted_at,
  min(created_at) FILTER (WHERE is_submitted AND is_admin_rater) AS first_admin_rater_application_at,
  min(created_at) FILTER (WHERE is_submitted AND is_manual_application) AS first_manual_application_at
FROM stg_application_submission WHERE business_id IS NOT NULL GROUP BY business_id""")

_days_to = [("attempted_to_contact", "cs.first_attempted_to_contact_at"), ("made_contact", "cs.first_made_contact_at"),
            ("junk", "cs.first_junk_at"), ("application_submitted", "am.first_application_submitted_at"),
            ("quote_presented", "om.first_quote_presented_at"), ("first_quote", "qr.first_quote_created_at"),
            ("first_chubb_quote", "qr.first_chubb_quote_created_at"),
            ("first_gaig_quote", "qr.first_gaig_quote_created_at"),
            ("first_policy", "pr.first_policy_created_at"), ("first_nb_policy", "pr.first_nb_policy_created_at"),
            ("first_nb_chubb_policy", "pr.first_nb_chubb_policy_created_at"),
            ("first_nb_gaig_policy", "pr.first_nb_gaig_policy_created_at")]
_zero = [("am", "submitted_application_count"), ("qr", "quote_count"), ("qr", "total_quoted_premium"),
         ("qr", "chubb_quoted_premium"), ("qr", "gaig_quoted_premium"), ("pr", "policy_count"),
         ("pr", "active_policy_count"), ("pr", "nb_policy_count"), ("pr", "total_premium"),
         ("pr", "active_premium"), ("pr", "nb_premium"), ("pr", "d30_nb_premium"), ("pr", "nb_chubb_premium"),
         ("pr", "d30_nb_chubb_premium"), ("pr", "nb_gaig_premium"), ("pr", "d30_nb_gaig_premium"),
         ("rr", "d7_nb_gross_revenue"), ("rr", "d14_nb_gross_revenue"), ("rr", "d30_nb_gross_revenue"),
         ("rr", "nb_gross_revenue"), ("rr", "d30_nb_chubb_gross_revenue"), ("rr", "d30_nb_gaig_gross_revenue"),
         ("rr", "d30_nb_core_revenue"), ("rr", "nb_core_revenue"), ("rr", "nb_cancellation_amount"),
         ("rr", "total_core_revenue")]
_milestones = ["cs.first_attempted_to_contact_at", "cs.first_made_contact_at", "cs.first_junk_at",
               "cs.first_customer_status_at", "am.first_application_started_at", "am.first_application_submitted_at",
               "am.first_viewed_application_submitted_at", "am.first_admin_rater_application_at",
               "am.first_manual_application_at", "om.first_quoting_status_at", "om.first_sit_status_at",
               "om.first_quoted_status_at", "om.first_quote_presented_at", "om.first_won_status_at",
               "om.first_lost_status_at", "qr.first_quote_created_at", "qr.first_chubb_quote_created_at",
               "qr.first_gaig_quote_created_at", "pr.first_policy_created_at", "pr.first_nb_policy_created_at",
               "pr.first_nb_chubb_policy_created_at", "pr.first_nb_gaig_policy_created_at",
               "rr.first_nb_cancellation_booked_at"]
cte("int_business_joined",
    ("stg_business", "stg_user", "stg_license", "stg_employee_contact_information", "stg_business_classification",
     "stg_campaign_status", "int_business_lead", "int_business_warm_transfer", "int_business_policy_rollup",
     "int_business_quote_rollup", "int_business_revenue_rollup", "int_business_close_status",
     "int_business_opportunity_milestones", "int_business_application_milestones"), f"""
SELECT b.business_id, b.user_id, b.close_lead_id, b.business_name, u.full_name AS owner_name, u.email AS owner_email,
  b.legal_entity_type, b.company_type, b.total_annual_revenue, b.total_annual_payroll, b.total_number_of_employees,
  b.years_in_business, b.close_status, b.is_high_risk,
  b.is_test_flag OR coalesce(u.is_test_name, false) AS is_test_business,
  b.created_at AS business_created_at, b.created_date AS business_created_date,
  b.created_week AS business_created_week, b.created_month AS business_created_month,
  {AS_OF} - b.created_date AS business_age_days,
  b.license_name, lic.partner_name, lic.partner_profile_type, coalesce(lic.transfer_type, 'Partner') AS transfer_type,
  b.warm_transfer_campaign, b.campaign_type, cmp.campaign_name AS warm_transfer_campaign_name,
  CASE WHEN wt.business_id IS NULL THEN 'OTHER' ELSE wt.warm_transfer_claimed_status END AS claimed_status,
  wt.warm_transfer_status, wt.first_warm_transfer_at, coalesce(wt.warm_transfer_bid_price, 0) AS warm_transfer_bid_price,
  b.credited_account_executive, e.team AS credited_ae_team, e.employee_type AS credited_ae_employee_type,
  b.account_executive, b.account_manager, b.sold_by, l.lead_id, l.lead_account_executive,
  coalesce(l.workflow_type_assigned, 'NONE') AS workflow_type, l.made_contact, l.is_junk, l.lead_score,
  l.lead_created_at, l.lead_expiry_time,
  cls.classification_name, cls.naics_code, cls.industry, cls.sub_industry, cls.naics_sub_industry,
  {', '.join(_milestones)},
  {', '.join(f'CAST({ts} AS DATE) - b.created_date AS days_to_{n}' for n, ts in _days_to)},
  {', '.join(f'coalesce({a}.{x}, 0) AS {x}' for a, x in _zero)}
FROM stg_business b
LEFT JOIN stg_user u ON u.user_id = b.user_id
LEFT JOIN stg_license lic ON lic.license_name = b.license_name
LEFT JOIN stg_employee_contact_information e ON e.employee_name = b.credited_account_executive
LEFT JOIN stg_business_classification cls ON cls.business_classification_id = b.business_classification_id
LEFT JOIN int_business_lead l ON l.business_id = b.business_id
LEFT JOIN int_business_warm_transfer wt ON wt.business_id = b.business_id
LEFT JOIN stg_campaign_status cmp ON cmp.campaign_status_id = wt.warm_transfer_campaign_status_id
LEFT JOIN int_business_policy_rollup pr ON pr.business_id = b.business_id
LEFT JOIN int_business_quote_rollup qr ON qr.business_id = b.business_id
LEFT JOIN int_business_revenue_rollup rr ON rr.business_id = b.business_id
LEFT JOIN int_business_close_status cs ON cs.business_id = b.business_id
LEFT JOIN int_business_opportunity_milestones om ON om.business_id = b.business_id
LEFT JOIN int_business_application_milestones am ON am.business_id = b.business_id""")


def _le(col: str, n: int) -> str:
    return f"CASE WHEN {col} <= {n} THEN 1 ELSE 0 END"


cte("int_business", ("int_business_joined",), f"""
SELECT *,
  {', '.join(f'CASE WHEN business_age_days >= {n} THEN 1 ELSE 0 END AS is_mature_d{n}' for n in S.MATURITY_DAYS)},
  {_le('days_to_attempted_to_contact', 7)} AS d7_attempted_to_contact,
  {_le('days_to_made_contact', 7)} AS d7_made_contact,
  {_le('days_to_junk', 7)} AS d7_junk,
  CASE WHEN first_quote_created_at IS NOT NULL THEN 1 ELSE 0 END AS quoted,
  {_le('days_to_first_quote', 7)} AS d7_quoted,
  {_le('days_to_first_quote', 30)} AS d30_quoted,
  CASE WHEN days_to_first_quote <= 30 THEN days_to_first_quote END AS days_to_d30_quote,
  {_le('days_to_quote_presented', 7)} AS d7_quote_presented,
  CASE WHEN first_policy_created_at IS NOT NULL THEN 1 ELSE 0 END AS converted,
  {', '.join(f"{_le('days_to_first_policy', n)} AS d{n}_converted" for n in S.CONVERSION_DAYS)},
  {_le('days_to_first_chubb_quote', 7)} AS d7_chubb_quoted,
  {_le('days_to_first_nb_chubb_policy', 7)} AS d7_chubb_converted,
  {_le('days_to_first_nb_chubb_policy', 30)} AS d30_chubb_converted,
  {_le('days_to_first_gaig_quote', 7)} AS d7_gaig_quoted,
  {_le('days_to_first_nb_gaig_policy', 7)} AS d7_gaig_converted,
  {_le('days_to_first_nb_gaig_policy', 30)} AS d30_gaig_converted
FROM int_business_joined""")

# --- other intermediates ------------------------------------------------------
cte("int_warm_transfer", ("stg_warm_transfer", "stg_campaign_status", "stg_partner", "int_business"), f"""
SELECT w.warm_transfer_id, w.business_id, w.campaign_status_id, w.created_at, w.created_date,
  CAST(date_trunc('week', w.created_at) AS DATE) AS created_week,
  CAST(date_trunc('month', w.created_at) AS DATE) AS created_month,
  {AS_OF} - w.created_date AS ping_age_days,
  coalesce(cp.partner_name, b.partner_name, w.payload_vendor, 'Unknown') AS partner_name,
  CASE WHEN cp.partner_name IS NOT NULL THEN 'campaign' WHEN b.partner_name IS NOT NULL THEN 'business'
       WHEN w.payload_vendor IS NOT NULL THEN 'payload' ELSE 'unknown' END AS partner_resolved_from,
  coalesce(c.campaign_name, w.awl_campaign, b.warm_transfer_campaign) AS campaign_name,
  coalesce(c.is_high_revenue_campaign, false) AS is_high_revenue_campaign,
  w.status, w.is_accepted, w.is_rejected, w.is_error, w.is_received,
  CASE WHEN w.is_accepted THEN w.claimed_status END AS claimed_status,
  w.rejection_reason, w.rejection_reason_category, w.bid_price,
  CASE WHEN w.is_accepted THEN w.bid_price END AS accepted_bid_price,
  b.license_name, b.transfer_type, b.credited_account_executive, b.credited_ae_team, b.workflow_type,
  coalesce(b.is_test_business, false) AS is_test_business, b.quoted, b.d7_quoted, b.converted, b.d7_converted,
  b.d30_converted, b.nb_policy_count, b.nb_premium, b.d30_nb_premium, b.d30_nb_gross_revenue, b.nb_gross_revenue
FROM stg_warm_transfer w
LEFT JOIN stg_campaign_status c ON c.campaign_status_id = w.campaign_status_id
LEFT JOIN stg_partner cp ON cp.partner_id = c.partner_id
LEFT JOIN int_business b ON b.business_id = w.business_id""")

cte("int_policy_revenue", ("stg_policy", "stg_business"), """
SELECT p.policy_id, p.business_id, p.carrier_id, p.quote_id, p.close_opportunity_id, p.renewed_from_policy_id,
  p.policy_type, coalesce(b.license_name, '(no license)') AS license_name, p.license_name AS policy_license_name,
  p.billing_type, p.sale_type, p.sales_channel, p.underwriting_carrier, p.account_executive, p.assigned_agent,
  p.is_renewal, p.renewal_count, p.bor_renewal, p.is_auto_bind, p.is_paygo, p.premium, p.commissionable_premium,
  p.commission_rate, p.estimated_commission, p.mmr_fee, p.effective_date, p.expiry_date, p.created_at AS bound_at,
  CAST(date_trunc('day', p.created_at) AS DATE) AS bound_date,
  CAST(date_trunc('week', p.created_at) AS DATE) AS bound_week,
  CAST(date_trunc('month', p.created_at) AS DATE) AS bound_month,
  CAST(date_trunc('quarter', p.created_at) AS DATE) AS bound_quarter,
  CAST(extract(year FROM p.created_at) AS INTEGER) AS bound_year,
  CAST(date_trunc('month', p.effective_date) AS DATE) AS effective_month
FROM stg_policy p LEFT JOIN stg_business b ON b.business_id = p.business_id
WHERE p.status = 'BOUND'""")

cte("int_nb_revenue_transaction", ("stg_policy_transaction", "stg_policy", "stg_carrier", "stg_business", "stg_user"),
    f"""
SELECT t.policy_transaction_id, t.policy_id, p.business_id, t.created_at AS booked_at, t.created_date AS booked_date,
  t.transaction_type,
  CASE WHEN t.transaction_type IN ('TECHNOLOGY_ACCESS_FEE', 'AGENCY_FEE') THEN 'TECH_FEE'
       ELSE t.transaction_type END AS revenue_bucket,
  t.direction, t.is_cancellation_driven, t.signed_amount, p.created_at AS policy_created_at,
  b.created_at AS business_created_at, t.created_date - p.created_date AS days_policy_to_booking
FROM stg_policy_transaction t
JOIN stg_policy p ON p.policy_id = t.policy_id AND p.is_new_business
JOIN stg_carrier c ON c.carrier_id = p.carrier_id
JOIN stg_business b ON b.business_id = p.business_id
LEFT JOIN stg_user u ON u.user_id = b.user_id
WHERE t.transaction_type IN ({q(S.NB_REVENUE_TYPES)})
  AND NOT c.is_test_carrier AND NOT b.is_test_flag AND NOT coalesce(u.is_test_name, false)
  AND NOT (t.is_cancellation_driven
           AND t.created_at >= p.created_at + INTERVAL '{S.CANCELLATION_WINDOW_DAYS}' DAY)""")

_SNAP = "(CAST(date_trunc('month', created_at) AS TIMESTAMP) + INTERVAL '1' MONTH + INTERVAL '5' HOUR + INTERVAL '5' MINUTE)"
cte("int_ae_sales_snapshot_status", ("stg_policy", "stg_policy_status_change"), f"""
WITH pol AS (SELECT policy_id, {_SNAP} AS snapshot_at FROM stg_policy),
before AS (
  SELECT DISTINCT ON (p.policy_id) p.policy_id, sc.new_status
  FROM pol p JOIN stg_policy_status_change sc ON sc.policy_id = p.policy_id AND sc.changed_at < p.snapshot_at
  ORDER BY p.policy_id, sc.changed_at DESC, sc.change_log_id DESC),
after AS (
  SELECT DISTINCT ON (p.policy_id) p.policy_id, sc.old_status
  FROM pol p JOIN stg_policy_status_change sc ON sc.policy_id = p.policy_id AND sc.changed_at >= p.snapshot_at
  ORDER BY p.policy_id, sc.changed_at ASC, sc.change_log_id ASC),
touched AS (SELECT policy_id FROM before UNION SELECT policy_id FROM after)
SELECT t.policy_id, b.new_status AS last_new_status_before, a.old_status AS first_old_status_after
FROM touched t LEFT JOIN before b ON b.policy_id = t.policy_id LEFT JOIN after a ON a.policy_id = t.policy_id""")

_ae_name = "upper(u.first_name || ' ' || u.last_name)"
cte("int_ae_sales_policy",
    ("stg_policy", "int_ae_sales_snapshot_status", "stg_business", "stg_user", "stg_carrier",
     "stg_business_classification", "stg_license"), f"""
WITH j AS (
  SELECT p.policy_id, p.business_id, p.created_at AS policy_created_at, p.created_date AS policy_created_date,
    p.sale_type, p.bor_renewal, p.premium, p.status AS current_status,
    {_SNAP.replace('created_at', 'p.created_at')} AS snapshot_at,
    coalesce(s.last_new_status_before, s.first_old_status_after, p.status) AS status_at_snapshot,
    (p.is_new_business OR coalesce(p.bor_renewal, false)) AS is_eligible_sale_type,
    coalesce(p.premium > 0, false) AS has_premium,
    coalesce(c.is_test_carrier, false) AS is_test_carrier,
    coalesce(b.is_test_flag, false) AS is_test_business_flag,
    coalesce(u.first_name IS NOT NULL AND u.last_name IS NOT NULL
             AND ({' OR '.join(f"{_ae_name} LIKE '%{t}%'" for t in CFG.test_tokens)}), false) AS is_test_name_ae_rule,
    (u.user_id IS NOT NULL AND cls.business_classification_id IS NOT NULL AND lic.license_name IS NOT NULL)
      AS has_required_joins
  FROM stg_policy p
  LEFT JOIN int_ae_sales_snapshot_status s ON s.policy_id = p.policy_id
  LEFT JOIN stg_carrier c ON c.carrier_id = p.carrier_id
  LEFT JOIN stg_business b ON b.business_id = p.business_id
  LEFT JOIN stg_user u ON u.user_id = b.user_id
  LEFT JOIN stg_business_classification cls ON cls.business_classification_id = b.business_classification_id
  LEFT JOIN stg_license lic ON lic.license_name = b.license_name)
SELECT *, is_eligible_sale_type AND has_premium AND status_at_snapshot IS DISTINCT FROM 'CANCELLED'
  AND NOT is_test_carrier AND NOT is_test_business_flag AND NOT is_test_name_ae_rule AND has_required_joins
  AS is_ae_sales_policy
FROM j""")

cte("int_ringba_call_events", ("stg_ringba_call_event",), """
SELECT ringba_call_id, count(*) AS event_count, count(DISTINCT target_name) AS ae_count_dialed,
  bool_or(event_name = 'TargetDialed') AS is_routed, bool_or(event_name = 'ConnectedCall') AS is_answered,
  bool_or(event_name = 'DuplicateCall') AS is_duplicate, bool_or(event_name = 'NoTargetFound') AS is_no_target_found,
  count(*) FILTER (WHERE event_name = 'NoAnswer') AS no_answer_events,
  min(event_at) FILTER (WHERE event_name = 'TargetDialed') AS first_dialed_at,
  min(event_at) FILTER (WHERE event_name = 'ConnectedCall') AS answered_at,
  max(target_name) FILTER (WHERE event_name = 'ConnectedCall') AS answered_by
FROM stg_ringba_call_event GROUP BY ringba_call_id""")

cte("int_ringba_call", ("stg_ringba_call", "int_ringba_call_events", "stg_campaign_status", "stg_partner"), """
SELECT c.ringba_call_id, c.inbound_call_id, c.campaign_status_id, c.caller_number, c.called_at, c.call_date,
  CAST(date_trunc('week', c.call_date) AS DATE) AS call_week,
  CAST(date_trunc('month', c.call_date) AS DATE) AS call_month,
  CASE WHEN c.campaign_status_id IS NULL THEN 'Other' ELSE coalesce(p.partner_name, 'Other') END AS partner_name,
  coalesce(cs.campaign_name, '(no campaign)') AS campaign_name,
  coalesce(cs.is_high_revenue_campaign, false) AS is_high_revenue_campaign,
  coalesce(e.event_count, 0) AS event_count, coalesce(e.ae_count_dialed, 0) AS ae_count_dialed,
  coalesce(e.is_routed, false) AS is_routed, coalesce(e.is_answered, false) AS is_answered,
  coalesce(e.is_routed, false) AND NOT coalesce(e.is_answered, false) AS is_missed,
  NOT coalesce(e.is_routed, false) AS is_unrouted, coalesce(e.is_duplicate, false) AS is_duplicate,
  coalesce(e.is_no_target_found, false) AS is_no_target_found, coalesce(e.no_answer_events, 0) AS no_answer_events,
  e.answered_by, e.first_dialed_at, e.answered_at,
  CAST(round(date_diff('microsecond', e.first_dialed_at, e.answered_at) / 1000000.0) AS INTEGER) AS seconds_to_answer,
  c.call_length_seconds, c.has_converted
FROM stg_ringba_call c
LEFT JOIN int_ringba_call_events e ON e.ringba_call_id = c.ringba_call_id
LEFT JOIN stg_campaign_status cs ON cs.campaign_status_id = c.campaign_status_id
LEFT JOIN stg_partner p ON p.partner_id = cs.partner_id""")

cte("int_ringba_call_ae", ("stg_ringba_call_event", "int_ringba_call", "stg_employee_contact_information"), """
WITH ca AS (
  SELECT ringba_call_id, target_name AS account_executive,
    bool_or(event_name = 'TargetDialed') AS was_dialed, bool_or(event_name = 'ConnectedCall') AS was_answered,
    count(*) FILTER (WHERE event_name = 'NoAnswer') AS no_answer_events,
    count(*) FILTER (WHERE event_name = 'BusyCall') AS busy_events,
    min(event_at) FILTER (WHERE event_name = 'TargetDialed') AS first_dialed_at,
    min(event_at) FILTER (WHERE event_name = 'ConnectedCall') AS answered_at
  FROM stg_ringba_call_event WHERE target_name IS NOT NULL GROUP BY 1, 2)
SELECT ca.ringba_call_id, ca.account_executive, e.team AS ae_team, e.employee_type AS ae_employee_type,
  c.call_date, c.call_week, c.call_month, c.partner_name, c.campaign_name, c.caller_number, c.is_duplicate,
  c.is_answered AS call_was_answered, ca.was_dialed, ca.was_answered, ca.was_dialed AND NOT ca.was_answered AS was_missed,
  ca.no_answer_events, ca.busy_events, ca.first_dialed_at, ca.answered_at,
  CASE WHEN ca.was_answered THEN c.call_length_seconds END AS answered_call_length_seconds
FROM ca JOIN int_ringba_call c ON c.ringba_call_id = ca.ringba_call_id
LEFT JOIN stg_employee_contact_information e ON e.employee_name = ca.account_executive""")

# --- marts ---------------------------------------------------------------------
cte("dim_date", (), f"""
SELECT CAST(d AS DATE) AS date_day,
  CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start,
  CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(date_trunc('year', d) AS DATE) AS year_start,
  CAST(extract(year FROM d) AS INTEGER) AS year, CAST(extract(quarter FROM d) AS INTEGER) AS quarter,
  CAST(extract(month FROM d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS year_month,
  CAST(extract(day FROM d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
  strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend,
  CAST(d AS DATE) = CAST(date_trunc('month', d) + INTERVAL '1' MONTH - INTERVAL '1' DAY AS DATE) AS is_month_end,
  CAST(d AS DATE) <= {AS_OF} AS is_past_or_today, CAST(d AS DATE) = {AS_OF} AS is_today
FROM generate_series(DATE '{S.SPINE_START.isoformat()}', {SPINE_END}, INTERVAL '1' DAY) AS g(d)""")

cte("wt_tracker_daily", ("int_business",), """
SELECT business_created_date, license_name, claimed_status, warm_transfer_campaign, credited_account_executive,
  workflow_type, business_created_week, business_created_month,
  max(is_mature_d7) AS is_mature_d7, max(is_mature_d14) AS is_mature_d14, max(is_mature_d30) AS is_mature_d30,
  max(partner_name) AS partner_name, max(transfer_type) AS transfer_type, max(campaign_type) AS campaign_type,
  max(credited_ae_team) AS credited_ae_team,
  count(*) AS business_count, sum(warm_transfer_bid_price) AS total_bid_price,
  sum(d7_attempted_to_contact) AS d7_attempted_to_contact_business_count,
  sum(d7_made_contact) AS d7_made_contact_business_count, sum(d7_junk) AS d7_junk_business_count,
  sum(quoted) AS quoted_business_count, sum(d7_quoted) AS d7_quoted_business_count,
  sum(d30_quoted) AS d30_quoted_business_count, coalesce(sum(days_to_d30_quote), 0) AS total_days_to_d30_quote,
  sum(d7_quote_presented) AS d7_quote_presented_business_count, sum(quote_count) AS quote_count,
  sum(converted) AS converted_business_count, sum(d1_converted) AS d1_converted_business_count,
  sum(d7_converted) AS d7_converted_business_count, sum(d14_converted) AS d14_converted_business_count,
  sum(d30_converted) AS d30_converted_business_count, sum(d60_converted) AS d60_converted_business_count,
  sum(d90_converted) AS d90_converted_business_count, sum(nb_policy_count) AS nb_policy_count,
  sum(nb_premium) AS nb_premium, sum(d30_nb_premium) AS d30_nb_premium,
  sum(d7_nb_gross_revenue) AS d7_nb_gross_revenue, sum(d14_nb_gross_revenue) AS d14_nb_gross_revenue,
  sum(d30_nb_gross_revenue) AS d30_nb_gross_revenue, sum(nb_gross_revenue) AS nb_gross_revenue,
  sum(d30_nb_core_revenue) AS d30_nb_core_revenue, sum(nb_cancellation_amount) AS nb_cancellation_amount,
  sum(d7_chubb_quoted) AS d7_chubb_quoted_business_count,
  sum(CASE WHEN d7_chubb_quoted = 1 THEN chubb_quoted_premium ELSE 0 END) AS d7_chubb_quoted_premium,
  sum(d7_chubb_converted) AS d7_chubb_converted_business_count,
  sum(d30_chubb_converted) AS d30_chubb_converted_business_count,
  sum(d30_nb_chubb_premium) AS d30_nb_chubb_premium, sum(d30_nb_chubb_gross_revenue) AS d30_nb_chubb_gross_revenue,
  sum(d7_gaig_quoted) AS d7_gaig_quoted_business_count,
  sum(CASE WHEN d7_gaig_quoted = 1 THEN gaig_quoted_premium ELSE 0 END) AS d7_gaig_quoted_premium,
  sum(d7_gaig_converted) AS d7_gaig_converted_business_count,
  sum(d30_gaig_converted) AS d30_gaig_converted_business_count,
  sum(d30_nb_gaig_premium) AS d30_nb_gaig_premium, sum(d30_nb_gaig_gross_revenue) AS d30_nb_gaig_gross_revenue
FROM int_business WHERE NOT is_test_business
GROUP BY ALL""")

cte("wt_pings_daily", ("int_warm_transfer",), """
SELECT created_date AS ping_date, partner_name, campaign_name, status, claimed_status, rejection_reason_category,
  rejection_reason, credited_account_executive, created_week AS ping_week, created_month AS ping_month,
  max(CASE WHEN ping_age_days >= 7 THEN 1 ELSE 0 END) AS is_mature_d7,
  max(CASE WHEN ping_age_days >= 30 THEN 1 ELSE 0 END) AS is_mature_d30,
  max(credited_ae_team) AS credited_ae_team, bool_or(is_high_revenue_campaign) AS is_high_revenue_campaign,
  count(*) AS ping_count, count(*) FILTER (WHERE is_accepted) AS accepted_count,
  count(*) FILTER (WHERE is_rejected) AS rejected_count, count(*) FILTER (WHERE is_error) AS error_count,
  count(*) FILTER (WHERE is_received) AS received_count,
  count(*) FILTER (WHERE claimed_status = 'CLAIMED') AS claimed_count,
  count(*) FILTER (WHERE claimed_status = 'UNCLAIMED') AS unclaimed_count, count(business_id) AS business_count,
  coalesce(sum(accepted_bid_price), 0) AS accepted_bid_price, coalesce(sum(bid_price), 0) AS offered_bid_price,
  coalesce(sum(quoted), 0) AS quoted_business_count, coalesce(sum(d7_quoted), 0) AS d7_quoted_business_count,
  coalesce(sum(converted), 0) AS converted_business_count,
  coalesce(sum(d7_converted), 0) AS d7_converted_business_count,
  coalesce(sum(d30_converted), 0) AS d30_converted_business_count,
  coalesce(sum(nb_policy_count), 0) AS nb_policy_count, coalesce(sum(nb_premium), 0) AS nb_premium,
  coalesce(sum(d30_nb_premium), 0) AS d30_nb_premium,
  coalesce(sum(d30_nb_gross_revenue), 0) AS d30_nb_gross_revenue,
  coalesce(sum(nb_gross_revenue), 0) AS nb_gross_revenue
FROM int_warm_transfer WHERE NOT is_test_business
GROUP BY created_date, partner_name, campaign_name, status, claimed_status, rejection_reason_category,
  rejection_reason, credited_account_executive, created_week, created_month""")

cte("policy_revenue_summary", ("int_policy_revenue",), f"""
WITH base AS (
  SELECT bound_month, bound_quarter, bound_year, policy_type, license_name, underwriting_carrier, billing_type,
    sale_type, sales_channel, is_renewal, is_paygo,
    count(policy_id) AS policies_bound, count(DISTINCT business_id) AS unique_businesses,
    sum(premium) AS gross_written_premium, sum(commissionable_premium) AS total_commissionable_premium,
    sum(estimated_commission) AS total_estimated_commission, sum(mmr_fee) AS total_mmr_fees,
    {half_up_avg('premium')} AS avg_premium, {half_up_avg('commission_rate')} AS avg_commission_rate,
    count(CASE WHEN NOT is_renewal THEN 1 END) AS new_business_policies,
    count(CASE WHEN is_renewal THEN 1 END) AS renewal_policies,
    sum(CASE WHEN NOT is_renewal THEN premium END) AS new_business_premium,
    sum(CASE WHEN is_renewal THEN premium END) AS renewal_premium
  FROM int_policy_revenue GROUP BY ALL)
SELECT *, {half_up_pct('renewal_policies', 'policies_bound')} AS renewal_rate_pct,
  {half_up_pct('total_estimated_commission', 'gross_written_premium')} AS effective_commission_rate_pct
FROM base""")

cte("ae_performance_monthly", ("int_business", "int_policy_revenue"), f"""
WITH leads AS (
  SELECT CAST(date_trunc('month', lead_created_at) AS DATE) AS activity_month,
    lead_account_executive AS account_executive, count(lead_id) AS leads_assigned,
    count(CASE WHEN made_contact THEN 1 END) AS leads_contacted,
    count(CASE WHEN is_junk THEN 1 END) AS leads_marked_junk, {half_up_avg('lead_score')} AS avg_lead_score
  FROM int_business WHERE lead_account_executive IS NOT NULL AND lead_id IS NOT NULL GROUP BY 1, 2),
pols AS (
  SELECT bound_month AS activity_month, account_executive, count(policy_id) AS policies_bound,
    count(CASE WHEN NOT is_renewal THEN 1 END) AS new_policies_bound,
    count(CASE WHEN is_renewal THEN 1 END) AS renewals_bound,
    count(DISTINCT business_id) AS unique_businesses_bound, sum(premium) AS total_premium,
    sum(estimated_commission) AS total_estimated_commission, {half_up_avg('premium')} AS avg_premium_per_policy,
    count(DISTINCT policy_type) AS distinct_policy_types
  FROM int_policy_revenue WHERE account_executive IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(l.activity_month, p.activity_month) AS activity_month,
  coalesce(l.account_executive, p.account_executive) AS account_executive,
  coalesce(l.leads_assigned, 0) AS leads_assigned, coalesce(l.leads_contacted, 0) AS leads_contacted,
  coalesce(l.leads_marked_junk, 0) AS leads_marked_junk, l.avg_lead_score,
  coalesce(p.policies_bound, 0) AS policies_bound, coalesce(p.new_policies_bound, 0) AS new_policies_bound,
  coalesce(p.renewals_bound, 0) AS renewals_bound, coalesce(p.unique_businesses_bound, 0) AS unique_businesses_bound,
  coalesce(p.total_premium, 0) AS total_premium, coalesce(p.total_estimated_commission, 0) AS total_estimated_commission,
  p.avg_premium_per_policy, coalesce(p.distinct_policy_types, 0) AS distinct_policy_types,
  {half_up_pct('coalesce(l.leads_contacted, 0)', 'l.leads_assigned')} AS contact_rate_pct,
  {half_up_pct('coalesce(p.unique_businesses_bound, 0)', 'l.leads_contacted')} AS contact_to_bind_rate_pct,
  {half_up_pct('coalesce(p.unique_businesses_bound, 0)', 'l.leads_assigned')} AS overall_close_rate_pct
FROM leads l FULL OUTER JOIN pols p ON p.activity_month = l.activity_month AND p.account_executive = l.account_executive""")

cte("business_funnel_daily",
    ("stg_business", "stg_application_submission", "stg_quote", "int_policy_revenue", "int_business"), f"""
WITH bl AS (SELECT business_id, coalesce(license_name, '(no license)') AS license_name FROM stg_business),
apps AS (
  SELECT CAST(a.created_at AS DATE) AS activity_date, coalesce(bl.license_name, '(no license)') AS license_name,
    count(DISTINCT a.business_id) AS businesses_with_app, count(a.application_submission_id) AS applications_started
  FROM stg_application_submission a LEFT JOIN bl ON bl.business_id = a.business_id
  WHERE NOT a.is_admin_quoting_tool GROUP BY 1, 2),
quotes AS (
  SELECT CAST(qq.created_at AS DATE) AS activity_date, coalesce(bl.license_name, '(no license)') AS license_name,
    count(DISTINCT qq.business_id) AS businesses_quoted, count(qq.quote_id) AS quotes_generated
  FROM stg_quote qq LEFT JOIN bl ON bl.business_id = qq.business_id GROUP BY 1, 2),
pols AS (
  SELECT p.bound_date AS activity_date, coalesce(bl.license_name, '(no license)') AS license_name,
    count(DISTINCT p.business_id) AS businesses_bound, count(p.policy_id) AS policies_bound,
    sum(p.premium) AS total_premium_bound, sum(p.estimated_commission) AS total_estimated_commission
  FROM int_policy_revenue p LEFT JOIN bl ON bl.business_id = p.business_id GROUP BY 1, 2),
signups AS (SELECT CAST(business_created_at AS DATE) AS activity_date, count(business_id) AS businesses_created
            FROM int_business GROUP BY 1),
j AS (
  SELECT coalesce(a.activity_date, qt.activity_date, p.activity_date) AS activity_date,
    coalesce(a.license_name, qt.license_name, p.license_name) AS license_name,
    coalesce(a.businesses_with_app, 0) AS businesses_with_app,
    coalesce(a.applications_started, 0) AS applications_started,
    coalesce(qt.businesses_quoted, 0) AS businesses_quoted, coalesce(qt.quotes_generated, 0) AS quotes_generated,
    coalesce(p.businesses_bound, 0) AS businesses_bound, coalesce(p.policies_bound, 0) AS policies_bound,
    coalesce(p.total_premium_bound, 0) AS total_premium_bound,
    coalesce(p.total_estimated_commission, 0) AS total_estimated_commission,
    {half_up_pct('coalesce(p.policies_bound, 0)', 'qt.quotes_generated')} AS quote_to_bind_rate_pct
  FROM apps a
  FULL OUTER JOIN quotes qt ON qt.activity_date = a.activity_date AND qt.license_name = a.license_name
  FULL OUTER JOIN pols p ON p.activity_date = coalesce(a.activity_date, qt.activity_date)
                        AND p.license_name = coalesce(a.license_name, qt.license_name))
SELECT j.*, s.businesses_created FROM j LEFT JOIN signups s ON s.activity_date = j.activity_date""")

cte("nb_sales_daily",
    ("int_nb_revenue_transaction", "int_ae_sales_policy", "stg_business", "stg_license",
     "stg_employee_contact_information", "dim_date"), """
WITH revenue AS (
  SELECT booked_date AS activity_date, business_id, revenue_bucket, signed_amount,
    row_number() OVER (PARTITION BY business_id, date_trunc('month', booked_date)
                       ORDER BY booked_at, policy_transaction_id) = 1 AS is_first_in_month
  FROM int_nb_revenue_transaction),
unioned AS (
  SELECT activity_date, business_id, signed_amount AS amount, revenue_bucket,
    CASE WHEN is_first_in_month THEN 1 ELSE 0 END AS first_in_month, 0 AS policy_count,
    CAST(0 AS DECIMAL(18,4)) AS policy_premium
  FROM revenue
  UNION ALL
  SELECT policy_created_date, business_id, CAST(0 AS DECIMAL(18,4)), NULL, 0, 1, premium
  FROM int_ae_sales_policy WHERE is_ae_sales_policy)
SELECT r.activity_date,
  CAST(date_trunc('month', r.activity_date) AS DATE) = b.created_month AS same_month_sale,
  coalesce(b.license_name, '(no license)') AS license_name, b.sold_by AS account_executive,
  max(d.week_start) AS week_start, max(d.month_start) AS month_start, max(d.quarter_start) AS quarter_start,
  max(d.year) AS year, bool_or(d.is_weekend) AS is_weekend,
  max(coalesce(l.transfer_type, 'Partner')) AS transfer_type, max(l.partner_name) AS partner_name,
  max(e.team) AS ae_team,
  sum(r.amount) AS nb_net_revenue,
  sum(r.amount) FILTER (WHERE r.revenue_bucket = 'COMMISSION') AS commission,
  sum(r.amount) FILTER (WHERE r.revenue_bucket = 'TECH_FEE') AS tech_fee,
  sum(r.amount) FILTER (WHERE r.revenue_bucket = 'ENDORSEMENT') AS endorsement,
  sum(r.amount) FILTER (WHERE r.revenue_bucket = 'CANCELLATION') AS cancellation,
  sum(r.first_in_month) AS business_count, sum(r.policy_count) AS ae_sales_policies,
  sum(r.policy_premium) AS ae_sales_premium
FROM unioned r
JOIN stg_business b ON b.business_id = r.business_id
LEFT JOIN stg_license l ON l.license_name = b.license_name
LEFT JOIN stg_employee_contact_information e ON e.employee_name = b.sold_by
JOIN dim_date d ON d.date_day = r.activity_date
GROUP BY 1, 2, 3, 4""")

cte("ringba_calls_daily", ("int_ringba_call", "dim_date"), """
SELECT c.call_date, c.partner_name, c.campaign_name, max(d.week_start) AS week_start,
  max(d.month_start) AS month_start, bool_or(d.is_weekend) AS is_weekend,
  bool_or(c.is_high_revenue_campaign) AS is_high_revenue_campaign, count(*) AS calls,
  count(*) FILTER (WHERE c.is_routed) AS routed_calls, count(*) FILTER (WHERE c.is_answered) AS answered_calls,
  count(*) FILTER (WHERE c.is_missed) AS missed_calls, count(*) FILTER (WHERE c.is_unrouted) AS unrouted_calls,
  count(*) FILTER (WHERE c.is_duplicate) AS duplicate_calls,
  count(*) FILTER (WHERE c.is_no_target_found) AS no_target_found_calls,
  count(*) FILTER (WHERE c.has_converted) AS converted_calls, sum(c.ae_count_dialed) AS ae_dials,
  sum(c.no_answer_events) AS no_answer_events,
  coalesce(sum(c.seconds_to_answer) FILTER (WHERE c.is_answered), 0) AS total_seconds_to_answer,
  coalesce(sum(c.call_length_seconds) FILTER (WHERE c.is_answered), 0) AS answered_talk_seconds
FROM int_ringba_call c JOIN dim_date d ON d.date_day = c.call_date
GROUP BY 1, 2, 3""")

cte("ringba_ae_calls_daily", ("int_ringba_call_ae", "dim_date"), """
SELECT a.call_date, a.account_executive, a.partner_name, max(a.ae_team) AS ae_team,
  max(a.ae_employee_type) AS ae_employee_type, max(d.week_start) AS week_start, max(d.month_start) AS month_start,
  bool_or(d.is_weekend) AS is_weekend, count(*) AS calls_routed,
  count(*) FILTER (WHERE a.was_dialed) AS calls_dialed, count(*) FILTER (WHERE a.was_answered) AS calls_answered,
  count(*) FILTER (WHERE a.was_missed) AS calls_missed,
  count(*) FILTER (WHERE a.was_missed AND a.call_was_answered) AS missed_calls_answered_by_other,
  count(*) FILTER (WHERE a.was_answered AND a.is_duplicate) AS duplicate_calls_answered,
  sum(a.no_answer_events) AS no_answer_events, sum(a.busy_events) AS busy_events,
  coalesce(sum(a.answered_call_length_seconds), 0) AS answered_talk_seconds
FROM int_ringba_call_ae a JOIN dim_date d ON d.date_day = a.call_date
GROUP BY 1, 2, 3""")


def _order(name: str, seen: set[str], out: list[str]) -> None:
    if name in seen:
        return
    seen.add(name)
    for d in CTES[name][0]:
        _order(d, seen, out)
    out.append(name)


def with_chain(name: str) -> str:
    """``WITH`` clause holding ``name`` and everything it reads."""
    order: list[str] = []
    _order(name, set(), order)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)


def query_sql(name: str, projection: str = "*") -> str:
    return f"{with_chain(name)}\nSELECT {projection} FROM {name}"


def with_chain_many(names) -> str:
    order: list[str] = []
    seen: set[str] = set()
    for n in names:
        _order(n, seen, order)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
