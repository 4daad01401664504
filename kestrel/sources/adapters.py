"""Source-shaped tables derived from the driver's TPC-H-like test tables.

The engine reads 19 application tables. The test environment ships other
tables, so each source is derived here by a deterministic SQL expression over
them. The same text runs on Spark (``spark.sql`` with DataFrame arguments)
and, in the test oracle, on DuckDB; the two dialect differences are the
``@``-macros below. ``{name}`` marks an input table.

b3(k) below means: true when k % 3 = 0, false when k % 3 = 1, else NULL.
"""

from __future__ import annotations

DIALECTS = {
    "spark": {"@NTZ": "TIMESTAMP_NTZ", "@INSTANT(": "CAST((", "@)INSTANT": " AS TIMESTAMP_LTZ)"},
    "duckdb": {"@NTZ": "TIMESTAMP", "@INSTANT(": "timezone('UTC', (", "@)INSTANT": ")"},
}

_B = "(@NTZ '2023-01-01 08:00:00')"


def _b3(expr: str) -> str:
    return f"(CASE ({expr}) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END)"


def _day(expr: str) -> str:
    return f"(INTERVAL '1' DAY * ({expr}))"


def _sec(expr: str) -> str:
    return f"(INTERVAL '1' SECOND * ({expr}))"


def _oc(o: str, cust: str, a: int, b: int) -> str:
    """Order-derived time: base + customer offset + order jitter + seconds."""
    return f"({_B} + {_day(f'{cust} * 37 % 1300')} + {_day(f'{o} * 13 % {a} - {b}')} + {_sec(f'{o} * 7919 % 50000')})"


def _biz_created(c: str) -> str:
    return f"({_B} + {_day(f'{c} * 37 % 1300')} + {_sec(f'{c} * 7919 % 50000')})"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


# Every line item with a number of its own in its order: (order, line number) is
# not unique. Lines equal in all columns are interchangeable.
_LI = """(SELECT l_orderkey, l_linenumber, l_extendedprice AS px, l_returnflag AS rf, l_partkey AS pk,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                     l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
          FROM {lineitem})"""

# Keys spread over a whole dimension table.
_N_SUPPLIER, _N_PART = "(SELECT count(*) FROM {supplier})", "(SELECT count(*) FROM {part})"

ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {}


def _adapter(name: str, inputs: tuple[str, ...], sql: str) -> None:
    ADAPTERS[name] = (inputs, sql)


_adapter("Partner", ("region",), f"""
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
       CASE WHEN r_regionkey % 2 = 0 THEN 'AGENCY' ELSE 'REFERRAL' END AS profileType,
       {_b3('r_regionkey')} AS payGoEnabled,
       {_B} + {_day('r_regionkey')} AS createdAt
FROM {{region}}""")

_adapter("License", ("nation",), f"""
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
       CASE WHEN n_nationkey = 24 THEN NULL ELSE CAST(n_regionkey AS BIGINT) END AS partnerId,
       CAST(NULL AS BIGINT) AS parentLicenseId,
       CASE WHEN n_nationkey % 2 = 0 THEN 'API' ELSE 'EMBED' END AS integrationType,
       CASE WHEN n_nationkey % 3 = 0 THEN 'WARM' ELSE 'DATA' END AS leadIntakeType,
       'GL' AS policyType, 'LLC' AS companyType,
       {_b3('n_nationkey')} AS instantPayEnabled, CAST(NULL AS BOOLEAN) AS leadSellingEnabled,
       CAST(n_nationkey AS INTEGER) AS laqPriority,
       {_B} + {_day('n_nationkey')} AS createdAt
FROM {{nation}}""")

_adapter("Carrier", ("supplier",), f"""
SELECT s_suppkey AS id,
       CASE s_suppkey % 10 WHEN 1 THEN 'Chubb' WHEN 2 THEN 'Great American Insurance Group'
            WHEN 7 THEN 'Fake Insurance' WHEN 8 THEN NULL ELSE s_name END AS name,
       {_b3('s_suppkey')} AS isWholesaler, CAST(NULL AS BOOLEAN) AS agencyBill
FROM {{supplier}}""")

_adapter("EmployeeContactInformation", ("supplier",), f"""
SELECT s_suppkey AS id, s_name AS name, concat('emp', {_s('s_suppkey')}, '@example.test') AS email,
       CASE WHEN s_suppkey % 4 = 0 THEN 'AM' ELSE 'AE' END AS employeeType,
       CASE s_suppkey % 3 WHEN 0 THEN 'Growth' WHEN 1 THEN 'Core' ELSE 'Enterprise' END AS team,
       CAST(NULL AS STRING) AS operationsTeam, {_b3('s_suppkey')} AS isActive,
       CAST(NULL AS BOOLEAN) AS isBelgradeAm,
       {_B} + {_day('s_suppkey')} AS startDate, CAST(NULL AS @NTZ) AS endDate
FROM {{supplier}}""")

_adapter("BusinessClassification", ("part",), f"""
SELECT p_partkey AS id, p_name AS display, p_brand AS naics17, p_type AS industry,
       p_brand AS subIndustry, CAST(NULL AS STRING) AS filter3, {_s('p_size')} AS sicCode
FROM {{part}}""")

_adapter("CampaignStatus", ("part",), f"""
SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey % 5 END AS partnerId,
       p_name AS campaignName, concat('ext', {_s('p_partkey')}) AS campaignExternalId,
       concat('rb', {_s('p_partkey')}) AS ringbaCampaignId, p_retailprice AS bidCost,
       {_b3('p_partkey + 1')} AS available, CAST(NULL AS BOOLEAN) AS isTivlyCampaign,
       {_b3('p_partkey')} AS isHighRevenueCampaign, CAST(NULL AS BOOLEAN) AS containsEnterprise
FROM {{part}}""")

_adapter("User", ("customer",), f"""
SELECT c_custkey AS id, concat('user', {_s('c_custkey')}, '@example.test') AS email,
       CASE WHEN c_custkey % 97 = 5 THEN 'Testa' WHEN c_custkey % 41 = 6 THEN NULL
            ELSE concat('F', {_s('c_custkey')}) END AS firstName,
       CASE WHEN c_custkey % 43 = 7 THEN NULL WHEN c_custkey % 79 = 8 THEN 'Homebase'
            ELSE concat('L', {_s('c_custkey')}) END AS lastName,
       concat('555', {_s('c_custkey')}) AS phone,
       {_b3('c_custkey')} AS isActive, {_b3('c_custkey + 1')} AS subscribedToEmails,
       {_B} + {_day('c_custkey * 37 % 1300')} AS createdAt, CAST(NULL AS @NTZ) AS lastLogin
FROM {{customer}}""")

_adapter("Business", ("customer", "nation", "supplier", "part"), f"""
SELECT c.c_custkey AS id,
       CASE WHEN c.c_custkey % 53 = 9 THEN NULL ELSE c.c_custkey END AS userId,
       CASE WHEN c.c_custkey % 31 = 3 THEN NULL ELSE c.c_custkey % {_N_PART} END AS businessClassificationId,
       concat('lead_', {_s('c.c_custkey')}) AS closeId,
       CAST(NULL AS BIGINT) AS leadOriginatorEmployeeId, CAST(NULL AS BIGINT) AS createdAtCohortId,
       c.c_name AS name, concat(' ', lower(c.c_mktsegment), ' ') AS legalEntityType,
       c.c_mktsegment AS companyType, CAST(c.c_custkey % 30 AS INTEGER) AS yearsInBusiness,
       CAST(2000 + c.c_custkey % 20 AS INTEGER) AS businessStartYear, CAST(NULL AS STRING) AS website,
       c.c_acctbal AS totalAnnualRevenue, c.c_acctbal * 2 AS totalAnnualPayroll,
       CAST(c.c_custkey % 50 AS INTEGER) AS totalNumberOfEmployees,
       CAST(1 + c.c_custkey % 3 AS INTEGER) AS numberOfOwnerOfficers,
       CASE WHEN c.c_custkey % 29 = 4 THEN NULL ELSE n.n_name END AS licenseName,
       CASE c.c_custkey % 5 WHEN 0 THEN 'BRAND Carrier A' WHEN 1 THEN NULL ELSE 'SEARCH B' END
           AS warmTransferCampaign,
       CAST(NULL AS STRING) AS tivlyCampaign, CAST(NULL AS STRING) AS partnerTrackingId,
       {_b3('c.c_custkey')} AS isQualifiedPartnerLead, CAST(NULL AS @NTZ) AS qualifiedPartnerLeadAt,
       {_b3('c.c_custkey + 2')} AS hasBeenSold,
       s.s_name AS accountExecutive, CAST(NULL AS STRING) AS accountManager,
       CASE WHEN c.c_custkey % 3 = 0 THEN s.s_name WHEN c.c_custkey % 11 = 1 THEN 'API Account' END AS soldBy,
       CASE c.c_custkey % 4 WHEN 0 THEN 'Customer' WHEN 1 THEN 'Junk' WHEN 2 THEN 'Made Contact' END AS closeStatus,
       CAST(NULL AS STRING) AS closeJunkParentReason, CAST(NULL AS STRING) AS closeJunkExplanation,
       {_b3('c.c_custkey + 1')} AS isHighRisk, CAST(NULL AS STRING) AS highRiskReason,
       CASE WHEN c.c_custkey % 101 = 2 THEN TRUE WHEN c.c_custkey % 2 = 0 THEN FALSE END AS isTest,
       {_biz_created('c.c_custkey')} AS createdAt
FROM (SELECT x.*, x.c_custkey % {_N_SUPPLIER} AS c_suppkey FROM {{customer}} x) c
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
LEFT JOIN {{supplier}} s ON s.s_suppkey = c.c_suppkey""")

_lead_cols = """
       CASE WHEN c.c_custkey % 71 = 1 THEN NULL ELSE c.c_custkey END AS businessId,
       c.c_custkey AS userId,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE s.s_name END AS accountExecutive,
       CASE c.c_custkey % 3 WHEN 0 THEN 'WARM_TRANSFER' WHEN 1 THEN 'DATA_LEAD' END AS workflowTypeAssigned,
       CAST(NULL AS STRING) AS previousAccountExecutives,"""

# Every customer with an order has a lead; customers of the AUTOMOBILE segment
# have a second, later one (so "latest lead" has a real choice to make).
_adapter("Lead", ("customer", "supplier", "orders"), f"""
SELECT 2 * c.c_custkey AS id, {_lead_cols}
       CAST(c.c_custkey % 100 AS INTEGER) AS score,
       {_b3('c.c_custkey')} AS madeContact, {_b3('c.c_custkey + 1')} AS isJunk,
       {_b3('c.c_custkey + 2')} AS timerPaused, CAST(NULL AS BOOLEAN) AS isCurrentlyOnCallWithAe,
       {_biz_created('c.c_custkey')} + INTERVAL '1' HOUR AS createdAt,
       {_biz_created('c.c_custkey')} + INTERVAL '1' HOUR + INTERVAL '2' DAY AS expiryTime,
       CAST(NULL AS @NTZ) AS pausedTime
FROM (SELECT x.*, x.c_custkey % {_N_SUPPLIER} AS c_suppkey FROM {{customer}} x) c LEFT JOIN {{supplier}} s ON s.s_suppkey = c.c_suppkey
WHERE EXISTS (SELECT 1 FROM {{orders}} o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 2 * c.c_custkey + 1 AS id, {_lead_cols}
       CAST((c.c_custkey + 7) % 100 AS INTEGER) AS score,
       {_b3('c.c_custkey + 2')} AS madeContact, {_b3('c.c_custkey')} AS isJunk,
       {_b3('c.c_custkey + 1')} AS timerPaused, CAST(NULL AS BOOLEAN) AS isCurrentlyOnCallWithAe,
       {_biz_created('c.c_custkey')} + INTERVAL '2' DAY AS createdAt,
       {_biz_created('c.c_custkey')} + INTERVAL '4' DAY AS expiryTime,
       CAST(NULL AS @NTZ) AS pausedTime
FROM (SELECT x.*, x.c_custkey % {_N_SUPPLIER} AS c_suppkey FROM {{customer}} x) c LEFT JOIN {{supplier}} s ON s.s_suppkey = c.c_suppkey
WHERE c.c_mktsegment = 'AUTOMOBILE'""")

_POLICY_CREATED = _oc("o_orderkey", "o_custkey", 120, 5)
_adapter("Policy", ("orders", "supplier"), f"""
SELECT o_orderkey AS id, o_custkey AS businessId, o_orderkey % {_N_SUPPLIER} AS carrierId, o_orderkey AS quoteId,
       concat('EXT', {_s('o_orderkey')}) AS externalPolicyId,
       CAST(NULL AS STRING) AS closeOpportunityId, CAST(NULL AS STRING) AS closePolicyId,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey - 1 END AS renewedFromPolicyId,
       CAST(NULL AS BIGINT) AS policyCancellationReasonId,
       CASE o_orderkey % 4 WHEN 0 THEN 'GL' WHEN 1 THEN 'BOP' WHEN 2 THEN 'WC' ELSE 'PL' END AS policyType,
       CASE WHEN o_orderkey % 4 = 0 THEN concat('PLIC_', {_s('o_orderkey % 3')}) END AS licenseName,
       CASE o_orderstatus WHEN 'F' THEN 'BOUND' WHEN 'O' THEN 'CANCELLED' ELSE 'EXPIRED' END AS status,
       CASE o_orderkey % 2 WHEN 0 THEN 'AGENCY' ELSE 'DIRECT' END AS billingType,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'NEW_BUSINESS' WHEN '3' THEN 'RENEWAL'
            WHEN '4' THEN 'REMARKET' WHEN '5' THEN 'CROSS_SELL' END AS saleType,
       CASE o_orderkey % 3 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'PHONE' ELSE 'PARTNER' END AS salesChannel,
       concat('UW', {_s('o_orderkey % 5')}) AS underwritingCarrier,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL
            ELSE concat('Supplier#', lpad({_s('o_orderkey % ' + _N_SUPPLIER)}, 9, '0')) END AS accountExecutive,
       CAST(NULL AS STRING) AS assignedAgent,
       CASE WHEN o_orderkey % 67 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS premium,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS commissionablePremium,
       CAST(o_orderkey * 7919 % 200000 AS DOUBLE) / 1000000 AS commissionRate,
       o_totalprice / 4 AS downPayment, CAST(NULL AS DOUBLE) AS monthlyPayment,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(25 AS DOUBLE) END AS mmrFee,
       {_b3('o_orderkey')} AS isRenewal, CAST(o_orderkey % 3 AS INTEGER) AS renewalCount,
       {_b3('o_orderkey + 1')} AS borRenewal, CAST(NULL AS BOOLEAN) AS isCancelRewrite,
       CAST(NULL AS BOOLEAN) AS isReinstated, {_b3('o_orderkey + 2')} AS isPartial,
       {_b3('o_orderkey')} AS instantPay, {_b3('o_orderkey + 1')} AS isPaygo,
       CAST(NULL AS BOOLEAN) AS isAutoBind,
       CASE WHEN o_orderstatus = 'O' THEN 'CANCELLED' END AS cancellationStatus,
       CASE WHEN o_orderstatus = 'O' THEN {_POLICY_CREATED} + INTERVAL '30' DAY END AS cancellationDate,
       CASE WHEN o_orderstatus = 'O' THEN {_POLICY_CREATED} + INTERVAL '31' DAY END AS cancellationEffectiveDate,
       CAST(NULL AS STRING) AS cancellationReason, CAST(NULL AS @NTZ) AS reinstatementDate,
       CAST(NULL AS STRING) AS borAwayStatus, CAST(NULL AS @NTZ) AS borAwayDate,
       {_POLICY_CREATED} + INTERVAL '3' DAY AS effectiveDate,
       {_POLICY_CREATED} + INTERVAL '368' DAY AS expiryDate,
       {_POLICY_CREATED} AS createdAt, {_POLICY_CREATED} AS updatedAt
FROM {{orders}}""")

_QUOTE_WALL = f"({_oc('o_orderkey', 'o_custkey', 60, 3)} + {_sec('o_orderkey * 104729 % 40000')})"
_adapter("Quote", ("orders", "supplier"), f"""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_custkey END AS businessId,
       o_orderkey AS applicationSubmissionId, o_orderkey % {_N_SUPPLIER} AS carrierId, o_orderkey AS opportunityId,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'QLIC' END AS licenseName,
       CASE o_orderkey % 4 WHEN 0 THEN 'GL' WHEN 1 THEN 'BOP' WHEN 2 THEN 'WC' ELSE 'PL' END AS policyTypeUpdated,
       CASE o_orderkey % 6 WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'EXPIRED' ELSE 'ACTIVE' END AS status,
       CASE o_orderkey % 2 WHEN 0 THEN 'AGENCY' ELSE 'DIRECT' END AS billingType,
       CASE o_orderkey % 3 WHEN 0 THEN 'MONTHLY' ELSE 'ANNUAL' END AS paymentInterval,
       {_b3('o_orderkey')} AS instantPay, CAST(NULL AS BOOLEAN) AS isHybridPay,
       {_b3('o_orderkey + 1')} AS isVisible,
       concat('UW', {_s('o_orderkey % 5')}) AS underwritingCarrier,
       o_totalprice AS price, CAST(o_orderkey % 50 AS DOUBLE) AS agencyFees,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice / 20 END AS taxes,
       CAST(25 AS DOUBLE) AS technologyFee, CAST(NULL AS DOUBLE) AS policyFee,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(25 AS DOUBLE) END AS mmrFee,
       CAST(NULL AS DOUBLE) AS otherFees, CAST(o_orderkey * 7919 % 200000 AS DOUBLE) / 1000000 AS commissionRate,
       o_totalprice / 4 AS downPayment, o_totalprice / 12 AS installmentAmount,
       CAST(o_orderkey % 12 AS INTEGER) AS numOfInstallments,
       @INSTANT({_QUOTE_WALL})@)INSTANT AS createdAt,
       {_QUOTE_WALL} + INTERVAL '30' DAY AS expiresAt
FROM {{orders}}""")

_APP_CREATED = _oc("o_orderkey", "o_custkey", 40, 2)
_adapter("ApplicationSubmission", ("orders",), f"""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_custkey END AS businessId,
       o_custkey AS userId, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey END AS applicationSubmissionBatchId,
       CAST(NULL AS BIGINT) AS employeeContactInformationId,
       CASE o_orderkey % 4 WHEN 0 THEN 'GL' WHEN 1 THEN 'BOP' WHEN 2 THEN 'WC' ELSE 'PL' END AS policyType,
       CAST(NULL AS STRING) AS licenseName,
       CASE o_orderkey % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'SENT_TO_QUOTING_ENGINE'
            WHEN 2 THEN 'NO_QUOTES_RETURNED' WHEN 3 THEN 'NEW' ELSE 'IN_PROGRESS' END AS status,
       CASE o_orderkey % 2 WHEN 0 THEN 'WEB' ELSE 'PARTNER_API' END AS source,
       {_b3('o_orderkey + 2')} AS isCrossSell, CAST(NULL AS BOOLEAN) AS isHybrid,
       {_b3('o_orderkey')} AS isAdminQuotingTool, CAST(NULL AS BOOLEAN) AS isPostPurchaseCrossSell,
       {_b3('o_orderkey + 1')} AS isRateCall1, CAST(NULL AS BOOLEAN) AS isPaygo,
       {_b3('o_orderkey + 2')} AS reminded, {_b3('o_orderkey + 1')} AS viewed,
       CAST(NULL AS STRING) AS missingFields,
       {_APP_CREATED} AS createdAt, {_APP_CREATED} AS updatedAt,
       {_APP_CREATED} + INTERVAL '10' DAY AS effectiveDate,
       {_APP_CREATED} + INTERVAL '375' DAY AS expiryDate,
       CASE WHEN o_orderkey % 3 = 1 THEN {_APP_CREATED} + INTERVAL '1' HOUR END AS viewedAt
FROM {{orders}}""")

_OPP_CREATED = _oc("o_orderkey", "o_custkey", 30, 1)
_adapter("Opportunity", ("orders",), f"""
SELECT o_orderkey AS id, o_custkey AS businessId, o_orderkey AS policyId,
       concat('opp_', {_s('o_orderkey')}) AS closeOpportunityId,
       CAST(NULL AS BIGINT) AS employeeContactInformationId,
       CASE o_orderkey % 4 WHEN 0 THEN 'GL' WHEN 1 THEN 'BOP' WHEN 2 THEN 'WC' ELSE 'PL' END AS policyType,
       CASE o_orderkey % 6 WHEN 0 THEN 'SIT_REVIEW' WHEN 1 THEN 'QUOTING' WHEN 2 THEN 'WON'
            WHEN 3 THEN 'LOST' WHEN 4 THEN 'SITTING' END AS status,
       CAST(o_orderkey % 100 AS INTEGER) AS confidence, CAST(NULL AS STRING) AS description,
       {_OPP_CREATED} AS createdAt, {_OPP_CREATED} AS updatedAt, {_OPP_CREATED} AS statusLastUpdatedAt
FROM {{orders}}""")

_adapter("OpportunityStatusHistory", ("lineitem", "orders"), f"""
SELECT li.l_orderkey * 1000000 + li.rn AS id, li.l_orderkey AS opportunityId,
       CASE WHEN li.l_linenumber = 7 THEN 'ASSIGNEE' ELSE 'STATUS' END AS changeType,
       CASE WHEN li.l_linenumber = 1 THEN NULL ELSE 'NEW' END AS @Qfrom@Q,
       CASE li.l_linenumber WHEN 1 THEN 'QUOTING' WHEN 2 THEN 'SIT_REVIEW' WHEN 3 THEN 'QUOTED'
            WHEN 4 THEN 'QUOTE_PRESENTED' WHEN 5 THEN 'WON' ELSE 'LOST' END AS @Qto@Q,
       {_B} + {_day('o.o_custkey * 37 % 1300')} + {_day('li.l_orderkey % 9 * li.l_linenumber')} AS createdAt
FROM {_LI} li JOIN {{orders}} o ON o.o_orderkey = li.l_orderkey""")

_PT_CREATED = f"({_oc('li.l_orderkey', 'o.o_custkey', 120, 5)} + {_day('li.pk % 150')})"
_adapter("PolicyTransaction", ("lineitem", "orders"), f"""
SELECT li.l_orderkey * 1000000 + li.rn AS id, li.l_orderkey AS policyId,
       CASE (li.l_orderkey + li.l_linenumber) % 8 WHEN 0 THEN 'COMMISSION' WHEN 1 THEN 'TECHNOLOGY_ACCESS_FEE'
            WHEN 2 THEN 'AGENCY_FEE' WHEN 3 THEN 'ENDORSEMENT' WHEN 4 THEN 'CANCELLATION'
            WHEN 5 THEN 'COMMISSION_PARTIAL' WHEN 6 THEN 'REFUND' ELSE 'OTHER' END AS transactionType,
       CASE WHEN li.rf = 'A' THEN 'PAYABLE' WHEN li.rf = 'N' THEN 'RECEIVABLE'
            WHEN li.l_orderkey % 17 = 0 THEN NULL ELSE 'RECEIVABLE' END AS direction,
       CASE li.l_linenumber % 2 WHEN 0 THEN 'OPEN' ELSE 'CLOSED' END AS status,
       CASE li.pk % 3 WHEN 0 THEN 'Policy CANCELled: offset' WHEN 2 THEN 'rate correction' END AS description,
       {_b3('li.l_linenumber')} AS isParent, CAST(NULL AS STRING) AS endorsementReason,
       li.px AS amount, li.px AS totalAmount, li.px / 2 AS amountReceived, CAST(li.l_orderkey * 7919 % 200000 AS DOUBLE) / 1000000 AS rate,
       {_b3('li.l_orderkey')} AS closedOut,
       {_PT_CREATED} AS createdAt, {_PT_CREATED} + INTERVAL '30' DAY AS dueBy
FROM {_LI} li JOIN {{orders}} o ON o.o_orderkey = li.l_orderkey""")

_adapter("ChangeLog", ("events", "customer", "orders"), f"""
SELECT e.event_id AS id,
       CASE WHEN e.event_type IN ('click', 'view', 'error') THEN 'POLICY' ELSE 'BUSINESS' END AS entityType,
       CASE WHEN e.event_type = 'signup' THEN 'closeStatus' WHEN e.event_type IN ('click', 'view') THEN 'status'
            ELSE 'name' END AS fieldName,
       CASE WHEN e.event_type = 'signup' THEN e.event_id % (SELECT count(*) FROM {{customer}})
            ELSE e.event_id % (SELECT count(*) FROM {{orders}}) END AS entityId,
       CASE e.event_id % 4 WHEN 0 THEN 'BOUND' WHEN 1 THEN 'CANCELLED' WHEN 3 THEN 'Junk' END AS oldValue,
       CASE CAST(floor(e.event_id / 4) AS BIGINT) % 6 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'BOUND'
            WHEN 3 THEN 'Junk' WHEN 4 THEN 'Made Contact' WHEN 5 THEN 'Attempted to Contact' END AS newValue,
       concat('user', {_s('e.user_id')}) AS changedBy,
       e.ts + {_day('e.event_id % 1200 - 300')} AS createdAt
FROM {{events}} e""")

# Every event is a ping; only views and signups know their business.
_adapter("WarmTransfer", ("events", "customer", "part"), f"""
SELECT e.event_id AS id,
       CASE WHEN e.event_type IN ('view', 'signup') THEN e.event_id % (SELECT count(*) FROM {{customer}}) END AS businessId,
       CASE WHEN e.event_id % 4 = 0 THEN CAST(e.event_id / 4 AS BIGINT) % {_N_PART} END AS campaignStatusId,
       concat('ext', {_s('e.event_id')}) AS externalBusinessId,
       CASE WHEN e.event_type IN ('view', 'signup') THEN 'ACCEPTED' WHEN e.event_id % 9 = 0 THEN 'ERROR'
            WHEN e.event_id % 9 = 1 THEN 'RECEIVED' ELSE 'REJECTED' END AS status,
       CASE e.event_id % 3 WHEN 1 THEN 'UNCLAIMED' WHEN 2 THEN 'CLAIMED' END AS claimedStatus,
       CAST(NULL AS STRING) AS soldBy,
       CASE e.event_id % 8 WHEN 0 THEN 'Campaign daily cap exceeded' WHEN 1 THEN 'Outside rejection hours (9-5)'
            WHEN 2 THEN 'No available AEs at this time' WHEN 3 THEN 'Commercial Auto leads not accepted'
            WHEN 4 THEN 'Revenue below minimum' WHEN 5 THEN 'Missing phone number'
            WHEN 6 THEN 'Vendor timeout' END AS rejectionReason,
       CASE e.event_id % 5 WHEN 0 THEN '{{{{"duns":null}}}}' WHEN 1 THEN '{{{{"awlToken":"t","awlCampaign":" X "}}}}'
            WHEN 2 THEN '{{{{"pro_email":"e"}}}}' WHEN 3 THEN '{{{{"k":1}}}}' END AS apiRequestJson,
       e.value AS bidPrice,
       e.ts + {_day('e.event_id % 900')} AS createdAt,
       CAST(NULL AS @NTZ) AS claimedAt, CAST(NULL AS @NTZ) AS laqAssignedAt,
       e.ts + {_day('e.event_id % 900')} AS updatedAt
FROM {{events}} e""")

# A call is a group of four consecutive events (every event belongs to one);
# the call's own attributes are those of the group's first event.
_adapter("RingbaCallLog", ("events", "part"), f"""
SELECT g.id, concat('call', {_s('g.id')}) AS inboundCallId,
       CASE WHEN g.id % 300 = 0 THEN NULL ELSE CAST(g.id / 4 AS BIGINT) % {_N_PART} END AS campaignStatusId,
       CAST(NULL AS STRING) AS ringbaCampaignId, concat('+1555', {_s('g.user_id')}) AS callerNumber,
       {_b3('g.id / 4')} AS hasConnected, {_b3('g.id / 4 + 1')} AS hasConverted,
       CAST(floor(g.value) AS INTEGER) AS callLengthInSeconds,
       CASE WHEN g.id % 12 = 0 THEN NULL ELSE g.ts + {_day('g.id % 365')} END AS callDt,
       g.ts + {_day('g.id % 365')} AS ingestedAt
FROM (SELECT min(e.event_id) AS id, min_by(e.user_id, e.event_id) AS user_id,
             min_by(e.value, e.event_id) AS value, min_by(e.ts, e.event_id) AS ts
      FROM {{events}} e GROUP BY e.event_id - e.event_id % 4) g""")

_adapter("RingbaCallEvent", ("events", "supplier"), f"""
SELECT e.event_id AS id, e.event_id - e.event_id % 4 AS ringbaCallLogId,
       CASE e.event_type WHEN 'click' THEN 'TargetDialed' WHEN 'view' THEN 'ConnectedCall'
            WHEN 'error' THEN 'NoAnswer' WHEN 'signup' THEN 'DuplicateCall' ELSE 'BusyCall' END AS eventName,
       concat('t', {_s('e.user_id % ' + _N_SUPPLIER)}) AS targetId,
       CASE WHEN e.event_type = 'signup' THEN NULL ELSE s.s_name END AS targetName,
       CAST(NULL AS STRING) AS targetNumber,
       CASE WHEN e.event_type = 'purchase' THEN e.value END AS conversionAmount,
       CAST(NULL AS STRING) AS failReason,
       e.ts + {_day('(e.event_id - e.event_id % 4) % 365')} AS eventTimestamp
FROM (SELECT x.*, x.user_id % {_N_SUPPLIER} AS u_suppkey FROM {{events}} x) e LEFT JOIN {{supplier}} s ON s.s_suppkey = e.u_suppkey""")


def render(name: str, dialect: str) -> str:
    """The adapter SQL for one source in one dialect, with ``{table}`` slots left."""
    _, sql = ADAPTERS[name]
    macros = dict(DIALECTS[dialect])
    macros["@Q"] = "`" if dialect == "spark" else '"'
    for k in sorted(macros, key=len, reverse=True):
        sql = sql.replace(k, macros[k])
    return sql
