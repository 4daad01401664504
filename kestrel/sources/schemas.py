"""The declared columns of the 19 source tables (SRC-01..SRC-19).

What a source holds is checked when it is read, from its schema alone: a column that is
missing or has another type is named in one error before any job runs, instead of
failing somewhere inside a model (or being cast silently). NOT NULL marks the columns that
must never be null; files do not tell, so these are held by the source checks before a
build (``plans.quality_checks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DDL = {
    "Business": """
        id bigint NOT NULL, userId bigint, businessClassificationId bigint, closeId string, leadOriginatorEmployeeId
        bigint, createdAtCohortId bigint, name string, legalEntityType string, companyType string, yearsInBusiness
        int, businessStartYear int, website string, totalAnnualRevenue double, totalAnnualPayroll double,
        totalNumberOfEmployees int, numberOfOwnerOfficers int, licenseName string, warmTransferCampaign string,
        tivlyCampaign string, partnerTrackingId string, isQualifiedPartnerLead boolean, qualifiedPartnerLeadAt
        timestamp_ntz, hasBeenSold boolean, accountExecutive string, accountManager string, soldBy string, closeStatus
        string, closeJunkParentReason string, closeJunkExplanation string, isHighRisk boolean, highRiskReason string,
        isTest boolean, createdAt timestamp_ntz""",
    "Lead": """
        id bigint NOT NULL, businessId bigint, userId bigint, accountExecutive string, workflowTypeAssigned string,
        previousAccountExecutives string, score int, madeContact boolean, isJunk boolean, timerPaused boolean,
        isCurrentlyOnCallWithAe boolean, createdAt timestamp_ntz, expiryTime timestamp_ntz, pausedTime timestamp_ntz""",
    "Policy": """
        id bigint NOT NULL, businessId bigint, carrierId bigint, quoteId bigint, externalPolicyId string,
        closeOpportunityId string, closePolicyId string, renewedFromPolicyId bigint, policyCancellationReasonId
        bigint, policyType string, licenseName string, status string, billingType string, saleType string,
        salesChannel string, underwritingCarrier string, accountExecutive string, assignedAgent string, premium
        double, commissionablePremium double, commissionRate double, downPayment double, monthlyPayment double, mmrFee
        double, isRenewal boolean, renewalCount int, borRenewal boolean, isCancelRewrite boolean, isReinstated
        boolean, isPartial boolean, instantPay boolean, isPaygo boolean, isAutoBind boolean, cancellationStatus
        string, cancellationDate timestamp_ntz, cancellationEffectiveDate timestamp_ntz, cancellationReason string,
        reinstatementDate timestamp_ntz, borAwayStatus string, borAwayDate timestamp_ntz, effectiveDate timestamp_ntz,
        expiryDate timestamp_ntz, createdAt timestamp_ntz, updatedAt timestamp_ntz""",
    "Quote": """
        id bigint NOT NULL, businessId bigint, applicationSubmissionId bigint, carrierId bigint, opportunityId bigint,
        licenseName string, policyTypeUpdated string, status string, billingType string, paymentInterval string,
        instantPay boolean, isHybridPay boolean, isVisible boolean, underwritingCarrier string, price double,
        agencyFees double, taxes double, technologyFee double, policyFee double, mmrFee double, otherFees double,
        commissionRate double, downPayment double, installmentAmount double, numOfInstallments int, createdAt
        timestamp, expiresAt timestamp_ntz""",
    "ApplicationSubmission": """
        id bigint NOT NULL, businessId bigint, userId bigint, applicationSubmissionBatchId bigint,
        employeeContactInformationId bigint, policyType string, licenseName string, status string, source string,
        isCrossSell boolean, isHybrid boolean, isAdminQuotingTool boolean, isPostPurchaseCrossSell boolean,
        isRateCall1 boolean, isPaygo boolean, reminded boolean, viewed boolean, missingFields string, createdAt
        timestamp_ntz, updatedAt timestamp_ntz, effectiveDate timestamp_ntz, expiryDate timestamp_ntz, viewedAt
        timestamp_ntz""",
    "User": """
        id bigint NOT NULL, email string NOT NULL, firstName string, lastName string, phone string, isActive boolean,
        subscribedToEmails boolean, createdAt timestamp_ntz, lastLogin timestamp_ntz""",
    "Opportunity": """
        id bigint, businessId bigint, policyId bigint, closeOpportunityId string, employeeContactInformationId bigint,
        policyType string, status string, confidence int, description string, createdAt timestamp_ntz, updatedAt
        timestamp_ntz, statusLastUpdatedAt timestamp_ntz""",
    "PolicyTransaction": """
        id bigint NOT NULL, policyId bigint, transactionType string, direction string, status string, description
        string, isParent boolean, endorsementReason string, amount double, totalAmount double, amountReceived double,
        rate double, closedOut boolean, createdAt timestamp_ntz, dueBy timestamp_ntz""",
    "Carrier": """
        id bigint NOT NULL, name string, isWholesaler boolean, agencyBill boolean""",
    "ChangeLog": """
        id bigint, entityType string, fieldName string, entityId bigint, oldValue string, newValue string, changedBy
        string, createdAt timestamp_ntz""",
    "OpportunityStatusHistory": """
        id bigint, opportunityId bigint, changeType string, from string, to string, createdAt timestamp_ntz""",
    "WarmTransfer": """
        id bigint NOT NULL, businessId bigint, campaignStatusId bigint, externalBusinessId string, status string,
        claimedStatus string, soldBy string, rejectionReason string, apiRequestJson string, bidPrice double, createdAt
        timestamp_ntz, claimedAt timestamp_ntz, laqAssignedAt timestamp_ntz, updatedAt timestamp_ntz""",
    "CampaignStatus": """
        id bigint, partnerId bigint, campaignName string, campaignExternalId string, ringbaCampaignId string, bidCost
        double, available boolean, isTivlyCampaign boolean, isHighRevenueCampaign boolean, containsEnterprise boolean""",
    "EmployeeContactInformation": """
        id bigint NOT NULL, name string, email string, employeeType string, team string, operationsTeam string,
        isActive boolean, isBelgradeAm boolean, startDate timestamp_ntz, endDate timestamp_ntz""",
    "License": """
        id bigint, name string NOT NULL, partnerId bigint, parentLicenseId bigint, integrationType string,
        leadIntakeType string, policyType string, companyType string, instantPayEnabled boolean, leadSellingEnabled
        boolean, laqPriority int, createdAt timestamp_ntz""",
    "Partner": """
        id bigint, name string, profileType string, payGoEnabled boolean, createdAt timestamp_ntz""",
    "BusinessClassification": """
        id bigint, display string, naics17 string, industry string, subIndustry string, filter3 string, sicCode string""",
    "RingbaCallLog": """
        id bigint NOT NULL, inboundCallId string, campaignStatusId bigint, ringbaCampaignId string, callerNumber
        string, hasConnected boolean, hasConverted boolean, callLengthInSeconds int, callDt timestamp_ntz, ingestedAt
        timestamp_ntz""",
    "RingbaCallEvent": """
        id bigint NOT NULL, ringbaCallLogId bigint, eventName string, targetId string, targetName string, targetNumber
        string, conversionAmount double, failReason string, eventTimestamp timestamp_ntz""",
}

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
          "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(ddl: str) -> T.StructType:
    """Spark's own parser needs a session, which there is none of at import."""
    fields = [" ".join(column.split()).split(" ", 2) for column in ddl.split(",")]
    return T.StructType([T.StructField(f[0], _TYPES[f[1]], f[2:] != ["NOT NULL"]) for f in fields])


SCHEMAS: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# Types a declared type takes as well: no value changes by the cast.
_TAKES: dict[type, tuple[type, ...]] = {
    T.LongType: (T.IntegerType, T.ShortType, T.ByteType),
    T.IntegerType: (T.ShortType, T.ByteType),
    T.DoubleType: (T.FloatType, T.DecimalType),
    T.StringType: (T.VarcharType, T.CharType),
}


class SourceSchemaError(ValueError):
    """A source table does not have its declared columns."""


def problems(name: str, found: T.StructType) -> list[str]:
    """What is wrong with a source's schema, one line a column."""
    have = {f.name: f.dataType for f in found.fields}
    out = []
    for f in SCHEMAS[name].fields:
        wanted = f"{name}.{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        if f.name not in have:
            close = [n for n in have if n.lower() == f.name.lower()]
            out.append(f"{wanted}: missing" + (f" (there is {close[0]!r})" if close else ""))
        elif have[f.name] != f.dataType and not isinstance(have[f.name], _TAKES.get(type(f.dataType), ())):
            out.append(f"{wanted}: is {have[f.name].simpleString()}")
    return out


def declared(name: str, df: DataFrame) -> DataFrame:
    """``df`` with exactly the declared columns and types of a source; other columns are
    left out. Raises ``SourceSchemaError`` that names every column at fault."""
    wrong = problems(name, df.schema)
    if wrong:
        raise SourceSchemaError("; ".join(wrong))
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.col(f"`{f.name}`") if have[f.name] == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                       for f in SCHEMAS[name].fields])
