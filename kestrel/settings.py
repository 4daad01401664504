"""Build parameters shared by every model.

The values under "Fixed values" are business rules the reports depend on; they
must stay exactly as written for results to match. Everything else is a
parameter a deployment sets once.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from zoneinfo import ZoneInfo

# ---------------------------------------------------------------------------
# Fixed values (must match the published reporting rules exactly)
# ---------------------------------------------------------------------------

# Carriers reported individually; anything else is grouped as "Other".
TRACKED_CARRIERS = {"Chubb": "Chubb", "Great American Insurance Group": "GAIG"}
# The carrier that only holds test policies and quotes.
TEST_CARRIER = "Fake Insurance"
# Ledger transaction types.
PARTIAL_TYPES = ("COMMISSION_PARTIAL", "TECHNOLOGY_ACCESS_FEE_PARTIAL")
CORE_TYPES = ("COMMISSION", "TECHNOLOGY_ACCESS_FEE", "AGENCY_FEE")
NB_REVENUE_TYPES = ("COMMISSION", "TECHNOLOGY_ACCESS_FEE", "AGENCY_FEE", "ENDORSEMENT", "CANCELLATION")
# Application statuses that mean the application reached quoting.
SUBMITTED_STATUSES = ("COMPLETED", "SENT_TO_QUOTING_ENGINE", "NO_QUOTES_RETURNED")
# Sale types that keep an existing account.
RETAINED_SALE_TYPES = ("RENEWAL", "REMARKET", "RENEWAL_CANCEL_REWRITE")
# Lead-vendor licenses by acquisition channel (third-party partner names).
WARM_TRANSFER_LICENSES = (
    "Housecall Pro - Sales Channel", "Smart Financial", "Smart Financial - Data Leads",
    "CTQ", "Tivly", "Tivly - PathPoint", "Bold Penguin", "All Web Leads",
    "Switchboard", "QuinStreet",
)
DATA_LEAD_LICENSES = (
    "Trusted Choice - Prebidder", "Trusted Choice", "All Web Leads – Data Leads",
    "All Web Leads – Fresh Data Leads", "Swyft Filings - Sonic", "Kapitus",
    "Collective - Activation Flow",
)
# Request-payload keys that identify a lead vendor, first match wins.
PAYLOAD_VENDOR_KEYS = (("awlToken", "All Web Leads"), ("pro_email", "Housecall Pro"), ("duns", "Bold Penguin"))
# Rejection-reason buckets, first match wins; patterns are case-insensitive LIKE.
REJECTION_BUCKETS = (
    ("Daily cap reached", ("%daily cap%",)),
    ("Outside acceptance hours", ("%rejection hours%",)),
    ("No AE available", ("No available AEs%", "%no agents available%")),
    ("Commercial auto restriction", ("%Commercial Auto%",)),
    ("Did not meet lead requirements", ("%does not meet the lead requirements%", "%below minimum%",
                                        "%legal_entity_id%", "%unknown sicCode%", "%invalid awlCampaign%")),
    ("Missing or invalid data", ("Missing %", "Invalid %")),
)
REJECTION_OTHER = "Other"
# Business.soldBy value meaning no AE picked the lead up.
API_ACCOUNT = "API Account"
# Cohort windows (days) and maturity thresholds.
MATURITY_DAYS = (7, 14, 30, 60, 90)
CONVERSION_DAYS = (1, 7, 14, 30, 60, 90)
# Cancellation-driven ledger rows count only within this many days of the policy.
CANCELLATION_WINDOW_DAYS = 90
# Date spine start; it runs to the end of the year after as_of.
SPINE_START = _dt.date(2023, 1, 1)
# AE-sales snapshot: 1 month, 5 hours, 5 minutes after the policy's creation month starts.
SNAPSHOT_OFFSET = (1, 5, 5)
EASTERN = "America/New_York"


def eastern_today(now: _dt.datetime | None = None) -> _dt.date:
    """The date in Eastern time now, whatever the driver machine's zone."""
    return (now or _dt.datetime.now(_dt.timezone.utc)).astimezone(ZoneInfo(EASTERN)).date()


@dataclass(frozen=True)
class Settings:
    """Per-deployment parameters.

    ``as_of`` is today in Eastern unless given: every age and maturity flag is
    measured against it, so a build is reproducible.
    ``house_brand`` (required) is one of the owner-name tokens that mark test
    accounts; ``other_non_partner_licenses`` (required) are the full names of the
    company's own channels.
    """

    house_brand: str
    other_non_partner_licenses: tuple[str, ...]
    as_of: _dt.date = field(default_factory=lambda: eastern_today())
    extra_test_tokens: tuple[str, ...] = ("TEST",)
    warm_transfer_licenses: tuple[str, ...] = WARM_TRANSFER_LICENSES
    data_lead_licenses: tuple[str, ...] = DATA_LEAD_LICENSES

    def __post_init__(self) -> None:
        if not self.house_brand.strip():
            raise ValueError("house_brand must be given: an empty token would mark every owner as a test account")

    @property
    def test_tokens(self) -> tuple[str, ...]:
        return (self.house_brand.upper(), *self.extra_test_tokens)

    @property
    def house_licenses(self) -> tuple[str, ...]:
        return self.other_non_partner_licenses

    @property
    def spine_end(self) -> _dt.date:
        return _dt.date(self.as_of.year + 1, 12, 31)

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)


def fixture_settings() -> Settings:
    """Settings for the source tables derived from the driver's test tables.

    License names there are ``NATION_<k>``; keys 0-6 are warm-transfer vendors,
    7-11 data-lead vendors and 12-13 in-house channels.
    """
    return Settings(
        as_of=_dt.date(2026, 10, 1),
        house_brand="Homebase",
        extra_test_tokens=("TEST",),
        warm_transfer_licenses=tuple(f"NATION_{k}" for k in range(0, 7)),
        data_lead_licenses=tuple(f"NATION_{k}" for k in range(7, 12)),
        other_non_partner_licenses=tuple(f"NATION_{k}" for k in range(12, 14)),
    )
