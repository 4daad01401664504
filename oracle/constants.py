"""Fixed values of the reporting rules and of the test deployment, stated here
again so that a wrong value in the engine's settings shows as a mismatch."""

import datetime as _dt

PARTIAL_TYPES = ("COMMISSION_PARTIAL", "TECHNOLOGY_ACCESS_FEE_PARTIAL")
CORE_TYPES = ("COMMISSION", "TECHNOLOGY_ACCESS_FEE", "AGENCY_FEE")
NB_REVENUE_TYPES = ("COMMISSION", "TECHNOLOGY_ACCESS_FEE", "AGENCY_FEE", "ENDORSEMENT", "CANCELLATION")
SUBMITTED_STATUSES = ("COMPLETED", "SENT_TO_QUOTING_ENGINE", "NO_QUOTES_RETURNED")
RETAINED_SALE_TYPES = ("RENEWAL", "REMARKET", "RENEWAL_CANCEL_REWRITE")
PAYLOAD_VENDOR_KEYS = (("awlToken", "All Web Leads"), ("pro_email", "Housecall Pro"), ("duns", "Bold Penguin"))
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
MATURITY_DAYS = (7, 14, 30, 60, 90)
CONVERSION_DAYS = (1, 7, 14, 30, 60, 90)
CANCELLATION_WINDOW_DAYS = 90
SPINE_START = _dt.date(2023, 1, 1)


class Deployment:
    """The test build's parameters."""

    as_of = _dt.date(2026, 10, 1)
    spine_end = _dt.date(2027, 12, 31)
    test_tokens = ("HOMEBASE", "TEST")
    warm_transfer_licenses = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5", "NATION_6")
    data_lead_licenses = ("NATION_7", "NATION_8", "NATION_9", "NATION_10", "NATION_11")
    house_licenses = ("NATION_12", "NATION_13")
