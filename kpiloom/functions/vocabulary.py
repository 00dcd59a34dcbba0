"""Fixed values that must equal the reference platform's for equal results.

They are listed plainly and in their natural order. Operators take them as
parameters (with these as defaults), so nothing clinic-specific is hidden in
operator code.
"""

# --- fixed values ---------------------------------------------------------
# Appointment status: cleaned key (trimmed, '-' and ' ' removed, lower-cased)
# -> controlled value. Anything else maps to null.
STATUS_VOCABULARY = {
    "completed": ["completed", "complete"],
    "cancelled": ["cancelled", "canceled"],
    "no_show": ["noshow"],
}
STATUS_VALUES = ["completed", "cancelled", "no_show"]

# Lead source: cleaned key (trimmed, lower-cased) -> marketing channel.
CHANNEL_VOCABULARY = {
    "paid_search": ["google ads", "google", "adwords"],
    "paid_social": ["facebook ads", "fb", "facebook", "instagram", "ig"],
    "referral": ["referral", "friend"],
    "organic": ["website", "organic", "seo"],
    "walk_in": ["walk-in", "walkin"],
}
CHANNEL_VALUES = ["paid_search", "paid_social", "referral", "organic", "walk_in"]

# Test accounts: e-mail domain suffix and first name (compared lower-cased).
TEST_EMAIL_SUFFIX = "@clinic-test.com"
TEST_FIRST_NAME = "test"

PAYMENT_TYPES = ["service", "membership", "refund"]
OWNERSHIP_VALUES = ["corporate", "franchise"]
VOID_STATUS = "void"
MEMBERSHIP_TYPE = "membership"

# Raw tables and their primary keys, in load order.
TABLES = {
    "locations": "location_id",
    "customers": "customer_id",
    "services": "service_id",
    "memberships": "membership_id",
    "appointments": "appointment_id",
    "payments": "payment_id",
    "leads": "lead_id",
}
# --- end of fixed values --------------------------------------------------
