"""Business vocabulary used by the views and reports."""

# Raw source tables, in extraction order.
LEAD_ACTIVITIES = "lead_activites_raw"
CUSTOM_ACTIVITIES = "custom_activites_raw"
CRM_USERS = "close_crm_users_raw"
SOURCE_TABLES = (LEAD_ACTIVITIES, CUSTOM_ACTIVITIES, CRM_USERS)

# Fixed value: high-water mark of a table that was never extracted.
EPOCH = "1970-01-01 00:00:00"

# Record kind that carries custom fields, and their key prefix.
CUSTOM_ACTIVITY = "CustomActivity"
CUSTOM_PREFIX = "custom."

# Activity families.
PROSPECTING_TYPES = ("1) Prospecting Activity", "2) Prospecting Follow Up")
TRIAGE_TYPES = ("3) Triage Call", "4) Triage Call Follow Up")
STRATEGY_TYPES = ("5) Strategy Call", "6) Strategy Call Follow Up")
SALE_TYPES = ("7) New Sale", "8) New Sale [Custom Payment Plan]")

# Field names read by the views.
SETTER = "Setter"
CLOSER = "Closer"
TRIAGE_OUTCOME = "Triage Call Outcome"
PROSPECTING_OUTCOME = "Prospecting Call Outcome"
STRATEGY_OUTCOME = "Strategy Call Outcome"
FOLLOW_UP_OUTCOME = "Follow Up Call Outcome"
OFFER_PRESENTED = "Offer Presented"
CONTRACT_VALUE = "Contract Value"
SALES_TYPE = "Sales Type"
CASH_COLLECTED = "Cash Collected"
PROGRAM = "Program"
DATE_OF_SALE = "Date of Sale"
OBJECTIONS = "Objections Faced?"

# Outcomes with a meaning in the funnel.
TRIAGE_SET = "1. Strategy Call Scheduled"
TRIAGE_NOT_TAKEN = ("6. No Show", "7. Reschedule", "8. Cancel")
PROSPECTING_SET = "2. Strategy Call Scheduled"
NOT_ATTENDED = (
    "4. No Show",
    "3. Cancel- Not Interested",
    "2. Admin Cancel",
    "8. Cancel- Nurture",
)

# Explicit attendance classes over both numbering schemes.
CORRECTED_ATTENDED = ("1. Follow Up", "6. Sale", "5. Sale", "7. Lost", "6. Lost")
CORRECTED_NOT_ATTENDED = (
    "4. No Show",
    "3. No Show",
    "5. Reschedule",
    "4. Reschedule",
    "2. Admin Cancel",
    "3. Cancel- Not Interested",
    "2. Cancel- No Longer Interested",
    "8. Cancel- Nurture",
    "7. Cancel- Nurture",
)

# Closer report counts, as first built and as corrected.
CLOSER_COUNTS = {
    "admin_cancel": ("2. Admin Cancel",),
    "cancel_nurture": ("8. Cancel- Nurture",),
    "cancel_not_interest": ("3. Cancel- Not Interested",),
    "no_show": ("4. No Show",),
    "lost": ("7. Lost",),
    "sale": ("5. Sale", "6. Sale"),
}
CORRECTED_CLOSER_COUNTS = {
    "admin_cancel": ("2. Admin Cancel",),
    "cancel_nurture": ("8. Cancel- Nurture", "7. Cancel- Nurture"),
    "cancel_not_interest": ("3. Cancel- Not Interested", "2. Cancel- No Longer Interested"),
    "no_show": ("4. No Show", "3. No Show"),
    "lost": ("7. Lost", "6. Lost"),
    "sale": ("6. Sale", "5. Sale"),
}
CANCEL_COLUMNS = ("admin_cancel", "cancel_nurture", "cancel_not_interest")

# Objection categories and the text each one looks for.
OBJECTION_PATTERNS = {
    "money_count": "money",
    "fear_count": "fear",
    "hung_up_count": "hung up",
    "logistical_count": "logistical",
    "no_obj_count": "no objection",
    "other_coaches_count": "other coach",
    "partner_count": "partner",
    "think_abt_it_count": "think",
    "time_count": "time",
    "trust_count": "trust",
    "value_count": "value",
    "not_looking_count": "not looking",
}
CORRECTED_OBJECTION_PATTERNS = OBJECTION_PATTERNS | {"not_looking_count": "looking"}

# Fixed value: "N. Label" / "N) Label" outcome codes; Unicode digits and
# blanks count, and only a line feed ends a line.
OUTCOME_CODE = r"(?Ud)^\s*\d+[).]\s*.+"

# Fixed value: share of failed rows above which a load is reported.
ERROR_RATE_LIMIT = 0.01

# E-mail endings of the company's own accounts; set these per deployment.
INTERNAL_DOMAINS = ("staff.example", "staf.example", "saff.example")
