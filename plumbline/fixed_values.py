"""Constants whose content decides results.

They are stated as plain text so that scores, labels and report rows agree with
the published rule definitions.
"""

# ---- event quality: observation window, allow-list, weights, penalties, bands
WINDOW_START_MS = 1430438400000  # 2015-05-01 00:00:00 UTC
WINDOW_END_MS = 1443657599000  # 2015-09-30 23:59:59 UTC
VALID_EVENTS = ("view", "addtocart", "transaction")
BROWSE_EVENTS = ("view", "addtocart")
TRANSACTION = "transaction"
GAP_ALERT_DAYS = 7
SAMPLE_SIZE = 200_000
SEED = 42

DIMENSION_WEIGHTS = {
    "completeness": 0.20,
    "uniqueness": 0.20,
    "validity": 0.20,
    "consistency": 0.20,
    "freshness": 0.10,
    "referential_integrity": 0.10,
}
SEVERITY_PENALTIES = {"critical": 25, "high": 15, "medium": 8, "low": 3}
SEVERITY_RANK = {"critical": 0, "high": 1, "medium": 2, "low": 3}
QUALITY_BANDS = ((90, "Excellent"), (75, "Good"), (60, "Warning"))
TIER_SCORE_BANDS = {
    "clean": (90, 100),
    "light": (75, 89),
    "moderate": (60, 74),
    "severe": (0, 59),
}
INVALID_EVENT_SAMPLES = ("click", "scroll", "hover", "unknown", "PAGE_VIEW")
OUT_OF_WINDOW_MS = 946684800000  # 2000-01-01 00:00:00 UTC

# ---- event quality: the 16 checks (rule id, description, dimension, severity)
EVENT_CHECKS = (
    ("COMP-001", "visitorid must not be null", "completeness", "critical"),
    ("COMP-002", "itemid must not be null", "completeness", "critical"),
    ("COMP-003", "event type must not be null", "completeness", "critical"),
    ("COMP-004", "transactionid must not be null on transaction events", "completeness", "critical"),
    ("UNIQ-001", "transactionid must be unique per transaction event", "uniqueness", "critical"),
    ("UNIQ-002", "no fully duplicate rows across all columns", "uniqueness", "high"),
    ("VALID-001", "event must be one of: view, addtocart, transaction", "validity", "critical"),
    ("VALID-002", "timestamp must fall within dataset observation window (2015-05-01 to 2015-09-30)", "validity", "high"),
    ("VALID-003", "itemid must be a positive integer", "validity", "high"),
    ("CONS-001", "transaction event must always have a transactionid", "consistency", "critical"),
    ("CONS-002", "view and addtocart events must not have a transactionid", "consistency", "high"),
    ("CONS-003", "transaction must not be the first event for a visitor", "consistency", "medium"),
    ("FRESH-001", "latest event timestamp must be within the observation window", "freshness", "high"),
    ("FRESH-002", "no gap greater than 7 consecutive days with zero events", "freshness", "medium"),
    ("RI-001", "every itemid in events must exist in the product catalogue", "referential_integrity", "high"),
    ("RI-002", "every categoryid in item_properties must exist in category_tree", "referential_integrity", "high"),
)

# texts of the checks whose parameters they name
WINDOW_TEXT = ("timestamp must fall within dataset observation window (", ")")
GAP_TEXT = "no gap greater than {days} consecutive days with zero events"
ALLOWED_TEXT = "event must be one of: "

# ---- event quality: report texts per rule (rule id, business impact, recommendation)
RULE_TEXTS = (
    ("COMP-001", "User behaviour cannot be attributed. Marketing and funnel reports become unreliable.",
     "Investigate upstream event tracking. Ensure visitorid is set before events are fired."),
    ("COMP-002", "Affected events cannot be linked to any product. Revenue and catalogue reports break.",
     "Check the event collection pipeline for missing itemid fields."),
    ("COMP-003", "Event type is unknown. Funnel analysis includes unclassifiable rows.",
     "Validate event payloads at ingestion. Reject records without an event type."),
    ("COMP-004", "Purchase events have no order reference. Fulfilment, refunds, and revenue tracking fail.",
     "Ensure the checkout system always writes a transactionid before committing the event."),
    ("UNIQ-001", "Revenue is double-counted. Finance reports will overstate sales figures.",
     "Deduplicate on transactionid before loading into the reporting layer."),
    ("UNIQ-002", "Duplicate rows inflate event counts and distort conversion rates.",
     "Add a deduplication step at ingestion. Investigate the source of duplicate events."),
    ("VALID-001", "Unrecognised event types corrupt funnel metrics and recommendation models.",
     "Enforce an event type allowlist at the collection layer. Alert on unknown values."),
    ("VALID-002", "Out-of-range timestamps corrupt trend charts and time-based aggregations.",
     "Validate timestamps at ingestion. Filter or quarantine out-of-range records."),
    ("VALID-003", "Invalid item IDs cannot be joined to the product catalogue.",
     "Validate itemid is a positive integer before writing to the event store."),
    ("CONS-001", "Purchases without order IDs cannot be traced, reconciled, or refunded.",
     "Block transaction events from entering the pipeline without a confirmed transactionid."),
    ("CONS-002", "Non-purchase events incorrectly tagged with order IDs corrupt transaction counts.",
     "Strip transactionid from non-transaction events at the source."),
    ("CONS-003", "First event is a purchase with no prior browsing — likely a tracking or ingestion error.",
     "Investigate affected visitors for session tracking gaps or bot activity."),
    ("FRESH-001", "Dataset is outside its expected date range — may be stale or incorrectly loaded.",
     "Verify the ingestion job ran for the expected date range. Re-run if data is missing."),
    ("FRESH-002", "A gap of 7+ days with no events suggests a pipeline outage or missed ingestion.",
     "Check pipeline logs for the gap period. Identify whether data was lost or delayed."),
    ("RI-001", "Events reference products that do not exist in the catalogue. Category and revenue rollups will have gaps.",
     "Backfill missing products in the catalogue or filter orphaned events before reporting."),
    ("RI-002", "Products reference categories that do not exist in the hierarchy. Category-level reporting is broken.",
     "Sync the category tree with the product catalogue. Remove or remap orphaned category IDs."),
)
DEFAULT_RECOMMENDATION = "Investigate and resolve."

# ---- governance: default inventory (9 columns)
INVENTORY = (
    ("DS-001", "Customer Master", "Customer", "Regulatory Critical", "Head of Customer Data", "Customer Data Steward", "Daily", "CRM", "High"),
    ("DS-002", "Transaction Ledger", "Transaction", "Regulatory Critical", "Head of Finance", "Finance Data Steward", "Intraday", "Core Banking", "High"),
    ("DS-003", "Risk Exposure", "Risk", "Regulatory Critical", "Chief Risk Officer", "Risk Data Steward", "Daily", "Risk Engine", "High"),
    ("DS-004", "General Ledger", "Finance", "Regulatory Critical", "CFO", "GL Data Steward", "Daily", "ERP", "High"),
    ("DS-005", "Product Master", "Product", "Business Critical", "Head of Product", "Product Data Steward", "Weekly", "PMS", "Medium"),
    ("DS-006", "Sales Performance", "Sales", "Business Critical", "Head of Sales", "Sales Data Steward", "Daily", "Salesforce", "Medium"),
    ("DS-007", "Customer Channels", "Customer", "Business Critical", "Head of Digital", "Digital Data Steward", "Daily", "Digital Hub", "Medium"),
    ("DS-008", "Branch Performance", "Operations", "Business Critical", "Head of Retail Banking", "Branch Data Steward", "Weekly", "Branch MIS", "Medium"),
    ("DS-009", "Inventory", "Operations", "Operational Critical", "Operations Manager", "Ops Data Steward", "Daily", "OMS", "Low"),
    ("DS-010", "Orders", "Operations", "Operational Critical", "Operations Manager", "Ops Data Steward", "Daily", "OMS", "Low"),
    ("DS-011", "Resource Allocation", "HR", "Operational Critical", "Head of HR", "HR Data Steward", "Weekly", "HRMS", "Low"),
    ("DS-012", "Branch Reference", "Reference", "Reference Data", "Data Governance Office", "Ref Data Steward", "Monthly", "MDM", "Low"),
    ("DS-013", "Product Reference", "Reference", "Reference Data", "Data Governance Office", "Ref Data Steward", "Monthly", "MDM", "Low"),
)

# ---- governance: default rulebook (rule id, rule name, category, threshold %, severity)
RULEBOOK = (
    ("COMP-001", "Customer ID Not Null", "Completeness", 100.0, "Critical"),
    ("COMP-002", "Transaction Amount Not Null", "Completeness", 100.0, "Critical"),
    ("COMP-003", "Account Number Completeness", "Completeness", 99.5, "High"),
    ("COMP-004", "Risk Rating Populated", "Completeness", 98.0, "High"),
    ("COMP-005", "Product Code Completeness", "Completeness", 100.0, "High"),
    ("COMP-006", "Branch Code Populated", "Completeness", 100.0, "Medium"),
    ("COMP-007", "GL Account Code Completeness", "Completeness", 100.0, "Critical"),
    ("COMP-008", "Contact Email Completeness", "Completeness", 95.0, "Medium"),
    ("ACCU-001", "Transaction Amount Positive", "Accuracy", 99.0, "Critical"),
    ("ACCU-002", "Date Range Validity", "Accuracy", 99.5, "High"),
    ("ACCU-003", "Customer Age Valid Range", "Accuracy", 99.0, "Medium"),
    ("ACCU-004", "Risk Score Valid Range", "Accuracy", 99.5, "High"),
    ("ACCU-005", "Interest Rate Accuracy", "Accuracy", 99.9, "Critical"),
    ("ACCU-006", "Postcode Format Accuracy", "Accuracy", 97.0, "Low"),
    ("ACCU-007", "GL Balance Accuracy", "Accuracy", 100.0, "Critical"),
    ("ACCU-008", "Product Price Positive", "Accuracy", 100.0, "High"),
    ("CONS-001", "Customer-Account Referential Integrity", "Consistency", 100.0, "Critical"),
    ("CONS-002", "Transaction-Account Consistency", "Consistency", 100.0, "Critical"),
    ("CONS-003", "Branch Code Cross-Dataset Consistency", "Consistency", 99.0, "High"),
    ("CONS-004", "Product Code Cross-Dataset Consistency", "Consistency", 99.5, "High"),
    ("CONS-005", "Risk Tier Consistency", "Consistency", 98.0, "High"),
    ("CONS-006", "GL-Transaction Reconciliation", "Consistency", 99.9, "Critical"),
    ("CONS-007", "Customer Status Consistency", "Consistency", 99.0, "Medium"),
    ("TIME-001", "Customer Master Freshness", "Timeliness", 98.0, "High"),
    ("TIME-002", "Transaction Feed SLA", "Timeliness", 99.0, "Critical"),
    ("TIME-003", "Risk Exposure Daily Refresh", "Timeliness", 99.5, "Critical"),
    ("TIME-004", "GL Close Timeliness", "Timeliness", 98.0, "High"),
    ("TIME-005", "Sales Performance Refresh", "Timeliness", 97.0, "Medium"),
    ("TIME-006", "Reference Data Currency", "Timeliness", 95.0, "Medium"),
    ("TIME-007", "Risk Report Delivery SLA", "Timeliness", 100.0, "Critical"),
)

# what each control asserts, in words
RULE_DESCRIPTIONS = {
    "COMP-001": "Every record names its customer.",
    "COMP-002": "Every transaction has an amount.",
    "COMP-003": "The account number is filled in and not blank.",
    "COMP-004": "Every exposure has a risk rating.",
    "COMP-005": "Every product has its code.",
    "COMP-006": "Every branch record has the branch code.",
    "COMP-007": "Every ledger entry has an account code.",
    "COMP-008": "Active customers have contact data.",
    "ACCU-001": "Amounts are above zero.",
    "ACCU-002": "Dates lie inside the operating period.",
    "ACCU-003": "Ages lie inside the plausible range.",
    "ACCU-004": "Scores lie inside the range of the model.",
    "ACCU-005": "Rates lie inside the permitted range.",
    "ACCU-006": "Codes follow the required pattern.",
    "ACCU-007": "Header and detail totals agree within 0.01.",
    "ACCU-008": "Active products have a price above zero.",
    "CONS-001": "Every account belongs to a known customer.",
    "CONS-002": "Every transaction belongs to a known account.",
    "CONS-003": "Branch codes exist in the reference data.",
    "CONS-004": "Product codes exist in the product master.",
    "CONS-005": "The stored tier equals the tier implied by the value.",
    "CONS-006": "Monthly totals of both sources agree within 0.1 %.",
    "CONS-007": "A status agrees between the data sets that hold it.",
    "TIME-001": "Entities were updated within 24 hours of the reference time.",
    "TIME-002": "Consecutive arrivals are at most 15 minutes apart.",
    "TIME-003": "The first daily record arrives before 08:00.",
    "TIME-004": "The last daily record arrives within two hours of day end.",
    "TIME-005": "The next record arrives by 07:00 of the following day.",
    "TIME-006": "Records are renewed within a monthly cycle.",
    "TIME-007": "Delivery follows by 09:00 of the next day.",
}

# ---- governance: default applicability of rules to datasets
APPLICABLE_RULES = {
    "DS-001": ("COMP-001", "COMP-003", "COMP-008", "ACCU-003", "ACCU-006", "CONS-001", "CONS-007", "TIME-001"),
    "DS-002": ("COMP-002", "ACCU-001", "ACCU-002", "CONS-002", "CONS-006", "TIME-002"),
    "DS-003": ("COMP-004", "ACCU-004", "CONS-005", "TIME-003", "TIME-007"),
    "DS-004": ("COMP-007", "ACCU-007", "CONS-006", "TIME-004"),
    "DS-005": ("COMP-005", "ACCU-008", "CONS-004"),
    "DS-006": ("COMP-006", "ACCU-001", "TIME-005"),
    "DS-007": ("COMP-008", "CONS-007", "TIME-001"),
    "DS-008": ("COMP-006", "TIME-005"),
    "DS-009": ("COMP-005", "ACCU-008"),
    "DS-010": ("COMP-002", "CONS-004", "TIME-002"),
    "DS-011": ("COMP-001", "COMP-008"),
    "DS-012": ("CONS-003", "TIME-006"),
    "DS-013": ("CONS-004", "TIME-006"),
}

# ---- governance: windows, labels, texts
RECENT_DAYS = 7  # inclusive: eight dates
TREND_SPLIT_DAYS = 15
REPEAT_LAST_TESTS = 5
REPEAT_MIN_FAILS = 3
TREND_CUT_PCT = 10.0
TREND_FLOOR = 0.01
WATCHLIST_PENALTY = 3
MONITOR_PENALTY = 1
TRUST_BANDS = ((90, "Trusted"), (75, "Monitor"))
MATURITY_BANDS = ((90, "Optimized"), (75, "Managed"), (60, "Developing"))
MATURITY_WEIGHTS = {
    "control_coverage": 0.30,
    "automation_pct": 0.30,
    "sla_compliance": 0.25,
    "audit_completeness": 0.15,
}
AUTOMATION_PCT = 85.0
AUDIT_COMPLETENESS = 100.0
ENTERPRISE = "Enterprise (Overall)"
SLA_DAYS = {"Critical": 1, "High": 3, "Medium": 7, "Low": 14}
DEFAULT_SLA_DAYS = 7
CHRONIC_MIN_FAILS = 27
STREAK_DAYS = 7

CRITICAL_FAILURE = "Critical Control Failure"
REPEATED_FAILURE = "Repeated Control Failure"
REGULATORY_ISSUE = "Regulatory Critical Issue"
CRITICAL_ACTION = ("Immediately escalate to ", ". Halt downstream reporting until resolved.")
REPEATED_ACTION = ("Assign to ", " for root cause investigation. Target resolution within 48 hours.")
REGULATORY_ACTION = "Notify Data Governance Office and Chief Risk Officer. Document for regulatory audit log."

# watchlist outcome -> (reason, recommended action); the first reason is built from the signals
WATCHLIST_ACTION = "Escalate to Data Steward for investigation. Review source system feeds."
MONITOR_REASON = "One metric showing deteriorating trend. Monitor for 5 business days."
MONITOR_ACTION = "Assign to Data Steward for monitoring. No immediate escalation required."
IMPROVING_REASON = "Multiple metrics showing improvement trend."
IMPROVING_ACTION = "Continue monitoring. No action required."
STABLE_REASON = "All metrics within acceptable range."
STABLE_ACTION = "No action required. Schedule next review in 30 days."
SIGNAL_TEXTS = {
    "null": "Null rate increased %.1f%%",
    "dup": "Duplicate rate increased %.1f%%",
    "fail": "Control failure rate worsening (%.1f%%)",
}

# monthly review: condition -> (priority, action text)
REVIEW_ACTIONS = {
    "critical": ("Immediate", "Escalate %d critical exception(s) to the Chief Data Officer. Halt use of affected datasets in regulatory reports until resolved."),
    "watchlist": ("High Priority", "Assign Data Stewards to investigate: %s. Root cause analysis within 5 business days."),
    "breach": ("High Priority", "Address %d SLA breach(es). Review escalation protocols with relevant teams."),
    "feeds": ("Medium Priority", "Engage Source System Team to review upstream feed stability and add automated alerting for feed delays."),
    "timeliness": ("Medium Priority", "Schedule Data Steward review for all Timeliness controls with repeated failures."),
    "maturity": ("Standard", "Update Governance Maturity roadmap targeting 'Managed' level next quarter."),
}
