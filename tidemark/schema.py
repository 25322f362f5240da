"""Table schemas and the small fixed dimensions."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind() if isinstance(kind, type) else kind) for name, kind in fields.items()])


TEXTS = ArrayType(StringType())

FILING = _struct(form=StringType, company=StringType, cik=LongType, filed=DateType, path=StringType, accession=StringType, items=TEXTS, sic=IntegerType, sic_desc=StringType, period=DateType, scan_day=DateType, seq=LongType)
EVIDENCE = _struct(
    source=StringType, severity=StringType, why=StringType, item_code=StringType, item_title=StringType, role=StringType, successor_named=BooleanType, direction=StringType, predecessor_auditor=StringType,
    predecessor_tier=StringType, successor_auditor=StringType, successor_tier=StringType, tier_downgrade=BooleanType, disagreements_disclosed=BooleanType, prior_state=StringType, current_state=StringType,
    similarity=DoubleType, days_past_due_date=IntegerType, topics=TEXTS, new_standards=TEXTS, prior_form=StringType, prior_filed=StringType,
)
EVENT = _struct(
    seq=LongType, id=StringType, signal_type=StringType, confidence=StringType, cik=LongType, company=StringType, ticker=StringType, form=StringType, filed=DateType, accession=StringType, filing_url=StringType,
    headline=StringType, quote=StringType, sic_desc=StringType, size_tier=StringType, public_float=DoubleType, prior_accession=StringType, prior_url=StringType, beta=BooleanType, routine=BooleanType,
    scan_day=DateType, recorded_at=TimestampType, evidence=EVIDENCE,
)
SUBMISSIONS = _struct(cik=LongType, accessionNumber=TEXTS, filingDate=TEXTS, form=TEXTS, primaryDocument=TEXTS, items=TEXTS)
TOMBSTONE = _struct(event_id=StringType, action=StringType)
RUN = _struct(date=DateType, index_rows=LongType, candidates=LongType, operating=LongType, events_written=LongType, blocked=BooleanType, retryable=BooleanType, periodic_skipped=IntegerType, finished_at=TimestampType)
HOLD_FIELDS = ("accession", "signal_type", "filed", "scan_day", "source_url", "reason")

# They must equal the published record's for equal results.
SIGNAL_ORDER = ("restatement", "comment_letter", "material_weakness", "auditor_change", "officer_departure", "going_concern", "policy_change", "revenue_recognition", "late_filing")
COMPARISON_SIGNALS = ("going_concern", "policy_change", "revenue_recognition")
ITEM_SIGNALS = {"4.01": "auditor_change", "4.02": "restatement", "5.02": "officer_departure"}
FORM_FAMILIES = ("8-K", "10-K", "10-Q", "20-F", "NT", "LETTER")
EVENT_FORMS = ("8-K", "8-K/A")
PERIODIC_FORMS = ("10-K", "10-K/A", "10-KT", "10-KT/A", "10-Q", "10-Q/A", "10-QT", "10-QT/A", "20-F", "20-F/A", "40-F", "40-F/A")
ANNUAL_LATE_FORMS = ("NT 10-K", "NT 10-K/A", "NT 20-F", "NT 20-F/A")
LATE_FORMS = ("NT 10-K", "NT 10-K/A", "NT 10-Q", "NT 10-Q/A", "NT 20-F", "NT 20-F/A", "NT 11-K")
LETTER_FORMS = ("UPLOAD", "CORRESP")
NOT_OPERATING_SIC = (6722, 6726, 6189, 6199, 6770)
SIC_LABELS = {
    2834: "Pharmaceutical preparations",
    2836: "Biological products",
    2844: "Cosmetics and toiletries",
    3674: "Semiconductors",
    3841: "Medical instruments",
    4813: "Telecommunications",
    5812: "Restaurants",
    6021: "National commercial banks",
    6022: "State commercial banks",
    6199: "Finance services",
    6221: "Commodity contracts brokers",
    6311: "Life insurance",
    6500: "Real estate",
    6552: "Land subdividers and developers",
    6770: "Blank checks",
    6798: "Real estate investment trusts",
    7372: "Prepackaged software",
    7370: "Computer services",
    7389: "Business services",
    8731: "Commercial physical and biological research",
}
SIC_DIVISIONS = (
    (100, 999, "Agriculture, forestry and fishing"),
    (1000, 1499, "Mining"),
    (1500, 1799, "Construction"),
    (2000, 3999, "Manufacturing"),
    (4000, 4999, "Transportation and utilities"),
    (5000, 5199, "Wholesale trade"),
    (5200, 5999, "Retail trade"),
    (6000, 6799, "Finance, insurance and real estate"),
    (7000, 8999, "Services"),
    (9100, 9999, "Public administration"),
)
SIZE_TIERS = ((10e9, "mega"), (700e6, "large"), (75e6, "mid"), (0.0, "small"))
FOLLOW_ON_PAIRS = (("auditor_change", "restatement"), ("late_filing", "restatement"), ("late_filing", "auditor_change"), ("restatement", "auditor_change"))
FOLLOW_ON_DAYS = 540
EXTENSION_WINDOWS = {"NT 10-Q": ("10-Q", 10), "NT 10-K": ("10-K", 25), "NT 20-F": ("20-F", 25)}
DUE_DAYS = {"quarterly": {"large": 40, "mid": 40, "small": 45}, "annual": {"large": 60, "mid": 75, "small": 90}}
HIDDEN_EVIDENCE = ("why", "source", "severity", "stated_reason", "new_language", "contexts", "limb_label", "limb", "limb_basis", "direction_label", "caveat", "current_state", "prior_state", "comparable")
