"""A small hand-made portfolio with every oddity the rules have to deal with."""

from __future__ import annotations

from datetime import date

from loanlens.sources.tables import SCHEMAS

D = date
CUSTOMERS = [
    ("c1", "S1", "T1", 30, "Salaried", 40000.0, "Emerging", D(2025, 1, 1)),
    ("c2", "S2", "T2", 40, "Gig worker", 95000.0, "Affluent", D(2025, 2, 1)),
    ("c3", None, "T3", 50, "Salaried", 20000.0, "Mass", D(2025, 3, 1)),
]
BUREAU = [("c1", 700, 1, 0.5, 0, 0), ("c2", 560, 2, 0.25, 5, 2)]
APPLICATIONS = [
    ("a1", "c1", D(2026, 5, 2), "Personal Loan", 1000.0, 6, "App", "Approved", None, 900.0, 14.5, 210.0),
    ("a2", "c1", D(2026, 5, 3), "Personal Loan", 1000.0, 9, "App", "Approved", None, 800.0, 14.5, 220.5),
    ("a3", "c2", D(2026, 5, 9), "Merchant Loan", 1000.0, 12, "Partner", "Approved", None, 700.25, 20.0, 299.9),
    ("a4", "c1", D(2026, 6, 1), "Personal Loan", 1000.0, 6, "App", "Rejected", "Policy score cutoff", 0.0, 0.0, 400.0),
    ("a5", "c1", D(2026, 6, 7), "Personal Loan", 1000.0, 6, "App", "Approved", None, 600.0, 14.5, 380.0),
    ("a6", None, D(2026, 6, 8), "Personal Loan", 1000.0, 6, "Branch", "Rejected", "x", 0.0, 0.0, None),
    ("a7", "zz", D(2026, 6, 8), "Personal Loan", 1000.0, 6, "Branch", "Rejected", "x", 0.0, 0.0, 100.0),
]
DISBURSEMENTS = [
    ("l1", "a1", "c1", D(2026, 5, 4), 900.0, 6, 14.5, 210.0),
    ("l2", "a2", "c1", D(2026, 5, 30), 0.0, 9, 14.5, 220.0),
    ("l3", "a3", "c2", D(2026, 5, 31), 500000.0, 12, 20.0, 300.0),
    ("l4", "a5", "c3", D(2026, 6, 9), 500000.01, 2, 14.5, None),
    ("l5", "a5", "c1", D(2026, 6, 9), None, 6, 14.5, 380.0),
]
DPD = [0, 1, 30, 31, 60, 61, 90, 91, -1, None]
REPAYMENTS = [
    ("l1", D(2026, 6, 1), D(2026, 6, 1), i + 1, 100.0 + i, None if i == 5 else 90.0, dpd) for i, dpd in enumerate(DPD)
] + [
    ("l2", D(2026, 7, 1), D(2026, 7, 1), 1, 50.0, 50.0, 0),
    ("l2", D(2026, 7, 1), D(2026, 7, 1), 1, 50.0, 50.0, 0),
    ("l2", D(2026, 7, 1), D(2026, 7, 1), 1, 50.0, 50.0, 0),
    ("lost", D(2026, 7, 1), D(2026, 7, 1), 2, 10.0, 10.0, 40),
    (None, D(2026, 7, 1), D(2026, 7, 1), 2, 10.0, 10.0, 0),
]
CALLS = [("k1", "l1", D(2026, 7, 2), "Connected", "ok"), (None, "l1", D(2026, 7, 2), "No answer", ""), (None, "l2", D(2026, 7, 3), "x", "")]

DATA = {
    "customers": CUSTOMERS,
    "bureau_features": BUREAU,
    "loan_applications": APPLICATIONS,
    "disbursements": DISBURSEMENTS,
    "repayments": REPAYMENTS,
    "collection_calls": CALLS,
}


def portfolio(spark) -> dict:
    return {name: spark.createDataFrame(DATA[name], SCHEMAS[name]) for name in SCHEMAS}
