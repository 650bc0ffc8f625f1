"""The reports, each a function from a ledger to one lazy DataFrame."""

from debtlens.plans.audit import AUDIT_LABELS, DEFAULT_TRIGGERS, audit_labels, audit_missing
from debtlens.plans.contract_list import CONTRACT_LABELS, contract_list
from debtlens.plans.debt import DEBT_LABELS, debt_report
from debtlens.plans.delinquency import DELINQUENCY_LABELS, delinquency_draft, delinquency_report

__all__ = [
    "AUDIT_LABELS",
    "CONTRACT_LABELS",
    "DEBT_LABELS",
    "DEFAULT_TRIGGERS",
    "DELINQUENCY_LABELS",
    "audit_labels",
    "audit_missing",
    "contract_list",
    "debt_report",
    "delinquency_draft",
    "delinquency_report",
]
