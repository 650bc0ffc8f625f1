"""Reading the ledger relations and writing reports."""

from debtlens.sources.layout import Stored, write_ledger
from debtlens.sources.ledger import Ledger
from debtlens.sources.relations import RELATIONS, Relation
from debtlens.sources.sink import write_report
from debtlens.sources.tables import load, load_relation, normalize

__all__ = [
    "RELATIONS",
    "Ledger",
    "Relation",
    "Stored",
    "load",
    "load_relation",
    "normalize",
    "write_ledger",
    "write_report",
]
