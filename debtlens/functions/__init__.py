"""Column builders: everything here takes and returns Columns and stays inside codegen."""

from debtlens.functions.aggregates import (
    count_where,
    latest_by,
    neg_total,
    preferred_version,
    sum_where,
)
from debtlens.functions.scalars import (
    MONEY,
    TOTAL,
    add0,
    all_of,
    any_of,
    before,
    constant,
    decode,
    differs,
    like_any,
    missing_flag,
    money,
    nvl,
    total,
    unlike,
)

__all__ = [
    "MONEY",
    "TOTAL",
    "add0",
    "all_of",
    "any_of",
    "before",
    "constant",
    "count_where",
    "decode",
    "differs",
    "latest_by",
    "like_any",
    "missing_flag",
    "money",
    "neg_total",
    "nvl",
    "preferred_version",
    "sum_where",
    "total",
    "unlike",
]
