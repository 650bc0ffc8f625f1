"""Relational operators: DataFrames in, DataFrames out."""

from debtlens.operators.fixed import fixed, shared_folder
from debtlens.operators.joins import (
    assemble,
    chain_left,
    exists_any,
    in_scope,
    left_join_many,
    left_join_where,
    lookup,
)
from debtlens.operators.measuring import Measure, measure
from debtlens.operators.pick import count_over, distinct_keys, one_per_key, pick_one, total_over
from debtlens.operators.rows import multiplicity, repeat_rows
from debtlens.operators.scope import Scope, driver_list, fits
from debtlens.operators.shape import snapshot, with_labels
from debtlens.operators.skew import frequent_keys, salted_left_join, salts_of, split_left_join
from debtlens.operators.versions import picked_version_sums, prefer_version, split_by_version

__all__ = [
    "Measure",
    "Scope",
    "assemble",
    "chain_left",
    "count_over",
    "distinct_keys",
    "driver_list",
    "exists_any",
    "fits",
    "fixed",
    "frequent_keys",
    "in_scope",
    "left_join_many",
    "left_join_where",
    "lookup",
    "measure",
    "multiplicity",
    "one_per_key",
    "pick_one",
    "picked_version_sums",
    "prefer_version",
    "repeat_rows",
    "salted_left_join",
    "salts_of",
    "shared_folder",
    "snapshot",
    "split_by_version",
    "split_left_join",
    "total_over",
    "with_labels",
]
