"""tidemark: filings and price analytics on Spark DataFrames.

The most used entry points, re-exported; see the submodules for the rest.
"""

from tidemark.functions.exprs import (
    first_present,
    guarded_difference,
    required_minus_optional,
    safe_float,
    safe_int,
    sum_if_any,
    sum_minus_required,
)
from tidemark.functions.periods import iso_to_date, latest_closed_period, month_to_date
from tidemark.operators.merge import (
    duplicate_keys,
    last_write_wins,
    merge_outcomes,
    replace_upsert,
    required_keys,
    set_fold,
    set_upsert,
)
from tidemark.operators.rollup import all_grains, daily_average, monthly_average, yearly_average
from tidemark.operators.sectors import promote_rule_facts, sector_rows, sector_rows_union

__all__ = [
    "all_grains", "daily_average", "duplicate_keys", "first_present", "guarded_difference", "iso_to_date",
    "last_write_wins", "latest_closed_period", "merge_outcomes", "month_to_date", "monthly_average",
    "promote_rule_facts", "replace_upsert", "required_keys", "required_minus_optional", "safe_float", "safe_int",
    "sector_rows", "sector_rows_union", "set_fold", "set_upsert", "sum_if_any", "sum_minus_required",
    "yearly_average",
]
