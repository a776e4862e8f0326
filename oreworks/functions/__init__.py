"""Column functions: every one takes and returns Spark columns and stays in codegen."""

from oreworks.functions.calendar import (
    CALENDAR_COLUMNS,
    age_exact,
    age_in_years,
    days_since,
)
from oreworks.functions.casts import (
    as_date,
    as_double,
    as_key,
    money_sum,
    range_bucket,
    rejected,
)
from oreworks.functions.text import (
    mask_account,
    mask_card,
    mask_card_strict,
    tidy,
    tidy_upper,
)

__all__ = [
    "CALENDAR_COLUMNS",
    "age_exact",
    "age_in_years",
    "as_date",
    "as_double",
    "as_key",
    "days_since",
    "mask_account",
    "mask_card",
    "mask_card_strict",
    "money_sum",
    "range_bucket",
    "rejected",
    "tidy",
    "tidy_upper",
]
