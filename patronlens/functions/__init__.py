from patronlens.functions.draws import uniform_draw
from patronlens.functions.money import beyond_cents, cents, from_cents, mean_money, sum_money
from patronlens.functions.numbers import (
    has_nan,
    mean_of_shares,
    mean_share,
    ratio_or_zero,
    segment_code,
    share_parts,
    zero_if_missing,
)
from patronlens.functions.text import dollar_text, percent_text, sql_double, whole_text
from patronlens.functions.time import age_in_days, day_of, not_after

__all__ = [
    "age_in_days",
    "beyond_cents",
    "cents",
    "day_of",
    "dollar_text",
    "from_cents",
    "has_nan",
    "mean_money",
    "mean_of_shares",
    "mean_share",
    "not_after",
    "percent_text",
    "ratio_or_zero",
    "segment_code",
    "share_parts",
    "sql_double",
    "sum_money",
    "uniform_draw",
    "whole_text",
    "zero_if_missing",
]
