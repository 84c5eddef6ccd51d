from turnstile.functions.dates import split_iso, weekday_columns
from turnstile.functions.labels import app_name, provider_label, status_label, title_case
from turnstile.functions.text import (
    fold_ascii,
    join_name,
    normalize_email,
    normalize_name,
    sanitize_key,
)
from turnstile.functions.values import (
    blank_to_null,
    bucket_amount,
    bucket_price,
    first_filled,
    midpoint_price,
    nonzero,
    safe_bool,
    safe_float,
    safe_int,
    to_money,
    to_money_text,
)

__all__ = [
    "app_name", "blank_to_null", "bucket_amount", "bucket_price", "first_filled", "fold_ascii",
    "join_name", "midpoint_price", "nonzero", "normalize_email", "normalize_name",
    "provider_label", "safe_bool", "safe_float", "safe_int", "sanitize_key", "split_iso",
    "status_label", "title_case", "to_money", "to_money_text", "weekday_columns",
]
