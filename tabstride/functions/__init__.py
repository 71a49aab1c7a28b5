from tabstride.functions.scalars import (
    column_value,
    fill_missing,
    hash_bucket,
    hash_order,
    logit,
    named,
    relu,
    sigmoid,
    standard_score,
    to_double,
)
from tabstride.functions.text import TEXT_DESCRIPTORS, text_descriptors

__all__ = [
    "TEXT_DESCRIPTORS",
    "column_value",
    "fill_missing",
    "hash_bucket",
    "hash_order",
    "logit",
    "named",
    "relu",
    "sigmoid",
    "standard_score",
    "text_descriptors",
    "to_double",
]
