"""Scalar column functions and SQL function registration."""

from .scalars import at_least, clamp_to_bigint, not_null_column, truncate_identifier, type_label

__all__ = ["at_least", "clamp_to_bigint", "not_null_column", "truncate_identifier", "type_label"]
