"""Operators for preparing training text at scale.

One module per operator; ``registered`` holds the thin queries over the driver tables and
their SQL.  Nothing else in the library imports this subpackage.
"""
