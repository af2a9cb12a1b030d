"""Incremental (streaming) variants of the load, rewrite and statement-result operators."""

from .changes import load_stream, rewrite_stream, statement_results_stream

__all__ = ["load_stream", "rewrite_stream", "statement_results_stream"]
