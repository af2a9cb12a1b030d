"""Multi-step plans: materialization, multi-table loads, constraint reports, run log."""
