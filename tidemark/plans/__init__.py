"""Whole jobs: the incremental sync, its state, and the named queries."""
