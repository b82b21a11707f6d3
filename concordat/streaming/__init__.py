"""Incremental state, ledgers and structured streaming."""
