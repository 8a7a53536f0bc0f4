"""Queries over whole tables, the ledger of stages, exports."""
