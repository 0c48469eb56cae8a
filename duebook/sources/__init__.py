"""Readers, writers and the mapping from source tables to ledger entities."""
