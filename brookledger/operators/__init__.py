"""Reusable multi-row operators: dedup, dense keys, existence flags, ledgers."""
