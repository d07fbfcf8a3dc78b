"""Whole runs: collect, validate, repair, store, report."""
