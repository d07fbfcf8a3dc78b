"""Fixtures over the test tables, the registered queries and their oracles."""
