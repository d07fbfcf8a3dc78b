"""Operators on bars tables: DataFrame in, DataFrame out, no actions inside."""
