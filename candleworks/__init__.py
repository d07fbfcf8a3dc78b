"""Candleworks: price-bar validation, repair, analytics and forecasting on Spark.

Every operator takes and returns DataFrames that hold all symbols at once.
"""
