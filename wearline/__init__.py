"""Condition-panel analytics on Spark: DataFrame-in, DataFrame-out building blocks."""
