"""Batch analytics for field activity on Spark DataFrames.

Raw tables go through cleaning, deduplication and reference flags into typed
staging tables; two marts and a set of KPI tables are built from those; checks
and profiles describe their quality.
"""
