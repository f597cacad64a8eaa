"""Staging tables, marts, KPI tables, declared checks and the job that runs them."""
