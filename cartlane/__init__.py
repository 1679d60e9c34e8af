"""Retail order data on Spark: batch jobs, integrity audits and a change feed."""
