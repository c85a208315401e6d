"""Tidemark: event-history analytics on Spark DataFrames.

Cleaning and quality gates, interval and sequence operators, graph linking,
scoped merge, point-in-time features, scoring and drift, all as DataFrame in,
DataFrame out functions without a global session.
"""
