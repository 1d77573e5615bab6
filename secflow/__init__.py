"""secflow: security-posture analytics on Spark DataFrames and Structured Streaming.

Subpackages: ``sources`` (tables, adapters, connectors, wire decode), ``functions``
(column expressions), ``operators`` (joins, anomaly model, findings, rollups, CDC,
patterns, contracts, governance), ``plans`` (registered queries and their SQL
oracles), ``streaming`` (stream forms) and ``sinks`` (idempotent writers).
"""
