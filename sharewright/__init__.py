"""sharewright: audited share-of-total metrics from untrusted multi-source tables, on Spark.

Sub-packages
------------
functions   column expressions (text, dates, numeric proofs); no jobs, no joins
operators   table operators: rule flow, keyed statistics, references, history, anomalies, shares
sources     all-text ingest with lineage, and the sinks
plans       the conforming plan of each dataset, publication gates, views and audit queries
driver      the registered queries over the benchmark tables, with their SQL twins
"""
