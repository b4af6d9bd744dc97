"""cabline: Spark-native trip analytics.

Ingest periodic trip files into raw tables with schema conformance, lineage and an
audit ledger; build a denormalised wide trip table; profile and sample it; fit and
diagnose linear regression models from distributed sufficient statistics.
Everything is expressed as DataFrame / Spark SQL operators.
"""

__version__ = "0.1.0"
