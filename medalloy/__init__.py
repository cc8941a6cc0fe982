"""medalloy — Spark-native operators for layered (raw → bronze → silver → gold) analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` expressions so Catalyst can push filters, prune columns and
keep whole-stage codegen. Actions (counts, writes) live only in
:mod:`medalloy.store` and in the plan runners.
"""

__version__ = "0.1.0"
