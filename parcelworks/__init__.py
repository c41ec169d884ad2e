"""parcelworks: a Spark-native order-fulfilment analytics warehouse.

Raw order tables -> typed staging -> order facts and seller marts ->
quality gate -> delivery-reliability analyses -> report datasets, all as
lazy Spark DataFrames built from ``pyspark.sql.functions`` built-ins.
"""

__version__ = "0.1.0"
