"""civicmart — a PySpark library and batch job for a yearly incident mart.

Raw incident, population and labour-force inputs are cleaned into a star
schema (one fact, time and location dimensions, yearly measures); the
yearly, per-area and per-type indicators are computed on it behind null,
duplicate and orphan gates, and a versioned audit table is refreshed.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` and Spark SQL, so Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
