"""Fixed schemas of the raw inputs, the mart tables and the audit log."""

from pyspark.sql import types as T

# Column names of the raw incident export, as the cleaner expects them.
INCIDENT_COLUMNS = ["DR_NO", "DATE OCC", "AREA", "AREA NAME", "Crm Cd", "Crm Cd Desc", "LAT", "LON"]
# Column names of the monthly labour-force export.
LABOUR_COLUMNS = ["Area Name", "Area Type", "Seasonally Adjusted(Y/N)", "Year", "Unemployment Rate"]


def all_strings(names: list[str]) -> T.StructType:
    """Raw files are read as text; types are applied by the cleaning operators."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_INCIDENT = all_strings(INCIDENT_COLUMNS)
RAW_LABOUR = all_strings(LABOUR_COLUMNS)

STAGING = T.StructType([
    T.StructField("crime_id", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("area_code", T.IntegerType()),
    T.StructField("area_name", T.StringType()),
    T.StructField("crime_code", T.IntegerType()),
    T.StructField("crime_desc", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

FACT = T.StructType([
    T.StructField("crime_id", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("location_id", T.IntegerType()),
    T.StructField("crime_code", T.IntegerType()),
    T.StructField("crime_desc", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

DIM_TIME = T.StructType([T.StructField("year", T.IntegerType())])

DIM_LOCATION = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("area_code", T.IntegerType()),
    T.StructField("area_name", T.StringType()),
])

POPULATION = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("population", T.LongType()),
])

UNEMPLOYMENT = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("unemployment_rate", T.DoubleType()),
])

AUDIT_LOG = T.StructType([
    T.StructField("log_id", T.IntegerType()),
    T.StructField("refreshed_at", T.TimestampType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("total_crimes", T.LongType()),
    T.StructField("crime_rate", T.DecimalType(10, 2)),
    T.StructField("unemployment", T.DecimalType(10, 4)),
])

GRID = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("row_idx", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])
