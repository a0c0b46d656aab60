"""Bind the driver's TPC-H-like tables to the mart, and render raw inputs from them.

Binding (fixed by this project, see README):

* fact          = orders LEFT JOIN customer: crime_id = o_orderkey, year = year(o_orderdate),
                  location_id = c_nationkey, crime_code = first character of o_orderpriority,
                  crime_desc = o_orderpriority || '/' || o_orderstatus, lat = o_totalprice,
                  lon = c_acctbal. An order without customer keeps a NULL location (an orphan).
* dim_location  = nation (location_id = area_code = n_nationkey, area_name = n_name)
* population    = per ship year, CAST(SUM(l_quantity) AS BIGINT)
* unemployment  = per ship year over returnflag 'N', linestatus 'O', tax 0:
                  ROUND(AVG(l_discount * 100), 4)

The raw renderings (incident CSV rows, labour-force rows, population sheets) are
derived from the same tables so the cleaners run on data that grows with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.schema import INCIDENT_COLUMNS, LABOUR_COLUMNS

# Fixed values of the binding: the labour-force selection (area, area type, unadjusted).
LABOUR_AREA = "N"
LABOUR_AREA_TYPE = "O"
# Default analysis window of the bound data: order years 1995-2001, 2001 partial.
BOUND_YEARS = list(range(1995, 2002))


def _crime_code(priority: Column) -> Column:
    return F.substring(priority, 1, 1).try_cast("int")


def _crime_desc(priority: Column, status: Column) -> Column:
    return F.concat(priority, F.lit("/"), status)


def _orders_with_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                      "o_orderstatus", "o_totalprice")
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal")
    # Customers are a big table at scale: no broadcast hint, the planner picks
    # broadcast only when its size estimate allows, otherwise a sort-merge join
    # (AQE splits a hot customer key).
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left")


def bind_fact(orders: DataFrame, customer: DataFrame) -> DataFrame:
    j = _orders_with_customer(orders, customer)
    return j.select(
        F.col("o_orderkey").alias("crime_id"),
        F.year("o_orderdate").alias("year"),
        F.col("c_nationkey").alias("location_id"),
        _crime_code(F.col("o_orderpriority")).alias("crime_code"),
        _crime_desc(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("crime_desc"),
        F.col("o_totalprice").alias("lat"),
        F.col("c_acctbal").alias("lon"),
    )


def bind_dim_location(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").alias("location_id"),
        F.col("n_nationkey").alias("area_code"),
        F.col("n_name").alias("area_name"),
    )


def bind_dim_time(orders: DataFrame) -> DataFrame:
    """Distinct event years (the fact keeps every order, so orders alone give them)."""
    return (orders.select(F.year("o_orderdate").alias("year"))
            .where(F.col("year").isNotNull()).distinct())


def bind_population(lineitem: DataFrame) -> DataFrame:
    return (lineitem.groupBy(F.year("l_shipdate").alias("year"))
            .agg(F.sum("l_quantity").cast("bigint").alias("population")))


def bind_unemployment(lineitem: DataFrame) -> DataFrame:
    selected = lineitem.where(_labour_rows())
    return (selected.groupBy(F.year("l_shipdate").alias("year"))
            .agg(F.round(F.avg(F.col("l_discount") * 100), 4).alias("unemployment_rate")))


def _incident_base(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    j = _orders_with_customer(orders, customer)
    n = nation.select(F.col("n_nationkey"), F.col("n_name"))
    # nation is a dimension: the planner broadcasts it by its file-size estimate.
    return j.join(n, j["c_nationkey"] == n["n_nationkey"], "left")


def _labour_rows() -> Column:
    return ((F.col("l_returnflag") == LABOUR_AREA) & (F.col("l_linestatus") == LABOUR_AREA_TYPE)
            & (F.col("l_tax") == 0))


def bind_measures(lineitem: DataFrame) -> DataFrame:
    """Population and unemployment in one pass over lineitem: one row per ship year.

    ``labour_rows`` counts the rows of the labour selection; a year without any
    has no unemployment (``bind_unemployment`` would not list it).
    """
    labour = _labour_rows()
    return (lineitem.groupBy(F.year("l_shipdate").alias("year"))
            .agg(F.sum("l_quantity").cast("bigint").alias("population"),
                 F.round(F.avg(F.when(labour, F.col("l_discount") * 100)), 4).alias("unemployment_rate"),
                 F.count_if(labour).alias("labour_rows")))


def bind_staging(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Natural-key shape of the fact (area_code + area_name instead of location_id)."""
    return _incident_base(orders, customer, nation).select(
        F.col("o_orderkey").alias("crime_id"),
        F.year("o_orderdate").alias("year"),
        F.col("c_nationkey").alias("area_code"),
        F.col("n_name").alias("area_name"),
        _crime_code(F.col("o_orderpriority")).alias("crime_code"),
        _crime_desc(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("crime_desc"),
        F.col("o_totalprice").alias("lat"),
        F.col("c_acctbal").alias("lon"),
    )


def render_raw_incidents(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """All-string incident rows as the raw export would hold them.

    The timestamp text depends on the order status: 'F' zero-padded, 'O' unpadded
    (both valid), anything else ISO-formatted, which the incident layout rejects,
    so those rows lose their year and leave through the year window.
    """
    ts_text = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a"))
                .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"))
                .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    values = [
        F.col("o_orderkey").cast("string"),
        ts_text,
        F.col("c_nationkey").cast("string"),
        F.col("n_name"),
        F.substring("o_orderpriority", 1, 1),
        _crime_desc(F.col("o_orderpriority"), F.col("o_orderstatus")),
        F.col("o_totalprice").cast("string"),
        F.col("c_acctbal").cast("string"),
    ]
    return _incident_base(orders, customer, nation).select(
        *[v.alias(name) for v, name in zip(values, INCIDENT_COLUMNS)])


def render_raw_labour(lineitem: DataFrame) -> DataFrame:
    """All-string monthly labour rows; a zero discount is written as the missing token 'n/a'."""
    rate = F.when(F.col("l_discount") == 0, F.lit("n/a")).otherwise((F.col("l_discount") * 100).cast("string"))
    values = [
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.when(F.col("l_tax") == 0, F.lit("N")).otherwise(F.lit("Y")),
        F.year("l_shipdate").cast("string"),
        rate,
    ]
    return lineitem.select(*[v.alias(name) for v, name in zip(values, LABOUR_COLUMNS)])


def render_population_grid(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                           region: DataFrame, years: Sequence[int] = BOUND_YEARS) -> DataFrame:
    """One population sheet per region as a grid ``(file, row_idx, cells)``.

    Layout per sheet: a title row, ``r_regionkey`` blank rows (so the header moves
    from file to file), an upper header row holding "Geographic Area", a lower header
    row holding the years, one row per nation (place, an always-empty spacer column,
    a base value, one count of orders per year; a year without orders is an empty
    cell) and a blank end-of-table row.
    """
    years = [int(y) for y in years]
    width = 3 + len(years)
    # One aggregation with a conditional sum per year (NULL where a nation has
    # no order that year), partially aggregated before the shuffle.
    wide = (_orders_with_customer(orders, customer)
            .withColumn("year", F.year("o_orderdate"))
            .groupBy(F.col("c_nationkey").alias("nk"))
            .agg(*[F.sum(F.when(F.col("year") == y, F.lit(1))).alias(str(y)) for y in years]))
    base = customer.groupBy(F.col("c_nationkey").alias("nk")).agg(F.count(F.lit(1)).alias("base"))
    sheet = (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
             .select("n_nationkey", "n_name", "r_regionkey", "r_name"))
    sheet = (sheet.join(wide, sheet["n_nationkey"] == wide["nk"], "left").drop("nk")
             .join(base, sheet["n_nationkey"] == base["nk"], "left").drop("nk"))
    file_name = F.concat(F.lit("population_"), F.lower(F.col("r_name")), F.lit(".csv"))
    first_data = F.col("r_regionkey") + 3

    def cell(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    per_file = Window.partitionBy("file")
    data = (sheet.withColumn("file", file_name)
            .withColumn("pos", F.row_number().over(per_file.orderBy("n_name")) - 1)
            .withColumn("n_rows", F.count(F.lit(1)).over(per_file)))
    blank_row = F.array_repeat(F.lit(""), width)
    row = F.struct((first_data + F.col("pos")).cast("int").alias("row_idx"),
                   F.array(F.col("n_name"), F.lit(""), cell(F.col("base")),
                           *[cell(F.col(str(y))) for y in years]).alias("cells"))
    end = F.struct((first_data + F.col("n_rows")).cast("int").alias("row_idx"), blank_row.alias("cells"))
    # The last nation of a sheet also emits the blank end-of-table row (one pass).
    emitted = F.when(F.col("pos") == F.col("n_rows") - 1, F.array(row, end)).otherwise(F.array(row))
    data_rows = data.select("file", F.explode(emitted).alias("r")).select("file", "r.row_idx", "r.cells")

    regions = region.select(file_name.alias("file"), "r_regionkey", "r_name")
    blanks = [F.lit("")] * width
    k = F.col("r_regionkey")
    fixed = F.array(
        F.struct(F.lit(0).alias("row_idx"),
                 F.array(F.concat(F.lit("Annual Estimates of the Resident Population: "), F.col("r_name")),
                         *blanks[1:]).alias("cells")),
        F.struct((k + 1).cast("int").alias("row_idx"),
                 F.array(F.lit("Geographic Area"), F.lit(""), F.lit("Estimates Base"),
                         F.lit("Population Estimate (as of July 1)"), *blanks[4:]).alias("cells")),
        F.struct((k + 2).cast("int").alias("row_idx"),
                 F.array(*blanks[:3], *[F.lit(str(y)) for y in years]).alias("cells")))
    gap_idx = F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))
    gaps = F.transform(gap_idx, lambda i: F.struct(i.cast("int").alias("row_idx"),
                                                   F.array_repeat(F.lit(""), width).alias("cells")))
    header_rows = (regions.select("file", F.explode(F.concat(fixed, gaps)).alias("r"))
                   .select("file", "r.row_idx", "r.cells"))
    return header_rows.unionByName(data_rows)
