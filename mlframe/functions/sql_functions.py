"""SQL-defined functions (U3 table function; U4 scalar functions live in
:mod:`mlframe.functions.scalar`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_forecast_tvf(spark: SparkSession, forecast: DataFrame, view: str = "forecast_v",
                          name: str = "forecast_demand") -> str:
    """``forecast_demand(brand_filter, region_filter, horizon_months)``
    over a forecast table; a null filter means all, horizon counted from the
    first forecast month. Inlined by the analyzer, so filters reach the plan
    of the forecast itself."""
    forecast.createOrReplaceTempView(view)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            brand_filter STRING DEFAULT NULL, region_filter STRING DEFAULT NULL, horizon_months INT DEFAULT 9)
        RETURNS TABLE (brand STRING, region STRING, forecast_month DATE, forecast_cases DOUBLE,
                       forecast_p10 DOUBLE, forecast_p90 DOUBLE)
        RETURN SELECT brand, region, forecast_month, forecast_cases, forecast_p10, forecast_p90
               FROM {view}
               WHERE (brand_filter IS NULL OR brand = brand_filter)
                 AND (region_filter IS NULL OR region = region_filter)
                 AND forecast_month < add_months((SELECT min(forecast_month) FROM {view}), horizon_months)""")
    return name
