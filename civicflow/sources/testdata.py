"""Driver testdata -> service-request records.

The generated tables are order/customer/geography tables, not requests, so a
fixed role mapping turns them into requests: regions stand for boroughs,
nations for agencies, market segments for complaint types, order status for
request status. Closing times, missing values and renamed agencies are made by
key arithmetic so that every edge case of the request model occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, columns named as the raw contract (15 of 44 present).

    Plan: orders ⋈ customer on the customer key (shuffle join at scale, Spark
    broadcasts customer itself when its measured size is small); nation (25
    rows) and region (5 rows) are fixed-size and are broadcast explicitly.
    """
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey)
    cust = cust.select("c_custkey", "c_mktsegment", "n_name", "r_name")

    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    # the order date is zone-less; the cast is a no-op unless a session reads it as zone-aware
    created = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(k % 4 * 6).cast("int"))
    o = orders.select("*", created.alias("created_date"))
    j = o.join(cust, o.o_custkey == cust.c_custkey)

    created_c = F.col("created_date")
    closed = (
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("timestamp_ntz"))
        .when(_every(k, 11), created_c)
        .otherwise(created_c + F.make_dt_interval(secs=((k * 7919) % 432000).cast("int")))
    )
    lat = F.when(_every(k, 20), F.lit(None).cast("double")).otherwise(F.lit(40.5) + (ck % 400) / F.lit(1000.0))
    lon = F.when(_every(k, 20), F.lit(None).cast("double")).otherwise(F.lit(-74.2) + (ck % 450) / F.lit(1000.0))
    channel = F.when(k % 3 == 0, "PHONE").when(k % 3 == 1, "ONLINE").otherwise("MOBILE")
    return j.select(
        k.alias("unique_key"),
        created_c.alias("created_date"),
        closed.alias("closed_date"),
        F.col("n_name").alias("agency"),
        F.when(_every(k, 97), F.lit("Agency (old name)"))
         .otherwise(F.concat(F.lit("Agency "), F.col("n_name"))).alias("agency_name"),
        F.col("c_mktsegment").alias("complaint_type"),
        F.when(_every(k, 70), F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("descriptor"),
        F.concat(F.lit("1"), F.lpad((ck % 300).cast("string"), 4, "0")).alias("incident_zip"),
        F.col("n_name").alias("city"),
        F.when(_every(k, 50), F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("borough"),
        F.col("o_orderstatus").alias("status"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        channel.alias("open_data_channel_type"),
        (created_c + F.make_dt_interval(days=F.lit(3))).alias("due_date"),
    )


# Raw-contract columns the request view fills (the rest are NULL after ``conform``).
PRESENT_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type", "descriptor",
    "incident_zip", "city", "borough", "status", "latitude", "longitude", "open_data_channel_type", "due_date",
]


def replayed(raw: DataFrame) -> DataFrame:
    """The same requests sent again later: open ones now closed five days after creation
    (status 'C'), closed ones under a new agency name. Same keys, different payloads."""
    is_open = F.col("closed_date").isNull()
    changed = {
        "closed_date": F.coalesce(F.col("closed_date"), F.col("created_date") + F.make_dt_interval(days=F.lit(5))),
        "status": F.when(is_open, F.lit("C")).otherwise(F.col("status")),
        "agency_name": F.when(is_open, F.col("agency_name")).otherwise(F.lit("Agency (replayed)")),
    }
    return raw.select(*[changed.get(c, F.col(c)).alias(c) for c in raw.columns])
