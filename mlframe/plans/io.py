"""Source and sink queries (2.A): every one writes derived data to a fresh
folder under the shared checkpoint root and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe import bindings as B
from mlframe.functions.hashing import hash_uniform_sql
from mlframe.operators.features import entity_counters
from mlframe.operators.sampling import hash_split
from mlframe.plans import query
from mlframe.plans.feature_store import COUNTERS_SQL, PAY
from mlframe.session import scratch_dir
from mlframe.sources import tables as TB


@query("csv_scan", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey IS NOT NULL")
def csv_scan(spark, d):
    """Headered CSV written from the customer table, read back with a
    fixed schema (no inference pass) and a non-null key filter."""
    root = scratch_dir(spark, "csv")
    TB.read(spark, d, "customer").write.mode("overwrite").option("header", "true").csv(f"{root}/customer")
    schema = T.StructType.fromDDL("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    return TB.read_csv(spark, f"{root}/customer/*.csv", schema=schema, key="c_custkey")


@query("parquet_exchange", sql=f"""
SELECT o_orderkey, o_totalprice,
       CASE WHEN {hash_uniform_sql('o_orderkey', 'split')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def parquet_exchange(spark, d):
    """S3: train/test parquet folders with a bounded file count, read back."""
    root = scratch_dir(spark, "exchange")
    o = hash_split(TB.read(spark, d, "orders", ["o_orderkey", "o_totalprice"]), "o_orderkey", 0.8)
    for part in ("train", "test"):
        TB.write_split(o.where(F.col("split") == part).drop("split"), f"{root}/{part}", files=4)
    tr = spark.read.parquet(f"{root}/train").withColumn("split", F.lit("train"))
    te = spark.read.parquet(f"{root}/test").withColumn("split", F.lit("test"))
    return tr.unionByName(te)


@query("source_file", sql="SELECT l_orderkey, l_linenumber, 'lineitem.parquet' AS source_name FROM lineitem")
def source_file(spark, d):
    """The source of every row; the table's name in the path is the part
    that does not depend on the machine (a table may be a folder of files)."""
    li = TB.with_source_file(TB.read(spark, d, "lineitem")).select("l_orderkey", "l_linenumber", "source_file")
    return li.select("l_orderkey", "l_linenumber", F.regexp_extract("source_file", r"([^/]+\.parquet)(?:/[^/]*)?$", 1).alias("source_name"))


@query("overwrite_table", sql="""
SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS r_name FROM nation
UNION ALL
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def overwrite_table(spark, d):
    """Full replace, then append with a schema merge (a new column),
    read back with the merged schema."""
    root = scratch_dir(spark, "table")
    n = TB.read(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = TB.read(spark, d, "region")
    TB.write_table(n.select("n_nationkey", "n_name"), f"{root}/t", mode="overwrite")
    TB.write_table(n.select("n_nationkey", "n_name"), f"{root}/t", mode="overwrite")  # replace is idempotent
    joined = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    TB.write_table(joined, f"{root}/t", mode="append", merge_schema=True)
    return TB.read_table(spark, f"{root}/t", merge_schema=True).select("n_nationkey", "n_name", "r_name")


@query("partitioned_write", sql="SELECT event_id, user_id, value, CAST(ts AS DATE) AS event_date FROM events")
def partitioned_write(spark, d):
    """Derive a date, write one folder per date (dynamic overwrite),
    read back with partition discovery (the date filter prunes folders)."""
    root = scratch_dir(spark, "partitioned")
    e = TB.read(spark, d, "events", ["event_id", "user_id", "value", "ts"])
    TB.write_partitioned(e, f"{root}/events", "ts")
    back = spark.read.parquet(f"{root}/events").withColumn("event_date", F.col("event_date").cast("date"))
    return back.select("event_id", "user_id", "value", "event_date")


UPSERT_SQL = PAY + f""",
old AS ({COUNTERS_SQL.replace('FROM payments', "FROM payments WHERE event_ts < TIMESTAMP '2024-01-20 00:00:00'")}),
upd AS ({COUNTERS_SQL.replace('FROM payments', "FROM payments WHERE event_ts >= TIMESTAMP '2024-01-20 00:00:00'").replace('SELECT instrument_id', 'SELECT instrument_id', 1)})
SELECT * FROM old WHERE instrument_id NOT IN (SELECT instrument_id FROM upd)
UNION ALL SELECT * FROM upd
"""


@query("upsert_by_key", sql=UPSERT_SQL)
def upsert_by_key(spark, d):
    """Counters from the first 19 days upserted with counters computed
    on the rest (matched keys replaced, new keys inserted, others kept);
    applied twice to show idempotence."""
    p = B.payments(spark, d)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    old = entity_counters(p.where(F.col("event_ts") < cut))
    upd = entity_counters(p.where(F.col("event_ts") >= cut))
    root = scratch_dir(spark, "upsert")
    once = TB.upsert(old, upd, "instrument_id")
    once.write.mode("overwrite").parquet(f"{root}/v1")
    twice = TB.upsert(spark.read.parquet(f"{root}/v1"), upd, "instrument_id")
    twice.write.mode("overwrite").parquet(f"{root}/v2")
    return spark.read.parquet(f"{root}/v2")


@query("upsert_parts", sql=UPSERT_SQL)
def upsert_parts(spark, d):
    """S11 in place: the same counters in a table laid out by key hash, whose touched parts alone are rewritten."""
    p = B.payments(spark, d)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    path = f"{scratch_dir(spark, 'keyed')}/counters"
    TB.write_keyed(entity_counters(p.where(F.col("event_ts") < cut)), path, "instrument_id", parts=16)
    TB.upsert_keyed(spark, path, entity_counters(p.where(F.col("event_ts") >= cut)), "instrument_id")
    return TB.read_keyed(spark, path)


@query("ctas", sql=B.cte(sales=B.SALES_SQL) + """
SELECT account_id, count(*) AS n_lines, sum(cases) AS total_cases FROM sales GROUP BY account_id
""")
def ctas(spark, d):
    """Create-or-replace a table from a SELECT."""
    root = scratch_dir(spark, "ctas")
    B.sales(spark, d).createOrReplaceTempView("sales_v")
    return TB.create_as(spark, "ctas_account_cases",
                        "SELECT account_id, count(*) AS n_lines, sum(cases) AS total_cases FROM sales_v GROUP BY account_id",
                        path=f"{root}/ctas_account_cases")


LISTED = ("orders", "lineitem", "events", "documents")


@query("list_files", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, TRUE AS sized, TRUE AS dated FROM {t}" for t in LISTED))
def list_files(spark, d):
    """Landed files with size, ISO modification time and the rows read
    from each, summed per table (paths and times differ per machine)."""
    parts = [TB.file_rows(TB.read(spark, d, t)).withColumn("table_name", F.lit(t)) for t in LISTED]
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return files.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"), F.every(F.col("length") > 0).alias("sized"),
                                           F.every(F.col("modified_iso").rlike(r"^\d{4}-\d\d-\d\dT")).alias("dated"))
