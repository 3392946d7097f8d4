"""A-series: sources and sinks, checked by writing whole tables and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.operators import reshape, stats
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables
from gridpulse.scratch import new_path
from gridpulse.sources import files

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("a01_csv_scan", """
    SELECT event_id, ts, user_id, nullif(event_type, '') AS event_type FROM dirty""")
def a01(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a01")
    rows = t.dirty.select("event_id", "ts", "user_id", "event_type")
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema)


@query("a01_csv_scan_inferred", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def a01_inferred(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a01i")
    files.write_csv(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path)
    df = files.read_csv_inferred(t.spark, path)
    return df.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("a02_parquet_scan", "SELECT event_id, value FROM events WHERE value > 100")
def a02(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, t.path("events")).filter("value > 100").select("event_id", "value")


@query("a07_optional_files", """
    SELECT 'orders' AS name, count(*) AS n_rows FROM orders UNION ALL SELECT 'absent', -1
    UNION ALL SELECT 'events', count(*) FROM events""")
def a07(t: Tables) -> DataFrame:
    found = files.read_optional(t.spark, {
        "orders": t.path("orders"), "events": t.path("events"), "absent": f"{t.sf_dir}/not_there.parquet"})
    parts = [
        (t.orders.limit(0) if df is None else df).agg(
            F.lit(name).alias("name"),
            (F.lit(-1).cast("bigint") if df is None else F.count("*")).alias("n_rows"))
        for name, df in found.items()]
    return reshape.merge_batches(parts)


METRICS_SQL = """
    SELECT l_returnflag AS dataset, 'fixed line' AS model, round(avg(abs(l_extendedprice - 1500 - l_quantity * 1450)), 4) AS mae,
        round(sqrt(avg((l_extendedprice - 1500 - l_quantity * 1450) ** 2)), 4) AS rmse,
        round(1 - avg((l_extendedprice - 1500 - l_quantity * 1450) ** 2) / var_pop(l_extendedprice), 4) AS r2,
        count(*) AS trained_rows, 'l_quantity, one' AS features FROM lineitem GROUP BY 1"""


def metrics(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_returnflag").alias("dataset"), F.col("l_extendedprice").alias("actual"),
                             (1500 + F.col("l_quantity") * 1450).alias("predicted"))
    m = stats.regression_metrics(rows, "actual", "predicted", ["dataset"])
    return m.select("dataset", F.lit("fixed line").alias("model"), "mae", "rmse", "r2", F.col("n").alias("trained_rows"),
                    F.array(F.lit("l_quantity"), F.lit("one")).alias("features"))


@query("a08_json_document", METRICS_SQL)
def a08(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a08")
    m = metrics(t)
    files.write_metrics(m, path)
    return files.read_json_document(t.spark, path, files.metrics_rows(m).schema)


@query("a09_parquet_overwrite", ORDERS_SQL)
def a09(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a09")
    files.write_parquet(t.orders.limit(10), path)
    files.write_parquet(t.orders, path)
    return t.spark.read.parquet(path)


@query("a09_parquet_partitioned", "SELECT order_no, area, vehicle_count, year FROM traffic WHERE year = 1998")
def a09_partitioned(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a09p")
    files.write_parquet(t.traffic.select("order_no", "area", "vehicle_count", "year"), path, ["year"])
    return t.spark.read.parquet(path).filter("year = 1998")


@query("a10_repeated_column_names", "SELECT o_orderkey, o_totalprice FROM orders")
def a10(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a10")
    a = t.orders.select("o_orderkey", "o_totalprice")
    b = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("O_TOTALPRICE"))
    files.write_parquet(a.join(b, a["o_orderkey"] == b["k"]).drop("k"), path)
    return t.spark.read.parquet(path)


@query("a11_single_csv_mart", """
    SELECT area, avg(energy_consumption) AS avg_energy_consumption FROM energy GROUP BY area""",
    rounded="avg_energy_consumption")
def a11(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a11") + ".csv"
    files.write_single_csv(stats.group_mean(t.energy, ["area"], ["energy_consumption"]), path)
    return files.read_csv(t.spark, path, "area string, avg_energy_consumption double")


@query("a12_prediction_sink", """
    SELECT reading_id, timestamp, energy_consumption * 2 AS predicted FROM energy""", rounded="predicted")
def a12(t: Tables) -> DataFrame:
    folder = new_path(t.spark, "a12")
    zoned = F.col("timestamp").cast("timestamp").alias("timestamp")
    rows = t.energy.select("reading_id", zoned, (F.col("energy_consumption") * 2).alias("predicted"))
    files.write_predictions(rows, folder, "energy")
    stored = t.spark.read.parquet(f"{folder}/energy_parquet")
    text = files.read_csv(t.spark, f"{folder}/energy_csv", stored.schema)
    return stored.join(text.select("reading_id"), "reading_id")


@query("a13_metrics_document", METRICS_SQL)
def a13(t: Tables) -> DataFrame:
    return files.metrics_rows(metrics(t))


@query("a15_export_filtered_view", """
    SELECT reading_id, zone, energy_consumption FROM energy WHERE zone = 'East' AND season = 'Summer'""")
def a15(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a15")
    rows = t.energy.select("reading_id", "zone", "season", "energy_consumption")
    view = reshape.apply_filters(rows, zones=["East"], seasons=["Summer"]).drop("season")
    files.write_csv(view, path)
    return files.read_csv(t.spark, path, view.schema)


@query("a17_inventory", " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS n_rows, {c} AS n_columns FROM {n}"
    for n, c in (("orders", 6), ("events", 6), ("lineitem", 11))))
def a17(t: Tables) -> DataFrame:
    return files.inventory({n: t.table(n) for n in ("orders", "events", "lineitem")}).drop("n_bytes")


@query("a17_inventory_bytes")
def a17_bytes(t: Tables) -> DataFrame:
    return files.inventory({n: t.table(n) for n in ("orders", "events", "lineitem")})


@query("a18_freshness")
def a18(t: Tables) -> DataFrame:
    return files.freshness({n: t.table(n) for n in ("orders", "events", "lineitem")})


@query("a18_freshness_of_written", """
    SELECT * FROM (VALUES ('events', 2, false, 3), ('lineitem', 3, true, 2), ('orders', 1, false, 1)) v(dataset, place, newest, n_files)""")
def a18_written(t: Tables) -> DataFrame:
    """Whole tables written one after the other, by one, two and three files: their times must come in that order, and the newest be the last."""
    copies = {}
    for name, parts in (("orders", 1), ("events", 3), ("lineitem", 2)):
        path = new_path(t.spark, f"a18_{name}")
        files.write_parquet(files.in_parts(t.table(name), parts), path)
        copies[name] = t.spark.read.parquet(path)
    times = files.file_times(copies)
    newest = files.freshness(copies).scalar()
    place = F.row_number().over(Window.orderBy("latest"))  # three rows
    return times.select("dataset", place.alias("place"), (F.col("latest") == newest).alias("newest"), F.col("n_files").cast("int").alias("n_files"))
