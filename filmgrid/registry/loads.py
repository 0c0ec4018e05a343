"""Writes, merges and incremental loads. Written data goes to a fresh folder in the shared work folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.operators import merge
from filmgrid.registry import Query
from filmgrid.registry.views import table
from filmgrid.session import fresh_path
from filmgrid.sources import readers, writers
from filmgrid.sources.warehouse import Warehouse
from filmgrid.streaming.ingest import ingest_files, read_rejects

RUN_TIME = datetime(2024, 4, 1, 12)

ORDERS = schemas.record(
    o_orderkey=schemas.LONG,
    o_custkey=schemas.LONG,
    o_orderstatus=schemas.STRING,
    o_totalprice=schemas.DOUBLE,
    o_orderpriority=schemas.STRING,
    insertion_datetime=schemas.TIME,
)
EVENTS = schemas.record(
    user_id=schemas.LONG, event_type=schemas.STRING, event_id=schemas.LONG, value=schemas.DOUBLE, insertion_datetime=schemas.TIME
)
ORDER_COLUMNS = ORDERS.names[:-1]


def _known_orders(spark, folder):
    return table(spark, folder, "orders").where("o_orderkey % 10 <> 0").select(*ORDER_COLUMNS)


def _changed_orders(spark, folder):
    """New and known orders with new status, some prices lost, and without the priority column."""
    changed = table(spark, folder, "orders").where("o_orderkey % 10 IN (0, 1)")
    return changed.select(
        "o_orderkey",
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("U").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice") * 2).alias("o_totalprice"),
    )


UPSERTED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (0, 1) THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 10 IN (0, 1) THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 10 NOT IN (0, 1) THEN o_totalprice WHEN o_orderkey % 4 <> 0 THEN o_totalprice * 2 END AS o_totalprice,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority
FROM orders"""
UPDATED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 1 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 10 = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 4 <> 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderpriority
FROM orders WHERE o_orderkey % 10 <> 0"""


def upsert_orders(spark, folder):
    return merge.upsert(_known_orders(spark, folder), _changed_orders(spark, folder), ["o_orderkey"])


def update_nonnull_orders(spark, folder):
    return merge.update_known(_known_orders(spark, folder), _changed_orders(spark, folder), ["o_orderkey"])


def _warehouse(spark, label):
    return Warehouse(
        spark, fresh_path(spark, label), {"orders": (ORDERS, ["o_orderkey"]), "latest_events": (EVENTS, ["user_id", "event_type"])}
    )


def warehouse_upsert(spark, folder):
    """Create, load, upsert twice (the second time nothing may change), update, read."""
    warehouse = _warehouse(spark, "upsert")
    warehouse.create_all()
    warehouse.load("orders", _known_orders(spark, folder), RUN_TIME, "truncate")
    for _ in range(2):
        warehouse.upsert("orders", _changed_orders(spark, folder), RUN_TIME)
    warehouse.update("orders", _changed_orders(spark, folder).select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus")), RUN_TIME)
    return warehouse.read("orders").drop("insertion_datetime")


def warehouse_append(spark, folder):
    """An empty-only load, an append, and the run's time stamp."""
    warehouse = _warehouse(spark, "append")
    orders = table(spark, folder, "orders").select(*ORDER_COLUMNS)
    warehouse.load("orders", orders.where("o_orderkey % 2 = 0"), RUN_TIME, "empty")
    warehouse.load("orders", orders.where("o_orderkey % 2 = 1"), RUN_TIME, "append")
    return warehouse.read("orders").withColumn("insertion_datetime", F.date_format("insertion_datetime", "yyyy-MM-dd"))


def csv_round_trip(spark, folder):
    """Line items through CSV files, found again by a name pattern; the flags have quotes and line feeds."""
    path = fresh_path(spark, "csv")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.concat("l_returnflag", F.lit(', "'), "l_linestatus", F.lit('"\nend')).alias("flags")
    )
    writers.write_csv(lines, path)
    schema = schemas.record(flags=schemas.STRING, l_orderkey=schemas.LONG, l_linenumber=schemas.INT, l_extendedprice=schemas.DOUBLE)
    return readers.read_csv(spark, readers.prefix_glob(path, "part-", "csv"), schema, multi_line=True)


def ndjson_round_trip(spark, folder):
    """Events as nested JSON lines and back."""
    path = fresh_path(spark, "ndjson")
    events = table(spark, folder, "events").select("event_id", F.struct("user_id", "event_type").alias("who"))
    writers.write_ndjson(events, path)
    schema = schemas.record(event_id=schemas.LONG, who=schemas.record(user_id=schemas.LONG, event_type=schemas.STRING))
    back = readers.read_ndjson(spark, readers.prefix_glob(path, "part-", "json"), schema)
    return back.select("event_id", "who.user_id", "who.event_type")


def incremental_upsert(spark, folder):
    """The event log taken in as landed files: the last event of each user and type."""
    warehouse = _warehouse(spark, "stream")
    events = table(spark, folder, "events")
    for _ in range(2):  # the second call finds nothing new
        ingest_files(
            spark,
            warehouse,
            "latest_events",
            folder,
            "events.parquet",
            "parquet",
            events.schema,
            ["ts", "event_id"],
            f"{warehouse.root}/_checkpoint",
            RUN_TIME,
        )
    return warehouse.read("latest_events").drop("insertion_datetime")


def _events_with_bad_lines(spark, folder):
    """The event log landed as lines in two batches; some lines are cut off, some have no user."""
    landing, warehouse = fresh_path(spark, "landing"), _warehouse(spark, "stream")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    user = F.when(F.col("event_id") % 101 != 0, F.col("user_id"))
    record = F.to_json(F.struct(user.alias("user_id"), "event_type", "event_id", "value", "ts"))
    cut = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "user'))
    lines = events.select(F.when(F.col("event_id") % 97 == 0, cut).otherwise(record).alias("value"), (F.col("event_id") % 2).alias("half"))
    schema = schemas.record(user_id=schemas.LONG, event_type=schemas.STRING, event_id=schemas.LONG, value=schemas.DOUBLE, ts=schemas.TIME)
    rejects = f"{warehouse.root}/_rejects"
    for half in (0, 1):
        lines.where(F.col("half") == half).select("value").write.text(f"{landing}/{half}")
        for _ in range(2):  # the second call finds nothing new
            ingest_files(
                spark, warehouse, "latest_events", f"{landing}/*", "part-*", "json", schema, ["ts", "event_id"],
                f"{warehouse.root}/_checkpoint", RUN_TIME, rejects=rejects,
            )
    return warehouse, rejects


def incremental_upsert_bad_lines(spark, folder):
    """The last good event of each user and type; bad lines are no rows of the table."""
    warehouse, _ = _events_with_bad_lines(spark, folder)
    return warehouse.read("latest_events").drop("insertion_datetime")


def incremental_rejects(spark, folder):
    """The events that were not taken in, and why."""
    _, rejects = _events_with_bad_lines(spark, folder)
    event = F.regexp_extract("line", r'"event_id":\s*(\d+)', 1).cast("bigint")
    return read_rejects(spark, rejects).select("reason", event.alias("event_id"), (F.col("batch") % 2).alias("half"))


QUERIES = {
    "incremental_upsert_bad_lines": Query(
        incremental_upsert_bad_lines,
        """SELECT user_id, event_type, event_id, value FROM events WHERE event_id % 97 <> 0 AND event_id % 101 <> 0
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "incremental_rejects": Query(
        incremental_rejects,
        """SELECT CASE WHEN event_id % 97 = 0 THEN 'not a record of the schema' ELSE 'a key is missing' END AS reason, event_id, event_id % 2 AS half
FROM events WHERE event_id % 97 = 0 OR event_id % 101 = 0""",
    ),
    "upsert_orders": Query(upsert_orders, UPSERTED),
    "update_nonnull_orders": Query(update_nonnull_orders, UPDATED),
    "warehouse_upsert": Query(warehouse_upsert, UPSERTED),
    "warehouse_append": Query(
        warehouse_append, f"SELECT {', '.join(ORDER_COLUMNS)}, '2024-04-01' AS insertion_datetime FROM orders"
    ),
    "csv_round_trip": Query(
        csv_round_trip,
        """SELECT l_returnflag || ', "' || l_linestatus || '"' || chr(10) || 'end' AS flags, l_orderkey, l_linenumber, l_extendedprice FROM lineitem""",
    ),
    "ndjson_round_trip": Query(ndjson_round_trip, "SELECT event_id, user_id, event_type FROM events"),
    "incremental_upsert": Query(
        incremental_upsert,
        """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
}
