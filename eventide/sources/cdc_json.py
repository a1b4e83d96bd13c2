"""Newline-JSON change-data-capture inputs with explicit schemas (no
inference): row-level CDC envelopes with transaction metadata, transaction
boundary events, and key-value store change records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE = ("struct<version:string,connector:string,name:string,ts_ms:bigint,db:string,"
          "schema:string,table:string,txId:bigint,lsn:bigint,xmin:bigint>")
TRANSACTION = "struct<id:string,total_order:bigint,data_collection_order:bigint>"
ORDER_ROW = "struct<id:bigint,customer_id:bigint,status:string,total_amount:double>"
ITEM_ROW = ("struct<id:bigint,order_id:bigint,product_id:bigint,quantity:int,"
            "unit_price:double>")

ORDERS_CDC = (f"before {ORDER_ROW}, after {ORDER_ROW}, source {SOURCE}, op string, "
              f"ts_ms bigint, transaction {TRANSACTION}")
ORDER_ITEMS_CDC = (f"before {ITEM_ROW}, after {ITEM_ROW}, source {SOURCE}, op string, "
                   f"ts_ms bigint, transaction {TRANSACTION}")
TRANSACTION_EVENTS = ("status string, id string, ts_ms bigint, event_count bigint, "
                      "data_collections array<struct<data_collection:string,"
                      "event_count:bigint>>")
ATTR = "struct<S:string,N:string>"
KV_CHANGES = (f"eventID string, eventName string, dynamodb struct<Keys:map<string,{ATTR}>,"
              f"NewImage:map<string,{ATTR}>,OldImage:map<string,{ATTR}>,"
              "SequenceNumber:string,SizeBytes:bigint,StreamViewType:string>")

SCHEMAS = {"orders_cdc": ORDERS_CDC, "order_items_cdc": ORDER_ITEMS_CDC,
           "transaction_events": TRANSACTION_EVENTS, "kv_changes": KV_CHANGES}


def read_cdc(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[kind]).json(path)


def read_cdc_stream(spark: SparkSession, path: str, kind: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(SCHEMAS[kind])
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)
