"""Command line: load the input files, convert them to Parquet, or query loaded tables."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from etalage.schemas import FILES
from etalage.session import prepare
from etalage.sources.files import convert_to_parquet
from etalage.sources.load import full_load, register_views, validate
from etalage.sources.streams import append_to, keep_running
from etalage.operators.privacy import erase_files, pseudonymize, stored
from etalage.operators.reports import sales_by_product, top_categories

TABLES = [
    "customers",
    "products",
    "sessions",
    "addresses",
    "orders",
    "order_items",
    "payments",
    "fraud_alerts",
]


#: Tables whose rows go with those of another, and the column that leads there.
CHILDREN = {
    "order_items": ("orders", "order_id"),
    "payments": ("orders", "order_id"),
    "fraud_alerts": ("payments", "payment_id"),
}


def erase_command(spark: SparkSession, folder: str, ids: str, out: str) -> DataFrame:
    """Curated payments lead to their customer over the order, alerts over the payment."""
    erased = spark.read.text(ids).select(F.trim("value").alias("customer_id"))
    return erase_files(spark, folder, TABLES, erased, "customer_id", CHILDREN, out)


def ingest_events(spark: SparkSession, inbox: str, out: str, checkpoint: str, every: str) -> StreamingQuery:
    """Event files (JSON lines) that are new, each time, by day."""
    lines = spark.readStream.schema(FILES["events"]).json(inbox)
    return keep_running(append_to(lines.withColumn("day", F.to_date("ts")), out, checkpoint, by="day"), every)


def main() -> None:
    parser = argparse.ArgumentParser(prog="etalage", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="replace the curated tables from the input files")
    load.add_argument("--data-dir", required=True)
    load.add_argument("--out", required=True)
    convert = commands.add_parser("convert", help="convert the input files to Parquet")
    convert.add_argument("--data-dir", default=".")
    convert.add_argument("--out")
    ask = commands.add_parser("sql", help="run a statement on the loaded tables and report views")
    ask.add_argument("--tables", required=True)
    ask.add_argument("statement")
    forget = commands.add_parser("erase", help="rid the loaded tables of the customers listed in a file; files without them stay as they are")
    forget.add_argument("--tables", required=True)
    forget.add_argument("--ids", required=True, help="text file, one customer id a line")
    forget.add_argument("--out", required=True)
    hide = commands.add_parser("pseudonymize", help="write the customers under salted names")
    hide.add_argument("--tables", required=True)
    hide.add_argument("--out", required=True)
    hide.add_argument("--salt-file", required=True, help="file that holds the secret salt")
    ingest = commands.add_parser("ingest", help="append new event files to the bronze layer until stopped")
    ingest.add_argument("--inbox", required=True)
    ingest.add_argument("--out", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--every", default="15 minutes")
    args = parser.parse_args()

    spark = prepare(SparkSession.builder.appName("etalage").getOrCreate())
    if args.command == "load":
        tables, counts = full_load(spark, args.data_dir, args.out)
        counts.show(truncate=False)
        validate(tables).orderBy("check_name").show(100, truncate=False)
        top_categories(tables["products"], sales_by_product(tables["order_items"])).show(truncate=False)
        tables["payments"].agg(F.count_if("is_fraudulent").alias("fraudulent_payments")).show()
    elif args.command == "convert":
        done = convert_to_parquet(spark, args.data_dir, args.out or args.data_dir)
        for table, rejects in done.items():
            print(f"{table}: converted, {rejects} lines rejected")
        if not done:
            print("nothing found")
    elif args.command == "ingest":
        ingest_events(spark, args.inbox, args.out, args.checkpoint, args.every).awaitTermination()
    elif args.command == "erase":
        erase_command(spark, args.tables, args.ids, args.out).show(truncate=False)
    elif args.command == "pseudonymize":
        salt = spark.read.text(args.salt_file).first()[0]
        customers = stored(spark, args.tables, "customers").withColumnsRenamed({"date_of_birth": "birthdate"})
        pseudonymize(customers.withColumn("segment", F.lit(None).cast("string")), salt).write.parquet(args.out)
    else:
        register_views({t: stored(spark, args.tables, t) for t in TABLES})
        spark.sql(args.statement).show(100, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
