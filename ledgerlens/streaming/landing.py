"""Load-once ingestion of landing CSV files with Structured Streaming.

The reference loads every staged file whose name contains ``invoices`` /
``organizations`` and relies on the loader remembering which files it has
already loaded. The Spark counterpart is a file stream source: its
checkpoint records every file it has committed, so a run with
``trigger(availableNow=True)`` reads exactly the files that arrived since
the previous run and then stops — a daily batch with exactly-once file
bookkeeping. Each micro-batch is upserted into the RAW table; the upsert is
idempotent, so a batch replayed after a failure yields the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.build import Warehouse, load_raw
from ledgerlens.sources.csv import CSV_READ_OPTIONS, INVOICES_GLOB, ORGANIZATIONS_GLOB, blanks_to_null
from ledgerlens.sources.schemas import RAW_INVOICES, RAW_INVOICES_KEY, RAW_ORGANIZATIONS, RAW_ORGANIZATIONS_KEY

_KINDS = {
    "invoices": (RAW_INVOICES, INVOICES_GLOB),
    "organizations": (RAW_ORGANIZATIONS, ORGANIZATIONS_GLOB),
}


_KEYS = {"invoices": (RAW_INVOICES_KEY, ""), "organizations": (RAW_ORGANIZATIONS_KEY, None)}
FILE_TIME, FILE_NAME = "_FILE_TIME", "_FILE_NAME"


def newest_files(batch: DataFrame, keys: tuple[str, ...], null_as: str | None) -> DataFrame:
    """The rows of each key's newest file, a partial and a final maximum; rows
    of one file that share a key all stay, to be refused by the upsert."""
    k = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(null_as)).alias(f"_k{i}") if null_as is not None
         else F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    rows = batch.select("*", *k, F.struct(FILE_TIME, FILE_NAME).alias("_f"))
    names = [f"_k{i}" for i in range(len(keys))]
    newest = rows.groupBy(*names).agg(F.max("_f").alias("_newest"))
    cond = [rows[n].eqNullSafe(newest[n]) for n in names] + [rows["_f"] == newest["_newest"]]
    return rows.join(newest, cond, "left_semi").drop(*names, "_f")


def landing_stream(spark: SparkSession, landing_dir: str, kind: str = "invoices",
                   max_files_per_trigger: int | None = None, multi_line: bool = True) -> DataFrame:
    """Streaming DataFrame over the landing files of one kind, with the
    modification time of each row's file as ``FILE_TIME``."""
    schema, glob = _KINDS[kind]
    r = spark.readStream.schema(schema).options(**CSV_READ_OPTIONS).option("multiLine", str(multi_line).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(f"{landing_dir.rstrip('/')}/{glob}").select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME),
                                                             F.col("_metadata.file_name").alias(FILE_NAME))


def start_landing_ingest(spark: SparkSession, landing_dir: str, wh: Warehouse, kind: str = "invoices",
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None, multi_line: bool = True,
                         newest_file_wins: bool = True) -> StreamingQuery:
    """Start the ingest of one file kind into its RAW table.

    A backlog may hold a key in several files: the row of the newest file
    (then of the greatest name) is loaded. With ``newest_file_wins=False``, and for
    a key that one file repeats, duplicate keys raise.

    ``checkpoint`` defaults to a folder inside the warehouse, next to the
    tables it feeds, so it lives on the same shared storage.
    """
    checkpoint = checkpoint or wh.path(f"_checkpoints/landing_{kind}")

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001 - foreachBatch signature
        schema, _ = _KINDS[kind]
        rows = batch if not newest_file_wins else newest_files(batch, *_KEYS[kind])
        rows = blanks_to_null(rows.select(*schema.fieldNames()))
        load_raw(batch.sparkSession, wh, **{kind: rows})

    w = (landing_stream(spark, landing_dir, kind, max_files_per_trigger, multi_line).writeStream
         .foreachBatch(upsert_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_available(spark: SparkSession, landing_dir: str, wh: Warehouse,
                     kinds: tuple[str, ...] = ("organizations", "invoices")) -> None:
    """Load every landing file not loaded before, then return."""
    for kind in kinds:
        q = start_landing_ingest(spark, landing_dir, wh, kind)
        q.awaitTermination()
