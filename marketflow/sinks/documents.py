"""JSON documents in ``index/type`` folders, or in a document store through its connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import REASON
from ..schemas import Field, ddl
from .tables import BATCH, stored_once

PLACE = ("doc_index", "doc_type")


DOCUMENT_ID = "document_id"

# Documents repeat their keys, so their files are compressed. Such a file is read by one task: its documents are bounded.
STORED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def with_document_id(df: DataFrame, batch_id: int) -> DataFrame:
    """``document_id`` from the batch, the document and its number among equal ones: a repeated batch gives the same ids.

    Columns that tell the time of processing differ from one attempt to the next; leave them out or fix them per batch.
    """
    equal = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return equal.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select(
        *df.columns, F.sha2(F.concat_ws("|", F.lit(batch_id), F.col("_copy"), text), 256).alias(DOCUMENT_ID)
    )


def write_documents(df: DataFrame, path: str, index: str, doc_type: str, batch_id: int | None = None, nulls: bool = True,
                    connector: str | None = None, **options: str) -> None:
    """Append documents; with a ``batch_id`` replace the earlier attempt of that batch.

    The batch id stands above the type, which is the day of processing, so an attempt after midnight replaces one before
    it. A folder holds documents of batches or appended ones, not both. ``connector`` names a document-store data source,
    which then gets ``index/type`` as its resource and, for a batch, ids in ``document_id``: name that column in the
    connector's options, so that the store replaces a document it has.
    """
    if connector:
        rows = df if batch_id is None else with_document_id(df, batch_id)
        rows.write.format(connector).mode("append").options(**options).save(f"{index}/{doc_type}")
        return
    target = f"{path}/{PLACE[0]}={index}"
    nulls_kept = str(not nulls).lower()
    if batch_id is None:
        df.write.options(**STORED, ignoreNullFields=nulls_kept).mode("append").json(f"{target}/{PLACE[1]}={doc_type}")
    else:
        _replace_batch(df, target, doc_type, batch_id, "json", ignoreNullFields=nulls_kept)


def _replace_batch(df: DataFrame, target: str, doc_type: str, batch_id: int, fmt: str, **options: str) -> None:
    rows = df.withColumn(PLACE[1], F.lit(doc_type))
    rows.write.mode("overwrite").options(**STORED, **options).partitionBy(PLACE[1]).format(fmt).save(f"{target}/{BATCH}={batch_id}")


def write_json_texts(df: DataFrame, path: str, index: str, doc_type: str, batch_id: int, quarantine: str) -> None:
    """Documents given as JSON text in ``value``; texts that are no object go to ``quarantine``.

    A ``reject_reason`` column, where there is one, sets its rows aside as well and is kept beside their text.
    """
    usable = F.coalesce(F.json_object_keys(F.col("value")).isNotNull(), F.lit(False))
    told = df.withColumn(REASON, F.lit(None).cast("string")) if REASON not in df.columns else df
    judged = told.select("value", F.when(~usable, F.coalesce(REASON, F.lit("not_an_object"))).otherwise(F.col(REASON)).alias(REASON))
    with stored_once(judged) as held:
        _replace_batch(held.where(F.col(REASON).isNull()).select("value"), f"{path}/{PLACE[0]}={index}", doc_type, batch_id, "text")
        _replace_batch(held.where(F.col(REASON).isNotNull()), f"{quarantine}/{PLACE[0]}={index}", doc_type, batch_id, "json")


def read_documents(spark: SparkSession, path: str, fields: tuple[Field, ...]) -> DataFrame:
    schema = ddl(fields, f"{PLACE[0]} string, {PLACE[1]} string")
    names = [f.name for f in fields]
    return spark.read.schema(schema).json(path).select(*PLACE, *names)
