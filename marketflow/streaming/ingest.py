"""Sinks of the shop, comment and shop-list topics: a dated table and a document index per record type.

Every record type is a function from messages to records, so that the same code
serves a table of messages, a stream, and a micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import json_fields as J
from ..operators import records as R
from ..sinks.documents import write_documents
from ..sinks.fanout import Branch, Sink, fan_out, replay
from ..sinks.tables import BATCH, write_batch

# Sinks of a topic that run side by side.
AT_ONCE = 4


@dataclass(frozen=True)
class RecordType:
    """How the messages of a topic become table rows and documents.

    ``array`` names the property that holds the elements, ``""`` means the message
    itself is the array, None that the message is the record.
    """

    name: str
    row: tuple[S.Field, ...]
    document: tuple[S.Field, ...]
    array: str | None = None

    @property
    def table(self) -> str:
        return f"ods_{self.name}"

    @property
    def _fields(self) -> tuple[S.Field, ...]:
        """Every key either output reads."""
        return tuple({f.key: f for f in (*self.row, *self.document) if f.key}.values())

    def parsed(self, messages: DataFrame) -> DataFrame:
        """The text columns of this type, from raw messages."""
        if self.array is None:
            return R.parsed_messages(messages, self._fields)
        elements = R.explode_property(messages, self.array) if self.array else R.explode_message(messages)
        return R.parsed_messages(elements, self._fields, require=None)

    @property
    def outputs(self) -> dict[str, tuple[S.Field, ...]]:
        """The fields of the table and of the documents. Each is judged alone: a text fee fits the table only."""
        return {self.table: self.row, f"doc_{self.name}": self.document}

    def frame(self, shared: DataFrame) -> DataFrame:
        """The judged rows of this type from messages that ``shared_parse`` has read.

        A message whose array could not be read is a reject of both outputs.
        """
        if self.array is None:
            return shared.where("has_key")
        array = F.col(f"`{self.array or WHOLE}`")
        elements = R.parsed_messages(shared.select(F.explode(array).alias("value")), self._fields, require=None)
        lost = shared.where(F.col(R.bad_array_of(self.array))).select(
            "value", *(F.lit(R.NOT_AN_ARRAY).alias(R.reason_of(name)) for name in self.outputs)
        )
        return R.judged(elements, self.outputs).unionByName(lost, allowMissingColumns=True)

    def rejects(self, judged: DataFrame) -> DataFrame:
        """What an output of ``frame`` cannot store: the output as ``sink``, the text and the reason."""
        told = F.array(*(F.struct(F.lit(name).alias("sink"), F.col(R.reason_of(name)).alias(R.REASON)) for name in self.outputs))
        return R.rejected(judged.select("value", F.inline(told)))

    def rows(self, messages: DataFrame, now: str | None = None) -> DataFrame:
        return R.accepted(R.typed_rows(self.parsed(messages), self.row, now=now))

    def documents(self, messages: DataFrame, now: str | None = None) -> DataFrame:
        return R.accepted(R.typed_rows(self.parsed(messages), self.document, now=now))


WHOLE = "elements"

SHOP = RecordType("shop", S.SHOP, S.SHOP_DOC)
ITEM = RecordType("item", S.ITEM, S.ITEM_DOC, "itemList")
COUPON = RecordType("coupon", S.COUPON, S.COUPON_DOC, "couponList")
SHOP_BASIC = RecordType("shop_basic", S.SHOP_BASIC, S.SHOP_BASIC_DOC, "")
SHOP_COMMENT = RecordType("shop_comment", S.SHOP_COMMENT, S.SHOP_COMMENT_DOC)
USER_COMMENT = RecordType("user_comment", S.USER_COMMENT, S.USER_COMMENT_DOC, "list")

# The topics and what each of them carries.
TOPICS = {
    "shop1": (SHOP, ITEM, COUPON),
    "shop_list1": (SHOP_BASIC,),
    "comment1": (SHOP_COMMENT, USER_COMMENT),
}


def shared_parse(kinds: tuple[RecordType, ...]):
    """One parse of a message for all its record types."""
    outputs = {name: fields for kind in kinds if kind.array is None for name, fields in kind.outputs.items()}
    arrays = [kind.array for kind in kinds if kind.array]
    if not outputs and not arrays:
        elements = F.col(WHOLE)
        return lambda messages: messages.select("value", J.array_elements(F.col("value")).alias(WHOLE)).select(
            elements, elements.isNull().alias(R.bad_array_of("")), F.when(elements.isNull(), F.col("value")).alias("value"))
    return lambda messages: R.shared_messages(messages, outputs, arrays)


def topic_branches(topic: str, root: str, now: str | None = None) -> list[Branch]:
    """The table, document and reject sinks of a topic below ``root``."""
    branches = []
    for kind in TOPICS[topic]:
        sinks = {
            kind.table: _table_sink(kind, f"{root}/{kind.table}", now),
            f"doc_{kind.name}": _document_sink(kind, f"{root}/documents", now),
            f"rejected_{kind.name}": _reject_sink(kind, f"{root}/rejected_{kind.name}"),
        }
        branches.append(Branch(kind.frame, sinks, hold=kind.array is not None))
    return branches


def topic_writer(topic: str, root: str, now: str | None = None, on_error=None, at_once: int = AT_ONCE, park: str | None = None) -> Sink:
    """A ``foreachBatch`` function with all sinks of a topic below ``root``, ``at_once`` of them side by side.

    The day of a row is the day it is processed. Rows keep the batch id as a
    partition above the day, so a repeated batch replaces itself in every sink,
    also after midnight. What one sink cannot store is judged for that sink alone.
    With ``park``, what a failed sink was given waits there for ``replay_topic``.
    """
    return fan_out(topic_branches(topic, root, now), shared_parse(TOPICS[topic]), on_error, at_once, park)


def replay_topic(spark: SparkSession, topic: str, root: str, park: str, now: str | None = None) -> list[tuple[str, int]]:
    """Give what failed sinks of a topic had to leave to them once more."""
    sinks = {name: sink for branch in topic_branches(topic, root, now) for name, sink in branch.sinks.items()}
    return replay(spark, park, sinks)


def _day(df: DataFrame, now: str | None) -> str:
    """The day of processing, in the session's zone."""
    if now is not None:
        return now[:10]
    return datetime.now(ZoneInfo(df.sparkSession.conf.get("spark.sql.session.timeZone"))).date().isoformat()


def _table_sink(kind: RecordType, path: str, now: str | None) -> Sink:
    def write(parsed: DataFrame, batch_id: int) -> None:
        rows = R.accepted(R.typed_rows(parsed, kind.row, now=now, output=kind.table)).withColumn("batch_date", F.lit(_day(parsed, now)))
        rows.write.mode("overwrite").partitionBy("batch_date").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def _document_sink(kind: RecordType, path: str, now: str | None) -> Sink:
    def write(parsed: DataFrame, batch_id: int) -> None:
        documents = R.accepted(R.typed_rows(parsed, kind.document, now=now, output=f"doc_{kind.name}"))
        write_documents(documents, path, kind.name, _day(parsed, now), batch_id)

    return write


def _reject_sink(kind: RecordType, path: str) -> Sink:
    def write(parsed: DataFrame, batch_id: int) -> None:
        write_batch(kind.rejects(parsed), path, batch_id)

    return write
