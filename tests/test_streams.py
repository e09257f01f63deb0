import os
import threading

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from marketflow.operators import behavior as B
from marketflow.operators import records
from marketflow.plans import clicks as clicks_plan
from marketflow.schemas import Field
from marketflow.session import configure, file_state, path_exists, scratch, shared_root
from marketflow.sinks import documents, files, jdbc, tables  # noqa: F401
from marketflow.sinks.commit import PartitionCommit
from marketflow.sinks.documents import read_documents, write_documents, write_json_texts
from marketflow.sinks.fanout import Branch, SinkErrors, fan_out, parked, replay
from marketflow.sinks.keyed import KeyedTable
from marketflow.sinks.rolling import RollingLines
from marketflow.sinks.tables import stored_once
from marketflow.sinks.topic import write_topic
from marketflow.sources import jdbc as J
from marketflow.sources.topic import FILE_RECORDS, kafka_options, topic_parts, topic_stream
from marketflow.streaming import ingest, runs, shops
from marketflow.streaming.shops import partitioned_shops, write_partitioned_shops
from marketflow.streaming.windows import RankedShops, windowed

FIELD, NAME = Field("n", "n", "int"), Field("name", "name")
CLICK = '{{"sessionId":"{0}","mtWmPoiId":"{1}","shopName":"s","platform":"p","source":"x","createTime":"2024-01-01 {2}"}}'


class Topic:
    """A topic whose messages arrive in steps, and one stream job over it."""

    def __init__(self, spark, job):
        self.spark, self.job, self.sent = spark, job, 0
        self.root = scratch(spark, "test")

    def send(self, *texts):
        rows = [("user_behavior", None, t, 0, self.sent + i) for i, t in enumerate(texts)]
        self.sent += len(texts)
        df = self.spark.createDataFrame(rows, "topic string, key string, value string, partition int, offset long")
        write_topic(df.withColumn("timestamp", F.lit(None).cast("timestamp")), path=f"{self.root}/topics")
        stream = topic_stream(self.spark, ["user_behavior"], path=f"{self.root}/topics")
        return runs.drain(self.job(stream, self.root))


def test_a_stream_from_the_latest_loses_nothing_while_it_stands_still(spark):
    root = scratch(spark, "latest")
    topics, starts = f"{root}/topics", f"{root}/starts"

    def send(*records):
        rows = [("t", None, v, p, o) for p, o, v in records]
        write_topic(spark.createDataFrame(rows, "topic string, key string, value string, partition int, offset long").withColumn("timestamp", F.lit(None).cast("timestamp")), path=topics)

    def read():
        stream = topic_stream(spark, ["t"], path=topics, start="latest", starts=starts).select("value")
        runs.drain(runs.into_files(stream, f"{root}/out", f"{root}/checkpoint"))
        return sorted(r.value for r in spark.read.schema("value string").parquet(f"{root}/out").collect())

    send((0, 0, "old"), (0, 1, "old"), (1, 0, "old"))
    assert read() == []
    send((0, 2, "a"), (1, 1, "b"), (2, 0, "c"))  # with a partition that is new
    assert read() == ["a", "b", "c"]
    send((0, 3, "d"))
    assert read() == ["a", "b", "c", "d"] == read()
    assert {(r.partition, r.next) for r in spark.read.parquet(starts).collect()} == {(0, 2), (1, 1)}
    with pytest.raises(ValueError):
        topic_stream(spark, ["t"], path=topics, start="latest")
    with pytest.raises(ValueError):
        topic_stream(spark, ["t"], path=topics, start="middle")


def test_a_bounded_stream_goes_on_where_it_stood(spark, monkeypatch):
    root, sizes, failing = scratch(spark, "bounded"), [], [True]
    rows = spark.range(0, 2300, 1, 1).select(F.lit("t").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    write_topic(rows, path=f"{root}/topics", file_records=FILE_RECORDS)

    def write(batch, batch_id):
        if batch_id == 1 and failing[0]:
            raise RuntimeError("stopped")
        sizes.append(batch.count())
        tables.write_batch(batch.select("value"), f"{root}/out", batch_id)

    def run():
        stream = topic_stream(spark, ["t"], path=f"{root}/topics", max_per_trigger=1100)
        runs.drain(runs.into_batches(stream, write, f"{root}/checkpoint"))

    with pytest.raises(Exception, match="stopped"):
        run()
    failing[0] = False
    run()
    assert len(sizes) == 3 and max(sizes) <= 1100 and sum(sizes) == 2300
    assert sorted(int(r.value) for r in spark.read.parquet(f"{root}/out").collect()) == list(range(2300))


def test_late_rows_count_in_the_closing_batch_only(spark):
    def job(stream, root):
        return runs.into_files(windowed(B.behaviors(stream)), f"{root}/out", f"{root}/checkpoint")

    topic = Topic(spark, job)
    topic.send(CLICK.format(1, "a", "00:00:10"), CLICK.format(2, "a", "00:01:00"))
    topic.send(CLICK.format(3, "z", "00:02:20"), CLICK.format(4, "a", "00:00:20"))
    query = topic.send(CLICK.format(5, "a", "00:00:30"), CLICK.format(6, "z", "00:04:19"))
    found = {(r.mt_wm_poi_id, r.window_start.minute): r.action_num for r in spark.read.parquet(f"{topic.root}/out").collect()}
    assert found == {("a", 0): 3}
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


@pytest.mark.parametrize("delay", ["0 seconds", "5 seconds", "3500 milliseconds"])
def test_watermark_delays(spark, delay):
    def job(stream, root):
        return runs.into_files(windowed(B.behaviors(stream), delay), f"{root}/out", f"{root}/checkpoint")

    topic = Topic(spark, job)
    topic.send(CLICK.format(1, "a", "00:00:10"), CLICK.format(2, "z", "00:02:04"))
    closed = spark.read.schema("mt_wm_poi_id string").parquet(f"{topic.root}/out").count()
    assert closed == (0 if delay == "5 seconds" else 1)


def test_ranked_shops_over_batches_and_a_repeated_batch(spark):
    state = RankedShops(spark, scratch(spark, "ranked"), 2)

    def windows(*rows):
        return spark.createDataFrame([(s, s, "x", p, "2024-01-01", "00", mm, n) for s, p, mm, n in rows],
                                     "mt_wm_poi_id string, shop_name string, source string, platform string, dt string, hr string, mm string, action_num long")

    def top(batch_id):
        return sorted((r.platform, r.mt_wm_poi_id, r.action_num) for r in state.result(batch_id).collect())

    state(windows(("a", "p", "00", 3), ("b", "p", "00", 2), ("c", "p", "00", 1)), 0)
    second = windows(("d", "p", "02", 5), ("e", "q", "02", 1))
    state(second, 1)
    assert top(1) == [("p", "a", 3), ("p", "d", 5), ("q", "e", 1)]
    state(second, 1)
    assert top(1) == [("p", "a", 3), ("p", "d", 5), ("q", "e", 1)]
    state(windows(), 2)
    assert top(2) == top(1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        state.result(0)


def test_a_sink_that_failed_in_a_batch_is_made_good_on_restart(spark):
    """One of two sinks fails after the other has written; the batch runs again from the checkpoint."""
    failing = [True]

    def broken_once(df, batch_id):
        if failing[0]:
            raise RuntimeError("lost")
        tables.write_batch(df, f"{root}/second", batch_id)

    def job(stream, root):
        sinks = {"first": lambda df, batch_id: tables.write_batch(df, f"{root}/first", batch_id), "second": broken_once}
        return runs.into_batches(stream, fan_out([Branch(lambda b: b.select("value"), sinks)]), f"{root}/checkpoint")

    topic = Topic(spark, job)
    root = topic.root
    with pytest.raises(Exception, match="lost"):
        topic.send("a", "b")
    failing[0] = False
    topic.send("c")
    for name in ("first", "second"):
        assert sorted(r.value for r in spark.read.parquet(f"{root}/{name}").collect()) == ["a", "b", "c"]


def test_keyed_table_over_batches(spark):
    table = KeyedTable(spark, scratch(spark, "keyed"), "id string, n long", "id", "n")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, n long")
    table(rows(("a", 1), ("a", 2), ("b", 1)), 0)
    for _ in range(2):
        table(rows(("b", 3), ("c", 1)), 1)
    assert sorted(map(tuple, table.result(1).collect())) == [("a", 2), ("b", 3), ("c", 1)]


def keyed_files(table):
    return {os.path.relpath(os.path.join(d, f), table.path): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{table.path}/data") for f in names if f.endswith(".parquet")}


def test_a_batch_writes_only_the_buckets_of_its_keys(spark):
    table = KeyedTable(spark, scratch(spark, "keyed"), "id long, a string, n long", "id", "n", buckets=8)
    table(spark.range(4000).select("id", F.lit("a").alias("a"), F.lit(1).alias("n")), 0)
    before = keyed_files(table)
    assert len({path.split("/")[3] for path in before}) == 8
    change = spark.createDataFrame([(7, None, 2), (7, "old", 1), (5000, "new", 1), (None, "lost", 9)], "id long, a string, n long")
    for _ in range(2):
        table(change, 1)
        after = keyed_files(table)
        assert {p: t for p, t in after.items() if p in before} == before
        assert 1 <= len(set(after) - set(before)) <= 2 and all("batch=1" in p for p in set(after) - set(before))
    assert table.result(1).count() == 4001
    assert sorted(map(tuple, table.get(1, [7, 8, 5000, 9999]).collect())) == [(7, "a", 2), (8, "a", 1), (5000, "new", 1)]
    assert len({f.split("bucket=")[1][0] for f in table.get(1, [7]).inputFiles()}) == 1


def test_buckets_are_merged_when_their_deltas_outgrow_them(spark):
    table = KeyedTable(spark, scratch(spark, "keyed"), "id long, a string, b string", "id", buckets=2, max_deltas=3)
    stored = {}
    for batch_id in range(12):
        rows = [(batch_id % 5, f"a{batch_id}", None), (batch_id + 100, None, f"b{batch_id}")]
        table(spark.createDataFrame(rows, "id long, a string, b string"), batch_id)
        for i, a, b in rows:
            old = stored.get(i, (None, None))
            stored[i] = (a if a is not None else old[0], b if b is not None else old[1])
        assert {r.id: (r.a, r.b) for r in table.result(batch_id).collect()} == stored
        folders = table._manifest(batch_id)
        assert all(len(f) <= 4 and len({tuple(x) for x in f}) == len(f) for f in folders.values())
    assert any(kind == "base" for f in folders.values() for _, kind, _ in f)
    kept = {tuple(p.split("/")[1:4]) for p in keyed_files(table)}
    named = {(f"batch={b}", f"kind={kind}", f"bucket={k}") for at in (10, 11) for k, f in table._manifest(at).items() for b, kind, _ in f}
    assert named == kept
    assert len(os.listdir(f"{table.path}/manifest")) <= 6  # with check sums


def test_a_keyed_table_takes_empty_batches_and_other_columns(spark):
    table = KeyedTable(spark, scratch(spark, "keyed"), "id string, n long", "id")
    table(spark.createDataFrame([], "id string, n long"), 0)
    assert table.result(0).count() == 0 and table.get(0, ["a"]).count() == 0
    table(spark.createDataFrame([("a", 5)], "id string, bucket int"), 1)
    table(spark.createDataFrame([("a", 2), ("b", 3)], "id string, n int"), 2)
    assert sorted(map(tuple, table.result(2).collect())) == [("a", 2), ("b", 3)] and table.result(2).schema == table.fields


def test_a_jdbc_key_needs_an_order(spark):
    with pytest.raises(ValueError):
        jdbc.write_jdbc(spark.range(1), "jdbc:x", "t", "d", key="id")


def clicks(spark, *rows):
    df = spark.createDataFrame([(s, t) for s, t in rows], "session_id string, t string")
    at = F.to_timestamp("t")
    blank = [F.lit("v").alias(c) for c in ("user_id", "mt_wm_poi_id", "shop_name", "source", "platform", "create_time")]
    return df.select("session_id", *blank, F.date_format(at, "yyyy-MM-dd").alias("dt"), F.date_format(at, "HH").alias("hr"), at.alias("event_time"))


def test_partition_commit(spark):
    path = scratch(spark, "commit")
    schema = "session_id string, user_id string, mt_wm_poi_id string, shop_name string, source string, platform string, create_time string"
    sink = PartitionCommit(spark, "commit_test", schema, path, commit_delay="1 hour")

    def visible():
        return sorted(r.session_id for r in spark.table("commit_test").collect())

    first = clicks(spark, ("1", "2024-01-01 00:10:00"), ("2", "2024-01-01 01:00:10"))
    sink(first, 0)
    assert visible() == []
    sink(clicks(spark, ("3", "2024-01-01 01:00:20")), 1)
    assert visible() == ["1"]
    assert os.path.exists(f"{path}/dt=2024-01-01/hr=00/batch_id=1/_SUCCESS")
    sink(clicks(spark, ("3", "2024-01-01 01:00:20")), 1)
    sink(clicks(spark, ("4", "2024-01-01 00:59:00")), 2)
    assert visible() == ["1", "4"]
    sink(clicks(spark), 3)
    assert visible() == ["1", "4"]
    sink(clicks(spark, ("5", "2024-01-01 02:00:20")), 4)
    assert visible() == ["1", "2", "3", "4"]
    assert sorted((r.dt, r.hr) for r in sink.pending(4).collect()) == [("2024-01-01", "02")]
    listed = sorted(r.partition for r in spark.sql("SHOW PARTITIONS commit_test").collect())
    assert listed == [f"dt=2024-01-01/hr={hr}/batch_id={b}" for hr, b in (("00", 1), ("00", 2), ("01", 4))]


def test_partition_commit_loses_no_row(spark):
    path = scratch(spark, "commit")
    schema = "session_id string, user_id string, mt_wm_poi_id string, shop_name string, source string, platform string, create_time string"
    sink = PartitionCommit(spark, "commit_whole", schema, path, commit_delay="1 hour")
    first = clicks(spark, ("1", "2024-01-01 00:10:00"), ("2", "2024-01-01 00:20:00"))
    untimed = first.withColumn("event_time", F.lit(None).cast("timestamp"))
    sink(untimed, 0)
    assert [tuple(r) for r in sink.pending(0).collect()] == [("2024-01-01", "00")]
    spoilt = clicks(spark, ("3", "2024-01-01 03:00:00"), ("4", "2024-01-01 03:00:00")).withColumn(
        "hr", F.when(F.col("session_id") == "4", "it's:no").otherwise(F.col("hr")))
    for _ in range(2):
        sink(spoilt, 1)
        assert sorted(r.session_id for r in spark.table("commit_whole").collect()) == ["1", "2"]
    assert [r.session_id for r in spark.read.parquet(f"{path}/_rejected/batch_id=1").collect()] == ["4"]
    sink(clicks(spark, ("5", "2024-01-01 09:00:00")), 2)
    assert sorted(r.session_id for r in spark.table("commit_whole").collect()) == ["1", "2", "3"]
    assert not os.path.exists(f"{path}/_staging/dt=2024-01-01/hr=00")


def test_a_closing_batch_moves_files_and_writes_no_row_again(spark):
    path, schema = scratch(spark, "commit"), "session_id string, user_id string, mt_wm_poi_id string, shop_name string, source string, platform string, create_time string"
    sink = PartitionCommit(spark, "commit_moves", schema, path, commit_delay="1 hour")
    sink(clicks(spark, ("1", "2024-01-01 00:10:00")), 0)
    staged = {os.path.getmtime(os.path.join(d, f)): f for d, _, names in os.walk(f"{path}/_staging") for f in names if f.startswith("part")}
    sink(clicks(spark, ("2", "2024-01-01 00:20:00"), ("3", "2024-01-01 05:00:00")), 1)
    moved = sorted(f for f in os.listdir(f"{path}/dt=2024-01-01/hr=00/batch_id=1") if f.endswith(".parquet"))
    assert [f.split("-")[0] for f in moved] == ["0", "1"] and moved[0] == f"0-{next(iter(staged.values()))}"
    assert os.path.getmtime(f"{path}/dt=2024-01-01/hr=00/batch_id=1/{moved[0]}") in staged
    sink(clicks(spark), 2)
    assert sorted(os.listdir(f"{path}/_staging")) == ["arrival=1", "arrival=2"]


def test_a_batch_that_broke_while_moving_is_made_good(spark, monkeypatch):
    """After some renames, before the catalog and the journal: the batch runs again, and once more after it has ended."""
    path, schema = scratch(spark, "commit"), "session_id string, user_id string, mt_wm_poi_id string, shop_name string, source string, platform string, create_time string"
    sink = PartitionCommit(spark, "commit_broken", schema, path)
    visible = lambda: sorted(r.session_id for r in spark.table("commit_broken").collect())
    sink(clicks(spark, ("1", "2024-01-01 00:10:00")), 0)
    batch = clicks(spark, ("2", "2024-01-01 00:20:00"), ("3", "2024-01-01 01:30:00"), ("4", "2024-01-01 03:00:30"))
    move, calls = sink._move, []

    def broken(row, arrivals, batch_id):
        move(row, arrivals, batch_id)
        calls.append(row)
        if len(calls) == 2:
            raise OSError("lost")

    monkeypatch.setattr(sink, "_move", broken)
    with pytest.raises(OSError, match="lost"):
        sink(batch, 1)
    monkeypatch.setattr(sink, "_move", move)
    for _ in range(2):
        sink(batch, 1)
        assert visible() == ["1", "2", "3", "4"] or visible() == ["1", "2", "3"]
        first = visible()
    sink(clicks(spark, ("5", "2024-01-01 09:00:00")), 2)
    assert visible()[: len(first)] == first and set(visible()) >= {"1", "2", "3", "4"} and len(visible()) == len(set(visible()))


def test_fan_out_isolates_sinks(spark, messages):
    seen = []

    def broken(df, batch_id):
        raise RuntimeError("full disk")

    def count(df, batch_id):
        seen.append(df.count())

    branches = [Branch(lambda b: b, {"bad": broken, "good": count}), Branch(lambda b: b.limit(1), {"other": count})]
    with pytest.raises(SinkErrors, match="bad: full disk"):
        fan_out(branches)(messages("{}", "{}"), 0)
    assert seen == [2, 1]
    noted = []
    fan_out(branches, on_error=lambda *e: noted.append(e[:2]))(messages("{}"), 7)
    assert noted == [("bad", 7)]
    fan_out(branches)(messages(), 1)
    assert len(seen) == 4


def test_a_slow_sink_does_not_hold_up_the_others(spark, messages):
    """The slow sink ends only once all others have: one after another, it would wait for good."""
    ended, pools = [threading.Event() for _ in range(3)], {}

    def slow(df, batch_id):
        pools["slow"] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        assert all(e.wait(60) for e in ended)

    def quick(k):
        def sink(df, batch_id):
            assert df.count() == 2
            ended[k].set()
        return sink

    branches = [Branch(lambda b: b, {"slow": slow, "a": quick(0)}), Branch(lambda b: b, {"b": quick(1), "c": quick(2)}, hold=False)]
    fan_out(branches, at_once=4)(messages("{}", "{}"), 0)
    assert pools == {"slow": "slow"}

    def broken(df, batch_id):
        raise RuntimeError("full disk")

    with pytest.raises(SinkErrors, match="bad: full disk"):
        fan_out([Branch(lambda b: b, {"bad": broken, "a": quick(0)})], at_once=2)(messages("{}", "{}"), 0)


def test_rows_of_a_failed_sink_are_parked_and_replayed(spark, messages):
    root = scratch(spark, "park")
    failing = {"bad"}

    def sink(name):
        def write(df, batch_id):
            if name in failing:
                raise RuntimeError("full disk")
            tables.write_batch(df.select("value"), f"{root}/{name}", batch_id)
        return write

    sinks = {"bad": sink("bad"), "good": sink("good")}
    write = fan_out([Branch(lambda b: b.select("key", "value"), sinks)], at_once=2, park=f"{root}/park")
    for batch_id in range(2):
        write(messages(f"a{batch_id}", f"b{batch_id}"), batch_id)
    values = lambda name: sorted(r.value for r in spark.read.parquet(f"{root}/{name}").collect())
    assert values("good") == ["a0", "a1", "b0", "b1"] and [(n["sink"], n["batch_id"], n["error"]) for n in parked(spark, f"{root}/park")] == [("bad", 0, "full disk"), ("bad", 1, "full disk")]
    with pytest.raises(SinkErrors, match="bad: full disk"):
        replay(spark, f"{root}/park", sinks)
    assert len(parked(spark, f"{root}/park")) == 2
    failing.clear()
    assert replay(spark, f"{root}/park", sinks) == [("bad", 0), ("bad", 1)] and values("bad") == values("good")
    assert parked(spark, f"{root}/park") == [] and replay(spark, f"{root}/park", sinks) == [] and parked(spark, f"{root}/none") == []


def test_a_topic_goes_on_without_a_sink_that_fails(spark, messages, monkeypatch):
    root, real = scratch(spark, "topic"), ingest.write_documents
    batch = messages('{"mtWmPoiId":"1","itemList":[{"spuId":5},{"spuId":6}]}', "broken")

    def lost(*args, **options):
        raise OSError("no store")

    monkeypatch.setattr(ingest, "write_documents", lost)
    ingest.topic_writer("shop1", root, "2024-06-01 00:00:00", park=f"{root}/park")(batch, 3)
    assert spark.read.parquet(f"{root}/ods_item").count() == 2 and not os.path.exists(f"{root}/documents")
    monkeypatch.setattr(ingest, "write_documents", real)
    assert ingest.replay_topic(spark, "shop1", root, f"{root}/park", "2024-06-01 00:00:00") == [("doc_coupon", 3), ("doc_item", 3), ("doc_shop", 3)]
    assert spark.read.json(f"{root}/documents/doc_index=item").count() == 2 and spark.read.json(f"{root}/documents/doc_index=shop").count() == 1


def test_a_repeated_batch_replaces_itself(spark, messages):
    root = scratch(spark, "topic")
    write = ingest.topic_writer("comment1", root, "2024-06-01 00:00:00")
    batch = messages('{"mtWmPoiId":"1","shopId":2,"list":[{"userID":5},{"userID":"no"}]}', "broken")
    for _ in range(2):
        write(batch, 4)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    assert [(r.shop_id, str(r.batch_date)) for r in read("ods_shop_comment").collect()] == [(2, "2024-06-01")]
    assert [r.user_id for r in read("ods_user_comment").collect()] == [5]
    assert [r.reject_reason for r in read("rejected_shop_comment").collect()] == ["not_an_object"] * 2
    assert [r.reject_reason for r in read("rejected_user_comment").collect()] == ["bad_number:user_id"] * 2
    assert spark.read.json(f"{root}/documents").count() == 2


def test_shop_list_topic(spark, messages):
    root = scratch(spark, "topic")
    ingest.topic_writer("shop_list1", root)(messages('[{"mtWmPoiId":"1"},{"mtWmPoiId":"2"}]', "{}"), 0)
    assert spark.read.parquet(f"{root}/ods_shop_basic").count() == 2


def test_quarantine(spark, messages):
    root = scratch(spark, "docs")
    write_json_texts(messages('{"a":1}', "x", None), f"{root}/d", "shop", "2024-06-01", 0, f"{root}/q")
    assert spark.read.text(f"{root}/d").count() == 1 and spark.read.text(f"{root}/q").count() == 2


def stored_files(spark, path):
    return [f for f, _, _ in file_state(spark, path) if f.rsplit("/", 1)[1].startswith("part-")]


def document_bytes(spark, path):
    return sum(size for f, size, _ in file_state(spark, path) if f.rsplit("/", 1)[1].startswith("part-"))


@pytest.mark.parametrize("kind", [ingest.ITEM, ingest.COUPON, ingest.SHOP], ids=lambda kind: kind.name)
@pytest.mark.parametrize("batch_id", [None, 3])
def test_documents_are_stored_small_and_read_whole(spark, messages, kind, batch_id):
    """Appended or by batch: the same documents as their JSON lines, in a fraction of the bytes, NULL fields as told."""
    root = scratch(spark, "docs")
    element = '{{"mtWmPoiId":"{0}","dpShopId":"{0}","shopName":"shop \u00e9 {0}","createTime":"2024-01-01 00:00:00"}}'
    texts = [element.format(i) for i in range(500)]
    texts = [t[:-1] + f',"itemList":[{t}],"couponList":[{t}]}}' for t in texts]
    found = kind.documents(messages(*texts), "2024-06-01 12:00:00")
    write_documents(found, root, kind.name, "2024-06-01", batch_id)
    assert all(f.endswith(".json.gz") for f in stored_files(spark, root)) and stored_files(spark, root)
    plain = found.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    assert document_bytes(spark, root) * 4 < plain.agg(F.sum(F.length("value"))).first()[0]
    assert sorted(r.value for r in spark.read.text(root).select("value").collect()) == sorted(r.value for r in plain.collect())
    back = read_documents(spark, root, kind.document)
    assert sorted(map(str, back.select(found.columns).collect())) == sorted(map(str, found.collect()))


def test_files_of_documents_are_bounded(spark, monkeypatch):
    """A compressed file is read by one task."""
    root = scratch(spark, "docs")
    monkeypatch.setitem(documents.STORED, "maxRecordsPerFile", "100")
    write_documents(spark.range(0, 450, 1, 1), root, "ids", "2024-06-01")
    assert len(stored_files(spark, root)) == 5 and spark.read.json(root).count() == 450


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), "value string, batch_date string")


def data_files(sink, day):
    folder = f"{sink.path}/batch_date={day}"
    return sorted(f for f in os.listdir(folder) if f.endswith(".txt"))


def test_rolling_files_are_bounded_and_a_repeated_batch_replaces_its_own(spark):
    sink = RollingLines(spark, scratch(spark, "rolling"), max_records=10)
    many = spark.range(35).select(F.col("id").cast("string").alias("value"), F.lit("d1").alias("batch_date")).repartition(8)
    for _ in range(2):
        sink(many, 0)
    sink(lines(spark, ("x", "d1"), ("y", "d2")), 1)
    assert sorted(r.value for r in sink.read().collect()) == sorted([*map(str, range(35)), "x", "y"]) and sink.days() == ["d1", "d2"]
    files = data_files(sink, "d1")
    assert [f.split("-")[0] for f in files] == ["0"] * 4 + ["1"]
    assert all(sum(1 for _ in open(f"{sink.path}/batch_date=d1/{f}")) <= 10 for f in files)
    sink(lines(spark), 2)
    assert sink.read().count() == 37


def test_small_files_of_a_day_are_joined(spark, monkeypatch):
    sink = RollingLines(spark, scratch(spark, "rolling"))
    for batch_id in range(6):
        sink(lines(spark, (f"a{batch_id}", "d1"), (f"é{batch_id}", "d1"), ("b", "d2")), batch_id)
    before = sorted(map(tuple, sink.read().collect()))
    assert sink.compact("d1") and not sink.compact("d1") and not sink.compact("none")
    assert len(data_files(sink, "d1")) == 1 and len(data_files(sink, "d2")) == 6 and sorted(map(tuple, sink.read().collect())) == before
    assert sink.compact("d2", part_bytes=4) and len(data_files(sink, "d2")) == 3 and sorted(map(tuple, sink.read().collect())) == before


@pytest.mark.parametrize("at", [1, 2])
def test_a_compaction_that_broke_off_is_finished(spark, monkeypatch, at):
    """After the first rename the day is gone for readers, after the second the old folder is left: the next one makes it good."""
    sink = RollingLines(spark, scratch(spark, "rolling"))
    for batch_id in range(4):
        sink(lines(spark, (f"a{batch_id}", "d1")), batch_id)
    before, rename, calls = sorted(map(tuple, sink.read().collect())), sink._rename, []

    def broken(source, target):
        rename(source, target)
        calls.append(target)
        if len(calls) == at:
            raise OSError("lost")

    monkeypatch.setattr(sink, "_rename", broken)
    with pytest.raises(OSError, match="lost"):
        sink.compact("d1")
    monkeypatch.setattr(sink, "_rename", rename)
    assert not sink.compact("d1") and sorted(map(tuple, sink.read().collect())) == before and len(data_files(sink, "d1")) == 1
    assert os.listdir(f"{sink.path}/_replaced") == []


def test_console(spark):
    topic = Topic(spark, lambda stream, root: runs.into_console(stream.select("value"), f"{root}/checkpoint"))
    progress = topic.send('{"shown":1}').recentProgress[0]
    assert progress.numInputRows == 1 and "Console" in progress.sink.description


def test_tables(spark):
    tables.use_database(spark, "wm")
    try:
        path = scratch(spark, "table")
        tables.create_table(spark, "t", "a string, b int", "batch_date string", path=path, fmt="csv", replace=True, sep="\t")
        df = spark.createDataFrame([("x", 1, "2024-01-01"), ("y", 2, "2024-01-02")], "a string, b int, batch_date string")
        tables.insert_dynamic(df, "t")
        tables.insert_static(df, "t", {"batch_date": "2024-01-03"})
        assert spark.table("wm.t").where("batch_date = '2024-01-03'").count() == 2
        assert spark.table("t").count() == 4
        tables.drop_table(spark, "t")
        assert not spark.catalog.tableExists("t")
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_csv_files_are_bounded_on_request(spark):
    path = scratch(spark, "csv")
    files.write_csv(spark.range(0, 1000, 1, 8), path, max_files=4)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) <= 4
    assert spark.read.csv(path, header=True).count() == 1000


def test_connector_options(spark):
    assert kafka_options("h:1", ["a", "b"], max_offsets=9)["maxOffsetsPerTrigger"] == "9"
    options = J.jdbc_options("jdbc:x", "record", "d", partition_column="id", bounds=("0", "9"), partitions=3)
    assert options["numPartitions"] == "3" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        J.jdbc_options("jdbc:x", "record", "d", partition_column="id")
    with pytest.raises(ValueError):
        topic_stream(spark, ["a"])
    J.register_catalog(spark, "shopdb", "jdbc:x", "d")
    assert spark.conf.get("spark.sql.catalog.shopdb").endswith("JDBCTableCatalog")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_a_text_fee_is_stored_and_only_its_document_is_set_aside(spark, messages):
    root = scratch(spark, "topic")
    batch = messages('{"mtWmPoiId":"1","deliveryFee":"free"}', '{"mtWmPoiId":"2","deliveryFee":3}')
    ingest.topic_writer("shop1", root)(batch, 0)
    assert sorted(r.wm_poi_id for r in spark.read.parquet(f"{root}/ods_shop").collect()) == ["1", "2"]
    assert sorted(r.wm_poi_id for r in ingest.SHOP.rows(batch).collect()) == ["1", "2"]
    assert [r.wm_poi_id for r in spark.read.json(f"{root}/documents/doc_index=shop").collect()] == ["2"]
    assert [(r.sink, r.reject_reason) for r in spark.read.parquet(f"{root}/rejected_shop").collect()] == [("doc_shop", "bad_number:delivery_fee")]


def test_unread_arrays_are_set_aside(spark, messages):
    root = scratch(spark, "topic")
    ingest.topic_writer("shop_list1", root)(messages('[{"mtWmPoiId":"1"}]', "{}", '[{"mtWmPoiId":"2"', "no", None, "[]"), 0)
    assert spark.read.parquet(f"{root}/ods_shop_basic").count() == 1
    assert spark.read.parquet(f"{root}/rejected_shop_basic").where("sink = 'ods_shop_basic' AND reject_reason = 'not_an_array'").count() == 4
    lists = ['{"spuId":1}', '"[{"', "5", '"x"', "null", "[]", '[{"spuId":1}]', '"[{}]"']
    ingest.topic_writer("shop1", root)(messages(*(f'{{"mtWmPoiId":"1","itemList":{text}}}' for text in lists)), 0)
    assert spark.read.parquet(f"{root}/ods_item").count() == 2
    assert spark.read.parquet(f"{root}/ods_shop").count() == len(lists)
    kept = spark.read.parquet(f"{root}/rejected_item").where("sink = 'ods_item'").collect()
    assert len(kept) == 4 and all("itemList" in r.value for r in kept)


def test_a_batch_repeated_after_midnight_leaves_one_copy(spark, messages):
    root = scratch(spark, "topic")
    batch = messages('{"mtWmPoiId":"1"}', '{"mtWmPoiId":"1"}')
    for now in ("2024-06-01 23:59:59", "2024-06-02 00:00:01"):
        ingest.topic_writer("shop1", root, now)(batch, 3)
    found = spark.read.json(f"{root}/documents/doc_index=shop").collect()
    assert [str(r.doc_type) for r in found] == ["2024-06-02"] * 2
    assert spark.read.parquet(f"{root}/ods_shop").count() == 2


def test_documents_of_a_store_get_the_same_ids_again(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "s string, n int")
    root = scratch(spark, "store")
    for _ in range(2):
        write_documents(df, "", f"{root}/shop", "day", 5, connector="json")
    ids = [r.document_id for r in spark.read.json(f"{root}/shop/day").collect()]
    assert len(ids) == 6 and len(set(ids)) == 3


def test_shops_without_a_time_are_set_aside(spark, messages):
    root = scratch(spark, "shops")
    batch = partitioned_shops(messages('{"mtWmPoiId":"1","createTime":"2024-01-01 00:00:00"}', '{"mtWmPoiId":"2"}', "cut{"), delay=None)
    write_partitioned_shops(batch, f"{root}/t", f"{root}/r", 0)
    assert [r.wm_poi_id for r in spark.read.parquet(f"{root}/t").collect()] == ["1"]
    assert sorted(r.reject_reason for r in spark.read.parquet(f"{root}/r").collect()) == ["no_event_time", "not_an_object"]


def test_every_click_is_stored_or_set_aside(spark, messages):
    df = messages(CLICK.format(1, "a", "00:00:10"), CLICK.format(2, "a", "25:00:10"), "cut{", "", None, "[]")
    assert B.behaviors(df).count() == 1
    assert sorted(r.reject_reason for r in B.rejected_behaviors(df).collect()) == ["bad_time"] + ["not_an_object"] * 4


def test_partitions_of_a_topic_are_read_by_streams_of_their_own(spark):
    """A partition without a number is one too; each batch of each stream keeps to its bound."""
    root = scratch(spark, "parts")
    rows = [("t", str(i), f"v{i}", [0, 1, None][i % 3], i, None) for i in range(3000)] + [("u", "x", "other", 0, 1, None)]
    sent = spark.createDataFrame(rows, "topic string, key string, value string, partition int, offset long, timestamp timestamp").coalesce(1)
    write_topic(sent, path=f"{root}/topics", file_records=FILE_RECORDS, by_partition=True)
    parts = topic_parts(spark, "t", f"{root}/topics")
    assert len(parts) == 3 and topic_parts(spark, "none", f"{root}/topics") == []
    sizes, found = {}, []

    def reading(part):
        def write(batch, batch_id):
            got = batch.collect()
            sizes[part, batch_id] = len(got)
            found.extend((r.partition, r.offset) for r in got)

        stream = topic_stream(spark, ["t"], path=f"{root}/topics", max_per_trigger=FILE_RECORDS, part=part)
        return runs.into_batches(stream, write, f"{root}/checkpoint/{parts.index(part)}")

    runs.drain_all(reading(part) for part in parts)
    assert sorted(sizes.values()) == [500] * 6 and {part for part, _ in sizes} == set(parts)
    assert sorted(found, key=lambda r: r[1]) == [([0, 1, None][i % 3], i) for i in range(3000)]


def test_stages_beyond_the_compiler_run_operator_by_operator(spark):
    """A method of more bytecode is never compiled by HotSpot, and every message would be read by the interpreter."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_bounded_batch_is_one_file_and_a_local_checkpoint_is_kept_cheaply(spark, monkeypatch):
    """6 million clicks are 6,000 batches of a topic: what a batch costs beside its rows is most of the time."""
    root, at = scratch(spark, "bounded"), scratch(spark, "clicks")
    rows = spark.range(2500).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 2 AS user_id", "'view' AS event_type",
                                        "1.0D AS value", "concat('{\"k\": ', id, '}') AS props")
    rows.coalesce(1).write.parquet(f"{at}/events.parquet")
    monkeypatch.setattr(clicks_plan, "scratch", lambda spark, name: root)
    found = clicks_plan.topic_bounded(spark, at).collect()
    assert sorted(r.offset for r in found) == list(range(2500)) and {r.bound for r in found} == {2 * FILE_RECORDS}
    files = spark.read.parquet(f"{root}/out").select("stream", "batch_id", F.col("_metadata.file_path").alias("file")).distinct()
    assert files.count() == files.select("stream", "batch_id").distinct().count() > 2
    assert spark.conf.get("spark.sql.streaming.checkpointFileManagerClass").endswith(".FileSystemBasedCheckpointFileManager")


def test_a_batch_of_shops_is_held_without_the_cache_or_the_text_of_good_ones(spark, messages, monkeypatch):
    """The texts of all messages are most of a batch, and Spark's cache keeps what does not fit the heap on disk, not compressed."""
    root, held = scratch(spark, "shops"), []

    def watched(df):
        held.append(df)
        return stored_once(df)

    monkeypatch.setattr(shops, "stored_once", watched)
    texts = [f'{{"mtWmPoiId":"{i}","createTime":"2024-01-01 00:00:00"}}' for i in range(3)]
    batch = partitioned_shops(messages(*texts, texts[0], '{"mtWmPoiId":"7"}', "cut{"), delay=None)
    write_partitioned_shops(batch, f"{root}/t", f"{root}/r", 0)
    assert [r.value for r in held[0].where("reject_reason IS NULL").collect()] == [None] * 4
    assert sorted(r.wm_poi_id for r in spark.read.parquet(f"{root}/t").collect()) == ["0", "0", "1", "2"]
    assert sorted(map(tuple, spark.read.parquet(f"{root}/r").select("reject_reason", "value").collect())) == [("no_event_time", '{"mtWmPoiId":"7"}'), ("not_an_object", "cut{")]


def test_rows_stored_once_are_made_once_and_removed(spark):
    made = spark.sparkContext.accumulator(0)
    twice = F.udf(lambda i: made.add(1) or i * 2, "long")
    with stored_once(spark.range(5).select(twice("id").alias("n")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))) as rows:
        assert [sorted(r.n or 0 for r in rows.collect()) for _ in range(2)] == [[0, 0, 2, 4, 6, 8]] * 2
        assert rows.storageLevel == StorageLevel.NONE and made.value == 5
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, path)
    assert not path_exists(spark, path)


def test_streamed_documents_are_held_outside_the_cache(spark, messages, monkeypatch):
    root, held = scratch(spark, "docs"), []

    def watched(df):
        held.append(df)
        return stored_once(df)

    monkeypatch.setattr(documents, "stored_once", watched)
    write_json_texts(messages('{"a":1}', '{"a":1}', "x", None), f"{root}/d", "shop", "2024-06-01", 0, f"{root}/q")
    assert len(held) == 1 and held[0].storageLevel == StorageLevel.NONE
    assert [r.value for r in spark.read.text(f"{root}/d").collect()] == ['{"a":1}'] * 2 and spark.read.json(f"{root}/q").count() == 2
    assert all(f.endswith(".gz") for f in stored_files(spark, root))


def test_fan_out_holds_its_frames_outside_the_cache(spark, messages):
    seen = []

    def sink(df, batch_id):
        seen.append((df.storageLevel, df.count(), "InMemoryRelation" in df._jdf.queryExecution().toString()))

    fan_out([Branch(lambda b: b.select("value"), {"a": sink, "b": sink}), Branch(lambda b: b, {"c": sink}, hold=False)], at_once=2)(messages("{}", "{}"), 0)
    assert seen == [(StorageLevel.NONE, 2, False)] * 3


def test_outputs_of_the_same_numbers_are_judged_once(spark, messages):
    """The reasons of a table and its documents, where both read the same numbers, come from one expression."""
    told = records.judged(records.parsed_messages(messages('{"n":"x"}', '{"n":"1,000"}', '{"n":""}', "cut{"), (FIELD,), None), {"a": (FIELD, NAME), "b": (NAME, FIELD), "c": (NAME,)})
    rows = sorted(map(tuple, told.select("value", "reject_reason_a", "reject_reason_b", "reject_reason_c").collect()), key=str)
    assert rows == sorted([('{"n":"x"}', "bad_number:n", "bad_number:n", None), (None, None, None, None), (None, None, None, None), ("cut{", *["not_an_object"] * 3)], key=str)
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bad_number:n") == 1
