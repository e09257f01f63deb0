import datetime
import random

import pytest
from pyspark.sql import functions as F

from marketflow.operators import behavior, cdc, cells, dedup, grams, mutate, postings, ranking, search, views
from marketflow.plans import fixtures
from marketflow.session import scratch
from marketflow.sinks.bucketed import DocumentTable
from marketflow.sinks.cells import CellStore, bulk_load, newest
from marketflow.sinks.tables import read_table, write_ordered
from marketflow.sources.jdbc import records_since


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def scan_rows(node):
    """Rows that the scans of a plan that has run gave."""
    own = node.metrics().get("numOutputRows").get().value() if "Scan" in node.nodeName() else 0
    children = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.children().apply(i) for i in range(node.children().size())]
    return own + sum(map(scan_rows, children))


def as_set(df):
    return {tuple(r) for r in df.collect()}


# -- behavior

CLICK = '{{"sessionId":"{0}","userId":"u{0}","mtWmPoiId":"{1}","shopName":"s","platform":"{2}","source":"x","createTime":"{3}"}}'


def test_windows_take_the_first_event(messages):
    df = messages(
        CLICK.format(1, "a", "p1", "2024-01-01 00:01:59"), CLICK.format(2, "a", "p2", "2024-01-01 00:00:30"),
        CLICK.format(3, "a", "p3", "2024-01-01 00:00:30"), CLICK.format(4, "a", "p4", "2024-01-01 00:02:00"),
        CLICK.format(5, "b", "p5", "2024-13-01 00:00:00"), "no json", "",
    )
    got = behavior.shop_windows(behavior.behaviors(df)).orderBy("window_start").collect()
    assert [(r.session_id, r.platform, r.mm, r.action_num) for r in got] == [("2", "p2", "00", 3), ("4", "p4", "02", 1)]
    assert [r.window_end.minute for r in got] == [2, 4]


def test_ranks_break_ties_and_ids_are_stable(messages):
    clicks = [CLICK.format(i, shop, "p", "2024-01-01 00:00:00") for i, shop in enumerate("dcbaa")]
    windows = behavior.shop_windows(behavior.behaviors(messages(*clicks)))
    first, again = (behavior.ranked_shops(windows, 3).collect() for _ in range(2))
    assert [(r.mt_wm_poi_id, r.action_num) for r in sorted(first, key=lambda r: (-r.action_num, r.mt_wm_poi_id))] == [("a", 2), ("b", 1), ("c", 1)]
    assert {r.id for r in first} == {r.id for r in again} and {r.status for r in first} == {"1"}
    with_uuid = behavior.ranked_shops(windows, 3, F.expr("replace(uuid(), '-', '')")).collect()
    assert all(len(r.id) == 32 for r in with_uuid)


def test_rank_limit_runs_before_the_shuffle(messages):
    windows = behavior.shop_windows(behavior.behaviors(messages("{}")))
    plan = behavior.ranked_shops(windows, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# -- dedup and ranking


def test_one_per_key(spark):
    df = table(spark, "wm_poi_id string, dp_shop_id int, a string, n int", ("1", 1, "b", None), ("1", 1, "a", 5), ("2", 1, None, None))
    assert as_set(dedup.one_per_key(df)) == {("1", 1, "a", 5), ("2", 1, None, None)}
    assert as_set(dedup.one_per_key(df, pick="any")) <= {("1", 1, "a", 5), ("1", 1, "b", 5), ("2", 1, None, None)}


def test_latest_per_key_keeps_rows_whole(spark):
    df = table(spark, "k int, v string, create_time string", (1, "z", "2024-01-01"), (1, "a", "2024-01-02"), (1, "b", "2024-01-02"), (2, "n", None))
    assert as_set(dedup.latest_per_key(df, ["k"])) == {(1, "b", "2024-01-02"), (2, "n", None)}


def test_top_rows_pages(spark):
    df = spark.range(10)
    assert [r.id for r in ranking.top_rows(df, 3, [F.desc("id")], 2).collect()] == [7, 6, 5]


# -- cells


def test_cells(spark):
    df = table(spark, "wm_poi_id string, shop_name string, shop_status int, shop_pic string", ("2", "b", 1, None), (None, "x", 1, "p"), ("10", "a", 2, "q"))
    got = [tuple(r) for r in cells.sort_cells(cells.to_cells(df)).collect()]
    assert got == [
        ("10", "info", "shop_name", "a"), ("10", "info", "shop_pic", "q"), ("10", "info", "shop_status", "2"), ("10", "info", "wm_poi_id", "10"),
        ("2", "info", "shop_name", "b"), ("2", "info", "shop_status", "1"), ("2", "info", "wm_poi_id", "2"),
    ]


def test_one_hot_row_key_is_spread_over_partitions(spark):
    df = spark.range(3000).select(F.lit("hot").alias("rowkey"), F.lit("info").alias("family"), F.lit("q").alias("qualifier"), F.col("id").cast("string").alias("value"))
    spread = cells.sort_cells(df, 6).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 5 and max(r[1] for r in spread) < 1500 and sum(r[1] for r in spread) == 3000


@pytest.fixture
def store(spark):
    """Two loads: cells of 500 row keys, one of which has most of them; then new values for some."""
    store = CellStore(spark, scratch(spark, "cells"))
    ids = spark.range(5000).select(F.when(F.col("id") < 500, F.lpad(F.col("id").cast("string"), 3, "0")).otherwise(F.lit("250")).alias("rowkey"),
                                   F.lit("info").alias("family"), F.concat(F.lit("q"), F.col("id")).alias("qualifier"), F.col("id").cast("string").alias("value"))
    store.load(ids, 0, files=6)
    store.load(ids.where("rowkey = '250' AND value < 600").withColumn("value", F.lit("new")), 1, files=1)
    return store, ids


def test_files_of_a_load_hold_sorted_and_disjoint_ranges(spark, store):
    store, ids = store
    assert as_set(store.cells().where("load = 0").drop("load")) == as_set(ids) and store.cells().count() == 5101
    ranges = sorted(store.ranges().where("load = 0").collect(), key=lambda r: r.first)
    assert len(ranges) >= 5 and sum(r.cells for r in ranges) == 5000
    assert all(a.last < b.first for a, b in zip(ranges, ranges[1:])) and max(r.cells for r in ranges) < 2000
    for r in ranges:
        cells = [tuple(c)[:3] for c in spark.read.parquet(r.file).collect()]
        assert cells == sorted(cells) and (cells[0], cells[-1]) == (tuple(r.first), tuple(r.last))


def test_a_scan_opens_the_files_of_its_range_only(store):
    store, ids = store
    everything = set(store.files())
    for start, stop in (("000", "010"), ("400", None), (None, "003"), ("250", "251"), ("9", None), (None, None), ("100", "100")):
        found = store.scan(start, stop)
        wanted = ids.where(F.lit(True) if start is None else F.col("rowkey") >= start).where(F.lit(True) if stop is None else F.col("rowkey") < stop)
        assert as_set(found.where("load = 0").drop("load")) == as_set(wanted)
        assert set(store.files(start, stop)) <= everything and found.inputFiles() is not None
    assert len(store.files("000", "010")) == 1 and len(store.files("250", "251")) >= 4 and store.files("9") == []


def test_single_row_keys_and_their_newest_cells(store):
    store, ids = store
    found = {(r.rowkey, r.qualifier): r.value for r in newest(store.get(["003", "250", "none"])).collect()}
    old = {(r.rowkey, r.qualifier): r.value for r in ids.where("rowkey IN ('003', '250')").collect()}
    assert found == {k: "new" if k[0] == "250" and int(v) < 600 else v for k, v in old.items()}
    assert store.get([]).count() == 0 and len(set(store.get(["003"]).inputFiles())) == 1


def test_a_repeated_load_replaces_itself(spark, store):
    store, ids = store
    store.load(ids.where("rowkey = '007'"), 1, files=3)
    assert store.cells().where("load = 1").count() == 1 and store.cells().where("load = 0").count() == 5000
    store.load(ids.limit(0), 1)
    assert store.cells().where("load = 1").count() == 0
    empty = CellStore(spark, scratch(spark, "cells"))
    empty.load(ids.limit(0))
    assert empty.cells().count() == 0 and empty.scan("a").count() == 0


def test_short_lines_are_set_aside(spark):
    df = table(spark, "value string", ("1\tx\tn\ts\tp",), ("1\tx\tn\ts\t\t",), ("1\tx\tn",), ("",), (None,), ("2\t\t\t\tp\textra",))
    good, short = cells.split_fields(df, cells.SHOP_LINE_POSITIONS)
    assert as_set(good) == {("1", "n", "s", "p"), ("2", "", "", "p")}
    assert short.count() == 4


def test_a_bulk_load_needs_its_arguments(spark, tmp_path):
    for blank in ("", "  ", None):
        with pytest.raises(ValueError, match="blank arguments: target, table"):
            bulk_load(spark, "lines", blank, blank)
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("2\tx\tn\ts\tp\n1\tx\tn\n10\t\tm\t\tq\n")
    store, short = bulk_load(spark, str(tmp_path / "lines"), str(tmp_path), "shops")
    assert [tuple(r)[0::3] for r in store.get(["10"]).drop("load").orderBy("qualifier").collect()] == [("10", "m"), ("10", "q"), ("10", ""), ("10", "10")]
    assert as_set(short) == {("1\tx\tn",)} and store.cells().count() == 8


# -- views


def test_views_are_named_for_sql(spark):
    views.name_views({"left_rows": spark.range(4), "right_rows": spark.range(2, 6)})
    assert as_set(views.query(spark, "SELECT l.id FROM left_rows l JOIN right_rows r USING (id)")) == {(2,), (3,)}
    assert views.query(spark, "SELECT count(*) AS n FROM left_rows", {"left_rows": spark.range(9)}).first().n == 9
    views.drop_views(spark, "left_rows", "right_rows", "never_named")
    with pytest.raises(Exception, match="left_rows"):
        spark.sql("SELECT * FROM left_rows").collect()


# -- tables by time


def test_a_large_table_by_time_is_written_range_by_range(spark):
    """The shuffle of wide rows takes more disk than the table: with rounds only that of one range exists at a time."""
    path = scratch(spark, "rounds")
    rows = spark.range(0, 10_000, 1, 4).selectExpr("CAST(id AS STRING) AS response", "CASE WHEN id % 10 <> 3 THEN CAST((id * 7919) % 500 AS STRING) END AS create_time")
    write_ordered(rows, path, "create_time", round_rows=1500)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    jobs = back.select(F.regexp_extract(F.input_file_name(), "part-[0-9]+-(.*)-c[0-9]+", 1).alias("job"), "create_time")
    bounds = sorted(tuple(r)[1:] for r in jobs.where("create_time IS NOT NULL").groupBy("job").agg(F.min("create_time"), F.max("create_time")).collect())
    assert len(bounds) >= 5 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    write_ordered(rows.limit(0), path, "create_time", round_rows=1500)
    assert spark.read.schema(rows.schema).parquet(path).count() == 0
    write_ordered(rows.withColumn("create_time", F.lit("same")), path, "create_time", round_rows=1500)
    assert spark.read.parquet(path).count() == 10_000


def test_a_filter_on_time_skips_files_and_row_groups(spark):
    path = scratch(spark, "ordered")
    rows = spark.range(0, 60_000, 1, 4).select(F.concat(F.lit("{"), F.sha2(F.col("id").cast("string"), 256)).alias("response"), F.lit("q").alias("request"),
                                               F.date_format(F.timestamp_seconds(F.lit(1_600_000_000) + (F.col("id") * 7919) % 60_000), "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    write_ordered(rows, path, "create_time", group_bytes=64 << 10)
    since = "2020-09-14 03:40:00"
    found = records_since(read_table(spark, path, "response string, request string, create_time string"), since)
    plan = found._jdf.queryExecution().executedPlan()
    assert f"GreaterThan(create_time,{since})" in plan.toString().split("PushedFilters: ")[1]
    assert as_set(found) == as_set(rows.where(F.col("create_time") > since).select("response", "request", "create_time")) and found.count() > 5000
    found.collect()

    again = records_since(read_table(spark, path, "response string, request string, create_time string"), since)
    again._jdf.collect()
    assert found.count() <= scan_rows(again._jdf.queryExecution().executedPlan()) < 30_000


# -- keyed changes


def stored(spark):
    return table(spark, "id int, a string, b string", (1, "a1", "b1"), (2, "a2", "b2"))


def test_upsert_merges_and_adds(spark):
    changes = table(spark, "id int, a string, at int", (1, None, 1), (2, "old", 1), (2, "new", 2), (3, "a3", 1), (None, "lost", 1))
    assert as_set(mutate.upsert(stored(spark), changes, "id", "at")) == {(1, "a1", "b1"), (2, "new", "b2"), (3, "a3", None)}


def test_upsert_moves_a_stored_order_on(spark):
    old = table(spark, "id int, a string, at string", (1, "a", "2024-01-01"))
    changes = table(spark, "id int, a string, at string", (1, "b", "2024-02-01"), (2, "c", "2024-02-02"))
    assert as_set(mutate.upsert(old, changes, "id", "at")) == {(1, "b", "2024-02-01"), (2, "c", "2024-02-02")}


def test_small_changes_do_not_move_the_stored_rows(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(200_000).select("id", F.col("id").cast("string").alias("a")).write.parquet(path)
    spark.createDataFrame([(1, "x"), (-1, "y")], "id long, a string").write.parquet(path + "_changes")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        merged = mutate.upsert(spark.read.parquet(path), spark.read.parquet(path + "_changes"), "id")
        assert merged.count() == 200_001
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_partial_update_adds_fields_but_no_rows(spark):
    changes = table(spark, "id int, c string", (2, "c2"), (9, "c9"))
    assert as_set(mutate.partial_update(stored(spark), changes, "id")) == {(1, "a1", "b1", None), (2, "a2", "b2", "c2")}


def test_put_delete_get(spark):
    rows = table(spark, "id int, a string", (2, "n2"), (3, "n3"))
    assert as_set(mutate.put(stored(spark), rows, "id")) == {(1, "a1", "b1"), (2, "n2", None), (3, "n3", None)}
    assert as_set(mutate.delete(stored(spark), rows, "id")) == {(1, "a1", "b1")}
    assert as_set(mutate.get_many(stored(spark), [2, 7], "id")) == {(2, '{"id":2,"a":"a2","b":"b2"}')}
    assert as_set(mutate.get_many(stored(spark), rows, "id")) == {(2, '{"id":2,"a":"a2","b":"b2"}')}


@pytest.fixture
def documents(spark):
    path = scratch(spark, "bucketed")
    rows = spark.range(20_000).select("id", F.concat(F.lit("a"), "id").alias("a"), F.col("id").cast("string").alias("b"))
    table = DocumentTable(spark, f"documents_{path[-12:]}", "id", 8).write(rows, path)
    yield table
    spark.sql(f"DROP TABLE {table.name}")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_one_key_opens_one_bucket(spark, documents):
    """The scan gives an eighth of the rows that it gives without regard to buckets."""

    def scanned():
        found = documents.lookup(77)
        assert [tuple(r) for r in found.collect()] == [(77, "a77", "77")]
        found = documents.lookup(77)
        found._jdf.collect()
        return scan_rows(found._jdf.queryExecution().executedPlan())

    own = scanned()
    spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
    try:
        assert 0 < 6 * own < scanned()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.enabled")
    assert documents.get([5, -1]).count() == 1 and len(documents.rows.inputFiles()) == 8


def test_stored_buckets_are_joined_where_they_lie(spark, documents):
    """With changes too large to broadcast: no shuffle above the stored side, whose scan is by buckets."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = spark.range(10_000, 30_000).select("id", F.lit("new").alias("a"))
        results = {"put": documents.put(changes), "delete": documents.delete(changes), "get": documents.get(changes), "upsert": documents.upsert(changes)}
        plans = {name: plan_of(df) for name, df in results.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {name: df.count() for name, df in results.items()} == {"put": 30_000, "delete": 10_000, "get": 10_000, "upsert": 30_000}
    assert results["upsert"].where("a = 'new' AND b IS NOT NULL").count() == 10_000 and results["put"].where("a = 'new' AND b IS NOT NULL").count() == 0
    for name, plan in plans.items():
        lines = plan.splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
        assert scans and "Join" in plan, name
        for i in scans:
            depth = lines[i].index("FileScan")
            for line in reversed(lines[:i]):  # up to the join over this scan
                at = len(line) - len(line.lstrip(" :+-*0123456789()"))
                if at < depth:
                    assert "Exchange" not in line, (name, line)
                    depth = at
                    if "Join" in line:
                        break


# -- change messages


def test_route(messages):
    df = messages('{"table":"users","data":1}', '{"table":"other"}', '{"table":null}', "{}", "null", "", "x", '{"table":7}', '["table"]')
    assert as_set(cdc.route(df, ["users"])) == {("ods_users", "0", '{"table":"users","data":1}')}


# -- search


@pytest.fixture
def docs(spark):
    return table(
        spark, "id int, title string, body string", (1, "Red apple", "an apple a day"), (2, "green pear", None),
        (3, "apple apple", "pear"), (4, None, "unrelated words"), (5, "Äpfel", "pineapple"),
    )


def ids_of(df):
    return [r.id for r in df.collect()]


def test_match_scores_and_pages(docs):
    hits = search.match(docs, "APPLE, pear", ["title", "body"])
    assert sorted(ids_of(hits)) == [1, 2, 3]
    assert ids_of(search.page(hits, "id", 1, 1)) == ids_of(search.page(hits, "id"))[1:2]
    assert search.hit_count(hits).first().hits == 3
    assert search.match(docs, " ,. ", ["title"]).count() == 0


def test_best_field_decides(docs):
    by_field = {f: {r.id: r.score for r in search.match(docs, "apple", [f]).collect()} for f in ("title", "body")}
    both = {r.id: r.score for r in search.match(docs, "apple", ["title", "body"]).collect()}
    assert both == {i: max(by_field["title"].get(i, 0), by_field["body"].get(i, 0)) for i in (1, 3)}


def test_term_wildcard_fuzzy(docs):
    assert ids_of(search.term(docs, "title", "äpfel")) == [5]
    assert ids_of(search.term(docs, "title", "Red apple")) == []
    assert ids_of(search.wildcard(docs, "body", "appl")) == [1, 5]
    assert ids_of(search.wildcard(docs, "body", "p?ne*l")) == [5]
    assert ids_of(search.fuzzy(docs, "title", "paer")) == [2]
    assert ids_of(search.fuzzy(docs, "title", "appel")) == [1, 3]
    assert ids_of(search.fuzzy(docs, "title", "pe")) == []


def test_all_fields(docs):
    assert sorted(ids_of(search.match_all_fields(docs, ["title", "body"], must=["apple"], must_not=["pear"]))) == [1]
    assert sorted(ids_of(search.match_all_fields(docs, ["title", "body"], should=["apple", "pear"]))) == [1, 2, 3]
    with pytest.raises(ValueError):
        search.match_all_fields(docs, ["title"], must_not=["apple"])


def test_highlight(spark):
    df = table(spark, "t string", ("Apple apple-pie, pineapple äpple",), (None,))
    marked = [r[0] for r in df.select(search.highlight(F.col("t"), ["apple", "äpple"])).collect()]
    on, off = search.PRE_TAG, search.POST_TAG
    assert marked == [f"{on}Apple{off} {on}apple{off}-pie, pineapple {on}äpple{off}", None]


@pytest.fixture
def index(spark, docs):
    fields = {"title": F.col("title"), "body": F.col("body"), "all": F.concat_ws(" ", "title", "body")}
    return postings.build_postings(docs, fields, scratch(spark, "postings"), "id")


def scores(df):
    return {r.id: r.score for r in df.collect()}


def test_the_index_answers_as_the_scan_does(docs, index):
    for query in ("APPLE, pear", "apple", "absent", " ,. "):
        for fields in (["title"], ["title", "body"]):
            assert scores(postings.match(index, query, fields)) == scores(search.match(docs, query, fields))
    assert scores(postings.term(index, "title", "äpfel")) == scores(search.term(docs, "title", "äpfel"))
    for value in ("paer", "appel", "pe"):
        assert sorted(ids_of(postings.fuzzy(index, "title", value))) == sorted(ids_of(search.fuzzy(docs, "title", value)))
    for parts in ({"must": ["apple"], "must_not": ["pear"]}, {"should": ["apple", "pear"]}):
        assert scores(postings.match_combined(index, "all", **parts)) == scores(search.match_all_fields(docs, ["title", "body"], **parts))
    assert sorted((r.field, r.documents, r.tokens) for r in index.totals.collect()) == [("all", 5, 15), ("body", 4, 8), ("title", 4, 7)]


def test_a_query_reads_its_terms_only(index):
    plan = postings.match(index, "apple pear", ["title"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(field" in plan and "In(term, [apple,pear])" in plan


def test_an_index_of_no_documents(spark, docs):
    empty = postings.build_postings(docs.where("id < 0"), {"title": F.col("title")}, scratch(spark, "postings"), "id")
    assert postings.match(empty, "apple", ["title"]).count() == 0



def test_a_block_of_documents_counts_as_rows_of_tokens_do(spark, monkeypatch):
    """Blocks of any size, of columns and of columns together, hold what a shuffle of all tokens finds; the shuffle carries blocks."""
    rows = [(1, "Äpfel, äpfel und\u00a0Birnen", "b"), (2, None, "x\u0870y"), (3, "", None), (4, " ,-", ""), (5, "a1 \U00010400\U00010428 a1\nb", "a"), (None, "b b", "b a b")]
    docs = spark.createDataFrame(rows + [(i, "und b", "und") for i in range(6, 40)], "id long, title string, body string").coalesce(2)
    fields = {"title": F.col("title"), "body": ["body"], "all": ["title", "body"]}
    for size in (1, 1 << 24):
        monkeypatch.setattr(postings, "BLOCK_BYTES", size)
        for places in (False, True):
            found, wanted = (make(docs, fields, "id", places).select("field", "term", F.explode("postings")) for make in (postings._in_place, postings._by_shuffle))
            assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    index = postings.build_postings(docs, fields, scratch(spark, "postings"), "id")
    blocks, terms = index.blocks.where("field = 'all' AND term = 'und'"), index.terms.where("field = 'all' AND term = 'und'")
    assert blocks.count() <= 2 and terms.count() == 35
    assert [(r.documents, r.occurrences) for r in index.vocabulary.where("field = 'all' AND term = 'und'").collect()] == [(35, 69)]


def test_ids_that_repeat_are_indexed_by_id(spark):
    """Rows of an id with as many tokens are one document, others are documents of their own; null is an id too."""
    rows = [(1, "a b"), (1, "a c"), (1, "a"), (2, "a a"), (None, "a b"), (None, "b b")]
    docs = spark.createDataFrame(rows, "id long, body string")
    index = postings.build_places(docs, {"body": ["body"]}, postings.build_postings(docs, {"body": ["body"]}, scratch(spark, "postings"), "id"))
    assert sorted(map(repr, (tuple(r) for r in index.terms.where("term = 'a'").select("id", "length", "tf").collect()))) == sorted(map(repr, [(1, 2, 2), (1, 1, 1), (2, 2, 2), (None, 2, 1)]))
    assert [(r.documents, r.occurrences) for r in index.vocabulary.where("term = 'b'").collect()] == [(2, 4)]
    assert sorted(r.places for r in index.places.where("id = 1").collect()) == [[0, 0, 0], [1], [1]]


def test_what_a_message_holds_several_times_is_made_once(spark):
    """The time of a shop message stands in the shop, its items and its coupon, and is formatted in one place of the plan per kind of line."""
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    rows = [(1, 2, 3, 4, 5.0, 6.0, 0.04, 0.03, "A", status, datetime.date(1995, 5, 17)) for status in "FO"]
    made = fixtures.shop_messages(spark.createDataFrame(rows, columns))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format(cast((date_trunc(month") + plan.count("date_format((date_trunc(month") <= 2
    for row in made.collect():
        assert row.value.count("1995-05-01 02:00:00") == 4 and row.value.count("shop_4") == 4


# -- runs of letters


def near(a, b):
    """Edits between two words: insertions, deletions, replacements and swaps of neighbours, no letter edited twice."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def test_no_near_word_shares_too_few_runs():
    """Every word that some edits make out of another passes the count; words that pass at no count are said to."""
    draw = random.Random(4)
    for _ in range(3000):
        value = "".join(draw.choices("abcde", k=draw.randrange(1, 9)))
        other = value
        for _ in range(draw.randrange(3)):
            i = draw.randrange(len(other) + 1)
            other = draw.choice([other[:i] + "x" + other[i:], other[:i] + other[i + 1 :], other[:i] + "y" + other[i + 1 :], other[:i] + other[i + 1 : i + 2] + other[i : i + 1] + other[i + 2 :]])
        for edits in (1, 2):
            wanted = grams.near_runs(value, edits)
            if wanted is not None and near(other, value) <= edits:
                own = grams.runs_of(f"^{other}$", 2)
                assert any(len(own & pairs) >= least for pairs, least in wanted), (value, other, edits)


def test_a_block_of_runs_holds_plain_terms(spark):
    """The shuffle carries a term alone for each of its runs; its letters are counted when it is read."""
    blocks = grams.gram_table(spark.createDataFrame([("t", "a\U00010400b"), ("all", "a\U00010400b"), ("t", "ab")], "field string, term string"))
    assert blocks.schema["terms"].dataType.simpleString() == "array<string>"
    rows = grams.spread_grams(blocks).where("gram = '^a'").select("field", "size", "term", "letters").collect()
    assert sorted(map(tuple, rows)) == [("all", 2, "a\U00010400b", 3), ("t", 2, "ab", 2), ("t", 2, "a\U00010400b", 3)]


def test_runs_a_pattern_needs():
    assert grams.contained_runs("thle") == {"thl", "hle"} and grams.contained_runs("ti?n*er") == {"ti", "er"} and grams.contained_runs("a*b?") == set()


@pytest.fixture
def words(spark):
    draw = random.Random(9)
    texts = [" ".join("".join(draw.choices("abcdel", k=draw.randrange(1, 9))) for _ in range(30)) for _ in range(60)]
    docs = table(spark, "id int, body string", *enumerate([*texts, None, "", "İstanbul ÄPFEL 漢字"]))
    return docs, postings.build_postings(docs, {"body": F.col("body")}, scratch(spark, "postings"), "id")


@pytest.mark.parametrize("content", ["abc", "ab", "a", "a?c", "ab*de", "*", "a*b", "zz", "pfel", "漢", "AB", "a b", ""])
def test_wildcards_from_the_index_are_those_of_the_texts(words, content):
    docs, index = words
    assert sorted(ids_of(postings.wildcard(index, "body", content))) == sorted(ids_of(search.wildcard(docs, "body", content)))


@pytest.mark.parametrize("value", ["abcde", "abdce", "ab", "abc", "edcbal", "lledcb", "äpfle", "zzzzzz", "abcdeabc"])
def test_near_terms_from_the_index_are_those_of_the_texts(words, value):
    docs, index = words
    for edits in (None, 1, 2):
        assert sorted(ids_of(postings.fuzzy(index, "body", value, edits))) == sorted(ids_of(search.fuzzy(docs, "body", value, edits)))


@pytest.mark.parametrize("query", ["a b a", "b", "a a", "c, A b", "z", "", "a b c a b c a b c"])
def test_phrases_from_the_index_are_those_of_the_texts(spark, query):
    draw = random.Random(3)
    docs = table(spark, "id int, body string", *enumerate([" ".join(draw.choices("abc", k=draw.randrange(40))) for _ in range(40)] + [None, "", "x-a.b a;b"]))
    index = postings.build_places(docs, {"body": F.col("body")}, postings.build_postings(docs, {"body": F.col("body")}, scratch(spark, "postings"), "id"))
    words = search.query_tokens(query)
    wanted = {}
    for d in docs.collect():
        own = search.query_tokens(d.body or "")
        n = sum(own[i : i + len(words)] == words for i in range(len(own))) if words else 0
        if n:
            wanted[d.id] = n
    for found in (postings.phrase(index, query, "body"), search.phrase(docs, "body", query)):
        assert {r.id: r.occurrences for r in found.collect()} == wanted


def test_many_terms_are_joined(words, monkeypatch):
    docs, index = words
    monkeypatch.setattr(postings, "LITERAL_TERMS", 2)
    assert sorted(ids_of(postings.wildcard(index, "body", "ab"))) == sorted(ids_of(search.wildcard(docs, "body", "ab")))


def test_searches_by_runs_read_no_text(spark):
    from marketflow.plans import search as plans

    sf_dir = "/root/testdata/sf0.001"
    for query in (plans.search_wildcard, plans.search_wildcard_pattern, plans.search_fuzzy):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        read = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
        assert read and not any("text:string" in line for line in read)
    index = plans._index(spark, sf_dir)
    for terms in (postings.wildcard_terms(index, "text", "thle"), postings.fuzzy_terms(index, "text", "lisence")):
        plan = terms._jdf.queryExecution().executedPlan().toString()
        assert "In(gram, [" in plan and all("/grams/" in path for path in terms.inputFiles())
    wanted = grams.near_runs("lisence", 2)
    tested = grams.sharing(index.grams, "text", "lisence", 2, wanted).count()
    assert tested < 0.05 * index.vocabulary.where("field = 'text'").count()


def test_many_terms_join_blocks_before_these_are_spread(spark, monkeypatch):
    """Found terms beyond the literals meet a row per block, not one per document; of the postings only ids are read."""
    docs = spark.createDataFrame([(i, f"part{i} word{i % 3}") for i in range(40)], "id long, body string")
    index = postings.build_postings(docs, {"body": F.col("body")}, scratch(spark, "postings"), "id")
    monkeypatch.setattr(postings, "LITERAL_TERMS", 2)
    found = postings.wildcard(index, "body", "part")
    assert sorted(r.id for r in found.collect()) == list(range(40))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate") < plan.index("LeftSemi")
    assert "postings:array<struct<id:bigint>>" in found._jdf.queryExecution().executedPlan().toString()
