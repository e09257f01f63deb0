import hashlib
import itertools

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketflow.functions import ids, text, times


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_lenient_partition_time(spark):
    cases = {
        "2021-01-10 14:45:00": "2021-01-10 14:45:00", "2021-13-01 00:00:00": "2022-01-01 00:00:00",
        "2021-02-32 25:61:61": "2021-03-05 02:02:01", "2021-4-5": "2021-04-05 00:00:00", "2021-04-05 1:2": None,
        "soon": None, "2024-02-30": "2024-03-01 00:00:00",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select(F.date_format(times.lenient_timestamp(F.col("t")), times.TIME_FORMAT)).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_partition_time_shift_and_longest_name_first(spark):
    parts = {"d": F.lit("x"), "dt": F.lit("2021-01-10"), "hr": F.lit("03"), "mm": F.lit("05")}
    at = times.partition_time(parts)
    assert one(spark, t=F.date_format(at, times.TIME_FORMAT)).t == "2021-01-09 19:05:00"


def test_times(spark):
    bad = F.lit("2021-13-01 00:00:00")
    row = one(
        spark, bad=times.parse_time(bad), filled=F.date_format(times.event_time(bad, F.lit("2021-01-01").cast("timestamp"), -8), "HH"),
        millis=times.epoch_millis(F.lit("1970-01-01 00:00:01")), day=times.bucket_date(F.lit("2021-01-01 17:00:00").cast("timestamp"), "Asia/Shanghai"),
        now=times.now_text(now="2021-05-06 07:08:09"), today=F.length(times.now_text(times.DATE_FORMAT)),
    )
    assert (row.bad, row.filled, row.millis, row.day, row.now, row.today) == (None, "16", 1000, "2021-01-02", "2021-05-06 07:08:09", 10)


def test_ids(spark):
    row = one(spark, a=ids.random_id(), b=ids.stable_id(F.lit("x"), F.lit("y")))
    assert len(row.a) == 32 and "-" not in row.a and row.b == hashlib.md5(b"x|y").hexdigest()


def test_lines(spark):
    cases = {"a\nb": ["a", "b"], "a\r\nb\rc\n": ["a", "b", "c"], "a\n\n": ["a", ""], "\n": [""], "": [], None: None, "a\n\rb": ["a", "", "b"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(text.lines(F.col("t"))).collect()] == list(cases.values())


def alignment(a, b):
    """Edits between two texts by the textbook table; no letter is edited twice."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=12, deadline=None)
@given(st.text("abcd", min_size=1, max_size=7), st.lists(st.text("abcd", max_size=8), min_size=40, max_size=80))
def test_within_edits(spark, term, words):
    words = [*words, *(term[:i] + w + term[i:] for i, w in enumerate(words[: len(term)]))]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select(*(text.within_edits(F.col("w"), term, n) for n in (0, 1, 2))).collect()
    assert [tuple(r) for r in got] == [tuple(alignment(w, term) <= n for n in (0, 1, 2)) for w in words]
