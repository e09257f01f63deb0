import json

from pyspark.sql import functions as F

from marketflow import schemas as S
from marketflow.functions import json_fields as J
from marketflow.operators import records as R


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_key_present_with_null_passes_and_missing_does_not(messages):
    df = messages('{"mtWmPoiId":null}', '{"other":1}', '{"mtWmPoiId":"7"}', "{}", "", None, "no json", '[{"mtWmPoiId":1}]')
    assert rows(R.with_key(df, "mtWmPoiId"), "key") == [("0",), ("2",)]


def test_value_not_null(messages):
    df = messages('{"itemList":null}', '{"itemList":[]}', "{}", '{"itemList":[1]', '{"itemList":"[]"}')
    assert rows(R.with_value(df, "itemList"), "key") == [("1",), ("4",)]


def test_numbers(spark):
    texts = ["12", "1,234", "12.7", "", "null", None, "abc", "-3", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = df.select(J.unboxed(t, "int"), J.boxed(t, "int"), J.boxed(t, "double"), J.bad_number(t, "int")).collect()
    assert [r[0] for r in got] == [12, 1234, 12, 0, 0, 0, 0, -3, 0]
    assert [r[1] for r in got] == [12, 1234, 12, None, None, None, None, -3, None]
    assert [r[2] for r in got] == [12.0, 1234.0, 12.7, None, None, None, None, -3.0, 99999999999.0]
    assert [r[3] for r in got] == [False] * 6 + [True, False, True]


def test_shop_record_defaults_and_rejects(messages):
    df = messages(
        '{"mtWmPoiId":"1","dpShopId":"12","minFee":"2.5","deliveryFee":{"a":1}}',
        '{"mtWmPoiId":2,"shopStatus":3,"onlinePay":1}',
        '{"mtWmPoiId":"3","dpShopId":"many"}',
        '{"mtWmPoiId":"4"', "", '{"shopName":"no key"}',
    )
    found = R.typed_records(df, S.SHOP, keep=["key"])
    good = rows(R.accepted(found), "key", "wm_poi_id", "dp_shop_id", "shop_status", "min_fee", "online_pay", "delivery_fee")
    assert good == [("0", "1", 12, 0, 2.5, None, '{"a":1}'), ("1", "2", 0, 3, None, 1, None)]
    assert rows(R.rejected(found), "key", R.REASON) == [("2", "bad_number:dp_shop_id"), ("3", "not_an_object"), ("4", "not_an_object")]


def test_explode_takes_objects_texts_and_arrays_sent_as_text(messages):
    element = json.dumps({"spuId": 5})
    df = messages(
        '{"itemList":[{"spuId":1},{"spuId":"2"}]}', json.dumps({"itemList": [element]}),
        json.dumps({"itemList": f"[{element}]"}), '{"itemList":[]}', '{"itemList":null}', "{}", '{"itemList":{"spuId":9}}',
        '{"itemList":[{"spuId":8}]', "", None,
    )
    assert rows(R.element_records(R.explode_property(df, "itemList"), S.RECORD_ITEM), "spu_id") == [(1,), (2,), (5,), (5,)]


def test_explode_message(messages):
    df = messages('[{"spuId":1},{"spuId":2}]', "[]", '{"spuId":3}', '[{"spuId":4}', None)
    assert rows(R.element_records(R.explode_message(df), S.RECORD_ITEM), "spu_id") == [(1,), (2,)]


def test_relation_keeps_parent_when_another_field_is_odd(messages):
    df = messages('{"mtWmPoiId":"1","shopName":"a","itemList":[{"spuId":1,"spuName":"x"}]}',
                  '{"mtWmPoiId":"2","shopName":"b","itemList":"[{\\"spuId\\":2}]"}')
    found = R.parent_children(df, S.RECORD_SHOP, S.RECORD_ITEM, "itemList")
    assert rows(found, "wm_poi_id", "shop_name", "spu_id", "spu_name") == [("1", "a", 1, "x"), ("2", "b", 2, None)]


def test_ignore_parse_errors(messages):
    df = messages('{"shopName":"a"}', "{", "[]", '{"mtWmPoiId":1}')
    fields = (S.Field("wm_poi_id", "mtWmPoiId"), S.Field("shop_name", "shopName"))
    assert rows(R.ignore_parse_errors(df, fields), "wm_poi_id", "shop_name") == [(None, "a"), ("1", None)]


def test_line_and_document(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "x string, y string, z double")
    assert R.delimited_line(df, ["z", "y", "x"]).first()[0] == "1.5\tnull\ta"
    both = df.select(R.json_document(df), R.json_document(df, nulls=True)).first()
    assert both[0] == '{"x":"a","z":1.5}' and json.loads(both[1]) == {"x": "a", "y": None, "z": 1.5}


def test_a_message_is_parsed_once(messages):
    plan = R.records_of(messages("{}"), S.SHOP)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
