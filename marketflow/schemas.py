"""Record types: output column, JSON key, kind.

Kinds: ``text``; ``int0 long0 double0`` (0 when missing); ``int long double``
(NULL when missing); ``now`` (time of processing); ``long0>double`` (whole
number stored as double).
"""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    name: str
    key: str
    kind: str = "text"

    @property
    def type(self) -> str:
        if self.kind in ("text", "now"):
            return "string"
        return self.kind.split(">")[-1].removesuffix("0")


def _fields(*rows: tuple[str, ...]) -> tuple[Field, ...]:
    return tuple(Field(*row) for row in rows)


# The column names, JSON keys and number kinds of the records.
SHOP = _fields(
    ("wm_poi_id", "mtWmPoiId"),
    ("dp_shop_id", "dpShopId", "int0"),
    ("shop_name", "shopName"),
    ("shop_status", "shopStatus", "int0"),
    ("shop_pic", "shopPic"),
    ("delivery_fee", "deliveryFee"),
    ("delivery_type", "deliveryType"),
    ("delivery_time", "deliveryTime"),
    ("min_fee", "minFee", "double"),
    ("online_pay", "onlinePay", "int"),
    ("bulletin", "bulletin"),
    ("shipping_time", "shipping_time"),
    ("create_time", "createTime"),
)
SHOP_DOC = _fields(
    ("wm_poi_id", "mtWmPoiId"),
    ("dp_shop_id", "dpShopId", "int0"),
    ("shop_name", "shopName"),
    ("shop_status", "shopStatus", "int0"),
    ("shop_pic", "shopPic"),
    ("delivery_fee", "deliveryFee", "int0"),
    ("delivery_type", "deliveryType", "int0"),
    ("delivery_time", "deliveryTime"),
    ("delivery_msg", "deliveryMsg"),
    ("min_fee", "minFee", "double0"),
    ("online_pay", "onlinePay", "int0"),
    ("bulletin", "bulletin"),
    ("shipping_time", "shipping_time"),
    ("create_time", "createTime"),
    ("update_time", "", "now"),
)
ITEM = _fields(
    ("wm_poi_id", "mtWmPoiId"),
    ("dp_shop_id", "dpShopId", "int0"),
    ("shop_name", "shopName"),
    ("spu_id", "spuId", "long0"),
    ("spu_name", "spuName"),
    ("unit", "unit"),
    ("tag", "tag"),
    ("activity_tag", "activityTag"),
    ("little_image", "littleImageUrl"),
    ("big_image", "bigImageUrl"),
    ("origin_price", "originPrice", "double0"),
    ("current_price", "currentPrice", "double0"),
    ("spu_desc", "spuDesc"),
    ("praise_num", "praiseNum", "long0"),
    ("activity_type", "activityType", "long0"),
    ("spu_promotion_info", "spuPromotionInfo"),
    ("status_desc", "statusDesc"),
    ("category_name", "categoryName"),
    ("category_type", "categoryType"),
    ("create_time", "createTime"),
)
ITEM_DOC = ITEM + _fields(("update_time", "", "now"))
COUPON = _fields(
    ("wm_poi_id", "mtWmPoiId"),
    ("dp_shop_id", "dpShopId", "int0"),
    ("shop_name", "shopName"),
    ("coupon_id", "couponId", "long0"),
    ("coupon_pool_id", "couponPoolId", "long0"),
    ("activity_id", "activityId", "long0"),
    ("coupon_value", "couponValue", "double0"),
    ("coupon_condition_text", "couponConditionText"),
    ("coupon_valid_time_text", "couponValidTimeText"),
    ("coupon_status", "couponStatus"),
    ("limit_new_user", "limitNewUser"),
    ("create_time", "createTime"),
)
COUPON_DOC = COUPON + _fields(("update_time", "", "now"))
SHOP_BASIC = _fields(
    ("wm_poi_id", "mtWmPoiId"),
    ("shop_name", "shopName"),
    ("status_desc", "statusDesc"),
    ("address", "address"),
    ("pic_url", "picUrl"),
    ("wm_poi_score", "wmPoiScore", "int0"),
    ("shipping_time", "shipping_time"),
    ("status", "status", "int0"),
    ("create_time", "createTime"),
)
SHOP_BASIC_DOC = SHOP_BASIC[:-1] + _fields(("create_time", "", "now"), ("update_time", "", "now"))
SHOP_COMMENT = _fields(
    ("shop_id", "shopId", "long"),
    ("wm_poi_id", "mtWmPoiId"),
    ("record_count", "recordCount", "long0"),
    ("dp_comment_num", "dpCommentNum", "long0"),
    ("praise_ratio", "PraiseRatio"),
    ("quality_score", "qualityScore", "double0"),
    ("pack_score", "packScore", "double0"),
    ("integrated_score", "integratedScore", "double0"),
    ("shop_score", "shopScore", "double0"),
    ("delivery_score", "deliveryScore", "double0"),
    ("comment_labels", "commentLabels"),
    ("create_time", "createTime"),
)
SHOP_COMMENT_DOC = SHOP_COMMENT + _fields(("update_time", "", "now"))
USER_COMMENT = _fields(
    ("shop_id", "shopId", "long0"),
    ("wm_poi_id", "mtWmPoiId"),
    ("user_id", "userID", "long0"),
    ("user_name", "userName"),
    ("user_pic_url", "userPicUrl"),
    ("comment_time", "commentTime"),
    ("score", "score", "long0>double"),
    ("delivery_time", "deliveryTime"),
    ("content", "content"),
    ("shop_reply", "shopReply"),
    ("is_anonymous", "isAnonymous", "long0"),
    ("pictures", "originalPicUrls"),
    ("create_time", "", "now"),
)
USER_COMMENT_DOC = tuple(f._replace(kind="long0") if f.name == "score" else f for f in USER_COMMENT) + _fields(
    ("update_time", "", "now")
)
BEHAVIOR = _fields(
    ("session_id", "sessionId"),
    ("user_id", "userId"),
    ("mt_wm_poi_id", "mtWmPoiId"),
    ("shop_name", "shopName"),
    ("source", "source"),
    ("platform", "platform"),
    ("create_time", "createTime"),
)
RECORD_SHOP = _fields(("wm_poi_id", "mtWmPoiId"), ("shop_name", "shopName"))
RECORD_ITEM = _fields(("spu_id", "spuId", "long"), ("spu_name", "spuName"))

# Columns of the ranked sink, of the delimited shop line and of a topic.
TOP_SHOP_COLUMNS = ("id", "mt_wm_poi_id", "shop_name", "source", "platform", "time_key", "action_num", "status")
SHOP_LINE_COLUMNS = (
    "dp_shop_id", "wm_poi_id", "shop_name", "shop_status", "shop_pic", "delivery_fee", "delivery_time",
    "delivery_type", "min_fee", "online_pay", "shipping_time", "bulletin", "create_time",
)
SHOP_KEY = "mtWmPoiId"
TOPIC_SCHEMA = "topic string, key string, value string, partition int, offset long, timestamp timestamp"


def columns(fields: tuple[Field, ...]) -> list[str]:
    return [f.name for f in fields]


def ddl(fields: tuple[Field, ...], extra: str = "") -> str:
    """Schema text of the stored table."""
    return ", ".join([*(f"{f.name} {f.type}" for f in fields), *filter(None, [extra])])
