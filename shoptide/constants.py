"""Settings and labels shared by the operators."""

from __future__ import annotations

# They decide results or are part of them, so they are stated as they must appear.
STARTUP_TYPE = "startup"
EVENT_ITEM_VIEW = "clickItem"
EVENT_COUPON = "coupon"
PHONE_KEEP = 4
PHONE_STARS = "*******"
DAYS_PER_AGE_YEAR = 365
ALERT_MIN_ACCOUNTS = 3
ALERT_WINDOW_S = 300
ALERT_SLIDE_S = 5
JOIN_BOUND_S = 100
TRIGGER_S = 5
ORDER_TRIGGER_S = 3
AGE_YOUNG_BELOW = 20
AGE_OLD_FROM = 30
MALE = "M"
LABEL_MALE = "男"
LABEL_FEMALE = "女"
TITLE_GENDER = "用户性别占比"
LABEL_YOUNG = "20岁以下"
LABEL_MIDDLE = "20岁到30岁"
LABEL_OLD = "30岁及30岁以上"
TITLE_AGE = "用户年龄占比"
CARD_DAU = ("dau", "新增日活")
CARD_NEW_DEVICE = ("new_mid", "新增设备")
CARD_ORDER_AMOUNT = ("order_amount", "新增交易额")
CDC_ROW_ENTRY = "ROWDATA"
CDC_ORDER_TABLE = "order_info"
CDC_DETAIL_TABLE = "order_detail"
CDC_USER_TABLE = "user_info"

# Tasks that share the rows of a hot key in a stream, and how far ahead of arrival a device's clock may be.
STREAM_SALTS = 4
CLOCK_AHEAD_S = 24 * 3600

# Topic and index names are deployment choices; every function that uses one takes it as an argument.
TOPIC_STARTUP = "startup"
TOPIC_EVENT = "event"
TOPIC_ORDER_INFO = "order_info"
TOPIC_ORDER_DETAIL = "order_detail"
TOPIC_USER_INFO = "user_info"
INDEX_ALERT = "coupon_alert"
INDEX_SALE_DETAIL = "sale_detail"
