"""Coupon-abuse alerts: several accounts take coupons on one device while nobody views an item.

A sliding window puts each event into ``length / slide`` windows. Copying events that often is what makes it
expensive, so none is copied: an account that takes a coupon counts in an interval of window starts, an item view
blocks one. A sweep over the edges of a device's intervals adds up how many accounts count and how many views block,
and gives the stretches of window starts that alert. Only panes (stretches between two window edges) within those
windows are looked at again. Behaviours are carried as counts, so no group of raw events is ever collected.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide import constants as C
from shoptide.functions.fields import index_name
from shoptide.functions.times import minute_bucket
from shoptide.operators.keyed import latest_by_key


def _ms(seconds: int) -> Column:
    return F.lit(seconds * 1000).cast("bigint")


def _floor_to(ms: Column, seconds: int) -> Column:
    return ms - F.pmod(ms, _ms(seconds))


def pane_seconds(length_s: int, slide_s: int) -> int:
    """Window edges fall on multiples of this."""
    return gcd(length_s, slide_s)


def _windows_of(pane: Column, length_s: int, slide_s: int) -> Column:
    """Starts of the windows that contain the pane, aligned to the epoch."""
    last = _floor_to(pane, slide_s)
    first = _floor_to(pane - _ms(length_s), slide_s) + _ms(slide_s)
    return F.sequence(first, last, _ms(slide_s))


def is_alert(accounts: Column, viewed: Column, min_accounts: int) -> Column:
    """Coupons of so many accounts and no item view. Events without a device belong to none and never alert."""
    return F.col("mid").isNotNull() & (accounts >= min_accounts) & ~viewed


def _in_panes(events: DataFrame, length_s: int, slide_s: int) -> DataFrame:
    """Events with their pane; account and item only where a coupon was taken."""
    is_coupon = F.col("evid") == C.EVENT_COUPON
    return events.select(
        "mid",
        _floor_to(F.col("ts"), pane_seconds(length_s, slide_s)).alias("pane"),
        "evid",
        F.when(is_coupon, F.col("uid")).alias("account"),
        F.when(is_coupon, F.col("itemid")).alias("item"),
    )


def alert_groups(events: DataFrame, length_s: int = C.ALERT_WINDOW_S, slide_s: int = C.ALERT_SLIDE_S) -> DataFrame:
    """All events of a device in a window, as a count per behaviour (``evid``)."""
    panes = _in_panes(events, length_s, slide_s).groupBy("mid", "pane", "evid").agg(F.count(F.lit(1)).alias("n"))
    return (
        panes.withColumn("window_start", F.explode(_windows_of(F.col("pane"), length_s, slide_s)))
        .groupBy("mid", "window_start", "evid")
        .agg(F.sum("n").alias("n"))
        .withColumn("window_end", F.col("window_start") + _ms(length_s))
    )


def alert_stretches(events: DataFrame, length_s: int, slide_s: int, min_accounts: int) -> DataFrame:
    """(mid, first, last): stretches of window starts with coupons of ``min_accounts`` accounts and no item view.

    Only coupons and item views are read for this, reduced to one row per device, pane and account. An account's
    intervals are cut where the one before already counts, so that it counts once wherever they overlap.
    """
    step, length = _ms(slide_s), _ms(length_s)
    is_view = F.col("evid") == C.EVENT_ITEM_VIEW
    wanted = events.where(F.col("mid").isNotNull() & F.col("evid").isin(C.EVENT_COUPON, C.EVENT_ITEM_VIEW))
    marks = _in_panes(wanted, length_s, slide_s).select("mid", "pane", "account", is_view.alias("view")).distinct()
    ends = marks.where(F.col("view") | F.col("account").isNotNull()).select(
        "mid",
        "account",
        "view",
        (_floor_to(F.col("pane") - length, slide_s) + step).alias("first"),
        _floor_to(F.col("pane"), slide_s).alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy("mid", "account", "view").orderBy("first", "last"))
    fresh = ends.withColumn("first", F.greatest("first", before + step)).where("first <= last")
    edge = lambda at, by: F.struct(at.alias("at"), F.lit(by).alias("by"))
    edges = fresh.select("mid", "view", F.inline(F.array(edge(F.col("first"), 1), edge(F.col("last") + step, -1))))
    by_kind = [F.sum(F.when(F.col("view") == kind, F.col("by")).otherwise(0)).alias(n) for n, kind in (("accounts", False), ("views", True))]
    steps = edges.groupBy("mid", "at").agg(*by_kind)
    so_far = Window.partitionBy("mid").orderBy("at")
    swept = steps.select(
        "mid",
        F.col("at").alias("first"),
        (F.lead("at").over(so_far) - step).alias("last"),
        F.sum("accounts").over(so_far).alias("accounts"),
        F.sum("views").over(so_far).alias("views"),
    )
    return swept.where(is_alert(F.col("accounts"), F.col("views") > 0, min_accounts)).select("mid", "first", "last")


def alert_windows(events: DataFrame, length_s: int, slide_s: int, min_accounts: int) -> DataFrame:
    """(mid, window_start) of the windows that alert, as many rows as there are alerts."""
    starts = F.sequence("first", "last", _ms(slide_s))
    return alert_stretches(events, length_s, slide_s, min_accounts).select("mid", F.explode(starts).alias("window_start"))


def coupon_alerts(
    events: DataFrame,
    length_s: int = C.ALERT_WINDOW_S,
    slide_s: int = C.ALERT_SLIDE_S,
    min_accounts: int = C.ALERT_MIN_ACCOUNTS,
) -> DataFrame:
    """Alerts with their accounts, coupon items and behaviours; ``ts`` is the end of the window.

    ``behaviours`` says how often each kind of event (``evid``) occurred, by name; :func:`list_events` writes them out.
    """
    hits = alert_windows(events, length_s, slide_s, min_accounts)
    # A window lies in two spans of its own length at most, a pane in one: what meets there is half of it wanted.
    span = _floor_to(F.col("window_start"), length_s)
    hits = hits.withColumn("span", F.explode(F.array_distinct(F.array(span, _floor_to(F.col("window_start") + _ms(length_s - 1), length_s)))))
    panes = (
        _in_panes(events, length_s, slide_s)
        .groupBy("mid", "pane", "evid")
        .agg(
            F.collect_set("account").alias("accounts"),
            F.collect_set("item").alias("items"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("span", _floor_to(F.col("pane"), length_s))
    )
    inside = (F.col("pane") >= F.col("window_start")) & (F.col("pane") < F.col("window_start") + _ms(length_s))
    # Alerts are few against panes, so adaptive execution sends them to the panes, which then stay in place.
    # Should they be many, both sides meet by device and span, which spreads a busy device over its spans.
    # A window has its panes' kinds of events at most, so its parts can be gathered in one shuffle.
    met = panes.join(hits, ["mid", "span"]).where(inside)
    parts = F.collect_list(F.struct("evid", "accounts", "items", "n")).alias("parts")
    windows = met.groupBy("mid", "window_start").agg(parts)
    return alerts_of_parts(windows.withColumn("ts", F.col("window_start") + _ms(length_s)), min_accounts)


def all_of(parts: Column, field: str) -> Column:
    """The distinct values of an array field of all parts, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, lambda p: p.getField(field)))))


def alerts_of_parts(windows: DataFrame, min_accounts: int = C.ALERT_MIN_ACCOUNTS) -> DataFrame:
    """Alerts of windows whose panes are at hand as ``parts``, an array of (evid, accounts, items, n).

    ``windows`` has mid, window_start and ts besides.
    """
    viewed = F.exists("parts", lambda p: p.getField("evid").eqNullSafe(C.EVENT_ITEM_VIEW))
    found = windows.withColumn("uids", all_of(F.col("parts"), "accounts")).where(is_alert(F.size("uids"), viewed, min_accounts))
    kinds = F.array_sort(F.array_distinct(F.transform("parts", lambda p: p.getField("evid"))))

    def total(kind: Column) -> Column:
        same = F.filter("parts", lambda p: p.getField("evid").eqNullSafe(kind))
        return F.aggregate(same, F.lit(0).cast("long"), lambda t, p: t + p.getField("n"))

    behaviours = F.transform(kinds, lambda kind: F.struct(kind.alias("evid"), total(kind).alias("n")))
    return found.select(
        "mid", "uids", all_of(F.col("parts"), "items").alias("item_ids"), behaviours.alias("behaviours"), "window_start", "ts"
    )


def list_events(alerts: DataFrame) -> DataFrame:
    """Alerts with ``events``, every behaviour as often as it occurred, in place of the counts.

    As long as the events of a window; counts are the form to keep.
    """
    repeated = F.transform("behaviours", lambda b: F.array_repeat(b.getField("evid"), b.getField("n").cast("int")))
    return alerts.withColumn("behaviours", F.flatten(repeated)).withColumnRenamed("behaviours", "events")


def alert_documents(alerts: DataFrame, prefix: str = C.INDEX_ALERT) -> DataFrame:
    """One document per device and minute, under id ``<mid>-<minute>``; the last window of the minute stays."""
    named = alerts.withColumn("doc_id", F.concat_ws("-", F.col("mid"), minute_bucket(F.col("ts")).cast("string")))
    day = F.timestamp_millis(F.col("ts"))
    return latest_by_key(named, ["doc_id"], ["ts"]).withColumn("index_name", index_name(prefix, day))
