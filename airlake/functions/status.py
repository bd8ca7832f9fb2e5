"""Freshness classes, feed classes, and the wording shown with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.time import col, ist, whole


def freshness(age_hours: Column | str, cfg: Config = CONFIG) -> Column:
    age = col(age_hours)
    return (
        F.when(age.isNull(), "no_data")
        .when(age <= cfg.live_max_hours, "live")
        .when(age <= cfg.delayed_max_hours, "delayed")
        .when(age <= cfg.inactive_max_days * 24, "inactive")
        .otherwise("offline")
    )


def feed_class(share_not_live: Column | str, cfg: Config = CONFIG) -> Column:
    share = col(share_not_live)
    return (
        F.when(share >= cfg.outage_share, "outage")
        .when(share >= cfg.degraded_share, "degraded")
        .otherwise("ok")
    )


def source_freshness_class(age_hours: Column, warn_hours: float, error_hours: float) -> Column:
    return (
        F.when(age_hours.isNull() | (age_hours > error_hours), "error")
        .when(age_hours > warn_hours, "warn")
        .otherwise("pass")
    )


def ist_text(ts: Column | str) -> Column:
    """``5 Jan, 14:30 IST``"""
    return F.date_format(ist(ts), "d MMM, HH:mm 'IST'")


def age_text(ts: Column | str, now: Column) -> Column:
    seconds = whole("SECOND", ts, now)
    minutes, hours = F.floor(seconds / 60), F.floor(seconds / 3600)
    return (
        F.when(seconds < 3600, F.concat(F.greatest(minutes, F.lit(1)).cast("string"), F.lit(" min ago")))
        .when(hours < 48, F.concat(hours.cast("string"), F.lit(" h ago")))
        .otherwise(F.concat(F.floor(hours / 24).cast("string"), F.lit(" days ago")))
    )


def hour_window_text(ts: Column | str) -> Column:
    """The IST hour a forecast is for, as ``30 Sep, 15:00–16:00 IST``."""
    start = ist(ts)
    end = start + F.expr("INTERVAL '1' HOUR")
    return F.concat(
        F.date_format(start, "d MMM, HH:mm"), F.lit("–"), F.date_format(end, "HH:mm"), F.lit(" IST")
    )


# The user-facing sentences.
NO_READINGS = "No readings available for this station yet."
SOURCE_DOWN = (
    "The air quality data service isn't sending new readings. "
    "Showing this station's last reading from {when}."
)
DELAYED = "Readings are delayed. Last reading: {when}."
INACTIVE = "This station's sensor appears inactive. Showing its last reading from {when}."
OFFLINE = "This station has been offline since {when} and is excluded from area averages."
FEED_OUTAGE = (
    "Live updates are paused: our data source (OpenAQ / CPCB) has sent no new readings "
    "since {when}. You're seeing the last available data for each station."
)
FEED_DEGRADED = "Some stations ({when}) are reporting late or not at all."
STALE_FORECAST = (
    "Forecasts use this station's last known readings from {when} "
    "({age} h old) because new readings aren't arriving."
)


def fill(template: str, **values: Column) -> Column:
    """A sentence with its ``{placeholders}`` replaced by columns."""
    out, rest = [], template
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        out += [F.lit(before), values[name]]
    return F.concat(*out, F.lit(rest))


def station_message(status: Column, last_reading: Column, now: Column, feed: Column) -> Column:
    """Banner for one station; NULL when it is live."""
    when = F.concat(ist_text(last_reading), F.lit(" ("), age_text(last_reading, now), F.lit(")"))
    return (
        F.when(status == "live", F.lit(None).cast("string"))
        .when((status == "no_data") | last_reading.isNull(), F.lit(NO_READINGS))
        .when(feed == "outage", fill(SOURCE_DOWN, when=when))
        .when(status == "delayed", fill(DELAYED, when=when))
        .when(status == "inactive", fill(INACTIVE, when=when))
        .otherwise(fill(OFFLINE, when=when))
    )


def feed_message(feed: Column, share_not_live: Column, newest: Column) -> Column:
    """Site-wide banner; NULL when the feed is ok."""
    since = F.coalesce(ist_text(newest), F.lit("unknown"))
    share = F.concat(F.bround(share_not_live * 100).cast("int").cast("string"), F.lit("%"))
    return (
        F.when(feed == "outage", fill(FEED_OUTAGE, when=since))
        .when(feed == "degraded", fill(FEED_DEGRADED, when=share))
    )


def change_message(previous: Column, current: Column, share_not_live: Column, newest: Column) -> Column:
    """Announcement for a status change; NULL when nothing changed, or on a first check that is ok."""
    pct = F.bround(share_not_live * 100).cast("int")
    when = F.coalesce(ist_text(newest), F.lit("none"))
    silent = (current == previous) | (previous.isNull() & (current == "ok"))
    p = pct.cast("string")
    return (
        F.when(silent, F.lit(None).cast("string"))
        .when(
            current == "outage",
            F.concat(
                F.lit("🔴 OpenAQ outage: "), p, F.lit("% of stations have no live reading (newest reading "),
                when, F.lit("). The dashboard shows last-known data."),
            ),
        )
        .when(
            current == "degraded",
            F.concat(
                F.lit("🟠 OpenAQ degraded: "), p, F.lit("% of stations not live (newest reading "),
                when, F.lit(")."),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("🟢 OpenAQ back to normal: "), (100 - pct).cast("string"),
                F.lit("% of stations live (newest reading "), when, F.lit(")."),
            )
        )
    )
