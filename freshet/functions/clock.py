"""Instants as numbers: columns may be zoned or plain timestamps, both read in the session's zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / 3.6e9


def minutes_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / 6e7
