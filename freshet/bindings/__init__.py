"""Queries over the driver tables: each operator bound to whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ["series", "forecast", "history", "place", "exposure", "suite", "functions", "feeds", "matching", "upserts", "streams"]


def load() -> None:
    for family in FAMILIES:
        import_module(f"freshet.bindings.{family}")
