"""Registered queries with their check SQL, grouped by area."""

from __future__ import annotations

from importlib import import_module

from tapeline.queries import registry

AREAS = ("market", "features", "replay", "pins", "calendar", "news", "scoring", "state", "sources", "streams")


def _load() -> None:
    for area in AREAS:
        import_module(f"tapeline.queries.{area}")


def all_queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def all_checks() -> dict:
    _load()
    return dict(registry.CHECKS)
