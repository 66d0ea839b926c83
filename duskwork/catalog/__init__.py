"""Registered queries; importing this package fills the registry."""

from duskwork.catalog import audits, intake, lookups, nights, refresh, retention, scoped, status  # noqa: F401
from duskwork.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
