"""Incremental catalogue sync and login-log loading on Spark."""

from tidemark.config import JPN, VNM, Region, generic_region
from tidemark.plans.ddl_text import index_ddl_extract
from tidemark.plans.logins import ingest_logins, parse_client
from tidemark.plans.runner import Run, sync_catalog, sync_rights

__all__ = [
    "JPN",
    "VNM",
    "Region",
    "Run",
    "generic_region",
    "index_ddl_extract",
    "ingest_logins",
    "parse_client",
    "sync_catalog",
    "sync_rights",
]
