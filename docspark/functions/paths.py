"""Blob path rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def container(p: Column) -> Column:
    return F.when(p.contains("/"), F.substring_index(p, "/", 1))


def blob_name(p: Column) -> Column:
    """Everything after the first '/'."""
    return F.when(p.contains("/"), F.split(p, "/", 2).getItem(1))


def file_name(p: Column) -> Column:
    """Text after the last '/' (the whole path when there is none)."""
    return F.substring_index(p, "/", -1)
