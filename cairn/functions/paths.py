"""Expressions over file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme and authority of a path: 's3a://bucket', 'hdfs://host:8020', 'file:' or nothing.
FILESYSTEM = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?)?"


def split_filesystem(path: str) -> tuple[str, str]:
    """``(filesystem, path inside it)`` of a plain string."""
    filesystem = re.match(FILESYSTEM, path).group()
    return filesystem, path[len(filesystem) :]


def is_record_file(path: Column, suffix: str = ".json") -> Column:
    """A data file, as opposed to the ``.keep`` markers that hold an empty folder."""
    return path.endswith(suffix) & ~path.endswith(".keep")


def rewrite_zone(path: Column, zone: str, target_zone: str) -> Column:
    """The same file below ``target_zone``; NULL for a path that is not inside ``zone``.

    Only a leading, whole path segment counts, so ``raw/a_old/x`` is not inside ``raw/a``.
    """
    here = split_filesystem(zone)[1].rstrip("/") + "/"
    there_fs, there = split_filesystem(target_zone.rstrip("/") + "/")
    path_fs = F.regexp_extract(path, FILESYSTEM, 0)
    inside = F.substr(path, F.length(path_fs) + F.lit(1))
    rest = F.substr(inside, F.lit(len(here) + 1))
    filesystem = F.lit(there_fs) if there_fs else path_fs
    return F.when(inside.startswith(here), F.concat(filesystem, F.lit(there), rest))
