"""Logical names of landed snapshots."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDECAR_SUFFIX = ".meta.json"


def asset_path(*key_parts: Column | str) -> Column:
    """Key parts joined by ``/``, every ``_`` read as ``/`` too."""
    return F.replace(F.concat_ws("/", *key_parts), F.lit("_"), F.lit("/"))


def snapshot_path(asset: Column, ms: Column) -> Column:
    return F.concat(asset, F.lit("_"), ms.cast("string"), F.lit(".json"))


def sidecar_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.json$", SIDECAR_SUFFIX)


def plain_path(path: Column) -> Column:
    """A file's name as it stands, from the URL that file scans report; local ones begin with ``file:/``."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def literal(name: str) -> str:
    """A name for readers that take patterns, matching nothing but itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def is_sidecar(name: Column) -> Column:
    return F.endswith(name, F.lit(SIDECAR_SUFFIX))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def pairing_key(path: Column) -> Column:
    """What a data file and its sidecar have in common: the path without its suffix."""
    return F.regexp_replace(path, r"(\.meta)?\.json$", "")


def exchange_of(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def under_prefix(path: Column, prefix: str) -> Column:
    """Paths of exactly this asset: ``<prefix>_<ms>.json``, not those of a longer sibling name."""
    return path.rlike(rf"^\Q{prefix}\E_\d+\.json\z")
