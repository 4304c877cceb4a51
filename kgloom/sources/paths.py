"""Names of scanned files: as they are, not as the scan's metadata writes them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(location: Column) -> Column:
    """A path or name of ``_metadata``, where blanks, ``%`` and others stand as escapes."""
    return F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    return decoded(F.col("_metadata.file_path"))


def file_name() -> Column:
    return decoded(F.col("_metadata.file_name"))


def literal(path: str) -> str:
    """A path that a reader takes for one file even if it holds wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _bare(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def belongs(path: Column, given: str) -> Column:
    """Whether a decoded path is ``given`` or lies below it; without a leading slash ``given`` is the end of a path."""
    bare = _bare(given)
    own = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    if bare.startswith("/"):
        return (own == bare) | F.startswith(own, F.lit(bare + "/"))
    bare = "/" + bare.removeprefix("./")
    return F.endswith(own, F.lit(bare)) | F.contains(own, F.lit(bare + "/"))


def leads_to(given: str, path: str) -> bool:
    """``belongs`` for a path that the driver has."""
    bare, own = _bare(given), _bare(path)
    if not bare.startswith("/"):
        bare = "/" + bare.removeprefix("./")
        return own.endswith(bare) or bare + "/" in own
    return own == bare or own.startswith(bare + "/")
