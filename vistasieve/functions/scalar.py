"""Small scalar helpers: names, stems, paths, the version format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item file name and release version formats.
ITEM_NAME_FORMAT = "%s_%07d.jpg"
VERSION_FORMAT = "1.%d.0"


def item_name(source: Column, idx: Column, suffix: str = ".jpg") -> Column:
    """K6: ``<source>_<7-digit index><suffix>``."""
    return F.format_string("%s_%07d" + suffix.replace("%", "%%"), source, idx)


# These patterns begin where a name does: tried at every character instead, they take time by the square of the length.
def file_stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(path, r"(?:^|/)([^/]+)\.[^./]*$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"(?:^|/)([^/]++)$", 1)


def parent_dir(path: Column, levels: int = 1) -> Column:
    """Name of the folder ``levels`` above the file (1 = containing folder)."""
    pattern = r"(?:^|/)([^/]++)" + r"/[^/]++" * levels + r"$"
    return F.regexp_extract(path, pattern, 1)


def normalize_path(path: Column) -> Column:
    """One spelling for local URIs: ``file:///x`` and ``file:/x`` both become ``file:/x``."""
    return F.regexp_replace(path, r"^file:/+", "file:/")
