"""What a file's path says about its lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decoded(part: Column) -> Column:
    """Undo the percent escapes of a path."""
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def logical_name(path: Column) -> Column:
    """File name of a plain file; for ``.../name=X/part-...`` the X that the part files belong to."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    plain = F.substring_index(path, "/", -1)
    inside = _decoded(F.substring(folder, F.lit(6), F.length(folder)))
    return F.when(folder.startswith("name="), _decoded(inside)).otherwise(_decoded(plain))


def parent_name(path: Column) -> Column:
    """Name of the folder that holds the logical file; M for a folder ``model=M``."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    above = F.substring_index(F.substring_index(path, "/", -3), "/", 1)
    parent = _decoded(F.when(folder.startswith("name="), above).otherwise(folder))
    return F.when(
        parent.startswith("model="), _decoded(F.substring(parent, F.lit(7), F.length(parent)))
    ).otherwise(parent)


def part_number(path: Column) -> Column:
    """Number of a Spark part file, NULL for any other file."""
    file = F.substring_index(path, "/", -1)
    return F.when(file.startswith("part-"), F.split_part(file, F.lit("-"), F.lit(2)).try_cast("bigint"))
