"""Object types and paths read from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terravane import constants as K


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def archive_type(path: Column) -> Column:
    """Type code of an archive: its base name up to the first dot, without the digits."""
    return F.regexp_replace(F.substring_index(base_name(path), ".", 1), "[0-9]", "")


def member_path(folder: str, archive: Column, member: Column) -> Column:
    """Where a member of ``archive`` is stored: folder, type code, member base name."""
    return F.concat_ws("/", F.lit(folder), archive_type(archive), base_name(member))


def has_suffix(path: Column, suffix: str) -> Column:
    return path.endswith(suffix)


def file_number(path: Column) -> Column:
    """Last run of digits in a file's base name, null if it has none."""
    digits = F.regexp_extract(base_name(path), r"([0-9]+)[^0-9]*$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def batch_of(path: Column, size: int = K.BATCH_FILES) -> Column:
    """Part number of a source file: ``size`` consecutive file numbers share a part."""
    number = file_number(path)
    first = F.floor((number - 1) / F.lit(size))
    return F.greatest(F.coalesce(first, F.lit(0)), F.lit(0)).cast("int")
