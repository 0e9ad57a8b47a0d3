"""Path expressions used by the file-listing monitors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def folder_of(path, root: str | None = None) -> Column:
    """Folder of a file path; with ``root`` given, the root prefix is removed
    literally (not as a pattern)."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.length(F.substring_index(p, "/", -1))
    folder = F.when(F.contains(p, F.lit("/")), F.substr(p, F.lit(1), F.length(p) - name - 1)).otherwise(p)
    if root:
        r = root.rstrip("/")
        folder = F.when(F.startswith(folder, F.lit(r)),
                        F.substr(folder, F.lit(len(r) + 1))).otherwise(folder)
    return folder
