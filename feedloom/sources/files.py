"""Files as seen by data sources, which run without a Spark session."""

from __future__ import annotations

import re

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with a scheme, or the local one, and the path in it."""
    if "://" in path:
        files, root = fs.FileSystem.from_uri(path)
        return files, root.rstrip("/")
    return fs.LocalFileSystem(), re.sub("^file:", "", path).rstrip("/")


def folder_names(files: fs.FileSystem, root: str) -> list[str]:
    """Names of the folders right below ``root``."""
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return [info.base_name for info in found if info.type == fs.FileType.Directory]
