"""Files that a task reads or writes by itself, wherever the cluster keeps them."""

from __future__ import annotations

import re
import sys

import pyarrow.fs as pafs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def place_of(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; a path without a scheme is local or mounted."""
    if re.match(r"file:/+", path):
        path = "/" + re.sub(r"^file:/+", "", path)
    return pafs.FileSystem.from_uri(path)


def files_of(path: str, ending: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of a file, or of all files of a folder with that ending; marker files do not count."""
    system, inner = place_of(path)
    info = system.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    found = system.get_file_info(pafs.FileSelector(inner))
    named = [f for f in found if f.is_file and f.base_name.lower().endswith(ending) and f.base_name[0] not in "._"]
    return sorted((scheme + f.path, f.size) for f in named)


def opened(path: str):
    """The file for reading from any place in it."""
    system, inner = place_of(path)
    return system.open_input_file(inner)


def written(path: str, content: bytes) -> None:
    """A whole file put in place at once where the store can do that; a task tried again writes the same."""
    system, inner = place_of(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    aside = f"{inner}.part"
    with system.open_output_stream(aside) as out:
        out.write(content)
    system.move(aside, inner)
