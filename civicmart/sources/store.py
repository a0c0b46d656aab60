"""Files that the driver publishes, lists and removes, by URI (``pyarrow.fs``; no JVM handles).

``publish`` is the one atomic step that optimistic commits need: a small file appears under its
name whole or not at all, and only for the first who asks.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI; a plain path is a file path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def publish(uri: str, content: str) -> bool:
    """Create the file ``uri`` with ``content``; False if somebody else did before.

    The content is written under a name of its own first. A link (POSIX file systems) or a rename that
    refuses an existing name (HDFS) then gives it its name. Stores without either are refused.
    """
    store, path = open_store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    own = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"  # hidden from Spark's readers
    with store.open_output_stream(own) as out:
        out.write(content.encode())
    try:
        if isinstance(store, fs.LocalFileSystem):
            try:
                os.link(own, path)
            except FileExistsError:
                return False
            return True
        if store.type_name != "hdfs":
            raise NotImplementedError(f"no exclusive creation on {store.type_name}")
        try:
            store.move(own, path)
        except OSError:
            if store.get_file_info(path).type == fs.FileType.NotFound:
                raise
            return False
        return True
    finally:
        if store.get_file_info(own).type != fs.FileType.NotFound:
            store.delete_file(own)


def listed(uri: str, recursive: bool = False) -> Iterator[fs.FileInfo]:
    """What a folder holds (nothing if it isn't there)."""
    store, path = open_store(uri)
    yield from store.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=recursive))


def read_text(uri: str) -> str:
    store, path = open_store(uri)
    with store.open_input_stream(path) as f:
        return f.read().decode()


def remove(uri: str) -> bool:
    """Remove a folder or file; False if it wasn't there."""
    store, path = open_store(uri)
    kind = store.get_file_info(path).type
    if kind == fs.FileType.Directory:
        store.delete_dir(path)
    elif kind == fs.FileType.File:
        store.delete_file(path)
    return kind != fs.FileType.NotFound
