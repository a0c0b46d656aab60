"""Files that tasks write and read themselves, in the folder all executors share.

Any store that pyarrow knows by its URI serves (file, hdfs, s3, ..). A task writes to a
name of its own attempt; only names in the manifest that the job returns are ever read,
so a lost or repeated task leaves at most an unlisted file behind.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI; a plain path is a file path."""
    if "://" in uri or uri.startswith("file:/"):
        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[5:]
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def attempt_name(folder: str, kind: str) -> str:
    return f"{folder.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
