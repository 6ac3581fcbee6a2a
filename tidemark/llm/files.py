"""Files that executors write to and read from the shared folder, wherever that folder is."""

from __future__ import annotations

import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs) and the path in it; a bare path is a local one."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def attempt_name(folder: str, stem: str, suffix: str) -> str:
    """A name that no other attempt of a task uses.

    A task reports the files it has written in its result, and only the attempt that succeeds is heard. So files of
    lost or repeated attempts are never read.
    """
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
