"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid


def open_fs(path: str):
    """The file system of a path or URI, and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def put(path: str, content) -> None:
    """Write a file under another name and move it into place, so that a task that is run again, or
    twice at once, leaves one whole file. ``content`` is bytes or an iterable of bytes."""
    system, place = open_fs(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    draft = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for part in [content] if isinstance(content, (bytes, bytearray)) else content:
            out.write(part)
    system.move(draft, place)
