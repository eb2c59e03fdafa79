"""Files of the shared folder, opened inside tasks by their URI."""

from __future__ import annotations

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local or mounted one."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = resolve(uri)
    system.create_dir(path, recursive=True)
