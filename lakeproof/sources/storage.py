"""Storage access from inside tasks, for whatever the path's scheme names."""
from __future__ import annotations

import hashlib

from pyarrow import fs

CHUNK = 8 << 20


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path within it; a path without scheme is local."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    # A percent sign belongs to the object's name, so the name is not parsed as a URL.
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    bucket = rest.split("/", 1)[0]
    system, _ = fs.FileSystem.from_uri(f"{scheme}://{bucket}/")
    return system, rest


def children(path: str) -> list[fs.FileInfo]:
    """Direct entries of a folder; every name counts.

    On a local disk Spark keeps a checksum file ``.name.crc`` beside each file; as in
    Hadoop's own listing those are not objects.
    """
    system, inner = resolve(path)
    found = system.get_file_info(fs.FileSelector(inner.rstrip("/") or "/"))
    if isinstance(system, fs.LocalFileSystem):
        found = [e for e in found
                 if not (e.base_name.startswith(".") and e.base_name.endswith(".crc"))]
    return found


def md5_of(path: str) -> str:
    """MD5 of a file of any size, read in chunks."""
    system, inner = resolve(path)
    digest = hashlib.md5()
    with system.open_input_stream(inner) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()
