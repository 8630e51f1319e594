"""Byte access to files from tasks: local, HDFS or object stores by their URI."""

from __future__ import annotations

from contextlib import contextmanager


def _open_filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@contextmanager
def write_whole(uri: str):
    """A binary stream whose file appears under its name only when complete."""
    filesystem, path = _open_filesystem(uri)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(f"{path}.part", compression=None) as stream:
        yield stream
    filesystem.move(f"{path}.part", path)


@contextmanager
def read_at(uri: str):
    """A seekable binary stream."""
    filesystem, path = _open_filesystem(uri)
    with filesystem.open_input_file(path) as stream:
        yield stream
