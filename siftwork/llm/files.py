"""Files that Python workers write and read in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(uri: str) -> Iterator:
    """A binary stream to a temporary name, moved to ``uri`` when the block ends well.

    A task that fails or is lost leaves only a temporary name, which no manifest lists; a task
    that runs twice writes the same bytes to the same name.
    """
    system, path = store(uri)
    folder = path.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(temporary) as out:
            yield out
        system.move(temporary, path)
    except BaseException:
        if system.get_file_info(temporary).type != fs.FileType.NotFound:
            system.delete_file(temporary)
        raise


def open_file(uri: str):
    system, path = store(uri)
    return system.open_input_file(path)
