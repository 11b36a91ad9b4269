"""Files that tasks write and read in the folder all executors share."""

from __future__ import annotations

import io
from uuid import uuid4

import numpy as np
from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class NewFile:
    """A file that appears under its name when it is whole, so a task may run twice."""

    def __init__(self, folder: str, name: str):
        self.files, path = opened(folder)
        self.name, self.part = f"{path}/{name}", f"{path}/.{name}.{uuid4().hex}"
        self.files.create_dir(path, recursive=True)
        self.out = self.files.open_output_stream(self.part)

    def close(self):
        self.out.close()
        self.files.move(self.part, self.name)


def save_arrays(folder: str, name: str, **arrays: np.ndarray) -> None:
    data = io.BytesIO()
    np.savez(data, **arrays)
    file = NewFile(folder, name)
    file.out.write(data.getbuffer())
    file.close()


def load_arrays(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The arrays of a file; None if there is no such file."""
    files, path = opened(folder)
    if files.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
        return None
    with files.open_input_file(f"{path}/{name}") as file:
        return dict(np.load(io.BytesIO(file.read())))
