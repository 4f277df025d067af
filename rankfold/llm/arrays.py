"""Flat numpy arrays in the shared folder: written once by a task, memory-mapped by workers."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow.fs as pafs


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write under another name first: a retried or doubled task replaces equal bytes by equal bytes."""
    path, data = _local(folder), np.ascontiguousarray(values)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        data.tofile(draft)
        os.replace(draft, f"{path}/{name}")
        return
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    draft = f"{root}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(data.tobytes())
    fs.move(draft, f"{root}/{name}")


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    """The array, memory-mapped; from a store that can't be mapped, through an unlinked local copy."""
    path = _local(folder)
    if path is not None:
        return _mapped(f"{path}/{name}", dtype)
    fs, root = pafs.FileSystem.from_uri(folder)
    with tempfile.NamedTemporaryFile(prefix="lm-") as copy:         # the mapping outlives the name
        with fs.open_input_stream(f"{root}/{name}") as src:
            while block := src.read(1 << 24):
                copy.write(block)
        copy.flush()
        return _mapped(copy.name, dtype)


def _mapped(path: str, dtype) -> np.ndarray:
    if os.path.getsize(path) == 0:
        return np.empty(0, dtype)
    with open(path, "rb") as f:
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype)
