"""Blocks of numpy arrays as files in the shared folder: iterative jobs hand their state on through them.

A block is written under a draft name and renamed, so a task that runs twice
replaces equal bytes by equal bytes, and a reader never sees half a block.
A file is a line of JSON (name, type and shape of each array) and the arrays'
bytes one after the other: they are neither packed nor copied on their way.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow.fs as pafs


def _store(folder: str):
    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(folder)


def _bytes(x: np.ndarray) -> memoryview:
    return memoryview(x.reshape(-1).view(np.uint8))


def save_block(folder: str, name: str, **arrays: np.ndarray) -> None:
    fs, root = _store(folder)
    fs.create_dir(root, recursive=True)
    draft = f"{root}/.{name}-{uuid.uuid4().hex}"
    arrays = {k: np.ascontiguousarray(x) for k, x in arrays.items()}
    head = json.dumps([(k, x.dtype.str, x.shape) for k, x in arrays.items()]).encode()
    with fs.open_output_stream(draft) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for x in arrays.values():
            if x.size:
                out.write(_bytes(x))
    fs.move(draft, f"{root}/{name}")


def load_block(folder: str, name: str, only: tuple[str, ...] | None = None) -> dict[str, np.ndarray] | None:
    """The arrays of a block (or those called ``only``), or None if no such block was written."""
    fs, root = _store(folder)
    if fs.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
        return None
    found = {}
    with fs.open_input_file(f"{root}/{name}") as src:
        at = 8 + int.from_bytes(src.read(8), "little")
        for k, kind, shape in json.loads(src.read(at - 8)):
            x = np.empty(shape, np.dtype(kind))
            if (only is None or k in only) and x.size:
                src.seek(at)
                into, done = _bytes(x), 0
                while done < x.nbytes:
                    got = src.readinto(into[done:])
                    if not got:
                        raise EOFError(f"block {name} in {folder} ends too early")
                    done += got
            at += x.nbytes
            if only is None or k in only:
                found[k] = x
    return found


def drop_block(folder: str, name: str) -> None:
    """Remove a block if it is there."""
    fs, root = _store(folder)
    if fs.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:
        fs.delete_file(f"{root}/{name}")
