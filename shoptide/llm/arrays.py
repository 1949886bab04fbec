"""Numpy arrays as files in the shared folder: written by tasks, memory-mapped by tasks.

Where the folder is mounted (``file:`` or a plain path) a file appears whole, by a rename, and is mapped. Elsewhere it is
written and read through Arrow's file systems.
"""

from __future__ import annotations

import io
import os
from urllib.parse import urlparse

import numpy as np
from pyarrow import fs


def mounted(uri: str) -> str | None:
    parsed = urlparse(uri)
    return parsed.path if parsed.scheme in ("", "file") else None


def save(uri: str, array: np.ndarray) -> None:
    """Writes an array; a second writer of the same name replaces it with equal content."""
    if path := mounted(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        held = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
        with open(held, "wb") as out:
            np.save(out, array)
        os.replace(held, path)
        return
    store, path = fs.FileSystem.from_uri(uri)
    out = io.BytesIO()
    np.save(out, array)
    with store.open_output_stream(path) as stream:
        stream.write(out.getbuffer())


def load(uri: str) -> np.ndarray:
    if path := mounted(uri):
        return np.load(path, mmap_mode="r") if os.path.getsize(path) > 256 else np.load(path)
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as stream:
        return np.load(io.BytesIO(stream.read()))


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in a sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys
