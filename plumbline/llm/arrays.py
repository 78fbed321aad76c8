"""Arrays in the shared folder: written by tasks, memory-mapped by other tasks."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
from urllib.parse import urlsplit

import numpy as np
import zstandard
from pyarrow import fs


def is_local(url: str) -> bool:
    return urlsplit(url).scheme in ("", "file")


def local_path(url: str) -> str:
    return urlsplit(url).path


def save(url: str, array: np.ndarray) -> None:
    """Writes one array; a second attempt of a task replaces the first one's file as a whole."""
    raw = io.BytesIO()
    np.save(raw, array)
    if is_local(url):
        path = local_path(url)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            f.write(raw.getbuffer())
        os.replace(draft, path)
    else:
        store, path = fs.FileSystem.from_uri(url)
        store.create_dir(os.path.dirname(path), recursive=True)
        with store.open_output_stream(path) as f:
            f.write(raw.getbuffer())


def load(url: str) -> np.ndarray:
    """The array, memory-mapped; from a remote store through a copy that goes with the worker."""
    if is_local(url):
        return np.load(local_path(url), mmap_mode="r")
    folder = tempfile.TemporaryDirectory()
    atexit.register(folder.cleanup)
    store, path = fs.FileSystem.from_uri(url)
    copy = os.path.join(folder.name, "array.npy")
    with store.open_input_stream(path) as source, open(copy, "wb") as target:
        while block := source.read(1 << 24):
            target.write(block)
    return np.load(copy, mmap_mode="r")


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an integer array, byte planes apart."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unsqueeze(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=keys.dtype.type(0)))


def unsqueeze_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(raw, np.uint64), dtype=np.uint64)


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their values; values are (n,) or (n, k)."""
    key, value = np.concatenate(keys), np.concatenate(values).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value[order], first, axis=0) if len(key) else value
