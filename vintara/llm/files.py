"""Flat binary files in the shared folder, written whole and read by memory map where the store allows it."""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs

MAGIC = b"VNTR0001"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri)


def put(uri: str, *parts: bytes | memoryview) -> None:
    """Write ``parts`` as one file. The file appears whole or not at all, so a task may be run twice or lost half-way."""
    at, path = store(uri)
    at.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with at.open_output_stream(draft) as f:
        for p in parts:
            f.write(p)
    at.move(draft, path)


def get(uri: str) -> pa.Buffer:
    """The bytes of a file: mapped from a mounted file system, read from any other."""
    at, path = store(uri)
    if isinstance(at, fs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with at.open_input_file(path) as f:
        return f.read_buffer()


def pack(meta: dict, arrays: dict[str, np.ndarray]) -> bytes:
    """A header in JSON and the arrays, each aligned to 64 bytes."""
    places, at = {}, 0
    for k, x in arrays.items():
        places[k] = [x.dtype.str, len(x), at]
        at += -(-x.nbytes // 64) * 64
    head = json.dumps({"meta": meta, "arrays": places}).encode()
    size = -(-(16 + len(head)) // 64) * 64
    out = bytearray(size + at)
    out[:8], out[8:16], out[16 : 16 + len(head)] = MAGIC, len(head).to_bytes(8, "little"), head
    for k, x in arrays.items():
        p = size + places[k][2]
        out[p : p + x.nbytes] = np.ascontiguousarray(x).tobytes()
    return bytes(out)


def unpack(uri: str) -> tuple[dict, dict[str, np.ndarray]]:
    """Header and arrays of a file that ``pack`` made; the arrays are views of the mapped bytes."""
    raw = get(uri)
    view = memoryview(raw)
    if bytes(view[:8]) != MAGIC:
        raise ValueError(f"{uri} is not a file of this format")
    n = int.from_bytes(view[8:16], "little")
    head = json.loads(bytes(view[16 : 16 + n]))
    base = -(-(16 + n) // 64) * 64
    return head["meta"], {k: np.frombuffer(raw, np.dtype(t), count, base + at) for k, (t, count, at) in head["arrays"].items()}
