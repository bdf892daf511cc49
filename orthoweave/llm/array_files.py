"""Files of numpy arrays in the shared folder, memory-mapped by the tasks that read them."""

from __future__ import annotations

import io
import os
import tempfile

import numpy as np

from orthoweave.llm.common import open_fs, write_file


def save_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a line of names, kinds and lengths, then the arrays, each at a multiple
    of eight bytes."""
    head = ";".join(f"{k},{v.dtype.str},{len(v)}" for k, v in arrays.items()).encode() + b"\n"
    out = io.BytesIO()
    out.write(head)
    for v in arrays.values():
        out.write(bytes(-out.tell() % 8))
        out.write(v.tobytes())
    write_file(uri, [out.getvalue()])


_LOCAL: dict[str, str] = {}


def load_arrays(uri: str) -> dict[str, np.ndarray]:
    """Memory-maps a file. One in a remote store is first copied to the worker's own
    temporary folder, once."""
    system, path = open_fs(uri)
    if system.type_name != "local":
        if uri not in _LOCAL:
            target = os.path.join(tempfile.mkdtemp(), "segment")
            with system.open_input_stream(path) as source, open(target, "wb") as out:
                while data := source.read(8 << 20):
                    out.write(data)
            _LOCAL[uri] = target
        path = _LOCAL[uri]
    data = np.memmap(path, np.uint8, "r")
    line = bytes(data[:65536]).split(b"\n", 1)[0]
    at, arrays = len(line) + 1, {}
    for name, kind, n in (x.split(",") for x in line.decode().split(";")):
        at += -at % 8
        size = int(n) * np.dtype(kind).itemsize
        arrays[name] = np.asarray(data[at:at + size]).view(kind)
        at += size
    return arrays


class SortedNumbers:
    """Membership in a set of signed 64-bit numbers, kept as files of sorted numbers."""

    def __init__(self, files: list[str]):
        self.parts = [load_arrays(f)["numbers"] for f in files]
        self.lows = np.array([p[0] for p in self.parts], np.int64)

    def has(self, numbers: np.ndarray) -> np.ndarray:
        unique, back = np.unique(numbers, return_inverse=True)
        found = np.zeros(len(unique), bool)
        home = np.searchsorted(self.lows, unique, side="right") - 1
        for part in np.unique(home[home >= 0]).tolist():
            own = np.flatnonzero(home == part)
            at = np.minimum(np.searchsorted(self.parts[part], unique[own]), len(self.parts[part]) - 1)
            found[own] = self.parts[part][at] == unique[own]
        return found[back]
