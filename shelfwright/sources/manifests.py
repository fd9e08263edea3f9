"""Numbered manifests: what a folder holds is what its last manifest names.

Data is written under new names first and the manifest last, whole, so a reader sees the state before or the state after and
never a mixture. Nothing that a manifest names is changed later; what no manifest names is not read.
"""

from __future__ import annotations

import json
import uuid

from shelfwright.sources import files

_FOLDER = "_manifests"


def _numbered(folder: str) -> list[tuple[int, str]]:
    names = (f.base_name for f in files.listed(f"{folder}/{_FOLDER}"))
    return sorted((int(n.removesuffix(".json")), n) for n in names if n.endswith(".json") and not n.startswith("."))


def current(folder: str, number: int | None = None) -> dict | None:
    """The last manifest of a folder, or the one with a number; None where there is none."""
    found = [name for n, name in _numbered(folder) if number in (None, n)]
    return json.loads(files.read_file(f"{folder}/{_FOLDER}/{found[-1]}")) if found else None


def commit(folder: str, content: dict, after: dict | None = None) -> dict:
    """Make ``content`` the state of the folder, in the place of the manifest ``after`` it was derived from. Another
    manifest in between is an error; writers of one folder take turns."""
    last = _numbered(folder)
    number = last[-1][0] if last else 0
    if number != (after or {}).get("number", 0):
        raise RuntimeError(f"{folder} was changed by another writer (manifest {number})")
    content = {**content, "number": number + 1}
    files.write_file(f"{folder}/{_FOLDER}/{number + 1:012d}.json", json.dumps(content).encode())
    return content


def new_name(folder: str, name: str) -> str:
    """A path in the folder that nothing uses."""
    return f"{folder}/{name}-{uuid.uuid4().hex}"
