"""Settings: environment first, then KEY=value files, then a default; nested updates of option dictionaries."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from pathlib import Path


def setting(name: str, default: str | None = None, files: Iterable[str] = ()) -> str | None:
    if value := os.environ.get(name):
        return value
    for path in map(Path, files):
        for line in path.read_text().splitlines() if path.is_file() else ():
            key, found, value = line.strip().partition("=")
            if found and key == name:
                return value.strip()
    return default


def merged(base: Mapping, extra: Mapping) -> dict:
    """base with extra's entries; where both hold a mapping, the mappings are merged."""
    out = dict(base)
    for key, value in extra.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = merged(out[key], value) if both else value
    return out
