"""The thin queries of this subpackage: (name, query, DuckDB SQL or None)."""

from __future__ import annotations

import importlib
import pkgutil

import fieldmart.llm as package


def registered() -> list:
    found = []
    for info in sorted(pkgutil.iter_modules(package.__path__), key=lambda m: m.name):
        if info.name.startswith("q_"):
            found += importlib.import_module(f"{package.__name__}.{info.name}").QUERIES
    return found
