"""Binding of each operator to the driver's tables: (name, query, DuckDB SQL or None)."""

from __future__ import annotations

import importlib
import pkgutil

import fieldmart.plans as package


def registered() -> list:
    found: list = []
    for info in sorted(pkgutil.iter_modules(package.__path__), key=lambda m: m.name):
        if info.name.startswith("bed_"):
            found += importlib.import_module(f"{package.__name__}.{info.name}").bed.entries
    return found
