"""Lazy package exports: Python workers that unpickle a fold import only the
module they need (numpy + the fold rules), not the whole library."""

from __future__ import annotations

import importlib


def lazy_exports(package: str, table: dict[str, str]):
    def __getattr__(name: str):
        mod = table.get(name)
        if mod is None:
            raise AttributeError(f"module {package!r} has no attribute {name!r}")
        return getattr(importlib.import_module(mod), name)

    def __dir__():
        return sorted(table)

    return __getattr__, __dir__
