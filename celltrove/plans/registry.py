"""All contract queries and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("core", "reports", "cells", "space", "columns", "models", "more", "files", "masks")


def queries() -> dict:
    return {k: v for m in MODULES for k, v in importlib.import_module(f"{__package__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in importlib.import_module(f"{__package__}.{m}").SQL.items()}
