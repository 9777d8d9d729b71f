"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from importlib import import_module

MODULES = ("lines", "bpe", "forest", "secrets", "quality", "weaklabels", "packing", "jaccard", "suffixes", "chat",
           "merkle", "warc", "alignment")


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"{__package__}.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in import_module(f"{__package__}.{m}").ORACLES.items()}
