"""Spark-native analytics over catalogs of semi-structured records.

Submodules load on first use, so importing the package starts nothing::

    import sparvane
    sparvane.operators.relational.compare_datasets(a, b, ["id"])
"""

from importlib import import_module

_PARTS = ("functions", "operators", "plans", "runtime", "sources", "streaming")
__all__ = list(_PARTS)


def __getattr__(name):
    if name in _PARTS:
        return import_module(f"{__name__}.{name}")
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")


def __dir__():
    return sorted([*globals(), *_PARTS])
