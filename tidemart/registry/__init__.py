"""Queries of the package over the benchmark tables, each with its SQL counterpart."""

from importlib import import_module

FAMILIES = ("retail", "freight", "shop", "persona", "streams", "basics")


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
