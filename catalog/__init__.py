"""Registered queries, grouped by the part of the engine they exercise."""


def all_catalogs():
    import importlib
    import pkgutil

    names = sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.endswith("_queries"))
    return [importlib.import_module(f"{__name__}.{n}").CATALOG for n in names]
