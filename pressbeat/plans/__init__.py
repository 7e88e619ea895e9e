"""Named queries, grouped by area; importing a module registers its queries."""

from importlib import import_module

AREAS = ("traffic", "sources", "frame", "cleaning", "joining", "stats", "scalars", "summaries", "streams", "lakes", "searching", "jobs")


def load_all() -> None:
    for area in AREAS:
        import_module(f"{__name__}.{area}")
