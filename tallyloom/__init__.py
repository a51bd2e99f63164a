"""Spark-native matching of organisation lists against award registers, with enrichment, consolidation and metrics."""

_PUBLIC = {"MatchConfig": "tallyloom.config", "RunConfig": "tallyloom.config", "match_awards": "tallyloom.operators.matching", "Inputs": "tallyloom.plans.run", "run": "tallyloom.plans.run"}
__all__ = list(_PUBLIC)


def __getattr__(name: str):
    """Public names, loaded when asked for, so that a worker that needs one module doesn't load all."""
    if name not in _PUBLIC:
        raise AttributeError(name)
    from importlib import import_module

    return getattr(import_module(_PUBLIC[name]), name)
