"""A Spark-native engine for publication corpora: ingest, cleaning, text, topics, curation and citation networks."""

from importlib import import_module

#: What the package offers, by the module that has it; loaded when first asked for, as executors need little of it.
_OFFERS = {
    "Config": "plans.config", "load": "plans.config", "Session": "plans.session", "doctor": "plans.stages", "plan_variant": "plans.stages",
    "run": "plans.stages", "run_variant": "plans.stages",
}
__all__ = sorted(_OFFERS)


def __getattr__(name: str):
    if name not in _OFFERS:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_OFFERS[name]}"), name)
