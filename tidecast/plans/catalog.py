"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from . import q_ensemble, q_eval, q_features, q_models, q_reconcile, q_store  # noqa: F401
from ..session import checkpoint_root, tune
from .registry import REGISTRY


def _tuned(fn):
    def run(spark, sf_dir):
        tune(spark)
        checkpoint_root(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries():
    return {name: _tuned(q.fn) for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
