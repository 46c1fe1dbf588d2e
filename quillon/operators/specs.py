"""Model specifications: small dictionaries with a ``model`` type, an optional ``name`` and parameters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

MODEL_TYPES = ("dt", "lr", "knn", "svc", "rf", "boosting", "bagging", "dummy")


def generate_iter_model_specs(base_specs: Mapping, iter_param: str, iter_vals: Iterable) -> list[dict]:
    """One specification per value of one parameter; the base stays unchanged."""
    return [{**base_specs, iter_param: value} for value in iter_vals]


def spec_label(spec: Mapping, position: int = 1) -> str:
    return str(spec.get("name", f"Model #{position}"))


def parameters(spec: Mapping, allowed: Mapping[str, object]) -> dict:
    """Parameters of a specification over their defaults; an unknown one is an error.

    ``n_jobs`` and ``solver`` are accepted and have no effect: Spark runs the tasks and picks the
    optimiser.
    """
    given = {k: v for k, v in spec.items() if k not in ("model", "name", "n_jobs", "solver")}
    unknown = set(given) - set(allowed)
    if unknown:
        raise ValueError(f"unknown parameters for {spec['model']}: {sorted(unknown)}")
    return {**allowed, **given}
