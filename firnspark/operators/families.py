"""Model families: how a kind of model is fitted and evaluated.

A family works on whole frames, all regions and seasons at once, so a new one is a pair
of DataFrame functions and needs no row-wise or per-group Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from firnspark.functions.codes import ASPECT_MODELS, PROBLEM_MODELS, deployed_release
from firnspark.operators import evaluate, scoring, training, trees

Years = tuple[int, int]


@dataclass(frozen=True)
class ModelFamily:
    """``fit(frame, years)`` gives the model rows of all (region, season) groups,
    ``metrics(frame, model, years)`` one metric row per model on its test season."""

    fit: Callable[[DataFrame, Years], DataFrame]
    metrics: Callable[[DataFrame, DataFrame, Years], DataFrame]


def _fit_majority(frame: DataFrame, years: Years) -> DataFrame:
    return training.fit_majority(training.class_counts(frame), years)


def _majority_metrics(frame: DataFrame, model: DataFrame, years: Years) -> DataFrame:
    confusion = scoring.evaluate_problem_types(training.class_counts(frame), model, years)
    return evaluate.classification_metrics(confusion, ["model_name", *training.GROUP])


def _fit_trees(frame: DataFrame, years: Years) -> DataFrame:
    return trees.fit_trees(training.class_counts(frame), years)


def _tree_metrics(frame: DataFrame, model: DataFrame, years: Years) -> DataFrame:
    confusion = scoring.evaluate_problem_types(training.class_counts(frame), model, years, trees.resolve_by_trees)
    return evaluate.classification_metrics(confusion, ["model_name", *training.GROUP])


def _fit_linear(release: str, frame: DataFrame, years: Years) -> DataFrame:
    return training.fit_linear(training.moments(training.design_rows(frame, release)), years)


def _linear_metrics(release: str, frame: DataFrame, model: DataFrame, years: Years) -> DataFrame:
    pairs = scoring.evaluate_aspects(frame, model, years, release)
    return evaluate.regression_metrics(pairs, ["model_name", *training.GROUP])


FAMILIES: dict[tuple[str, str], ModelFamily] = {
    ("problem_type", "v000"): ModelFamily(_fit_majority, _majority_metrics),
    ("problem_type", "grown"): ModelFamily(_fit_trees, _tree_metrics),
    **{
        ("aspect", release): ModelFamily(partial(_fit_linear, release), partial(_linear_metrics, release))
        for release in ("v000", "v001")
    },
}


def add_family(kind: str, release: str, family: ModelFamily) -> None:
    FAMILIES[kind, release] = family


def family_of(model_name: str, release: str | None = None) -> ModelFamily:
    """The family of a model at a release, by default the deployed one."""
    if model_name in PROBLEM_MODELS:
        kind = "problem_type"
    elif model_name in ASPECT_MODELS:
        kind = "aspect"
    else:
        raise ValueError(f"unknown model {model_name!r}")
    wanted = release or deployed_release(model_name)
    try:
        return FAMILIES[kind, wanted]
    except KeyError:
        raise ValueError(f"no release {wanted!r} of {kind} models") from None
