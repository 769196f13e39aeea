"""Models by the names used in evaluation configurations."""

from __future__ import annotations

import ast
from collections.abc import Callable, Mapping
from typing import Any

from goldpan.models import anomaly, classifiers, regressors
from goldpan.models.anomaly import Detector
from goldpan.models.base import Fit

Factory = Callable[..., Fit | Detector]

# fixed values: the model names of evaluation configurations
CLASSIFIERS: dict[str, Factory] = {
    "Logistic Regression": classifiers.logistic,
    "Ridge Classifier": classifiers.ridge,
    "Decision Tree": classifiers.tree,
    "Random Forest": classifiers.forest,
    "Gradient Boosting": classifiers.boosting,
    "AdaBoost": classifiers.adaboost,
    "Bagging Classifier": classifiers.bagging,
    "SVC (RBF Kernel)": classifiers.rff_svc,
    "SVC (Linear Kernel)": classifiers.linear_svc,
    "K-Nearest Neighbors": classifiers.knn,
    "MLP Classifier (Neural Net)": classifiers.mlp,
    "Gaussian Naive Bayes": classifiers.gaussian_nb,
    "Bernoulli Naive Bayes": classifiers.bernoulli_nb,
    "Quadratic Discriminant Analysis": lambda: classifiers.discriminant(pooled=False),
    "Linear Discriminant Analysis": lambda: classifiers.discriminant(pooled=True),
}

REGRESSORS: dict[str, Factory] = {
    "Linear Regression": regressors.linear,
    "Ridge Regression": regressors.ridge,
    "Lasso Regression": regressors.lasso,
    "ElasticNet": regressors.elastic_net,
    "Bayesian Ridge": regressors.bayesian_ridge,
    "Decision Tree": regressors.tree,
    "Random Forest": regressors.forest,
    "Gradient Boosting": lambda **p: regressors.boosting("gradient", **p),
    "Hist Gradient Boosting": lambda **p: regressors.boosting("histogram", **p),
    "AdaBoost": regressors.adaboost,
    "SVR (RBF Kernel)": regressors.rff_huber,
    "SVR (Linear Kernel)": regressors.huber,
    "K-Nearest Neighbors": regressors.knn,
    "Polynomial Regression (Degree 2)": lambda: regressors.polynomial(2),
    "XGBoost": lambda **p: regressors.boosting("depthwise", **p),
    "LightGBM": lambda **p: regressors.boosting("leafwise", **p),
    "CatBoost": lambda **p: regressors.boosting("symmetric", **p),
}

ANOMALY: dict[str, Factory] = {
    "Isolation Forest": anomaly.forest_detector,
    "Local Outlier Factor": anomaly.neighbour_detector,
    "Elliptic Envelope": anomaly.envelope_detector,
}

TIME_SERIES = ("ARIMA", "SARIMA", "Prophet")
MODELS: dict[str, Mapping[str, Factory]] = {"classification": CLASSIFIERS, "regression": REGRESSORS, "anomaly-detection": ANOMALY}

# fixed values: parameter names of configured constructors -> ours
_TREE = {"max_depth": "max_depth", "random_state": "seed"}
_FOREST = {"n_estimators": "num_trees", **_TREE}
_ROUNDS = {"n_estimators": "rounds", "learning_rate": "learning_rate", "random_state": "seed"}
_BOOSTING = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate", "random_state": "seed"}
PARAMETERS: dict[str, dict[str, dict[str, str]]] = {
    "classification": {
        "Logistic Regression": {"max_iter": "max_iter", "C": "c"},
        "Ridge Classifier": {"alpha": "alpha"},
        "Decision Tree": _TREE,
        "Random Forest": _FOREST,
        "Gradient Boosting": {"n_estimators": "rounds", "max_depth": "max_depth", "learning_rate": "step", "random_state": "seed"},
        "AdaBoost": _ROUNDS,
        "Bagging Classifier": {"n_estimators": "num_trees", "random_state": "seed"},
        "SVC (RBF Kernel)": {"C": "c", "max_iter": "max_iter", "n_components": "components", "random_state": "seed"},
        "SVC (Linear Kernel)": {"C": "c", "max_iter": "max_iter"},
        "K-Nearest Neighbors": {"n_neighbors": "k"},
        "MLP Classifier (Neural Net)": {"hidden_layer_sizes": "hidden", "max_iter": "max_iter", "random_state": "seed", "early_stopping": "early_stopping",
                                        "validation_fraction": "validation", "n_iter_no_change": "patience", "tol": "tolerance"},
        "Gaussian Naive Bayes": {"var_smoothing": "smoothing"},
        "Bernoulli Naive Bayes": {"binarize": "threshold", "alpha": "alpha"},
    },
    "regression": {
        "Ridge Regression": {"alpha": "alpha"},
        "Lasso Regression": {"alpha": "alpha"},
        "ElasticNet": {"alpha": "alpha", "l1_ratio": "l1_ratio"},
        "Bayesian Ridge": {"max_iter": "max_iter", "tol": "tolerance"},
        "Decision Tree": _TREE,
        "Random Forest": _FOREST,
        "Gradient Boosting": _BOOSTING,
        "Hist Gradient Boosting": {"max_iter": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize", "max_bins": "maxBins", "random_state": "seed"},
        "AdaBoost": _ROUNDS,
        "SVR (RBF Kernel)": {"n_components": "components", "random_state": "seed"},
        "SVR (Linear Kernel)": {"max_iter": "max_iter"},
        "K-Nearest Neighbors": {"n_neighbors": "k"},
        "XGBoost": _BOOSTING,
        "LightGBM": _BOOSTING,
        "CatBoost": {"iterations": "maxIter", "depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate", "random_seed": "seed"},
    },
    "anomaly-detection": {
        "Isolation Forest": {"n_estimators": "trees", "random_state": "seed"},
        "Local Outlier Factor": {"n_neighbors": "k"},
        "Elliptic Envelope": {"contamination": "contamination", "support_fraction": "support"},
    },
}

# They change no prediction, or are part of what the name stands for: all scores are probabilities, fits end at their own tolerance.
NO_EFFECT = {"verbose", "verbosity", "silent", "n_jobs", "probability"}
STANDS_FOR: dict[str, dict[str, Any]] = {
    "SVC (RBF Kernel)": {"kernel": "rbf"}, "SVC (Linear Kernel)": {"kernel": "linear"},
    "SVR (RBF Kernel)": {"kernel": "rbf"}, "SVR (Linear Kernel)": {"kernel": "linear"},
}


def literal_parameters(constructor: str) -> dict[str, Any]:
    """Keyword literals of a configured constructor text.  The text is parsed, never executed."""
    try:
        call = ast.parse(constructor, mode="eval").body
        if not isinstance(call, ast.Call):
            raise ValueError
        return {k.arg: ast.literal_eval(k.value) for k in call.keywords if k.arg}
    except (SyntaxError, ValueError) as error:
        raise ValueError(f"not a constructor with literal parameters: {constructor!r}") from error


def translated(problem: str, name: str, literals: Mapping[str, Any]) -> dict[str, Any]:
    """Parameters of a configured constructor as ours; one that would have no effect here is an error.  None leaves the default."""
    known, implied = PARAMETERS[problem].get(name, {}), STANDS_FOR.get(name, {})
    refused = [k for k, v in literals.items() if k not in known and k not in NO_EFFECT and not (k in implied and implied[k] == v)]
    if refused:
        raise ValueError(f"{name}: parameters without effect here: {refused}; known: {sorted(known)}")
    return {known[k]: v for k, v in literals.items() if k in known and v is not None}


def build(problem: str, name: str, given: str | Mapping[str, Any] | None = None) -> Fit | Detector:
    """The model ``name`` with parameters given as a mapping of ours or as a configured constructor text."""
    if problem not in MODELS:
        raise ValueError(f"unknown problem type {problem!r}; known: {sorted(MODELS)}")
    if name not in MODELS[problem]:
        raise ValueError(f"no {problem} model {name!r}; known: {sorted(MODELS[problem])}")
    if isinstance(given, str):
        given = translated(problem, name, literal_parameters(given))
    return MODELS[problem][name](**(given or {}))
