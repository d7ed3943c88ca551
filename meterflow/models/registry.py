"""Which models each training profile fits, and how large they are.

``Budget`` decides between the full tree counts of a profile and compact ones.
Spark fits boosted trees one after another, each with its own jobs, so hundreds
of small trees suit a cluster with large data and not a quick local run.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

RIDGE = "ridge"
OLS = "ols"
ELASTIC_NET = "elastic_net"
BOOSTING = "boosting"
FOREST = "forest"
# Grown by our own aggregations: boosting with leaf penalties, and trees with random thresholds.
HISTOGRAM = "histogram"
RANDOMISED = "randomised"

# Deepest tree a compact budget grows, by kind of model.
_COMPACT_DEPTH = {BOOSTING: 5, FOREST: 8, HISTOGRAM: 4, RANDOMISED: 8}
# Compact models have this share of the trees, within the given bounds.
_COMPACT_SHARE = 12
_COMPACT_TREES = {BOOSTING: (10, 30), FOREST: (20, 40), HISTOGRAM: (8, 12), RANDOMISED: (20, 40)}
_COMPACT_STEP = 0.3
# MLlib trees have at most 30 levels; 12 hold 4,096 leaves.
_FULL_DEPTH = 12


@dataclass(frozen=True)
class ModelSpec:
    """One model of a profile. Settings a kind does not use stay at their defaults."""

    name: str
    kind: str
    alpha: float = 0.0
    l1_ratio: float = 0.0
    trees: int = 0
    step: float = 0.1
    depth: int | None = None
    min_leaf: int = 1
    rows: float = 1.0
    features: str = "all"
    bootstrap: bool = True
    bins: int = 32
    l1: float = 0.0
    l2: float = 0.0


def compact(spec: ModelSpec) -> ModelSpec:
    """A smaller model of the same kind: fewer, larger steps and flatter trees."""
    if spec.kind not in _COMPACT_TREES:
        return spec
    least, most = _COMPACT_TREES[spec.kind]
    trees = min(max(round(spec.trees / _COMPACT_SHARE), least), most)
    step = min(_COMPACT_STEP, spec.step * spec.trees / trees)
    depth = min(spec.depth or _FULL_DEPTH, _COMPACT_DEPTH[spec.kind])
    return replace(spec, trees=trees, step=step, depth=depth)


# Tree counts, learning rates, depths, leaf sizes, penalties and
# sampling shares of the three profiles.
_FAST = [
    ModelSpec("Ridge", RIDGE, alpha=1.0),
    ModelSpec("Linear Regression", OLS),
    ModelSpec("Hist Gradient Boosting", HISTOGRAM, trees=120, step=0.05, depth=6, min_leaf=20, bins=255, l2=0.1),
    ModelSpec("Extra Trees", RANDOMISED, trees=200, features="0.8"),
    ModelSpec("Random Forest", FOREST, trees=160, features="sqrt"),
    ModelSpec("XGBoost", BOOSTING, trees=180, step=0.05, depth=5, rows=0.9, features="0.9"),
    ModelSpec("XGBoost Strong", BOOSTING, trees=240, step=0.035, depth=6, min_leaf=2, rows=0.9, features="0.85"),
]
_BALANCED = [
    ModelSpec("Ridge", RIDGE, alpha=1.0),
    ModelSpec("ElasticNet", ELASTIC_NET, alpha=0.002, l1_ratio=0.2),
    ModelSpec("Linear Regression", OLS),
    ModelSpec("Gradient Boosting", BOOSTING, trees=380, step=0.025, depth=3, min_leaf=2),
    ModelSpec("Hist Gradient Boosting", HISTOGRAM, trees=320, step=0.04, depth=10, min_leaf=20, bins=255, l2=0.1),
    ModelSpec("Extra Trees", RANDOMISED, trees=500, features="0.8"),
    ModelSpec("Extra Trees Smoothed", RANDOMISED, trees=350, rows=0.8),
    ModelSpec("Random Forest", FOREST, trees=420, features="sqrt", min_leaf=2),
    ModelSpec("XGBoost", BOOSTING, trees=420, step=0.03, depth=6, min_leaf=2, rows=0.92, features="0.88"),
    ModelSpec("XGBoost Strong", BOOSTING, trees=560, step=0.02, depth=7, min_leaf=3, rows=0.9, features="0.85"),
]
_FULL = [
    ModelSpec("Ridge", RIDGE, alpha=0.8),
    ModelSpec("ElasticNet", ELASTIC_NET, alpha=0.0015, l1_ratio=0.15),
    ModelSpec("Linear Regression", OLS),
    ModelSpec("Gradient Boosting", BOOSTING, trees=420, step=0.025, depth=3, min_leaf=2),
    ModelSpec("Hist Gradient Boosting", HISTOGRAM, trees=400, step=0.035, depth=12, min_leaf=20, bins=255, l2=0.1),
    ModelSpec("Extra Trees", RANDOMISED, trees=700, features="0.8"),
    ModelSpec("Extra Trees Smoothed", RANDOMISED, trees=350, rows=0.8),
    ModelSpec("Random Forest", FOREST, trees=500, features="sqrt", min_leaf=2),
    ModelSpec("XGBoost", BOOSTING, trees=500, step=0.025, depth=6, min_leaf=2, rows=0.92, features="0.9"),
    ModelSpec("XGBoost Strong", BOOSTING, trees=650, step=0.02, depth=7, min_leaf=3, rows=0.9, features="0.85"),
]
_PROFILES = {"fast": _FAST, "balanced": _BALANCED, "full": _FULL}

_COMPACT_FRAME_TREES = {"fast": 220, "balanced": 350, "full": 420}

_FAST_CLASSIFIERS = [
    ModelSpec("RandomForest", FOREST, trees=100, features="sqrt"),
    ModelSpec("ExtraTrees", FOREST, trees=120, features="sqrt", bootstrap=False),
]
_CLASSIFIERS = [
    ModelSpec("RandomForest", FOREST, trees=450, features="sqrt"),
    ModelSpec("ExtraTrees", FOREST, trees=500, features="sqrt", bootstrap=False),
    ModelSpec("GradientBoosting", BOOSTING, trees=250, step=0.05, depth=3),
]
_COMPACT_FRAME_CLASSIFIER_TREES = {"fast": 100, "balanced": 300, "full": 450}

# A round of boosted classifiers grows a tree for every hour of the day.
_COMPACT_ROUNDS = 10


def profile_name(profile: str) -> str:
    """Case and spaces do not matter; an unknown profile is ``balanced``."""
    name = profile.lower().strip()
    return name if name in _PROFILES else "balanced"


def regressors(
    profile: str = "balanced", full_budget: bool = False, compact_frame: bool = False
) -> list[ModelSpec]:
    """The regressors of a profile; ``compact_frame`` names the older, shorter list."""
    name = profile_name(profile)
    found = _PROFILES[name]
    if compact_frame:
        trees = _COMPACT_FRAME_TREES[name]
        found = [
            ModelSpec("Linear Regression", OLS),
            ModelSpec("Gradient Boosting", BOOSTING, trees=trees, step=0.03, depth=3),
        ]
    return found if full_budget else [compact(spec) for spec in found]


def classifiers(
    profile: str = "balanced", full_budget: bool = False, compact_frame: bool = False
) -> list[ModelSpec]:
    name = profile_name(profile)
    found = _FAST_CLASSIFIERS if name == "fast" else _CLASSIFIERS
    if compact_frame:
        trees = _COMPACT_FRAME_CLASSIFIER_TREES[name]
        found = [ModelSpec("RandomForest", FOREST, trees=trees, features="sqrt")]
    if full_budget:
        return found
    return [
        replace(compact(spec), trees=_COMPACT_ROUNDS)
        if spec.kind == BOOSTING
        else compact(spec)
        for spec in found
    ]


def full_depth(spec: ModelSpec) -> int:
    return spec.depth or _FULL_DEPTH
