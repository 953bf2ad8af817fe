"""End-to-end plans: feature table, training sets, training matrices."""

from postpulse.plans.exploration import Exploration
from postpulse.plans.models import set_cells, set_models
from postpulse.plans.training import (
    TARGETS,
    feature_columns,
    feature_table,
    label_posts,
    post_keys,
    post_labels,
    training_matrix,
    training_samples,
    training_sets,
    training_sets_of_labels,
    write_training_sets,
)

__all__ = [
    "TARGETS",
    "Exploration",
    "feature_columns",
    "feature_table",
    "label_posts",
    "post_keys",
    "post_labels",
    "set_cells",
    "set_models",
    "training_matrix",
    "training_samples",
    "training_sets",
    "training_sets_of_labels",
    "write_training_sets",
]
