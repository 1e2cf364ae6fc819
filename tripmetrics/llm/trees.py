"""Trained trees as column expressions, so that scoring stays a projection over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column
from pyspark.sql import functions as f


def _tree(node, features: Column, leaf: Callable[[object], float]) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return f.lit(float(leaf(node)))
    split = node.split()
    left = _tree(node.leftChild(), features, leaf)
    right = _tree(node.rightChild(), features, leaf)
    return f.when(features[split.featureIndex()] <= split.threshold(), left).otherwise(right)


def boosted_probability(model: GBTClassificationModel, features: Column) -> Column:
    """Probability of class 1 for an array of features, as the boosted trees give it."""
    margin = f.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        root = tree._call_java("rootNode")
        margin = margin + f.lit(float(weight)) * _tree(root, features, lambda n: n.prediction())
    return f.lit(1.0) / (f.lit(1.0) + f.exp(f.lit(-2.0) * margin))


def forest_probability(model: RandomForestClassificationModel, features: Column) -> Column:
    """Probability of class 1 for an array of features: the mean over the trees' leaves."""
    total = f.lit(0.0)
    for tree in model.trees:
        root = tree._call_java("rootNode")
        total = total + _tree(root, features, lambda n: n.impurityStats().prob(1.0))
    return total / f.lit(float(len(model.trees)))
