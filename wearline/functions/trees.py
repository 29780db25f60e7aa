"""Fitted trees as SQL expressions: plain comparisons of columns, without vectors or a call per row.

Spark's models read a feature vector that is put together, unpacked and read again for every ensemble.
Comparisons are compiled with the rest of the projection. Ensembles of more than ``MAX_NODES`` nodes are
left to Spark's models: an expression of that size would be compiled in too many pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NODES = 2000


def number(value: float) -> str:
    return f"({float(value)!r}D)"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def in_pieces(value: str) -> str:
    """A double as it is, in a projection that Spark leaves where it is and compiles piece by piece.

    Compiled as one method with the steps around it, as most projections are, one of many trees outgrows what
    the JVM takes or optimises: Spark keeps projections with a higher-order function apart. A filter on a forecast
    would be moved below it, with all trees written out in the condition once for each use: Spark moves none past
    what depends on the partition. Both terms are zero.
    """
    return f"({value}) + aggregate(array(), 0.0D, (a, b) -> a) + 0.0D * spark_partition_id()"


def _tree(lines: Iterator[str]):
    """One tree of Spark's description: the prediction of a leaf, or (feature, test, if it holds, else)."""
    line = next(lines)
    if line.startswith("Predict: "):
        return float(line.removeprefix("Predict: "))
    found = re.fullmatch(r"If \(feature (\d+) (?:<= (\S+)|in \{(.*)\})\)", line)
    if found is None:
        raise ValueError(f"not a node of a tree: {line}")
    test = f"<= {number(found[2])}" if found[2] else f"IN ({', '.join(map(number, found[3].split(',')))})"
    held = _tree(lines)
    next(lines)  # Else, with the opposite test
    return int(found[1]), test, held, _tree(lines)


def _trees(model) -> list:
    """All trees by one call: asking for the parts of every node takes thousands."""
    lines = iter([line.strip() for line in model.toDebugString.splitlines()])
    return [_tree(lines) for line in lines if re.match(r"Tree \d+", line)]


def _branches(tree, names: Sequence[str], leaf: Callable[[float], str]) -> str:
    if isinstance(tree, float):
        return leaf(tree)
    feature, test, held, other = tree
    return f"CASE WHEN {quoted(names[feature])} {test} THEN {_branches(held, names, leaf)} ELSE {_branches(other, names, leaf)} END"


def weighted_sum(model, names: Sequence[str]) -> str:
    """The sum of the trees' predictions, each times its weight, as boosted models predict."""
    return " + ".join(f"{number(w)} * ({_branches(tree, names, number)})"
                      for w, tree in zip(list(model.treeWeights), _trees(model), strict=True))


def leaf_numbers(model, names: Sequence[str]) -> list[str]:
    """Per tree, the place of a row's leaf among the leaves of the tree, in the order of Spark's leaf column."""
    found = []
    for tree in _trees(model):
        places = count()
        found.append(_branches(tree, names, lambda leaf: str(next(places))))
    return found


def class_shares(model) -> list[list[list[float]]]:
    """Per tree and leaf, the share of each class among the rows that the tree was grown on."""
    def leaves(node):
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            total = sum(stats)
            yield [n / total if total else 0.0 for n in stats]
        else:
            yield from leaves(node.leftChild())
            yield from leaves(node.rightChild())

    return [list(leaves(tree._call_java("rootNode"))) for tree in model.trees]


def sum_of_leaves(shares: Sequence[Sequence[Sequence[float]]], leaves: Sequence[str], k: int) -> str:
    """Entry ``k`` of the shares of a row's leaves, which are one column per tree, summed over the trees.

    Every table is a constant of the expression, so looking a leaf up is no join.
    """
    return " + ".join(f"get(array({', '.join(number(leaf[k]) for leaf in tree)}), {quoted(name)})" for tree, name in zip(shares, leaves))


def quantile_of_columns(names: Sequence[str], q: float) -> Column:
    """``ratings.quantile_of`` over ten columns in place of an array."""
    reached, below = [], "0.0D"
    for k, name in enumerate(map(quoted, names)):
        reached.append(f"WHEN {below} + {name} >= {number(q - 1e-9)} AND {name} > 0 "
                       f"THEN {number(k - 0.5)} + ({number(q)} - ({below})) / {name}")
        below = f"{below} + {name}"
    return F.expr(f"CASE WHEN {below} IS NULL THEN NULL ELSE greatest(0.0D, least(9.0D, CASE {' '.join(reached)} ELSE 9.0D END)) END")
