"""Boosted trees with a full oracle: the first round on given bins, and scores of a forest given as a table."""

from __future__ import annotations

import numpy as np

from foldwise import fixtures as fx
from foldwise.operators.boosting import BoostedOptions, BoostedScorer, forest_table, grown, packed, read_forest
from foldwise.operators.classifiers import vectors
from foldwise.operators.predict import long_rows
from foldwise.queries.base import BASE, LONG, query, rounded
from foldwise.queries.features import lab
from foldwise.sources.scratch import scratch_path, stored

P = fx.LETTERS
CUTS = [0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0]
_PAIR = "pow(greatest(abs({g}) - 0.1, 0), 2) / ({h} + 0.1)"
_LEAF = "-sign({g}) * greatest(abs({g}) - 0.1, 0) / ({h} + 0.1)"


@query(
    "boosted_first_round",
    f"""{LONG}, rows AS (
      SELECT k AS fold, label, j, x, 0.25 - (target = label)::INT AS g
      FROM long, (SELECT unnest(range(0, 5)) AS k), (SELECT unnest(range(1, 5)) AS label) WHERE n_fold <> k
    ), cells AS (
      SELECT fold, label, j, c, coalesce(sum(g) FILTER (x <= c), 0) AS gl, count(*) FILTER (x <= c) * 0.1875 AS hl, sum(g) AS g, count(*) * 0.1875 AS h
      FROM rows, (SELECT unnest({CUTS}) AS c) GROUP BY ALL
    ), best AS (
      SELECT *, {_PAIR.format(g='gl', h='hl')} + {_PAIR.format(g='(g - gl)', h='(h - hl)')} - {_PAIR.format(g='g', h='h')} AS gain
      FROM cells WHERE hl >= 2 AND h - hl >= 2 QUALIFY row_number() OVER (PARTITION BY fold, label ORDER BY gain DESC, j, c) = 1
    )
    SELECT fold AS n_fold, label, j AS feature, c::DOUBLE AS cut, round({_LEAF.format(g='gl', h='hl')}, 6) + 0.0 AS left_value,
           round({_LEAF.format(g='(g - gl)', h='(h - hl)')}, 6) + 0.0 AS right_value, round(ln(4), 6) AS loss_before FROM best""",
)
def boosted_first_round(spark, sf):
    """Best split and leaf values of every fold and class, with all rows and columns, on given bins."""
    options = BoostedOptions(rate=1.0, depth=1, row_sample=1.0, column_sample=1.0, bins=len(CUTS) + 1)
    cuts = [np.array(CUTS)] * len(P.features)
    state = stored(packed(vectors(lab(spark, sf), P.features), P, cuts), "boosting")
    trees, losses = grown(state, P, cuts, set(P.folds), 0, options)
    rows = [
        (k, c + 1, int(t.feature[0]) + 1, CUTS[int(t.cut[0])], round(float(t.value[1]), 6) + 0.0, round(float(t.value[2]), 6) + 0.0, round(float(losses[k]), 6))
        for (k, c), t in sorted(trees.items())
    ]
    return spark.createDataFrame(rows, "n_fold long, label long, feature long, cut double, left_value double, right_value double, loss_before double")


TREES = range(8)


def _value(tree: int, node: int) -> float:
    return ((7 * tree + 3 * node) % 11 - 5) / 10


def rule_forest() -> BoostedScorer:
    """Two trees per class: a root, a split on its left, and leaves, from a rule."""
    feature = [[5 * t % 26, (7 * t + 3) % 26, -1, -1, -1, -1, -1] for t in TREES]
    threshold = [[10.0 + t, 3.0, 0, 0, 0, 0, 0] for t in TREES]
    value = [[_value(t, n) for n in range(7)] for t in TREES]
    return BoostedScorer(np.array(feature), np.array(threshold, float), np.array(value), np.array([t % 4 for t in TREES]), 4, 2, 26)


def _tree(t: int) -> str:
    return f"CASE WHEN feat_{5 * t % 26 + 1} > {10 + t} THEN {_value(t, 2)} WHEN feat_{(7 * t + 3) % 26 + 1} > 3 THEN {_value(t, 4)} ELSE {_value(t, 3)} END"


_MARGINS = ", ".join(f"exp({' + '.join(_tree(t) for t in TREES if t % 4 == c)})" for c in range(4))


@query(
    "given_forest",
    f"""{BASE}, scored AS (SELECT id, [{_MARGINS}]::DOUBLE[] AS e FROM lab)
    SELECT id, unnest(range(1, 5)) AS label, round(unnest(e) / list_sum(e), 6) AS prob FROM scored""",
)
def given_forest(spark, sf):
    """A forest stored as a table, read back, and scored in Arrow batches."""
    path = scratch_path(spark, "forest")
    forest_table(spark, rule_forest()).write.parquet(path)
    forest = read_forest(spark.read.parquet(path))
    scored = forest.probabilities(vectors(lab(spark, sf), P.features), "probs")
    return rounded(long_rows(scored, 4, "id"))
