"""Grown trees beside a plain recursive tree in Python."""

import itertools
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from firnspark.operators import families, scoring, tables, training, trees
from firnspark.session import materialise

CELLS = "region_id string, season_year int, slot int, k0 long, k1 long, k2 long, y long, n long"
TUPLES = "region_id string, model_year int, k0 long, k1 long, k2 long"


def drawn(seed, codes=(0, 1, 3, 4, 8)):
    rng, cells = random.Random(seed), {}
    for slot in range(3):
        for _ in range(40):
            key = (slot, *(rng.choice(codes) for _ in range(3)), rng.randrange(4))
            cells[key] = rng.randint(1, 4)
    return cells


def grow(cells, features, depth=None):
    """cells: {(codes): Counter}; a nested (feature, threshold, left, right) or the ranked classes."""
    total = sum(cells.values(), Counter())
    ranked = sorted(total, key=lambda y: (-total[y], y))
    best = None
    if len(total) > 1 and depth != 0:
        for feature in features:
            values = sorted({codes[feature] for codes in cells})
            for low, high in itertools.pairwise(values):
                purity = Fraction(0)
                for side in (True, False):
                    part = sum((c for codes, c in cells.items() if (codes[feature] <= low) == side), Counter())
                    purity += Fraction(sum(n * n for n in part.values()), sum(part.values()))
                if best is None or purity > best[0]:
                    best = purity, feature, (low + high) / 2
    if best is None:
        return ranked
    _, feature, threshold = best
    below = None if depth is None else depth - 1
    sides = [{c: n for c, n in cells.items() if (c[feature] > threshold) == right} for right in (False, True)]
    return feature, threshold, *[grow(side, features, below) for side in sides]


def look_up(tree, codes):
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = right if codes[feature] > threshold else left
    return tree


def expected_trees(cells, depth):
    out = []
    for slot in range(3):
        held = {}
        for (own, *codes, y), n in cells.items():
            if own == slot:
                held.setdefault((codes[0], -1, -1) if slot == 0 else tuple(codes), Counter())[y] += n
        out.append(grow(held, (0,) if slot == 0 else (0, 1, 2), depth))
    return out


@pytest.mark.parametrize("depth", [None, 0, 3])
def test_trees_and_their_leaves(spark, depth):
    """Seen and unseen tuples alike get the classes of the leaf a plain tree leads to."""
    cells = {f"R{seed}": drawn(seed) for seed in range(3)}
    rows = [(region, 2000, key[0], *key[1:4], key[4], n) for region, held in cells.items() for key, n in held.items()]
    counts = spark.createDataFrame(rows, CELLS)
    grown = trees.fit_trees(counts, (2000, 2002), depth)
    assert grown.groupBy(*trees.NODE).count().where("count > 1").count() == 0
    asked = list(itertools.product((0, 1, 2, 4, 6, 9), repeat=3))
    tuples = spark.createDataFrame([(region, 2002, *codes) for region in cells for codes in asked], TUPLES)
    found = {
        (r.region_id, r.k0, r.k1, r.k2): [r.ranked_0, r.ranked_1, r.ranked_2]
        for r in trees.resolve_by_trees(tuples, grown).collect()
    }
    wanted = {region: expected_trees(held, depth) for region, held in cells.items()}
    assert found == {
        (region, *codes): [look_up(tree, codes) for tree in wanted[region]] for region in cells for codes in asked
    }
    early = tuples.withColumn("model_year", F.lit(2001))
    assert trees.resolve_by_trees(early, grown).count() == 0


def test_no_rows_and_one_row(spark):
    assert trees.fit_trees(spark.createDataFrame([], CELLS), (2000, 2002)).count() == 0
    (node,) = trees.fit_trees(spark.createDataFrame([("R", 2000, 0, 1, 1, 1, 5, 7)], CELLS), (2000, 2002)).collect()
    assert (node.node, node.feature, node.ranked, node.n_rows) == (1, None, [5], 7)
    with pytest.raises(ValueError, match="max_depth"):
        trees.fit_trees(spark.createDataFrame([], CELLS), (2000, 2002), 99)


def test_seen_tuples_are_as_in_the_majority_table(spark):
    """A fully grown tree and the majority table agree wherever the tuple was seen."""
    from firnspark.plans import catalogue

    sf_dir = "/root/testdata/sf0.01"
    winners = catalogue.winners_of(spark, sf_dir)
    years = catalogue.model_years(spark, sf_dir)
    counts = materialise(training.class_counts(catalogue.frame_from(winners)))
    grown = materialise(trees.fit_trees(counts, years))
    majority = materialise(training.fit_majority(counts, years))
    seen = majority.where("level = 3").select("region_id", "model_year", "k0", "k1", "k2").distinct()
    columns = [*scoring.TUPLE, *[f"ranked_{s}[0] AS top_{s}" for s in range(3)]]
    by_tree = trees.resolve_by_trees(seen, grown).selectExpr(*columns)
    by_table = training.resolve_tuples(seen, majority).selectExpr(*columns)
    assert seen.count() > 500
    assert by_tree.exceptAll(by_table).count() == 0 and by_table.exceptAll(by_tree).count() == 0
    features = tables.model_inputs_of(winners)
    scored = scoring.score_problem_types(features, grown, trees.resolve_by_trees)
    assert scored.count() == scoring.score_problem_types(features, majority).count()
    family = families.FAMILIES["problem_type", "grown"]
    assert family.metrics(catalogue.frame_from(winners), grown, years).count() > 0
