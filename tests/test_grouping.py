"""Grouping and families against small models of their meaning, on random inputs."""

import random

from barkline.operators import grouping as gp

D = 1


def model_groups(counts):
    """counts: {umi: (n, first_seen)} -> {umi: parent}: roots in rank order claim what they reach."""
    near = lambda a, b: sum(x != y for x, y in zip(a, b)) <= D
    order = sorted(counts, key=lambda u: (-counts[u][0], counts[u][1], u))
    parent = {}
    for root in order:
        if root in parent:
            continue
        todo, seen = [root], {root}
        while todo:
            a = todo.pop()
            for b in counts:
                if b not in seen and near(a, b) and counts[a][0] >= 2 * counts[b][0] - 1:
                    seen.add(b)
                    todo.append(b)
        for u in seen:
            parent.setdefault(u, root)
    return parent


def model_families(entries, threshold):
    """entries: [(pos, n)] -> [(fam_pos, fam_n)] by the greedy rule."""
    left, out = list(entries), []
    while left:
        seed = max(left, key=lambda e: (e[1], e[0]))
        near = [e for e in left if abs(e[0] - seed[0]) <= threshold]
        out.append((seed[0], sum(n for _, n in near)))
        left = [e for e in left if abs(e[0] - seed[0]) > threshold]
    return sorted(out)


def test_groups_equal_the_model(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for r in range(6):
        umis = {"".join(rng.choice("AC") if k < 3 else rng.choice("ACGT") for k in range(5)): (rng.choice([1, 1, 2, 3, 5, 9]), k) for k in range(40)}
        rows += [(f"r{r}", u, n, s) for u, (n, s) in umis.items()]
        want |= {(f"r{r}", u, p) for u, p in model_groups(umis).items()}
    rng.shuffle(rows)
    counts = spark.createDataFrame(rows, "region string, umi string, n bigint, first_seen bigint")
    got = gp.umi_groups(counts, gp.umi_edges(counts, 5, D))
    assert {tuple(r) for r in got.collect()} == want


def test_edges_at_two_mismatches(spark):
    rng = random.Random(6)
    umis = sorted({"".join(rng.choice("ACG") for _ in range(7)) for _ in range(120)})
    counts = spark.createDataFrame([("r", u, 1, k) for k, u in enumerate(umis)], "region string, umi string, n bigint, first_seen bigint")
    got = {(r["src"], r["dst"]) for r in gp.umi_edges(counts, 7, 2).collect()}
    assert got == {(a, b) for a in umis for b in umis if a != b and sum(x != y for x, y in zip(a, b)) <= 2}
    assert gp.umi_edges(counts, 7, 2).count() == len(got)


def test_families_equal_the_model(spark):
    rng = random.Random(7)
    rows, want = [], set()
    for p in range(40):
        entries = [(rng.randrange(60), rng.randrange(1, 5)) for _ in range(rng.randrange(1, 12))]
        rows += [("r", f"P{p:02}", f"U{k}", pos, n) for k, (pos, n) in enumerate(entries)]
        want |= {("r", f"P{p:02}", a, n) for a, n in model_families(entries, 5)}
    positions = spark.createDataFrame(rows, "region string, parent string, umi string, pos bigint, n bigint")
    got = gp.umi_families(positions, 5)
    assert {tuple(r) for r in got.collect()} == want
    again = gp.umi_families(positions.repartition(7, "umi"), 5)
    assert {tuple(r) for r in again.collect()} == want


def test_lengths_must_agree(spark):
    import pytest

    counts = spark.createDataFrame([("r", "AC", 1, 1), ("r", "ACG", 1, 2)], "region string, umi string, n bigint, first_seen bigint")
    with pytest.raises(ValueError):
        gp.checked_counts(counts)


def test_empty(spark):
    counts = spark.createDataFrame([], "region string, umi string, n bigint, first_seen bigint")
    assert gp.umi_groups(counts, gp.umi_edges(counts, 4)).count() == 0
