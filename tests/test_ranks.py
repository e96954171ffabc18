"""Places of rated items among all items of a model."""

from types import SimpleNamespace

import numpy as np
from conftest import SF_SMALL

from quarry.operators import recommend
from quarry.plans import check_plans

FACTORS = "id int, features array<float>"


def _plain(users, items, truth):
    """Average precision of every user with all items sorted."""
    out = {}
    for u in {a for a, _ in truth}:
        rated = {i for a, i in truth if a == u}
        order = sorted(items, key=lambda i: (-sum(float(x) * float(y) for x, y in zip(users[u], items[i])), i))
        hits, total = 0, 0.0
        for place, i in enumerate(order, 1):
            if i in rated:
                hits += 1
                total += hits / place
        out[u] = total / len(rated)
    return out


def test_ranks_with_ties_over_blocks(spark):
    rng = np.random.default_rng(2)
    users = {u: np.float32(rng.normal(size=5)).tolist() for u in range(12)}
    items = {i: np.float32(rng.normal(size=5)).tolist() for i in range(90)}
    items |= {100 + i: items[i] for i in range(20)} | {200: [0.0] * 5, 201: [0.0] * 5}
    truth = [(u, int(i)) for u in users for i in rng.choice(sorted(items), 30, replace=False)] + [(3, 999), (77, 1)]
    model = SimpleNamespace(userFactors=spark.createDataFrame(list(users.items()), FACTORS),
                            itemFactors=spark.createDataFrame(list(items.items()), FACTORS))
    t = spark.createDataFrame(truth + truth[:5], "user int, item int")
    got = {(r.user, r.item): r["rank"] for r in recommend.rated_ranks(model, t, block=16, rows=50, longest=8).collect()}
    want = {}
    for u, vec in users.items():
        order = sorted(items, key=lambda i: (-sum(float(x) * float(y) for x, y in zip(vec, items[i])), i))
        want |= {(u, i): k + 1 for k, i in enumerate(order) if (u, i) in truth}
    assert got == want and len(got) == 360


def test_map_ranks_all_items(spark):
    """MAP equals that of every user with all items sorted: nothing is cut at the length of the lists."""
    model, data, lists = check_plans._als(spark, SF_SMALL)
    users = {r.id: list(r.features) for r in model.userFactors.collect()}
    items = {r.id: list(r.features) for r in model.itemFactors.collect()}
    plain = _plain(users, items, {(r.user, r.item) for r in data.collect()})
    row = check_plans._ranking(model, data, lists).first()
    assert row["n_users"] == len(plain) and abs(row["map"] - sum(plain.values()) / len(plain)) < 1e-9


def test_users_without_truth_score_one(spark):
    from quarry.operators import metrics
    truth = spark.createDataFrame([(1, 10), (2, 20)], "user long, item long")
    ranked = spark.createDataFrame([(1, 10, 1), (2, 21, 1)], "user long, item long, rank int")
    users = spark.createDataFrame([(1,), (2,), (3,), (3,)], "user long")
    got = metrics.average_precision(truth, ranked, "user", "item", "rank", 5, users)
    assert {r["user"]: r["ap"] for r in got.collect()} == {1: 1.0, 2: 0.0, 3: 1.0}


def test_items_are_not_copied_for_lists(spark, monkeypatch):
    """Lists and items meet by rounds: what is written is one row a list, whatever the number of items or lists."""
    written = {}
    plain = recommend.materialise

    def counted(df, name):
        out = plain(df, name)
        written.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(recommend, "materialise", counted)
    rng = np.random.default_rng(3)
    users = [(u, np.float32(rng.normal(size=5)).tolist()) for u in range(20)]
    items = [(i, np.float32(rng.normal(size=5)).tolist()) for i in range(100)]
    model = SimpleNamespace(userFactors=spark.createDataFrame(users, FACTORS), itemFactors=spark.createDataFrame(items, FACTORS))
    truth = spark.createDataFrame([(u, i) for u in range(20) for i in range(u, u + 3)], "user int, item int")
    assert recommend.rated_ranks(model, truth, block=8, rows=40).count() == 60
    assert written == {"items-by-id": [100], "rank-lists": [20, 20, 20]}
