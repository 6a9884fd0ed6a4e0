from __future__ import annotations

import random

import pytest

from tallyward.llm.components import components
from tallyward.llm.vectors import NearVectors
from tallyward.llm.warc import WarcStore
from tallyward.sources.scratch import Scratch


def brute(edges):
    low = {}
    for a, b in edges:
        low.setdefault(a, a), low.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


@pytest.fixture
def joins(monkeypatch):
    """The plans, from the join down, of everything that is stored."""
    found, keep = [], Scratch.keep

    def kept(self, df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        if "Join" in plan:
            found.append(plan[plan.index("Join") :])
        return keep(self, df, name)

    monkeypatch.setattr(Scratch, "keep", kept)
    return found


def edges_with_a_hub(seed=1):
    rng = random.Random(seed)
    edges = [(5, i) for i in range(200, 500)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    return edges + [(i, i + 1) for i in range(2000, 2060)] + [(7, 7)]


def test_components_of_a_hub_a_chain_and_loose_ends(spark, joins):
    edges = edges_with_a_hub()
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)
    got = {r.id: r.component for r in components(df, Scratch.create(spark)).collect()}
    want = brute(edges)
    assert got == {k: v for k, v in want.items() if k != 7}
    # no aggregate below a join: both sides are plain shuffles that can be split
    assert joins and not any("Aggregate" in plan for plan in joins)


def test_hot_components_are_joined_from_stored_tables(spark, joins):
    vector = [1.0, 2.0, 3.0]
    rows = [(i, vector if i % 2 else [float(i), 1.0, 0.0], 1) for i in range(60)]
    NearVectors().classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    last = [plan for plan in joins if "component_id" in plan]
    assert last and not any("Aggregate" in plan for plan in last)


def test_equal_pages_are_joined_from_a_stored_table(spark):
    pages = spark.createDataFrame([(i, "u", "x" * 2000) for i in range(9)], "page_id bigint, url string, html string")
    plan = WarcStore().decided(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan[plan.index("Join") :]


def test_no_edges(spark):
    df = spark.createDataFrame([], "a bigint, b bigint")
    assert components(df, Scratch.create(spark)).count() == 0
