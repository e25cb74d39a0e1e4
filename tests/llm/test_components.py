from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campflow.llm.components import components


def brute(links):
    root = {}
    for a, b in links:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in root and b in root and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-20, 40), st.integers(-20, 40)), max_size=60))
def test_random_graphs(spark, links):
    df = spark.createDataFrame(links, "x long, y long")
    assert {(r.node, r.root) for r in components(df).collect()} == set(brute(links).items())


def test_long_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, n) for n in range(1001, 1300)] + [(5, None), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(found.values()) == {0, 1000} and len(found) == 301 + 300
