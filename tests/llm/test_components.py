import re
from pathlib import Path

from sparkmart.llm import common, components
from tests.llm import helpers as H


def _labels(spark, edges):
    return {r["node"]: r["label"] for r in components.components(H.docs(spark, edges, "a bigint, b bigint")).collect()}


def test_components_against_brute_force(spark):
    chain = [(i + 1, i) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = chain + star + [(7, 7), (500, 500), (300, 200), (300, 200), (200, 300), (-5, 300)]
    real = [e for e in edges if e[0] != e[1]]
    assert _labels(spark, edges) == H.classes({x for e in real for x in e}, real)
    assert _labels(spark, [(1, 1)]) == {} and _labels(spark, []) == {}


def test_a_round_is_four_jobs(spark, monkeypatch):
    names = []
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or common.written(df, name))
    sc = spark.sparkContext
    sc.setJobGroup("test_components", "jobs of all rounds")
    try:
        _labels(spark, [(i, i // 2) for i in range(1, 60)])
        jobs = len(sc.statusTracker().getJobIdsForGroup("test_components"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    rounds = names.count("labels") - 1
    assert rounds > 1 and jobs <= 6 + 4 * rounds, (jobs, rounds)    # 6: the edges, the first labels and the result


def test_freed_memory_goes_back_to_the_system():
    def held():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    parts = [bytes(b"x" * 40_000) for _ in range(2500)]
    after = [bytes(1000) for _ in range(1000)]       # what lies behind keeps the C library from trimming by itself
    full = held()
    parts.clear()
    common.release_memory()
    assert len(after) == 1000 and held() < full - 60
