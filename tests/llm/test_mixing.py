import math
import random
from collections import Counter

import pytest

from sievemill.llm import mixing
from tests.llm.helpers import DOCS


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", "clash", 1, 2) for i, t, s in rows], f"{DOCS}, whole int, blocks int")


@pytest.mark.parametrize("limit", [1.0, 1.5, 3.0, 100.0])
def test_solve_keeps_the_limit(limit):
    tokens = [1000.0, 200.0, 50.0, 0.0]
    m = mixing.solve(tokens, repetition=limit)
    assert max(m.passes) <= limit + 1e-9 and min(m.passes) >= 1
    assert m.exponent == 0 or max(m.passes) == pytest.approx(limit, rel=1e-6)  # no flatter mix fits
    assert sum(m.weights) == pytest.approx(1)


def test_solve_meets_the_entropy():
    tokens = [1000.0, 200.0, 50.0]
    shares = [t / 1250 for t in tokens]
    own = -sum(p * math.log(p) for p in shares)
    target = (own + math.log(3)) / 2
    m = mixing.solve(tokens, entropy=target)
    assert -sum(w * math.log(w) for w in m.weights) == pytest.approx(target, abs=1e-9)
    assert mixing.solve(tokens, entropy=9.0).weights == pytest.approx([1 / 3] * 3)
    with pytest.raises(ValueError):
        mixing.solve(tokens)


def test_rows_follow_the_plan(spark):
    r = random.Random(1)
    rows = [(i, "w " * r.randint(1, 30), "hot" if i < 300 else f"s{i % 3}") for i in range(420)] + [(900, "", "hot"), (901, None, "void"), (902, "a b", None)]
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len((t or "").split())
    known = sorted(tokens, key=lambda s: (s is not None, s or ""))
    plan = mixing.solve([float(tokens[s]) for s in known], repetition=2.5)
    got = mixing.mix(frame(spark, rows), repetition=2.5, block_tokens=200).collect()
    taken, times = Counter(), Counter()
    for g in got:
        taken[g.source] += g["mix tokens"]
        times[g.doc_id] += 1
        assert g.id == "clash" and 0 <= g["mix key"] <= 1
    assert set(times) == {i for i, _, _ in rows}  # none is lost
    for s, p in zip(known, plan.passes, strict=True):
        assert p * tokens[s] - 1 <= taken[s] <= p * tokens[s] + 31  # the document that crosses the budget is taken
        assert {times[i] for i, t, x in rows if x == s and t} <= {int(p), int(p) + 1}
    assert len({(g.doc_id, g["mix epoch"]) for g in got}) == len(got)
    # the hot source is spread over the whole order
    half = sorted(got, key=lambda g: g["mix key"])[: len(got) // 2]
    assert abs(sum(g.source == "hot" for g in half) / len(half) - sum(g.source == "hot" for g in got) / len(got)) < 0.12


def rows_of(df):
    return sorted(((x.doc_id, x.source, x["mix tokens"], x["mix epoch"], round(x["mix key"], 12)) for x in df.collect()), key=str)


def test_many_sources_give_the_same(spark, monkeypatch):
    """More sources, and more token counts, than are collected or broadcast."""
    r = random.Random(3)
    df = frame(spark, [(i, "w " * r.randint(0, 30), f"s{int(r.random() ** 3 * 60)}") for i in range(800)])
    for how in ({"repetition": 2.5}, {"entropy": 3.9}):
        want = rows_of(mixing.mix(df, block_tokens=50, **how))
        with monkeypatch.context() as m:
            m.setattr(mixing, "MAX_COUNTS", 3)
            assert rows_of(mixing.mix(df, block_tokens=50, **how)) == want


def brute_mix(rows, plan, known, xx, block_tokens):
    """Emissions (id, source, tokens) -> times by going through all blocks of each source in order; xx: hashes from Spark."""
    times = Counter()
    for s, passes in zip(known, plan.passes, strict=True):
        mine = [(i, t, len((t or "").split())) for i, t, x in rows if x == s]
        total = sum(n for *_, n in mine)
        blocks, whole = max(1, round(total / block_tokens)), int(passes)
        left = round((passes - whole) * total)
        held = {}
        for i, t, n in mine:
            times[i] += whole
            if n:
                held.setdefault(xx["deal", i] % blocks, []).append((xx["deal", i], i, n))
        for b in sorted(held, key=lambda b: (xx["turn", whole, b], b)):
            for _, i, n in sorted(held[b]):
                if left > 0:
                    times[i] += 1
                    left -= n
    return times


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_going_through_all_blocks(spark, seed):
    from pyspark.sql import functions as F

    r = random.Random(seed)
    rows = [(i, "w " * r.randint(0, 25), r.choice(["a"] * 8 + ["b", "b", "c", None])) for i in range(500)]
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    known = sorted(tokens, key=lambda s: (s is not None, s or ""))
    plan = mixing.solve([float(tokens[s]) for s in known], repetition=2.6)
    df = frame(spark, rows)
    xx = {("deal", x.doc_id): x.h for x in df.select("doc_id", F.xxhash64(F.lit(1), "doc_id", "text").alias("h")).collect()}
    xx |= {("turn", x.w, x.b): x.h for x in spark.range(4).crossJoin(spark.range(300).withColumnRenamed("id", "b")).selectExpr("cast(id as int) w", "cast(b as int) b").withColumn("h", F.xxhash64(F.lit(1), "w", "b")).collect()}
    for block_tokens in (30, 100, 100_000):
        got = Counter(x.doc_id for x in mixing.mix(df, repetition=2.6, block_tokens=block_tokens).select("doc_id").collect())
        assert got == brute_mix(rows, plan, known, xx, block_tokens)


def test_query_equals_the_plan_on_a_whole_table(spark, sf_dir):
    """Each source's tokens and documents in the registered query's result."""
    from sievemill.llm.queries import queries

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += len((r.text or "").split())
    known = sorted(tokens, key=lambda s: (s is not None, s or ""))
    plan = dict(zip(known, mixing.solve([float(tokens[s]) for s in known], repetition=mixing.REPETITION).passes, strict=True))
    got, taken = queries()["op5_temperature_mixing"](spark, sf_dir).collect(), Counter()
    for g in got:
        taken[g.source] += g.n_tokens
    assert {g.doc_id for g in got} == {r.doc_id for r in rows}
    longest = max(len((r.text or "").split()) for r in rows)
    for s in known:
        assert plan[s] * tokens[s] - 1 <= taken[s] <= plan[s] * tokens[s] + longest


def test_empty(spark):
    assert mixing.mix(frame(spark, []), repetition=2).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None), (2, "", "x")]), entropy=1.0).count() == 2
    with pytest.raises(ValueError):
        mixing.mix(frame(spark, [(1, "a", "x")]))


def test_repeated_rows_stay(spark):
    got = mixing.mix(frame(spark, [(1, "a b", "x"), (1, "a b", "x"), (None, "c", "x")]), repetition=1.0).collect()
    assert len(got) == 3


def test_copies_at_the_edge_are_taken_together(spark):
    """Equal rows are dealt as one: the partial pass takes all of them or none."""
    rows = [(1, "a b c", "x")] * 50 + [(i, "d e", "x") for i in range(2, 40)] + [(100 + i, "f " * 40, "big") for i in range(30)]
    got = Counter((x.doc_id, x["mix epoch"]) for x in mixing.mix(frame(spark, rows), repetition=1.5).collect() if x.source == "x")
    assert got[1, 0] == 50 and got[1, 1] in (0, 50)
    taken = sum(n * (3 if i == 1 else 2) for (i, _), n in got.items())
    assert 1.5 * 226 - 1 <= taken <= 1.5 * 226 + 150
