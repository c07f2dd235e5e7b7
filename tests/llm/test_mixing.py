"""Phases of the mix, light sources in a pool, sources without weight."""

from collections import Counter

import brute
import pytest

from ferryline.llm import mixing


@pytest.mark.parametrize("sources, period", [
    ({1: (7, 3), 2: (20, 9), 3: (1, 1), 5: (40, 5), 9: (6, 0)}, 16),
    ({1: (1, 1), 2: (500, 1000)}, 1024),
    ({k: (k * 3, k * k + 7) for k in range(1, 30)}, 1024),
    ({1: (3, 0)}, 8),
])
def test_phases_are_earliest_deadline_first(spark, sources, period):
    table = spark.createDataFrame([(s, *x) for s, x in sources.items()], "entity long, blocks long, w long")
    rows = mixing.phases(table, period).collect()
    got = [(r.entity, r.phase, b, r.start + (b - r.base) // r.share * period + r.ats[(b - r.base) % r.share])
           for r in rows for b in range(r.base, r.upto)]
    assert sorted(got) == sorted(brute.pfair(sources, period))


def mixed(spark, counts, **settings):
    rows = [(k * 100_000 + i, s) for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(table, **settings).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    slots = {}
    for r in got:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    assert sorted(slots) == list(range(len(slots)))  # no slot is empty, none holds two blocks
    for s, n in counts.items():  # the blocks of a source come in their order
        size = settings.get("block_docs", mixing.BLOCK_DOCS)
        assert [b for _, (x, b) in sorted(slots.items()) if x == s] == list(range(-(-n // size)))
    return got, [slots[t][0] for t in range(len(slots))]


def test_one_row_beside_many(spark):
    got, _ = mixed(spark, {"hot": 5000, "one": 1, None: 1})
    assert all(r.in_mix for r in got)


def test_more_sources_than_heads(spark):
    got, order = mixed(spark, {"hot": 6000, **{f"s{k}": 12 for k in range(700)}}, block_docs=4)
    assert all(r.in_mix for r in got)
    mean = order.count("hot") / len(order)
    w_hot = 6000**0.5 / (6000**0.5 + 700 * 12**0.5)
    for t in range(50, 2000, 50):  # shares are whole slots of a period, so rounding adds up from period to period
        assert abs(order[:t].count("hot") - w_hot * t) < 1 + t / mixing.PERIOD
    assert mean > w_hot


def test_pool_deals_its_slots_by_weight(spark):
    counts = {"a": 400, "b": 400, **{f"s{k}": 40 for k in range(30)}}
    _, order = mixed(spark, counts, block_docs=1, heads=2)
    seen = Counter(order[:900])
    for k in range(30):
        expected = 900 * 40**0.5 / (2 * 400**0.5 + 30 * 40**0.5)
        assert abs(seen[f"s{k}"] - expected) < 2


def test_sources_without_weight_come_last(spark):
    got, order = mixed(spark, {"a": 30, "b": 10, None: 5, "c": 7}, block_docs=1, weights={"a": 2.0, None: 1.0})
    assert set(order[:35]) == {"a", None} and set(order[35:]) == {"b", "c"}
    assert {r.source for r in got if not r.in_mix} == {"b", "c"}
    assert order[:15].count("a") == 10
    got, _ = mixed(spark, {"a": 9, "b": 3}, weights={})
    assert not any(r.in_mix for r in got)
