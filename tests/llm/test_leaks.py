"""Leaks of benchmark items, judged alignment by alignment, against a plain version."""

import re
from collections import defaultdict

from llm_paths import SF_DIR

from ferryline.llm import decontaminate

ITEM = "if you take 12 red apples from a box and later give 12 of those apples away how many apples are left"


def kept(spark, docs, items, *texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return [r.doc_id for r in decontaminate.decontaminate(docs(*enumerate(texts)), bench).orderBy("doc_id").collect()]


def test_a_verbatim_leak_beside_a_changed_variant(spark, docs):
    variant = ITEM.replace("12 red", "45 red").replace("12 of", "46 of")
    assert kept(spark, docs, [ITEM], f"{ITEM}. {variant}", f"{variant} {ITEM} {variant}", variant, "x") == [2, 3]


def test_values_that_become_one_value(spark, docs):
    item = "if you take 12 red apples from a box and later give 7 of those apples away how many apples are left"
    same = item.replace("12", "5").replace(" 7 ", " 5 ")
    other = item.replace("12", "5").replace(" 7 ", " 9 ")
    assert kept(spark, docs, [item], same, other) == [0]


def test_words_put_in_or_left_out(spark, docs):
    words = ITEM.split()
    put_in = " ".join([*words[:10], "then", "also", *words[10:]])
    assert kept(spark, docs, [ITEM], put_in, " ".join(words[:17] + words[18:])) == []


def test_hits_far_apart_do_not_add_up(spark, docs):
    words = ITEM.split()
    far = " ".join([*words[:10], *["filler"] * 40, *words[10:]])
    assert kept(spark, docs, [ITEM], far) == [0]


def folded(text):
    """Words of a text in lower case; marks within numbers belong to them."""
    return re.findall(r"[0-9](?:(?<=[0-9])[.,'’  ](?=[0-9])|[^\W_])*|[^\W_](?:(?<=[0-9])[.,'’  ](?=[0-9])|[^\W_])*",
                      text.lower())


def test_verbatim_items_of_the_test_table(spark):
    """Every document that holds an item's words in a row, found by trying all places."""
    read = spark.read.parquet
    docs, bench = read(f"{SF_DIR}/documents.parquet"), read(f"{SF_DIR}/benchmark.parquet")
    items = [folded(r.text) for r in bench.collect()]
    by_start = defaultdict(list)
    for words in items:
        by_start[tuple(words[:3])].append(words)
    holds = set()
    for r in docs.collect():
        words = folded(r.text)
        if any(words[i:i + len(item)] == item for i in range(len(words) - 2)
               for item in by_start.get(tuple(words[i:i + 3]), [])):
            holds.add(r.doc_id)
    rows, leaks = decontaminate.find_leaks(docs, bench, keep=["doc_id"])
    found = {r.doc_id for r in rows.join(leaks, "uid").select("doc.doc_id").collect()}
    assert holds and holds <= found
    # Whatever else is found shares half the windows of an item: five words in a row at least.
    grams = {tuple(w[k:k + 5]) for w in items for k in range(len(w) - 4)}
    texts = {r.doc_id: folded(r.text) for r in docs.collect()}
    for i in found - holds:
        assert any(tuple(texts[i][k:k + 5]) in grams for k in range(len(texts[i]) - 4))


def test_bitmaps_of_any_size_find_the_same(spark, docs, monkeypatch):
    """Two words of bits, nearly all set, and a benchmark that is joined by shuffling."""
    texts = [ITEM, ITEM.upper(), "x " * 9, f"a {ITEM} b", "", "give the apples away in the box you take later if you like"]
    found = kept(spark, docs, [ITEM, "why"], *texts, "Why not")
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "LEAST_WORDS", 1)
    monkeypatch.setattr(decontaminate, "MOST_WORDS", 1)
    assert kept(spark, docs, [ITEM, "why"], *texts, "Why not") == found == [2, 4, 5]


def test_what_rows_met_is_never_broadcast(spark, docs, monkeypatch):
    """Stored rows are many times larger than their files, which are all that Spark knows of them."""
    plans, store = [], decontaminate.materialize

    def planned(df, purpose, *more):
        if purpose == "met":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, purpose, *more)

    monkeypatch.setattr(decontaminate, "materialize", planned)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    texts = [f"{ITEM} {k}" for k in range(20)] + ["x"]
    bench = spark.createDataFrame([(0, ITEM)], "item_id bigint, text string")
    _, leaks = decontaminate.find_leaks(docs(*enumerate(texts)), bench)
    plans.append(leaks._jdf.queryExecution().executedPlan().toString())
    assert [(r.item_id, r.coverage) for r in leaks.collect()] == [(0, 1.0)] * 20
    plans.append(leaks._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Broadcast" in plan for plan in plans)
