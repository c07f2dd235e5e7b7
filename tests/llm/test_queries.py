"""The registered queries over a whole small table, against brute force."""

import math
import zlib
from collections import Counter

import brute
import duckdb
import pytest
from llm_paths import SF_DIR

from ferryline.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def result(spark):
    def rows(name):
        return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]
    return rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF_DIR}/{t}.parquet')")
    theirs = con.sql(SQL[name])
    ours = QUERIES[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected = sorted(theirs.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert sorted(tuple(r) for r in ours.select(*columns).collect()) == expected


def test_leaks(result, table):
    items = {r["item_id"]: r["text"] for r in table("benchmark")}
    texts = {r["doc_id"]: r["text"] for r in table("documents")}
    got = {r["doc_id"]: r for r in result("op1_template_decontamination")}
    assert set(got) == set(texts)
    leaky = {i for i, t in texts.items() if any(b in t for b in items.values())}
    flagged = {i for i, r in got.items() if r["contaminated"]}
    assert leaky and leaky <= flagged
    grams = set()
    for b in items.values():
        w = b.lower().split()
        grams.update(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    for i in flagged - leaky:  # nothing without shared words is flagged
        w = texts[i].lower().split()
        assert any(tuple(w[k:k + 5]) in grams for k in range(len(w) - 4))


def test_fingerprints(result, table):
    order = sorted(table("documents"), key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in result("op2_chunk_fingerprints")}
    assert len(got) == len(order)
    prints = {}
    for r, n in zip(order, order[1:] + order[:1], strict=True):
        t, h = r["text"], len(r["text"]) // 2
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(t)
        assert g["edited_sha256"] == brute.sha(t[:len(t) - h] + n["text"][:h])
        assert prints.setdefault(t, g["fingerprint"]) == g["fingerprint"]
        own, edited = (dict(c.split(":") for c in g[k].split(",") if c) for k in ("fingerprint", "edited_fingerprint"))
        shared = sum(int(v) for k, v in own.items() if k in edited)
        assert g["near_edited"] == pytest.approx(shared / sum(map(int, own.values())))
    long = [g for g in got.values() if g["n_chars"] > 500]
    assert sum(0.3 < g["near_edited"] < 0.8 for g in long) > 0.8 * len(long)
    assert sum(g["near_edited"] > g["near_next"] for g in long) > 0.95 * len(long)


def test_secrets(result, table):
    got = {r["doc_id"]: r for r in result("op3_secret_ownership")}
    for r in table("documents"):
        spans, g = brute.base_spans(r["text"]), got[r["doc_id"]]
        assert g["base_sha256"] == brute.sha(",".join(spans))
        assert set(spans) <= set(filter(None, g["spans"].split(",")))
        counts = Counter(s.split(":")[0] for s in spans)
        assert [g["n_assign"], g["n_access"], g["n_hex"]] == [counts[k] for k in ("assign", "access", "hex")]


def test_mix_deviation(result):
    rows = result("op4_pfair_mixing")
    blocks = sorted({(r["slot"], r["source"], r["phase"], r["share"]) for r in rows})
    assert all(r["in_mix"] and r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert [b[0] for b in blocks] == list(range(len(blocks)))  # one block in each slot
    for phase in {b[2] for b in blocks}:
        own = [b for b in blocks if b[2] == phase]
        share, done = {b[1]: b[3] for b in own}, Counter()
        for t, (_, source, _, _) in enumerate(own):
            done[source] += 1
            for s, p in share.items():
                assert abs(done[s] - (t + 1) * p / 1024) < 1


def test_toxicity(result, table):
    labels = {r["doc_id"]: r["toxic"] for r in table("labels")}
    got = {r["doc_id"]: r for r in result("op5_nb_ngram_toxicity")}
    assert len(got) == len(table("documents"))
    assert all(g["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, g in got.items())
    assert all(0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5) for g in got.values())
    held = [(g["score"], labels[i]) for i, g in got.items() if g["held_out"] and i in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.9


def test_near_duplicates(result, table):
    expected = brute.near_classes([(r["doc_id"], r["text"]) for r in table("documents")])
    got = {r["doc_id"]: r for r in result("op6_probminhash")}
    assert {i: g["class_id"] for i, g in got.items()} == expected
    assert {i for i, g in got.items() if g["kept"]} == set(expected.values())


def test_language_model(result, table):
    got = {r["doc_id"]: r for r in result("op7_subword_lattice")}
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in table("documents")}
    tokens = {r["doc_id"]: brute.log_words(r["text"]) for r in table("documents")}
    counts = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    better = 0
    for i, ts in tokens.items():
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["train_tokens"]) == (held[i], len(ts), n)
        assert g["n_known"] == sum(counts[t] > 0 for t in ts)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert g["base_score"] == pytest.approx(base)
        assert g["score"] < 0
        better += held[i] and g["score"] > -3.5 * g["n_tokens"] * 3
    assert better > 0.9 * sum(held.values())


def test_repeats(result, table):
    rows = table("documents")
    got = {r["doc_id"]: r for r in result("op8_recompression")}
    for r, (n, gone, kept) in zip(rows, brute.windows_removed([r["text"] for r in rows], 35), strict=True):
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_removed"], g["kept_sha256"]) == (n, gone, brute.sha(kept)), r["doc_id"]


def test_pages(result, table):
    import html
    import re
    for g, r in zip(sorted(result("op10_text_density"), key=lambda r: r["page_id"]),
                    sorted(table("pages"), key=lambda r: r["page_id"]), strict=True):
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        words = html.unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert g["text"].split() == words
        assert (g["url"], g["n_chars"]) == (r["url"], len(g["text"]))


def test_all_queries_are_registered():
    import __spark_entry__ as contract
    assert set(QUERIES) <= set(contract.queries())
