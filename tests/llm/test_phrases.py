"""Phrase mining against plain counting, and quotient filters against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferryline.llm import phrases
from ferryline.llm.quotient import QuotientFilter, filters_of, ids_of, ngrams, permute, restore


def plain(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(other == lang and len(longer) > len(words) and 100 * f >= 80 * a and any(
            longer[i:i + len(words)] == words for i in range(len(longer))) for (other, longer), f in found.items())
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, rank + 1, p.decode(), -a, left, right, totals[lang], -score)
                  for lang, all_ in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(all_)[:top]))


def made(n, seed):
    draw = random.Random(seed)
    words = ["a", "b", "Ça", "é", "New", "york", "CITY", "x y", "de", "la"]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " - "])
                       for _ in range(draw.randrange(60)))
        rows.append((draw.choice(["en", "en", "de", None, "und"]), text))
    return rows


ODD = [(None, None), ("en", ""), ("fr", "..!?"), ("en", " \t "), ("en", "a"), ("xx", "only once here"),
       ("en", "new york city " * 9_000), ("en", "w" * 300_000), ("de", "de la" * 3), ("de", ",de la,de la")]


def mined(spark, rows, **settings_):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "lang string, text string, chunk string, ids int")
    return sorted(tuple(r) for r in phrases.mine_phrases(df, **settings_).collect())


@pytest.mark.parametrize("top", [7, 2_000])
def test_phrases(spark, top):
    rows = made(400, 3) + ODD + ODD[-4:]
    assert mined(spark, rows, least=5, top=top) == plain(rows, 5, top)


def test_filters_are_merged_in_rounds(spark, monkeypatch):
    for name, value in {"CHUNK_BYTES": 2_000, "FAN": 3, "PREFIX_ROWS": 2_000, "SPLIT_BITS": 2}.items():
        monkeypatch.setattr(phrases, name, value)
    rows = made(900, 5)
    assert mined(spark, rows, least=4) == plain(rows, 4, 2_000)


def test_tables_without_phrases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", "a b c")] * 3) == [] and mined(spark, [(None, None)]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB .,\n\té", max_size=30) | st.none(), max_size=20))
def test_encoding(texts):
    words, counts, tokens = phrases.encode(pa.array(texts, pa.string()))
    names = [None, *words.to_pylist()]
    pieces = [re.findall(r"[^ \t]+", p) for t in texts for p in re.split(r"[.,\n]", (t or "").replace("B", "b"))]
    text = "\0".join(" ".join(p) for p in pieces if p)
    assert " ".join("\0" if n is None else n for n in (names[t] for t in tokens)).replace(
        " \0 ", "\0").lstrip("\0").strip() == text
    assert Counter(dict(zip(words.to_pylist(), counts.tolist()))) == Counter(w for p in pieces for w in p)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.integers(0, 2**32), st.integers(0, 8), st.integers(0, 300))
def test_filters(bits, seed, prefix_bits, n):
    prefix_bits = min(prefix_bits, 2 * bits)
    draw = np.random.default_rng(seed)
    ids = draw.integers(0, min(2**bits, draw.choice([4, 2**32])), n)
    high, low = ngrams(ids, bits)
    again = restore(high, low, 2 * bits)
    assert all((a == b).all() for a, b in zip(permute(*again, 2 * bits), (high, low)))
    expected = Counter(tuple(ids[i:i + k].tolist()) for k in (2, 3, 4) for i in range(n - k + 1) if ids[i:i + k].all())
    got = Counter()
    for prefix, f in filters_of(high, low, 2 * bits, prefix_bits):
        f = QuotientFilter.from_bytes(f.to_bytes())
        whole = QuotientFilter.merged([f, f, f])
        assert (whole.counts == 3 * f.counts).all() and (whole.high == f.high).all()
        more = min(3, 2 * bits - prefix_bits)
        for head, part in whole.split(more):
            start = np.uint64((prefix << more | head) << (2 * bits - prefix_bits - more)) if (
                prefix_bits + more) else np.uint64(0)
            for row, count in zip(ids_of(part.high | start, part.low, bits).tolist(), part.counts.tolist()):
                got[tuple(i for i in row if i)] += count
    assert got == Counter({k: 3 * v for k, v in expected.items()})


def test_large_counters_are_kept():
    f = QuotientFilter.of(np.array([5, 5, 6], np.uint64), np.array([1, 1, 2], np.uint64), 10, 2,
                          np.array([254, 1, 2**40]))
    assert QuotientFilter.from_bytes(f.to_bytes()).counts.tolist() == [255, 2**40]
