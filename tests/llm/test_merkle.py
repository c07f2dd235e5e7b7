"""The Merkle manifest against a plain recursive version."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ferryline.llm import merkle

COLUMNS = ["doc_id", "source", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(level, fanout):
    """Root of the digests and of each one its siblings, from below."""
    paths, owners = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        above, above_owners = [], []
        for at in range(0, len(level), fanout):
            run = level[at:at + fanout]
            for k in range(len(run)):
                for i in owners[at + k]:
                    paths[i] += run[:k] + run[k + 1:]
            above.append(digest("".join(run)))
            above_owners.append([i for o in owners[at:at + fanout] for i in o])
        level, owners = above, above_owners
    return level[0], paths


def expected(rows, claim, fanout):
    """Sorted (leaf, subroot, root, proof, verified) of rows of COLUMNS."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subs = []
    for key in keys:
        members = sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in groups[key]), key=lambda m: m[:3])
        root, paths = tree([m[2] for m in members], fanout)
        subs.append((root, members, paths))
    root, top = tree([s[0] for s in subs], fanout)
    out = []
    for (sub, members, paths), above in zip(subs, top):
        for (_, _, leaf, row), path in zip(members, paths):
            out.append((leaf, sub, root, digest("".join(path + above)), claim(row) == row))
    return sorted(out)


def audited(df, fanout, **settings):
    shout = {"text": F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))}
    manifest = merkle.build(df, COLUMNS, claims=shout, fanout=fanout, **settings)
    return merkle.audit(manifest)


def shouted(row):
    return (*row[:2], row[2].upper() if row[2] is not None and row[0] is not None and row[0] % 3 == 0 else row[2])


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest(spark, fanout):
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", f"text {i}") for i in range(150)]
    rows += [(500, None, "no source"), (None, "hot", None), (None, "hot", "b"), (7, "hot", ""), (7, "hot", ""),
             (3, "ünï", "é" * 40_000), (900, "zz", "alone"), (4, "", "empty name")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns(
        {"tree": F.lit("clash"), "leaf": F.lit(1), "own_group": F.lit(None).cast("int"), "doc": F.lit(2)})
    got = audited(df, fanout).collect()
    assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got) == expected(
        rows, shouted, fanout)
    assert all((r.folded_root == r.root) == r.verified for r in got)
    assert {r["doc"]["tree"] for r in got} == {"clash"}


def test_runs_with_many_leaves_are_met_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CROWN_LEAST", 5)
    rows = [(i, f"s{i % 3}" if i < 60 else "hot", f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = audited(df, 4).collect()
    assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got) == expected(
        rows, shouted, 4)


@pytest.mark.parametrize("rows", [[(1, "a", "x")], [(i, None, None) for i in range(40)], []])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    manifest = merkle.build(df, COLUMNS)
    got = merkle.audit(manifest).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    if rows:
        assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256, True) for r in got) == expected(
            rows, lambda r: r, 16)
    else:
        assert manifest.root is None


def test_the_limit_of_recursion_is_put_back(spark):
    before = spark.conf.get(merkle.ROW_LIMIT, None)
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "doc_id long, source string, text string")
    assert merkle.audit(merkle.build(df, COLUMNS)).count() == 2
    assert spark.conf.get(merkle.ROW_LIMIT, None) == before
