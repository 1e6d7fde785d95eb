"""Merkle manifest against a direct construction of the trees."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from meterflow.llm import merkle_manifest as mm


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(digests):
    """Root and, for each leaf, its siblings level by level."""
    paths = [[] for _ in digests]
    above = list(range(len(digests)))
    row = digests
    while len(row) > 1:
        for i, at in enumerate(above):
            first = at - at % 3
            paths[i].append((row[first:at], row[at + 1:first + 3]))
            above[i] = at // 3
        row = [H(*row[i:i + 3]) for i in range(0, len(row), 3)]
    return row[0], paths


def direct(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[s] = (members, *_tree([_leaf(r) for r in members]))
    root, top = _tree([trees[s][1] for s in order])
    out = []
    for s, above in zip(order, top):
        members, subroot, paths = trees[s]
        out += [(r[0], _leaf(r), subroot, root, H(*(d for left, right in path + above for d in left + right))) for r, path in zip(members, paths)]
    return sorted(out, key=repr)


def _manifest(docs):
    rows = mm.merkle_manifest(docs).withColumn("folded", mm.folded(F.col("leaf"), F.col("proof"))).collect()
    return rows, sorted(((r.doc_id, r.leaf, r.subroot, r.root, H("".join(r.proof).replace("*", ""))) for r in rows), key=repr)


DOC = "doc_id long, source string, lang string, n_chars long, text string, digest int, tree int, payload int, place int"


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, "b": 4, None: 1, "": 2, "é": 1, "Z": 5}, {"hot": 800, "x": 244, "y": 81, "z": 82}])
def test_equals_direct_construction(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(k, s, rng.choice([None, "en"]), k % 7, rng.choice([None, "", "a\nb", "é" * k])) for s, n in sizes.items() for k in rng.sample(range(5000), n)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOC).repartition(5)
    got, found = _manifest(docs)
    assert found == direct(rows)
    assert all(r.folded == r.root for r in got)


def test_many_sources_repeated_rows_and_null_ids(spark):
    rows = [(k, f"s{k}", None, None, "t") for k in range(300)] + [(1, "dup", None, None, "same")] * 40 + [(None, "dup", None, 3, "x"), (1, "dup", None, None, "other")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOC).repartition(3)
    assert _manifest(docs)[1] == direct(rows)


def test_empty_table(spark):
    assert mm.merkle_manifest(spark.createDataFrame([], DOC)).count() == 0


def test_changed_leaf_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(k, "s", None, None, f"line {k}\nend", 1, 2, 3, 4) for k in range(100)], DOC)
    rows = mm.merkle_manifest(docs, also={"other": mm.leaf_digest([F.col("doc_id"), F.lit("forged")])})
    assert rows.where(mm.folded(F.col("other"), F.col("proof")) == F.col("root")).isEmpty()
    assert rows.columns == ["doc_id", "source", "place", "leaf", "proof", "subroot", "root", "other"]


def test_levels():
    assert [mm.levels(n) for n in (0, 1, 2, 3, 4, 9, 10, 243, 244)] == [0, 0, 1, 1, 2, 2, 3, 5, 6]
