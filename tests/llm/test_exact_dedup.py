"""Streaming deduplication against direct grouping, in one go and file by file."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterflow.llm import stream_dedup as sd


def direct(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), key is None, key, text))
    out = []
    for normal, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], members[0][2], len(members), i == 0, hashlib.sha256(normal.encode()).hexdigest()) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def _corpus():
    rng = random.Random(6)
    texts = [None, "", " \t\n\r\v\f", "a b", "ab", "a b", "é e", "ée", "ée", "x" * 200_000, "x" * 100_000 + " " + "x" * 100_000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(300)] + ["hot copy "] * 150 + ["hotcopy"] * 20
    rng.shuffle(texts)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    return [*rows, (None, "ab"), *rows[:3]]


def _write(spark, rows, path, mode="overwrite"):
    kinds = "doc_id long, text string, file int, row int, digest int, mark int, n int"
    spark.createDataFrame([(k, t, 1, 2, 3, 4, 5) for k, t in rows], kinds).repartition(3).write.mode(mode).parquet(path)


def _found(rows):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in rows.collect()), key=repr)


def test_equals_direct_grouping(spark, tmp_path):
    _write(spark, _corpus(), f"{tmp_path}/docs")
    assert _found(sd.exact_copies(spark, f"{tmp_path}/docs", f"{tmp_path}/state")) == direct(_corpus())


def test_files_arrive_later(spark, tmp_path):
    rows = _corpus()
    for k, part in enumerate((rows[:100], rows[100:101], rows[101:], [])):
        _write(spark, part, f"{tmp_path}/docs", "append" if k else "overwrite")
        found = sd.exact_copies(spark, f"{tmp_path}/docs", f"{tmp_path}/state")
    assert _found(found) == direct(rows)
    dedup = sd.Deduplicator(spark, f"{tmp_path}/docs", f"{tmp_path}/state")
    before = dedup.fingerprints().inputFiles()
    dedup.absorb()  # nothing new: nothing is read or written again
    assert dedup.fingerprints().inputFiles() == before
    assert dedup.state().agg(F.sum("n")).first()[0] == len(rows)


def test_hits_of_a_weak_digest_are_settled_by_the_texts(spark, tmp_path):
    rows = _corpus()
    _write(spark, rows, f"{tmp_path}/docs")
    weak = sd.Deduplicator(spark, f"{tmp_path}/docs", f"{tmp_path}/state", digest=lambda text: F.substring(text, 1, 1).cast("binary"))
    weak.absorb()
    found = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak.groups().collect()), key=repr)
    assert found == sorted((r[:4] for r in direct(rows)), key=repr)
    assert weak.state().where("n > 1").count() < len({r[4] for r in direct(rows) if r[2] > 1})


@pytest.mark.parametrize("single", [False, True])
def test_empty_table_single_file_and_text_keys(spark, tmp_path, single):
    rows = [("b", "x y"), ("a", "xy "), (None, "xy "), ("c", None)] if single else []
    spark.createDataFrame(rows, "doc_id string, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    path = str(next(tmp_path.joinpath("docs").glob("*.parquet"))) if single else f"{tmp_path}/docs"
    found = sd.exact_copies(spark, path, f"{tmp_path}/state").drop("digest").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([("b", "a", 3, False), ("a", "a", 3, True), (None, "a", 3, False), ("c", "c", 1, True)] if single else [], key=repr)
