"""Periodic runs against a brute-force scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import periodic_runs as pr


def brute(codes, length=pr.LENGTH, exponent=pr.EXPONENT):
    found = {}
    for period in range(1, len(codes) // exponent + 1):
        at = 0
        while at + period < len(codes):
            start = at
            while at + period < len(codes) and codes[at] == codes[at + period]:
                at += 1
            if at + period - start >= max(length, exponent * period):
                found.setdefault((start, at + period - start), period)
            at = max(at, start + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=8), st.sampled_from([(6, 4), (2, 2), (5, 3), (20, 4)]))
def test_runs_equal_brute_force(blocks, bounds):
    codes = [c for block, times in blocks for c in block * times]
    assert pr.find_runs(np.array(codes, np.int64), *bounds) == brute(codes, *bounds)


def test_random_long_sequences():
    rng = random.Random(3)
    for alphabet in (1, 2, 3):
        codes = [rng.randrange(alphabet) + 1 for _ in range(1500)]
        codes[700:1300] = (codes[700:770] * 9)[:600]
        assert pr.find_runs(np.array(codes, np.int64)) == brute(codes)


def test_long_texts_stay_fast():
    separate = [w for k in range(20000) for w in (k + 5, 1, 1, 1, 1, 1, 1)]
    assert len(pr.find_runs(np.array(separate))) == 20000
    assert pr.find_runs(np.arange(200_000) % 30_000) == [(0, 200_000, 30_000)]


def _expected(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    numbers = {}
    runs = brute([numbers.setdefault(w, len(numbers)) for w in words])
    keep = [w for i, w in enumerate(words) if not any(s + p <= i < s + k for s, k, p in runs)]
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(keep).encode()).hexdigest())


def _rows():
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "a", "x " * 40, "a\vb\fc " * 9, "    " * 12, "é é é é é é", "A a " * 9, "\x00 " * 7, "no run here at all"]
    for _ in range(250):
        words = [rng.choice(["to", "be", "or", "not", "Ü", "再"]) for _ in range(rng.randrange(120))]
        at = rng.randrange(len(words) + 1)
        texts.append(rng.choice([" ", "\n", " \t"]).join(words[:at] + words[at:at + rng.randrange(1, 6)] * rng.randrange(9) + words[at:]))
    texts.append(" ".join(str(i % 700) for i in range(5000)))
    rows = list(enumerate(texts))
    return rows + rows[5:8]


def test_report_equals_brute_force(make):
    rows = _rows()
    docs = make(rows).repartition(3)
    got = pr.run_report(pr.periodic_runs(pr.planted(docs))).collect()
    assert sorted(tuple(r) for r in got if r.n_runs) + sorted((tuple(r) for r in got if not r.n_runs), key=str) == (
        sorted(e for e in ((k, *_expected(k, t)) for k, t in rows) if e[1]) + sorted((e for e in ((k, *_expected(k, t)) for k, t in rows) if not e[1]), key=str))


def test_empty_null_ids_and_clashing_columns(spark, make):
    assert pr.run_report(pr.periodic_runs(pr.planted(make([])))).count() == 0
    docs = spark.createDataFrame([(None, "b " * 8, 1, 2, 3), ("k", "b " * 8, 1, 2, 3)], "doc_id string, text string, runs int, top int, collapsed int")
    got = pr.periodic_runs(docs).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in sorted(got, key=lambda r: r.doc_id or "")] == [
        (None, 8, [(0, 8, 1)], "b"), ("k", 8, [(0, 8, 1)], "b")]
    assert {r.n_runs for r in pr.run_report(pr.periodic_runs(pr.planted(docs))).collect()} == {1}
