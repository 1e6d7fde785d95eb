"""Similarity join, components, decontamination and the pipeline against brute force."""

import itertools
import random
import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import common, decontamination, jaccard_join
from meterflow.llm.components import components

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _roots({n for e in edges for n in e}, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in want.items() if n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def _corpus():
    """Groups of near copies around and beside the bound, chains, hot passages, ties and odd rows."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([7, 30, 90]))]
        for _ in range(rng.choice([1, 6, 25])):
            copy = base[:]
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy + passage * rng.choice([0, 1])))
    chain = [word() for _ in range(60)]
    for i in range(25):
        chain = chain[2:] + [word(), word()]
        texts.append(" ".join(chain))
    texts += [" ".join(passage), " ".join(passage + ["x"]), "a b c", "A B C", "a b", "", None, "   ", " ".join(["same"] * 400), " ".join(["same"] * 9), "É é a b c", "é é a b c"]
    texts += [texts[0]] * 30
    rng.shuffle(texts)
    return [(1000 - i, t) for i, t in enumerate(texts)]


def test_large_families_that_hardly_link(make):
    """Many changed copies of one text, far from each other, a few of them near ones: large blocks meet by part digests."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(220)]
    rows = []
    for i in range(260):
        words = base[:]
        for _ in range(rng.choice([5, 6, 6, 6, 7])):
            words[rng.randrange(220)] = f"x{i}y{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
        if i % 13 == 0:
            words[rng.randrange(220)] = "near"
            rows.append((1000 + i, " ".join(words)))
    sets = {i: _shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert 20 <= len(links) < 4000
    want = _roots(sets, links)
    docs = make(rows)
    assert {r.doc_id: r.component_id for r in jaccard_join.similar_groups(docs).collect()} == want


def _near_copies(n, seed):
    """Copies of one text with few or many changed words: most link with some others, few with the smallest one."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(n):
        words = base[:]
        for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4, 5, 6])):
            words[rng.randrange(150)] = f"x{i}y{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("bounds", [{}, {"DIGEST": 0, "LONG": 4}, {"DIGEST": 0, "KINDS": 0, "LONG": 4}, {"MANY_LINKS": 0.01, "LONG": 4, "HEADS": 1}])
def test_near_copies_meet_once(make, monkeypatch, bounds):
    """Digests stay few for a family of near copies, and no bound of speed changes a group."""
    for name, value in bounds.items():
        monkeypatch.setattr(jaccard_join, name, value)
    made, write = {}, jaccard_join.stored

    def stored(df, name):
        made[name] = write(df, name)
        return made[name]
    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = _near_copies(500, 3)
    sets = {i: _shingles(t) for i, t in rows}
    want = _roots(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert len(set(want.values())) > 50
    assert {r.doc_id: r.component_id for r in jaccard_join.similar_groups(make(rows).repartition(5)).collect()} == want
    if not bounds:
        assert made["parts"].count() <= 60 * len(rows)


def test_a_family_links_with_its_middle(make, monkeypatch):
    """Copies with as many changes as still link with their text, hardly with one another: few pairs are left open."""
    made, write = {}, jaccard_join.stored

    def stored(df, name):
        made[name] = write(df, name)
        return made[name]
    monkeypatch.setattr(jaccard_join, "stored", stored)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(400):
        words = base[:]
        for k in rng.sample(range(150), 0 if i == 200 else rng.choice([1, 2, 3])):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    sets = {i: _shingles(t) for i, t in rows}
    want = _roots(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert {r.doc_id: r.component_id for r in jaccard_join.similar_groups(make(rows).repartition(5)).collect()} == want
    assert made["open-pairs"].count() <= 2 * len(rows)


def test_workers_release_the_caches_of_other_stages():
    for work in (jaccard_join._sets(0, 5), jaccard_join._codes(0, 5), jaccard_join._prefixes(np.empty(0, np.uint64), np.empty(0, np.int64), 0, 5)):
        kept = common.per_process("pieces", dict)
        assert common.per_process("pieces", dict) is kept
        assert not list(work(iter([])))
        assert common.per_process("pieces", dict) is not kept


def test_parts_of_linked_sets_agree():
    rng = np.random.default_rng(5)
    tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
        lost = int(rng.integers(0, 8))
        y = np.unique(np.concatenate([np.delete(x, rng.integers(60, len(x), lost)), rng.integers(1 << 62, 1 << 63, 3).astype(np.uint64)]))
        parts = len(set(x.tolist()) ^ set(y.tolist())) + 1
        first = next(c for c in x.tolist() if c in set(y.tolist()))
        rows = [{"pos": v.tolist().index(first), "parts": parts} for v in (x, y)]
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([x.tobytes(), y.tobytes()], pa.binary()), pa.array([[r] for r in rows])], ["key", "grams", "wants"])
        a, b = next(iter(jaccard_join._part_digests(tokens, counts)(iter([batch])))).column(2).to_pylist()
        assert set(a[0]) & set(b[0])


def test_groups_equal_brute_force(make):
    rows = _corpus()
    sets = {i: _shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = _roots(sets, links)
    got = jaccard_join.similar_groups(make(rows).repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    kept = jaccard_join.one_of_each(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_odd_rows(make):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a), (2, a), (None, b), (None, "alone in the world here it is"), (None, None)]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in jaccard_join.similar_groups(make(rows)).collect())
    assert got == [("1", "1"), ("1", "1"), ("2", "1"), ("2", "1"), ("None", "1"), ("None", "None"), ("None", "None")]
    assert sorted((str(r.doc_id), r.text or "") for r in jaccard_join.one_of_each(make(rows)).collect() if r.text) == [
        ("1", b), ("1", a), ("None", "alone in the world here it is")]
    assert jaccard_join.similar_groups(make([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 10, 333])
def test_prefix_is_as_long_as_needed(n):
    assert jaccard_join.prefix_length(n) == n - -(-80 * n // 100) + 1


def test_outlines_never_rule_out_a_link():
    rng = np.random.default_rng(9)
    for n in (1, 5, 60, 700):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        for share in (0.0, 0.05, 0.2, 0.5):
            other = base.copy()
            changed = rng.random(n) < share
            other[changed] = rng.integers(0, 1 << 63, changed.sum(), dtype=np.uint64)
            x, y = np.unique(base), np.unique(other)
            common = len(np.intersect1d(x, y))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                assert jaccard_join.may_link(jaccard_join.outline(x), jaccard_join.outline(y), len(x), len(y))
    far = [np.unique(rng.integers(0, 1 << 63, 600, dtype=np.uint64) * np.uint64(2)) for _ in range(2)]
    assert not jaccard_join.may_link(*map(jaccard_join.outline, far), 600, 600)


def _lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_equals_the_table():
    rng = np.random.default_rng(8)
    for _ in range(200):
        x, y = rng.integers(0, 5, rng.integers(0, 30)), rng.integers(0, 5, rng.integers(0, 80))
        assert decontamination.common_subsequence(x, y) == _lcs(x.tolist(), y.tolist())


def _bench(spark, make):
    rng = random.Random(6)
    stock = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([2, 3, 5, 7]))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(stock) for _ in range(n)).capitalize() + "."
    items = [f"{text(rng.randrange(8, 40))} {text(10)}" for _ in range(25)]
    docs, held = [], {}
    for i in range(300):
        body = [text(20) for _ in range(rng.randrange(1, 30))]
        if i % 6 == 0:
            k = rng.randrange(25)
            words = items[k].split()
            if i % 12 == 0:  # a paraphrase: one word in ten is another one
                for j in range(0, len(words) - 10, 10):
                    words[j] = "other"
            body.insert(rng.randrange(len(body) + 1), " ".join(words).upper())
            held[i] = k
        docs.append((i, "\n".join(body)))
    docs += [(900, None), (901, ""), (902, items[3]), (902, items[3]), (None, items[4] + " " + items[5])]
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)] + [(50, None, 1), (51, "too short", 1), (None, "", 1)], "item_id long, text string, codes int")
    return docs, bench, held


def test_items_are_found_and_clean_texts_left(spark, make):
    docs, bench, held = _bench(spark, make)
    got = decontamination.contamination_report(decontamination.find_items(make(docs), bench)).collect()
    assert len(got) == len(docs)
    found = {r.doc_id: r.item_ids for r in got if r.contaminated}
    assert found == {i: str(k) for i, k in held.items()} | {902: "3", None: "4,5"}
    clean = decontamination.without_items(make(docs), bench)
    assert clean.columns == make(docs).columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if i not in found)
    assert decontamination.find_items(make(docs), bench.limit(0)).where("size(items) > 0").count() == 0
    assert decontamination.find_items(make([]), bench).count() == 0


def _planted(n):
    """A benchmark of n items over a wide vocabulary, and texts that each hold one of them, whole or with words changed."""
    rng = np.random.default_rng(31)
    share = 1 / np.arange(1, 3001)
    draw = lambda size: rng.choice(3000, size, p=share / share.sum()) + 1
    codes = [draw(rng.integers(10, 40)) for _ in range(n)]
    bench = decontamination.Benchmark(list(range(n)), codes, [c[-5:] for c in codes], {str(i).encode(): i + 1 for i in range(3000)})
    texts = []
    for i in range(200):
        k = int(rng.integers(n))
        copy = codes[k].copy()
        if i % 2:
            copy[:-5][rng.random(len(copy) - 5) < 0.25] = 0
        at = int(rng.integers(0, 60))
        texts.append((k, bool(i % 2), np.concatenate([draw(at), copy, draw(60 - at)])))
    return bench, texts


def test_copies_are_checked_however_poor_the_latent_space(spark):
    bench, texts = _planted(1500)
    rng = np.random.default_rng(1)
    space = decontamination.Space(bench, rng.standard_normal((bench.size, 2)).astype(np.float32), np.ones(bench.size, np.float32))
    search = decontamination.Searcher(space, 2.0, 0.8, 0.6, 0.8)  # no cosine is as high
    found = search.search([t for *_, t in texts])
    assert all(k in f for (k, changed, _), f in zip(texts, found) if not changed)
    due = [k in f for (k, changed, t), f in zip(texts, found) if changed and decontamination.common_subsequence(bench.codes[k], t) >= 0.6 * len(bench.codes[k])]
    assert sum(due) >= 0.95 * len(due) > 0


def test_directions_grow_with_the_items(spark):
    coded = spark.createDataFrame([(1, b"")], "doc_id long, codes binary")
    sizes = [decontamination.fit_space(coded, _planted(n)[0]).basis.shape[1] for n in (40, 200, 800)]
    assert sizes == [48, 48, 96]


def test_pipeline_stages_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("shared tables are not here")
    import corpus_pipeline
    from meterflow.llm.common import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [set(r.doc_id for r in docs.select("doc_id").collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "stage")
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept.append(set(r.doc_id for r in docs.select("doc_id").distinct().collect()))
        assert kept[-1] <= kept[-2]
    assert kept[4] == kept[3] == kept[5] and 100 < len(kept[-1]) < 200
    whole = docs.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert whole.max() <= 4096


def test_windows_with_too_few_words_are_not_looked_at():
    """Windows whose benchmark words are too few for an item are left out before their words are compared; others as by plain counting."""
    rng = np.random.default_rng(9)
    items = [np.arange(1, 41), np.arange(30, 61)]
    known = decontamination.Benchmark([1, 2], items, [i[-5:] for i in items], {str(k).encode(): k for k in range(1, 61)})
    space = decontamination.Space(known, rng.standard_normal((known.size, 8)).astype(np.float32), np.ones(known.size, np.float32))
    searcher = decontamination.Searcher(space, 0.5, 0.8, 0.6, 0.8)
    rows = np.where(rng.random((60, 8)) < 0.6, rng.integers(0, 61, (60, 8)), 0)
    held = np.concatenate([[0], np.cumsum(np.count_nonzero(rows, axis=1))])
    window, item = np.repeat(np.arange(60), 2), np.tile([0, 1], 60)
    start, scale = np.arange(60), 6
    end = np.minimum(start + scale, 60)
    words = [int(np.isin(rows[a:z], items[k]).sum()) for a, z, k in zip(start[window], end[window], item)]
    want = [(w, k) for w, k, n in zip(window.tolist(), item.tolist(), words) if n >= 0.6 * len(items[k])]
    assert 0 < len(want) < 120
    assert list(zip(*searcher._worded(rows, held, start, end, window, item, scale))) == want
    searcher.known = None
    poor = rows.copy()
    poor[:, 2:] = 0
    held = np.concatenate([[0], np.cumsum(np.count_nonzero(poor, axis=1))])
    assert searcher._worded(poor, held, start, end, window, item, scale) == ([], [])
