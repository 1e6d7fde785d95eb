"""Tables whose other columns have the names that operators might use, and keys of other types."""

import public_tokenizers
from pyspark.sql import functions as F

from meterflow.llm import jaccard_join, packing, quality_rules, secrets, token_counts, token_ids, wordpieces

NAMES = ["_m", "_t", "_w", "_s", "_l", "_g", "_o", "_kept", "kept", "row", "_before", "key", "i", "a.b", "size"]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PROSE = ("The old house stands beside a wide river, where people walk in the evening. Most of them know its garden well, with two apple trees "
         "and one bench that faces west. Nobody has lived there for many years, yet someone still paints the door each spring. Children say that a "
         "sailor keeps the key, and that he returns when the first swallows come back from the south to nest under the roof.")


def _docs(spark, texts):
    rows = [(f"k{i}", t, len(t) if t is not None else None, *range(len(NAMES))) for i, t in enumerate(texts)]
    kinds = ", ".join(f"`{n}` int" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id string, text string, n_chars long, {kinds}")


def test_filters_keep_columns_of_any_name(spark):
    docs = _docs(spark, [PROSE, "# # # #", None, "", PROSE])
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == ["k0", "k4"]
    one = jaccard_join.one_of_each(docs)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == ["k0", "k1", "k2", "k3"]
    assert one.where("doc_id = 'k0'").first()["a.b"] == NAMES.index("a.b")


def test_masking_leaves_other_columns(spark):
    key = "password = hunter2hunter2"
    docs = _docs(spark, [f"my {key}", "nothing", None, ""]).withColumn("_before", F.lit("kept"))
    got = {r.doc_id: r for r in secrets.mask_secrets(docs, length="n_chars").collect()}
    assert "hunter2" not in got["k0"].text and got["k0"].n_chars == len(got["k0"].text)
    assert [got[k].n_chars for k in ("k1", "k2", "k3")] == [7, None, 0] and {r["_before"] for r in got.values()} == {"kept"}
    assert secrets.mask_secrets(docs).columns == docs.columns


def test_text_and_null_keys(spark):
    docs = _docs(spark, ["one two", "three", None, "four"]).withColumn("doc_id", F.when(F.col("doc_id") != "k1", F.col("doc_id")))
    files = sorted(map(tuple, token_ids.token_files(docs, TOKENIZER, 1).collect()), key=lambda r: r[1])
    assert [r[0] for r in files] == [None, "k0", "k2", "k3"] and files[-1][1] + files[-1][2] == sum(r[2] for r in files)
    pieces = packing.pack(docs, TOKENIZER, 2).collect()
    assert {p.doc_id for p in pieces} == {None, "k0", "k2", "k3"}
    numbers = docs.select(F.lit(-(1 << 62)).alias("doc_id"), "text").union(docs.select(F.lit((1 << 62) + 5), "text")).union(docs.select(F.lit(None).cast("long"), "text"))
    assert sorted((r.doc_id or 0) for r in token_ids.token_files(numbers, TOKENIZER, 1).collect()) == [-(1 << 62)] * 4 + [0] * 4 + [(1 << 62) + 5] * 4


def test_caches_keep_short_pieces_only():
    encoder = wordpieces.WordEncoder(TOKENIZER)
    long = [f"{'x' * 5000}{i}" for i in range(20)]
    assert [len(encoder.encode(t)) > 0 for t in long] == [True] * 20
    assert max(map(len, encoder.pieces), default=0) <= 64 and max(map(len, encoder.pieces.words), default=0) <= 64
    counts = token_counts._Counts(public_tokenizers.path("byte_bpe_50k.json"))
    counts.of(" ".join(long))
    assert max(map(len, counts), default=0) <= 64
    hashes = jaccard_join._Hashes()
    jaccard_join.shingle_set(" ".join(long) + " a b c d e", hashes)
    assert max(map(len, hashes), default=0) <= 64
