"""Token files, token counts and packing against the libraries themselves."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterflow.llm import packing, token_counts, token_ids
from meterflow.llm.wordpieces import WordEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "It's Sam'S  we'LL 12,000!! <|endoftext|>x<|startoftext|>", "É é ΣΑΣ İst ﬁ x y\x1cz\x85q", "a \n b\t\tc \r\n", "  two  blanks  ",
       "word " * 3000, "x" * 5000, "日本語 テキスト 🎉👍🏽 àb", "<|endoftext|>", " <|endoftext|> ", "tab\x0bff\x0c.", "don't 've s's <| |>", "µª º×÷ ǅ ſ K", "ends. Here! And? so\nline"]
ROWS = [(10 - i if i % 3 else i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, ODD[3]), (3, None), (None, "no key"), (-5, None)]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAéÉ'sTm12 \n\t.!<|>́ΣßİK\x1c ​字"), max_size=40))
def test_word_ids_equal_the_library(text):
    library = Tokenizer.from_file(WORDS) if not hasattr(test_word_ids_equal_the_library, "t") else test_word_ids_equal_the_library.t
    test_word_ids_equal_the_library.t = library
    assert np.frombuffer(WordEncoder(WORDS).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAéÉ'sTm12 \n\t.!<|>́ΣßİK\x1c ​字"), max_size=40))
def test_counts_equal_the_library(text):
    if not hasattr(test_counts_equal_the_library, "c"):
        test_counts_equal_the_library.c = token_counts._Counts(BYTES)
    counts = test_counts_equal_the_library.c
    assert counts.of(text) == len(counts.tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_of_rows(make):
    got = token_counts.token_counts(make(ROWS), BYTES).collect()
    library = Tokenizer.from_file(BYTES)
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_round_trip(gaps):
    values = np.cumsum(np.array(gaps, np.int64))
    code = token_ids.EliasFano.of(values)
    assert code.all().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 900))
    assert token_ids.EliasFano.of(values).size() < 10_000 * 2


def _ordered(rows, tokenizer, end):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    return [(i, [*tokenizer.encode(t, add_special_tokens=False).ids, end]) for i, t in rows]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_token_files_round_trip(make, words, monkeypatch, block):
    monkeypatch.setattr(token_ids, "BLOCK_IDS", block)
    want, start = [], 0
    for i, ids in _ordered(ROWS, words, 1):
        want.append((i, start, len(ids), _crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in token_ids.token_files(make(ROWS).repartition(3), WORDS, 1).orderBy("start").collect()]
    assert got == want
    assert token_ids.token_files(make([]), WORDS, 1).count() == 0


def _check_pieces(pieces, docs, width):
    sums = {(i, len(ids)) for i, ids in docs}
    assert {(p.doc_id, p.doc_tokens) for p in pieces} == sums
    pieces = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    stream, expected = [], [x for _, ids in docs for x in ids]
    at = {}
    for p in pieces:
        assert p.offset == at.get(p.sequence_id, 0) and p.length > 0
        at[p.sequence_id] = p.offset + p.length
    assert list(at) == list(range(len(at))) and max(at.values()) <= width
    # pieces follow the stream, so their lengths and sums replay it
    position, d, used = 0, 0, 0
    for p in pieces:
        if used == len(docs[d][1]):
            d, used = d + 1, 0
        key, ids = docs[d]
        assert (p.doc_id, p.start, p.doc_tokens) == (key, used, len(ids))
        assert p.ids_crc32 == _crc(ids[used:used + p.length])
        used += p.length
        position += p.length
    assert position == len(expected)
    return sum(0 if n & (n - 1) == 0 else width - n for n in at.values()), len(expected)


def test_pack_places_every_token_once(make, words, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 6000)
    docs = _ordered(ROWS * 1, words, 2)
    pieces = packing.pack(make(ROWS), WORDS, 2).collect()
    padding, total = _check_pieces(pieces, docs, 4096)
    assert padding < 0.05 * total + 4096
    assert packing.pack(make([]), WORDS, 2).count() == 0


def _brute(bounds, prices, width):
    best = [0.0]
    for j in range(1, len(bounds)):
        best.append(min(best[i] + width - bounds[j] + bounds[i] + prices[j] for i in range(j) if bounds[j] - bounds[i] <= width))
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 8, 256])), min_size=1, max_size=60))
def test_queue_finds_the_cheapest_packing(steps):
    bounds, prices = [0], [0]
    for gap, price in steps:
        bounds.append(bounds[-1] + gap)
        prices.append(price)
    assert packing.cheapest_cuts(bounds, prices, 16)[0] == _brute(bounds, prices, 16)


def test_documents_are_kept_whole_where_that_costs_nothing():
    assert packing.windows([8, 16, 24, 32], [0, 0, 0, 0], True, 16) == [16, 32]
    assert packing.windows([5, 12, 16, 30], [0, 0, 8, 0], True, 16) == [16, 24, 28, 30]


def test_plain_words_need_no_call_for_whole_texts():
    """Plain words go to the merge model alone, spelled as the vocabulary spells bytes; their ids are the library's."""
    from meterflow.llm import wordpieces
    library = Tokenizer.from_file(WORDS)
    calls = []

    class Counted:
        model = library.model

        def encode(self, text, **options):
            calls.append(text)
            return library.encode(text, **options)

        def __getattr__(self, name):
            calls.append(name)
            return getattr(library, name)
    encoder = wordpieces.WordEncoder.__new__(wordpieces.WordEncoder)
    encoder.pieces = wordpieces._Pieces(Counted())
    letters = [chr(c) for c in [*range(33, 127), *range(192, 256)] if chr(c) not in "×÷<"]
    text = " ".join(["Ünïted stätes's 1234 nátion, Íñ 're don't ßÿ", *letters, *(a + b + "x" + a for a, b in zip(letters, reversed(letters)))])
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert not calls
