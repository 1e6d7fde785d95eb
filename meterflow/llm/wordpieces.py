"""Token ids of whole texts by a word-level cache in front of the tokenizers library.

The vocabulary's normaliser and pre-tokenizer never look across white space, so a text's ids are the
ids of its pieces between blanks, line feeds, tabs and carriage returns. A piece of plain characters
is taken apart by the pre-tokenizer's own pattern, and every part, spelled as the vocabulary spells bytes, goes
to the library's merge model once per worker process; any other piece goes to the library as it stands.
"""

from __future__ import annotations

import re
from struct import pack

from meterflow.llm.common import CACHED, load_tokenizer, per_process

#: Characters for which lower-casing and composition are the same everywhere and work letter by letter.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The vocabulary's pre-tokenizer pattern, written out for plain lower-case characters.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Entries of short pieces a worker keeps; a full cache is emptied, which costs time but changes nothing.
PIECES, WORDS = 600_000, 900_000
#: The vocabulary spells bytes that are no visible Latin-1 characters by the characters from 256 on, in their order.
BYTES = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


def pack_ids(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class _Words(dict):
    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model

    def __missing__(self, word):
        if len(self) >= WORDS:
            self.clear()
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
        ids = pack_ids([token.id for token in self.model.tokenize(spelled)])
        if len(word) <= CACHED:
            self[word] = ids
        return ids


class _Pieces(dict):
    def __init__(self, tokenizer):
        super().__init__({"": b""})
        self.words = _Words(tokenizer)

    def __missing__(self, piece):
        if len(self) >= PIECES:
            self.clear()
            self[""] = b""
        words = self.words
        if "<|" not in piece and PLAIN.fullmatch(piece):
            ids = b"".join([words[w] for w in PARTS.findall(piece.lower())])
        else:
            ids = pack_ids(words.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= CACHED:
            self[piece] = ids
        return ids


class WordEncoder:
    """``encode(text)``: ids as little-endian unsigned 32-bit bytes, equal to the library's."""

    def __init__(self, path: str):
        self.pieces = per_process(f"pieces {path}", lambda: _Pieces(load_tokenizer(path)))

    def encode(self, text: str) -> bytes:
        known = self.pieces
        flat = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        pieces = flat.split(" ")
        found = [*map(known.get, pieces)]
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = known[pieces[i]]
        return b"".join(found)
