"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is tested: it is *whole* if the library encodes it alone as one token.
A text's count is then the number of its whole pre-tokens plus the merged counts of the rest, which the
library encodes once per worker process. Texts are cut before a blank that follows and precedes
something else than white space, where a pre-token always starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import CACHED, load_tokenizer, per_process, texts

#: The byte-level vocabulary's pre-tokenizer pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = 900_000
_CUT = re.compile(r" (?=\S)")


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def whole_tokens(tokenizer) -> frozenset[str]:
    """Vocabulary strings that are valid text, are one pre-token, and encode alone as exactly one token."""
    back, pattern, found = byte_letters(), regex.compile(PATTERN), []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if pattern.fullmatch(text):
            found.append(text)
    return frozenset(t for t, e in zip(found, tokenizer.encode_batch_fast(found, add_special_tokens=False)) if len(e.ids) == 1)


class _Counts(dict):
    """Tokens of a piece that starts and ends where pre-tokens do."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load_tokenizer(path)
        self.whole, self.pattern = whole_tokens(self.tokenizer), regex.compile(PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece):
        if len(self) >= PIECES:
            self.clear()
        whole, count, rest = self.whole, 0, []
        for word in self.pattern.findall(piece):
            if word in whole:
                count += 1
            else:
                rest.append(word)
        for word in rest:
            count += len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(piece) <= CACHED:
            self[piece] = count
        return count

    def of(self, text: str) -> int:
        if any(s in text for s in self.special):  # special strings cut the text; the library does that
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *rest = _CUT.split(text)
        return self[first] + sum(map(self.__getitem__, [" " + x for x in rest])) if text else 0


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = per_process(f"counts {path}", lambda: _Counts(path))
        for batch in batches:
            n = [counts.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; one pass, no shuffle.

    Null and empty texts have no token. Repeated rows are counted each; an empty table gives an empty result.
    """
    rows = texts(docs, key, text).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(_count(tokenizer), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
