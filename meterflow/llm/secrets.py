"""Secret scan: patterns, and character Markov models of random strings and of ordinary identifiers.

Both models start from fixed samples made once in code: random strings of the usual alphabets, and identifiers.
The corpus adds its own pairs (one bounded table of counts over all documents): what the patterns find is random,
every other run of identifier characters is ordinary unless the fixed models alone take it for random. In no row of
pairs does the corpus outweigh the fixed samples, so neither many keys of one alphabet nor many random strings
without a keyword hide others. Runs are cut at what the patterns find, and a stretch of a run is a secret where its
log-likelihood ratio exceeds a bound.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import map_batches, texts

# Patterns of the contract, kinds in their order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("passw", "secret", "token", "api")
#: A run of identifier characters; shorter ones, and shorter stretches of one, hold too little to tell.
LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Log-likelihood ratio from which a stretch of a run is a secret; a drop as deep ends a stretch.
BOUND = 12.0
#: Weight of the single-character model in each row of pairs; high, so that a rare run does not vouch for itself.
SMOOTHING = 200.0
#: Fixed random samples: alphabets, and how many strings of each. Lengths go from 16 to 64.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {_UPPER + _LOWER + _DIGITS: 3000, _UPPER + _LOWER + _DIGITS + "+/": 1000, _UPPER + _LOWER + _DIGITS + "-_": 500,
             _LOWER + _DIGITS: 1000, _UPPER + _DIGITS: 1000, _DIGITS + "abcdef": 500, _DIGITS + "ABCDEF": 500}
#: Words of the fixed identifiers.
WORDS = ("access account action active address admin after agent alert amount answer archive array async attribute audio author backup balance bar "
         "base batch before begin block board body border branch bucket buffer build button byte cache call cancel card center change channel "
         "check child city class clean client clock close cluster code color column command common company config connect const contact content "
         "context control copy core count country create current custom customer data date day debug default delete delivery depth detail device "
         "dialog digest direct document domain double download draft driver edit element email empty enable end engine entry environment error event "
         "example exception execute export factory field file filter final first flag folder font format forward frame from function gateway get "
         "global graph group handle handler hash header health height help history host hour html http image import index info input insert "
         "instance int internal invoice is item job join json key kind label language last layout left length level library license light limit "
         "line link list load local lock log long loop machine main manager map mask matrix max measure media memory menu message meta method "
         "metric min minute mobile mode model module month mouse name native network new next node none note null number object offset on open "
         "operation option order output owner package page panel param parent parse part patch path payment period phone pixel player plugin point "
         "policy pool port position post power press previous price print private process product profile project proxy public query queue quick "
         "random range raw read record region register release remote remove render report request reset resource response rest result return right "
         "role root route row rule run sample save scale schedule schema scope screen search second section select send sequence server service "
         "session set setting shape share short show sign simple size sort source space split stack staging start state static status step stop "
         "storage store stream string style submit sum support switch sync system table target task team temp template test text theme thread time "
         "title to token tool total trace track transfer tree trigger type union unit update upload url user util valid value vector version "
         "video view visit wait warning watch web week weight width window with word worker write year zone "
         "anzahl arbeit bericht bezeichnung daten einheit ergebnis fehler gesellschaft kunden nachricht rechnung schaltung verbindung verwaltung "
         "zeichen zeitpunkt adresse bonjour compte demande donnee facture fichier gestion langue niveau numero personne recherche utilisateur "
         "archivo cantidad ciudad cliente direccion empresa fecha nombre pedido usuario").split()
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_CODE = np.zeros(128, np.int64)
_CODE[[ord(c) for c in _CHARS]] = np.arange(1, len(_CHARS) + 1)
SIZE = len(_CHARS) + 1  # 0: start of a run


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the value), by start, then kind."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), m.end(), "assign", m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def other_runs(text: str, base: list[tuple]) -> list[tuple[int, int]]:
    """Runs without what the base spans cover; a run that is cut leaves its other parts, however short."""
    runs = [m.span() for m in RUN.finditer(text)]
    if not base or not runs:
        return runs
    kept, merged = [], []
    for a, z in sorted((s[0], s[1]) for s in base):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    i = 0
    for a, z in runs:
        while i < len(merged) and merged[i][1] <= a:
            i += 1
        k = i
        while k < len(merged) and merged[k][0] < z:
            if merged[k][0] > a:
                kept.append((a, merged[k][0]))
            a = merged[k][1]
            k += 1
        if a < z:
            kept.append((a, z))
    return kept


def stretches(scores: list[float], bound: float) -> list[tuple[int, int]]:
    """Stretches whose sum reaches the bound, each of them best from where it starts until the sum is used up or has dropped by the bound."""
    found, total, best, start, end = [], 0.0, 0.0, 0, 0
    for i, score in enumerate(scores):
        total += score
        if total > best:
            best, end = total, i + 1
        if total <= 0 or total <= best - bound:
            if best >= bound:
                found.append((start, end))
            total, best, start = 0.0, 0.0, i + 1
    return [*found, (start, end)] if best >= bound else found


def pair_codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (previous, current) character of every string, and where each string starts."""
    lengths = np.array([len(s) for s in strings], np.int64)
    codes = _CODE[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
    starts = np.cumsum(lengths) - lengths
    before = np.concatenate([[0], codes[:-1]])
    before[starts] = 0
    return before * SIZE + codes, starts


def fixed_samples() -> tuple[list[str], list[str]]:
    """Labelled samples that do not depend on any corpus: identifiers, random strings."""
    rng = np.random.default_rng(11)
    random = ["".join(rng.choice(list(alphabet), rng.integers(16, 65))) for alphabet, n in ALPHABETS.items() for _ in range(n)]
    ordinary = []
    for i in range(6000):
        parts = [str(w) for w in rng.choice(WORDS, rng.integers(3, 7))]
        number = "".join(rng.choice(list(_DIGITS), rng.integers(1, 5)))
        style = i % 12
        joined = ["_".join(parts), "-".join(parts), "/" + "/".join(parts), "".join(parts), "_".join(parts).upper(),
                  parts[0] + "".join(p.capitalize() for p in parts[1:]), "".join(p.capitalize() for p in parts), "=".join(parts[:2]) + "_" + parts[2],
                  "/".join(parts[:2]) + "/" + "-".join(p.capitalize() for p in parts[2:]), "-".join(parts[:2]) + "-" + number, "_".join(parts) + number,
                  "".join(rng.choice(list(_DIGITS), 18)) if i % 2 else f"20{i % 60:02d}-{i % 12 + 1:02d}-{i % 28 + 1:02d}_{parts[0]}_{number}"][style]
        ordinary.append(joined)
    ordinary += [rule for c in "=-_+/" for rule in [c * 64] * 20] + [("+" + "-" * n) * 3 for n in range(5, 25)]
    return ordinary, random


def _counts(strings: list[str]) -> np.ndarray:
    return np.bincount(pair_codes(strings)[0], minlength=SIZE * SIZE)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every pair, random against ordinary. Pairs are smoothed towards single characters, those towards equal shares."""
    counts = counts.reshape(2, SIZE, SIZE).astype(float)
    single = counts.sum(axis=1, keepdims=True) + 1
    counts += SMOOTHING * single / single.sum(axis=2, keepdims=True)
    model = np.log(counts / counts.sum(axis=2, keepdims=True))
    return (model[1] - model[0]).ravel()


def scored_runs(text: str, base: list[tuple], ratios: np.ndarray, bound: float) -> list[tuple[int, int, bool]]:
    """(start, end, whether it is a secret) of all parts of runs beside the base spans, in order.

    A secret stretch is taken up to the ends of the letters and digits it lies in, so that no rest of a key stays.
    """
    runs = other_runs(text, base)
    if not runs:
        return []
    pairs, starts = pair_codes([text[a:z] for a, z in runs])
    scores = ratios[pairs]
    most = np.add.reduceat(np.maximum(scores, 0), starts)  # no stretch has more
    found = []
    for (a, z), start, high in zip(runs, starts.tolist(), most.tolist()):
        at = a
        for i, k in stretches(scores[start:start + z - a].tolist(), bound) if high >= bound else ():
            i, k = a + i, a + k
            while i > at and text[i - 1].isalnum():
                i -= 1
            while k < z and text[k - 1].isalnum() and text[k].isalnum():
                k += 1
            i = max(i, at)
            if k - i < LEAST:
                continue
            if i > at:
                found.append((at, i, False))
            found.append((i, k, True))
            at = k
        if at < z:
            found.append((at, z, False))
    return found


def _train(ratios: np.ndarray):
    """Pairs of both labels; ``ratios`` of the fixed samples keep random strings out of the ordinary ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            samples: tuple[list, list] = ([], [])
            for value in batch.column(0):
                text = value.as_py()
                base = base_spans(text)
                samples[1].extend(text[s[3]:s[4]] for s in base)
                samples[0].extend(text[a:z] for a, z, secret in scored_runs(text, base, ratios, BOUND) if not secret)
            for label, strings in enumerate(samples):
                if strings:
                    counts[label] += _counts(strings)
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(counts[label, pair], pa.int64())],
                                         ["label", "pair", "n"])

    return run


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every character pair, random against ordinary, from the fixed samples and all documents.

    At most two counts for each of 69 x 69 pairs reach the driver. An empty table gives the model of the fixed samples.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    fixed = np.stack([_counts(s) for s in fixed_samples()]).reshape(2, SIZE, SIZE).astype(float)
    counted = rows.mapInArrow(_train(log_ratios(fixed)), "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, SIZE, SIZE))
    for row in counted:
        counts[row["label"], row["pair"] // SIZE, row["pair"] % SIZE] += row["n"]
    counts *= np.minimum(1, fixed.sum(axis=2, keepdims=True) / np.maximum(counts.sum(axis=2, keepdims=True), 1))
    return log_ratios(fixed + counts)


def find(text: str, ratios: np.ndarray, bound: float = BOUND) -> list[tuple[int, int, str]]:
    """All spans of one text: base kinds and stretches above the bound."""
    base = base_spans(text)
    spans = [(a, z, kind) for a, z, kind, *_ in base] + [(a, z, "random") for a, z, secret in scored_runs(text, base, ratios, bound) if secret]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str, spans: list[tuple[int, int, str]], mask: str = "[secret]") -> str:
    out, at = [], 0
    for a, z, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, z)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(ratios: np.ndarray, bound: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": z} for a, z, k in find(t.as_py(), ratios, bound)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], ["doc_id", "spans"])

    return run


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", bound: float = BOUND) -> DataFrame:
    """Per row its spans (kind, start, end in code points, end exclusive), by start, then kind.

    Null and empty texts have none. Repeated rows are scanned each. Two passes, no shuffle of texts.
    """
    rows = texts(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(train(docs, text), bound), f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def _mask(ratios: np.ndarray, bound: float, places: list[int], mask: str):
    """Replaces the text at the first place and, if there is another, sets it to the new length where the text changes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, changed = [], []
            for value in batch.column(places[0]):
                text = value.as_py()
                spans = find(text, ratios, bound) if text else []
                clean.append(redact(text, spans, mask) if spans else text)
                changed.append(clean[-1] != text)
            columns = [clean]
            if len(places) > 1:
                columns.append([len(t) if new else old for t, new, old in zip(clean, changed, batch.column(places[1]).to_pylist())])
            for place, values in zip(places, columns):
                batch = batch.set_column(place, batch.schema.field(place), pa.array(values, batch.schema.field(place).type))
            yield batch

    return run


def mask_secrets(docs: DataFrame, text: str = "text", bound: float = BOUND, mask: str = "[secret]", length: str | None = None) -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced; null texts stay null and empty ones empty.

    ``length`` names a column that is to hold the new length of the texts that were changed. Whole texts are masked,
    however long; repeated rows each; an empty table stays empty. Other columns pass through, whatever their names.
    """
    places = [docs.columns.index(c) for c in ([text, length] if length else [text])]
    return map_batches(docs, _mask(train(docs, text), bound, places, mask))


def secret_report(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the checksum of their spans, and all spans as text."""
    own = lambda s: s["kind"] == "random"
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"),
                          F.sha2(written(F.filter("spans", lambda s: ~own(s))), 256).alias("base_sha256"),
                          written(F.col("spans")).alias("spans"))
