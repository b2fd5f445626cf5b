"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary writing.

Both models are first-order over the letters, digits and a few signs. They are trained from labelled samples of the corpus
itself: the values of the base patterns are the random strings, all text outside base spans and candidates is ordinary. A candidate is secret where the
log-likelihood ratio per character is above a threshold.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified

# ---------------------------------------------------------------- fixed values
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
# ------------------------------------------------------------ end fixed values
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")

THRESHOLD = 1.0  # nats per character
_CLASS = np.full(256, len(ALPHABET), np.int64)
_CLASS[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
_SIDE = len(ALPHABET) + 1

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def transitions(text: str) -> np.ndarray:
    """Counts of neighbouring characters; whatever is outside the alphabet counts as one character."""
    kinds = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    return np.bincount(kinds[:-1] * _SIDE + kinds[1:], minlength=_SIDE * _SIDE) if len(kinds) > 1 else np.zeros(_SIDE * _SIDE, np.int64)


def secret_value(text: str, span: Span) -> str:
    matched = text[span[1]: span[2]]
    return (ASSIGN.match(matched) or [None, None, matched])[2] if span[0] == "assign" else matched


def model(counts: np.ndarray, weight: float = 20.0) -> np.ndarray:
    """Log probabilities of each transition; a row leans on the frequencies of single characters by ``weight`` counts."""
    table = counts.reshape(_SIDE, _SIDE).astype(np.float64)
    single = (table.sum(axis=0) + 1) / (table.sum() + _SIDE)
    return np.log((table + weight * single) / (table.sum(axis=1, keepdims=True) + weight))


def ratios(secret: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each transition."""
    return model(secret) - model(ordinary)


def trained(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Ratios from counts over all texts. Tasks add up their counts; the driver gets two tables of fixed size."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        secret, everything, labelled_or_open = (np.zeros(_SIDE * _SIDE, np.int64) for _ in range(3))
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                everything += transitions(text)
                base = base_spans(text)
                for span in base:
                    value = transitions(secret_value(text, span))
                    secret += value
                    labelled_or_open += value
                for begin, end in candidates(text, base):
                    labelled_or_open += transitions(text[begin:end])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SIDE * _SIDE)), pa.array(secret), pa.array(everything - labelled_or_open)], names=["at", "secret", "ordinary"])

    rows = docs.select(docs[text_column].cast("string")).mapInArrow(counted, "at bigint, secret bigint, ordinary bigint").groupBy("at").agg(
        F.sum("secret").alias("secret"), F.sum("ordinary").alias("ordinary")).collect()
    secret, ordinary = np.zeros(_SIDE * _SIDE, np.int64), np.zeros(_SIDE * _SIDE, np.int64)
    for r in rows:
        secret[r["at"]], ordinary[r["at"]] = r["secret"], max(0, r["ordinary"])  # base spans of two kinds may overlap
    return ratios(secret, ordinary)


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Strings of 20 characters or more, with a digit and a letter, that no base span touches."""
    for m in CANDIDATE.finditer(text):
        if re.search(r"[0-9]", m[0]) and re.search(r"[A-Za-z]", m[0]) and not any(s < m.end() and m.start() < e for _, s, e in base):
            yield m.span()


def model_spans(text: str, base: list[Span], table: np.ndarray, threshold: float = THRESHOLD) -> list[Span]:
    """Candidates that look more like random strings than like ordinary writing."""
    found = []
    for begin, end in candidates(text, base):
        kinds = _CLASS[np.frombuffer(text[begin:end].encode(), np.uint8)]
        if table[kinds[:-1], kinds[1:]].mean() > threshold:
            found.append(("random", begin, end))
    return found


def scanned(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, counts per base kind and of random strings, ``base_sha256`` and ``spans`` of every row.

    Null and empty texts have no spans; the digest of no spans is that of the empty string. Null ids, repeated rows and
    texts are kept as they are. An empty table gives an empty result; other columns are ignored.
    """
    narrow = identified(docs)
    table = trained(narrow)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                extra = model_spans(text, base, table, threshold)
                counts.append([sum(k == kind for k, _, _ in (*base, *extra)) for kind in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + extra))
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else ((), (), (), ()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(scan, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string")
