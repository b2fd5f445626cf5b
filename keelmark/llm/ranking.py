"""Quality scores by Bradley-Terry pairwise ranking.

From labelled rows, pairs of a preferred and a rejected document are formed; a linear score is learnt by logistic loss
on the differences of their features. The cut is a quantile of the training scores. Scores are mapped to (0, 1) by a
logistic curve that puts the cut at ``CUT``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified, remainder

#: At most so many labelled rows train the model, those with the least hashes; the fit needs no more.
TRAIN_ROWS = 20_000
PAIRS_EACH = 32
FEATURES = 16
CUT = 0.3
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "shout": b"!?", "stop": b".,;:", "bar": b"|-_=+/\\{}[]()@~^", "space": b" \t\r\x0b\x0c", "line": b"\n"}
_TABLE = np.zeros(256, np.int64)
for _i, _members in enumerate(_CLASSES.values(), 1):
    _TABLE[np.frombuffer(_members, np.uint8)] = _i


def features(text: str | None) -> np.ndarray:
    """A fixed number of measurements of the whole text; an empty one has zeros but for the last, which marks it."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.r_[np.zeros(FEATURES - 1), 1.0]
    n, size = len(words), len(data)
    shares = np.bincount(_TABLE[np.frombuffer(data, np.uint8)], minlength=9)[1:] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    joint = len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2) if n > 2 else 1.0
    return np.r_[np.sqrt(shares), np.log1p(n) / 10, lengths.mean() / 10, lengths.std() / 10, len(set(words)) / n,
                 1 - len(set(lines)) / len(lines), joint, np.sqrt((lengths <= 1).mean()), 0.0]


def fitted(rows: np.ndarray, labels: np.ndarray, pairs_each: int = PAIRS_EACH, penalty: float = 1e-3, seed: int = 11) -> dict:
    """Weights, the cut on the raw score and its spread. Without both labels, every document gets one score over the cut."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    mean, scale = (rows.mean(axis=0), rows.std(axis=0) + 1e-6) if len(rows) else (np.zeros(FEATURES), np.ones(FEATURES))
    if not len(good) or not len(bad):
        return {"mean": mean, "scale": scale, "w": np.zeros(len(mean)), "cut": -1.0, "spread": 1.0}
    x = (rows - mean) / scale
    rng = np.random.default_rng(seed)
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    first, second = np.repeat(few, pairs_each), rng.choice(many, len(few) * pairs_each)
    difference = x[second] - x[first] if few is bad else x[first] - x[second]
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        gradient = -(difference * p[:, None]).mean(axis=0) + penalty * w
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    raw = x @ w
    # the quantile at which fewest training rows fall on the wrong side; between equals the lowest, which keeps most
    order = np.argsort(raw, kind="stable")
    wrong = np.r_[0, np.cumsum(np.where(labels[order] == 1, 1, -1))]
    at = int(np.argmin(wrong))
    cut = raw[order[0]] - 1 if at == 0 else raw[order[-1]] + 1 if at == len(raw) else (raw[order[at - 1]] + raw[order[at]]) / 2
    return {"mean": mean, "scale": scale, "w": w, "cut": float(cut), "spread": float(raw.std()) or 1.0, "quantile": at / len(raw)}


def scored_rows(x: np.ndarray, model: dict) -> np.ndarray:
    raw = (((x - model["mean"]) / model["scale"]) @ model["w"] - model["cut"]) / model["spread"]
    return 1 / (1 + np.exp(-np.clip(2 * raw + np.log(CUT / (1 - CUT)), -60, 60)))


def _featured(docs: DataFrame, others: list[str]) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), *batch.columns[1:]], names=["x", *others])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select("text", *others).mapInArrow(made, f"x array<double>, {kinds}")


def trained(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, by: int = 5) -> dict:
    """Fit on labelled documents whose id's crc32 modulo ``by`` is not 0; at most ``train_rows`` rows reach the driver."""
    usable = labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality")).where(
        "labelled is not null and quality in (0, 1)").where(remainder("labelled", by) != 0)
    sample = usable.orderBy(F.xxhash64("labelled"), "labelled", "quality").limit(train_rows)  # bounded by the parameter
    narrow = identified(docs)
    rows = narrow.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select("text", "labelled", "quality")
    got = sorted(_featured(rows, ["labelled", "quality"]).limit(2 * train_rows).collect(), key=lambda r: (r["labelled"], r["quality"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), FEATURES)
    return fitted(x, np.array([r["quality"] for r in got]))


def scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, by: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null and empty texts have a score like others. Labels other than 0 and 1 and null ones are not used; ids with
    several labels count with each. Null ids are held in by the crc32 of the empty text. Without both labels every
    document is predicted 1. Repeated rows come out as often as they came in; an empty table gives an empty result;
    other columns are ignored.
    """
    model = trained(docs, labels, train_rows, by)
    narrow = identified(docs).withColumn("held_out", remainder("doc_id", by) == 0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")]).reshape(len(batch), FEATURES)
            s = scored_rows(x, model) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
