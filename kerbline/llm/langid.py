"""Language identification: averaged hashed subword embeddings with a linear softmax and calibrated rejection.

Subwords are byte n-grams (2 to 4) of the text with A-Z lower-cased and every ASCII non-letter taken as a space. A text
is the mean of its subwords' embeddings; a linear softmax turns it into probabilities. Embeddings and softmax are fitted
together by stochastic gradient descent in numpy on a bounded sample of labelled rows (``train_rows``; of each row up to
``EXCERPTS`` evenly placed excerpts). A fifth of the sample calibrates: a temperature for the probabilities, and the
probability below which a text is rejected. Mean and softmax are linear up to the end, so tasks carry one small
table (buckets x languages) and score whole texts by adding its rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and rejected; null ids are scored and
never in the training sample; rows are scored one by one, so ties and repeated rows get equal answers; other columns
are ignored; without labelled rows every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import bounded_sample, crc_mod, pieces

TRAIN_ROWS = 4000
EXCERPTS, EXCERPT_CHARS = 4, 300
BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
REJECTED_SHARE = 0.001
UNDETERMINED = "und"
HOLD_OUT = 5

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    rows: np.ndarray  # buckets x languages: embedding times softmax weights; row 0 is zero
    bias: np.ndarray
    temperature: float
    reject_below: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each n, the bucket of the n-gram at every byte; 0 where it leaves its text or holds two spaces in a row."""
    letters = _LETTERS[data].astype(np.uint32)
    n = len(letters)
    gap = np.zeros(n, bool)
    gap[:-1] = (letters[:-1] == 32) & (letters[1:] == 32)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    h = letters.copy()
    bad = np.zeros(n, bool)
    for size in range(2, max(GRAMS) + 1):
        k = size - 1
        h[: n - k] = h[: n - k] * np.uint32(0x01000193) ^ letters[k:]
        if n > k:
            bad[: n - k] |= gap[k - 1 : n - 1]
        if size in GRAMS:
            mix = h * np.uint32(0x9E3779B1)
            ids = (mix >> np.uint32(16)).astype(np.int64) % (BUCKETS - 1) + 1
            ids[bad | (left < size)] = 0
            yield ids


def excerpts(text):
    """Up to EXCERPTS evenly placed parts of a text, as a column."""
    n = F.length(text)
    step = F.greatest(F.lit(EXCERPT_CHARS), (n / EXCERPTS).cast("int"))
    return F.concat_ws(" ", *[F.substr(text, F.lit(1) + step * k, F.lit(EXCERPT_CHARS)) for k in range(EXCERPTS)])


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, hold_out: int = HOLD_OUT) -> LanguageModel | None:
    """Fit on at most ``train_rows`` labelled rows with crc32(doc_id) mod ``hold_out`` not 0, chosen by id hash."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", hold_out) != 0)
    )
    chosen = bounded_sample(labelled, F.col("doc_id"), train_rows).filter(F.col("text").rlike(r"\p{L}"))
    sample = sorted(tuple(r) for r in chosen.select("doc_id", excerpts(F.col("text")), "lang").collect())
    return fit([r[1] for r in sample], [r[2] for r in sample]) if sample else None


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    ids = np.concatenate(list(subwords(data, np.array([0, len(data)]))))
    ids, counts = np.unique(ids[ids > 0], return_counts=True)
    return ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 7) -> LanguageModel:
    languages = tuple(sorted(set(langs)))
    index = {x: i for i, x in enumerate(languages)}
    bags = [_bag(t) for t in texts]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    held = order[: len(order) // 5] if len(order) >= 50 else order
    fitted = order[len(order) // 5 :] if len(order) >= 50 else order
    embedding = rng.normal(0, 0.3, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.3, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = EPOCHS * len(fitted), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fitted):
            rate = RATE * (1 - done / steps)
            done += 1
            ids, share = bags[i]
            mean = share @ embedding[ids]
            error = _softmax(mean @ weights + bias)
            error[index[langs[i]]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= rate * error
            # Shares are far below one; each subword moves as if it had a tenth of the text.
            embedding[ids] -= (rate * 10) * share[:, None] * back
    rows = embedding @ weights
    rows[0] = 0
    logits = np.array([share @ rows[ids] + bias for ids, share in (bags[i] for i in held)])
    truth = np.array([index[langs[i]] for i in held])
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    temperature = float(min((loss(t), t) for t in np.geomspace(0.05, 20, 60))[1])
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    # At most REJECTED_SHARE of the rightly named texts may fall below, and nothing that has the majority.
    floor = 1 / len(languages)
    reject = float(np.clip(np.quantile(right, REJECTED_SHARE) if len(right) else floor, floor, 0.5))
    return LanguageModel(languages, rows.astype(np.float32), bias, temperature, reject)


def score(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (doc_id, text and others) to doc_id, lang_pred, score, rejected; every whole text."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    frame = docs.select("doc_id", "text", lettered)
    if model is None:
        return frame.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], object)
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                sums, seen = np.zeros((rows.num_rows, len(m.languages))), np.zeros(rows.num_rows)
                full = np.flatnonzero(np.diff(offsets) > 0)
                if len(full):
                    for ids in subwords(data, offsets):
                        sums[full] += np.add.reduceat(m.rows[ids], offsets[full], axis=0, dtype=np.float64)
                        seen[full] += np.add.reduceat((ids > 0).astype(np.int64), offsets[full])
                p = _softmax((sums / np.maximum(seen, 1)[:, None] + m.bias) / m.temperature)
                best = p.argmax(axis=1)
                top = p[np.arange(len(p)), best]
                no_letter = ~rows.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                best[no_letter], top[no_letter] = len(m.languages), 0.0
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(names[best], pa.string()), pa.array(top), pa.array(no_letter | (top < m.reject_below))],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    kinds = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    return frame.mapInArrow(run, T.StructType([frame.schema["doc_id"], *[T.StructField(*k) for k in kinds]]))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` and score all of them."""
    scored = score(docs, train(docs))
    return scored.withColumn("held_out", crc_mod("doc_id", HOLD_OUT) == 0)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language the model does not reject, all columns as they are.

    The verdict is taken row by row beside the text, so no join by id is needed.
    """
    model = train(docs)
    verdict = score(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text"), model)
    return verdict.filter(~F.col("rejected")).select("doc_id.*")
