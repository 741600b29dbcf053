"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded and cut into overlapping chunks of ``CHUNK`` bytes, ``HOP`` apart, that cover it wholly (the last is padded).
Learned filters of ``WIDTH`` bytes slide over every chunk, ``STRIDE`` bytes at a time, and keep their largest response in it. The means
and the maxima of the chunks' responses are combined linearly into one probability.

It is fitted by Adam on at most ``TRAIN_ROWS`` labelled rows, ``TRAIN_CHUNKS`` evenly placed chunks of each; the last fifth of the
sample chooses the epoch that is kept. Scoring streams every whole text through the filters in blocks of ``BLOCK`` hops.

Defined cases: null and empty texts are scored as a chunk of padding; rows without a label or id are never trained on; equal texts get
equal scores; repeated ids are scored row by row; without labels of both kinds every score is the share of good labels, or
0.5; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import bounded_sample, crc_mod, pieces

TRAIN_ROWS = 2400
TRAIN_CHUNKS = 4
CHUNK, HOP = 512, 256
EMBEDDED, WIDTH, STRIDE, FILTERS = 8, 8, 2, 32
STEPS, BATCH, RATE = 240, 64, 0.004
BLOCK = 1024
HOLD_OUT, HELD_REMAINDER = 4, 2
GOOD = 0.7
PLACES = (CHUNK - WIDTH) // STRIDE + 1
#: Filter places of a hop that stay inside a chunk which ends with the hop.
INNER = PLACES - HOP // STRIDE

Model = dict[str, np.ndarray]


def chunks_of(data: np.ndarray) -> int:
    return max(2, -(-len(data) // HOP)) - 1


def training_chunks(text: bytes) -> bytes:
    """TRAIN_CHUNKS evenly placed chunks of a text, as many bytes for every text."""
    data = np.frombuffer(text, np.uint8)
    n = chunks_of(data)
    padded = np.zeros((n + 1) * HOP, np.uint8)
    padded[: len(data)] = data
    chosen = np.linspace(0, n - 1, TRAIN_CHUNKS).astype(int)
    return b"".join(padded[k * HOP : k * HOP + CHUNK].tobytes() for k in chosen)


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[int, bytes]]:
    """Labels and training chunks of a bounded sample of the labelled rows that are not held out."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", HOLD_OUT) != HELD_REMAINDER))
    chosen = bounded_sample(known.select("doc_id", "quality"), F.col("doc_id"), rows).select(F.col("doc_id").alias("_id"), "quality")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [training_chunks((t or "").encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.binary())], names=["doc_id", "quality", "chunks"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[:2])
    parts = texts.mapInArrow(run, f"{kinds}, chunks binary").limit(2 * rows).collect()
    return [(int(r[1]), bytes(r[2])) for r in sorted(parts, key=lambda r: (r[0], r[1], bytes(r[2])))]


def responses(model: Model, data: np.ndarray) -> np.ndarray:
    """Filter outputs at every STRIDE-th byte of rows of bytes: rows x places x filters."""
    embedded = model["embedding"][data]
    rows, n = data.shape
    pairs = embedded.reshape(rows, n // STRIDE, STRIDE * EMBEDDED)
    places = (n - WIDTH) // STRIDE + 1
    out = np.zeros((rows, places, FILTERS), np.float32)
    for k in range(WIDTH // STRIDE):
        out += pairs[:, k : k + places] @ model["filters"][k * STRIDE * EMBEDDED : (k + 1) * STRIDE * EMBEDDED]
    return out


def fit(rows: list[tuple[int, bytes]], seed: int = 5) -> Model | None:
    """Filters, embedding and weights; None without rows of both labels."""
    y = np.array([r[0] for r in rows], np.float32)
    if len(rows) < 10 or not 0 < y.mean() < 1:
        return None
    rng = np.random.default_rng(seed)
    x = np.stack([np.frombuffer(r[1], np.uint8) for r in rows]).reshape(len(rows), TRAIN_CHUNKS, CHUNK)
    order = rng.permutation(len(rows))
    check, fitted = order[: len(rows) // 5], order[len(rows) // 5 :]
    model: Model = {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBEDDED), (WIDTH * EMBEDDED, FILTERS)).astype(np.float32),
        "shift": np.zeros(FILTERS, np.float32),
        "mean": np.zeros(FILTERS, np.float32),
        "most": np.zeros(FILTERS, np.float32),
        "bias": np.array([np.log(y.mean() / (1 - y.mean()))], np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    best, step = (np.inf, model), 0
    for _ in range(max(1, round(STEPS * BATCH / len(fitted)))):
        mixed = rng.permutation(fitted)
        for at in range(0, len(mixed), BATCH):
            step += 1
            for name, g in gradients(model, x[mixed[at : at + BATCH]], y[mixed[at : at + BATCH]]).items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model[name] = model[name] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        p = np.concatenate([forward(model, x[check[k : k + BATCH]])[0] for k in range(0, len(check), BATCH)])
        loss = -np.log(np.clip(np.where(y[check] > 0, p, 1 - p), 1e-6, 1)).mean()
        if loss < best[0]:
            best = (loss, {k: v.copy() for k, v in model.items()})
    return best[1]


def forward(model: Model, x: np.ndarray) -> tuple:
    docs = len(x)
    z = responses(model, x.reshape(-1, CHUNK))
    where = z.argmax(axis=1)
    top = np.maximum(np.take_along_axis(z, where[:, None], axis=1)[:, 0] + model["shift"], 0).reshape(docs, TRAIN_CHUNKS, FILTERS)
    peak = top.argmax(axis=1)
    logit = top.mean(axis=1) @ model["mean"] + top.max(axis=1) @ model["most"] + model["bias"]
    return 1 / (1 + np.exp(-logit)), top, peak, where


def gradients(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    docs = len(x)
    p, top, peak, where = forward(model, x)
    error = ((p - y) / docs).astype(np.float32)
    back = np.repeat((error[:, None] * model["mean"])[:, None] / TRAIN_CHUNKS, TRAIN_CHUNKS, axis=1)
    np.put_along_axis(back, peak[:, None], np.take_along_axis(back, peak[:, None], 1) + (error[:, None] * model["most"])[:, None], 1)
    back = (back * (top > 0)).reshape(-1, FILTERS)
    flat = x.reshape(-1, CHUNK)
    windows = flat[np.arange(len(flat))[:, None, None], where[:, :, None] * STRIDE + np.arange(WIDTH)]
    inputs = model["embedding"][windows].reshape(len(flat), FILTERS, -1)
    into = np.einsum("bf,kf->bfk", back, model["filters"]).reshape(-1, EMBEDDED)
    embedding = np.zeros_like(model["embedding"])
    for d in range(EMBEDDED):
        embedding[:, d] = np.bincount(windows.ravel(), weights=into[:, d], minlength=256)
    return {
        "embedding": embedding,
        "filters": np.einsum("bf,bfk->kf", back, inputs),
        "shift": back.sum(axis=0),
        "mean": error @ top.mean(axis=1),
        "most": error @ top.max(axis=1),
        "bias": np.array([error.sum()], np.float32),
    }


def hop_maxima(model: Model, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest responses in each hop: over all its places, and over those of a chunk that ends with it."""
    hops = len(padded) // HOP
    full = np.empty((hops, FILTERS), np.float32)
    inner = np.empty((hops, FILTERS), np.float32)
    ahead = np.concatenate([padded, np.zeros(HOP, np.uint8)])
    for at in range(0, hops, BLOCK):
        n = min(BLOCK, hops - at)
        z = responses(model, ahead[at * HOP : (at + n) * HOP + WIDTH - STRIDE][None])[0].reshape(n, HOP // STRIDE, FILTERS)
        inner[at : at + n] = z[:, :INNER].max(axis=1)
        full[at : at + n] = np.maximum(inner[at : at + n], z[:, INNER:].max(axis=1))
    return full, inner


def probabilities(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sizes = np.diff(offsets)
    hops = np.maximum(2, -(-sizes // HOP))
    ends = np.cumsum(hops)
    padded = np.zeros(int(ends[-1]) * HOP, np.uint8)
    padded[np.arange(len(data)) + np.repeat((ends - hops) * HOP - offsets[:-1], sizes)] = data
    full, inner = hop_maxima(model, padded)
    chunk = np.maximum(np.maximum(full[:-1], inner[1:]) + model["shift"], 0)
    # Hop i and the next one are a chunk, unless i is the last hop of its text.
    kept = np.ones(len(chunk), bool)
    kept[ends[:-1] - 1] = False
    starts = np.concatenate([[0], np.cumsum(hops - 1)[:-1]])
    top = chunk[kept]
    mean = np.add.reduceat(top, starts, axis=0, dtype=np.float64) / (hops - 1)[:, None]
    most = np.maximum.reduceat(top, starts, axis=0)
    return 1 / (1 + np.exp(-(mean @ model["mean"] + most @ model["most"] + model["bias"])))


def score(docs: DataFrame, model: Model | None, share: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    frame = docs.select("doc_id", "text")
    if model is None:
        scored = frame.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, data, offsets in pieces(batch, "text"):
                    p = probabilities(shared.value, data, offsets)
                    yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

        scored = frame.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select(
        "doc_id", (crc_mod("doc_id", HOLD_OUT) == HELD_REMAINDER).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that are not held out and score all documents."""
    rows = sample(docs, labels)
    return score(docs, fit(rows), sum(r[0] for r in rows) / len(rows) if rows else 0.5)
