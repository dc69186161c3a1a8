"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads a window of bytes in both directions, labels every position, and a document's
probabilities are the mean over all of its positions. It is trained in numpy by backpropagation
through time on a bounded sample of labelled rows: about ``SAMPLE_DOCS`` different texts, shared evenly
by the labels, and ``SAMPLE_WINDOWS`` windows spread over each. Prediction reads every byte of every document, in
windows of ``WINDOW`` bytes, many windows at a time, inside Arrow batches; the weights (some
thousand numbers) travel in the closure.

Documents are the rows whose language is predicted; only text is an input. Rows are cut
into windows within their task, so a very long text costs time, never more memory than its bytes.

Defined cases: null text, and text without a letter, is ``und`` with score 0; a null or repeated id
is carried along (each row has its own prediction); without any labelled row every text with a
letter is ``und`` with score 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.llm.common import table
from tidegauge.session import materialize

WINDOW = 128
HIDDEN = 8
SAMPLE_DOCS = 2_000
SAMPLE_WINDOWS = 4
#: Texts of each label where many labels share the sample.
LEAST_PER_LABEL = 16
#: Texts under the hash limit for each that is wanted.
SPARE = 4
EPOCHS = 8
BATCH = 128
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start_weights(labels: int, hidden: int = HIDDEN, seed: int = 7) -> Weights:
    """``x``: what a byte adds to the three gates of each direction; ``h``: recurrent; ``o``: labels."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype("f4")
    return {"x": draw(2, 256, 3 * hidden, scale=0.5), "h": draw(2, hidden, 3 * hidden, scale=hidden ** -0.5),
            "b": np.zeros((2, hidden), "f4"), "o": draw(2 * hidden, labels, scale=0.3), "ob": np.zeros(labels, "f4")}


def _states(w: Weights, side: int, steps: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States after each step (time, row, hidden); ``live`` is 0 where a row has no byte, which holds the state."""
    n, hidden = steps.shape[1], w["h"].shape[1]
    x, u, bias = w["x"][side], w["h"][side], w["b"][side]
    out, state, trace = np.empty((len(steps), n, hidden), "f4"), np.zeros((n, hidden), "f4"), []
    for t, (byte, on) in enumerate(zip(steps, live, strict=True)):
        gates, inner = x[byte], state @ u
        zr = _sigmoid(gates[:, :2 * hidden] + inner[:, :2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        rest = inner[:, 2 * hidden:] + bias
        new = np.tanh(gates[:, 2 * hidden:] + r * rest)
        step = z * on[:, None]
        if keep:
            trace.append((state, step, z, r, rest, new))
        state = state + step * (new - state)
        out[t] = state
    return out, trace


def _both(w: Weights, steps: np.ndarray, live: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    ahead, a = _states(w, 0, steps, live, keep)
    back, b = _states(w, 1, steps[::-1], live[::-1], keep)
    return np.concatenate([ahead, back[::-1]], axis=2), (a, b)


def label_positions(w: Weights, steps: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Label probabilities of every position: (time, row, label)."""
    states, _ = _both(w, steps, live)
    scores = states.reshape(-1, states.shape[2]) @ w["o"] + w["ob"]
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return (scores / scores.sum(axis=1, keepdims=True)).reshape(*steps.shape, -1)


def gradients(w: Weights, steps: np.ndarray, live: np.ndarray, labels: np.ndarray) -> tuple[float, Weights]:
    """Mean cross-entropy of the labels of all live positions, and its gradient through time."""
    states, traces = _both(w, steps, live, keep=True)
    hidden, total = w["h"].shape[1], max(live.sum(), 1.0)
    scores = states @ w["o"] + w["ob"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    share = scores / scores.sum(axis=2, keepdims=True)
    rows = np.arange(steps.shape[1])
    loss = -(np.log(share[:, rows, labels] + 1e-9) * live).sum() / total
    share[:, rows, labels] -= 1
    share *= live[:, :, None] / total
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["o"] = np.einsum("tnh,tnl->hl", states, share, optimize=True)
    grad["ob"] = share.sum((0, 1))
    down = share @ w["o"].T
    for side in (0, 1):
        part = down[:, :, side * hidden:(side + 1) * hidden]
        ordered, order = (part, steps) if side == 0 else (part[::-1], steps[::-1])
        u, carry = w["h"][side], np.zeros((steps.shape[1], hidden), "f4")
        for t in range(len(steps) - 1, -1, -1):
            state, step, z, r, rest, new = traces[side][t]
            carry = carry + ordered[t]
            on = live[t] if side == 0 else live[len(steps) - 1 - t]
            d_new = carry * step * (1 - new * new)
            d_z = carry * on[:, None] * (new - state) * z * (1 - z)
            d_r = d_new * rest * r * (1 - r)
            d_inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_gates = np.concatenate([d_z, d_r, d_new], axis=1)
            np.add.at(grad["x"][side], order[t], d_gates)
            grad["h"][side] += state.T @ d_inner
            grad["b"][side] += (d_new * r).sum(0)
            carry = carry * (1 - step) + d_inner @ u.T
    return float(loss), grad


def windows_of(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps and live flags (time, window) of all windows of all texts, and each window's text number."""
    counts = [-(-len(t) // width) for t in texts]
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = np.frombuffer(b"".join(t.ljust(c * width, b"\0") for t, c in zip(texts, counts, strict=True)), np.uint8)
    lengths = np.full(len(owner), width, np.int64)
    ends = np.cumsum(counts) - 1
    for i, (t, c) in enumerate(zip(texts, counts, strict=True)):
        if c:
            lengths[ends[i]] = len(t) - (c - 1) * width
    live = (np.arange(width)[:, None] < lengths[None, :]).astype("f4")
    return np.ascontiguousarray(flat.reshape(-1, width).T), live, owner


def train(texts: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> tuple[Weights, list[str]]:
    """Adam on mini-batches of windows, the first ``SAMPLE_WINDOWS`` spread over each text; label classes weigh alike."""
    names = sorted(set(labels))
    kinds = np.array([names.index(x) for x in labels])
    pieces, kind = [], []
    for text, k in zip(texts, kinds, strict=True):
        count = -(-len(text) // WINDOW)
        for i in range(0, count, max(1, count // SAMPLE_WINDOWS)):
            pieces.append(text[i * WINDOW:(i + 1) * WINDOW])
            kind.append(k)
    kind = np.array(kind)
    steps, live, _ = windows_of(pieces)
    rng, w = np.random.default_rng(seed), start_weights(len(names), seed=seed)
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    sizes = np.bincount(kind, minlength=len(names))
    chance = (1 / np.maximum(sizes, 1))[kind]
    per_epoch = max(30, min(len(kind), 6_000) // BATCH)
    for _ in range(epochs * per_epoch):
        pick = rng.choice(len(kind), min(BATCH, len(kind)), p=chance / chance.sum())
        _, grad = gradients(w, steps[:, pick], live[:, pick], kind[pick])
        step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            w[k] = (w[k] - 0.02 * mean[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)).astype("f4")
    return w, names


def pooled(w: Weights, texts: list[bytes], at_once: int = 1024) -> np.ndarray:
    """Mean label probabilities over all positions of each text; zeros for an empty one."""
    labels = w["o"].shape[1]
    sums, counts = np.zeros((len(texts), labels)), np.zeros(len(texts))
    block, start = max(1, at_once * WINDOW), 0
    while start < len(texts):  # texts of about `at_once` windows at a time; a longer text alone
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= 8 * block):
            size += len(texts[stop])
            stop += 1
        steps, live, owner = windows_of(texts[start:stop])
        for i in range(0, len(owner), at_once):
            part = slice(i, i + at_once)
            on = live[:, part]
            shares = label_positions(w, steps[:, part], on)
            np.add.at(sums, owner[part] + start, np.einsum("tnl,tn->nl", shares, on, optimize=True))
            np.add.at(counts, owner[part] + start, on.sum(0))
        start = stop
    return sums / np.maximum(counts, 1)[:, None]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", usable: Column | None = None,
        limit: int = SAMPLE_DOCS) -> tuple[Weights, list[str]] | None:
    """Trains on a sample of labelled rows; None without any.

    Copies of a text count once per label. Every label gets the same number of texts, those of smallest
    hash, about ``limit`` in all and ``LEAST_PER_LABEL`` at least, so frequent labels take no place from
    rare ones. Of each text ``SAMPLE_WINDOWS`` windows spread over the whole of it are taken.
    """
    text, lang = F.col(text_col), F.col(lang_col)
    rows = docs.where(usable) if usable is not None else docs
    rows = rows.where(text.isNotNull() & lang.isNotNull() & text.rlike(r"\p{L}")).select(
        lang.cast("string").alias("l"), F.xxhash64(text).alias("h"), text.alias("t"))
    keys = materialize(rows.select("l", "h").distinct(), "labelled-texts")
    counts = keys.groupBy("l").agg(F.count(F.lit(1)).alias("texts"))
    labels = counts.count()
    if not labels:
        return None
    each = max(LEAST_PER_LABEL, limit // labels)
    # Several times the texts wanted, by hash, so that few of a frequent label are ever sorted.
    below = keys.join(counts, "l").where(F.shiftrightunsigned("h", 1) <= F.lit(SPARE * each * 2.0**63) / F.col("texts"))
    place = F.row_number().over(W.partitionBy("l").orderBy("h"))
    chosen = below.select("l", "h", place.alias("place")).where(F.col("place") <= each).drop("place")
    chosen = F.broadcast(chosen)  # each * labels rows at most
    size = F.greatest(F.length("t"), F.lit(1))
    starts = [F.floor(size * i / SAMPLE_WINDOWS).cast("int") for i in range(SAMPLE_WINDOWS)]
    whole = F.length("t") <= SAMPLE_WINDOWS * WINDOW
    parts = F.when(whole, F.array("t")).otherwise(F.array(*[F.substring("t", start + 1, F.lit(WINDOW)) for start in starts]))
    found = rows.join(chosen, ["l", "h"]).select("l", "h", parts.alias("parts"))
    sample = found.groupBy("l", "h").agg(F.min("parts").alias("parts")).orderBy("l", "h").collect()
    pieces = [(part.encode(), r["l"]) for r in sample for part in r["parts"]]
    return train([p for p, _ in pieces], [lang for _, lang in pieces])


def predict(docs: DataFrame, model: tuple[Weights, list[str]] | None, text_col: str = "text",
            keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: ``row``, the whole input row) with ``lang_pred`` and ``score``."""
    kept = keep or {"row": F.struct("*")}
    rows = docs.select(*[c.alias(n) for n, c in kept.items()], F.col(text_col).cast("binary").alias("text"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    out = rows.drop("text", "letters").schema.add("lang_pred", "string").add("score", "double")
    weights, names = model or (None, [])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                *columns, text, letters = part.columns
                found = np.array(letters.to_pylist(), bool) if weights is not None else np.zeros(len(part), bool)
                texts = [t.as_py() for t, f in zip(text, found, strict=True) if f]
                shares = pooled(weights, texts) if texts else np.zeros((0, 1))
                lang, score = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                lang[found] = [names[i] for i in shares.argmax(1)] if texts else []
                score[found] = np.clip(shares.max(1), 0, 1) if texts else []
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 [*part.schema.names[:-2], "lang_pred", "score"])

    return rows.mapInArrow(label, out)


def _slices(batch: pa.RecordBatch, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` text bytes."""
    start, size = 0, 0
    for i, text in enumerate(batch.column("text")):
        size += len(text.as_buffer() or b"") if text.is_valid else 0
        if size > most:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(batch):
        yield batch.slice(start)


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, usable=fold() != HELD_OUT)
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held}).select("doc_id", "held_out", "lang_pred", "score")
