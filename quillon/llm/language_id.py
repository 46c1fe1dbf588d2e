"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.session import spread

WINDOW = 64
HIDDEN = 8
BATCH = 2048
SAMPLE_PER_LANGUAGE = 600
SAMPLE_WINDOWS = 6
SAMPLE_TEXTS = 40_000
WIDE = 64
UNKNOWN = "und"


class Network(NamedTuple):
    """Per direction: byte inputs of the three gates [256, 3H], recurrent weights [H, 3H]; output [2H, C], [C]; language names."""

    inputs: tuple[np.ndarray, np.ndarray]
    recurrent: tuple[np.ndarray, np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    languages: list[str]


def windows(text: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text in rows of ``size``, and each row's number of bytes; the last row is filled with zeros."""
    n = -(-len(text) // size)
    out = np.zeros(n * size, dtype=np.uint8)
    out[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    lengths = np.full(n, size)
    if n:
        lengths[-1] = len(text) - (n - 1) * size
    return out.reshape(n, size), lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _direction(rows: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states [T, B, H] of one gated recurrent layer over rows [B, T], in the order of the rows' columns."""
    hidden = recurrent.shape[0]
    state = np.zeros((len(rows), hidden), dtype=inputs.dtype)
    out = np.empty((rows.shape[1], len(rows), hidden), dtype=inputs.dtype)
    for t in range(rows.shape[1]):
        x, r = inputs[rows[:, t]], state @ recurrent
        gates = _sigmoid(x[:, : 2 * hidden] + r[:, : 2 * hidden])
        update, reset = gates[:, :hidden], gates[:, hidden:]
        inner = r[:, 2 * hidden :]
        candidate = np.tanh(x[:, 2 * hidden :] + reset * inner)
        if keep is not None:
            keep.append((rows[:, t], state, update, reset, inner, candidate))
        state = candidate + update * (state - candidate)
        out[t] = state
    return out


def position_probabilities(net: Network, rows: np.ndarray) -> np.ndarray:
    """[T, B, C]: the network's language probabilities at every byte of rows [B, T]."""
    ahead = _direction(rows, net.inputs[0], net.recurrent[0])
    back = _direction(rows[:, ::-1], net.inputs[1], net.recurrent[1])[::-1]
    hidden = net.recurrent[0].shape[0]
    scores = ahead @ net.output[:hidden] + back @ net.output[hidden:] + net.bias
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    return scores / scores.sum(axis=2, keepdims=True)


def pooled(net: Network, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """[B, C]: sums of the position probabilities over each row's own bytes."""
    probabilities = position_probabilities(net, rows)
    inside = (np.arange(rows.shape[1])[:, None] < lengths[None, :]).astype(probabilities.dtype)
    return np.einsum("tbc,tb->bc", probabilities, inside)


def _backward(kept: list, d_out: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction's parameters by backpropagation through time; ``d_out`` is [T, B, H]."""
    hidden = recurrent.shape[0]
    d_inputs, d_recurrent = np.zeros_like(inputs), np.zeros_like(recurrent)
    d_state = np.zeros_like(d_out[0])
    for t in range(len(kept) - 1, -1, -1):
        column, state, update, reset, inner, candidate = kept[t]
        d_state = d_state + d_out[t]
        d_candidate = d_state * (1 - update) * (1 - candidate**2)
        d_update = d_state * (state - candidate) * update * (1 - update)
        d_reset = d_candidate * inner * reset * (1 - reset)
        d_x = np.concatenate([d_update, d_reset, d_candidate], axis=1)
        d_r = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
        np.add.at(d_inputs, column, d_x)
        d_recurrent += state.T @ d_r
        d_state = d_state * update + d_r @ recurrent.T
    return d_inputs, d_recurrent


def loss_and_gradients(net: Network, rows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean log loss over all positions of the rows, and its gradients for the two inputs, two recurrents, output and bias."""
    kept: tuple[list, list] = ([], [])
    hidden = net.recurrent[0].shape[0]
    ahead = _direction(rows, net.inputs[0], net.recurrent[0], kept[0])
    back = _direction(rows[:, ::-1], net.inputs[1], net.recurrent[1], kept[1])[::-1]
    states = np.concatenate([ahead, back], axis=2)
    scores = states @ net.output + net.bias
    scores -= scores.max(axis=2, keepdims=True)
    probabilities = np.exp(scores)
    probabilities /= probabilities.sum(axis=2, keepdims=True)
    inside = (np.arange(rows.shape[1])[:, None] < lengths[None, :]) / lengths.sum()
    one = np.arange(len(rows))
    loss = -float((np.log(probabilities[:, one, labels] + 1e-12) * inside).sum())
    d = probabilities.copy()
    d[:, one, labels] -= 1
    d *= inside[:, :, None]
    d_output = np.einsum("tbh,tbc->hc", states, d)
    d_states = d @ net.output.T
    d_in0, d_rec0 = _backward(kept[0], d_states[:, :, :hidden], net.inputs[0], net.recurrent[0])
    d_in1, d_rec1 = _backward(kept[1], d_states[::-1, :, hidden:], net.inputs[1], net.recurrent[1])
    return loss, [d_in0, d_in1, d_rec0, d_rec1, d_output, d.sum(axis=(0, 1))]


def train(
    texts: list[str], names: list[str], hidden: int = HIDDEN, window: int = WINDOW, per_text: int = SAMPLE_WINDOWS, steps: int = 350,
    batch: int = 256, rate: float = 0.02, seed: int = 7,
) -> Network:
    """Fit the network on evenly spaced windows of labelled texts by backpropagation through time and Adam.

    Languages are drawn equally often, however many texts they have. Without any text the network knows no language.
    """
    parts = [spaced_windows(text.encode(), window, per_text) for text in texts]
    return train_windows(parts, names, hidden, steps, batch, rate, seed)


def spaced_windows(text: bytes, size: int = WINDOW, most: int = SAMPLE_WINDOWS) -> list[bytes]:
    """At most ``most`` windows of a text, evenly spaced over the whole of it."""
    n = -(-len(text) // size)
    return [text[i * size : (i + 1) * size] for i in np.unique(np.linspace(0, n - 1, min(most, n)).astype(int)).tolist()]


def train_windows(
    parts: list[list[bytes]], names: list[str], hidden: int = HIDDEN, steps: int = 350, batch: int = 256, rate: float = 0.02, seed: int = 7,
) -> Network:
    """``train`` on the windows of each text."""
    rng = np.random.default_rng(seed)
    languages = sorted({name for found, name in zip(parts, names, strict=True) if found})
    number = {name: i for i, name in enumerate(languages)}
    labels = [number[name] for found, name in zip(parts, names, strict=True) for _ in found]
    pieces = [piece for found in parts for piece in found]
    lengths = [len(piece) for piece in pieces]
    size = max(lengths, default=0)
    rows = [np.frombuffer(piece.ljust(size, b"\0"), np.uint8) for piece in pieces]
    count = len(languages)
    parts = [rng.normal(0, 0.3, (256, 3 * hidden)), rng.normal(0, 0.3, (256, 3 * hidden)), *(rng.normal(0, 1 / hidden**0.5, (hidden, 3 * hidden)) for _ in "ab"),
             rng.normal(0, 0.3, (2 * hidden, count)), np.zeros(count)]
    if not rows:
        return _network(parts, [])
    rows, lengths, labels = np.array(rows), np.array(lengths), np.array(labels)
    by_label = [np.flatnonzero(labels == c) for c in range(count)]
    by_label = [g for g in by_label if len(g)]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        drawn = by_label if len(by_label) <= batch else [by_label[c] for c in rng.choice(len(by_label), batch, replace=False)]
        pick = np.concatenate([rng.choice(g, -(-batch // len(drawn))) for g in drawn])
        _, gradients = loss_and_gradients(_network(parts, languages, float), rows[pick], lengths[pick], labels[pick])
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((g**2).sum()) for g in gradients)) + 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(parts, gradients, m, v, strict=True):
            g = g * scale
            a += 0.1 * (g - a)
            b += 0.001 * (g**2 - b)
            p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return _network(parts, languages)


def _network(parts: list[np.ndarray], languages: list[str], kind: type = np.float32) -> Network:
    p = [x.astype(kind, copy=False) for x in parts]
    return Network((p[0], p[1]), (p[2], p[3]), p[4], p[5], languages)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(net: Network, texts: list[str | None], batch: int = BATCH) -> list[tuple[str, float]]:
    """Language and score of whole texts: the mean of the position probabilities over all bytes, and its largest value.

    Windows of many texts run together, ``batch`` at a time (fewer with more than ``WIDE`` languages), so memory stays the same for texts of any length.
    NULL texts and texts without a letter are ``und`` with score 0.
    """
    batch = max(1, min(batch, batch * WIDE // max(1, len(net.languages))))
    use = [t is not None and bool(net.languages) and has_letter(t) for t in texts]
    totals = np.zeros((len(texts), max(1, len(net.languages))))
    held, sizes, owners, waiting = [], [], [], 0

    def flush(rows: np.ndarray, lengths: np.ndarray, owner: np.ndarray) -> None:
        for a in range(0, len(rows), batch):
            np.add.at(totals, owner[a : a + batch], pooled(net, rows[a : a + batch], lengths[a : a + batch]))

    for i, text in enumerate(texts):
        if use[i]:
            rows, lengths = windows(text.encode())
            held.append(rows)
            sizes.append(lengths)
            owners.append(np.full(len(rows), i))
            waiting += len(rows)
        if held and (waiting >= 16 * batch or i == len(texts) - 1):
            flush(np.concatenate(held), np.concatenate(sizes), np.concatenate(owners))
            held, sizes, owners, waiting = [], [], [], 0
    if held:
        flush(np.concatenate(held), np.concatenate(sizes), np.concatenate(owners))
    out = []
    for i in range(len(texts)):
        best = int(totals[i].argmax())
        out.append((net.languages[best], min(1.0, float(totals[i][best] / totals[i].sum()))) if use[i] else (UNKNOWN, 0.0))
    return out


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most_texts: int = SAMPLE_TEXTS) -> tuple[list[list[bytes]], list[str]]:
    """Windows of about ``per_language`` texts of every language, chosen by a hash of the id, and the languages.

    So many languages that this makes more than ``most_texts`` get an equal share of that, but a text at least.
    The windows are spaced over whole texts. NULL texts and languages and texts without a letter teach nothing.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min(chance).alias("least")).collect()
    if not counts:
        return [], []
    each = max(1, min(per_language, most_texts // len(counts)))
    # the text of the smallest hash always counts, so that none is left without any
    below = [(r["lang"], max(int(min(1.0, each / r["n"]) * (1 << 31)), r["least"] + 1)) for r in counts]
    bounds = docs.sparkSession.createDataFrame(below, "lang string, below bigint")
    chosen = usable.join(F.broadcast(bounds), "lang").where(chance < F.col("below")).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spaced_windows(text.encode()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.list_(pa.binary()))], ["lang", "windows"])

    # about each * len(counts) rows of at most SAMPLE_WINDOWS * WINDOW bytes; only ids repeated very often could make twice as many
    parts = chosen.mapInArrow(cut, "lang string, windows array<binary>").limit(2 * each * len(counts))
    found = sorted((r["lang"], [bytes(w) for w in r["windows"]]) for r in parts.collect())
    return [windows for _, windows in found], [lang for lang, _ in found]


def holdout(doc_id: str = "doc_id"):
    """Whether the crc32 of the id as text leaves 1 when divided by 3; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document, from the bytes of its whole text alone.

    The network learns from rows that are not held out and have a language. NULL and empty texts, and texts without
    a letter, are ``und`` with score 0. A very long text is read whole, in windows of ``WINDOW`` bytes. Repeated rows give equal
    rows; ties between languages go to the first by name. An empty table gives an empty result. Other columns are not
    looked at. If nothing can be learned, all are ``und``.
    """
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), holdout().alias("held_out"))
    net = train_windows(*training_sample(marked.where(~F.col("held_out"))))
    sent = docs.sparkSession.sparkContext.broadcast(net)  # its size depends on the number of languages only
    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predict(sent.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return spread(marked.select("doc_id", "held_out", "text")).mapInArrow(run, schema)
