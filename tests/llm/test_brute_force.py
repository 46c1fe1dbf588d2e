"""The shuffle, the language network and the toxicity fit against plain implementations of their definitions."""

import math
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from quillon.llm import language_id, sharding, toxicity
from quillon.session import Scratch


class Watched(Scratch):
    """A scratch that remembers what it kept."""

    def keep(self, df):
        self.kept = [*getattr(self, "kept", []), super().keep(df)]
        return self.kept[-1]


def spark_hash(seed, place):
    """Spark's xxhash64 of an int and a bigint, as a signed number."""
    first = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", place), first)))[0]


@pytest.mark.parametrize(("rows", "parts", "matrix_rows", "bucket"), [(500, 7, 2048, 100_000), (300, 9, 4, 20), (3, 2, 2048, 1)])
def test_shuffle_equals_plain_python(spark, rows, parts, matrix_rows, bucket):
    shards, seed, scratch = 6, 11, Watched(spark)
    found = sharding.shuffle_into_shards(spark.range(rows).repartition(parts), shards, scratch, seed, matrix_rows, bucket).collect()
    places = {r["c0"]: r["__place"] for r in scratch.kept[0].collect()}
    scratch.clear()
    blocks = defaultdict(list)
    for i, place in places.items():
        blocks[(place >> 33) % matrix_rows].append(i)
    names = sorted(blocks)
    sizes = [rows // shards + (s < rows % shards) for s in range(shards)]
    matrix = sharding.communication_matrix([len(blocks[b]) for b in names], sizes, seed)
    arrived = defaultdict(list)
    for b, sent in zip(names, matrix, strict=True):
        order = sorted(blocks[b], key=lambda i: (spark_hash(2 * seed + 1, places[i]), places[i]))
        at = 0
        for s, n in enumerate(sent):
            arrived[s] += order[at : at + n]
            at += n
    wanted = {}
    for s, members in arrived.items():
        for slot, i in enumerate(sorted(members, key=lambda i: (spark_hash(2 * seed + 2, places[i]), places[i]))):
            wanted[i] = (s, slot)
    assert {r["id"]: (r["shard"], r["slot"]) for r in found} == wanted


def plain_probabilities(net, row):
    """Language probabilities at each byte, one gate and one number at a time."""
    hidden = net.recurrent[0].shape[0]

    def states(data, inputs, recurrent):
        state, out = [0.0] * hidden, []
        for byte in data:
            r = [sum(state[i] * recurrent[i][j] for i in range(hidden)) for j in range(3 * hidden)]
            x, new = inputs[byte], []
            for j in range(hidden):
                update = 1 / (1 + math.exp(-(x[j] + r[j])))
                reset = 1 / (1 + math.exp(-(x[hidden + j] + r[hidden + j])))
                candidate = math.tanh(x[2 * hidden + j] + reset * r[2 * hidden + j])
                new.append(update * state[j] + (1 - update) * candidate)
            state = new
            out.append(state)
        return out

    ahead, back = states(row, net.inputs[0], net.recurrent[0]), states(row[::-1], net.inputs[1], net.recurrent[1])[::-1]
    out = []
    for a, b in zip(ahead, back, strict=True):
        scores = [sum(v * net.output[k][c] for k, v in enumerate([*a, *b])) + net.bias[c] for c in range(len(net.languages))]
        top = max(scores)
        e = [math.exp(s - top) for s in scores]
        out.append([v / sum(e) for v in e])
    return out


def test_network_equals_plain_loops():
    rng = np.random.default_rng(1)
    parts = [rng.normal(0, 0.6, s) for s in ((256, 9), (256, 9), (3, 9), (3, 9), (6, 4), (4,))]
    net = language_id._network(parts, list("abcd"), float)
    rows = rng.integers(0, 256, (5, 11)).astype(np.uint8)
    found = language_id.position_probabilities(net, rows)
    for i, row in enumerate(rows):
        assert np.allclose(found[:, i], plain_probabilities(net, row.tolist()), atol=1e-12)
    text = "Ünd so weiter, " * 9
    data, total = text.encode(), np.zeros(4)
    for at in range(0, len(data), language_id.WINDOW):
        piece = data[at : at + language_id.WINDOW].ljust(language_id.WINDOW, b"\0")
        total += np.array(plain_probabilities(net, list(piece)))[: len(data) - at].sum(axis=0)
    name, score = language_id.predict(net, [text])[0]
    assert name == "abcd"[int(total.argmax())] and abs(score - total.max() / len(data)) < 1e-9


def test_fit_equals_dense_algebra():
    rng = np.random.default_rng(2)
    n, width = 60, 25
    x = (rng.random((n, width)) < 0.3).astype(float)
    y = (x[:, 3] + x[:, 7] + rng.random(n) > 1.1).astype(float)
    pairs = {((3,), (20,)): 4, ((7, 9), (21, 22)): 1}
    found = toxicity.fit_features([np.flatnonzero(r) for r in x], y, pairs, balance=1.5, steps=80)
    moves = np.zeros((2, width))
    for row, (gone, come) in enumerate(sorted(pairs)):
        moves[row, list(gone)], moves[row, list(come)] = 1, -1
    share = np.array([pairs[p] for p in sorted(pairs)]) / 5
    cost = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    w, b, m, v = np.zeros(width), 0.0, np.zeros(width + 1), np.zeros(width + 1)
    used = x.any(axis=0) | moves.any(axis=0)
    for step in range(1, 81):
        error = cost * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = np.append((x.T @ error + 1e-4 * w + 2 * 1.5 * moves.T @ (share * (moves @ w))) * used, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    assert np.allclose(found.weights[:width], w, atol=1e-5) and abs(found.bias - b) < 1e-6 and found.pairs == 5
    assert not found.weights[width:].any()


def test_features_and_scores_equal_their_definition():
    rng = random.Random(3)
    words = ["idiot", "scum", "friendly", "people", "he", "she", "elle", "über", "x1y"]
    weights = np.zeros(1 << toxicity.BITS, np.float32)
    for w in ("idiot", "^frien", "über"):
        weights[zlib.crc32(w.encode()) & ((1 << toxicity.BITS) - 1)] += rng.random()
    model = toxicity.Model(weights, -0.4)
    for _ in range(50):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 9))).title()
        letters = {part for w in text.lower().split() for part in "".join(c if c.isalpha() else " " for c in w).split()}
        names = letters | {"^" + w[:5] for w in letters if len(w) > 5}
        logit = -0.4 + sum(float(weights[i]) for i in {zlib.crc32(n.encode()) % (1 << toxicity.BITS) for n in names})
        assert abs(toxicity.score(model, text) - 1 / (1 + math.exp(-logit))) < 1e-6


def test_swaps_change_the_features_of_their_sentences_only():
    following = toxicity.following_terms(toxicity.IDENTITY_TERMS)
    assert following["he"] == "she" and following["elle"] == "il" and following["er"] == "sie"
    found = toxicity.swapped_features("He walks. Nobody else! He walks; she too", following)
    assert sum(found.values()) == 1  # he to she; the second sentence has no term, and the third keeps its features
    assert all(gone and come and not set(gone) & set(come) for gone, come in found)


def test_sample_for_the_fit_has_no_texts(spark):
    rows = [(i, ("He is an idiot scum. " if i % 2 else "She is kind here. ") + f"w{i % 7} " * 30) for i in range(120)] + [(500, "he " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    scratch = Scratch(spark)
    sample = toxicity.labelled_sample(docs, labels, scratch)
    scratch.clear()
    texts = [t for _, t in rows]
    plain = toxicity.fit(texts, [i % 2 for i, _ in rows])
    fitted = toxicity.fit_features(sample.rows, sample.labels, sample.pairs)
    assert len(sample.rows) == len(rows) and max(len(r) for r in sample.rows) < 40
    assert np.allclose(plain.weights, fitted.weights, atol=1e-4) and plain.pairs == fitted.pairs > 100
    assert toxicity.labelled_sample(docs.where("false"), labels, Scratch(spark)).rows == []
    assert toxicity.score_all(docs.where("false"), labels).count() == 0
