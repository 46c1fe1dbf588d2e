"""The row-level parts of the corpus operators against plain definitions; no Spark."""

import hashlib
import io
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import decontaminate, language_id, packing_plan, sharding, signature_tree, toxicity, warc
from quillon.llm.encoders import Encoder, encoder, encoder_version

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- encoders


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60) | st.text("ab éß\n\t'sll123<|endoftext|>", max_size=60))
def test_encoder_equals_library(text):
    exact = encoder(BYTE_BPE).exact.encode(text, add_special_tokens=False).ids
    assert list(encoder(BYTE_BPE).encode(text)) == exact


def test_encoder_uses_the_fast_engine_and_knows_special_strings():
    assert encoder(BYTE_BPE).fast is not None
    assert list(encoder(BYTE_BPE).encode("<|endoftext|>")) == [50256]
    assert encoder(BYTE_BPE).count("") == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_go_to_their_library(name):
    other = Encoder(public_tokenizers.path(name))
    assert other.fast is None
    assert other.count("one two three") > 0
    assert encoder_version(public_tokenizers.path(name)) != encoder_version(BYTE_BPE)


# --- packing plan


def laid_out(moves, histogram):
    """Sequence -> [(offset, length)], and the pieces used, by expanding every move."""
    sequences, used = {}, {n: [] for n in histogram}
    for m in moves:
        used[m.length] += range(m.start, m.start + m.count)
        for i in range(m.count):
            sequences.setdefault(m.first + i, []).append((m.offset, m.length))
    return sequences, used


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20), st.integers(1, 12))
def test_plan_places_every_piece_once_without_gaps(histogram, groups):
    moves, count = packing_plan.plan(histogram, 64, groups)
    sequences, used = laid_out(moves, histogram)
    assert all(sorted(used[n]) == list(range(c)) for n, c in histogram.items())
    assert set(sequences) == set(range(count))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_plan_is_near_the_lower_bound():
    rng = random.Random(1)
    histogram = {}
    for _ in range(20_000):
        n = rng.choice([rng.randint(1, 1024), rng.randint(1, 200)])
        histogram[n] = histogram.get(n, 0) + 1
    _, count = packing_plan.fewest_sequences(histogram, 1024)
    assert count <= 1.005 * -(-sum(n * c for n, c in histogram.items()) // 1024) + 1


def test_configurations_find_the_perfect_pairing():
    found = packing_plan.configurations([700, 324], [50, 50], 1024)
    assert sum(often for _, often in found) == 50


def test_empty_plan():
    assert packing_plan.fewest_sequences({}, 1024) == ([], 0)


# --- communication matrix


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=8), st.integers(1, 6), st.integers(0, 99))
def test_matrix_has_exact_margins(counts, shards, seed):
    total = sum(counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = sharding.communication_matrix(counts, sizes, seed)
    assert (matrix >= 0).all()
    assert list(matrix.sum(axis=1)) == counts
    assert not counts or list(matrix.sum(axis=0)) == sizes


def test_matrix_follows_the_hypergeometric_law():
    drawn = [sharding.communication_matrix([6, 6], [6, 6], seed)[0, 0] for seed in range(4000)]
    assert abs(np.mean(drawn) - 3) < 0.07
    assert abs(np.var(drawn) - 6 * 0.25 * 6 / 11) < 0.07


def test_huge_draws_stay_in_bounds():
    rng = np.random.default_rng(0)
    assert 0 <= sharding._hypergeometric(rng, 10**10, 10**11, 10**9) <= 10**9


# --- decontamination


def edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (p != t))
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90))
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.best_distance(pattern, text) == edit_distance(pattern, text)


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=1, max_size=200), st.integers(0, 9))
def test_pieces_cover_the_item(item, budget):
    budget = min(budget, len(item) - 1)
    found = decontaminate.pieces(item, budget)
    assert len(found) == budget + 1
    assert "".join(p for _, p in found) == item


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_matcher_equals_brute_force(seed):
    rng = random.Random(seed)
    item = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 120)))
    changed = list(item)
    for _ in range(rng.randint(0, 9)):
        at = rng.randrange(len(changed))
        changed[at : at + 1] = rng.choice([[], ["x"], [changed[at], "y"]])
    noise = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))) for _ in "12"]
    text = noise[0] + "".join(changed) + noise[1]
    budget = decontaminate.error_budget(len(item), 0.06, 12)
    best = edit_distance(item, text)
    found = decontaminate.Matcher([(5, item)], 0.06, 12).find(text)
    assert found == ([(5, best)] if best <= budget else [])


# --- signature trees


def words_of(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").split(" ") if w]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "cé", "Éx", "dd"]), max_size=30))
def test_shingles_count_distinct_runs(tokens):
    low = words_of(" ".join(tokens))
    runs = {tuple(low[i : i + 4]) for i in range(max(1, len(low) - 3))} if low else set()
    assert len(signature_tree.shingles("  ".join(tokens) + "\n")) == len(runs)


def test_shingles_do_not_depend_on_slices(monkeypatch):
    text = " ".join(str(i % 97) for i in range(3000)) + " " + "x" * 5000 + " end"
    whole = signature_tree.shingles(text)
    monkeypatch.setattr(signature_tree, "SLICE", 100)
    assert (signature_tree.shingles(text) == whole).all()


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6))
def test_linked_sets_share_a_key(n, seed):
    rng = np.random.default_rng(seed)
    router = signature_tree.Router(85)
    a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    keep = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.1])]
    b = np.unique(np.concatenate([keep, rng.integers(0, 2**64, rng.integers(0, max(1, n // 8) + 1), dtype=np.uint64)]))
    if len(b) and signature_tree.linked(a, b, 85) and len(np.setxor1d(a, b)):
        assert set(router.keys(a)) & set(router.keys(b))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.booleans())
def test_tree_finds_the_components_of_all_pairs(seed, across):
    rng = np.random.default_rng(seed)
    bases = [rng.integers(0, 2**64, rng.integers(1, 60), dtype=np.uint64) for _ in range(4)]
    sets = []
    for _ in range(rng.integers(2, 60)):
        base = bases[rng.integers(len(bases))]
        kept = base[rng.random(len(base)) > 0.06]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**64, rng.integers(0, 4), dtype=np.uint64)])))
    sets = [s for s in sets if len(s)]
    side = rng.integers(0, 2, len(sets))

    def parts(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            label = [label[i] if x == label[j] else x for x in label]
        return {frozenset(k for k in range(len(sets)) if label[k] == x) for x in label}

    every = [(i, j) for i in range(len(sets)) for j in range(i) if signature_tree.linked(sets[i], sets[j], 85) and (not across or side[i] != side[j])]
    found = signature_tree.links(sets, side, across, 85)
    assert all(signature_tree.linked(sets[i], sets[j], 85) for i, j in found)
    assert parts(found) == parts(every)


@pytest.mark.parametrize("across", [False, True])
def test_many_short_sets_with_one_common_element_fit_bounded_memory(across):
    rng = np.random.default_rng(3)
    sets = [np.unique(np.append(rng.integers(0, 2**64, 14, dtype=np.uint64), np.uint64(5))) for _ in range(20_000)]
    for i, j in ((3, 19_000), (19_000, 41), (7, 8)):
        sets[j] = np.unique(np.append(sets[i][1:], np.uint64(j)))
    side = np.arange(len(sets)) % 2 if across else np.zeros(len(sets), int)
    tracemalloc.start()
    found = signature_tree.links(sets, side, across, 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 3 and {i for p in found for i in p} == {3, 41, 19_000, 7, 8}
    assert all(signature_tree.linked(sets[i], sets[j], 85) for i, j in found)
    assert peak < 150_000_000


# --- language identification


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    shapes = [(256, 6), (256, 6), (2, 6), (2, 6), (4, 3), (3,)]
    parts = [rng.normal(0, 0.5, s) for s in shapes]
    rows, lengths, labels = rng.integers(0, 5, (4, 7)).astype(np.uint8), np.array([7, 7, 3, 5]), np.array([0, 1, 2, 1])
    _, gradients = language_id.loss_and_gradients(language_id._network(parts, list("abc"), float), rows, lengths, labels)
    for p, g in zip(parts, gradients, strict=True):
        for at in [tuple(rng.integers(0, min(n, 5)) for n in p.shape) for _ in range(6)]:
            old, step = p[at], 1e-5
            p[at] = old + step
            up, _ = language_id.loss_and_gradients(language_id._network(parts, list("abc"), float), rows, lengths, labels)
            p[at] = old - step
            down, _ = language_id.loss_and_gradients(language_id._network(parts, list("abc"), float), rows, lengths, labels)
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 1e-6


def test_prediction_pools_whole_texts_whatever_the_batch():
    texts = ["the quick brown fox " * 9, "ñandú señor año " * 30, None, "123 !?", ""]
    net = language_id.train([texts[0], texts[1]] * 4, ["en", "es"] * 4, steps=40)
    found = language_id.predict(net, texts)
    assert [f[0] for f in found] == ["en", "es", "und", "und", "und"]
    again = language_id.predict(net, texts, batch=2)
    assert [f[0] for f in again] == [f[0] for f in found]
    assert [f[1] for f in again] == pytest.approx([f[1] for f in found], abs=1e-5)
    assert language_id.predict(language_id.train([], []), ["abc"]) == [("und", 0.0)]


# --- toxicity


def test_counterfactual_penalty_evens_out_group_mentions():
    clean = [f"we met {p} at the {q} today" for p in ("a teacher", "a friend", "muslim people") for q in ("park", "shop", "lake", "gate")]
    toxic = [f"such muslim {w} idiot {q}" for w in ("scum", "trash") for q in ("today", "there", "here", "now")] + ["what an idiot you are scum"] * 4
    texts, labels = clean + toxic, [0] * len(clean) + [1] * len(toxic)
    plain, fair = (toxicity.fit(texts, labels, balance=b) for b in (0.0, 20.0))

    def gap(model):
        return abs(toxicity.score(model, "we met muslim people") - toxicity.score(model, "we met christian people"))

    assert gap(fair) < 0.5 * gap(plain)
    assert toxicity.score(fair, "you idiot scum") > 0.5 > toxicity.score(fair, "we met a friend at the lake")


def test_swaps():
    assert toxicity.swap("Muslim women smile") == "christian men smile"
    assert toxicity.swap("nobody smiles") is None
    assert len(toxicity.counterfactuals("a gay man")) >= 3


def test_fit_without_two_classes():
    assert toxicity.score(toxicity.fit([], []), "any") == 0.5
    assert toxicity.score(toxicity.fit(["a"], [0]), None) < 0.5


# --- archives


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12) | st.none(), st.text(max_size=20) | st.none(), st.binary(max_size=300)), max_size=12), st.binary(max_size=500))
def test_archive_round_trip(rows, dictionary):
    records = [(i, url, payload, "ab" * 32, len(payload), "response", None) for i, url, payload in rows]
    records.append((7, "u\r\nX: y", b"", "cd" * 32, 999, "revisit", 3))
    out = io.BytesIO()
    assert warc.write_archive(out, iter(records), dictionary) == len(records)
    out.seek(0)
    assert list(warc.read_archive(out)) == [(i, n, d, kind, ref, p) for i, _, p, d, n, kind, ref in records]


def test_archive_opens_with_a_skippable_frame_and_rolls_over():
    records = [(i, None, bytes([i]) * 5000, "00", 5000, "response", None) for i in range(9)]
    out, rest = io.BytesIO(), iter(records)
    first = warc.write_archive(out, rest, b"seed" * 100, most=200)
    assert 0 < first < 9 and len(list(rest)) == 9 - first
    assert out.getvalue()[:4] == b"\x5d\x2a\x4d\x18"


def test_truncated_archives_are_noticed():
    out = io.BytesIO()
    warc.write_archive(out, iter([(1, None, bytes(range(256)) * 40, "00", 10240, "response", None)]), b"")
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(io.BytesIO(out.getvalue()[:-20])))


@pytest.mark.parametrize("kept", [b"payload", b"paylo\0d", b"paylo", b""])
def test_damaged_payloads_are_noticed(kept):
    digest = hashlib.sha256(b"payload").hexdigest()
    record = warc.parse_record(warc.record_bytes(3, None, kept, digest, 7, "response", None))
    if kept == b"payload":
        assert warc.verified(record) == (3, 7, digest, "response", None, kept)
    else:
        with pytest.raises(ValueError, match="page 3"):
            warc.verified(record)
    revisit = warc.parse_record(warc.record_bytes(4, None, b"", digest, 7, "revisit", 3))
    assert warc.verified(revisit) == (4, 7, digest, "revisit", 3, b"")
