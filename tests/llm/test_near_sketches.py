"""Sketches rule out sets before these are sent to a block, lose no link, and keys are made a few rows at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quillon.llm import near_duplicates
from quillon.llm.signature_tree import linked, packed, promising, sketch, unpacked


def _sets():
    """Pairs at and around the limit, of sizes on both sides of a power of two, and sets that share a third of their elements."""
    rng = np.random.default_rng(3)
    out = []

    def fresh(n):
        return rng.integers(0, 1 << 63, n, dtype=np.uint64)

    for n in (1, 6, 7, 12, 30, 63, 65, 100, 127, 128, 129, 250, 256, 260, 1000, 1025):
        one = fresh(n)
        for drop in (0, 1, n * 7 // 100, n * 8 // 100, n * 15 // 100):
            out.append(np.unique(np.concatenate([one[drop:], fresh(drop // 2)])))
    passage = fresh(40)
    out += [np.unique(np.concatenate([passage, fresh(80)])) for _ in range(60)]
    return [s for s in out if len(s)]


def test_sketches_lose_no_link():
    for percent in (50, 80, 85, 95):
        sets = _sets()
        label = np.arange(len(sets))
        found = promising([sketch(s) for s in sets], np.array([len(s) for s in sets]), percent, label)
        short = [unpacked(packed(s)) for s in sets]
        must = np.array([any(i != j and linked(a, b, percent) for j, b in enumerate(short)) for i, a in enumerate(short)])
        assert not (must & ~found).any()
        if percent >= 80:
            assert found[-60:].sum() <= 6  # they share a passage only
    assert not promising([sketch(s) for s in sets], np.array([len(s) for s in sets]), 50, np.zeros(len(sets), int)).any()


def test_keys_are_made_in_slices():
    sets = [np.sort(np.random.default_rng(i).integers(0, 1 << 63, 300, dtype=np.uint64)) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array([packed(s) for s in sets], pa.binary())], ["class", "hashes"])
    out = list(near_duplicates._keys(80)(iter([batch])))
    assert len(out) >= 4 and max(b.num_rows for b in out) <= 256 * 400
    assert sorted({c for b in out for c in b.column("class").to_pylist()}) == list(range(1000))


def test_a_shared_passage_sends_no_sets(spark, tmp_path, monkeypatch):
    from quillon.session import Scratch

    kept = []

    class Counted(Scratch):
        def keep(self, df):
            found = super().keep(df)
            if "task" not in df.columns and {"leader", "class", "label", "chunk", "i", "j"} == set(df.columns):
                kept.append(found.count())
            return found

    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"u{w}" for w in rng.integers(0, 10**6, 60)) + " " + passage) for i in range(30)]
    rows.append((100, rows[0][1] + " more"))
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), Counted(spark), shingle=5, percent=80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {**{i: i for i in range(30)}, 100: 0}
    assert 5 * kept[-1] <= kept[0], kept  # the near copy and its text, in the blocks of a few keys
