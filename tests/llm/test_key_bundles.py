"""Keys of near duplicates are shuffled in bundles, some size classes after the others, and none is lost."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from quillon.llm import near_duplicates
from quillon.llm.signature_tree import Router, packed, unpacked
from quillon.session import Scratch


def _hashes(count=400):
    """Sets of all sizes, half of them near copies of others."""
    rng = np.random.default_rng(11)
    out = []
    for i in range(count):
        n = int(rng.integers(1, 60) if i % 3 else rng.integers(60, 900))
        own = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        if i % 2 and out:
            base = out[-1]
            own = np.concatenate([base[len(base) // 30 :], own[: len(base) // 40]])
        out.append(np.unique(own))
    return [s for s in out if len(s)]


def _expected(sets, percent):
    """(leader, class, size, spare) of the keys that several sets have, one of them near enough in size beside each."""
    router, rows = Router(percent), defaultdict(list)
    for name, s in enumerate(sets):
        h = unpacked(packed(s))
        for key, first, spare in zip(*router.marked_keys(h), strict=True):
            rows[int(key) >> 16].append((len(h), name, int(first), int(spare)))
    out = []
    for held in rows.values():
        held.sort()
        for i, (n, name, first, spare) in enumerate(held):
            near = any(0 <= j < len(held) and 100 * min(n, held[j][0]) >= percent * max(n, held[j][0]) for j in (i - 1, i + 1))
            if near and len({h[1] for h in held}) > 1:
                out.append((min(h[1] for h in held), name, first, spare))
    return sorted(out)


def _table(spark, sets):
    return spark.createDataFrame(
        [(i, len(unpacked(packed(s))), bytearray(packed(s))) for i, s in enumerate(sets)], "class bigint, n bigint, hashes binary").repartition(5)


@pytest.mark.parametrize("bundle, bucket", [(1 << 19, 1 << 17), (500, 100)])
def test_passes_meet_what_one_table_of_keys_would(spark, monkeypatch, bundle, bucket):
    monkeypatch.setattr(near_duplicates, "BUNDLE_KEYS", bundle)
    monkeypatch.setattr(near_duplicates, "BUCKET_KEYS", bucket)
    for percent in (80, 85):
        sets = _hashes()
        table, found = _table(spark, sets), []
        for turn in range(near_duplicates.PASSES):
            rows = near_duplicates._met(table, percent, turn, np.empty(0, np.int64), sum(map(len, sets)), max(map(len, sets))).collect()
            found += [(r["leader"], r["class"], r["size"], r["spare"]) for r in rows]
        assert sorted(found) == _expected(sets, percent)


def test_planes_hold_any_value():
    for values, width in (([0, 5, (1 << 48) - 1], 6), ([0, 1 << 40, (1 << 62) + 7], 8), ([-1, 0, 20_000, 1 << 30], 4), ([], 8)):
        values = np.array(values, np.int64)
        assert near_duplicates._values(near_duplicates._planes(values, width), width).tolist() == values.tolist()


def test_keys_take_few_shuffled_bytes(spark):
    """A key takes 6 bytes itself: with the class and what is known of it, half of what a row of five numbers took."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(800)]
    table, keys, size = _table(spark, sets), 0, 0
    wanted = frozenset(first for first, _ in Router(85).ranges(300))
    bundles = table.select("class", "hashes").coalesce(1).mapInArrow(
        near_duplicates._bundles(85, wanted, 64, np.empty(0, np.int64)), "bucket bigint, " + ", ".join(f"`{c}` binary" for c in near_duplicates.PLANES))
    import zlib

    for r in bundles.collect():
        keys += len(r["key"]) // 6
        size += len(zlib.compress(b"".join(bytes(r[c]) for c in near_duplicates.PLANES), 1))
    assert keys == sum(len(Router(85).keys(s)) for s in sets)
    assert size < 12 * keys


def test_hot_keys_stay_out_of_bundles(spark):
    sets = _hashes(60)
    table = _table(spark, sets)
    keys = np.sort(np.unique(np.concatenate([Router(85).keys(unpacked(packed(s))) >> np.uint64(16) for s in sets])).astype(np.int64))
    for turn in range(near_duplicates.PASSES):
        assert near_duplicates._met(table, 85, turn, keys, sum(map(len, sets)), max(map(len, sets))).count() == 0


def test_classes_have_numbers(spark):
    """A short number for each class, in place of a hash, whose bytes every key would carry."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(50)]
    seen = []
    plain = near_duplicates._blocks

    def blocks(sets, *rest):
        seen.extend(r["class"] & ((1 << 33) - 1) for r in sets.select("class").collect())
        return plain(sets, *rest)

    near_duplicates._blocks = blocks
    try:
        found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), Scratch(spark))
        assert all(r["doc_id"] == r["component_id"] for r in found.collect())
    finally:
        near_duplicates._blocks = plain
    assert len(seen) == 50 and max(seen) < 50


def test_hot_keys_are_a_few_rows_a_class(spark, monkeypatch):
    """Near copies share hundreds of hot keys, which few classes lead: counted in the task, not written out a row a key."""
    monkeypatch.setattr(near_duplicates, "SAMPLED", 1)
    rng = np.random.default_rng(7)
    text = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([text[:i], text[i + 1 :]])) for i in range(40)] + _hashes(30)
    per_key, kept = _blocks_by_key(sets, 85), []

    class Counted(Scratch):
        def keep(self, df):
            found = super().keep(df)
            if {"leader", "class", "size", "spare", "keys", "common"} == set(df.columns):
                kept.append((found.count(), found.selectExpr("sum(keys)").first()[0]))
            return found

    found = near_duplicates._blocks(_table(spark, sets), Counted(spark), 85)
    assert {(r["leader"], r["class"]): r["shared"] for r in found.collect() if r["leader"] != r["class"]} == per_key
    rows, keys = kept[-1]
    assert keys > 40 * 30 and 10 * rows < keys, kept


def _blocks_by_key(sets, percent):
    """{(leader, class): keys} as a row for every hot key gives them."""
    router, rows = Router(percent), []
    for name, s in enumerate(sets):
        h = unpacked(packed(s))
        rows += [(int(key) >> 16, name, int(first), int(spare), len(h)) for key, first, spare in zip(*router.marked_keys(h), strict=True)]
    held = defaultdict(list)
    for r in rows:
        held[r[0]].append(r)
    met = []
    for key, group in held.items():
        hot = len(group) >= near_duplicates.HOT_IN_SAMPLE
        group.sort(key=lambda r: r[4])
        leader = min(r[1] for r in group)
        for i, r in enumerate(group):
            near = any(0 <= j < len(group) and 100 * min(r[4], group[j][4]) >= percent * max(r[4], group[j][4]) for j in (i - 1, i + 1))
            if hot or near and len({g[1] for g in group}) > 1:
                met.append((leader, *r[1:4], hot or len(group) > near_duplicates.COMMON))
    common, out = defaultdict(int), defaultdict(int)
    for _, name, size, _, many in met:
        common[name, size] += many
    for leader, name, size, spare, many in met:
        if leader != name and not (many and common[name, size] <= spare):
            out[leader, name] += 1
    return dict(out)
