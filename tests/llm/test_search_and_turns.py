"""Nearest neighbours, prefix trie and conversation repair against brute force, on small hard tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillon.llm import conversation_repair, posting_graph, posting_lists, prefix_trie, repair_lattice
from quillon.llm.turns import digests, in_order
from quillon.session import Scratch


@pytest.fixture
def scratch(spark):
    found = Scratch(spark)
    yield found
    found.clear()


# --- nearest neighbours


def exact_neighbours(rows, every=20, nearest=20):
    """(query, rank) -> (id, score) over distinct (id, vector) rows."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = Counter()
    for i, v in good:
        if i % every:
            continue
        scores = []
        for j, w in good:
            if j != i and len(w) == len(v):
                s = 0.0
                for a, b in zip(v, w, strict=True):
                    s += a * b
                scores.append((-s, j))
        for rank, (s, j) in enumerate(sorted(scores)[:nearest], 1):
            out[(i, rank, j, -s)] += 1
    return out


def vectors(n, width=6, seed=1):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in row] for row in rng.normal(size=(n, width))]


def found_neighbours(frame, scratch, **options):
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in posting_lists.search(frame, scratch, **options).collect())


def test_neighbours_of_hard_rows(spark, scratch):
    rows = list(enumerate(vectors(45)))
    rows += [(100 + i, rows[3][1]) for i in range(60)]  # copies of one vector, queries among them
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (220, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (240, [float("inf")] * 6)]
    rows += [(None, rows[0][1]), (260, [1.0, 2.0]), (261, [3.0, -1.0]), (280, [5.0]), rows[20], rows[20], (20, rows[7][1])]
    frame = spark.createDataFrame([(i, v, "x", 1.0, 7) for i, v in rows], "vec_id bigint, embedding array<float>, key string, score double, rank int").repartition(3)
    # every list is searched, so that the result is exact
    assert found_neighbours(frame, scratch, target=1.0, list_rows=1000) == exact_neighbours(rows)
    assert found_neighbours(frame, scratch, target=1.0, list_rows=10, block_rows=7, bundle_lists=2).keys() >= {k for k in exact_neighbours(rows) if k[0] in (260, 280)}
    assert posting_lists.search(frame.where("false"), scratch).count() == 0
    assert posting_lists.search(frame.where("vec_id in (200, 202, 240)"), scratch).count() == 0
    assert posting_lists.search(frame.where("vec_id = 0"), scratch).count() == 0


def test_neighbours_are_scored_in_double_precision(spark, scratch):
    rows = [(i, [1.0, i * 1e-12, 0.1]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found_neighbours(frame, scratch) == exact_neighbours(rows)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_recall(spark, scratch, spread):
    """Without structure most lists are searched; with vectors of very different lengths too."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(4000, 16)) * np.exp(spread * rng.normal(size=(4000, 1)))
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = posting_lists.search(frame, scratch, list_rows=64).toPandas()
    assert len(found) == 200 * 20 and (found.groupby("query_id")["vec_id"].nunique() == 20).all()
    x = np.array([v for _, v in rows])
    scores = x[::20] @ x.T
    scores[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    true = {20 * q: set(np.argsort(-scores[q])[:20].tolist()) for q in range(200)}
    hits = sum(len(true[q] & set(g["vec_id"])) for q, g in found.groupby("query_id"))
    assert hits / 4000 >= 0.9


def test_blocks_lose_nothing(spark, scratch):
    rows = list(enumerate(vectors(600, 5, 4)))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    whole = found_neighbours(frame, scratch, list_rows=20)
    assert found_neighbours(frame, scratch, list_rows=20, block_rows=9, bundle_lists=3) == whole
    assert len({(q, i) for q, _, i, _ in whole} & {(q, i) for q, _, i, _ in exact_neighbours(rows)}) >= 0.9 * 600


def test_graph_finds_the_nearest_centroids():
    points = np.random.default_rng(0).normal(size=(3000, 8)).astype(np.float32)
    graph = posting_graph.CentroidGraph(posting_graph.balanced_centroids(points, 150))
    far = ((points[:300, None, :] - graph.centroids[None]) ** 2).sum(axis=2)
    ids, _ = graph.nearest(points[:300])
    assert (ids[:, 0] == far.argmin(axis=1)).mean() > 0.97
    sizes = np.bincount(((points[:, None, :] - graph.centroids[None]) ** 2).sum(axis=2).argmin(axis=1), minlength=len(graph))
    assert sizes.max() < 6 * sizes.mean()
    chosen = graph.within(points[:300], 1.4, np.full(len(graph), 20), 100)
    assert (chosen.sum(axis=1) >= 5).all()
    inside = far <= 1.4**2 * far.min(axis=1, keepdims=True)
    assert (chosen & inside).sum() >= 0.98 * inside.sum()
    assert graph.within(points[:5], 1.0, np.ones(len(graph)), 10**6).all()


# --- conversations


def conversations():
    """Rows with nulls, ties, repeated rows, common starts, a very long conversation and columns that clash."""
    rng = random.Random(6)
    openings = [("system", "Be kind."), ("user", "Hello there."), ("assistant", "Hi!"), ("user", "What now?")]
    rows = []
    for c in range(90):
        turns = [*openings[: rng.randint(0, 4)]]
        for _ in range(rng.randint(0, 7)):
            turns.append((rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(
                ["yes.", "no", "maybe!\n ", "a long answer with words?", "", "  \t", None, "x" * 40 + ".", "é ü。", f"own {rng.random()}."])))
        start = rng.choice([0, 0, 1, -3])
        rows += [(c, None if rng.random() < 0.05 else start + i * rng.choice([1, 1, 2]), r, t) for i, (r, t) in enumerate(turns)]
    rows += [(c, i, r, t) for c in range(100, 160) for i, (r, t) in enumerate(openings)]  # copies
    rows += [(7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "assistant", "tie"), (None, 0, "user", "no conversation"), (-21, 0, "user", "negative?")]
    rows += [(200, i, ("user", "assistant")[i % 2] if rng.random() < 0.8 else rng.choice(["system", "tool"]), rng.choice(["fine.", f"{i}?", "cut", ""])) for i in range(700)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string, t string, k int, depth int, cost string, `__group` int"


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in conversations()], SCHEMA).repartition(5)


def md5(text):
    return hashlib.md5(text.encode()).digest()


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", md5(text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    talks = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))
        talks[c] = (*own.get(base, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(talks.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        w = len(p[-1][1].split()) if p else 0
        saved[p] = (len(members[p]) - 1) * w + sum(saved[x] for x in children[p])
    return Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if len(talks[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


@pytest.mark.parametrize(("block", "stretch"), [(4, 1024), (2, 16), (1, 50), (64, 1)])
def test_prefix_trie(talks, scratch, monkeypatch, block, stretch):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    found = prefix_trie.prefix_trie(talks, scratch, block)
    assert Counter(tuple(r) for r in found.collect()) == brute_trie(conversations())


def test_prefix_trie_of_few_rows(spark, talks, scratch):
    assert prefix_trie.prefix_trie(talks.where("false"), scratch).count() == 0
    assert prefix_trie.prefix_trie(talks.where("conv_id IS NULL"), scratch).count() == 0
    # 22 loses its only turn and has none to borrow: the root is all there is
    assert zlib.crc32(b"22") % 4 > 0
    rows = [(22, 0, "user", "a b")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert [tuple(r) for r in prefix_trie.prefix_trie(frame, scratch).collect()] == [(22, 0, None, 1, 0, 1, 0, hashlib.sha256(b"22").hexdigest())]


def test_common_conversation_is_spread(spark, scratch):
    """A conversation of a third of the rows, and copies of another: no task of the ordering holds them all."""
    rows = [(1, i, "user", f"{i}") for i in range(3000)] + [(c, i, "user", "same") for c in range(1000, 4000) for i in range(2)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    placed = in_order(frame, "conv_id", [frame["turn"].asc_nulls_first()], ["conv_id", "turn"], scratch)
    assert all(r["t"] == r["turn"] for r in placed.collect())
    found = Counter(tuple(r) for r in prefix_trie.prefix_trie(frame, scratch).collect())
    assert found == brute_trie(rows)


def test_digests_of_a_large_group(spark, scratch):
    rows = [(k, i, str(i)) for k, n in ((None, 5), (1, 5000), (2, 1)) for i in range(n)]
    frame = spark.createDataFrame(rows, "k int, i int, text string").repartition(6)
    found = {r["k"]: r["d"] for r in digests(frame, ["k"], ["i"], "text", ",", "d", scratch).collect()}
    assert found == {k: hashlib.sha256(",".join(str(i) for i in range(n)).encode()).hexdigest() for k, n in ((None, 5), (1, 5000), (2, 1))}


def cheapest(rows):
    """(cost, audit, lines) by trying every edit, state by state; rows are (role, text, must go, truncated)."""
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    best = {0: (0, "", ())}

    def offer(table, state, way):
        if state not in table or way < table[state]:
            table[state] = way

    def inserted(states):
        out = dict(states)
        for q, (cost, audit, lines) in states.items():
            for n in (1, 2, 3):
                q, cost, audit, lines = follow[q], cost + 5, audit + "I", (*lines, name[follow[q]] + ":")
                offer(out, q, (cost, audit, lines))
        return out

    for role, text, gone, cut in rows:
        new = {}
        # one way for every start and number of insertions, as ties are broken by whole strings
        for q0, way in best.items():
            for n in (0, 1, 2):
                q, (cost, audit, lines) = q0, way
                for _ in range(n):
                    q, cost, audit, lines = follow[q], cost + 5, audit + "I", (*lines, name[follow[q]] + ":")
                offer(new, q, (cost + 2, audit + "D", lines))
                if gone:
                    continue
                to, extra = follow[q], 5 * cut
                if role[:1] == "s" and q == 0:
                    offer(new, 1, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                if role[:1] == name[to][:1]:
                    offer(new, to, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                offer(new, to, (cost + 1 + extra, audit + "R", (*lines, f"{name[to]}:{text}")))
        best = new
    last = inserted(best)
    return min(last[q] for q in (0, 3) if q in last)


def brute_repair(rows):
    hurt = defaultdict(list)
    for c, turn, role, text in rows:
        if c is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        hurt[c] += [(turn is not None, turn or 0, role, md5(text), text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = Counter()
    for c, found in hurt.items():
        found.sort()
        turns = [x[1] for x in found if x[0]]
        seen, marked, counts = set(), [], Counter()
        for _, _, role, _, text in found:
            kind = "blank" if not text.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "ok" if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[kind] += 1
            marked.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        firsts = [role[:1] for _, _, role, _, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest(marked)
        out[(c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("segment", [conversation_repair.SEGMENT, 3, 1])
def test_conversation_repair(talks, scratch, segment):
    found = conversation_repair.damage_and_repair(talks, scratch, segment)
    assert Counter(tuple(r) for r in found.collect()) == brute_repair(conversations())


def test_repair_of_nothing(spark, talks, scratch):
    assert conversation_repair.damage_and_repair(talks.where("false"), scratch).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(5, turn, "user", "gone.")], "conv_id bigint, turn bigint, role string, text string")
    assert [tuple(r) for r in conversation_repair.damage_and_repair(frame, scratch).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_auction_distances_equal_all_paths():
    rng = random.Random(2)
    for _ in range(300):
        codes = "".join(rng.choice("-suaxSUAX") for _ in range(rng.randint(1, 40)))
        rows = [({"-": "user", "s": "system", "u": "user", "a": "assistant", "x": "tool"}[c.lower()], "t", c == "-", c.isupper()) for c in codes]
        lattice = repair_lattice.Lattice(codes, repair_lattice.END)
        audit, state = lattice.trace(0)
        cost, best, lines = cheapest(rows)
        assert (lattice.distance(0), audit + repair_lattice.TAIL[state]) == (cost, best)
        left = list(repair_lattice.replay(best, [r[0][:1] for r in rows]))
        assert [f"{role or rows[i][0]}:{'' if i is None else 't'}" for i, role in left] == list(lines)
        cut = rng.randint(1, len(codes))
        if cut < len(codes):
            a, b = repair_lattice.between(codes[:cut]), repair_lattice.between(codes[cut:])
            assert cost == min(a[q] + b[4 * q + r] + repair_lattice.END[r] for q in range(4) for r in range(4))
