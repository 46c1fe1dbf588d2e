"""The trie of common conversation prefixes, by digests of blocks of turns first and of turns where blocks diverge."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.line_quality import words
from quillon.llm.turns import digests, in_order, small
from quillon.session import Scratch

BLOCK = 4
STRETCH = 1024
FAMILY = 20
LANES = ("1", "2", "3", "4")
LOW = (1 << 32) - 1


def rebuilt_turns(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id of all conversations; conv_id, depth, role, digest, w of their turns after rebuilding).

    Conversation c starts with the first crc32(c) % 4 turns of conversation c - c % 20, followed by its own
    turns but as many of the first ones. Turns are in order of turn (NULL first), then of role, then of the MD5 of the text.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        F.size(words(text)).cast("bigint").alias("w"))
    own = scratch.keep(in_order(parts, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], ["conv_id", "role", "digest", "w"], scratch))
    counts = scratch.keep(own.groupBy("conv_id").agg(F.count("*").alias("n")))
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    asked = counts.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    heads = scratch.keep(asked.join(bases, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")))
    start = own.where("t < 3").withColumnRenamed("conv_id", "base").join(small(heads), "base").where("t < h")
    rest = own.join(small(heads), "conv_id").where("t >= h")
    turns = start.select("conv_id", (F.col("t") + 1).alias("depth"), "role", "digest", "w").unionByName(
        rest.select("conv_id", (F.col("taken") + F.col("t") - F.col("h") + 1).alias("depth"), "role", "digest", "w"))
    return counts.select("conv_id"), turns


def _lanes() -> list[Column]:
    """Two 64-bit hashes of a turn and its depth as four numbers of 32 bits, whose sums over a prefix name the prefix."""
    a, b = F.xxhash64("digest", "role", "depth"), F.xxhash64(F.lit(7), "role", "depth", "digest")
    return [(x.bitwiseAND(F.lit(LOW)) if low else F.shiftrightunsigned(x, 32)).cast("bigint") for x in (a, b) for low in (True, False)]


def blocked(turns: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """One row per conversation and block of ``block`` turns.

    conv_id, k, turns (list of lanes and words), words and lanes before it (``before``, ``p1`` to ``p4``), lanes
    up to its end (``x1`` to ``x4``), and the conversation's length and words (``len``, ``total``). A long conversation's
    sums are made in stretches of 1024 blocks, then over stretches.
    """
    placed = turns.withColumn("k", F.floor((F.col("depth") - 1) / block).cast("bigint")).select(
        "conv_id", "k", "depth", "w", *[x.alias(f"l{i}") for i, x in zip(LANES, _lanes(), strict=True)])
    element = F.struct("depth", *[f"l{i}" for i in LANES], "w")
    sums = {"w": F.sum("w"), "n": F.count("*"), **{f"l{i}": F.sum(f"l{i}") for i in LANES}}
    blocks = scratch.keep(placed.groupBy("conv_id", "k").agg(F.sort_array(F.collect_list(element)).alias("turns"), *[v.alias(c) for c, v in sums.items()]))
    blocks = blocks.withColumn("s", F.floor(F.col("k") / STRETCH).cast("bigint"))
    lengthy = blocks.where("s > 0").select("conv_id").distinct()
    parts = blocks.join(lengthy, "conv_id", "left_semi").groupBy("conv_id", "s").agg(*[F.sum(c).alias(c) for c in sums])
    past, whole = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id")
    stretches = scratch.keep(parts.select(
        "conv_id", "s", *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"past_{c}") for c in sums],
        F.sum("n").over(whole).alias("len"), F.sum("w").over(whole).alias("total")))
    here = Window.partitionBy("conv_id", "s")
    ahead = here.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    inner = blocks.select(
        "conv_id", "k", "s", "turns", *[f"l{i}" for i in LANES], *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"in_{c}") for c in sums],
        F.sum("n").over(here).alias("own_len"), F.sum("w").over(here).alias("own_total"))
    joined = inner.join(small(stretches), ["conv_id", "s"], "left")
    before = {c: F.col(f"in_{c}") + F.coalesce(f"past_{c}", F.lit(0)) for c in sums}
    return scratch.keep(joined.select(
        "conv_id", "k", "turns", before["w"].alias("before"), *[before[f"l{i}"].alias(f"p{i}") for i in LANES],
        *[(before[f"l{i}"] + F.col(f"l{i}")).alias(f"x{i}") for i in LANES],
        F.coalesce("len", "own_len").alias("len"), F.coalesce("total", "own_total").alias("total")))


def nodes_of(blocks: DataFrame, values: dict[str, Column], merge: dict[str, Column], block: int, scratch: Scratch) -> DataFrame:
    """Nodes below the root: depth, lanes (``c1`` to ``c4``) and the parent's (``q1`` to ``q4``), w, before, ends, and ``values``.

    Members are grouped by whole blocks. Where all members of a block's prefix go on with the same block, its turns
    are nodes with the same values. Where siblings diverge, their turns are grouped by digest; only there are turns
    looked at, once per different block. ``merge`` says how values of blocks become values of a node.
    """
    names, parent = [f"x{i}" for i in LANES], ["k", *[f"p{i}" for i in LANES]]
    end = (F.col("len") == F.col("k") * block + F.size("turns")).cast("bigint")
    children = scratch.keep(blocks.groupBy(*parent, *names, F.size("turns").alias("size")).agg(
        F.first("turns").alias("turns"), F.first("before").alias("before"), F.sum(end).alias("ends"), *[v.alias(c) for c, v in values.items()]))
    parting = scratch.keep(children.groupBy(*parent).agg(F.count("*").alias("siblings")).where("siblings > 1").select(*parent, F.lit(True).alias("parted")))
    marked = children.join(small(parting), parent, "left")

    def up_to(field: str, j: Column, start: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), j), start, lambda s, x: s + x[field])

    one = marked.select("*", F.posexplode("turns").alias("j", "turn"))
    steps = one.select(
        "parted", F.col("turn.depth").alias("depth"), *[up_to(f"l{i}", F.col("j") + 1, F.col(f"p{i}")).alias(f"c{i}") for i in LANES],
        *[up_to(f"l{i}", F.col("j"), F.col(f"p{i}")).alias(f"q{i}") for i in LANES], F.col("turn.w").alias("w"),
        up_to("w", F.col("j"), F.col("before")).alias("before"), F.when(F.col("j") + 1 == F.col("size"), F.col("ends")).otherwise(0).alias("ends"), *values)
    keys = ["depth", *[f"c{i}" for i in LANES]]
    same = ["w", "before", *[f"q{i}" for i in LANES]]
    apart = steps.where("parted").groupBy(*keys).agg(*[F.first(c).alias(c) for c in same], F.sum("ends").alias("ends"), *[v.alias(c) for c, v in merge.items()])
    columns = [*keys, *same, "ends", *values]
    return scratch.keep(steps.where("parted IS NULL").select(*columns).unionByName(apart.select(*columns)))


def prefix_trie(rows: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Nodes are the different sequences of first turns (role and text; NULL is empty) of the rebuilt conversations
    (``rebuilt_turns``), from the root, of which all conversations are members.

    1. A turn's lanes are hashes of its digest and depth; their sums over a prefix name it (128 bits).
    2. Members are grouped by blocks of ``block`` turns, and by turns where blocks diverge (``nodes_of``).
    3. A node belongs to its smallest member. Sums over a subtree are sums over its members: a member counts the
       words of all its turns from that depth on, less those of the nodes that belong to it, and the leaf that
       belongs to it. So no tree is walked, however deep.
    4. Digests of member lists are made from sorted pieces, as a stream.

    Rows without conv_id are no conversation. Rows that repeat others are turns of their own; ties of turn
    are ordered by role and by the MD5 of the text. An empty table gives no node, not even the root. Other columns are not looked at.
    """
    conversations, turns = rebuilt_turns(rows, scratch)
    blocks = blocked(turns, block, scratch)
    first = nodes_of(
        blocks, {"n": F.count("*"), "owner": F.min("conv_id")}, {"n": F.sum("n"), "owner": F.min("owner")}, block, scratch)
    owned = scratch.keep(first.groupBy(F.col("owner").alias("conv_id")).agg(
        F.sum("w").alias("own"), F.min("depth").alias("since"), F.max((F.col("ends") == F.col("n")).cast("bigint")).alias("leaf")))
    told = blocks.join(small(owned), "conv_id", "left")
    owner = F.min(F.struct("conv_id", "total", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("since", F.lit(0)).alias("since")))
    sums = {"n": F.count("*"), "all": F.sum("total"), "owned": F.sum(F.coalesce("own", F.lit(0))), "leaves": F.sum(F.coalesce("leaf", F.lit(0)))}
    nodes = nodes_of(told, {**sums, "owner": owner}, {**{c: F.sum(c) for c in sums}, "owner": F.min("owner")}, block, scratch)
    lengths = told.where("k = 0").select("conv_id", "total", "own", "leaf")
    everyone = conversations.join(lengths, "conv_id", "left")
    none = F.lit(0).cast("bigint")
    root = everyone.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("total"), none).alias("all"), F.coalesce(F.sum("own"), none).alias("owned"),
        F.coalesce(F.sum("leaf"), none).alias("leaves"), F.min("conv_id").alias("id"), F.sum(F.col("total").isNull().cast("bigint")).alias("ends"))
    keys = ["depth", *[f"c{i}" for i in LANES]]
    tops = root.where("n > 0").select(
        none.alias("depth"), *[none.alias(f"{x}{i}") for x in "cq" for i in LANES], none.alias("w"), none.alias("before"), "ends", "n", "all", "owned", "leaves",
        F.struct(F.col("id").alias("conv_id"), none.alias("total"), none.alias("own"), none.alias("since")).alias("owner"))
    every = scratch.keep(nodes.unionByName(tops))
    up = [(F.col("depth") - 1).alias("depth"), *[F.col(f"q{i}").alias(f"c{i}") for i in LANES]]
    below = every.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    above = every.select(*[F.col(c).alias(f"up_{c}") for c in keys], F.col("owner.conv_id").alias("above"))
    # only a conversation's first own node hangs on another's
    hung = every.where("depth > 1 AND depth = owner.since").select(*keys, *[c.alias(f"u{i}") for i, c in enumerate(up)]).join(
        above, [F.col(f"u{i}") == F.col(f"up_{c}") for i, c in enumerate(keys)]).select(*keys, "above")
    ids = F.col("conv_id").cast("string").alias("text")
    last = blocks.where(F.col("len") == F.col("k") * block + F.size("turns")).select(F.col("len").alias("depth"), *[F.col(f"x{i}").alias(f"c{i}") for i in LANES], "conv_id", ids)
    bare = everyone.where("total IS NULL").select(none.alias("depth"), *[none.alias(f"c{i}") for i in LANES], "conv_id", ids)
    ends = digests(last.unionByName(bare), keys, ["conv_id"], "text", ",", "ends_sha256", scratch)
    joined = every.join(below, keys, "left").join(scratch.keep(hung), keys, "left").join(scratch.keep(ends), keys, "left")
    own = F.col("owner.conv_id")
    least = every.where("depth = 0").select(F.col("owner.conv_id").alias("least"))
    top = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == 1, F.col("least")).when(F.col("depth") == F.col("owner.since"), F.col("above")).otherwise(own)
    mine = F.when(F.col("depth") == 0, 0).otherwise(F.col("owner.total") - F.col("before") - F.col("owner.own"))
    distinct = F.col("owned") + mine
    return joined.join(F.broadcast(least)).select(
        own.alias("conv_id"), "depth", top.cast("bigint").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("n_children", none).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
        (F.col("all") - F.col("n") * F.col("before") - distinct).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT)"""

SQL = (
    """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS t
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, n, """
    + CRC.format("conv_id::VARCHAR")
    + r""" % 4 AS h FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
turns AS (
  SELECT c.conv_id, t.t + 1 AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.t < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.t - c.h + 1 AS depth, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.t >= c.h LEFT JOIN c b ON b.conv_id = c.base),
lists AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY depth) AS l FROM turns GROUP BY conv_id),
whole AS (SELECT c.conv_id, coalesce(l, []) AS l, len(coalesce(l, [])) AS n FROM c LEFT JOIN lists USING (conv_id)),
members AS (SELECT conv_id, n, depth, l[1:depth] AS prefix FROM (SELECT conv_id, l, n, unnest(range(0, n + 1)) AS depth FROM whole)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS w,
    max(n) = depth AS childless
  FROM members GROUP BY depth, prefix),
children AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
under AS (
  SELECT m.depth, m.prefix, sum((v.n_convs - 1) * v.w) AS saved, count(*) FILTER (v.childless) AS leaves
  FROM members m JOIN nodes v ON v.conv_id = m.conv_id AND v.depth >= m.depth GROUP BY m.depth, m.prefix)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
  under.leaves::BIGINT AS n_leaves, under.saved::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN under USING (depth, prefix) LEFT JOIN children USING (depth, prefix)
LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.prefix = a.prefix[1:a.depth - 1]
""")
