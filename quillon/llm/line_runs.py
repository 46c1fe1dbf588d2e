"""Line dedup: repeated runs of lines found by prefix doubling over line-ID sequences. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.line_quality import WHITE, count_normal_words, normal_lines
from quillon.session import Scratch

LEAST_WORDS = 50
BROADCAST_LINES = 1_000_000


def text_of(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def document_key(id_column: str, text_column: str) -> Column:
    """Digest of a document's id and text."""
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("\0"))
    return F.unhex(F.md5(F.concat(name, F.lit("\1"), text_of(text_column))))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def line_positions(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(key, id, p, line, w, c): each line with a word, its number p among such lines, words, and words up to its end."""
    parts = docs.select(
        document_key(id_column, text_column).alias("key"), F.col(f"`{id_column}`").alias("id"), F.posexplode(normal_lines(text_of(text_column))).alias("p", "text"))
    rows = parts.select("key", "id", "p", F.unhex(F.md5("text")).alias("line"), count_normal_words(F.col("text")).alias("w"))
    # told by the documents' keys alone: lines are shuffled twice only where an id and text come again
    again = docs.groupBy(document_key(id_column, text_column).alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    once = rows if again.isEmpty() else rows.distinct()
    sofar = Window.partitionBy("key").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    return once.withColumn("c", F.sum("w").over(sofar))


def _ranked(classes: DataFrame, group: list[str], base: Column, second: list[str]) -> DataFrame:
    """``classes`` (group and second columns, n members) with ``o``: the base plus the members that sort before in the group.

    This is the rank of the class in the suffix array, up to the suffixes that are unique and can't matter.
    Groups are summed in 256 ranges of ``b``, so a prefix that a third of all suffixes share is no single task.
    """
    inside = Window.partitionBy(*group, "b").orderBy(*second).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    parts = classes.groupBy(*group, "b").agg(F.sum("n").alias("m")).withColumn("m", F.coalesce(F.sum("m").over(before), F.lit(0)))
    summed = classes.withColumn("k", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return summed.join(parts, [*group, "b"]).withColumn("o", base + F.col("m") + F.col("k")).drop("m", "k", "b")


def first_ranks(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Suffixes by their first line: (key, id, p, w, c, h, o) of all positions whose line occurs at least twice.

    Lines sort by hash; (h, o) is the rank.
    """
    classes = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").withColumn("h", F.xxhash64("line"))
    before = Window.partitionBy("h").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)  # mostly one line a hash
    ranked = scratch.keep(classes.select("line", "h", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o")))
    return scratch.keep(lines.join(ranked, "line").select("key", "id", "p", "w", "c", "h", "o"))


def doubled_ranks(ranks: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """One step of prefix doubling: from ranks by ``length`` lines to ranks by twice as many.

    A suffix's new rank orders the pair (own rank, rank of the suffix ``length`` lines on). Suffixes whose pair is
    unique share no such prefix with any other and drop out.
    """
    ahead = ranks.select("key", (F.col("p") - length).alias("p"), F.col("h").alias("h2"), F.col("o").alias("o2"))
    pairs = scratch.keep(ranks.join(ahead, ["key", "p"]))
    names = ["h", "o", "h2", "o2"]
    # read twice
    classes = scratch.keep(pairs.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").withColumn("b", F.shiftright("h2", 56)))
    renamed = classes.withColumnRenamed("o", "from")
    ranked = _ranked(renamed, ["h", "from"], F.col("from"), ["h2", "o2"])
    fresh = scratch.keep(ranked.select("h", F.col("from").alias("o"), "h2", "o2", F.col("o").alias("rank")))
    return scratch.keep(pairs.join(fresh, names).select("key", "id", "p", "w", "c", "h", F.col("rank").alias("o")))


def windows(ranks: DataFrame, least_words: int) -> DataFrame:
    """(key, p, size): runs of repeated lines with ``least_words`` words, but fewer without their first or without their last line.

    Every run with ``least_words`` words is a union of such runs, so these are the only depths at which
    longest-common-prefix intervals have to be looked at. They have at most ``least_words`` lines.
    """
    place = F.struct("p", "c")
    after = Window.partitionBy("key").orderBy("c").rangeBetween(0, least_words - 1)  # few words after the first line
    before = Window.partitionBy("key").orderBy("s").rangeBetween(0, least_words - 1)  # few words before the last line
    ends = ranks.withColumn("s", F.col("c") - F.col("w")).select(
        "key", "p", "s", F.collect_list(place).over(after).alias("right"), F.max(place).over(before).alias("left"))
    both = F.array_append("right", F.col("left"))
    fits = F.filter(both, lambda e: e["c"] - F.col("s") >= least_words)
    return ends.select("key", "p", F.explode(F.array_distinct(F.transform(fits, lambda e: e["p"] - F.col("p") + 1))).alias("size"))


def later_copies(runs: DataFrame, ranks: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(key, p, size) of the ``runs`` (of ``length`` to 2 * ``length`` - 1 lines) of which an earlier copy exists.

    The suffixes that share ``size`` lines (an interval of the suffix array with that common prefix) are those
    equal in two ranks by ``length`` lines, at the run's start and ending at its end. The first of an interval is
    the one of the smallest document id and place.
    """
    starts = ranks.select("key", "id", "p", "h", "o")
    ends = ranks.select("key", F.col("p").alias("q"), F.col("h").alias("h2"), F.col("o").alias("o2"))
    placed = scratch.keep(runs.join(starts, ["key", "p"]).withColumn("q", F.col("p") + F.col("size") - length).join(ends, ["key", "q"]))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "p")
    names = ["size", "h", "o", "h2", "o2"]
    firsts = scratch.keep(placed.groupBy(*names).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"))
    later = (F.col("first.key") != F.col("key")) | (F.col("first.p") != F.col("p"))
    return placed.join(firsts, names).where(later).select("key", "p", "size")


def repeated_lines(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, lines): per document with any, the numbers (among its lines with a word) of the lines to delete."""
    lines = scratch.keep(line_positions(docs, id_column, text_column))
    ranks, length = first_ranks(lines, scratch), 1
    runs = scratch.keep(windows(ranks, least_words))
    found = None
    while True:
        here = later_copies(runs.where((F.col("size") >= length) & (F.col("size") < 2 * length)), ranks, length, scratch)
        found = here if found is None else found.unionByName(here)
        longer = runs.where(F.col("size") >= 2 * length)
        if longer.isEmpty():
            break
        ranks, length = doubled_ranks(ranks, length, scratch), 2 * length
        if ranks.isEmpty():
            break
    covered = found.select("key", F.explode(F.sequence(F.col("p"), F.col("p") + F.col("size") - 1)).alias("line")).distinct()
    return scratch.keep(covered.groupBy("key").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def remove_repeated_runs(
    docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` with ``__n_lines``, ``__removed`` (numbers of the deleted lines, ascending from 0) and ``__text``, what is left.

    Lines are compared in lower case with white space collapsed; lines without a word are neither
    compared nor deleted. A run of consecutive lines with at least ``least_words`` words is deleted where the same
    run stands earlier: in a document of smaller id (NULL: last), or earlier in the document itself. The first
    copy stays. A run lies within one document.

    Rows that repeat both id and text are one document and get equal results. NULL texts have no lines and stay
    NULL; the empty text is one empty line. An empty table gives an empty result. Columns of the three
    added names are replaced.
    """
    safe = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows, text_name = docs.toDF(*safe.values()), safe[text_column]
    found = repeated_lines(rows, scratch, safe[id_column], text_name, least_words)
    size = found.agg(F.sum(F.size("lines"))).first()[0] or 0
    if size <= BROADCAST_LINES:
        found = F.broadcast(found)  # at most BROADCAST_LINES integers
    joined = rows.withColumn("key", document_key(safe[id_column], text_name)).join(found, "key", "left")
    parts = joined.withColumn("split", F.when(F.col("lines").isNotNull(), F.split(text_of(text_name), "\n")))
    everything = F.sequence(F.lit(0), F.size("split") - 1)
    worded = F.filter(everything, lambda j: has_word(F.get("split", j)))
    listed = parts.withColumn("worded", F.when(F.col("lines").isNotNull(), worded))
    removed = listed.withColumn("removed", F.coalesce(F.transform("lines", lambda p: F.get("worded", p)), F.array().cast("array<int>")))
    left = F.transform(F.array_except(everything, F.col("removed")), lambda j: F.get("split", j))
    text = F.when(F.size("removed") == 0, F.col(text_name).cast("string")).otherwise(F.array_join(left, "\n"))
    breaks = F.octet_length(text_of(text_name)) - F.octet_length(F.replace(text_of(text_name), F.lit("\n"), F.lit("")))
    count = F.when(F.col(text_name).isNull(), 0).otherwise(breaks + 1).cast("bigint")
    added = {"__n_lines": count, "__removed": F.col("removed"), "__text": text}
    return removed.select(*[F.col(s).alias(c) for c, s in safe.items() if c not in added], *[v.alias(n) for n, v in added.items()])


SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
raw AS (SELECT doc_id, j, ls[j + 1] AS line FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS j FROM d)),
l AS (
  SELECT doc_id, j, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS p, len(string_split(norm, ' ')) AS w, norm FROM (
    SELECT doc_id, j, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
    FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))),
cum AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS c FROM l),
whole AS (SELECT doc_id, list(norm ORDER BY p) AS norms FROM l GROUP BY doc_id),
runs AS (
  SELECT a.doc_id, a.p, b.p - a.p + 1 AS size, array_to_string(norms[a.p : b.p], chr(10)) AS run
  FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 50 AND b.c - a.c + a.w >= 50
    AND (b.c - a.c < 50 OR b.c - b.w - a.c + a.w < 50) JOIN whole ON whole.doc_id = a.doc_id),
later AS (SELECT doc_id, p, size FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS copy FROM runs) WHERE copy > 1),
gone AS (SELECT DISTINCT l.doc_id, l.j FROM l JOIN later ON l.doc_id = later.doc_id AND l.p BETWEEN later.p AND later.p + later.size - 1),
kept AS (SELECT raw.doc_id, string_agg(line, chr(10) ORDER BY raw.j) AS text FROM raw LEFT JOIN gone USING (doc_id, j) WHERE gone.j IS NULL GROUP BY raw.doc_id),
numbers AS (SELECT doc_id, count(*) AS n, string_agg(j, ',' ORDER BY j) AS js FROM gone GROUP BY doc_id)
SELECT documents.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines, coalesce(numbers.n, 0)::BIGINT AS n_removed, coalesce(numbers.js, '') AS removed_lines,
  CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents LEFT JOIN d USING (doc_id) LEFT JOIN numbers USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
