"""Quality rules: document measures, and lines that too many documents of a host share. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.session import Scratch

WHITE = "\t\n\x0b\x0c\r "
GAPS = "[\\t-\\r ]+"

LEAST_DOCUMENTS = 10
HOST_PERCENT = 2
DEPLETED_PERCENT = 70
FEW = 64
BROADCAST_HASHES = 1_000_000


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAPS))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(tokens: Column) -> Column:
    """How many words lie in a 3-word window that occurs at least twice in the array.

    Windows are compared by 64-bit hash. A document with few different repeated windows looks each window
    up among them; one with many sorts its windows with their places, so the work stays n log n.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3), lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))

    def twice(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i - 1)))

    def looked_up(found: Column, windows: Column) -> Column:
        return F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(found, h), i)), lambda i: i.isNotNull())

    def paired(placed: Column) -> Column:
        same = F.filter(placed, lambda e, k: (e["h"] == F.get(placed, k - 1)["h"]) | (e["h"] == F.get(placed, k + 1)["h"]))
        return F.sort_array(F.transform(same, lambda e: e["i"]))

    def places(windows: Column) -> Column:
        sorted_places = let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), paired)
        return let(let(F.sort_array(windows), twice), lambda found: F.when(F.size(found) == 0, F.array().cast("array<int>"))
                   .when(F.size(found) <= FEW, looked_up(found, windows)).otherwise(sorted_places))

    def covered(at: Column) -> Column:
        fresh = F.transform(at, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, k - 1))))
        return F.aggregate(fresh, F.lit(0), lambda x, y: x + y)

    return F.when(F.size(tokens) < 3, F.lit(0)).otherwise(let(let(hashes, places), covered)).cast("bigint")


def measures(docs: DataFrame, text_column: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, each named with ``prefix``."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    own = [F.col(f"`{c}`") for c in docs.columns]
    split = docs.select(*own, text.alias("__t"), words(text).alias("__w"), lines.alias("__l"))
    found = {
        "n_words": F.size("__w").cast("bigint"),
        "word_chars": F.length(F.translate("__t", WHITE, "")).cast("bigint"),
        "n_symbols": (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("bigint"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("__w")),
    }
    out = split.select(*own, *[v.alias(prefix + n) for n, v in found.items()])
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return out.withColumn(f"{prefix}base_failed", (n < 50) | (100 * repeated > 50 * n))


def normal_line(line: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(WHITE)), GAPS, " "))


def normal_lines(text: Column) -> Column:
    """``normal_line`` of each line of a text that has a word, in order; the text is normalised as a whole, which is cheaper."""
    # most texts have single spaces only, and a regular expression costs more than all the rest
    odd = reduce(or_, [F.contains(text, F.lit(white)) for white in ("  ", "\t", "\x0b", "\f", "\r")])
    whole = F.lower(F.when(odd, F.regexp_replace(text, "[\\t\\x0B\\f\\r ]+", " ")).otherwise(text))
    return F.filter(F.transform(F.split(whole, "\n"), lambda x: F.trim(x)), lambda x: x != "")  # transform gives trim the index too


def count_normal_words(line: Column) -> Column:
    """Words of a normal line: its spaces and one."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("int")


def line_hash(line: Column) -> Column:
    return F.unhex(F.md5(normal_line(line)))


def content_key(text_column: str, host_column: str) -> list[Column]:
    """Host (NULL: the empty one) and digest of the text (NULL: empty): rows equal in both share every verdict."""
    return [
        F.coalesce(F.col(f"`{host_column}`").cast("string"), F.lit("")).alias("__host"),
        F.unhex(F.md5(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))).alias("__digest")]


def frequent_lines(
    docs: DataFrame, scratch: Scratch, text_column: str = "text", host_column: str = "source",
    least_documents: int = LEAST_DOCUMENTS, host_percent: int = HOST_PERCENT,
) -> DataFrame:
    """Per content key with any: ``__removed_words`` and ``__lines``, the hashes of its lines above the limits.

    A normalised line is above the limits in a host when more than ``least_documents`` documents of the host
    with different texts hold it, and more than ``host_percent`` per cent of them. Copies of a text count as
    one document, so copying a document never condemns its lines.
    """
    key = content_key(text_column, host_column)
    lines = normal_lines(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))
    parts = docs.select(*key, F.explode(lines).alias("line")).select(
        "__host", "__digest", F.unhex(F.md5("line")).alias("__line"), count_normal_words(F.col("line")).alias("w"))
    # copies add up here, and are divided out below
    held = scratch.keep(parts.groupBy("__host", "__line", "__digest").agg(F.sum("w").alias("w")))
    contents = docs.select(*key).groupBy("__host", "__digest").agg(F.count("*").alias("copies"))
    hosts = contents.groupBy("__host").agg(F.count("*").alias("texts"))
    counts = held.groupBy("__host", "__line").agg(F.count("*").alias("n")).where(F.col("n") > least_documents)
    frequent = counts.join(hosts, "__host").where(100 * F.col("n") > host_percent * F.col("texts")).select("__host", "__line")
    hit = held.join(frequent, ["__host", "__line"]).groupBy("__host", "__digest").agg(F.sum("w").alias("w"), F.collect_set("__line").alias("__lines"))
    return hit.join(contents, ["__host", "__digest"]).select("__host", "__digest", (F.col("w") / F.col("copies")).cast("bigint").alias("__removed_words"), "__lines")


def judge(
    docs: DataFrame, scratch: Scratch, text_column: str = "text", host_column: str = "source", least_documents: int = LEAST_DOCUMENTS,
    host_percent: int = HOST_PERCENT, depleted_percent: int = DEPLETED_PERCENT,
) -> DataFrame:
    """``docs`` with the measures, ``n_removed_words``, ``kept`` and ``removed_lines``, all prefixed ``__q_``.

    A document is kept unless its base measures fail or it is depleted: its lines above the limits hold more
    than ``depleted_percent`` per cent of its words. NULL and empty texts have no words and fail. Ties at a
    limit are within it. Repeated rows get equal verdicts. An empty table gives an empty result. Columns of the
    added names are replaced.
    """
    safe = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows, names = docs.toDF(*safe.values()), (safe[text_column], safe[host_column])
    measured = measures(rows.select("*", *content_key(*names)), names[0], "__q_")
    hits = scratch.keep(frequent_lines(rows, scratch, *names, least_documents, host_percent))
    held = hits.agg(F.sum(F.octet_length("__host") + 16 * (F.size("__lines") + 2))).first()[0] or 0
    if held <= 16 * BROADCAST_HASHES:
        hits = F.broadcast(hits)  # at most that many bytes of hosts and hashes; rows keep their places and no text is shuffled
    judged = measured.join(hits, ["__host", "__digest"], "left")
    removed = F.coalesce("__removed_words", F.lit(0))
    depleted = 100 * removed > depleted_percent * F.col("__q_n_words")
    added = {c: F.col(c) for c in measured.columns if c.startswith("__q_")}
    added |= {"__q_n_removed_words": removed, "__q_kept": ~F.col("__q_base_failed") & ~depleted, "__q_removed_lines": F.col("__lines")}
    return judged.select(*[F.col(s).alias(c) for c, s in safe.items() if c not in added], *[v.alias(n) for n, v in added.items()])


def clean(docs: DataFrame, scratch: Scratch, text_column: str = "text", host_column: str = "source", **limits: int) -> DataFrame:
    """The documents that are kept, without their lines above the limits; columns as in ``docs``."""
    # written first: as a filter on it, the verdict would be pushed to where each use of the words splits the text again
    work = Scratch(scratch.spark)
    judged = scratch.keep(judge(docs, work, text_column, host_column, **limits)).where("__q_kept")
    work.clear()
    rest = F.filter(F.split(F.col(f"`{text_column}`"), "\n"), lambda x: ~F.array_contains("__q_removed_lines", line_hash(x)))
    text = F.when(F.col("__q_removed_lines").isNull(), F.col(f"`{text_column}`")).otherwise(F.array_join(rest, "\n"))
    return judged.select(*[text.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
repeated AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM twice, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY rid),
lines AS (SELECT rid, host, t, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
          FROM (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
hosts AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host),
frequent AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS n FROM lines GROUP BY host, norm) JOIN hosts USING (host) WHERE n > 10 AND 100 * n > 2 * texts),
removed AS (SELECT rid, sum(len(string_split(norm, ' '))) AS n FROM lines JOIN frequent USING (host, norm) GROUP BY rid),
base AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN removed USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (100 * n_removed_words > 70 * n_words) AS kept
FROM base
"""
