"""Benchmark decontamination: exact piece hits by the pigeonhole principle, verified by bit-parallel edit distance."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.session import spread

ERROR_RATE = 0.08
LEAST_CHARS = 40
LEAST_PIECE = 11
BLOCK_CHARS = 4_000_000
BLOCK_ITEMS = 20_000

# Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana and Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def plain(text: str) -> str:
    """The form that is compared: lower case, words separated by one space."""
    return " ".join(text.lower().split())


def error_budget(length: int, rate: float = ERROR_RATE, least_piece: int = LEAST_PIECE) -> int:
    """Edits allowed in an item of so many characters: ``rate`` of them, but no more than leave pieces of ``least_piece``."""
    return max(0, min(int(length * rate), length // least_piece - 1))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their places: ``budget`` edits leave one of them whole."""
    n, k = len(item), budget + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_distance(pattern: str, text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text`` (Myers' bit-parallel algorithm).

    Python's integers serve as words of any width, so a pattern of any length is one word.
    """
    m = len(pattern)
    if not m:
        return 0
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = ones, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & ones
        plus, minus = (down | ~(diagonal | up)) & ones, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & ones, (minus << 1) & ones
        up, down = (minus | ~(diagonal | plus)) & ones, plus & diagonal
        if score < best:
            best = score
    return best


def is_bound(text: str, at: int) -> bool:
    """Whether no word goes on across this place; in scripts without spaces words may end anywhere."""
    if at <= 0 or at >= len(text):
        return True
    pair = text[at - 1 : at + 1]
    return any(unicodedata.category(c)[0] not in "LMN" for c in pair) or bool(UNSPACED.search(pair))


class Matcher:
    """Finds the items of one block of the benchmark in texts; those under ``least_chars`` characters only without edits and as whole words."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_piece: int, least_chars: int = LEAST_CHARS):
        import ahocorasick

        self.least_chars = least_chars
        self.items = [(item_id, text, error_budget(len(text), rate, least_piece) if len(text) >= least_chars else 0) for item_id, text in items]
        self.automaton = ahocorasick.Automaton()
        for number, (_, text, budget) in enumerate(self.items):
            for at, piece in pieces(text, budget):
                self.automaton.add_word(piece, [*self.automaton.get(piece, []), (number, at)])
        if len(self.automaton):
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item_id, distance) of each item with a substring of the text within its budget.

        Every piece hit is verified in the stretch the item could take around it; hits that imply
        nearly the same stretch are verified once.
        """
        if not len(self.automaton):
            return []
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        whole: set[int] = set()
        for last, owners in self.automaton.iter(text):
            for number, at in owners:
                _, item, budget = self.items[number]
                if len(item) < self.least_chars:
                    if number not in whole and is_bound(text, last + 1 - len(item)) and is_bound(text, last + 1):
                        whole.add(number)
                    continue
                begin = last + 1 - self._piece_length(number, at) - at - budget
                end = begin + len(item) + 2 * budget
                known = stretches[number]
                if known and abs(begin - known[-1][0]) <= 2 * budget:
                    known[-1] = [min(known[-1][0], begin), max(known[-1][1], end)]
                else:
                    known.append([begin, end])
        found = [(self.items[number][0], 0) for number in whole]
        for number, spans in stretches.items():
            item_id, item, budget = self.items[number]
            best = min(best_distance(item, text[max(0, a) : b]) for a, b in spans)
            if best <= budget:
                found.append((item_id, best))
        return found

    def _piece_length(self, number: int, at: int) -> int:
        _, item, budget = self.items[number]
        n, k = len(item), budget + 1
        i = -(-(at * k) // n)
        while n * i // k < at:
            i += 1
        return n * (i + 1) // k - at


def benchmark_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in blocks of at most ``chars`` characters (or one item), so any benchmark fits a task's memory.

    Items are streamed to the driver partition by partition. Items with a NULL id, which no list can
    name, and those without a text or with white space only, which no text can show, are left out.
    """
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    block, size = [], 0
    for row in rows.toLocalIterator():
        text = plain(row["text"])
        if not text:
            continue
        if block and (size + len(text) > chars or len(block) >= BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", rate: float = ERROR_RATE,
    least_piece: int = LEAST_PIECE, least_chars: int = LEAST_CHARS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, columns in ``keep``, ``items`` (ids of benchmark items in its text, ascending) and ``distances``.

    Whole texts are searched, in lower case and with white space collapsed. An item of n characters is
    in a text when some substring is within its error budget of edits (``error_budget``); an item of less than
    ``least_chars`` characters when it is there without edits and on word bounds (``is_bound``). A benchmark
    larger than one block is searched block by block, each in one pass over the documents. No item is dropped but
    those with a NULL id or without text. An item_id with several texts is one item that any of them shows.

    NULL and empty texts hold nothing. Repeated rows give equal rows. An empty benchmark gives empty lists,
    an empty table an empty result. Other columns of either table are not looked at.
    """
    spark = docs.sparkSession
    fields = [T.StructField("doc_id", docs.schema[id_column].dataType), *[T.StructField(c, docs.schema[c].dataType) for c in keep]]
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("items", "distances")]
    out = spread(docs.select(
        F.col(id_column).alias("doc_id"), *[F.col(f"`{c}`") for c in keep], F.col(text_column).cast("string").alias("__text"),
        F.array().cast("array<bigint>").alias("items"), F.array().cast("array<bigint>").alias("distances")))
    text = [T.StructField("__text", T.StringType())]
    blocks = benchmark_blocks(benchmark)
    block = next(blocks, None)
    while block:
        following = next(blocks, None)
        sent = spark.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters
        out = out.mapInArrow(_searcher(sent, rate, least_piece, least_chars, following is not None), T.StructType([*fields, *(text if following else []), *lists]))
        block = following
    pairs = F.sort_array(F.arrays_zip("items", "distances"))
    best = F.array_distinct(F.transform(pairs, lambda p: p["items"]))
    distances = F.transform(best, lambda i: F.array_min(F.transform(F.filter(pairs, lambda p: p["items"] == i), lambda p: p["distances"])))
    return out.select("doc_id", *[F.col(f"`{c}`") for c in keep], best.alias("items"), distances.alias("distances"))


def _searcher(block, rate: float, least_piece: int, least_chars: int, again: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value, rate, least_piece, least_chars)
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            items, distances = batch.column(at["items"]).to_pylist(), batch.column(at["distances"]).to_pylist()
            for i, text in enumerate(batch.column(at["__text"])):
                value = text.as_py()
                for item_id, distance in matcher.find(plain(value)) if value else []:
                    items[i].append(item_id)
                    distances[i].append(distance)
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            arrays[at["items"]], arrays[at["distances"]] = pa.array(items, pa.list_(pa.int64())), pa.array(distances, pa.list_(pa.int64()))
            kept = [n for n in batch.schema.names if again or n != "__text"]
            yield pa.RecordBatch.from_arrays([arrays[at[n]] for n in kept], kept)

    return search
