"""A toxicity classifier that is fitted to score a sentence alike whichever group it mentions."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.session import Scratch, spread

# Group terms that may stand in for one another, one list per kind, by language.
IDENTITY_TERMS: dict[str, tuple[tuple[str, ...], ...]] = {
    "en": (
        ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("black", "white", "asian", "latino", "african", "european"),
        ("gay", "lesbian", "straight", "bisexual", "transgender"), ("immigrant", "native", "refugee", "foreigner"),
        ("immigrants", "natives", "refugees", "foreigners"), ("old", "young", "elderly"), ("disabled", "deaf", "blind"),
        ("he", "she"), ("him", "her"), ("himself", "herself")),
    "fr": (
        ("femmes", "hommes", "filles", "garçons"), ("femme", "homme", "fille", "garçon"), ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"), ("noir", "blanc", "asiatique", "africain", "européen"),
        ("lesbienne", "hétérosexuel", "bisexuel", "transgenre"), ("immigré", "réfugié", "étranger"), ("immigrés", "réfugiés", "étrangers"),
        ("vieux", "jeune"), ("handicapé", "sourd", "aveugle"), ("il", "elle"), ("ils", "elles", "eux")),
    "de": (
        ("frauen", "männer", "mädchen", "jungen"), ("frau", "mann"), ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"), ("schwarz", "weiß", "asiatisch", "afrikanisch", "europäisch"),
        ("schwul", "lesbisch", "bisexuell"), ("einwanderer", "flüchtling", "ausländer"), ("alt", "jung"), ("behindert", "taub"), ("er", "sie"), ("ihn", "ihr")),
    "es": (
        ("mujeres", "hombres", "niñas", "niños"), ("mujer", "hombre", "niña", "niño"), ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
        ("musulmanes", "cristianos", "judíos", "budistas", "ateos"), ("negro", "asiático", "europeo"), ("lesbiana", "heterosexual", "bisexual"),
        ("inmigrante", "refugiado", "extranjero"), ("inmigrantes", "refugiados", "extranjeros"), ("viejo", "joven"), ("discapacitado", "sordo", "ciego"),
        ("él", "ella"), ("ellos", "ellas")),
}

WORD = re.compile(r"[^\W\d_]+")
BITS = 18
PREFIX = 5
SAMPLE = 4_000
MOST_PAIRS = 50_000
DESCRIBED_ROWS = 64
LEAST_TEXTS = 3
CHI_SQUARED = 10.83  # p = 0.001

Terms = Mapping[str, Sequence[Sequence[str]]] | Sequence[Sequence[str]]
Pairs = Mapping[tuple[tuple[int, ...], tuple[int, ...]], int]


class Model(NamedTuple):
    """Hashed weights of words and word beginnings, the bias, and from how many swapped sentences it learned."""

    weights: np.ndarray
    bias: float
    pairs: int = 0


def kinds(terms: Terms) -> list[Sequence[str]]:
    """The lists of all languages; of a word in several the first counts."""
    lists = [k for of in terms.values() for k in of] if isinstance(terms, Mapping) else list(terms)
    seen: set[str] = set()
    out = []
    for kind in lists:
        fresh = [w for w in kind if w not in seen]
        seen.update(fresh)
        if len(fresh) > 1:
            out.append(fresh)
    return out


def sentences(text: str) -> list[str]:
    """Parts of a text between line ends and closing punctuation, with a word in each."""
    return [s for s in re.split(r"[\n.!?]+", text) if WORD.search(s)]


def features(text: str) -> list[int]:
    """Distinct hashed features of a text: its words in lower case, and the first letters of the longer ones."""
    found = set(WORD.findall(text.lower()))
    names = found | {"^" + w[:PREFIX] for w in found if len(w) > PREFIX}
    return sorted({zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names})


def following_terms(terms: Terms) -> dict[str, str]:
    """Each term's successor in its kind, in a circle."""
    return {w: kind[(i + 1) % len(kind)] for kind in kinds(terms) for i, w in enumerate(kind)}


def swap(text: str, terms: Terms = IDENTITY_TERMS) -> str | None:
    """The text with each identity term replaced by the next of its kind, or None if it holds none."""
    return _swapped(text, following_terms(terms))


def _swapped(text: str, following: Mapping[str, str]) -> str | None:
    changed = WORD.sub(lambda m: following.get(m[0].lower(), m[0]), text)
    return None if changed == text else changed


def counterfactuals(text: str, terms: Terms = IDENTITY_TERMS) -> list[str]:
    """All texts that repeated swapping gives before it comes round to the text again."""
    return _counterfactuals(text, following_terms(terms))


def _counterfactuals(text: str, following: Mapping[str, str]) -> list[str]:
    out, seen, now = [], {text.lower()}, _swapped(text, following)
    while now is not None and now.lower() not in seen:
        seen.add(now.lower())
        out.append(now)
        now = _swapped(now, following)
    return out


def swapped_features(text: str, following: Mapping[str, str]) -> Pairs:
    """The features that a swap in a sentence takes away and brings, with the number of sentences and swaps that do.

    All other features of the sentence stay, so a score changes by these alone.
    """
    out: Counter = Counter()
    for sentence in sentences(text):
        if not any(w in following for w in WORD.findall(sentence.lower())):
            continue
        own = set(features(sentence))
        for other in _counterfactuals(sentence, following):
            new = set(features(other))
            if own != new:
                out[(tuple(sorted(own - new)), tuple(sorted(new - own)))] += 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def chi_squared(both, feature, ones, n):
    """Of a feature and the label: ``both`` rows have the two, ``feature`` the feature and ``ones`` the label, of ``n``."""
    cross = both * (n - ones) - (feature - both) * ones
    return n * cross * cross / np.maximum(feature * (n - feature) * ones * (n - ones), 1e-9)


def telling(rows: Sequence[np.ndarray], y: np.ndarray, least: int, level: float = CHI_SQUARED) -> np.ndarray:
    """Features of at least ``least`` texts whose chi-squared statistic with the label reaches ``level``."""
    ids, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    both = np.bincount(ids, np.repeat(y, lengths), 1 << BITS)
    count = np.bincount(ids, minlength=1 << BITS).astype(float)
    return np.flatnonzero((count >= least) & (chi_squared(both, count, y.sum(), len(y)) >= level))


def swapped(pairs: Pairs) -> np.ndarray:
    """Features that swaps take away or bring: these may learn from the labels too, against the penalty."""
    return np.array(sorted({i for gone, come in pairs for i in (*gone, *come)}), dtype=np.int64)


def fit(
    texts: Sequence[str], labels: Sequence[int], terms: Terms = IDENTITY_TERMS, balance: float = 2.0,
    steps: int = 200, rate: float = 0.1, decay: float = 1e-4, least: int = LEAST_TEXTS,
) -> Model:
    """``fit_features`` on texts that are at hand."""
    rows, y = [np.array(features(t), dtype=np.int64) for t in texts], np.array(labels, dtype=float)
    pairs: Counter = Counter()
    for t in texts:
        pairs.update(swapped_features(t, following_terms(terms)))
    known = np.union1d(telling(rows, y, least), swapped(pairs)) if len(rows) else np.empty(0, np.int64)
    return fit_features([r[np.isin(r, known)] for r in rows], y, pairs, balance, steps, rate, decay)


def fit_features(
    rows: Sequence[np.ndarray], y: np.ndarray, pairs: Pairs, balance: float = 2.0, steps: int = 200, rate: float = 0.1, decay: float = 1e-4,
) -> Model:
    """Logistic regression on hashed features with a penalty on score changes under identity swaps.

    The loss is the mean log loss, with the classes weighted to equal totals, plus ``balance`` times the mean
    squared change of the logit between a sentence with identity terms and its counterfactuals, plus
    ``decay`` on the weights. ``rows`` hold the features that tell something about the label and the swapped ones; others keep
    weight 0, so that long texts don't add up noise. Optimised by Adam on all rows. One class only, or no row, gives weights of 0 and that
    class's share (or one half).
    """
    total = sum(pairs.values())
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else float(np.clip(y.mean(), 0.01, 0.99))
        return Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))), total)
    swaps = sorted(pairs.items())
    sides = [(row, i, sign) for row, ((gone, come), _) in enumerate(swaps) for sign, side in ((1.0, gone), (-1.0, come)) for i in side]
    used, place = np.unique(np.concatenate([*rows, np.array([i for _, i, _ in sides], dtype=np.int64)]).astype(np.int64), return_inverse=True)
    lengths = np.array([len(r) for r in rows])
    ids, moved = place[: lengths.sum()], place[lengths.sum() :]
    row = np.repeat(np.arange(len(rows)), lengths)
    swap_row, sign = np.array([r for r, _, _ in sides], dtype=np.int64), np.array([s for _, _, s in sides])
    share = np.array([n for _, n in swaps], dtype=float) / max(total, 1)
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, bias = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        wrong = each * (_sigmoid(np.bincount(row, w[ids], len(rows)) + bias) - y)
        gradient = np.bincount(ids, wrong[row], len(used)) + decay * w
        if swaps:
            change = 2 * balance * share * np.bincount(swap_row, sign * w[moved], len(swaps))
            gradient += np.bincount(moved, sign * change[swap_row], len(used))
        full = np.append(gradient, wrong.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[used] = w
    return Model(weights, float(bias), total)


def score(model: Model, text: str | None) -> float:
    """Probability of the label 1 for a whole text; NULL and empty texts get what the bias alone gives."""
    return float(_sigmoid(np.array(float(model.weights[features(text or "")].sum()) + model.bias)))


class Sample(NamedTuple):
    """What the classifier learns from: features of each text, labels, and swapped features."""

    rows: list[np.ndarray]
    labels: np.ndarray
    pairs: Pairs


def labelled_sample(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, label: str = "toxic", limit: int = SAMPLE, terms: Terms = IDENTITY_TERMS, least: int = LEAST_TEXTS,
) -> Sample:
    """Features of about ``limit`` labelled texts of either class (twice as many at most), chosen by a hash of the doc_id.

    NULL ids, texts and labels, and labels other than 0 and 1, teach nothing. Features are made, counted and chosen in tasks:
    the driver gets, of each of at most 4 * ``limit`` texts, the few features that tell something about the label, and
    at most ``MOST_PAIRS`` different swaps, the most frequent ones; no text.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    parts = [marks.where((F.col("label") == v) & (chance < int(min(1.0, limit / n) * (1 << 31)))).limit(2 * limit) for v, n in sorted(counts.items())]
    if not parts:
        return Sample([], np.empty(0), {})
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # at most 4 * limit rows of two integers
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
    # a limit leaves one partition; at most as many tasks as there are cores share its rows
    limited = found.limit(4 * limit).select("label", "text").repartition(docs.sparkSession.sparkContext.defaultParallelism)
    rows = scratch.keep(limited.mapInArrow(
        _described(following_terms(terms)), "label int, ids array<int>, swaps array<struct<gone:array<int>,come:array<int>,n:bigint>>"))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).first()
    per = rows.select("label", F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).where(F.col("n") >= least)
    per = per.toPandas()  # at most 2 ** BITS features
    statistic = chi_squared(per["ones"].to_numpy(float), per["n"].to_numpy(float), float(total["ones"]), float(total["n"]))
    mask = np.zeros(1 << BITS, dtype=bool)
    mask[per["id"].to_numpy(np.int64)[statistic >= CHI_SQUARED]] = True
    swaps = rows.select(F.explode("swaps").alias("s")).select("s.*").groupBy("gone", "come").agg(F.sum("n").alias("n"))
    pairs = {(tuple(r["gone"]), tuple(r["come"])): r["n"] for r in swaps.orderBy(F.desc("n"), "gone", "come").limit(MOST_PAIRS).collect()}
    mask[swapped(pairs)] = True
    sent = docs.sparkSession.sparkContext.broadcast(mask)
    few = rows.select("label", "ids").mapInArrow(_chosen(sent), "label int, ids array<int>").toPandas()
    few = sorted((tuple(int(i) for i in ids), int(y)) for y, ids in zip(few["label"], few["ids"], strict=True))
    return Sample([np.array(ids, dtype=np.int64) for ids, _ in few], np.array([y for _, y in few], dtype=float), pairs)


def _described(following: Mapping[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("label", pa.int32()), ("ids", pa.list_(pa.int32())), (
        "swaps", pa.list_(pa.struct([("gone", pa.list_(pa.int32())), ("come", pa.list_(pa.int32())), ("n", pa.int64())])))])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a few rows at a time: as Python objects, features and swaps take many times the room of their texts
        for batch in (whole.slice(i, DESCRIBED_ROWS) for whole in batches for i in range(0, whole.num_rows, DESCRIBED_ROWS)):
            texts = batch.column("text").to_pylist()
            swaps = [[{"gone": list(g), "come": list(c), "n": n} for (g, c), n in sorted(swapped_features(t, following).items())] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([features(t) for t in texts], schema.field("ids").type), pa.array(swaps, schema.field("swaps").type)], schema=schema)

    return described


def _chosen(mask) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[i for i in ids if mask.value[i]] for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], ["label", "ids"])

    return chosen


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``docs`` without its text, with ``score`` (0 to 1). Whole texts are scored."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights, whatever the data
    others = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = [_score(fitted, t.as_py() or "", known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(scores, pa.float64())], [*others, "score"])

    return spread(docs).mapInArrow(run, schema)


def _score(model: Model, text: str, known: dict[str, tuple[int, ...]], most: int = 200_000) -> float:
    """``score`` with a bounded memory of the features of single words."""
    if len(known) > most:
        known.clear()
    ids: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        found = known.get(w)
        if found is None:
            found = known[w] = tuple(features(w))
        ids.update(found)
    return float(_sigmoid(np.array(float(model.weights[np.fromiter(ids, np.int64, len(ids))].sum()) + model.bias)))


def holdout(doc_id: str = "doc_id", parts: int = 5, part: int = 0):
    """Whether the crc32 of the id as text leaves ``part``; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(True))


def score_all(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, terms: Terms = IDENTITY_TERMS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the model sees labels of rows not held out only.

    Empty and NULL texts get the score of the bias. Very long texts are scored whole, by their different words.
    Repeated rows give equal rows. Without usable labels all scores are one half. An empty table of documents gives an
    empty result. Other columns are not looked at.
    """
    sample = labelled_sample(docs, labels.where(~holdout()), scratch or Scratch(docs.sparkSession), terms=terms)
    model = fit_features(sample.rows, sample.labels, sample.pairs)
    rows = docs.select("doc_id", holdout().alias("held_out"), F.col("text").cast("string").alias("text"))
    return score_documents(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
