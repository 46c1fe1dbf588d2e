"""The corpus operators on small hard tables: nulls, empty texts, copies, repeated rows, ties, clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from quillon.llm import decontaminate, language_id, line_quality, line_runs, near_duplicates, packing, sharding, signature_tree, token_counts, toxicity, warc
from quillon.llm.components import components
from quillon.llm.encoders import encoder
from quillon.session import Scratch

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string, `__key` int, shard int, component_id string"


def corpus():
    """Rows with every hard case; the last columns clash with names the operators use."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    def lines(k, n=12):
        return "\n".join(prose(n) for _ in range(k))

    base = lines(12)
    near = base.split(" ")
    near[30] = "changed"
    passage = prose(60)
    texts = [
        base, base, " ".join(near), base.upper(), lines(9), lines(9) + "\n" + passage, lines(9) + "\n" + passage + "\n" + prose(5), passage + "\n" + lines(6) + "\n" + passage,
        None, "", "   \n\t\n", "short", "a b c d e f", prose(70), "word " * 120, "x" * 3000, "é ñ <|endoftext|> ü\n\n" + prose(55), "1 2 3 !", lines(200)]
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 2}", 0 if t is None else len(t), "x", 1, 2, "y") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture
def scratch(spark):
    found = Scratch(spark)
    yield found
    found.clear()


def none_of(docs):
    return docs.where("false")


def texts():
    return [(r[0], r[1]) for r in corpus()]


def test_token_counts(spark, docs, scratch):
    cache = token_counts.TokenCache(spark, scratch.path("cache"))

    def run():
        return Counter(tuple(r) for r in token_counts.count_tokens(docs, BYTE_BPE, cache, scratch).collect())

    exact = encoder(BYTE_BPE).exact
    wanted = Counter()
    for i, t in texts():
        n = len(exact.encode(t or "", add_special_tokens=False).ids)
        wanted[(i, len((t or "").encode()), n, n > 1024)] += 1
    assert run() == wanted
    stored = spark.read.parquet(cache.folder).count()
    assert stored == len({t or "" for _, t in texts()})
    assert run() == wanted  # from the cache
    assert spark.read.parquet(cache.folder).count() == stored
    assert token_counts.count_tokens(none_of(docs), BYTE_BPE, cache, scratch).count() == 0


def repeated(words):
    """Words in 3-word windows found twice or more."""
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    return len({k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)})


def base_fails(text):
    words = (text or "").split()
    return len(words) < 50 or 2 * repeated(words) > len(words)


def test_quality_rules(docs, scratch):
    found = {(r["doc_id"], r["text"]): r for r in line_quality.judge(docs, scratch).collect()}
    assert len(line_quality.judge(docs, scratch).columns) == len(docs.columns) + 9
    for i, t in texts():
        words = (t or "").split()
        listed = [x for x in (t or "").split("\n") if x.split()]
        r = found[(i, t)]
        assert r["__q_n_words"] == len(words)
        assert r["__q_word_chars"] == sum(map(len, words))
        assert r["__q_n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        assert r["__q_n_dup_lines"] == len(listed) - len(set(listed))
        assert r["__q_n_repeat_words"] == repeated(words)
        assert r["__q_base_failed"] == base_fails(t)
    assert line_quality.judge(none_of(docs), scratch).count() == 0


def test_repeated_words_with_many_windows(spark):
    rng = random.Random(2)
    rows = [(" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n)),) for n in (0, 1, 2, 3, 40, 900)]
    rows.append((" ".join(str(i) for i in range(400)) + " " + " ".join(str(i) for i in range(400)),))
    for r in line_quality.measures(spark.createDataFrame(rows, "text string")).collect():
        assert r["n_repeat_words"] == repeated(r["text"].split())


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark, scratch):
    rng = random.Random(3)

    def unique(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(n))

    shared = "Read   More about our " + unique(40)
    rows = [(i, f"{unique(60)}\n{shared.upper() if i % 2 else shared}\n{unique(5)}", "h") for i in range(14)]
    rows += [(20, f"{shared}\n{unique(14)}", "h"), (21, f"{unique(30)}\n{shared}\n{unique(30)}", "other")]
    rows += [(30 + i, rows[0][1], "h") for i in range(20)]  # copies of a text count once
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    out = {r["doc_id"]: r["text"] for r in line_quality.clean(frame, scratch).collect()}
    assert set(out) == {r[0] for r in rows} - {20}
    assert shared.lower() not in out[3].lower() and shared in out[21]
    copies = spark.createDataFrame([(i, unique(60) if i < 2 else rows[0][1], "h") for i in range(40)], "doc_id int, text string, source string")
    assert line_quality.clean(copies, scratch).count() == 40


def brute_components(rows, shingle=4, percent=85):
    sets = []
    for _, t in rows:
        w = [x.lower() for x in (t or "").split()]
        sets.append({tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = {}
    for (d, _), x in zip(rows, label, strict=True):
        ids[x] = d if ids.get(x) is None else ids[x] if d is None else min(ids[x], d)
    return Counter((d, len(s), ids[x]) for (d, _), s, x in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize("chunk", [near_duplicates.CHUNK_SHINGLES, 300])
def test_near_duplicates(docs, scratch, chunk):
    found = near_duplicates.near_duplicates(docs, scratch, chunk_shingles=chunk)
    assert Counter(tuple(r) for r in found.collect()) == brute_components(texts())


def test_near_duplicates_of_many_copies_with_edits(spark, scratch, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SAMPLED", 2)
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for i in range(30)]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch, chunk_shingles=1500)
    assert Counter(tuple(r) for r in found.collect()) == brute_components(rows)
    assert near_duplicates.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string"), scratch).count() == 0


def test_components(spark, scratch):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a int, b int"), scratch).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_decontamination(spark, docs):
    items = [(1, corpus()[4][1].split("\n")[2] + " " + corpus()[4][1].split("\n")[3]), (2, "not in any text whatsoever, by no means at all"), (3, None), (None, "x" * 80), (4, "tiny"), (5, corpus()[13][1].upper()[:90] + "?"), (2, "also not there, quite certainly not in there either")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_contaminated(docs, bench)
    wanted = Counter()
    for i, t in texts():
        plain = decontaminate.plain(t or "")
        hits = []
        for item, text in items:
            p = decontaminate.plain(text or "")
            if item is not None and len(p) >= decontaminate.LEAST_CHARS:
                best = decontaminate.best_distance(p, plain)
                if best <= decontaminate.error_budget(len(p)):
                    hits.append(item)
        wanted[(i, tuple(sorted(set(hits))))] += 1
    assert Counter((r["doc_id"], tuple(r["items"])) for r in found.collect()) == wanted
    assert sum(bool(k[1]) for k in wanted) >= 2
    assert all(not r["items"] for r in decontaminate.find_contaminated(docs, bench.where("false")).collect())
    assert decontaminate.find_contaminated(none_of(docs), bench).count() == 0


def test_decontamination_in_blocks_loses_no_item(spark, docs, monkeypatch):
    items = [(i, corpus()[18][1].split("\n")[i] + " " + corpus()[18][1].split("\n")[i + 1]) for i in range(5)]
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    found = decontaminate.find_contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert [r["items"] for r in found.where("doc_id = 18").collect()] == [list(range(5))]


def test_short_items_are_found_as_whole_words_without_edits(spark):
    items = [(1, "Who wrote  Hamlet?"), (2, "art"), (3, "水の沸点は何度ですか"), (4, " \n"), (5, "who wrote hamlat?"), (6, None), (7, "की")]
    rows = [(1, "asked: who wrote\nHAMLET? by"), (2, "a start, an artist"), (3, "modern art."), (4, "問題。水の沸点は何度ですか答え"), (5, "we who wrote hamlets?"), (6, ""), (7, "कीड़ा")]
    found = decontaminate.find_contaminated(spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r["doc_id"]: (r["items"], r["distances"]) for r in found.collect()} == {
        1: ([1], [0]), 2: ([], []), 3: ([2], [0]), 4: ([3], [0]), 5: ([], []), 6: ([], []), 7: ([], [])}


def brute_runs(rows, least=50):
    """Deleted lines by the definition: every run of enough words that stands earlier."""
    def norm(x):
        return " ".join(x.lower().split())

    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    seqs = [(k, [(j, norm(x)) for j, x in enumerate(k[2].split("\n")) if norm(x)]) for k in order]
    gone, seen = {k: set() for k in order}, set()
    for k, seq in seqs:
        for a in range(len(seq)):
            run, words = (), 0
            for b in range(a, min(len(seq), a + 60)):
                run, words = (*run, seq[b][1]), words + len(seq[b][1].split())
                if words >= least:
                    if run in seen:
                        gone[k] |= {j for j, _ in seq[a : b + 1]}
                    seen.add(run)
    return gone


def test_line_runs(docs, scratch):
    gone = brute_runs(texts())
    rows = line_runs.remove_repeated_runs(docs, scratch).collect()
    assert len(rows) == len(texts())
    for r in rows:
        wanted = gone[(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")]
        assert set(r["__removed"]) == wanted
        assert r["__text"] == (r["text"] if not wanted else "\n".join(x for j, x in enumerate(r["text"].split("\n")) if j not in wanted))
    assert line_runs.remove_repeated_runs(none_of(docs), scratch).count() == 0


def test_line_runs_of_short_lines(spark, scratch):
    rng = random.Random(11)
    rows = []
    for i in range(40):
        rows.append((i, "\n".join(" ".join(rng.choice("pq") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 60)))))
    block = "\n".join(" ".join(f"z{rng.randrange(50)}" for _ in range(rng.randint(1, 9))) for _ in range(70))
    rows += [(50, block), (51, "start\n" + block.replace(" ", "  ")), (52, "\n".join(block.split("\n")[20:60]) + "\nend"), (53, block + "\n" + block)]
    gone = brute_runs(rows)
    for r in line_runs.remove_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch).collect():
        assert set(r["__removed"]) == gone[(False, r["doc_id"], r["text"])]


def test_shards(docs, scratch):
    rows = sharding.shuffle_into_shards(docs, 5, scratch, bucket_rows=2).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(texts())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(5))
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert sharding.shuffle_into_shards(none_of(docs), 5, scratch).count() == 0


def test_language(spark, docs):
    rng = random.Random(1)
    words = {"en": ["the", "thing", "with", "which"], "es": ["ñandú", "señor", "corazón", "qué"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang) for i in range(120) for lang in [("en", "es")[i % 2]]]
    rows += [(500, None, "en"), (501, "", "es"), (502, "12 34", "es"), (None, "the thing", None), (3, rows[3][1], rows[3][2])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as score")
    found = language_id.identify(frame).collect()
    assert len(found) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    for r in found:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (500, 501, 502):
            assert r["lang_pred"] == "und"
        elif r["doc_id"] is not None:
            assert r["lang_pred"] == lang[r["doc_id"]]
    assert language_id.identify(frame.where("false")).count() == 0


def test_every_language_teaches_from_all_over_its_texts(spark):
    rows = [(i, "a" * 5000 + "b" * 5000, f"l{i % 70:02d}") for i in range(200)]
    sample, names = language_id.training_sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), most_texts=70)
    assert len(set(names)) == 70 and len(names) <= 200
    assert all(found[0] == b"a" * 64 and found[-1][:16] == b"b" * 16 and len(found) == language_id.SAMPLE_WINDOWS for found in sample)
    net = language_id.train_windows(sample, names, steps=1, batch=32)
    assert len(net.languages) == 70
    assert [x[0] for x in language_id.predict(net, [None, ""])] == ["und", "und"]


def test_toxicity(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)) + (" you idiot scum" if i % 4 == 0 else " muslim women"), i % 4 == 0) for i in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "idiot scum"), (0, rows[0][1])], "doc_id bigint, text string").selectExpr("*", "1 as score")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    found = toxicity.score_all(frame, labels).collect()
    assert len(found) == 404
    truth = {i: int(y) for i, _, y in rows}
    for r in found:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] in truth:
            assert r["predicted"] == truth[r["doc_id"]]
    assert {r["score"] for r in toxicity.score_all(frame, labels.where("false")).collect()} == {0.5}


def test_archives(spark, scratch):
    long = "<p>" + "text é " * 60
    rows = [(3, "u3", long), (1, "u1", long), (2, None, long), (4, "u4", None), (5, "u5", ""), (6, "u6", "tiny"), (7, "u7", "tiny"), (8, "a\nb", "<b>" * 5000), (1, "u1", long), (None, "n", "z" * 300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as digest", "1 as payload")
    found = warc.archive_pages(pages, scratch, payloads=True).collect()
    assert len(found) == len(rows)
    wanted = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 1
        wanted[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None, b"" if again else data)] += 1
    assert Counter((*tuple(r)[:5], bytes(r["payload"])) for r in found) == wanted
    assert warc.archive_pages(pages.where("false"), scratch).count() == 0


def test_partitions_that_fill_several_archives_lose_no_record(spark, scratch):
    rng = random.Random(9)
    payloads = [rng.randbytes(1000) for _ in range(20)]
    rows = [(i, None, p, hashlib.sha256(p).hexdigest(), 1000, "response", None) for i, p in enumerate(payloads)]
    records = spark.createDataFrame(rows, warc.RECORD).coalesce(1)
    folder = scratch.path("archives")
    archives = scratch.keep(warc.write_archives(records, folder, b"", most=2500))
    assert [r["n_records"] for r in archives.orderBy("archive").collect()] == [3] * 6 + [2]
    found = warc.read_archives(archives, folder, payloads=True).collect()
    assert sorted((r["page_id"], bytes(r["payload"])) for r in found) == [(i, p) for i, _, p, *_ in rows]


def test_a_damaged_payload_stops_the_reading_back(spark, scratch):
    rows = [(1, None, b"other than the digest says", hashlib.sha256(b"payload").hexdigest(), 7, "response", None)]
    folder = scratch.path("archives")
    archives = scratch.keep(warc.write_archives(spark.createDataFrame(rows, warc.RECORD), folder, b""))
    with pytest.raises(Exception, match="the payload of page 1 has"):
        warc.read_archives(archives, folder).collect()


def check_packing(rows, kept):
    """Pieces as the contract has them, and no gap or overflow in any sequence."""
    exact = encoder(BYTE_BPE).exact
    wanted = Counter()
    for i, t in kept:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 2]
        count = -(-len(ids) // 1024)
        start, size = 0, len(ids) - 1024 * (count - 1)
        for p in range(count):
            wanted[(i, p, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes()))] += 1
            start, size = start + size, 1024
    assert Counter(tuple(r)[:5] for r in rows) == wanted
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(e <= 1024 for e in ends.values())


def test_packing(docs, scratch):
    check_packing(packing.pack_documents(docs, BYTE_BPE, scratch).collect(), texts())
    many = packing.pack(packing.token_pieces(docs, BYTE_BPE), scratch, rank_rows=1)
    check_packing(many.collect(), texts())
    assert packing.pack_documents(none_of(docs), BYTE_BPE, scratch).count() == 0


def test_pipeline_equals_brute_force(spark, docs, tmp_path):
    folder = f"file://{tmp_path}"
    items = [(1, " ".join(corpus()[13][1].split()[5:40])), (2, "a passage that no document has, however long one looks for it")]
    docs.drop("n_tokens", "__key", "shard", "component_id").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(i, t) for i, t in texts()]
    kept = [(i, t) for i, t in rows if not base_fails(t)]
    gone = brute_runs(kept)
    left = []
    for i, t in kept:
        lost = gone[(i is None, i or 0, t)]
        text = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in lost) if lost else t
        if text.split() or not lost:
            left.append((i, text))
    groups = brute_components(left, 5, 80)
    firsts = {g for _, _, g in groups}
    left = list(dict.fromkeys((i, t) for i, t in left if i in firsts))  # rows that repeat id and text are one document
    clean = [(i, t) for i, t in left if not any(decontaminate.best_distance(decontaminate.plain(x), decontaminate.plain(t)) <= decontaminate.error_budget(len(decontaminate.plain(x))) for _, x in items)]
    assert len(clean) < len(left) < len(kept) < len(rows)
    check_packing(corpus_pipeline.run(spark, folder).collect(), clean)


def test_stages_keep_columns(spark, docs):
    folder_docs = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, folder_docs, "").columns == docs.columns


def test_nothing_else_imports_the_package():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[2] / "quillon"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "quillon.llm" in p.read_text()]


def test_signature_tree_of_one_set():
    assert signature_tree.links([signature_tree.shingles("a b c d e")], np.zeros(1), False) == []
