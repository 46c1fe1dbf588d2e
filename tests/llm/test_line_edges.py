"""Lines with digits and spaces at their edges, repeated rows, and long texts, against DuckDB and brute force."""

import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from quillon.llm import line_quality, line_runs, packing
from quillon.session import Scratch


@pytest.fixture
def scratch(spark):
    found = Scratch(spark)
    yield found
    found.clear()


def edged():
    """Documents of two hosts that share blocks of lines with digits, spaces and tabs at their edges."""
    rng = random.Random(5)

    def word():
        return "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))

    def line(n):
        return " ".join(word() for _ in range(n))

    block = [f"{k} {line(9)} z{rng.randrange(50)}{k}" for k in range(12)]
    notice = "123456 all rights of " + line(3) + " reserved 123456"
    rows = []
    for i in range(60):
        lines = [f"  {line(rng.randint(4, 14))} {rng.randrange(10**6)}", " \t ", f"{i}{line(12)}", line(30), "0123456789"]
        if i % 3 == 0:
            lines += [x + " " * (i % 4) if i % 2 else "\t" + x.upper() for x in block]
        lines.insert(rng.randrange(len(lines)), " " * (i % 5) + notice)
        lines += [line(8) + " last line y"] if i % 2 else [""]
        rows.append((i, "\n".join(lines), f"h{i % 2}"))
    rows.append((100, " \nkeep me\n" + "\n".join(block) + "\nlast line y", "h0"))
    rows += [(101, None, "h1"), (102, "", None), (103, " \n \n", "h1")]
    rows += [(200 + i, "\n".join([notice] * 4 + [line(10)]), "h0") for i in range(12)]
    return rows


def from_duckdb(sql, rows):
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"])  # noqa: F841
    con = duckdb.connect()
    con.register("frame", documents)
    con.execute("CREATE VIEW documents AS SELECT doc_id, text, source, 'xx' AS lang, 0::BIGINT AS n_chars FROM frame")
    found = con.sql(sql)
    return Counter(tuple(sorted(zip(found.columns, r, strict=True))) for r in found.fetchall())


def test_quality_rules_equal_sql(spark, scratch):
    rows = edged()
    judged = line_quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), scratch)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
    found = Counter(tuple(sorted([("doc_id", r["doc_id"]), *[(n, r[f"__q_{n}"]) for n in names]])) for r in judged.collect())
    assert found == from_duckdb(line_quality.SQL, rows)
    assert len({dict(k)["n_removed_words"] for k in found}) > 2


def test_line_dedup_equals_sql(spark, scratch):
    rows = edged()
    done = line_runs.remove_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), scratch)
    found = Counter(
        tuple(sorted([("doc_id", r["doc_id"]), ("n_lines", r["__n_lines"]), ("n_removed", len(r["__removed"])),
                      ("removed_lines", ",".join(map(str, r["__removed"]))), ("text", r["__text"])])) for r in done.collect())
    assert found == from_duckdb(line_runs.SQL, rows)
    assert "keep me" in done.where("doc_id = 100").first()["__text"] and "last line y" in done.where("doc_id = 100").first()["__text"]


def test_cleaned_documents_equal_brute_force(spark, scratch):
    rows = edged()

    def norm(x):
        return " ".join(x.lower().split())

    texts = {}
    for _, t, h in rows:
        texts.setdefault(h or "", set()).add(t or "")
    often = set()
    for h, found in texts.items():
        counts = Counter(x for t in found for x in {norm(y) for y in t.split("\n")} if x)
        often |= {(h, x) for x, n in counts.items() if n > 10 and 100 * n > 2 * len(found)}
    wanted = {}
    for i, t, h in rows:
        words = (t or "").split()
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = len({k + d for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for d in range(3)})
        gone = sum(len(x.split()) for x in (t or "").split("\n") if (h or "", norm(x)) in often)
        if len(words) >= 50 and 2 * repeated <= len(words) and 100 * gone <= 70 * len(words):
            wanted[i] = "\n".join(x for x in t.split("\n") if (h or "", norm(x)) not in often)
    out = line_quality.clean(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), scratch)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == wanted
    assert 0 < len(wanted) < len(rows) and any(len(wanted[i]) < len(t) for i, t, _ in rows if i in wanted)


def test_kept_texts_are_split_once(spark, scratch):
    """A filter on the verdict must not bring the split of the whole text into the lambdas of the measures."""
    text = " ".join(f"w{i % 9000}" for i in range(20_000))
    frame = spark.createDataFrame([(1, text, "h")], "doc_id int, text string, source string")

    def splits(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("split(")

    assert splits(line_quality.clean(frame, scratch)) <= splits(line_quality.judge(frame, scratch))
    assert line_quality.clean(frame, scratch).count() == 0  # every window of the first 2000 words occurs again
    frame = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20_000)), "h")], "doc_id int, text string, source string")
    assert line_quality.clean(frame, scratch).count() == 1


def test_equal_pieces_are_spread(spark, scratch):
    pieces = spark.range(20_000).selectExpr("cast(null as bigint) as doc_id", "0 as piece", "0L as start", "1L as length", "7L as ids_crc32")
    packed = packing.pack(pieces, scratch, rank_rows=100)
    placed = [(r["sequence_id"], r["offset"]) for r in packed.collect()]
    assert len(set(placed)) == 20_000 and len({s for s, _ in placed}) == -(-20_000 // 1024)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan and "doc_id" not in plan.split("RepartitionByExpression")[1].split("\n")[0]


def test_one_row_of_each_document_stays(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, "fr", "b", 3), (1, text, "en", "a", 3), (1, text + " more", "en", "a", 3), (2, text, "en", "a", 3), (3, None, "en", "a", 0),
            (3, None, None, "a", 0), (None, "x y", "en", "a", 3), (None, "x y", "en", "a", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = Counter(tuple(r) for r in corpus_pipeline.jaccard_dedup(spark, frame, "").collect())
    assert len([r for r in found if r[0] in (1, 2)]) == 1
    assert sum(found.values()) == 3 and (3, None, "en", "a", 0) in found


def test_two_pipelines_leave_each_other_alone(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    for k in range(2):
        rows = [(i, "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(3)), "en", "a", 3) for i in range(8)]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        frame.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.createDataFrame([(1, "a passage that is in none of the documents of the corpus here")], "item_id bigint, text string").write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
    first = corpus_pipeline.run(spark, f"{tmp_path}/0")
    second = corpus_pipeline.run(spark, f"{tmp_path}/1")
    assert first.select("doc_id").distinct().count() == second.select("doc_id").distinct().count() == 8


def near_rows():
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(260):  # near copies of one text
        words = list(base)
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(260):  # texts that share a passage and are not alike
        rows.append((1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) + " " + passage))
    return rows


def test_large_blocks_of_near_copies_are_linear(spark, scratch, monkeypatch):
    """Each class of a block of many chunks meets the leader; what that connects is not sent again."""
    from quillon.llm import near_duplicates

    sent = []
    plain = near_duplicates._tree_links

    def counted(sets, placed, near, *rest):
        sent.append((near.count(), placed.where("large").select("class").distinct().count()))
        return plain(sets, placed, near, *rest)

    monkeypatch.setattr(near_duplicates, "_tree_links", counted)
    rows = near_rows()
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch, shingle=5, percent=80, chunk_shingles=3000)
    groups = Counter(r["component_id"] for r in found.collect())
    assert groups[0] == 260 and sum(n == 1 for n in groups.values()) == 260
    linked, large = sent[0]
    assert large >= 200 and 0.5 * large <= linked <= 3 * large


def test_common_keys_lose_no_link(spark, scratch, monkeypatch):
    from quillon.llm import near_duplicates

    monkeypatch.setattr(near_duplicates, "COMMON", 3)
    rows = near_rows()[::3]
    rng = random.Random(4)
    rows += [(5000 + i, " ".join(w if rng.random() > 0.01 else "z" for w in t.split())) for i, t in rows]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch, shingle=5, percent=80)
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == label
