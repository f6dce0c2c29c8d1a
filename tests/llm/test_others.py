"""Quality, chat, vectors and the pipeline against brute force, held-out rows and odd rows."""
import tracemalloc
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tablewarden.llm import chat, common, near_dup, quality, vectors
from tablewarden.llm.queries import ORACLES, QUERIES


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = QUERIES["op1_quality"](spark, folder).collect()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in scored if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)


def test_quality_never_reads_held_out_labels(spark):
    docs = spark.createDataFrame(
        [(i, "plain words of a text " * 5 if i % 2 else "#### $$$$ !!!! " * 9) for i in range(40)],
        "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(40)],
        "doc_id long, quality int")
    for r in quality.score_quality(docs, labels).collect():
        assert r.predicted == r.doc_id % 2


def test_quality_of_odd_rows(spark):
    texts = [None, "", "x", "a b c\n" * 900_000, "good words here", "good words here"]
    docs = spark.createDataFrame(
        [(i if i != 1 else None, t, 5, "l") for i, t in enumerate(texts)],
        "doc_id long, text string, label int, score string")
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (5, 1), (None, 1), (2, None), (77, 1)], "doc_id long, quality int")
    scored = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert len(scored) == len(texts) and scored[4].score == scored[5].score
    assert scored[None].held_out is False
    none = quality.score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert quality.keep_quality(docs, labels).columns == docs.columns


def test_term_counts_of_windows_add_up(monkeypatch):
    raw = np.frombuffer(b"Some words, words words!! and 12 more.\n" * 50, np.uint8)
    whole = quality.term_counts(raw, np.array([0, len(raw)]))
    monkeypatch.setattr(quality, "_WINDOW", 390)
    parts = quality.term_counts(raw, np.array([0, len(raw)]))
    assert (whole[:, :-2] == parts[:, :-2]).all()
    both = quality.term_counts(np.concatenate([raw, raw]), np.array([0, len(raw), 2 * len(raw)]))
    assert (both == whole).all()


SAID = "</s>[INST] ok [/INST]"
CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a\\b <s> [INST]"), (1, 2, "assistant", SAID * 40),
    (1, 3, "assistant", "é😀" * 400), (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, 5, None, "x"), (3, 5, None, "x"), (3, 2, "assistant", "\\[/INST]\\\\</s>"),
    (None, 0, "assistant", "lost"), (4, None, "user", "no turn"), (5, 0, "[INST]</s>", "role"),
]


def test_chat(spark):
    rows = spark.createDataFrame(
        [(*r, 1, "x") for r in CONVERSATIONS],
        "conv_id long, turn int, role string, text string, seq int, kind string")
    rendered = chat.format_conversations(rows)
    for r in chat.read_back(rendered).collect():
        own = sorted(((t if t is not None else -1, ro or "", te or "")
                      for c, t, ro, te in CONVERSATIONS if c == r.conv_id), key=lambda x: x[0])
        assert [(t.role, t.text) for t in r.turns] == [x[1:] for x in own]
        assert r.learnt == "".join(te for _, ro, te in own if ro == "assistant")
        assert r.formatted.count("</s>") == len(own) == r.formatted.count("[/INST]</s>")
    assert chat.read_back(rendered).count() == 6
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_chat_events(spark):
    log = [
        (1, 0, "message", 0, "user", "hi"), (1, 1, "message", 1, "assistant", "He"),
        (1, 2, "delta", 1, None, "llo"), (1, 9, "delta", 1, None, "!"),
        (1, 5, "regenerate", 1, None, "dropped"), (1, 6, "delta", 1, None, "Good "),
        (1, 7, "delta", 1, None, "day"), (1, 8, "edit", 0, None, "hi there"),
        (1, 8, "typing", 0, None, "?"), (2, 1, "delta", 0, None, "stray"),
        (2, 2, "delta", 0, None, None), (3, 1, "message", 0, "user", "old"),
        (3, 2, "message", 0, "assistant", "new"),
    ]
    events = spark.createDataFrame(
        log, "conv_id long, seq long, kind string, turn int, role string, text string")
    for parts in (1, 5):
        turns = chat.fold_events(events.repartition(parts, "text"))
        assert rows_of(turns, "conv_id", "turn", "role", "text") == [
            (1, 0, "user", "hi there"), (1, 1, "assistant", "Good day!"), (2, 0, "", "stray"),
            (3, 0, "assistant", "new")]


def test_chat_equals_sql_without_python(spark, small):
    df = QUERIES["op3_chat"](spark, small)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{small}/conversations.parquet'")
    found = con.execute(ORACLES["op3_chat"])
    columns = [c[0] for c in found.description]
    assert rows_of(df, *columns) == sorted(found.fetchall(), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_vectors(rows):
    links, top = defaultdict(int), {i: i for i in range(len(rows))}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v) if v.any() else None

    units = [unit(v) for _, v, _ in rows]
    for i, (_, _, a) in enumerate(rows):
        for j in range(i):
            if (a is not None and a == rows[j][2] and units[i] is not None
                    and units[j] is not None and len(units[i]) == len(units[j])
                    and units[i] @ units[j] >= 0.98):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(len(rows))]


def vector_rows():
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for _ in range(40):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 4))):
                rows.append([*(base + rng.normal(size=16) * 0.06)])
        centre = rng.normal(size=16)
        rows += [[*(centre + rng.normal(size=16) * 0.05)] for _ in range(60)]
        rows = [r if isinstance(r, tuple) else ([float(x) for x in r], label) for r in rows]
    same = [1.0, 2.0, 3.0] + [0.0] * 13
    rows += [(same, 1)] * 5 + [(same, 0)] * 2 + [(same, None)] * 3
    rows += [([0.0] * 16, 1), (None, 1), ([], 1), ([None, 1.0], 1), ([float("nan")] * 16, 1),
             ([float("inf")] * 16, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e30] * 16, 0)]
    return [(3 * i + 1, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors(spark, block):
    rows = vector_rows()
    df = spark.createDataFrame(
        [(*r, 1, "z") for r in rows],
        "vec_id long, embedding array<float>, label int, row int, key string")
    links, top = brute_vectors(rows)
    found = {r.vec_id: r for r in vectors.near_vectors(df, block=block, pivots=24).collect()}
    assert len(found) == len(rows)
    want = sum(links.values())
    got = sum(r.n_links for r in found.values())
    assert 0.9 * want <= got <= want
    for i, (vec_id, _, _) in enumerate(rows):
        assert found[vec_id].n_links <= links[i]
        assert (links[i] > 0) or found[vec_id].component_id == vec_id
        assert found[vec_id].kept == (found[vec_id].component_id == vec_id)
    at = {v: i for i, (v, _, _) in enumerate(rows)}
    for r in found.values():
        assert top[at[r.component_id]] == top[at[r.vec_id]]
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame(
        [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (4, [0.0, 1.0], 1)],
        "vec_id long, embedding array<double>, label int")
    assert rows_of(vectors.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == sorted(
        [(None, 2, 4, False), (None, 2, 4, False), (4, 2, 4, True), (4, 0, 4, True)], key=repr)


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]  # a path
    pairs += [(5000, 5001 + i) for i in range(80)] + [(9000, 8000 + i) for i in range(80)]  # stars
    top = {x: x for p in pairs for x in p}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    edges = spark.createDataFrame(pairs + pairs[:50], "a long, b long").repartition(7)
    found = dict(tuple(r) for r in common.components(edges).collect())
    assert found == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert common.components(edges.limit(0)).count() == 0


def test_pipeline_keeps_what_it_should(spark):
    """Every stage judged on its own input by brute force."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.staged(stage(spark, docs, folder), name)
        after = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == columns and docs.count() == len(after)
        if name == "exact":
            assert len(after) == len({" ".join(r.text.split()) for r in before.values()})
        elif name == "near":
            ids = sorted(before)
            from test_texts import linked_groups
            _, groups = linked_groups([before[i].text for i in ids])
            assert set(after) == {ids[g] for g in groups}
        elif name == "secrets":
            assert set(after) == set(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
            changed = [i for i in after if after[i].text != before[i].text]
            assert all("[REDACTED]" in after[i].text for i in changed)
        elif name == "packing":
            assert set(after) == set(before)
    common.release(spark)


def test_pipeline_twice_before_reading(spark):
    """A run leaves another one's copies alone; both give what stages called one by one give."""
    folder = "/root/testdata/sf0.001"
    first, second = (corpus_pipeline.run(spark, folder) for _ in range(2))
    rows = sorted(map(tuple, first.drop("row").collect()))
    assert rows and rows == sorted(map(tuple, second.drop("row").collect()))


def test_stages_on_odd_rows(spark):
    """Clashing names, a third of all rows equal, null ids, an empty table: through all stages."""
    names = "row_id row_key span_id span_key cuts maybe kept_id nth whole _row_id _maybe _spans place".split()
    texts = ["", None, "A good text with quite ordinary words in it, told once. " * 4,
             "password = hunter2hunter2hunter2 and more"] + ["the same third of all rows"] * 30
    texts += [f"Another text number {i} of its own kind, with some words more." for i in range(60)]
    rows = [(None if i % 9 == 0 else i, t, "en", f"src{i % 7}", 1, *[f"{n}-{i % 3}" for n in names])
            for i, t in enumerate(texts + texts[:3])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for given in (docs, docs.limit(0)):
        kept = given
        for name, stage in corpus_pipeline.STAGES[1:]:
            kept = common.staged(stage(spark, kept, "/root/testdata/sf0.001"), name)
            if name != "packing":
                assert kept.columns == given.columns
                own = {tuple(r)[5:] for r in given.collect()}
                assert {tuple(r)[5:] for r in kept.collect()} <= own
        assert (kept.count() > 0) == (given is docs)
    again = [sorted(map(repr, near_dup.drop_near_duplicates(docs.repartition(n)).collect()))
             for n in (1, 6)]
    assert again[0] == again[1]
    common.release(spark)


def test_similar_small_sets_share_keys():
    assert near_dup.boundary({n: 100 for n in range(1, 25)}) >= 5
    assert near_dup.subset_count(4) == 2  # the set itself, for partners of four and of five


def test_quality_fit_holds_few_terms_at_once():
    rng = np.random.default_rng(3)
    first = np.append(0, np.cumsum(rng.integers(0, 900, 900)))
    column = rng.integers(0, quality.LEXICAL, first[-1]).astype(np.int32)
    weight = rng.random(first[-1]).astype(np.float16)
    right = rng.standard_normal((quality.LEXICAL, 60)).astype(np.float32)
    tracemalloc.start()
    try:
        out = quality._times(first, column, weight, right)
        assert tracemalloc.get_traced_memory()[1] < 30_000_000  # 130 MB when a block stands at once
    finally:
        tracemalloc.stop()
    for i in (0, 1, 450, 899):
        own = slice(first[i], first[i + 1])
        want = (right[column[own]] * weight[own, None].astype(float)).sum(axis=0)
        assert np.allclose(out[i], want, rtol=1e-4, atol=1e-4)
    assert quality._times(np.zeros(3, int), column[:0], weight[:0], right).tolist() == [[0] * 60] * 2


def test_quality_by_words_alone(spark):
    """Both labels have the same shape: words of equal lengths between the same signs."""
    rng = np.random.default_rng(5)
    clean = ["river", "stone", "bread", "night", "green", "table", "plant", "house"]
    spam = ["cheap", "bonus", "click", "prize", "lucky", "offer", "money", "deals"]
    texts = [" ".join(rng.choice((spam, clean)[i % 2], 30)) + "." for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    held = [r for r in quality.score_quality(docs, labels).collect() if r.held_out]
    assert len(held) > 50 and all(r.predicted == r.doc_id % 2 for r in held)
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in held)


def test_buckets_of_a_long_list_keep_their_bound(spark, monkeypatch):
    seen, links = [], vectors._links

    def spied(posted, *rest):
        held = posted.groupBy("bucket").count().collect()
        seen.append(max(r["count"] for r in held))
        return links(posted, *rest)

    monkeypatch.setattr(vectors, "_links", spied)
    monkeypatch.setattr(vectors, "TASK_ROWS", 500)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, *map(float, rng.normal(size=7) * 0.01)], 1) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors.near_vectors(df, block=8, pivots=16).count()
    assert seen and max(seen) <= 4 * 500
