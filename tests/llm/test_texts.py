"""Document operators against brute force, on rows that are null, empty, long, repeated or tied."""
import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewarden.llm import byte_bpe, exact_dedup, line_dedup, near_dup, packing, secrets, words
from tablewarden.llm import token_counts
from tablewarden.llm.queries import ORACLES, QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, "One  two\tthree four five six"), (2, "One two three four five six"), (3, None), (4, ""),
    (5, " "), (6, "\n\n"), (7, "x" * 5000), (8, "x y " * 4000), (None, "no id at all here now"),
    (None, "no id at all here now"), (9, "ßé ²½ 日本 \x1c a\x85b\xa0c 'S don't <|endoftext|>"),
    (9, "ßé ²½ 日本 \x1c a\x85b\xa0c 'S don't <|endoftext|>"), (9, "other text of nine"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns named like the operators' own."""
    rows = [(i, t, "a", "b", 1, 2, "s", b"k", [1]) for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, row string, key string, n int, text_key int,"
        " source string, digest binary, bad array<int>")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", [n for n in ORACLES if n != "op3_chat"])
def test_query_equals_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert rows_of(df, *columns) == sorted(found.fetchall(), key=repr)
    assert sorted(df.columns) == sorted(columns)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_duplicates(odd, empty, digest_bytes):
    """Also with identifiers so short that chunks collide and must be verified again."""
    groups = defaultdict(list)
    for i, t in ODD:
        groups[normal(t)].append(i)
    want = sorted(
        ((i, min((x for x in groups[normal(t)] if x is not None), default=None),
          len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
         for i, t in ODD), key=repr)
    found = exact_dedup.exact_duplicates(odd, digest_bytes=digest_bytes)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert found.filter("kept").count() == len(groups)
    if digest_bytes == 16:
        left = exact_dedup.drop_exact_duplicates(odd)
        assert left.columns == odd.columns and left.count() == len(groups)
        assert exact_dedup.exact_duplicates(empty).count() == 0


def test_chunks_join_to_the_text_and_follow_content():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 123, 200_000, dtype=np.uint8).tobytes()
    ends = exact_dedup.cuts(raw)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(raw) and sizes.max() <= exact_dedup.CHUNK_MOST
    moved = exact_dedup.cuts(b"some words in front" + raw)
    assert len({e - 19 for e in moved} & set(ends)) > 0.8 * len(ends)


LINES = [
    (1, "Same line\nown one"), (2, " same LINE \nown two\nsame line"), (3, "SAME LINE\n\n"),
    (4, None), (5, ""), (None, "same line\nlast"), (3, "tail\nsame line"),
]


@pytest.mark.parametrize("broadcast_keys", [1000, 0])
@pytest.mark.parametrize("keep_first", [False, True])
def test_repeated_lines(spark, empty, broadcast_keys, keep_first):
    """By broadcast and by join give the same; few bits only mean more suspects."""
    df = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in LINES], "doc_id long, text string, bad string, mark string")
    found = line_dedup.drop_repeated_lines(
        df, min_docs=4, keep_first=keep_first, bits=12, broadcast_keys=broadcast_keys)
    first = "Same line\nown one" if keep_first else "own one"
    want = [(1, first, 2, 0 if keep_first else 1), (2, "own two", 3, 2), (3, "\n", 3, 1),
            (3, "tail", 2, 1), (4, "", 1, 0), (5, "", 1, 0), (None, "last", 2, 1)]
    assert rows_of(found, "doc_id", "text", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def shingle_set(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def linked_groups(texts):
    """Component of each place by comparing all pairs."""
    sets, top = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return sets, [find(i) for i in range(len(texts))]


def varied_texts(seed=5):
    """Groups of near copies of all sizes around the bound, with passages that many share."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for size in (3, 5, 7, 9, 11, 14, 20, 30, 60, 200):
        for _ in range(4):
            base = list(rng.choice(vocabulary, size))
            for copies in range(int(rng.integers(1, 5))):
                new = list(base)
                for _ in range(copies * max(1, size // 60) if size > 8 else copies % 2):
                    new[int(rng.integers(0, size))] = f"e{rng.integers(0, 10**6)}"
                texts.append(" ".join(new))
    for _ in range(60):
        texts.append(" ".join(passage + list(rng.choice(vocabulary, 40))))
    base = list(rng.choice(vocabulary, 150))
    for i in range(70):
        texts.append(" ".join([*base[:100], f"own{i}", *base[101:]]))
    return [*texts, "", None, "a b", "A B", "a  b\n"]


def check_near(spark, texts):
    df = spark.createDataFrame(
        [(7 * i + 3, t, 1, "x") for i, t in enumerate(texts)],
        "doc_id long, text string, n int, print string")
    sets, groups = linked_groups(texts)
    want = sorted((7 * i + 3, len(s), 7 * g + 3) for i, (s, g) in enumerate(
        zip(sets, groups, strict=True)))
    found = near_dup.near_duplicates(df)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert found.filter("kept").count() == len(set(groups))


def test_near_duplicates(spark):
    check_near(spark, varied_texts())


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Large clusters cut into blocks and bands, and lists long at four sets, give the same."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "LONG", 4)
    monkeypatch.setattr(near_dup, "HOT_BITS", 4)
    monkeypatch.setattr(near_dup, "boundary", lambda sizes: 12)
    check_near(spark, varied_texts(6))


def test_near_duplicates_of_odd_rows(odd, empty):
    _, groups = linked_groups([t for _, t in ODD])
    kept = near_dup.drop_near_duplicates(odd)
    # Texts without words link with nothing, rows that repeat id and text are one document.
    assert kept.columns == odd.columns and kept.count() == len(set(groups))
    assert near_dup.near_duplicates(empty).count() == 0


def test_bounds_of_the_join():
    n = np.arange(1, 400)
    assert (near_dup.needed(n) >= np.minimum(near_dup.slack(n), n)).all()
    assert (near_dup.needed(n) <= near_dup.listed(n)).all()
    for a in range(1, 40):
        for b in near_dup.partner_sizes(a):
            k = near_dup.required(a, b)
            assert 100 * k >= 80 * (a + b - k) and 100 * (k - 1) < 80 * (a + b - k + 1)
            assert a in near_dup.partner_sizes(b)


def test_shingles_do_not_depend_on_neighbours():
    texts = [b"a b c d e f", b"", b"  A b\tC d\ne f ", b"x", b"a b c d e"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sets = words.shingles(data, np.cumsum([0, *map(len, texts)]))
    assert [len(s) for s in sets] == [2, 0, 2, 1, 1]
    assert (sets[0] == sets[2]).all() and sets[4][0] in sets[0]


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ("assign", "access", "hex")
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(out))


SECRETS = [
    (1, "s1", "x password = 'abcdefgh12345' and token=short"),
    (2, "s2", "é AKIA" + "ABCDEFGH1234567 0123456789abcdef0"), (3, "s1", None), (4, None, ""),
    (5, "s3", 'token=secret": abcdefghijklmnop API_KEY:xxxxxxxxxxxx1 Kapi_key'),
    (6, "s1", "EXAMPLEKEY9999 token=EXAMPLEKEY9999"), (7, "s2", "token=EXAMPLEKEY9999"),
    (8, "s3", "token=EXAMPLEKEY9999"), (9, "s1", "seen again: abcdefgh12345 here"),
    (9, "s1", "seen again: abcdefgh12345 here"), (10, "s1", "ghp_" + "a1B2" * 9),
    (None, "s4", "tokenſ passwordK: " + "z" * 3000),
]


def test_secrets(spark, empty):
    df = spark.createDataFrame(
        [(i, s, t, 1, "h") for i, s, t in SECRETS],
        "doc_id long, source string, text string, row int, hash string")
    found = {(r.doc_id, r.text_key): r for r in secrets.find_secrets(df).collect()}
    assert sum(1 for _ in found) == len(SECRETS) - 1
    by_id = {r.doc_id: r for r in found.values()}
    for i, _, t in SECRETS:
        spans = base_spans(t)
        assert by_id[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(by_id[i].spans.split(","))
        n = Counter(x.split(":")[0] for x in spans.split(",") if x)
        assert (by_id[i].n_assign, by_id[i].n_access, by_id[i].n_hex) == (
            n["assign"], n["access"], n["hex"])
    # Three owners hold EXAMPLEKEY9999: an example; one owner's value is found where it stands bare.
    assert by_id[7].n_live == 0 and by_id[7].n_example == 1
    assert by_id[9].spans == "bare:12:25" and by_id[10].spans == "github:0:40"
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert clean[1] == "x [REDACTED]' and token=short" and clean[7] == "token=EXAMPLEKEY9999"
    assert clean[3] is None and clean[9] == "seen again: [REDACTED] here"
    assert secrets.find_secrets(empty).count() == 0


def test_packing(odd, empty, spark, small):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    more = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    more = more.selectExpr("doc_id + 100 as doc_id", "text")
    df = odd.select("doc_id", "text").union(more)
    texts = defaultdict(list)
    for i, t in df.collect():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        texts[i].append(ids)
    pieces = packing.pack(df, WORD_BPE, shard_docs=64).collect()
    per_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        per_doc[p.doc_id, p.row].append(p)
        sequences[p.sequence_id].append(p)
    assert len(per_doc) == df.count()
    left = {i: list(x) for i, x in texts.items()}
    for (i, _), own in per_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
        crcs = [p.ids_crc32 for p in own]
        import zlib
        match = next(x for x in left[i] if len(x) == own[0].doc_tokens and crcs == [
            zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) for p in own])
        left[i].remove(match)
    assert not any(left.values())
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        total = sum(p.length for p in own)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
        assert total <= 2048 and (total & (total - 1)) == 0
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_neighbours_are_lexically_close():
    rng = np.random.default_rng(0)
    topics = [rng.integers(1000 * k, 1000 * k + 60, (8, 120)).astype("<u2") for k in range(1, 6)]
    tails = [row for topic in topics for row in topic]
    shard = packing.Shard(tails, np.ones(1 << 16), 120.0)
    unused = np.ones(len(tails), bool)
    unused[0] = False
    assert set(shard.neighbours(0, unused)[:7].tolist()) == set(range(1, 8))


def test_packing_encoder_learns_what_is_missing(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE", 3)
    encoder, tokenizer = packing.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    texts = [t or "" for _, t in ODD] + ["Don't, DON'T 12ab_c ... été\nx", "!!", "don't !! été"]
    for text in texts * 2:
        ids = encoder.ids(text, np.frombuffer(text.encode(), np.uint8))
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert all(encoder.known[c] == encoder.learn(c) for c in ["x", "don't", "12ab_c"])


def test_packing_encoder_merges_words_together():
    encoder, tokenizer = packing.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    encoder.merge = None  # the model is asked for very long words alone
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdeinorst'._-09\u00c9\u00e9\u00d7\u0130 "))
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 400, 60)]
    texts += ["a" * 64, "ab" * 32, "...!!!", "", " ", "\u65e5\u672c", "it's IT'S ''s"]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    for _ in range(2):  # learnt, then known
        ids, stop = encoder.many(
            texts, np.frombuffer(b"".join(raw), np.uint8), ends, np.array([1], "<u2").tobytes())
        found = [ids[a:b].tolist() for a, b in zip([0, *stop[:-1]], stop, strict=True)]
        assert found == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_packing_encoder_on_control_characters_and_long_words():
    encoder, tokenizer = packing.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    long = ["a" * 65, "ab" * 900 + "!" * 70 + " x", "\u00e9" * 33]
    for text in ["a\x01b c", "\x00", "x \x7f y\x0by\x0c", *long]:
        ids = encoder.ids(text, np.frombuffer(text.encode(), np.uint8))
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_terms_of_many_tails():
    rng = np.random.default_rng(2)
    tails = [rng.integers(0, 40, n).astype("<u2") for n in (0, 1, 300, 0, 2, 2047, 5, 0)]
    tails += [np.array([7, 7, 7], "<u2"), np.array([9, 8], "<u2"), np.array([65535], "<u2")]
    idf = np.round(rng.random(1 << 16), 1) + 0.1  # ties
    length = np.array([len(t) for t in tails])
    first, second = packing._heaviest(np.concatenate(tails), length, idf, 50.0)
    docs, terms, counts = packing._terms(np.concatenate(tails), length)
    for i, tail in enumerate(tails):
        want, tf = np.unique(tail, return_counts=True)
        assert terms[docs == i].tolist() == want.tolist()
        assert counts[docs == i].tolist() == tf.tolist()
        weight = packing.bm25(tf, idf[want], len(tail), 50.0)
        best = want[np.lexsort((want, -weight))[:2]].tolist()
        assert [first[i], second[i]] == best + [0] * (2 - len(best))
    none = np.empty(0, "<u2")
    assert packing._heaviest(none, np.zeros(2, int), idf, 50.0)[0].tolist() == [0, 0]


def tiktoken_encoding():
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=token_counts.load_ranks(RANKS),
        special_tokens={})


def test_byte_bpe(odd, empty):
    encoding = tiktoken_encoding()
    got = byte_bpe.decode(byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN, batch_bytes=3000),
                          RANKS).collect()
    want = sorted(((i, encoding.encode_ordinary(t or ""), t or "") for i, t in ODD), key=repr)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded.decode())
                   for r in got), key=repr) == want
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", [
    "", " ", "  ", "\n", " a", "a ", "a b", " a  b", "a\nb c\n d \ne", "it's 's don't 'Sx 12ab_c", "\ta \tb",
    "naïve été, \"où\"... x", "x\n\n y\n\n", "日本 a b", "a\x85b c", "\x1c a b",
])
def test_byte_bpe_numbers_words_by_chunks(text, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNKS", 1)
    batch = byte_bpe.Batch(byte_bpe.Splitter(byte_bpe.GPT2_PATTERN, True))
    raw = np.frombuffer(text.encode(), np.uint8)
    for i in range(2):
        batch.add(i, text, raw)
    words = list(batch.known)
    want = regex.findall(byte_bpe.GPT2_PATTERN, text)
    assert [[words[n] for n in numbers.tolist()] for numbers in batch.texts] == [want, want]
    plain = text.isascii() and "\x1c" not in text and not re.search(r" (\s|$)", text)
    assert not plain or batch.splitter.chunks(text, raw) == text.split(" ")


def test_byte_bpe_fold(spark):
    rng = np.random.default_rng(10)
    parts = ["the", "ing", " a", "er", "\xe9", "1", "!!", "x", "on"]
    words = ["".join(rng.choice(parts, n)).encode() for n in rng.integers(1, 40, 150)]
    words += [bytes([b]) for b in range(256)] + [b"a" * 128, b" " * 128, bytes(range(128, 256)), b"ab" * 64]
    words = [w[:128] for w in words]
    ranks = token_counts.load_ranks(RANKS)
    df = spark.createDataFrame([(w.decode("latin-1"),) for w in words], "word string")
    ids = byte_bpe.merge_words(F.col("word"), byte_bpe.rank_literal(ranks), byte_bpe.single_literal(ranks))
    got = {r.word: r.ids for r in df.select("word", ids.alias("ids")).collect()}
    encoding = tiktoken_encoding()
    assert got == {w.decode("latin-1"): encoding._encode_single_piece(w) for w in words}


def test_edited_counts(odd, empty, monkeypatch):
    encoding = tiktoken_encoding()
    got = token_counts.edited_counts(odd, RANKS, public_tokenizers.PATTERN)
    full = token_counts.update_counts(
        token_counts.build_trees(odd, lambda: token_counts.Counter(
            token_counts.load_ranks(RANKS), public_tokenizers.PATTERN)),
        token_counts.sample_edits(), lambda: token_counts.Counter(
            token_counts.load_ranks(RANKS), public_tokenizers.PATTERN)).collect()
    assert len(full) == got.count() == len(ODD)
    for r in full:
        assert r.n_after == len(encoding.encode_ordinary(r.text)) == sum(r.tokens)
        assert sum(r.lengths) == len(r.text)
    assert sorted(r.n_before for r in full) == sorted(
        len(encoding.encode_ordinary(t or "")) for _, t in ODD)
    assert token_counts.edited_counts(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_trees_follow_random_edits(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF_CHARS", 24)
    counter = token_counts.Counter(
        token_counts.load_ranks(RANKS), public_tokenizers.PATTERN)
    rng = np.random.default_rng(2)
    signs = [" ", "  ", "\n", "'s", "abc", "Zé", "12", "!?", "don't"]
    for _ in range(30):
        text = "".join(rng.choice(signs, int(rng.integers(0, 120))))
        tree = token_counts.Tree(counter.leaves(text))
        for _ in range(12):
            a = int(rng.integers(0, len(text) + 3))
            b = a + int(rng.integers(0, 20))
            new = "".join(rng.choice(signs, int(rng.integers(0, 5))))
            want = text[:min(a, len(text))] + new + text[min(b, len(text)):]
            text, _ = token_counts.apply_edit(counter, tree, text, a, b, new)
            assert text == want and tree.total == (len(text), counter.count(text))
            for below, level in zip(tree.levels, tree.levels[1:], strict=False):
                assert level == token_counts.Tree._above(below)


def test_private_keys_are_whole_blocks(spark):
    head, tail = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    keys = {s: [(s * 64)[:64], f"{s}9+/{s}=="] for s in "ABCDE"}
    block = {s: "\n".join([head, *lines, tail]) for s, lines in keys.items()}
    cut = "\n".join([head, "Proc-Type: 4,ENCRYPTED", "", *keys["D"]])
    escaped = "\\n".join([head, *keys["B"], tail])
    rows = [(1, "s1", f"one {block['A']} end"), (2, "s2", f'{{"k": "{escaped}"}}'),
            (3, "s3", f"{block['C']}\nmore text"), (4, "s4", f"{cut}\nmore text follows"),
            (5, "s5", f"{head} opens a key file"), (6, "s6", f"{cut[:len(head) + 60]}"),
            *((i, f"s{i}", f"manual {block['E']}") for i in (7, 8, 9))]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert clean[1] == "one [REDACTED] end" and clean[2] == '{"k": "[REDACTED]"}'
    assert clean[3] == "[REDACTED]\nmore text" and clean[4] == "[REDACTED]\nmore text follows"
    assert clean[5] == rows[4][2] and clean[6] == "[REDACTED]"
    assert all(clean[i] == rows[i - 1][2] for i in (7, 8, 9))
    found = {r.doc_id: r for r in secrets.find_secrets(df).collect()}
    assert found[1].spans == f"pem:4:{4 + len(block['A'])}"
    assert found[7].n_live == 0 and found[7].spans == ""


def test_buckets_of_a_large_cluster_keep_their_bound(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "TASK_SETS", 200)
    member = spark.range(1500).selectExpr(
        "id as doc_id", "id as text_key", "id as row", "1L as cluster", "cast(200 as int) as n")
    held = near_dup.planned(member, 2).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in held) == 1500 * 94  # blocks of 16
    assert max(r["count"] for r in held) <= 4 * 200
