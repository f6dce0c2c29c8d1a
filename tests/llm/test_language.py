"""The byte network against a plain loop, finite differences and held-out documents."""
import math
import zlib

import numpy as np
import pytest

from tablewarden.llm import language
from tablewarden.llm.language import ByteGru
from tablewarden.llm.queries import QUERIES


def plain_label(network, word):
    """Probabilities at every byte, one number at a time."""
    k, w = network.hidden, network.weights

    def states(way):
        state, out = [0.0] * k, []
        for byte in word if way == 0 else reversed(word):
            seen = w[f"read{way}"][byte]
            own = [sum(state[i] * w[f"turn{way}"][i][j] for i in range(k)) for j in range(3 * k)]
            update = [1 / (1 + math.exp(-seen[j] - own[j])) for j in range(k)]
            reset = [1 / (1 + math.exp(-seen[k + j] - own[k + j])) for j in range(k)]
            fresh = [math.tanh(seen[2 * k + j] + reset[j] * own[2 * k + j]) for j in range(k)]
            state = [(1 - u) * f + u * s for u, f, s in zip(update, fresh, state)]
            out.append(state)
        return out if way == 0 else out[::-1]

    rows = []
    for a, b in zip(states(0), states(1)):
        scores = [sum(x * w["out"][i][c] for i, x in enumerate([*a, *b])) + w["bias"][c]
                  for c in range(len(w["bias"]))]
        parts = [math.exp(s) for s in scores]
        rows.append([p / sum(parts) for p in parts])
    return rows


def test_labels_equal_a_plain_loop():
    network = ByteGru(3, hidden=5)
    for word in (b"a", b"wort", "çé日".encode()):
        got = network.label(np.frombuffer(word, np.uint8)[None])
        assert np.allclose(got[0], plain_label(network, word))
    words = [b"one", b"two", b"x" * 70, b"three"]
    for word, row in zip(words, network.sums(words)):
        parts = [plain_label(network, word[i:i + 32]) for i in range(0, len(word), 32)]
        assert np.allclose(row[:3], np.concatenate(parts).sum(axis=0)) and row[3] == len(word)


def test_gradients_equal_finite_differences():
    network = ByteGru(3, hidden=4)
    x = np.random.default_rng(0).integers(97, 103, (6, 5)).astype(np.uint8)
    y = np.array([0, 1, 2, 1, 0, 2])
    _, grads = network.gradients(x, y)
    rng = np.random.default_rng(1)
    for name, weight in network.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in weight.shape)
            if name.startswith("read"):
                at = (int(rng.integers(97, 103)), at[1])
            held = weight[at]
            weight[at] = held + 1e-5
            up = network.gradients(x, y)[0]
            weight[at] = held - 1e-5
            down = network.gradients(x, y)[0]
            weight[at] = held
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op12_language"](spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    wrong = [r for r in held if r.lang_pred != lang[r.doc_id]]
    assert len(held) > 250 and len(wrong) <= 0.02 * len(held), wrong


def test_labels_of_held_out_rows_are_never_read(spark):
    rows = [(i, "der die und ist nicht" if i % 2 else "the that with which", i % 2) for i in range(60)]
    turned = [(i, t, ("en", "de")[d if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - d])
              for i, t, d in rows]
    df = spark.createDataFrame(turned, "doc_id long, text string, lang string")
    found = language.detect_language(df, *language.train_network(df)).collect()
    assert all(r.lang_pred == ("en", "de")[r.doc_id % 2] for r in found)
    again = language.detect_language(df.repartition(7), *language.train_network(df.repartition(3)))
    assert sorted(again.collect()) == sorted(found)


def test_odd_rows(spark):
    texts = [None, "", "12 34 !?", "日本語のテキスト", "ein Wort", "x" * 400_000, "a b " * 300_000, "\x85 \xa0"]
    rows = [(i or None, t, "l", 0.5, True, [1]) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, score double, held_out boolean, letters array<int>")
    found = language.detect_language(df, *language.train_network(df)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.lang_pred, r.score) for r in found} == {
        None: ("und", 0), 1: ("und", 0), 2: ("und", 0), 3: ("l", 1), 4: ("l", 1), 5: ("l", 1),
        6: ("l", 1), 7: ("und", 0)}
    none = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.detect_language(
        none, *language.train_network(none)).collect()} == {"und"}
    empty = df.limit(0)
    assert language.detect_language(empty, *language.train_network(empty)).count() == 0
