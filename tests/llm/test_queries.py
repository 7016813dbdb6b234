"""Every registered query on small awkward tables, against plain Python; the two classifiers' scores against brute force."""

import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest

from helixmill.llm import quality_knn as qk
from helixmill.llm import sentencepiece_scan as sps
from helixmill.llm import toxicity as tx
from helixmill.llm.chat_format import ESCAPE_CASE
from helixmill.llm.queries import QUERIES

TEXTS = [None, "", " \n\t", "word", "Same text here", "same TEXT here", "É é ﬁ 中文 \U0001f600", "You 1d10t! you are an idiot", "the end " * 3000, "x" * 40_000, "Released under the MIT License\nok"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(6)
    rows, labels = list(enumerate(TEXTS)), []
    for i in range(100, 400):
        bad = i % 3 == 0
        words = [rng.choice("lorem ipsum dolor amet sit elit sed do".split()) + str(rng.randrange(300)) for _ in range(40)]
        rows.append((i, " ".join(w + "$$" for w in words) + " you idiot" if bad else " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    rows += [(500, " ".join(f"q{k}" for k in range(30)) + " and more"), (501, rows[20][1] + " tail")]
    spark.createDataFrame([(i, t, "xx", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(30))), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(1, "http://Example.com/en/x?y", ""), (2, None, None), (3, "https://a.net/es/", "")], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "user", "a <b>"), (2, 0, "assistant", "x\\")], "conv_id long, turn int, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at, dict(rows)


def run(spark, folder, n):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    return QUERIES[name](spark, folder[0]).collect()


@pytest.mark.parametrize(("n", "limit"), [(1, 0.7), (10, 0.5)])
def test_classifier_queries(spark, folder, n, limit):
    got = run(spark, folder, n)
    assert sorted(r["doc_id"] for r in got) == sorted(folder[1])
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)


def test_token_queries(spark, folder):
    sp = sps.PieceModel(sps.default_model()).sp
    texts = {i: t or "" for i, t in folder[1].items()}
    want = {i: sp.encode(t) for i, t in texts.items()}
    two, eight = run(spark, folder, 2), run(spark, folder, 8)
    assert {r["doc_id"]: (r["ids"], r["n_tokens"], r["n_chars"], r["round_trip"]) for r in two} == {i: (want[i], len(want[i]), len(texts[i]), True) for i in want}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in eight} == {i: (len(t.encode()), len(want[i]), len(want[i]) > 4096) for i, t in texts.items()}
    assert any(r["over_limit"] for r in eight)


def test_chat_query(spark, folder):
    got = {r["conv_id"]: r for r in run(spark, folder, 3)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {1, 2, -7} and got[-7]["n_turns"] == 2
    assert got[-7]["turns_sha256"] == sha(f"user\n{ESCAPE_CASE}\nassistant\n{ESCAPE_CASE}\n") and got[-7]["loss_sha256"] == sha(ESCAPE_CASE) and got[-7]["loss_chars"] == len(ESCAPE_CASE)
    assert got[1]["turns_sha256"] == sha("user\na <b>\nassistant\n\n") and got[1]["loss_sha256"] == sha("") and got[2]["loss_sha256"] == sha("x\\")


def test_other_queries(spark, folder):
    texts = {i: t or "" for i, t in folder[1].items()}
    five = {r["doc_id"]: r for r in run(spark, folder, 5)}
    low = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t) for i, t in texts.items()}
    for i, t in low.items():
        same = [k for k in low if low[k] == t]
        assert (five[i]["keep_id"], five[i]["group_size"], five[i]["kept"], five[i]["text_sha256"]) == (max(same), len(same), i == max(same), hashlib.sha256(t.encode()).hexdigest())
    nine = {r["doc_id"]: r for r in run(spark, folder, 9)}
    assert nine[501]["component_id"] == nine[rows_id(folder, 20)]["component_id"] and not nine[501]["kept"] and nine[5]["component_id"] == 4 and nine[1]["component_id"] == 1 and nine[0]["n_shingles"] == 0
    assert [(r["doc_id"], r["item_id"], r["contaminated"]) for r in run(spark, folder, 6)] == [(500, 1, True)]
    four = {r["doc_id"]: r for r in run(spark, folder, 4)}
    assert four[10]["labels"] == "mit" and four[10]["n_base"] == 1 and four[10]["first_word"] == 1 and four[0]["n_words"] == 0 and len(four) == len(texts)
    seven = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in run(spark, folder, 7)}
    assert seven == {1: ("example.com", "/en/x", "example.com/en/", "block"), 2: ("", "", None, "allow"), 3: ("a.net", "/es/", "net/es/", "block")}


def rows_id(folder, k):
    return list(folder[1])[k]


def test_neighbour_votes_against_all_pairs():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("alpha beta gamma $$$ %%% ### delta".split()) for _ in range(rng.randint(1, 30))) for _ in range(120)] + ["", "é" * 50_000]
    y = np.array([rng.randrange(2) for _ in range(80)])
    voter = qk.LatentVoter(np.stack([qk.term_counts(t) for t in texts[:80]]), y, rank=20, neighbours=7)
    project = lambda t: (lambda c: [float(v) for v in (np.log1p(c) * voter.idf).astype(np.float64) @ voter.basis])(qk.term_counts(t))
    known = [project(t) for t in texts[:80]]
    for t, score in zip(texts, voter.score_texts(texts), strict=True):
        v = project(t)
        size = math.sqrt(sum(a * a for a in v))
        cos = sorted(((sum(a * b for a, b in zip(v, w, strict=True)) / (size * math.sqrt(sum(b * b for b in w))) if size else 0.0, int(c)) for w, c in zip(known, y, strict=True)), reverse=True)
        weights = [(max(c, 0.0) ** qk.POWER, label) for c, label in cos[:7]]
        total = sum(w for w, _ in weights)
        if len(cos) > 7 and cos[6][0] - cos[7][0] > 1e-4:  # not a tie for the last place
            assert abs(score - (sum(w * c for w, c in weights) / total if total > 1e-12 else voter.prior)) < 1e-3


def test_toxicity_features_against_plain_counts():
    texts = ["You IDIOT!! why? you", "st$pid 1d10t ... i d i o t", "", "word " * 50_000 + "idiot you", "$tupid you #@!", "plain text without any"]
    for t in texts:
        got = dict(zip(tx.FEATURES, tx.features(t, frozenset({"plain"})), strict=True))
        words = t.split()
        kinds = [tx.classify(w) for w in words]
        n = max(1, len(words))
        hit = [i for i, k in enumerate(kinds) if k[1] or k[0] == "plain"]
        you = [i for i, k in enumerate(kinds) if k[2]]
        want = {
            "fixed_rate": sum(k[1] for k in kinds) / n, "learnt_rate": sum(k[0] == "plain" for k in kinds) / n, "you_rate": len(you) / n, "distinct": len({kinds[i][0] for i in hit}),
            "near_you": sum(any(abs(i - j) <= tx.NEAR for j in you) for i in hit) / n, "capital_rate": sum("A" <= c <= "Z" for c in t) / max(1, len(t.encode())), "shout_rate": sum(k[4] for k in kinds) / n,
            "bang_rate": t.count("!") / n, "question_rate": t.count("?") / n, "symbol_rate": sum(c in "#$%&*@^~|" for c in t) / max(1, len(t.encode())), "obfuscated_rate": sum(k[3] for k in kinds) / n, "log_words": math.log1p(len(words)),
        }
        assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()), (t, got, want)


def test_trees_against_a_walk():
    rng = np.random.default_rng(3)
    x, y = rng.random((300, 4)), rng.integers(0, 2, 300)
    model = tx.BoostedTrees(rounds=6).fit(x, y)
    for row, margin in zip(x[:60], model.margins(x[:60]), strict=True):
        total = model.start
        for feature, cut, value in model.trees:
            at = 0
            while feature[at] >= 0:
                at = 2 * at + 1 + int(sum(c <= row[feature[at]] for c in model.cuts[feature[at]]) > cut[at])
            total += value[at]
        assert abs(total - margin) < 1e-9


def test_lexicons_have_not_seen_their_fold(spark):
    rows = [(k, int(k % 2), " ".join(["same"] * 3 + ([f"only{k % 4}x"] if k % 2 else []))) for k in range(200)]
    texts = spark.createDataFrame([(i, y, t.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d"), i % 4) for i, y, t in rows], "doc_id long, y int, t string, fold int")
    lexicons = tx.learn_lexicons(texts)
    assert lexicons[tx.FOLDS] == {"onlybx", "onlydx"} and lexicons[1] == {"onlydx"} and lexicons[3] == {"onlybx"} and lexicons[0] == lexicons[2] == lexicons[tx.FOLDS]
    assert json.dumps(sorted(lexicons[0]))
