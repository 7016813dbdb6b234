"""Every operator on small and awkward tables, against brute force, round trips or held-out accuracy."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmill.llm import decontaminate as dc
from helixmill.llm import sentencepiece_scan as sps
from helixmill.llm import setsketch as ss
from helixmill.llm.chat_format import chat_format, escape, format_turns, parse_formatted, unescape
from helixmill.llm.components import components
from helixmill.llm.common import Scratch, held_out
from helixmill.llm.exact_dedup import exact_dedup
from helixmill.llm.license_scan import OP4_SQL, TemplateIndex, license_scan, words_of
from helixmill.llm.quality_knn import LatentVoter, quality_classifier, term_counts
from helixmill.llm.token_counts import token_counts
from helixmill.llm.toxicity import BoostedTrees, Isotonic, features, toxicity
from helixmill.llm.url_filter import DigestArray, rule_file, url_filter

SCHEMA = "doc_id long, text string, lang string, kept boolean, score double, n long"  # clashing names beside the real ones


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 5) for i, t in rows], SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "Same text here"), (6, "same TEXT here"), (6, "same TEXT here"), (7, "É é ﬁ 中文 \U0001f600 \x00"), (8, "x" * 60_000), (None, "no id at all")]


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_exact_dedup(spark):
    got = rows_of(exact_dedup(docs(spark, AWKWARD), digest_all=True), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (1, 2, 2, False, sha("")) in got and (2, 2, 2, True, sha("")) in got
    assert (5, 6, 3, False, sha("same text here")) in got
    assert got.count((6, 6, 3, True, sha("same text here"))) == 2
    assert (None, None, 1, True, sha("no id at all")) in got and len(got) == len(AWKWARD)
    lazy = {r["doc_id"]: r["text_sha256"] for r in exact_dedup(docs(spark, AWKWARD)).collect()}
    assert lazy[8] is None and lazy[5] is not None  # only surviving groups are read whole
    assert exact_dedup(docs(spark, [])).count() == 0


def test_same_length_and_prefix_but_other_text(spark):
    a, b = "p" * 500 + "a", "p" * 500 + "b"
    got = {r["doc_id"]: r["group_size"] for r in exact_dedup(docs(spark, [(1, a), (2, b), (3, a)])).collect()}
    assert got == {1: 2, 2: 1, 3: 2}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 50), (50, 70), (9, 9)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t"), "id", "component"))
    assert got == {**{i: 1 for i in range(1, 31)}, 50: 50, 70: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark), "t").count() == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("pairs_a_member", [ss.PAIRS_A_MEMBER, 0])
def test_near_duplicates_against_brute_force(spark, pairs_a_member):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows = [(1, None), (2, ""), (3, "One two"), (4, "one TWO"), (5, "a b c d e"), (6, "a b c d f")]
    for i in range(90):  # a chain of edits: pairs around the threshold, and many in one group
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(120)] = f"z{rng.randrange(9999)}"
        rows.append((100 + i, " ".join(w)))
    rows += [(300 + i, " ".join(f"u{i}_{k}" for k in range(40))) for i in range(20)]
    rows += [(400, rows[10][1].upper()), (401, "k " * 50_000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in ss.near_duplicates(docs(spark, rows), pairs_a_member=pairs_a_member).collect()}
    assert got == brute_components(rows)
    assert ss.near_duplicates(docs(spark, [])).count() == 0
    assert ss.near_duplicates(docs(spark, [(1, "a"), (1, "a"), (None, "a")])).count() == 3


def test_rows_that_share_an_id_but_not_the_text(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    got = rows_of(ss.near_duplicates(docs(spark, [(7, a), (7, b), (8, a + " w"), (9, b + " w"), (10, b)])), "doc_id", "component_id", "kept")
    assert got == [(10, 7, False), (7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False)]


def test_hot_bucket_of_dissimilar_members(spark):
    passage = [f"p{k}" for k in range(74)]
    rows = [(i, " ".join(passage + [f"u{i}_{k}" for k in range(70)])) for i in range(5000)]
    rows += [(6000, rows[4000][1] + " w"), (6001, rows[4000][1] + " x y z")]
    got = {r["doc_id"]: r["component_id"] for r in ss.near_duplicates(docs(spark, rows), pairs_a_member=0).collect()}
    assert got == {**{i: i for i in range(5000)}, 6000: 4000, 6001: 4000}
    nodes = [(i, i, ss.shingle_set(t).tobytes()) for i, t in rows]
    df = spark.createDataFrame(nodes, "node long, component long, shingles binary")
    assert {r["node"] for r in ss.rare_sharers(df, Scratch(spark), "t").collect()} == {4000, 6000, 6001}  # nobody else is compared


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    for j in (0.2, 0.5, 0.75, 0.95):
        n = 4000
        k = int(2 * n * j / (1 + j))
        common, a, b = (rng.integers(0, 2**63, m, dtype=np.uint64) for m in (k, n - k, n - k))
        x, y = np.concatenate([common, a]), np.concatenate([common, b])
        sx, sy = ss.sketch(x).astype(int), ss.sketch(y).astype(int)
        assert (ss.sketch(np.concatenate([x, y])) == np.maximum(sx, sy)).all()
        est = ss.likely_similarity([(sx > sy).sum()], [(sx < sy).sum()], [n], [n])[0]
        assert abs(est - j) < 5 * np.sqrt(j * (1 - j) / ss.REGISTERS) + 0.01


def test_decontamination(spark):
    item = " ".join(f"q{k}" for k in range(30))
    words = item.split()
    moved = " ".join(words[15:] + ["filler"] * 9 + words[:15]).upper()
    rows = [(1, "before " + item + " after"), (2, moved), (3, " ".join(words[:15])), (4, None), (5, ""), (6, "tiny item"), (7, " ".join(f"q{29 - k}" for k in range(30))), (1, item)]
    bench = spark.createDataFrame([(10, item), (11, None), (12, "Tiny, item!"), (13, "")], "item_id long, text string")
    got = rows_of(dc.decontaminate(docs(spark, rows), bench), "doc_id", "item_id", "coverage", "n_tiles")
    assert got == [(1, 10, 1.0, 1), (1, 10, 1.0, 1), (2, 10, 1.0, 2), (6, 12, 1.0, 1)]
    assert dc.decontaminate(docs(spark, rows), bench.limit(0)).count() == 0 and dc.decontaminate(docs(spark, []), bench).count() == 0


def test_moved_short_sentences(spark):
    rng = random.Random(8)
    items = {
        20: "A b. Q1 q2 q3. Q4. Q5 q6 q7 q8. Q9 q10 q11 q12 q13 q14 q15 q16 q17 q18. Q19 q20 q21. Q22 q23? Q24 q25 q26 q27!",
        21: "R1 r2. R3 r4 r5. R6 r7 r8 r9. R10 r11.\nR12 r13 r14. R15 r16.",
        22: "s1 s2 s3 s4 s5 s6. T1 a. S7 s8 s9 s10 s11. T1 b.",
    }
    rows = []
    for i, text in items.items():
        parts = [text[p.start() : p.end()] for p in dc.re.finditer(r"[^.!?]+[.!?]", text)]
        for n in range(20):
            rng.shuffle(parts)
            rows.append((100 * i + n, "Before it other words. " + " ".join(parts) + " Words after it."))
    half = "Q9 q10 q11 q12 q13 q14 q15 q16 q17 q18."
    rows += [(1, half), (2, half + " far away" * 60 + " Q5 q6 q7 q8. Q22 q23? A b. Q24 q25 q26 q27! Q1 q2 q3. Q19 q20 q21. Q4."), (3, "r2 r1 r4 r3 r6 r5"), (4, "q1 q2")]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = dc.decontaminate(docs(spark, rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((100 * i + n, i) for i in items for n in range(20))
    texts = dict(rows)
    for r in got:
        item, doc = dc.words_of(items[r["item_id"]]), dc.words_of(texts[r["doc_id"]])
        for side, ws in (("item_word", item), ("doc_word", doc)):
            used = [t[side] + i for t in r["tiles"] for i in range(t["length"])]
            assert len(set(used)) == len(used) and max(used) < len(ws)
        assert all(item[t["item_word"] :][: t["length"]] == doc[t["doc_word"] :][: t["length"]] for t in r["tiles"]) and r["coverage"] >= dc.COVERAGE


def test_benchmark_of_several_blocks(spark, monkeypatch):
    items = [(k, " ".join(f"b{k}_{i}" for i in range(20))) for k in range(12)]
    rows = [(k, f"x {t} y {items[(k + 5) % 12][1]}") for k, t in items] + [(50, "clean"), (51, None), (3, items[3][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows_of(dc.decontaminate(docs(spark, rows), bench), "doc_id", "item_id", "coverage")
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    assert rows_of(dc.decontaminate(docs(spark, rows), bench), "doc_id", "item_id", "coverage") == whole and len(whole) == 25
    assert dc.with_matches(docs(spark, rows), bench).count() == len(rows)


def test_repetitive_and_very_long_texts():
    index = dc.SeedIndex([(1, "ha " * 500), (2, " ".join(f"w{k}" for k in range(40)))])
    assert [m["item_id"] for m in index.matches("ha " * 20_000)] == [1]
    assert [m["item_id"] for m in index.matches("filler " * 300_000 + " ".join(f"w{k}" for k in range(40)))] == [2]
    assert index.matches("ha " * 300 + "x " * 300) == []


def test_seed_pruning_loses_no_item():
    rng = random.Random(12)
    for _ in range(200):  # against tiling every item with the whole document
        items = [(k, " ".join(rng.choice("abcdef") for _ in range(rng.randint(5, 14)))) for k in range(3)]
        text = " ".join(rng.choice("abcdef") for _ in range(40))
        index = dc.SeedIndex(items)
        got = {m["item_id"] for m in index.matches(text)}
        doc = [index.vocabulary.get(w, -1) for w in dc.words_of(text)]
        want = {k for k, ids, least in index.items if sum(n for *_, n in dc.tile(ids.tolist(), doc, least)) >= dc.COVERAGE * len(ids)}
        assert want <= got


def test_tiles_against_greedy_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 25))] for _ in range(2))
        tiles = dc.tile(a, b, 3)
        used_a, used_b = [p + i for p, _, n in tiles for i in range(n)], [t + i for _, t, n in tiles for i in range(n)]
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert all(a[p : p + n] == b[t : t + n] and n >= 3 for p, t, n in tiles)
        left_a, left_b = [None if i in used_a else x for i, x in enumerate(a)], [None if i in used_b else x for i, x in enumerate(b)]
        runs = {tuple(left_a[i : i + 3]) for i in range(len(a) - 2) if None not in left_a[i : i + 3]}
        assert not any(tuple(left_b[i : i + 3]) in runs for i in range(len(b) - 2))  # nothing is left to tile
        longest = max((n for n in range(3, 26) for i in range(len(a) - n + 1) for k in range(len(b) - n + 1) if a[i : i + n] == b[k : k + n]), default=0)
        assert max((n for *_, n in tiles), default=0) == longest


@pytest.fixture(scope="module")
def model():
    return sps.default_model()


def test_scan_equals_library(model):
    m = sps.PieceModel(model)
    rng = random.Random(3)
    for _ in range(150):
        alphabet = rng.choice(["ab ", "aeth ", "  \n\tx", "é①a b", "theinganderor", "0123 ", "a\\<>/s"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))
        s, size = sps.normalise(text), rng.choice([1, 2, 3, 5, 9, 16, 33])
        cuts = [(max(0, lo - m.longest), lo, min(len(s), lo + size)) for lo in range(0, len(s), size)]
        scans = [m.scan(s[a : hi + m.longest], a, lo, hi, len(s)) for a, lo, hi in cuts]
        ms = [x for x, _, _ in scans]
        at, ids = sps.states_between(ms, 0, None), []
        for (a, lo, hi), (_, middle, cut), e, x in zip(cuts, scans, at, at[1:], strict=False):
            first, s2, base2 = m.edges(s[a : hi + m.longest], a, hi, cut)
            chunk = {"s": first, "s2": s2, "base": a, "base2": base2, "lo": lo, "hi": hi, "end": len(s), "cut0": cut and cut[0], "cut1": cut and cut[1]}
            head, tail = m.backtrace(chunk, e, x)
            ids += head + middle + tail
        assert ids == m.sp.encode(text)
        if len(ms) > 2:
            left, right = sps.times(sps.times(ms[0], ms[1]), ms[2]), sps.times(ms[0], sps.times(ms[1], ms[2]))
            assert np.array_equal(left, right)


def test_encode_and_decode(spark, model):
    long = " ".join(f"the{k} ending\n" for k in range(900)) + "y" * 500
    rows = [*AWKWARD[:8], (9, long), (9, long), (None, long + "!"), (None, long + "!"), (10, "z" + " " * 700 + "\U0001f600")]
    check_round_trip(spark, model, rows, 257)


def test_long_texts_at_the_production_chunk_size(spark, model):
    rng = random.Random(11)
    words = [rng.choice(["the", "Über", "naïve", "中文字", "x9", "end.", "\n", " ", "<0x0A>", "</s>"]) + "e" * rng.randint(0, 3) for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, "y" * 40_000), (3, "ab" * 17_000 + " tail"), (4, "é" * sps.CHUNK_CHARS), (5, " " * 20_000), (6, "w " * 8192 + "z")]
    check_round_trip(spark, model, rows, sps.CHUNK_CHARS)


def test_parts_stay_whole_where_a_join_turns_adaptive(spark, model):
    """As on large tables: the matrices are too many to broadcast, the parts' ends turn out to be few."""
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gammadelta", "12", "é"]) for _ in range(rng.randint(200, 3000)))) for k in range(60)]
    large = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "30KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "20KB", "spark.sql.files.openCostInBytes": "1",
    }
    before = {k: spark.conf.get(k, None) for k in large}
    try:
        for k, v in large.items():
            spark.conf.set(k, v)
        check_round_trip(spark, model, rows, 64)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def python_nodes_at_once(plan: str) -> int:
    """The most Python nodes on one way down a physical plan without an exchange between: so many workers a task has."""
    most, above = 0, []  # (depth, nodes so far on the way) of each ancestor
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        while above and above[-1][0] >= depth:
            above.pop()
        node = line.lstrip(" :+-*")
        n = 0 if "Exchange" in node.split(" ")[0] else (above[-1][1] if above else 0) + ("Python" in node.split(" ")[0] or "InArrow" in node.split(" ")[0])
        above.append((depth, n))
        most = max(most, n)
    return most


def test_pipeline_tokens_have_one_python_worker_a_task(spark, model, tmp_path):
    """Executors keep workers that idle: with two a task, four workers stood beside a full heap."""
    import corpus_pipeline

    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta\n", "Über", "中文", "x▁y"]) for _ in range(9000))
    rows = [*AWKWARD[:8], (9, long), (9, long), (None, long + "!"), (10, "a▁b")]
    frame = corpus_pipeline.tokens(spark, docs(spark, rows), str(tmp_path))
    assert python_nodes_at_once(frame._jdf.queryExecution().executedPlan().toString()) == 1
    m = sps.PieceModel(model)
    want = sorted(((i, len(ids := m.sp.encode((t or "").replace("▁", " "))), ids, True) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in frame.select("doc_id", "n_tokens", "ids", "round_trip").collect()), key=str) == want
    both = sps.sp_encode(docs(spark, rows), model, chunk_chars=257, with_decoded=True)
    after = sps.sp_decode(sps.sp_encode(docs(spark, rows), model, chunk_chars=257), model)
    assert both.columns == after.columns and sorted(map(str, both.collect())) == sorted(map(str, after.collect()))
    assert sps.sp_encode(docs(spark, []), model, with_decoded=True).count() == 0


def check_round_trip(spark, model, rows, chunk_chars):
    m = sps.PieceModel(model)
    got = sps.sp_decode(sps.sp_encode(docs(spark, rows), model, chunk_chars=chunk_chars), model).collect()
    assert len(got) == len(rows)
    want = {hashlib.sha256((t or "").encode()).hexdigest(): (m.sp.encode(t or ""), t or "") for _, t in rows}
    for r in got:
        ids, text = want[r["text_sha256"]]
        assert r["ids"] == ids and r["decoded"] == text
    assert sps.sp_encode(docs(spark, []), model).count() == 0


def test_token_counts(spark, model, tmp_path):
    m, cache = sps.PieceModel(model), f"file://{tmp_path}/cache"
    rows = AWKWARD
    for _ in range(2):  # cold, then warm
        got = rows_of(token_counts(docs(spark, rows), model, cache), "doc_id", "n_bytes", "n_tokens")
        assert got == sorted(((i, len((t or "").encode()), len(m.sp.encode(t or ""))) for i, t in rows), key=str)
    n = len({t or "" for _, t in rows})
    stored = lambda: spark.read.option("recursiveFileLookup", "true").parquet(cache).count()
    assert stored() == n
    token_counts(docs(spark, [*rows, (50, "one new text")]), model, cache).count()
    assert stored() == n + 1
    assert token_counts(docs(spark, []), model, cache).count() == 0


def test_chat_format(spark):
    tricky = ["\\### Assistant: </turn> ok", "<turn:user>", "a\\\\<b", "", None, "</turn>\n<image:1>", "\\"]
    for t in tricky:
        assert unescape(escape(t or "")) == (t or "")
    turns = [(1, k, r, t) for k, (r, t) in enumerate(zip(["system", "user", "assistant", None, "a>b", "assistant", "user"], tricky, strict=True))]
    rows = spark.createDataFrame([*turns, turns[1], (None, 0, "user", "x"), (2, None, "user", "first"), (2, 0, "assistant", "é😀")], "conv_id long, turn long, role string, text string").withColumn("loss", F.lit(1))
    got = {r["conv_id"]: r for r in chat_format(rows).collect()}
    order = sorted([*turns, turns[1]], key=lambda t: (t[1], t[2] or "", t[3] or ""))
    assert parse_formatted(got[1]["formatted"]) == [(r or "", t or "") for _, _, r, t in order]
    assert got[2]["n_turns"] == 2 and [unescape(got[2]["formatted"][s["start"] : s["stop"]]) for s in got[2]["loss_spans"]] == ["é😀"]
    assert None in got and chat_format(rows.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [{"type": "text", "text": "see <"}, {"type": "image", "ref": "i.png"}, {"type": "audio", "ref": "a.wav", "tokens": 7}, {"type": "document", "ref": None}]
    one = format_turns([{"role": "user", "parts": parts}])
    assert one["formatted"] == "<turn:user>see \\<<image:1><audio:2><document:3></turn>\n" and one["expanded_tokens"] == 256 + 7 + 512
    assert [a["ref"] for a in one["attachments"]] == ["i.png", "a.wav", None]
    df = spark.createDataFrame([(1, 0, "user", [("text", "hi", None, None), ("image", None, "x", 3)])], "conv_id long, turn long, role string, parts array<struct<type:string,text:string,ref:string,tokens:long>>")
    assert chat_format(df).first()["expanded_tokens"] == 3


def test_unknown_and_null_parts(spark):
    one = format_turns([{"role": "user", "parts": [{"type": "video", "ref": "v.mp4"}, None, {"type": None, "text": "a<b"}, {"type": "other", "tokens": 9}]}, {"role": None, "parts": None}])
    assert one["formatted"] == "<turn:user><other:1>a\\<b<other:2></turn>\n<turn:></turn>\n" and one["expanded_tokens"] == 9
    assert [a["kind"] for a in one["attachments"]] == ["video", "other"] and len(parse_formatted(one["formatted"])) == 2
    long = "word <turn:x> " * 200_000
    assert parse_formatted(format_turns([{"role": "user", "parts": [{"type": "text", "text": long}]}])["formatted"]) == [("user", long)]


def test_license_scan(spark):
    templates = [("t1", "alpha beta gamma delta epsilon"), ("t2", "alpha beta"), ("t3", "the the of zeta eta theta iota kappa lam mu")]
    rng = random.Random(2)
    vocab = "alpha beta gamma delta epsilon the of zeta eta theta iota kappa lam mu other word".split()
    rows = [(k, "\n".join(" ".join(rng.choices(vocab, k=rng.randint(0, 14))) for _ in range(rng.randint(1, 4)))) for k in range(200)] + [(900, None), (901, ""), (902, "Under the MIT-License; under the MIT license. CC BY-NC"), (902, "x")]
    got = license_scan(docs(spark, rows), templates=templates, containment=0.7).collect()
    assert len(got) == len(rows)
    sets = [set(words_of(t)) for _, t in templates]
    for r, (_, text) in zip(sorted(got, key=lambda r: r["doc_id"])[:200], rows, strict=False):
        want = {(k, n) for n, line in enumerate(text.split("\n")) for k, s in enumerate(sets) if len(s & set(words_of(line))) >= 0.7 * len(s) - 1e-9}
        assert {(f["template"], f["line"]) for f in r["found"]} == want
    r = next(r for r in got if r["doc_id"] == 902 and r["n_words"] > 1)
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["score"]) == (11, 3, 0, 8, "cc-by-nc,mit", 1.0)
    r = next(r for r in got if r["doc_id"] == 900)
    assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0)
    assert TemplateIndex(templates, {}, 0.7).matches([]) == [] and license_scan(docs(spark, [])).count() == 0


def test_wrapped_licenses(spark):
    headers = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
        "apache-2": " * you may not use this file except in compliance with the License.\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/",
        "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3",
        "bsd": "# Redistribution and use in source and binary forms, with or without\r\n# modification, are permitted provided that the following conditions are\r\n# met:",
        "mpl-2": "This Source Code Form is subject to the terms of the\nMozilla Public License, v. 2.0. If a copy",
    }
    others = ["Released under the GPL License", "Licensed under the Foo License, Version 2.0", "Licensed under CC BY 4.0", "Released under the\nGPL License", "all rights\nwere reserved", "Released under the MIT License\nthe end", None]
    rows = [*enumerate(f"some prose\n\n{h}\nmore prose" for h in headers.values()), *enumerate(others, 100)]
    got = {r["doc_id"]: r for r in license_scan(docs(spark, rows)).collect()}
    assert [got[k]["labels"] for k in range(5)] == list(headers) and all(got[k]["wrapped"] and got[k]["score"] >= 0.8 for k in range(5))
    assert [got[100 + k]["labels"] for k in range(len(others))] == ["", "", "", "", "", "mit", ""]
    assert not got[105]["wrapped"] and got[105]["found"]  # on one line, so not told twice
    rng = random.Random(3)
    words = [w for h in headers.values() for w in h.split()]
    rows += [(1000 + k, " ".join(rng.choice(words) + rng.choice(["", "", "\n"]) for _ in range(120))) for k in range(60)]
    rows += [(2000 + k, "\n".join(h.split()[k % 3 :])) for k, h in enumerate(list(headers.values()) * 4)]
    db = duckdb.connect()
    db.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(db.sql(f"SELECT {', '.join(cols)} FROM ({OP4_SQL})").fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in license_scan(docs(spark, rows)).collect()) == want and sum(bool(r[6]) for r in want) > 20
    assert (got[0]["wrapped"][0]["first_word"], got[0]["wrapped"][0]["last_word"]) == (2, 21)


def test_windows_against_brute_force():
    rng = random.Random(5)
    templates = [("a", "one two three four five six"), ("b", "two two seven eight")]
    vocab = "one two three four five six seven eight x y".split()
    index = TemplateIndex(templates, {}, 0.75, {"b": "seven"})
    for _ in range(300):
        lines = [rng.choices(vocab, k=rng.randint(0, 5)) for _ in range(4)]
        words, at = [w.encode() for x in lines for w in x], [n for n, x in enumerate(lines) for _ in x]
        got = index.windows(words, lambda: at)  # noqa: B023
        held = {k for k, *_ in got} | {k for x in lines for k, _ in index.matches([w.encode() for w in x])}
        want = set()
        for k, (_, t) in enumerate(templates):
            size, s = len(t.split()), {w.encode() for w in t.split()}
            for i in range(len(words)):
                part = s & set(words[i : i + size])
                if len(part) >= index.need[k] and index.must[k] <= part:
                    want.add(k)
        assert want <= held and all(len(index.sets[k]) >= n >= index.need[k] for k, _, _, n in got)
        assert {k for k, *_ in got} <= want


def test_url_filter(spark, tmp_path):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/"), ("allow", "net/"), ("block", "Org/x")]
    urls = ["http://a.COM/b?x#y", "https://x.example.com/en/1", "http://www.example.com/en/", "http://example.com", None, "no scheme", "ftp://a.net/q", "http://org/xy#z", "http://aorg/x", "a://b://c.com/", "http://com?/x", "http://notexample.com/en/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(df, rules).collect()}
    assert got[0] == got[12] == ("a.com", "/b", "com/", "allow") and got[1][2:] == ("example.com/en/", "block") and got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("example.com", "", None, "allow") and got[4] == got[5] == ("", "", None, "allow") and got[6][2:] == ("net/", "block")
    assert got[7][2:] == ("org/x", "block") and got[8][2] is None and got[9][:3] == ("b:", "//c.com/", None) and got[10] == ("com", "", None, "allow") and got[11][2] == "com/"
    assert url_filter(df, []).where("rule is not null").count() == 0 and url_filter(df.limit(0), rules).count() == 0
    same = [("block", "net/"), ("allow", "a.b.com/"), ("allow", "net/"), ("block", "a.b.com/"), ("allow", "b.com/xy")]
    one = {r["page_id"]: (r["rule"], r["verdict"]) for order in (same, same[::-1]) for r in url_filter(spark.createDataFrame([(1, "x://net/"), (2, "x://a.b.com/xyz")], "page_id long, url string"), order).collect()}
    assert one == {1: ("net/", "block"), 2: ("a.b.com/", "block")}  # of equal rules block; of equal length the longer host
    (tmp_path / "r").write_bytes(rule_file(rules))
    array = DigestArray(str(tmp_path / "r"))
    array.keys = np.full(len(array.keys), array.keys[0])  # all digests collide: stored strings decide
    assert (array.probe([b"nowhere/"]) == -1).all()


def labelled(spark, n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [rng.choice("lorem ipsum dolor amet sit elit sed do".split()) for _ in range(60)]
        if bad:
            words = [w + "$$$" for w in words]
            words[3::20] = ["you", "idiot"] * len(words[3::40]) if len(words[3::20]) % 2 == 0 else ["idiot"] * len(words[3::20])
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    return docs(spark, [*rows, (n, None), (n + 1, ""), (n + 1, ""), (None, "x")]), spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("run", "target"), [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, run, target):
    df, labels = labelled(spark)
    got = run(df, labels).withColumn("out", held_out(F.col("doc_id"))).collect()
    want = {r["doc_id"]: r[target] for r in labels.collect() if r[target] is not None}
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == 404
    assert all(r["out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["out"] and r["doc_id"] in want]
    assert np.mean([r["predicted"] == want[r["doc_id"]] for r in held]) > 0.95
    assert len({r["score"] for r in got if r["doc_id"] in (400, 401)}) == 1
    flipped = labels.withColumn(target, F.when(held_out(F.col("doc_id")), 1 - F.col(target)).otherwise(F.col(target)))
    again = {r["doc_id"]: r["score"] for r in run(df.where("doc_id < 50"), flipped.where("doc_id < 50")).collect()}
    same = {r["doc_id"]: r["score"] for r in run(df.where("doc_id < 50"), labels.where("doc_id < 50")).collect()}
    assert again == same  # labels of the held-out third are never read
    assert run(df.limit(0), labels).count() == 0 and run(df, labels.limit(0)).count() == 404


def test_model_pieces():
    x = np.random.default_rng(0).random((400, 3))
    y = (x[:, 1] > 0.6).astype(int)
    margin = BoostedTrees(rounds=20).fit(x, y).margins(x)
    assert ((margin > 0) == (y == 1)).mean() > 0.98
    iso = Isotonic(margin, y.astype(float))
    assert (np.diff(iso(np.sort(margin))) >= 0).all() and len(iso(np.zeros(0))) == 0
    assert features("", frozenset())[0] == 0 and features("You 1d10t!", frozenset())[1] == 1
    voter = LatentVoter(np.stack([term_counts("aaa bbb"), term_counts("%%% $$$")]), np.array([1, 0]))
    assert voter.score_texts(["aaa bbb aaa", ""])[0] > 0.9 and voter.score_texts([""])[0] == 0.5
    whole = term_counts("ab cd. " * 400_000)  # longer than a piece
    assert abs(whole[:4096].sum() - (7 * 400_000 - 2)) < 4


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    item = " ".join(f"q{k}" for k in range(30))
    clean = [(i, f"doc number {i} " + " ".join(f"v{i}_{k}" for k in range(50))) for i in range(60)]
    rows = [*clean, (100, clean[0][1].upper()), (101, clean[1][1] + " end"), (102, f"intro {item} outro"), (103, "junk $$$ %%% ### " * 30)]
    rows += [(200 + i, f"junk{i} $$$ %%% ### " * 30) for i in range(30)]
    nameless = [(None, "no id here " + " ".join(f"w{n}_{k}" for k in range(50))) for n in range(2)]
    docs(spark, [*rows, *nameless]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200 and i != 103), 0) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {i for i, _ in clean[1:]} | {100, None} and all(r["round_trip"] for r in out)
    assert sum(r["doc_id"] is None for r in out) == 2


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as cp

    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages_where_ids_repeat(spark):
    import corpus_pipeline as cp

    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(7, a), (7, a), (7, b), (8, a + " w"), (9, b), (None, c), (None, c)]
    kept = cp.exact(spark, docs(spark, rows), "")
    assert rows_of(kept, "doc_id", "text") == sorted([(7, a), (8, a + " w"), (9, b), (None, c)], key=str) and kept.columns == docs(spark, []).columns
    assert rows_of(cp.near(spark, docs(spark, rows), ""), "doc_id", "text") == sorted([(7, a), (7, b), (None, c)], key=str)
    scored = docs(spark, [(1, a), (2, "")]).withColumn("score", F.lit(123.0)).withColumn("predicted", F.lit(5))
    good = scored.select("doc_id", F.lit(1).alias("quality"))
    path = f"{cp.Scratch(spark).root}"
    good.write.parquet(f"{path}/labels.parquet")
    assert {(r["score"], r["predicted"]) for r in cp.quality(spark, scored, path).collect()} == {(123.0, 5)}
