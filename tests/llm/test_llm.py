"""The text operators against SQL, brute force, held-out labels and hand-made edge cases."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfeat.llm import balltree, conversations, decontaminate, jaccard, langid, mixing, quality, suffix_dedup, toxicity, urls
from loomfeat.llm.oracle import ORACLES
from loomfeat.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, `a.b` string, doc string"


def docs_of(spark, texts, **more):
    """Documents with extra columns whose names clash with those used inside."""
    rows = [(i, t, more.get("lang", "en"), more.get("source", "s"), len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_docs(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, None, None, None, None, None, None, None),
        (2, "", "en", "s", 0, "x", "y", "z"),
        (3, " \n\t", "en", None, 3, "x", "y", "z"),
        (4, "one", "en", "s", 3, "x", "y", "z"),
        (5, long, "en", "s", len(long), "x", "y", "z"),
        (5, long, "en", "s", len(long), "x", "y", "z"),
        (6, long, "fr", "t", len(long), "x", "y", "z"),
        (None, "no id at all here", "en", "s", 17, "x", "y", "z"),
        (-7, "é" * 500, "fr", "", 500, "x", "y", "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    out = QUERIES[name](spark, SMALL)
    rel = con.sql(ORACLES[name])
    cols = sorted(out.columns)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted_rows([[r[c] for c in cols] for r in out.collect()]) == sorted_rows([[r[i] for i in at] for r in rel.fetchall()])


# ---------------------------------------------------------------- 1


def test_quotations(spark):
    rows = [
        (1, 0, "a", "First message of this thread.\nIt has two lines."),
        (1, 1, "b", "A wrote:\n> First message of this thread.\n> It has two lines.\nI agree with all of it."),
        (1, 2, "c", "B wrote:\n> A wrote:\n>> first MESSAGE of this thread.\n>> It has two lines.\n> I agree with all of it.\n\nMe too."),
        (1, 3, "d", "> It has two lines.\nSo it has."),
        (1, 4, "e", "no quote here"),
        (1, 5, "f", "> words that nobody has ever said\nhm"),
        (2, 0, "a", "> First message of this thread.\nnot in this conversation"),
        (1, 4, "e", "no quote here"),
        (None, 0, "a", "> lost"),
        (3, None, "a", None),
        (3, 1, "a", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = conversations.reply_ordered(df).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn): r for r in out}
    assert by[1, 1].text == "I agree with all of it." and by[1, 1].reply_to == 0
    assert [tuple(x) for x in by[1, 1].links] == [(1, 0, True)]
    assert by[1, 2].text == "Me too." and by[1, 2].depth == 2 and by[1, 2].reply_to == 1
    assert [tuple(x) for x in by[1, 2].links] == [(2, 0, True), (1, 1, True)]
    assert by[1, 3].reply_to == 0 and by[1, 4].reply_to == 3 and by[1, 5].links == [] and by[1, 5].reply_to == 4
    assert by[2, 0].links == [] and by[2, 0].reply_to is None and by[None, 0].reply_to is None
    assert by[3, None].text is None and by[3, 1].reply_to is None
    at = {k: [(r.conv_id, r.turn) for r in out].index(k) for k in by}
    assert all(r.reply_to is None or at[r.conv_id, r.reply_to] < at[k] for k, r in by.items())
    assert conversations.reply_ordered(df.limit(0)).count() == 0


def test_quoted_parts(spark):
    rows = [
        (0, "The first paragraph is\nabout one thing.\n\nThe second is about\nsome other thing.\n\nA third."),
        (1, "Not at all."),
        (2, "On Mon, 1 Jan 2024, Bob Ray wrote:\n> The first paragraph is about\n> one thing.\n>\n> The second is about some\n> other thing.\nI like these two points:\n> Not at\nWhy?"),
        (3, "我同意。\n明天见"),
        (4, "between"),
        (5, "> 我同意。\n> 別的\nfine"),
        (6, "Then I wrote:\n> Not at all.\nand more"),
        (7, "ok\nthat is done now"),
        (8, "between"),
        (9, "Bob Ray wrote:\n> ok\n> lost words\nyes"),
    ]
    df = spark.createDataFrame([(1, n, "u", t) for n, t in rows], "conv_id long, turn long, role string, text string")
    by = {r.turn: r for r in conversations.reply_ordered(df).collect()}
    assert [tuple(x) for x in by[2].links] == [(1, 0, False)] and by[2].reply_to == 0
    assert by[2].text == "I like these two points:\nWhy?"
    assert by[5].reply_to == 3 and [tuple(x) for x in by[5].links] == [(1, 3, False)]
    assert by[6].text == "Then I wrote:\nand more" and by[6].reply_to == 1
    assert by[9].reply_to == 7 and by[9].text == "yes"


def test_turns_across_buckets(spark):
    turns = [0, 1, 1023, 1024, 5000, 5001]
    df = spark.createDataFrame([(1, t, "u", f"t{t}") for t in turns], "conv_id long, turn long, role string, text string")
    assert {r.turn: r.reply_to for r in conversations.reply_ordered(df).collect()} == dict(zip(turns, [None, *turns[:-1]]))


# ---------------------------------------------------------------- 2


def test_ball_tree_ties_and_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(600)]
    rows += [(600 + i, rows[20][1]) for i in range(60)] + [(900, None), (920, [float("nan")] * 6), (940, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, rows[0][1]), (960, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = balltree.top_k(df, shard_rows=90, block_rows=8, k=7).collect()
    valid = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, v in valid:
        if q % 20 == 0:
            found = sorted((-int(v @ w), i) for i, w in valid if i != q and len(w) == len(v))[:7]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert balltree.top_k(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 3


def test_contamination_edges(spark):
    long = "x " * 50_000 + "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 tail"
    bench = spark.createDataFrame([(1, " ".join(f"Q{i}" for i in range(10))), (2, "solo"), (3, None), (4, "..."), (5, "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9")], "item_id long, text string")
    texts = [None, "", "...", "q0-q1-q2 q3 q4 q5 q6 q7 q8 q9 q0 q1", "q0 q1 q2 q3 q4 q5 q6 q7 q8", "a Solo b", long, long]
    docs = docs_of(spark, texts)
    got = {r["doc"]["doc_id"]: r for r in decontaminate.find_contamination(docs, bench, docs.columns).collect()}
    assert [got[i].n_hit for i in range(8)] == [0, 0, 0, 10, 0, 1, 10, 10]
    assert got[3]["items"] == ["1", "5"] and got[5]["items"] == ["2"]
    a, b = got[3].spans[0]
    assert texts[3][a:b] == "q0-q1-q2 q3 q4 q5 q6 q7 q8 q9"
    sliced = decontaminate.find_contamination(docs, bench, ["doc_id"], slice_bytes=20, shard_bytes=100)
    assert {r["doc"]["doc_id"]: (r.n_words, r.n_hit, r["items"], r.spans) for r in sliced.collect()} == {i: (r.n_words, r.n_hit, r["items"], r.spans) for i, r in got.items()}
    left = {r.doc_id: r.text for r in decontaminate.remove_contamination(docs, bench).collect()}
    assert left[3].split() == ["q0", "q1"] and left[0] is None and left[4] == texts[4] and left[5] == "a \n b"
    assert decontaminate.contamination(edge_docs(spark), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


# ---------------------------------------------------------------- 4


def test_mixing(spark):
    docs = edge_docs(spark)
    rows = mixing.mix(docs, docs.columns).collect()
    assert len(rows) == docs.count()
    by_source = {}
    for r in rows:
        assert r.taken <= 2 * r.size and r.taken == sum(p.words for p in r.passes)
        by_source.setdefault(r["doc"]["source"], []).append(r)
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    first = [r.passes[0].position for r in rows if r.passes]
    assert first == sorted(first) and all(0 <= p <= 1 for p in first)
    assert sorted_rows(mixing.mixed(docs).collect()) == sorted_rows(mixing.mixed(docs).collect())
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_curriculum_holds_the_words_taken(spark):
    texts = [f"  w{i}\t{i}  " + " \n".join(f"x{k}" for k in range(40 + i)) + " \n" for i in range(7)]
    docs = docs_of(spark, texts).withColumn("source", F.when(F.col("doc_id") < 3, "a").otherwise("b"))
    rows = mixing.curriculum(docs).collect()
    assert any(r.words < len(texts[r.doc_id].split()) for r in rows)
    for r in rows:
        assert len(r.text.split()) == r.words and texts[r.doc_id].startswith(r.text)
        assert r.text == texts[r.doc_id] or r.words < len(texts[r.doc_id].split())


def test_positions_invert_the_integral(spark):
    for knots in mixing.SCHEDULES:
        segments = mixing.integrate(knots)
        shares = [i / 10 for i in range(11)]
        got = spark.createDataFrame([(s,) for s in shares], "s double").select(mixing._invert(knots, F.col("s"))).collect()
        for s, (t,) in zip(shares, got):
            grid = np.linspace(0, t, 20_001)
            w = np.interp(grid, *zip(*knots))
            assert abs(float(((w[1:] + w[:-1]) / 2 * np.diff(grid)).sum()) - s * segments[-1][3]) < 1e-6


# ---------------------------------------------------------------- 5, 9, 10


def accuracy(spark, name, label):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, MEDIUM).join(labels, "doc_id").where("held_out").collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality_held_out(spark):
    assert accuracy(spark, "op5_quality", "quality") >= 0.95


def test_toxicity_held_out(spark):
    assert accuracy(spark, "op9_toxicity", "toxic") >= 0.85


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_langid"](spark, MEDIUM).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.95


def test_classifier_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for marks in (labels, labels.limit(0)):
            rows = module.scored(docs, marks).collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
            assert {r.held_out for r in rows if r.doc_id == 4} == {zlib.crc32(b"4") % 5 == 0}
        assert module.scored(docs.limit(0), labels).count() == 0
    rows = {r.doc_id: r for r in langid.predicted(docs).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[3].lang_pred == "und"
    assert langid.predicted(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predicted(unlabelled).collect()} == {"und"}


def test_toxicity_sample_size(spark):
    import inspect

    from loomfeat.llm import labels

    docs = docs_of(spark, [f"text of row {i}" for i in range(9_000)])
    marks = spark.range(9_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    per_class = inspect.signature(toxicity.fit_toxicity).parameters["per_class"].default
    sample = labels.labelled_sample(docs, marks, "toxic", lambda i: F.lit(True), per_class, toxicity.packed_bag)
    assert Counter(y for _, y in sample) == {0: 4_500, 1: 1_500}
    texts = {toxicity.packed_bag(f"text of row {i}".encode()) for i in range(9_000)}
    assert all(x in texts for x, _ in sample)


def test_long_texts_are_learned(spark):
    words = {"aa": "alpha beta gamma", "bb": "kilo lima mike"}
    texts = [f"{words[lang]} " * 2_000 for i in range(30) for lang in words]
    rows = [(i, t, ("aa", "bb")[i % 2], "s", len(t), "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), (F.col("doc_id") % 2).cast("int").alias("quality"))
    assert all(len(t) > 20_000 for t in texts)
    assert {(r.doc_id % 2, r.predicted) for r in toxicity.scored(docs, marks).collect()} == {(0, 0), (1, 1)}
    assert {(r.doc_id % 2, r.lang_pred) for r in langid.predicted(docs).collect()} == {(0, "aa"), (1, "bb")}
    # labels of other tables' ids take no place of a labelled text
    lost = marks.union(spark.range(100, 20_000).selectExpr("id", "cast(id % 2 as int)", "cast(id % 2 as int)"))
    assert {(r.doc_id % 2, r.predicted) for r in toxicity.scored(docs, lost).collect()} == {(0, 0), (1, 1)}
    model = quality.fit_quality(docs, lost)
    assert model.weights.any()


def test_grams_stay_in_words():
    whole = toxicity.bag(b"some words and others here")
    assert toxicity.bag(b"some  words!and\nothers here")[0].tolist() == whole[0].tolist()
    assert toxicity.bag(b"")[0].size == 0


def test_forward_sums_all_segmentations():
    vocabulary = sorted({"▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab"})
    p = np.append(np.linspace(0.05, 0.2, len(vocabulary)), langid.UNKNOWN)[:, None]

    def total(word):
        if not word:
            return 1.0
        out = 0.0
        for i in range(1, len(word) + 1):
            piece = word[:i]
            if piece in vocabulary:
                out += p[vocabulary.index(piece), 0] * total(word[i:])
            elif i == 1:
                out += langid.UNKNOWN * total(word[i:])
        return out

    words = ["abab", "b", "babab", "xab", "", "a"]
    got = np.exp(langid.Lattice(langid.Pieces(vocabulary), words).totals(p)[:, 0])
    assert np.allclose(got, [total("▁" + w) for w in words])


# ---------------------------------------------------------------- 6


def brute_repeats(texts, window):
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), starts, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def test_suffix_sorting():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = np.append(rng.integers(0, 4, rng.integers(1, 50)), 0).astype(np.uint8)
        s = text.tobytes()
        sa = suffix_dedup.two_stage(text, 100)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("group_rows", [400, 1])
def test_repeats_equal_brute_force(spark, group_rows, monkeypatch):
    plain = suffix_dedup.repeats
    monkeypatch.setattr(suffix_dedup, "repeats", lambda t, window=400: plain(t, window, group_rows=group_rows, batch_bytes=2_000))
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    passage = "".join(chr(97 + i * i % 23) for i in range(450))
    texts += [f"{i} {passage}{i * 7}" for i in range(12)] + [None, "", "a" * 399, "b" * 400, "c" * 401, "é" * 300, texts[0], texts[0]]
    docs = docs_of(spark, texts)
    got = sorted(suffix_dedup.digests(docs).collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[1:] for r in got] == brute_repeats([(t or "").encode() for t in texts], 400)
    # the same by way of the repeats of 51 words, whose passages hold them
    both = suffix_dedup.removed_spans(docs, ["doc_id"], min_words=51)
    for r, b, t in zip(got, sorted(both.collect(), key=lambda r: r.doc.doc_id), texts):
        assert tuple(r)[1:] == (b.n_bytes, b.n_removed, b.n_spans, b.kept_sha256)
        assert b.n_passage_bytes >= b.n_removed and (b.n_passages > 0) == (b.n_passage_bytes > 0)
        assert b.n_passages == 0 or b.n_bytes >= 400 or len((t or "").split()) > 50


def test_removed_texts(spark):
    p = "".join(chr(97 + i * i % 23) for i in range(500))
    docs = docs_of(spark, ["start " + p + " end", p, "é" + p, None, "", "clean text"])
    left = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).collect()}
    assert left == {0: "start  end", 2: "é", 3: None, 4: "", 5: "clean text"}
    assert suffix_dedup.digests(docs.limit(0)).count() == 0


def test_repeated_passages_of_51_words(spark):
    import corpus_pipeline

    long, tiny = " ".join(f"p{i:02}xy" for i in range(51)), " ".join(chr(97 + i * i % 23) for i in range(51))
    kept = " ".join(f"q{i:02}xyz" for i in range(50))
    lines = [" ".join(f"{c}{i:02}x" for i in range(30)) for c in "rs"]
    unspaced = "".join(chr(0x4E00 + i * i % 997) for i in range(140))
    assert len(long) < 400 and len(tiny) == 101
    bodies = {i: " ".join(f"{c}{k}{c}" for k in range(60)) for i, c in enumerate("abcdefghij")}
    inside = {0: long, 1: long, 2: tiny, 3: tiny, 4: kept, 5: kept, 6: lines[0] + "\n" + lines[1], 7: lines[0], 8: lines[1], 9: unspaced}
    texts = [f"{bodies[i]} {inside[i]} {bodies[i][::-1]}" for i in bodies] + [unspaced]
    left = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs_of(spark, texts), SMALL).collect()}
    assert all(passage not in left[i] for i, passage in inside.items() if i in (0, 1, 2, 3, 9)) and 10 not in left
    assert all(left[i].startswith(bodies[i]) and left[i].rstrip().endswith(bodies[i][::-1]) for i in bodies)
    assert all(left[i] == texts[i] for i in (4, 5, 6, 7, 8))
    out = suffix_dedup.removed_spans(docs_of(spark, texts), ["doc_id"], min_words=51)
    found = {r.doc.doc_id: r for r in out.collect()}
    for i, passage in inside.items():
        cut = [texts[i].encode()[s.start : s.end].decode(errors="ignore") for s in found[i].passages]
        assert [passage in c for c in cut] == ([True] if i in (0, 1, 2, 3, 9) else []) and found[i].n_passages == len(cut)
        assert found[i].n_passage_bytes == sum(s.end - s.start for s in found[i].passages)
    # of these only the 420 bytes without blanks reach 400 bytes
    assert {i for i, r in found.items() if r.n_removed} == {9, 10}


# ---------------------------------------------------------------- 7


def brute_components(texts, k=5):
    sets = []
    for t in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))) if x]
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("list_rows", [64, 2])
def test_near_duplicates_equal_brute_force(spark, list_rows):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in rng.integers(0, 400, 80)]
    texts = [None, "", " \t", "One two", "one TWO", "three"]
    for i in range(40):  # a group of copies with lighter and heavier edits around one passage
        w = list(base)
        for at in rng.choice(80, rng.integers(0, 6), replace=False):
            w[at] = f"e{i}_{at}"
        texts.append(" ".join(w))
    texts += [" ".join([*base[:40], *(f"u{i}_{j}" for j in range(10 + i))]) for i in range(20)]
    docs = docs_of(spark, texts)
    got = sorted(tuple(r) for r in jaccard.near_duplicates(docs, list_rows=list_rows).collect())
    assert got == brute_components(texts)
    kept = {r.doc_id for r in jaccard.keep_one(docs).collect()}
    assert kept == {i for i, _, c in got if i == c}


def test_near_duplicate_edges(spark):
    rows = jaccard.near_duplicates(edge_docs(spark)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.id, set()).add((r.n_shingles > 0, r.component_id))
    assert by[1] == {(False, 1)} and by[5] == {(True, 5)} and by[6] == {(True, 5)} and by[None] == {(True, None)}
    assert jaccard.keep_one(edge_docs(spark)).count() == 8
    assert jaccard.near_duplicates(edge_docs(spark).limit(0)).count() == 0


# ---------------------------------------------------------------- 8


def test_url_rules(spark):
    cases = {
        "http://Example.com/en/x?q": ("example.com", "/en/x", "example.com/en/", "block"),
        "http://www.example.com/en/x": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.b.net/es/1#t": ("a.b.net", "/es/1", "net/es/", "block"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "ftp://x.com/": ("x.com", "/", "com/", "allow"),
        "http://x.com": ("x.com", "", None, None),
        "http://xcom/": ("xcom", "/", None, None),
        "x.com/en": ("", "", None, None),
        None: ("", "", None, None),
        "": ("", "", None, None),
    }
    rows = [(i, u, "<p>words here</p><script>var hidden</script>", "h") for i, u in enumerate(cases)] + [(99, None, None, None)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judged(df).collect()}
    for i, (h, p, rule, verdict) in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert urls.judged(df).count() == len(rows)
    assert urls.judged(df.limit(0)).count() == 0


def test_urls_learn_every_word(spark):
    # zebra and apple are seen once each under one verdict
    marked = ["http://aa.com/apple", "http://aa.net/es/zebra"]
    rows = [(i, u, "") for i, u in enumerate([*marked, "http://qq.org/zebra", "http://qq.org/apple"])]
    got = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "allow", 1: "block", 2: "block", 3: "allow"}


def test_urls_equal_brute_force(spark):
    import math

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    known = spark.createDataFrame([(-i, f"http://{w}.{end}", None) for i, (w, end) in enumerate([("a", "com/"), ("b", "net/es/")] * 3, 1) for _ in range(i)], pages.schema)
    long = "abcdefghijklmnopqrstuvwxyz"
    pages = pages.union(known).union(spark.createDataFrame([(-99, f"http://x{long}.org/{long}yes", f"<p>{long} yes {long}</p>")], pages.schema))
    rows = pages.collect()
    words: Counter = Counter()
    for r in rows:
        words.update(urls._WORD.findall(urls._HIDDEN.sub(" ", r.html or "").lower()))
    segment = urls.Segmenter(words)
    assert long in segment.split(f"{long}yes")
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    counts, number = {"allow": Counter(), "block": Counter()}, Counter()

    def tokens(r):
        return [m + t for (m, n), times in urls.names_of(r.host, r.path).items() for t in segment.split(n) * times]

    for p in rows:
        r = got[p.page_id]
        if r.rule:
            counts[r.verdict].update(tokens(r))
            number[r.verdict] += 1
    size = len({*counts["allow"], *counts["block"]}) + 1
    part = lambda v, t: math.log((counts[v][t] + 1) / (sum(counts[v].values()) + size))
    for r in got.values():
        if not r.rule:
            score = math.log((number["block"] + 1) / (number["allow"] + 1)) + sum(part("block", t) - part("allow", t) for t in tokens(r))
            assert r.verdict == ("block" if score > 0 else "allow")


def test_viterbi_finds_the_best_split():
    seg = urls.Segmenter({"the": 50, "then": 20, "end": 10, "a": 30, "at": 15, "hat": 5})

    def best(name):
        if not name:
            return 0.0
        strange = np.log(seg.total) - np.log(10)
        return min(seg.cost.get(name[:i], strange + i * np.log(10)) + best(name[i:]) for i in range(1, len(name) + 1))

    for name in ("thenend", "thehat", "athend", "xyzthe"):
        words = seg.split(name)
        assert "".join(words) == name
        strange = np.log(seg.total) - np.log(10)
        assert abs(sum(seg.cost.get(w, strange + len(w) * np.log(10)) for w in words) - best(name)) < 1e-9


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) > 50, name
        before = after
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} <= ids and all(0 <= r.position <= 1 for r in out)


# ---------------------------------------------------------------- long, hostile and repeated input


def test_quote_marks_without_end(spark):
    import time

    marks, digits = ">" * 50_000, "7" * 200_000
    rows = [
        (1, 0, "a", "An own line."),
        (1, 1, "b", marks + " An own line.\nfine"),
        (1, 2, "c", digits + "\n> An own line.\n" + digits + " wrote " * 2000 + ":\n> An own line.\n" + " " * 100_000 + "x" + " " * 100_000),
        (1, 3, "d", "On 1 May, Bob wrote :\n> An own line.\nyes"),
        (1, 4, "e", "At 5 he wrote it: no\n> An own line.\nyes"),
    ]
    start = time.time()
    by = {r.turn: r for r in conversations.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert time.time() - start < 120
    assert by[1].depth == 50_000 and by[1].text == "fine"
    assert by[2].text == digits + "\n" + " " * 100_000 + "x"
    assert by[3].text == "yes" and by[4].text == "At 5 he wrote it: no\nyes"


def test_an_id_with_two_texts_links_by_each(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (7, b + " more"), (9, "alone here")], "key long, text string")
    got = {(r.id, r.component_id) for r in jaccard.near_duplicates(docs, id_col="key").collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (9, 9)}
    assert sorted(r.key for r in jaccard.keep_one(docs, id_col="key").collect()) == [3, 9]


def test_a_column_named_like_the_filler(spark):
    docs = docs_of(spark, ["one two three " * 5, "four five"]).withColumn("_", F.lit("kept"))
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert {r["_"] for r in decontaminate.remove_contamination(docs, benchmark).collect()} == {"kept"}
    out = mixing.mix(docs, ["doc_id", "_"], ordered=False)
    assert {r.doc["_"] for r in out.collect()} == {"kept"}


def test_visible_text_equals_the_pattern():
    import random

    rng = random.Random(3)
    parts = ["<script>", "</script>", "<style ", "</STYLE >", "<", "a", "b>", ">", " ", "<p>", "<scripty>", "<Script x>", "</style", "\n"]
    for _ in range(20_000):
        html = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert urls.visible(html) == urls._HIDDEN.sub(" ", html)
    assert urls.visible("<" * 2_000_000) == "<" * 2_000_000


def test_very_long_names_and_words(spark):
    long = "a" * 3000
    rows = [(1, f"http://{long}.example.com/en/", f"<p>{long} word</p>"), (2, f"http://www.example.com/en/{long}", "<p>word</p>"), (3, f"http://x{long}.org/word", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.rule for r in urls.judged(pages).collect()} == {1: "example.com/en/", 2: "www.example.com/en/", 3: None}


def test_stages_drop_the_tables_before_them(spark, tmp_path):
    import os

    import corpus_pipeline

    def there(paths):
        return [p for p in paths if os.path.isdir(p.split(":", 1)[-1])]

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    (_, first), (_, second) = corpus_pipeline.STAGES[1:3]
    corpus_pipeline._BESIDE.clear()
    kept = first(spark, docs, SMALL)
    tables = list(corpus_pipeline._BESIDE)
    assert tables and there(tables) == tables
    second(spark, kept, SMALL)  # its input is not written yet and reads them
    assert there(tables) == tables
    kept.write.parquet(str(tmp_path / "kept"))
    out = second(spark, spark.read.parquet(str(tmp_path / "kept")), SMALL)
    assert there(tables) == [] and out.count() > 50


def test_quality_learns_from_every_labelled_row(spark):
    from loomfeat.llm.common import held_out
    from loomfeat.llm.labels import labelled_features

    training = lambda i: ~held_out(i, 5, 0)
    marks = spark.range(6_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    docs = docs_of(spark, [f"word{i % 7} and some more" for i in range(6_000)])
    rows = labelled_features(docs, marks, "quality", training, lambda t: np.array(quality.features(t), np.float64).tobytes()).cache()
    assert rows.count() == marks.where(training(F.col("doc_id"))).count() > 4_500
    seen = quality._summed(quality._buckets(rows, 9), len(quality.features(b"")), lambda b, good, bad: np.array([float(len(good) + len(bad))]))
    assert seen[0] == rows.count()
