"""Language ID, toxicity, quality, decontamination and the pipeline."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from civicmart.llm import decontam, langid, queries, quality_knn, toxicity
from civicmart.llm.common import read_table
from civicmart.llm.textmodel import letter_words

SF01 = "/root/testdata/sf0.01"


def crc(d, n):
    return zlib.crc32(str(d).encode()) % n


EDGES = [(900_001, None), (900_002, ""), (900_003, "12 34 --"), (900_004, "the and of " * 60_000), (None, "the of and")]


def test_language_id_held_out_accuracy(corpus):
    truth = {r.doc_id: r.lang for r in read_table(corpus, SF01, "documents").collect()}
    got = queries.op1_language_id(corpus, SF01).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(frame):
    rows = [(i, "le chat et la souris" if i % 2 else "the cat and the mouse") for i in range(60)] + EDGES
    docs = frame(rows, lang={i: "fr" if i % 2 else "en" for i in range(60)})
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert {got[d].lang_pred for d in (900_001, 900_002, 900_003)} == {"und"}
    assert got[1].lang_pred == "fr" and got[900_004].lang_pred == "en" and got[None].held_out is False
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(d) for d, t in rows if t and re.search("[^\\W\\d_]", t))
    assert langid.identify(frame([])).collect() == []
    unlabelled = langid.identify(frame([(1, "abc")], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


@pytest.mark.parametrize("lang", [None, "und"])
def test_texts_with_letters_stay_without_a_model(frame, lang):
    rows = [(1, "abc"), (2, "some words"), (3, None), (4, ""), (5, "12 --"), (None, "é")]
    kept = langid.with_language(frame(rows, lang=lang)).collect()
    assert sorted((str(r.doc_id) for r in kept)) == ["1", "2", "None"]


def test_words_keep_their_marks_and_numbers_are_no_letters(frame):
    assert letter_words("हिन्दी भाषा में") == ["हिन्दी", "भाषा", "में"]
    assert letter_words("cafe\u0301 ½ x² 3rd") == ["cafe\u0301", "x", "rd"]
    docs = frame([(i, "हिन्दी भाषा में" if i % 2 else "the cat") for i in range(40)] + [(50, "½ ²"), (51, "में")],
                 lang={i: "hi" if i % 2 else "en" for i in range(40)})
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert got[50] == "und" and got[51] == "hi"


def test_a_small_language_is_learned_beside_a_large_one(frame):
    """One language holds nearly all rows and has far more words than a table may keep."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"ab{rng.randrange(9000)}".translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(60)))
            for i in range(400)]
    rows += [(1000 + i, "zu zo ze " * 3) for i in range(12)]
    docs = frame(rows, lang={**{i: "big" for i in range(400)}, **{1000 + i: "tiny" for i in range(12)}})
    fitted = langid.train(docs, max_docs=60, max_words=5, max_grams=5)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, fitted).collect()}
    assert all(got[1000 + i] == "tiny" for i in range(12)) and got[0] == "big"


def test_ties_go_to_the_alphabetically_first_and_repeated_rows_are_rows_each(frame):
    rows = [(1, "same words"), (2, "same words"), (1, "same words"), (2, "same words"), (4, "zzz")]
    got = langid.predict(frame(rows, lang={1: "b", 2: "a"}), langid.train(frame(rows[:4], lang={1: "b", 2: "a"}))).collect()
    assert len(got) == 5 and {r.lang_pred for r in got} == {"a"}


def test_language_stage_decides_by_language_and_score(frame):
    rows = [(i, "le chat et la souris" if i % 2 else "the cat and the mouse") for i in range(40)] + [(90, "chat cat")]
    docs = frame(rows, lang={i: "fr" if i % 2 else "en" for i in range(40)})
    kept = {r.doc_id for r in langid.with_language(docs, languages=["fr"]).collect()}
    assert kept >= {i for i in range(40) if i % 2} and not kept & {i for i in range(40) if i % 2 == 0}
    sure = {r.doc_id for r in langid.with_language(docs, min_score=0.9).collect()}
    assert sure >= set(range(40)) and 90 not in sure


def test_words_come_before_ngrams():
    import numpy as np
    entries = {0: {"chat": [0.1, 0.9]}, 5: {}, 4: {"chat": [0.9, 0.1]}, 3: {}, 2: {"at": [0.2, 0.8]}, 1: {"c": [0.5, 0.5]}}
    tables = {k: {item: 0 for item in e} for k, e in entries.items()}
    model = langid.Model(["en", "fr"], tables, {k: np.log(list(e.values()) or np.zeros((0, 2))) for k, e in entries.items()})
    assert model.predict("chat")[0] == "fr"          # the word itself decides
    assert model.predict("chats")[0] == "en"         # unseen: its longest n-gram
    assert model.predict("zat")[0] == "fr"           # unseen: a shorter one


def labelled(spark, n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in "abcdefghijklmnopqrstuvwxyz"]
    rows, labels = [], []
    for d in range(n):
        bad = rng.random() < 0.3
        text = rng.choices(words, k=40)
        if bad:
            text[rng.randrange(40)] = rng.choice(["nasty", "vile"])
        rows.append((d, " ".join(text)))
        labels.append((d, int(not bad), int(bad), "x"))
    return rows, spark.createDataFrame(labels + [(n + 5, 1, None, "x"), (None, 1, 1, "x")],
                                       "doc_id long, quality int, toxic int, text string")


def test_toxicity_learns_and_defines_edges(corpus, frame):
    rows, labels = labelled(corpus, 400, 1)
    got = {r.doc_id: r for r in toxicity.toxicity(frame(rows + EDGES), labels).collect()}
    assert len(got) == 400 + len(EDGES)
    held = [r for d, r in got.items() if d is not None and d < 400 and r.held_out]
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert got[900_001].score == got[900_002].score and 0 <= got[900_001].score <= 1
    assert toxicity.toxicity(frame([]), labels).collect() == []
    none = toxicity.toxicity(frame([(1, "a")]), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in none] == [(0.5, 1)]


def test_ftrl_weights_are_sparse(corpus, frame):
    rows, labels = labelled(corpus, 300, 2)
    at, w = toxicity.train(frame(rows).join(labels.selectExpr("doc_id", "toxic AS label"), "doc_id"))
    assert 0 < len(at) < 2_000 and (w != 0).all()


def test_quality_on_held_out_rows(corpus):
    with duckdb.connect() as c:
        truth = dict(c.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    got = [r for r in queries.op9_quality(corpus, SF01).collect()]
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.9


def test_ties_at_the_last_neighbour_go_to_the_smaller_position():
    bits = quality_knn.BITS
    raw = np.zeros((1, (1 << bits) + quality_knn.SHAPES), dtype=np.float32)
    raw[0, 3] = 1
    base = np.zeros((raw.shape[1], 2), dtype=np.float32)
    base[3, 0] = 1
    for first in (0.0, 1.0):  # 40 labelled copies: the first 15 vote
        labels = np.array([first] * 15 + [1 - first] * 25, dtype=np.float32)
        labelled = np.tile(np.array([[1, 0]], dtype=np.float32), (40, 1))
        space = quality_knn.Space(np.ones(raw.shape[1], np.float32), base, labelled, labels)
        assert space.vote(raw, 15).tolist() == [first]
    labelled[:10] = [0.6, 0.8]  # farther ones come after all nearer copies
    space = quality_knn.Space(np.ones(raw.shape[1], np.float32), base, labelled, labels)
    assert space.vote(raw, 30).tolist() == pytest.approx([5 / 30])


def test_quality_edges(corpus, frame):
    rows, labels = labelled(corpus, 60, 3)
    got = {r.doc_id: r.score for r in quality_knn.quality(frame(rows + EDGES), labels).collect()}
    assert got[900_001] == got[900_002] and len(got) == 65
    assert quality_knn.quality(frame([]), labels).collect() == []
    assert [r.score for r in quality_knn.quality(frame([(1, "a")]), labels.limit(0)).collect()] == [0.5]


# --- decontamination ----------------------------------------------------------------

def tokens(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingles(words):
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_matches(docs, items):
    out = {}
    for d, t in docs:
        w = tokens(t)
        for i, it in items:
            iw = tokens(it)
            if not w or not iw:
                continue
            want = shingles(iw)
            for s in range(max(1, len(w) - len(iw) + 1)):
                have = shingles(w[s:s + len(iw)])
                sim = (want & have).total() / (want | have).total()
                if sim >= 0.8:
                    out[(d, i)] = max(out.get((d, i), 0), sim)
    return out


def bench(spark, items):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in items],
                                 "item_id long, text string, doc_id string, th long")


def test_decontamination_equals_brute_force(corpus, frame):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate([3, 5, 8, 15, 22, 40, 59, 80])]
    items += [(20, None), (21, ""), (22, "Same Item, here it is again now ok"), (23, "same item here it is again now ok"),
              (24, "la la la la la la la la la la la la")]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randint(0, 120))
        if d % 3 == 0:
            it = rng.choice(items[:8])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                it[rng.choice([0, -1])] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = it[:rng.choice([len(it), len(it) - 1, len(it) - 2])]
        docs.append((d, " ".join(text).upper() if d % 2 else ", ".join(text)))
    docs += [(100, None), (101, ""), (102, items[5][1]), (103, items[6][1][:-4]), (104, "same ITEM here: it is again now ok"),
             (105, "la " * 50), (102, items[5][1]), (106, (items[7][1] + " ") * 40)]
    got = decontam.matches(frame(docs), bench(corpus, items)).collect()
    want = brute_matches(docs, items)
    assert len(want) > 15
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want)
    flagged = {d for d, _ in want}
    frame_ = frame(docs)
    kept = decontam.clean_documents(frame_, bench(corpus, items))
    assert kept.columns == frame_.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in flagged)


def test_clean_rows_stay_beside_contaminated_ones_of_their_doc_id(corpus, frame):
    item = " ".join(f"t{i}" for i in range(30))
    rows = [(None, "a clean text without an id"), (None, f"before {item} after"), (None, None), (None, item),
            (7, "a clean text with a repeated id"), (7, item), (8, "clean"), (9, f"{item} end")]
    docs = frame(rows)
    kept = decontam.clean_documents(docs, bench(corpus, [(1, item)]))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        ((d, t) for d, t in rows if "t5" not in (t or "")), key=str)


def test_item_sets_are_broadcast_by_all_their_shingles(corpus, frame, monkeypatch):
    item, seen = " ".join(f"t{i}" for i in range(30)), []

    def bounded(df, rows, kept=decontam._bounded):
        if "item_sh" in df.columns:
            seen.append((rows, df.selectExpr("sum(size(item_sh)) n").first().n))
        return kept(df, rows)

    monkeypatch.setattr(decontam, "_bounded", bounded)
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 100)
    alike = [(k, f"{item} u{k}") for k in range(10)]
    got = decontam.matches(frame([(1, item), (2, "x")]), bench(corpus, alike + alike[:3])).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, k) for k in range(10)]
    assert seen == [(270, 270)]
    # Items of the same words are one.
    got = decontam.matches(frame([(1, item), (2, "x")]), bench(corpus, [(k, item) for k in range(10)])).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, k) for k in range(10)]
    assert seen[1:] == [(26, 26)]


def test_decontamination_of_empty_tables(corpus, frame):
    assert decontam.matches(frame([]), bench(corpus, [(1, "a b c d e f")])).collect() == []
    assert decontam.matches(frame([(1, "a b c d e f")]), bench(corpus, [])).collect() == []


def test_stride_meets_every_similar_window():
    for n in range(1, 120):
        s = decontam.stride_for(n, 0.8)
        for window in range(max(1, -(-8 * n // 10)), n + 1):
            missing = window - -(-(4 * (window + n)) // 9)
            assert window // s >= missing + 1 or s == 1


# --- pipeline -----------------------------------------------------------------------

def test_pipeline_stages_take_effect(corpus, tmp_path):
    docs = read_table(corpus, SF01, "documents")
    extra = corpus.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 456", "en", "s", 7)], docs.schema)
    docs = docs.unionByName(extra)
    counts, rows = [docs.count()], docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(corpus, rows, SF01)
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        rows = corpus.read.parquet(str(tmp_path / name))
        counts.append(rows.count() if k < 4 else rows.select("doc_id").distinct().count())
    assert counts[1] == counts[0] - 2 and counts[1] > counts[2] >= counts[3] > counts[4] == counts[5]


def test_pipeline_over_an_empty_table(corpus):
    docs = read_table(corpus, SF01, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(corpus, docs, SF01)
    assert docs.collect() == []


@pytest.mark.parametrize("name", ["op3_line_dedup", "op10_exact_dedup"])
def test_queries_equal_their_sql(corpus, name):
    with duckdb.connect() as c:
        for t in ("documents", "pages"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
        out = queries.queries()[name](corpus, SF01)
        want = c.sql(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_python_stages_get_bounded_batches_of_texts(frame):
    docs = frame([(1, "the cat sat on the mat")])
    spark, key = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for stage in (corpus_pipeline.language_id, corpus_pipeline.near, corpus_pipeline.pack):
            for asked, got in (("10000", 1000), ("0", 1000), ("200", 200)):
                spark.conf.set(key, asked)
                corpus_pipeline._for_workers(spark)
                assert int(spark.conf.get(key)) == got
            spark.conf.set(key, "10000")
            stage(spark, docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source"), "")
            assert int(spark.conf.get(key)) == 1000
    finally:
        spark.conf.set(key, before)
