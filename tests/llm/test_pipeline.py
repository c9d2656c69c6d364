"""Each stage against a brute-force version on what the stage before kept."""

import random

import corpus_pipeline as P
from cases import DOCS, awkward, lines_brute, near_brute, substrings_brute

STAGES = dict(P.STAGES)


def by_id(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


def check_columns(before, after):
    assert after.columns == before.columns and [f.dataType for f in after.schema] == [f.dataType for f in before.schema]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after.collect())


def test_stages_one_after_another(spark):
    rows = [(i, t) for i, t in dict(awkward(11, 60)).items()]  # one row an id
    full = [(i, t, ["aa", "bb"][n % 2], "s", None if t is None else len(t), "x", "y", n, "z", "k", n) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, DOCS)

    found = STAGES["language_id"](spark, docs, "")
    check_columns(docs, found)
    kept = found.collect()
    letters = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    assert by_id(kept) == sorted(letters, key=repr)  # all of these score above the bound

    found = spark.createDataFrame(kept, DOCS)
    lined = STAGES["line_dedup"](spark, found, "")
    check_columns(found, lined)
    want = [(i, t) for i, t, _, _ in lines_brute([(r.doc_id, r.text) for r in kept])]
    assert by_id(lined.collect()) == sorted(want, key=repr)

    lined = spark.createDataFrame(lined.collect(), DOCS)
    single = STAGES["near_dedup"](spark, lined, "")
    check_columns(lined, single)
    stay = [t for t, k in zip(want, near_brute(want, 5), strict=True) if k[3]]
    assert by_id(single.collect()) == sorted(stay, key=repr)

    single = spark.createDataFrame(single.collect(), DOCS)
    cut = STAGES["substring_dedup"](spark, single, "")
    check_columns(single, cut)
    clean = [(i, t if not gone else text) for (i, t), (_, text, _, gone) in zip(stay, substrings_brute(stay), strict=True)]
    assert by_id(cut.collect()) == sorted(clean, key=repr)

    packed = STAGES["best_fit_packing"](spark, spark.createDataFrame(cut.collect(), DOCS), "")
    assert sorted({r.doc_id for r in packed.collect() if r.doc_id is not None}) == sorted(i for i, _ in clean if i is not None)


def test_documents_that_language_id_rejects(spark):
    docs = spark.createDataFrame([(1, "words in a text", "aa", "s", 15, "", "", 0, "", "", 0), (2, "12 + 34", "aa", "s", 7, "", "", 0, "", "", 0), (3, None, None, "s", None, "", "", 0, "", "", 0)], DOCS)
    assert [r.doc_id for r in STAGES["language_id"](spark, docs, "").collect()] == [1]


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
        docs = spark.createDataFrame([], docs.schema)


def test_stages_and_run(spark):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "substring_dedup", "best_fit_packing"]
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "aa", f"s{n}", None if t is None else len(t), "", "", n, "", "", 0) for n, (i, t) in enumerate(rows)], DOCS)


def test_language_id_judges_rows_of_one_id_by_their_own_texts(spark):
    rows = [(1, "words in a text"), (1, "12 + 34"), (None, "a clean text of no id"), (None, "56"), (None, None), (None, ""), (None, "another clean text"), (2, "a third text")]
    docs = documents(spark, rows)
    kept = STAGES["language_id"](spark, docs, "")
    check_columns(docs, kept)
    assert by_id(kept.collect()) == sorted([(i, t) for i, t in rows if t and "t" in t], key=repr)


def test_near_dedup_keeps_one_row_of_each_group_whatever_the_ids(spark):
    words = [" ".join(f"{g}{n}" for n in range(60)) for g in "abcdefg"]
    rows = [(1, words[0]), (None, words[0]), (None, words[1]), (3, words[2]), (3, words[0] + " z"), (3, words[3])]  # only the copies of row 0 go
    rows += [(None, words[4]), (None, words[4]), (None, words[4].upper()), (7, words[5]), (7, words[5]), (7, words[5] + " z"), (8, words[5])]  # one of each
    rows += [(None, None), (None, " \n"), (None, " \n"), (9, ""), (9, ""), (None, words[6])]  # no words, no group
    docs = documents(spark, rows)
    out = STAGES["near_dedup"](spark, docs, "")
    check_columns(docs, out)
    kept = out.collect()
    assert len({r._row for r in kept}) == len(kept)
    group = lambda t: (t or "").lower().removesuffix(" z")
    assert by_id(r for r in kept if r.text and r.text.strip() and group(r.text) not in words[4:6]) == sorted([(1, words[0]), (None, words[1]), (3, words[2]), (3, words[3]), (None, words[6])], key=repr)
    assert [(r.doc_id, group(r.text)) for r in kept if group(r.text) in words[4:6]].count((None, words[4])) == 1
    assert [r.doc_id for r in kept if group(r.text) == words[5]] == [7]
    assert [r.doc_id for r in kept if not (r.text or "").strip()].count(None) == 3 and len(kept) == 12


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t), "", "", 0, "", "", 0) for i, (t, lang) in enumerate(rows)], DOCS)


def test_clean_texts_of_many_related_languages_stay(spark):
    r = random.Random(5)
    # 20 languages that share most words: clean texts score low
    shared = ["".join(r.choices("aeioulmnrst", k=5)) for _ in range(200)]
    rows = [(" ".join(r.choices(shared, k=44) + [f"{c}{c}{c}{c}{c}"] * 6), c) for c in "bcdfghjkpqvwxyzBCDFG" for _ in range(20)]
    docs = labelled(spark, rows)
    scores = P.langid.languages(docs).collect()
    assert min(x.score for x in scores) < 0.3
    assert STAGES["language_id"](spark, docs, "").count() == len(rows)
