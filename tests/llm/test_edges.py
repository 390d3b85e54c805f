"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import math

import pytest
from pyspark.sql import functions as F

from sluice.llm import (decontaminate, fingerprint, langid, line_dedup, lm, mixing, quality, simhash_dedup,
                        token_counts, toxicity)
from sluice.llm.common import fold

LONG = " ".join(f"word{i % 977}" for i in range(150_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fingerprint int, score string, size string, removed int, _row string, _key int, _src int, held_out int")
ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 10),
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 10),     # a repeated row
    (2, "the cat sat on the mat and looked at the dog", "en", None, 10),    # an equal text
    (3, None, None, "b", None),
    (4, "", "fr", "b", 0),
    (5, " \t\n ", None, "b", 4),
    (None, "der Hund und die Katze sind im Haus und schlafen", "de", "c", 9),
    (6, LONG, "en", "c", len(LONG)),
    (7, "x", None, "c", 1),
    (8, "1234 5678 !!", None, None, 3),
    (9, "Ünï cödé ❤ 漢字 \U0001F600 mixed", "de", "a", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + (7, "s", "z", 1, "r", 2, 3, 4) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (4, 0, 0), (4, 1, 1), (6, 1, 0), (7, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def none_of(df):
    return df.where("doc_id = -1")


OPERATORS = {
    "quality": lambda d, l: quality.score_quality(d, l, fold("doc_id", 5) != 0, fold("doc_id", 5) == 0),
    "tokens": lambda d, l: token_counts.count_tokens(d),
    "simhash": lambda d, l: simhash_dedup.near_duplicates(d),
    "fingerprint": lambda d, l: fingerprint.fingerprint_documents(d),
    "langid": lambda d, l: langid.predict_language(d, fold("doc_id", 4) != 2, fold("doc_id", 4) == 2),
    "toxicity": lambda d, l: toxicity.score_toxicity(d, l, fold("doc_id", 3) != 1, fold("doc_id", 3) == 1),
    "lines": lambda d, l: line_dedup.dedupe_lines(d),
    "lm": lambda d, l: lm.score_documents(d, fold("doc_id", 10) != 0, fold("doc_id", 10) == 0, rounds=1),
    "mixing": lambda d, l: mixing.mix_sources(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(name, docs, labels):
    rows = OPERATORS[name](docs, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    if "score" in rows[0] and name != "lines" and name != "mixing" and name != "lm":
        assert all(0.0 <= r.score <= 1.0 for r in rows)
    if "held_out" in rows[0] and name not in ("lines", "mixing"):
        assert all(r.held_out is False for r in rows if r.doc_id is None)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, docs, labels):
    assert OPERATORS[name](none_of(docs), none_of(labels)).collect() == []


def test_simhash_values(docs):
    rows = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_dedup.near_duplicates(docs).collect()}
    zero = {i for (i, f) in rows if f == "0" * 16}
    assert zero == {3, 4, 5} and {rows[i, "0" * 16] for i in zero} == {3}
    assert {c for (i, _), c in rows.items() if i in (1, 2)} == {1}
    assert [c for (i, _), c in rows.items() if i is None] == [None]


def test_simhash_keeps_one_of_each(docs):
    kept = simhash_dedup.keep_first(docs)
    assert [c for c in kept.columns] == [c for c in docs.columns if c != "_row"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 6, 7, 8, 9]
    assert simhash_dedup.keep_first(none_of(docs)).collect() == []


def test_line_values(docs):
    rows = {r.doc_id: r for r in line_dedup.dedupe_lines(docs).collect()}
    assert rows[3].text is None and rows[3].n_lines == 0
    assert rows[2].text == "" and rows[2].n_removed == 1 and rows[2].removed[0].first_doc_id == 1
    assert rows[1].text == ROWS[0][1] and rows[6].text == LONG


def test_mixing_values(docs):
    mixed = mixing.mix_sources(docs)
    assert [c for c in mixed.columns if c in docs.columns] == [c for c in docs.columns if c not in ("_src", "size")] + ["size"]
    rows = mixed.collect()
    assert all(r.taken <= 2 * r.size for r in rows) and all(r.size == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert mixing.copied(mixed).where("copies = 0").count() == 0


def test_language_values(docs):
    rows = {r.doc_id: r for r in OPERATORS["langid"](docs, None).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5, 8))
    assert rows[6].lang_pred in ("en", "de", "fr")
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in OPERATORS["langid"](blank, None).collect()} == {"und"}


def test_lm_values(docs):
    rows = {r.doc_id: r for r in OPERATORS["lm"](docs, None).collect()}
    assert rows[3].n_tokens == rows[4].n_tokens == rows[5].n_tokens == 1
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows.values())
    untaught = lm.score_documents(docs, F.lit(False), F.lit(True), rounds=1).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 and math.isfinite(r.score) for r in untaught)


def test_no_labels_reject_nothing(docs, labels):
    assert quality.keep_good(docs, none_of(labels), F.lit(True)).count() == len(ROWS)
    assert toxicity.score_toxicity(docs, none_of(labels), F.lit(True), F.lit(False)).where("predicted = 1").count() == 0


def test_leaks_with_nulls_and_empty_sides(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "cat sat on the mat and looked"), (4, "the cat sat on"),
                                   (5, "cat sat on the mat and looked")], "item_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id or -1) for r in found) == [(1, -1), (1, -1), (1, 5), (1, 5), (2, -1), (2, 5)]
    assert decontaminate.decontaminate(docs, items).count() == len(ROWS) - 3
    assert decontaminate.decontaminate(docs, items).columns == docs.columns
    assert decontaminate.leaks(docs, items.where("item_id = -1")).collect() == []
    assert decontaminate.leaks(none_of(docs), items).collect() == []


def test_short_lines_that_repeat_go_and_blank_ones_stay(spark):
    rows = [(1, "Of it.\n\nno, not.\n  \n中"), (2, "Of it.\n\nno, nod.\n  \n中"), (3, "no, not.\nOf it.\nOf it.")]
    got = {r.doc_id: r for r in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed == 0
    assert got[2].text == "\nno, nod.\n  " and [x.line_no for x in got[2].removed] == [0, 4]
    assert got[3].text == "" and [(x.line_no, x.first_doc_id, x.first_line_no) for x in got[3].removed] == [(0, 1, 2), (1, 1, 0), (2, 1, 0)]


def test_long_lines_with_a_changed_word_go(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    line = [f"word{i * 7 % 101}" for i in range(100)]
    other = [f"other{i}" for i in range(60)]
    near = [" ".join(line[:i * 4] + ["changed"] + line[i * 4 + 1:]) for i in range(20)]
    rows = [(0, " ".join(line))] + [(i + 1, x) for i, x in enumerate(near)]
    rows += [(50, " ".join(other + line[:30])), (51, " ".join(line[:30] + other)), (52, " ".join(line[:60]))]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(0 < i < 50) for i, _ in rows}
