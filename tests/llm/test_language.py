import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickharbor.llm import language, tables

PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]


def slow(word, weights):
    """Sum over all cuts of the marked word into pieces."""
    whole, total = "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(whole) - 1):
        parts, start = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                parts.append(whole[start:k])
                start = k
        parts.append(whole[start:])
        product = 1.0
        for p in parts:
            product *= weights.get(p, language.UNKNOWN if len(p) == 1 else 0.0)
        total += product
    return total


def test_forward_sums_all_segmentations():
    weights = np.random.default_rng(1).dirichlet(np.ones(len(PIECES)), 2).T
    words = ["a", "abab", "bbax", "abaab"]
    got = language.Lattice(PIECES).forward(words, weights)
    for k in range(2):
        assert np.allclose(np.exp(got[:, k]), [slow(w, dict(zip(PIECES, weights[:, k]))) for w in words])


def test_expected_uses_fit_the_likelihood():
    lattice, words, times = language.Lattice(PIECES), ["ab", "aba", "bab", "a"], np.array([5, 3, 2, 9])
    p, before = np.full(len(PIECES), 1 / len(PIECES)), -np.inf
    for _ in range(5):
        now = (lattice.forward(words, p[:, None])[:, 0] * times).sum()
        assert now >= before - 1e-9
        before, uses = now, lattice.expected(words, times, p)
        p = uses / uses.sum()


@pytest.fixture(scope="module")
def pieces():
    return language.vocabulary_pieces(tables.vocabulary("piece_bpe_32k.model"))


def test_held_out_accuracy(spark, pieces):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.languages(docs, pieces).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 30 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_odd_rows(odd_documents, odd_rows, no_documents, spark, pieces):
    one = language.languages(odd_documents, pieces).collect()
    assert len(one) == len(odd_rows) and all((r.lang_pred, r.score > 0) in (("x", True), ("und", False)) for r in one)
    none = language.languages(odd_documents.withColumn("lang", F.lit(None).cast("string")), pieces).collect()
    assert len(none) == len(odd_rows) and all(r.lang_pred == "und" and r.score == 0 for r in none)
    rows = [(i, "the thing and that other", "en") for i in range(20)] + [(i, "über sich nicht schön das", "de") for i in range(20, 40)]
    rows += [(None, "nicht das", None), (41, "123 !!", None), (42, None, "en"), (43, "THING AND", None), (44, "qzjxwkvq" * 700, None), (45, "中文", None)]
    got = {r.doc_id: r for r in language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), pieces).collect()}
    assert got[None].lang_pred == "de" and not got[None].held_out
    assert got[41].lang_pred == got[42].lang_pred == "und" and got[43].lang_pred == "en"
    assert got[44].score < 0.5 and got[45].score < 0.5
    assert language.languages(no_documents, pieces).collect() == []
