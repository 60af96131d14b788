"""Divergence of sources against whole numbers of Python, over several blocks, tiles and slices."""

import re
from collections import Counter, defaultdict

import pytest

from tickharbor.llm.divergence import source_divergence
from tests.llm.conftest import prose

KIND = "text string, term string, lang string, n int, source string, block string, value double"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def diverged(rows):
    """(lang, source, part, item, value, rank) for rows of (lang, source, text)."""
    documents = [(lang or "", source or "", Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for lang, source, text in rows]
    df, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in documents:
        df[lang].update(terms.keys())
        groups[lang, source].update(terms)
    result = []
    for lang in {x for x, _ in groups}:
        kept = {t for t, n in df[lang].items() if n >= 3}
        own = {s: {t: c for t, c in terms.items() if t in kept} for (x, s), terms in groups.items() if x == lang}
        whole = Counter()
        for terms in own.values():
            whole.update(terms)

        def p(terms, t):
            return 1 + 10**9 * (terms.get(t, 0) + 1) // (sum(terms.values()) + len(kept))

        def f(a, b):
            return (a - b) * (a - b) // b

        for source, terms in own.items():
            pairs = [(-sum(f(p(terms, t), p(other, t)) for t in kept), s.encode(), s) for s, other in own.items() if s != source]
            near = [(-f(p(terms, t), p(whole, t)), t.encode(), t) for t in terms if p(terms, t) > p(whole, t)]
            result += [(lang, source, "pair", s, -v, rank) for rank, (v, _, s) in enumerate(sorted(pairs), 1)]
            result += [(lang, source, "term", t, -v, rank) for rank, (v, _, t) in enumerate(sorted(near)[:200], 1)]
    return sorted(result)


def found(spark, rows, **options):
    df = spark.createDataFrame([(text, "t", lang, 3, source, "b", 1.0) for lang, source, text in rows], KIND).repartition(3)
    return sorted(tuple(r) for r in source_divergence(df, **options).collect())


def corpus():
    rows = [(("en", "de", None)[i % 3], f"s{i * i % 7}", prose(i, 20 + 60 * (i % 4))) for i in range(90)]
    rows += [("en", "s0", prose(1000, 4000)), ("en", None, "The THE the tHe  é É o'clock"), ("en", "", "the end"), ("xx", "a", "one"), ("xx", "b", None),
             ("xx", "c", "one two"), (None, "s3", None), ("e\0n", "é", "the é"), ("e\0n", "z", "the é the"), ("e\0n", "z", "é the thé"), ("", "ünï", "")]
    return rows + rows[:9]


@pytest.mark.parametrize("options", [{}, {"tile_sources": 3, "cell_rows": 50}, {"tile_sources": 1, "cell_rows": 7}])
def test_all_values(spark, options):
    rows = corpus()
    expected = diverged(rows)
    assert len({r[:2] for r in expected}) > 15
    assert found(spark, rows, **options) == expected


def test_empty_table(spark):
    assert found(spark, []) == []
