import random

import numpy as np

from tickharbor.llm import decontamination as de

SYLLABLES = ("ka", "lo", "mi", "nu", "pe", "ro", "sa", "ti", "vo", "zu")
WORDS = [a + b + c for a in SYLLABLES for b in SYLLABLES for c in ("", "na", "re", "so", "tu", "vi")]


def prose(rng, count):
    return " ".join(rng.choice(WORDS) for _ in range(count))


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b):
            before, row[k + 1] = row[k + 1], before + 1 if x == y else max(row[k], row[k + 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 20))] for _ in range(2))
        assert de.common_subsequence(de._masks(np.array(a, dtype=np.int64)), len(a), b) == slow_common(a, b)


def test_space_has_the_singular_values(spark):
    rng = random.Random(2)
    topics = [[rng.choice(WORDS) for _ in range(6)] for _ in range(5)]
    texts = [" ".join(rng.choice(topics[i % 5]) for _ in range(30)) for i in range(300)]
    space = de.latent_space(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    terms = np.concatenate([de.passages(w, f)[2] for _, w, f in de._blocks(de.pa.array(texts))])
    df = np.bincount(terms.ravel(), minlength=de.TERMS + 1)[:-1]
    weight = np.append(np.where(df > 0, np.log((1 + len(terms)) / (1 + df)), 0), 0)
    used = np.flatnonzero(df)
    dense = np.zeros((len(terms), de.TERMS + 1))
    dense[np.arange(len(terms))[:, None], terms] = weight[terms]
    dense = dense[:, used] / np.linalg.norm(dense, axis=1, keepdims=True)
    assert np.allclose(space.values[:5], np.linalg.svd(dense, compute_uv=False)[:5], rtol=0.02)


def test_leaks(spark):
    rng = random.Random(3)
    items = [(k, f"{prose(rng, 8 + 3 * k)}. {prose(rng, 7)}.") for k in range(12)] + [(50, None), (51, ""), (52, "!?")]
    rows = [(i, prose(rng, rng.randrange(1, 400))) for i in range(200)]
    expected = set()
    for k, text in items[:12]:
        words = text.split()
        whole = prose(rng, 150) + " " + text.upper().replace(" ", "!! ") + " " + prose(rng, 90)
        changed = [w if j % 7 else rng.choice(WORDS) for j, w in enumerate(words)]
        rows += [(1000 + k, whole), (2000 + k, prose(rng, 60) + " " + " ".join(changed)), (3000 + k, " ".join(words[:len(words) // 3]))]
        expected |= {(1000 + k, k), (2000 + k, k)}
    rows += [(None, items[3][1]), (4000, None), (4001, ""), (4002, items[4][1]), (4002, items[4][1])]
    docs = spark.createDataFrame([(t, i, "x", 0.5) for i, t in rows], "text string, doc_id long, item_id string, share double").repartition(4)
    bench = spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id long, doc_id int")
    got = [(r.doc_id, r.item_id) for r in de.leaks(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([*expected, (None, 3), (4002, 4), (4002, 4)], key=str)
    flagged = {d for d, _ in got}
    kept = de.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in flagged)


SMALL = "/root/testdata/sf0.001"
# How a planted item is changed, and the recall that the README states for it.
CHANGES = {
    "exact": lambda rng, words, other: words,
    "a fifth dropped": lambda rng, words, other: [w for w in words if rng.random() > 0.2],
    "30 % replaced": lambda rng, words, other: [w if rng.random() > 0.3 else other() for w in words],
    "a foreign word after each": lambda rng, words, other: [x for w in words for x in (w, other())],
    "first 42 % replaced": lambda rng, words, other: [other() if k < 0.42 * len(words) else w for k, w in enumerate(words)],
    "two foreign words after each": lambda rng, words, other: [x for w in words for x in (w, other(), other())],
}


def every_window(search, words, item):
    """Whether the check holds in any window of the text, whatever the search would have looked at."""
    reach = de.WINDOW + 2 * len(search.items.words[item])
    return any(search._check(item, words[a:a + reach]) for a in range(max(1, len(words) - reach + 1)))


def test_recall_against_every_window(spark):
    rng = random.Random(5)
    given = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").where("text IS NOT NULL").collect()]
    vocabulary = sorted({w for text in given for w in text.split()})
    rows = [r for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect() if r.text]
    planted = []
    for way, (name, change) in enumerate(CHANGES.items()):
        for k, row in enumerate(rows):
            host = rng.choice(given).split()[:120]
            at = rng.randrange(len(host) + 1)
            changed = change(rng, row.text.split(), lambda: rng.choice(vocabulary))
            planted.append((1_000_000 + 1000 * way + k, " ".join([*host[:at], *changed, *host[at:]])))
    shape = "doc_id long, text string"
    docs = spark.createDataFrame(planted + [(k, text) for k, text in enumerate(given)], shape).repartition(4)
    bench = spark.createDataFrame([(row.item_id, row.text) for row in rows], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in de.leaks(docs, bench).collect() if r.doc_id >= 1_000_000}
    items = de.read_items([row.asDict() for row in rows])
    search = de.Search(de.latent_space(docs), items)
    held = {(doc, items.ids[item]) for (doc, _), words in zip(planted, de._words([text for _, text in planted]))
            for item in range(len(items.ids)) if every_window(search, words, item)}
    assert found <= held
    recall = {}
    for way, name in enumerate(CHANGES):
        due = {pair for pair in held if (pair[0] - 1_000_000) // 1000 == way}
        recall[name] = (len(due & found), len(due))
    print(recall)
    assert all(caught >= 0.9 * due for caught, due in recall.values()) and sum(due for _, due in recall.values()) >= 100
    assert recall["exact"][0] == recall["exact"][1] >= 25


def test_empty_tables(odd_documents, odd_rows, no_documents, spark):
    bench = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert de.leaks(no_documents, bench).collect() == [] and de.leaks(odd_documents, bench.limit(0)).collect() == []
    assert de.leaks(odd_documents, bench).collect() == []
    assert de.without_leaks(odd_documents, bench.limit(0)).count() == len(odd_rows)
    assert de.without_leaks(no_documents, bench).collect() == []


def test_sums_of_rows_hold_one_row_of_each_passage():
    import tracemalloc

    random = np.random.default_rng(3)
    rows = random.standard_normal((de.TERMS + 1, de.DIMENSIONS)).astype(np.float32)
    terms = random.integers(0, de.TERMS + 1, (3 * de.STEP + 5, de.WINDOW)).astype(np.int32)
    expected = rows[terms].sum(axis=1)
    tracemalloc.start()
    found = de._summed(rows, terms)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == expected).all() and (de._summed(np.asfortranarray(rows), terms) == expected).all()
    assert peak < found.nbytes + (1 << 20)
    assert len(de._summed(rows, terms[:0])) == 0
