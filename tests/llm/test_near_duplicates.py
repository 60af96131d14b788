import random
import re

from tickharbor.llm.components import components
from tickharbor.llm.near_duplicates import near_duplicates

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def expected(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    ids = [i for i in sets if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b
             and any(x & y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    named = groups(links, ids)
    return sorted((i, len(shingles(t)), named[i], named[i] == i) for i, t in rows if i is not None)


def test_odd_rows(odd_documents, odd_rows, no_documents):
    got = near_duplicates(odd_documents).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == expected(odd_rows)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_duplicates(no_documents).collect() == []


def test_chains_and_large_groups(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:40] + [f"v{i // 3}"] + words[40:])) for i in range(30)]
    rows += [(100 + i, " ".join(words[3 * i:60 + 3 * i])) for i in range(12)]
    rows += [(200 + i, " ".join(words[:50] + [f"u{i}-{k}" for k in range(18)])) for i in range(25)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (139, 300)]
    got = components(spark.createDataFrame([(b, a) for a, b in pairs], "u long, v long")).collect()
    nodes = {n for p in pairs for n in p} - {200}
    assert {r.node: r.component for r in got} == groups([p for p in pairs if p[0] != p[1]], nodes)


def test_repeated_ids_link_by_each_of_their_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 1, False)}
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_many_texts_of_few_ids(spark):
    rng = random.Random(17)
    bases = [[f"b{k}w{i}" for i in range(50)] for k in range(30)]
    rows = []
    for _ in range(160):
        words = list(rng.choice(bases))
        words[rng.randrange(50)] = f"z{rng.randrange(9)}"
        # A third of the rows have one id; the others have few, and some texts come again under another id.
        rows.append((rng.choice([7, rng.randrange(60), 1000 + rng.randrange(10**6)]), " ".join(words)))
    rows += [(i + 1, t) for i, t in rows[::9]] + rows[::20]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)
