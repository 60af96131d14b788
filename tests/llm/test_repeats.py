import hashlib
import random

import pytest

from tickharbor.llm import repeats
from tickharbor.llm.repeats import LENGTH, intervals, maximal_repeats, without_repeats


def slow(rows):
    """doc_id, bytes, removed, runs and digest from the first place of every string."""
    first, out = {}, []
    for doc_id, text in sorted(rows):
        raw, gone = (text or "").encode(), set()
        for i in range(len(raw) - LENGTH + 1):
            if first.setdefault(raw[i:i + LENGTH], (doc_id, i)) != (doc_id, i):
                gone.update(range(i, i + LENGTH))
        runs = sum(k in gone and k - 1 not in gone for k in range(len(raw)))
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        out.append((doc_id, len(raw), len(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def random_rows(seed, docs=24):
    rng = random.Random(seed)
    letters = "abcdeé "
    shared = ["".join(rng.choice(letters) for _ in range(rng.randrange(60, 260))) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            text = rng.choice(shared)
            a = rng.randrange(0, 60)
            parts.append(text[a:] if rng.random() < 0.5 else text)
            parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(0, 90))))
        rows.append((i * 3, "".join(parts)))
    return rows + [(500, "a" * 400), (501, "b" + "a" * 250), (502, "ab" * 150), (503, "short"), (504, None), (505, rows[3][1])]


@pytest.mark.parametrize("limit", [10_000, 2])
def test_removed_bytes_equal_the_slow_way(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "GROUP_LIMIT", limit)
    rows = random_rows(limit)
    docs = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, doc_id long, anchor int, spans string").repartition(4)
    got = sorted(tuple(r)[:5] for r in without_repeats(docs).collect())
    assert got == slow(rows)


def test_intervals():
    assert sorted(intervals([3, 5, 5, 1], 2)) == [(3, 0, 4), (5, 1, 4)]
    assert list(intervals([], 0)) == []


def test_maximal_repeats_are_all_and_maximal():
    rng = random.Random(4)
    for _ in range(40):
        lefts, rights = ([bytes(rng.choices(b"ab", k=rng.randrange(0, 7))) for _ in range(9)] for _ in range(2))
        found = {(b, a, tuple(sorted(m))) for b, a, m in maximal_repeats(lefts, rights, 4)}
        expected = set()
        for x in range(9):
            for y in range(x):
                b, a = repeats.common(lefts[x], lefts[y]), repeats.common(rights[x], rights[y])
                if a + b >= 4:
                    expected.add((b, a, tuple(k for k in range(9) if lefts[k][:b] == lefts[x][:b] and rights[k][:a] == rights[x][:a])))
        assert expected <= found
        for b, a, m in found:
            assert len(m) > 1 and len({lefts[k][:b] for k in m}) == 1 and len({rights[k][:a] for k in m}) == 1


def test_odd_rows(odd_documents, odd_rows, no_documents):
    got = without_repeats(odd_documents).collect()
    known = {i: t for i, t in odd_rows if i is not None and i != 1}
    assert sorted(tuple(r)[:5] for r in got if r.doc_id in known) == slow(list(known.items()))
    assert sum(r.doc_id == 1 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert without_repeats(no_documents).collect() == []
