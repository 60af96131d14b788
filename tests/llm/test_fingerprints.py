import hashlib

import numpy as np
import pyarrow as pa

from tickharbor.llm import fingerprints as fp


def one(text):
    return next(fp.fingerprints(pa.array([text])))


def slow_chunks(data):
    """Byte by byte: ends of the chunks."""
    ends, start, value = [], 0, 0
    for i, byte in enumerate(data):
        value = ((value << 1) + int(fp._GEAR[byte])) & 0xFFFF
        size = i + 1 - start
        mask = fp._HARD if size < fp.NORMAL else fp._EASY
        if size >= fp.MOST or (size >= fp.LEAST and value & int(mask) == 0):
            ends.append(i + 1)
            start = i + 1
    return ends + [len(data)] * (start < len(data))


def test_chunks_equal_the_slow_cut(odd_rows):
    for _, text in odd_rows:
        data = (text or "").encode()
        marks = np.frombuffer(data, dtype=np.uint8)
        value = fp.gear(marks)
        places = np.flatnonzero((value & fp._EASY) == 0)
        assert fp.cut(len(data), (places + 1).tolist(), ((value[places] & fp._HARD) == 0).tolist()) == slow_chunks(data)


def test_likeness_and_text_form(odd_rows):
    long = next(t for i, t in odd_rows if i == 12)
    whole, shifted, other = one(long), one("inserted " + long), one("x" * 5 + long[::-1])
    assert fp.likeness(whole, whole) == 1.0 and fp.likeness(whole, shifted) > 0.95 and fp.likeness(whole, other) < 0.05
    assert fp.likeness(fp.NOTHING, fp.NOTHING) == 1.0 and fp.likeness(whole, fp.NOTHING) == 0.0
    again = fp.parsed(fp.written(whole))
    assert all((a == b).all() for a, b in zip(again, whole))


def test_edited_texts(odd_documents, odd_rows, spark):
    got = fp.edited_fingerprints(odd_documents).collect()
    assert len(got) == len(odd_rows)
    known = sorted(((i, t or "") for i, t in odd_rows if i is not None))
    expected = []
    for at, (doc_id, text) in enumerate(known):
        after = known[at - 1][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.written(one(text)),
                         fp.written(one(edited)), fp.likeness(one(text), one(edited)), fp.likeness(one(text), one(after))))
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == sorted(expected)
    alone = [r for r in got if r.doc_id is None]
    assert len(alone) == 1 and alone[0].near_next == 0.0


def test_empty_table(no_documents):
    assert fp.edited_fingerprints(no_documents).collect() == []
    assert fp.document_fingerprints(no_documents).collect() == []
