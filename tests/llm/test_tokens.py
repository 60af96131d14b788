import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickharbor.llm import packing, tables, token_files
from tickharbor.llm.encoding import TASK_SLOTS, Encoder
from tickharbor.llm.perfect_hash import PerfectHash, fingerprint

ODD = ["a<|endoftext|>b c, d", "don't, I'll 's, x'y.z  two  spaces\n\n nl \t tab\x0b x\x85y\xa0 z", " lead", "trail ", "\n",
       "Привет, мир.日本語 テスト、です é, á. B̧́ İstanbul ΣΑΣ, 'S 'T 12,345.67 a1b2,c3!'s!'t?'re", "\x1c a\x1c b  c 　 d"]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_units_give_the_ids_of_whole_texts(name, odd_rows):
    tool = Encoder(tables.vocabulary(name))
    texts = ODD + [t or "" for _, t in odd_rows]
    for _ in range(2):
        for text, ids in zip(texts, tool.encode(pa.array(texts), 5)):
            assert ids.tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids + [5]


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(-2**63, 2**63, 5000)
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.places(keys)) == list(range(len(keys))) and len(hashed) == len(keys)
    order = np.argsort(hashed.places(keys))
    foreign = np.arange(5000)
    place = hashed.places(foreign)
    assert (fingerprint(keys)[order][place[place >= 0]] == fingerprint(foreign)[place >= 0]).sum() <= 1
    assert len(PerfectHash.build(keys[:0])) == 0


def test_token_files(odd_documents, odd_rows, no_documents):
    path = tables.vocabulary("word_bpe_49k.json")
    tool = Encoder(path).tokenizer
    manifest = token_files.write_token_files(odd_documents, path, 1)
    got = token_files.read_token_files(manifest).collect()
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [tool.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows]
    starts = np.cumsum([0] + [len(x) for x in ids])
    assert sorted(got, key=lambda r: r.start) == [
        (i, s, len(x), crc(x)) for (i, _), s, x in zip(rows, starts.tolist(), ids)]
    shards = [token_files.Shard(r.path) for r in manifest.collect()]
    for doc_id, text in odd_rows:
        if doc_id is not None:
            found = [x.tolist() for s in shards for x in s.get(doc_id)]
            assert tool.encode(text or "", add_special_tokens=False).ids + [1] in found
            assert len(found) == sum(i == doc_id for i, _ in odd_rows)
    assert [x for s in shards for x in s.get(5)] == []
    assert token_files.read_token_files(token_files.write_token_files(no_documents, path, 1)).collect() == []


def test_packing(odd_documents, odd_rows, no_documents):
    path = tables.vocabulary("byte_bpe_50k.json")
    tool = Encoder(path).tokenizer
    got = packing.pack(odd_documents, path, 2, 64).collect()
    expected = []
    for doc_id, text in odd_rows:
        ids = tool.encode(text or "", add_special_tokens=False).ids + [2]
        ends = range(len(ids) % 64 or 64, len(ids) + 1, 64)
        for piece, end in enumerate(ends):
            start = end - 64 if piece else 0
            expected.append((str(doc_id), piece, start, end - start, crc(ids[start:end])))
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == sorted(expected)
    filled = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 64
    assert len(filled) <= -(-sum(r.length for r in got) // 64) + 1
    assert packing.pack(no_documents, path, 2, 64).collect() == []


def test_plan_is_close_to_the_bound():
    lengths = np.random.default_rng(2).integers(1, 257, 20_000)
    plan = packing.make_plan(np.bincount(lengths, minlength=257), 256)
    assert plan.sequences <= 1.003 * lengths.sum() / 256


def test_repeats_fit_the_histogram():
    shapes = packing.patterns(32)
    truth = np.random.default_rng(3).integers(0, 50, len(shapes))
    counts = sum(np.bincount(shapes[:, k], truth, 33) for k in range(3))
    counts[0] = 0
    fitted = packing.fit_repeats(counts, shapes, 2000)
    used = sum(np.bincount(shapes[:, k], fitted, 33) for k in range(3))
    used[0] = 0
    assert np.abs(used - counts).max() < 0.02 * counts.max() and (fitted >= 0).all()


def test_an_encoder_of_one_task_is_small_and_gives_the_same_ids():
    """Also where its table has far fewer entries than the texts have units."""
    path = tables.vocabulary("byte_bpe_50k.json")
    texts = pa.array([" ".join(f"word{(7 * k * k + j) % 4999}x" for j in range(400)) for k in range(40)] + ["", None])
    expected = [ids.tolist() for ids in Encoder(path).encode(texts, 2)]
    for slots in (64, TASK_SLOTS):
        tool = Encoder(path, slots)
        assert [ids.tolist() for _ in range(2) for ids in tool.encode(texts, 2)] == expected * 2
    assert tool.keys.nbytes + tool.begin.nbytes + tool.count.nbytes <= 8 << 20
