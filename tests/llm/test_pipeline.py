"""The pipeline against brute force, on a small table with a case of each kind."""

import re

import pytest
from test_near_duplicates import expected as near_groups
from test_personal_data import slow as slow_spans

import corpus_pipeline
from tickharbor.llm import tables
from tickharbor.llm.encoding import Encoder
from tickharbor.llm.personal_data import KINDS

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, odd_rows):
    place = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    bench = spark.read.parquet(f"{SOURCE}/benchmark.parquet")
    leak = bench.orderBy("item_id").first()["text"]
    extra = [(10_000, "!!! 123 ???", "en"), (10_001, None, None), (10_002, "then " + leak, "en"), (10_003, "qzjxw kvqz" * 40, None),
             (10_004, "the thing and the of it is here, mail a.b@example.com or 10.0.0.1 now and then", "en"),
             (10_004, "the thing and the of it is here, mail a.b@example.com or 10.0.0.1 now and then", "en"),
             (None, "the and of it thing is that here only once", "en")]
    more = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in extra], docs.schema)
    docs.unionByName(more).repartition(3).write.parquet(f"{place}/documents.parquet")
    bench.write.parquet(f"{place}/benchmark.parquet")
    return place


def mask(text):
    marks, at, out = sorted((a, b, KINDS[k]) for k, a, b in slow_spans(text)), 0, ""
    for a, b, kind in marks:
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    return out + text[at:]


def test_stages(spark, folder):
    docs = tables.documents(spark, folder)
    columns = docs.columns
    source = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    languages = corpus_pipeline.stored(stages["language"](spark, docs, folder), "t1")
    left = [(r.doc_id, r.text) for r in languages.collect()]
    assert languages.columns == columns
    assert sorted({i for i, _ in source} - {i for i, _ in left}) == [10_000, 10_001, 10_003]

    single = corpus_pipeline.stored(stages["near_duplicates"](spark, languages, folder), "t2")
    ids = [r.doc_id for r in single.collect()]
    assert single.columns == columns
    assert sorted(i for i in ids if i is not None) == sorted({i for i, _, _, kept in near_groups(left) if kept}) and None in ids

    clean = corpus_pipeline.stored(stages["decontamination"](spark, single, folder), "t3")
    rows = {r.doc_id: r.text for r in single.collect()}
    kept = {r.doc_id for r in clean.collect()}
    plain = lambda t: re.sub(r"[^\w]+", " ", t.lower()).strip()
    items = [plain(r.text) for r in tables.read(spark, folder, "benchmark").collect()]
    leaking = {i for i, t in rows.items() if any(f" {x} " in f" {plain(t)} " for x in items)}
    assert set(rows) - kept == leaking and 10_002 in leaking and clean.columns == columns

    private = corpus_pipeline.stored(stages["personal_data"](spark, clean, folder), "t4")
    assert private.columns == columns
    for r in private.collect():
        assert r.text == mask(rows[r.doc_id]) and r.n_chars == len(r.text)

    packed = stages["packing"](spark, private, folder).collect()
    tool = Encoder(tables.vocabulary("byte_bpe_50k.json")).tokenizer
    sizes = {r.doc_id: len(tool.encode(r.text, add_special_tokens=False).ids) + 1 for r in private.collect()}
    totals = {}
    for r in packed:
        totals[r.doc_id] = totals.get(r.doc_id, 0) + r.length
    assert totals == sizes
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in whole.collect()) == sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in packed)
