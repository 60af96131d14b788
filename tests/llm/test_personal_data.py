import hashlib
import re
import time

from pyspark.sql import functions as F

from tickharbor.llm.personal_data import FOUND, base_spans, luhn, masked, personal_data, runs, spans_text

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
HARD = ["a@b.c%d@e.f and x@@y.z.w q@r q@r. u.v@w-x.y-z.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 00300.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 42424242424242424242424242424242", "+1 (606) 555-7814, +12 3 +1.........2 ++49 30 1234567",
        "ünï é@b.co 7@é.de +1 (202) 555-0100é 1.1.1.1", "", "@", "4923437827071911 or 4436387346764662"]


def slow(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == 1 and any(int(p) > 255 for p in m[0].split(".")))
                    or (kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits.encode())))
                    or (kind == 3 and not 8 <= len(digits) <= 15)):
                continue
            out.append((kind, *m.span()))
    return out


def in_points(raw, spans):
    return [(k, len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b in spans]


def test_base_spans_equal_the_patterns(odd_rows):
    for text in HARD + [t or "" for _, t in odd_rows]:
        assert in_points(text.encode(), base_spans(text.encode())) == slow(text)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"some éwords {i} before please call me at +1 (20{i}) 555-01{i}0 or later") for i in range(6)]
    rows += [(10, "then call me at 0170-5551234, or not"), (11, "costs 99999 euro and more 0170-5551234."), (12, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("found", F.lit("x"))
    got = {r.doc_id: r.spans for r in personal_data(docs).select("doc_id", spans_text().alias("spans")).collect()}
    assert got[10] == f"{FOUND}:16:28" and got[11] == f"{FOUND}:26:38" and got[12] == ""
    assert got[3].startswith("phone:")
    texts = {r.doc_id: r for r in masked(docs).collect()}
    assert texts[10].text == "then call me at [OTHER], or not" and texts[12].text == "nothing here"
    assert texts[3].text == "some éwords 3 before please call me at [PHONE] or later" and texts[3].base == 1


def test_contexts_find_identifiers_with_spaces(spark):
    numbers = ["(206) 555-0134", "0170 555 1234", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "4111 1111 1111 1112",
               "01. 70. 55. 12. 34", "0170\u00a0555\u00a01299", "abc0170 555 77"]
    rows = [(i, f"some words {i} before please call me at +1 (20{i}) 555-01{i}0 or later") for i in range(9)]
    rows += [(20 + i, f"then call me at {n}, or not") for i, n in enumerate(numbers)]
    rows += [(40 + i, f"it costs {n}{',' if '. ' in n else '.'} 7 more, (see {n})") for i, n in enumerate(numbers)]
    rows += [(60, "call me at 0170555 98 today"), (61, "it has 0170555 of those and 98 201 01"), (62, "write a@b.co 555 1234 +1 (202) 555-0134 or 2020 2021")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r.doc_id: r.text for r in masked(docs).collect()}
    for i in range(len(numbers)):
        assert texts[20 + i] == "then call me at [OTHER], or not"
        assert texts[40 + i].replace(",", ".") == "it costs [OTHER]. 7 more. (see [OTHER])"
    assert texts[60] == "call me at [OTHER] today" and texts[61] == "it has [OTHER] of those and 98 201 01"
    assert texts[62] == "write [EMAIL] 555 1234 [PHONE] or 2020 2021"
    found = {r.doc_id: r.spans for r in personal_data(docs).select("doc_id", spans_text().alias("spans")).collect()}
    assert found[60] == f"{FOUND}:11:21" and found[20] == f"{FOUND}:16:30"


def test_runs_stay_linear_and_outside_base_spans():
    raw = b"call a@b.co 555 1234 +1 (202) 555-0134x 98765 4"
    assert [raw[a:b] for a, b, _ in runs(raw, base_spans(raw))] == [b"555 1234", b"98765 4"]
    for odd in (b"(" * 200_000, b"1" + b"." * 200_000, b"1. " * 100_000, b"a1" * 200_000, b"1( " * 100_000, b"AB12 " * 50_000):
        assert len(runs(odd, [])) <= 50_000


def test_odd_rows(odd_documents, odd_rows, no_documents, spark):
    got = personal_data(odd_documents).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows) and all(r.base == "" for r in got)
    rows = [(None, HARD[0]), (None, HARD[0]), (5, HARD[2] + HARD[3]), (5, None), (6, HARD[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = personal_data(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("sha")).collect()
    names = ["email", "ip", "card", "phone"]
    expected = []
    for i, t in rows:
        spans = slow(t or "")
        text = ",".join(f"{names[k]}:{a}:{b}" for k, a, b in spans)
        expected.append((str(i), *(sum(k == n for k, _, _ in spans) for n in range(4)), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(expected)
    assert personal_data(no_documents).collect() == [] and masked(no_documents).collect() == []
    assert masked(odd_documents).count() == len(odd_rows)


def test_many_addresses_in_one_text(spark):
    """Time grows with the text: candidates are held against the spans in order, not against all of them."""
    text = " ".join(f"user{i}@host{i % 97}.org, no {100000 + i}" for i in range(40_000))
    began = time.monotonic()
    row = personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert row.n_email == 40_000
    assert time.monotonic() - began < 60
