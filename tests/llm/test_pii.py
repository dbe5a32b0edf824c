"""Personal data: the base patterns against the plain ones, checksums, words nearby, awkward rows."""

import hashlib
import re
import time
from pathlib import Path

import pytest
from pixelquery.llm import pii
from pixelquery.llm.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
FIELDS = "doc_id BIGINT, text STRING, SPANS STRING, _text STRING, `a.b` INT"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "no data", "a.b@c.de, a@b.c_d@e.f x@y @z.w q@@r.s .@-.-",
    "1.2.3.4 1.2.3.4.5.6 256.1.1.1 1.1.1.1.1.1.1.1 0001.002.3.255 9999999.1.1.1",
    "4539 1488 0343 6467, 4539-1488-0343-6467 4539148803436467 45391488034364671 79927398713",
    "+1 (743) 555-3824 +49 30 1234567 +1 2 ++123456789012 +12345678901234567 +1(((((", "Ünï +33 1 23 45 67 89 漢😀 x@y.zz",
    "+12 1.2.3.4 4539148803436467", "5" * 40, "1.2.3.4@x.yy", "mail a@b.cc" * 300,
]


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1])))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def plain(text):
    found = [
        (kind, *m.span()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], list(PLAIN).index(s[0])))


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert [s[:3] for s in pii.find(text or "") if s.base] == plain(text)


def test_checksums():
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in pii.find(text) if not s.base]


def test_spans_of_the_method():
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 please") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("pay to DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    assert kinds("pay to DE89370400440532013001.") == []
    assert kinds("her social security number 123-45-6789") == [("ssn", "123-45-6789")]
    assert kinds("part 123-45-6789") == [] and kinds("ssn 000-45-6789") == []
    assert kinds("phone 030 123 4567") == [("tel", "030 123 4567")]
    assert kinds("on 030 123 4567") == [] and kinds("order, phone 030 123 4567") == []
    assert kinds("phone +49 030 123 4567") == []  # a base span covers it


def test_words_nearby_move_the_score():
    alone = pii.score("card", "4539148803436467", 0, 16)
    assert pii.score("card", "visa 4539148803436467", 5, 21) > alone > pii.score("card", "isbn 4539148803436467", 5, 21)


def test_hostile_texts_take_linear_time():
    n = 1 << 20
    start = time.time()
    for text in ("a" * n, "1" * n, "@" * n, "@a.b " * (n // 5), "1.1.1." * (n // 6), "+1" + "(" * n, "12 " * (n // 3)):
        pii.find(text)
    assert time.time() - start < 60


def test_rows(spark):
    data = [(k if k % 5 else None, t, "old", "kept", k) for k, t in enumerate(TEXTS + TEXTS[:2])]
    docs = spark.createDataFrame(data, FIELDS)
    found = pii.with_spans(docs)
    assert found.columns == ["doc_id", "text", "_text", "a.b", "spans"]
    got = {r["a.b"]: r for r in found.collect()}
    assert len(got) == len(data)
    for k, (i, text, *_) in enumerate(data):
        assert (got[k]["doc_id"], got[k]["text"], got[k]["_text"]) == (i, text, "kept")
        assert [tuple(s)[:3] for s in got[k]["spans"] if s["base"]] == plain(text)
    assert pii.with_spans(docs.limit(0)).collect() == []
    clear = {r["a.b"]: r["text"] for r in pii.masked(docs).collect()}
    assert clear[0] is None and clear[2] == "no data" and clear[4].startswith("<ip> <ip>.5.6 256.1.1.1")


def test_query(spark):
    rows = QUERIES["op12_pii"](spark, str(SF)).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in PLAIN]
        said = ",".join(":".join(map(str, s)) for s in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
