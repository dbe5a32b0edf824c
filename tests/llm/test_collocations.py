"""Collocations against counting all phrases, for several numbers of shards and small blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pixelquery.llm import collocations

FIELDS = "doc_id BIGINT, text STRING, lang STRING, k INT, g STRING, phrase STRING"
UPPER = {c: c + 32 for c in range(65, 91)}


def made():
    draw = random.Random(11)
    words = ["a", "b", "C", "D d", "Ä", "ä", "漢字", "x-y", "new york city"] + [f"w{i}" for i in range(40)]
    rows = []
    for k in range(60):
        body = []
        for _ in range(draw.randint(0, 60)):
            body.append(draw.choice(words[: 9 if draw.random() < 0.6 else None]))
            body.append(draw.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "!", "\r\n"]))
        rows.append((k, "".join(body), draw.choice(["en", "en", "en", "fr", None])))
    rows += [rows[0]] * 3 + [(None, None, None), (1, "", "zz"), (2, "one of a kind", "yy"), (3, "a a a a a a a a", "en")]
    return [(*r, 7, "other", "same") for r in rows]


def expected(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {
            p[i:j] for p, a in held.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1)
            if j - i < len(p) and 100 * a >= 100 * counts[p[i:j]]
        }
        scored = []
        for p, a in held.items():
            if p in inside:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        scored.sort()
        out += [
            (lang, i + 1, p.decode(), -a, l, r, n[lang], -score) for i, (score, a, p, l, r) in enumerate(scored[:top])
        ]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(
    ("shards", "least", "longest", "top", "words", "share"),
    [(2, 4, 5, 2000, 300, 2), (3, 6, 3, 10, 400, 7)],
)
def test_counts_are_exact(spark, monkeypatch, shards, least, longest, top, words, share):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", words)
    monkeypatch.setattr(collocations, "OPEN_WORDS", 2 * words)
    monkeypatch.setattr(collocations, "BUCKET_SHARE", share)
    rows = made()
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    found = collocations.collocations(docs, least=least, longest=longest, top=top, shards=shards)
    assert got(found) == expected(rows, least, longest, top)


def test_nothing_found(spark):
    docs = spark.createDataFrame(made(), FIELDS)
    assert got(collocations.collocations(docs.limit(0))) == []
    assert got(collocations.collocations(docs, least=10**6)) == []
    once = spark.createDataFrame([(1, "a. a. a. b", "en")], "doc_id BIGINT, text STRING, lang STRING")
    assert got(collocations.collocations(once, least=3)) == []


def test_packed_arrays_come_back():
    for kind in (np.int32, np.int64):
        for values in ([], [5], [0, -1, 2**31 - 1, 7] * 1000):
            packed = collocations.pack(np.array(values, kind))
            assert collocations.unpack(packed, kind).tolist() == values
