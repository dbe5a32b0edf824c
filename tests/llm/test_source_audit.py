"""Source divergence against exact arithmetic over all terms, with small blocks, nulls, ties and repeats."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pixelquery.llm import source_audit

FIELDS = "doc_id BIGINT, text STRING, lang STRING, source STRING, term INT, gid STRING"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def made(n=120):
    draw = random.Random(3)
    parts = ["an", "ber", "the", "ther", "Ö", "漢", "zq", "A", "x" * 90]
    rows = [
        (
            k,
            " ".join("".join(draw.choices(parts[: 3 + k % 7], k=draw.randint(1, 3))) for _ in range(draw.randint(0, 30))),
            draw.choice(["en", "en", "de", None, ""]),
            draw.choice(["s0", "s0", "s0", "s1", "s2", None]),
        )
        for k in range(n)
    ]
    rows += [rows[0], rows[0], (None, None, "en", "s9"), (1, "", "fr", "s1"), (1, "one two", "fr", "s2"), (2, "Once", "it", "a")]
    return [(*r, 5, "other") for r in rows]


def expected(rows, least=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        found = Counter(TERM.findall((text or "").translate(UPPER)))
        docs[lang or ""].update(found.keys())
        counts[lang or "", source or ""].update(found)
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [
                ((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                found = found[:top] if part == "term" else found
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("small", [False, True])
def test_audit(spark, monkeypatch, small):
    if small:
        for name, value in (("WORDS", 90), ("DIFFERENT", 40), ("BLOCK", 15), ("LEVELS", 4), ("CELLS", 5)):
            monkeypatch.setattr(source_audit, name, value)
    rows = made()
    docs = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert got(source_audit.audit(docs)) == expected(rows)
    assert got(source_audit.audit(docs, least=1, top=3)) == expected(rows, 1, 3)
    assert source_audit.audit(docs.limit(0)).collect() == []


def test_refinement_keeps_what_counting_keeps():
    draw = random.Random(5)
    for _ in range(200):
        n_docs, least = draw.randint(1, 12), draw.randint(1, 4)
        has = defaultdict(set)
        for d in range(n_docs):
            for _ in range(draw.randint(0, 8)):
                has[draw.choice([0, 1]), "".join(draw.choices("ab", k=draw.randint(1, 5))).encode()].add(d)
        keys = sorted(has)
        if not keys:
            continue
        seen = [sorted(has[k])[:least] for k in keys]
        alive = source_audit.refine(
            [t for _, t in keys],
            np.array([k == 0 or keys[k - 1][0] != keys[k][0] for k in range(len(keys))]),
            np.array([len(has[k]) for k in keys]),
            np.repeat(np.arange(len(keys)), [len(s) for s in seen]),
            np.array(sum(seen, []), np.int64),
            least,
        )
        assert [keys[i] for i in alive] == [k for k in keys if len(has[k]) >= least]


def test_shares_beyond_a_long(spark):
    n, of, terms = 5 * 10**12, 9 * 10**12, 7
    row = spark.createDataFrame([(n, of, terms)], "n BIGINT, of BIGINT, terms BIGINT")
    assert row.select(source_audit.share("n", "of")).first()[0] == 1 + 10**9 * (n + 1) // (of + terms)
