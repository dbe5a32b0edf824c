"""Whole results recomputed plainly: the classifier's features and tables, links of the Jaccard join in deep splits."""

import math
import re
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pixelquery.llm import jaccard, quality

import corpus_pipeline

SF = Path("/root/testdata/sf0.01")
SPACE = " \t\n\v\f\r"
TEXTS = [
    None, "", " \n\t", "One", "One two, two two!\nOne two, two two!\n\n #tag $5 <b> 123", "Ünï ünï 漢字 😀 😀",
    "a\n" * 50 + "B" * 200, "x,y;z:w?" * 30, "line one\r\nline one\r\nline two",
]


def features(text):
    """The same twelve numbers, letter by letter."""
    raw = (text or "").encode()
    words = [w for w in re.split(rb"[ \t\n\v\f\r]+", raw) if w]
    n, size = len(words), sum(map(len, words))
    if not n:
        return [0.0] * 12
    lines = [x for x in raw.split(b"\n") if re.search(rb"[^ \t\n\v\f\r]", x)]
    of = lambda keep: sum(1 for b in raw if keep(b)) / size
    return [
        math.log(1 + n), size / n, of(lambda b: 65 <= b <= 90), of(lambda b: 48 <= b <= 57),
        of(lambda b: chr(b) in "#*$%&|<>"), of(lambda b: b == 33), of(lambda b: chr(b) in ".,;:?"), of(lambda b: b > 127),
        math.log(1 + n / max(1, len(lines))), sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
    ]


@pytest.mark.parametrize("text", TEXTS)
def test_features_of_the_classifier(text):
    assert quality.text_features(text) == pytest.approx(features(text))


def test_scores_are_sums_of_table_entries(spark):
    draw = np.random.default_rng(4)
    x = draw.random((400, 12))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id INT, text STRING")
    for row in quality.scored(docs, model).collect():
        values, total = features(row.text), model.start
        bins = lambda f, edges: sum(e <= values[f] for e in edges[f])
        for f, table in enumerate(model.tables):
            total += table[bins(f, model.edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[bins(a, model.coarse), bins(b, model.coarse)]
        assert row.score == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, total)))))


def test_no_link_is_missed_when_buckets_split_often(spark, monkeypatch):
    """Recall against all pairs of a whole table, with buckets of 8 sets, so that paths split many times."""
    monkeypatch.setattr(jaccard, "BUCKET", 8)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets, owners = {}, {}
    for row in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        grams = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets[row.doc_id] = grams
        for gram in grams:
            owners.setdefault(gram, []).append(row.doc_id)
    shared = {}
    for ids in owners.values():
        for pair in combinations(sorted(ids), 2):
            shared[pair] = shared.get(pair, 0) + 1
    links = dict.fromkeys(sets, 0)
    for (a, b), n in shared.items():
        if 9 * n >= 4 * (len(sets[a]) + len(sets[b])):  # n / (A + B - n) >= 4 / 5
            links[a] += 1
            links[b] += 1
    assert sum(links.values()) > 100
    found = {r.doc_id: r.n_links for r in jaccard.near_duplicates(docs).collect()}
    assert found == links


def test_pipeline_of_empty_tables(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
