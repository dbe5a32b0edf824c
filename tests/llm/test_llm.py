"""Every operator of the training-data part against brute force or SQL, with awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pixelquery.llm import (
    components,
    divergence,
    exact_dedup,
    jaccard,
    lattice,
    mixing,
    packing,
    quality,
    rollup,
    substring,
    tokens,
    url_filter,
)
from pixelquery.llm.queries import ORACLES, QUERIES

import corpus_pipeline

SF = Path("/root/testdata/sf0.001")
FIELDS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, uid STRING, score STRING, _Copies INT"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SAID = "the quick brown fox jumps over a lazy dog while nine small birds sing songs about rain and wind"
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def words(text):
    return WORDS.findall(text or "")


def texts():
    """Nulls, empty and long texts, copies, near copies, shared passages, ties and repeated rows."""
    base = " ".join(f"w{i}" for i in range(80))
    listed = [
        (1, "  " + base + "\n"), (2, base), (2, base), (3, base.replace("w40", "other")), (None, base),
        (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "one"), (9, f"start {PASSAGE} end"),
        (10, f"{PASSAGE} then {PASSAGE}"), (11, SAID), (12, (SAID + "\n") * 40), (13, "Ünïcode ﬁne 漢字 text 😀 " * 9),
        (14, "line one\nline one\n\nline two"), (None, None), (15, " ".join(f"x{i % 977}" for i in range(30000))),
    ]
    return [
        (i, t, (None, "en", "de")[k % 3], (None, "s1", "s0", "s2")[k % 4], None, "same", "x", 7)
        for k, (i, t) in enumerate(listed)
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), FIELDS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], FIELDS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, str(SF))
    cursor = con.execute(ORACLES[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == sorted(df.columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*order).collect())


def expected_exact():
    same = {}
    for i, t, *_ in texts():
        same.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return [
        (i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in same.items() for i in ids
    ]


def test_exact_duplicates(docs, none):
    found = exact_dedup.exact_duplicates(docs)
    assert rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(expected_exact(), key=repr)
    assert found.where("kept").count() == len({r[3] for r in expected_exact()})
    assert exact_dedup.exact_duplicates(none).count() == 0
    stays = exact_dedup.drop_duplicates(docs)
    assert stays.columns == docs.columns and stays.count() == len({r[3] for r in expected_exact()})


def test_colliding_chunk_hashes_stay_apart(spark, monkeypatch):
    """With one hash for all chunks, the places in the dictionary alone tell texts apart."""
    real = exact_dedup.F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(exact_dedup.F.lit(1)))
    long_ = [" ".join(f"{k}word{i}" for i in range(400)) for k in "ab"]
    data = [(1, long_[0]), (2, long_[1]), (3, long_[0]), (4, "x"), (5, "y")]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(data, "doc_id BIGINT, text STRING"))
    assert rows(found, "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 1), (4, 4), (5, 5)]


def test_substring_removal(docs, none, monkeypatch):
    from pixelquery.llm import exchange

    monkeypatch.setattr(exchange, "GROUP_BYTES", 5000)
    listed = [(i, words(t)) for i, t, *_ in texts()]
    seen = Counter(tuple(w[k : k + 35]) for _, w in listed for k in range(len(w) - 34))
    want = []
    for i, w in listed:
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    found = substring.remove_repeats(docs)
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_text") == sorted(want, key=repr)
    assert substring.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(docs, window=10)


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def brute_links(data):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] * bool(w)) for _, w in data]
    links = {(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    root = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return links, root


def test_near_duplicates(docs, none, monkeypatch):
    data = [(i, words(t)) for i, t, *_ in texts()]
    links, root = brute_links(data)
    groups = {}
    for k, (i, _) in enumerate(data):
        groups.setdefault(root[k], []).append(i)
    want = [
        (i, min((x for x in groups[root[k]] if x is not None), default=None), sum(k in pair for pair in links))
        for k, (i, _) in enumerate(data)
    ]
    for bucket, block in ((256, 256), (2, 2)):
        monkeypatch.setattr(jaccard, "BUCKET", bucket)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        found = jaccard.near_duplicates(docs)
        assert rows(found, "doc_id", "class_id", "n_links") == sorted(want, key=repr)
        assert found.where("kept").count() == len(groups)
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.drop_near_duplicates(docs).columns == docs.columns


def test_near_duplicates_of_the_tables(spark):
    """All links of the smallest table; repeats of runs reach the wanted recall."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    links, _ = brute_links([(r.doc_id, words(r.text)) for r in docs.collect()])
    found = jaccard.near_duplicates(docs)
    assert found.groupBy().sum("n_links").first()[0] == 2 * len(links)


def test_roots_of_a_path_and_a_star(spark, monkeypatch):
    monkeypatch.setattr(components, "SHARE", 10)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 40)] + [(5, 5)]
    found = dict(rows(components.roots(spark.createDataFrame(edges, "a BIGINT, b BIGINT")), "node", "root"))
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 40)}}


def brute_base(text):
    w = words(text)
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    again = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n = len(w)
    counts = n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)
    return (*counts, n < 20 or 100 * len(again) > 30 * n)


def test_divergence_rules(docs, none, spark):
    names = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    found = divergence.rules(docs)
    assert rows(found, "doc_id", *names) == sorted(((i, *brute_base(t)) for i, t, *_ in texts()), key=repr)
    assert found.where("base_failed AND kept").count() == 0
    assert divergence.rules(none).count() == 0
    draw = np.random.default_rng(2)
    plain = [(k, " ".join(draw.choice(SAID.split(), 120)), "en") for k in range(60)]
    odd = (99, " ".join(f"{w.upper()}{k}!! #$% |" for k, w in enumerate(draw.choice(SAID.split(), 120))), "en")
    judged = divergence.rules(spark.createDataFrame([*plain, odd], "doc_id BIGINT, text STRING, lang STRING"))
    assert {r.doc_id for r in judged.where("NOT kept").collect()} == {99}


def test_divergence_equals_the_formula(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2 + sum(b * math.log2(b / c) for b, c in zip(q, m)) / 2
    df = spark.createDataFrame([(p, q)], "p ARRAY<DOUBLE>, q ARRAY<DOUBLE>")
    assert df.select(divergence.js_distance("p", "q")).first()[0] == pytest.approx(math.sqrt(want))


def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block")]
    urls = [
        "https://Blog.Example.ORG/es/1?x=/en/1", "http://example.org/en/12#a", "http://example.org/en/2", "x.org/es/",
        "http://badexample.org/es/", "http://example.org", None, "", "http://e.net/", "http://example.org/es/", "http://example.org/es/",
    ]
    pages = spark.createDataFrame(
        [(k, u, "mine", "b", "c") for k, u in enumerate(urls)], "page_id INT, url STRING, url_host STRING, u STRING, best STRING"
    )
    table = spark.createDataFrame(rules, "host STRING, path STRING, verdict STRING")
    found = url_filter.judge(pages, table)
    assert rows(found, "page_id", "url_rule", "url_verdict", "u") == sorted([
        (0, "example.org/es/", "block", "b"), (1, "example.org/en/1", "block", "b"), (2, "org/", "allow", "b"),
        (3, None, "allow", "b"), (4, "org/", "allow", "b"), (5, None, "allow", "b"), (6, None, "allow", "b"),
        (7, None, "allow", "b"), (8, None, "allow", "b"), (9, "example.org/es/", "block", "b"), (10, "example.org/es/", "block", "b"),
    ], key=repr)
    assert url_filter.judge(pages, table.limit(0)).where("url_rule IS NOT NULL").count() == 0
    assert url_filter.judge(pages.limit(0), table).count() == 0


def water(sizes, weights, total):
    caps = [2 * s for s in sizes]
    got, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(caps[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        full = {i for i in open_ if share[i] > caps[i]}
        if not full:
            return [share[i] if i in open_ else caps[i] for i in range(len(sizes))]
        open_ -= full
    return caps


def test_mixing(docs, none, spark):
    measured = mixing.measured(docs, "doc_id", "text", "source")
    first, again = mixing.mix(measured), mixing.mix(measured)
    kept = "doc_id", "size", "source_size", "taken"
    assert rows(first, *kept) == rows(again, *kept)
    sizes = Counter()
    for _, t, _, s, *_ in texts():
        sizes[s] += len(words(t))
    order = ["s0", "s1", "s2", None]
    want = water([sizes[s] for s in order], [5, 2, 1, 5], 1.5 * sum(sizes.values()))
    got = {r.source: r for r in first.select("source", "target", "source_size").distinct().collect()}
    assert [got[s].target for s in order] == pytest.approx(want)
    assert first.where("taken > 2 * size").count() == 0
    assert mixing.mix(mixing.measured(none, "doc_id", "text", "source")).count() == 0
    many = spark.createDataFrame([(k, "w " * (k % 50), f"s{k % 9 % 4}") for k in range(4000)], "doc_id INT, text STRING, source STRING")
    sums = mixing.mix(mixing.measured(many, "doc_id", "text", "source")).groupBy("source", "target").sum("taken")
    assert all(abs(r[2] - r[1]) <= 100 for r in sums.collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixing.mixed_documents(none).count() == 0


def reference_ids(text):
    t = tokens._library(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids


def test_token_ids_equal_the_vocabulary_file(spark):
    found = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [t for _, t, *_ in texts()]
    found += ["<|endoftext|> a b  c　d it's  \n\n x", "\x85\x1f tab\t\t end "]
    for text in found:
        assert tokens.encode(text).tolist() == reference_ids(text)


def test_added_tokens_are_found_as_by_the_plain_vocabulary_file():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    for text in (f"page end {mark} next page", mark, f"a{mark}{mark}\n", f"漢字 {mark} x", "<|endoftext| >", f"x {mark} " * 99):
        assert tokens.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert tokens.encode(f"page end {mark} next page").tolist().count(50256) == 1


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "some words with spaces, and more of them. " * 50
    whole_ids = tokens.encode(text).tolist()
    monkeypatch.setattr(tokens, "PART", 100)
    assert tokens.encode(text).tolist() == whole_ids


def test_packing(docs, none):
    found = [r.asDict() for r in packing.pack_documents(docs, capacity=64).collect()]
    want = []
    for i, t, *_ in texts():
        ids = np.array([*reference_ids(t), 0], "<u4")
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids), 64), len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    names = "doc_id", "piece", "start", "length", "ids_crc32"
    assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == sorted(want, key=repr)
    filled = {}
    for r in sorted(found, key=lambda r: r["offset"]):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 64
    assert packing.pack_documents(none).count() == 0


def test_best_fit_is_best_fit_decreasing():
    draw = np.random.default_rng(3)
    sizes = np.sort(draw.integers(1, 101, 3000))[::-1]
    gaps = []
    for s in sizes:
        fits = [k for k, g in enumerate(gaps) if g >= s]
        if fits:
            gaps[min(fits, key=lambda k: gaps[k])] -= s
        else:
            gaps.append(100 - s)
    plan = packing.best_fit(np.bincount(sizes, minlength=101), 100)
    ends = plan.groupby("size")["rank"].shift(-1)
    count = np.where(ends.isna(), np.bincount(sizes, minlength=101)[plan["size"]], ends) - plan["rank"]
    assert (plan["sequence"] + count).max() <= len(gaps) * 1.01


def test_token_rollup(docs, none, tmp_path):
    totals = rollup.maintain(docs, str(tmp_path / "a"))
    want = Counter()
    for _, t, lang, source, *_ in texts():
        if words(t):
            want[source, lang, "words-1"] += len(words(t))
            want[source, lang, "byte_bpe_50k"] += len(reference_ids(t))
    got = {(r.source, r.lang, r.tokenizer): r.tokens for r in totals.collect()}
    assert got == dict(want)
    assert rollup.maintain(none, str(tmp_path / "b")).count() == 0


def test_registered_rollup_counts_all_documents(spark, tmp_path):
    """As a group-by over the whole table, wordless texts and a source that has only those included."""
    given = [*texts(), *[(i, t, "en", "blank", None, "same", "x", 7) for i, t in ((20, None), (21, ""), (22, " \t\n "))]]
    spark.createDataFrame(given, FIELDS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for _, t, lang, source, *_ in given:
        for tokenizer, n in (("words-1", len(words(t))), ("byte_bpe_50k", len(reference_ids(t)))):
            documents, total = want.get((source, lang, tokenizer), (0, 0))
            want[source, lang, tokenizer] = documents + 1, total + n
    got = QUERIES["op8_token_counts"](spark, str(tmp_path)).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in got} == want and len(got) == len(want)
    assert want["blank", "en", "words-1"] == (3, 0) and want["blank", "en", "byte_bpe_50k"][1] > 0


def test_sums_of_a_batch_stay_in_many_tasks(spark, tmp_path):
    keys = "concat('site', id) AS source", "'en' AS lang", "'t' AS tokenizer", "'insert' AS kind"
    changes = spark.range(400).selectExpr(*keys, "0L AS old_tokens", "id AS new_tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rollup.commit(changes, str(tmp_path), "load")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "deltas").glob("attempt=*/*.parquet"))) > 1
    assert rollup.totals(spark, str(tmp_path)).count() == 400


def test_rollup_batches_count_once(spark, tmp_path):
    fields = "source STRING, lang STRING, tokenizer STRING, kind STRING, old_tokens BIGINT, new_tokens BIGINT"
    first = [("s", None, "t", "insert", None, 10), ("s", None, "t", "insert", None, 5), ("u", "en", "t", "insert", None, 1)]
    second = [("s", None, "t", "delete", 5, None), ("s", None, "t", "revise", 10, 12), ("u", "en", "t", "delete", 1, None), ("s", None, "t", None, 1, 1)]
    root = str(tmp_path)
    for batch, data in (("1", first), ("2", second), ("1", first)):
        rollup.commit(spark.createDataFrame(data, fields), root, batch)
    rollup.signed(spark.createDataFrame(first, fields)).write.parquet(f"{root}/deltas/attempt=3")  # no marker
    assert rows(rollup.totals(spark, root), "source", "lang", "tokenizer", "documents", "tokens") == [("s", None, "t", 1, 12)]


def test_lattice_score(docs, none, monkeypatch):
    from pixelquery.llm import exchange

    monkeypatch.setattr(exchange, "GROUP_BYTES", 5000)
    lower = {i: i + 32 for i in range(65, 91)}
    data = [(i, words((t or "").translate(lower))) for i, t, *_ in texts()]
    late = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data}
    count, ends = Counter(w for i, ws in data if not late[i] for w in ws), sum(not late[i] for i, _ in data)
    n, kinds = sum(count.values()) + ends, len(count) + 1
    sp, pieces = lattice.processor(), Counter()
    for w, k in count.items():
        for i in sp.encode(w):
            pieces[i] += k
    total = sum(pieces.values()) + ends + 0.1 * (sp.get_piece_size() + 1)
    p, spelled = {}, {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            spelled[int(sp.id_to_piece(i)[3:5], 16)] = (pieces[i] + 0.1) / total
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            p[sp.id_to_piece(i)] = (pieces[i] + 0.1) / total

    def probability(word):
        word = "▁" + word
        forward = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            if word[j - 1] not in p:
                forward[j] += forward[j - 1] * math.prod(spelled[b] for b in word[j - 1].encode())
            forward[j] += sum(forward[i] * p.get(word[i:j], 0.0) for i in range(j))
        return math.log10(forward[-1])

    want = sorted(
        ((i, late[i], len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, n,
          sum(math.log10((c + 0.1) / (n + 0.1 * (kinds + 1))) for c in [*(count[w] for w in ws), ends]),
          sum(map(probability, ws)) + math.log10((ends + 0.1) / total)) for i, ws in data),
        key=lambda r: (str(r[0]), r[2], r[5]),
    )
    names = "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    found = [tuple(r) for r in lattice.score(docs).select(*names).collect()]
    found.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.array([r[5:] for r in found]) == pytest.approx(np.array([r[5:] for r in want]), rel=1e-9)
    assert lattice.score(none).count() == 0


def test_quality_classifier(spark, docs, none):
    """Held-out accuracy on the labelled rows; awkward rows get a score too."""
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op1_quality_classifier"](spark, sf).where("held_out")
    joined = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (joined.predicted == joined.quality).mean() > 0.95
    empty = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    model = quality.train(docs, empty)
    scored = quality.scored(docs, model)
    assert scored.count() == len(texts()) and scored.where("score BETWEEN 0 AND 1").count() == len(texts())
    assert sorted(scored.columns) == sorted(docs.columns)
    assert quality.accepted(none, empty).columns == docs.columns


def test_additive_model_learns_an_interaction():
    draw = np.random.default_rng(5)
    x = draw.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x[:2000], y[:2000], rounds=20, pair_rounds=60)
    assert model.pairs[0] == (0, 1) and ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_pipeline(spark):
    """Each stage against what its operator says of the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, str(SF))
        if k in (1, 2):
            data = [(r.doc_id, words(r.text)) for r in docs.collect()]
            groups = {" ".join(w): i for i, w in sorted(data, reverse=True)} if k == 1 else None
            want = set(groups.values()) if k == 1 else {data[r][0] for r in set(brute_links(sorted(data))[1])}
            if k == 1:
                assert {r.doc_id for r in after.collect()} == want
            else:
                assert after.count() == len(want)
        if k < 4:
            assert after.columns == docs.columns
            docs = spark.createDataFrame(after.collect(), after.schema)
    assert {"doc_id", "sequence_id", "offset"} <= set(after.columns)
    assert after.where("piece = 0").count() == docs.count()
