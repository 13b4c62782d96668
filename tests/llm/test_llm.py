"""Operators of shopwright.llm: brute force, edge cases, SQL parity."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from shopwright.llm import decontam, licenses, linededup, maxent, packing, quality, queries, secrets, simhash, topk, toxicity

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, fp string, h string, rank int"
ODD = [(1, None, None, None, None, "x", "y", 1), (2, "", "en", "a", 0, None, None, 2), (None, "one two three four five", "en", None, 5, None, None, 3),
       (3, "same words here again and again", "en", "a", 1, "", "", 4), (3, "same words here again and again", "en", "a", 1, "", "", 4),
       (4, "lang " * 40_000, "zz", "b", 9, None, None, None)]
LABELS = "doc_id long, quality int, toxic int, text string"
TOKENIZER = __import__("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql_parity(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    cols = sorted(want.columns)
    key = lambda d: sorted(map(tuple, d[cols].astype(str).to_numpy()))
    assert sorted(got.columns) == cols and key(got) == key(want)


def _fingerprint(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(z >> b & 1 for z in h) > len(h))


def test_simhash_brute_force(spark, docs):
    f = {i: _fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in f}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in sorted(f):
        for b in sorted(f):
            if a < b and (f[a] ^ f[b]).bit_count() <= 4 and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = queries.op1_simhash(spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{f[i]:016x}", find(i)) for i in f}


def test_simhash_links_are_complete(spark):
    rng = np.random.default_rng(1)
    fps = {0}
    for _ in range(60):
        x = int(rng.integers(0, 1 << 63))
        fps.add(x)
        for _ in range(6):
            y = x
            for p in rng.integers(0, 64, rng.integers(1, 7)):
                y ^= 1 << int(p)
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    got = queries.op10_packing(spark, SF).toPandas()
    for i, x in list(docs.items())[:60]:
        ids = np.array(t.encode(x, add_special_tokens=False).ids + [0], "<u4")
        rows = got[got.doc_id == i].sort_values("piece")
        assert list(rows.ids_crc32) == [zlib.crc32(ids[k:k + 2048].tobytes()) for k in range(0, len(ids), 2048)]
    q = got.sort_values(["sequence_id", "offset"])
    assert (q.groupby("sequence_id").length.cumsum() - q.length == q.offset).all()
    assert q.groupby("sequence_id").length.sum().max() <= 2048


def test_packing_plan_is_tight():
    rng = np.random.default_rng(3)
    h = Counter(int(x) for x in rng.integers(1, 2049, 20_000)) + Counter({3: 5_000, 2048: 40, 1: 9_000})
    used = Counter()
    for length, r0, n, first, each, at in packing.plan(h, 2048):
        for k in range(n):
            used[first + k // each] += length
    assert sum(used.values()) == sum(x * n for x, n in h.items()) and max(used.values()) <= 2048
    assert len(used) <= 1.08 * max(sum(used.values()) / 2048, sum(n for x, n in h.items() if x > 1024))


def test_word_encoder_odd_words():
    e = packing.WordEncoder(TOKENIZER)
    for t in ("It's ÉTÉ... <|endoftext|> x\u0085y a\x1cb 12,5 ﬁń Straße!!", "　wide space", "İstanbul ΣΑΣ"):
        assert np.frombuffer(e.text(t), "<u4").tolist() == e.whole.encode(t, add_special_tokens=False).ids


def test_topk_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, None), (2, [float("nan"), 1.0]), (3, [1.0, 0.5]), (20, [0.0, -1.0]), (None, [1.0, 1.0]), (5, [1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2, shard_rows=2, block_rows=1).collect()
    assert all(r["vec_id"] != r["query_id"] and r["vec_id"] in (0, 3, 20) for r in got)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_topk_searches_a_batch_together():
    # a batch's leaves are matrix products: few products for many queries, the same results as query by query
    rng = np.random.default_rng(11)
    x = np.floor(64 * np.concatenate([rng.normal(size=(5000, 8)), np.tile(rng.normal(size=8), (1500, 1))]))
    ids = np.sort(rng.integers(0, 6000, len(x)))  # repeated ids
    q, own = x[::20], ids[::20]
    s = topk.Search(x, ids, q, own, 7, np.full(len(q), -(1 << 62)))
    leaves = []
    inner = s.leaf
    s.leaf = lambda node, at: (leaves.append(len(at)), inner(node, at))
    who, found, scores = s.run(topk.build(x, np.arange(len(x))))
    got = {}
    for w, i, v in sorted(zip(who.tolist(), found.tolist(), scores.tolist()), key=lambda t: (t[0], -t[2], t[1])):
        got.setdefault(w, []).append((-int(v), i))
    for n in range(len(q)):
        each = x @ q[n]
        assert got[n] == sorted((-int(v), int(i)) for v, i in zip(each, ids) if i != own[n])[:7]
    assert len(leaves) < len(q)


def test_topk_many_shards(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    got = topk.top_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), k=5, shard_rows=90, block_rows=7).collect()
    q = np.floor(64 * x).astype(int)
    for i in range(0, 400, 20):
        want = sorted(((-int(q[i] @ q[j]), j) for j in range(400) if j != i))[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == want


def test_quality_and_toxicity(spark):
    sf = "/root/testdata/sf0.01"  # the smallest scale has 11 untrusted documents
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    q = queries.op2_quality(spark, sf).toPandas().set_index("doc_id").join(labels, how="inner")
    assert q[q.quality == 1].keep.mean() > 0.98 and q[q.quality == 0].keep.mean() < 0.2
    t = queries.op6_toxicity(spark, SF).toPandas()
    assert t.score.between(0, 1).all() and set(t.predicted) <= {0, 1}


def test_language_model(spark, docs):
    got = queries.op9_maxent(spark, SF).toPandas().set_index("doc_id")
    c = Counter(w for i, t in docs.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in maxent.tokens(t.encode()))
    n, v = sum(c.values()), len(c)
    for i, t in docs.items():
        ws, r = maxent.tokens(t.encode()), got.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


def test_decontamination_tolerates_substitutions(spark):
    words = [f"w{i}" for i in range(30)]
    changed = words[:]
    changed[5] = changed[20] = "other"
    docs = spark.createDataFrame([(1, " ".join(["x"] * 9 + changed)), (2, " ".join(words[:9])), (3, None), (4, ""), (None, " ".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words)), (8, None), (9, "short one")], "item_id long, text string")
    assert [(r[0], r[1]) for r in decontam.hits(docs, bench).collect()] == [(1, 7)]
    assert decontam.flags(docs, bench.limit(0)).where("contaminated").count() == 0


def test_licenses_against_plain_search(spark, docs):
    got = queries.op4_licenses(spark, SF).collect()
    for name in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT"):
        want = {i for i, t in docs.items() if licenses.TEMPLATES[name] in t}
        assert want == {r["doc_id"] for r in got if r["license"] == name}
    assert all(r["coverage"] >= 0.8 and r["span_start"] < r["span_end"] for r in got)


def test_secrets_trained_from_findings(spark):
    docs = spark.createDataFrame([(1, "my token = \"0123456789abcdef0123\" end", "src"), (2, "averylongordinaryword here", None), (3, None, "a"), (4, "", "b")], "doc_id long, text string, source string")
    good = [("p", "token = \"", f"{i}a9b8c7d6e5f4a3b2{i}", 1.0) for i in range(40)]
    bad = [("p", "the", "ordinary" + "word" * (2 + i % 4), 0.0) for i in range(40)]
    got = secrets.scan(docs, spark.createDataFrame(good + bad, "path string, before string, value string, label double")).collect()
    assert {(r["doc_id"], r["is_secret"]) for r in got} == {(1, True), (2, False)}


def test_line_dedup_rules(spark):
    rows = [(i, f"menu\nown {i}\n\nmenu", None) for i in range(6)] + [(9, None, "b"), (10, "", "b")]
    got = {r["doc_id"]: r for r in linededup.clean(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0]["text"] == "own 0\n" and got[0]["n_dropped"] == 2 and got[9]["text"] is None and got[10]["text"] == ""


def test_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0, "x"), (None, 1, 1, None), (4, None, None, None)], LABELS)
    bench = spark.createDataFrame([(1, "a b"), (None, None)], "item_id long, text string")
    for d, n in ((odd, len(ODD)), (empty, 0)):
        assert simhash.near_duplicates(d).count() == (5 if n else 0)
        assert quality.classify(d, labels).count() == n
        assert linededup.clean(d).count() == n
        assert licenses.scan(d).count() == 0
        secrets.scan(d).collect()
        assert toxicity.classify(d, labels).count() == n
        decontam.flags(d, bench).collect()
        assert maxent.log_probability(d).count() == n
        assert len({r["sequence_id"] for r in packing.pack(d, TOKENIZER).collect()}) >= (n > 0)


def test_pipeline(spark, docs):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert 0 < got.doc_id.nunique() < len(docs)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == corpus_pipeline.COLUMNS


def test_language_model_joins_what_it_does_not_look_up(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    keep = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    looked, joined = (maxent.log_probability(documents, common_share=x).toPandas().sort_values("doc_id") for x in (1e-6, 2.0))
    assert (looked[keep].to_numpy() == joined[keep].to_numpy()).all()
    for c in ("base_score", "score"):
        assert np.allclose(looked[c], joined[c])


def test_copies_of_a_page_are_one_page(spark):
    import corpus_pipeline
    rng = np.random.default_rng(11)
    page = lambda k: "\n".join(["home about contact"] + [" ".join(f"{k}x{int(x)}" for x in rng.integers(0, 10_000, 12)) for _ in range(4)])
    own = [page(f"p{i}") for i in range(44)]
    a, b = page("a"), page("b")
    rows = [(i, t, "en", "few", len(t)) for i, t in enumerate(own + [a] * 5)]  # 5 rows of 49
    rows += [(100 + i, t, "en", "third", len(t)) for i, t in enumerate([page(f"q{i}") for i in range(40)] + [b] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.line_stage(spark, docs, SF).checkpoint()
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(texts[i] == t.split("\n", 1)[1] for i, t, *_ in rows)
    left = {r["doc_id"] for r in corpus_pipeline.near_dup_stage(spark, cut, SF).collect()}
    assert left == set(range(45)) | set(range(100, 141))


def test_decontamination_against_every_window(spark):
    from itertools import combinations
    rng = np.random.default_rng(13)
    items = {n: [f"i{n}t{k}" for k in range(n)] for n in (1, 3, 7, 8, 10, 12, 13, 15, 16, 18, 24)}
    items[30] = ["a", "b"] * 15
    texts = []
    for n, w in items.items():
        changes = [()] + [(k,) for k in range(n)] + list(combinations(range(n), 2)) + [tuple(rng.choice(n, 3, replace=False)) for _ in range(10 * (n > 2))]
        for c in changes:
            new = ["other" if k in c else x for k, x in enumerate(w)]
            texts += [new, ["x"] * int(rng.integers(1, 9)) + new + ["y"] * int(rng.integers(0, 4))]
        texts += [w[k:] for k in range(n)] + [["x"] + w[:k] + ["y"] for k in range(n)]

    def hit(item, text):
        n = min(len(item), 13)
        return any(sum(x != y for x, y in zip(item[p:p + n], text[q:q + n])) <= (2 if n == 13 else 0)
                   for p in range(len(item) - n + 1) for q in range(len(text) - n + 1))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    want = {(i, n) for i, t in enumerate(texts) for n, w in items.items() if hit(w, t)}
    got = [(r[0], r[1]) for r in decontam.hits(docs, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    long = {n for n in items if n >= 8}
    assert {x for x in decontam.hits(docs, bench.where("item_id >= 8")).collect()} == {x for x in want if x[1] in long}


def test_secrets_of_every_form_in_the_registered_query(spark, tmp_path):
    rng = np.random.default_rng(17)
    run = lambda n: "".join(rng.choice(list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"), n))
    upper = lambda n: "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZ234567"), n))
    planted = {}
    for i in range(8):
        planted |= {  # no hint word but a prefix
            f"we cloned it with ghp_{(a := run(36))} on the build host": f"ghp_{a}", f"posted by gho_{(a := run(36))}, see the log": f"gho_{a}",
            f"the bot xoxb-{(a := upper(24))} went away": f"xoxb-{a}", f"charge sk_live_{(a := run(24))} today": f"sk_live_{a}", f"user AKIA{(a := upper(16))} logged in": f"AKIA{a}",
            # short, or broken by signs
            f'{i} password = "hunter{i}!" then': f"hunter{i}!", f"{i} pwd: a.b$c!{i}@d, next": f"a.b$c!{i}@d", f"{i} PASSWORD='two words {i}';": f"two words {i}",
            f'{{"secret": "s{i}", "n": 1}}': f"s{i}", f'{i} passwd: str = "p{i}#"': f"p{i}#", f"login with {(a := run(30))} which is the token": a}
    plain = ["averylongordinarywordhere stands alone", "internationalisationcommittee met", "password = get_password() was called", "token: ${TOKEN_FROM_ENV} is set", "ASIAN-PACIFIC-REGIONAL trade"] * 8
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    rows = [(10_000 + i, t, "src") for i, t in enumerate([*planted, *plain])]
    base.unionByName(spark.createDataFrame(rows, base.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["secret"], r["is_secret"]) for r in queries.op5_secrets(spark, str(tmp_path)).where("doc_id >= 10000").collect())
    want = Counter((10_000 + i, v, True) for i, v in enumerate(planted.values()))
    assert {k: n for k, n in got.items() if k[0] < 10_000 + len(planted)} == want
    assert not any(yes for i, _, yes in got if i >= 10_000 + len(planted))


def test_licenses_with_one_word_changed_anywhere(spark):
    words, _ = licenses.index(licenses.TEMPLATES)
    texts = [" ".join(["before", "it"] + w[:k] + ["changed"] + w[k + 1:] + ["after"]) for w in words.values() for k in range(len(w))]

    def unfiltered(text):
        have = text.split()
        return {n for n, w in words.items() if max(licenses.align(w, have, s)[0] for s in range(-len(w), len(have))) >= 0.8 * len(w)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(docs).collect()}
    assert all(got.get(i) in want if (want := unfiltered(t)) else i not in got for i, t in enumerate(texts))
    assert len(got) == len(texts)
