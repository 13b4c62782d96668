"""Collocations, rule ledger and whitening: brute force, edge cases, SQL parity."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from shopwright.llm import collocations, queries, ruleledger, whitening

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, phrase string, n long, fail_bits int, f string, m int, rank int"
EXTRA = ("x", 1, 2, "y", 3, 4)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(spark, rows):
    """rows: (doc_id, text, lang); columns whose names clash with the operators' own follow."""
    return spark.createDataFrame([(i, t, lang, "s", 0, *EXTRA) for i, t, lang in rows], DOC)


def _brute_collocations(rows, max_words=3, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = tuple(x for x in re.split("[ \t]", piece) if x)
            n[lang or "und"] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang or "und", w[i:i + m]) for i in range(len(w) - m + 1))
    cand = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    out = []
    for (lang, p), a in cand.items():
        if any(k == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (k, q), b in cand.items()):
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    out.sort()
    seen, ranked = Counter(), []
    for lang, score, a, p, left, right, total in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p.decode(), -a, left, right, total, -score))
    return ranked


def _mixed_texts():
    rng = np.random.default_rng(5)
    vocab = ["the", "The", "of", "new", "york", "city", "été", "x#", "\x00", "rare", "a", "b"]
    rows = []
    for k in range(150):
        text = "".join(str(rng.choice(vocab)) + str(rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "?"])) for _ in range(int(rng.integers(0, 90))))
        rows.append((k, text, [None, "en", "en", "und"][k % 4]))
    return [*rows, *rows[:20], (None, None, None), (7, "", "fr"), (8, "new york " * 5000 + "city", "en"), (9, ".,;:!?", "de")]


@pytest.mark.parametrize("max_words, least, top, buffer", [(3, 10, 2000, 2_000_000), (4, 3, 25, 300), (2, 2, 5, 1)])
def test_collocations_brute_force(spark, max_words, least, top, buffer):
    rows = _mixed_texts()
    got = collocations.mine(_rows(spark, rows).repartition(3), max_words, least, top=top, buffer=buffer).collect()
    assert sorted(map(tuple, got)) == sorted(_brute_collocations(rows, max_words, least, top=top))


def test_collocations_ties_keep_the_smallest_cut_and_phrase(spark):
    rows = [(1, "p q r. " * 10 + "b c. " * 10 + "a c1. " * 10, "en")]
    got = collocations.mine(_rows(spark, rows)).collect()
    assert [(r["rank"], r["phrase"], r["l"], r["r"], r["score"]) for r in got] == [(1, "a c1", 10, 10, 10 ** 6), (2, "b c", 10, 10, 10 ** 6), (3, "p q r", 10, 10, 10 ** 6)]


def test_collocations_merge_join_streams(spark):
    stream = collocations.counts(_rows(spark, _mixed_texts()))
    plan = collocations.scored(stream)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" not in plan


def test_collocations_product_beyond_64_bits(spark):
    big = 5_000_000_000
    stream = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1), ("en", None, 0, 4 * big)], "lang string, phrase string, m int, f long")
    assert collocations.scored(stream).first()["score"] == 10 ** 6 * (big - 1) ** 2 // (big * (big + 1))


def test_empty_tables(spark):
    docs = _rows(spark, [])
    assert collocations.mine(docs).collect() == [] and ruleledger.judge(docs).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert whitening.whiten(vectors).collect() == []
    none = whitening.whiten(spark.createDataFrame([(1, None), (2, [None, 1.0]), (3, [float("inf")]), (4, [float("nan")]), (5, [])], "vec_id long, embedding array<float>"))
    assert none.collect() == [] and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def _brute_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    inside = {i + j for i, v in enumerate(windows) if often[v] > 1 for j in range(8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_lines": len(lines),
            "n_letter_words": sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in x) for x in w),
            "n_bullet_lines": sum(x.strip(" \t\n\r\x0b\x0c")[0] in "-*•" for x in lines),
            "n_ellipsis_lines": sum(x.strip(" \t\n\r\x0b\x0c").endswith(("...", "…")) for x in lines),
            "top_word": max(Counter(w).values(), default=0), "n_stutters": sum(a == b for a, b in zip(w, w[1:]))}


LEDGER_ROWS = [
    (1, None, "en"), (2, "", None), (None, "word " * 30, "en"), (3, "a b c d e f g h " * 2 + "tail", "en"), (3, "a b c d e f g h " * 2 + "tail", "en"),
    (4, " \n\x0b \n", "en"), (5, "- eins…\n* zwei ...\n• drei\n\n- eins…\n x y  ", "de"), (6, "$$$ ### a|b <tag> 100% &c *", "en"),
    (7, "same line\n" * 5 + "other", "en"), (8, "\x00 \x1c\x85 é日本 " * 10, "xx"), (9, "long " * 50_000 + "end", "en"),
    (10, " ".join(f"w{k % 17}" for k in range(200)), "en"), (11, " ".join(f"word{k}" for k in range(60)), "en")]


def test_ledger_brute_force(spark):
    got = ruleledger.ledger(_rows(spark, LEDGER_ROWS).repartition(2)).collect()
    assert sorted((r["doc_id"] or 0, *[r[m] for m in ruleledger.MEASURES]) for r in got) == sorted(
        (i or 0, *[_brute_measures(t)[m] for m in ruleledger.MEASURES]) for i, t, _ in LEDGER_ROWS)


def test_policies_and_ablation(spark):
    docs = _rows(spark, LEDGER_ROWS)
    rows = ruleledger.ledger(docs).cache()
    for version, names in ruleledger.POLICIES.items():
        judged = ruleledger.apply_policy(rows, version).collect()
        fails = [{name for k, (name, _) in enumerate(ruleledger.RULES) if r["fail_bits"] >> k & 1} & set(names) for r in judged]
        assert [r["kept"] for r in judged] == [not f for f in fails]
        assert [r["base_failed"] for r in judged] == [bool(f & set(ruleledger.BASE)) for f in fails]
        assert [r["sole_rule"] for r in judged] == [next(iter(f)) if len(f) == 1 else "none" for f in fails]
        got = {r["rule"]: (r["n_failed"], r["n_sole"], r["n_kept"], r["n_kept_without"]) for r in ruleledger.ablation(rows, version).collect()}
        kept = sum(not f for f in fails)
        assert got == {x: (sum(x in f for f in fails), sum(f == {x} for f in fails), kept, sum(not f - {x} for f in fails)) for x in names}


def test_repeated_windows_do_not_cross_texts():
    texts = [b"a b c d", b"e f g h", b"a b c d e f g h a b c d e f g h"]
    assert ruleledger.measure(texts)["n_repeat_words"].tolist() == [0, 0, 16]


def test_clean_documents_stay_and_junk_goes(spark):
    kept = {r["doc_id"]: r["kept"] for r in queries.op12_rules(spark, "/root/testdata/sf0.01").select("doc_id", "kept").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    text = {r["doc_id"]: len((r["text"] or "").split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1 and text[r["doc_id"]] >= 20]
    bad = [kept[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def _check_whitening(rows, got):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    shifted = (x - x.min(0)).astype(np.float64)
    centred = shifted - shifted.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = ((n * x - s) ** 2).sum(1)
    key = lambda r: (r["component"], r["deviation"], abs(r["whitened"]))
    want = [{"component": k + 1, "deviation": int(d), "whitened": float(c @ vectors[:, k] / math.sqrt(values[k]))}
            for c, d in zip(centred, deviation) for k in range(min(8, x.shape[1]))]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert (g["component"], g["deviation"]) == (w["component"], w["deviation"]) and abs(abs(g["whitened"]) - abs(w["whitened"])) < 1e-7
        assert g["n"] == n and abs(g["explained"] / (values[g["component"] - 1] / values.sum()) - 1) < 1e-9 and g["identity_error"] < 1e-9


def test_whitening_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, SF).collect()
    _check_whitening(rows, got)
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}


def test_whitening_wide_values_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(k % 50, [float(v) for v in rng.normal(0, [1, 30, 2e3, 0.1], 4)]) for k in range(199)]
    good += [(None, good[0][1]), (1, good[0][1])]
    odd = [(900, None), (901, [1.0, None, 2.0, 3.0]), (902, [float("inf")] * 4), (903, [float("nan")] * 4), (904, [])]
    df = spark.createDataFrame([(i, v, 1, "c", 2) for i, v in good + odd], "vec_id long, embedding array<double>, n int, x string, component int")
    _check_whitening(good, whitening.whiten(df.repartition(3)).collect())


def test_whitening_degenerate_and_mixed_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0]), (4, [7.0]), (5, [6.0])], "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df).collect()}
    assert sorted(got) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1), (5, 1)]
    assert all(got[i, k]["whitened"] is None and got[i, k]["identity_error"] is None and got[i, k]["n"] == 2 for i in (1, 2) for k in (1, 2))
    assert got[5, 1]["whitened"] == 0 and got[3, 1]["n"] == 3 and abs(got[3, 1]["explained"] - 1) < 1e-12


def test_whitening_stays_in_the_engine(spark):
    rows = whitening.integers(spark.read.parquet(f"{SF}/embeddings.parquet"), 1024, 100_000)
    plan = whitening.planes(rows, [0] * 64, 18)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Scan parquet" in plan


@pytest.mark.parametrize("name", ["op11_collocations", "op12_rules"])
def test_sql_parity(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    cols = sorted(want.columns)
    key = lambda d: sorted(map(tuple, d[cols].astype(str).to_numpy()))
    assert sorted(got.columns) == cols and key(got) == key(want)
