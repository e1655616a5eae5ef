import re

import numpy as np

from strandline.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_of_odd_and_real_texts(spark, sf):
    odd = [None, "", " \n\t\x0b\x0c\r", "a", "é é ##", "x " * 9, "same line\nsame line\n \n \nsame line ", "w1 w2 w3 w4 w5 w6 w7 w8 z w1 w2 w3 w4 w5 w6 w7 w8", "y " * 200_000, "퟿\U0001f600 *"]
    rows = [(i, t, "x") for i, t in enumerate(odd)] + [(None, "a b", None), (3, "a", "x")]
    rows += [(r.doc_id + 1000, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, code string")
    got = q.score_documents(df).collect()
    assert len(got) == len(rows)
    expected = sorted((d if d is not None else -1, *brute(t)) for d, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in q.STATS[:5])) for r in got) == expected
    for r in got:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and 0 <= r.quality <= 1
        assert r.kept == (not failed and r.quality >= 0.5)
    kept = q.keep_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def naive_em(votes, rounds=100):
    """The same estimation, document by document."""
    n, rules = votes.shape
    prior, table = 0.8, {0: np.array([q.ON_BAD] * rules), 1: np.array([q.ON_GOOD] * rules)}

    def post(v):
        good, bad = np.log(prior), np.log(1 - prior)
        for r, x in enumerate(v):
            good += np.log(table[1][r][x])
            bad += np.log(table[0][r][x])
        return 1 / (1 + np.exp(bad - good))

    for _ in range(rounds):
        p = np.array([post(v) for v in votes])
        prior = float(np.clip(p.mean(), 0.02, 0.98))
        new = {}
        for y, w, start in ((0, 1 - p, q.ON_BAD), (1, p, q.ON_GOOD)):
            rows = []
            for r in range(rules):
                c = np.array([w[votes[:, r] == x].sum() for x in range(3)]) + q.SMOOTH * n * start
                rows.append(c / c.sum())
            new[y] = np.array(rows)
        table = new
    return np.array([post(v) for v in votes])


def test_estimation_matches_a_naive_one():
    rng = np.random.default_rng(0)
    good = rng.random(120) < 0.8
    votes = np.array([[rng.choice(3, p=[0.1, 0.85, 0.05] if g else [0.1, 0.4, 0.5]) for _ in q.RULES] for g in good])
    codes = (votes * 3 ** np.arange(len(q.RULES))[::-1]).sum(axis=1)
    uniq, counts = np.unique(codes, return_counts=True)
    got = q.fit(uniq, counts, rounds=8)[codes]
    assert np.allclose(got, naive_em(votes, rounds=8))
    assert ((got >= 0.5) == good).mean() > 0.95


def test_labels_agree(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = q.op4_quality_rules(spark, sf).drop("quality").join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == bool(r.quality) for r in got]) > 0.95


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert q.score_documents(df).count() == 0 and q.keep_documents(df).count() == 0
