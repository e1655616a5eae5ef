import random

from strandline.llm import substring_dedup as sd
from strandline.llm.common import shared_dir

VOCAB = [f"Word{i}" for i in range(3000)]


def prose(rng, n, line=18):
    w = [rng.choice(VOCAB) for _ in range(n)]
    return [w[i : i + line] for i in range(0, n, line)]


def text(lines):
    return "\n".join(" ".join(x) for x in lines)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, line string")
    return [tuple(r) for r in sd.passages(df, **kw).collect()]


def brute_shared(a, b, least):
    """Places in b of the runs of `least` words that a holds too."""
    have = {tuple(a[i : i + least]) for i in range(len(a) - least + 1)}
    return [i for i in range(len(b) - least + 1) if tuple(b[i : i + least]) in have]


def test_passages_inside_lines(spark):
    rng = random.Random(2)
    rows, planted = [], []
    for d in range(60):
        words = [w for line in prose(rng, 300) for w in line]
        rows.append([d, words])
    for k in range(12):
        passage = [rng.choice(VOCAB) for _ in range(51 + k)]
        for d in (2 * k, 2 * k + 31):
            at = rng.randint(0, 300)
            rows[d][1][at:at] = passage
        planted.append((2 * k, 2 * k + 31))
    texts = [(d, text([w[i : i + 70] for i in range(0, len(w), 70)])) for d, w in rows]
    out = found(spark, texts)
    assert {(r[3], r[0]) for r in out} == set(planted)
    for doc, at, n, kept, _, _ in out:
        a, b = ([w.lower() for w in rows[d][1]] for d in (kept, doc))
        places = brute_shared(a, b, 40)
        assert places[0] <= at and at + n <= places[-1] + 40


def test_every_place_in_a_document(spark):
    """A passage that stands three times in a document that doesn't keep it goes three times."""
    rng = random.Random(11)
    words = lambda n: [rng.choice(VOCAB) for _ in range(n)]
    passage = words(60)
    keeper = words(100) + passage + words(100)
    copy, places = words(30), []
    for _ in range(3):
        places.append(len(copy))
        copy += passage + words(80)
    texts = [(d, text([w[i : i + 30] for i in range(0, len(w), 30)])) for d, w in ((1, keeper), (2, copy))]
    out = sorted((r for r in found(spark, texts) if r[4] == "run"), key=lambda r: r[1])
    assert [(r[0], r[3]) for r in out] == [(2, 1)] * 3
    for (_, at, n, _, _, _), place in zip(out, places, strict=True):
        assert place <= at and at + n <= place + 60 and n >= 40


def test_near_paragraphs_match_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for base in range(6):
        w = [rng.choice(VOCAB) for _ in range(rng.randint(60, 120))]
        for _ in range(9):
            v = list(w)
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = rng.choice(VOCAB)
            own = [rng.choice(VOCAB) for _ in range(45)]
            rows.append((len(rows), text([own, v])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (512, 4):
        got = {(r.doc_id, r.first_word): r.cluster for r in sd.similar_paragraphs(df, sd.numbered_units(df), block=block).collect()}
        units = [(d, 45, line.lower().split()) for d, t in rows for line in t.split("\n")[1:]]
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, _, w in units]
        up = list(range(len(units)))

        def root(i, up=up):
            return i if up[i] == i else root(up[i])

        for i in range(len(units)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    up[max(root(i), root(j))] = min(root(i), root(j))
        groups = {}
        for i, (d, f, _) in enumerate(units):
            groups.setdefault(root(i), set()).add((d, f))
        ours = {}
        for u, c in got.items():
            ours.setdefault(c, set()).add(u)
        assert sorted(map(sorted, ours.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_odd_rows(spark):
    rng = random.Random(5)
    p = text(prose(rng, 60, 60))
    rows = [(1, p), (1, p), (2, None), (3, ""), (4, "few words"), (None, p), (5, "same " * 5000), (6, "Same " * 5000), (7, "x " * 120_000)]
    assert sorted(found(spark, rows)) == [(6, 0, 5000, 5, m, False) for m in ("paragraph", "run")]
    assert sorted(found(spark, [*rows, (9, "start " + p.upper() + " end")]))[-1][:4] [0] == 9
    assert found(spark, []) == []


def test_whole_table_has_copies(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    first, copies = {}, set()
    for d in sorted(docs):
        if len(docs[d].split()) > 60:
            if docs[d] in first:
                copies.add(d)
            first.setdefault(docs[d], d)
    out = sd.op10_substring_dedup(spark, sf).collect()
    assert copies <= {r.doc_id for r in out}
    for r in out:
        assert r.kept_in < r.doc_id and r.n_words >= 40


def test_short_lines_join_to_paragraphs():
    lines = [[b"a"] * 30, [b"b"] * 30, [], [b"c"] * 10, [b"d"] * 50, [b"e"] * 39, [], [b"f"] * 39, [b"g"]]
    got = list(sd.paragraphs(lines, 40))
    assert (0, 2, 0, 60) in got and (4, 1, 70, 50) in got and (7, 2, 159, 40) in got and len(got) == 3
    many = list(sd.paragraphs([[b"w%d" % i] * 7 for i in range(500)], 40))
    assert all(n >= 40 for *_, n in many) and len(many) > 30 and sum(n for *_, n in many) > 3300


def test_recall_of_paragraphs_alone(spark):
    """Of all paragraph pairs of the table at 0.8 or more, at least 0.9 are found by the paragraph method alone, and nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.first_word): r.cluster for r in sd.similar_paragraphs(docs, sd.numbered_units(docs)).collect()}
    sets, index, ids = {}, {}, {}
    for r in docs.where("text IS NOT NULL").collect():
        parts = [sd.lower_words_of(x) for x in r.text.encode().split(b"\n")]
        words = [w for p in parts for w in p]
        for _, _, at, n in sd.paragraphs(parts, sd.MIN_WORDS):
            sets[r.doc_id, at] = {ids.setdefault(tuple(words[i : i + 5]), len(ids)) for i in range(at, at + n - 4)}
    for k, members in sets.items():
        for x in members:
            index.setdefault(x, []).append(k)
    pairs, common = 0, {}
    for holders in index.values():
        for i, a in enumerate(holders):
            for b in holders[:i]:
                common[a, b] = common.get((a, b), 0) + 1
    alike, linked = 0, {}
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            pairs += 1
            alike += a in got and got[a] == got.get(b)
            linked.setdefault(a, set()).add(b)
            linked.setdefault(b, set()).add(a)
    assert alike >= 0.9 * pairs > 100
    assert set(got) <= set(linked)


def test_runs_match_brute_force():
    """Anchors, digests and joined places of many texts at once are those of each text alone."""
    rng = random.Random(4)
    texts = [[b"w%d" % rng.randrange(40) for _ in range(n)] for n in (8, 9, 15, 23, 60, 8, 200)] + [[b"same"] * 70]
    least = 8
    hashes = [sd.window_hashes(sd.np.array([hash(w) % 2**32 for w in t], sd.np.uint64), 5) for t in texts]
    want = []
    for k, (t, s) in enumerate(zip(texts, hashes, strict=True)):
        w = min(sd.ANCHOR, len(s))
        at = {min(range(i, i + w), key=lambda j, s=s: (s[j], j)) for i in range(len(s) - w + 1)}
        want += [(k, i) for i in sorted(at) if i + least <= len(t)]
    of, at = sd.anchors(hashes, least)
    assert list(zip(of.tolist(), at.tolist(), strict=True)) == want
    keys = [b" ".join(texts[k][i : i + least]) for k, i in want]
    digests = sd.np.array([[hash(x), len(x)] for x in keys], sd.np.int64)
    places = {}
    for (k, i), key in zip(want, keys, strict=True):
        mine = places.setdefault((k, key), [])
        if mine and i <= mine[-1][1]:
            mine[-1][1] = i + least
        else:
            mine.append([i, i + least])
    got = sorted(tuple(map(int, x)) for x in zip(*sd.joined_places(of, at, digests, least)[:3], strict=True))
    assert got == sorted((k, a, b - a) for (k, _), mine in places.items() for a, b in mine)


def test_little_is_shuffled(spark):
    """Of texts without repeats only digests and bands are shuffled, once each; bytes as Spark counts them."""
    rng = random.Random(3)
    rows = [(d, text(prose(rng, 400))) for d in range(1500)]
    rows += [(d + 1500, t + "\n" + text(prose(rng, 60))) for d, t in rows[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df.write.mode("overwrite").parquet(path := f"{shared_dir(spark)}/little")

    def written():
        context = spark.sparkContext._jsc.sc()
        context.listenerBus().waitUntilEmpty(30_000)
        found = context.statusStore().executorList(False)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    before = written()
    out = sd.passages(spark.read.parquet(path)).collect()
    assert {(r.kept_in, r.doc_id) for r in out} == {(d, d + 1500) for d in range(20)}
    assert written() - before < 1.2 * sum(len(t) for _, t in rows)
