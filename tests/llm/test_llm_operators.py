import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import chat, embed_dedup, near_dup, packing, quality, scratch, skew, substring, tokens, toxicity, url_filter

rng = random.Random(1)
VOCABULARY = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choices(VOCABULARY, k=n))


BASE = prose(300)
NEAR = " ".join(w if k % 60 else "changed" for k, w in enumerate(BASE.split()))
PASSAGE = prose(70)
DOCS = [
    (0, BASE), (1, BASE.upper()), (2, NEAR), (3, BASE), (3, BASE), (4, prose(40) + "\n" + PASSAGE + " " + prose(30)),
    (5, prose(25) + " " + PASSAGE + "\t" + prose(9)), (6, None), (7, ""), (8, " \n"), (9, "one two"), (10, "One TWO"),
    (11, prose(6000)), (12, "x" * 30000), (13, "<|endoftext|> </s> é漢字"), (None, BASE),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names clash with the operators' own."""
    df = spark.createDataFrame(DOCS, SCHEMA)
    return df.withColumn("kept", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("score", F.lit(None).cast("int")).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def folded(text):
    return re.findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_near_duplicates(docs, nothing):
    got = sorted((r.doc_id, r.component_id, r.n_shingles, r.kept) for r in near_dup.near_duplicates(docs, words=4).collect() if r.doc_id is not None)
    sets = {}
    for i, t in DOCS:
        w = folded(t)
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets if i is not None}
    for _ in root:
        for a, b in itertools.combinations(root, 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[a] = root[b] = min(root[a], root[b])
    assert got == sorted((i, root[i], len(sets[i]), root[i] == i) for i, _ in DOCS if i is not None)
    assert root[2] == 0 and root[10] == 9
    assert near_dup.near_duplicates(nothing).count() == 0


def test_near_duplicates_across_blocks(spark, monkeypatch):
    """Links that hubs alone do not find, in buckets that hold many components and many blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 2000)
    rows = []

    def variant(words, edits):
        words = list(words)
        for at in rng.sample(range(3, len(words) - 3, 8), edits):
            words[at] = "x" + str(rng.randint(0, 10**6))
        rows.append((len(rows), " ".join(words)))

    for _ in range(2):  # most texts with three changed words stand apart and are hubs of buckets
        base = prose(120).split()
        for edits in [3] * 40 + [1, 2]:  # other links often have no hub at either end
            variant(base, edits)
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in (folded(x) for _, x in rows)]
    root = list(range(len(rows)))
    for a, b in itertools.combinations(root[:], 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
            one, two = sorted((root[a], root[b]))
            root = [one if r == two else r for r in root]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), words=4).collect()}
    assert got == dict(enumerate(root)) and 1 < len(set(root)) < len(rows)


def test_near_duplicates_of_repeated_ids(spark):
    """An id with several texts is one node that joins what each of them links to."""
    x, y, z = prose(60), prose(60), prose(60)
    rows = [(1, x), (5, x), (5, y), (7, y), (5, None), (9, z), (8, z + " more"), (8, ""), (3, prose(50)), (3, prose(50)), (3, prose(50)), (None, x)]
    got = sorted({(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id and r.n_shingles})
    assert got == [(1, 1, True), (3, 3, True), (5, 1, False), (7, 1, False), (8, 8, True), (9, 8, False)]


def test_repeats(docs, nothing):
    rows = substring.remove_repeats(docs).collect()
    assert len(rows) == len(DOCS) and rows[0].asDict()["key"] == 1
    first = {}
    for i, t in sorted((d for d in DOCS if d[0] is not None), key=lambda d: d[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for r in rows:
        w = (r.text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if r.doc_id is not None and first[tuple(w[k : k + 50])] < r.doc_id:
                gone[k : k + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        assert (r.n_words, r.n_removed, r.kept_text) == (len(w), sum(gone), kept)
    assert any(0 < r.n_removed < r.n_words for r in rows)
    assert substring.remove_repeats(nothing).count() == 0
    clash = docs.select("doc_id", "text", *(F.lit(k).alias(c) for k, c in enumerate(("key__", "text__", "spans__", "id__", "first", "seed"))))
    assert sorted(r.n_removed for r in substring.remove_repeats(clash).collect()) == sorted(r.n_removed for r in rows)


@pytest.mark.parametrize("share", [1, 4, 512])
def test_hot_join(spark, share):
    """Hot keys, cold keys, keys of one side only, and empty sides give the rows of a plain join."""
    left = [(1 if k % 3 else k, k) for k in range(60)] + [(2, 70), (2, 70)]
    right = [(k, sum(x == k for x, _ in left), -k) for k in [*range(0, 50, 2), 1, 99]]
    a, b = spark.createDataFrame(left, "k long, v long"), spark.createDataFrame(right, "k long, n__ long, w long")
    with scratch.Scratch(spark) as s:
        got = sorted(map(tuple, skew.join_hot(s, a, b, ["k"], share).select("k", "v", "w").collect()))
        assert got == sorted((k, v, w) for k, v in left for x, _, w in right if x == k)
        assert skew.join_hot(s, a.limit(0), b, ["k"], share).count() == 0 == skew.join_hot(s, a, b.limit(0), ["k"], share).count()


def test_packing(docs, nothing):
    import tokenizers
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs, with_ids=True).collect()
    ids = {}
    for r in rows:
        if r.doc_id not in (3, None):
            ids.setdefault(r.doc_id, []).append(r)
    for i, t in DOCS:
        if i not in (3, None):
            mine = sorted(ids[i], key=lambda r: r.piece)
            assert [x for r in mine for x in r.ids] == [*library.encode(t or "", add_special_tokens=False).ids, 2]
            assert all(r.length == 1024 for r in mine[1:]) and len(mine) == -(-sum(r.length for r in mine) // 1024)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("blank", [" ", "\n", " \n\t"], ids=["spaces", "newlines", "mixed"])
def test_ids_of_long_blank_runs(blank):
    import tokenizers
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "a b" + blank * (2_000_000 // len(blank)) + "c"
    assert tokens.byte_encoder(path)(text) == tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_packing_spreads_equal_rows(spark, monkeypatch):
    """Rows that are equal in all columns get places of their own, in groups of bounded size."""
    monkeypatch.setattr(packing, "RANKED", 20)
    rows = packing.pack(spark.createDataFrame([(None, None)] * 3000, SCHEMA)).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3000 and {r.sequence_id for r in rows} == {0, 1, 2}


def test_plan_is_best_fit_decreasing():
    for _ in range(50):
        items = [rng.randint(1, 64) for _ in range(rng.randint(1, 200))]
        bins = []
        for x in sorted(items, reverse=True):
            fit = [b for b in range(len(bins)) if bins[b] >= x]
            if fit:
                bins[min(fit, key=lambda b: bins[b])] -= x
            else:
                bins.append(64 - x)
        counts = {x: items.count(x) for x in items}
        slots = packing.plan(counts, 64)
        assert max(s[3] + -(-s[2] // s[5]) for s in slots) == len(bins)
        assert {x: sum(s[2] for s in slots if s[0] == x) for x in counts} == counts


def test_token_counts(docs, nothing):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = tokens.count_tokens(docs).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in DOCS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    text = "a  b " * 9000 + "▁ c" * 5000
    text += "漢字 é " * 9000 + "x" * 20000 + " y"
    assert tokens.lengths([text.encode()], public_tokenizers.path("piece_bpe_32k.model"))[0] == len(library.encode(text))
    parts = tokens.segments(text.encode())
    assert len(parts) > 9 and b" ".join(parts).decode() == text and max(map(len, parts)) < 31000
    assert tokens.count_tokens(nothing).count() == 0


@pytest.mark.parametrize("operator", [toxicity.score_toxicity, quality.score_quality])
def test_classifiers(spark, docs, nothing, operator):
    bad = ["idiot", "moron", "worthless"]
    rows, marks = [], []
    for k in range(400):
        words = prose(60).split()
        if k % 3 == 0:
            words[10:50:9] = [rng.choice(bad) + "!!" for _ in words[10:50:9]]
        rows.append((k, " ".join(words)))
        marks.append((k, int(k % 3 != 0), int(k % 3 == 0)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    which = "toxic" if operator is toxicity.score_toxicity else "quality"
    scored = operator(spark.createDataFrame(rows, SCHEMA), labels).join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert len(scored) == 400 and len(held) > 50
    assert sum(r.predicted == r[which] for r in held) / len(held) > 0.95
    many = spark.createDataFrame([(k, f"w{k % 7} x") for k in range(3000)] + [(9000, prose(20000)), (9001, rows[1][1]), (9001, rows[1][1])], SCHEMA)
    many = operator(many, labels).collect()
    assert len(many) == 3003 and len({r.score for r in many if r.doc_id == 9001}) == 1
    odd = operator(docs, labels).collect()
    assert len(odd) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in odd)
    assert operator(docs, labels.limit(0)).count() == len(DOCS) and operator(nothing, labels).count() == 0


def test_isotonic_is_the_nearest_monotone_fit():
    """Against the formula: each value is the greatest over beginnings of the least over ends of the mean between."""
    import numpy as np

    from threadloom.llm.boosting import isotonic

    g = np.random.default_rng(1)
    x = np.sort(g.standard_normal(60))
    y, w = (g.random(60) < 1 / (1 + np.exp(-x))).astype(float), g.integers(1, 4, 60).astype(float)
    mean = lambda a, b: (y[a : b + 1] * w[a : b + 1]).sum() / w[a : b + 1].sum()
    want = [max(min(mean(a, b) for b in range(k, 60)) for a in range(k + 1)) for k in range(60)]
    order = g.permutation(60)
    assert np.allclose(isotonic(x[order], y[order], w[order])(x), want)


def test_a_stump_is_the_best_split():
    """One tree of depth one takes the cut with the greatest gain, and Newton steps in its leaves."""
    import numpy as np

    from threadloom.llm.boosting import boost

    g = np.random.default_rng(3)
    x, best = g.standard_normal((200, 4)), None
    y = (x[:, 2] + 0.5 * g.standard_normal(200) > 0.3).astype(float)
    tree = boost(x, y, trees=1, depth=1, rate=1.0)
    p = y.mean()
    for f in range(4):
        for c in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 49)[1:-1])):
            side = x[:, f] > c
            score = sum((y[m] - p).sum() ** 2 / (m.sum() * p * (1 - p) + 2) for m in (side, ~side))
            best = max(best or (0,), (score, f, c))
    assert tree.trees[0].feature[0] == best[1] and np.isclose(tree.trees[0].cut[0], best[2])
    m = x[:, best[1]] <= best[2]
    assert np.isclose(tree.trees[0].value[0], (y[m] - p).sum() / (m.sum() * p * (1 - p) + 2))


def test_votes_of_the_nearest():
    """Against a plain loop over all labelled vectors."""
    import numpy as np

    g = np.random.default_rng(5)
    unit = lambda n: (v := g.standard_normal((n, 12))) / np.linalg.norm(v, axis=1, keepdims=True)
    held, z = unit(90), unit(40)
    y, weight = g.integers(0, 2, 90).astype(float), g.random(90) + 0.1
    got = quality.Neighbours(None, None, None, held, y, weight, 0.25).score(z)
    for k in range(40):
        near = sorted(range(90), key=lambda m: -(z[k] @ held[m]))[: quality.NEIGHBOURS]
        vote = [max(0.0, z[k] @ held[m]) ** quality.POWER * weight[m] for m in near]
        want = (sum(v * y[m] for v, m in zip(vote, near)) + 1e-9 * 0.25) / (sum(vote) + 1e-9)
        assert abs(got[k] - want) < 1e-9


def brute_force_vectors(rows):
    import numpy as np

    n, root = [0] * len(rows), list(range(len(rows)))
    fine = [k for k, (i, e) in enumerate(rows) if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    unit = {k: np.array(rows[k][1], dtype=np.float32).astype(float) / np.linalg.norm(np.array(rows[k][1], dtype=np.float32).astype(float)) for k in fine}
    for a, b in itertools.combinations(fine, 2):
        linked = len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95
        n[a], n[b] = n[a] + linked, n[b] + linked
        if (linked or rows[a][0] == rows[b][0]) and root[a] != root[b]:
            one, two = root[a], root[b]
            root = [one if r == two else r for r in root]
    least = {r: min(rows[k][0] for k in fine if root[k] == r) for r in {root[k] for k in fine}}
    return n, [least[root[k]] if k in unit else i for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [8, 512])
def test_embeddings(spark, monkeypatch, block):
    """Several widths, many equal vectors, repeated ids, and vectors that link with nothing."""
    import numpy as np

    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    g = np.random.default_rng(2)
    x = np.repeat(g.standard_normal((40, 16)), 8, axis=0) + 0.2 * g.standard_normal((320, 16))
    rows = [(k, [float(v) for v in e]) for k, e in enumerate(x)]
    wide = np.repeat(g.standard_normal((9, 24)), 6, axis=0) + 0.15 * g.standard_normal((54, 24))
    rows += [(400 + k, [float(v) for v in e]) for k, e in enumerate(wide)]
    rows += [(600 + k, rows[8 * (k % 3)][1]) for k in range(60)]  # many copies
    rows += [(700, [1.0, 2.0, 3.0]), (701, [1.0, 2.0, 3.0]), (702, [1.0, 2.0]), (703, [1.0, 2.0]), (5, rows[300][1]), (5, rows[5][1]), (640, [1.0] * 5)]
    rows += [(900, [0.0] * 16), (901, None), (902, [float("nan")] * 16), (903, []), (904, [1.0] * 15), (905, [None] * 16), (None, rows[0][1]), (906, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("w", F.lit(0))
    n, root = brute_force_vectors(rows)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_vectors(df).collect()), key=str)
    assert got == sorted(((i, n[k], root[k], i is None or i == root[k]) for k, (i, _) in enumerate(rows)), key=str)
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("width, groups", [(64, 300), (24, 300)])
def test_embeddings_recall_near_the_threshold(spark, width, groups):
    """Links with cosines of 0.95 to 0.96: at least 0.9 are found, and none below the threshold."""
    import numpy as np

    g = np.random.default_rng(width)
    rows = []
    for k in range(groups):
        a, b = (v / np.linalg.norm(v) for v in g.standard_normal((2, width)))
        b = b - (a @ b) * a
        b /= np.linalg.norm(b)
        for c in g.uniform(0.95, 0.96, 4):
            rows += [(len(rows), (c * a + math.sqrt(1 - c * c) * b).tolist())]
            b = -b
        rows.append((len(rows), a.tolist()))
    x = np.array([e for _, e in rows])
    want = (x @ x.T >= 0.95).sum() - len(rows)
    got = sum(r.n_links for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    print(width, got / want)
    assert 0.9 * want <= got <= want


def test_urls(spark, monkeypatch):
    urls = ["http://WWW.Example.com/en/a", "https://a.example.com/en/?q", "x://net/es/", "ftp://b.net/fr/#x", "http://spam-farm.example.org/x", "http://www.spam-farm.example.org", "http://notspam-farm.example.org/", None, "nothing", "http://é.com/", "http://a.example.com?/en/", "http://com/"]
    got = [tuple(r)[1:] for r in url_filter.judge(spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string").coalesce(1)).collect()]
    assert got[:4] == [("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("a.example.com", "/en/", "example.com/en/", "block"), ("net", "/es/", "net/es/", "block"), ("b.net", "/fr/", "net/fr/", "block")]
    assert [g[3] for g in got[4:]] == ["block", "block", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert got[7][:3] == ("", "", None) and got[10][:3] == ("a.example.com", "", None) and got[11][2] == "com/"
    hosts = [f"h{k}.example" for k in range(3000)]
    many = spark.createDataFrame([(k, f"http://{h}/") for k, h in enumerate(hosts)], "page_id long, url string")
    out = {r.host for r in url_filter.judge(many, (), spark.createDataFrame([(h,) for h in hosts[::7]], "d string")).where("verdict = 'block'").collect()}
    assert out == set(hosts[::7])
    monkeypatch.setattr(url_filter, "PART_KEYS", 150)
    out = {r.host for r in url_filter.judge(many, (), spark.createDataFrame([(h,) for h in [*hosts[::7], "elsewhere.example"]], "d string")).where("verdict = 'block'").collect()}
    assert out == set(hosts[::7])
    assert url_filter.judge(many.limit(0)).count() == 0


def test_chat(spark):
    said = [(1, 0, "user", "hi </s> & &lt; <s>~[INST]"), (1, 1, "assistant", "a</s>"), (1, 1, "assistant", "a</s>"), (2, 0, "x[/INST]", None), (2, None, None, "~"), (3, 0, "assistant", ""), (None, 0, "user", "é\n漢")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("p"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("t")).collect()}
    assert [(t.role, t.text) for t in got[1].p] == [("user", said[0][3]), ("assistant", "a</s>"), ("assistant", "a</s>")]
    assert got[1].t == "a</s>a</s>" and [(t.role, t.text) for t in got[2].p] == [("", "~"), ("x[/INST]", "")]
    assert got[3].t == "" and got[None].p[0].text == "é\n漢" and out.count() == 4
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    folder = str(tmp_path)
    poison = ["idiot", "moron", "worthless"]
    toxic = lambda n: " ".join(rng.choice(poison) if j % 13 == 5 else w for j, w in enumerate(prose(n).split()))
    sizes = [rng.randint(60, 320) for _ in range(300)]
    rows = [(100 + k, prose(n) if k % 3 else toxic(n), "en", "s", 1) for k, n in enumerate(sizes)]
    leak = prose(30)
    rows += [(900, prose(20) + " " + leak + " " + prose(20), "en", "s", 1), (901, BASE, "en", "s", 1), (902, NEAR, "en", "s", 1), (903, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(100 + k, 1, int(k % 3 == 0)) for k in range(300)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    ids = {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()}
    assert not ids & {900, 902} and {901, 903} <= ids
    assert len(ids & {m[0] for m in marks if m[2]}) <= 2 and len(ids & {m[0] for m in marks if not m[2]}) >= 198




def in_words(text):
    return re.findall(r"[^ \t-\r]+", text or "")


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage's rows from its own input, in plain loops; toxicity by the operator's scores, themselves held above."""
    shared = [prose(60), prose(55)]
    rows = [(k, prose(rng.randint(3, 40)) + " " + (shared[k % 2] if k % 5 == 0 else "") + " " + prose(rng.randint(3, 40)), "en", "s", 5, k) for k in range(40)]
    rows += [(40, BASE, "en", "s", 1, 0), (41, NEAR, "en", "s", 1, 0), (42, BASE.upper(), None, "s", 1, 0), (43, shared[0], "en", None, 1, 0)]
    rows += [(44, None, "en", "s", None, 0), (45, "", "en", "s", 0, 0), (45, BASE, "en", "s", 0, 0), (None, BASE, "en", "s", 0, 0), (46, rows[3][1], "en", "s", 0, 0)]
    leak = "the mill at " + prose(20)
    rows += [(50, prose(10) + " " + leak + " " + prose(10), "en", "s", 1, 0), (51, prose(10) + " " + leak[: len(leak) // 4], "en", "s", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long")
    folder = str(tmp_path)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    plain = lambda df: sorted(map(tuple, df.collect()), key=str)

    sets = {}
    for i, t, *_ in rows:
        w = folded(t)
        sets.setdefault(i, []).append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    root = {i: i for i in sets if i is not None}
    for _ in root:
        for a, b in itertools.combinations(root, 2):
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    single = [r for r in rows if r[0] is None or root[r[0]] == r[0]]
    assert 0 < len(single) < len(rows)
    assert plain(corpus_pipeline.near_dedup(spark, docs, folder)) == sorted(single, key=str)

    first, cut = {}, []
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = in_words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for r in rows:
        w = in_words(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[k : k + 50])] < r[0]:
                gone[k : k + 50] = [True] * 50
        left = " ".join(x for x, g in zip(w, gone) if not g)
        if not any(gone):
            cut.append(r)
        elif left:
            cut.append((r[0], left, *r[2:4], len(left), r[5]))
    assert len(cut) < len(rows) and any(r not in rows for r in cut)
    assert plain(corpus_pipeline.substring_dedup(spark, docs, folder)) == sorted(cut, key=str)

    # words without numbers or capitals: a leak is a text with at least half of the item's windows of words along one shift
    item, clean = in_words(leak), []
    windows = [item[k : k + 8] for k in range(len(item) - 7)]
    for r in rows:
        w = [x.lower() for x in in_words(r[1])]
        shifts = [p - k for p in range(len(w) - 7) for k, x in enumerate(windows) if w[p : p + 8] == x]
        if r[0] is None or 2 * max((shifts.count(s) for s in shifts), default=0) < len(windows):
            clean.append(r)
    assert {r[0] for r in rows} - {r[0] for r in clean} == {50}
    assert plain(corpus_pipeline.decontamination(spark, docs, folder)) == sorted(clean, key=str)

    import public_tokenizers

    encode = tokens.byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.packing(spark, docs, folder).collect()
    lengths = {}
    for p in packed:
        lengths.setdefault(p.doc_id, []).append(p.length)
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append(len(encode(t or "")) + 1)
    assert {i: sum(x) for i, x in lengths.items()} == {i: sum(x) for i, x in want.items()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, folder).count() == 0
