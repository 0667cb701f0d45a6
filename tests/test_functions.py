import itertools
import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.chunking import cut, plan, sentence_places
from threadloom.functions.model_json import extract_json
from threadloom.functions.similarity import common_subsequence, token_set_ratio
from threadloom.functions.text import claim_id, normalized_name, sentences, strip, tokens, with_bigrams


@pytest.mark.parametrize(
    "a, b, expected",
    [("routing", "routing py", 1), ("pydantic", "pydantc", 0.9333), ("pr #15070", "pr #14932", 0.5556), ("fastapi core", "fastapi app", 0.7778), ("", "x", 0)],
)
def test_token_set_ratio(a, b, expected):
    assert round(token_set_ratio(a, b), 4) == round(expected, 4) == round(token_set_ratio(b, a), 4)


def test_common_subsequence_is_the_longest():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(2))
        subs = lambda s: {"".join(x) for n in range(len(s) + 1) for x in itertools.combinations(s, n)}
        assert common_subsequence(a, b) == max(map(len, subs(a) & subs(b)))


def test_chunks_overlap_and_cut_long_sentences():
    short = lambda text: [(r["text"], r["start"], r["end"]) for r in cut(text, 5, 2)]
    assert short("A. B. C.") == [("A. B.", 0, 5), ("B. C.", 4, 9)]
    assert short("ABCDEFGH. X.") == [("ABCDE", 0, 5), ("DEFGH", 3, 8), ("GH.", 6, 9), ("X.", 0, 2)]
    assert short("") == short(" \n ") == []
    rows = cut("One two. \r\n\r\nThree\r\nfour!  Five.", 12, 4)
    assert [(r["text"], r["source_start"], r["source_end"]) for r in rows] == [("One two.", 0, 8), ("Three\nfour!", 13, 25), ("Five.", 27, 32)]


def test_plans_hold_every_sentence_in_order():
    rng = random.Random(8)
    for _ in range(300):
        size = rng.randint(3, 30)
        overlap = rng.randint(0, size - 1)
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(0, 30))]
        groups = [w for w, _, _ in plan(lengths, size, overlap) if not isinstance(w, int)]
        pieces = [(w, at) for w, _, at in plan(lengths, size, overlap) if isinstance(w, int)]
        assert sorted({k for g in groups for k in g} | {w for w, _ in pieces}) == list(range(len(lengths)))
        assert pieces == [(k, at) for k, n in enumerate(lengths) if n > size for at in range(0, n, size - overlap)]
        for a, b in zip(groups, groups[1:]):
            again = [k for k in b if k <= a[-1]]
            assert again == a[len(a) - len(again) :] and sum(lengths[k] for k in again) <= overlap
            assert len(again) == len(a) or sum(lengths[k] for k in a[-len(again) - 1 :]) > overlap
        assert all(sum(lengths[k] for k in g[:-1]) <= size for g in groups)


def test_long_white_space_inside_a_text(spark):
    text = "a" + " " * 1_000_000 + "b" + " " * 1_000_000
    got = spark.createDataFrame([(text,), ("\u2003x\t",)], "t string").select(strip(F.col("t"))).collect()
    assert got[0][0] == text.rstrip() and got[1][0] == "x"


def test_text_columns(spark):
    df = spark.createDataFrame([("Élan vital: a b.c/d-e.  The END!\r\n\r\n\r\nnext, ﬁne",), ("",), (None,)], "t string")
    rows = df.select(sentences(F.col("t")).alias("s"), tokens(F.col("t")).alias("w")).select("s", "w", with_bigrams(F.col("w")).alias("g")).collect()
    text = "Élan vital: a b.c/d-e.  The END!\r\n\r\n\r\nnext, ﬁne"
    assert [text[a:b] for a, b in sentence_places(text)] == rows[0].s
    assert rows[0].s == ["Élan vital: a b.c/d-e.", "The END!", "next, ﬁne"]
    assert rows[0].w == ["elan", "vital", "b.c/d-e", "the", "end", "next", "fine"]
    assert rows[0].g[7] == "elan vital" and len(rows[0].g) == 13
    assert rows[1].s == rows[2].s == rows[1].w == rows[2].g == []


def test_names_and_ids(spark):
    df = spark.createDataFrame([("`The Café_of/routing.py`",), ("to the",), ("Ünïcode–x",)], "n string")
    keys = [r[0] for r in df.select(normalized_name(F.col("n"))).collect()]
    assert keys == ["cafe routing py", "", "unicodex"]
    one = spark.range(1).select(claim_id(F.lit("A"), F.lit("uses"), F.lit("B"))).first()[0]
    assert len(one) == 16 and one == spark.range(1).select(claim_id(F.lit("a"), F.lit("USES"), F.lit("b"))).first()[0]


def test_json_is_found(spark):
    texts = ['{"a":1}', '```json\n{"a":1}\n```', 'Sure: {"a":1} ok', "nothing", '```[1]```', None]
    out = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_json(extract_json(F.col("t")))).collect()]
    assert out == ['{"a":1}'] * 3 + [None, "[1]", None]
