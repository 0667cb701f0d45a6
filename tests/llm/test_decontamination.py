import math
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from threadloom.llm import decontaminate as D

SCHEMA = "doc_id long, text string"
rng = random.Random(4)
VOCABULARY = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
NAMES = ["Mary", "Tom", "Ann Lee", "Ed", "Sue", "Bob", "Jean-Luc", "Maria Anna Schmidt"]


def prose(n):
    return " ".join(rng.choices(VOCABULARY, k=n))


def found(spark, rows, items):
    d, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(d, b).collect()}


def cut(text):
    """(template word, value) of each token."""
    out = []
    for t in regex.findall(D.TOKEN, text):
        if t[0] in "$€£" or "0" <= t[0] <= "9":
            out.append((D._NUMBER if "0" <= t[0] <= "9" and "0" <= t[-1] <= "9" else D._QUANTITY, t))
        elif len(t) > 1 and t[0].isupper() and t not in D.FUNCTION.split():
            out.append((D._PERSON, t))
        else:
            out.append((t.lower(), None))
    return [(w, v and re.sub(r"\s+", " ", v.lower())) for w, v in out]


def brute_force(rows, items):
    out = {}
    for doc, text in rows:
        for item, its in items:
            for exact in (False, True):
                if exact:
                    x, y = ([(w, None) for w in regex.findall(r"[\p{L}\p{N}]+", t.lower())] for t in (its, text))
                else:
                    x, y = cut(its), cut(text)
                size = min(D.WINDOW, len(x))
                windows = {k: [w for w, _ in x[k : k + size]] for k in range(len(x) - size + 1)} if x else {}
                if not exact:
                    free = {k: sum(not i.startswith("<") for i in w) for k, w in windows.items()}
                    windows = {k: w for k, w in windows.items() if free[k] * 2 > size and size >= D.SHORT}
                hits = [(p - k, k) for p in range(len(y) - size + 1) for k, w in windows.items() if [i for i, _ in y[p : p + size]] == w]
                places = []
                for side in (0, D.SLACK):
                    for of in {(s + side) // (2 * D.SLACK) for s, _ in hits}:
                        mine = [h for h in hits if (h[0] + side) // (2 * D.SLACK) == of]
                        n = len({k for _, k in mine})
                        shift = max({s for s, _ in mine}, key=lambda s: (sum(t == s for t, _ in mine), -s))
                        if n < D.SHARE * len(windows):
                            continue
                        pairs = set()
                        for k, (w, v) in enumerate(x):
                            if v and 0 <= k + shift < len(y) and y[k + shift][0] == w:
                                pairs.add((v, y[k + shift][1]))
                        values = len({a for a, _ in pairs})
                        if 2 * (len(pairs) - values) <= values:
                            places.append((-n, len(pairs) - values, 0 if exact else shift, values))
                if places:
                    n, conflicts, _, values = min(places)
                    out[doc, item] = (len(windows), -n, values, conflicts)
                    break
    return out


def sentence(n):
    parts = []
    for k in range(n):
        parts.append(rng.choice([prose(3), prose(2) + " " + rng.choice(NAMES), f"{rng.randint(1, 999)} {rng.choice(VOCABULARY)}", f"{rng.randint(2, 90)} {rng.choice(['kg', 'dollars', '%'])}", f"1,{rng.randint(100, 999)}.5", rng.choice(["The", "Then", "Who"]) + " " + prose(1)]))
    text = " ".join(parts)
    return text[0].upper() + text[1:] + rng.choice([".", "?", ""])


def changed(text):
    """With other numbers and names, each the same wherever it stands."""
    to = {}

    def other(m):
        return to.setdefault(m[0], str(rng.randint(1000, 9999)))

    text = re.sub(r"\d+", other, text)
    for name in NAMES:
        text = text.replace(name, to.setdefault(name, rng.choice(["Karl", "Eva Novak", "Li"]) + rng.choice("xyz")))
    return text


def test_against_brute_force(spark):
    items = [(k, sentence(rng.randint(1, 9))) for k in range(40)]
    items += [(40, "Who wrote Hamlet?"), (41, "?!"), (42, ""), (43, items[3][1]), (44, "12 kg of 5 g"), (45, "Mary ate 5 red apples")]
    rows = []
    for k, (_, text) in list(enumerate(items)):
        rows.append((k, prose(20) + " " + text + " " + prose(20)))
        rows.append((100 + k, sentence(2) + "\n" + changed(text) + "\n" + sentence(2)))
        same = re.sub(r"\d+", "7", text) + " " + re.sub(r"\d+", "7", sentence(1))
        rows.append((200 + k, re.sub(r"7", lambda m: str(rng.randint(1, 9)), same) + " " + prose(5) + " " + text.upper()))
        items[k] = (k, same) if k % 4 == 1 else items[k]
        words = text.split()
        rows.append((300 + k, " ".join(words[: len(words) // 2] + ["extra"] + words[len(words) // 2 :]) + " " + changed(text)))
    rows += [(500, ""), (501, prose(300)), (502, " ".join(sentence(3) for _ in range(60)))]
    got = {k: (r.n_windows, r.n_matched, r.n_slots, r.n_conflicts) for k, r in found(spark, rows, items).items()}
    want = brute_force(rows, items)
    assert {k: (got.get(k), want.get(k)) for k in {**got, **want} if got.get(k) != want.get(k)} == {}
    assert len(want) > 120 and any(v[3] for v in want.values())


def test_recall_on_items_with_other_values(spark):
    """Items of prose, numbers and names come back with other values, between other sentences: at least 0.9 are found."""
    items = [(k, sentence(rng.randint(4, 9)) + f" {rng.choice(NAMES)} {prose(2)} {rng.randint(1, 99)} {prose(3)}. {rng.choice(NAMES)} {prose(4)}.") for k in range(150)]
    rows = [(k, sentence(5) + " " + changed(t) + " " + sentence(5)) for k, t in items]
    rows += [(1000 + k, " ".join(sentence(6) for _ in range(6))) for k in range(150)]
    got = set(found(spark, rows, items))
    assert sum((k, k) in got for k, _ in items) >= 0.9 * len(items)
    assert all(a == b for a, b in got)


def test_slots_must_agree_somewhere(spark):
    item = "A farmer sold 12 sheep to Mary for 300 dollars each and then Mary bought 4 more sheep from the same farmer for Mary and 4 dollars of 4 dollars."
    mixed = "A farmer sold 4 sheep to Ann for 4 dollars each and then Ed bought 5 more sheep from the same farmer for Lou and 6 dollars of 7 dollars."
    twice = item.replace("sold 12", "sold 4").replace("to Mary", "to Ed")
    item_2 = "Mary has 12 apples and 3 pears. Tom takes 3 pears from Mary and gives 2 back to her."
    rows = [
        (0, "growth was 5 % Mary said. " + item), (1, item.replace("12", "15").replace("Mary", "Ann Lee").replace("300 dollars", "$25")),
        (2, "growth was 5 % Mary said. " + mixed + " " + mixed), (3, mixed + " stop. " + item), (4, item.upper()), (5, item), (5, item), (5, prose(9)), (6, None), (7, ""), (None, item),
        (8, item_2.replace("Mary", "Sue").replace("Tom", "Bob").replace("12", "45")), (9, twice), (10, "<number> numslot " + prose(20)),
    ]
    got = found(spark, rows, [(7, item), (8, item_2), (8, "z" + item_2), (9, None), (None, item), (10, "too short")])
    assert set(got) == {(0, 7), (1, 7), (3, 7), (4, 7), (5, 7), (8, 8), (9, 7)}
    assert got[1, 7].n_conflicts == 0 and got[1, 7].n_slots == 5 and got[3, 7].n_conflicts == 0 and got[9, 7].n_conflicts >= 1
    assert all(r.n_matched <= r.n_windows for r in got.values())


def test_case_and_wrapping(spark):
    """Copies in another case, wrapped, or after words without a full stop are found."""
    items = [
        "Der Bauer verkauft zwei Schafe an den Nachbarn und kauft im Herbst neue Ziegen vom Markt.",
        "Every morning before school the tall boy asked Mary about her new red bicycle.",
        "The grey heron waits beside shallow water forever.",
        "Every day some 30 birds pass here twice.",
        "Compute 12, 45, 7, 18, 33, 90, 6, 11, 2, 64, 5, 27, 81 and 14 added together.",
    ]
    rows = [
        (0, prose(20) + ". " + items[0].lower() + " " + prose(20)), (1, prose(20) + ". " + items[1].replace(" Mary", "\n  Ann") + " " + prose(20)),
        (2, prose(20) + ", " + items[2]), (3, prose(20) + "\n" + items[3].replace("30", "45")), (4, prose(9) + items[4]), (5, items[4].replace("1", "3")),
    ]
    got = found(spark, rows, list(enumerate(items)))
    assert set(got) == {(k, k) for k in range(5)} and got[1, 1].n_slots == got[3, 3].n_slots == 1


@pytest.mark.parametrize(
    "text", ["Ab" + " Ab" * 200_000, "1" + ",2" * 200_000, "1.2" * 200_000 + "x", "x" * 2_000_000, "5 " + " " * 1_000_000 + " 5", "1 " * 100_000], ids=["names", "groups", "dots", "giant", "spaces", "ones"]
)
def test_long_runs(spark, text):
    item = "The grey heron waits beside shallow water forever."
    assert set(found(spark, [(1, text), (2, text + " " + item)], [(1, item)])) <= {(2, 1)}


def test_columns_in_the_way_and_empty_tables(spark):
    names = ("key", "hash", "words", "leak_", "item_id", "exact", "places", "n", "shift")
    item = "The grey heron waits beside shallow water forever."
    d = spark.createDataFrame([(1, item), (2, prose(30)), (3, None)], SCHEMA).select("*", *(F.lit(7).alias(c) for c in names))
    b = spark.createDataFrame([(1, item, 0)], "item_id long, text string, doc_id int")
    kept = D.drop_leaks(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {2, 3}
    assert D.leaks(d.limit(0), b).count() == D.leaks(d, b.limit(0)).count() == 0 and D.drop_leaks(d, b.limit(0)).count() == 3


def test_more_hashes_than_are_broadcast(spark, monkeypatch):
    items = [(k, prose(12)) for k in range(20)]
    rows = [(k, prose(5) + " " + t) for k, t in items]
    want = {k: (r.n_windows, r.n_matched) for k, r in found(spark, rows, items).items()}
    monkeypatch.setattr(D, "BROADCAST", 1)
    monkeypatch.setattr(D, "BROADCAST_BYTES", 1)
    assert {k: (r.n_windows, r.n_matched) for k, r in found(spark, rows, items).items()} == want and len(want) >= 20
    assert math.isclose(D.SHARE, 0.5)
