import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.contamination import contamination, is_contaminated
from tidemark.llm.shingles import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(text, items, window=13):
    found = WORD.findall((text or "").translate(FOLD))
    hit, names = set(), set()
    for name, item in items:
        run = WORD.findall((item or "").translate(FOLD))
        n = min(window, len(run))
        for i in range(len(run) - n + 1) if n else ():
            for j in range(len(found) - n + 1):
                if found[j : j + n] == run[i : i + n]:
                    hit.update(range(j, j + n))
                    names.add(str(name))
    return len(found), len(hit), sorted(names)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_words(text):
    assert [w.decode() for w in words(text)] == WORD.findall(text.translate(FOLD))


@pytest.fixture(scope="module")
def case():
    pick = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÑO", "日本", "x_1"]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([1, 2, 3, 5, 13, 14, 40])))) for i in range(25)]
    items += [(25, items[6][1]), (26, ""), (27, None), (28, " -- "), (29, items[5][1].upper() + " tail")]
    docs = []
    for i in range(80):
        parts = pick.choices(vocabulary, k=pick.randint(0, 60))
        for _ in range(pick.randint(0, 3)):
            item = (pick.choice(items)[1] or "").split()
            cut = pick.randint(0, 2)
            at = pick.randint(0, len(parts))
            parts[at:at] = item[cut:]
        docs.append((i, pick.choice([" ", "\n", ", "]).join(parts), "z", "z"))
    docs += [(None, items[3][1], "z", "z"), (None, items[4][1] + " end", "z", "z"), (200, None, "z", "z"), (201, "", "z", "z")]
    docs += [docs[3], docs[3], (202, " ".join([items[7][1]] * 3000), "z", "z")]
    return docs, items


def test_against_brute_force(spark, case):
    docs, items = case
    table = spark.createDataFrame(docs, "doc_id long, text string, n_hit string, window string")
    benchmark = spark.createDataFrame([(*i, "q") for i in items], "item_id int, text string, doc_id string")
    got = contamination(table, benchmark).collect()
    expected = [(i, *brute(text, items)) for i, text, *_ in docs if i != 202]
    key = lambda row: (row[0] is None, str(row))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got if r.doc_id != 202), key=key) == sorted(
        expected, key=key
    )
    long = [r for r in got if r.doc_id == 202]
    assert len(long) == 1 and long[0].n_hit == long[0].n_words


def test_empty_tables_and_rule(spark, case):
    docs, items = case
    schema = "doc_id long, text string, n_hit string, window string"
    table = spark.createDataFrame(docs[:3], schema)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    none = contamination(table, benchmark.where("false")).collect()
    assert len(none) == 3 and all(r.n_hit == 0 and r.item_ids == [] for r in none)
    assert contamination(spark.createDataFrame([], schema), benchmark).count() == 0
    counts = spark.createDataFrame([(100, 5), (100, 4), (0, 0), (20, 1)], "n_words long, n_hit long")
    assert [r[0] for r in counts.select(is_contaminated()).collect()] == [True, False, False, True]
