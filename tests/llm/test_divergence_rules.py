import random
import re
from collections import Counter

import pytest

from tidemark.llm.divergence_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, kept string, words string"


def brute(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + o for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for o in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


@pytest.fixture(scope="module")
def clean():
    pick = random.Random(1)
    common = ["the"] * 12 + ["of"] * 7 + ["and"] * 5 + ["to"] * 4 + ["a"] * 3
    rare = ["".join(pick.choices("abcdefghijklmnoprstuw", k=6)) for _ in range(400)]
    return [" ".join(pick.choice(common if pick.random() < 0.3 else rare) for _ in range(150)) for _ in range(60)]


def test_base_counts_of_odd_texts(spark):
    texts = [
        None, "", " \n\t", "a", "a b", "a b c", "a b c a b c a b c", "x x x x x", "é\x0bé\x0cé é\ré 😀 😀 😀 😀",
        "one line\none line\n\n  \n one line", "# <b> || 5% & $*", "a b c d", "k " * 60_000,
        " ".join(str(i % 7919) for i in range(30_000)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    for i, text in enumerate(texts):
        assert counts(got[i]) == brute(text or ""), text
    assert not got[0].kept and got[12].base_failed


def test_verdicts(spark, clean):
    junk = [
        clean[0].upper(),
        " ".join(w + "***" for w in clean[1].split()),
        " | ".join(w for w in clean[2].split() if len(w) > 4),
    ]
    rows = [(i, t, "en", None, None) for i, t in enumerate([*clean, *junk])]
    rows += [(None, clean[0], "en", None, None), (100, clean[0], None, None, None), (101, clean[0], "zz", None, None)]
    rows += [(102, clean[3], "en", None, None)] * 2
    got = quality_rules(spark.createDataFrame(rows, SCHEMA), language_share=20).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(len(clean)))
    assert not any(kept[len(clean) + i] for i in range(len(junk)))
    assert kept[None] and kept[100] and kept[101] and kept[102]
    assert {r.doc_id: r.word_distance for r in got}[101] is None
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rare_language_has_reference(spark, clean):
    rows = [(i, t, "en", None, None) for i, t in enumerate(clean * 18)]
    rows += [(2000 + i, " ".join(clean[4 * i : 4 * i + 4]), "yy", None, None) for i in range(4)]
    rows += [(2010, clean[0].upper(), "yy", None, None), (2011, clean[0].upper(), "zz", None, None)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[2000 + i].kept for i in range(4)) and not got[2010].kept
    assert got[2011].char_distance is None and got[2011].kept  # 150 words are no reference


def test_plan_is_native(spark, clean):
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(clean)], SCHEMA)
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
