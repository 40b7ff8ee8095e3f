import random
import re
from collections import Counter

import pytest

from tidemark.llm import phrase_mining as mining
from tidemark.llm.phrase_mining import collocations

SCHEMA = "text string, lang string, rank string, phrase string, n string"


def brute(rows):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    count[lang, tuple(words[i : i + size])] += 1
    candidates = {key: a for key, a in count.items() if a >= 30 and len(key[1]) > 1}
    out = {}
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            l, r = count[lang, words[:k]], count[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        inside = any(
            100 * b >= 80 * a
            for (other, longer), b in candidates.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    result = set()
    for lang, found in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[: mining.BEST], 1):
            result.add((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return result


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)] + ["École", "ß", "ﬁn", "NEW", "york", "\x1f", "a\x00b", "　"]
    weights = [1 / (i + 2) for i in range(len(vocabulary))]
    out = []
    for _ in range(1500):
        words = pick.choices(vocabulary, weights, k=pick.randint(0, 80))
        for _ in range(3):
            words.insert(pick.randint(0, len(words)), pick.choice(["New York City Hall", "of the, people", "top\tten", "a b\rc"]))
        out.append((" ".join(w + pick.choice(["", "", "", ".", "\n", "\x0b", "  "]) for w in words), pick.choice(["en", "en", "de", None])))
    return [*out, (None, "en"), ("", "de"), (" .,", "xx"), *out[:3]]


def test_against_brute_force(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(t, lang, "", "", "") for t, lang in rows], SCHEMA)
    expected = brute(rows)
    assert len(expected) > 100 and {r[0] for r in expected} == {"en", "de", "und"}
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for block, spread in ((1 << 21, docs), (300, docs.repartition(9)), (1 << 21, docs.coalesce(1))):
        monkeypatch.setattr(mining, "_BLOCK", block)
        found = collocations(spread)
        assert found.columns == names
        assert {tuple(r) for r in found.collect()} == expected


def test_most_and_ties(spark, rows, monkeypatch):
    """Equal scores and occurrences go by bytes; the best of each language only."""
    monkeypatch.setattr(mining, "BEST", 5)
    tied = [(f"{a} {b}.", "en") for a, b in (("z", "q"), ("é", "q2"), ("b", "q3"), ("￿", "q4"), ("𐀀", "q5"), ("c", "q6")) for _ in range(30)]
    docs = spark.createDataFrame([(t, lang, "", "", "") for t, lang in tied], SCHEMA)
    found = sorted(collocations(docs).collect(), key=lambda r: r.rank)
    assert [r.phrase for r in found] == ["b q3", "c q6", "z q", "é q2", "￿ q4"]
    assert {tuple(r) for r in found} == brute(tied)


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations(empty).count() == 0
    long = "one two three " * 100_000
    found = collocations(spark.createDataFrame([(long, None, "", "", "")], SCHEMA)).collect()
    assert {tuple(r) for r in found} == brute([(long, None)])


def test_exact_beyond_64_bits(spark):
    """The score's product, as the plan computes it."""
    a = 8 * 10**18 // 3
    row = spark.range(1).selectExpr(f"cast((cast({a}L as decimal(20, 0)) * {mining.SCALE}) div ({a}L + 7) as long) score")
    assert row.first().score == a * mining.SCALE // (a + 7)
