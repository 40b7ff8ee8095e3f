import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling_variants as variants
from tidemark.llm.queries import queries
from tidemark.llm.spelling_variants import near_pairs, spelling_variants

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, word string, n string, root string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    by_part = {}
    for w in words:
        for part in deletions(w) | {w}:
            by_part.setdefault(part, set()).add(w)
    near = {w: {v for part in deletions(w) | {w} for v in by_part[part] if one_edit(v, w)} for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]]))
    return out


def got(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture(scope="module")
def words():
    pick = random.Random(5)
    letters = "abcdeé÷ÿ"
    out = {"".join(pick.choices(letters, k=pick.randint(7, 9))) for _ in range(400)}
    for word in sorted(out):
        for _ in range(pick.randint(0, 3)):
            i = pick.randrange(len(word) + 1)
            word = pick.choice([word[:i] + pick.choice(letters) + word[i:], word[:i] + pick.choice(letters) + word[i + 1 :], word[:i] + word[i + 1 :]])
            out.add(word)
    return sorted(w for w in out if len(w) >= 7)


def test_bitsets_against_all_pairs(words):
    for some in (words, words[:64], words[:65], ["abcdefg", "abcdefg" * 40, "abcdefg" * 40 + "h"], ["aaaaaaa", "aaaaaaaa"]):
        row, column = near_pairs(some)
        pairs = set(zip(row.tolist(), column.tolist()))
        assert len(pairs) == len(row)
        assert pairs == {(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if one_edit(a, b)}


@pytest.mark.parametrize("group", [4096, 40, 3])
def test_against_brute_force(spark, words, monkeypatch, group):
    """Also with groups so small that they are divided many times."""
    monkeypatch.setattr(variants, "_GROUP", group)
    monkeypatch.setattr(variants, "_INDEXED", min(group, variants._INDEXED))
    pick = random.Random(6)
    rows = [(i, " ".join(f"{w}{'.' if i % 2 else ' -'}" * pick.choice([1, 2, 3, 30, 400]) for w in pick.sample(words, 20))) for i in range(120)]
    rows += [(None, "Wörter WÖRTER wörtern " * 30), (1000, None), (1001, ""), (1002, "12 ?"), rows[0], (1003, "commonprefix" + "x" * 5000 + " commonprefix" + "x" * 4999)]
    rows.append((1004, rows[-1][1]))
    expected = brute(rows)
    assert len(expected) > 300 and sum(r[1] is not None for r in expected) > 20
    assert any(r[1] is not None and r[1] != r[2] for r in expected)
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], SCHEMA)
    found = spelling_variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == len(expected) and got(found) == expected


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None, "", "", "")], SCHEMA)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([tuple(r) for r in docs])
    found = queries()["op13_bitset_variants"](spark, SF)
    assert len(expected) > 100 and any(r[1] for r in expected)
    assert found.count() == len(expected) and got(found) == expected
