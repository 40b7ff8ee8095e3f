import random

import numpy as np
import pytest

import tidemark.llm.near_duplicates as near_duplicates_module
from tidemark.llm.components import components
from tidemark.llm.near_duplicates import Sampler, Weigher, classes, common_shingles, deduplicate, near_duplicates
from tidemark.llm.near_duplicates import _prefix_pairs, _sketcher, frequencies, tf_idf, weighted_jaccard
from tidemark.llm.queries import queries
from tidemark.llm.shingles import WordHashes, mixed, words

SCHEMA = "doc_id long, text string, row string, class_id string, label string"


def closure(ids, links):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    pick = random.Random(2)
    for links in (
        [(i, i + 1) for i in range(300)],
        [(0, i) for i in range(1, 200)] + [(500, 501)],
        [(pick.randint(0, 400), pick.randint(0, 400)) for _ in range(300)],
        [],
    ):
        got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        expected = closure({i for link in links if link[0] != link[1] for i in link}, links)
        assert got == expected


def test_draws_agree_as_often_as_similarity():
    pick, sample = np.random.default_rng(4), Sampler(4000)
    hashes = np.sort(pick.integers(0, 1 << 63, 300, dtype=np.uint64))
    a, b = pick.uniform(0.2, 5, 300), pick.uniform(0.2, 5, 300)
    a[:60], b[:60] = b[:60], a[:60]
    b[100:] = a[100:]
    for drop in (0, 40):
        left, right = (hashes, a), (hashes[drop:], b[drop:])
        agree = (sample(*left) == sample(*right)).mean()
        assert abs(agree - weighted_jaccard(left, right)) < 0.04


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = " ".join(pick.choices(vocabulary, k=40))
    out = []
    for group in range(30):
        base = pick.choices(vocabulary, k=pick.randint(40, 400))
        for copy in range(pick.choice([1, 1, 2, 5, 12])):
            words = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 40)) if copy else 0):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            text = " ".join(words)
            out.append(text + ("\n" + shared if group % 3 == 0 else ""))
            if pick.random() < 0.2:
                out.append(out[-1].upper() + " !")
    out += ["only four words here", "only four words HERE", "x", "x"]
    return [(1000 - i, t, "r", "c", "l") for i, t in enumerate(out)]


def test_against_all_pairs(spark, rows):
    odd = [(None, rows[0][1], "", "", ""), (5, None, "", "", ""), (6, "", "", "", ""), (7, " - ", "", "", "")]
    docs = spark.createDataFrame([*rows, *odd, rows[1]], SCHEMA)
    found = near_duplicates(docs).collect()
    assert len(found) == len(rows) + 5
    weigh = Weigher(5, common_shingles(docs.select("text"), 5, 0.1))
    sets = {i: weigh(words(t)) for i, t, *_ in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and weighted_jaccard(sets[a], sets[b]) >= 0.8]
    label = closure(ids, links)
    got = {r.doc_id: r.class_id for r in found if r.doc_id is not None and r.doc_id > 7}
    assert got == label
    assert {r.doc_id: r.class_id for r in found if r.doc_id in (5, 6, 7)} == {5: 5, 6: 6, 7: 7}
    assert [r.class_id for r in found if r.doc_id is None] == [label[rows[0][0]]]
    kept = [r.class_id for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len(set(label.values())) + 3
    left = deduplicate(docs)
    assert left.columns == docs.columns and left.count() == len(kept)


def test_common_shingles_are_found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).select("text").repartition(7)
    weigh = Weigher(5, (np.empty(0, np.uint64), np.empty(0)))
    sets = [weigh(words(t))[0] for _, t, *_ in rows]
    each, n = np.unique(np.concatenate(sets), return_counts=True)
    hashes, idf = common_shingles(docs, 5, 0.1)
    often = n >= 0.1 * len(rows)
    assert (hashes == each[often]).all() and len(hashes) > 20
    assert np.allclose(idf, np.log(len(rows) / n[often]) / np.log(10))


def test_draws_weigh_all_shingles_by_idf(spark, rows):
    """Every shingle's document frequency counts, not only that of common ones, over several tasks."""
    docs = spark.createDataFrame(rows, SCHEMA).select("text").repartition(5)
    weigh = Weigher(5, (np.empty(0, np.uint64), np.empty(0)))
    sets = [weigh(words(t)) for _, t, *_ in rows]
    each, n = np.unique(np.concatenate([hashes for hashes, _ in sets]), return_counts=True)
    idf = dict(zip(each.tolist(), 1 + np.log((1 + len(rows)) / (1 + n))))
    assert len({round(x, 6) for x in idf.values()}) > 8
    every = frequencies(docs, 5, 0.1)[1]
    exact = []
    for (_, text, *_), (hashes, counts) in zip(rows, sets):
        own, weights = tf_idf(WordHashes(), words(text), 5, every)
        expected = counts * [idf[h] for h in hashes.tolist()]
        assert (own == hashes).all() and (weights <= expected * 1.00001).all()
        exact += np.isclose(weights, expected, rtol=1e-5).tolist()
    assert np.mean(exact) > 0.998  # the rest share both cells with others


def test_widespread_passage_brings_few_candidates(spark):
    """Texts that share only a passage of a twentieth of all texts agree on fewer bands than their plain similarity makes them."""
    pick = random.Random(12)
    text = lambda n: [f"w{pick.randrange(1 << 30)}" for _ in range(n)]
    passage = text(104)
    texts = [text(100) + passage for _ in range(60)] + [text(100) for _ in range(1140)]
    docs = spark.createDataFrame([(" ".join(t),) for t in texts], "text string")
    every = frequencies(docs, 5, 0.1)[1]
    sets = [tf_idf(WordHashes(), words(" ".join(t)), 5, every) for t in texts[:60]]
    plain = Weigher(5, (np.empty(0, np.uint64), np.empty(0)))
    expected = weighted_jaccard(sets[0], sets[1])
    assert expected < 0.22 < 0.33 < weighted_jaccard(*(plain(words(" ".join(t))) for t in texts[:2]))
    drawn = docs.limit(60).select(_sketcher(5, every, 200, 1)("text").alias("drawn")).select("drawn.bands").collect()
    drawn = np.array([row.bands for row in drawn])
    agree = np.mean([(drawn[i] == drawn[j]).mean() for i in range(60) for j in range(i)])
    assert abs(agree - expected) < 0.05


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0 and deduplicate(empty).count() == 0
    long = " ".join(str(i * 7919 % 50_021) for i in range(50_000))
    docs = spark.createDataFrame([(1, long, "", "", ""), (2, long + " end", "", "", ""), (3, "a b", "", "", "")], SCHEMA)
    assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.class_size for r in classes(docs).collect()} == {1, 2}


def test_pairs_in_large_bands(spark):
    """Near copies among many documents that share a long template, all of them in the same bands."""
    pick = random.Random(8)
    word = lambda: f"w{pick.randrange(1 << 30)}"
    template = [word() for _ in range(160)]
    texts = [template + [word() for _ in range(40)] for _ in range(600)]
    for i in range(0, 600, 6):  # a partner at about 0.82 for every sixth
        texts.append(texts[i][:182] + [word() for _ in range(18)])
    ids = list(range(len(texts)))
    docs = spark.createDataFrame([(i, " ".join(t), "", "", "") for i, t in zip(ids, texts)], SCHEMA)
    weigh = Weigher(5, common_shingles(docs.select("text"), 5, 2.0))
    sets = [weigh(words(" ".join(t))) for t in texts]
    links = [(a, b) for a in ids for b in ids[:a] if weighted_jaccard(sets[a], sets[b]) >= 0.8]
    assert len(links) == 100
    # With every shingle at weight 1 the bands are as large as they get.
    found = near_duplicates(docs, common=2.0).collect()
    assert {r.doc_id: r.class_id for r in found} == closure(ids, links)


def test_few_links_cost_no_turns(spark, monkeypatch):
    """A turn that links few of its pairs is the last, and nothing is missed for it."""
    pick = random.Random(8)
    word = lambda: f"w{pick.randrange(1 << 30)}"
    template = [word() for _ in range(160)]
    texts = [template + [word() for _ in range(40)] for _ in range(400)]
    for i in range(0, 400, 4):
        texts.append(texts[i][:182] + [word() for _ in range(18)])
    docs = spark.createDataFrame([(i, " ".join(t), "", "", "") for i, t in enumerate(texts)], SCHEMA)
    turns, pairs = [], near_duplicates_module._pairs
    monkeypatch.setattr(near_duplicates_module, "_pairs", lambda members, turn, *more: turns.append(turn) or pairs(members, turn, *more))
    found = near_duplicates(docs, common=2.0).collect()
    assert {r.doc_id: r.class_id for r in found} == closure(range(500), [(4 * i, 400 + i) for i in range(100)])
    assert turns == [0, 1]


def test_prefix_join_grows_with_rows(spark):
    """Five times the rows of one template give five times the candidates, and no pair at the threshold is left out."""
    found = {}
    for n in (200, 1000):
        pick = random.Random(n)
        word = lambda: f"w{pick.randrange(1 << 30)}"
        template = [word() for _ in range(170)]
        texts = [template[: pick.randint(150, 170)] + [word() for _ in range(30)] for _ in range(n)]  # 0.7 to 0.76 by pairs
        for i in range(0, n, 4):
            texts.append([*texts[i][: len(texts[i]) - 12], *(word() for _ in range(12))])
        sets = [Weigher(5, (np.empty(0, np.uint64), np.empty(0)))(words(" ".join(t))) for t in texts]
        rows = [(i, i, " ".join(t)) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "node long, label long, text string")
        pairs = {(r.a, r.b) for r in _prefix_pairs(frame, 5, (np.empty(0, np.uint64), np.empty(0)), 0.8).collect()}
        links = {(j, i) for i in range(n, len(texts)) for j in range(i) if weighted_jaccard(sets[j], sets[i]) >= 0.8}
        links |= {(j, i) for i in range(min(n, 200)) for j in range(i) if weighted_jaccard(sets[j], sets[i]) >= 0.8}
        assert len(links) >= n // 4 and links <= pairs
        found[n] = len(pairs)
    assert found[1000] <= 6 * found[200] and found[200] < 2000


def test_group_does_not_discount_its_own_text(spark):
    """A table of two near copies, and a third of the rows near copies of one text: plain similarity decides."""
    pick = random.Random(9)
    text = lambda n: [f"w{pick.randrange(1 << 30)}" for _ in range(n)]
    base = text(200)
    copies = [base, *(base[:179] + text(21) for _ in range(9))]
    plain = Weigher(5, (np.empty(0, np.uint64), np.empty(0)))
    sets = [plain(words(" ".join(t))) for t in copies]
    assert all(0.8 < weighted_jaccard(sets[0], other) < 0.81 for other in sets[1:])
    for texts in (copies[:2], copies + [text(150) for _ in range(20)]):
        docs = spark.createDataFrame([(i, " ".join(t), "", "", "") for i, t in enumerate(texts)], SCHEMA)
        sizes = {r.doc_id: r.class_size for r in near_duplicates(docs).collect()}
        n = min(len(texts), 10)
        assert sizes == {i: n if i < n else 1 for i in range(len(texts))}


def test_query(spark):
    """Classes of the query against all pairs that share a rare shingle."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.class_id for r in queries()["op6_near_duplicates"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    weigh = Weigher(5, common_shingles(docs.select("text"), 5, 0.1))
    sets = {r.doc_id: weigh(words(r.text)) for r in docs.collect()}
    by_shingle = {}
    for i, (hashes, _) in sets.items():
        for h in hashes.tolist():
            by_shingle.setdefault(h, []).append(i)
    pairs = {(a, b) for ids in by_shingle.values() if len(ids) < 100 for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if weighted_jaccard(sets[a], sets[b]) >= 0.8]
    assert len(links) > 20
    assert got == closure(sorted(sets), links)


def test_draws_of_many_sets_go_in_blocks():
    """Sets drawn from together draw what each draws alone, block by block and not set by set."""
    pick, sample = np.random.default_rng(6), Sampler(8)
    sizes = [0, 1, 3, 0, 5000, *pick.integers(1, 60, 200), 0, 1, 4096, 0]
    sets = [(pick.integers(0, 1 << 63, n).astype(np.uint64), pick.random(n) * 4 + 0.1) for n in sizes]
    alone = [sample(*one) for one in sets]
    blocks, values = [], sample._values
    sample._values = lambda own, logs: blocks.append(len(own)) or values(own, logs)
    assert (sample.of_all(sets) == np.array(alone)).all()
    assert sum(blocks) == sum(sizes) and len(blocks) <= sum(sizes) / 2048 + 1
    # By the formula, one shingle at a time.
    for (own, weights), drawn in zip(sets[1:3], alone[1:3]):
        value, shingle = np.full(8, np.inf), np.zeros(8, np.uint64)
        for one, weight in zip(own, weights):
            bits = mixed(one ^ sample.seeds)
            r, c = sample.gamma[bits % 65536], sample.log_gamma[bits // 65536 % 65536]
            b = (bits // (1 << 32) % 65536).astype(np.float32) / np.float32(65536)
            t = np.floor(np.float32(np.log(weight)) / r + b)
            least = c - r * (t + 1 - b) < value
            value = np.where(least, c - r * (t + 1 - b), value)
            shingle = np.where(least, mixed(one ^ mixed(t.astype(np.int64).view(np.uint64) + np.uint64(1))), shingle)
        assert (shingle == drawn).all()


def test_word_hashes_are_not_remembered():
    table = WordHashes()
    known = [b"a", b"word", b"a", "größe".encode()]
    assert table.of([]).tolist() == []
    # The published value of XXH3 for one letter, and equal words alike.
    found = table.of(known)
    assert found[0] == found[2] == 0xE6C632B61E964E1F and len(set(found.tolist())) == 3
    assert not vars(table)
