import random

import numpy as np
import pytest
import xxhash

from tests.llm.test_near_duplicates import closure
from tidemark.llm.byte_index import fingerprint, links_between, position_masks, simhash_components, split_masks
from tidemark.llm.queries import queries

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def brute_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c not in SPACE:
            word += c.lower() if "A" <= c <= "Z" else c
        elif word:
            words, word = [*words, word], ""
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints):
    """Label of each distinct fingerprint, from all pairs."""
    entries = np.array(sorted(set(fingerprints)), np.uint64)
    links = []
    for i, entry in enumerate(entries):
        near = np.flatnonzero(np.bitwise_count(entries[:i] ^ entry) <= 3)
        links += [(int(entries[j]), int(entry)) for j in near]
    return closure([int(e) for e in entries], links)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_masks():
    masks = position_masks()
    assert len(masks) == 14 and all(mask.bit_count() == 32 for mask in masks)
    for differ in [(a, b, c) for a in range(8) for b in range(8) for c in range(8)]:
        assert any(all(not mask >> 8 * p & 1 for p in differ) for mask in masks)
    finer = split_masks(masks[0])
    assert len(finer) == 4 and all(m & masks[0] == masks[0] and m.bit_count() == 40 for m in finer)


@pytest.mark.parametrize("crowd", [0, 9000])
def test_links_against_all_pairs(spark, crowd):
    """Also where thousands of entries share four, five and six bytes."""
    pick = random.Random(crowd)
    entries = {pick.getrandbits(64) for _ in range(1500)}
    for entry in list(entries)[:300]:
        for _ in range(pick.randint(1, 4)):
            for _ in range(pick.randint(1, 5)):
                entry ^= 1 << pick.randrange(64)
            entries.add(entry)
    base = pick.getrandbits(64)
    while crowd and len(entries) < crowd:
        spread = pick.getrandbits(13) << 3 if len(entries) % 2 else pick.getrandbits(64) & 0x0000FF00FF00FF00
        entries.add(base ^ spread)
    expected = brute_components(entries)
    frame = spark.createDataFrame([(signed(e),) for e in entries], "fp long")
    links = links_between(frame).collect()
    assert all(r.a % (1 << 64) in entries and r.b % (1 << 64) in entries for r in links)
    assert closure(sorted(entries), [(r.a % (1 << 64), r.b % (1 << 64)) for r in links]) == expected
    assert len(links) < 60 * len(entries)


def test_odd_rows(spark):
    schema = "doc_id long, text string, fp string, component_id string, label string"
    rows = [(5, None), (3, " \n\t"), (None, ""), (9, "One"), (8, "oNE "), (None, "x y z q"), (7, "ÄB c"), (6, "äb c"), (8, "oNE ")]
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], schema)
    found = simhash_components(docs).collect()
    ones = f"{brute_fingerprint('one'):016x}"
    zero = "0" * 16
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in found)
    expected = [(5, zero, 3), (3, zero, 3), (-1, zero, 3), (9, ones, 8), (8, ones, 8), (8, ones, 8)]
    expected += [(-1, f"{brute_fingerprint('x y z q'):016x}", None)]
    expected += [(7, f"{brute_fingerprint('Äb c'):016x}", 7), (6, f"{brute_fingerprint('äb c'):016x}", 6)]
    assert got == sorted(expected, key=lambda r: (r[0], r[1]))
    assert found and simhash_components(docs.where("false")).count() == 0


def test_long_text():
    text = " ".join(str(i * i % 99991) for i in range(200_000))
    words = text.split()
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)], np.uint64)
    ones = [int((hashes >> np.uint64(bit) & np.uint64(1)).sum()) for bit in range(64)]
    assert fingerprint(text.encode()) == sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(hashes))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    label = brute_components(prints.values())
    least = {}
    for doc_id, fp in sorted(prints.items()):
        least.setdefault(label[fp], doc_id)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in queries()["op11_byte_index"](spark, SF).collect()}
    assert got == {(i, f"{fp:016x}", least[label[fp]]) for i, fp in prints.items()}
    assert len(set(least.values())) < len(docs)
