import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from igarape.llm import simhash
from igarape.llm.simhash import anchors, components, fingerprint, links, near_duplicates, one_of_each


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, bits=3):
    values = np.array(values, "u8")
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    root = np.arange(len(values))
    while True:
        new = np.array([root[near[i]].min() for i in range(len(values))])
        if (new == root).all():
            return root
        root = new


def test_fingerprint_equals_brute_force(monkeypatch):
    texts = [None, "", " \t", "A", "a b", "A b C", "É É É x", "the cat sat on the mat " * 30, "a\x0bb\x0cc\rd"]
    for part in (1 << 20, 16, 1):
        monkeypatch.setattr(simhash, "_PART", part)
        for text in texts:
            assert fingerprint((text or "").encode()) == brute_print(text), (part, text)


def test_anchors_cover_all_close_pairs():
    random.seed(1)
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, 3)):
            b ^= 1 << bit
        row, anchor = anchors(np.array([a, b], "u8"))
        assert set(anchor[row == 0]) & set(anchor[row == 1]), (a, b)
        for side in range(2):
            half = a >> 31 * side & (1 << 31) - 1
            own = [x & (1 << 31) - 1 for x in anchor[row == 0].tolist() if x >> 62 == side]
            assert len(own) == len(set(own)) and len(own) in (1, 16)
            distances = sorted(bin(x ^ half).count("1") for x in own)
            assert distances[0] <= 1 and distances[-1] <= 2


@pytest.mark.parametrize("split_rows", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, split_rows):
    random.seed(4)
    values = {random.getrandbits(64) for _ in range(150)}
    for centre in list(values)[:6]:
        for _ in range(60):
            near = centre
            for bit in random.sample(range(64), random.randint(1, 4)):
                near ^= 1 << bit
            values.add(near)
    values = sorted(values)
    rows = spark.createDataFrame([(int(np.uint64(v).astype("i8")),) for v in values], "fp long")
    found = {r["node"]: r["root"] for r in components(links(rows, split_rows=split_rows)).collect()}
    signed = [int(np.uint64(v).astype("i8")) for v in values]
    roots = [found.get(s, s) for s in signed]
    expected = brute_roots(values)
    assert len(set(roots)) == len(set(expected.tolist()))
    assert len(set(zip(roots, expected.tolist()))) == len(set(roots))


def test_links_beyond_three_bits_are_refused(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([], "fp long"), bits=4)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100}


def documents():
    random.seed(9)
    base = " ".join(random.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + str(i % 70) for i in range(300))
    rows = [(None, None, 1), (5, "", 1), (2, "  ", 1), (9, base, 1), (9, base, 1), (4, base + " tail", 1), (None, base, 1)]
    for i in range(20, 60):
        words = base.split()
        words[random.randrange(300)] = "changed"
        rows.append((i, " ".join(words), 1))
    rows += [(i, " ".join(random.choice("abcdefgh") for _ in range(40)), 1) for i in range(70, 90)]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = documents()
    table = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    prints = [brute_print(t) for _, t, _ in rows]
    roots = brute_roots(prints).tolist()
    ids = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in roots}
    expected = [(i, f"{p:016x}", ids[r]) for (i, _, _), p, r in zip(rows, prints, roots)]
    order = lambda x: tuple((v is not None, v or "") if not isinstance(v, int) else (True, f"{v:09d}") for v in x)
    got = [tuple(r) for r in near_duplicates(table, split_rows=8).collect()]
    assert sorted(got, key=order) == sorted(expected, key=order)

    kept = one_of_each(table)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert kept.count() == len(set(roots))
    assert kept.filter("doc_id is null").count() == 0
    assert {r["doc_id"] for r in kept.collect()} == set(ids.values())


def test_empty_table_and_one_hot_text(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    same = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"))
    assert near_duplicates(same).select("component_id").distinct().collect()[0][0] == 0
    assert one_of_each(same).count() == 1
