import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from igarape.llm import parity_join
from igarape.llm.parity_join import Bands, Bitmap, Shingles, keys_of, near_sets, signature, sketch
from igarape.llm.queries import QUERIES


def brute_sets(texts, width=4):
    found = []
    for text in texts:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        found.append(grams or ({tuple(words)} if words else set()))
    return found


def brute(rows, width=4, num=85, den=100):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = brute_sets([t for _, t in rows], width)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    places = {}
    for i, s in enumerate(sets):
        for gram in s:
            places.setdefault(gram, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for gram in s:
            for j in places[gram]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return [(rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows))]


def ordered(rows):
    return sorted((tuple((x is not None, x or 0) for x in r) for r in rows))


def word(rng):
    return rng.choice("of the cat sat on mat dog ran far away".split()) + str(rng.randrange(40))


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        words[at : at + (kind != 1)] = [] if kind == 0 else [word(rng)]
    return " ".join(words)


def documents(seed=3):
    rng = random.Random(seed)
    rows = [(None, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "One Two\x0bThree"), (7, "one two three four")]
    key = 10
    for size in (5, 6, 7, 8, 9, 12, 20, 40, 41, 100, 150, 400, 900):
        for _ in range(3):
            base = " ".join(word(rng) for _ in range(size))
            rows.append((key, base))
            for n in range(8):
                rows.append((key + n + 1, edited(base, rng, rng.randrange(1 + size // 25 + 2))))
            rows.append((key, base))
            key += 10
    rows.append((None, rows[30][1]))
    passage = " ".join(word(rng) for _ in range(60))
    rows += [(key + i, passage + " " + " ".join(word(rng) for _ in range(rng.randrange(5, 40)))) for i in range(60)]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "_BLOCK", 7)
    monkeypatch.setattr(parity_join, "_FEW", 3)
    rows = documents()
    table = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, node int, key int").repartition(7)
    expected = ordered(brute(rows))
    assert ordered(near_sets(table, members=3, split_rows=4, bits=16).collect()) == expected
    monkeypatch.undo()
    assert ordered(near_sets(table, bits=20).collect()) == expected
    assert len({x[2] for x in expected}) < len({x[0] for x in expected}) - 50


@pytest.mark.parametrize("num,den,width", [(80, 100, 5), (1, 2, 3), (1, 1, 4)])
def test_other_thresholds(spark, num, den, width):
    rows = [r for r in documents(8) if r[0] is None or r[0] < 300]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_sets(table, width=width, num=num, den=den, bits=18)
    assert ordered(found.collect()) == ordered(brute(rows, width, num, den))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    bands, pairs = Bands(85, 100), 0
    for size in [*range(1, 80), *rng.integers(80, 3000, 150).tolist()]:
        whole = np.unique(rng.integers(0, 1 << 63, size, dtype="u8"))
        for _ in range(4):
            gone = int(rng.integers(0, size * 15 // 200 + 2))
            new = int(rng.integers(0, size * 15 // 200 + 2))
            other = np.unique(np.concatenate((rng.permutation(whole)[gone:], rng.integers(0, 1 << 63, new, dtype="u8"))))
            common = len(np.intersect1d(whole, other))
            if not len(other) or 100 * common < 85 * (len(whole) + len(other) - common) or len(other) == common == len(whole):
                continue
            pairs += 1
            keys = []
            for x in (whole, other):
                keys.append(set())
                for band in bands.of(len(x)):
                    most, blocks = bands.shape(band)
                    if blocks:
                        keys[-1] |= set(keys_of(sketch(x, blocks), band, most).tolist())
            assert keys[0] & keys[1], (size, gone, new)
            for band in set(bands.of(len(whole))) & set(bands.of(len(other))):
                most, blocks = bands.shape(band)
                if not blocks:
                    continue
                a, b = sketch(whole, blocks), sketch(other, blocks)
                apart = len(whole) + len(other) - 2 * common
                full = int(np.bitwise_count(a ^ b).sum())
                short = sum(bin(x ^ y).count("1") for x, y in zip(signature(whole, most), signature(other, most), strict=True))
                fine = sum(bin(x ^ y).count("1") for x, y in zip(signature(whole, most, True), signature(other, most, True), strict=True))
                assert fine <= apart and short <= apart and full <= apart and (full - apart) % 2 == 0 == (short - apart) % 2
    assert pairs > 300


def test_bitmap_has_no_false_negatives(spark):
    values = [-5, 0, 7, 1 << 40, -(1 << 62), 12345678901]
    held = Bitmap(spark.createDataFrame([(v,) for v in values], "v long"), 20)
    assert held.holds(np.array(values)).all()
    assert held.holds(np.arange(1000, 30000)).sum() <= len(values)
    assert not Bitmap(spark.createDataFrame([], "v long"), 16).holds(np.arange(10)).any()


def test_shingles_of_long_and_odd_texts():
    shingled = Shingles(4, remembered=3)
    assert len(shingled(b"a b c d " * 50000)) == 4
    assert len(shingled(b"x" * 1_000_000)) == 1
    assert len(shingled("É é a b".encode())) == 1 and shingled("É".encode()).tolist() != shingled("é".encode()).tolist()


def test_thousands_of_near_copies_and_copies(spark):
    rng = random.Random(2)
    base = " ".join(word(rng) for _ in range(120))
    rows = [(i, edited(base, rng, 1)) for i in range(1500)] + [(i, base) for i in range(1500, 3000)]
    found = near_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), members=100, split_rows=256)
    counts = {r["component_id"]: r["count"] for r in found.groupBy("component_id").count().collect()}
    assert counts == {0: 3000}


def test_empty_table_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_sets(empty).count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    assert near_sets(same).select("component_id").distinct().collect() == [(0,)]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(QUERIES["op12_parity_join"](spark, folder).collect()) == ordered(brute(rows))


def test_near_sets_of_a_key_give_a_star_and_their_family_is_compared():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 200, dtype="u8")
    sets = [np.unique(np.append(base[k % 4 * 3 :], rng.integers(0, 1 << 63, 3 * (k % 9), dtype="u8"))) for k in range(60)]
    most, _ = Bands(85, 100).shape(Bands(85, 100).of(200)[-1])
    rows = [(1, 0, k, k, signature(x, most, True), len(x)) for k, x in enumerate(sets)]
    stars = parity_join._group_stars(rows, 85, 100)
    assert stars.shape == (2, 59) and (stars[1] == 0).all()
    pairs = {(i, j) for j in range(60) for i in range(j) if parity_join.linked(sets[i], sets[j], 85, 100)}
    found = list(parity_join._linked_classes(sets, np.arange(60), 85, 100))
    assert len(pairs) > 500 and set(found) <= pairs and len(found) <= 59


def test_keys_are_the_blocks_with_the_most_bits_and_linked_sets_share_one():
    rng = np.random.default_rng(9)
    bands, pairs = Bands(85, 100), 0
    for size in [*range(1, 60), *rng.integers(60, 2000, 120).tolist()]:
        whole = np.unique(rng.integers(0, 1 << 64, size, dtype="u8"))
        for _ in range(6):
            gone, new = rng.integers(0, size * 18 // 100 + 2, 2).tolist()
            other = np.unique(np.concatenate((rng.permutation(whole)[gone:], rng.integers(0, 1 << 64, new, dtype="u8"))))
            common = len(np.intersect1d(whole, other))
            if not len(other) or 100 * common < 85 * (len(whole) + len(other) - common) or len(other) == common == len(whole):
                continue
            pairs += 1
            keys = []
            for x in (whole, other):
                keys.append(set())
                for band in bands.of(len(x)):
                    most, blocks = bands.shape(band)
                    differing = bands.differing(len(x), band)
                    assert differing <= most
                    if differing:
                        parities = sketch(x, blocks)
                        found = keys_of(parities, band, differing).tolist()
                        assert len(found) == differing + 1 <= 15 * len(x) // 85 + 1
                        kept = np.isin(keys_of(parities, band, blocks), found)  # ascending by bits
                        assert kept[-len(found) :].all() and not kept[: -len(found)].any()
                        keys[-1] |= set(found)
            assert keys[0] & keys[1], (size, gone, new)
    assert pairs > 200


def test_few_keys_are_shared_by_chance(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(str(rng.randrange(100000)) for _ in range(rng.randrange(100, 140)))) for i in range(4000)]
    sets = parity_join.sketched(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 4, 85, 100)
    counts = sets.select(F.explode(F.flatten("sketches.keys")).alias("key")).groupBy("key").count()
    found = counts.agg(F.sum("count").alias("all"), F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("shared")).first()
    assert found["all"] < 40 * 4000 and found["shared"] < 0.05 * found["all"]
