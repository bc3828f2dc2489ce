import collections
import math
import random
import zlib

import numpy as np
import pytest

from igarape.llm import weak_quality
from igarape.llm.lattice_sampling import BLANK, Sampler, Vocabulary, sample
from igarape.llm.queries import QUERIES
from igarape.llm.weak_quality import LABELLERS, classify, fit_labels, pattern, votes

FOLDER = "/root/testdata/sf0.01"


def test_expectation_maximisation_finds_accuracies():
    random = np.random.default_rng(1)
    good = random.random(20000) < 0.8
    false_alarm, hits = np.linspace(0.001, 0.009, LABELLERS), np.linspace(0.3, 0.7, LABELLERS)
    bad_votes = np.where(good[:, None], random.random((20000, LABELLERS)) < false_alarm, random.random((20000, LABELLERS)) < hits)
    cast = np.where(bad_votes, 0, 1)
    cast[random.random(cast.shape) < 0.2] = 2
    numbers = np.array([pattern(row) for row in cast.tolist()])
    patterns, counts = np.unique(numbers, return_counts=True)
    model = fit_labels(patterns, counts.astype(float), strength=0.0)
    assert model.share == pytest.approx(0.8, abs=0.02)
    assert model.chances[:, 0, 0] == pytest.approx(hits, abs=0.04)
    assert model.chances[:, 1, 0] == pytest.approx(false_alarm, abs=0.004)
    belief = model.posterior(numbers)
    assert ((belief > 0.5) == good).mean() > 0.95
    assert (model.accuracies() > 0.8).all()


def test_votes_of_odd_texts():
    for text in ["", " \n", "x", "a " * 1000, "!!! ###", "É" * 50]:
        assert len(votes(text, text.split())) == LABELLERS


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = {r["doc_id"]: r["kept"] for r in classify(docs.select("doc_id", "text")).collect()}
    pairs = [(found[i], q) for i, q in labels.items() if i in found]
    assert np.mean([k for k, q in pairs if q == 1]) >= 0.99
    assert np.mean([not k for k, q in pairs if q == 0]) >= 0.9


def test_classifier_takes_any_row(spark):
    rows = [(None, None, 1.0), (1, "", 1.0), (2, "the cat sat on the mat and slept " * 9, 1.0), (3, "#" * 200000, 1.0)]
    table = spark.createDataFrame([*rows, rows[2], rows[2]], "doc_id long, text string, score double")
    found = classify(table).collect()
    assert len(found) == 6
    assert len({(r["posterior"], r["score"], r["kept"]) for r in found if r["doc_id"] == 2}) == 1
    assert not any(r["kept"] for r in found if r["doc_id"] in (None, 1))
    assert classify(table.limit(0)).count() == 0


def test_training_rows_are_bounded_for_null_and_repeated_ids(spark, monkeypatch):
    taken = []
    train = weak_quality.train
    monkeypatch.setattr(weak_quality, "train", lambda rows, size: taken.append(len(rows)) or train(rows, size))
    text = lambda i: f"the word{i} of the river is not far from the house and {i} trees"
    ids = [None] * 1000 + [7] * 1000 + list(range(10, 1010))
    table = spark.createDataFrame([(n, text(i)) for i, n in enumerate(ids)], "doc_id long, text string")
    assert classify(table, fit_rows=300).count() == 3000
    repeated = spark.createDataFrame([(None, text(0))] * 2000 + [(i, text(i)) for i in range(50)], table.schema)
    assert classify(repeated, fit_rows=5000).count() == 2050
    assert 240 <= taken[0] <= 300 and taken[1] == 51


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary()


def segmentations(vocabulary, unit):
    if not unit:
        yield (), 0.0
    for j in range(1, len(unit) + 1):
        if unit[:j] in vocabulary.pieces:
            code, weight = vocabulary.pieces[unit[:j]]
            for rest, more in segmentations(vocabulary, unit[j:]):
                yield (code, *rest), weight + more


def test_samples_follow_the_distribution(vocabulary):
    text = "than re"
    both = [segmentations(vocabulary, BLANK + w) for w in text.split()]
    tails = list(both[1])
    weights = {a + b: math.exp(p + q) for a, p in both[0] for b, q in tails}
    total = sum(weights.values())
    chance = {k: w / total for k, w in weights.items()}
    n, k = 20000, 3
    drawn = Sampler(vocabulary)([text] * n, list(range(n)), k)
    first = collections.Counter(tuple(row[0][0].tolist()) for row in drawn)
    pairs = collections.Counter(tuple(tuple(x[0].tolist()) for x in row[:2]) for row in drawn)
    for key in sorted(chance, key=chance.get)[-3:]:
        assert first[key] / n == pytest.approx(chance[key], abs=4 * math.sqrt(chance[key] / n))
    for (a, b), seen in pairs.most_common(3):
        expected = chance[a] * chance[b] / (1 - chance[a])
        assert seen / n == pytest.approx(expected, abs=4 * math.sqrt(expected / n))
    for row in drawn:
        found = [tuple(x[0].tolist()) for x in row]
        assert len(set(found)) == k == len(found)
        assert [x[2] for x in row] == sorted((x[2] for x in row), reverse=True)
        for ids, log_prob in zip(found, (x[1] for x in row)):
            assert log_prob == pytest.approx(math.log(chance[ids]), abs=1e-9)
    # weights chance / inclusion are unbiased for any sum over segmentations
    for key in sorted(chance, key=chance.get)[-3:]:
        held = [chance[key] / x[3] for row in drawn for x in row if tuple(x[0].tolist()) == key]
        assert sum(held) / n == pytest.approx(chance[key], rel=0.05)


TEXTS = [None, "", " ", "a", "a b", "  two  blanks ", "line\nbreak\ttab", "ça été 日本語 🙂", "x" * 300, "word " * 500 + "end", "▁odd"]


def test_decoding_gives_the_text_back(vocabulary):
    rows = [t or "" for t in TEXTS]
    for text, found in zip(rows, Sampler(vocabulary)(rows, list(range(len(rows))), 4)):
        assert len({tuple(x[0].tolist()) for x in found}) == len(found) >= 1
        for ids, log_prob, _, inclusion in found:
            assert vocabulary.decode(ids.tolist()) == text.replace(BLANK, " ")
            assert log_prob <= 1e-6 and 0 <= inclusion <= 1


def test_few_segmentations_are_all_returned(vocabulary):
    every = list(segmentations(vocabulary, BLANK + "to"))
    (found,) = Sampler(vocabulary)(["to"], [5], 100)
    assert {tuple(x[0].tolist()) for x in found} == {ids for ids, _ in every}
    assert all(x[3] == 1.0 for x in found)
    assert sum(math.exp(x[1]) for x in found) == pytest.approx(1)


def test_samples_depend_on_the_key_only(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], 1) for i in range(40)] + [(None, "no key", 1), (3, TEXTS[3], 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, sample int")
    order = lambda r: (str(r["key"]), r["sample"], r["ids"])
    one = sorted(sample(table.repartition(1)).collect(), key=order)
    many = sorted(sample(table.repartition(7), part=10).collect(), key=order)
    assert one == many
    assert sample(table.limit(0)).count() == 0
    assert len({r["ids_crc32"] for r in one if r["key"] in (9, 20, 31)}) > 1


def edges_of(vocabulary, word):
    number = vocabulary.numbers([word])[0]
    root, size = vocabulary.roots[number], vocabulary.sizes[number]
    begin = vocabulary.first[root]
    end = vocabulary.first[root + size] if root + size < len(vocabulary.first) else len(vocabulary.to)
    nodes = [x - begin for x in vocabulary.first[root : root + size]]
    to = [x - root if x >= 0 else -1 for x in vocabulary.to[begin:end]]
    return nodes, to, list(vocabulary.code[begin:end]), list(vocabulary.below[begin:end]), list(vocabulary.log_q[begin:end])


def test_lattices_do_not_depend_on_other_words():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeétionsz", k=rng.randrange(1, 20))) for _ in range(400)] + ["", "日本", "x" * 64, "y" * 65]
    together = Vocabulary()
    together.numbers(words)
    alone = Vocabulary()
    for word in words[::-1]:
        assert edges_of(alone, word) == edges_of(together, word), word


def test_forgetting_keeps_the_samples(vocabulary):
    rng = random.Random(3)
    small = Vocabulary(edges=3000)
    common = ["the", "of", "cat", "house", "running"]
    for i in range(12):
        rows = [" ".join(rng.choices(common, k=30) + ["".join(rng.choices("abcdefgh", k=8)) for _ in range(20)]) for _ in range(3)]
        few, many = Sampler(small)(rows, [i, 1, 2], 2), Sampler(vocabulary)(rows, [i, 1, 2], 2)
        assert [[(x[0].tolist(), *x[1:]) for x in r] for r in few] == [[(x[0].tolist(), *x[1:]) for x in r] for r in many]
    assert len(small.to) < 30000 and len(vocabulary.known) > len(small.known)


def test_a_very_long_text(vocabulary):
    rng = random.Random(4)
    text = " ".join(rng.choices(["alpha", "beta", "naïveté", "of", "x" * 70, "日本語"], k=1_400_000))
    assert len(text) > 10_000_000
    (found,) = Sampler(vocabulary)([text], [1], 2)
    assert len(found) == 2 and all(vocabulary.decode(x[0]) == text for x in found)
    assert found[0][0].tolist() != found[1][0].tolist()


def test_query_returns_the_sampled_pieces(spark, vocabulary, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op8_lattice_sampling"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(TEXTS)))
    for r in rows:
        assert len(r["ids"]) == r["n_pieces"] and zlib.crc32(np.array(r["ids"], "<i4")) == r["ids_crc32"]
        assert vocabulary.decode(r["ids"]) == (TEXTS[r["doc_id"]] or "").replace(BLANK, " ")
