import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from igarape.llm.source_audit import Pointers, _long_runs, audit

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(rows, least=3, top=200):
    """Rows of the audit of (lang, source, text), by exact whole numbers of Python."""
    terms = [(a or "", s or "", [lower(t) for t in TERM.findall(x or "")]) for a, s, x in rows]
    found = []
    for lang in {a for a, _, _ in terms}:
        seen = Counter(t for a, _, words in terms if a == lang for t in set(words))
        kept = {t for t, n in seen.items() if n >= least}
        counts = defaultdict(Counter)
        for a, s, words in terms:
            if a == lang:
                counts[s].update(t for t in words if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        for s, own in counts.items():
            pair = []
            for other in counts:
                if other != s:
                    pair.append((other, sum((share(own, t) - share(counts[other], t)) ** 2 // share(counts[other], t) for t in kept)))
            term = []
            for t in kept:
                p, q = share(own, t), share(whole, t)
                if own[t] and p > q:
                    term.append((t, (p - q) ** 2 // q))
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return found


def documents():
    rng = random.Random(4)
    words = ["Alpha", "beta", "élan", "ÉLAN", "日本", "x", "verylongword" * 3, "verylongword" * 2, "abcdefgh", "abcdefghi", "the", "a1b", "o'clock"]
    rows = [(None, None, None), (None, "s", ""), ("en", None, "the the"), ("xx", "only", "rare"), ("yy", "a", ""), ("yy", "b", None)]
    for i in range(220):
        lang = rng.choice(["en", "en", "fr", None])
        rows.append((lang, f"s{rng.randrange(7)}", " ".join(rng.choices(words, k=rng.randrange(40))) + rng.choice(["", ".", "Z"])))
    return rows + rows[20:26]


@pytest.mark.parametrize("how", [{}, {"block": 2, "salt_terms": 3, "top": 4}])
def test_equals_brute_force(spark, how):
    rows = documents()
    table = spark.createDataFrame([(a, s, t, 1, 2) for a, s, t in rows], "lang string, source string, text string, n int, term int")
    found = [tuple(r) for r in audit(table.repartition(5), **how).collect()]
    assert sorted(found) == sorted(brute(rows, top=how.get("top", 200)))


def test_small_slices_and_long_texts(spark, monkeypatch):
    from igarape.llm import source_audit

    real = source_audit.term_runs
    monkeypatch.setattr(source_audit, "term_runs", lambda *x: real(*x, size=50, small=4))
    rows = [*documents(), ("en", "long", "word " * 30000 + "x" * 20000 + " Élan" * 3)]
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(r) for r in audit(table).collect()) == sorted(brute(rows))


def test_pointers_are_sorted_with_runs():
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abc\xc3\xa9", k=rng.randrange(1, 30))) for _ in range(3000)] + [b"abcdefgh", b"abcdefgha", b"abcdefg"] * 300
    rng.shuffle(words)
    data = np.frombuffer(b" ".join(words) + b"\0" * 8, "u1")
    lengths = np.array(list(map(len, words)))
    starts = np.cumsum(lengths + 1) - lengths - 1
    for small in (1, 7, 100, 1 << 15):
        order, first = Pointers(data, starts, lengths, small).sort()
        found = [words[i] for i in order]
        assert found == sorted(words)
        assert first.tolist() == [i == 0 or found[i] != found[i - 1] for i in range(len(found))]
        assert all(order[i] > order[i - 1] for i in range(1, len(found)) if not first[i])


def test_long_runs_count_each_word_once():
    text = (b"ab cd " * 999 + b"e" * 10000 + b"\n") * 2
    terms, n = _long_runs(np.frombuffer(text, "u1"), 100, 8)
    assert dict(zip(terms.to_pylist(), n.tolist())) == {"ab": 1998, "cd": 1998, "e" * 10000: 2}


def test_empty_table_and_one_source(spark):
    assert audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    one = spark.createDataFrame([("en", "s", "a b")] * 5, "lang string, source string, text string")
    assert audit(one).count() == 0
