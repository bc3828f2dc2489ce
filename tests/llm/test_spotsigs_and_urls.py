import hashlib
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from igarape.llm.spotsigs import compare_with_edits, digest, likeness, signatures, similar_pairs
from igarape.llm.url_filter import RULES, Model, fit, host_and_path, judge


def signature_sets(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = rows.select("id", signatures(F.col("text")).alias("sigs"))
    return {r["id"]: r["sigs"] for r in found.collect()}


def test_signatures_are_chains_of_content_words(spark):
    texts = [
        "The quick, (brown) fox and of jumps high",
        "the QUICK brown? fox and OF jumps high",
        "the quick brown fox",
        "quick brown fox runs",
        "quick",
        "",
        None,
        "...",
        "the the the the",
    ]
    found = signature_sets(spark, texts)
    assert len(found[0]) == 3 and found[0] == found[1]  # the, and, of
    assert len(set(found[2]) & set(found[0])) == 1
    assert len(found[3]) == 2  # no common word: all chains of three words
    assert found[5] == found[6] and len({tuple(found[i]) for i in (4, 5, 7, 8)}) == 4


def edited_pairs(rows):
    """(id, n, edited text) by brute force; null ids first, equal ids by text."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    result = []
    for number, (i, text) in enumerate(ordered):
        half = len(text) // 2
        after = ordered[(number + 1) % len(ordered)][1]
        result.append((i, text, text[: len(text) - half] + after[:half], after))
    return result


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_edits_equal_brute_force(spark, blocks):
    random.seed(blocks)
    words = ["the", "of", "été", "river", "stone", "日本", "and", "blue"]
    rows = [(i * 7 % 101, " ".join(random.choice(words) for _ in range(random.randint(0, 40)))) for i in range(60)]
    rows += [(None, None), (None, "no id"), (50, "repeated row"), (50, "repeated row"), (2**60 + 1, "far"), (-9, "x")]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, block int").repartition(3)
    found = compare_with_edits(table, blocks=blocks).collect()
    expected = edited_pairs(rows)
    sets = signature_sets(spark, [x for _, t, e, a in expected for x in (t, e, a)])
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    wanted = [
        (str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(sets[3 * n], sets[3 * n + 1]), jaccard(sets[3 * n], sets[3 * n + 2]))
        for n, (i, t, e, _) in enumerate(expected)
    ]
    got = [(str(r[0]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found]
    assert sorted(got) == sorted(wanted)
    prints = {}
    for r, key in [(r, r["n_chars"]) for r in found if r["doc_id"] == 50]:
        prints.setdefault(key, set()).add(r["fingerprint"])
    assert all(len(x) == 1 for k, x in prints.items() if k == len("repeated row"))


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "the quick brown fox")], "doc_id long, text string")
    row = compare_with_edits(one).first()
    assert row["near_next"] == 1.0
    assert compare_with_edits(one.limit(0)).count() == 0


def test_no_python_runs(spark):
    one = spark.createDataFrame([(1, "the quick brown fox")], "doc_id long, text string")
    assert "Python" not in compare_with_edits(one)._jdf.queryExecution().toString()
    urls = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert "Python" not in judge(urls)._jdf.queryExecution().toString()


def test_similar_pairs_equal_brute_force(spark):
    random.seed(3)
    sets = {}
    for i in range(40):
        base = random.sample(range(1000), 30)
        for j in range(3):
            sets[3 * i + j] = sorted(set(base[: 30 - j * 2] + random.sample(range(2000, 3000), j) + [1, 2]))
    rows = spark.createDataFrame(list(sets.items()), "id long, sigs array<long>")
    found = {(r["a"], r["b"]): r["likeness"] for r in similar_pairs(rows).collect()}
    expected = {}
    for a in sets:
        for b in sets:
            if a < b and (near := len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b]))) >= 0.8:
                expected[a, b] = near
    assert found == pytest.approx(expected) and len(expected) > 20


def test_pruned_likeness_and_digest(spark):
    row = spark.range(1).select(
        likeness(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2)), 0.8).alias("far"),
        likeness(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2))).alias("near"),
        F.length(digest(F.array(F.lit(1).cast("long")))).alias("n"),
    )
    assert tuple(row.first()) == (0.0, 0.5, 32)


def brute_host_and_path(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def brute_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://A.COM/x://y", "http://com/", "http://a.com", "http://a.com?x/",
    "http://acom/", "https://www.example.com/en/1", "https://x.www.example.com/en/", "https://example.com/en/?q#f",
    "https://example.com/en", "http://b.example.com/EN/", "http://a.net/es/#f", "http://net/fr/", "http://a.net/de/",
    "http://É.COM/a?b#c/d", "http://a.org#x/y", "ftp://user@h.com:80/p/q?r", "x\n://y.com/\nz",
]


def test_hosts_and_rules_equal_brute_force(spark):
    rows = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for r in judge(rows).collect():
        host, path = brute_host_and_path(r["url"])
        rule = brute_rule(host, path)
        assert (r["host"], r["path"]) == (host, path), r["url"]
        assert r["rule"] == (rule.name if rule else None), r["url"]
        assert r["verdict"] == (rule.verdict if rule else r["verdict"]) and r["verdict"] in ("allow", "block")
        assert (r["score"] is None) == (rule is not None)
    assert len(rows.select(*host_and_path(F.col("url"))).columns) == 2


class BruteModel:
    """The same two models, counted and mixed in Python."""

    def __init__(self, labelled, order, buckets, prior):
        self.order, self.buckets, self.prior = order, buckets, prior
        self.counts = {"allow": {}, "block": {}}
        for url, verdict in labelled:
            for cells in self.cells(url):
                for pair in cells:
                    for cell in pair:
                        self.counts[verdict][cell] = self.counts[verdict].get(cell, 0) + 1

    def cells(self, url):
        framed = "\x02" + (url or "") + "\x03"
        cell = lambda table, part: (table, xxhash.xxh64_intdigest(part.encode(), 42) % self.buckets if xxhash.xxh64_intdigest(part.encode(), 42) < 1 << 63 else (xxhash.xxh64_intdigest(part.encode(), 42) - (1 << 64)) % self.buckets)
        return [
            [
                (cell(("seen", k), framed[i - k + 1 : i]), cell(("both", k), framed[i - k + 1 : i + 1]))
                for k in range(1, self.order + 1)
                if i >= k - 1
            ]
            for i in range(1, len(framed))
        ]

    def score(self, url):
        total, found = 0.0, self.cells(url)
        for cells in found:
            logs = []
            for verdict in ("allow", "block"):
                value, counts = 1 / 256, self.counts[verdict]
                for seen, both in cells:
                    value = (counts.get(both, 0) + self.prior * value) / (counts.get(seen, 0) + self.prior)
                logs.append(math.log(value))
            total += logs[0] - logs[1]
        return total / len(found)


def test_model_equals_brute_force(spark):
    random.seed(5)
    good = [f"http://good{random.randint(1, 30)}.com/a/{random.randint(1, 99)}" for _ in range(200)]
    bad = [f"http://spam{random.randint(1, 30)}.net/fr/{random.randint(1, 99)}" for _ in range(200)]
    labelled = [(u, "allow") for u in good] + [(u, "block") for u in bad]
    rows = spark.createDataFrame(labelled, "url string, verdict string")
    model = fit(rows, order=3, buckets=1024, prior=2.0)
    held = {r["url"] for r in rows.filter(F.pmod(F.xxhash64("url"), F.lit(5)) == 0).collect()}
    brute = BruteModel([x for x in labelled if x[0] not in held], 3, 1024, 2.0)
    ask = ["http://good99.com/a/5", "http://spam5.net/fr/1", "é", "", None, *good[:5], *bad[:5]]
    asked = spark.createDataFrame([(u,) for u in ask], "url string")
    for r in asked.select("url", model.score(F.col("url")).alias("s")).collect():
        assert r["s"] == pytest.approx(brute.score(r["url"]), abs=1e-9)
    scores = sorted((math.floor(brute.score(u) * 64), v) for u, v in labelled if u in held)
    right = lambda cut: sum((b >= cut) == (v == "allow") for b, v in scores)
    assert right(model.cut * 64) == len(scores)  # these classes can be told apart


def test_without_examples_all_pass(spark):
    rows = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.com/")], "page_id long, url string")
    assert {r["verdict"] for r in judge(rows).collect()} == {"allow"}
    assert judge(rows.limit(0)).count() == 0
    assert isinstance(fit(rows.select("url", F.lit("allow").alias("verdict")), buckets=64), Model)


class ExactModel(BruteModel):
    """Counts by the characters themselves."""

    def cells(self, url):
        framed = "\x02" + (url or "") + "\x03"
        return [
            [(("seen", k, framed[i - k + 1 : i]), ("both", k, framed[i - k + 1 : i + 1])) for k in range(1, self.order + 1) if i >= k - 1]
            for i in range(1, len(framed))
        ]


def brute_verdicts(urls):
    """(score, verdict) of each URL that no rule decides, by exact counts."""
    rules = {u: brute_rule(*brute_host_and_path(u)) for u in urls}
    labelled = [(u, rules[u].verdict) for u in urls if rules[u]]
    number = lambda u: xxhash.xxh64_intdigest(u.encode(), 42)
    held = lambda u: (number(u) - (1 << 64 if number(u) >> 63 else 0)) % 5 == 0
    model = ExactModel([x for x in labelled if not held(x[0])], 4, 0, 2.0)
    bins = [(math.floor(model.score(u) * 64), v) for u, v in labelled if held(u)]
    share = lambda cut, v: sum((b >= cut) == (v == "allow") for b, x in bins if x == v) / sum(x == v for _, x in bins)
    cut = max(sorted({b for b, _ in bins}), key=lambda c: share(c, "allow") + share(c, "block")) / 64
    scores = {u: model.score(u) for u in set(urls) if not rules[u]}
    return {u: (s, "allow" if s >= cut else "block") for u, s in scores.items()}


def test_verdicts_equal_unhashed_brute_force(spark):
    random.seed(8)
    letters = "abcdefghijklmnopqrstuvwxyzéß日本"
    word = lambda: "".join(random.choice(letters) for _ in range(9))
    ends = [".com/", ".net/fr/", ".org/", ".net/de/"]
    urls = [f"http://{word()}{random.choice(ends)}{word()}" for _ in range(1500)]  # far more contexts than 8,192
    urls += [r["url"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").collect()]
    urls += ["http://hot.org/"] * 500 + [None, None, "", "\x02htt", "x"]
    expected = brute_verdicts(urls)
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(5)
    found = judge(rows).collect()
    assert sorted(r["page_id"] for r in found) == list(range(len(urls)))
    left = [r for r in found if r["rule"] is None]
    assert len(left) == sum(u in expected for u in urls)
    for r in left:
        score, verdict = expected[r["url"]]
        assert r["score"] == pytest.approx(score, abs=1e-9), r["url"]
        assert r["verdict"] == verdict, r["url"]
