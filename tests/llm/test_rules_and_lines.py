import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from igarape.llm.line_runs import LineRuns, without_repeated_lines
from igarape.llm.quality_rules import MORE_RULES, STOP_WORDS, Rule, judge

_BLANK = "[\x20\x09-\x0d]+"


def measured(text):
    t = text or ""
    words = [w for w in re.split(_BLANK, t) if w]
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", t)),
        "n_stop_words": sum(w.lower() in STOP_WORDS for w in words),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def some_texts():
    random.seed(3)
    vocabulary = ["the", "of", "été", "x#", "a&b", "wörd", "Und", " ", "日本"]
    texts = [None, "", " \n\t ", "one", "a b", "a b c", "a a a a", "x\n\nx\nx", "\x0ba\x0cb\rc"]
    texts += [" ".join(random.choice(vocabulary) for _ in range(random.randint(1, 90))) for _ in range(60)]
    texts += ["\n".join(random.choice(["the cat", "sat", " sat", ""]) for _ in range(30)) for _ in range(10)]
    cycle = " ".join(f"w{i}" for i in range(60))
    texts += [f"{cycle} {cycle} end", "word " * 400]  # many windows repeat
    return texts


def test_measures_equal_brute_force(spark):
    texts = some_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in judge(rows).collect():
        found, expected = row["quality"], measured(texts[row["doc_id"]])
        assert {k: found[k] for k in expected} == expected, texts[row["doc_id"]]
        n, repeat = expected["n_words"], expected["n_repeat_words"]
        assert found["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (found["base_failed"] and found["kept"])


def test_rules_are_a_table_and_need_no_python(spark):
    clean = " ".join(f"the word{i}" for i in range(60))
    rows = spark.createDataFrame(
        [(1, clean, 5), (2, clean.replace("word", "#$%"), 5), (2, clean.replace("word", "#$%"), 5)],
        "doc_id long, text string, n_words int",
    )
    result = judge(rows, into="verdict")
    assert [(r["doc_id"], r["n_words"], r["verdict"]["kept"]) for r in result.orderBy("doc_id").collect()] == [
        (1, 5, True),
        (2, 5, False),
        (2, 5, False),
    ]
    strict = judge(rows, rules=(*MORE_RULES, Rule("short", "n_words", "one", most=100)))
    assert not strict.filter("quality.kept").count()
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert judge(rows.limit(0)).count() == 0


def kept_lines(docs, min_chars=40, min_docs=5):
    """Brute force: (id, kept text, lines, dropped) of rows (id, text)."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for number, (_, text) in enumerate(docs):
        for line in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(line, []).append(number)
    result = []
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            rows = holders[key(line)]
            ids = [docs[r][0] for r in rows if docs[r][0] is not None]
            common = len(key(line)) >= min_chars and len(rows) >= min_docs
            if not common or i == (max(ids) if ids else None):
                stay.append(line)
        result.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return result


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines_equal_brute_force(spark, batches):
    random.seed(batches)
    common = [f"  This is the Common passage number {i}, which many hold é" for i in range(6)]
    short = "a short line"
    docs = [(None, None), (None, common[0]), (3, ""), (3, common[1]), (3, common[1]), (-5, "\n".join(common))]
    for i in range(10, 70):
        parts = [random.choice([*common, common[0].upper() + "\t", short, f"own line {i} " * 5, ""]) for _ in range(6)]
        docs.append((i, "\n".join(parts)))
    docs.append((1000, "\n".join([common[2]] * 3 + ["x" * 39, "y" * 40])))
    rows = spark.createDataFrame([(i, t, "s", 7) for i, t in docs], "doc_id long, text string, keeper string, n long")
    found = without_repeated_lines(rows, batches=batches)
    assert found.columns[:4] == ["doc_id", "text", "keeper", "n"]
    got = [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in found.collect()]
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2], x[3])
    assert sorted(got, key=order) == sorted(kept_lines(docs), key=order)


def test_lines_of_an_empty_table(spark):
    assert without_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_compacted_by_level(spark):
    runs = LineRuns(spark, fanout=2)
    for batch in range(5):
        rows = [(k, 0, 100 - batch) for k in range(batch, batch + 3)]
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, id long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r["h1"]: (r["n"], r["keeper"], r["first"]) for r in runs.rows().collect()}
    assert found[2] == (3, 100, True) and found[6] == (1, 96, True) and len(found) == 7


def test_a_hot_line_is_one_row_before_it_is_shuffled(spark):
    line = "the very same line in every single document of all"
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(line).alias("text"))
    found = without_repeated_lines(rows).agg(F.sum("n_dropped").alias("gone"), F.max_by("kept_text", "doc_id")).first()
    assert found[0] == 2999 and found[1] == line
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
