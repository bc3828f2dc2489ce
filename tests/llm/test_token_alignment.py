import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from igarape.llm.queries import QUERIES
from igarape.llm.token_alignment import Aligner, aligned, compare


@pytest.fixture(scope="module")
def plain():
    """Groups and links of a text by the given libraries and sets of ends."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in signs} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in signs)}

    def a_bytes(i):
        return bytes(byte[c] for c in first.id_to_token(i))

    def b_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        if not text:
            return [], [], [], Counter()
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        x, y = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
        if not b"".join(x) == b"".join(y) == f" {text}".encode():
            return [], [], [], Counter()
        ends = [np.cumsum(list(map(len, z))).tolist() for z in (x, y)]
        places = [{e: i + 1 for i, e in enumerate(z)} for z in ends]
        groups, links, begin = [], Counter(), (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            stop = places[0][end], places[1][end]
            own = a[begin[0] : stop[0]], b[begin[1] : stop[1]]
            groups.append("|".join(",".join(map(str, z)) for z in own))
            links.update((i, j) for i in own[0] for j in own[1])
            begin = stop
        return a, b, groups, links

    return run


def texts():
    rng = random.Random(1)
    odd = [None, "", " ", "  ", "a", "foo\n \nbar", "x\t \nfoo", "a  b", " lead", "trail ", "\n", "\n\n x", "▁", "a ▁b", "a\x00b"]
    odd += ["<|endoftext|> a<|endoftext|>b", "<s> </s> <0x0A> <unk>", "日本語のテキスト" * 30, "é x", "a\r\n b\r\n", "　x\xa0 y", "​" * 90]
    odd += [" " * 3000, "z" * 2000, "😀" * 40, "😀😀 😀"]
    return odd + ["".join(rng.choice(" \n\tab1é.日 ") for _ in range(rng.randrange(1, 40))) for _ in range(200)]


def scores(rows, plain):
    """doc_id and the numbers of `compare` for (doc_id, text), by counting in Python."""
    found = [(key, *plain(text)) for key, text in rows]
    held = Counter(pair for *_, links in found for pair in links)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(n, best.get(a, 0))
    result = []
    for key, a, b, groups, links in found:
        spelled = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(n for pair, n in links.items() if held[pair] == best[pair[0]])
        total = sum(n * held[pair] for pair, n in links.items())
        result.append((key, len(a), len(b), len(groups), sum(links.values()), n_best, total, spelled))
    return result


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("lane", [4, 256])
def test_alignment_equals_sets_of_ends(plain, lane):
    rows = texts()
    counts, spelled, row, pairs, times = Aligner(None, lane)([x or "" for x in rows])
    for i, text in enumerate(rows):
        a, b, groups, links = plain(text)
        assert [int(c[i]) for c in counts] == [len(a), len(b), len(groups), sum(links.values())], text
        assert spelled[i].decode() == ";".join(groups)
        own = row == i
        assert dict(zip(pairs[own].tolist(), times[own].tolist())) == {x * 32000 + y: n for (x, y), n in links.items()}


def test_compare_equals_counting(spark, plain, monkeypatch):
    from igarape.llm import token_alignment

    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())] + [(5, "the cat sat"), (5, "the cat sat"), (6, "the cat")]
    table = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, row int, pairs string").repartition(5)
    expected = ordered(scores(rows, plain))
    for heavy in (1 << 16, 20, 0):
        monkeypatch.setattr(token_alignment, "_HEAVY", heavy)
        assert ordered([tuple(r) for r in compare(table).collect()]) == expected


def test_long_text_and_many_lanes(plain):
    text = " ".join(random.Random(3).choices(["alpha", "naïveté", "日本", "x\ny", "don't", "1234567"], k=60000))
    counts, spelled, *_ = Aligner(None, 64)([text, "short one"])
    a, b, groups, links = plain(text)
    assert [int(c[0]) for c in counts] == [len(a), len(b), len(groups), sum(links.values())]
    assert spelled[0].decode() == ";".join(groups)


def test_words_are_forgotten(plain):
    align = Aligner(None, 256)
    align.vocabularies._remembered = 5
    for text in ("one two three four", "five six seven eight", "one nine", "two  spaces"):
        assert align([text])[1][0].decode() == ";".join(plain(text)[2])


def test_groups_column_and_empty_table(spark, plain):
    rows = spark.createDataFrame([(1, "naïve café"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in aligned(rows, with_groups=True).collect()}
    assert found[1]["groups"] == ";".join(plain("naïve café")[2]) and found[2]["groups"] == "" and found[2]["pairs"] == []
    assert compare(rows.limit(0)).count() == 0


def test_query_equals_counting(spark, plain):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered([tuple(r) for r in QUERIES["op13_token_alignment"](spark, folder).collect()]) == ordered(scores(rows, plain))
