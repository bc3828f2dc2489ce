import random
import zlib

import numpy as np
import pytest

from igarape.llm.packing import Encoder, first_fit_decreasing, pack, pieces

TEXTS = [
    "",
    " ",
    "a",
    "a b",
    "a  b   c",
    " lead",
    "trail ",
    "a \n b\n\n c\t d",
    "it's we're  x",
    "é ü   z",
    "12345 #$% <|endoftext|> and <|endoftext|>",
    "日本語 テキスト",
    "x" * 5000,
    "\n \n",
    "a  b",
]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_equals_tokenizer(reference):
    random.seed(5)
    encode = Encoder(remembered=50)
    signs = ["a", "word", " ", " ", "\n", ",", "é", "7", "'s", "Ab", " ", "日"]
    texts = TEXTS + ["".join(random.choice(signs) for _ in range(40)) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(reference, text)[:-1], repr(text)


def test_first_fit_decreasing_equals_a_plain_scan():
    random.seed(6)
    for n in (1, 2, 3, 50, 500):
        lengths = sorted((random.randint(1, 100) for _ in range(n)), reverse=True)
        room, expected = [], []
        for item in lengths:
            at = next((i for i, r in enumerate(room) if r >= item), len(room))
            if at == len(room):
                room.append(100)
            expected.append((at, 100 - room[at]))
            room[at] -= item
        assert first_fit_decreasing(lengths, 100) == expected


def check_packed(rows, documents, reference, length=1024):
    """Pieces cover each document's ids once; sequences are gapless and not too long."""
    by_place, by_doc = {}, {}
    for r in rows:
        by_place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_place.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end and size > 0
            end += size
        assert end <= length
    for key, texts in documents.items():
        found = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc.pop(key))
        expected = []
        for text in texts:
            ids = np.array(ids_of(reference, text), "<u4")
            for start in range(0, len(ids), length):
                part = ids[start : start + length]
                expected.append((start, len(part), zlib.crc32(part.tobytes()), len(ids)))
        assert found == sorted(expected)
    assert not by_doc
    return by_place


def test_packing_keeps_every_id(spark, reference):
    random.seed(8)
    docs = {i: [t] for i, t in enumerate(TEXTS)}
    docs |= {i: ["word " * random.randint(1, 3000)] for i in range(100, 160)}
    docs[None] = [None, "no id"]
    docs[7] = [TEXTS[7]] * 3  # repeated rows
    rows = [(k, t, 1) for k, texts in docs.items() for t in texts]
    table = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(5)
    found = pack(pieces(table), group_pieces=40).collect()
    sequences = check_packed(found, docs, reference)
    padding = sum(1024 - sum(n for _, n in x) for x in sequences.values())
    assert padding < 0.2 * 1024 * len(sequences)
    assert {s >> 32 for s in sequences} == set(range(max(s >> 32 for s in sequences) + 1))


def test_pieces_give_their_ids(spark, reference):
    table = spark.createDataFrame([(1, "word " * 3000)], "doc_id long, text string")
    parts = sorted(pieces(table, with_ids=True).collect(), key=lambda r: r["start"])
    assert sum((list(r["ids"]) for r in parts), []) == ids_of(reference, "word " * 3000)


def test_empty_table(spark):
    assert pack(pieces(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
