"""Packing token sequences: first-fit decreasing with a tournament tree, in randomised groups.

A document's ids, with an end id, are cut into pieces of the sequence length and a rest. Pieces
are dealt at random (by hash of place and position) to groups of about `group_pieces` pieces and
each group is packed on its own, so no task holds more than a group, and a group does not depend
on any key of the data. Groups are a thin table: ids do not travel.

Null and empty texts are one piece with the end id only. Repeated rows, also of one id, are
packed as documents of their own. An empty table gives an empty result. Columns other than the
two named ones are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import texts
from igarape.session import cut_lineage

SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a byte-level BPE vocabulary as little-endian 32-bit strings.

    A space before a non-space always begins a new unit of the vocabulary's pattern, so texts
    without two spaces in a row are the concatenation of their space-separated parts. Parts are
    remembered, at most `remembered` of them. Other texts are encoded as a whole.
    """

    def __init__(self, folder: str | None = None, remembered: int = 300_000):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path if folder is None else lambda name: f"{folder}/{name}"
        with open(path("byte_bpe_50k.tiktoken"), "rb") as source:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, source)}
        self._words = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
        self._remembered = remembered
        self._parts = _Parts(self._words)

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:  # the vocabulary's own token, which the word encoder does not know
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text:
            return np.array(self._words.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        if len(self._parts) > self._remembered:
            self._parts.clear()
        head = np.array(self._words.encode_ordinary(first), "<u4").tobytes()
        return head + b"".join(map(self._parts.__getitem__, rest))


class _Parts(dict):
    def __init__(self, words):
        self._encode = words.encode_ordinary

    def __missing__(self, part: str) -> bytes:
        ids = np.array(self._encode(" " + part), "<u4").tobytes()
        if len(part) < 64:
            self[part] = ids
        return ids


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 1024,
    end_id: int = 0,
    with_ids: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens and, if asked, the ids."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long"
    if with_ids:
        schema += ", ids array<int>"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(folder)
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, found = [], []
            for key, value in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids = memoryview(encode(value.decode()) + end)
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((key, start, len(part) // 4, zlib.crc32(part), total, place))
                    place += 1
                    if with_ids:
                        found.append(np.frombuffer(part, "<u4").astype("int32"))
            if rows:
                columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
                if with_ids:
                    columns.append(pa.array(found, pa.list_(pa.int32())))
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, given in descending order of length.

    The leaves of a tournament tree hold the free room of the bins and each inner node the
    largest below it, so the first bin with room is found by one descent.
    """
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    result = []
    for item in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < item:
                node += 1
        result.append((node - leaves, capacity - room[node]))
        room[node] -= item
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return result


def pack(cut: DataFrame, length: int = 1024, group_pieces: int = 8192) -> DataFrame:
    """`cut` (rows of `pieces`) with sequence_id and offset. Runs `cut` at once."""
    thin = cut_lineage(cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"), "pieces")
    groups = thin.count() // group_pieces + 1
    dealt = thin.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "place"), F.lit(groups)))

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "place"], ascending=[False, True, True, True])
        found = np.array(first_fit_decreasing(group["length"].tolist(), length), "int64").reshape(-1, 2)
        group["sequence_id"] = (int(key[0]) << 32) + found[:, 0]
        group["offset"] = found[:, 1]
        return group[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return dealt.groupBy("part").applyInPandas(
        one,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
