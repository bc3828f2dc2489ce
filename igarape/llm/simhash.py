"""SimHash near-duplicates by anchor-point covering.

Two 64-bit fingerprints within 3 bits agree on at least one of two 31-bit halves up to 1 bit.
On a half, the codewords of the Hamming code (31, 26) are the anchors: every half lies within
covering radius 1 of one of them. A fingerprint goes to every anchor within covering radius plus
threshold, 1 + 1, of each half: 1 anchor if its half is a codeword, else 16. Linked fingerprints
then meet at the nearest anchor of either one, and are compared there on all 64 bits.

Equal fingerprints are one row before anything is replicated. An anchor emits a star per set of
fingerprints that it connects, never all pairs. Anchors with more than `split_rows` fingerprints
are dealt again by four blocks of the remaining bits, of which a linked pair must share one; so
no link is lost. Components come from alternating star contraction of the links.

Null and empty texts have fingerprint 0 and are linked like others; very long texts are hashed in
parts. Null ids take part, but never name a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import map_arrow, texts
from igarape.session import cut_lineage

_HALF_BITS = 31
_HALF = (1 << _HALF_BITS) - 1
#: The pairs (i, i ^ s) of positions 1..31 whose flips change the syndrome by s, by s.
_PAIRS = [[(i, i ^ s) for i in range(1, 32) if 0 < (i ^ s) < i] for s in range(32)]
_PART = 1 << 20


def _hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, for a part of the words at a time."""
    kept: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    begin, any_shingle = 0, False
    while begin < len(text) or begin == 0:
        end = min(len(text), begin + _PART)
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            stop = len(text)
            for blank in b" \t\n\x0b\x0c\r":
                found = text.find(blank, end, stop)
                stop = found if found >= 0 else stop
            end = stop
        words = kept + text[begin:end].lower().split()
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
            each = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())]
            yield np.array(each, "<u8")
            any_shingle = True
        kept = words[max(0, len(words) - width + 1) :]
        begin = max(end, 1)
    if not any_shingle and kept:
        yield np.array([digest(b" ".join(kept), 42)], "<u8")


def fingerprint(text: bytes, width: int = 3) -> int:
    """Bits set in more than half of the hashes of the word shingles; 0 without words."""
    count, total = np.zeros(64, "int64"), 0
    for hashes in _hashes(text, width):
        total += len(hashes)
        for part in range(0, len(hashes), 8192):
            bits = np.unpackbits(hashes[part : part + 8192].view("u1").reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype="int64")
    if not total:
        return 0
    return int(np.packbits(count * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, mark, fp): the fingerprint of each row as a signed long; `mark` is a hash of the text."""

    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(x, width) for x in texts(batch.column(2))], "u8").view("i8")
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["doc_id", "mark", "fp"])

        return one

    plain = docs.select(F.col(doc_id).cast("long"), _mark(F.col(text)), F.col(text).cast("string"))
    return map_arrow(plain, "doc_id long, mark long, fp long", start)


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for all anchors of 64-bit values; the half is bit 62 of the anchor."""
    rows, found = [], []
    index = np.arange(len(values))
    for side in range(2):
        half = (values >> np.uint64(side * _HALF_BITS)).astype("int64") & _HALF
        syndrome = np.zeros(len(half), "int64")
        for place in range(1, _HALF_BITS + 1):
            syndrome ^= ((half >> (place - 1)) & 1) * place
        mark = np.int64(side << 62)
        near = half ^ np.where(syndrome > 0, np.int64(1) << np.maximum(syndrome - 1, 0), 0)
        rows.append(index)
        found.append(near | mark)
        for s in range(1, 32):
            at = index[syndrome == s]
            for i, j in _PAIRS[s]:
                rows.append(at)
                found.append(half[at] ^ ((1 << (i - 1)) | (1 << (j - 1))) | mark)
    return np.concatenate(rows), np.concatenate(found)


def _anchored(distinct: DataFrame) -> DataFrame:
    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            rows, found = anchors(values.view("u8"))
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(values[rows])], ["anchor", "fp"])

        return one

    return map_arrow(distinct.select("fp"), "anchor long, fp long", start)


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= bits


def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars: each value with the smallest one that the links connect it to."""
    values, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(values))
    return values[far], values[label[far]]


def _links(keyed: DataFrame, bits: int) -> DataFrame:
    """Stars (fp, root) of rows that share `key` and differ in at most `bits` bits.

    Rows come sorted by key. A group is held as 8 bytes a row and compared in blocks.
    """
    block = 1024

    def group_links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.zeros(0, "u8"), np.zeros(0, "u8")
        for i in range(0, len(values), block):
            for j in range(i, len(values), block):
                x, y = values[i : i + block], values[j : j + block]
                at, to = np.nonzero(_near(x[:, None], y[None, :], bits))
                left = np.concatenate((left, x[at]))
                right = np.concatenate((right, y[to]))
                if len(left) > 1 << 20:
                    left, right = _contract(left, right)
        return _contract(left, right)

    def batch_links(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1), [True])))
        sizes = np.diff(edges)
        left, right = [], []
        for begin, size in zip(edges[:-1][sizes > 64].tolist(), sizes[sizes > 64].tolist()):
            a, b = group_links(values[begin : begin + size])
            left.append(a)
            right.append(b)
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = (sizes[group] <= 64) & (sizes[group] > 1)
        group, values = group[small], values[small]
        step = 1
        while step < len(group):
            same = np.flatnonzero(group[:-step] == group[step:])
            if not len(same):
                break
            near = same[_near(values[same], values[same + step], bits)]
            left.append(values[near])
            right.append(values[near + step])
            step += 1
        if not left:
            return values[:0], values[:0]
        return _contract(np.concatenate(left), np.concatenate(right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros((0, 2), "int64"), np.zeros(0, "u8")
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            values = batch.column(2).to_numpy(zero_copy_only=False).view("u8")
            keys, values = np.concatenate((held_keys, keys)), np.concatenate((held, values))
            if not len(keys):
                continue
            last = len(keys) - np.argmax((keys[::-1] != keys[-1]).any(axis=1)) if (keys != keys[-1]).any() else 0
            held_keys, held = keys[last:], values[last:]
            if last:
                yield _star_batch(*batch_links(keys[:last], values[:last]))
        if len(held):
            yield _star_batch(*batch_links(held_keys, held))

    sorted_rows = keyed.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return sorted_rows.select("key", "sub", "fp").mapInArrow(run, "a long, b long")


def _star_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], ["a", "b"])


def _blocks(anchor: str, fp: str):
    """Four sub-keys of a fingerprint at an anchor, from the 33 bits that the anchor's half leaves out."""
    first = F.shiftright(F.col(anchor), 62).bitwiseAND(F.lit(1)) == 0
    rest = F.when(first, F.shiftrightunsigned(F.col(fp), _HALF_BITS)).otherwise(
        F.col(fp).bitwiseAND(F.lit(_HALF)).bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.col(fp), 62), _HALF_BITS))
    )
    widths, keys, low = (9, 8, 8, 8), [], 0
    for number, width in enumerate(widths):
        value = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << width) - 1))
        keys.append(value + F.lit((number + 1) << 16))
        low += width
    return F.array(*keys)


def links(distinct: DataFrame, bits: int = 3, split_rows: int = 4096) -> DataFrame:
    """Stars (a, b) that connect exactly the fingerprints linked at `bits` or fewer bits."""
    if bits > 3:
        raise ValueError("two halves at threshold 1 cover at most 3 differing bits")
    at = cut_lineage(_anchored(distinct), "anchors")
    shared = at.groupBy("anchor").count().filter("count > 1")
    hot = shared.filter(F.col("count") > split_rows).select(F.col("anchor").alias("hot_anchor"))
    rows = at.join(hot, F.col("anchor") == F.col("hot_anchor"), "left")
    keys = F.when(F.col("hot_anchor").isNull(), F.array(F.lit(0).cast("long"))).otherwise(_blocks("anchor", "fp"))
    return _links(rows.select(F.col("anchor").alias("key"), F.explode(keys).alias("sub"), "fp"), bits)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of undirected edges (a, b) with the smallest node it reaches.

    Large and small stars in turn until nothing changes; each round is a written table.
    """
    both = cut_lineage(edges.filter("a <> b").distinct(), "links")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            ways = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        else:
            ways = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = ways.join(low, "u")
        if large:
            moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        return moved.filter("a <> b").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(
                F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))
            ).first()
        )

    before = None
    while (now := state(both)) != before:
        before = now
        both = cut_lineage(star(star(both, True), False), "links")
    return both.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3, split_rows: int = 4096
) -> DataFrame:
    """(doc_id, mark, fp, root, component_id): `root` is the smallest fingerprint of a component."""
    prints = cut_lineage(fingerprints(docs, doc_id, text, width), "fingerprints")
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(links(distinct, bits, split_rows))
    rooted = distinct.join(groups, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("own"), "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("own", "root", "component_id")
    return prints.join(named, F.col("fp") == F.col("own")).drop("own")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """(doc_id, fingerprint, component_id): the component is the smallest id reachable over links."""
    return grouped(docs, doc_id, text, **how).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """The rows of `docs` with the smallest id of each component; of equal rows, one."""
    first = (
        grouped(docs, doc_id, text, **how)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "mark")).alias("row"))
        .select(F.struct("row.doc_id", "row.mark").alias("__first"))
    )
    key = F.struct(F.col(doc_id).cast("long").alias("doc_id"), _mark(F.col(text)).alias("mark"))
    kept = docs.withColumn("__key", key).join(first, F.col("__key") == F.col("__first"), "left_semi")
    return kept.dropDuplicates(["__key"]).select(docs.columns)
