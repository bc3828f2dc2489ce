"""Jaccard join of word n-gram sets by parity sketches.

A sketch has B blocks of 64 bits; each shingle of a set flips one bit, chosen by its hash. A
shingle that two sets share flips the same bit of both, so the Hamming distance of the sketches is
at most the size of the symmetric difference. Two sets with a Jaccard of `num` / `den` or more, the
smaller with at most u shingles, differ in at most d = (den - num) * u div num shingles, hence in at
most d blocks: of B > d blocks at least B - d are equal.

Set sizes are cut into bands, each with its own u and B. A set has keys in its band, and in the
band below where a set near enough may lie there; a key is a hash of band, block number and bits.
Only the d + 1 blocks with the most bits give keys (of equally many, those with the highest numbers),
where d is the most that sets linked with one of its own size may differ in: blocks with few bits are
those that sets share by chance. Of the blocks that two linked sets share, take the one with the most
bits. In either set the other shared blocks, B - d - 1 or more, have fewer, so it is a key of both.

Sets that meet at a key are candidates if a second, shorter sketch differs in as few bits as the
sizes allow. In a first round each set of a key is compared with its nearest partners' smallest, at
keys of many sets with the smallest of its part, and the links found are contracted; that turns a
group of near copies into one class. In a second round sets of different classes that a finer sketch
finds near at some key are gathered in families, the components of those pairs; pairs themselves are
never written, a key gives a star of each family that it sees. All sets of a family are compared.
Comparison is exact, on the shingles of both texts. Every linked pair meets at a key, and in the second
round is in one family, unless it is in one class already; so no link is lost.

Equal sets are one node, named by a 64-bit hash. The texts of the candidates are read again; a
bitmap of bounded size tells which rows. A set met by many others is copied to as many tasks as they
need; a key with many sets is compared in blocks, a large family in pairs of parts. Words are
lower-cased in A-Z only.

Null, empty and blank texts have no set and are linked with nothing. Texts with fewer words than
`width` have one shingle, all their words. Null ids take part, but never name a component unless all
its ids are null; repeated rows are linked with each other. An empty table gives an empty result.
Other columns are not read. A task's memory follows the longest text, at some 100 bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import map_arrow, texts
from igarape.llm.simhash import _contract, components
from igarape.session import cut_lineage

# Growth of the bands' edges; about the least keys in all.
_WIDEN = 1.55
_BLOCK = 1024
# Sets at a key up to which the first round compares all with all.
_FEW = 512
# Tasks that a key with more sets than one task should have is dealt over in the first round.
_PARTS = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sets of shingle hashes; a shingle's hash is built from remembered hashes of its words."""

    def __init__(self, width: int, remembered: int = 500_000):
        self._width, self._remembered, self._words = width, remembered, _WordHashes()

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A-Z and ASCII blanks only
        if not words:
            return np.zeros(0, "u8")
        if len(self._words) > self._remembered:
            self._words.clear()
        each = np.fromiter(map(self._words.__getitem__, words), "u8", len(words))
        width = min(self._width, len(each))
        found = np.full(len(each) - width + 1, width, "u8")
        for i in range(width):
            found = found * np.uint64(0x9E3779B97F4A7C17) + each[i : i + len(found)]
        return np.unique(_mixed(found))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            self[word] = found
        return found


def node_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).astype("i8"))


class Bands:
    """Bands of set sizes for a threshold; band i holds sizes from edges[i] to below edges[i + 1]."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1, 2]

    def _until(self, size: int) -> None:
        while self.edges[-1] <= size:
            last = self.edges[-1]
            self.edges.append(max(last + 1, (last - 1) * self.den // self.num + 1, int(last * _WIDEN)))

    def of(self, size: int) -> list[int]:
        """The bands in which a set of this size has keys."""
        self._until(size)
        own = int(np.searchsorted(self.edges, size, side="right")) - 1
        below = own > 0 and size <= (self.edges[own] - 1) * self.den // self.num
        return [own - 1, own] if below else [own]

    def differing(self, size: int, band: int) -> int:
        """The most shingles by which a set of this size differs from one linked with it, the smaller of both in this band."""
        self._until(size)
        largest = self.edges[band + 1] - 1
        other = size * self.den // self.num if size <= largest else largest
        return (self.den - self.num) * (size + other) // (self.den + self.num)

    @cache
    def shape(self, band: int) -> tuple[int, int]:
        """(d, B): the largest difference of a linked pair, and the number of blocks; B = 0 where only equal sets link."""
        while len(self.edges) < band + 2:
            self._until(self.edges[-1])
        most = (self.den - self.num) * (self.edges[band + 1] - 1) // self.num
        if not most:
            return 0, 0
        return most, most + 1 + math.isqrt(most) + 1  # some to choose from, yet few, so that blocks have many bits


def sketch(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """Parities of the shingles: one bit of one block is flipped by each."""
    at = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    found = np.zeros(blocks, "u8")
    np.bitwise_xor.at(found, at.astype("int64"), np.uint64(1) << (shingles & np.uint64(63)))
    return found


def signature(shingles: np.ndarray, most: int, fine: bool = False) -> bytes:
    """A shorter sketch for one comparison: sets that share little differ in half of its bits, clearly more than `most`.

    A `fine` one has four bits for each of `most`, and tells apart sets that are less than nearly linked.
    """
    size = 4 * most + 64 if fine else (8 + 2 * most + math.ceil(2.5 * math.sqrt(2 * most))) // 8 * 8 + 8
    places = (shingles >> np.uint64(8) & np.uint64(0xFFFFFF)) % np.uint64(size)
    return np.packbits(np.bincount(places.astype("int64"), minlength=size) & 1).tobytes()


def keys_of(parities: np.ndarray, band: int, most: int) -> np.ndarray:
    """Keys of the `most` + 1 blocks with the most bits."""
    number = np.arange(len(parities), dtype="u8") + np.uint64(band << 40)
    keys = _mixed(parities + _mixed(number + np.uint64(1)))
    order = np.argsort(np.bitwise_count(parities), kind="stable")
    return keys[order[-most - 1 :]].view("i8")


_SETS = "doc_id long, mark long, node long, n_shingles long, sketches array<struct<sign: binary, keys: array<long>, fine: binary>>"


def sketched(docs: DataFrame, doc_id: str, text: str, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, mark, node, n_shingles, sketches) of each row; `mark` is a hash of the text."""
    kind = pa.list_(pa.struct([("sign", pa.binary()), ("keys", pa.list_(pa.int64())), ("fine", pa.binary())]))

    def start():
        shingled, bands = Shingles(width), Bands(num, den)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, sizes, found, seen = [], [], [], set()
            for value in texts(batch.column(2)):
                shingles = shingled(value)
                node = node_of(shingles) if len(shingles) else None
                nodes.append(node)
                sizes.append(len(shingles))
                rows = []
                if node is not None and node not in seen:  # equal sets have equal keys: once a batch will do
                    seen.add(node)
                    for band in bands.of(len(shingles)):
                        most, blocks = bands.shape(band)
                        if differing := bands.differing(len(shingles), band):
                            keys = keys_of(sketch(shingles, blocks), band, differing)
                            rows.append({"sign": signature(shingles, most), "keys": keys, "fine": signature(shingles, most, True)})
                found.append(rows)
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, kind)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "node", "n_shingles", "sketches"])

        return one

    return map_arrow(docs.select(F.col(doc_id).cast("long"), _mark(F.col(text)), F.col(text).cast("string")), _SETS, start)


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


class Bitmap:
    """Which of 2^bits places the values of a column fall on: a filter without false negatives.

    It takes 2^bits / 8 bytes, whatever the number of values.
    """

    def __init__(self, values: DataFrame, bits: int):
        self._low = (1 << bits) - 1
        place = F.col(values.columns[0]).bitwiseAND(F.lit(self._low))
        parts = (
            values.select(F.shiftright(place, 15).cast("int").alias("part"), place.bitwiseAND(F.lit(32767)).alias("bit"))
            .groupBy("part")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
            .toArrow()
        )
        self._parts = np.zeros((max(1, (self._low + 1) >> 15), 4096), "u1")
        for part, found in zip(parts.column(0).to_pylist(), parts.column(1).to_pylist()):
            self._parts[part] = np.frombuffer(found, "u1")
        self._parts = self._parts.ravel()

    def holds(self, values: np.ndarray) -> np.ndarray:
        place = values & self._low
        return (self._parts[place >> 3] >> (place & 7).astype("u1")) & 1 > 0


def _met(rows: DataFrame, known: Bitmap, hot: Bitmap | None = None, active: Bitmap | None = None) -> DataFrame:
    """(key, node, place) of the keys, and if given of the nodes, that the bitmaps hold; `place` numbers a node's sketches.

    With `hot` also n, sign and `sub`: -1, or the part in which a key of many sets, held by `hot`, has the node.
    """
    names = ["key", "node", "place"] + (["n", "sign", "sub"] if hot else [])

    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            if active is not None:
                batch = batch.filter(pa.array(active.holds(batch.column(0).to_numpy())))
            found = batch.column(2)
            counts = np.diff(found.offsets.to_numpy())
            inner = found.flatten()
            keys = inner.field(1)
            keys = keys.slice(inner.offset, len(inner)) if len(keys) != len(inner) else keys
            at = keys.offsets.to_numpy()
            values = keys.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            own = np.repeat(np.arange(len(inner)), np.diff(at))
            held = np.flatnonzero(known.holds(values))
            values, own = values[held], own[held]
            places = np.arange(len(inner)) - np.repeat(np.cumsum(counts) - counts, counts)
            row = pa.array(np.repeat(np.arange(batch.num_rows), counts)[own])
            nodes = batch.column(0).take(row)
            columns = [pa.array(values), nodes, pa.array(places[own].astype("i4"))]
            if hot:
                parts = _mixed(nodes.to_numpy().view("u8")) % np.uint64(_PARTS)
                sub = np.where(hot.holds(values), parts.astype("i4"), -1)
                columns += [batch.column(1).take(row), inner.field(0).take(pa.array(own)), pa.array(sub.astype("i4"))]
            return pa.RecordBatch.from_arrays(columns, names)

        return one

    coarse = F.transform("sketches", lambda x: F.struct(x.sign.alias("sign"), x["keys"].alias("keys"))).alias("sketches")
    filled = rows.filter("size(sketches) > 0").select("node", "n_shingles", coarse)
    return map_arrow(filled, "key long, node long, place int" + (", n long, sign binary, sub int" if hot else ""), start)


def _close(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs (i, j) of rows may be linked, by sizes and sketches; sketch i lies at data[at[i]:at[i + 1]]."""
    a, b = sizes[i], sizes[j]
    # den * common >= num * all, as a limit: (num + den) * difference <= (den - num) * (both sizes)
    width = at[i + 1] - at[i]
    fits = (den * np.minimum(a, b) >= num * np.maximum(a, b)) & (width == at[j + 1] - at[j]) & (width > 0)
    some = np.flatnonzero(fits)
    for k in range(0, len(some), 1 << 17):
        part = some[k : k + (1 << 17)]
        size = width[part]
        ends = np.cumsum(size)
        step = np.arange(ends[-1]) - np.repeat(ends - size, size)
        bits = np.bitwise_count(data[np.repeat(at[i[part]], size) + step] ^ data[np.repeat(at[j[part]], size) + step])
        apart = np.add.reduceat(bits, ends - size, dtype="int64")
        fits[part] = (num + den) * apart <= (den - num) * (a[part] + b[part])
    return fits


def _first_pairs(met: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) to compare first, and (a, a) for further nodes that may be linked with some.

    At keys of few sets a set comes with the smallest that it may be linked with, at others with the
    smallest set of its part, if it may be linked with that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            keys = np.stack([held.column(i).to_numpy() for i in (0, 1)], axis=1)
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            if not len(change):
                continue
            last = int(change[-1]) + 1
            yield pairs(held.slice(0, last), keys[:last])
            held = held.slice(last)
        if held is not None and held.num_rows:
            yield pairs(held, np.stack([held.column(i).to_numpy() for i in (0, 1)], axis=1))

    def pairs(rows: pa.Table, keys: np.ndarray) -> pa.RecordBatch:
        nodes, sizes = rows.column(2).to_numpy(), rows.column(3).to_numpy()
        signs = rows.column(4).combine_chunks().cast(pa.large_binary())
        at = np.frombuffer(signs.buffers()[1], "i8")[signs.offset : signs.offset + len(signs) + 1]
        data = np.frombuffer(signs.buffers()[2], "u1")
        begins = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        counts = np.diff(np.append(begins, len(nodes)))
        left, right = [], []
        group, size = np.repeat(np.arange(len(begins)), counts), np.repeat(counts, counts)
        hot = keys[:, 1] >= 0
        small = np.flatnonzero((size > 1) & (size <= _FEW) & ~hot)
        step = 1
        while True:  # rows of a key are neighbours, in order of their nodes
            other = small[:-step] if step else small
            i = other[group[other] == group[small[step:]]] if step < len(small) else other[:0]
            if not len(i):
                break
            i = i[nodes[i] != nodes[i + step]]
            near = i[_close(data, at, sizes, i, i + step, num, den)]
            left.append(near + step)
            right.append(near)
            step += 1
        large = np.flatnonzero((size > _FEW) | hot)
        first = begins[group[large]]
        near = _close(data, at, sizes, large, first, num, den)
        a, b = nodes[np.concatenate([*left, large[near]])], nodes[np.concatenate([*right, first[near]])]
        a, b = a[a != b], b[a != b]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        smallest = np.append(True, a[1:] != a[:-1]) if len(a) else np.zeros(0, bool)
        active = np.unique(np.concatenate((a, b, nodes[large])))
        both = [np.concatenate((a[smallest], active)), np.concatenate((b[smallest], active))]
        return pa.RecordBatch.from_arrays(list(map(pa.array, both)), ["a", "b"])

    dealt = met.select("key", "sub", "node", "n", "sign").repartition("key", "sub")
    return dealt.sortWithinPartitions("key", "sub", "node").mapInArrow(run, "a long, b long")


def _with_texts(sent: DataFrame, docs: DataFrame, text: str, bits: int) -> DataFrame:
    """The rows of `sent` with the text that has their `mark`; a text may come more than once."""
    sent = cut_lineage(sent, "compared")
    known = Bitmap(sent.select("mark"), bits)

    def start():
        seen: set[tuple[int, int]] = set()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            marks = batch.column(0).to_numpy()
            at = []
            for i in np.flatnonzero(known.holds(marks)).tolist():
                same = (int(marks[i]), hash(batch.column(1)[i].as_py()))
                if same not in seen:
                    seen.add(same)
                    at.append(i)
            return batch.take(pa.array(at, pa.int64()))

        return one

    plain = docs.select(_mark(F.col(text)).alias("mark"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    return map_arrow(plain, "mark long, text string", start).join(sent, "mark")


def _verified(
    pairs: DataFrame, docs: DataFrame, witnesses: DataFrame, text: str, width: int, num: int, den: int, bits: int, members: int
) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are linked, by their shingles."""
    groups = pairs.groupBy("b").agg((F.count("*") / members + 1).cast("long").alias("salts"))
    sent = (
        pairs.join(groups, "b")
        .select(F.col("a").alias("node"), "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.lit(1).alias("turn"))
        .unionByName(
            groups.select(
                F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("turn")
            )
        )
    )
    read = _with_texts(sent.join(witnesses, "node"), docs, text, bits)
    dealt = read.select("b", "salt", "turn", "node", "text").repartition("b", "salt")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled, own, shingles = Shingles(width), None, None
        for batch in batches:
            left, right = [], []
            rows = zip(*[batch.column(i).to_pylist() for i in range(4)], texts(batch.column(4)))
            for b, _, turn, node, value in rows:
                found = shingled(value)
                if node_of(found) != node:  # another text with the same mark
                    continue
                if turn == 0:
                    own, shingles = b, found
                elif own == b and linked(found, shingles, num, den):
                    left.append(node)
                    right.append(b)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return dealt.sortWithinPartitions("b", "salt", "turn").mapInArrow(compare, "a long, b long")


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if den * len(small) < num * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[place] == small).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _in_parts(rows: DataFrame, key: str, parts: Column) -> DataFrame:
    """Rows with `sub`: those of a key are cut into `parts` (an aggregate), each pair of which shares a value.

    A pair of parts (i, j) meets at i * parts + j with i <= j; each row goes to all that its part is in.
    """
    counted = rows.join(rows.groupBy(key).agg(parts.cast("long").alias("parts")), key)
    count, own = F.col("parts"), F.pmod(F.xxhash64("node"), F.col("parts"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.least(i, own) * count + F.greatest(i, own))
    return counted.withColumn("sub", F.explode(every)).drop("parts")


def _near(rows: DataFrame, num: int, den: int, split_rows: int) -> DataFrame:
    """Stars (a, b) that connect the nodes of different classes at a key that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found, size = [], 0

        def stars() -> pa.RecordBatch:
            left, right = np.concatenate(found, axis=1) if found else np.zeros((2, 0), "i8")
            return pa.RecordBatch.from_arrays(list(map(pa.array, _contract(left, right))), ["a", "b"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if held and held[0][:2] != row[:2]:
                    found.append(_group_stars(held, num, den))
                    size += found[-1].shape[1]
                    held = []
                    if size > 1 << 18:
                        yield stars()
                        found, size = [], 0
                held.append(row)
        if held:
            found.append(_group_stars(held, num, den))
            yield stars()

    ordered = _in_parts(rows, "key", F.expr(f"count(*) div {split_rows} + 1")).repartition("key", "sub").sortWithinPartitions("key", "sub")
    return ordered.select("key", "sub", "node", "label", "sign", "n").mapInArrow(run, "a long, b long")


def _group_stars(rows: list[tuple], num: int, den: int) -> np.ndarray:
    nodes, labels, sizes = (np.array([r[i] for r in rows]) for i in (2, 3, 5))
    if len(nodes) < 2 or (labels == labels[0]).all():
        return np.zeros((2, 0), "i8")
    signs = [r[4] for r in rows]
    at = np.append(0, np.cumsum(np.fromiter(map(len, signs), "int64", len(signs))))
    data = np.frombuffer(b"".join(signs), "u1")
    stars = np.zeros((2, 0), "i8")
    for i in range(0, len(nodes), _BLOCK):
        for j in range(i, len(nodes), _BLOCK):
            apart = labels[i : i + _BLOCK, None] != labels[None, j : j + _BLOCK]
            if i == j:
                apart = np.triu(apart, 1)
            x, y = np.nonzero(apart)
            x, y = x + i, y + j
            near = _close(data, at, sizes, x, y, num, den)
            stars = np.stack(_contract(np.append(stars[0], nodes[x[near]]), np.append(stars[1], nodes[y[near]])))
    return stars


def _family_links(
    families: DataFrame, docs: DataFrame, witnesses: DataFrame, text: str, width: int, num: int, den: int, bits: int, split_rows: int
) -> DataFrame:
    """Pairs (a, b) of linked nodes that connect all linked nodes within a family (node, root, label, n)."""
    parts = F.expr(f"greatest(count(*) div {split_rows}, sum(n) div {512 * split_rows}) + 1")
    read = _with_texts(_in_parts(families, "root", parts).join(witnesses, "node"), docs, text, bits)
    dealt = read.select("root", "sub", "node", "label", "text").repartition("root", "sub").sortWithinPartitions("root", "sub")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled, family, sets, labels = Shingles(width), None, {}, []

        def links() -> pa.RecordBatch:
            found = list(_linked_classes(list(sets.values()), np.array(labels), num, den))
            nodes = np.array(list(sets))
            pairs = np.array(found, "i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(nodes[pairs[:, 1]]), pa.array(nodes[pairs[:, 0]])], ["a", "b"])

        for batch in batches:
            for root, sub, node, label, value in zip(*[batch.column(i).to_pylist() for i in range(4)], texts(batch.column(4))):
                if family != (root, sub):
                    if len(sets) > 1:
                        yield links()
                    family, sets, labels = (root, sub), {}, []
                if node not in sets and node_of(found := shingled(value)) == node:  # else another text with the same mark
                    sets[node] = found
                    labels.append(label)
        if len(sets) > 1:
            yield links()

    return dealt.mapInArrow(compare, "a long, b long")


def _linked_classes(sets: list[np.ndarray], labels: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Linked pairs (i, j) of sets of different classes; a pair found makes one class of two."""
    sizes = np.fromiter(map(len, sets), "int64", len(sets))
    blocks = (den - num) * int(sizes.max()) // num // 2 + 2  # 32 bits for each shingle by which linked sets may differ
    sketches = np.stack([sketch(x, blocks) for x in sets])
    for i in range(len(sets) - 1):
        other = i + 1 + np.flatnonzero(labels[i + 1 :] != labels[i])
        both = sizes[other] + sizes[i]
        fits = den * np.minimum(sizes[other], sizes[i]) >= num * np.maximum(sizes[other], sizes[i])
        other, both = other[fits], both[fits]
        apart = np.concatenate(
            [np.bitwise_count(sketches[part] ^ sketches[i]).sum(axis=1, dtype="int64") for part in np.split(other, range(256, len(other), 256))]
        )
        for j in other[(num + den) * apart <= (den - num) * both].tolist():
            if labels[j] != labels[i] and linked(sets[i], sets[j], num, den):
                yield i, j
                labels[labels == labels[j]] = labels[i]


def _labels(edges: DataFrame) -> DataFrame:
    return components(edges).select("node", F.col("root").alias("label"))


def _members(rooted: DataFrame) -> DataFrame:
    """(node, root) with the roots themselves, which `components` leaves out."""
    return rooted.select("node", "root").unionByName(rooted.select(F.col("root").alias("node"), "root").distinct())


def near_sets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 4,
    num: int = 85,
    den: int = 100,
    bits: int = 27,
    members: int = 512,
    split_rows: int = 4096,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): linked are rows whose sets have a Jaccard of num / den or more.

    `bits` sizes the bitmaps, `members` is the number of comparisons with one set in a task, `split_rows` the
    number of sets at a key compared in a task. Writes tables of sketches, keys and links, at once.
    """
    if not 0 < num <= den:
        raise ValueError("the threshold num / den must be above 0 and at most 1")
    rows = cut_lineage(sketched(docs, doc_id, text, width, num, den), "sketches")
    # Counted by 48 bits of the key: more keys may seem shared, none fewer.
    keys = rows.select(F.explode(F.flatten("sketches.keys")).alias("key"))
    keys = keys.select(F.col("key").bitwiseAND(F.lit((1 << 48) - 1)).alias("key"))
    shared = cut_lineage(keys.groupBy("key").agg(F.count("*").alias("n_rows")).filter("n_rows > 1"), "shared-keys")
    known, hot = Bitmap(shared.select("key"), bits), Bitmap(shared.filter(F.col("n_rows") > split_rows).select("key"), bits)
    first = cut_lineage(_first_pairs(_met(rows, known, hot), num, den).distinct(), "first-pairs")
    witnesses = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("mark").alias("mark"))

    def verified(pairs: DataFrame) -> DataFrame:
        return cut_lineage(_verified(pairs, docs, witnesses, text, width, num, den, bits, members).distinct(), "linked")

    chosen = first.filter("a <> b").groupBy("a").agg(F.min("b").alias("b"))
    edges = verified(chosen)
    met = _met(rows, known, active=Bitmap(first.select("a").distinct(), bits)).distinct()
    labelled = cut_lineage(met.join(_labels(edges), "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    several = cut_lineage(labelled.join(mixed.select("key"), "key", "left_semi"), "several-classes")
    signs = rows.select("node", F.col("n_shingles").alias("n"), F.posexplode("sketches").alias("place", "sketch"))
    signs = signs.select("node", "place", "n", F.col("sketch.fine").alias("sign"))
    signs = signs.join(several.select("node", "place").distinct(), ["node", "place"], "left_semi").dropDuplicates(["node", "place"])
    near = _near(several.join(signs, ["node", "place"]), num, den, split_rows)
    classes = several.groupBy("node").agg(F.first("label").alias("label"))
    counted = rows.filter("node IS NOT NULL").groupBy("node").agg(F.first("n_shingles").alias("n"))
    families = _members(components(near)).join(classes, "node").join(counted, "node")
    met_again = _family_links(families, docs, witnesses, text, width, num, den, bits, split_rows)
    edges = edges.unionByName(cut_lineage(met_again.distinct(), "linked"))
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = nodes.join(_labels(edges), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "label").select("node", "component_id")
    return (
        rows.select("doc_id", "n_shingles", "node")
        .join(named, "node", "left")
        .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )
