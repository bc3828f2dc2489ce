"""Alignment of two tokenizers by lockstep merging of their token ends.

Texts are encoded by a byte-level BPE vocabulary (A) and a SentencePiece vocabulary (B). Tokens of
both are ranges of the same bytes, a space and the text. One NumPy state vector holds a pointer to
the next A and the next B token of every lane; a step moves, in all lanes at once, the pointer whose
token ends first, or both where the ends agree. There it emits a cut and the links of the group that
the cut closes, each A token with each B token. Finished lanes leave the vector. A lane is a text,
or a stretch of a long one between two places where both vocabularies end a token, so that one long
text doesn't keep the vector narrow.

A pair of ids is counted once for each row that holds it linked. Rows are scored by these counts:
pairs with at least a 65,536th of all counted links are at most that many and go to all tasks; the
others, none of which is frequent, are joined by id.

Texts that are null, empty, or not spelled alike by both vocabularies (such as those that contain
U+2581) have no tokens. Repeated rows, also of one id, are documents of their own; null ids stay
null. An empty table gives an empty result. Strings of special tokens are plain text. Other columns
are not read. A task's memory follows the longest text, at some 200 bytes a character.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from igarape.llm.common import map_arrow, texts
from igarape.session import cut_lineage

#: A place where words cannot be encoded one by one: a space before white space or the end.
_JOINED = re.compile(r" (?:\s|\Z)")
_CHUNK = 1 << 20
_LANE = 128
_LARGE = 4096
_HEAVY = 1 << 16


class Vocabularies:
    """Ids of both vocabularies for space-separated words, remembered in flat arrays.

    A space before a non-space begins a new unit in both, so a text without other spaces is the
    concatenation of its words; any other text counts as one word. `remembered` bounds the words
    and, sixteen-fold, their ids.
    """

    def __init__(self, folder: str | None = None, remembered: int = 300_000):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        path = public_tokenizers.path if folder is None else lambda name: f"{folder}/{name}"
        with open(path("byte_bpe_50k.tiktoken"), "rb") as source:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, source)}
        self._a = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            self.a_bytes[rank] = word
        self._b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        self.b_bytes = [self._piece(i) for i in range(self._b.vocab_size())]
        self.a_lengths = np.array(list(map(len, self.a_bytes)), "int64")
        self.b_lengths = np.array(list(map(len, self.b_bytes)), "int64")
        self._remembered = remembered
        self._clear()

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def _clear(self) -> None:
        self._words = _Numbered()
        self._whole = 0  # numbers that belong to whole texts
        self.ok = np.zeros(0, bool)
        self.a_ids, self.b_ids = np.zeros(0, "int64"), np.zeros(0, "int64")
        self.a_at, self.b_at = np.zeros(1, "int64"), np.zeros(1, "int64")

    def numbers(self, batch: list[str]) -> list[list[int]]:
        """For each text the numbers of its words, whose ids are then in the arrays."""
        if len(self._words) > self._remembered or len(self.a_ids) > 16 * self._remembered:
            self._clear()
        words, found = self._words, []
        for text in batch:
            if _JOINED.search(f" {text}"):
                found.append([words.add(text)])
            else:
                found.append(list(map(words.__getitem__, text.split(" "))))
        if words.new:
            a = [self._a.encode_ordinary(f" {word}") for word in words.new]
            b = self._b.encode(words.new, num_threads=1)
            same = [
                b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y)) == f" {w}".encode()
                for x, y, w in zip(a, b, words.new)
            ]
            self.ok = np.concatenate((self.ok, np.array(same, bool)))
            self.a_ids, self.a_at = _appended(self.a_ids, self.a_at, a)
            self.b_ids, self.b_at = _appended(self.b_ids, self.b_at, b)
            words.new = []
        return found


class _Numbered(dict):
    """Words in the order in which they were first asked for; `new` ones wait for their ids."""

    def __init__(self):
        self.new: list[str] = []
        self._count = 0

    def add(self, word: str) -> int:
        self.new.append(word)
        self._count += 1
        return self._count - 1

    def __missing__(self, word: str) -> int:
        self[word] = number = self.add(word)
        return number


def _appended(ids: np.ndarray, at: np.ndarray, more: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, more), "int64", len(more))
    flat = np.fromiter((x for row in more for x in row), "int64", int(sizes.sum()))
    return np.concatenate((ids, flat)), np.concatenate((at, at[-1] + np.cumsum(sizes)))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all ranges in turn."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _lanes(a_end: np.ndarray, b_end: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, lane: int):
    """Where lanes begin, as indexes into A and B: at each text, and within it at common ends about `lane` apart."""
    sizes = np.diff(a_at)
    steps = np.maximum(sizes - 1, 0) // lane
    last = np.repeat(a_at[1:], steps) - 1
    at = np.repeat(a_at[:-1], steps) + lane * (_spread(np.ones(len(steps), "int64"), steps)) - 1
    cuts = []
    for _ in range(lane // 4):
        if not len(at):
            break
        end = a_end[at]
        other = np.searchsorted(b_end, end)
        common = b_end[other] == end
        cuts.append(np.stack((at[common] + 1, other[common] + 1)))
        at, last = at[~common] + 1, last[~common]
        inside = at < last
        at, last = at[inside], last[inside]
    filled = sizes > 0
    cuts.append(np.stack((a_at[:-1][filled], b_at[:-1][filled])))
    begins = np.concatenate(cuts, axis=1)
    return begins[:, np.argsort(begins[0])]


def merge(
    a_end: np.ndarray, b_end: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, lane: int = _LANE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(groups, links_a, links_b) of texts whose tokens lie at a_at[t]:a_at[t + 1], likewise B.

    Ends are places in the bytes of all texts, one after the other. A row of groups is a0, a1, b0,
    b1. Links are indexes of tokens; groups of more than `_LARGE` links are left to `large_links`.
    """
    begins = _lanes(a_end, b_end, a_at, b_at, lane)
    i, j = begins[0].copy(), begins[1].copy()
    until = np.append(i[1:], len(a_end)) if len(i) else i
    from_i, from_j = i.copy(), j.copy()
    groups, links_a, links_b = [], [], []
    while len(i):
        ends_a, ends_b = a_end[i], b_end[j]
        i = i + (ends_a <= ends_b)
        j = j + (ends_b <= ends_a)
        cut = np.flatnonzero(ends_a == ends_b)
        if not len(cut):
            continue
        a0, a1, b0, b1 = from_i[cut], i[cut], from_j[cut], j[cut]
        groups.append(np.stack((a0, a1, b0, b1)))
        n_a, n_b = a1 - a0, b1 - b0
        each = n_a * n_b
        each[each > _LARGE] = 0
        single = each == 1
        links_a.append(a0[single])
        links_b.append(b0[single])
        some = np.flatnonzero(each > 1)
        if len(some):
            place = _spread(np.zeros(len(some), "int64"), each[some])
            width = np.repeat(n_b[some], each[some])
            links_a.append(np.repeat(a0[some], each[some]) + place // width)
            links_b.append(np.repeat(b0[some], each[some]) + place % width)
        from_i[cut], from_j[cut] = a1, b1
        going = i < until
        if not going.all():
            i, j, until, from_i, from_j = i[going], j[going], until[going], from_i[going], from_j[going]
    empty = np.zeros(0, "int64")
    if not groups:
        return np.zeros((4, 0), "int64"), empty, empty
    found = np.concatenate(groups, axis=1)
    return found[:, np.argsort(found[0])], np.concatenate(links_a), np.concatenate(links_b)


def large_links(groups: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each group left out by `merge`: its A begin, ids of A and B, and how often they are linked."""
    for a0, a1, b0, b1 in groups[:, (groups[1] - groups[0]) * (groups[3] - groups[2]) > _LARGE].T.tolist():
        a, n_a = np.unique(a_ids[a0:a1], return_counts=True)
        b, n_b = np.unique(b_ids[b0:b1], return_counts=True)
        step = max(1, (1 << 20) // len(b))
        for k in range(0, len(a), step):
            part = a[k : k + step]
            yield a0, np.repeat(part, len(b)), np.tile(b, len(part)), np.outer(n_a[k : k + step], n_b).ravel()


class Aligner:
    """Alignment of lists of texts; made once in a task."""

    def __init__(self, folder: str | None, lane: int):
        self.vocabularies = Vocabularies(folder)
        self._lane = lane
        self._b_size = len(self.vocabularies.b_bytes)
        a_names = [str(i).encode() for i in range(len(self.vocabularies.a_bytes))]
        b_names = [str(i).encode() for i in range(self._b_size)]
        #: The decimal of each id with what may stand behind it.
        self._names = [x + s for s in (b",", b"|") for x in a_names] + [x + s for s in (b",", b";") for x in b_names]

    def __call__(self, batch: list[str]) -> tuple[list[np.ndarray], list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text n_a, n_b, n_groups, n_links and its groups; of distinct links the text, pair and times."""
        words = self.vocabularies
        numbers = words.numbers(batch)
        rows = [np.array(x if text else [], "int64") for x, text in zip(numbers, batch)]
        rows = [x if words.ok[x].all() else x[:0] for x in rows]
        flat = np.concatenate(rows) if rows else np.zeros(0, "int64")
        in_text = np.append(0, np.cumsum(np.fromiter(map(len, rows), "int64", len(rows))))

        def gathered(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes = (at[1:] - at[:-1])[flat]
            return ids[_spread(at[flat], sizes)], np.append(0, np.cumsum(sizes))[in_text]

        a_ids, a_at = gathered(words.a_at, words.a_ids)
        b_ids, b_at = gathered(words.b_at, words.b_ids)
        a_end, b_end = np.cumsum(words.a_lengths[a_ids]), np.cumsum(words.b_lengths[b_ids])
        groups, links_a, links_b = merge(a_end, b_end, a_at, b_at, self._lane)
        group_at = np.searchsorted(groups[0], a_at)
        each = np.append(0, np.cumsum((groups[1] - groups[0]) * (groups[3] - groups[2])))
        counts = [np.diff(a_at), np.diff(b_at), np.diff(group_at), np.diff(each[group_at])]
        return counts, self._spelled(groups, a_ids, b_ids, a_at, b_at), *self._distinct(groups, links_a, links_b, a_ids, b_ids, a_at)

    def _spelled(self, groups, a_ids, b_ids, a_at, b_at) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text, in decimal."""
        a0, a1, b0, b1 = groups
        a_size, b_size = len(self.vocabularies.a_bytes), self._b_size
        codes = np.empty(len(a_ids) + len(b_ids), "int64")
        last = np.zeros(len(a_ids), "int64")
        last[a1 - 1] = a_size
        codes[np.arange(len(a_ids)) + np.repeat(b0, a1 - a0)] = a_ids + last
        last = np.zeros(len(b_ids), "int64")
        last[b1 - 1] = b_size
        codes[np.arange(len(b_ids)) + np.repeat(a1, b1 - b0)] = b_ids + last + 2 * a_size
        spelled = list(map(self._names.__getitem__, codes.tolist()))
        at = (a_at + b_at).tolist()
        return [b"".join(spelled[x:y])[:-1] for x, y in zip(at[:-1], at[1:])]

    def _distinct(self, groups, links_a, links_b, a_ids, b_ids, a_at) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs = len(self.vocabularies.a_bytes) * self._b_size
        text = np.searchsorted(a_at, links_a, side="right") - 1
        keys, times = np.unique(text * pairs + a_ids[links_a] * self._b_size + b_ids[links_b], return_counts=True)
        more = [
            ((np.searchsorted(a_at, a0, side="right") - 1) * pairs + a * self._b_size + b, n)
            for a0, a, b, n in large_links(groups, a_ids, b_ids)
        ]
        if more:
            keys = np.concatenate((keys, *[k for k, _ in more]))
            times = np.concatenate((times, *[n for _, n in more]))
            keys, where = np.unique(keys, return_inverse=True)
            summed = np.zeros(len(keys), "int64")
            np.add.at(summed, where, times)
            times = summed
        return keys // pairs, keys % pairs, times


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    with_groups: bool = False,
    lane: int = _LANE,
) -> DataFrame:
    """One row per row of `docs`: doc_id, counts, groups_sha256, the distinct linked pairs of ids and their times.

    A pair is a * (size of vocabulary B) + b. `with_groups` adds the groups themselves.
    """
    schema = f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, pairs array<long>, times array<long>"
    names = ["doc_id", *_COUNTS, "groups_sha256", "pairs", "times"]
    if with_groups:
        schema, names = schema + ", groups string", [*names, "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(folder, lane)
        for batch in batches:
            whole = texts(batch.column(1))
            ends = np.cumsum(np.fromiter(map(len, whole), "int64", len(whole)))
            begin = 0
            while begin < len(whole):
                base = int(ends[begin - 1]) if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, base + _CHUNK)))
                counts, groups, row, pairs, times = align([x.decode() for x in whole[begin:stop]])
                at = pa.array(np.searchsorted(row, np.arange(stop - begin + 1)), pa.int32())
                columns = [batch.column(0).slice(begin, stop - begin), *map(pa.array, counts)]
                columns.append(pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in groups]))
                columns += [pa.ListArray.from_arrays(at, pa.array(x)) for x in (pairs, times)]
                if with_groups:
                    columns.append(pa.array([x.decode() for x in groups], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)
                begin = stop

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def pair_weights(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): the number of rows that hold each pair, and whether no pair of its A id has more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    own = Window.partitionBy(F.expr(f"pair div {b_size}"))  # at most b_size rows
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(own)).alias("best"))


def _weighed(rows: DataFrame, pairs: np.ndarray, n: np.ndarray, best: np.ndarray) -> DataFrame:
    """(row, n_best, count_sum) of the links whose pair is among `pairs`, ascending."""

    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, times, at, place, known = _found(batch, pairs)
            weight = np.where(known, n[place] * times, 0) if len(n) else np.zeros(len(own), "int64")
            hits = np.where(known & best[place], times, 0) if len(n) else weight
            sums = [np.diff(np.append(0, np.cumsum(x))[at]) for x in (hits, weight)]
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums)], ["row", "n_best", "count_sum"])

        return one

    return map_arrow(rows.select("row", "pairs", "times"), "row long, n_best long, count_sum long", start)


def _others(rows: DataFrame, pairs: np.ndarray) -> DataFrame:
    """(row, pair, times) of the links whose pair is not among `pairs`."""

    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, times, at, _, known = _found(batch, pairs)
            row = np.repeat(batch.column(0).to_numpy(), np.diff(at))
            return pa.RecordBatch.from_arrays([pa.array(x[~known]) for x in (row, own, times)], ["row", "pair", "times"])

        return one

    return map_arrow(rows.select("row", "pairs", "times"), "row long, pair long, times long", start)


def _found(batch: pa.RecordBatch, pairs: np.ndarray):
    lists = [batch.column(i) for i in (1, 2)]
    own, times = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
    at = lists[0].offsets.to_numpy() - lists[0].offsets[0].as_py()
    place = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
    known = pairs[place] == own if len(pairs) else np.zeros(len(own), bool)
    return own, times, at, place, known


def compare(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str | None = None, b_size: int = 32000
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of `docs`.

    n_best are the links whose pair is the most frequent of its A id; count_sum adds up the pairs'
    numbers of rows over the links. Writes the aligned rows and the weights, at once.
    """
    found = aligned(docs, doc_id, text, folder)
    rows = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    weights = cut_lineage(pair_weights(rows, b_size), "pair-weights")
    total = F.lit(weights.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).cast("decimal(38,0)")
    heavy = weights.filter(F.col("n").cast("decimal(38,0)") * _HEAVY >= total).orderBy("pair").toArrow()
    pairs, n, best = [heavy.column(c).to_numpy() for c in ("pair", "n", "best")]
    others = (
        _others(rows, pairs)
        .join(weights, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    zero = F.lit(0).cast("long")
    return (
        rows.drop("pairs", "times")
        .join(_weighed(rows, pairs, n, best), "row")
        .join(others, "row", "left")
        .select(
            "doc_id",
            *_COUNTS,
            (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
            "groups_sha256",
        )
    )
