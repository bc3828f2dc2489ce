"""Audit of how far the sources of a language diverge, from sorted pointers to the starts of its words.

Rows of an Arrow batch (a shard) are put in order of language and source. Over slices of its text
buffer, pointers to word starts are sorted by the words they point to with a multikey quicksort
whose characters are eight bytes. Sorting is stable, so the pointers of a run of equal words come by
source and by row: each run yields the word's occurrences and documents in each source at once.
Spark adds these up. A language keeps the terms found in at least `least_documents` of its rows.

Each source of a language and the language itself give every kept term a smoothed whole-number
probability, p = 1 + 10^9 * (count + 1) div (N + V). Sources are compared by f = (p - q)^2 div q:
with each other over all kept terms ('pair'), and with their language for the terms they use more
('term', the first `top`). All arithmetic is in whole numbers.

Null languages, sources and texts are ''. A row is a document, also if it repeats another. A group
without terms has pairs, but no terms; where no term is kept pairs have value 0. An empty table
gives an empty result. A text longer than a slice is sorted in several and counts as one document.
Sources of a language are compared all with all, as the result asks: n * (n - 1) rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from igarape.session import cut_lineage

_SLICE = 8 << 20
_SMALL = 1 << 15
_LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], "u1")
_MASKS = np.array([0] + [(1 << 64) - (1 << 8 * (8 - n)) for n in range(1, 9)], "u8")


class Pointers:
    """Words of a byte buffer, as starts and lengths; the buffer has eight bytes more than its text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, small: int = _SMALL):
        self._eights = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
        self.starts, self.lengths, self._small = starts, lengths, small

    def _slice(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes of each word at `depth`, zero beyond its end, as one number."""
        left = np.clip(self.lengths[pointers] - 8 * depth, 0, 8)
        place = np.where(left > 0, self.starts[pointers] + 8 * depth, 0)
        return self._eights[place].astype("u8") & _MASKS[left]

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, first): pointers in byte order of their words, and whether each begins a run of equal ones."""
        n = len(self.starts)
        self._order, self._first = np.arange(n), np.zeros(n, bool)
        self._keys = self._slice(self._order, 0)
        waiting = [(0, n, 0)] if n else []
        while waiting:
            low, high, depth = waiting.pop()
            if high - low <= self._small:
                self._finish(low, high, depth)
                continue
            keys = self._keys[low:high]
            some = np.sort(keys[:: max(1, len(keys) // 31)])
            pivot = some[len(some) // 2]
            less, same = np.flatnonzero(keys < pivot), np.flatnonzero(keys == pivot)
            place = np.concatenate((less, same, np.flatnonzero(keys > pivot)))
            self._order[low:high], self._keys[low:high] = self._order[low:high][place], keys[place]
            begin, end = low + len(less), low + len(less) + len(same)
            waiting += [x for x in ((low, begin, depth), (end, high, depth)) if x[0] < x[1]]
            if int(pivot) & 255:  # the words go on
                self._keys[begin:end] = self._slice(self._order[begin:end], depth + 1)
                waiting.append((begin, end, depth + 1))
            else:
                self._first[begin] = True
        return self._order, self._first

    def _finish(self, low: int, high: int, depth: int) -> None:
        """Sort a slice whose words agree up to `depth`, all its runs at one depth after the other."""
        places, runs, keys = np.arange(low, high), np.zeros(high - low, "int64"), self._keys[low:high]
        while len(places):
            order = np.lexsort((keys, runs)) if runs[-1] > runs[0] else np.argsort(keys, kind="stable")
            keys, runs = keys[order], runs[order]
            self._order[places] = self._order[places][order]
            begins = np.append(True, (keys[1:] != keys[:-1]) | (runs[1:] != runs[:-1]))
            self._first[places[begins]] = True
            number = np.cumsum(begins) - 1
            on = (np.bincount(number)[number] > 1) & ((keys & np.uint64(255)) > 0)
            depth += 1
            places, runs = places[on], number[on]
            keys = self._slice(self._order[places], depth)


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of a buffer in which texts begin at `begins`."""
    letter = _LETTERS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    before = np.append(False, letter)
    after = np.append(letter, False)
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends - starts


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.append(0, np.cumsum(lengths))
    place = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.astype("i4")), pa.py_buffer(data[place]))


def _padded(data: np.ndarray) -> np.ndarray:
    return np.append(_LOWER[data], np.zeros(8, "u1"))


def _slice_runs(data: np.ndarray, at: np.ndarray, group: np.ndarray, small: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, occurrences, documents) of texts at data[at[i]:at[i + 1]], which come by group."""
    data = _padded(data)
    starts, lengths = _words(data[:-8], at[:-1][np.diff(at) > 0])
    order, first = Pointers(data, starts, lengths, small).sort()
    row = np.searchsorted(at, starts, side="right")[order] - 1
    own = group[row]
    begins = np.flatnonzero(first | (own != np.append(-1, own[:-1])))
    fresh = first | (row != np.append(-1, row[:-1]))
    documents = np.add.reduceat(fresh, begins, dtype="int64") if len(begins) else begins
    words = order[begins]
    return _strings(data, starts[words], lengths[words]), own[begins], np.diff(np.append(begins, len(order))), documents


def _long_runs(data: np.ndarray, size: int, small: int) -> tuple[pa.Array, np.ndarray]:
    """(term, occurrences) of one long text, cut into slices between words."""
    counts: dict[str, int] = {}
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + size)
        while end < len(data) and _LETTERS[data[end - 1]]:  # within a word, perhaps a long one
            others = np.flatnonzero(~_LETTERS[data[end : end + 4096]])
            end = min(len(data), end + (int(others[0]) if len(others) else 4096))
            if len(others):
                break
        terms, _, n, _ = _slice_runs(data[begin:end], np.array([0, end - begin]), np.zeros(1, "int64"), small)
        for term, more in zip(terms.to_pylist(), n.tolist()):
            counts[term] = counts.get(term, 0) + more
        begin = end
    return pa.array(list(counts), pa.string()), np.array(list(counts.values()), "int64")


def term_runs(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", size: int = _SLICE, small: int = _SMALL
) -> DataFrame:
    """(lang, source, term, n, documents) of each shard; one more row of each group with term '' and 0."""

    def shard(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = pa.table({n: pc.fill_null(batch.column(i), "") for i, n in enumerate(("lang", "source", "text"))})
        table = table.sort_by([("lang", "ascending"), ("source", "ascending")]).combine_chunks()
        langs, sources, column = [table.column(i).chunk(0) for i in range(3)]
        column = column.cast(pa.large_binary())
        change = np.append(
            True,
            pc.or_(pc.not_equal(langs[1:], langs[:-1]), pc.not_equal(sources[1:], sources[:-1])).to_numpy(zero_copy_only=False),
        )
        group, heads = np.cumsum(change) - 1, pa.array(np.flatnonzero(change))
        langs, sources = langs.take(heads), sources.take(heads)
        offsets = np.frombuffer(column.buffers()[1], "i8")[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", "u1")

        def rows(terms: pa.Array, own: np.ndarray, n: np.ndarray, documents: np.ndarray) -> pa.RecordBatch:
            own = pa.array(own)
            columns = [langs.take(own), sources.take(own), terms, pa.array(n), pa.array(documents)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "documents"])

        zeros = np.zeros(len(heads), "int64")
        yield rows(pa.array([""] * len(heads), pa.string()), np.arange(len(heads)), zeros, zeros)
        begin = 0
        while begin < len(column):
            if offsets[begin + 1] - offsets[begin] > size:
                terms, n = _long_runs(data[offsets[begin] : offsets[begin + 1]], size, small)
                yield rows(terms, np.full(len(n), group[begin]), n, np.ones(len(n), "int64"))
                begin += 1
                continue
            stop = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1)
            at = offsets[begin : stop + 1]
            yield rows(*_slice_runs(data[at[0] : at[-1]], at - at[0], group[begin:stop], small))
            begin = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from shard(batch)

    plain = docs.select(*[F.col(c).cast("string") for c in (lang, source, text)])
    return plain.mapInArrow(run, "lang string, source string, term string, n long, documents long")


def _share(count: str, total: str) -> Column:
    """1 + 10^9 * (count + 1) div (total + v); the product can exceed a long."""
    return F.expr(
        f"1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * CAST(1000000000 AS DECIMAL(10, 0))) div CAST({total} + v AS DECIMAL(31, 0))"
    )


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _matrix(rows: DataFrame, block: int) -> DataFrame:
    """(lang, a, b, value): sums of f over terms for sources a of a block against all sources b.

    `rows` are (lang, block, salt, base, term, held): for each key first a row with `base`, what p
    every source gives a term it doesn't use, then rows of terms with `held`, the (source, p) of
    those that use it.
    """
    cells = 1 << 22

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base, begin, total, waiting, n_waiting = None, None, 0, None, [], 0

        def add() -> None:
            nonlocal waiting, n_waiting
            width = total.shape[0]
            step = max(1, cells // max(1, total.size))
            sizes = np.array([len(x) for x, _ in waiting], "int64")
            places, shares = (np.concatenate([x[i] for x in waiting]) if waiting else np.zeros(0, "int64") for i in (0, 1))
            at = np.append(0, np.cumsum(sizes))
            for k in range(0, len(waiting), step):
                some = sizes[k : k + step]
                p = np.repeat(base[None, :], len(some), axis=0)
                inside = slice(at[k], at[k + len(some)])
                p[np.repeat(np.arange(len(some)), some), places[inside]] = shares[inside]
                gap = p[:, begin : begin + width, None] - p[:, None, :]
                np.add(total, (gap * gap // p[:, None, :]).sum(axis=0), out=total)
            waiting, n_waiting = [], 0

        def told() -> pa.RecordBatch:
            add()
            a, b = np.nonzero(np.arange(begin, begin + total.shape[0])[:, None] != np.arange(total.shape[1])[None, :])
            columns = [pa.array([key[0]] * len(a), pa.string()), pa.array(a + begin), pa.array(b), pa.array(total[a, b])]
            return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

        for batch in batches:
            langs, blocks, salts, bases = [batch.column(i) for i in range(4)]
            held = batch.column(4)
            at, flat = held.offsets.to_numpy(), held.values
            places, shares = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(2)]
            for i in range(batch.num_rows):
                if bases.is_valid()[i].as_py():
                    if key is not None:
                        yield told()
                    key = (langs[i].as_py(), blocks[i].as_py(), salts[i].as_py())
                    base = np.array(bases[i].as_py(), "int64")
                    begin = key[1] * block
                    total = np.zeros((min(block, len(base) - begin), len(base)), "int64")
                else:
                    waiting.append((places[at[i] : at[i + 1]], shares[at[i] : at[i + 1]]))
                    n_waiting += 1
                    if n_waiting >= 8192:
                        add()
        if key is not None:
            yield told()

    keys = ["lang", "block", "salt"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("base").isNull())
    return dealt.select(*keys, "base", "held").mapInArrow(run, "lang string, a long, b long, value long")


def _pairs(used: DataFrame, groups: DataFrame, block: int, salt_terms: int) -> DataFrame:
    """(lang, source, item, value): f of each two sources of a language, over all its kept terms."""
    salts = F.expr(f"v div {salt_terms} + 1")
    bases = groups.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "p0"))), lambda x: x.p0).alias("base"), F.max("v").alias("v")
    )
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(size(base) - 1) div {block}"))
    bases = bases.select("lang", "base", F.explode(blocks).alias("block"), "v").select(
        "lang", "block", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), "base"
    )
    n_blocks = F.expr(f"(sources - 1) div {block}")
    terms = (
        used.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("place", "p")).alias("held"), F.max("v").alias("v"), F.max("sources").alias("sources"))
        .select("lang", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks)).alias("block"), F.pmod(F.xxhash64("term"), salts).alias("salt"), "held")
    )
    sums = _matrix(bases.unionByName(terms, allowMissingColumns=True), block).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    named = groups.select("lang", "place", F.col("source").alias("item"))
    return (
        sums.join(named.select("lang", F.col("place").alias("b"), "item"), ["lang", "b"])
        .join(named.select("lang", F.col("place").alias("a"), F.col("item").alias("source")), ["lang", "a"])
        .select("lang", "source", "item", "value")
    )


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_documents: int = 3,
    top: int = 200,
    block: int = 128,
    salt_terms: int = 1 << 15,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how sources differ from each other and from their language.

    Sums of f stay below 5 * 10^18 up to 10^9 kept terms. Writes the counts and the kept terms, at once.
    """
    runs = term_runs(docs, lang, source, text)
    counted = cut_lineage(
        runs.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")), "counts"
    )
    kept = (
        counted.filter("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("held"))
        .filter(F.col("documents") >= least_documents)
    )
    kept = cut_lineage(kept.drop("documents"), "kept-terms")
    uses = kept.select("lang", "term", "lang_n", F.explode("held").alias("use")).select("lang", "term", "lang_n", "use.*")
    zero = F.lit(0).cast("long")
    every = counted.filter("term = ''").select("lang", "source")
    totals = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    groups = (
        every.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "v")])
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
        .withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
        .withColumn("none", zero)
    )
    groups = cut_lineage(
        groups.withColumn("p0", F.when(F.col("v") > 0, _share("none", "total")).otherwise(1)).drop("none"), "groups"
    )
    used = uses.join(groups.drop("p0"), ["lang", "source"]).withColumn("p", _share("n", "total"))
    more = used.withColumn("q", _share("lang_n", "lang_total")).filter("p > q")
    terms = _ranked(more.select("lang", "source", F.col("term").alias("item"), _gap("p", "q").alias("value")), "term")
    return _ranked(_pairs(used, groups, block, salt_terms), "pair").unionByName(terms.filter(F.col("rank") <= top))
