"""Sampled segmentations by Gumbel top-k over the lattice of a SentencePiece vocabulary.

A text's segmentations have the probability of a unigram model whose pieces weigh 1 / (rank + 2),
rank being the vocabulary's merge order; characters without a piece are spelled in byte pieces. The
`samples` segmentations with the largest Gumbel-perturbed log-probability are a sample without
replacement. They are found by A* search: a node is a path from the text's begin with a set of next
pieces left out, and its value is the largest perturbed log-probability below it, drawn as a Gumbel
variable that is cut at its parent's value. Taking a node draws its best segmentation and leaves one
node at each of its places, so exact values serve as bounds and `samples` nodes are taken in all.
Backward sums over the lattice give each next piece's probability. No piece goes across a blank, so
the lattices of words are built and walked together, and those of frequent words are remembered by
each worker process, up to `edges` edges.

All draws are hashes of the row's key, the round and the place: a row's samples do not depend on
other rows, tasks or repeats. With the (samples + 1)-th value, `kappa`, a segmentation of
log-probability p was included with probability 1 - exp(-exp(p - kappa)).

Null and empty texts have one segmentation without pieces; texts with fewer segmentations than
asked for return all of them with inclusion 1. Null keys count as 0; repeated rows have equal
samples. A task's memory follows its longest text, at some 40 bytes a character.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import texts

BLANK = "▁"
_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_WALK, _LEFT, _TURN, _AGAIN = range(4)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX1
    z = (z ^ (z >> np.uint64(27))) * _MIX2
    return z ^ (z >> np.uint64(31))


def _uniform(seed: np.ndarray, turn: int, use: int, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by row, round, use and place."""
    count = place.astype("u8") + np.uint64(((turn * 4 + use) << 40) + 1)
    return ((_mixed(seed + count * _GOLDEN) >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53


def _cut_gumbel(mass: np.ndarray, most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at log-masses `mass`, given that they are below `most`."""
    return mass - np.log(np.exp(mass - most) - np.log(u))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all ranges in turn."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class _Numbered(dict):
    """Words in the order in which they were first asked for; `new` ones wait for their lattices."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Vocabulary:
    """Lattices of words; a lattice is its begin's number among the nodes.

    A node's edges follow each other from ``first[node]`` on, the longest first. Lattices take up to
    `edges` edges; beyond that those of words not often asked for are forgotten.
    """

    def __init__(self, model_file: str | None = None, edges: int = 4_000_000):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(
            model_file=model_file or public_tokenizers.path("piece_bpe_32k.model")
        )
        self.size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(self.size)]
        normal = [
            i
            for i in range(self.size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and model.get_score(i) > -1e8
        ]
        if any(BLANK in self.texts[i][1:] for i in normal):
            raise ValueError("a piece goes across a blank")
        rank = {i: -model.get_score(i) for i in normal}
        rank[model.piece_to_id(BLANK)] = float(self.size)  # the file has the blank itself without a rank
        total = sum(1 / (r + 2) for r in rank.values())
        weight = {i: -math.log((r + 2) * total) for i, r in rank.items()}
        self.pieces = {self.texts[i]: (i, w) for i, w in weight.items()}
        self._bytes = [model.piece_to_id(f"<0x{x:02X}>") for x in range(256)]
        self._byte_weight = min(weight.values())
        self._begins = {text[:n] for text in self.pieces for n in range(1, len(text) + 1)}
        self._longest = max(map(len, self.pieces))
        values = [text.replace(BLANK, " ").encode() for text in self.texts]
        for x, number in enumerate(self._bytes):
            values[number] = bytes([x])
        self._value_lengths = np.array(list(map(len, values)))
        self._value_at = np.cumsum(self._value_lengths) - self._value_lengths
        self._values = np.frombuffer(b"".join(values), "u1")
        self._hash_begins()
        self._limit = edges
        self.spelled: list[tuple[int, ...]] = []
        self._spelled_at: dict[str, int] = {}
        self.reset()

    def _hash_begins(self) -> None:
        """The beginnings of pieces by hash, in slots that are probed one after the other."""
        begins = sorted(self._begins)
        hashes = np.array([self._hash(x) for x in begins], "u8")
        if len(np.unique(hashes)) < len(begins):
            raise ValueError("beginnings of pieces share a hash")
        found = [self.pieces.get(x, (-1, 0.0)) for x in begins]
        self._table_code = np.array([x[0] for x in found] + [-1])
        self._table_weight = np.array([x[1] for x in found] + [0.0])
        self._slot_bits = max(4, (4 * len(begins)).bit_length())
        slots, self._probes = np.full(1 << self._slot_bits, len(begins), "i4"), 1
        for i, h in enumerate(hashes.tolist()):
            at, probes = self._slot(h), 1
            while slots[at] < len(begins):
                at, probes = (at + 1) % len(slots), probes + 1
            slots[at] = i
            self._probes = max(self._probes, probes)
        self._slots, self._table = slots, np.append(hashes, np.uint64(0))

    def _slot(self, h):
        return (h * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self._slot_bits)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the beginning with each hash; the number of beginnings where there is none."""
        none = len(self._table) - 1
        at = ((hashes * _GOLDEN) >> np.uint64(64 - self._slot_bits)).astype("i8")
        found = self._slots[at]
        open_ = np.flatnonzero((found < none) & (self._table[found] != hashes))
        for _ in range(self._probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self._slots)
            found[open_] = self._slots[at[open_]]
            own = found[open_]
            open_ = open_[(own < none) & (self._table[own] != hashes[open_])]
        found[open_] = none
        return found

    def reset(self) -> None:
        self.known = _Numbered()
        self.first, self.to, self.code = array("i"), array("i"), array("i")
        self.below, self.log_q = array("d"), array("d")
        self.roots, self.sizes, self._uses = array("q"), array("q"), np.zeros(0, "i8")

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words, whose lattices begin at ``roots`` and have ``sizes`` characters with their blank."""
        if len(self.to) > self._limit:
            self._forget()
        found = np.fromiter(map(self.known.__getitem__, words), "i8", len(words))
        new, self.known.new = self.known.new, []
        lengths = np.fromiter(map(len, new), "i8", len(new))
        long = np.flatnonzero(lengths > 64).tolist()
        roots = np.empty(len(new), "i8")
        roots[lengths <= 64] = self.learn([w for w in new if len(w) <= 64] if long else new)
        roots[long] = [self.learn_one(new[i]) for i in long]
        self.roots.frombytes(roots.tobytes())
        self.sizes.frombytes((lengths + 1).tobytes())
        uses = np.zeros(len(self.known), "i8")
        uses[: len(self._uses)] = self._uses
        self._uses = uses + np.bincount(found, minlength=len(uses))
        return found

    def _forget(self) -> None:
        """Keep the words asked for most often, with at most half of the edges."""
        first = np.append(np.frombuffer(self.first, "i4"), len(self.to)).astype("i8")
        roots, sizes = np.frombuffer(self.roots, "i8"), np.frombuffer(self.sizes, "i8")
        edges = first[roots + sizes] - first[roots]
        least = 2
        while edges[self._uses >= least].sum() > self._limit // 2:
            least *= 2
        kept = np.flatnonzero(self._uses >= least)
        nodes, own = _spread(roots[kept], sizes[kept]), _spread(first[roots[kept]], edges[kept])
        moved = np.repeat(np.cumsum(sizes[kept]) - sizes[kept] - roots[kept], edges[kept])
        to = np.frombuffer(self.to, "i4")[own]
        shift = np.repeat(np.cumsum(edges[kept]) - edges[kept] - first[roots[kept]], sizes[kept])
        tables = {
            "first": (first[nodes] + shift).astype("i4"),
            "to": np.where(to < 0, -1, to + moved).astype("i4"),
            **{name: np.frombuffer(getattr(self, name), kind)[own] for name, kind in (("code", "i4"), ("below", "f8"), ("log_q", "f8"))},
            "roots": np.cumsum(sizes[kept]) - sizes[kept],
            "sizes": sizes[kept],
        }
        words, uses = list(self.known), self._uses[kept] // 2
        self.reset()
        for i in kept.tolist():
            self.known[words[i]] = len(self.known)
        for name, values in tables.items():
            getattr(self, name).frombytes(values.tobytes())
        self._uses = uses

    def _spelling(self, char: str) -> tuple[int, float]:
        """Code (beyond the ids) and weight of a character in byte pieces."""
        if char not in self._spelled_at:
            self._spelled_at[char] = len(self.spelled)
            self.spelled.append(tuple(self._bytes[x] for x in char.encode()))
        at = self._spelled_at[char]
        return self.size + at, self._byte_weight * len(self.spelled[at])

    @staticmethod
    def _hash(text: str) -> int:
        value = 0
        for char in text:
            value = (value * int(_MIX1) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def learn(self, words: list[str]) -> np.ndarray:
        """Add the lattices of words of at most 64 characters, all at once; where they begin."""
        if not words:
            return np.zeros(0, "i8")
        sizes = np.fromiter(map(len, words), "i8", len(words)) + 1
        chars = np.frombuffer("".join([BLANK + w for w in words]).encode("utf-32-le"), "u4").astype("u8")
        ends = np.cumsum(sizes)
        n = len(chars)
        far = np.repeat(ends, sizes) - np.arange(n)
        active, hashes = np.arange(n), np.zeros(n, "u8")
        parts, single, none = [], np.zeros(n, bool), len(self._table) - 1
        for width in range(1, self._longest + 1):
            inside = far[active] >= width
            active, hashes = active[inside], hashes[inside]
            hashes = hashes * _MIX1 + chars[active + width - 1] + np.uint64(1)
            at = self._find(hashes)
            hit = at < none
            active, hashes, at = active[hit], hashes[hit], at[hit]
            piece = self._table_code[at] >= 0
            here, at = active[piece], at[piece]
            if width == 1:
                single[here] = True
            parts.append((width, here, self._table_code[at], self._table_weight[at]))
            if not len(active):
                break
        bare = np.flatnonzero(~single)
        spelt = [self._spelling(chr(c)) for c in chars[bare].tolist()]
        parts.insert(0, (1, bare, np.array([x[0] for x in spelt], "i8"), np.array([x[1] for x in spelt], "f8")))
        counts = np.zeros(n, "i8")
        for _, here, _, _ in parts:
            counts[here] += 1
        # Nodes by their distance from the word's end; the edges of a node from the longest on.
        order = np.argsort(far.astype("u2"), kind="stable")
        offset = np.empty(n, "i8")
        offset[order] = np.cumsum(counts[order]) - counts[order]
        size, filled = int(counts.sum()), offset.copy()
        begin, reach, code, weight = np.empty(size, "i8"), np.empty(size, "i8"), np.empty(size, "i8"), np.empty(size, "f8")
        for width, here, codes, weights in parts[::-1]:
            at = filled[here]
            filled[here] += 1
            begin[at], reach[at], code[at], weight[at] = here, here + width, codes, weights
        ending = reach == (far + np.arange(n))[begin]
        log_q, after = np.empty(size), np.zeros(n + 1)
        sums = np.cumsum(np.bincount(far, counts)).astype("i8").tolist()
        for a, b in zip(sums[:-1], sums[1:]):
            value = weight[a:b] + np.where(ending[a:b], 0.0, after[reach[a:b]])
            own = begin[a:b]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            top = np.maximum.reduceat(value, starts)
            each = np.diff(np.append(starts, b - a))
            whole = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, each)), starts))
            after[own[starts]] = whole
            log_q[a:b] = np.where(np.repeat(each, each) == 1, 0.0, value - np.repeat(whole, each))
        chance, below = np.exp(log_q), np.empty(size)
        at, total = offset, np.zeros(n)  # sums within each node, so that they do not depend on other words
        left = counts
        while len(at):
            total = total + chance[at]
            below[at] = total
            more = left > 1
            at, total, left = at[more] + 1, total[more], left[more] - 1
        below[offset + counts - 1] = 1.0
        # Back to the order of the nodes.
        starts = np.cumsum(counts) - counts
        back = _spread(offset, counts)
        base = len(self.first)
        self.first.frombytes((starts + len(self.to)).astype("i4").tobytes())
        self.to.frombytes(np.where(ending, -1, reach + base)[back].astype("i4").tobytes())
        self.code.frombytes(code[back].astype("i4").tobytes())
        self.below.frombytes(below[back].tobytes())
        self.log_q.frombytes(log_q[back].tobytes())
        return ends - sizes + base

    def learn_one(self, word: str) -> int:
        """Add the lattice of one word of any length."""
        unit = BLANK + word
        n, base = len(unit), len(self.first)
        after = [0.0] * (n + 1)
        options: list[list] = [[]] * n
        pieces, begins = self.pieces, self._begins
        for i in range(n - 1, -1, -1):
            found = []
            if unit[i] not in pieces:
                code, weight = self._spelling(unit[i])
                found.append((weight + after[i + 1], i + 1, code))
            for j in range(i + 1, min(n, i + self._longest) + 1):
                part = unit[i:j]
                if part in pieces:
                    code, weight = pieces[part]
                    found.append((weight + after[j], j, code))
                elif part not in begins:
                    break
            if len(found) > 1:
                found.sort(reverse=True)
                top = found[0][0]
                after[i] = top + math.log(sum([math.exp(x[0] - top) for x in found]))
            else:
                after[i] = found[0][0]
            options[i] = found
        for i in range(n):
            self.first.append(len(self.to))
            low, whole = 0.0, after[i]
            for value, j, code in options[i]:
                self.log_q.append(value - whole)
                low += math.exp(value - whole)
                self.below.append(low)
                self.to.append(base + j if j < n else -1)
                self.code.append(code)
            self.below[-1] = 1.0
            if len(options[i]) == 1:
                self.log_q[-1] = 0.0
        return base

    def ids(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of codes that lie at at[i]:at[i + 1]; codes beyond the ids are spelled out."""
        far = np.flatnonzero(codes >= self.size)
        if not len(far):
            return codes.astype("i4"), at
        counts = np.ones(len(codes), "i8")
        spelt = [self.spelled[c - self.size] for c in codes[far].tolist()]
        counts[far] = list(map(len, spelt))
        ends = np.append(0, np.cumsum(counts))
        found = np.repeat(codes, counts)
        found[_spread(ends[far], counts[far])] = list(chain.from_iterable(spelt))
        return found.astype("i4"), ends[at]

    def decoded(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The texts of the piece ids that lie at at[i]:at[i + 1], as UTF-8."""
        counts = self._value_lengths[ids]
        text = self._values[_spread(self._value_at[ids], counts)].tobytes()
        ends = np.append(0, np.cumsum(counts))[at].tolist()
        return [text[x + 1 : y] for x, y in zip(ends[:-1], ends[1:])]

    def decode(self, ids) -> str:
        """The text of piece ids."""
        return self.decoded(np.array(ids, "i8"), np.array([0, len(ids)]))[0].decode()


class _Path:
    """A segmentation: edges with their nodes, words and places; `left` holds the values of the open
    nodes along it and `out` the edges taken at nodes that were taken more than once."""

    def __init__(self, edge, node, word, place, before, left, value, log_prob):
        self.edge, self.node, self.word, self.place = edge, node, word, place
        self.before, self.left, self.value, self.log_prob = before, left, value, log_prob
        self.out: dict[int, list[int]] = {}


class Sampler:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def _walk(self, node, place, seed, turn):
        """Draw each lane's pieces to its word's end: (lane, edge, node, place), lane by lane."""
        first, to, below, _ = self._views
        lanes, shift, parts = np.arange(len(node)), place - node, []
        while len(lanes):
            at = shift[lanes] + node
            u = _uniform(seed[lanes], turn, _WALK, at)
            edge = first[node].astype("i8")
            more = np.flatnonzero(u >= below[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= below[edge[more]]]
            parts.append((lanes, edge, node, at))
            node = to[edge].astype("i8")
            on = node >= 0
            lanes, node = lanes[on], node[on]
        if not parts:
            return (np.zeros(0, "i8"),) * 4
        lane, *rest = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(lane, kind="stable")
        return lane[order], *[x[order] for x in rest]

    def _open(self, edge, place, seed, begin_of, begins, before, most, turn):
        """(log-mass before each piece, value of the node left there, the piece's own log-probability)."""
        log_q = self._views[3][edge]
        total = np.empty(len(log_q))
        limits = [*begins.tolist(), len(log_q)]
        for a, b in zip(limits, limits[1:]):  # row by row, so that a row's sums do not depend on others
            np.cumsum(log_q[a:b], out=total[a:b])
        start = total - log_q + before[begin_of]
        with np.errstate(divide="ignore"):
            mass = start + np.log(-np.expm1(log_q))
        left = _cut_gumbel(mass, most[begin_of], _uniform(seed, turn, _LEFT, place))
        return start, left, log_q

    def __call__(self, rows: list[str], keys: list[int], samples: int) -> list[list[tuple]]:
        """For each row (ids, log-probability, value, inclusion) of its samples, the best value first."""
        vocabulary = self.vocabulary
        words = [x.replace(BLANK, " ").split(" ") if x else [] for x in rows]
        counts = np.fromiter(map(len, words), "i8", len(words))
        number = vocabulary.numbers(list(chain.from_iterable(words)))
        roots, sizes = np.frombuffer(vocabulary.roots, "i8")[number], np.frombuffer(vocabulary.sizes, "i8")[number]
        ends = np.cumsum(counts)
        row_of = np.repeat(np.arange(len(rows)), counts)
        place = np.cumsum(sizes) - sizes
        begins = ends - counts
        if len(place):
            place -= place[np.minimum(begins, len(place) - 1)][row_of]
        seed = _mixed(np.array(keys, "i8").view("u8") * _GOLDEN + _MIX2)
        self._views = tuple(
            np.frombuffer(x, kind)
            for x, kind in ((vocabulary.first, "i4"), (vocabulary.to, "i4"), (vocabulary.below, "f8"), (vocabulary.log_q, "f8"))
        ) if len(vocabulary.to) else (np.zeros(1, "i4"), np.zeros(1, "i4"), np.zeros(1), np.zeros(1))
        code = np.frombuffer(vocabulary.code, "i4") if len(vocabulary.code) else np.zeros(1, "i4")
        try:
            found, kappa = self._search(roots, place, row_of, ends, seed, samples)
            every = [p.edge for paths in found for p in paths]
            at = np.append(0, np.cumsum(np.fromiter(map(len, every), "i8", len(every))))
            ids, at = vocabulary.ids(code[np.concatenate(every)] if every else code[:0], at)
            parts = iter([ids[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())])
            return [
                [(next(parts), p.log_prob, p.value, -math.expm1(-math.exp(min(p.log_prob - k, 700.0)))) for p in paths]
                for paths, k in zip(found, kappa.tolist())
            ]
        finally:
            del self._views, code

    def _search(self, roots, place, row_of, ends, seed, samples):
        n = len(seed)
        value = -np.log(-np.log(_uniform(seed, 0, _LEFT, np.full(n, 1 << 39))))
        lane, edge, node, at = self._walk(roots, place, seed[row_of], 0)
        row = row_of[lane]
        begins = np.searchsorted(row, np.arange(n))
        stops = np.append(begins[1:], len(row))
        before, left, log_q = self._open(edge, at, seed[row], row, begins, np.zeros(n), value, 0)
        whole = np.bincount(row, log_q, minlength=n)
        found = [
            [_Path(edge[a:b], node[a:b], lane[a:b], at[a:b], before[a:b], left[a:b], value[i], whole[i])]
            for i, (a, b) in enumerate(zip(begins.tolist(), stops.tolist()))
        ]
        kappa = np.full(n, -math.inf)
        alive = list(range(n))
        for turn in range(1, samples + 1):
            taken = []
            for i in alive:
                best, path, j = -math.inf, None, 0
                for p in found[i]:
                    if len(p.left):
                        m = int(p.left.argmax())
                        if p.left[m] > best:
                            best, path, j = float(p.left[m]), p, m
                if path is not None:
                    taken.append((i, best, path, j))
            if turn == samples:
                for i, best, _, _ in taken:
                    kappa[i] = best
                break
            alive = [i for i, *_ in taken]
            if taken:
                self._turn(taken, found, roots, place, ends, seed, turn)
        return found, kappa

    def _turn(self, taken, found, roots, place, ends, seed, turn):
        """Draw the segmentations below the taken nodes, all rows together."""
        first, to, _, log_q = self._views
        heads, nodes, places, lane_rows, lane_words, limits = [], [], [], [], [], [0]
        for i, value, path, j in taken:
            here = int(path.node[j])
            e0 = int(first[here])
            e1 = int(first[here + 1]) if here + 1 < len(first) else len(to)
            out = path.out.setdefault(j, [int(path.edge[j])])
            q = np.exp(log_q[e0:e1])
            q[[e - e0 for e in out]] = 0.0
            spot = np.array([int(path.place[j])])
            u = _uniform(seed[i : i + 1], turn, _TURN, spot)[0]
            pick = int(np.searchsorted(np.cumsum(q), u * q.sum(), side="right"))
            pick = min(pick, int(np.flatnonzero(q)[-1]))
            out.append(e0 + pick)
            rest = q.sum() - q[pick]
            path.left = path.left.copy()
            if len(out) == e1 - e0 or rest <= 0:
                path.left[j] = -math.inf
            else:
                mass = np.array([path.before[j] + math.log(rest)])
                path.left[j] = _cut_gumbel(mass, np.array([value]), _uniform(seed[i : i + 1], turn, _AGAIN, spot))[0]
            word, edge = int(path.word[j]), e0 + pick
            step = self._length(here, edge, roots, place, word)
            then = int(to[edge])
            own_nodes = roots[word + 1 : ends[i]]
            own_places = place[word + 1 : ends[i]]
            own_words = np.arange(word + 1, ends[i])
            if then >= 0:
                own_nodes = np.concatenate(([then], own_nodes))
                own_places = np.concatenate(([step], own_places))
                own_words = np.concatenate(([word], own_words))
            heads.append((i, value, path, j, edge, word))
            nodes.append(own_nodes)
            places.append(own_places)
            lane_words.append(own_words)
            lane_rows.append(np.full(len(own_nodes), len(heads) - 1))
            limits.append(limits[-1] + len(own_nodes))
        node, spot = np.concatenate(nodes).astype("i8"), np.concatenate(places).astype("i8")
        lane_row, lane_word = np.concatenate(lane_rows).astype("i8"), np.concatenate(lane_words).astype("i8")
        row_seed = seed[np.array([h[0] for h in heads])]
        lane, edge, at_node, at = self._walk(node, spot, row_seed[lane_row], turn)
        row = lane_row[lane]
        begins = np.searchsorted(row, np.arange(len(heads)))
        stops = np.append(begins[1:], len(row))
        start = np.array([p.before[j] + log_q[e] for _, _, p, j, e, _ in heads])
        most = np.array([h[1] for h in heads])
        before, left, each = self._open(edge, at, row_seed[row], row, begins, start, most, turn)
        whole = start + np.bincount(row, each, minlength=len(heads))
        for number, (i, value, path, j, taken_edge, word) in enumerate(heads):
            a, b = int(begins[number]), int(stops[number])
            join = lambda old, one, new: np.concatenate((old[:j], [one], new))  # noqa: B023, E731
            found[i].append(
                _Path(
                    join(path.edge, taken_edge, edge[a:b]),
                    join(path.node, path.node[j], at_node[a:b]),
                    join(path.word, word, lane_word[lane[a:b]]),
                    join(path.place, path.place[j], at[a:b]),
                    join(path.before, path.before[j], before[a:b]),
                    np.concatenate((np.full(j + 1, -math.inf), left[a:b])),
                    value,
                    float(whole[number]),
                )
            )

    def _length(self, node, edge, roots, place, word):
        """The place that an edge leads to."""
        then = int(self._views[1][edge])
        return int(place[word]) + (then - int(roots[word])) if then >= 0 else -1


def sample(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    samples: int = 2,
    model_file: str | None = None,
    with_ids: bool = True,
    part: int = 1 << 19,
) -> DataFrame:
    """One row per sample: key, sample (from 1), n_pieces, ids_crc32, decoded_crc32, log_prob, value, inclusion[, ids]."""
    schema = (
        "key long, sample int, n_pieces long, ids_crc32 long, decoded_crc32 long, log_prob double, value double, "
        "inclusion double" + (", ids array<int>" if with_ids else "")
    )
    names = ["key", "sample", "n_pieces", "ids_crc32", "decoded_crc32", "log_prob", "value", "inclusion", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = _sampler(model_file)
        for batch in batches:
            keys, values = batch.column(0).to_pylist(), [x.decode() for x in texts(batch.column(1))]
            begin = 0
            while begin < len(values):
                end, size = begin + 1, len(values[begin])
                while end < len(values) and size + len(values[end]) < part:
                    size += len(values[end])
                    end += 1
                own = keys[begin:end]
                drawn = draw(values[begin:end], [k or 0 for k in own], samples)
                ids = [x[0] for paths in drawn for x in paths]
                lengths = np.fromiter(map(len, ids), "i8", len(ids))
                at = np.append(0, np.cumsum(lengths))
                back = draw.vocabulary.decoded(np.concatenate(ids) if ids else np.zeros(0, "i4"), at)
                columns = [
                    pa.array([k for k, paths in zip(own, drawn) for _ in paths], pa.int64()),
                    pa.array([i for paths in drawn for i in range(1, len(paths) + 1)], pa.int32()),
                    pa.array(lengths),
                    pa.array([zlib.crc32(memoryview(x)) if len(x) else 0 for x in ids], pa.int64()),
                    pa.array(list(map(zlib.crc32, back)), pa.int64()),
                    *[pa.array([x[i] for paths in drawn for x in paths], pa.float64()) for i in (1, 2, 3)],
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
                begin = end

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


@cache
def _sampler(model_file: str | None) -> Sampler:
    """One for each worker process: the vocabulary and the lattices of frequent words serve all its tasks."""
    return Sampler(Vocabulary(model_file))
