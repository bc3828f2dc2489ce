"""Secret scans with one combined, minimised deterministic automaton.

A rule is a head (a regular expression) followed by a run of one or more bytes of a class; a match
counts if its run is long enough. All rules are compiled together: Thompson automata of the heads,
subset construction that follows leftmost, non-overlapping matching of each rule, and minimisation
to one transition array over byte classes. A text is scanned once for all rules.

Bytes that lead every state to the start state cut a batch of texts into lanes that are advanced
together, one byte a step, so the work is array look-ups. Lanes in which a state reports a match
are followed again with the same arrays to get the ends of all matches; a rule's reversed automaton,
run back from an end to the end of the match before, gives the start.

A rule may have a tail, what belongs to the secret after the match, such as a key's lines up to its
last one. Spans end with the match; the redacted text loses the tail as well.

Null and empty texts have no spans. Texts are scanned whole; a text without cutting bytes is one
lane, followed byte by byte. Repeated rows are scanned alike.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from igarape.llm.common import map_arrow, texts


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    run: str
    least: int
    any_case: bool = False
    tail: str = ""


# A private key's lines, quoted or with escaped line breaks too, with the END line; without one
# (cut texts) the full lines and the short one after them.
_KEY_LINES = (
    r"(?:[\sA-Za-z0-9+/=\\\"',:;>|#*]++|-(?!----))*+-----END (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"
    r"|(?:\s++[A-Za-z][A-Za-z-]*+: [^\r\n\\]*+)*+"
    r"(?:(?:\s|\\[nr])++[>|#*\"' ]*+[A-Za-z0-9+/]{40,}+={0,2}+)++"
    r"(?:(?:\r?\n|\\n)[>|#*\"' ]*+[A-Za-z0-9+/]{1,39}+={0,2}+(?=[\s\\\"']|\Z))?"
)

BASE_RULES = (
    Rule(
        "assign",
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?",
        "[A-Za-z0-9+/_.=-]",
        12,
        any_case=True,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY----", "-", 1, tail=_KEY_LINES),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
)
RULES = BASE_RULES + MORE_RULES


def _byte_set(items: Iterable, any_case: bool) -> frozenset[int]:
    found: set[int] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(value)
        elif kind is op.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not allowed in a class: {kind}")
    if any_case:
        letters = {x for x in found if chr(x).isascii() and chr(x).isalpha()}
        found |= {x ^ 32 for x in letters}
    if max(found) > 127:
        raise ValueError("rules are of ASCII characters")
    return frozenset(found)


class _Nfa:
    """Thompson automaton of a rule's head; `ready` is where the run may begin."""

    def __init__(self, rule: Rule, backwards: bool = False):
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self._case, self._back = rule.any_case, backwards
        self.start = self._new()
        self.ready = self._sequence(_parser.parse(rule.head), self.start)
        ((kind, value),) = _parser.parse(rule.run)
        self.run = _byte_set([(kind, value)] if kind is op.LITERAL else value, False)

    def _new(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def _sequence(self, items, at: int) -> int:
        items = list(items)
        for item in reversed(items) if self._back else items:
            at = self._item(*item, at)
        return at

    def _item(self, kind, value, at: int) -> int:
        if kind in (op.LITERAL, op.IN):
            to = self._new()
            chosen = _byte_set([(kind, value)] if kind is op.LITERAL else value, self._case)
            self.steps[at].append((chosen, to))
            return to
        if kind is op.SUBPATTERN:
            return self._sequence(value[3], at)
        if kind is op.BRANCH:
            to = self._new()
            for part in value[1]:
                begin = self._new()
                self.empty[at].append(begin)
                self.empty[self._sequence(part, begin)].append(to)
            return to
        if kind is op.MAX_REPEAT:
            least, most, part = value
            for _ in range(least):
                at = self._sequence(part, at)
            if most is op.MAXREPEAT:
                loop = self._new()
                self.empty[at].append(loop)
                self.empty[self._sequence(part, loop)].append(loop)
                return loop
            to = self._new()
            self.empty[at].append(to)
            for _ in range(most - least):
                at = self._sequence(part, at)
                self.empty[at].append(to)
            return to
        raise ValueError(f"not allowed in a rule: {kind}")

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in found:
                found.add(state)
                todo += self.empty[state]
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed(to for s in states for chosen, to in self.steps[s] if byte in chosen)


class _Leftmost:
    """One rule's deterministic states under leftmost, non-overlapping matching.

    A searching state is a tuple of thread sets, the earliest start first. A matching state is
    (run length up to the least, whether the match began to be one at this byte).
    """

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, _Nfa(rule)
        self.begin = self.nfa.closed([self.nfa.start])
        self._known: dict = {}

    def step(self, state: tuple, byte: int) -> tuple:
        key = state, byte
        if key not in self._known:
            self._known[key] = self._step(state, byte)
        return self._known[key]

    def _step(self, state: tuple, byte: int) -> tuple:
        kind, value = state
        if kind == "run":
            if byte in self.nfa.run:
                return "run", (min(value[0] + 1, self.rule.least), False)
            value = ()
        threads: list[frozenset[int]] = []
        seen: set[int] = set()
        for group in (*value, self.begin):
            if self.nfa.ready in group and byte in self.nfa.run:
                if threads:
                    raise ValueError(f"{self.rule.kind}: a later start matches before an earlier one is decided")
                return "run", (1, True)
            moved = self.nfa.step(group, byte) - seen
            if moved:
                threads.append(moved)
                seen |= moved
        return "seek", tuple(threads)


class Automaton:
    """Transition array over byte classes with, for each state, bits of the rules (by number):
    `reports` (a match that is long enough), `inside` (a match) and `fresh` (it begins here)."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        parts = [_Leftmost(rule) for rule in rules]
        self.back = [_Nfa(rule, backwards=True) for rule in rules]
        shapes: dict[tuple, int] = {}
        self.classes = np.zeros(256, "u1")
        sets = [s for p in parts for row in p.nfa.steps for s, _ in row] + [p.nfa.run for p in parts]
        for byte in range(256):
            self.classes[byte] = shapes.setdefault(tuple(byte in s for s in sets), len(shapes))
        examples = [int(np.flatnonzero(self.classes == c)[0]) for c in range(len(shapes))]

        first = tuple(("seek", ()) for _ in parts)
        numbers, todo, rows = {first: 0}, [first], []
        for state in todo:
            row = []
            for byte in examples:
                to = tuple(p.step(s, byte) for p, s in zip(parts, state))
                if to not in numbers:
                    numbers[to] = len(todo)
                    todo.append(to)
                row.append(numbers[to])
            rows.append(row)
        marks = np.zeros((len(todo), 3), "i8")
        for number, state in enumerate(todo):
            for bit, ((kind, value), rule) in enumerate(zip(state, rules)):
                if kind == "run":
                    marks[number] += np.array([value[0] >= rule.least, 1, value[1]], "i8") << bit
        self._minimise(np.array(rows, "i8"), marks)
        self.cutting = (self.table == 0).all(axis=0)
        if not self.cutting[self.classes[10]]:
            raise ValueError("a rule matches line breaks")

    def _minimise(self, table: np.ndarray, marks: np.ndarray) -> None:
        """Partition refinement until states of a block agree in marks and in the blocks they go to."""
        block = np.unique(marks, axis=0, return_inverse=True)[1].reshape(-1)
        while True:
            signature = np.concatenate((block[:, None], block[table]), axis=1)
            new = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
            if new.max() == block.max():
                break
            block = new
        order = np.unique(block, return_index=True)[1]  # a state of each block
        order = np.concatenate(([0], order[block[order] != block[0]]))
        number = np.empty(len(order), "i8")
        number[block[order]] = np.arange(len(order))
        self.table = number[block[table[order]]].astype("i4")
        self.reports, self.inside, self.fresh = marks[order].T

    def _lanes(self, classes: np.ndarray, length: int) -> np.ndarray:
        """Limits of lanes: each begins at 0 or after a cutting byte."""
        cuts = np.flatnonzero(self.cutting[classes]) + 1
        wanted = np.arange(length, len(classes), length)
        at = np.searchsorted(cuts, wanted)
        return np.unique(np.concatenate(([0], cuts[at[at < len(cuts)]], [len(classes)])))

    def hit_lanes(self, data: np.ndarray, length: int = 4096, least_lanes: int = 16) -> list[tuple[int, int]]:
        """Lanes in which a state reports a match."""
        if not len(data):
            return []
        width = self.table.shape[1]
        flat = (self.table * width).ravel()
        reporting = np.zeros(flat.max() + 1, bool)
        reporting[np.flatnonzero(self.reports) * width] = True
        classes = self.classes[data]
        limits = self._lanes(classes, length)
        begin, size = limits[:-1], np.diff(limits)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")  # lanes longer than a step
        state, hit = np.zeros(len(begin), "i4"), np.zeros(len(begin), bool)
        step = 0
        while step < size[0]:
            n = alive[step]
            if n < least_lanes:
                break
            state[:n] = flat[state[:n] + classes[begin[:n] + step]]
            hit[:n] |= reporting[state[:n]]
            step += 1
        if step < size[0]:
            table, flags = flat.tolist(), reporting.tolist()
            for lane in range(alive[step]):
                now = int(state[lane])
                for byte in classes[begin[lane] + step : begin[lane] + size[lane]].tolist():
                    now = table[now + byte]
                    if flags[now]:
                        hit[lane] = True
                        break
        found = np.flatnonzero(hit)
        return sorted(zip(begin[found].tolist(), (begin[found] + size[found]).tolist()))

    def ends(self, data: bytes) -> list[tuple[int, int, bool]]:
        """(rule, end, reported) of all matches in a lane, in order of their ends."""
        found, open_, good = [], 0, 0
        table, classes = self.table, self.classes
        now = 0
        for at, byte in enumerate(data):
            now = table[now, classes[byte]]
            inside, fresh = int(self.inside[now]), int(self.fresh[now])
            closed = open_ & (~inside | fresh)
            if closed:
                found += [(r, at, bool(good >> r & 1)) for r in range(len(self.rules)) if closed >> r & 1]
                good &= ~closed
            open_, good = inside, good | int(self.reports[now])
        found += [(r, len(data), bool(good >> r & 1)) for r in range(len(self.rules)) if open_ >> r & 1]
        return found

    def start(self, rule: int, data: bytes, least: int, end: int) -> int:
        """The first place from `least` on from which the rule matches up to `end`."""
        nfa = self.back[rule]
        begin = nfa.closed([nfa.start])
        threads, running, best = frozenset(), True, end
        for at in range(end - 1, least - 1, -1):
            byte = data[at]
            threads = nfa.step(threads, byte)
            running = running and byte in nfa.run
            if running:
                threads |= begin
            if not threads:
                break
            if nfa.ready in threads:
                best = at
        return best

    def lane_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of the matches that count."""
        before, found = [0] * len(self.rules), []
        for rule, end, good in self.ends(data):
            if good:
                found.append((self.start(rule, data, before[rule], end), rule, end))
            before[rule] = end
        return found

    def spans(self, rows: list[bytes]) -> dict[int, list[tuple[int, int, int]]]:
        """(start, rule, end) in bytes, sorted, of the rows that have any."""
        joined = b"\n".join(rows) + b"\n"
        starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in rows])))
        found: dict[int, list[tuple[int, int, int]]] = {}
        for begin, end in self.hit_lanes(np.frombuffer(joined, "u1")):
            for a, rule, b in self.lane_spans(joined[begin:end]):
                row = int(np.searchsorted(starts, begin + a, side="right")) - 1
                shift = begin - int(starts[row])
                found.setdefault(row, []).append((a + shift, rule, b + shift))
        return {row: sorted(x) for row, x in found.items()}


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return Automaton(rules)


def _in_chars(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    begins = np.concatenate(([0], np.cumsum((np.frombuffer(text, "u1") & 0xC0) != 0x80)))
    return [(int(begins[a]), rule, int(begins[b])) for a, rule, b in spans]


def _redacted(text: bytes, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> bytes:
    out, done = [], 0
    for a, rule, b in spans:
        if a >= done:
            out += [text[done:a], f"[{rules[rule].kind}]".encode()]
        if rules[rule].tail and (rest := re.compile(rules[rule].tail.encode()).match(text, b)):
            b = rest.end()
        done = max(done, b)
    return b"".join(out) + text[done:]


def scan(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, redact: bool = False,
    into: str = "secrets", part: int = 1 << 23
) -> DataFrame:
    """`docs` with a struct column `into`: counts (by rule), base_sha256, spans and, if asked, the
    redacted text, in which each span, with its rule's tail, is replaced by its kind in brackets.

    Spans are kind:start:end in code points, sorted by start, then by the order of the rules.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(compiled(rules))
    kinds = [rule.kind for rule in rules]
    n_base = len(BASE_RULES)
    names = docs.columns

    def start():
        machine = automaton.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = texts(batch.column(batch.num_columns - 1))
            found: dict[int, list[tuple[int, int, int]]] = {}
            begin = 0
            while begin < len(values):
                end, size = begin + 1, len(values[begin])
                while end < len(values) and size + len(values[end]) < part:
                    size += len(values[end])
                    end += 1
                found |= {begin + row: x for row, x in machine.spans(values[begin:end]).items()}
                begin = end
            counts, base, all_spans, clean = [], [], [], []
            nothing, empty = [0] * len(kinds), hashlib.sha256(b"").hexdigest()
            for row, value in enumerate(values):
                spans = found.get(row)
                if redact:
                    clean.append(_redacted(value, spans, rules) if spans else value)
                if not spans:
                    counts.append(nothing)
                    base.append(empty)
                    all_spans.append("")
                    continue
                told = [(rule, f"{kinds[rule]}:{a}:{b}") for a, rule, b in _in_chars(value, spans)]
                counts.append([sum(r == rule for r, _ in told) for rule in range(len(kinds))])
                base.append(hashlib.sha256(",".join(x for r, x in told if r < n_base).encode()).hexdigest())
                all_spans.append(",".join(x for _, x in told))
            fields = {
                "counts": pa.array(counts, pa.list_(pa.int64())),
                "base_sha256": pa.array(base, pa.string()),
                "spans": pa.array(all_spans, pa.string()),
            }
            if redact:
                fields["clean"] = pa.array(clean, pa.binary()).cast(pa.string())
            packed = pa.StructArray.from_arrays(list(fields.values()), list(fields))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], [*names, into])

        return one

    fields = "counts array<bigint>, base_sha256 string, spans string" + (", clean string" if redact else "")
    added = T.StructField(into, T.StructType.fromDDL(fields))
    schema = T.StructType([*docs.schema.fields, added])
    return map_arrow(docs.select("*", F.col(text).cast("string").alias("__scanned")), schema, start)
