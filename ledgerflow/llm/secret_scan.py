"""Secret scans by one combined automaton.

The regexes of all rules are put into one nondeterministic automaton over bytes, made deterministic by subset
construction and minimised into transition arrays. It is built from the reversed rules, so that one pass over a text's
bytes, from the end on, says at which places a match of which rule begins. What a match that begins somewhere covers
is then read off forwards by the rule's own automaton, leftmost and longest first, without overlaps in a rule.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: head and value as regexes, and characters that the value has at least; shorter matches are dropped
    once found, so they still cover what they cover."""

    kind: str
    head: str
    value: str
    least: int = 0


# The rules, in the order in which spans of one place are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", "AKIA", "[A-Z0-9]+", 12),
    Rule("hex", "", "[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("github", "gh[opsur]_", "[A-Za-z0-9]+", 36),
    Rule("slack", "xox[abeoprs]-", "[A-Za-z0-9-]+", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", 35),
    Rule("stripe", "[rs]k_(live|test)_", "[A-Za-z0-9]+", 16),
    Rule("webtoken", "eyJ", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("bearer", r"(?i:bearer)\x20+", "[A-Za-z0-9+/_.=~-]+", 16),
    Rule("privatekey", "", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----"),
)
# End of the fixed values.
SPANS = "array<struct<kind:string,start:int,end:int>>"


# ---- regexes to automata
class Nfa:
    """States with byte-set edges and empty edges, grown by building blocks that return (first, last) states."""

    def __init__(self, backwards: bool):
        self.backwards, self.edges, self.empty = backwards, [], []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def symbol(self, allowed: frozenset[int]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.edges[a].append((allowed, b))
        return a, b

    def chain(self, parts: list[tuple[int, int]]) -> tuple[int, int]:
        first = last = self.state()
        for a, b in reversed(parts) if self.backwards else parts:
            self.empty[last].append(a)
            last = b
        return first, last

    def choice(self, parts: list[tuple[int, int]]) -> tuple[int, int]:
        first, last = self.state(), self.state()
        for a, b in parts:
            self.empty[first].append(a)
            self.empty[b].append(last)
        return first, last

    def loop(self, part: tuple[int, int]) -> tuple[int, int]:
        """Any number of times, none included."""
        a, b = part
        first, last = self.state(), self.state()
        self.empty[first] += [a, last]
        self.empty[b] += [a, last]
        return first, last


class Pattern:
    """Adds one regex to an automaton: literals, \\xHH, classes and ranges, groups, (?i:...), |, ?, *, +, {m}, {m,}, {m,n}."""

    def __init__(self, text: str, nfa: Nfa):
        self.text, self.at, self.nfa, self.any_case = text, 0, nfa, False

    def whole(self) -> tuple[int, int]:
        found = self.alternatives()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} of {self.text!r}")
        return found

    def here(self, *options: str) -> bool:
        return any(self.text.startswith(o, self.at) for o in options)

    def alternatives(self) -> tuple[int, int]:
        found = [self.sequence()]
        while self.here("|"):
            self.at += 1
            found.append(self.sequence())
        return found[0] if len(found) == 1 else self.nfa.choice(found)

    def sequence(self) -> tuple[int, int]:
        parts = []
        while self.at < len(self.text) and not self.here("|", ")"):
            begin = self.at
            part = self.atom()
            end, again = self.at, (begin, self.any_case)
            if self.here("?", "*", "+", "{"):
                low, high = self.bounds()
                parts += self.repeated(part, again, low, high)
            else:
                parts.append(part)
                self.at = end
        return self.nfa.chain(parts)

    def bounds(self) -> tuple[int, int | None]:
        sign = self.text[self.at]
        self.at += 1
        if sign != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        inside, self.at = self.text[self.at : self.text.index("}", self.at)], self.text.index("}", self.at) + 1
        low, comma, high = inside.partition(",")
        return int(low), (int(high) if high else None) if comma else int(low)

    def repeated(self, part: tuple[int, int], again: tuple[int, bool], low: int, high: int | None) -> list[tuple[int, int]]:
        """The parts that repeat one atom, each built anew from its place in the text."""
        after, fresh = self.at, [part]

        def copy() -> tuple[int, int]:
            if fresh:
                return fresh.pop()
            self.at, self.any_case = again
            built = self.atom()
            self.at = after
            return built

        parts = [copy() for _ in range(low)]
        if high is None:
            parts.append(self.nfa.loop(copy()))
        else:
            parts += [self.nfa.choice([copy(), self.nfa.chain([])]) for _ in range(high - low)]
        return parts

    def atom(self) -> tuple[int, int]:
        if self.here("("):
            before = self.any_case
            if self.here("(?i:"):
                self.at, self.any_case = self.at + 4, True
            else:
                self.at += 3 if self.here("(?:") else 1
            found = self.alternatives()
            if not self.here(")"):
                raise ValueError(f"missing ) at {self.at} of {self.text!r}")
            self.at, self.any_case = self.at + 1, before
            return found
        if self.here("["):
            return self.nfa.symbol(self.cased(self.members()))
        return self.nfa.symbol(self.cased({self.character()}))

    def members(self) -> set[int]:
        self.at += 1
        outside = self.here("^")
        self.at += outside
        found: set[int] = set()
        while not self.here("]"):
            low = high = self.character()
            if self.here("-") and self.text[self.at + 1] != "]":
                self.at += 1
                high = self.character()
            found |= set(range(low, high + 1))
        self.at += 1
        return set(range(256)) - found if outside else found

    def character(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
            if c.isalnum():
                raise ValueError(f"unknown escape \\{c} in {self.text!r}")
        if ord(c) > 127:
            raise ValueError(f"{c!r} isn't ASCII")
        return ord(c)

    def cased(self, members: set[int]) -> frozenset[int]:
        if self.any_case:
            members = members | {ord(f(chr(m))) for m in members if m < 128 for f in (str.lower, str.upper)}
        return frozenset(members)


@dataclass
class Dfa:
    """Transition arrays: classes maps bytes to columns, step[state][column] is the next state, accepts[state] the bits of
    the rules that match there; state 0 is the first. dead is the state that nothing leads out of, if there is one."""

    classes: bytes
    step: list[list[int]]
    accepts: list[int]
    dead: int | None


def automaton(patterns: list[str], backwards: bool = False, anywhere: bool = False) -> Dfa:
    """The minimal deterministic automaton of some regexes at once; backwards: of their reversals; anywhere: a match may
    begin at each byte."""
    nfa = Nfa(backwards)
    first, ends = nfa.state(), {}
    for bit, text in enumerate(patterns):
        a, b = Pattern(text, nfa).whole()
        nfa.empty[first].append(a)
        ends[b] = ends.get(b, 0) | 1 << bit
    sets = sorted({s for out in nfa.edges for s, _ in out}, key=sorted)
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    samples = [classes.index(k) for k in range(len(kinds))]  # a byte of each column

    def closed(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in nfa.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(s for s in seen if nfa.edges[s] or s in ends)

    after = [[frozenset().union(*(closed({to}) for allowed, to in out if b in allowed)) for b in samples] for out in nfa.edges]
    begin = closed({first})
    numbers, todo, step, accepts = {begin: 0}, [begin], [], []
    for subset in todo:  # grows as subsets are found
        accepts.append(sum({ends[s] for s in subset if s in ends}))
        row = []
        for column in range(len(samples)):
            reached = (begin if anywhere else frozenset()).union(*(after[s][column] for s in subset))
            if reached not in numbers:
                numbers[reached] = len(todo)
                todo.append(reached)
            row.append(numbers[reached])
        step.append(row)
    return minimised(classes, step, accepts)


def minimised(classes: bytes, step: list[list[int]], accepts: list[int]) -> Dfa:
    """States that no input tells apart made one, by refining the partition by what is accepted."""
    block, n = list(accepts), 0
    while True:
        numbers: dict[tuple, int] = {}
        block = [numbers.setdefault((block[s], *(block[t] for t in step[s])), len(numbers)) for s in range(len(step))]
        if len(numbers) == n:
            break
        n = len(numbers)
    chosen: dict[int, int] = {}
    for s, b in enumerate(block):
        chosen.setdefault(b, s)
    small = [[block[t] for t in step[chosen[b]]] for b in range(n)]
    kept = [accepts[chosen[b]] for b in range(n)]
    dead = next((b for b in range(n) if not kept[b] and set(small[b]) == {b}), None)
    return Dfa(classes, small, kept, dead)


# ---- scanning
@dataclass(frozen=True)
class Scanner:
    """The combined automaton of all rules, read backwards; for each rule its own, its head's and the least length."""

    both: Dfa
    own: tuple[tuple[Dfa, Dfa | None, int], ...]

    def rows(self) -> list:
        """The first state as a row that holds the rows of the next states and, last, the bits of the rules it accepts."""
        rows: list[list] = [[] for _ in self.both.step]
        for row, step, bits in zip(rows, self.both.step, self.both.accepts, strict=True):
            row.extend(rows[t] for t in step)
            row.append(bits)
        return rows[0]


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    own = tuple((automaton([r.head + r.value]), automaton([r.head]) if r.least and r.head else None, r.least) for r in rules)
    return Scanner(automaton([r.head + r.value for r in rules], backwards=True, anywhere=True), own)


def longest(dfa: Dfa, data: bytes, start: int) -> int:
    """End of the longest match that begins at start, or -1."""
    state, end = 0, start if dfa.accepts[0] else -1
    classes, step, accepts, dead = dfa.classes, dfa.step, dfa.accepts, dfa.dead
    for at in range(start, len(data)):
        state = step[state][classes[data[at]]]
        if state == dead:
            break
        if accepts[state]:
            end = at + 1
    return end


def find_secrets(text: str, scanner: Scanner, row: list) -> list[tuple[int, int, int]]:
    """(start, end, rule) of all spans by start, then rule; places count code points, end is exclusive. row: scanner.rows()."""
    data, last = text.encode("utf-8", "surrogatepass"), len(row) - 1
    places, bits, at = array("q"), array("q"), len(data)
    for column in data.translate(scanner.both.classes)[::-1]:  # the one pass over all bytes, for all rules
        row = row[column]
        at -= 1
        if row[last]:
            places.append(at)
            bits.append(row[last])
    found, free = [], [0] * len(scanner.own)
    for start, here in zip(reversed(places), reversed(bits), strict=True):
        for i, (whole, head, least) in enumerate(scanner.own):
            if here >> i & 1 and start >= free[i]:
                end = free[i] = longest(whole, data, start)
                value = longest(head, data, start) if head else start
                if end - value >= least:
                    found.append((start, end, i))
    if len(data) == len(text) or not found:
        return found
    marks, chars, at = {}, 0, 0  # bytes to code points, from mark to mark
    for place in sorted({p for s, e, _ in found for p in (s, e)}):
        chars += len(data[at:place].decode("utf-8", "surrogatepass"))
        marks[place] = chars
        at = place
    return [(marks[s], marks[e], i) for s, e, i in found]


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and secrets (kind, start, end in code points, end exclusive) for every row of docs, by start, then by rule.

    Of each kind the leftmost, longest matches are taken that don't overlap; kinds may overlap each other. A match
    whose value is too short is dropped, and what it covers isn't searched again for its kind. Texts are read whole,
    whatever their length; null and empty ones have no secrets. Repeated rows, null ids and other columns are let
    through or ignored, and an empty table gives an empty result. All work is a map over the rows; the automata are
    compiled once and sent to the tasks as arrays."""
    rules = tuple(rules)
    scanner = compiled(rules)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = scanner.rows()
        for batch in batches:
            spans = [[{"kind": rules[i].kind, "start": s, "end": e} for s, e, i in find_secrets(value.as_py(), scanner, first)] for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "secrets"])

    out = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, secrets {SPANS}")
    return out.select(F.col("id").alias(id_col), "secrets")


def secret_digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The spans of secret_scan as columns: how many of each base kind, a digest of the base spans, and all spans."""
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    own = F.filter("secrets", lambda s: s.kind.isin([r.kind for r in base]))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long")
    return scanned.select(
        *[c for c in scanned.columns if c != "secrets"], *[count(r.kind).alias(f"n_{r.kind}") for r in base], F.sha2(listed(own), 256).alias("base_sha256"), listed("secrets").alias("spans")
    )
