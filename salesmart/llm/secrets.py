"""Secrets found by one deterministic automaton over bytes.

The rules' regular expressions become one nondeterministic automaton, subset
construction and minimisation make it deterministic, and its transitions are one
flat array.  The pass over a text reads it from the end with the reversed rules,
so the states it accepts in mark where matches begin, for all rules at once.
From each beginning a second automaton, made the same way from the rules as they
stand, runs forward to the longest end; it reads matches only.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import append_columns


@dataclass(frozen=True)
class Rule:
    """Leftmost longest matches of ``pattern``, over ASCII.  A match is dropped,
    and its text used up, if group ``group`` has fewer than ``least`` bytes."""

    kind: str
    pattern: bytes
    group: int = 0
    least: int = 0


# The first three rules, in the order in which spans are listed.
BASE = (
    Rule("assign", rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", rb"AKIA[A-Z0-9]{16,}"),
    Rule("hex", rb"[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("chat", rb"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("private", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

SPANS = "secrets array<struct<kind:string,start:long,end:long>>"


class Nfa:
    """Byte transitions and empty moves; built from the parse of a pattern."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def join(self, a: int, b: int) -> None:
        self.empty[a].append(b)

    def add(self, nodes: Iterable, at: int, fold: bool, backwards: bool) -> int:
        """The state after ``nodes`` when entered in ``at``."""
        nodes = list(nodes)
        for op, arg in reversed(nodes) if backwards else nodes:
            if op in (sre.LITERAL, sre.IN):
                chars = _bytes_of([(op, arg)] if op is sre.LITERAL else arg)
                if fold:
                    chars = frozenset(c for b in chars for c in (bytes([b]).lower()[0], bytes([b]).upper()[0]))
                nxt = self.state()
                self.moves[at].append((chars, nxt))
                at = nxt
            elif op is sre.SUBPATTERN:
                _, flags, _, inner = arg
                at = self.add(inner, at, fold or bool(flags & re.IGNORECASE), backwards)
            elif op is sre.BRANCH:
                out = self.state()
                for option in arg[1]:
                    start = self.state()
                    self.join(at, start)
                    self.join(self.add(option, start, fold, backwards), out)
                at = out
            elif op is sre.MAX_REPEAT:
                least, most, inner = arg
                for _ in range(least):
                    at = self.add(inner, at, fold, backwards)
                out = self.state()
                self.join(at, out)
                if most is sre.MAXREPEAT:
                    loop = self.state()
                    self.join(at, loop)
                    end = self.add(inner, loop, fold, backwards)
                    self.join(end, loop)
                    self.join(end, out)
                else:
                    for _ in range(most - least):
                        at = self.add(inner, at, fold, backwards)
                        self.join(at, out)
                at = out
            else:
                raise ValueError(f"not supported in a rule: {op}")
        return at

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _bytes_of(items: Iterable) -> frozenset[int]:
    found: set[int] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            found.add(arg)
        elif op is sre.RANGE:
            found.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"not supported in a set: {op}")
    return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``classes`` maps bytes that no rule tells apart to one number.  State s is
    the offset of its transitions, one for each class.  Accepting states come
    last, from ``accepting`` on; ``rules`` has the rules of each."""

    classes: bytes
    table: list[int]
    start: int
    accepting: int
    rules: dict[int, tuple[int, ...]]
    dead: int


def build(rules: tuple[Rule, ...], backwards: bool, anywhere: bool) -> Automaton:
    """Subset construction, then minimisation.  ``anywhere``: a match may begin
    at every byte."""
    nfa = Nfa()
    root, ends = nfa.state(), {}
    for i, rule in enumerate(rules):
        start = nfa.state()
        nfa.join(root, start)
        ends[nfa.add(sre_parser.parse(rule.pattern), start, False, backwards)] = i
    first = nfa.closure([root])

    # Bytes that no set of the rules tells apart share a column.
    sets = {chars for moves in nfa.moves for chars, _ in moves}
    column: dict[tuple[bool, ...], int] = {}
    byte_column = [column.setdefault(tuple(b in s for s in sets), len(column)) for b in range(256)]
    sample = {c: b for b, c in enumerate(byte_column)}

    numbers, todo, rows = {first: 0}, [first], []
    for current in todo:
        row = []
        for c in range(len(column)):
            reached = {t for s in current for chars, t in nfa.moves[s] if sample[c] in chars}
            nxt = nfa.closure(reached) | (first if anywhere else frozenset())
            if nxt not in numbers:
                numbers[nxt] = len(todo)
                todo.append(nxt)
            row.append(numbers[nxt])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in current if s in ends)) for current in todo]

    # States stay together while they accept the same and go to the same groups.
    group, count = _numbered(accepts)
    while True:
        finer, n = _numbered([(group[s], *(group[t] for t in rows[s])) for s in range(len(rows))])
        if n == count:
            break
        group, count = finer, n
    member = {g: s for s, g in enumerate(group)}
    order = sorted(member, key=lambda g: (accepts[member[g]] != (), g))
    width = len(column)
    offset = {g: i * width for i, g in enumerate(order)}  # one number object for each state keeps the table small
    table = [offset[group[s]] for g in order for s in rows[member[g]]]
    plain = [g for g in order if accepts[member[g]] == ()]
    dead = next((offset[g] for g in plain if all(group[t] == g for t in rows[member[g]])), -1)
    accepted = {offset[g]: accepts[member[g]] for g in order[len(plain) :]}
    return Automaton(bytes(byte_column), table, offset[group[0]], len(plain) * width, accepted, dead)


def _numbered(keys: list) -> tuple[list[int], int]:
    seen: dict = {}
    return [seen.setdefault(k, len(seen)) for k in keys], len(seen)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.checks = [re.compile(rule.pattern) for rule in rules]
        self.begins = build(rules, backwards=True, anywhere=True)
        self.longest = build(rules, backwards=False, anywhere=False)

    def beginnings(self, data: bytes) -> tuple[array, array, list[tuple[int, ...]]]:
        """Runs of bytes at each of which matches of the same rules begin, last run
        first: their first bytes, last bytes and rules.  A long match that could
        begin at each of its bytes is one run, so memory follows the matches."""
        table, state, accepting = self.begins.table, self.begins.start, self.begins.accepting
        rules_of = self.begins.rules
        low, high, owners = array("q"), array("q"), []
        size, last, owner = len(data), -1, ()
        for left, char in enumerate(reversed(data.translate(self.begins.classes)), 1):
            state = table[state + char]
            if state >= accepting:
                now = rules_of[state]
                if left != last + 1 or now != owner:
                    if owner:
                        low.append(size - last)
                    high.append(size - left)
                    owners.append(now)
                    owner = now
                last = left
        if owner:
            low.append(size - last)
        return low, high, owners

    def ends(self, data: bytes, at: int) -> dict[int, int]:
        """The longest end from ``at`` for each rule."""
        table, state, accepting, dead = self.longest.table, self.longest.start, self.longest.accepting, self.longest.dead
        classes, out = self.longest.classes, {}
        for i in range(at, len(data)):
            state = table[state + classes[data[i]]]
            if state == dead:
                break
            if state >= accepting:
                for rule in self.longest.rules[state]:
                    out[rule] = i + 1
        return out

    def scan(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then by the order of rules."""
        data = (text or "").encode("utf-8", "surrogatepass")
        used, found = [0] * len(self.rules), []
        low, high, owners = self.beginnings(data)
        for run in range(len(low) - 1, -1, -1):
            last, open_rules = high[run], owners[run]
            while open_rules := [r for r in open_rules if used[r] <= last]:
                at = min(max(low[run], used[r]) for r in open_rules)
                ends = self.ends(data, at)
                for r in open_rules:
                    if used[r] > at:
                        continue
                    used[r] = ends[r]
                    rule = self.rules[r]
                    if rule.least and len(self.checks[r].fullmatch(data, at, ends[r])[rule.group]) < rule.least:
                        continue
                    found.append((at, r, ends[r]))
        if len(data) == len(text or ""):
            return [(self.rules[r].kind, a, b) for a, r, b in sorted(found)]
        point = _code_points(data, sorted({p for a, _, b in found for p in (a, b)}))
        return [(self.rules[r].kind, point[a], point[b]) for a, r, b in sorted(found)]


def _code_points(data: bytes, positions: list[int]) -> dict[int, int]:
    out, last, points = {}, 0, 0
    for p in positions:
        points += len(data[last:p].decode("utf-8", "surrogatepass"))
        out[p], last = points, p
    return out


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Built once for each worker process, from the rules alone."""
    return Scanner(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` and ``secrets``: spans in code points, end exclusive, by start and
    then by the order of the rules.

    Null and empty texts have none.  Rows stay where they are read; nothing is
    shuffled.  A column ``secrets`` in ``docs`` is replaced.
    """
    return append_columns(docs, [text], functools.partial(_task, rules), SPANS)


def _task(rules: tuple[Rule, ...]):
    scan = scanner(rules).scan

    def columns(texts):
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in scan(text)] for text in texts]]

    return columns


def listed(secrets: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def of_kind(*kinds: str) -> Column:
    return F.filter("secrets", lambda s: s["kind"].isin(*kinds))
