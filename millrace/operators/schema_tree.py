"""Schemas of JSON records as trees, and the cheapest script that turns one into another. Plain Python, one pair at a time."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

#: A field is many-valued if more than half of its values differ, or more than half of this many.
MANY, LEAST_MANY = 48, 8

_KINDS = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}


def kind_of(value) -> str:
    """The JSON kind of a value that is not null."""
    return _KINDS[type(value)]


def parse_record(raw: str | None) -> dict | None:
    """The JSON object of a line, or None if it is none; NaN and Infinity are no JSON. Halves of characters, which no text can hold, become question marks."""

    def refuse(_: str) -> None:
        raise ValueError

    try:
        value = json.loads(raw, parse_constant=refuse)  # type: ignore[arg-type]
        if "\\ud" in raw or "\\uD" in raw:  # type: ignore[operator]
            value = json.loads(json.dumps(value, ensure_ascii=False).encode("utf-8", "replace").decode())
    except (ValueError, TypeError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


@dataclass
class Field:
    """What a file's records show of one field: kinds of its non-null values, how many single values, the range of numbers, and whether all are whole."""

    kinds: set[str] = field(default_factory=set)
    seen: int = 0
    numbers: list[float] = field(default_factory=lambda: [math.inf, -math.inf])
    whole: bool = True

    def add(self, value) -> None:
        if value is None:
            return
        self.kinds.add(_KINDS[type(value)])
        for x in singles(value):
            self.seen += 1
            if isinstance(x, (int, float)) and not isinstance(x, bool):
                n = float(x) if abs(x) < 1e300 else math.copysign(1e300, x)
                self.numbers = [min(self.numbers[0], n), max(self.numbers[1], n)]
            if self.whole and not isinstance(x, str):
                text = str(x)
                self.whole = "." not in text and "e" not in text


def singles(value) -> Iterator:
    """The value itself, or of a list its elements, without objects, lists and nulls."""
    for x in value if isinstance(value, list) else (value,):
        if x is not None and not isinstance(x, (dict, list)):
            yield x


def walk(record: dict) -> Iterator[tuple[tuple[str, ...], object]]:
    """Every field of a record with its path, at any depth and through arrays of objects."""
    stack: list[tuple[tuple[str, ...], dict]] = [((), record)]
    while stack:
        above, o = stack.pop()
        for name, value in o.items():
            path = (*above, name)
            yield path, value
            if isinstance(value, dict):
                stack.append((path, value))
            elif isinstance(value, list):
                todo = list(value)
                while todo:  # arrays of arrays of objects, too
                    x = todo.pop()
                    if isinstance(x, dict):
                        stack.append((path, x))
                    elif isinstance(x, list):
                        todo += x


def scan(record: dict, into: dict[tuple[str, ...], Field]) -> None:
    """Add a record's fields to ``into`` by path."""
    for path, value in walk(record):
        if path not in into:
            into[path] = Field()
        into[path].add(value)


@dataclass
class Node:
    name: str
    here: Field
    children: dict[str, Node] = field(default_factory=dict)
    size: int = 1


def tree(fields: Iterable[tuple[tuple[str, ...], Field]]) -> Node:
    root = Node("", Field())
    for path, here in sorted(fields, key=lambda x: len(x[0])):
        at = root
        for name in path[:-1]:
            at = at.children.setdefault(name, Node(name, Field()))
        at.children.setdefault(path[-1], Node(path[-1], here)).here = here

    def measure(n: Node) -> int:
        n.size = 1 + sum(measure(c) for c in n.children.values())
        return n.size

    measure(root)
    return root


def _words(name: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", name)]


def name_likeness(a: str, b: str) -> float:
    """1 for equal words in other dress; above 0 if two words share their first three letters or more."""
    x, y = _words(a), _words(b)
    if x == y and x:
        return 1.0
    hits = sum(any(p[:3] == q[:3] and min(len(p), len(q)) >= 3 for q in y) for p in x)
    return 2 * hits / (len(x) + len(y)) if hits else 0.0


def shape(value: str) -> str:
    """The form of a whole value."""
    return re.sub(r"\d+", "9", re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9a-f]{8,}|[0-9a-f]{4}(?=-)", "h", value)))


@dataclass(frozen=True)
class Shared:
    """What the values of two fields have in common: distinct values and forms of each, and of both."""

    values: tuple[int, int, int]
    forms: tuple[int, int, int]


def by_values(a: Node, b: Node) -> bool:
    """Whether a likeness of the two is a matter of their values."""
    plain = not (a.children or b.children) and a.here.kinds == b.here.kinds and a.here.seen and b.here.seen
    return bool(plain and not a.here.kinds <= {"boolean"} and not ("number" in a.here.kinds and "string" not in a.here.kinds))


def likeness(a: Node, b: Node, shared: Shared | None) -> float:
    """How surely ``b`` is ``a`` under another name, from 0 to 1. Kinds must agree.

    Fields holding others are compared by what they hold; few-valued ones by all their values, many-valued ones by the
    form of all their values, numbers by their size; a likeness of names helps where these leave room.
    """
    if a.here.kinds != b.here.kinds:
        return 0.0
    names = name_likeness(a.name, b.name)
    if a.children or b.children:
        x, y = set(a.children), set(b.children)
        common = len(x & y) / max(1, min(len(x), len(y)))
        return max(common, names) if common or names else 0.0
    if a.here.kinds <= {"boolean"} or not a.here.seen or not b.here.seen:
        return names
    if not by_values(a, b):
        mid = [math.log10(1 + max(abs(n.here.numbers[0]), abs(n.here.numbers[1]))) for n in (a, b)]
        value = 0.6 if abs(mid[0] - mid[1]) < 0.7 and a.here.whole == b.here.whole else 0.0
        return max(value, 0.5 + names / 2) if names else value
    if shared is None:
        return 0.0
    common = shared.values[2] / min(shared.values[:2])
    alike = shared.forms[2] / min(shared.forms[:2])
    many = all(k > 0.5 * min(n.here.seen, MANY) and k >= LEAST_MANY for k, n in zip(shared.values[:2], (a, b), strict=True))
    value = max(common, 0.8 * alike if many else 0.0)
    return max(value, 0.5 + names / 2) if names and (alike or common) else value


def assignment(cost: list[list[float]]) -> list[int]:
    """For each row the column that makes the sum least, by shortest augmenting paths; rows must not outnumber columns."""
    rows, columns = len(cost), len(cost[0]) if cost else 0
    row_price, column_price, owner = [0.0] * rows, [0.0] * columns, [-1] * columns
    for start in range(rows):
        reach, via, done = [math.inf] * columns, [-1] * columns, [False] * columns
        row, at = start, -1
        base = 0.0
        while True:
            for c in range(columns):
                if not done[c]:
                    step = base + cost[row][c] - row_price[row] - column_price[c]
                    if step < reach[c] - 1e-12:
                        reach[c], via[c] = step, at
            at = min((c for c in range(columns) if not done[c]), key=reach.__getitem__)
            base, done[at] = reach[at], True
            if owner[at] < 0:
                break
            row = owner[at]
        row_price[start] += base
        for c in range(columns):
            if done[c] and c != at:
                row_price[owner[c]] += base - reach[c]
                column_price[c] -= base - reach[c]
        while via[at] >= 0:
            owner[at] = owner[via[at]]
            at = via[at]
        owner[at] = start
    found = [-1] * rows
    for c, r in enumerate(owner):
        if r >= 0:
            found[r] = c
    return found


#: Costs of a script: taking a field away or adding one, for each field it holds; renaming at no likeness; a changed kind.
GONE, RENAME, RETYPE, LEAST_LIKE = 1.0, 2.0, 0.5, 0.45


Pair = tuple[str, str]


def _path(at: str, name: str) -> str:
    return f"{at}.{name}" if at else name


def _apart(a: Node, b: Node) -> tuple[list[Node], list[Node]]:
    """The fields that only one of two matched ones holds."""
    return [a.children[n] for n in sorted(a.children.keys() - b.children.keys())], [b.children[n] for n in sorted(b.children.keys() - a.children.keys())]


def _matched(a: Node, b: Node, at: str = "") -> Iterator[tuple[Node, Node, str]]:
    """Pairs of fields matched by name, with their path, from the top."""
    yield a, b, at
    for name in sorted(a.children.keys() & b.children.keys()):
        x, y = a.children[name], b.children[name]
        if x.here.kinds == y.here.kinds:
            yield from _matched(x, y, _path(at, name))


def _same(x: Node, y: Node) -> bool:
    return x.name == y.name and x.here.kinds == y.here.kinds and x.children.keys() == y.children.keys() and all(_same(x.children[n], y.children[n]) for n in x.children)


def compared(old: Node, new: Node) -> list[Pair]:
    """The paths of fields, former and new, whose values must be compared to tell whether one became the other."""
    taken: list[tuple[str, Node]] = []
    given: list[tuple[str, Node]] = []
    out: list[Pair] = []
    for a, b, at in _matched(old, new):
        left, right = _apart(a, b)
        out += [(_path(at, x.name), _path(at, y.name)) for x in left for y in right if by_values(x, y)]
        taken += [(_path(at, x.name), x) for x in left]
        given += [(_path(at, y.name), y) for y in right]
    named: dict[str, list[tuple[str, Node]]] = {}
    for q, y in given:
        named.setdefault(y.name, []).append((q, y))
    return out + [(p, q) for p, x in taken for q, y in named.get(x.name, ()) if by_values(x, y) and _same(x, y)]


def script(old: Node, new: Node, shared: Mapping[Pair, Shared]) -> tuple[float, list[tuple[str, str, str]]]:
    """The cost and the operations ``(kind, path, to)`` of a script that turns ``old`` into ``new``.

    Kinds: ``added``, ``removed``, ``renamed`` (``to`` is the new path), ``moved`` (to another parent, as it is),
    ``type_changed``. A field that keeps its name under the same parent is the same field. For the rest renaming, taking away and adding
    are assigned so that they cost least under each pair of matched parents; then what is still taken and given is assigned as
    moves so that these save most. What lies inside a field hit as a whole is not named again.
    ``shared`` has what the pairs of :func:`compared` have in common.
    """
    taken: list[tuple[str, Node]] = []
    given: list[tuple[str, Node]] = []
    ops: list[tuple[str, str, str]] = []
    total, high = 0.0, 1e9
    for a, b, at in _matched(old, new):
        changed = [n for n in sorted(a.children.keys() & b.children.keys()) if a.children[n].here.kinds != b.children[n].here.kinds]
        ops += [("type_changed", _path(at, n), "") for n in changed]
        total += RETYPE * len(changed)
        left, right = _apart(a, b)
        # a square table: every field may also be taken away or added
        cost = []
        for x in left:
            like = [likeness(x, y, shared.get((_path(at, x.name), _path(at, y.name)))) for y in right]
            cost.append([RENAME * (1 - v) if v >= LEAST_LIKE else high for v in like] + [GONE * x.size] * len(left))
        chosen = assignment([[c + (0 if j >= len(right) else -GONE * right[j].size) for j, c in enumerate(row)] for row in cost]) if left else []
        renamed = set()
        for i, (x, c) in enumerate(zip(left, chosen, strict=True)):
            if c < len(right) and cost[i][c] < high:
                ops.append(("renamed", _path(at, x.name), _path(at, right[c].name)))
                total += cost[i][c]
                renamed.add(c)
            else:
                taken.append((_path(at, x.name), x))
                total += GONE * x.size
        given += [(_path(at, y.name), y) for c, y in enumerate(right) if c not in renamed]
        total += sum(GONE * y.size for c, y in enumerate(right) if c not in renamed)

    def saved(p: str, x: Node, q: str, y: Node) -> float:
        apart = p.rpartition(".")[0] != q.rpartition(".")[0]
        return GONE * (x.size + y.size) - 1 if apart and _same(x, y) and (x.children or likeness(x, y, shared.get((p, q))) >= LEAST_LIKE) else 0.0

    gains = [[-saved(p, x, q, y) for q, y in given] + [0.0] * len(taken) for p, x in taken]
    at_home: set[int] = set()
    for i, c in enumerate(assignment(gains) if taken else []):
        p, x = taken[i]
        if c < len(given) and gains[i][c] < 0:
            ops.append(("moved", p, given[c][0]))
            total += gains[i][c]
            at_home.add(c)
        else:
            ops.append(("removed", p, ""))
    return total, ops + [("added", q, "") for c, (q, _) in enumerate(given) if c not in at_home]
