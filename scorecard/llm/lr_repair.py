"""Least-cost repair of a role sequence by a generalised LR parse.

A small LR table is built from the role grammar. A parse keeps a graph-structured
stack: nodes are a state and the node below, made once each, so stacks share
what they have in common. For each row every stack may keep it, rerole it, or
delete it, and insert a turn before it; stacks with equal tops merge, the
least (cost, audit) stays. The grammar is left-recursive and regular: what may
follow depends on the top state alone, so merging by tops loses nothing.

The audit is the string of edit initials. Two audits of one cost and of equally
many rows never are a beginning of each other, since the longer one would have more
inserts and cost more; so the least prefix stays the least whatever follows. That
lets a parse carry ranks instead of strings, and lets long conversations be parsed in
blocks: a block is parsed from every top, and blocks are chained afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

# The grammar of role initials, and what edits cost.
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("turns",)),
    ("conversation", ("s", "turns")),
    ("turns", ("turns", "exchange")),
    ("turns", ("exchange",)),
    ("exchange", ("u", "a")),
)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# What a row's fault does: nothing, forces a delete, or costs more if it stays.
SOUND, DOOMED, TRUNCATED = 0, 1, 2
ROLES = {"u": "user", "a": "assistant"}
END = "$"


class Node:
    """A stack: its top state and the stack below."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


class Table:
    """An SLR table of a grammar, and stacks that share nodes."""

    def __init__(self, grammar: tuple = GRAMMAR):
        start = grammar[0][0]
        self.rules = (("", (start,)), *grammar)
        heads = {head for head, _ in self.rules}
        follow = self._follow(heads, start)
        first = self._closed({(0, 0)}, heads)
        states, self.goto, self.reduce = [first], {}, {}
        for number, items in enumerate(states):
            symbols = sorted({s for s in map(self._next, items) if s is not None})
            for symbol in symbols:
                moved = self._closed({(r, d + 1) for r, d in items if self._next((r, d)) == symbol}, heads)
                if moved not in states:
                    states.append(moved)
                self.goto[number, symbol] = states.index(moved)
            for rule, dot in items:
                head, body = self.rules[rule]
                if dot == len(body):
                    for symbol in follow[head]:
                        if self.reduce.setdefault((number, symbol), rule) != rule:
                            raise ValueError("the grammar is not SLR(1)")
        self.nodes: dict[tuple[int, Node | None], Node] = {}
        self.known: dict[tuple[Node, str], Node | None] = {}
        self.bottom = self._node(0, None)

    def _next(self, item: tuple[int, int]) -> str | None:
        rule, dot = item
        body = self.rules[rule][1]
        return body[dot] if dot < len(body) else None

    def _closed(self, items: set, heads: set) -> frozenset:
        items = set(items)
        waiting = list(items)
        while waiting:
            symbol = self._next(waiting.pop())
            if symbol in heads:
                new = {(n, 0) for n, (head, _) in enumerate(self.rules) if head == symbol} - items
                items |= new
                waiting += new
        return frozenset(items)

    def _follow(self, heads: set, start: str) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {h: set() for h in heads}
        follow: dict[str, set[str]] = {h: set() for h in heads} | {"": {END}, start: {END}}
        before = None
        size = lambda: (len(empty), *[len(s) for s in (*first.values(), *follow.values())])
        while before != size():
            before = size()
            for head, body in self.rules:
                if all(s in empty for s in body):
                    empty.add(head)
                for symbol in body:
                    first[head] |= first.get(symbol, {symbol})
                    if symbol not in empty:
                        break
                after = follow[head]
                for symbol in reversed(body):
                    if symbol in heads:
                        follow[symbol] |= after
                        after = after | first[symbol] if symbol in empty else first[symbol]
                    else:
                        after = {symbol}
        return follow

    def _node(self, state: int, below: Node | None) -> Node:
        key = (state, below)
        if key not in self.nodes:
            self.nodes[key] = Node(state, below)
        return self.nodes[key]

    def _reduced(self, stack: Node, symbol: str) -> Node:
        """All reductions that ``symbol`` calls for, but not the last one of all."""
        while (rule := self.reduce.get((stack.state, symbol))) is not None and rule:
            head, body = self.rules[rule]
            for _ in body:
                stack = stack.below
            stack = self._node(self.goto[stack.state, head], stack)
        return stack

    def shift(self, stack: Node, symbol: str) -> Node | None:
        """The stack after ``symbol``, or None where it may not come."""
        key = (stack, symbol)
        if key not in self.known:
            reduced = self._reduced(stack, symbol)
            state = self.goto.get((reduced.state, symbol))
            self.known[key] = None if state is None else self._node(state, reduced)
        return self.known[key]

    def accepts(self, stack: Node) -> bool:
        reduced = self._reduced(stack, END)
        return self.reduce.get((reduced.state, END)) == 0

    def tops(self) -> list[Node]:
        """One stack for each top state that any sequence of roles can have."""
        found = {self.bottom.state: self.bottom}
        waiting = [self.bottom]
        while waiting:
            stack = waiting.pop(0)
            for symbol in "sua":
                moved = self.shift(stack, symbol)
                if moved is not None and moved.state not in found:
                    found[moved.state] = moved
                    waiting.append(moved)
        return [found[state] for state in sorted(found)]


TABLE = Table()
TOPS = {stack.state: stack for stack in TABLE.tops()}
FIRST = TABLE.bottom.state

# cost, rank of the parse it comes from, the edits since, its number
Parse = tuple[int, int, str, int]


def _merge(into: dict[int, tuple[Parse, Node]], parse: Parse, stack: Node) -> bool:
    held = into.get(stack.state)
    if held is None or parse[:3] < held[0][:3]:
        into[stack.state] = (parse, stack)
        return True
    return False


def with_inserts(front: dict[int, tuple[Parse, Node]]) -> dict[int, tuple[Parse, Node]]:
    """The stacks that inserted turns reach, too."""
    reached = dict(front)
    waiting = list(front.values())
    while waiting:
        (cost, rank, edits, number), stack = waiting.pop()
        for symbol in ROLES:
            moved = TABLE.shift(stack, symbol)
            if moved is not None:
                parse = (cost + COSTS[INSERT], rank, edits + INSERT, number)
                if _merge(reached, parse, moved):
                    waiting.append((parse, moved))
    return reached


def _after_row(front: dict[int, tuple[Parse, Node]], role: str, fault: int) -> dict[int, tuple[Parse, Node]]:
    after: dict[int, tuple[Parse, Node]] = {}
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    for (cost, rank, edits, number), stack in with_inserts(front).values():
        _merge(after, (cost + COSTS[DELETE], rank, edits + DELETE, number), stack)
        if fault == DOOMED:
            continue
        kept = TABLE.shift(stack, role)
        if kept is not None:
            _merge(after, (cost + COSTS[KEEP] + more, rank, edits + KEEP, number), kept)
        for symbol in ROLES:
            moved = TABLE.shift(stack, symbol)
            if moved is not None:
                parse = (cost + COSTS[REROLE] + more, rank, edits + REROLE, number)
                _merge(after, parse, moved)
    return after


def parse_block(top: int, rows: Iterable[tuple[str, int]]) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) of leading from a top state over rows to each top state."""
    front: dict[int, tuple[Parse, Node]] = {top: ((0, 0, "", 0), TOPS[top])}
    steps: list[list[tuple[int, str]]] = []
    for role, fault in rows:
        after = _after_row(front, role, fault)
        # Ranks order the audits so far; numbers lead back to what they come from.
        order = sorted({parse[1:3] for parse, _ in after.values()})
        ranks = {key: n for n, key in enumerate(order)}
        steps.append([(parse[3], parse[2]) for parse, _ in after.values()])
        front = {
            state: ((parse[0], ranks[parse[1:3]], "", number), stack)
            for number, (state, (parse, stack)) in enumerate(after.items())
        }
    found = {}
    for state, (parse, _) in front.items():
        parts, number = [], parse[3]
        for step in reversed(steps):
            number, edits = step[number]
            parts.append(edits)
        found[state] = (parse[0], "".join(reversed(parts)))
    return found


class Chain:
    """Blocks put together in order; the audits of the least parses, in parts."""

    def __init__(self) -> None:
        self.front: dict[int, tuple[int, int, tuple | None]] = {FIRST: (0, 0, None)}

    def add(self, block: dict[int, dict[int, tuple[int, str]]]) -> None:
        """``block`` has for each top state what ``parse_block`` finds from it."""
        after: dict[int, tuple[int, int, str, tuple | None]] = {}
        for top, (cost, rank, parts) in self.front.items():
            for state, (more, audit) in block.get(top, {}).items():
                parse = (cost + more, rank, audit, parts)
                if state not in after or parse[:3] < after[state][:3]:
                    after[state] = parse
        ranks = {key: n for n, key in enumerate(sorted({p[1:3] for p in after.values()}))}
        self.front = {
            state: (cost, ranks[rank, audit], (parts, audit))
            for state, (cost, rank, audit, parts) in after.items()
        }

    def end(self) -> tuple[int, list[str]]:
        """Least cost, and the audit in one part for each block and one for its end."""
        front = {
            state: ((cost, rank, "", state), TOPS[state]) for state, (cost, rank, _) in self.front.items()
        }
        ends = [p for p, stack in with_inserts(front).values() if TABLE.accepts(stack)]
        cost, _, edits, state = min(ends, key=lambda p: p[:3])
        audits, parts = [edits], self.front[state][2]
        while parts is not None:
            parts, audit = parts
            audits.append(audit)
        return cost, audits[::-1]


class Repair:
    """Applies an audit: says for each edit what turn comes out."""

    def __init__(self) -> None:
        self.stack = TABLE.bottom

    def turn(self, edit: str, role: str = "") -> str | None:
        """The role that an edit puts out, None for a deleted row."""
        if edit == DELETE:
            return None
        symbols = role[:1] if edit == KEEP else ROLES
        for symbol in symbols:
            moved = TABLE.shift(self.stack, symbol)
            if moved is not None:
                self.stack = moved
                return role if edit == KEEP else ROLES[symbol]
        raise ValueError(f"edit {edit} does not fit here")


def edits_of(audit: str) -> Iterator[tuple[int, str]]:
    """For each row, the number of inserts before it and its edit; then the last inserts."""
    inserts = 0
    for edit in audit:
        if edit == INSERT:
            inserts += 1
        else:
            yield inserts, edit
            inserts = 0
    yield inserts, ""


def repaired(rows: Iterable[tuple[str, str]], audit: str, write: Callable[[str, str], None]) -> None:
    """Write the (role, text) turns that an audit makes of rows."""
    repair, edits = Repair(), edits_of(audit)
    rows = iter(rows)
    for inserts, edit in edits:
        for _ in range(inserts):
            write(repair.turn(INSERT), "")
        if edit:
            role, text = next(rows)
            out = repair.turn(edit, role)
            if out is not None:
                write(out, text)
