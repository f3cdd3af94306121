"""An error-correcting chart parser over nested token sequences.

Grammars are EBNF texts; each nonterminal becomes a small transition network. Brackets are cut out beforehand: a bracketed
part is one token of its surroundings, a group, that grammars name by bracket and nonterminal, as `(Args` or `{Block`.
So sequences are short, and as tokens are classes rather than words, the same shapes come again and again: results are
kept by shape.

`cost` is the least number of edits (a token inserted, deleted or replaced by one of another class, at any depth) that
make a sequence derivable from a nonterminal. Sequences that parse are settled by a plain chart without error arcs. For
the others, disjoint parts that stand in no derivable sequence give a lower bound. While the number of edits tried is
near it, Earley's chart with error arcs is explored in order of cost (Knuth's generalization of Dijkstra's algorithm);
where more are needed, the costs of all spans are computed, shorter ones first, in arrays over the starts of spans. Both
are exact. A group costs 2 edits at most, as it can be deleted and another one inserted.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict

import numpy as np

_EBNF = re.compile(r"\s*(?:(?P<lit>'[^']+')|(?P<grp>[(\[{⟦](?=[A-Z])[A-Za-z]+)|(?P<name>[A-Za-z_]+)|(?P<op>[|?*+()]))")


class Grammar:
    """rules: one per line, `Name: alternatives`, with ? * + | and parentheses; literals in quotes; names that have no
    rule and begin with a small letter are token classes; rules without any definition match nothing."""

    def __init__(self, text: str):
        self.nets: dict[str, tuple[list[list[tuple[object, int]]], list[bool]]] = {}
        rules: dict[str, str] = {}
        for line in text.strip().split("\n"):
            if line.strip():
                name, _, body = line.partition(":")
                rules[name.strip()] = rules[name.strip()] + " | " + body if name.strip() in rules else body
        for name, body in rules.items():
            self.nets[name] = _merged(*_network(body, rules))
        self._firsts()

    def reversed(self) -> "Grammar":
        """Of the same language read from right to left (what is within groups stays as it is)."""
        g = Grammar("")
        for name, (arcs, final) in self.nets.items():
            back: list[list[tuple[object, int]]] = [[] for _ in range(len(arcs) + 1)]  # state s is s + 1 there, 0 the start
            for s, of in enumerate(arcs):
                for sym, t in of:
                    back[t + 1].append((sym, s + 1))
                    if final[t]:
                        back[0].append((sym, s + 1))
            g.nets[name] = _merged(back, [final[0], True, *([False] * (len(arcs) - 1))])
        g._firsts()
        return g

    def _firsts(self) -> None:
        """Terminals that a nonterminal can begin with, so that hopeless predictions are not made."""
        self.first: dict[str, set] = {}
        self.nullable: set[str] = set()
        for n in self.nets:
            self.first[n] = set()
        changed = True
        while changed:
            changed = False
            for n, (arcs, final) in self.nets.items():
                seen, todo = {0}, [0]
                got = set(self.first[n])
                null = final[0]
                while todo:
                    s = todo.pop()
                    null = null or final[s]
                    for sym, t in arcs[s]:
                        if sym in self.nets:
                            got |= self.first[sym]
                            if sym in self.nullable and t not in seen:
                                seen.add(t)
                                todo.append(t)
                        else:
                            got.add(sym)
                if got != self.first[n] or (null and n not in self.nullable):
                    self.first[n] = got
                    if null:
                        self.nullable.add(n)
                    changed = True


def _network(body: str, rules: dict[str, str]) -> tuple[list[list[tuple[object, int]]], list[bool]]:
    toks = []
    at = 0
    body = body.strip()
    while at < len(body):
        m = _EBNF.match(body, at)
        if not m:
            raise ValueError(f"grammar: {body[at:at + 30]}")
        if m["lit"]:
            toks.append(("sym", m["lit"][1:-1]))
        elif m["grp"]:
            toks.append(("sym", (m["grp"][0], m["grp"][1:])))
        elif m["name"]:
            known = m["name"] in rules or m["name"][0].islower()
            toks.append(("sym", m["name"] if known else None))
        else:
            toks.append(("op", m["op"]))
        at = m.end()
    arcs: list[list[tuple[object, int]]] = []

    def state() -> int:
        arcs.append([])
        return len(arcs) - 1

    pos = 0

    def alternatives() -> tuple[int, int]:
        nonlocal pos
        a, b = state(), state()
        while True:
            s, e = sequence()
            arcs[a].append((None, s))
            arcs[e].append((None, b))
            if pos < len(toks) and toks[pos] == ("op", "|"):
                pos += 1
            else:
                return a, b

    def sequence() -> tuple[int, int]:
        nonlocal pos
        a = now = state()
        while pos < len(toks) and toks[pos] not in (("op", "|"), ("op", ")")):
            kind, v = toks[pos]
            pos += 1
            if kind == "op":
                s, e = alternatives()
                pos += 1
            else:
                s, e = state(), state()
                if v is not None:
                    arcs[s].append((v, e))
            if pos < len(toks) and toks[pos][0] == "op" and toks[pos][1] in "?*+":
                q = toks[pos][1]
                pos += 1
                if q in "?*":
                    arcs[s].append((None, e))
                if q in "*+":
                    arcs[e].append((None, s))
                f = state()
                arcs[e].append((None, f))
                e = f
            arcs[now].append((None, s))
            now = e
        return a, now

    start, end = alternatives()
    close = []
    for s in range(len(arcs)):
        seen, todo = {s}, [s]
        while todo:
            for sym, t in arcs[todo.pop()]:
                if sym is None and t not in seen:
                    seen.add(t)
                    todo.append(t)
        close.append(seen)
    # without empty arcs: states keep their numbers, 0 is the start
    order = [start] + [s for s in range(len(arcs)) if s != start]
    number = {s: i for i, s in enumerate(order)}
    out = [[(sym, number[t]) for x in close[s] for sym, t in arcs[x] if sym is not None] for s in order]
    return out, [end in close[s] for s in order]


def _merged(arcs: list[list[tuple[object, int]]], final: list[bool]) -> tuple[list[list[tuple[object, int]]], list[bool]]:
    """The same network with states merged that the same sequences lead from to an end, 0 the start."""
    kind = [int(f) for f in final]
    while True:
        ids: dict[tuple, int] = {}
        new = [ids.setdefault((kind[s], frozenset((sym, kind[t]) for sym, t in arcs[s])), len(ids)) for s in range(len(arcs))]
        if len(ids) == len(set(kind)):
            break
        kind = new
    one = {kind[s]: s for s in reversed(range(len(arcs)))}  # a state of each kind
    number, order = {kind[0]: 0}, [kind[0]]
    out = []
    for k in order:
        row = {}
        for sym, t in arcs[one[k]]:
            if kind[t] not in number:
                number[kind[t]] = len(order)
                order.append(kind[t])
            row[sym, number[kind[t]]] = None
        out.append(list(row))
    return out, [final[one[k]] for k in order]


class Level:
    """The networks that a nonterminal leads to without entering a group, as arrays over states, arcs and nonterminals."""

    #: More than any cost, and twice that fits the narrow numbers.
    FAR = 16_000

    def __init__(self, g: Grammar, nt: str):
        self.names = [nt]
        for name in self.names:
            self.names += sorted({sym for of in g.nets[name][0] for sym, _ in of if isinstance(sym, str) and sym in g.nets} - set(self.names))
        of_name = {name: i for i, name in enumerate(self.names)}
        base = np.cumsum([0] + [len(g.nets[name][0]) for name in self.names])
        self.begins, self.states, n_names = base[:-1], int(base[-1]), len(self.names)
        calls, reads = [], []  # (target, source, nonterminal or terminal)
        for name, b in zip(self.names, base):
            for s, of in enumerate(g.nets[name][0]):
                for sym, t in of:
                    known = isinstance(sym, str) and sym in of_name
                    (calls if known else reads).append((int(b) + t, int(b) + s, of_name[sym] if known else sym))
        calls.sort(key=lambda x: x[:2])
        reads.sort(key=lambda x: x[:2])
        self.symbols = [x[2] for x in reads]
        self.read_to, self.read_from = _heads([x[0] for x in reads]), np.array([x[1] for x in reads], int)
        self.call_to, self.call_from, self.call_name = _heads([x[0] for x in calls]), np.array([x[1] for x in calls], int), np.array([x[2] for x in calls], int)
        targets = np.array([x[0] for x in calls], int)
        # what it costs to insert one's way from state to state, and all of a nonterminal
        final = np.concatenate([np.array(g.nets[name][1]) for name in self.names])
        whole = np.full(n_names, self.FAR)
        ways = np.full((self.states, self.states), self.FAR)
        np.fill_diagonal(ways, 0)
        for t, s, _ in reads:
            ways[s, t] = min(ways[s, t], 1)
        while True:
            for t, s, c in calls:
                ways[s, t] = min(ways[s, t], whole[c])
            for k in range(self.states):
                np.minimum(ways, ways[:, k, None] + ways[k], out=ways)
            to_end = np.where(final, ways, self.FAR).min(axis=1)
            if (to_end[self.begins] == whole).all():
                break
            whole = np.minimum(to_end[self.begins], self.FAR)
        self.whole, self.to_end = whole, to_end
        self.fresh = ways[np.repeat(self.begins, np.diff(base)), np.arange(self.states)]  # from the start of the network to the state
        t, s = np.nonzero(ways.T < self.FAR)
        self.way_to, self.way_from, self.way_cost = _heads(t.tolist()), s, ways[s, t]
        # what it costs to make a nonterminal of another one that it can contain, by insertions alone
        up = np.full((n_names, n_names), self.FAR)
        np.fill_diagonal(up, 0)
        owner = np.repeat(np.arange(n_names), np.diff(base))
        np.minimum.at(up, (owner[targets], self.call_name), self.fresh[self.call_from] + to_end[targets])
        for k in range(n_names):
            np.minimum(up, up[:, k, None] + up[k], out=up)
        self.up = np.minimum(up, self.FAR)


def _heads(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys the distinct ones, and where each begins."""
    return np.unique(np.array(keys, int), return_index=True)


class Parser:
    """Results by shape for one grammar. Groups are interned: a shape number stands for (bracket, contents)."""

    #: Shapes and results that a worker keeps before it starts afresh.
    KEEP = 400_000
    #: Edits beyond the lower bound that are searched for before all spans are computed.
    NEAR = 2

    def __init__(self, grammar: Grammar, classes, plain: frozenset[str]):
        """classes(token class) -> terminals it matches; plain: nonterminals whose sequences have no line ends."""
        self.g, self.classes, self.plain = grammar, classes, plain
        self.back = grammar.reversed()
        self.shape_of: dict[tuple, int] = {}
        self.shapes: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.zero: dict[tuple, bool] = {}
        self.terminals: dict[str, frozenset] = {}
        self.levels: dict[str, Level] = {}
        self.parents: dict[str, dict[str, list[tuple]]] = {}

    def intern(self, seq: tuple) -> int:
        n = self.shape_of.get(seq)
        if n is None:
            n = self.shape_of[seq] = len(self.shapes)
            self.shapes.append(seq)
        return n

    def fresh(self) -> bool:
        """Forgets everything once there is too much; call between files."""
        if len(self.shapes) + len(self.known) + len(self.zero) > self.KEEP:
            self.shape_of.clear()
            self.shapes.clear()
            self.known.clear()
            self.zero.clear()
        return True

    def _set(self, tok) -> frozenset:
        s = self.terminals.get(tok)
        if s is None:
            s = self.terminals[tok] = self.classes(tok)
        return s

    def contents(self, nt: str, shape: int) -> tuple:
        seq = self.shapes[shape]
        return tuple(t for t in seq if t != "NL") if nt in self.plain else seq

    def parses(self, nt: str, seq: tuple) -> bool:
        key = (nt, seq)
        r = self.zero.get(key)
        if r is None:
            r = self.zero[key] = self._chart(nt, seq)[0]
        return r

    def group_parses(self, sym: tuple, tok: tuple) -> bool:
        return tok[0] == sym[0] and self.parses(sym[1], self.contents(sym[1], tok[1]))

    def reach(self, nt: str, seq: tuple) -> int:
        """How far a prefix of the sequence can be parsed without edits: where the first error is."""
        return min(self._chart(nt, seq)[1], len(seq) - 1) if seq else 0

    def _chart(self, nt: str, seq: tuple, g: Grammar | None = None) -> tuple[bool, int]:
        """Whether the sequence parses, and the last position that a plain parse comes to."""
        g = g or self.g
        nets, first, nullable = g.nets, g.first, g.nullable
        n = len(seq)
        # waiting[i][nonterminal]: items that wait for it from position i
        waiting: list[dict] = [defaultdict(list) for _ in range(n + 1)]
        done: list[set] = [set() for _ in range(n + 1)]
        items: list[list] = [[] for _ in range(n + 1)]
        items[0].append((nt, 0, 0))
        done[0].add((nt, 0, 0))
        far = 0
        whole = False
        for i in range(n + 1):
            todo = items[i]
            if not todo:
                continue
            far = i
            tok = seq[i] if i < n else None
            sets = self._set(tok) if isinstance(tok, str) else frozenset()
            seen, wait = done[i], waiting[i]
            finished: set = set()  # nonterminals that are complete from i to i
            nxt, nseen = (items[i + 1], done[i + 1]) if i < n else (None, None)
            while todo:
                name, s, origin = item = todo.pop()
                arcs, final = nets[name]
                if final[s]:
                    if origin == i:
                        finished.add(name)
                    if name == nt and origin == 0 and i == n:
                        whole = True
                    for w, ws, wo in waiting[origin].get(name, ()):
                        x = (w, ws, wo)
                        if x not in seen:
                            seen.add(x)
                            todo.append(x)
                for sym, t in arcs[s]:
                    net = nets.get(sym) if isinstance(sym, str) else None
                    if net is not None:
                        ok = sym in nullable
                        if not ok and tok is not None:
                            f = first[sym]
                            ok = not sets.isdisjoint(f) if sets else any(isinstance(y, tuple) and y[0] == tok[0] for y in f)
                        if ok:
                            wait[sym].append((name, t, origin))
                            x = (sym, 0, i)
                            if x not in seen:
                                seen.add(x)
                                todo.append(x)
                            if sym in finished:
                                x = (name, t, origin)
                                if x not in seen:
                                    seen.add(x)
                                    todo.append(x)
                    elif tok is not None and (sym in sets if isinstance(sym, str) else (not isinstance(tok, str) and self.group_parses(sym, tok))):
                        x = (name, t, origin)
                        if x not in nseen:
                            nseen.add(x)
                            nxt.append(x)
        return whole, far

    def cost(self, nt: str, seq: tuple, limit: int | None = None) -> int:
        """Least edits; with a limit, limit + 1 if more are needed."""
        if self.parses(nt, seq):
            return 0
        key = (nt, seq)
        least, exact = self.known.get(key, (1, False))  # at least so many, and whether it is the cost
        if not exact and (limit is None or least <= limit):
            ahead = self._least_ahead(nt, seq)
            least = max(least, ahead[0])
            while not exact and (limit is None or least <= limit):  # few edits first: the fewer are allowed, the smaller the search
                if least - ahead[0] > self.NEAR:
                    least, exact = self._spans(nt, seq), True
                else:
                    found = self._search(nt, seq, least, ahead)
                    least, exact = found, found <= least
            self.known[key] = (least, exact)
        return least if limit is None else min(least, limit + 1)

    def _least_ahead(self, nt: str, seq: tuple) -> list[int]:
        """For each position a number of edits that must stand behind it: disjoint parts from there on that are in no derivable
        sequence, the last one at no end of any. Nothing before such a part or behind it mends it."""
        n = len(seq)
        back = seq[::-1]
        _, far = self._chart(nt, back, self.back)
        out = [0] * (n + 1)
        at = n
        while far < at:  # the part begins with the token that could not be read any more
            out[at - 1 - far] += 1
            at -= 1 + far
            far = self._factor(nt, back[n - at :])
        for i in range(n - 1, -1, -1):
            out[i] += out[i + 1]
        return out

    def _factor(self, nt: str, seq: tuple) -> int:
        """How many tokens of the reversed sequence can be read from anywhere within a derivable one."""
        nets, first, nullable = self.back.nets, self.back.first, self.back.nullable
        parents = self.parents.get(nt)
        if parents is None:  # of the networks that nt leads to: where a nonterminal goes on
            parents = self.parents[nt] = {nt: []}
            todo = [nt]
            for name in todo:
                for of in nets[name][0]:
                    for sym, t in of:
                        if isinstance(sym, str) and sym in nets:
                            if sym not in parents:
                                parents[sym] = []
                                todo.append(sym)
                            parents[sym].append((name, t, -1))
        n = len(seq)
        if not n:
            return 0
        matches = lambda sym, tok: sym in self._set(tok) if isinstance(sym, str) and isinstance(tok, str) else isinstance(sym, tuple) and isinstance(tok, tuple) and self.group_parses(sym, tok)
        nxt = {(name, t, -1) for name in parents for of in nets[name][0] for sym, t in of if not (isinstance(sym, str) and sym in nets) and matches(sym, seq[0])}
        waiting: list[dict] = [{}]
        for i in range(1, n + 1):
            if not nxt or i == n:
                return i if nxt else i - 1
            seen, todo, wait = nxt, list(nxt), defaultdict(list)
            nxt = set()
            waiting.append(wait)
            tok = seq[i]
            finished: set = set()
            while todo:
                name, s, origin = todo.pop()
                arcs, final = nets[name]
                new = []
                if final[s]:
                    if origin == i:
                        finished.add(name)
                    new += parents[name] if origin < 0 else waiting[origin].get(name, ())
                for sym, t in arcs[s]:
                    if isinstance(sym, str) and sym in nets:
                        if sym in nullable or self._begins(first[sym], tok):
                            wait[sym].append((name, t, origin))
                            new.append((sym, 0, i))
                            if sym in finished:
                                new.append((name, t, origin))
                    elif matches(sym, tok):
                        nxt.add((name, t, origin))
                for x in new:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
        return n

    def _begins(self, first: set, tok) -> bool:
        return not self._set(tok).isdisjoint(first) if isinstance(tok, str) else any(isinstance(y, tuple) and y[0] == tok[0] for y in first)

    def _spans(self, nt: str, seq: tuple) -> int:
        """Least edits, by those of all spans of the sequence: for each length the costs of items (states reached from the start
        of their networks) and of nonterminals, at all starts at once. Time grows with the cube of the length, room with its square."""
        g = self.levels.get(nt)
        if g is None:
            g = self.levels[nt] = Level(self.g, nt)
        n = len(seq)
        kind = np.int16 if n < Level.FAR // 2 else np.int32
        far = Level.FAR if kind == np.int16 else 1 << 29
        wide = lambda x: np.where(x >= Level.FAR, far, x).astype(kind)
        column = lambda x: wide(x)[:, None]
        of_token = {tok: [self._mismatch(sym, tok, far) for sym in g.symbols] for tok in set(seq)}
        misread = np.array([of_token[tok] for tok in seq], kind).reshape(n, len(g.symbols)).T.copy()
        callers, call_from = np.unique(g.call_from, return_inverse=True)
        fresh, to_end, way_cost, up, entered = column(g.fresh), column(g.to_end), column(g.way_cost), wide(g.up), column(g.fresh[g.call_from])
        now = np.broadcast_to(fresh, (g.states, n + 1))  # costs of items by state and start, for spans of the length at hand
        items, made = [now[callers]], [np.broadcast_to(column(g.whole), (len(g.names), n + 1))]
        for length in range(1, n + 1):
            starts = n + 1 - length
            new = now[:, :starts] + kind(1)  # a token deleted
            if g.symbols:
                to, heads = g.read_to
                read = np.minimum.reduceat(now[g.read_from, :starts] + misread[:, length - 1 :], heads)
                new[to] = np.minimum(new[to], read)
            if len(g.call_from):
                to, heads = g.call_to
                best = np.full((len(g.call_from), starts), far, kind)
                for m in range(1, length):
                    part = items[m][call_from, :starts]
                    part += made[length - m][g.call_name, m : m + starts]
                    np.minimum(best, part, out=best)
                new[to] = np.minimum(new[to], np.minimum.reduceat(best, heads))
            np.minimum(new, far, out=new)
            whole = np.minimum.reduceat(np.minimum(new + to_end, far), g.begins)
            done = np.full_like(whole, far)
            for b in range(len(g.names)):
                np.minimum(done, up[:, b, None] + whole[b], out=done)
            if len(g.call_from):
                new[to] = np.minimum(new[to], np.minimum.reduceat(entered + done[g.call_name], heads))
            to, heads = g.way_to
            now = np.full_like(new, far)
            now[to] = np.minimum(np.minimum.reduceat(new[g.way_from] + way_cost, heads), far)
            items.append(now[callers])
            made.append(done)
        return int(made[n][0, 0])

    def _mismatch(self, sym, tok, far: int) -> int:
        """Edits that make the token one of the terminal."""
        if isinstance(tok, str):
            return int(not (isinstance(sym, str) and sym in self._set(tok)))
        return self.cost(sym[1], self.contents(sym[1], tok[1]), 1) if isinstance(sym, tuple) and tok[0] == sym[0] else far

    def _viable(self, sym: str, tok) -> bool:
        """Whether a nonterminal can begin with the token, or be empty, without edits."""
        if sym in self.g.nullable:
            return True
        if tok is None:
            return False
        return self._begins(self.g.first[sym], tok)

    def _search(self, nt: str, seq: tuple, most: int, behind: list[int]) -> int:
        """Least edits, or most + 1. Positions from left to right, at each the items in order of their edits since the start.
        At each position the edits that must stand behind it are kept back.

        An item's own cost counts from its origin; `ahead` holds the least edits before that. What exceeds the limit
        together is dropped, and where no edit is left only what the next token allows goes on, so nothing is given up.
        """
        nets = self.g.nets
        n = len(seq)
        waiting: list[dict[str, list]] = [defaultdict(list) for _ in range(n + 1)]
        ahead: list[dict[str, int]] = [{} for _ in range(n + 1)]
        ahead[0][nt] = 0
        later: dict[tuple, int] = {(nt, 0, 0): 0}
        count = 0
        for i in range(n + 1):
            best, later = later, {}
            limit = most - behind[i]
            limit_later = most - behind[i + 1] if i < n else limit
            tok = seq[i] if i < n else None
            heap: list[tuple] = []
            for item, c in best.items():
                count += 1
                heap.append((ahead[item[2]][item[0]] + c, count, item))
            heapq.heapify(heap)
            settled: set = set()
            empty: dict[str, int] = {}  # nonterminals complete from i to i
            before, wait = ahead[i], waiting[i]

            def push(c: int, item: tuple) -> None:
                nonlocal count
                total = ahead[item[2]][item[0]] + c
                if total <= limit and c < best.get(item, limit + 1):
                    best[item] = c
                    count += 1
                    heapq.heappush(heap, (total, count, item))

            def push_later(c: int, item: tuple) -> None:
                if ahead[item[2]][item[0]] + c <= limit_later and c < later.get(item, limit_later + 1):
                    later[item] = c

            while heap:
                total, _, item = heapq.heappop(heap)
                if item in settled:
                    continue
                settled.add(item)
                c, room, room_later = best[item], limit - total, limit_later - total  # for insertions here, for edits of the next token
                name, s, origin = item
                arcs, final = nets[name]
                if final[s]:
                    if name == nt and origin == 0 and i == n:
                        return c
                    if origin == i:
                        empty[name] = min(c, empty.get(name, c))
                    for w, wc in waiting[origin].get(name, ()):
                        push(wc + c, w)
                if room_later and i < n:
                    push_later(c + 1, item)  # a token deleted
                for sym, t in arcs[s]:
                    if isinstance(sym, str) and sym in nets:
                        if not room_later and not self._viable(sym, tok):
                            continue
                        wait[sym].append(((name, t, origin), c))
                        if sym in empty:
                            push(c + empty[sym], (name, t, origin))
                        if sym not in before:
                            before[sym] = total
                            push(0, (sym, 0, i))
                    else:
                        if room:
                            push(c + 1, (name, t, origin))  # a token inserted
                        if i < n:
                            if isinstance(tok, str):
                                if isinstance(sym, str) and sym in self._set(tok):
                                    push_later(c, (name, t, origin))
                                elif room_later:
                                    push_later(c + 1, (name, t, origin))
                            elif isinstance(sym, tuple) and tok[0] == sym[0]:
                                if room_later:
                                    push_later(c + self.cost(sym[1], self.contents(sym[1], tok[1]), 1), (name, t, origin))
                                elif self.group_parses(sym, tok):
                                    push_later(c, (name, t, origin))
        return most + 1
