"""Byte regexes to one minimised automaton: subset construction, Moore's refinement, table scan.

The grammar is what secret rules need: literals, ``\\xHH`` and escaped
characters, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{n}``, ``{n,}``,
``{n,m}``. Patterns are ASCII; no other byte ever matches.
"""

from __future__ import annotations

from itertools import count

import numpy as np

#: Texts are cut for scanning about every so many bytes, behind a byte that resets the automaton.
LANE = 512


def parse(pattern: str, fold: bool = False):
    """The pattern as a tree: a byte set, or ("cat" | "alt", parts), or ("rep", part, low, high)."""
    at = 0

    def code() -> int:
        nonlocal at
        if pattern[at] != "\\":
            at += 1
            return ord(pattern[at - 1])
        if pattern[at + 1] == "x":
            at += 4
            return int(pattern[at - 2:at], 16)
        at += 2
        return ord(pattern[at - 1])

    def folded(codes) -> frozenset:
        return frozenset(ord(x) for c in codes for x in ({chr(c).lower(), chr(c).upper()} if fold else {chr(c)}))

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            out = alt()
            at += 1
            return out
        if pattern[at] != "[":
            return folded([code()])
        at += 1
        codes: set[int] = set()
        while pattern[at] != "]":
            low = code()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                codes.update(range(low, code() + 1))
            else:
                codes.add(low)
        at += 1
        return folded(codes)

    def term():
        nonlocal at
        out = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at + 1:end].partition(",")
                at = end + 1
                out = ("rep", out, int(low), (int(high) if high else None) if comma else int(low))
            else:
                out = ("rep", out, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]])
                at += 1
        return out

    def cat():
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            parts.append(term())
        return ("cat", parts)

    def alt():
        nonlocal at
        parts = [cat()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            parts.append(cat())
        return ("alt", parts)

    return alt()


def mirrored(node):
    if isinstance(node, frozenset):
        return node
    if node[0] == "rep":
        return ("rep", mirrored(node[1]), *node[2:])
    return (node[0], [mirrored(x) for x in (node[1] if node[0] == "alt" else node[1][::-1])])


class Automaton:
    """Minimised automaton of several patterns.

    ``table[state, class]`` is the next state, ``classes[byte]`` the byte's
    class, ``accepts[state]`` a bit for each pattern that ends there. State 0
    is the start. ``anywhere``: matches may start at any byte.
    """

    def __init__(self, trees: list, anywhere: bool = True):
        step: dict[int, list[tuple[frozenset, int]]] = {}
        free: dict[int, list[int]] = {}
        fresh = count()

        def build(node, entry: int) -> int:
            """Adds the node's states behind ``entry``; the state where it ends."""
            if isinstance(node, frozenset):
                out = next(fresh)
                step.setdefault(entry, []).append((node, out))
                return out
            if node[0] == "cat":
                for part in node[1]:
                    entry = build(part, entry)
                return entry
            if node[0] == "alt":
                out = next(fresh)
                for part in node[1]:
                    free.setdefault(build(part, entry), []).append(out)
                return out
            _, part, low, high = node
            for _ in range(low):
                entry = build(part, entry)
            out = next(fresh)
            free.setdefault(entry, []).append(out)
            if high is None:
                loop = next(fresh)
                free.setdefault(entry, []).append(loop)
                free.setdefault(build(part, loop), []).extend([loop, out])
            else:
                for _ in range(high - low):
                    entry = build(part, entry)
                    free.setdefault(entry, []).append(out)
            return out

        def closed(states) -> frozenset:
            seen, todo = set(states), list(states)
            while todo:
                for x in free.get(todo.pop(), ()):
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            return frozenset(seen)

        root = next(fresh)
        ends = {}
        for bit, tree in enumerate(trees):
            entry = next(fresh)
            free.setdefault(root, []).append(entry)
            ends[build(tree, entry)] = 1 << bit
        # Bytes that are in the same sets behave alike: one of each kind is followed.
        sets = sorted({x for arcs in step.values() for x, _ in arcs}, key=sorted)
        kinds, kind = np.unique([[c in x for x in sets] for c in range(256)], axis=0, return_inverse=True)
        kind = kind.reshape(-1)
        member = {x: np.flatnonzero(kinds[:, i]).tolist() for i, x in enumerate(sets)}
        start = closed([root])
        ids, rows, todo = {start: 0}, [], [start]
        for state in todo:
            row: dict[int, set[int]] = {}
            for x in state:
                for codes, to in step.get(x, ()):
                    for c in member[codes]:
                        row.setdefault(c, set()).add(to)
            nexts = np.zeros(len(kinds), np.int32)
            for c in range(len(kinds)):
                to = closed(row.get(c, ()))
                if anywhere:
                    to |= start
                if to not in ids:
                    ids[to] = len(todo)
                    todo.append(to)
                nexts[c] = ids[to]
            rows.append(nexts)
        table = np.array(rows)
        accepts = np.array([sum({ends[x] for x in s if x in ends}) for s in todo], np.int64)
        # Moore: states stay together while they accept alike and go to the same blocks.
        block = np.unique(accepts, return_inverse=True)[1]
        while True:
            key = np.column_stack([block, block[table]])
            new = np.unique(key, axis=0, return_inverse=True)[1].reshape(-1)
            if new.max() == block.max():
                break
            block = new
        order = np.full(block.max() + 1, -1)
        for old, b in enumerate(block):  # number blocks as met, so the start is 0
            if order[b] < 0:
                order[b] = (order >= 0).sum()
        block = order[block]
        first = np.unique(block, return_index=True)[1]
        table, self.accepts = block[table[first]], accepts[first]
        columns, classes = np.unique(table, axis=1, return_inverse=True)
        self.classes = classes.reshape(-1)[kind].astype(np.uint8)
        self.table = np.ascontiguousarray(columns, np.int32)
        #: Bytes that lead every state back to the start.
        self.resets = (self.table == 0).all(0)[self.classes] if anywhere else np.zeros(256, bool)
        #: States from which nothing is accepted any more.
        alive = self.accepts != 0
        while True:
            more = alive | alive[self.table].any(1)
            if (more == alive).all():
                break
            alive = more
        self.dead = ~alive

    def ends(self, data: np.ndarray) -> np.ndarray:
        """For each byte the bits of the patterns that match up to it: one pass, many lanes in step.

        Lanes are cut behind bytes that reset the automaton, so every lane
        starts in state 0; a stretch without such a byte stays one lane.
        """
        out = np.zeros(len(data), np.int64)
        cuts = np.flatnonzero(self.resets[data]) + 1
        if len(cuts):
            cuts = np.unique(cuts[np.minimum(np.searchsorted(cuts, np.arange(LANE, len(data), LANE)), len(cuts) - 1)])
        starts = np.concatenate([[0], cuts[cuts < len(data)]]).astype(np.int64)
        size = np.diff(np.append(starts, len(data)))
        by = np.argsort(-size, kind="stable")
        starts, size = starts[by], size[by]
        width, flat = self.table.shape[1], self.table.ravel()
        cls = self.classes[data]
        at, state = starts.copy(), np.zeros(len(starts), np.int32)
        for n in np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left"):
            state = flat[state[:n] * width + cls[at[:n]]]
            out[at[:n]] = self.accepts[state]
            at = at[:n] + 1
        return out
