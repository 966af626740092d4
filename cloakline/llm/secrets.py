"""Secret scan: all rules in one minimised automaton, one pass over the bytes.

The rules' regexes are compiled together by subset construction and
minimisation; the scan marks where each rule's matches end. A match's start
comes from the rule's mirrored automaton, run backwards from that end. Matches
are the leftmost ones that don't overlap within a rule, each as long as can be;
those that fail the rule's length are dropped afterwards.

Every rule ends in a repeated class or in fixed text, so a match is longest
where the rule stops accepting. Null and empty texts have no span. Rows are
scanned one by one, so repeated rows and ties need no rule; extra columns are
kept.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakline.llm.automata import Automaton, mirrored, parse
from cloakline.llm.common import utf8

#: Bytes scanned at once.
PIECE = 16 << 20
SPANS = "array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # of group 2, else of the whole match
    fold: bool = False


# The kinds, their patterns and least lengths; base kinds first.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)
RULES = BASE + MORE


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        trees = [parse(r.pattern, r.fold) for r in rules]
        self.forward = Automaton(trees)
        if not self.forward.resets[0x0A]:
            raise ValueError("a rule matches across lines")
        self.back = [Automaton([mirrored(t)], anywhere=False) for t in trees]
        self.check = [re.compile(r.pattern.encode(), re.I if r.fold else 0) for r in rules]

    def start(self, k: int, data: bytes, low: int, end: int) -> int:
        """The leftmost start, from ``low`` on, of a match of rule ``k`` that ends at ``end``; -1 if none."""
        a = self.back[k]
        state, found = 0, -1
        for at in range(end - 1, low - 1, -1):
            state = a.table[state, a.classes[data[at]]]
            if a.dead[state]:
                break
            if a.accepts[state]:
                found = at
        return found

    def passes(self, k: int, found: bytes) -> bool:
        m = self.check[k].fullmatch(found)
        return len(m[2] if m.re.groups > 1 else found) >= self.rules[k].least

    def scan(self, texts: list[bytes]) -> list[list[dict]]:
        """Spans of each text in code points, by start and then in the order of the rules."""
        out: list[list[dict]] = []
        at = 0
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and (not part or size + len(texts[at]) < PIECE):
                part.append(texts[at])
                size += len(texts[at]) + 1
                at += 1
            out += self._scan(part)
        return out

    def _scan(self, texts: list[bytes]) -> list[list[dict]]:
        data = b"\n".join([*texts, b""])
        bits = self.forward.ends(np.frombuffer(data, np.uint8))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        fell = bits[:-1] & ~bits[1:]  # the data end in a reset byte
        where = np.flatnonzero(fell)
        owner = np.searchsorted(begins, where, "right") - 1
        out: list[list[tuple]] = [[] for _ in texts]
        last: dict[tuple[int, int], int] = {}
        for p, i, b in zip(where.tolist(), owner.tolist(), fell[where].tolist()):
            for k in range(len(self.rules)):
                if b >> k & 1:
                    low = last.get((i, k), int(begins[i]))
                    s = self.start(k, data, low, p + 1)
                    if s < 0:
                        continue
                    last[i, k] = p + 1
                    if self.passes(k, data[s:p + 1]):
                        out[i].append((s - int(begins[i]), k, p + 1 - int(begins[i])))
        return [self._points(t, sorted(x)) for t, x in zip(texts, out)]

    def _points(self, text: bytes, spans: list[tuple]) -> list[dict]:
        """Byte offsets to code points: bytes that don't continue a character are counted."""
        if not spans:
            return []
        if text.isascii():
            def point(x):
                return x
        else:
            lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])

            def point(x):
                return int(lead[x])
        return [{"kind": self.rules[k].kind, "start": point(s), "end": point(e)} for s, k, e in spans]


def find_secrets(docs: DataFrame, out: str = "spans", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``out``: an array of ``(kind, start, end)``; every other column untouched."""
    scanner = Scanner(rules)

    def scan(text: pd.Series) -> pd.Series:
        return pd.Series(scanner.scan([bytes(t) for t in text]))

    return docs.withColumn(out, F.pandas_udf(scan, SPANS)(utf8("text")))


def listing(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
