"""Secret scans by patterns, and by probabilistic automata inferred from the credentials that patterns label.

Credentials found by the patterns label a sample: ``TRAINING`` distinct values of each kind, those with the least hash,
so the sample is bounded and does not depend on the order of rows. From a kind's sample a prefix tree is built over
character classes, and states whose futures do not differ significantly (Hoeffding bounds) are merged, as ALERGIA does.
The automaton gives every string a probability. A sample of ordinary long words of the same corpus gives a background
automaton the same way. Every long token of every text is scored: by how much likelier, per character, the best
credential automaton makes it than the background. Tokens above ``LEAST_SCORE`` are spans of kind ``format``.

Patterns of a kind are found from the left without overlap; matches that fail their length are dropped after that.

Defined results: null and empty texts have no span; rows repeated in full and ties are judged row by row; a corpus
without labelled credentials has pattern spans only; an empty table gives an empty result; other columns are ignored.
"""

import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.texts import add_columns, col
from aeroband.session import written_once

# Fixed patterns: kind, pattern, the group that is the credential, and its least length.
PATTERNS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
COMPILED = [
    (kind, re.compile(pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)), group, least)
    for kind, pattern, group, least in PATTERNS
]
# Runs of digits and a-f of the least length, which most texts have none of.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "secret", "token", "api")  # every assignment has one of them
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
FORMAT = "format"
TRAINING = 300  # labelled values of a kind, and background words
ALPHA = 0.05
LEAST_SCORE = 1.0  # natural logarithm per character
CLASSES = [("abcdef", "x"), ("ghijklmnopqrstuvwxyz", "l"), ("ABCDEF", "X"), ("GHIJKLMNOPQRSTUVWXYZ", "U"), ("0123456789", "d"),
           ("+/", "+"), ("_-", "_"), (".", "."), ("=", "=")]
CLASS_OF = str.maketrans({c: name for chars, name in CLASSES for c in chars})
WIDTH = {name: len(chars) for chars, name in CLASSES}


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, credential) of the pattern matches, in order."""
    found = []
    lower = text.lower()
    for place, (kind, pattern, group, least) in enumerate(COMPILED):
        if kind == "assign" and not any(name in lower for name in NAMES):
            continue
        # A match of the greedy hex pattern is a maximal run, so runs that are long enough are found directly.
        for match in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(match.group(group)) >= least:
                found.append((match.start(), place, match.end(), match.group(group)))
    return sorted(found)


class Automaton:
    """A deterministic automaton with counts: how often each state is passed, left by a class, or ended in."""

    def __init__(self, strings: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [defaultdict(int)]
        self.ends = [0]
        self.passes = [0]
        for string in strings:
            state = 0
            self.passes[0] += 1
            for c in string:
                self.taken[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.taken.append(defaultdict(int))
                    self.ends.append(0)
                    self.passes.append(0)
                state = self.next[state][c]
                self.passes[state] += 1
            self.ends[state] += 1

    def _differ(self, n1: int, of1: int, n2: int, of2: int, bound: float) -> bool:
        return abs(n1 / of1 - n2 / of2) > bound * (of1 ** -0.5 + of2 ** -0.5)

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether the futures of two states, followed together, nowhere differ beyond the bound."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            if not self.passes[a] or not self.passes[b]:
                continue
            if self._differ(self.ends[a], self.passes[a], self.ends[b], self.passes[b], bound):
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                n, m = self.taken[a].get(c, 0), self.taken[b].get(c, 0)
                if self._differ(n, self.passes[a], m, self.passes[b], bound):
                    return False
                if n and m and self.next[a][c] != self.next[b][c]:
                    waiting.append((self.next[a][c], self.next[b][c]))
        return True

    def merge(self, red: int, blue: int) -> None:
        """Fold the tree below ``blue`` into ``red``; its one incoming edge is turned by the caller."""
        waiting = [(red, blue)]
        while waiting:
            a, b = waiting.pop()
            self.passes[a] += self.passes[b]
            self.ends[a] += self.ends[b]
            for c, n in self.taken[b].items():
                self.taken[a][c] += n
                if c in self.next[a]:
                    waiting.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def generalise(self, alpha: float = ALPHA) -> "Automaton":
        """Merge states, each candidate (a child of a settled state) with the first settled state it agrees with."""
        red = [0]
        settled = {0}
        while True:
            edges = [(self.passes[s], -r, c, r, s) for r in red for c, s in self.next[r].items() if s not in settled]
            if not edges:
                return self
            _, _, c, source, blue = max(edges)
            partner = next((r for r in red if self.compatible(r, blue, alpha)), None)
            if partner is None:
                red.append(blue)
                settled.add(blue)
            else:
                self.next[source][c] = partner
                self.merge(partner, blue)

    def score(self, classes: str) -> float:
        """Logarithm of the probability of the string's characters, those of a class being equally likely.

        The end does not count, so that length alone makes nothing likely. What was never seen has one count in all.
        """
        state, total = 0, 0.0
        for c in classes:
            n = self.taken[state].get(c, 0) if state is not None else 0
            of = self.passes[state] if state is not None else 1
            total += math.log((n + 1 / len(CLASSES)) / (of + 1)) - math.log(WIDTH[c])
            state = self.next[state].get(c) if n else state
        return total


class Formats:
    """Automata of credential kinds and the background, and their score of a token."""

    def __init__(self, samples: dict[str, list[str]], background: list[str]):
        self.kinds = [Automaton([v.translate(CLASS_OF) for v in values]).generalise() for values in samples.values() if values]
        self.background = Automaton([v.translate(CLASS_OF) for v in background]).generalise()

    def score(self, token: str) -> float:
        classes = token.translate(CLASS_OF)
        if not self.kinds:
            return -math.inf
        return (max(kind.score(classes) for kind in self.kinds) - self.background.score(classes)) / len(token)


def labelled(docs: DataFrame) -> DataFrame:
    """``kind`` and ``value`` of credentials found by patterns, and of ordinary long tokens (kind ``background``)."""
    item = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())]))

    def find(data):
        text = data.decode()
        spans = base_spans(text)
        found = {(PATTERNS[place][0], value) for _, place, _, value in spans}
        taken = {i for start, _, end, _ in spans for i in (start, end - 1)}
        found |= {("background", m.group()) for m in TOKEN.finditer(text) if not taken & {*range(m.start(), m.end())}}
        return ([{"kind": kind, "value": value} for kind, value in sorted(found)],)

    rows = add_columns(docs.select(col("text").alias("text")), "text", T.StructType([T.StructField("found", item)]), find)
    return rows.select(F.explode("found").alias("f")).select("f.kind", "f.value").distinct()


def learned(docs: DataFrame, training: int = TRAINING) -> Formats:
    """The automata; the driver sees at most ``training`` values of each kind."""
    values = written_once(labelled(docs))
    samples = {
        kind: [r.value for r in values.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(training).collect()]
        for kind in [kind for kind, *_ in PATTERNS] + ["background"]
    }
    return Formats({k: v for k, v in samples.items() if k != "background"}, samples["background"])


def scanned(docs: DataFrame, training: int = TRAINING) -> DataFrame:
    """Per document: ``doc_id`` and ``spans``, an array of (``kind``, ``start``, ``end``) in code points, in order."""
    formats = learned(docs, training)
    names = [kind for kind, *_ in PATTERNS] + [FORMAT]
    span = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())
    ])

    def find(data):
        text = data.decode()
        spans = [(start, place, end) for start, place, end, _ in base_spans(text)]
        for m in TOKEN.finditer(text):
            if all(end <= m.start() or start >= m.end() for start, _, end in spans) and formats.score(m.group()) >= LEAST_SCORE:
                spans.append((m.start(), len(PATTERNS), m.end()))
        return ([{"kind": names[place], "start": start, "end": end} for start, place, end in sorted(spans)],)

    rows = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    return add_columns(rows, "text", T.StructType([T.StructField("spans", T.ArrayType(span))]), find)


def joined(spans, kinds=None):
    """``kind:start:end`` of the spans, joined by commas; of the given kinds only."""
    some = F.filter(spans, lambda s: s.kind.isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
