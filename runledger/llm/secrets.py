"""Secrets found by patterns and by the formats of known credentials.

The patterns give the base spans, which always stand. Formats are inferred from the
credentials that the patterns find: their characters, as classes, form a prefix tree, and
states whose continuations do not differ significantly (by Hoeffding's bound) are merged, which
leaves a probabilistic automaton for each kind. Every other run of key characters in every text
is scored by each automaton, against how ordinary words continue, and joins as a span of kind
``format`` if it is as likely as the known credentials are.

Learning reads at most ``MAX_TRAINING`` documents (by hash of id) that look like they hold a
credential, and uses at most ``MAX_CREDENTIALS`` of their distinct credentials of a kind (by hash
of the value, so that all starts take part); tasks take them out of the texts, so that only values
and counts of classes reach the driver. Scoring covers all runs of all texts: a short one has to be
the likelier for each of its characters.

Defined cases: a null or empty text has no spans; repeated rows give the same spans; an empty
table gives no rows, and without credentials to learn from, base spans only.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm import spans
from runledger.llm.common import slices, stored
from runledger.llm.spans import Span

KINDS = ("assign", "access", "hex", "format")

#: Documents that learning reads at most, and credentials of a kind that it uses.
MAX_TRAINING, MAX_CREDENTIALS = 2_000, 5_000

#: Significance of a difference between two states; length of an assigned value, and so of a candidate.
ALPHA, LEAST_LENGTH = 0.01, 6

#: How much likelier (nats a character, and nats in all) a candidate must be as a credential than as words.
LEAST_GAIN, LEAST_EVIDENCE = 1.0, 16.0

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# A whole run of key characters that holds a digit.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z+/_.=-]*+[0-9][A-Za-z0-9+/_.=-]*+")
_LETTER = re.compile(r"[A-Za-z]")
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, in order of start, then kind."""
    found = []
    if "=" in text or ":" in text:
        lower = text.lower()
        if any(name in lower for name in _NAMES):
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def credentials(text: str) -> list[tuple[int, str]]:
    """(kind, value) of what the patterns find; of an assignment, what is assigned."""
    return [(k, _ASSIGN.fullmatch(text, b, e)[2] if k == 0 else text[b:e]) for b, k, e in base_spans(text)]


def _class(c: str) -> str:
    if c.isdecimal():
        return "0"
    if c.islower():
        return "a" if c <= "f" else "g"
    if c.isupper():
        return "A" if c <= "F" else "G"
    return c


_CLASSES = {chr(i): _class(chr(i)) for i in range(128)}


def classes(value: str) -> list[str]:
    return [_CLASSES.get(c, "?") for c in value]


class Automaton:
    """A probabilistic automaton: counts of each state's visits, ends and steps by class."""

    def __init__(self, values: Iterable[str]):
        self.visits, self.ends = [0], [0]
        self.steps: list[dict[str, int]] = [{}]
        self.next: list[dict[str, int]] = [{}]
        for value in values:
            state = 0
            self.visits[0] += 1
            for c in classes(value):
                self.steps[state][c] = self.steps[state].get(c, 0) + 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.steps.append({})
                    self.next.append({})
                state = self.next[state][c]
                self.visits[state] += 1
            self.ends[state] += 1
        self._merge_states()

    def _merge_states(self) -> None:
        """In order of distance from the root, a state joins the first settled one like it."""
        settled = [0]
        while True:
            border = sorted(
                (-self.visits[t], i, c, t) for i, s in enumerate(settled) for c, t in self.next[s].items() if t not in settled
            )
            if not border:
                return
            _, i, c, state = border[0]
            for like in settled:
                if self._alike(like, state):
                    self.next[settled[i]][c] = like
                    self._fold(like, state)
                    break
            else:
                settled.append(state)

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (n**-0.5 + m**-0.5)
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.steps[a].keys() | self.steps[b].keys():
                if abs(self.steps[a].get(c, 0) / n - self.steps[b].get(c, 0) / m) > bound:
                    return False
                if c in self.next[a] and c in self.next[b] and bound < 1:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Counts of a subtree added to a state and what follows it."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.steps[b].items():
                self.steps[a][c] = self.steps[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def likelihood(self, value: str) -> float:
        """Mean log-probability of a class; unseen steps stay in their state, at a price."""
        state, total = 0, 0.0
        found = classes(value)
        for c in found:
            n = self.visits[state]
            total += math.log((self.steps[state].get(c, 0) + 0.01) / (n + 0.2))
            state = self.next[state].get(c, state)
        return total / max(1, len(found))


@dataclass
class Formats:
    automata: list[Automaton]
    least: list[float]  # the likelihood from which a candidate is as likely as the credentials
    words: dict[str, dict[str, float]]  # log-probability of a class after a class, in ordinary words

    def fits(self, value: str) -> bool:
        if not (any(c.isalpha() for c in value) and any(c.isdecimal() for c in value)):
            return False
        found = classes(value)
        unseen = math.log(1e-4)
        plain = sum(self.words.get(a, {}).get(b, unseen) for a, b in zip(["", *found], found)) / len(found)
        gain = max(LEAST_GAIN, LEAST_EVIDENCE / len(found))
        return any(
            (p := automaton.likelihood(value)) >= least and p - plain >= gain
            for automaton, least in zip(self.automata, self.least)
        )


#: What is counted of training texts: (kind, value, how often); this kind is of two classes that follow.
PAIR = -1


def counted(texts: Iterable[str]) -> Counter:
    """Credentials and, in words that hold none, pairs of classes."""
    counts: Counter = Counter()
    for text in texts:
        base = base_spans(text)
        counts.update(credentials(text))
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        for (b, e), kind in zip(places, spans.last_over(base, places)):
            if kind is None:
                found = classes(text[b:e])
                counts.update((PAIR, f"{x} {y}") for x, y in zip(["", *found], found))
    return counts


def _draw(value: str) -> str:
    """A prefix in order of the values would lack whole classes, one in order of this has all."""
    return hashlib.md5(value.encode()).hexdigest()


def learned(counts: Iterable[tuple[int, str, int]]) -> Formats | None:
    known: dict[int, set[str]] = defaultdict(set)
    pairs: dict[str, dict[str, int]] = defaultdict(dict)
    for kind, value, n in counts:
        if kind == PAIR:
            before, after = value.split(" ")
            pairs[before][after] = n
        else:
            known[kind].add(value)
    words = {}
    for before, after in pairs.items():
        n = sum(after.values())
        words[before] = {c: math.log((k + 0.01) / (n + 1)) for c, k in after.items()}
    automata, least = [], []
    for kind in sorted(known):
        values = sorted(sorted(known[kind], key=lambda v: (_draw(v), v))[:MAX_CREDENTIALS])
        if len(values) < 5:
            continue  # too few to tell a format
        automaton = Automaton(values)
        scores = sorted(automaton.likelihood(v) for v in values)
        automata.append(automaton)
        least.append(scores[len(scores) // 20])
    return Formats(automata, least, words) if automata else None


def infer(texts: list[str]) -> Formats | None:
    return learned((kind, value, n) for (kind, value), n in counted(texts).items())


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_TRAINING) -> Formats | None:
    """Formats from at most ``most`` documents that may hold a credential."""
    hint = F.col(text).rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}|(?i:passw|secret|token|api_?key)[a-z]*[\"']? *[:=]")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(k, v, n) for (k, v), n in counted(part.column("text").to_pylist()).items()]
                columns = zip(*found) if found else ((), (), ())
                types = (pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "value", "n"])

    chosen = spans.sample(docs, hint, most, doc_id, text)
    parts = chosen.select("text").mapInArrow(count, "kind int, value string, n long")
    counts = stored(parts.groupBy("kind", "value").agg(F.sum("n").alias("n")), "credentials")
    # Pairs number at most the classes squared.
    rows = counts.filter(F.col("kind") == PAIR).collect()
    for kind in range(len(KINDS) - 1):
        rows += counts.filter(F.col("kind") == kind).orderBy(F.md5("value"), "value").limit(MAX_CREDENTIALS).collect()
    return learned(rows)


def added_spans(text: str, base: list[Span], formats: Formats | None) -> list[Span]:
    """Candidates that fit a known format and that no base span touches."""
    if formats is None:
        return []
    # Words and plain numbers are not credentials, however likely.
    runs = (m for m in _RUN.finditer(text) if len(m[0]) >= LEAST_LENGTH and _LETTER.search(m[0]))
    places = [(m.start(), m.end()) for m in runs]
    free = (place for place, kind in zip(places, spans.last_over(base, places)) if kind is None)
    return [(b, 3, e) for b, e in free if formats.fits(text[b:e])]


def with_spans(docs: DataFrame, formats: Formats | None, text: str = "text") -> DataFrame:
    """``docs`` with base_spans and all_spans, arrays of (start, kind, end) in code points."""

    def find(texts: list[str]) -> spans.Found:
        base = [base_spans(t) for t in texts]
        return base, [added_spans(t, b, formats) for t, b in zip(texts, base)]

    return spans.with_spans(docs, find, KINDS, text)
