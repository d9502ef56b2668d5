"""Personal data found by patterns and by a skip-chain conditional random field.

The patterns give the base spans, which always stand. A conditional random field over the
tokens that hold a digit or an at sign adds spans: tokens like known personal data in places
where the patterns fail. Such a token has an entity label or none; any other token has none for
certain, so it only serves as context. Tokens that follow each other are neighbours in the
chain. Tokens of a document that repeat (``same``), or differ in digits only (``like``), are tied
by skip edges to a node of their form, which has a label but nothing of its own to see: any two
mentions are two edges apart, however many there are and however far apart they stand, and edges
number as many as mentions. So all mentions of a thing tend to one label.

Marginals come from loopy belief propagation, all edges of a batch of documents at once. Each
document goes on until its messages change by less than ``TOLERANCE``, whatever the others do, so
its marginals do not depend on the batch. Steps get shorter after ``STEADY`` rounds, which settles
messages that swing; a document that still changes after ``MAX_ROUNDS`` keeps its last messages, and
a warning counts such documents.

Weights are learned by pseudo-likelihood from at most ``MAX_TRAINING`` documents (by hash of
id) in which a pattern matches, labelled by the base spans; there, a form has the label most
usual among its other mentions.

Defined cases: a null or empty text has no spans; repeated rows give the same spans; an empty
table gives no rows, and without matches to learn from, base spans only. Columns of the input stay.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm import spans
from runledger.llm.common import SPACES, slices
from runledger.llm.spans import Span

KINDS = ("email", "ip", "card", "phone")

#: Documents that learning reads at most.
MAX_TRAINING = 2_000

#: Message passing: the change at which it ends, rounds of full steps, rounds at most.
TOLERANCE, STEADY, MAX_ROUNDS = 1e-5, 200, 5_000

#: The marginal from which a token is an entity.
CERTAIN = 0.95

#: Kinds of edges, each with its own potentials.
EDGES = ("chain", "same", "like")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins within a run of digits: it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(int(d) if i % 2 == 0 else double[int(d)] for i, d in enumerate(reversed(digits))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """By at sign, so that a long run of letters is not tried from each of its places."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            yield begin, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, in order of start, then kind."""
    found = [(b, 0, e) for b, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_LEAD = re.compile(r"[^0-9A-Za-z+(]+")
_TAIL = re.compile(r"[^0-9A-Za-z)]+")  # of the token turned round

#: Names of what is seen of a token; each is on or off.
FEATURES = (
    "bias", "at sign", "dot after at", "starts with plus", "in brackets", "dots 3", "dots other", "hyphen",
    "digits 1-3", "digits 4-8", "digits 9-11", "digits 12-19", "digits 20+", "digits only", "letters", "lower hex run",
    "colon before", "Luhn", "parts to 255", "after plus token", "before digit token",
)


def tokens(text: str) -> list[tuple[int, int, int, str]]:
    """(begin, end, order, token without marks around it) of what may be personal data.

    ``order`` counts all words of a sort: tokens of consecutive orders are neighbours.
    """
    out, last_end, order = [], 0, 0
    mark = _MARK.search(text)
    while mark:
        begin = mark.start()
        while begin > last_end and text[begin - 1] not in SPACES:
            begin -= 1
        space = _SPACE.search(text, mark.end())
        end = space.start() if space else len(text)
        # Only white space between two of them makes them neighbours.
        order += 1 if out and text[last_end:begin].isspace() else 2
        last_end = end
        lead = _LEAD.match(text, begin, end)
        begin = lead.end() if lead else begin
        tail = _TAIL.match(text[begin:end][::-1])
        end -= tail.end() if tail else 0
        if begin < end:
            out.append((begin, end, order, text[begin:end]))
        mark = _MARK.search(text, last_end)
    return out


def features(core: str, before: str | None, after: str | None) -> list[int]:
    """Numbers of the features that are on."""
    digits = sum(c in "0123456789" for c in core)
    at, dots = core.find("@"), core.count(".")
    on = [0]
    add = on.append
    if at > 0:
        add(1)
        if "." in core[at:]:
            add(2)
    if core[0] == "+":
        add(3)
    if core[0] == "(" and core[-1] == ")":
        add(4)
    if dots:
        add(5 if dots == 3 else 6)
    if "-" in core:
        add(7)
    add(8 if digits <= 3 else 9 if digits <= 8 else 10 if digits <= 11 else 11 if digits <= 19 else 12)
    letters = any(c.isalpha() for c in core)
    if digits == len(core):
        add(13)
    if letters:
        add(14)
        if digits > 4 and all(c in "0123456789abcdef" for c in core):
            add(15)
    if ":" in core or "=" in core:
        add(16)
    if not letters and 12 <= digits <= 19 and _luhn("".join(c for c in core if c in "0123456789")):
        add(17)
    if dots == 3 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in core.split(".")):
        add(18)
    if before and before[0] == "+":
        add(19)
    if after and after[0] in "0123456789":
        add(20)
    return on


@dataclass
class Graph:
    """Tokens of several documents, nodes of repeated forms (numbered after them), and edges."""

    row: list[int]  # the document of each node, tokens and forms
    begin: list[int]
    end: list[int]
    on: list[list[int]]
    edges: dict[str, np.ndarray]  # by kind, (edges, 2): neighbours, or a form and its mention


def graph(texts: list[str]) -> Graph:
    row, begin, end, on = [], [], [], []
    chain: list[tuple[int, int]] = []
    forms: list[tuple[str, int, list[int]]] = []  # kind, document, mentions
    for i, text in enumerate(texts):
        found = tokens(text) if text else []
        same: dict[str, list[int]] = {}
        like: dict[str, list[int]] = {}
        for k, (b, e, order, core) in enumerate(found):
            here = len(row)
            near = k > 0 and found[k - 1][2] + 1 == order
            after = k + 1 < len(found) and found[k + 1][2] == order + 1
            row.append(i)
            begin.append(b)
            end.append(e)
            on.append(features(core, found[k - 1][3] if near else None, found[k + 1][3] if after else None))
            if near:
                chain.append((here - 1, here))
            lower = core.lower()
            same.setdefault(lower, []).append(here)
            like.setdefault(_DIGIT.sub("0", lower), []).append(here)
        repeated = [m for m in same.values() if len(m) > 1]
        whole = {tuple(m) for m in repeated}
        forms += [("same", i, m) for m in repeated]
        # Mentions that are all the same are tied once.
        forms += [("like", i, m) for m in like.values() if len(m) > 1 and tuple(m) not in whole]
    edges = {kind: [] for kind in EDGES}
    edges["chain"] = chain
    for kind, i, mentions in forms:
        edges[kind] += [(len(row), m) for m in mentions]
        row.append(i)
    return Graph(row, begin, end, on, {kind: np.array(e, int).reshape(-1, 2) for kind, e in edges.items()})


def _scores(on: list[list[int]], weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of the features of each token, a column per label."""
    if not on:
        return np.zeros((0, weights.shape[1]))
    sizes = np.array([len(x) for x in on])
    flat = np.concatenate([np.array(x) for x in on])
    return np.add.reduceat(weights[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)


def marginals(g: Graph, model: dict[str, np.ndarray]) -> np.ndarray:
    """Label probabilities of each token by loopy belief propagation."""
    count, labels = len(g.on), model["unary"].shape[1]
    row = np.array(g.row, int)
    belief = np.zeros((len(row), labels))
    belief[:count] = _scores(g.on, model["unary"])
    edges = np.concatenate([g.edges[kind] for kind in EDGES])
    if len(edges):
        source, to = np.concatenate([edges, edges[:, ::-1]]).T
        back = np.roll(np.arange(2 * len(edges)), len(edges))
        kind = np.repeat(np.arange(len(EDGES)), [len(g.edges[k]) for k in EDGES])
        kind = np.concatenate([kind, kind + len(EDGES)])
        pairs = [np.exp(model[k]) for k in EDGES]
        pairs += [pair.T for pair in pairs]
        messages = np.zeros((2 * len(edges), labels))
        unary, live = belief, np.arange(2 * len(edges))
        for round_ in range(MAX_ROUNDS):
            # Documents share no edge: those that have settled are left as they are.
            belief = unary.copy()
            np.add.at(belief, to[live], messages[live])
            sent = belief[source[live]] - messages[back[live]]
            sent = np.exp(sent - sent.max(axis=1, keepdims=True))
            new = np.empty_like(sent)
            for k, pair in enumerate(pairs):
                of = kind[live] == k
                new[of] = np.log(sent[of] @ pair)
            new -= new.max(axis=1, keepdims=True)
            off = new - messages[live]
            messages[live] += off * (0.5 if round_ < STEADY else 0.5 * STEADY / round_)
            change = np.zeros(row.max() + 1)
            np.maximum.at(change, row[to[live]], np.abs(off).max(axis=1))
            live = live[change[row[to[live]]] >= TOLERANCE]
            if not len(live):
                break
        else:
            unsettled = len(np.unique(row[to[live]]))
            logging.getLogger(__name__).warning("messages of %d documents did not settle", unsettled)
        belief = unary.copy()
        np.add.at(belief, to, messages)
    belief = belief[:count]
    p = np.exp(belief - belief.max(axis=1, keepdims=True)) if count else belief
    return p / p.sum(axis=1, keepdims=True)


def _places(g: Graph, texts: int) -> list[slice]:
    """Which tokens are those of each text."""
    border = np.searchsorted(np.array(g.row[: len(g.on)], int), np.arange(texts + 1))
    return [slice(int(a), int(b)) for a, b in zip(border[:-1], border[1:])]


def token_labels(g: Graph, base: list[list[Span]]) -> np.ndarray:
    """0 for none, else one more than the kind of the last base span over the token."""
    out = np.zeros(len(g.on), int)
    for of, found in zip(_places(g, len(base)), base):
        if found:
            over = spans.last_over(found, zip(g.begin[of], g.end[of]))
            out[of] = [0 if kind is None else kind + 1 for kind in over]
    return out


def _form_labels(edges: np.ndarray, gold: np.ndarray, labels: int) -> np.ndarray:
    """For each edge of a form, the label most usual among the form's other mentions."""
    if not len(edges):
        return np.zeros(0, int)
    form = edges[:, 0] - edges[:, 0].min()
    own = np.eye(labels)[gold[edges[:, 1]]]
    counts = np.zeros((form.max() + 1, labels))
    np.add.at(counts, form, own)
    return (counts[form] - own).argmax(axis=1)


def fit(texts: list[str], steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> dict[str, np.ndarray] | None:
    """Weights by pseudo-likelihood: each token's label given its neighbours' base labels."""
    g = graph(texts)
    gold = token_labels(g, [base_spans(t) for t in texts])
    if not gold.any():
        return None
    labels = len(KINDS) + 1
    inputs = np.zeros((len(gold), len(FEATURES)))
    for k, on in enumerate(g.on):
        inputs[k, on] = 1
    want = np.eye(labels)[gold]
    model = {"unary": np.zeros((len(FEATURES), labels)), **{kind: np.zeros((labels, labels)) for kind in EDGES}}
    chain = g.edges["chain"]
    ties = {kind: (_form_labels(g.edges[kind], gold, labels), g.edges[kind][:, 1]) for kind in EDGES[1:]}
    squares = {name: np.full_like(w, 1e-6) for name, w in model.items()}
    for _ in range(steps):
        score = inputs @ model["unary"]
        np.add.at(score, chain[:, 1], model["chain"][gold[chain[:, 0]]])
        np.add.at(score, chain[:, 0], model["chain"].T[gold[chain[:, 1]]])
        for kind, (form, mention) in ties.items():
            np.add.at(score, mention, model[kind][form])
        p = np.exp(score - score.max(axis=1, keepdims=True))
        off = p / p.sum(axis=1, keepdims=True) - want
        left, right = chain.T
        grads = {"unary": inputs.T @ off, "chain": want[left].T @ off[right] + off[left].T @ want[right]}
        for kind, (form, mention) in ties.items():
            grads[kind] = np.eye(labels)[form].T @ off[mention]
        for name, grad in grads.items():
            grad = grad / len(gold) + decay * model[name]
            squares[name] += grad**2
            model[name] -= rate * grad / np.sqrt(squares[name])
    return model


def added_spans(texts: list[str], base: list[list[Span]], model: dict[str, np.ndarray] | None) -> list[list[Span]]:
    """Tokens that the model is certain of and no base span touches."""
    out: list[list[Span]] = [[] for _ in texts]
    if model is None:
        return out
    g = graph(texts)
    p = marginals(g, model)
    best, sure = p.argmax(axis=1), p.max(axis=1, initial=0) >= CERTAIN
    for of, found, more in zip(_places(g, len(texts)), base, out):
        over = spans.last_over(found, zip(g.begin[of], g.end[of]))
        for k, kind in zip(range(of.start, of.stop), over):
            if kind is None and sure[k] and best[k] > 0:
                more.append((g.begin[k], int(best[k]) - 1, g.end[k]))
    return out


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_TRAINING) -> dict | None:
    """A model from at most ``most`` documents that may hold personal data."""
    hint = F.col(text).rlike("@[A-Za-z0-9-]+[.]|[0-9][0-9.() -]{9,}[0-9]")
    return fit([r["text"] for r in sorted(spans.sample(docs, hint, most, doc_id, text).collect())])


def with_spans(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with base_spans and all_spans, arrays of (start, kind, end) in code points."""

    def find(texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
        base = [base_spans(t) for t in texts]
        return base, added_spans(texts, base, model)

    return spans.with_spans(docs, find, KINDS, text)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span replaced by ``<KIND>``; one that begins within another joins it."""
    parts, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` (if any) counted anew."""
    model = train(docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    plain = docs.toDF(*names)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text).to_pylist()
                filled = [t or "" for t in texts]
                base = [base_spans(t) for t in filled]
                more = added_spans(filled, base, model)
                new = [t and redacted(t, x + y) for t, x, y in zip(texts, base, more)]
                at = part.schema.get_field_index(text)
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    out = plain.mapInArrow(replace, plain.schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
