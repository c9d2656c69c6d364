"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to similar tokens.

Patterns find e-mail addresses, IP addresses, card and phone numbers (``KINDS``).  They miss mentions that only the
rest of the document explains: a phone number without its plus, an address's local part on its own, a card number
with a digit missing.  The field labels every token of a document that holds a digit or an ``@`` with a kind or none:

* node potentials from a token's shape (digits, dots, letters, signs);
* chain potentials between neighbouring tokens;
* skip potentials between repeated or similar tokens anywhere in the document (same text or local part, or the same
  last seven digits), each mention linked to the next one, so edges grow with the mentions and not with their square.

Tokens that a pattern covers are evidence, and that four numbers with dots are none if one is above 255.  Loopy belief propagation, damped, over all documents of a batch at once,
gives each other token its marginals; runs of neighbours whose likeliest label is the same kind, with a probability of
``CONFIDENCE``, are further spans.  Other words can have no label but none, so the field falls apart at them and
leaving them out is exact.  Spans of patterns always stay, and no added span overlaps one.

Weights are learned by pseudo-likelihood in numpy from what the patterns say of a bounded sample: about
``SAMPLE_DOCS`` documents, counted into distinct contexts (shape, neighbours' labels, label) by Spark, of which the
``CONTEXTS`` commonest reach the driver.  A token that is similar to a labelled one and has no label of its own is not
learned from.  Every context is learned again as its own twin, once with its shape left out and once with that of an
average token without a label, so that skip potentials do not hide behind shapes (they are undertrained otherwise).

Defined cases: a null text is empty and has no spans; positions are code points, ends exclusive; every row is
returned and judged by its own text; repeated ids and null ids are rows like others; without anything to learn from
only patterns give spans; extra columns are ignored.  A text is taken whole; time and memory grow with its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import on_workers

# The kinds in their order and the patterns of them.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

NONE, LABELS = 0, len(KINDS) + 1
SAMPLE_DOCS, CONTEXTS = 20_000, 20_000
RIDGE, ROUNDS = 1e-4, 600
CONFIDENCE, DAMPING, SWEEPS = 0.5, 0.5, 40
MIN_KEY, KEY_DIGITS = 5, 7
MAX_GAP, _GAP = 3, " ().-"  #: between neighbours

_TOKEN = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_BLANK = frozenset(" \t\n\x0b\x0c\r")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Looked for around each ``@``, since the pattern would try every place before it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start, domain = at, DOMAIN.match(text, at + 1)
        if domain:
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                last = domain.end()
                yield start, last
        at = text.find("@", max(last, at + 1))


def _octets(pieces: list[str]) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in pieces)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of what the patterns find, by kind and start."""
    out = [(0, *s) for s in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if _octets(m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m.group().replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum("0" <= c <= "9" for c in m.group()) <= PHONE_DIGITS[1]:
                out.append((3, m.start(), m.end()))
    return out


#: How many values each shape feature has.
SHAPES = [9, 5, 3, 3, 2, 3, 2, 2, 2]
_AT = np.cumsum([0, *SHAPES])
_DIGITS = np.array([0, 1, 2, 3, 4, 7, 10, 13, 16])


def shape(core: str, digits: str) -> tuple[int, ...]:
    n, letters = len(digits), sum(c.isalpha() for c in core)
    pieces = core.split(".")
    return (
        int(np.searchsorted(_DIGITS, n, "right")) - 1,
        min(len(pieces) - 1, 4),
        min(core.count("@"), 2),
        0 if not letters else 1 if letters <= n else 2,
        int(core.startswith("+")),
        min(core.count("-"), 2),
        int(n > len(core) // 2),
        int(len(pieces) == 4 and all(p.isascii() and p.isdecimal() for p in pieces)),
        int(CARD_DIGITS[0] <= n <= CARD_DIGITS[1] and luhn(digits)),
    )


class Field(NamedTuple):
    """The nodes of one or more documents, and edges between them."""

    span: list[tuple[int, int]]  #: first and last + 1 code point of each token without signs at its edges
    shape: list[tuple[int, ...]]
    label: list[int]  #: by patterns; -1 if none covers the token
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def field_of(text: str, base: list[tuple[int, int, int]]) -> Field:
    out = Field([], [], [], [], [])
    before, last, ended = {}, -1, -1
    covers = sorted(((a, b, k) for k, a, b in base))
    at, longest = 0, max((b - a for a, b, _ in covers), default=0)
    for m in _TOKEN.finditer(text):
        start, end = m.start(), m.end()
        while start > max(last, 0) and text[start - 1] not in _BLANK:
            start -= 1
        word = text[start:end]
        core = word.lstrip(_EDGE)
        a = end - len(core)
        core = core.rstrip(_EDGE + "+")
        b = a + len(core)
        last = end
        if not core:
            continue
        near, ended = ended >= 0 and a - ended <= MAX_GAP and not text[ended:a].strip(_GAP), b
        node = len(out.span)
        while at < len(covers) and covers[at][0] < a - longest:
            at += 1
        kinds, i = [], at
        while i < len(covers) and covers[i][0] < b:
            if covers[i][1] > a:
                kinds.append(covers[i][2])
            i += 1
        digits = "".join(c for c in core if "0" <= c <= "9")
        out.span.append((a, b))
        out.shape.append(shape(core, digits))
        out.label.append(min(kinds) + 1 if kinds else NONE if out.shape[-1][7] and not _octets(core.split(".")) else -1)
        if near:
            out.chain.append((node - 1, node))
        name = core.lower().partition("@")[0] or core.lower()
        keys = [("text", name)] if len(name) >= MIN_KEY else []
        if len(digits) >= KEY_DIGITS:
            keys.append(("digits", digits[-KEY_DIGITS:]))
        linked = set()
        for key in keys:
            if key in before and before[key] not in linked:
                linked.add(before[key])
                out.skip.append((before[key], node))
            before[key] = node
    return out


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One line per token to learn from: shape; left, right and similar tokens' labels; label."""
    for b in (c for big in batches for c in W.chunks(big)):
        out = []
        for text in b.column("_text").to_pylist():
            f = field_of(text or "", base_spans(text or ""))
            label = [max(x, NONE) for x in f.label]
            left, right, similar = {}, {}, {}
            for i, j in f.chain:
                left[j], right[i] = label[i], label[j]
            for i, j in f.skip:
                similar.setdefault(i, []).append(j)
                similar.setdefault(j, []).append(i)
            for i, s in enumerate(f.shape):
                linked = similar.get(i, [])
                if f.label[i] < 0 and any(f.label[j] >= 0 for j in linked):
                    continue
                told = sorted(label[j] for j in linked if f.label[j] >= 0 or f.label[i] < 0)
                out.append(",".join(map(str, [*s, left.get(i, -1), right.get(i, -1), label[i], *told])))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["context"])


class Model(NamedTuple):
    node: np.ndarray  #: shape values and a constant by label
    chain: np.ndarray  #: left label by right label
    skip: np.ndarray  #: label by label, symmetric


def train(rows: list[tuple[str, int]]) -> Model:
    """Pseudo-likelihood with a ridge, by accelerated gradient descent on all contexts and their twins."""
    size = int(_AT[-1])
    parsed = [([int(x) for x in c.split(",")], n) for c, n in rows]
    shapes = np.array([p[: len(SHAPES)] for p, _ in parsed])
    left, right, y = np.array([p[len(SHAPES) : len(SHAPES) + 3] for p, _ in parsed]).T
    told = np.zeros((len(parsed), LABELS))
    for i, (p, _) in enumerate(parsed):
        np.add.at(told[i], p[len(SHAPES) + 3 :], 1)
    eye = np.eye(LABELS)
    x = np.zeros((len(parsed), size + 1))
    x[np.arange(len(parsed))[:, None], shapes + _AT[:-1]] = 1
    x[:, size] = 1
    l, r = (np.where((v >= 0)[:, None], eye[v], 0) for v in (left, right))
    weight = np.sqrt([n for _, n in parsed])  # between counting tokens and counting contexts
    twin = np.zeros_like(x)
    twin[:, size] = 1
    plain = np.tile(np.average(x, 0, weight * (y == NONE)), (len(x), 1)) if (y == NONE).any() else twin
    x, l, r, told, y = np.r_[x, twin, plain], np.r_[l, 0 * l, 0 * l], np.r_[r, 0 * r, 0 * r], np.r_[told, eye[y], eye[y]], np.r_[y, y, y]
    weight = np.tile(weight, 3)
    weight = (weight / weight.sum())[:, None]
    step = 1 / (0.5 * (weight * (x.sum(1) + l.sum(1) + r.sum(1) + told.sum(1) ** 2)[:, None]).sum() + RIDGE)
    now = [np.zeros((size + 1, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    ahead = now
    for k in range(ROUNDS):
        u, c, s = ahead
        logit = x @ u + l @ c + r @ c.T + told @ s
        p = np.exp(logit - logit.max(1, keepdims=True))
        error = weight * (p / p.sum(1, keepdims=True) - eye[y])
        skip = told.T @ error
        slope = [x.T @ error, l.T @ error + (r.T @ error).T, (skip + skip.T) / 2]
        new = [a - step * (g + RIDGE * a) for a, g in zip(ahead, slope, strict=True)]
        ahead = [a + k / (k + 3) * (a - b) for a, b in zip(new, now, strict=True)]
        now = new
    return Model(*now)


def marginals(node: np.ndarray, edges: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Loopy belief propagation: node potentials (logarithms), edges ``(i, j)`` and each one's table (logarithms).

    All messages are sent together, half old and half new, ``SWEEPS`` times: a document's result depends on it alone.
    """
    n, m = len(node), len(edges)
    if not m:
        belief = node
    else:
        sender, to = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
        back = np.r_[np.arange(m, 2 * m), np.arange(m)]
        table = np.exp(np.r_[potential, potential.transpose(0, 2, 1)])
        message = np.full((2 * m, node.shape[1]), -np.log(node.shape[1]))
        for _ in range(SWEEPS):
            belief = node.copy()
            np.add.at(belief, to, message)
            part = belief[sender] - message[back]
            part = np.exp(part - part.max(1, keepdims=True))
            new = np.einsum("ey,eyz->ez", part, table)
            new = new / new.sum(1, keepdims=True)
            message = np.log(np.maximum(DAMPING * np.exp(message) + (1 - DAMPING) * new, 1e-300))
        belief = node.copy()
        np.add.at(belief, to, message)
    belief = np.exp(belief - belief.max(1, keepdims=True)) if n else belief
    return belief / belief.sum(1, keepdims=True) if n else belief


def added_spans(fields: list[Field], model: Model, confidence: float) -> list[list[tuple[int, int, int]]]:
    """For each document the spans ``(kind, start, end)`` that its field adds."""
    first = np.cumsum([0, *(len(f.span) for f in fields)])
    shapes = np.array([s for f in fields for s in f.shape], np.int64).reshape(-1, len(SHAPES))
    label = np.array([x for f in fields for x in f.label], np.int64)
    node = model.node[shapes + _AT[:-1]].sum(1) + model.node[-1]
    told = label >= 0
    node[told] = np.where(np.arange(LABELS) == label[told][:, None], 0.0, -60.0)
    chain = [(i + at, j + at) for f, at in zip(fields, first.tolist(), strict=False) for i, j in f.chain]
    skip = [(i + at, j + at) for f, at in zip(fields, first.tolist(), strict=False) for i, j in f.skip]
    edges = np.array(chain + skip, np.int64).reshape(-1, 2)
    tables = np.r_[np.broadcast_to(model.chain, (len(chain), LABELS, LABELS)), np.broadcast_to(model.skip, (len(skip), LABELS, LABELS))]
    belief = marginals(node, edges, tables)
    best = np.where((belief.max(1) >= confidence) & ~told, belief.argmax(1), NONE)
    out = []
    for f, at in zip(fields, first.tolist(), strict=False):
        found, joined = [], {j: i for i, j in f.chain}
        for i in np.flatnonzero(best[at : at + len(f.span)]).tolist():
            kind, (a, b) = int(best[at + i]) - 1, f.span[i]
            if found and joined.get(i) == found[-1][3] and found[-1][0] == kind:
                found[-1] = (kind, found[-1][1], b, i)
            else:
                found.append((kind, a, b, i))
        out.append([x[:3] for x in found])
    return out


def annotate(model: Model | None, confidence: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for b in (c for big in batches for c in W.chunks(big)):
            base, fields, which = [], [], []
            for i, text in enumerate(b.column("_text").to_pylist()):
                base.append(base_spans(text or ""))
                field = field_of(text or "", base[-1]) if model is not None else None
                if field and field.span:
                    fields.append(field)
                    which.append(i)
            more = dict(zip(which, added_spans(fields, model, confidence), strict=True)) if fields else {}
            rows = [sorted([(*s, True) for s in found] + [(*s, False) for s in more.get(i, [])]) for i, found in enumerate(base)]
            cells = [[{"kind": KINDS[k], "start": a, "end": e, "base": own} for k, a, e, own in r] for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(cells, pa.list_(kind))], names=["doc_id", "found"])

    return run


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, max_contexts: int = CONTEXTS) -> Model | None:
    """The field's weights, or None where the sample holds no token that a pattern covers."""
    n = docs.count()
    if not n:
        return None
    spread = F.pmod(F.xxhash64(F.lit(11), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(1 << 30))
    some = docs.where(spread < F.lit(min(1 << 30, (sample_docs << 30) // n))).select(F.col(f"`{text_col}`").cast("string").alias("_text"))
    seen = some.mapInArrow(contexts, "context string").groupBy("context").count()
    rows = [(r["context"], r["count"]) for r in seen.orderBy(F.desc("count"), "context").limit(max_contexts).collect()]
    known = {int(c.split(",")[len(SHAPES) + 2]) for c, _ in rows}
    return train(rows) if known - {NONE} else None


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, confidence: float = CONFIDENCE) -> DataFrame:
    """``doc_id, found`` of every row: spans ``(kind, start, end, base)`` by kind and start, ``base`` if by a pattern."""
    on_workers(docs.sparkSession)
    model = learn(docs, id_col, text_col, sample_docs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(annotate(model, confidence), "doc_id long, found array<struct<kind:string,start:long,end:long,base:boolean>>")
