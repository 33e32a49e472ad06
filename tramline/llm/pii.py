"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

Base spans are exact: the leftmost non-overlapping matches of each kind, checked. The
field reads the tokens around digits, "@", "=", "(at)" and "[at]" (no span of ours is without one) and
scores whole candidate spans of up to ``LONGEST`` tokens: shape, lengths, checks such as
Luhn, the words on either side, and which type follows which. A dynamic programme over
span ends chooses boundaries and types together; tokens far from any candidate can only be
outside, so each neighbourhood is solved by itself with the same result. Its spans that
meet no base span are added (numbers in other notations, masked addresses, secrets);
base spans stay as they are.

The field is trained here by likelihood on a bounded sample: neighbourhoods of at most
``SAMPLE`` documents with their base spans and key-like strings as truth, half of them
rewritten (a phone number without its plus sign, an address with "(at)").

Defined results: a null text counts as empty and has no spans; rows are independent, so
repeated rows give equal rows; without anything to learn from, the field adds nothing. The
patterns are matched in time linear in the text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The base kinds in order, their patterns and bounds.
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Types of the field: outside, the base kinds, and secrets.
TYPES = ["", *KINDS, "secret"]
#: Tokens of a span at most.
LONGEST = 5
#: Documents that the field is trained on at most, and neighbourhoods among them.
SAMPLE, REGIONS = 1500, 900
_EPOCHS, _RATE = 6, 0.15
_SLOTS = 4096
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_TRIGGER = re.compile(r"[0-9@=]|\(at\)|\[at\]")
_SECRET = re.compile(r"(?:[A-Z]{4}[A-Z0-9]{16}|(?=[0-9]*+[a-f])[0-9a-f]{16,})\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out, behind = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > behind and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                behind = m.end()
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _neighbourhoods(text: str):
    """Lists of (start, end) of tokens: those with a trigger, LONGEST - 1 more on either side."""
    held, quiet = [], LONGEST  # tokens, and how many of the last have no trigger
    for m in _TOKEN.finditer(text):
        if _TRIGGER.search(m[0]):
            held.append(m.span())
            quiet = 0
        elif quiet < LONGEST - 1:
            held.append(m.span())
            quiet += 1
        else:
            if quiet == LONGEST - 1 and any(_TRIGGER.search(text, *t) for t in held):
                yield held
                held = []
            quiet = LONGEST
            held = [*held[-(LONGEST - 2):], m.span()] if LONGEST > 2 else [m.span()]
    if any(_TRIGGER.search(text, *t) for t in held):
        yield held


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without quotes and marks around it."""
    while start < end and text[start] in "\"'([{<":
        start += 1
    while start < end and text[end - 1] in "\"'.,;:!?)]}>":
        end -= 1
    return start, end


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % _SLOTS


def _features(text: str, tokens, i: int, j: int) -> list[int]:
    """Slots of the features of the span from token i to before token j."""
    start, end = _trim(text, tokens[i][0], tokens[j - 1][1])
    body = text[start:end][:200]
    digits = _digits(body)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "0", body))[:24]
    kinds = (f"n{j - i}", f"s{shape}", f"d{min(len(digits), 24)}", f"l{min(len(body) // 4, 12)}",
             f"dots{min(body.count('.'), 5)}", f"at{'@' in body}{'at)' in body or 'at]' in body}", f"plus{body[:1] == '+'}",
             f"luhn{16 <= len(digits) <= 19 and luhn(digits)}", f"octets{shape == '0.0.0.0' and _octets(body)}",
             f"hex{bool(_SECRET.fullmatch(body))}{bool(_SECRET.search(body))}", f"is{'=' in body}",
             f"t{bool(_TRIGGER.search(text, *tokens[i]))}{bool(_TRIGGER.search(text, *tokens[j - 1]))}")
    before = text[slice(*tokens[i - 1])][-12:].lower() if i else "^"
    after = text[slice(*tokens[j])][:12].lower() if j < len(tokens) else "$"
    return [_slot(k) for k in (*kinds, f"b{before if any(c in before for c in '=:') else ''}", f"a{bool(re.match('[0-9(]', after))}")]


class Field:
    """Weights of span features by type, and of a type after a type."""

    def __init__(self, spans=None, follows=None):
        n = len(TYPES)
        self.spans = np.zeros((n, _SLOTS)) if spans is None else spans
        self.follows = np.zeros((n, n)) if follows is None else follows

    def potentials(self, text: str, tokens):
        """For each (i, j): feature slots and the score of each type; outside takes one token."""
        out = {}
        for i in range(len(tokens)):
            for j in range(i + 1, min(i + LONGEST, len(tokens)) + 1):
                slots = _features(text, tokens, i, j)
                score = self.spans[:, slots].sum(axis=1)
                if j > i + 1:
                    score[0] = -np.inf
                out[i, j] = (slots, score)
        return out

    def best(self, text: str, tokens) -> list[tuple[int, int, int]]:
        """The best segmentation as (first token, token behind, type); outside on ties."""
        n = len(tokens)
        pot = self.potentials(text, tokens)
        top = np.full((n + 1, len(TYPES)), -np.inf)
        top[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            for i in range(j - 1, max(-1, j - 1 - LONGEST), -1):
                ways = top[i][:, None] + self.follows
                frm = ways.argmax(axis=0)
                total = ways.max(axis=0) + pot[i, j][1]
                for y in np.flatnonzero(total > top[j]).tolist():
                    top[j, y] = total[y]
                    back[j, y] = (i, int(frm[y]))
        out, at, y = [], n, int(top[n].argmax())
        while at:
            i, before = back[at, y]
            out.append((i, at, y))
            at, y = i, before
        return out[::-1]

    def learn(self, text: str, tokens, truth: list[tuple[int, int, int]], rate: float) -> None:
        """One step up the likelihood of the true segmentation (forward and backward sums)."""
        n = len(tokens)
        pot = self.potentials(text, tokens)
        ahead = np.full((n + 1, len(TYPES)), -np.inf)
        ahead[0, 0] = 0
        rest = np.full((n + 1, len(TYPES)), -np.inf)
        rest[n] = 0
        spread = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
        for j in range(1, n + 1):
            terms = [spread(ahead[i][:, None] + self.follows, 0) + pot[i, j][1] for i in range(max(0, j - LONGEST), j)]
            ahead[j] = np.logaddexp.reduce(terms, axis=0)
        for i in range(n - 1, -1, -1):
            terms = [spread(self.follows + (pot[i, j][1] + rest[j])[None, :], 1) for j in range(i + 1, min(i + LONGEST, n) + 1)]
            rest[i] = np.logaddexp.reduce(terms, axis=0)
        whole = spread(ahead[n], 0)
        spans, follows = [], np.zeros_like(self.follows)
        for (i, j), (slots, score) in pot.items():
            both = np.exp(ahead[i][:, None] + self.follows + (score + rest[j])[None, :] - whole)
            follows -= both
            spans.append((slots, -both.sum(axis=0)))
        before = 0
        for i, j, y in truth:
            follows[before, y] += 1
            gain = np.zeros(len(TYPES))
            gain[y] = 1
            spans.append((pot[i, j][0], gain))
            before = y
        for slots, gain in spans:
            self.spans[:, slots] += rate * gain[:, None]
        self.follows += rate * follows


def _truth(text: str, tokens, spans) -> list[tuple[int, int, int]] | None:
    """The segmentation of tokens that spans give; None where a span has more than LONGEST tokens."""
    out, i = [], 0
    while i < len(tokens):
        kind = next((k for k, s, e in spans if tokens[i][0] <= s < tokens[i][1]), None)
        if kind is None:
            out.append((i, i + 1, 0))
            i += 1
            continue
        end = max(e for k, s, e in spans if k == kind and tokens[i][0] <= s < tokens[i][1])
        j = i + 1
        while j < len(tokens) and tokens[j][0] < end:
            j += 1
        if j - i > LONGEST:
            return None
        out.append((i, j, TYPES.index(kind)))
        i = j
    return out


def _examples(text: str):
    """(text, tokens, truth) of neighbourhoods, each as it is and rewritten."""
    spans = base_spans(text)
    spans += [("secret", *m.span()) for m in _SECRET.finditer(text) if not any(s < m.end() and m.start() < e for _, s, e in spans)]
    for tokens in _neighbourhoods(text):
        low, high = tokens[0][0], tokens[-1][1]
        inside = sorted((s - low, e - low, k) for k, s, e in spans if low <= s and e <= high)
        if len(tokens) > 60 or not inside:
            continue
        for rewrite in (False, True):
            body, moved, at = "", [], 0
            for s, e, k in inside:
                if s < at:
                    continue
                body += text[low + at: low + s]
                span = text[low + s: low + e]
                if rewrite:
                    span = (re.sub(r"^\+[0-9]+[ -]?", "", span) if k == "phone" else
                            span.replace("@", " (at) " if len(span) % 2 else "(at)") if k == "email" else span)
                moved.append((k, len(body), len(body) + len(span)))
                body += span
                at = e
            body += text[low + at: high]
            pieces = [m.span() for m in _TOKEN.finditer(body)]
            truth = _truth(body, pieces, moved)
            if truth:
                yield body, pieces, truth


def trained(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """The field, trained in one task on at most ``sample`` documents that hold a digit or "@"."""
    texts = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]"))
    total = docs.count()
    part = min(1 << 20, (4 * sample << 20) // max(total, 1) + 1)
    chosen = (texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < part)
              .select(F.xxhash64("doc_id").alias("by"), "text").orderBy("by", "text").limit(sample))

    def step(batches):
        field, examples = Field(), []
        for batch in batches:
            for text in batch.column(1).to_pylist():
                if len(examples) < REGIONS:
                    examples.extend(_examples(text))
        order = np.random.default_rng(7)
        for epoch in range(_EPOCHS):
            for k in order.permutation(len(examples)):
                field.learn(*examples[k], _RATE / (1 + epoch))
        yield pa.RecordBatch.from_arrays([pa.array([field.spans.tobytes()]), pa.array([field.follows.tobytes()])], names=["spans", "follows"])

    row = chosen.coalesce(1).mapInArrow(step, "spans binary, follows binary").first()
    if row is None:  # nothing to learn from, no task
        return Field()
    n = len(TYPES)
    return Field(np.frombuffer(row[0]).reshape(n, _SLOTS), np.frombuffer(row[1]).reshape(n, n))


def all_spans(text: str, base: list[tuple[str, int, int]], field: Field) -> list[tuple[str, int, int]]:
    """Base spans and those of the field that meet none of them, by type, then start."""
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    found = list(base)
    for tokens in _neighbourhoods(text):
        for i, j, y in field.best(text, tokens):
            if y:
                start, end = _trim(text, tokens[i][0], tokens[j - 1][1])
                near = np.searchsorted(starts, end)
                if start < end and not any(s < end and start < e for s, e in taken[max(0, near - 4 * LONGEST): near]):
                    found.append((TYPES[y], start, end))
    return sorted(set(found), key=lambda s: (TYPES.index(s[0]), s[1], s[2]))


def marked(docs: DataFrame, *, sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of docs (all by default), then base and spans: arrays of (kind, start, end)
    in code points, end exclusive. Columns of docs with these names are left out."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "spans")]
    at = keep.index("text") if "text" in keep else len(keep)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType())]))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("base", span), T.StructField("spans", span)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    n_keep = len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, sample))

    def step(batches):
        field = shared.value
        names = ("kind", "start", "end")
        for batch in batches:
            base, spans = [], []
            for text in batch.column(at).to_pylist():
                own = every = []
                if text and _TRIGGER.search(text):
                    own = base_spans(text)
                    every = all_spans(text, own, field)
                base.append([dict(zip(names, s)) for s in own])
                spans.append([dict(zip(names, s)) for s in every])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n_keep)), pa.array(base, kind), pa.array(spans, kind)], names=[*keep, "base", "spans"])

    return source.mapInArrow(step, schema)


def joined(spans):
    """kind:start:end of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans, kind: str):
    return F.filter(spans, lambda s: s["kind"] == kind)
