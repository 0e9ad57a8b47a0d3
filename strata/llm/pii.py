"""Personal data by weak supervision.

Base spans are those of the strict patterns; they always stay. Candidates for
further spans come from wider patterns (numbers with other separators or failing
check digits, phone numbers without a country code, spelled-out addresses).

Every candidate and base span is voted on (yes, no, abstains) by labelers of
three sorts: regex (strict form, check digits, plausible parts), gazetteers (mail
domains' ends, issuers' first digits, reserved networks) and context (cue words
on either side, what touches the span). Expectation-maximisation over the votes
of all documents estimates how reliable each labeler is for each kind, without
labels. The probabilities it gives train the span classifier, a logistic
regression on the votes and on the span's shape, which then decides about the
candidates: those of ``ACCEPT`` or more become spans.

Each whole text is read once. What is learnt from are counts of distinct (kind,
votes, shape) patterns, summed over all spans before and after a shuffle: their
number is bounded by the labelers and not by the data.

All patterns run in linear time on any text. Defined results: NULL and empty
texts have no spans; repeated rows are judged row by row; without candidates or
base spans nothing is learnt and nothing added; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, materialise, slices

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
CONTEXT = 40
EM_ROUNDS = 100
BATCH_BYTES = 8_000_000
SPAN = "struct<kind:int,start:long,end:long,base:boolean,pattern:string>"
FOUND = f"doc_id long, spans array<{SPAN}>"
RESULT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")

# -- base spans -------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# no match starts inside a run of digits: it would fail or succeed as from the run's start
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is the run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def small_parts(dotted: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in dotted.split("."))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def is_card(match: str) -> bool:
    digits = NOT_DIGIT.sub("", match)
    return 14 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strict patterns, in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m[0])]
        found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                      if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


# -- candidates -------------------------------------------------------------------

WIDER = (
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
                   r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,8}")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9.])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,2}[0-9]{4}){2}[ ./_-]{0,2}[0-9]{2,7}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches of the wider patterns that touch no base span, nor one another."""
    if not DIGIT.search(text) and "at)" not in text and "at]" not in text:
        return []
    taken = bytearray(len(text))
    for a, _, b in base:
        taken[a:b] = bytes([1]) * (b - a)
    out = []
    for kind, pattern in WIDER:
        for m in pattern.finditer(text):
            a, b = m.span()
            if taken.find(1, a, b) < 0:
                out.append((a, kind, b))
                taken[a:b] = bytes([1]) * (b - a)
    return sorted(out)


# -- labelers ---------------------------------------------------------------------

# Gazetteers and cue words of the labelers.
MAIL_ENDS = frozenset("com org net edu gov int info biz de fr es it uk nl be ch at eu us ca au io".split())
CARD_FIRST = frozenset("3456")
RESERVED_NETS = ("0.", "10.", "127.", "192.168.", "169.254.", "255.")
CUES = {
    0: "mail email e-mail contact write courriel correo kontakt".split(),
    1: "ip host server address login client adresse dirección".split(),
    2: "card visa mastercard credit debit payment carte karte tarjeta iban".split(),
    3: "phone tel call mobile fax cell telefon téléphone teléfono".split(),
}
AGAINST = "version isbn issn sha hash token id order invoice figure chapter page serial".split()
CUE = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v)) + r")\b", re.I) for k, v in CUES.items()}
AGAINST_CUE = re.compile(r"\b(?:" + "|".join(AGAINST) + r")\b", re.I)
LABELERS = ("form", "check", "gazetteer", "cue", "against", "touching")


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> str:
    """One character a labeler: + yes, - no, 0 abstains."""
    span = text[start:end]
    digits = NOT_DIGIT.sub("", span)
    form = "+" if strict else "0"
    if kind == 0:
        check = "+" if re.search(r"\.[A-Za-z]{2,24}$|dot[)\]] ?[A-Za-z]{2,24}$", span) else "-"
        gazetteer = "+" if re.split(r"[^A-Za-z0-9]+", span)[-1].lower() in MAIL_ENDS else "-"
    elif kind == 1:
        check = "+" if small_parts(span) else "-"
        gazetteer = "-" if span.startswith(RESERVED_NETS) else "0"
    elif kind == 2:
        check = "+" if luhn(digits) else "-"
        gazetteer = "+" if digits[0] in CARD_FIRST else "-"
    else:
        local = digits[-10:]
        check = "+" if 10 <= len(digits) <= 15 else "-"
        gazetteer = "-" if local[:3] in ("000", "999") or len(set(local)) < 3 else "0"
    before, after = text[max(0, start - CONTEXT): start], text[end: end + CONTEXT]
    cue = "+" if CUE[kind].search(before) or CUE[kind].search(after) else "0"
    against = "-" if AGAINST_CUE.search(before) else "0"
    touch = before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in ("/", "=", "_") and before != ""
    return form + check + gazetteer + cue + against + ("-" if touch else "0")


def shape(span: str) -> str:
    """Length class and which separators a span has."""
    return f"{min(9, len(span) // 4)}" + "".join(c if c in span else "" for c in " .-()/_")


class Find:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                          ("base", pa.bool_()), ("pattern", pa.string())])
        for batch in batches:
            for part in slices(batch, "data", BATCH_BYTES):
                rows = [self.spans(x.decode("utf-8", "replace")) for x in part.column("data").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(kind))],
                                                 names=["doc_id", "spans"])

    @staticmethod
    def spans(text: str) -> list[dict]:
        base = base_spans(text)
        both = [(s, True) for s in base] + [(s, False) for s in candidates(text, base)]
        return [{"kind": k, "start": a, "end": b, "base": strict,
                 "pattern": f"{k}|{votes(text, k, a, b, strict)}|{shape(text[a:b])}"}
                for (a, k, b), strict in sorted(both)]


# -- label model and classifier ---------------------------------------------------


def label_model(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """P(personal) of each pattern by expectation-maximisation: for every kind a
    prior and, for each labeler, how often it votes what on true and false spans."""
    out = {}
    for kind in {p.split("|")[0] for p in patterns}:
        own = [p for p in patterns if p.split("|")[0] == kind]
        n = np.array([patterns[p] for p in own], np.float64)
        vote = np.array([["+-0".index(v) for v in p.split("|")[1]] for p in own])
        lean = (vote == 0).sum(1) - (vote == 1).sum(1)         # start from the majority
        q = 1 / (1 + np.exp(-1.5 * (lean - 0.5)))
        for _ in range(rounds):
            prior = np.clip((n * q).sum() / n.sum(), 0.01, 0.99)
            yes, no = np.full(len(own), math.log(prior)), np.full(len(own), math.log(1 - prior))
            for j in range(vote.shape[1]):
                a = np.bincount(vote[:, j], n * q, 3) + 0.5
                b = np.bincount(vote[:, j], n * (1 - q), 3) + 0.5
                yes += np.log(a / a.sum())[vote[:, j]]
                no += np.log(b / b.sum())[vote[:, j]]
            q = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
        out.update(zip(own, q.tolist()))
    return out


class SpanClassifier:
    """Logistic regression on votes and shape, from probabilistic labels."""

    def __init__(self, patterns: dict[str, int], truth: dict[str, float], steps: int = 400, decay: float = 1e-3):
        keys = sorted(patterns)
        names = sorted({f for p in keys for f in self.features(p)})
        self.at = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(keys), len(names)))
        for row, p in enumerate(keys):
            x[row, [self.at[f] for f in self.features(p)]] = 1
        n = np.sqrt(np.array([patterns[p] for p in keys], np.float64))   # no pattern outweighs all others
        y = np.array([truth[p] for p in keys])
        self.w = np.zeros(len(names))
        grad2 = np.full(len(names), 1e-8)
        for _ in range(steps if keys else 0):
            g = x.T @ (n * (1 / (1 + np.exp(-x @ self.w)) - y)) / n.sum() + decay * self.w
            grad2 += g * g
            self.w -= 0.5 * g / np.sqrt(grad2)

    @staticmethod
    def features(pattern: str) -> list[str]:
        kind, vote, form = pattern.split("|")
        # the strict form is what separates base spans from candidates, so it teaches nothing about these
        return [f"{kind}"] + [f"{kind}.{name}{v}" for name, v in zip(LABELERS[1:], vote[1:])] + \
               [f"{kind}.shape{c}" for c in form]

    def accepts(self, pattern: str) -> bool:
        z = sum(self.w[self.at[f]] for f in self.features(pattern) if f in self.at)
        return bool(1 / (1 + math.exp(-z)) >= ACCEPT)


class Decide:
    def __init__(self, accepted: frozenset[str]):
        self.accepted = accepted

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("spans").to_pylist()
            counts, digests, spans, added = [], [], [], []
            for own in rows:
                own.sort(key=lambda s: (s["start"], s["kind"]))
                name = lambda s: f"{KINDS[s['kind']]}:{s['start']}:{s['end']}"
                base = [s for s in own if s["base"]]
                every = [s for s in own if s["base"] or s["pattern"] in self.accepted]
                counts.append([sum(s["kind"] == k for s in base) for k in range(4)])
                digests.append(hashlib.sha256(",".join(map(name, base)).encode()).hexdigest())
                spans.append(",".join(map(name, every)))
                added.append(len(every) - len(base))
            per_kind = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *per_kind, pa.array(digests, pa.string()), pa.array(spans, pa.string()),
                 pa.array(added, pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])


def learn(found: DataFrame) -> frozenset[str]:
    """The patterns whose candidates become spans."""
    counted = (found.select(F.explode("spans").alias("s")).groupBy(F.col("s.pattern").alias("pattern"))
               .agg(F.count("*").alias("n"), F.max(~F.col("s.base")).alias("candidate")).collect())
    patterns = {r["pattern"]: r["n"] for r in counted}
    classifier = SpanClassifier(patterns, label_model(patterns))
    return frozenset(r["pattern"] for r in counted if r["candidate"] and classifier.accepts(r["pattern"]))


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and digest, all spans, how many were added."""
    found = materialise(ids_and_bytes(docs).mapInArrow(Find(), FOUND), "pii-spans")
    return found.mapInArrow(Decide(learn(found)), RESULT)
