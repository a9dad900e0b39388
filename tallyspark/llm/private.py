"""Personal data by weak supervision.

Candidate spans come from patterns. The base kinds (email, ip, card, phone) have fixed rules
and are always reported. Further candidates (obfuscated addresses, phones without a country
code, social security and bank account numbers, hardware addresses, titled names) are reported
when a span classifier accepts them. The classifier is trained without labels:

* labelers vote on every candidate, base ones included: its strict pattern, its checksum or
  ranges (regex side), word lists of given names, mail hosts and calling codes (gazetteer), and
  cue words before it for or against personal data (context). A labeler may abstain.
* Spark counts the candidates of the whole corpus by kind and votes. These counts are the
  sufficient statistics, and there are at most ``kinds * 3 ** labelers`` of them.
* expectation-maximisation over the counts estimates each labeler's reliability and the
  posterior of every vote pattern, and a logistic classifier of kind and votes is trained on
  the posteriors weighted by the counts.

Offsets are code points, ends exclusive. Null text counts as empty; every document gives one
row; only the id and text columns are read. All patterns run in time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("obscured_email", "local_phone", "ssn", "iban", "mac", "name")
KINDS = BASE_KINDS + MORE_KINDS
LABELERS = ("form", "check", "gazetteer", "cue_for", "cue_against")
ACCEPT = 0.5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failing run of digits is consumed, which skips only starts that fail as well
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_MORE = {
    "obscured_email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63})+"
    ),
    "local_phone": re.compile(r"\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "mac": re.compile(r"(?<![0-9A-Fa-f:-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:-])"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señora?)\.? [A-Z][\w'-]{1,30}(?: [A-Z][\w'-]{1,30})?"),
}
#: Each further pattern needs one of these strings in the text.
_NEEDS = {"obscured_email": ("at]", "at)"), "local_phone": ("(",), "ssn": ("-",), "iban": ("",), "mac": (":", "-")}

GIVEN_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda david elizabeth maria anna peter thomas hans karl "
    "jean pierre marie sophie jose juan carmen luis ana paul laura martin julia".split()
)
_HOST = re.compile(r"(?:mail|smtp|post)[0-9]*\.|(?:gmail|yahoo|outlook|hotmail|gmx|proton)\.", re.I)
_CUE_FOR = re.compile(
    r"mail|contact|kontakt|write to|phone|call|tel|fax|mobile|card|visa|mastercard|account|iban|ssn|social security|"
    r"address|name|patient|customer|host|server|client|login|born",
    re.I,
)
_CUE_AGAINST = re.compile(r"version|release|build|isbn|issn|token|commit|sha|md5|chapter|section|figure|serial|model|order no", re.I)
CUE_WINDOW = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and _LOCAL.match(text, start - 1):
                start -= 1
            host = _DOMAIN.match(text, at + 1) if start < at else None
            if host:
                out.append((start, host.end()))
                done = host.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base kinds by their fixed rules."""
    ips, cards, phones = [], [], []
    for m in _IP.finditer(text) if "." in text else ():
        if m[1] and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            ips.append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
            phones.append(m.span())
    return {"email": _emails(text), "ip": ips, "card": cards, "phone": phones}


def further_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates that overlap no base span and no earlier candidate."""
    found: list[tuple[str, int, int]] = []
    for kind, pattern in _MORE.items():
        if not any(s in text for s in _NEEDS.get(kind, ("",))):
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    out: list[tuple[str, int, int]] = []
    if found:
        starts, ends = _disjoint(taken)
        for kind, start, end in sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))):
            i = bisect_right(ends, start)  # the first base stretch that ends behind the start
            if not (i < len(starts) and starts[i] < end) and not (out and start < out[-1][2]):
                out.append((kind, start, end))
    return out


def _disjoint(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends, in order, of the stretches that the spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _iban_ok(span: str) -> bool:
    s = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """One vote per labeler: 1 personal, -1 not, 0 abstains."""
    span, before = text[start:end], text[max(0, start - CUE_WINDOW) : start]
    digits = _DIGITS.sub("", span)
    tight = end < len(text) and (text[end].isalnum() or text[end] in "_=/")
    tight = tight or (start > 0 and (text[start - 1].isalnum() or text[start - 1] in '_=/"'))
    check, known = 0, 0
    if kind in ("card", "ip", "email"):
        check = 1
    elif kind == "ssn":
        check = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind == "iban":
        check = 1 if _iban_ok(span) else -1
    elif kind == "local_phone":
        check = -1 if digits[0] in "01" or digits[3] in "01" else 1
    if kind in ("email", "obscured_email"):
        known = 1 if _HOST.search(span) else 0
    elif kind == "name":
        known = 1 if any(w.lower() in GIVEN_NAMES for w in span.split()[1:]) else -1
    elif kind == "phone":
        known = 1 if digits[0] in "1234567" else 0
    return (-1 if tight else 1, check, known, 1 if _CUE_FOR.search(before) else 0, -1 if _CUE_AGAINST.search(before) else 0)


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, votes, n`` over all candidates of the corpus (votes as text, one sign each)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in small_batches(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    for kind, spans in base.items():
                        seen.update((kind, votes(text, kind, *s)) for s in spans)
                    taken = [s for spans in base.values() for s in spans]
                    seen.update((k, votes(text, k, s, e)) for k, s, e in further_spans(text, taken))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in seen], pa.string()),
                pa.array(["".join("-0+"[v + 1] for v in vs) for _, vs in seen], pa.string()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            ["kind", "votes", "n"],
        )

    parts = docs.select(text_col).mapInArrow(count, "kind string, votes string, n long")
    return parts.groupBy("kind", "votes").agg(F.sum("n").alias("n"))


def expectation_maximisation(votes_: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Reliability of each labeler and the posterior of each vote pattern.

    ``votes_`` has a row per pattern and a column per labeler; ``n`` counts the patterns. A
    labeler that speaks is right with its reliability; estimates are smoothed with a Beta(8, 2)
    prior, so a labeler that hardly speaks keeps 0.8.
    """
    right, prior = np.full(votes_.shape[1], 0.8), 0.5
    post = np.full(len(n), 0.5)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes_ @ np.log(right / (1 - right))
        post = 1 / (1 + np.exp(-odds))
        agree = (n[:, None] * np.where(votes_ > 0, post[:, None], np.where(votes_ < 0, 1 - post[:, None], 0))).sum(0)
        spoke = (n[:, None] * (votes_ != 0)).sum(0)
        right = np.clip((agree + 8) / (spoke + 10), 0.55, 0.99)
        prior = float(np.clip((n @ post + 1) / (n.sum() + 2), 0.05, 0.95))
    return right, post


def _design(kinds: list[str], votes_: np.ndarray) -> np.ndarray:
    one_hot = np.array([[k == x for x in KINDS] for k in kinds], float).reshape(len(kinds), len(KINDS))
    return np.hstack([np.ones((len(kinds), 1)), one_hot, votes_, (votes_ > 0).sum(1, keepdims=True) >= 2])


def train(counts: list[tuple[str, str, int]]) -> np.ndarray:
    """Weights of the span classifier from the corpus's vote counts (bounded rows)."""
    counts = sorted(counts)
    if not counts:
        return np.zeros(1 + len(KINDS) + len(LABELERS) + 1)
    votes_ = np.array([["-0+".index(c) - 1 for c in v] for _, v, _ in counts], float)
    n = np.array([c[2] for c in counts], float)
    _, post = expectation_maximisation(votes_, n)
    x = _design([c[0] for c in counts], votes_)
    weights, share = np.zeros(x.shape[1]), np.sqrt(n) / np.sqrt(n).sum()
    for _ in range(200):  # Newton steps would do, but the table is tiny
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= 2.0 * (x.T @ (share * (p - post)) + 1e-4 * weights)
    return weights


def accepted(weights: np.ndarray, kind: str, vote: tuple[int, ...]) -> bool:
    return float((_design([kind], np.array([vote], float)) @ weights)[0]) >= np.log(ACCEPT / (1 - ACCEPT))


def find(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    known: dict = {}

    def decide(kind, vote):
        if (kind, vote) not in known:
            known[kind, vote] = accepted(weights, kind, vote)
        return known[kind, vote]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                listed = [f"{k}:{s}:{e}" for k in BASE_KINDS for s, e in base[k]]
                taken = [s for spans in base.values() for s in spans]
                more = [c for c in further_spans(text, taken) if decide(c[0], votes(text, *c))]
                more = [f"{k}:{s}:{e}" for k, s, e in sorted(more, key=lambda c: (KINDS.index(c[0]), c[1]))]
                digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
                out.append((*(len(base[k]) for k in BASE_KINDS), digest, ",".join(listed + more)))
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField(x, T.LongType()) for x in names[1:5]] + [T.StructField(x, T.StringType()) for x in names[5:]]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, T.StructType(fields))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count votes over the corpus, train the classifier, and report every document's spans."""
    counts = [tuple(r) for r in vote_counts(docs, text_col).collect()]  # at most kinds * 3 ** labelers rows
    return find(docs, train(counts), id_col, text_col)
