"""Personal data by weak supervision.

Exact base patterns find emails, IP addresses, cards and phones; their spans always stay. Wider
patterns propose further candidates (spelt-out addresses, IPv6, local phone numbers, identity
numbers, secrets). Five labelers - strict pattern, checksum, gazetteer, context words and shape - vote
for, against or not at all on every candidate of the corpus. Votes are counted over all documents as
patterns (kind, votes, length class), of which there are at most ``6 * 3^5 * 4``, so the driver sees
a table of fixed size. From it expectation-maximisation estimates, per kind, how reliable each
labeler is and how likely each pattern is real, and a logistic span classifier is trained on those
likelihoods. Candidates it accepts are added unless a base span of their kind overlaps them.

Texts are scanned once; what is kept per document is its spans. All patterns are linear in the text.
Defined results: a null or empty text has no spans. Repeated rows and null ids are scanned like any
row. Offsets are code points, ends exclusive. Other columns play no part. An empty table gives an
empty result, and without candidates the classifier accepts nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import TextFunction, map_texts, stored

# Kinds in the order of the output.
KINDS = ("email", "ip", "card", "phone", "id", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns. A lookbehind only skips starts that could not match anyway.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Wider patterns, for candidates only.
_SPELT_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9])"
)
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z])")
_IDENTITY = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,128}(?![A-Za-z0-9+/_-])")

# Gazetteers and context words.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io de fr es it nl uk us ca eu ch at".split())
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
SECRET_PREFIXES = ("sk_", "pk_", "ghp_", "AKIA", "xox")
CONTEXT = {
    "email": re.compile("mail|contact|write to|reach|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login|from ", re.I),
    "card": re.compile("card|visa|credit|payment|karte|carte|tarjeta", re.I),
    "phone": re.compile("phone|tel|call|fax|mobile|cell|text me", re.I),
    "id": re.compile("ssn|social|tax|identity|passport", re.I),
    "secret": re.compile("token|secret|key|passw|auth|bearer|credential", re.I),
}
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done and (domain := _DOMAIN.match(text, at)):
            start = at
            while start > done and text[start - 1] in _LOCAL_CLASS:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns that pass their check, by kind, then place."""
    spans = [("email", a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                spans.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _votes(kind: str, text: str, start: int, end: int, strict: bool) -> list[int]:
    value = text[start:end]
    digits = _digits(value)
    if kind == "email":
        top = re.split(r"\.|\bdot\b|\W+", value)[-1].lower()
        checksum = 1 if top.isalpha() and 2 <= len(top) <= 6 else -1
        gazetteer = 1 if top in TOP_DOMAINS else -1
    elif kind == "ip":
        parts = value.split(".")
        checksum = 1 if ":" in value or all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        gazetteer = -1 if value.startswith(("0.", "0:")) else 0
    elif kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[0] in "3456" and len(digits) in (15, 16) else -1
    elif kind == "phone":
        checksum = 1 if 9 <= len(digits) <= 15 else -1
        plus = value.startswith("+")
        gazetteer = (1 if digits.startswith(CALLING_CODES) else -1) if plus else (1 if digits[0] in "23456789" else -1)
    elif kind == "id":
        checksum = 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" else -1
        gazetteer = 0
    else:
        checksum = 1 if _entropy(value) >= 3.0 else -1
        known = len(value) in (32, 40, 64) and re.fullmatch("[0-9a-fA-F]+", value)
        gazetteer = 1 if known or value.startswith(SECRET_PREFIXES) else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    joined = before.isalnum() or after.isalnum() or before in ("/", "#") and before != ""
    context = 1 if CONTEXT[kind].search(text, max(0, start - 40), start) else 0
    return [1 if strict else 0, checksum, gazetteer, context, -1 if joined else 1]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, bool]]:
    """Base spans and what the wider patterns find outside base spans."""
    found = [(k, a, b, True) for k, a, b in base]
    taken = [(a, b) for _, a, b in base]

    def add(kind: str, matches: Iterator[re.Match[str]], fits: Callable[[str], bool] = lambda v: True) -> None:
        for m in matches:
            a, b = m.span()
            if fits(m.group()) and not any(a < y and x < b for x, y in taken):
                found.append((kind, a, b, False))
                taken.append((a, b))

    if re.search(r"[ (\[]dot[ )\]]", text):
        add("email", _SPELT_EMAIL.finditer(text))
    if re.search("[0-9]", text):
        add("ip", _IPV6.finditer(text))
        add("id", _IDENTITY.finditer(text))
        add("phone", _LOCAL_PHONE.finditer(text))
        add("card", _CARD.finditer(text), lambda v: 13 <= len(_digits(v)) <= 19)
        mixed = lambda v: len(_digits(v)) >= 4 and sum(c.isalpha() for c in v) >= 4
        add("secret", _SECRET.finditer(text), mixed)
    return found


def _length_class(size: int) -> int:
    return 0 if size < 12 else 1 if size < 20 else 2 if size < 33 else 3


SPAN = "struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,size:int>"


def scan(docs: DataFrame, text: str, keep: list[str], name: str = "spans") -> DataFrame:
    """The columns of ``keep`` and ``name``: all candidates with their votes."""

    def make() -> TextFunction:
        def find(texts: list[str]) -> tuple[None, dict[str, list]]:
            out = []
            for t in texts:
                rows = []
                for kind, a, b, base in candidates(t, base_spans(t)):
                    rows.append(
                        {
                            "kind": KINDS.index(kind),
                            "start": a,
                            "end": b,
                            "base": base,
                            "votes": _votes(kind, t, a, b, base),
                            "size": _length_class(b - a),
                        }
                    )
                out.append(rows)
            return None, {name: out}

        return find

    return map_texts(docs, make, f"{name} array<{SPAN}>", text, keep)


def reliabilities(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """How likely each vote pattern is real: two-coin expectation-maximisation per kind.

    Every labeler starts, and is held by pseudo-counts, at what is believed of it: ten cases with 0.7
    of the votes right, and for checksums a hundred cases in which a real span hardly ever fails.
    """
    likely = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float) - 2 * votes[:, 1]))
    # Cases with vote -1, 0 and +1 among those that are not real, and among real ones.
    usual = np.array([[5.5, 2.5, 2.0], [2.0, 2.5, 5.5]])
    checksum = np.array([[85.0, 5.0, 10.0], [1.0, 9.0, 90.0]])
    for kind in np.unique(kinds):
        mine = kinds == kind
        v, n, p = votes[mine] + 1, counts[mine].astype(float), likely[mine]
        for _ in range(rounds):
            share = (1 + (n * p).sum()) / (2 + n.sum())
            log = np.stack([np.full(len(v), math.log(1 - share)), np.full(len(v), math.log(share))])
            for labeler in range(v.shape[1]):
                for real, weight in ((0, n * (1 - p)), (1, n * p)):
                    seen = np.bincount(v[:, labeler], weights=weight, minlength=3)
                    seen += (checksum if labeler == 1 else usual)[real]
                    log[real] += np.log(seen / seen.sum())[v[:, labeler]]
            p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        likely[mine] = p
    return likely


def _features(kinds: np.ndarray, votes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    columns = [np.ones(len(kinds))]
    columns += [kinds == k for k in range(len(KINDS))]
    columns += [votes[:, i] == v for i in range(votes.shape[1]) for v in (-1, 1)]
    columns += [(kinds == k) & (votes[:, 1] == -1) for k in range(len(KINDS))]
    columns += [sizes == s for s in range(4)]
    return np.stack(columns, axis=1).astype(float)


def train(patterns: list[tuple[int, list[int], int, int]]) -> np.ndarray:
    """Weights of the span classifier from (kind, votes, length class, count) rows."""
    if not patterns:
        return np.zeros(0)
    kinds = np.array([p[0] for p in patterns])
    votes = np.array([p[1] for p in patterns])
    sizes = np.array([p[2] for p in patterns])
    counts = np.array([p[3] for p in patterns])
    target = reliabilities(kinds, votes, counts)
    x = _features(kinds, votes, sizes)
    share = counts / counts.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(2000):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        weights -= 2.0 * (x.T @ (share * (p - target)) + 1e-4 * weights)
    return weights


def fit(spans: DataFrame, name: str = "spans") -> np.ndarray:
    """Train on the vote patterns of all candidates; the collected table has a fixed largest size."""
    s = spans.select(F.explode(name).alias("s")).groupBy("s.kind", "s.votes", "s.size").count()
    return train(sorted((r["kind"], list(r["votes"]), r["size"], r["count"]) for r in s.collect()))


def accepted(weights: np.ndarray, span: Column) -> Column:
    """Whether a span is reported: base spans always, others by the classifier."""
    if not len(weights):
        return span["base"]
    w = iter(weights.tolist())
    terms = [F.lit(next(w))]
    on = lambda condition: F.when(condition, F.lit(next(w))).otherwise(F.lit(0.0))
    terms += [on(span["kind"] == k) for k in range(len(KINDS))]
    terms += [on(F.get(span["votes"], F.lit(i)) == v) for i in range(len(LABELERS)) for v in (-1, 1)]
    terms += [on((span["kind"] == k) & (F.get(span["votes"], F.lit(1)) == -1)) for k in range(len(KINDS))]
    terms += [on(span["size"] == s) for s in range(4)]
    return span["base"] | (sum(terms[1:], terms[0]) >= 0)


def find_personal_data(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "spans"
) -> DataFrame:
    """The columns of ``keep`` and ``name``, an array of (kind, start, end, base), sorted."""
    found = stored(scan(docs, text, list(keep), name))
    weights = fit(found, name)
    chosen = F.filter(name, lambda s: accepted(weights, s))
    plain = F.transform(chosen, lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"]))
    return found.select(*keep, F.array_sort(plain).alias(name))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, the checksum of their list, and the list of all spans."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select(
        key,
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents, all columns, with every reported span replaced by its kind in brackets.

    Spans that overlap are replaced as one, by the kind of the longest of them (the first of equally
    long ones). ``length`` names the column that holds the number of characters of the text, if there
    is one.
    """
    spans = "_pii_spans"
    found = find_personal_data(docs, text, (*docs.columns,), spans)
    by_place = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    brackets = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # The text up to the open union of spans, where that ends, its longest span and kind.
    start = F.struct(
        F.lit("").alias("done"),
        F.lit(0).alias("at"),
        F.lit(0).alias("longest"),
        F.lit(None).cast("int").alias("kind"),
    )
    name_of = lambda state: F.coalesce(F.get(brackets, state["kind"]), F.lit(""))

    def step(state: Column, s: Column) -> Column:
        size = s["end"] - s["start"]
        longer = size > state["longest"]
        wider = F.struct(
            state["done"].alias("done"),
            F.greatest(state["at"], s["end"]).alias("at"),
            F.greatest(state["longest"], size).alias("longest"),
            F.when(longer, s["kind"]).otherwise(state["kind"]).alias("kind"),
        )
        piece = F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"])
        following = F.struct(
            F.concat(state["done"], name_of(state), piece).alias("done"),
            s["end"].alias("at"),
            size.alias("longest"),
            s["kind"].alias("kind"),
        )
        return F.when(s["start"] >= state["at"], following).otherwise(wider)

    masked = F.aggregate(
        by_place,
        start,
        step,
        lambda state: F.concat(
            state["done"], name_of(state), F.substring(F.col(text), state["at"] + 1, F.length(text))
        ),
    )
    new = F.when(F.size(spans) > 0, masked).otherwise(F.col(text))
    changed = found.withColumn("_pii_new", new)
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col("_pii_new").alias(c))
        elif length is not None and c == length:
            kind = docs.schema[c].dataType
            counted = F.length("_pii_new").cast(kind)
            columns.append(F.when(F.size(spans) > 0, counted).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return changed.select(*columns)
