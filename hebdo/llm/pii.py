"""Personal data by weak supervision.

Fixed patterns give the base spans, which always count. Wider patterns propose
more candidates; labelers (shape, checksum, context before, gazetteer, context
against) vote on every one of them. Expectation-maximisation over the counted
vote patterns estimates each labeler's reliability per kind, and its
posteriors train the span classifier that decides the candidates.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash

if TYPE_CHECKING:  # the workers that read texts do without pandas
    import pandas as pd

#: base kinds in their order, then the method's own
KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "person", "secret"]
BASE = KINDS[:4]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: a run of digits is tried from its first one only, and gives nothing back: linear on long runs
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_MORE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\(@\)) ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]+)+"),
    "phone": re.compile(r"(?<![\w.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "person": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-Z][a-zà-ÿ]+(?: [A-Z][a-zà-ÿ]+)?"),
    "secret": re.compile(r"""(?i)\b(?:token|secret|password|passwd|api_?key)\s*[=:]\s*["']?[A-Za-z0-9_/+.-]{12,}"""),
}
_CUES = {
    "email": re.compile(r"(?i)mail|contact|write|schreib|correo|courriel|@"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address|adress"),
    "card": re.compile(r"(?i)card|visa|master|karte|carte|tarjeta|credit|kredit"),
    "phone": re.compile(r"(?i)phone|call|tel|mobil|fax|ruf|llam|appel"),
    "iban": re.compile(r"(?i)iban|bank|konto|account|compte|cuenta"),
    "ssn": re.compile(r"(?i)ssn|social|security|sozial"),
    "person": re.compile(r"(?i)name|dear|contact|liebe|cher|estimad|sign"),
    "secret": re.compile(r"(?i)token|secret|password|passwd|key"),
}
_AGAINST = re.compile(r"(?i)(?:isbn|version|v\.|doi|page|chapter|section|\d|#)\s*$")
_NAMES = frozenset("james mary john maria anna peter paul anne marie jean pierre jose juan carlos hans karl julia emma "
                   "luis ana thomas michael sarah david laura".split())
_TLDS = frozenset("com org net edu gov de fr es uk io info eu".split())


@dataclass(frozen=True)
class PiiParams:
    context: int = 40       # characters before a span that context labelers read
    rounds: int = 50
    accept: float = 0.9     # posterior from which a candidate becomes a span


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, end exclusive, per kind leftmost and not overlapping."""
    out = [(a, b, "email") for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    out = []
    for kind, pattern in _MORE.items():
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return out


def _checksum(kind: str, span: str) -> int:
    digits = _NOT_DIGIT.sub("", span)
    if kind == "card":
        return 1 if 14 <= len(digits) <= 19 and _luhn(digits) else -1
    if kind == "iban":
        s = span.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 else -1
    if kind == "ssn":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    if kind == "phone":
        return 1 if 10 <= len(digits) <= 15 else -1
    if kind == "secret":
        value = re.split(r"[=:]\s*[\"']?", span, maxsplit=1)[-1]
        return 1 if len(set(value)) >= 8 and re.search("[0-9]", value) and re.search("[A-Za-z]", value) else -1
    return 0


def votes(text: str, span: tuple[int, int, str], context: int) -> tuple[int, ...]:
    """Votes of the labelers on a span: 1 for, -1 against, 0 none."""
    start, end, kind = span
    body, before = text[start:end], text[max(0, start - context):start]
    exact = any(a == start and b == end for a, b, _ in base_spans(body)) if kind in BASE else False
    shape = 1 if exact or (kind not in BASE and len(body) >= 9) else 0
    cue = 1 if _CUES[kind].search(before) or kind == "secret" else 0
    if kind in ("email",):
        gazetteer = 1 if re.split(r"[. ]", body.lower().replace("]", " ").replace(")", " "))[-1] in _TLDS else 0
    elif kind == "person":
        gazetteer = 1 if any(w.lower() in _NAMES for w in body.split()[1:]) else -1
    elif kind == "phone":
        gazetteer = 1 if body[0] in "+(" else 0
    else:
        gazetteer = 0
    return shape, _checksum(kind, body), cue, gazetteer, -1 if _AGAINST.search(before) else 0


def pattern(text: str, span: tuple[int, int, str], context: int) -> str:
    """What the classifier sees of a span: its kind, the votes, a length class and whether it is parted."""
    start, end, kind = span
    v = "".join("-0+"[x + 1] for x in votes(text, span, context))
    return f"{kind}|{v}|{min((end - start) // 8, 7)}|{int(' ' in text[start:end])}"


def estimate(counted: pd.DataFrame, rounds: int) -> pd.DataFrame:
    """EM over counted patterns (pattern, n, base): adds the posterior that such a span is personal data.

    Each kind's labelers are independent given the truth; base spans are known
    to be true and anchor their kind.
    """
    d = counted.copy()
    d["kind"] = d["pattern"].str.split("|").str[0]
    d["votes"] = d["pattern"].str.split("|").str[1]
    d["p"] = np.where(d["base"], 1.0, d["votes"].map(lambda v: 0.9 if v.count("+") > v.count("-") + 1 else
                                                     0.5 if v.count("+") > v.count("-") else 0.1))
    for _, own in d.groupby("kind"):
        v = np.array([["-0+".index(c) for c in x] for x in own["votes"]])
        n, known, p = own["n"].to_numpy(float), own["base"].to_numpy(bool), own["p"].to_numpy(float)
        for _ in range(rounds):
            prior = (n @ p + 1) / (n.sum() + 2)
            yes, no = np.log(prior) * np.ones(len(own)), np.log(1 - prior) * np.ones(len(own))
            for j in range(v.shape[1]):
                for value in range(3):
                    hit = v[:, j] == value
                    smooth = 2.0 if value == 1 else 1.0
                    # a reliable labeler is the prior belief: votes for go with the truth
                    lean = (4.0, 2.0, 1.0)[value], (1.0, 2.0, 4.0)[value]
                    yes[hit] += np.log((n[hit] @ p[hit] + lean[1] * smooth) / (n @ p + 11))
                    no[hit] += np.log((n[hit] @ (1 - p[hit]) + lean[0] * smooth) / (n @ (1 - p) + 11))
            new = np.where(known, 1.0, 1 / (1 + np.exp(np.clip(no - yes, -50, 50))))
            done = np.abs(new - p).max() < 1e-6
            p = new
            if done:
                break
        d.loc[own.index, "p"] = p
    return d


def features(patterns: pd.Series) -> np.ndarray:
    """One-hot of the votes, length class and parting, and of the kind."""
    part = patterns.str.split("|", expand=True)
    rows = [np.ones(len(patterns))]
    rows += [(part[0] == k).to_numpy(float) for k in KINDS]
    for j in range(5):
        rows += [(part[1].str[j] == c).to_numpy(float) for c in "-+"]
    rows += [(part[2].astype(int) >= c).to_numpy(float) for c in range(1, 8)]
    rows.append((part[3] == "1").to_numpy(float))
    return np.column_stack(rows)


def train(d: pd.DataFrame, ridge: float = 0.5, steps: int = 100) -> np.ndarray:
    """Logistic span classifier on EM posteriors, patterns weighted by (damped) counts."""
    x, y, w = features(d["pattern"]), d["p"].to_numpy(float), np.log1p(d["n"].to_numpy(float))
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(b)),
                               x.T @ (w * (y - p)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def settle(base: list[tuple[int, int, str]], more: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """All base spans, and those accepted candidates that overlap nothing already there."""
    order = {k: i for i, k in enumerate(KINDS)}
    out = list(base)
    for s in sorted(more, key=lambda s: (s[0], -s[1], order[s[2]])):
        if all(s[1] <= a or s[0] >= b for a, b, _ in out):
            out.append(s)
    return sorted(out, key=lambda s: (s[0], order[s[2]]))


_SPANS = "array<struct<start:int,end:int,kind:string,pattern:string,base:boolean>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
                            ("pattern", pa.string()), ("base", pa.bool_())]))
_ANY = re.compile(r"[0-9@]|\((?:at|@)\)|\[at\]|(?i:token|secret|passw|key|\b(?:mr|mrs|ms|dr|prof|herr|frau|mme|sr|sra)\b)")


def propose(docs: DataFrame, params: PiiParams, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): base spans and candidates of whole texts, with their vote patterns."""

    def run(batches):
        for rb in record_batches(batches, "text"):
            rows = []
            for text in rb.column("text").to_pylist():
                if not text or not _ANY.search(text):
                    rows.append([])
                    continue
                found = [(s, True) for s in base_spans(text)] + [(s, False) for s in candidates(text)]
                rows.append([{"start": s[0], "end": s[1], "kind": s[2], "base": b,
                              "pattern": pattern(text, s, params.context)} for s, b in found])
            yield pa.RecordBatch.from_arrays([rb.column("id"), pa.array(rows, _SPAN)], names=["id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id long, spans {_SPANS}")


def find_pii(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id_col, spans array<struct<start, end, kind, base>>), one row per row of ``docs``,
    spans by start, then kind.

    Null and empty texts have none. Null and repeated ids are treated row by
    row; other columns are ignored. Only counted vote patterns (at most kinds x
    3**5 x 8 x 2 rows) reach the driver.
    """
    params = params or PiiParams()
    seen = stash(propose(docs, params, id_col, text_col))
    taken = accepted_patterns(seen, params)

    def run(batches):
        for rb in batches:
            out = []
            for spans in rb.column("spans").to_pylist():
                s = [((x["start"], x["end"], x["kind"]), x["base"], x["pattern"]) for x in spans or ()]
                base = [x for x, b, _ in s if b]
                known = set(base)
                out.append([{"start": a, "end": b, "kind": k, "pattern": None, "base": (a, b, k) in known}
                            for a, b, k in settle(base, [x for x, b, q in s if not b and q in taken])])
            yield pa.RecordBatch.from_arrays([rb.column("id"), pa.array(out, _SPAN)], names=["id", "spans"])

    found = seen.mapInArrow(run, f"id long, spans {_SPANS}")
    return found.select(F.col("id").alias(id_col), F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"))).alias("spans"))


def accepted_patterns(seen: DataFrame, params: PiiParams) -> frozenset[str]:
    """Vote patterns that the trained classifier takes for personal data."""
    counted = (seen.select(F.explode("spans").alias("s")).groupBy("s.pattern", "s.base")
               .agg(F.count("*").alias("n")).orderBy("pattern", "base").toPandas())
    if not len(counted):
        return frozenset()
    d = estimate(counted, params.rounds)
    p = 1 / (1 + np.exp(-features(d["pattern"]) @ train(d)))
    return frozenset(d["pattern"][p >= params.accept])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans per kind, their digest, and all spans as kind:start:end."""
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        id_col, *(count(k) for k in BASE),
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.

    The classifier is trained in a first pass over the texts; a second one
    finds, decides and replaces, so no text is shuffled. Null texts stay null.
    """
    params = params or PiiParams()
    taken = accepted_patterns(stash(propose(docs, params, id_col, text_col)), params)

    def one(text: str | None) -> str | None:
        if not text or not _ANY.search(text):
            return text
        more = [s for s in candidates(text) if pattern(text, s, params.context) in taken]
        out, at = [], 0
        for start, end, kind in settle(base_spans(text), more):
            if start >= at:
                out += [text[at:start], f"<{kind.upper()}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches):
        for rb in record_batches(batches, text_col):
            i = rb.schema.get_field_index(text_col)
            yield rb.set_column(i, text_col, pa.array([one(t) for t in rb.column(i).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema)
