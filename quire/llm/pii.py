"""Personal data by weak supervision.

Candidate spans are the strict ("base") matches of four kinds and looser ones.  Labelers vote
on every candidate (+1, -1 or 0 for no opinion): regular expressions for its shape, a
gazetteer, and context words before it.  Expectation-maximisation over the vote patterns of
the whole corpus estimates each labeler's reliability without labels; its posteriors are the
soft labels of a logistic span classifier over votes and shape.  Base spans are always
returned; a loose candidate is returned if the classifier accepts it and it overlaps none.

Only counts of (kind, votes, shape) leave the tasks: at most 4 * 3**3 * 48 rows reach the
driver however large the corpus.  Null and empty texts have no spans.  Offsets are code
points, the end exclusive.  Repeated rows are treated one by one.  All searches take time
linear in the text.  An empty table gives an empty result; with no candidates the
classifier accepts nothing.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# fixed by the contract of the operator; patterns that start with digits are tried at the
# start of every digit run only (no later start in a run can match), which keeps them linear
_RUN = re.compile(r"[0-9]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# looser shapes of the same kinds
_AT = re.compile(r"[\[({<] ?(?:at|AT|arobase|arroba) ?[\])}>]")
_DOT_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?[\[({<] ?(?:dot|DOT|point|punkt|punto) ?[\])}>] ?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,6}")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_CARD_LOOSE = re.compile(r"[0-9]{4}(?:[ ./_-])[0-9]{4}(?:[ ./_-])[0-9]{4}(?:[ ./_-])[0-9]{4}(?![0-9])")
_PHONE_LOOSE = re.compile(r"(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")

_CUES = {
    "email": re.compile(r"mail|contact|write|correo|courriel|kontakt|schreib", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|serveur|servidor", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|carte|tarjeta|karte|kredit", re.I),
    "phone": re.compile(r"tel|phone|call|mobile|fax|ruf|appel|llam", re.I),
}
_COUNTER_CUES = re.compile(r"version|license|token|section|page|isbn|doi|order|invoice|=\s*$|#\s*$", re.I)
_TLDS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu ch at be us ca au jp".split())
_COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 81 86 91".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30|36")
LABELERS = ("shape", "gazetteer", "context")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _left(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _runs(text: str) -> list[int]:
    return [m.start() for m in _RUN.finditer(text)]


def _at_runs(pattern: re.Pattern, text: str, starts: list[int]):
    """Leftmost matches that do not overlap, tried at the given places."""
    last = 0
    for start in starts:
        if start >= last and (m := pattern.match(text, start)):
            yield m
            last = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the strict matches, in order."""
    found, last = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = _left(text, m.start(), last)
            if start < m.start():
                found.append((start, 0, m.end()))
                last = m.end()
    runs = _runs(text)
    for m in _at_runs(_IP, text, runs):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _at_runs(_CARD, text, runs):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span and, in order, one another."""
    found, last = [], 0
    for m in _AT.finditer(text):
        stop = m.start() - (text[m.start() - 1:m.start()] == " ")
        start = _left(text, stop, last)
        if start < stop and (domain := _DOT_DOMAIN.match(text, m.end())):
            found.append((start, 0, domain.end()))
            last = domain.end()
    if text.count(":") >= 7:
        found += [(m.start(), 1, m.end()) for m in _IP6.finditer(text)]
    runs = _runs(text)
    found += [(m.start(), 2, m.end()) for m in _at_runs(_CARD_LOOSE, text, runs)]
    opened = [r - (text[r - 1:r] == "(") for r in runs if text[r - 1:r] != "+"]
    found += [(m.start(), 3, m.end()) for m in _at_runs(_PHONE_LOOSE, text, opened)]
    out, i, upto = [], 0, 0
    for span in sorted(found):
        while i < len(base) and base[i][2] <= span[0]:
            i += 1
        if span[0] >= upto and not any(b[0] < span[2] and b[2] > span[0] for b in base[i:i + 4]):
            out.append(span)
            upto = span[2]
    return out


def features(text: str, span: tuple[int, int, int], is_base: bool) -> tuple[int, tuple[int, int, int], int]:
    """(kind index, votes, shape code under 48) of a candidate."""
    start, kind, end = span
    inside, before = text[start:end], text[max(0, start - 40):start]
    digits = "".join(c for c in inside if "0" <= c <= "9")
    if kind == 0:
        shape = 1 if is_base else 0
        tail = re.split(r"[^A-Za-z]+", inside)[-1].lower()
        gazetteer = 1 if tail in _TLDS else -1
    elif kind == 1:
        shape = 1
        gazetteer = -1 if inside.startswith(("0.", "255.255.")) else 1 if inside.startswith(("10.", "192.168.", "172.")) else 0
    elif kind == 2:
        shape = 1 if luhn(digits) else -1
        gazetteer = 1 if _ISSUERS.match(digits) else -1
    else:
        shape = 1 if 10 <= len(digits) <= 15 else -1
        code = inside[1:4] if inside[0] == "+" else ""
        gazetteer = (1 if any(code.startswith(c) for c in _COUNTRY_CODES) else -1) if code else 0
    context = 1 if _CUES[KINDS[kind]].search(before) else -1 if _COUNTER_CUES.search(before) else 0
    separators = len({c for c in inside if not c.isalnum()})
    code = min(separators, 3) + 4 * min(len(inside) // 8, 5) + 24 * is_base
    return kind, (shape, gazetteer, context), code


def _strings(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").alias("text"))


def _parts(batches, column: str, rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def candidate_counts(docs: DataFrame, text: str = "text") -> dict[tuple, int]:
    """Candidates of the whole corpus by (kind, votes, shape)."""
    def counted(batches):
        seen = Counter()
        for _, texts in _parts(batches, "text"):
            for t in filter(None, texts):
                base = base_spans(t)
                seen.update(features(t, s, True) for s in base)
                seen.update(features(t, s, False) for s in loose_spans(t, base))
        rows = [(k, *v, c, n) for (k, v, c), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 6)],
                                         ["kind", "v0", "v1", "v2", "code", "n"])

    schema = "kind bigint, v0 bigint, v1 bigint, v2 bigint, code bigint, n bigint"
    rows = (_strings(docs, text).mapInArrow(counted, schema)
            .groupBy("kind", "v0", "v1", "v2", "code").agg(F.sum("n").alias("n")).collect())
    return {(r.kind, (r.v0, r.v1, r.v2), r.code): r.n for r in sorted(rows)}


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, list, dict]:
    """EM for one kind: (share of true spans, per labeler {class: {vote: rate}}, posterior of each pattern)."""
    prior = 0.5
    rate = [{1: {1: 0.7, 0: 0.2, -1: 0.1}, 0: {1: 0.2, 0: 0.3, -1: 0.5}} for _ in LABELERS]
    post: dict = {}
    for _ in range(rounds):
        for votes in patterns:
            odds = log(prior / (1 - prior)) + sum(log(rate[j][1][v] / rate[j][0][v]) for j, v in enumerate(votes))
            post[votes] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
        total = sum(patterns.values())
        prior = min(0.99, max(0.01, sum(n * post[v] for v, n in patterns.items()) / total))
        for j in range(len(LABELERS)):
            for true in (1, 0):
                mass = {v: 1.0 for v in (1, 0, -1)}           # one vote of each kind as a prior
                for votes, n in patterns.items():
                    mass[votes[j]] += n * (post[votes] if true else 1 - post[votes])
                rate[j][true] = {v: m / sum(mass.values()) for v, m in mass.items()}
    return prior, rate, post


def _row(kind: int, votes: tuple, code: int) -> np.ndarray:
    x = np.zeros(1 + 4 + 12 + 6 + 10)
    x[0] = 1
    x[1 + kind] = 1
    for j, v in enumerate(votes):
        x[5 + 3 * j + v + 1] = 1
    x[17 + code % 4] = 1
    x[23 + (code % 24) // 4] = 1
    x[30] = code >= 24
    return x


def fit(counts: dict[tuple, int], rounds: int = 300) -> dict:
    """Label model and span classifier from the corpus counts."""
    post, priors = {}, {}
    for kind in range(len(KINDS)):
        patterns = Counter()
        for (k, votes, _), n in counts.items():
            if k == kind:
                patterns[votes] += n
        if patterns:
            priors[KINDS[kind]], rate, found = reliabilities(dict(patterns))
            post |= {(kind, v): p for v, p in found.items()}
    if not counts:
        return {"weights": np.zeros(33), "priors": priors, "empty": True}
    x = np.array([_row(*key) for key in counts])
    y = np.array([post[k, v] for k, v, _ in counts])
    n = np.sqrt(np.array(list(counts.values()), float))      # damped, so that a frequent shape is not all
    w = np.zeros(x.shape[1])
    for _ in range(rounds):                                   # gradient descent with a small ridge
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (n * (p - y)) / n.sum() + 1e-4 * w)
    return {"weights": w, "priors": priors, "empty": False}


def find(text: str | None, model: dict, threshold: float = 0.5) -> tuple[list, list]:
    """(base spans, added spans) of one text."""
    if not text:
        return [], []
    base = base_spans(text)
    if model["empty"]:
        return base, []
    accept = {}
    added = []
    for span in loose_spans(text, base):
        key = features(text, span, False)
        if key not in accept:
            accept[key] = 1 / (1 + exp(-float(_row(*key) @ model["weights"]))) >= threshold
        if accept[key]:
            added.append(span)
    return base, added


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def tag(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans): counts of base spans; spans as kind:start:end lists."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def tagged(batches):
        for part, texts in _parts(batches, "text"):
            out = [[] for _ in range(6)]
            for t in texts:
                base, added = find(t, model, threshold)
                per = Counter(k for _, k, _ in base)
                for k in range(4):
                    out[k].append(per[k])
                out[4].append(_written(base))
                out[5].append(_written(base + added))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[pa.array(c, pa.int64()) for c in out[:4]], *[pa.array(c, pa.string()) for c in out[4:]]],
                ["id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    schema = f"id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string"
    return rows.mapInArrow(tagged, schema).withColumnRenamed("id", key)


def redact_text(text: str | None, model: dict, threshold: float = 0.5) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    spans = sorted(sum(find(text, model, threshold), []))
    if not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: dict, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced; columns, order of columns and types stay."""
    names = docs.columns
    at = names.index(text)

    def redacted(batches):
        for part, texts in _parts(batches, text):
            columns = list(part.columns)
            columns[at] = pa.array([redact_text(t, model, threshold) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(redacted, docs.schema)
