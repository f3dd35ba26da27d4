"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Four kinds are found: email, ip, card and phone. The base spans of each kind follow fixed rules and
always stay. Wider patterns propose more spans (addresses written with "at" and "dot", numbers
without a country prefix, other separators, defanged and long-form network addresses).

Method. Every proposed span, base ones included, gets a vote of each labeler, which may abstain:
the strict pattern, a checksum or range, gazetteers (top-level domains, calling codes, issuer
prefixes, reserved networks), cue words before the span, its borders, and what surrounds it. The
votes and a coarse shape are one small number per span, so all spans of all documents shrink to a
table of (kind, votes, shape, spans) of at most ``4 * 3**6 * SHAPES`` rows, counted by Spark.
On that table, for each kind, expectation-maximisation estimates each labeler's reliability and
the probability of every vote pattern, without labels; a logistic regression on votes and shape is
then trained on these probabilities, weighted by the counts. It scores the proposed spans, and
those of ``MIN_SCORE`` and more are added. Proposed spans that overlap a base span are not counted.

Texts are read once, in the scan; the spans travel as one slim row per document, are written, and
nothing is shuffled but the counted patterns.

Edge cases. Null text is empty; a null doc_id is kept. Texts of any length are scanned whole, and
every pattern takes time in proportion to the text. Repeated rows each give a row. Where added spans
overlap, the leftmost stays, of equal starts the longer, then the kind listed first. Empty table: no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, written

KINDS = ("email", "ip", "card", "phone")
MIN_SCORE = 0.5
EM_ROUNDS = 50
SHAPES = 32
ABSTAIN, YES, NO = 0, 1, 2
LABELERS = ("strict pattern", "checksum or range", "gazetteer", "cue words", "borders", "surroundings")

# Common top-level domains, calling codes and card issuer prefixes.
TLDS = frozenset("com org net edu gov mil int info biz io ai app dev me tv de fr es it nl be at ch uk eu us ca mx br ar cl jp cn in kr "
                 "au nz ru pl cz se no dk fi pt ie gr tr za".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92",
                 "351", "352", "353", "358", "380", "420", "421", "852", "886", "971", "972")
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "30", "36", "38", "35", "6011", "65")
CUES = {
    "email": {"mail", "email", "mails", "contact", "write", "correo", "courriel", "kontakt", "address", "reach"},
    "ip": {"ip", "host", "server", "address", "addr", "ping", "node", "router", "gateway", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "tarjeta", "carte", "kreditkarte"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "telefono", "teléfono", "téléphone", "whatsapp"}}
OTHER_CUES = frozenset("version release section chapter figure isbn issn order invoice token password sha hash serial release build patent".split())

_DIGIT = re.compile("[0-9]")
_EMAIL_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DOT = r"(?:\.| ?\[\.\] ?| ?[\[({] ?dot ?[\])}] ?| dot )"
_WIDE_AT = re.compile(r"(?: ?[\[({<] ?(?:at|@) ?[\])}>] ?| at | @ |@)"
                      rf"(?=[A-Za-z0-9])[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}(?![A-Za-z0-9])", re.IGNORECASE)
_BRACKET_AT = re.compile(r"[\[({<] ?at ?[\])}>]")
_WIDE_IP = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?: ?\[\.\] ?|\(\.\)| \. )(?:[0-9]{1,3}(?: ?\[\.\] ?|\(\.\)| \. |\.)){2}[0-9]{1,3}"
                      r"|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])")
_WIDE_NUMBER = re.compile(r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]++(?:[ ./()-]{1,2}[0-9]++)*+(?![0-9A-Za-z])")
_WORDS = re.compile(r"[^\W\d_]+")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans by the fixed rules, in order of start and kind.

    Each scan finds what the plain pattern finds from the left without overlaps, but looks at no
    character more than a few times: local parts are read backwards from their at sign, runs of
    digits are entered at their first digit only.
    """
    out = []
    if "@" in text:
        end = 0
        for m in _EMAIL_AT.finditer(text):
            at = m.start()
            start = at
            while start > end and not _LOCAL_END.match(text, start - 1):
                start -= 1
            if start < at:
                end = m.end()
                out.append((start, 0, end))
    if not _DIGIT.search(text):
        return out
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) that the wider patterns propose."""
    out = []
    low = text.lower()
    if "@" in low or " at " in low and " dot " in low or _BRACKET_AT.search(low):
        for m in _WIDE_AT.finditer(text):
            span = m[0].lower()
            if re.split("[^a-z0-9-]+", span)[-1] not in TLDS or span.startswith(" at ") and " dot " not in span:
                continue  # "at noon dot", and "at example.com", which is a place more often than an address
            start = m.start()
            while start > 0 and m.start() - start < 64:
                if not _LOCAL_END.match(text, start - 1):
                    start -= 1
                elif start < m.start() and text[start - 5:start].lower() == " dot ":
                    start -= 5
                else:
                    break
            if start < m.start():
                out.append((start, 0, m.end()))
    if ":" in text or "[.]" in text or "(.)" in text or " . " in text:
        out += [(m.start(), 1, m.end()) for m in _WIDE_IP.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for m in _WIDE_NUMBER.finditer(text):
        if m.end() - m.start() < 9:
            continue
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and "." not in m[0] and "(" not in m[0]:
            out.append((m.start(), 2, m.end()))
        if 9 <= len(d) <= 15 and len(d) < m.end() - m.start():
            out.append((m.start(), 3, m.end()))
    return out


def _vote(yes: bool, no: bool) -> int:
    return YES if yes else NO if no else ABSTAIN


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, int]:
    """The labelers' votes as one number to base three, and the shape as one below ``SHAPES``."""
    span = text[start:end]
    d = _digits(span)
    before = text[max(0, start - 40):start]
    words = [w.lower() for w in _WORDS.findall(before)][-4:]
    left, right = text[start - 1:start], text[end:end + 1]
    if kind == 0:
        tld = re.split(r"[^A-Za-z0-9-]+", span.rstrip(".-"))[-1].lower()
        check, known = _vote(tld.isalpha() and 2 <= len(tld) <= 24, True), _vote(tld in TLDS, True)
    elif kind == 1:
        parts = re.findall("[0-9]+", span) if ":" not in span else []
        good = ":" in span or len(parts) == 4 and all(map(_octet, parts))
        check = _vote(good, True)
        known = ABSTAIN if ":" in span else _vote(good and 0 < int(parts[0]) < 224 and int(parts[0]) != 127, True)
    elif kind == 2:
        check, known = _vote(luhn(d), True), _vote(d.startswith(ISSUERS), True)
    else:
        dated = re.match(r"(?:19|20)\d\d[./-]\d{1,2}[./-]|\d{1,2}[./-]\d{1,2}[./-](?:19|20)\d\d", span) is not None
        decimal = re.fullmatch(r"[0-9]+\.[0-9]+|[0-9.]+", span) is not None
        grouped = re.search(r"[0-9]{3,4}[ .-]?[0-9]{2,4}$", span) is not None
        check = _vote(not dated and not decimal and grouped and 9 <= len(d) <= 13, dated or decimal or luhn(d) and len(d) >= 13)
        known = _vote(span.startswith("+") and d.startswith(CALLING_CODES) or span.startswith("00") and d[2:].startswith(CALLING_CODES)
                      or span.startswith("("), False)
    cue = _vote(not CUES[KINDS[kind]].isdisjoint(words), not OTHER_CUES.isdisjoint(words))
    glued = (left.isalnum() or left in tuple("_=\"'/#$.-")) and left != "" or right.isalnum() or right in tuple("_=\"'/#%") and right != ""
    around = text[max(0, start - 20):start] + text[end:end + 20]
    crowd = sum(c.isdigit() for c in around) > 0.5 * max(1, len(around))
    code = 0
    for v in (YES if strict else ABSTAIN, check, known, cue, NO if glued else YES, NO if crowd else ABSTAIN):
        code = code * 3 + v
    seps = len(set(re.findall(r"[^0-9A-Za-z]", span)))
    return code, min(3, seps) * 8 + min(7, (end - start) // 4)


def apart(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of ``taken``."""
    if not spans or not taken:
        return spans
    blocks: list[list[int]] = []  # the union of the taken ranges
    for s, _, e in sorted(taken):
        if blocks and s < blocks[-1][1]:
            blocks[-1][1] = max(blocks[-1][1], e)
        else:
            blocks.append([s, e])
    ends = [e for _, e in blocks]
    out = []
    for s, k, e in spans:
        at = bisect.bisect_right(ends, s)
        if at == len(blocks) or blocks[at][0] >= e:
            out.append((s, k, e))
    return out


_PROPOSED = "array<struct<kind:int,start:long,stop:long,code:int,shape:int>>"
SCAN_SCHEMA = f"doc_id long, base {_PROPOSED}, more {_PROPOSED}"
_ARROW = pa.schema([("doc_id", pa.int64())] + [(n, pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("code", pa.int32()), ("shape", pa.int32())])))
    for n in ("base", "more")])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def spans(text: str, found: list[tuple[int, int, int]], strict: bool) -> list[dict]:
        out = []
        for start, kind, end in found:
            code, shape = votes(text, start, kind, end, strict)
            out.append({"kind": kind, "start": start, "stop": end, "code": code, "shape": shape})
        return out

    for b in batches:
        base, more = [], []
        for cell in b.column(1):
            text = cell.as_py() or ""
            own = base_spans(text)
            base.append(spans(text, own, True))
            more.append(spans(text, apart(wide_spans(text), own), False))
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(base, _ARROW.field(1).type), pa.array(more, _ARROW.field(2).type)],
                                         schema=_ARROW)


def _vote_matrix(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3 ** k % 3 for k in reversed(range(len(LABELERS)))], axis=1)


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: (rates, probability of each pattern).

    ``rates[y, j, v]`` is the share of vote v (abstain, yes, no) of labeler j on spans that are
    (y = 1) or are not (y = 0) personal data. Pseudo-counts that take a labeler to be right in
    four of five votes keep rare kinds steady; the first probabilities come from the majority.
    """
    votes_of = _vote_matrix(codes)
    lead = (votes_of == YES).sum(1) - (votes_of == NO).sum(1)
    p = 1 / (1 + np.exp(-1.5 * (lead - 1.0)))
    prior = np.array([[[3.0, 1.0, 4.0]] * len(LABELERS), [[3.0, 4.0, 1.0]] * len(LABELERS)])
    for _ in range(rounds):
        rates = prior.copy()
        for v in (ABSTAIN, YES, NO):
            rates[1, :, v] += ((votes_of == v) * (p * counts)[:, None]).sum(0)
            rates[0, :, v] += ((votes_of == v) * ((1 - p) * counts)[:, None]).sum(0)
        rates /= rates.sum(2, keepdims=True)
        share = (1 + (p * counts).sum()) / (2 + counts.sum())
        log = np.log(rates)
        at = np.arange(len(LABELERS))
        odds = np.log(share / (1 - share)) + (log[1][at, votes_of] - log[0][at, votes_of]).sum(1)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return rates, p


def _features(codes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    v = _vote_matrix(codes)
    return np.concatenate([np.ones((len(codes), 1)), v == YES, v == NO, (shapes // 8)[:, None] == np.arange(1, 4),
                           (shapes % 8)[:, None] == np.arange(1, 8)], axis=1).astype(float)


def train(patterns: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int], float]:
    """(kind, code, shape, spans) rows to the classifier's score of each (kind, code, shape)."""
    scores = {}
    for kind in range(len(KINDS)):
        rows = np.array([r[1:] for r in patterns if r[0] == kind], np.int64).reshape(-1, 3)
        if not len(rows):
            continue
        counts = rows[:, 2].astype(float)
        _, target = reliabilities(rows[:, 0], counts)
        x, w = _features(rows[:, 0], rows[:, 1]), np.zeros(_features(rows[:1, 0], rows[:1, 1]).shape[1])
        weight = counts / counts.sum() * min(counts.sum(), 1e4)  # the ridge of 1 keeps its meaning at every size
        for _ in range(30):  # Newton steps of the ridge-penalised likelihood
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
            step = np.linalg.solve(hess, x.T @ (weight * (target - p)) - w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        for r, p in zip(rows, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))):
            scores[(kind, int(r[0]), int(r[1]))] = float(p)
    return scores


OUT_SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
              "n_added long, added array<struct<kind:string,start:long,stop:long,score:double>>")


def _finish(batches: Iterator[pa.RecordBatch], scores: dict, least: float) -> Iterator[pa.RecordBatch]:
    added_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))

    def joined(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    for b in batches:
        cols: list[list] = [[] for _ in range(8)]
        for base, more in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            own = [(x["start"], x["kind"], x["stop"]) for x in base]
            good = []
            for x in more:
                score = scores[(x["kind"], x["code"], x["shape"])]
                if score >= least:
                    good.append((x["start"], -x["stop"], x["kind"], score))
            added, end = [], 0
            for start, stop, kind, score in sorted(good):
                if start >= end:
                    added.append({"kind": KINDS[kind], "start": start, "stop": -stop, "score": score})
                    end = -stop
            every = sorted(own + [(x["start"], KINDS.index(x["kind"]), x["stop"]) for x in added])
            row = [*(sum(k == kind for _, k, _ in own) for kind in range(4)),
                   hashlib.sha256(joined(own).encode()).hexdigest(), joined(every), len(added), added]
            for c, v in zip(cols, row):
                c.append(v)
        types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), added_type]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                         ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "added"])


def find_personal_data(docs: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """One row per document: base spans counted and digested, all spans, the added ones with their scores."""
    ready_workers(docs.sparkSession)
    scanned = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCAN_SCHEMA), "proposed-spans")
    spans = scanned.select(F.explode(F.concat("base", "more")).alias("s")).select("s.kind", "s.code", "s.shape")
    patterns = spans.groupBy("kind", "code", "shape").agg(F.count(F.lit(1)).alias("n")).collect()  # a bounded table
    scores = train([tuple(r) for r in patterns])
    return scanned.mapInArrow(partial(_finish, scores=scores, least=least), OUT_SCHEMA)
