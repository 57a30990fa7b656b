"""Personal data: labellers that vote on spans, their reliabilities, and a span classifier."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches, settle
from claimwell.llm.weak_quality import fit_scorer

KINDS = ("email", "ip", "card", "phone")
YES, NO, ABSTAIN = "1", "0", "-"
#: Hashed dimensions of the classifier; spans of each kind and vote pattern that it is fitted on.
DIMENSIONS, SAMPLE = 1 << 12, 200
#: Spans that score less are not added.
LEAST_SCORE = 0.5
#: Characters before and after a span that labellers and the classifier see.
NEAR = 40

# National digits by country code, first digits of cards, mail domains, cue words.
PLANS = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9),
    "34": (9, 9), "36": (8, 9), "39": (8, 11), "40": (9, 9), "41": (9, 9), "43": (7, 12), "44": (9, 10), "45": (8, 8),
    "46": (7, 10), "47": (8, 8), "48": (9, 9), "49": (7, 12), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11),
    "56": (9, 9), "57": (10, 10), "61": (9, 9), "64": (8, 10), "65": (8, 8), "81": (9, 10), "82": (8, 10), "86": (10, 11),
    "90": (10, 10), "91": (10, 10), "351": (9, 9), "353": (7, 9), "358": (6, 11), "380": (9, 9), "420": (9, 9),
}
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|3[068]|35|6011|65|64[4-9]|62|50|6[37]").match
DOMAINS = frozenset(
    "com org net edu gov mil int info biz io dev app ai co me tv uk us ca de fr es it nl be at ch pl pt br mx ar cl se no "
    "dk fi ie cz ru ua tr in cn jp kr au nz za eu example test invalid localhost".split()
)
CUES = {
    "email": "email e-mail mail mailto correo courriel contact contacto kontakt write schreib adresse reach",
    "ip": "ip host server address adresse dirección client from peer login addr remote",
    "card": "card visa mastercard amex tarjeta carte karte credit debit pay paid zahlung",
    "phone": "phone tel telephone telefon teléfono téléphone call mobile cell fax handy móvil whatsapp sms",
}
CONTRARY = frozenset("version v token password secret key hash sha md5 id isbn order invoice build release licence license commit uuid".split())

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
# a match never begins inside digits, as those before would have matched or failed alike
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digits = re.compile(r"[0-9]+").findall

_BRACKET_DOT = r"\s{0,2}[\[({]\s?(?:\.|dot)\s?[\])}]\s{0,2}"
_WORD_DOT = rf"(?:{_BRACKET_DOT}|\s{{1,2}}dot\s{{1,2}})"
_NAME, _HOST = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}", r"[A-Za-z0-9-]{1,63}"
# at in brackets, or with spaces around the sign, before any dots; a bare at only before bare dots
_HIDDEN_MAILS = (
    re.compile(rf"{_NAME}(?:\s{{0,2}}[\[({{]\s?(?:@|at)\s?[\])}}]\s{{0,2}}|\s?@\s?|＠){_HOST}(?:(?:\.|{_WORD_DOT}){_HOST}){{1,4}}", re.IGNORECASE),
    re.compile(rf"{_NAME}\s{{1,2}}at\s{{1,2}}{_HOST}(?:{_WORD_DOT}{_HOST}){{1,4}}", re.IGNORECASE),
)
_mail_cue = re.compile(r"@|＠|[\[({]\s*at\s*[\])}]|[\[({]\s*dot\s*[\])}]|\sdot\s", re.IGNORECASE).search
_HIDDEN_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\s?\[\.\]\s?|\s?\(\.\)\s?|\s?\[dot\]\s?|\s?\(dot\)\s?)[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE)
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9])")
_OTHER_PHONE = re.compile(r"(?<![0-9])00 ?[1-9][0-9]{0,2}[ ().-]{1,2}[0-9][ ().0-9-]{5,18}[0-9](?![0-9])")
_DOTTED_CARD = re.compile(r"(?<![0-9./])[0-9]{4}([./_‐-― ])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])")
_PHONE_PARTS = re.compile(r"\+[0-9]+|\([0-9]+\)|[0-9]+")
_GROUPS = frozenset([(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)])


def luhn(number: str) -> bool:
    total = sum(map(int, number[-1::-2]))
    return (total + sum(2 * int(c) - 9 * (c > "4") for c in number[-2::-2])) % 10 == 0


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    return all(len(p := d.lstrip("0")) <= 3 and int(p or 0) <= 255 for d in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the characters before each @, and the domain after it."""
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _domain(text, at + 1) if begin < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield begin, free
        at = text.find("@", free)


def planned(text: str, begin: int, end: int) -> int | None:
    """Where a number ends that has as many digits as its country code asks for, at the end
    of a group of digits; the longest such."""
    found, country, digits = None, None, 0
    for part in _PHONE_PARTS.finditer(text, begin, end):
        digits += sum(map(len, _digits(part[0])))
        if country is None:
            lead = part[0].lstrip("+00") if part[0].startswith("+") else part[0]
            country = next((lead[:n] for n in (1, 2, 3) if lead[:n] in PLANS), None)
            if country is None:
                return None
            digits = len(lead)
        low, high = PLANS[country]
        if low <= digits - len(country) <= high:
            found = part.end()
        elif digits - len(country) > high:
            break
    return found


def hidden_cards(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Card numbers that are whole groups of digits inside a longer row of groups."""
    groups = [m.span() for m in re.finditer("[0-9]+", text[begin:end])]
    at = 0
    while at < len(groups):
        for n in (1, 5, 4, 3):
            chosen = groups[at : at + n]
            sizes = tuple(b - a for a, b in chosen)
            a, b = begin + chosen[0][0], begin + chosen[-1][1]
            if (n == 1 or sizes in _GROUPS) and is_card("".join(_digits(text[a:b]))):
                yield a, b
                at += n
                break
        else:
            at += 1


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans, failing matches) of the patterns that define the kinds, by kind and start."""
    found = [("email", *s) for s in emails(text)]
    failed = []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            whole = m[0]
            if kind == "ip":
                sound = is_ip(whole)
            else:
                digits = "".join(_digits(whole))
                sound = is_card(digits) if kind == "card" else 9 <= len(digits) <= 15
            (found if sound else failed).append((kind, *m.span()))
    return found, failed


def other_spans(text: str, failed: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Candidates beyond the patterns: (kind, start, end, form). Form p is a part of a failing
    match, o another way to write the kind."""
    for kind, begin, end in failed:
        if kind == "card" and end - begin > 13:
            yield from (("card", *s, "p") for s in hidden_cards(text, begin, end))
        elif kind == "phone" and (stop := planned(text, begin, end)):
            yield "phone", begin, stop, "p"
    if _mail_cue(text):
        for pattern in _HIDDEN_MAILS:
            yield from (("email", *m.span(), "o") for m in pattern.finditer(text))
    for kind, pattern in (("ip", _HIDDEN_IP), ("ip", _IP6), ("phone", _LOCAL_PHONE), ("phone", _OTHER_PHONE)):
        yield from ((kind, *m.span(), "o") for m in pattern.finditer(text))
    for m in _DOTTED_CARD.finditer(text):
        if 13 <= len("".join(_digits(m[0]))) <= 19:
            yield "card", *m.span(), "o"


# labellers: (kind, the span's text, its form, text before it, text after it) -> vote


def pattern_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """The defining pattern: it holds for the span, or is made up for by another writing."""
    return YES if form in "bp" else ABSTAIN


def checksum_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """What the number or the domain has to be: check digit, number plan, parts, known domain."""
    digits = "".join(_digits(span))
    if kind == "card":
        return YES if is_card(digits) else NO
    if kind == "phone":
        if form == "o":
            return ABSTAIN
        return YES if planned(span, 0, len(span)) == len(span) else ABSTAIN
    if kind == "ip":
        return YES if ":" in span or all(int(d) <= 255 for d in _digits(span) if len(d) < 9) else NO
    return YES if re.split(r"[^a-z0-9-]+", span.lower())[-1] in DOMAINS else NO


def gazetteer_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """Known issuers of cards, country codes, and networks that no host has."""
    digits = _digits(span)
    if kind == "card":
        return YES if ISSUERS("".join(digits)) else NO
    if kind == "phone":
        lead = "".join(digits).removeprefix("00")
        return YES if form == "o" and len(lead) == 10 or any(lead[:n] in PLANS for n in (1, 2, 3)) else NO
    if kind == "ip" and ":" not in span:
        return YES if 0 < int(digits[0][-9:]) < 240 else ABSTAIN
    return ABSTAIN


def context_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """Words before the span that speak of its kind, or of numbers that are something else."""
    words = re.findall(r"[a-zß-ÿ-]+", before.lower())[-4:]
    if any(w in CONTRARY for w in words[-2:]) or before.endswith(("=", '="')):
        return NO
    return YES if any(w in _CUES[kind] for w in words) else ABSTAIN


def edge_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """Whether the span stands by itself or inside a longer word."""
    inside = before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in "_$#" and before != ""
    return NO if inside else YES


def writing_votes(kind: str, span: str, form: str, before: str, after: str) -> str:
    """Whether separators and groups are those that people use for the kind."""
    if kind == "card":
        groups = tuple(map(len, _digits(span)))
        return YES if len(groups) == 1 or groups in _GROUPS else NO
    if kind == "phone":
        return NO if re.search(r"[ .-]{2}|\([^)]*$|^[^(]*\)", span) else YES
    if kind == "email" and form == "o":
        return YES if re.search(r"[\[({]\s*(at|@|dot|\.)\s*[\])}]|[@＠]", span, re.IGNORECASE) else ABSTAIN
    return YES


_CUES = {kind: frozenset(words.split()) for kind, words in CUES.items()}
LABELLERS = (pattern_votes, checksum_votes, gazetteer_votes, context_votes, edge_votes, writing_votes)


def votes(text: str, kind: str, begin: int, end: int, form: str) -> str:
    """One character for each of LABELLERS."""
    before, after = text[max(0, begin - NEAR) : begin], text[end : end + NEAR]
    return "".join(vote(kind, text[begin:end], form, before, after) for vote in LABELLERS)


def features(text: str, kind: str, begin: int, end: int, cast: str) -> list[int]:
    """Hashed features of a span: votes, shape, neighbouring characters and words."""
    from xxhash import xxh32_intdigest

    before, after = text[max(0, begin - NEAR) : begin], text[end : end + NEAR]
    shape = re.sub("[0-9]+", "9", re.sub("[A-Za-z]+", "a", text[begin : min(end, begin + 80)]))
    said = [f"{i}{v}" for i, v in enumerate(cast)]
    said += [f"{kind}{x}" for x in said]
    said += [f"{kind} {shape}", f"n{len(_digits(text[begin:end]))}", f"<{before[-1:].isalnum()}", f">{after[:1].isalnum()}"]
    said += [f"w{w}" for w in re.findall(r"\w+", before.lower())[-2:] if not w.isdigit()]
    return sorted({0} | {1 + xxh32_intdigest(x) % (DIMENSIONS - 1) for x in said})


class Taken:
    """Places that spans cover."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.begins: list[int] = []
        self.ends: list[int] = []
        for begin, end in sorted(spans):
            if self.ends and begin < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.begins.append(begin)
                self.ends.append(end)

    def free(self, begin: int, end: int) -> bool:
        at = bisect_left(self.begins, end) - 1
        return at < 0 or self.ends[at] <= begin

    def take(self, begin: int, end: int) -> None:
        at = bisect_left(self.begins, begin)
        self.begins.insert(at, begin)
        self.ends.insert(at, end)


def candidates(text: str | None) -> list[dict]:
    """All spans of a text with their votes and features, base ones first."""
    if not text:
        return []
    base, failed = base_spans(text)
    spans = [(*s, "b") for s in base]
    taken = Taken([s[1:3] for s in spans])
    spans += [s for s in other_spans(text, failed) if taken.free(s[1], s[2])]
    out = []
    for kind, begin, end, form in dict.fromkeys(spans):
        cast = votes(text, kind, begin, end, form)
        out.append({"kind": kind, "begin": begin, "end": end, "base": form == "b", "votes": cast, "at": features(text, kind, begin, end, cast)})
    return out


def label_model(counts: Counter, rounds: int = 100) -> dict[tuple[str, str], float]:
    """Expectation maximisation over (kind, votes) and their counts: (kind, votes) -> P(personal).

    A labeller that votes says yes of personal data with one chance and of anything else
    with another; both differ by kind, and not to vote says nothing. Chances are smoothed
    with a hundredth of the kind's spans, 20 at least, towards labellers that are mostly
    right (90 % and 40 %), and a yes never speaks against nor a no for. Spans that the
    pattern holds for and other ones have shares of personal data of their own.
    """
    found = {}
    for kind in KINDS:
        names = [v for k, v in counts if k == kind]
        if not names:
            continue
        weight = np.array([counts[kind, v] for v in names], float)
        yes, no = (np.array([[x == said for x in v] for v in names], float) for said in (YES, NO))
        strict = yes[:, 0] > 0
        personal = 1 / (1 + np.exp(-(yes.sum(1) * np.log(0.9 / 0.4) + no.sum(1) * np.log(0.1 / 0.6))))
        mass = max(20.0, weight.sum() / 100)
        for _ in range(rounds):
            other, own = (
                (weight * share @ yes + mass * usual) / (weight * share @ (yes + no) + mass)
                for share, usual in ((1 - personal, 0.4), (personal, 0.9))
            )
            own = np.maximum(own, other)
            total = yes @ np.log(own / other) + no @ np.log((1 - own) / (1 - other))
            for form in (strict, ~strict):
                there = weight * form
                total[form] += np.log((there @ personal + 5) / (there @ (1 - personal) + 5))
            new = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            done = np.abs(new - personal).max() < 1e-6
            personal = new
            if done:
                break
        found |= {(kind, v): float(p) for v, p in zip(names, personal)}
    return found


@dataclass(frozen=True)
class SpanModel:
    posteriors: dict
    weights: np.ndarray

    def score(self, at: list[int]) -> float:
        total = self.weights[at].sum() / np.sqrt(len(at))
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def chosen_spans(spans: list[dict], model: SpanModel, least: float) -> list[dict]:
    """Base spans and those that score enough, by kind and start. Where others overlap, parts of
    failing matches come first, then the best."""
    kept = [s | {"score": model.score(s["at"])} for s in spans]
    out = [s for s in kept if s["base"]]
    taken = Taken([(s["begin"], s["end"]) for s in out])
    others = [s for s in kept if not s["base"] and s["score"] >= least]
    for s in sorted(others, key=lambda s: (s["votes"][0] != YES, -s["score"], s["begin"], s["end"])):
        if taken.free(s["begin"], s["end"]):
            taken.take(s["begin"], s["end"])
            out.append(s)
    out.sort(key=lambda s: (KINDS.index(s["kind"]), s["begin"]))
    return [{k: s[k] for k in ("kind", "begin", "end", "base", "score")} for s in out]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidate spans of every text, one row for each input row, in the shared folder."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    span = "struct<kind: string, begin: bigint, end: bigint, base: boolean, votes: string, at: array<int>>"

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"key": b["key"], "spans": [candidates(t) for t in b["body"]]}

    return settle(map_batches(rows, work, f"key {dict(rows.dtypes)['key']}, spans array<{span}>"), "spans")


def fit(found: DataFrame, sample: int = SAMPLE) -> SpanModel:
    """Estimate the labellers from the votes on all spans of `find`, and fit the classifier.

    The driver gets one count for each kind and vote pattern, whose number the labellers
    bound, and the features of `sample` spans of each of them, in the order of a hash; those
    weigh as much as their pattern has spans. No spans give a model that says 0.5.
    """
    each = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.at")
    counts = Counter({(r.kind, r.votes): r["count"] for r in each.groupBy("kind", "votes").count().collect()})
    posteriors = label_model(counts)
    order = Window.partitionBy("kind", "votes").orderBy(F.xxhash64("at"), "at")
    few = each.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    rows = sorted((r.kind, r.votes, list(r["at"])) for r in few.collect())
    described = [(np.array(at), np.full(len(at), 1 / np.sqrt(len(at))), posteriors[k, v]) for k, v, at in rows]
    return SpanModel(posteriors, fit_scorer(described, DIMENSIONS))


def classify(found: DataFrame, model: SpanModel, least: float = LEAST_SCORE, id_col: str = "doc_id") -> DataFrame:
    """(id, spans array<struct<kind, begin, end, base, score>>), one row per row of `find`.

    Base spans all stay, whatever they score; others are added where they score enough and
    overlap no base span and no better one. Spans count code points, `end` is exclusive.
    """
    span = "struct<kind: string, begin: bigint, end: bigint, base: boolean, score: double>"

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"key": b["key"], "spans": [chosen_spans(s or [], model, least) for s in b["spans"]]}

    return map_batches(found, work, f"key {dict(found.dtypes)['key']}, spans array<{span}>").withColumnRenamed("key", id_col)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(id, spans) of every whole text: email, ip, card and phone, see `classify`.

    A NULL text is an empty one, without spans. Repeated and NULL ids stay rows of their
    own, other columns are not read, no rows give no rows. A text is read once, by one task;
    what is shuffled are counts of vote patterns and a bounded number of spans.
    """
    found = find(docs, id_col, text_col)
    return classify(found, fit(found), least, id_col)
