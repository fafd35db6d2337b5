"""Personal data: generated candidates, judged by boosted trees at calibrated thresholds.

Four base kinds are defined by patterns (:func:`base_spans`); their spans always count. Generators
of high recall propose further, overlapping spans of the same kinds in looser formats. Boosted
trees judge a candidate by its format and context. What they learn from is labelled by construction,
not by a rule over the features: values of every kind, and decoys (dates, prices, versions, lists,
order numbers, numbers with wrong check digits), are invented in many formats and planted into the
``SAMPLE`` snippets of smallest hash of the corpus; a candidate that touches the planted text is
personal data if it is one of the planted values of its kind, and not if it is anything else. Other
candidates of a snippet have no label and are left out. For each kind the threshold is the lowest
score above which at least ``PRECISION`` of the accepted candidates of a separate fold are right;
that fold plants values in separators and shapes that the training lines never use, too. Accepted
candidates that touch no base span and no better candidate are added.

Offsets are code points, ends exclusive. Every generator reads a text in time proportional to its
length. Defined cases: null texts are empty and have no spans; repeated rows are answered row by
row; a corpus without words plants into invented words; empty tables give empty results; other
columns are carried or ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia.llm import trees
from affinia.llm.common import annotate, thinned

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 12_000
PRECISION = 0.995
LEAST = 50
SNIPPET = 60
CONTEXT = 24
MOST_DIGITS = 20
AT_ONCE = 10_000

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits, as it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_AT = re.compile(
    r"([A-Za-z0-9._%+-]{1,64}) ?(?:@|[\[({] ?at ?[\])}]) ?"
    r"([A-Za-z0-9-]{1,63}(?:( ?(?:\.|[\[({] ?dot ?[\])}]) ?)[A-Za-z0-9-]{1,63}){1,8})", re.I
)
_DIGITS = re.compile(r"[+(]?[0-9](?:[ ()./_-]{0,3}[0-9])+")
_ANCHOR = re.compile(r"@|[\[({] ?at ?[\])}]", re.I)
_DIGIT = re.compile(r"[0-9]")
_GROUP = re.compile(r"[0-9]+")

CUES = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|addr", re.I),
    "card": re.compile(r"card|visa|master|credit|pay|iban|konto", re.I),
    "phone": re.compile(r"phone|\b(?:tel|call|fax|mobile|cell)\b|\bt:", re.I),
}

_AT_MARK = re.compile(r" ?(?:@|[\[({] ?at ?[\])}]) ?", re.I)
_DOT_MARK = re.compile(r" ?[\[({] ?dot ?[\])}] ?", re.I)
_MORE_HOST = re.compile(r"(?:[.-]?[A-Za-z0-9]|@)| ?[\[({] ?(?:dot|at) ?[\])}] ?[A-Za-z0-9]", re.I)
_GAP = r"[ ()./_-]{0,3}"
_IP_BEFORE = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_GAP}$")
_IP_AFTER = re.compile(rf"{_GAP}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?![0-9])")
_GROUP_BEFORE = re.compile(rf"([0-9]+){_GAP}$")
_GROUP_AFTER = re.compile(rf"{_GAP}([0-9]+)")
_FOURS_BEFORE = re.compile(r"(?<![0-9])(?:[0-9]{4}[ -]){4}$")
_FOURS_AFTER = re.compile(r"[ -](?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octet(part: str) -> bool:
    """Whether digits are 255 at most; any number of zeros may come first."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ leftwards, so that long runs cost no more than once."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            last = host.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Proposed spans, overlapping within and across kinds. Of a run of digit groups, every sub-run
    whose digits suit a kind is proposed; it spans at most ``MOST_DIGITS`` digits, so the work is
    linear."""
    found = set()
    if any(mark in text for mark in "@[({"):
        for anchor in _ANCHOR.finditer(text):
            stop = anchor.start()
            stop -= text[stop - 1:stop] == " "
            start = stop
            while start > max(0, stop - 64) and text[start - 1] in _LOCAL:
                start -= 1
            m = _AT.match(text, start, min(len(text), anchor.end() + 700)) if start < stop else None
            while m:  # the host, and what of it ends before its last point, and so on
                found.add(("email", start, m.end()))
                m = _AT.fullmatch(text, start, m.start(3)) if m.start(3) > m.start(2) else None
    for m in _DIGITS.finditer(text) if _DIGIT.search(text) else ():
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (first, _) in enumerate(groups):
            count, points = 0, 0
            for j in range(i, len(groups)):
                a, end = groups[j]
                count += end - a
                if count > MOST_DIGITS:
                    break
                points += j > i and text[groups[j - 1][1]:a].strip(" ()[]") == "."
                if j == i + 3 and points == 3:
                    found.add(("ip", first, end))
                if count >= 12:
                    found.add(("card", first, end))
                if 7 <= count <= 16:
                    found.add(("phone", first, end))
                    start = first
                    for mark in "(+":
                        if start and text[start - 1] == mark:
                            start -= 1
                            found.add(("phone", start, end))
    return sorted(found)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what surrounds it."""
    span = text[start:end]
    digits = _digits(span)
    groups = _GROUP.findall(span)
    shape = tuple(map(len, groups)) or (0,)
    raw = set(_GROUP.split(span)[1:-1]) if kind != "email" else set()
    gaps = {g.strip(" ") or g for g in raw}
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    prev, nxt = before[-1:], after[:1]
    # What the run goes on with; an address of a host is a thing of its own.
    left = None if _IP_BEFORE.search(before) else _GROUP_BEFORE.search(before)
    right = None if _IP_AFTER.match(text, end) else _GROUP_AFTER.match(after)
    ahead = text[max(0, start - 21):start]
    fours = [m for m in (_FOURS_BEFORE.search(ahead), _FOURS_AFTER.match(text, end)) if m]
    labels = []
    if kind == "email":
        labels = _DOT_MARK.sub(".", _AT_MARK.sub("@", span, count=1)).split("@")[-1].replace(" ", "").split(".")
    return [
        *(float(kind == k) for k in KINDS),
        float(len(digits)), float(len(groups)), float(max(shape)), float(min(shape)),
        float(shape[0]), float(shape[-1]), float(len(set(shape))),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(max((int(g) if len(g) < 4 else 999 for g in groups), default=0)) if kind == "ip" else 0.0,
        float(len(gaps)), float(bool(gaps & {"-"})), float(bool(gaps & {"."})), float(bool(gaps & {"/"})),
        float(any("(" in g or ")" in g for g in raw)), float(" " in span),
        float(span[:1] == "+"), float(span[:1] == "("), float(digits[:2] == "00"), float(digits[:1] == "0"),
        float(len(labels)), float(len(labels[-1])) if labels else 0.0, float(bool(labels) and labels[-1].isalpha()),
        float(kind == "email" and "@" not in span), float(kind == "email" and ". " in span),
        float(kind == "email" and (" @" in span or "@ " in span)),
        float(kind == "email" and bool(_MORE_HOST.match(text, end))),
        float(kind == "email" and (prev in _LOCAL if prev else False)),
        float(kind == "email" and not span[0].isalnum()),
        float(prev.isalpha()), float(nxt.isalpha()), float(prev in "+(" if prev else False),
        float(len(left[1])) if left else 0.0, float(len(right[1])) if right else 0.0,
        float(prev == " "), float(any(luhn(_digits(m[0])) for m in fours)),
        float(bool(CUES[kind].search(before))),
        float(any(CUES[k].search(before) for k in KINDS if k != kind)),
    ]


class Planter:
    """Invents values and decoys; ``unseen`` draws from the formats that training never uses."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def pick(self, values):
        return self.rng.choice(values)

    def some(self, k: int) -> str:
        return "".join(self.rng.choice("0123456789") for _ in range(k))

    def word(self) -> str:
        return "".join(self.rng.choice("abcdefghilmnoprstu") for _ in range(self.rng.randint(2, 8)))

    def email(self, unseen: bool) -> str:
        at, dot = self.pick(
            [(" {at} ", " {dot} "), ("{at}", "."), (" (AT) ", " (DOT) ")] if unseen else
            [("@", "."), (" @ ", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", "."), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("@", " (dot) ")]
        )
        host = [self.word() for _ in range(self.rng.randint(1, 3))] + [self.pick(["com", "org", "de", "net", "info", "co"])]
        return self.pick([self.word(), f"{self.word()}.{self.word()}", self.word() + self.some(2)]) + at + dot.join(host)

    def ip(self, unseen: bool) -> str:
        dot = self.pick(["[.]", " .", ". "] if unseen else [".", " . ", "(.)", "."])
        return dot.join(str(self.rng.randint(0, 255)) for _ in range(4))

    def _in_groups(self, digits: str, shape: tuple[int, ...], gap: str) -> str:
        out, at = [], 0
        for size in shape:
            out.append(digits[at:at + size])
            at += size
        return gap.join(out)

    def card(self, unseen: bool, right: bool = True) -> str:
        shape = self.pick(
            [(4, 4, 4, 4), (8, 8), (4, 6, 4)] if unseen else
            [(4, 4, 4, 4)] * 4 + [(16,)] * 4 + [(4, 6, 5), (15,), (13,), (19,), (4, 4, 5)]
        )
        digits = self.some(sum(shape))
        if luhn(digits) != right:
            digits = next(digits[:-1] + d for d in "0123456789" if luhn(digits[:-1] + d) == right)
        return self._in_groups(digits, shape, self.pick(["_", " - ", "."] if unseen else [" ", "-", "/", " "]))

    def phone(self, unseen: bool) -> str:
        gap = self.pick([" / ", "_"] if unseen else [" ", "-", ".", " - ", "/"])
        shape = self.pick([(3, 3, 4), (3, 3, 4), (4, 3, 4), (4, 7), (2, 3, 2, 2), (5, 6), (3, 4, 4)])
        groups = [self.some(k) for k in shape]
        groups[0] = self.pick(["", "", "0"]) + groups[0]
        if self.rng.random() < 0.4:
            groups[0] = f"({groups[0]})"
        lead = self.pick(["+", "+", "", "", "", "00"])
        return lead + (f"{self.rng.randint(1, 99)} " if lead or self.rng.random() < 0.1 else "") + gap.join(groups)

    def decoy(self) -> str:
        r, some, pick = self.rng.randint, self.some, self.pick
        return pick([
            lambda: f"{r(1900, 2030)}-{r(1, 12):02}-{r(1, 28):02}", lambda: f"{r(1, 28)}.{r(1, 12)}.{r(1900, 2030)}",
            lambda: f"{r(1900, 2030)}/{r(1, 12):02}/{r(1, 28):02} {r(0, 23):02}.{r(0, 59):02}",
            lambda: " ".join(str(r(1900, 2030)) for _ in range(r(2, 6))),
            lambda: " ".join(some(r(1, 3)) for _ in range(r(3, 9))),
            lambda: ". ".join(map(str, range(a := r(1, 9), a + r(3, 6)))), lambda: ".".join(some(r(1, 2)) for _ in range(pick([3, 5, 6]))),
            lambda: ".".join(str(r(200, 700)) for _ in range(4)) + "9", lambda: f"{r(1, 999)},{some(3)}.{some(2)}",
            lambda: some(r(5, 12)), lambda: some(pick([7, 8, 10, 11])), lambda: self.card(False, right=False),
            lambda: self.card(False, right=False), lambda: some(r(20, 26)), lambda: f"{some(4)} {some(4)} {some(4)}",
            lambda: f"{some(3)}-{some(2)}-{some(4)}", lambda: f"{pick('abcdef')}{some(r(7, 16))}{pick('abcdef')}",
            lambda: f"{self.word()} @ {self.word()}", lambda: f"{self.word()}@{self.word()}.{some(2)}",
            lambda: f"{self.word()} (at) {self.word()} . {self.word()}", lambda: f"({some(1)}) {some(2)} {some(3)}",
        ])()

    def line(self, left: str, right: str, unseen: bool) -> tuple[str, int, int, set]:
        """A text, where its planted part begins and ends, and the (kind, start, end) of its values."""
        made = {"email": self.email, "ip": self.ip, "card": self.card, "phone": self.phone}
        cues = {
            "email": ["mail ", "contact: ", "write ", "write to "], "ip": ["ip ", "host ", "server at ", "address "],
            "card": ["card ", "the card ", "visa: ", "pay with "], "phone": ["tel ", "my tel ", "call ", "phone: ", "fax "],
            "none": ["order ", "no. ", "page ", "ref ", "version ", "number ", "the number ", "in ", "years "],
        }
        text, true = left, set()
        parts = [self.pick([*KINDS, "none", "none"]) for _ in range(self.pick([1, 1, 1, 1, 2]))]
        if self.rng.random() < 0.08:  # two of one kind side by side
            parts = [self.pick(["card", "phone", "ip"])] * 2
        for i, kind in enumerate(parts):
            if i:
                text += self.pick([" ", " ", ", "])
            loud = self.rng.random()
            if not i and loud < 0.55:
                text += self.pick(cues[kind])
            elif not i and loud < 0.6:
                text += self.pick(cues[self.pick(KINDS)])
            value = self.decoy() if kind == "none" else made[kind](unseen)
            if kind != "none":
                true.add((kind, len(text), len(text) + len(value)))
            text += value
        return text + self.pick(["", "", "", ".", ","]) + right, len(left), len(text), true


def labelled(snippets: list[tuple[str, str]], seed: int, unseen: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels, and which are base spans, of the candidates of values planted in snippets."""
    planter, x, y, base = Planter(seed), [], [], []
    for left, right in snippets:
        text, begin, end, true = planter.line(left, right, unseen and planter.rng.random() < 0.5)
        known = set(base_spans(text))
        for c in candidates(text):
            if c[1] < end and c[2] > begin:
                x.append(features(text, *c))
                y.append(float(c in true))
                base.append(c in known)
    return np.array(x), np.array(y), np.array(base, bool)


def all_spans(text: str, model: trees.Boosted, thresholds: dict[str, float]) -> tuple[list, list]:
    """Base spans, and all spans (base and added), each by kind as listed, then start."""
    base = base_spans(text)
    taken = bytearray(len(text))
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    more = [c for c in candidates(text) if c[0] in thresholds and taken.find(1, c[1], c[2]) < 0]
    if not more:
        return base, base
    good = []
    for at in range(0, len(more), AT_ONCE):
        part = more[at:at + AT_ONCE]
        scores = model.probability(np.array([features(text, *c) for c in part]))
        good += [(score, c) for score, c in zip(scores, part) if score >= thresholds[c[0]]]
    chosen = []
    # The longest first, as a part of a number can look as good as the number.
    for _, span in sorted(good, key=lambda x: (x[1][1] - x[1][2], -x[0], x[1])):
        _, a, b = span
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            chosen.append(span)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + chosen, key=lambda s: (order[s[0]], s[1], s[2]))


def snippets(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """Pairs of texts to plant values between: what is around a blank of ``sample`` documents."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    key = F.xxhash64("text", F.lit(9))
    at = F.pmod(F.xxhash64("text", F.lit(10)), F.length("text").cast("long")).cast("int") + 1
    cut = F.substring("text", F.greatest(F.lit(1), at - SNIPPET), F.lit(2 * SNIPPET))
    rows = thinned(texts, key, texts.count(), sample).select(key.alias("key"), cut.alias("cut"))
    out = []
    for r in rows.orderBy("key", "cut").limit(sample).collect():
        words = r.cut.split(" ")[1:-1]  # the first and the last may be cut
        half = len(words) // 2
        out.append((" ".join([*words[:half], ""]), " ".join(["", *words[half:]])))
    planter = Planter(5)
    while len(out) < sample:
        out.append((f"{planter.word()} {planter.word()} ", f" {planter.word()}"))
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[trees.Boosted, dict[str, float]]:
    """The trees, and the threshold of every kind that has one."""
    places = snippets(docs, sample)
    third = len(places) // 3
    x, y, _ = labelled(places[third:], 11, unseen=False)
    model = trees.fit_boosted(x, y, rounds=60, depth=6)
    x, y, base = labelled(places[:third], 12, unseen=True)
    x, y = x[~base], y[~base]  # base spans always count, so the trees are not asked for them
    score = model.probability(x)
    thresholds = {}
    for k, kind in enumerate(KINDS):
        mine = x[:, k] == 1
        threshold = _threshold(score[mine], y[mine])
        if threshold is not None:
            thresholds[kind] = threshold
    return model, thresholds


def _threshold(score: np.ndarray, y: np.ndarray) -> float | None:
    """The lowest score at and above which the share of right cases is high enough."""
    if y.sum() < LEAST:
        return None
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_tie = np.append(np.diff(score[order]) != 0, True)
    good = np.flatnonzero((share >= PRECISION) & last_of_tie & (score[order] > 0.5))
    return float(score[order][good[-1]]) if len(good) else None


_SPANS = T.StructType([
    T.StructField("base", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StringType())),
    T.StructField("redacted", T.StringType()),
])


def find(
    docs: DataFrame, carry: list[str] | None = None, redact: bool = True, sample: int = SAMPLE
) -> DataFrame:
    """``row`` (the carried columns) and ``result``: base and all spans as kind:start:end, and the
    text with every span replaced by its kind in angle brackets (null if ``redact`` is off)."""
    model, thresholds = train(docs, sample)

    def fn(texts: list) -> list[dict]:
        out = []
        for text in texts:
            base, spans = all_spans(text or "", model, thresholds)
            out.append({
                "base": [f"{k}:{a}:{b}" for k, a, b in base],
                "spans": [f"{k}:{a}:{b}" for k, a, b in spans],
                "redacted": redacted(text, spans) if redact else None,
            })
        return out

    return annotate(docs, fn, _SPANS, carry)


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with its spans replaced; overlapping spans become one, named after the first."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with redacted texts; ``n_chars``, where present, is the new length."""
    done = find(docs, sample=sample)
    columns = []
    for name in docs.columns:
        value = F.col(f"row.`{name}`")
        if name == "text":
            value = F.col("result.redacted")
        elif name == "n_chars":
            value = F.when(F.size("result.spans") > 0, F.length("result.redacted")).otherwise(value)
            value = value.cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return done.select(*columns)
