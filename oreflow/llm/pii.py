"""Personal data: exact patterns, and a conditional random field for what patterns miss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from oreflow.llm.common import small_batches
from oreflow.llm.crf import Crf, shapes

KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
TRAINING_ROWS = 600
_BLOCK_CHARS = 4_000_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A start inside a run of digits can only match where the run's first digit matches, too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def sound(kind: str, found: str) -> bool:
    """Whether a match of a kind's pattern counts."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    digits = _digits(found)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern; every character is looked at once, however long the runs."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", done if found else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of what the patterns find, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for k, pattern in enumerate((_IP, _CARD, _PHONE), 1):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if sound(KINDS[k], m[0])]
    return sorted(out)


def labelled_rows(n: int = TRAINING_ROWS, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The small labelled table: made-up lines with the spans of the personal data in them.

    Besides forms that the patterns find it has phone numbers without a plus sign, and numbers
    that are nothing personal: years, dates, times, prices, versions, sizes and order numbers.
    """
    rng = np.random.default_rng(seed)
    number = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(rng.choice(list("abcdeghilmnorstuvéñü"), rng.integers(1, 10)))

    def card() -> str:
        digits = number(15)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        return digits if rng.random() < 0.6 else "- "[rng.integers(2)].join(digits[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        forms = (f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {a} {b}{c}", f"({a}) {b} {c}")
        return forms[rng.integers(len(forms))]

    made = (
        lambda: f"{word()}.{number(2)}@{word()}{number(1)}.example.com",
        lambda: ".".join(str(x) for x in rng.integers(0, 256, 4)),
        card,
        phone,
    )
    plain = (
        lambda: str(rng.integers(1900, 2100)),
        lambda: f"{number(4)}-{number(2)}-{number(2)}",
        lambda: f"{number(2)}/{number(2)}/{number(4)}",
        lambda: f"{number(2)}:{number(2)}",
        lambda: f"{number(2)}.{number(2)}",
        lambda: f"v{number(1)}.{number(1)}.{number(1)}",
        lambda: f"#{number(6)}",
        lambda: number(rng.integers(1, 10)),
        lambda: f"{number(3)}-{number(4)}",
        lambda: f"({number(4)})",
        lambda: f"${number(3)},{number(3)}",
        lambda: f"@{word()}",
        lambda: number(20),
    )
    rows = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.integers(6, 14)):
            draw = rng.random()
            if draw < 0.15:
                kind = int(rng.integers(4))
                value = made[kind]()
                spans.append((len(text), kind, len(text) + len(value)))
            elif draw < 0.35:
                value = plain[rng.integers(len(plain))]()
            else:
                value = word().capitalize() if rng.random() < 0.2 else word()
            text += value + ("", "", "", ".", ",")[rng.integers(5)] + " "
        rows.append((text, spans))
    return rows


def _labels(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    labels = np.zeros(len(starts), np.int64)
    for start, kind, end in spans:
        labels[(starts < end) & (ends > start)] = kind + 1
    return labels


@cache
def trained(n: int = TRAINING_ROWS) -> Crf:
    rows = []
    for text, spans in labelled_rows(n):
        starts, ends, features = shapes(text)
        rows.append((features, _labels(starts, ends, spans)))
    return Crf(len(KINDS) + 1).fit(rows, rounds=6)


def _own_spans(text: str, starts, ends, labels, base) -> list[tuple[int, int, int]]:
    """Spans of words with one label that pass the checks and touch no base span."""
    tagged = np.flatnonzero(labels)
    if not len(tagged):
        return []
    cuts = np.flatnonzero((np.diff(tagged) > 1) | (np.diff(labels[tagged]) != 0)) + 1
    out = []
    for group in np.split(tagged, cuts):
        kind, i, j = int(labels[group[0]]) - 1, int(starts[group[0]]), int(ends[group[-1]])
        while i < j and not (text[i].isalnum() or text[i] == "("):
            i += 1
        while i < j and not text[j - 1].isalnum():
            j -= 1
        found = text[i:j]
        fits = {
            "email": lambda x: x.count("@") == 1 and re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", x),
            "ip": lambda x: re.fullmatch(r"[0-9]+(\.[0-9]+){3}", x),
            "card": lambda x: re.fullmatch(r"[0-9](?:[ -]?[0-9])++", x),
            "phone": lambda x: re.fullmatch(r"\(?[0-9][ ().0-9-]+[0-9]", x) and re.search(r"[ ().-]", x),
        }[KINDS[kind]]
        if j > i and fits(found) and sound(KINDS[kind], found) and not any(s < j and i < e for s, _, e in base):
            out.append((i, kind, j))
    return out


def scan(texts: list[str], model: Crf) -> list[list[tuple[int, int, int, bool]]]:
    """All spans ``(start, kind number, end, base)`` of each text, sorted.

    The texts with a digit or an ``@`` are decoded together; no other text can hold a span that
    passes the checks.
    """
    base = [base_spans(t) if _HINT.search(t) else [] for t in texts]
    out = [[(*s, True) for s in b] for b in base]
    todo = [i for i, t in enumerate(texts) if _HINT.search(t)]
    while todo:
        block, chars = [], 0
        while todo and (not block or chars + len(texts[todo[-1]]) <= _BLOCK_CHARS):
            block.append(todo.pop())
            chars += len(texts[block[-1]])
        parts = [shapes(texts[i]) for i in block]
        lengths = np.array([len(p[0]) for p in parts])
        labels = model.decode(np.concatenate([p[2] for p in parts]), lengths)
        for i, (starts, ends, _), mine in zip(block, parts, np.split(labels, np.cumsum(lengths)[:-1]), strict=True):
            own = _own_spans(texts[i], starts, ends, mine, base[i])
            out[i] = sorted(out[i] + [(*s, False) for s in own])
    return out


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii``: spans ``(kind, start, end, base)`` in code points, end exclusive, for every row.

    Base spans are what the patterns find, leftmost and without overlap per kind, less the matches
    that fail their checks. The random field, trained on a small labelled table, adds spans that
    touch no base span. No shuffle. NULL and empty texts have no spans; very long texts are
    scanned whole, in time linear in their length; repeated rows get the same spans; a column
    ``pii`` is replaced; an empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(trained())

    @F.arrow_udf(SPAN_TYPE)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for batch in batches:
            found = scan([t or "" for t in batch.to_pylist()], model.value)
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in row] for row in found]
            yield pa.array(rows, pa.list_(kind))

    return df.withColumn("pii", spans(F.col(text)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@F.arrow_udf(StringType())
def redacted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """A text with every span, or overlapping spans together, replaced by ``[KIND]`` of the first."""
    for texts, spans in batches:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if text is None or not found:
                out.append(text)
                continue
            parts, at = [], 0
            for s in found:
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
                at = max(at, s["end"])
            out.append("".join(parts) + text[at:])
        yield pa.array(out, pa.string())


def redact_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the personal data in its texts replaced by placeholders; NULL stays NULL."""
    return find_pii(df, text).withColumn(text, redacted(text, "pii")).drop("pii")
