"""Operator 4 [native]: personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators confirm them (Luhn's sum for payment cards, the
remainder by 97 for bank accounts, value ranges), and words near a span adjust its score.

Where the matches of an expression stand is found without a user function: the text split at
the matches gives the pieces between them, whose lengths with those of the matches add up to
the offsets, in code points. Expressions are written so that Java's matcher neither recurses
nor goes over a run of characters more than once, however long the run: possessive repetition,
and a start only where a run starts or a match has just ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import clear_name

# Characters before and after a span that are searched for context words.
CONTEXT = 40
# Score from which a span that only the method proposes counts.
THRESHOLD = 0.5


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits have a Luhn sum that 10 divides."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(19):
        digit = F.substring(padded, i + 1, 1).cast("int")
        if i % 2:  # every second digit from the right end
            total = total + digit * 2 - F.when(digit > 4, F.lit(9)).otherwise(F.lit(0))
        else:
            total = total + digit
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether a bank account number (IBAN, no spaces) leaves 1 when divided by 97."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    spelled = turned
    for i in range(26):
        spelled = F.replace(spelled, F.lit(chr(65 + i)), F.lit(str(10 + i)))
    rest = F.lit(0).cast("long")
    for i in range(0, 72, 9):  # 34 characters give 68 digits at most
        part = F.substring(spelled, i + 1, 9)
        shifted = rest * F.pow(F.lit(10.0), F.length(part)).cast("long")
        rest = (shifted + F.coalesce(part.try_cast("long"), F.lit(0))) % 97
    return rest == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _always(match: Column) -> Column:
    return F.lit(True)


def _octets(match: Column) -> Column:
    return match.rlike(r"^(?:0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(13, 19) & luhn(digits)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _account(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    return F.length(plain).between(15, 34) & mod97(plain)


@dataclass(frozen=True)
class Detector:
    """kind; expression; a plain string each match holds; validator; score without context;
    words that raise it; whether a valid match counts whatever its score."""

    kind: str
    pattern: str
    holds: str | None
    valid: object
    prior: float
    words: str
    base: bool


_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# In the order in which kinds are listed. The first four are the base.
DETECTORS = (
    Detector("email", EMAIL, "@", _always, 0.95, "mail|contact|write", True),
    Detector("ip", IP, ".", _octets, 0.6, "ip|address|host|server", True),
    Detector("card", CARD, None, _card, 0.9, "card|credit|visa|payment", True),
    Detector("phone", PHONE, "+", _phone, 0.7, "phone|tel|call|mobile|fax", True),
    # Cards and phones inside matches that the base drops as a whole.
    Detector("card", r"(?<![0-9])[0-9]{13,19}+(?![0-9])", None, _card, 0.8, "card|credit|visa", False),
    Detector(
        "card", r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", None, _card, 0.8,
        "card|credit|visa", False,
    ),
    Detector(
        "phone", r"\+[0-9]{1,3}[\x20.-]?\([0-9]{2,4}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "+",
        _phone, 0.7, "phone|tel|call|mobile|fax", False,
    ),
    Detector(
        "phone", r"(?<![0-9])\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])", "(", _always, 0.6,
        "phone|tel|call|mobile|fax", False,
    ),
    Detector(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        None, _account, 0.95, "iban|account|konto|bank", False,
    ),
    Detector(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.5, "ssn|social|security", False,
    ),
)
KINDS = tuple(dict.fromkeys(d.kind for d in DETECTORS))

SPAN = "struct<kind: string, start: int, end: int, score: double, base: boolean>"


def _spans(text: Column, detector: Detector) -> Column:
    """Spans of one detector that its validator confirms, in order.

    The text's pieces and matches are gone through once, side by side; a span's context is taken
    from the pieces before and after it.
    """
    between = F.split(text, detector.pattern, -1)
    sides = F.arrays_zip(
        between.alias("gap"),
        F.regexp_extract_all(text, F.lit(detector.pattern), F.lit(0)).alias("match"),
        F.slice(between, 2, F.size(between)).alias("after"),
    )
    none = F.array().cast("array<bigint>")

    def step(held: Column, side: Column) -> Column:
        start = held["at"] + F.length(side["gap"])
        end = start + F.length(side["match"])
        near = F.lower(
            F.concat_ws(" ", F.right(side["gap"], F.lit(CONTEXT)), F.left(side["after"], F.lit(CONTEXT)))
        ).rlike(detector.words)
        # One number for a span, negative if a context word is near: what a fold holds is copied
        # at every step, so it is kept plain.
        packed = F.shiftleft(start.cast("long"), 32) + end
        packed = F.when(near, -packed).otherwise(packed)
        counts = side["match"].isNotNull() & detector.valid(side["match"])
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(counts, F.concat(held["found"], F.array(packed)))
            .otherwise(held["found"])
            .alias("found"),
        )

    def unpacked(packed: Column) -> Column:
        bonus = F.when(packed < 0, F.lit(0.2)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(detector.kind).alias("kind"),
            F.shiftright(F.abs(packed), 32).cast("int").alias("start"),
            F.abs(packed).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("end"),
            F.least(F.lit(1.0), F.lit(detector.prior) + bonus).alias("score"),
            F.lit(detector.base).alias("base"),
        )

    folded = F.aggregate(
        sides, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda held: held["found"]
    )
    present = F.contains(text, F.lit(detector.holds)) if detector.holds else text.rlike("[0-9]")
    found = F.transform(F.when(present, folded).otherwise(none), unpacked).cast(f"array<{SPAN}>")
    return found if detector.base else F.filter(found, lambda s: s["score"] >= THRESHOLD)


def _apart(more: Column, had: Column) -> Column:
    """The spans of ``more`` that touch none of ``had``."""
    return F.filter(
        more,
        lambda s: ~F.exists(had, lambda h: (h["start"] < s["end"]) & (s["start"] < h["end"])),
    )


def with_spans(documents: DataFrame, *, text: str = "text", name: str = "pii") -> DataFrame:
    """``documents`` and an array column ``name`` of spans (kind, start, end, score, base).

    Spans come in the order of ``KINDS``, then of start; offsets are code points, the end
    exclusive. Spans of the method that touch a span of their kind found before are left out;
    base spans always stay. A null or empty text has no spans. Rows are independent: repeated
    rows or ids change nothing, and a column called ``name`` is refused.
    """
    if name.lower() in {c.lower() for c in documents.columns}:
        raise ValueError(f"documents already have a column {name}")
    columns = documents.columns
    whole = clear_name(documents, "pii_text_")
    df = documents.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    # One step, and one projection, for each thing that is used more than once: an expression
    # inside a lambda would be worked out again for every element.
    spans = [clear_name(documents, f"pii_spans_{i}_") for i in range(len(DETECTORS))]
    df = df.withColumns({s: _spans(F.col(whole), d) for s, d in zip(spans, DETECTORS, strict=True)})
    df = df.drop(whole)
    joined = []
    for kind in KINDS:
        first, *rest = (s for s, d in zip(spans, DETECTORS, strict=True) if d.kind == kind)
        for more in rest:
            df = df.withColumn(first, F.concat(F.col(first), _apart(F.col(more), F.col(first))))
        joined.append(F.array_sort(F.col(first), lambda a, b: a["start"] - b["start"]))
    return df.select(*columns, F.concat(*joined).alias(name))


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    out = F.aggregate(
        ordered,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda held, s: F.struct(
            F.when(
                s["start"] >= held["at"],
                F.concat(
                    held["done"],
                    F.substring(text, held["at"] + 1, s["start"] - held["at"]),
                    F.lit("<"),
                    F.upper(s["kind"]),
                    F.lit(">"),
                ),
            )
            .otherwise(held["done"])
            .alias("done"),
            F.greatest(held["at"], s["end"]).alias("at"),
        ),
        lambda held: F.concat(held["done"], F.substring(text, held["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)


def redact(documents: DataFrame, *, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows and columns of ``documents`` with personal data replaced in their texts.

    ``length`` is a column of text lengths that follows the change, where there is one.
    """
    found, changed = clear_name(documents, "pii_spans"), clear_name(documents, "pii_redacted")
    marked = with_spans(documents, text=text, name=found)
    marked = marked.withColumn(changed, redacted(F.col(text), F.col(found)))
    columns = []
    for c in documents.columns:
        if c == text:
            columns.append(F.col(changed).alias(c))
        elif c == length:
            count = F.length(F.col(changed)).cast(documents.schema[c].dataType)
            columns.append(F.when(F.size(found) > 0, count).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return marked.select(*columns)
