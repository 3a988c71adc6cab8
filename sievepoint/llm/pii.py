"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.llm.text import once, whole_text

# The patterns take the same matches as the plain forms in the comments, but neither recurse nor start anew inside
# a run that has failed, so a text of any length takes linear time and constant stack. \G: where the last match ended.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
             r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?:\G|(?<![0-9]))[0-9](?:(?![ -](?![0-9]))[0-9 -])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    # Keys of a known shape: cloud access keys, repository tokens, signed web tokens, heads of private keys.
    "key": r"(?<![A-Za-z0-9_])(?:A(?:KIA|SIA)[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{36}|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"
           r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)(?![A-Za-z0-9_])",
    # A name that says so and its value.
    "secret": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?[A-Za-z0-9_.+/=-]{8,}+[\"']?",
}
BASE = ("email", "ip", "card", "phone")
# What a text must hold for the pattern to be tried; each follows from the pattern.
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][ -]?[0-9]"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
    "key": lambda t: t.rlike(r"AKIA|ASIA|gh[oprsu]_|eyJ|-----BEGIN "),
    "secret": lambda t: t.rlike(r"[A-Za-z][\"']?[ \t]{0,3}[:=]"),
}
# Score before and after words nearby; a span of an added kind is reported from 0.6, a base span always.
START = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "key": 0.9, "secret": 0.6}
BONUS, REPORT_AT, REACH = 0.3, 0.6, 40
# Words that raise the score of a kind, lower case.
CONTEXT = {
    "email": ["mail", "contact", "correo", "courriel"],
    "ip": ["ip", "address", "server", "host", "adresse"],
    "card": ["card", "visa", "credit", "tarjeta", "carte", "karte"],
    "phone": ["phone", "tel", "call", "mobile", "fax", "telefon"],
    "iban": ["iban", "bank", "account", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social security", "security number"],
    "key": ["key", "access", "token", "credentials"],
    "secret": ["login", "user", "account", "credentials", "auth"],
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Checksum of the digits of a text: every second one from the right counts double, less 9 from 10 on."""
    digits = F.reverse(_digits(text))
    at = F.sequence(F.lit(0), F.length(digits) - 1)

    def part(i):
        d = digits.substr(i + 1, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(at, F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def mod97(text: Column) -> Column:
    """Bank account check: first four characters last, A to Z as 10 to 35, remainder 1 by 97."""
    plain = F.regexp_replace(text, "[^A-Z0-9]", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(acc, i):
        code = F.ascii(turned.substr(i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": lambda m: F.when(F.length(_digits(m)).between(12, 19), luhn(m)).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
    "iban": lambda m: F.when(F.length(F.regexp_replace(m, " ", "")).between(15, 34), mod97(m)).otherwise(False),
    "ssn": lambda m: F.lit(True),
    "key": lambda m: F.lit(True),
    "secret": lambda m: F.lit(True),
}


# So many matches and the pieces beside them hold ``REACH`` code points at least: a match has two and stands apart by one.
BESIDE = 20


def _running(lengths: Column) -> Column:
    """Sums up to each element, in as many rounds as the number of elements has binary digits, none of which copies a list so far."""
    rounds = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths).cast("double"))).cast("int")),
                         lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(rounds, lengths, lambda acc, step: F.transform(
        acc, lambda v, i: v + F.when(i >= step, F.get(acc, i - step)).otherwise(0)))


def _spans(kind: str) -> Column:
    """The valid matches in ``found`` as (start, end, score), in code points.

    The built-ins give matches and the ``pieces`` between them but no places; lengths add up to places in ``starts``. Words
    nearby are looked for in the ends of the pieces and matches beside a match, never in the whole text.
    """
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    at = F.filter(F.sequence(F.lit(0), F.size("found") - 1), lambda i: VALID[kind](F.get("found", i)))

    def span(i):
        first = F.greatest(i - BESIDE, F.lit(0))
        before = F.array_join(F.transform(F.sequence(first, i), lambda k: F.concat(
            F.get("tails", k), F.when(k < i, F.get("found", k)).otherwise(""))), "")
        last = F.least(i + BESIDE, F.size("found"))
        after = F.array_join(F.transform(F.sequence(i + 1, last), lambda k: F.concat(
            F.get("heads", k), F.when(k < last, F.get("found", k)).otherwise(""))), "")
        near = F.lower(F.concat(F.right(before, F.lit(REACH)), F.lit(" "), F.left(after, F.lit(REACH))))
        said = near.rlike(r"\b(" + "|".join(CONTEXT[kind]) + r")\b")
        score = F.least(F.lit(1.0), F.lit(START[kind]) + F.when(said, BONUS).otherwise(0.0))
        start = F.get("starts", i)
        return F.struct(start.alias("start"), (start + F.length(F.get("found", i))).alias("end"), score.alias("score"))
    return F.when(F.size("found") > 0, F.transform(at, span)).otherwise(none)


def find_personal_data(docs: DataFrame, kinds: tuple[str, ...] = tuple(PATTERNS)) -> DataFrame:
    """Spans of personal data: doc_id, spans (array of kind, start, end, score), ordered by start, then kind.

    Emails, network addresses, cards (12 to 19 digits that pass Luhn) and phone numbers (9 to 15 digits) are always
    reported; bank accounts (that pass the remainder by 97), social security numbers, keys and named secrets if their score reaches 0.6. A word
    of the kind's list within 40 code points on either side adds 0.3, up to 1. Each kind takes its matches from left to
    right without overlap; kinds may overlap. Places are code points, end exclusive.

    A NULL or empty text has no span. Repeated rows come back as often as they are given. Other columns are
    ignored; an empty table gives an empty result. Whole texts are read; n matches in one text take time in proportion to n log n.
    """
    rows = docs.select("doc_id", whole_text("text").alias("body"))
    for kind in kinds:
        body, pattern = F.col("body"), PATTERNS[kind]
        rows = once(rows, found=F.when(NEEDS[kind](body), F.regexp_extract_all(body, F.lit(pattern), 0)))
        some = F.size("found") > 0
        rows = once(rows, pieces=F.when(some, F.split(body, pattern, -1)))
        steps = F.transform("found", lambda m, i: F.length(F.get("pieces", i)) + F.when(i > 0, F.length(F.get("found", i - 1))).otherwise(0))
        rows = once(rows, starts=F.when(some, _running(steps)),
                    tails=F.transform("pieces", lambda p: F.right(p, F.lit(REACH))), heads=F.transform("pieces", lambda p: F.left(p, F.lit(REACH))))
        rows = once(rows, **{f"{kind}_spans": _spans(kind)}).drop("found", "pieces", "starts", "tails", "heads")

    def listed(kind):
        return F.transform(f"{kind}_spans", lambda x: F.struct(
            x["start"].alias("start"), F.lit(list(PATTERNS).index(kind)).alias("order"), F.lit(kind).alias("kind"),
            x["end"].alias("end"), x["score"].alias("score")))
    every = F.concat(*(listed(k) for k in kinds))
    reported = F.filter(every, lambda x: x["kind"].isin(*BASE) | (x["score"] >= REPORT_AT))
    return rows.select("doc_id", F.transform(F.array_sort(reported), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["score"].alias("score"))).alias("spans"))
