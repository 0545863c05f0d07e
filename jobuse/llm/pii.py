"""Personal data: base patterns, and spans added by weak supervision.

Everything is built-in functions. Four base kinds (e-mail, IP address, payment
card, phone) are found by their patterns and always count. Other candidate spans
- long tokens with digits in them, and whatever is assigned to a name that ends in
a word - get the votes of regex, gazetteer and
context labelers. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; the posteriors of the patterns then
train the span classifier, a naive Bayes model over what a span and its
surroundings look like. Candidates that it accepts and no base span touches are
added: as kind ``account`` where their form or the name before them is that of a
personal number (bank account, social security, passport), else as ``secret``.

Votes and features are counted over all documents. The tables that reach the
driver have one row for each vote pattern and each feature value, both bounded
by construction.

Posteriors are summed as whole millionths, so the model is the same in every run,
however the rows lie.

Places are code points, ends exclusive. Null and empty texts have no spans. Rows
are read alone, so repeated rows, null ids and extra columns need no care.
Without candidates nothing is added.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.llm.common import let, unused
from jobuse.llm.weak_labels import estimate
from jobuse.session import cut

KINDS = ("email", "ip", "card", "phone", "secret", "account")

# The base patterns. Possessive repeats, and starts only where a run of the first
# class starts or the last match ended, find the same matches in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# What a name is given (name=value, name: "value"), with or without digits. The first look behind is cheap and
# fails nearly everywhere.
ASSIGNED = r"""(?<=[=:\x20"'])(?<=[A-Za-z_]\x20?[=:]\x20?["']?)[A-Za-z0-9_!#$%&*+^~-]{6,}+"""
LONG = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{8,}+"      # any other long token with a digit
# Bank accounts, social security numbers, and cloud access ids, which need not have a digit.
IBAN = "^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"
SOCIAL = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
ACCESS_ID = r"A(?<![A-Za-z0-9]A)KIA[0-9A-Z]{16}(?![A-Za-z0-9_-])"
CANDIDATE = f"{ASSIGNED}|{ACCESS_ID}|{LONG}"

SPAN = "array<struct<start:int,kind:int,end:int>>"
MILLION = 1_000_000
CONTEXT = 32        # characters before a candidate that labelers see


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether 14 to 19 digits have a valid check digit."""
    def valid(digits: Column) -> Column:
        n = F.length(digits)

        def part(i: Column) -> Column:
            d = F.substring(digits, n - i, F.lit(1)).cast("int")
            twice = d * 2
            return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

        total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0), lambda a, x: a + x)
        return F.when(n.between(14, 19), total % 10 == 0).otherwise(F.lit(False))

    return let(_digits(value), valid)


def _matches(text: Column, pattern: str, item: str, make: Callable[[Column, Column, Column, Column, Column], Column],
             keep: Callable[[Column], Column]) -> Column:
    """``make(start, end, value, before, after)`` of the leftmost matches that ``keep`` holds for.

    What lies between matches gives their places: the lengths of all gaps and
    matches before one add up to its start.
    """
    def located(gaps: Column) -> Column:
        values = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda v, i: F.struct(v.alias("v"), i.alias("i")))

        def step(acc: Column, x: Column) -> Column:
            gap = F.get(gaps, x["i"])
            start = acc["at"] + F.length(gap)
            end = start + F.length(x["v"])
            made = F.array(make(start, end, x["v"], gap, F.get(gaps, x["i"] + 1)))
            return F.struct(end.alias("at"), F.when(keep(x["v"]), F.concat(acc["found"], made)).otherwise(acc["found"]).alias("found"))

        return F.aggregate(values, F.struct(F.lit(0).alias("at"), F.array().cast(item).alias("found")), step)["found"]

    return let(F.split(text, pattern, -1), located)


def _spans(text: Column, kind: str, pattern: str, sign: Column, keep: Callable[[Column], Column]) -> Column:
    """Spans of one kind; ``sign`` is a cheap test that a text has any."""
    def make(start, end, value, before, after):
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))

    return F.when(sign, _matches(text, pattern, SPAN, make, keep)).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Base spans (``start, kind, end``) by start, then kind."""
    return F.array_sort(F.concat(
        _spans(text, "email", EMAIL, text.contains("@"), lambda v: F.lit(True)),
        _spans(text, "ip", IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        _spans(text, "card", CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), _luhn),
        _spans(text, "phone", PHONE, text.rlike(r"\+[0-9]"), lambda v: F.length(_digits(v)).between(10, 15))))


# ---- candidates, and how labelers vote on them ------------------------------------

ITEM = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _may_hold(text: Column) -> Column:
    """A cheap test that no text with a candidate fails."""
    assigned = (text.contains("=") | text.contains(":")) & text.rlike(r"[=:]\x20?[\"']?[A-Za-z0-9_!#$%&*+^~-]{6}")
    return text.contains("AKIA") | assigned | text.rlike(LONG)


def candidates(text: Column) -> Column:
    def make(start, end, value, before, after):
        return F.struct(start.alias("start"), end.alias("end"), value.alias("value"),
                        F.right(before, F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(2)).alias("after"))

    return F.when(_may_hold(text), _matches(text, CANDIDATE, ITEM, make, lambda v: F.lit(True))).otherwise(F.array().cast(ITEM))


# Names that secrets, personal numbers and other values go by.
NAMES_SECRET = ("token|secret|password|passwd|passphrase|passcode|pwd|pass|key|api_key|apikey|auth|bearer|credential|credentials|access|"
                "private|login|otp|pin|contraseña|passwort|kennwort|geheim|clave")
NAMES_ACCOUNT = "account|iban|ssn|social|passport|licence_no|license_no|tax|kontonummer|cuenta|pasaporte|reisepass"
NAMES_OTHER = "version|license|licence|page|chapter|section|copyright|isbn|figure|table|release|http|https|www|time|date|note|example|step|part"


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _names(c: Column, names: str) -> Column:
    """Whether the last word before a candidate is one of some names."""
    return F.lower(c["before"]).rlike(rf"(?<![a-zñ])(?:{names})(?![a-zñ])[^a-zñ]*$")


def _iban(value: Column) -> Column:
    """Whether a bank account number has valid check digits: with its head moved behind, it is 1 modulo 97."""
    def rest(v: Column) -> Column:
        def step(acc: Column, c: Column) -> Column:
            letter = c.rlike("[A-Z]")
            return F.when(letter, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97).cast("int")

        return F.aggregate(F.split(F.concat(F.substring(v, F.lit(5), F.length(v)), F.left(v, F.lit(4))), ""), F.lit(0), step)

    return F.when(value.rlike(IBAN), rest(value) == 1).otherwise(F.lit(False))


def _account_shape(value: Column) -> Column:
    return value.rlike(SOCIAL) | _iban(value)


def _is_account(c: Column) -> Column:
    return _account_shape(c["value"]) | _names(c, NAMES_ACCOUNT)


# For each labeler, what it takes for a secret and what it takes for none; it abstains on the rest.
LABELERS: dict[str, Callable[[Column], Column]] = {
    # regex: hexadecimal, cloud-access and mixed-case keys; a word with a short number behind it
    "key_shape": lambda c: _vote(c["value"].rlike(r"^(?=.*[A-Za-z])(?:[0-9a-f]{16,}|[0-9A-F]{16,}|AKIA[0-9A-Z]{16}|(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]{24,})$"),
                                 c["value"].rlike(r"^[A-Za-z_-]+[0-9]{1,4}$|^[0-9-]+$") & ~c["value"].rlike(SOCIAL)),
    # gazetteer: names that secrets or other numbers go by, among the words before
    "named": lambda c: _vote(_names(c, f"{NAMES_SECRET}|{NAMES_ACCOUNT}"), _names(c, NAMES_OTHER)),
    # regex: a social security number, a bank account with valid check digits; one with others
    "account_shape": lambda c: _vote(_account_shape(c["value"]), c["value"].rlike(IBAN)),
    # context: assigned or quoted; in the run of a sentence
    "assigned": lambda c: _vote(c["before"].rlike(r"[=:]\s*[\"']?$|[\"']$"), c["before"].rlike(r"[A-Za-z,]\s$")),
    # context: closed by a quote; followed by a word
    "closed": lambda c: _vote(c["after"].rlike("^[\"']"), c["after"].rlike(r"^\s[A-Za-z]")),
    # regex: many different characters; few or a short token, unless it has the form of a personal number
    "varied": lambda c: let(F.size(F.array_distinct(F.split(c["value"], ""))),
                            lambda n: _vote((F.length(c["value"]) >= 20) & (n >= 9),
                                            ((F.length(c["value"]) < 12) | (n <= 4)) & ~c["value"].rlike(SOCIAL))),
}


def _charset(value: Column) -> Column:
    return (F.when(value.rlike("^[0-9-]+$"), "digits").when(value.rlike("^[0-9a-f]+$"), "hex").when(value.rlike("^[0-9A-F]+$"), "HEX")
            .when(value.rlike("^[0-9a-z_-]+$"), "lower").when(value.rlike("^[0-9A-Z_-]+$"), "upper").otherwise("mixed"))


# What the classifier sees; each feature has a bounded set of values.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "length": lambda c: F.least(F.length(c["value"]), F.lit(64)).cast("string"),
    "charset": lambda c: _charset(c["value"]),
    "digits": lambda c: (F.length(_digits(c["value"])) * 8 / F.length(c["value"])).cast("int").cast("string"),
    "before": lambda c: F.regexp_replace(F.regexp_replace(F.right(c["before"], F.lit(2)), "[A-Za-z]", "a"), "[^a\\s=:\"']", "x"),
    "after": lambda c: F.regexp_replace(F.regexp_replace(c["after"], "[A-Za-z]", "a"), "[^a\\s\"']", "x"),
    "word": lambda c: F.pmod(F.xxhash64(F.lower(F.regexp_extract(c["before"], r"([A-Za-z_]+)[^A-Za-z_]*$", 1))), F.lit(512)).cast("string"),
}


@dataclass(frozen=True)
class Model:
    """A prior and, for each feature value, log odds; ``reliability``: how likely each labeler's votes are on secrets, on the rest."""

    prior: float
    weights: dict[str, float]
    reliability: dict[str, dict[int, tuple[float, float]]]

    def accepts(self, c: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        table = F.map_from_arrays(*(F.array(*map(F.lit, x)) for x in zip(*sorted(self.weights.items()))))
        score = F.lit(self.prior)
        for name, f in FEATURES.items():
            score = score + F.coalesce(F.try_element_at(table, F.concat(F.lit(f"{name}="), f(c))), F.lit(0.0))
        return score > 0.0


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The span classifier, from the candidates of all documents."""
    text = F.col(f"`{text_col}`")
    c = F.col("c")
    seen = cut(docs.where(_may_hold(text)).select(F.explode(candidates(text)).alias("c"))
               .select(F.array(*(f(c) for f in LABELERS.values())).alias("votes"),
                       F.array(*(F.concat(F.lit(f"{name}="), f(c)) for name, f in FEATURES.items())).alias("features")))
    patterns = [(tuple(r["votes"]), r["n"]) for r in seen.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()]
    if not patterns:
        return Model(0.0, {}, {})
    posterior, reliability, prior = estimate(patterns, list(LABELERS), silence_tells=False)
    given = F.map_from_arrays(F.array(*(F.lit("".join(f"{v:+d}" for v in votes)) for votes, _ in patterns)), F.array(*map(F.lit, posterior)))
    key = F.array_join(F.transform("votes", lambda v: F.format_string("%+d", v)), "")
    counts = (seen.withColumn("p", F.round(F.element_at(given, key) * MILLION).cast("long")).select("p", F.explode("features").alias("feature"))
              .groupBy("feature").agg((F.sum("p") / MILLION).alias("yes"), (F.sum(MILLION - F.col("p")) / MILLION).alias("no")).collect())
    yes = sum(p * n for p, (_, n) in zip(posterior, patterns))
    no = sum(n for _, n in patterns) - yes
    weights = {r["feature"]: math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1)) for r in counts}
    return Model(math.log((yes + 0.5) / (no + 0.5)), weights, reliability)


def all_spans(text: Column, base: Column, model: Model) -> Column:
    """Base spans and the candidates that ``model`` accepts and no base span touches."""
    if not model.weights:
        return base

    def kind(c: Column) -> Column:
        return F.when(_is_account(c), F.lit(KINDS.index("account"))).otherwise(F.lit(KINDS.index("secret")))

    def added(b: Column) -> Column:
        free = F.filter(candidates(text), lambda c: ~F.exists(b, lambda s: (s["start"] < c["end"]) & (s["end"] > c["start"])))
        taken = F.transform(F.filter(free, model.accepts),
                            lambda c: F.struct(c["start"].alias("start"), kind(c).alias("kind"), c["end"].alias("end")))
        return F.array_sort(F.concat(b, taken))

    return F.when(_may_hold(text), let(base, added)).otherwise(base)


def _named(kind: Column) -> Column:
    return F.get(F.array(*map(F.lit, KINDS)), kind)


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _named(s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of start, kind number, end) of every document."""
    model = fit(docs, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    return rows.select("doc_id", "base", all_spans(F.col("text"), F.col("base"), model).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with ``[KIND]`` in place of each span; where spans overlap, the first stands for all.

    ``length_col``, if there is one, is set to the new length.
    """
    model = fit(docs, text_col)
    name = unused(docs, "spans")
    text, spans = F.col(f"`{text_col}`"), F.col(name)

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(_named(s["kind"])), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    out = F.when(F.size(spans) > 0, F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, finish)).otherwise(text)
    rows = docs.withColumn(name, base_spans(F.coalesce(text, F.lit(""))))
    rows = rows.withColumn(name, all_spans(F.coalesce(text, F.lit("")), spans, model))
    rows = rows.withColumn(text_col, out).drop(name)
    if length_col in docs.columns:
        rows = rows.withColumn(length_col, F.length(text).cast(docs.schema[length_col].dataType))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
