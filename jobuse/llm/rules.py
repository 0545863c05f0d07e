"""Quality rules: statistics of a text, and decision lists learned from labels.

Everything is built-in functions. A decision list is learned by sequential
covering: a rule grows condition by condition (a statistic above or below a
threshold) on part of the labelled rows, loses its last conditions again while
that helps on the rest, and the rows it covers leave. Each step is one aggregate
over the labelled statistics, which returns counts for every threshold at once.
The list becomes one ordered conditional expression.

Null and empty texts have no words and fail the base rule. Labels of unknown
documents and null labels are passed over; without labels of both kinds there are
no rules, and only the base rule rejects. A document labelled twice counts twice.
Rows are judged alone, so repeated rows, null ids and extra columns need no care.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.llm.common import SPACE_RUN, SPACES, let, unused
from jobuse.session import cut

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN, -1), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more: equal windows stand together once sorted."""
    def covered(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                              lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("hash"), i.alias("at")))
        return let(F.sort_array(windows), lambda s: F.aggregate(
            F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(
                (F.get(s, k - 1)["hash"] == x["hash"]) | (F.get(s, k + 1)["hash"] == x["hash"]),
                F.get(s, k - 1)["hash"] == x["hash"], F.get(s, k + 1)["hash"] == x["hash"], F.lit(False))), lambda x: x["at"])),
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")))["n"])

    return let(words, lambda w: F.when(F.size(w) >= 3, covered(w)).otherwise(F.lit(0)))


def statistics(text: Column) -> Column:
    """A struct of counts of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, SPACES) != "")
    return let(words_of(text), lambda words: let(lines, lambda rows: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
        _repeated_words(words).cast("long").alias("n_repeat_words"),
        F.size(rows).cast("long").alias("n_lines"),
        (F.length(text) - F.length(_without(text, UPPER))).cast("long").alias("n_upper"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


# The measures that rules may test; each is a ratio with a floor of one below the line.
def _over(s: Column, above: str, below: str) -> Column:
    return s[above] / F.greatest(s[below], F.lit(1)).cast("double")


MEASURES = {
    "words": lambda s: s["n_words"].cast("double"),
    "chars_per_word": lambda s: _over(s, "word_chars", "n_words"),
    "symbols_per_word": lambda s: _over(s, "n_symbols", "n_words"),
    "duplicate_lines": lambda s: _over(s, "n_dup_lines", "n_lines"),
    "repeated_words": lambda s: _over(s, "n_repeat_words", "n_words"),
    "upper_case": lambda s: _over(s, "n_upper", "word_chars"),
    "words_per_line": lambda s: _over(s, "n_words", "n_lines"),
    "distinct_words": lambda s: _over(s, "n_distinct", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _below(measure: str):
    return lambda threshold: F.col(measure) > threshold


def _holds(rule: Rule, measures: Column) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(measures[c.measure])
    return out


def verdict(rules: list[Rule], s: Column) -> Column:
    """The decision list as a conditional expression: the first rule that holds rejects, none keeps."""
    measures = {name: f(s) for name, f in MEASURES.items()}
    out = F
    for rule in rules:
        out = out.when(_holds(rule, measures), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


@dataclass(frozen=True)
class Learner:
    """How rules are learned. ``max_labelled`` bounds the labelled rows that are looked at."""

    max_labelled: int = 8_000
    thresholds: int = 40            # for each measure, at even ranks
    max_rules: int = 12
    max_conditions: int = 4
    min_covered: int = 5            # on the pruning part
    min_precision: float = 0.9      # on the pruning part

    def sample(self, docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``bad, prune`` and the measures of at most ``max_labelled`` labelled documents, evenly by hash."""
        chosen = (labels.select(F.col("doc_id"), (F.col("quality") == 0).alias("bad")).dropna()
                  .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id", "bad").limit(self.max_labelled))
        rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "bad", statistics(F.col("text")).alias("s"))
        return cut(rows.select("bad", (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("prune"),
                               *(f(F.col("s")).alias(name) for name, f in MEASURES.items())))

    def learn(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
        rows = self.sample(docs, labels, id_col, text_col)
        ranks = [k / (self.thresholds + 1) for k in range(1, self.thresholds + 1)]
        # Ranks of the rejected rows as well as of all: what they differ in may be rare overall.
        found = rows.groupBy().agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"),
            *(F.array_union(F.coalesce(F.percentile_approx(m, ranks, 10_000), F.array()),
                            F.coalesce(F.percentile_approx(F.when(F.col("bad"), F.col(m)), ranks, 10_000), F.array())).alias(m)
              for m in MEASURES)).first()
        if not found["bad"] or not found["good"]:
            return []
        cuts = {m: sorted(found[m]) for m in MEASURES}
        binned = cut(rows.withColumn("bins", F.array(*(
            F.size(F.filter(F.array(*map(F.lit, cuts[m])), _below(m))) for m in MEASURES))))
        rules: list[Rule] = []
        left = binned
        while len(rules) < self.max_rules:
            rule = self._prune(left.where("prune"), self._grow(left.where("not prune"), cuts))
            if not rule:
                break
            rules.append(rule)
            left = left.where(~_holds(rule, {m: F.col(m) for m in MEASURES}))
        return rules

    def _grow(self, rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
        rule: Rule = ()
        names = list(MEASURES)
        while len(rule) < self.max_conditions:
            counts = (rows.select("bad", F.posexplode("bins").alias("measure", "bin")).groupBy("measure", "bin")
                      .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect())
            bad, good = (sum(c[k] for c in counts if c["measure"] == 0) for k in ("bad", "good"))
            if not bad or not good:
                break
            best, gain = None, 0.0
            for m, name in enumerate(names):
                for above in (True, False):
                    b = g = 0
                    bins = sorted((c for c in counts if c["measure"] == m), key=lambda c: c["bin"], reverse=above)
                    for c, following in zip(bins, bins[1:]):
                        b, g = b + c["bad"], g + c["good"]
                        # From the top: rows above the threshold below this bin. From the bottom: up to the one above it.
                        threshold = cuts[name][c["bin"] - 1 if above else c["bin"]]
                        value = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good))) if b else 0.0
                        if value > gain + 1e-9:
                            best, gain = Condition(name, above, threshold), value
            if best is None:
                break
            rule += (best,)
            rows = rows.where(best.column(F.col(best.measure)))
        return rule

    def _prune(self, rows: DataFrame, rule: Rule) -> Rule:
        """The prefix of a rule that does best on rows it was not grown on; none if that is not good enough."""
        if not rule:
            return ()
        measures = {m: F.col(m) for m in MEASURES}
        counts = rows.groupBy().agg(*(
            F.count_if(_holds(rule[:k], measures) & (F.col("bad") == bad)).alias(f"{'bad' if bad else 'good'}{k}")
            for k in range(1, len(rule) + 1) for bad in (True, False))).first()
        best: Rule = ()
        worth = -1.0
        for k in range(1, len(rule) + 1):
            b, g = counts[f"bad{k}"], counts[f"good{k}"]
            if b + g >= self.min_covered and b >= self.min_precision * (b + g) and (b - g) / (b + g + 1) > worth:
                best, worth = rule[:k], (b - g) / (b + g + 1)
        return best


def judge(docs: DataFrame, labels: DataFrame, learner: Learner = Learner(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed`` and ``kept`` of every document."""
    rules = learner.learn(docs, labels, id_col, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), statistics(F.col(f"`{text_col}`")).alias("s"))
    s = F.col("s")
    return rows.select("doc_id", *(s[k].alias(k) for k in BASE), base_failed(s).alias("base_failed"),
                       (~base_failed(s) & verdict(rules, s)).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, learner: Learner = Learner(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    rules = learner.learn(docs, labels, id_col, text_col)
    name = unused(docs, "statistics")
    rows = docs.withColumn(name, statistics(F.col(f"`{text_col}`")))
    s = F.col(name)
    return rows.where(~base_failed(s) & verdict(rules, s)).drop(name)
