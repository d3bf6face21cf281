"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule reads one text and says whether it rejects it. `plan_cascade` estimates
every rule's cost and how much it rejects on a sample, and orders the
rules by rejection per cost, each by what it rejects of the rows that the rules before
it let through; `cascade` compiles that order into one CASE whose
later branches are evaluated only for documents that the earlier ones let
through. The order never changes which documents are rejected, only what it
costs to find out (and which rule is named first).

Defined results: a null or empty text has no words (rejected as too short);
repeated rows are judged one by one; other columns pass through unchanged; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, let, materialize, words

SYMBOLS = "#*$%&|<>"
#: Rows, about, that costs and selectivities are estimated on.
SAMPLE_ROWS = 2000
#: Work of a count by characters and by words of its text, in units of one pass of a simple pattern over a character. Fixed values.
WORK = {"n_words": (1.0, 2.0), "word_chars": (1.0, 0.0), "n_symbols": (1.0, 0.0), "n_bangs": (0.3, 0.0), "n_dup_lines": (1.0, 1.0), "n_lines": (1.0, 0.5), "n_repeat_words": (1.0, 12.0)}


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \t-\r]"))


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows that the word array holds at least twice.

    Windows are compared by 64-bit hash within one text. Only texts with a repeat
    pay for the sort that finds where the repeats lie: O(n log n), also for very long texts.
    """

    def spread(starts: Column) -> Column:
        """Words covered by windows of three at the sorted starts."""
        step = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3)))
        return F.aggregate(step, F.lit(0), lambda acc, x: acc + x)

    def repeated(s: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(j, j - 1) | same(j, j + 1), x["i"]))
        return F.array_sort(F.array_compact(marked))

    def located(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(let(ranked, repeated), spread)

    def of_hashes(v: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(v) - 3), lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(located(h)))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes)).cast("long")


class Counts:
    """What rules read of one text; every count is an expression over the text, evaluated where a rule needs it."""

    def __init__(self, text: Column):
        self.text = text

    def n_words(self) -> Column:
        return F.size(words(self.text)).cast("long")

    def word_chars(self) -> Column:
        return F.length(F.regexp_replace(self.text, "[ \t-\r]+", "")).cast("long")

    def n_symbols(self) -> Column:
        return (F.length(self.text) - F.length(F.regexp_replace(self.text, "[#*$%&|<>]+", ""))).cast("long")

    def n_bangs(self) -> Column:
        return (F.length(self.text) - F.length(F.replace(self.text, F.lit("!")))).cast("long")

    def n_dup_lines(self) -> Column:
        """Lines with a word that equal an earlier line."""
        return let(lines(self.text), lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")

    def n_lines(self) -> Column:
        return F.size(lines(self.text)).cast("long")

    def n_repeat_words(self) -> Column:
        return let(words(self.text), repeat_words)


class Counted(Counts):
    """Counts of which some are columns already."""

    def __init__(self, text: Column, *done: str):
        super().__init__(text)
        for name in done:
            setattr(self, name, lambda name=name: F.col(name))


@dataclass(frozen=True)
class Rule:
    """name, the counts that it reads, and rejects(Counts): true for a document that the rule throws out."""

    name: str
    reads: tuple[str, ...]
    rejects: Callable[[Counts], Column]


RULES = (
    Rule("too_short", ("n_words",), lambda c: c.n_words() < 50),
    Rule("repeated_words", ("n_repeat_words",), lambda c: let(words(c.text), lambda w: repeat_words(w) * 100 > F.size(w) * 50)),
    Rule("symbols", ("n_symbols", "word_chars"), lambda c: c.n_symbols() * 20 > c.word_chars()),
    Rule("shouting", ("n_bangs", "word_chars"), lambda c: c.n_bangs() * 10 > c.word_chars()),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda c: let(c.n_dup_lines(), lambda d: (d > 2) & (d * 2 > c.n_lines()))),
    Rule("word_length", ("n_words", "word_chars"), lambda c: let(c.n_words(), lambda n: (c.word_chars() > n * 25) | (c.word_chars() < n * 2))),
)


def plan_cascade(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, done: tuple[str, ...] = ()) -> list[dict]:
    """The rules in order, each with its cost and its selectivity (the share of the sample that it rejects and the rules before it don't), best rejection per cost first.

    The sample is a hash of the row number, written to the shared folder by the tasks that scan the text column: no row
    is shuffled, and what comes back is a row for each combination of verdicts. A rule's cost is the work (`WORK`) of the
    counts that it reads on the sample's texts, without those that are `done`, so an order depends on the data alone.
    """
    total = df.count()
    every = max(1, total // sample_rows)
    number = F.xxhash64(F.monotonically_increasing_id())
    picked = df.select(text_of(text).alias("t"), F.pmod(number, F.lit(every)).alias("k")).filter("k = 0").select("t")
    sample = materialize(picked, "quality-sample")
    flags = [rule.rejects(Counts(F.col("t"))).alias(f"r{k}") for k, rule in enumerate(rules)]
    seen = sample.select(*flags, F.length("t").alias("chars"), F.size(words(F.col("t"))).alias("words")).groupBy(*(f"r{k}" for k in range(len(rules)))).agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("words").alias("words"))
    left = [x.asDict() for x in seen.collect()]  # two to the number of rules at most
    drop_table(sample)
    rows = max(1, sum(x["n"] for x in left))
    chars, n_words = (sum(x[c] for x in left) / rows for c in ("chars", "words"))
    cost = [1.0 + sum(WORK[c][0] * chars + WORK[c][1] * n_words for c in rule.reads if c not in done) for rule in rules]
    plan, open_ = [], set(range(len(rules)))
    while open_:
        share = {k: sum(x["n"] for x in left if x[f"r{k}"]) / rows for k in open_}
        best = min(open_, key=lambda k: (-share[k] / cost[k], cost[k], rules[k].name))
        plan.append({"rule": rules[best], "cost": cost[best], "selectivity": share[best]})
        left = [x for x in left if not x[f"r{best}"]]
        open_.remove(best)
    return plan


def cascade(df: DataFrame, order: list[Rule], text: str = "text", verdict: str = "rejected_by") -> DataFrame:
    """df with the first rule of the order that rejects the row, or null."""
    found = None
    for rule in order:
        hit = rule.rejects(Counts(text_of(text)))
        found = F.when(hit, F.lit(rule.name)) if found is None else found.when(hit, F.lit(rule.name))
    return df.withColumn(verdict, found if found is not None else F.lit(None).cast("string"))


def keep(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    order = [p["rule"] for p in plan_cascade(df, text, rules)]
    mark = "__rejected_by"
    return cascade(df, order, text, mark).filter(F.col(mark).isNull()).drop(mark)


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the counts, base_failed and kept.

    The counts that are returned are computed once and shared. The other rules run as a cascade behind the base test: what
    they read besides (exclamation marks, for one) is only counted in texts that the rules before let through.
    """
    t = text_of(text)
    c = Counts(t)
    of_words = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"), repeat_words(w).alias("n_repeat_words"))
    of_lines = lambda v: F.struct((F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"), F.size(v).cast("long").alias("n_lines"))
    raw = df.select(F.col(doc_id).alias("doc_id"), t.alias("__t"), let(words(t), of_words).alias("w"), let(lines(t), of_lines).alias("l"), c.n_symbols().alias("n_symbols"))
    base = raw.select("doc_id", "__t", "n_symbols", "w.*", "l.*")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rest = tuple(r for r in rules if r.name not in ("too_short", "repeated_words"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
    order = [p["rule"] for p in plan_cascade(df, text, rest, done=names)]
    done = Counted(F.col("__t"), *names)
    first = F.when(failed, F.lit("base"))
    for rule in order:
        first = first.when(rule.rejects(done), F.lit(rule.name))
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), first.isNull().alias("kept"))
