"""Quality rules under weak supervision.

Each rule looks at counts of a document and votes good or bad, or abstains. No
labels are used: expectation-maximisation takes the true class as hidden and
estimates, for each rule, how often its vote is right on good and on bad
documents, and the share of good ones. A document's quality is the posterior
probability of good given all its votes. So one bad vote of a rule that is
seldom wrong weighs more than many good votes of rules that let anything pass.

A rule's vote is one of three, so documents differ in at most 3 ** rules vote
patterns. The corpus is read once; each round of the estimation is one aggregate
over the counted patterns, whose number doesn't grow with the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, table

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for with as was be by on".split()
    + "le la les de des et que pour dans un une du est".split()
    + "der die das und ist von mit den ein eine zu im".split()
    + "el los las y en por con una del se no lo".split()
)

#: rule -> (votes bad, votes good), in SQL over the counts of ``measured``; neither: it abstains. Exact, in whole numbers.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("2 * word_chars < 5 * n_words OR word_chars > 12 * n_words", "word_chars >= 3 * n_words AND word_chars <= 10 * n_words AND n_words > 0"),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= n_words AND n_words > 0"),
    "repeats": ("10 * n_repeat_words > n_words", "50 * n_repeat_words <= n_words AND n_words >= 10"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "10 * n_dup_lines <= n_lines AND n_lines >= 3"),
    "letters": ("10 * n_letters < 6 * word_chars", "10 * n_letters >= 8 * word_chars AND word_chars > 0"),
    "capitals": ("10 * n_capitals > 4 * n_letters", "10 * n_capitals <= 2 * n_letters AND n_letters > 0"),
    "exclamations": ("10 * n_exclamations > n_words", "100 * n_exclamations <= n_words AND n_words > 0"),
    "variety": ("n_distinct * n_distinct < 4 * n_words", "n_distinct * n_distinct >= 25 * n_words AND n_words > 0"),
    "sentences": ("n_words > 100 * (n_stops + 1)", "n_words <= 40 * n_stops AND n_words > 0"),
    "function_words": ("n_words >= 30 AND 50 * n_function_words < n_words", "10 * n_function_words >= n_words AND n_words > 0"),
}
ROUNDS = 20
#: How many votes of a rule, and documents, the starting values weigh.
PRIOR = 10.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _neighbours(items: Column, field: str) -> Column:
    """Those of sorted structs whose field equals that of the one before or after."""
    same = lambda s, x, j: F.coalesce(F.get(s, j)[field] == x[field], F.lit(False))
    return let(items, lambda s: F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1)))


def repeated_words(words: Column) -> Column:
    """How many of the words lie in a window of five that the array holds twice or more.

    ``words`` must be a column, not an expression. Windows are hashed; without
    equal hashes none is repeated, else those that share a hash are compared as
    they are. Linear but for sorting, in memory of some times the text.
    """
    last = F.size(words) - WINDOW
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))

    def count(h: Column) -> Column:
        at = _neighbours(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), "h")
        exact = _neighbours(F.sort_array(F.transform(at, lambda x: F.struct(F.array_join(F.slice(words, x["i"] + 1, WINDOW), " ").alias("w"), x["i"].alias("i")))), "w")
        starts = F.sort_array(F.transform(exact, lambda x: x["i"].cast("long")))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        step = lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end"))
        return F.aggregate(starts, start, step, lambda a: a["n"])

    none = F.lit(0).cast("long")
    return F.coalesce(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(count(h))), none)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: its id and the counts of its whole text that the rules judge.

    A null text counts as an empty one: all counts 0. Repeated rows and null ids
    count each on their own; other columns aren't read. No shuffle.
    """
    long = lambda c: c.cast("long")
    kept = lambda of, pattern: long(F.length(F.regexp_replace(of, pattern, "")))
    t = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select("doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"), F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"))
    return t.select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        kept(F.col("t"), f"[{SPACE}]+").alias("word_chars"),
        long(F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"),
        kept(F.col("t"), r"\P{L}+").alias("n_letters"),
        kept(F.col("t"), r"\P{Lu}+").alias("n_capitals"),
        long(F.length("t") - F.length(F.translate("t", "!", ""))).alias("n_exclamations"),
        long(F.length("t") - F.length(F.translate("t", ".!?…", ""))).alias("n_stops"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
        long(F.size(F.filter("words", lambda w: w.isin(*FUNCTION_WORDS)))).alias("n_function_words"),
    )


def pattern() -> Column:
    """A row's votes as one number: digit j to base 3 is rule j's, 0 bad, 1 none, 2 good."""
    votes = [F.when(F.expr(bad), 0).when(F.expr(good), 2).otherwise(1) * 3**j for j, (bad, good) in enumerate(RULES.values())]
    return sum(votes[1:], votes[0]).cast("int")


@dataclass(frozen=True)
class Model:
    """The share of good documents; of each rule, the share of its votes that are right on good and on bad ones."""

    good: float
    on_good: list[float]
    on_bad: list[float]

    def posterior(self, votes: Column) -> Column:
        """The probability of good, given an array of votes in the order of the rules."""
        weights = F.lit([[math.log((1 - a) / b), 0.0, math.log(a / (1 - b))] for a, b in zip(self.on_good, self.on_bad, strict=True)])
        odds = F.aggregate(F.zip_with(votes, weights, lambda v, w: F.get(w, v)), F.lit(math.log(self.good / (1 - self.good))), lambda total, w: total + w)
        return 1 / (1 + F.exp(-odds))


def votes_of(code: Column) -> Column:
    return F.transform(F.lit([3**j for j in range(len(RULES))]), lambda p: F.pmod(F.floor(code / p), F.lit(3)).cast("int"))


START = Model(0.8, [0.99] * len(RULES), [0.3] * len(RULES))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over rows (votes, n): a pattern of votes and how many documents have it.

    Rules are taken as independent given the class, and none as worse than
    guessing: bad votes are at least as likely on bad documents as on good ones.
    PRIOR counts of votes and documents as ``START`` has them are added, so
    that no share gets to 0 or 1, and without rows START comes back. A round is
    one aggregate; only its sums, three a rule, reach the driver.
    """
    m = START
    for _ in range(rounds):
        good = patterns.select((F.col("n") * m.posterior(F.col("votes"))).alias("g"), "n", F.posexplode("votes").alias("j", "v"))
        sums = {(x.j, x.v): (x.g, x.n - x.g) for x in good.groupBy("j", "v").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).collect()}
        of = lambda j, side, *votes: sum(sums.get((j, v), (0.0, 0.0))[side] for v in votes)
        share = lambda right, all_, start: (right + PRIOR * start) / (all_ + PRIOR)
        on_good = [share(of(j, 0, 2), of(j, 0, 0, 2), a) for j, a in enumerate(START.on_good)]
        on_bad = [max(share(of(j, 1, 0), of(j, 1, 0, 2), b), 1 - a) for j, (a, b) in enumerate(zip(on_good, START.on_bad, strict=True))]
        m = Model(share(of(0, 0, 0, 1, 2), of(0, 0, 0, 1, 2) + of(0, 1, 0, 1, 2), START.good), on_good, on_bad)
    return m


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def judged(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row: its counts, ``base_failed``, ``quality`` (the posterior, to 6 digits) and ``kept``.

    kept: not base_failed, and quality is ``least`` or more. An empty table gives
    an empty one. See ``measured`` for nulls and repeated rows.
    """
    counts = scratch.keep(measured(df, id_col, text_col).withColumn("code", pattern()))
    patterns = scratch.keep(counts.groupBy("code").agg(F.count(F.lit(1)).alias("n")).select(votes_of(F.col("code")).alias("votes"), "n").repartition(1))
    quality = F.round(estimate(patterns).posterior(votes_of(F.col("code"))), 6)
    out = counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("quality", quality)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).drop("code")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), Scratch(spark, "rules"))


def _sql() -> str:
    k = len(RULES)
    code = " + ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END * {3**j}" for j, (bad, good) in enumerate(RULES.values()))
    vote = lambda j: f"(code // {3**j}) % 3"
    odds = "ln(p / (1 - p)) + " + " + ".join(f"CASE {vote(j)} WHEN 2 THEN ln(a{j} / (1 - b{j})) WHEN 0 THEN ln((1 - a{j}) / b{j}) ELSE 0 END" for j in range(k))
    of = lambda what, when: f"coalesce(sum({what}) FILTER ({when}), 0)"
    share = lambda what, j, v, start: f"({of(what, f'{vote(j)} = {v}')} + {PRIOR * start}::DOUBLE) / ({of(what, f'{vote(j)} <> 1')} + {PRIOR}::DOUBLE)"
    steps = ["m0 AS (SELECT " + ", ".join([f"{START.good}::DOUBLE AS p"] + [f"{START.on_good[j]}::DOUBLE AS a{j}, {START.on_bad[j]}::DOUBLE AS b{j}" for j in range(k)]) + ")"]
    for r in range(ROUNDS):
        acc = ", ".join(f"{share('g', j, 2, START.on_good[j])} AS a{j}, greatest({share('n - g', j, 0, START.on_bad[j])}, 1 - a{j}) AS b{j}" for j in range(k))
        steps.append(f"m{r + 1} AS MATERIALIZED (SELECT ({of('g', 'true')} + {PRIOR * START.good}::DOUBLE) / ({of('n', 'true')} + {PRIOR}::DOUBLE) AS p, {acc} FROM (SELECT code, n, n / (1 + exp(-({odds}))) AS g FROM patterns, m{r}))")
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM t),
g AS (SELECT r, i, words[i:i+4] AS win FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
f AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM f, range(5) x(o) GROUP BY r),
c AS MATERIALIZED (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[{SPACE}]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, length(regexp_replace(t, '\\P{{L}}+', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(t, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_capitals, length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclamations,
    length(regexp_replace(t, '[^.!?…]+', '', 'g'))::BIGINT AS n_stops, len(list_distinct(words))::BIGINT AS n_distinct,
    len(list_filter(words, lambda x: list_contains({list(FUNCTION_WORDS)}, x)))::BIGINT AS n_function_words
  FROM w LEFT JOIN rep USING (r)
),
v AS MATERIALIZED (SELECT *, {code} AS code FROM c),
patterns AS MATERIALIZED (SELECT code, count(*)::DOUBLE AS n FROM v GROUP BY code),
{", ".join(steps)},
q AS (SELECT v.* EXCLUDE (code), {BASE_FAILED} AS base_failed, round(1 / (1 + exp(-({odds}))), 6) AS quality FROM v, m{ROUNDS})
SELECT *, NOT base_failed AND quality >= 0.5 AS kept FROM q
"""


ORACLE = _sql()
