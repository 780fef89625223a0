"""Weak supervision over document quality: rules vote, EM weighs them, a posterior decides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import SEPARATORS, let, pick, rows_of, with_row, words
from lapwise.session import stored

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


# Each rule looks at one kind of evidence, votes either way where that is clear and abstains in
# between, so rules overlap and can disagree.
RULES = (
    Rule("symbols_per_word", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("symbols_per_char", "50 * n_symbols > word_chars", "1000 * n_symbols <= word_chars"),
    Rule("word_length", "2 * word_chars > 13 * n_words or 5 * word_chars < 19 * n_words",
         "2 * word_chars >= 9 * n_words and word_chars <= 6 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines and n_dup_lines > 2",
         "n_dup_lines = 0 and n_lines >= 3"),
    Rule("repeated_words", "100 * n_repeat_words > 10 * n_words", "100 * n_repeat_words <= 2 * n_words"),
    Rule("capitals", "3 * n_upper > word_chars", "8 * n_upper < word_chars"),
)

# What is believed before any document is seen, and how many documents that belief weighs: a rule
# seldom accuses a good document and finds three bad ones in ten.
GOOD_SHARE, GOOD_RIGHT, BAD_FOUND, BELIEF = 0.9, 0.98, 0.3, 20.0

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
)


def repeat_words(word_list: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the list.

    Windows are compared by a 64-bit hash.  Only a list that has a repeated window is
    sorted to find which words the repeated windows cover.
    """
    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(w, i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(
            marked,
            lambda s: F.filter(
                s,
                lambda x, k: (x["h"] == F.get(s, k + 1)["h"])
                | ((k > 0) & (x["h"] == F.get(s, F.greatest(k - 1, F.lit(0)))["h"])),
            ),
        )
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda s, i: F.struct(
                i.alias("last"),
                (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"),
            ),
            lambda s: s["n"],
        )

    return let(
        let(word_list, windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            covered(h)
        ),
    )


def measured(text: Column) -> Column:
    """A struct of `FEATURES` for one text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.regexp_replace(s, SEPARATORS + "+", "")) > 0)

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        )

    return let(words(text), of)


def votes() -> Column:
    """One character for each rule: ``-`` bad, ``+`` good, ``0`` abstains."""
    return F.concat(
        *[F.when(F.expr(r.bad), "-").when(F.expr(r.good), "+").otherwise("0") for r in RULES]
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def posteriors(voted: DataFrame, rounds: int = 40) -> DataFrame:
    """``pattern, posterior`` from a frame with ``pattern`` and ``base_failed`` per document.

    Documents with the same votes count as one weighted pattern, of which there are at most
    3 to the power of the number of rules; the EM is a fold over that list.  It learns from
    the documents that pass the base rule, which the others do not need.  A rule has an
    accuracy for each class, taken over the documents it votes on: ``a`` is the share of its votes
    on good documents that are good, ``b`` that of its votes on bad ones that are bad.
    Abstaining says nothing, and rules err independently.  ``a`` stays at least 0.5 and ``b`` at least
    ``1 - a``, so a vote never counts for the other side.
    """
    n = len(RULES)
    patterns = voted.groupBy("pattern").agg(F.count_if(~F.col("base_failed")).cast("double").alias("c"))
    listed = patterns.agg(F.sort_array(F.collect_list(F.struct("pattern", "c"))).alias("ps"))
    signs = ", ".join(
        f"case substr(p.pattern, {j + 1}, 1) when '+' then 1 when '-' then -1 else 0 end"
        for j in range(n)
    )
    coded = listed.select(
        F.expr(f"transform(ps, p -> struct(p.pattern as pattern, p.c as c, array({signs}) as v))").alias("ps")
    )
    log_odds = (
        f"ln(m.prior / (1 - m.prior)) + aggregate(sequence(0, {n - 1}), 0D, (s, j) -> s + case p.v[j]"
        " when 1 then ln(m.a[j] / (1 - m.b[j])) when -1 then ln((1 - m.a[j]) / m.b[j]) else 0D end)"
    )
    shared = f"transform(ps, p -> struct(p.c as c, p.v as v, 1 / (1 + exp(-({log_odds}))) as q))"
    total = "greatest(aggregate(qs, 0D, (s, x) -> s + x.c), 1D)"
    good = "aggregate(qs, 0D, (s, x) -> s + x.c * x.q)"

    def seen(vote: str, weight: str) -> str:
        return f"aggregate(qs, 0D, (s, x) -> s + if(x.v[j] {vote}, x.c * {weight}, 0D))"

    right = (
        f"({seen('= 1', 'x.q')} + {BELIEF * GOOD_RIGHT}D) / ({seen('<> 0', 'x.q')} + {BELIEF}D)"
    )
    found = (
        f"({seen('= -1', '(1 - x.q)')} + {BELIEF * BAD_FOUND}D) / ({seen('<> 0', '(1 - x.q)')} + {BELIEF}D)"
    )
    step = (
        f"element_at(transform(array({shared}), qs -> element_at(transform(array("
        f"transform(sequence(0, {n - 1}), j -> least(0.9999D, greatest(0.5D, {right})))), a -> struct("
        f"least(0.99D, greatest(0.05D, {good} / {total})) as prior, a as a,"
        f" transform(sequence(0, {n - 1}), j -> least(0.9999D, greatest(0.0001D, 1 - a[j], {found}))) as b)), 1)), 1)"
    )
    start = (
        f"struct({GOOD_SHARE}D as prior, array_repeat({GOOD_RIGHT}D, {n}) as a, array_repeat({BAD_FOUND}D, {n}) as b)"
    )
    fitted = coded.select(
        "ps", F.expr(f"aggregate(sequence(1, {rounds}), {start}, (m, i) -> {step})").alias("m")
    )
    return fitted.select(
        F.explode(F.expr(
            f"transform(ps, p -> struct(p.pattern as pattern, 1 / (1 + exp(-({log_odds}))) as posterior))"
        )).alias("x")
    ).select("x.*")


def judged(features: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``features`` with ``base_failed``, ``posterior`` and ``kept``."""
    voted = features.withColumn("pattern", votes()).withColumn("base_failed", base_failed())
    # At most 3 ** len(RULES) rows.
    return (
        voted.join(F.broadcast(posteriors(voted)), "pattern", "left")
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the features, ``base_failed``, ``posterior`` and ``kept`` for every row.

    A null or empty text has no words and fails the base rule.  ``n_repeat_words`` compares windows
    by a 64-bit hash.  Null ids and repeated rows
    are scored like any other row; an empty table gives no rows.  Equal texts always get
    the same verdict.
    """
    features = stored(
        pick(docs, id_col, text_col)
        .select(F.col(id_col).alias("doc_id"), measured(F.col(text_col)).alias("f"))
        .select("doc_id", "f.*"),
        "quality-features",
    )
    return judged(features).select(
        "doc_id", *FEATURES[:5], "base_failed", "kept", "posterior", "n_lines", "n_upper", "pattern"
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Features are taken twice, for the vote patterns and for the verdicts, so that no copy
    of the texts is written.
    """
    rows = with_row(docs, text_col).select(measured(F.col(text_col)).alias("f"), "row")
    return rows_of(judged(rows.select("f.*", "row")).where("kept"), docs)
