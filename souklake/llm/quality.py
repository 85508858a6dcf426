"""Quality rules whose cutoffs are chosen from labelled documents under exact binomial bounds.

Two fixed base rules reject texts that are too short or mostly repeated. Each further rule measures one share
of a text and comes with a fixed ladder of cutoffs. Per stratum (language), the rules spend the allowed risk
together, in their order. One in ``PILOT`` labelled good documents, picked by hash, and the bad ones choose;
the other good ones prove:

- Chosen is the strictest cutoff that pays: it rejects at least ``GAIN`` labelled bad documents for each good one,
  at the pilot's rate, and one at least. It must also be likely to be proven, as far as the pilot tells. Bad documents
  that earlier rules reject at their own cutoffs do not count, so no rule costs good documents for what another one finds.
- Proven is what the rules so far and the new one reject together: the exact one-sided (Clopper-Pearson) upper
  bound of the false rejection rate of their union lies below ``RISK``, at an error level corrected for all strata
  (Bonferroni). If the chosen cutoff cannot be proven, the strictest laxer one that can is used, and no later rule.

The proving documents see one sequence of unions, each containing the one before, that was fixed without them; it
ends where one is refused. So only the first union that breaks the limit can be accepted wrongly, and needs no
further correction: at most ``RISK`` of a stratum's good documents are rejected, with confidence ``CONFIDENCE`` for
all strata at once.

Without enough labels nothing can be proven, and only the base rules reject there.

Everything runs as DataFrame expressions: measures are computed per row, and only counts are shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import bind, store, whole, words_of

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words inside repeated three-word windows
SYMBOLS = "#*$%&|<>"

RISK = 0.02
CONFIDENCE = 0.95
GAIN = 4
PILOT = 5
# More strata than this are joined instead of broadcast.
BROADCAST_STRATA = 10_000
# Some 100 MB of ids in a task.
BROADCAST_LABELS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose ``measure`` lies beyond a cutoff; cutoffs go from strict to lax."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]
    above: bool = True

    def rejects(self, cutoff: Column | float) -> Column:
        measure = F.expr(self.measure)
        return measure > cutoff if self.above else measure < cutoff

    def rung(self) -> Column:
        """How many cutoffs reject a text; as the ladder goes from strict to lax, the first ones do."""
        ladder = F.array(*(F.lit(float(cutoff)) for cutoff in self.cutoffs))
        return F.size(F.filter(ladder, lambda cutoff: F.coalesce(self.rejects(cutoff), F.lit(False))))


RULES = (
    Rule("symbols", "try_divide(100 * n_symbols, n_words)", (1, 2, 5, 10, 20, 40, 80)),
    Rule("repeated_words", "try_divide(100 * n_repeat_words, n_words)", (5, 10, 15, 20, 25, 30, 35, 40, 45)),
    Rule("duplicate_lines", "try_divide(100 * n_dup_lines, n_lines)", (5, 10, 15, 20, 25, 30, 35, 40, 50)),
    Rule("non_letters", "try_divide(100 * n_other_chars, word_chars)", (5, 8, 10, 15, 20, 25, 30, 40, 60)),
)


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice, by sorting window hashes within the row."""
    n = F.size(words)
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
            ),
        )
    )

    def again(sorted_: Column) -> Column:
        return F.filter(
            sorted_,
            lambda w, k: (w["h"] == F.get(sorted_, k + 1)["h"])
            | F.when(k > 0, w["h"] == F.get(sorted_, k - 1)["h"]).otherwise(False),
        )

    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def cover(positions: Column) -> Column:
        return F.aggregate(
            positions,
            start,
            lambda s, p: F.struct(
                (p + 3).alias("upto"), (s["n"] + p + 3 - F.greatest(p, s["upto"])).alias("n")
            ),
            lambda s: s["n"],
        )

    found = bind(windows, again)
    return F.when(n < 4, 0).otherwise(cover(F.sort_array(F.transform(found, lambda w: w["i"]))))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the further counts that
    the rules use. A null text counts as empty. Repeated windows are found by 64-bit hashes."""
    body = whole(text)
    words = words_of(body)
    dense = F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        *docs.columns,
        bind(
            words,
            lambda w: F.struct(F.size(w).alias("n_words"), _repeated_words(w).alias("n_repeat_words")),
        ).alias("_words"),
        F.struct(
            F.char_length(dense).alias("word_chars"),
            F.char_length(F.regexp_replace(dense, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
            F.char_length(F.regexp_replace(dense, r"\p{L}+", "")).alias("n_other_chars"),
        ).alias("_chars"),
        bind(
            lines,
            lambda x: F.struct(
                F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
            ),
        ).alias("_lines"),
    )
    return counted.select(
        *docs.columns,
        F.col("_words.n_words").cast("long").alias("n_words"),
        F.col("_chars.word_chars").cast("long").alias("word_chars"),
        F.col("_chars.n_symbols").cast("long").alias("n_symbols"),
        F.col("_lines.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("_words.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("_lines.n_lines").cast("long").alias("n_lines"),
        F.col("_chars.n_other_chars").cast("long").alias("n_other_chars"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed downwards from k in a fold; k < n * p is where it matters.

    The exact upper confidence bound of a rate lies below p just when this is below the error level.
    """
    odds = math.log(p) - math.log1p(-p)
    ratio = (1 - p) / p

    def log_mass(kk: Column) -> Column:
        steps = F.when(kk > 0, F.sequence(F.lit(1).cast("long"), kk)).otherwise(F.array().cast("array<bigint>"))
        return F.aggregate(
            steps, n * math.log1p(-p), lambda s, j: s + F.log((n - j + 1) / j) + F.lit(odds)
        )

    def below(kk: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
        steps = F.when(kk > 0, F.sequence(kk, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        )

        def fold(s: Column, j: Column) -> Column:
            term = s["term"] * j / (n - j + 1) * F.lit(ratio)
            return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

        return F.aggregate(steps, start, fold, lambda s: F.log(s["sum"]))

    return F.when(n == 0, 1.0).when(k >= n * p, 1.0).otherwise(F.exp(log_mass(k) + below(k)))


def choose_cutoffs(
    measured: DataFrame, labels: DataFrame, doc_id: str, stratum: str, rules=RULES, risk=RISK, confidence=CONFIDENCE
) -> DataFrame:
    """One row per stratum: its number of labelled good documents, and the chosen cutoff of each rule or null."""
    marks = labels.groupBy(doc_id).agg(F.min("quality").alias("_quality"))
    holdout = measured.where(~base_failed()).join(marks, doc_id)
    rungs = [f"_rung_{rule.name}" for rule in rules]
    # All that the choice needs: how many documents of a stratum stand on which rungs of the ladders.
    cells = holdout.groupBy(
        F.col(stratum).alias("_stratum"),
        "_quality",
        (F.pmod(F.xxhash64(doc_id), F.lit(PILOT)) == 0).alias("_pilot"),
        *(rule.rung().alias(rung) for rule, rung in zip(rules, rungs)),
    ).agg(F.count(F.lit(1)).alias("_docs"))
    cells = store(cells, "quality-cells")
    good, bad, pilot = F.col("_quality") == 1, F.col("_quality") == 0, F.col("_pilot")

    def number(of: Column) -> Column:
        return F.sum(F.when(of, F.col("_docs")).otherwise(F.lit(0).cast("long")))

    strata = cells.groupBy("_stratum").agg(
        number(good).alias("n"), number(good & pilot).alias("_n_pilot"), F.lit(True).alias("_open")
    )
    strata = store(strata, "quality-strata")
    n_strata = strata.count()
    level = (1 - confidence) / max(1, n_strata)
    n_proof = F.col("n") - F.col("_n_pilot")

    def safe(wrong: Column) -> Column:
        return binomial_tail(wrong, n_proof, risk) <= level

    used = F.lit(False)
    for at, (rule, rung) in enumerate(zip(rules, rungs)):
        known = (F.broadcast(strata) if n_strata <= BROADCAST_STRATA else strata).withColumnRenamed("_stratum", "_own")
        rows = cells.join(known, F.col("_stratum").eqNullSafe(F.col("_own"))).drop("_own")
        # A row per cutoff, so that the plan holds each bound once and the driver never a whole ladder of them.
        steps = rows.withColumn("_claimed", used).withColumn(
            "_at", F.explode(F.sequence(F.lit(0), F.lit(len(rule.cutoffs) - 1)))
        )
        claimed, rejected = F.col("_claimed"), F.col(rung) > F.col("_at")
        counts = steps.groupBy(*strata.columns, "_at").agg(
            number(claimed & good & pilot).alias("_used"),
            number((claimed | rejected) & good & pilot).alias("_seen"),
            number((claimed | rejected) & good & ~pilot).alias("_proof"),
            number(rejected & bad & ~claimed).alias("_right"),
        )
        seen, right = F.col("_seen"), F.col("_right")
        pays = (right >= 1) & (right * F.col("_n_pilot") >= GAIN * (seen - F.col("_used")) * F.col("n"))
        expected = F.try_divide((seen + F.sqrt(seen)) * n_proof, F.col("_n_pilot"))
        likely = safe(F.coalesce(F.ceil(expected), F.lit(0)).cast("long"))
        tested = counts.select(
            *strata.columns, "_at", pays.alias("_pays"), likely.alias("_likely"), safe(F.col("_proof")).alias("_proven")
        )
        own = tested.groupBy(*strata.columns).agg(
            F.min(F.when(F.col("_open") & F.col("_pays") & F.col("_likely"), F.col("_at"))).alias("_wanted"),
            F.sort_array(F.collect_list(F.when(F.col("_pays") & F.col("_proven"), F.col("_at")))).alias("_usable"),
        )
        found = F.get(F.filter("_usable", lambda i: i >= F.col("_wanted")), F.lit(0))
        own = own.withColumn("_found", found)
        going = F.col("_open") & F.coalesce(F.col("_found") == F.col("_wanted"), F.col("_wanted").isNull())
        strata = own.select(
            "_stratum",
            "n",
            "_n_pilot",
            going.alias("_open"),
            *(earlier.name for earlier in rules[:at]),
            F.col("_found").alias(rule.name),
        )
        strata = store(strata, "quality-strata")
        used = used | F.coalesce(F.col(rung) > F.col(rule.name), F.lit(False))
    ladders = (F.array(*(F.lit(float(cutoff)) for cutoff in rule.cutoffs)) for rule in rules)
    chosen = (F.get(ladder, F.col(rule.name)).alias(rule.name) for ladder, rule in zip(ladders, rules))
    return strata.select("_stratum", "n", *chosen)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    rules=RULES,
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """doc_id, the measures, base_failed, kept and the names of the rules that reject, per row of ``docs``.

    ``labels`` has doc_id and quality (1: good); contradicting labels of a document count as not good, labels
    without a document as nothing. Null strata form a stratum. Repeated rows are judged alike; an empty
    table gives no rows, and without labels only the base rules reject.
    """
    measured = store(
        measure(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), text), text).drop(text),
        "quality-measures",
    )
    marks = labels.select(F.col(doc_id).alias("doc_id"), "quality")
    cutoffs = choose_cutoffs(measured, marks, "doc_id", "stratum", rules, risk, confidence).drop("n")
    cutoffs = store(cutoffs, "quality-cutoffs")
    if cutoffs.count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    judged = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    hits = F.array(*(F.when(rule.rejects(F.col(rule.name)), F.lit(rule.name)) for rule in rules))
    counted = judged.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(hits))
    return counted.select(
        *measured.columns,
        "base_failed",
        (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
        F.when(F.col("base_failed"), F.array().cast("array<string>"))
        .otherwise(F.col("rejected_by"))
        .alias("rejected_by"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", **settings
) -> DataFrame:
    """The rows of ``docs`` that are kept, with unchanged columns.

    The cutoffs are found as in ``judge``; the rows are then judged in a second pass over the texts, so no
    text is shuffled.
    """
    rules = settings.get("rules", RULES)
    marks = labels.select(F.col(doc_id).alias("doc_id"), "quality")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.col(text).alias("_text"))
    labelled = store(marks.select("doc_id").distinct(), "quality-labelled")
    # Only labelled documents choose cutoffs. Beyond the bound all are measured, as a join would shuffle texts.
    if labelled.count() <= BROADCAST_LABELS:
        rows = rows.join(F.broadcast(labelled), "doc_id", "left_semi")
    measured = store(measure(rows, "_text").drop("_text"), "quality-measures")
    cutoffs = store(choose_cutoffs(measured, marks, "doc_id", "stratum", **settings).drop("n"), "quality-cutoffs")
    if cutoffs.count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"), F.col(stratum).alias("_own"))
    again = measure(packed, "_text").join(cutoffs, F.col("_own").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(rule.rejects(F.col(rule.name)), F.lit(False))
    return again.where(~base_failed() & ~rejected).select("_row.*")
