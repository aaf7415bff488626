"""Conditional bigram probabilities P(next_word | word), two ways.

Pairs way:   documents -> bigrams -> counts (word, next_word, n)
             -> totals per word -> n / total.
Stripes way: counts -> one map next_word -> n per word (cut into bounded
             parts for hot words) -> n / the word total the stripe carries.
Both give the same numbers.

Scale notes
-----------
* Counting is a partial + final hash aggregate: each task combines its own
  bigrams before the shuffle (the in-mapper combining of a MapReduce job is
  built in).  The shuffle key is ``(word, next_word)``, so a hot first word is
  spread over all reducers.
* Totals per word are a second partial aggregate over the counts (one row per
  word leaves each task); the same aggregate counts each word's followers.
  Rows meet them in an equi-join on ``word`` that hot words cannot overload
  (:func:`bigraph.functions.with_group_totals`).
* The corpus is tokenised and its counts are shuffled once per query: both
  sides of that join read one exchange.  Spark takes an exchange twice only if
  the plans below are equal, so ``bigram_counts`` says itself that its keys are
  not NULL (else the join would say so below one of its sides).
* A stripe is a collected group.  Words with more than ``max_entries``
  followers are cut into ``ceil(n_next / max_entries)`` parts by a hash of the
  follower, and the shuffle goes on ``(word, part)``, so no task holds more
  than about ``max_entries`` entries of one word.
* Top-k per word: every task keeps its own best ``k`` of a word before the one
  shuffle on ``word``.  From counts, only the survivors meet the word totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bigraph.functions import (
    DEFAULT_MAX_ENTRIES,
    adjacent_pairs,
    bigram_key,
    n_parts,
    normalize_text,
    part_of,
    tokenize,
    with_group_totals,
)
from bigraph.functions.collect import MAX_HOT_KEYS


def normalized_documents(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``normalized``."""
    return docs.select(*keep, normalize_text(text).alias("normalized"))


def document_tokens(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per token: ``keep`` columns, ``pos`` (0-based), ``token``."""
    return docs.select(*keep, F.posexplode(tokenize(normalize_text(text))).alias("pos", "token"))


def bigrams(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per adjacent word pair of each document: ``keep``, ``word``,
    ``next_word`` (P3).  Documents with fewer than two tokens give none.

    Tokens are projected first so the regular expressions run once per
    document, not once per use inside the generator.
    """
    tokens = docs.select(*keep, tokenize(normalize_text(text)).alias("_tokens"))
    return tokens.select(*keep, F.inline(adjacent_pairs("_tokens")))


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """``word, next_word, n``: occurrences of each bigram (A1).  A pair with a
    NULL word (:func:`bigrams` gives none) is no bigram."""
    pairs = pairs.where(F.col("word").isNotNull() & F.col("next_word").isNotNull())
    return pairs.groupBy("word", "next_word").agg(F.count(F.lit(1)).alias("n"))


def word_totals(counts: DataFrame) -> DataFrame:
    """``word, total``: bigrams that start with ``word`` (A2, the marginal)."""
    return counts.groupBy("word").agg(F.sum("n").alias("total"))


def _word_sizes(counts: DataFrame) -> DataFrame:
    """``word, total, n_next``: occurrences and followers of every word."""
    sizes = counts.groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_next"))
    # Always true; it keeps both columns in every use of the table, so that
    # all uses share one exchange.
    return sizes.where(F.col("n_next") > 0)


def bigram_probabilities(counts: DataFrame, max_entries: int = DEFAULT_MAX_ENTRIES,
                         max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``word, next_word, probability`` from pair counts (A4, J5).  Words with
    more than ``max_entries`` followers are spread over the tasks of the join
    (``max_keys`` of them; the others have few rows)."""
    sized = with_group_totals(counts, _word_sizes(counts), "word", "next_word", "n_next", max_entries, max_keys)
    return sized.select("word", "next_word", (F.col("n") / F.col("total")).alias("probability"))


def stripes(counts: DataFrame, max_entries: int = DEFAULT_MAX_ENTRIES, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``word, part, parts, total, stripe MAP<next_word, n>`` (A3).

    Words with at most ``max_entries`` followers have one stripe (part 0 of 1)
    and ``total`` is the sum of its values.  Every other word has ``parts``
    stripes that together hold all its followers, each with the word's total
    over all parts; only these words are looked up, a table of at most
    ``rows / max_entries`` words.  The result does not depend on ``max_keys``,
    which bounds a broadcast.
    """
    long = _word_sizes(counts).where(F.col("n_next") > max_entries)
    part = F.when(F.col("parts") > 1, part_of(F.col("next_word"), F.col("parts"))).otherwise(F.lit(0))
    tagged = (with_group_totals(counts, long, "word", "next_word", "n_next", max_entries, max_keys)
              .withColumn("parts", n_parts(F.col("n_next"), max_entries))    # 1 for words that are not long
              .select("word", "next_word", "n", part.alias("part"), "parts", "total"))
    collected = (tagged.groupBy("word", "part", "parts", "total")
                 .agg(F.map_from_entries(F.collect_list(F.struct("next_word", "n"))).alias("stripe"),
                      F.sum("n").alias("_n")))
    return collected.select("word", "part", "parts", F.coalesce("total", "_n").alias("total"), "stripe")


def bigram_probabilities_from_stripes(stripe_df: DataFrame) -> DataFrame:
    """``word, next_word, probability`` from stripes (A5): each entry over the
    word total carried by its stripe row.  No shuffle."""
    return (stripe_df.select("word", "total", F.explode("stripe").alias("next_word", "n"))
            .select("word", "next_word", (F.col("n") / F.col("total")).alias("probability")))


def keyed_probabilities(probs: DataFrame) -> DataFrame:
    """``bigram = 'word-next'``, ``probability``: the reference's output view."""
    return probs.select(bigram_key("word", "next_word").alias("bigram"), "probability")


def sort_probabilities(probs: DataFrame) -> DataFrame:
    """Total order by word, then probability ascending, then next word."""
    return probs.orderBy("word", "probability", "next_word")


def next_words(probs: DataFrame, word: str) -> DataFrame:
    """Followers of one word, most likely first."""
    return (probs.where(F.col("word") == F.lit(word))
            .orderBy(F.desc("probability"), F.asc("next_word")))


def _top_k_per_word(df: DataFrame, k: int, order: list) -> DataFrame:
    """Rows with ``rank`` 1..k per ``word`` under ``order``.  Spark limits each
    group inside every task before the shuffle on ``word``, so at most ``k``
    rows per word and task move."""
    return (df.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(*order)))
            .where(F.col("rank") <= k))


def top_next_words(probs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most likely followers of every word, with ``rank`` 1..k.

    Ties are broken by ``next_word``.
    """
    return _top_k_per_word(probs, k, [F.desc("probability"), F.asc("next_word")])


def top_next_words_from_counts(counts: DataFrame, k: int) -> DataFrame:
    """Same result as ``top_next_words(bigram_probabilities(counts), k)``.

    Within a word the probability order is the count order (one positive
    total divides every count of the word, and different counts give
    different quotients), so the ranking runs on the counts and only the at
    most ``k`` survivors per word are joined with the word totals.  The full
    table of counts is never joined with the totals.
    """
    best = _top_k_per_word(counts, k, [F.desc("n"), F.asc("next_word")])
    totals = word_totals(counts)
    return (best.join(totals, "word")
            .select("word", "next_word", (F.col("n") / F.col("total")).alias("probability"), "rank"))
