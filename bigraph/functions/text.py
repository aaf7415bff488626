"""Column expressions for text: normalising, tokenising, adjacent word pairs.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen next to the scan; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the tokeniser (they must stay as they are for the
# results to match): the apostrophe that is deleted, the class of characters
# that separate words, and the single space used to join and split.
APOSTROPHE = "'"
NON_WORD = "[^a-z]+"
SPACE = " "

# Lower-casing, restricted to what can survive the NON_WORD step: ASCII A-Z,
# and the only two other code points whose lower case holds an ASCII letter
# (U+212A KELVIN SIGN -> "k"; U+0130 -> "i" + U+0307 COMBINING DOT ABOVE).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u212a"
LOWER = "abcdefghijklmnopqrstuvwxyzk"
DOTTED_CAPITAL_I = "\u0130"
DOTTED_CAPITAL_I_LOWER = "i\u0307"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(text: Column | str) -> Column:
    """Lower-case, drop ASCII apostrophes, turn each run of non ``a-z`` into
    one space, trim spaces at both ends.  NULL stays NULL.

    ``don't`` becomes ``dont``; ``don’t`` (U+2019) becomes ``don t``; accented
    letters split words (``café`` -> ``caf``).

    Equal to Python's ``str.lower()`` followed by the two substitutions: a
    full Unicode lower-case is not needed, because every character outside
    ``a-z`` becomes a separator anyway; ``translate`` maps the few that lower
    into ``a-z`` and deletes the apostrophe in one pass (much cheaper than
    ``lower``).
    """
    c = F.replace(_col(text), F.lit(DOTTED_CAPITAL_I), F.lit(DOTTED_CAPITAL_I_LOWER))
    c = F.translate(c, UPPER + APOSTROPHE, LOWER)
    c = F.regexp_replace(c, NON_WORD, SPACE)
    return F.trim(c)


def tokenize(text: Column | str) -> Column:
    """Split a normalised text on single spaces.  An empty text gives one
    empty token (``[""]``), which starts no bigram."""
    return F.split(_col(text), SPACE)


def adjacent_pairs(tokens: Column | str) -> Column:
    """``ARRAY<STRUCT<word, next_word>>`` of the adjacent token pairs.

    The last token starts no pair, so fewer than two tokens give an empty
    array.  Built from two shifted slices zipped together (no lambda), so it
    stays inside generated code.
    """
    t = _col(tokens)
    n_pairs = F.greatest(F.size(t) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(t, 1, n_pairs).alias("word"),
        F.slice(t, 2, n_pairs).alias("next_word"),
    )


def bigram_key(word: Column | str, next_word: Column | str) -> Column:
    """Output key ``word-next``; reversible because words hold no ``-``."""
    return F.concat_ws("-", _col(word), _col(next_word))
