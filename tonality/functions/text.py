"""Text expressions: tokenising, normalising and verdict strings.

All are built-in column expressions, so they stay inside whole-stage code
generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Token delimiters of the default tokenizer: space, tab, line feed, carriage return, form feed.
TOKEN_DELIMITERS = r"[ \t\n\r\f]+"
# Characters the common preprocessor deletes from every token: digits and . : , " ' ( ) [ ] | / ? ! ;
STRIP_CHARACTERS = r"""[0-9.:,"'()\[\]|/?!;]+"""
# The same set as a plain character list, for ``translate`` (deletes without a regex).
STRIP_CHARS_PLAIN = "0123456789.:,\"'()[]|/?!;"
# Message shown when a text cannot be scored.
INVALID_INPUT = "Invalid input. Please try again."
# Class names by class index (0 = positive, 1 = negative).
LABEL_NAMES = ("positive", "negative")
# Verdict words, tie goes to Positive.
VERDICT_POSITIVE = "Positive"
VERDICT_NEGATIVE = "Negative"


def split_pieces(text: Column | str) -> Column:
    """Split on the tokenizer's white space (pieces may be empty at the ends)."""
    return F.split(F.col(text) if isinstance(text, str) else text, TOKEN_DELIMITERS)


def normalise(piece: Column | str) -> Column:
    """Delete digits and punctuation, then lower-case."""
    col = F.col(piece) if isinstance(piece, str) else piece
    return F.lower(F.translate(col, STRIP_CHARS_PLAIN, ""))


def normalised_pieces(text: Column | str) -> Column:
    """``normalise`` of every piece of ``split_pieces``, as one array: the whole text is
    normalised at once, which costs far less than a call a piece.  White space is made single
    spaces before anything is deleted, so pieces keep their number (some become empty)."""
    return F.split(normalised_text(text), " ")


def normalised_text(text: Column | str) -> Column:
    """The pieces of ``normalised_pieces``, parted by single spaces."""
    col = F.col(text) if isinstance(text, str) else text
    spaced = F.regexp_replace(col, TOKEN_DELIMITERS, " ")
    return F.lower(F.regexp_replace(spaced, STRIP_CHARACTERS, ""))


def token_array(text: Column | str) -> Column:
    """All normalised, non-empty tokens of a text, in order, as an array."""
    return F.filter(F.transform(split_pieces(text), normalise), lambda w: w != "")


def verdict(score_pos: Column, score_neg: Column) -> Column:
    """``Positive`` when p(positive) >= p(negative), else ``Negative``; null stays null."""
    return (F.when(score_pos.isNull() | score_neg.isNull(), F.lit(None).cast("string"))
            .when(score_pos >= score_neg, F.lit(VERDICT_POSITIVE))
            .otherwise(F.lit(VERDICT_NEGATIVE)))


def fixed6(x: Column) -> Column:
    """A probability printed with six decimals (rounded first, so engines agree)."""
    return F.format_string("%.6f", F.round(x, 6))


def verdict_text(score_pos: Column, score_neg: Column, result: Column | None = None) -> Column:
    """``Sentiment: X [p(positive)=a p(negative)=b]``, or the invalid-input message.

    ``result``: the verdict, where the scores given here are already rounded."""
    result = verdict(score_pos, score_neg) if result is None else result
    return F.when(score_pos.isNull() | score_neg.isNull(), F.lit(INVALID_INPUT)).otherwise(
        F.concat(F.lit("Sentiment: "), result,
                 F.lit(" [p(positive)="), fixed6(score_pos),
                 F.lit(" p(negative)="), fixed6(score_neg), F.lit("]")))


def echo_output(text: Column, result: Column) -> Column:
    """Input text followed by the result on a new line (a null text echoes as empty)."""
    return F.concat(F.coalesce(text, F.lit("")), F.lit("\n"), result)
