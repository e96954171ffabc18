"""Token expressions (split / lower / filter run as JVM array functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stopword list of the newsgroup tokenizer.
STOPWORDS = (
    "the", "a", "an", "of", "or", "in", "for", "by", "on", "but", "is", "not", "with", "as", "was", "if",
    "they", "are", "this", "and", "it", "have", "from", "at", "my", "be", "that", "to",
)
# Shortest kept token and the count below which a token is rare.
MIN_TOKEN_LENGTH = 2
RARE_BELOW = 2
NO_DIGITS = r"^[^0-9]*$"


def non_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def whitespace_tokens(text: Column) -> Column:
    """Split on single spaces, lower-case, drop empty strings."""
    return non_empty(F.transform(F.split(text, " "), lambda t: F.lower(t)))


def nonword_tokens(text: Column) -> Column:
    """Split on runs of non-word characters, lower-case, drop empty strings."""
    return non_empty(F.split(F.lower(text), r"\W+"))


def normalised_tokens(text: Column) -> Column:
    """Non-word split, no digits, no stopwords, length >= 2 (rare pruning is a
    join on the corpus counts, see ``operators.textops.prune_rare``)."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(nonword_tokens(text),
                    lambda t: t.rlike(NO_DIGITS) & ~F.array_contains(stop, t)
                    & (F.length(t) >= MIN_TOKEN_LENGTH))


def topic_from_path(path: Column) -> Column:
    """Parent directory name of a file path."""
    return F.element_at(F.split(path, "/"), -2)


# Token-level predicates: used after ``explode`` so that the filters run as
# ordinary codegen'd expressions instead of lambdas inside array functions.
SPLITTERS = {"whitespace": " ", "nonword": r"\W+"}


def token_column(text: Column, kind: str) -> Column:
    """Array of raw tokens of a tokenizer (lower-cased; may hold empties)."""
    if kind == "whitespace":
        return F.split(F.lower(text), " ")
    return F.split(F.lower(text), r"\W+")


def keep_token(t: Column, kind: str) -> Column:
    """Row-level filter matching the array form of each tokenizer."""
    ok = t != ""
    if kind == "normalised":
        ok = ok & ~t.rlike("[0-9]") & ~t.isin(*STOPWORDS) & (F.length(t) >= MIN_TOKEN_LENGTH)
    return ok
