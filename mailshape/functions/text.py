"""Cleaning, tokens and counting on text columns (native expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailshape.functions.chars import (
    DIGIT_LIKE_CHARACTERS, PUNCTUATION, WHITE, WHITE_CHARACTERS,
)

# Fixed patterns of the cleaning step, applied in this order. A class of ranges is many times slower
# in Java's regex engine than a named or spelled-out one; without further flags ``Alnum`` is ASCII.
TAG_PATTERN = r"<[^>]+>"
CLEAN_URL_PATTERN = rf"http[^{WHITE}]+|www\.[^{WHITE}]+"
DROPPED_PATTERN = r"[^\p{Alnum}!?.,]+"

# Fixed pattern of the URL feature. It ignores case and wants "://", unlike the cleaning step.
FEATURE_URL_PATTERN = rf"(?i)https?://[^{WHITE}]+|www\.[^{WHITE}]+"

# A run of word characters is cut to one at both ends: for "is there a match" this is the same
# test, and it keeps the regex engine from backtracking over long runs.
EMAIL_PATTERN = r"[\p{L}\p{N}_.-]@[\p{L}\p{N}_.-]+[.][\p{L}\p{N}_]"

# In blanked text: a token of two or more characters with an upper-case and no lower- or title-case one.
CAPS_TOKEN_PATTERN = (
    r"(?<![^ ])(?=[^ ]*?\p{IsUppercase})[^ a-z\p{IsLowercase}\p{Lt}]{2,}+(?![^ ])"
)

HTML_MARKERS = ("content type text html", "text/html")


def blanked(text: Column) -> Column:
    """Every white-space character as a plain blank, one for one, and none at the ends.

    Counts of tokens and of anything but white space are the same on this form, and the cheap native
    ``trim`` and single-character patterns suffice for it.
    """
    return F.trim(F.translate(text, WHITE_CHARACTERS, " " * len(WHITE_CHARACTERS)))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return blanked(F.coalesce(text, F.lit(""))) == ""


def blanked_token_count(text: Column) -> Column:
    """Number of tokens of text in the form of :func:`blanked`."""
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " +")))


def token_count(text: Column) -> Column:
    """Number of white-space separated tokens."""
    return blanked_token_count(blanked(text))


def without_tags(text: Column) -> Column:
    """Every tag as a blank.

    No tag reaches past the last ">", so what follows it is set aside: otherwise each "<" there would
    send the regex to the end of the text and back, which takes quadratic time on hostile mails.
    """
    rest = F.substring_index(text, ">", -1)
    tagged = F.left(text, F.length(text) - F.length(rest))
    return F.concat(F.regexp_replace(tagged, TAG_PATTERN, " "), rest)


def clean_characters(text: Column) -> Column:
    """Tags, then URLs, then all characters outside the kept set; collapsed, trimmed, lower-cased.

    Tags go first, so a URL inside an attribute disappears with its tag. Blanking characters and
    collapsing blanks are one replacement of whole runs. The result is ASCII with single blanks.
    """
    marked = F.regexp_replace(
        without_tags(F.coalesce(text, F.lit(""))), CLEAN_URL_PATTERN, " URL ")
    return F.lower(F.trim(F.regexp_replace(marked, DROPPED_PATTERN, " ")))


def cleaned_tokens(cleaned: Column) -> Column:
    """Token array of text in the single-blank form left by :func:`clean_characters`."""
    return F.filter(F.split(cleaned, " "), lambda token: token != "")


def cleaned_token_count(cleaned: Column) -> Column:
    """Token count of text in single-blank form: one more than its blanks, without a regex."""
    blanks = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", 0).otherwise(blanks + 1)


def joined_text(subject: Column, body: Column) -> Column:
    """Subject and body of a cleaned mail as one text."""
    return F.trim(F.concat_ws(" ", subject, body))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0.0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def occurrences(text: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal string."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))
    return (removed / F.lit(len(literal))).cast("int")


def occurrences_of_url(text: Column) -> Column:
    return F.regexp_count(text, F.lit(FEATURE_URL_PATTERN))


def characters_in(text: Column, char_class: str) -> Column:
    """Number of characters of a regex class: what is left once all other runs are removed."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", ""))


def letter_count(text: Column) -> Column:
    return characters_in(text, r"\p{L}")


def upper_letter_count(text: Column) -> Column:
    return characters_in(text, r"\p{Lu}")


def removed_by(text: Column, characters: str) -> Column:
    """Number of characters of ``text`` that are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def digit_count(text: Column) -> Column:
    return characters_in(text, r"\p{Nd}") + removed_by(text, DIGIT_LIKE_CHARACTERS)


def punctuation_count(text: Column) -> Column:
    return removed_by(text, PUNCTUATION)


def caps_word_count(text: Column) -> Column:
    """Of blanked text: tokens longer than one character that are upper-case throughout (``A1!`` is, ``123`` is not)."""
    return F.regexp_count(text, F.lit(CAPS_TOKEN_PATTERN))
