"""The 21 structural features of a mail, all taken from its raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailshape.functions import text as T

# Fixed names in fixed order: the order is that of the assembled feature vector.
STRUCTURAL_COLUMNS = [
    "url_count", "url_density", "exclamation_count", "question_count", "uppercase_ratio",
    "digit_ratio", "punctuation_ratio", "all_caps_word_ratio", "html_marker_count",
    "subject_char_count", "body_char_count", "sender_char_count", "subject_word_count",
    "body_word_count", "text_word_count", "sender_word_count", "sender_has_email",
    "sender_has_domain", "sender_digit_ratio", "sender_uppercase_ratio",
    "sender_punctuation_ratio",
]


def with_structural_features(df: DataFrame, subject: str = "raw_subject", body: str = "raw_body",
                             sender: str = "raw_sender") -> DataFrame:
    """Append the 21 features as ``double`` columns. No null may be left in the three text columns.

    Two projections: the first names the joined text and the counts used more than once, the second
    derives the features, so that no regex is evaluated twice for one mail.
    """
    subject_col, body_col, sender_col = F.col(subject), F.col(body), F.col(sender)
    joined = df.withColumns({
        "_joined": T.blanked(F.concat(subject_col, F.lit(" "), body_col)),
        "_subject_tokens": T.token_count(subject_col),
        "_body_tokens": T.token_count(body_col),
    })
    whole = F.col("_joined")
    counted = joined.withColumns({
        "_length": F.length(whole),
        "_tokens": F.col("_subject_tokens") + F.col("_body_tokens"),
        "_letters": T.letter_count(whole),
        "_urls": T.occurrences_of_url(whole),
        "_lower_body": F.lower(body_col),
        "_sender_length": F.length(sender_col),
        "_sender_letters": T.letter_count(sender_col),
    })
    length, tokens, sender_length = F.col("_length"), F.col("_tokens"), F.col("_sender_length")
    markers = [T.occurrences(F.col("_lower_body"), marker) for marker in T.HTML_MARKERS]
    features = {
        "url_count": F.col("_urls"),
        "url_density": T.safe_ratio(F.col("_urls"), tokens),
        "exclamation_count": T.occurrences(whole, "!"),
        "question_count": T.occurrences(whole, "?"),
        "uppercase_ratio": T.safe_ratio(T.upper_letter_count(whole), F.col("_letters")),
        "digit_ratio": T.safe_ratio(T.digit_count(whole), length),
        "punctuation_ratio": T.safe_ratio(T.punctuation_count(whole), length),
        "all_caps_word_ratio": T.safe_ratio(T.caps_word_count(whole), tokens),
        "html_marker_count": markers[0] + markers[1],
        "subject_char_count": F.length(subject_col),
        "body_char_count": F.length(body_col),
        "sender_char_count": sender_length,
        "subject_word_count": F.col("_subject_tokens"),
        "body_word_count": F.col("_body_tokens"),
        "text_word_count": tokens,
        "sender_word_count": T.token_count(sender_col),
        "sender_has_email": sender_col.rlike(T.EMAIL_PATTERN),
        "sender_has_domain": F.contains(sender_col, F.lit("@")),
        "sender_digit_ratio": T.safe_ratio(T.digit_count(sender_col), sender_length),
        "sender_uppercase_ratio": T.safe_ratio(
            T.upper_letter_count(sender_col), F.col("_sender_letters")),
        "sender_punctuation_ratio": T.safe_ratio(T.punctuation_count(sender_col), sender_length),
    }
    return counted.select(
        *df.columns, *[features[name].cast("double").alias(name) for name in STRUCTURAL_COLUMNS]
    )
