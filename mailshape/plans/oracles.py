"""SQL (DuckDB dialect) that computes the registered queries independently of Spark.

Written against the raw tables, without using any Spark code; only fixed word lists, character
classes and the query parameters are shared.
"""

from __future__ import annotations

from mailshape.functions.chars import DIGIT_LIKE_RANGES, PUNCTUATION, WHITE
from mailshape.functions.structural import STRUCTURAL_COLUMNS
from mailshape.operators.lemma import NOUN_RULES
from mailshape.operators.profile import COMMON_WORDS

LEXICON_MAILS = 3
DIGIT = r"\p{Nd}" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in DIGIT_LIKE_RANGES)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def matches(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, {text(pattern)}))"


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^[{WHITE}]+|[{WHITE}]+$', '', 'g')"


def clean(column: str) -> str:
    steps = f"coalesce({column}, '')"
    for pattern, new in (
        ("<[^>]+>", " "), (rf"http[^{WHITE}]+|www\.[^{WHITE}]+", " URL "),
        (f"[^a-zA-Z0-9{WHITE}!?.,]", " "), (f"[{WHITE}]+", " "),
    ):
        steps = f"regexp_replace({steps}, {text(pattern)}, '{new}', 'g')"
    return f"lower(trim({steps}))"


def ratio(numerator: str, denominator: str) -> str:
    return (f"CASE WHEN ({denominator}) = 0 THEN 0.0::DOUBLE "
            f"ELSE ({numerator})::DOUBLE / ({denominator})::DOUBLE END")


def word_list(words: list[str]) -> str:
    return "(" + ", ".join(text(w) for w in words) + ")"


# -- inputs as common table expressions -----------------------------------------------------------

MAIL = """mail AS (
    SELECT doc_id AS mail_id, split_part(text, chr(10), 1) AS subject, source AS sender,
           substr(text, length(split_part(text, chr(10), 1)) + 2) AS body, lang,
           (doc_id % 2)::INT AS parity
    FROM documents)"""

LABELLED = MAIL + """, labelled AS (
    SELECT mail.*, (1 - quality)::INT AS label FROM mail JOIN labels ON labels.doc_id = mail.mail_id)"""

CLEANED = MAIL + f""", cleaned AS (
    SELECT mail_id, parity AS label, subject AS raw_subject, sender AS raw_sender,
           {clean('subject')} AS subject, {clean('body')} AS body, {clean('sender')} AS sender
    FROM mail), prepared AS (
    SELECT *, trim(subject || ' ' || body) AS text FROM cleaned)"""

LABELLED_TEXT = LABELLED + f""", prepared AS (
    SELECT *, trim({clean('subject')} || ' ' || {clean('body')}) AS text FROM labelled)"""

BODY_ONLY = MAIL + f""", body_only AS (
    SELECT mail_id, parity AS label, {clean('body')} AS text FROM mail)"""

LENGTHS = CLEANED + """, lengths AS (
    SELECT label, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS word_count
    FROM prepared)"""


def features(relation: str, keys: str) -> str:
    """CTEs ``counted`` and ``featured`` over a relation with keys and subject, sender, body."""
    white = f"[^{WHITE}]+"
    in_class = "[" + "".join("\\" + c for c in PUNCTUATION) + "]"
    caps = (f"len(list_filter(regexp_extract_all(c, {text(white)}), lambda t: length(t) > 1 "
            "AND regexp_matches(t, '\\p{Lu}') AND NOT regexp_matches(t, '[\\p{Ll}\\p{Lt}ªº]')))")
    columns = {
        "url_count": "urls",
        "url_density": ratio("urls", "tokens"),
        "exclamation_count": matches("c", "!"),
        "question_count": matches("c", "[?]"),
        "uppercase_ratio": ratio(matches("c", r"\p{Lu}"), matches("c", r"\p{L}")),
        "digit_ratio": ratio(matches("c", f"[{DIGIT}]"), "length(c)"),
        "punctuation_ratio": ratio(matches("c", in_class), "length(c)"),
        "all_caps_word_ratio": ratio(caps, "tokens"),
        "html_marker_count": matches("lower(body)", "content type text html") + " + "
        + matches("lower(body)", "text/html"),
        "subject_char_count": "length(subject)",
        "body_char_count": "length(body)",
        "sender_char_count": "length(sender)",
        "subject_word_count": matches("subject", white),
        "body_word_count": matches("body", white),
        "text_word_count": "tokens",
        "sender_word_count": matches("sender", white),
        "sender_has_email": r"regexp_matches(sender, '[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+[.][\p{L}\p{N}_]+')",
        "sender_has_domain": "contains(sender, '@')",
        "sender_digit_ratio": ratio(matches("sender", f"[{DIGIT}]"), "length(sender)"),
        "sender_uppercase_ratio": ratio(matches("sender", r"\p{Lu}"), matches("sender", r"\p{L}")),
        "sender_punctuation_ratio": ratio(matches("sender", in_class), "length(sender)"),
    }
    url = rf"(?i)https?://[^{WHITE}]+|www\.[^{WHITE}]+"
    listed = ",\n           ".join(f"({columns[c]})::DOUBLE AS {c}" for c in STRUCTURAL_COLUMNS)
    joined = strip("subject || ' ' || body")
    return f"""counted AS (
    SELECT *, {matches('c', url)} AS urls, {matches('c', white)} AS tokens
    FROM (SELECT *, {joined} AS c FROM {relation})), featured AS (
    SELECT {keys}, {listed} FROM counted)"""


def rounded_features(keys: str) -> str:
    return f"SELECT {keys}, " + ", ".join(f"round({c}, 6) AS {c}" for c in STRUCTURAL_COLUMNS)


def lemma_tables() -> str:
    rules = ", ".join(f"({i + 1}, '{end}', '{new}')" for i, (end, new) in enumerate(NOUN_RULES))
    return f"""tokens AS (
    SELECT mail_id, field, unnest(string_split(value, ' ')) AS word,
           generate_subscripts(string_split(value, ' '), 1) AS pos
    FROM (SELECT mail_id, unnest(['subject', 'body', 'sender']) AS field,
                 unnest([subject, body, sender]) AS value FROM cleaned)),
lexicon AS (
    SELECT word FROM tokens WHERE word <> '' GROUP BY word
    HAVING count(DISTINCT mail_id) >= {LEXICON_MAILS}),
rules AS (SELECT * FROM (VALUES {rules}) AS r(nr, ending, new)),
forms AS (
    SELECT DISTINCT word, 0 AS round, 0 AS nr, word AS form FROM tokens WHERE word <> ''
    UNION ALL
    SELECT f.word, f.round + 1, r.nr, left(f.form, length(f.form) - length(r.ending)) || r.new
    FROM forms f JOIN rules r ON suffix(f.form, r.ending)),
lemmas AS (
    SELECT word, form AS lemma FROM (
        SELECT *, row_number() OVER (
            PARTITION BY word ORDER BY greatest(round, 1), length(form), nr) AS best
        FROM forms WHERE form IN (SELECT word FROM lexicon))
    WHERE best = 1 AND form <> word)"""


def scored() -> str:
    return f"""WITH {LABELLED}, {features('labelled', 'mail_id, label')}, scored AS (
    SELECT mail_id, label, score, CASE WHEN score > 0 THEN 1 ELSE 0 END AS prediction FROM (
        SELECT *, round(exclamation_count * 0.25::DOUBLE + uppercase_ratio * 3
                        - text_word_count / 400 + punctuation_ratio * 10, 6) AS score
        FROM featured)), cells AS (
    SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn,
           count(*) FILTER (label = 0 AND prediction = 1) AS fp,
           count(*) FILTER (label = 1 AND prediction = 0) AS fn,
           count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM scored), rates AS (
    SELECT *, {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
           {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0 FROM cells), f AS (
    SELECT *, {ratio('2 * p1 * r1', 'p1 + r1')} AS f1, {ratio('2 * p0 * r0', 'p0 + r0')} AS f0
    FROM rates), curve AS (
    SELECT score, hits, sum(hits) OVER (ORDER BY score DESC) AS tp,
           sum(n) OVER (ORDER BY score DESC) AS retrieved, sum(hits) OVER () AS positives
    FROM (SELECT score, sum(label) AS hits, count(*) AS n FROM scored GROUP BY score))
"""


def terms(high: int) -> str:
    """Word tokens without common words, then n-grams up to ``high``, as ``(mail_id, term)``."""
    grams = "SELECT mail_id, unnest(words) AS term FROM words"
    if high > 1:
        grams += (
            " UNION ALL SELECT mail_id, words[i] || ' ' || words[i + 1] FROM ("
            "SELECT mail_id, words, unnest(range(1, len(words))) AS i FROM words)")
    return f"""words AS (
    SELECT mail_id, list_filter(regexp_extract_all(text, '[a-z0-9]{{2,}}'),
                                lambda w: w NOT IN {word_list(COMMON_WORDS)}) AS words
    FROM prepared), terms AS ({grams}), vocabulary AS (
    SELECT row_number() OVER (ORDER BY count(*) DESC, term) AS rank, term, count(*) AS n
    FROM terms GROUP BY term ORDER BY rank LIMIT 5000)"""


def cleaning_columns(relation: str, dataset: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, count(*) AS initial_rows,
        count(*) FILTER (trim(coalesce(text, '')) = '') AS dropped_empty,
        (SELECT count(*) - count(DISTINCT (text, label)) FROM {relation} WHERE trim(text) <> '')
            AS removed_duplicates,
        (SELECT count(*) FROM (SELECT text FROM {relation} WHERE trim(text) <> '' GROUP BY text
            HAVING count(DISTINCT label) > 1)) AS conflicting_groups,
        (SELECT count(DISTINCT (text, label)) FROM {relation} WHERE trim(text) <> '') AS remaining
        FROM {relation}"""


def diversity_columns(relation: str, dataset: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, label, count(*) AS total_rows,
        count(DISTINCT text) AS unique_texts,
        round(count(DISTINCT text)::DOUBLE / count(*), 6) AS unique_ratio
        FROM {relation} GROUP BY label"""


_first_copy = """SELECT mail_id, label, text FROM (
    SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY mail_id) AS copy FROM {relation}
    WHERE trim(text) <> '') WHERE copy = 1"""

_PAGES = "page_mail AS (SELECT page_id AS mail_id, url AS subject, '' AS sender, html AS body FROM pages)"
_TALK = """talk AS (
    SELECT conv_id, turn, '' AS subject, text AS body, role || '@' || conv_id || '.Example.org' AS sender
    FROM conversations)"""
_SPLIT = """, train AS (SELECT * FROM prepared WHERE lang = 'en'),
    test AS (SELECT * FROM prepared WHERE lang <> 'en')"""
_scaled = ", ".join(
    f"round((f.{c} - s.m_{c}) / CASE WHEN s.d_{c} = 0 THEN 1 ELSE s.d_{c} END, 6) AS {c}_scaled"
    for c in STRUCTURAL_COLUMNS)
_moments = ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in STRUCTURAL_COLUMNS)

ORACLES: dict[str, str] = {
    "enron_mapping": f"""WITH {MAIL}
SELECT mail_id, subject, '' AS sender, body,
       CASE WHEN toxic = 1 THEN -1 WHEN quality = 0 THEN 1 ELSE 0 END::INT AS label
FROM mail JOIN labels ON doc_id = mail_id""",
    "trec_mapping": f"""WITH {LABELLED}
SELECT mail_id, subject, CASE WHEN sender = 'src1' THEN '' ELSE sender END AS sender, body, label
FROM labelled""",
    "clean_text_pages": f"""WITH {_PAGES}, cleaned AS (
    SELECT mail_id, {clean('subject')} AS subject, {clean('body')} AS body FROM page_mail)
SELECT *, CASE WHEN body = '' THEN 0 ELSE len(string_split(body, ' ')) END::INT AS n_tokens FROM cleaned""",
    "clean_text_documents": f"""WITH {CLEANED}
SELECT mail_id, subject, body, sender, text,
       CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END::INT AS n_tokens FROM prepared""",
    "lemmatize_terms": f"WITH RECURSIVE {CLEANED}, {lemma_tables()} SELECT word, lemma FROM lemmas",
    "preprocess_text": f"""WITH RECURSIVE {CLEANED}, {lemma_tables()}, joined AS (
    SELECT mail_id, field, string_agg(coalesce(lemma, word), ' ' ORDER BY pos) AS value
    FROM tokens LEFT JOIN lemmas USING (word) GROUP BY mail_id, field), wide AS (
    SELECT mail_id, max(value) FILTER (field = 'subject') AS subject,
           max(value) FILTER (field = 'body') AS body, max(value) FILTER (field = 'sender') AS sender
    FROM joined GROUP BY mail_id)
SELECT mail_id, raw_subject, raw_sender, wide.subject, wide.body, wide.sender,
       trim(wide.subject || ' ' || wide.body) AS text
FROM wide JOIN cleaned USING (mail_id)""",
    "structural_features_pages":
        f"WITH {_PAGES}, {features('page_mail', 'mail_id')} {rounded_features('mail_id')} FROM featured",
    "structural_features_mail":
        f"WITH {MAIL}, {features('mail', 'mail_id')} {rounded_features('mail_id')} FROM featured",
    "sender_features_conversations":
        f"WITH {_TALK}, {features('talk', 'conv_id, turn')} "
        f"{rounded_features('conv_id, turn')} FROM featured",
    "drop_empty": f"WITH {BODY_ONLY} SELECT mail_id, label, text FROM body_only WHERE trim(text) <> ''",
    "conflicting_labels": f"""WITH {CLEANED}
SELECT min(mail_id) AS first_mail_id, count(*) AS n_rows, min(label) AS min_label, max(label) AS max_label
FROM prepared WHERE text <> '' GROUP BY text HAVING count(DISTINCT label) > 1""",
    "dedupe_first": f"WITH {CLEANED} " + _first_copy.format(relation="prepared"),
    "cleaning_summary": f"WITH {BODY_ONLY} {cleaning_columns('body_only', 'All')}",
    "label_diversity": f"WITH {CLEANED} {diversity_columns('prepared', 'All')}",
    "prepare_datasets": f"""WITH {LABELLED_TEXT}{_SPLIT},
train_clean AS ({_first_copy.format(relation='train')}), test_clean AS ({_first_copy.format(relation='test')})
SELECT * FROM ({cleaning_columns('train', 'Train')} UNION ALL {cleaning_columns('test', 'Test')})
JOIN ({diversity_columns('train_clean', 'Train')} UNION ALL {diversity_columns('test_clean', 'Test')})
USING (dataset)""",
    "corpus_union": f"""WITH {LABELLED}
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS corpus, mail_id, subject, sender, body, label
FROM labelled""",
    "sample_counts": f"""WITH {LABELLED}
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS corpus, count(*) AS n_rows,
       sum(label)::BIGINT AS n_spam FROM labelled GROUP BY 1""",
    "class_distribution": f"""WITH {LABELLED}
SELECT label, count(*) AS n_rows, CASE label WHEN 0 THEN 'Ham' ELSE 'Spam' END AS class_name
FROM labelled GROUP BY label""",
    "length_histogram": f"""WITH {LENGTHS}, range_of AS (
    SELECT min(word_count)::DOUBLE AS lo, (max(word_count) - min(word_count))::DOUBLE / 50 AS width
    FROM lengths), bins AS (
    SELECT label, bin::INT AS bin, lo + bin * width AS a, lo + (bin + 1) * width AS b
    FROM (SELECT DISTINCT label FROM lengths), range(50) AS t(bin), range_of)
SELECT bins.label, bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end, count(word_count) AS n_rows
FROM bins LEFT JOIN lengths ON lengths.label = bins.label AND word_count >= a
     AND (word_count < b OR bin = 49)
GROUP BY ALL""",
    "length_density": f"""WITH {LENGTHS}, range_of AS (
    SELECT min(word_count) AS lo, max(word_count) AS hi FROM lengths), classes AS (
    SELECT label, count(*) AS n, stddev_samp(word_count) * pow(count(*), -0.2) AS h
    FROM lengths GROUP BY label), grid AS (
    SELECT point::INT AS point, lo + point * ((hi - lo)::DOUBLE / 199) AS x, (hi - lo)::DOUBLE / 50 AS width
    FROM range(200) AS t(point), range_of), sums AS (
    SELECT label, point, any_value(x) AS x, any_value(width) AS width, any_value(n) AS n,
           sum(exp(-0.5::DOUBLE * pow((x - word_count) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))
               AS density
    FROM lengths JOIN classes USING (label), grid GROUP BY label, point)
SELECT label, point, round(x, 6) AS word_count, round(density, 6) AS density,
       round(density * n * width, 6) AS scaled FROM sums""",
    "length_p95": f"WITH {LENGTHS} SELECT round(quantile_cont(word_count, 0.95), 6) AS quantile FROM lengths",
    "top_terms": f"""WITH {LABELLED_TEXT}, firsts AS ({_first_copy.format(relation='prepared')}), counts AS (
    SELECT label, term, count(*) AS n
    FROM (SELECT label, unnest(string_split(text, ' ')) AS term FROM firsts)
    WHERE length(term) > 2 AND term NOT IN {word_list(COMMON_WORDS)} GROUP BY label, term)
SELECT label, CASE label WHEN 0 THEN 'Ham' ELSE 'Spam' END AS class_name, rank::INT AS rank, term, n FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, term) AS rank FROM counts)
WHERE rank <= 20""",
    "vocab_unigram": f"WITH {CLEANED}, {terms(1)} SELECT rank::INT AS rank, term, n FROM vocabulary",
    "vocab_bigram": f"WITH {CLEANED}, {terms(2)} SELECT rank::INT AS rank, term, n FROM vocabulary",
    "count_matrix": f"""WITH {CLEANED}, {terms(1)}
SELECT mail_id, term, count(*)::DOUBLE AS value FROM terms WHERE term IN (SELECT term FROM vocabulary)
GROUP BY mail_id, term""",
    "tfidf_matrix": f"""WITH {CLEANED}, {terms(2)}, cells AS (
    SELECT mail_id, term, count(*) AS n FROM terms WHERE term IN (SELECT term FROM vocabulary)
    GROUP BY mail_id, term), idf AS (
    SELECT term, ln((1 + (SELECT count(*) FROM prepared))::DOUBLE / (1 + count(*))) + 1 AS idf
    FROM cells GROUP BY term), weighted AS (
    SELECT mail_id, term, n * idf AS w FROM cells JOIN idf USING (term))
SELECT mail_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY mail_id)), 6) AS value FROM weighted""",
    "scaled_features": f"""WITH {LABELLED}, {features('labelled', 'mail_id, lang')}, moments AS (
    SELECT {_moments} FROM featured WHERE lang = 'en')
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS corpus, mail_id, {_scaled}
FROM featured f, moments s""",
    "doc_centroid": f"""WITH {CLEANED}, {terms(1)}, hits AS (
    SELECT mail_id, word, count(*) AS n
    FROM (SELECT mail_id, unnest(string_split(text, ' ')) AS word FROM prepared) GROUP BY mail_id, word),
vectors AS (
    SELECT term AS word, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim
    FROM vocabulary JOIN embeddings ON vec_id = rank - 1), sums AS (
    SELECT mail_id, dim, sum(n)::BIGINT AS n_known, sum(n * x::DOUBLE) AS total
    FROM hits JOIN vectors USING (word) GROUP BY mail_id, dim)
SELECT mail_id, coalesce(n_known, 0)::BIGINT AS n_known, dim::INT AS dim,
       round(coalesce(total / n_known, 0.0::DOUBLE), 6) AS value
FROM (SELECT mail_id, dim FROM prepared, (SELECT DISTINCT dim FROM vectors)) LEFT JOIN sums USING (mail_id, dim)""",
    "stratified_folds": f"""WITH {LABELLED}, classes AS (
    SELECT label, count(*) AS n, min(mail_id) AS first_id FROM labelled GROUP BY label), ordered AS (
    SELECT label, coalesce(sum(n) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS before FROM classes), sorted AS (
    SELECT mail_id, label, row_number() OVER (PARTITION BY label ORDER BY mail_id) AS nr, before
    FROM labelled JOIN ordered USING (label)), dealt AS (
    SELECT label, ((before + nr - 1) % 5)::INT AS fold, count(*) AS size FROM sorted GROUP BY ALL), spans AS (
    SELECT label, fold, sum(size) OVER (PARTITION BY label ORDER BY fold) AS upto, size FROM dealt)
SELECT mail_id, sorted.label, fold FROM sorted JOIN spans
ON spans.label = sorted.label AND nr > upto - size AND nr <= upto""",
    "fold_vocabulary": f"""WITH {LABELLED_TEXT}{_SPLIT}, kept AS ({_first_copy.format(relation='train')}), classes AS (
    SELECT label, count(*) AS n, min(mail_id) AS first_id FROM kept GROUP BY label), ordered AS (
    SELECT label, coalesce(sum(n) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS before FROM classes), sorted AS (
    SELECT mail_id, label, row_number() OVER (PARTITION BY label ORDER BY mail_id) AS nr, before
    FROM kept JOIN ordered USING (label)), dealt AS (
    SELECT label, ((before + nr - 1) % 5)::INT AS fold, count(*) AS size FROM sorted GROUP BY ALL), spans AS (
    SELECT label, fold, sum(size) OVER (PARTITION BY label ORDER BY fold) AS upto, size FROM dealt), folded AS (
    SELECT mail_id, fold FROM sorted JOIN spans
    ON spans.label = sorted.label AND nr > upto - size AND nr <= upto), words AS (
    SELECT mail_id, fold, list_filter(regexp_extract_all(text, '[a-z0-9]{{2,}}'),
                                      lambda w: w NOT IN {word_list(COMMON_WORDS)}) AS words
    FROM kept JOIN folded USING (mail_id)), terms AS (
    SELECT mail_id, fold, unnest(words) AS term FROM words
    UNION ALL SELECT mail_id, fold, words[i] || ' ' || words[i + 1] FROM (
        SELECT mail_id, fold, words, unnest(range(1, len(words))) AS i FROM words)), per_fold AS (
    SELECT fold, term, count(*) AS n, count(DISTINCT mail_id) AS df FROM terms GROUP BY fold, term), sides AS (
    SELECT unnest([-1, 0, 1, 2, 3, 4]) AS held_out), side_counts AS (
    SELECT held_out, term, sum(n)::BIGINT AS n, sum(df)::BIGINT AS df FROM per_fold, sides
    WHERE fold <> held_out GROUP BY held_out, term), side_rows AS (
    SELECT held_out, (SELECT count(*) FROM folded WHERE fold <> held_out) AS side_rows FROM sides), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY held_out ORDER BY n DESC, term) AS rank FROM side_counts)
SELECT held_out, rank::INT AS rank, term, n, df,
       round(ln((side_rows + 1)::DOUBLE / (df + 1)) + 1, 6) AS idf
FROM ranked JOIN side_rows USING (held_out) WHERE rank <= 5000""",
    "fold_scalers": f"""WITH {LABELLED_TEXT}{_SPLIT}, kept AS ({_first_copy.format(relation='train')}), classes AS (
    SELECT label, count(*) AS n, min(mail_id) AS first_id FROM kept GROUP BY label), ordered AS (
    SELECT label, coalesce(sum(n) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS before FROM classes), sorted AS (
    SELECT mail_id, label, row_number() OVER (PARTITION BY label ORDER BY mail_id) AS nr, before
    FROM kept JOIN ordered USING (label)), dealt AS (
    SELECT label, ((before + nr - 1) % 5)::INT AS fold, count(*) AS size FROM sorted GROUP BY ALL), spans AS (
    SELECT label, fold, sum(size) OVER (PARTITION BY label ORDER BY fold) AS upto, size FROM dealt), folded AS (
    SELECT mail_id, fold FROM sorted JOIN spans
    ON spans.label = sorted.label AND nr > upto - size AND nr <= upto), {features('labelled', 'mail_id, lang')}, sides AS (
    SELECT unnest([-1, 0, 1, 2, 3, 4]) AS held_out), rows_of AS (
    SELECT featured.*, fold FROM featured JOIN folded USING (mail_id))
SELECT held_out, feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM (
    UNPIVOT (SELECT * EXCLUDE (mail_id, lang) FROM rows_of) ON {', '.join(STRUCTURAL_COLUMNS)}
    INTO NAME feature VALUE value), sides
WHERE fold <> held_out GROUP BY held_out, feature""",
    "binary_metrics": scored() + f"""SELECT round({ratio('tp + tn', 'tn + fp + fn + tp')}, 6) AS accuracy,
       round(p1, 6) AS precision, round(r1, 6) AS recall, round(f1, 6) AS f1 FROM f""",
    "classification_report": scored() + f"""
SELECT 'Ham' AS row, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, tn + fp AS support FROM f
UNION ALL SELECT 'Spam', round(p1, 6), round(r1, 6), round(f1, 6), tp + fn FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round({ratio('tp + tn', 'tn + fp + fn + tp')}, 6), tn + fp + fn + tp FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
    tn + fp + fn + tp FROM f
UNION ALL SELECT 'weighted avg', round((p0 * (tn + fp) + p1 * (tp + fn)) / (tn + fp + fn + tp), 6),
    round((r0 * (tn + fp) + r1 * (tp + fn)) / (tn + fp + fn + tp), 6),
    round((f0 * (tn + fp) + f1 * (tp + fn)) / (tn + fp + fn + tp), 6), tn + fp + fn + tp FROM f""",
    "confusion_matrix": scored() + """
SELECT t.label, p.prediction, count(mail_id) AS n_rows
FROM (VALUES (0), (1)) AS t(label) CROSS JOIN (VALUES (0), (1)) AS p(prediction)
LEFT JOIN scored ON scored.label = t.label AND scored.prediction = p.prediction GROUP BY ALL""",
    "pr_curve": scored() + f"""
SELECT score AS threshold, round({ratio('tp', 'retrieved')}, 6) AS precision,
       round(tp::DOUBLE / positives, 6) AS recall FROM curve
UNION ALL SELECT NULL, 1.0, 0.0""",
    "average_precision": scored() + """
SELECT round(sum((recall - coalesce(before, 0)) * precision), 6) AS average_precision FROM (
    SELECT *, lag(recall) OVER (ORDER BY score DESC) AS before FROM (
        SELECT score, tp::DOUBLE / retrieved AS precision, tp::DOUBLE / positives AS recall FROM curve))""",
}
