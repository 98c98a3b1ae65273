"""Registered queries: valence scores and polarity by lexicon."""

from pyspark.sql import functions as F

from gleanery.functions.tokenize import merged_text
from gleanery.operators import moderation as mod
from gleanery.operators import opinion, valence
from gleanery.plans.inputs import (
    EXTRA_NEGATIONS,
    REVIEWS_CTE,
    VALENCE,
    small_frame,
    sql_list,
    sql_values,
    valence_lexicon,
)
from gleanery.plans.valence_sql import VALENCE_CTE, corpus_rules, valence_cte
from gleanery.sources.tables import reviews, table


def _scores(spark, sf_dir, first_context=True):
    return valence.polarity_scores(
        mod.with_review_id(reviews(spark, sf_dir)),
        valence_lexicon(spark),
        text=merged_text(F.col("summary"), F.col("reviewText")),
        rules=corpus_rules(),
        first_context=first_context,
    )


def valence_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


def valence_scores_in_place(spark, sf_dir):
    return _scores(spark, sf_dir, first_context=False)


def polarity_vote(spark, sf_dir):
    return opinion.polarity_vote(table(spark, sf_dir, "documents"), valence_lexicon(spark), "doc_id")


def negation_marks(spark, sf_dir):
    marked = opinion.negation_marked(
        table(spark, sf_dir, "documents"), "doc_id", extra_negations=EXTRA_NEGATIONS
    )
    return marked.select("doc_id", F.array_join("tokens", " ").alias("marked"))


def unigram_presence(spark, sf_dir):
    wanted = small_frame(spark, term=list(VALENCE))
    return opinion.unigram_presence(table(spark, sf_dir, "documents"), wanted, "doc_id")


def bigram_presence(spark, sf_dir):
    wanted = small_frame(spark, w1=["of", "in", "de"], w2=["the", "the", "la"])
    return opinion.bigram_presence(table(spark, sf_dir, "documents"), wanted, "doc_id")


QUERIES = {
    "valence_scores": valence_scores,
    "valence_scores_in_place": valence_scores_in_place,
    "polarity_vote": polarity_vote,
    "negation_marks": negation_marks,
    "unigram_presence": unigram_presence,
    "bigram_presence": bigram_presence,
}

_WORDS = "list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda w: w <> '')"
_NEG = (
    "^(never|no|nothing|nowhere|noone|none|not|havent|hasnt|hadnt|cant|couldnt|shouldnt|wont"
    "|wouldnt|dont|doesnt|didnt|isnt|arent|aint|" + "|".join(EXTRA_NEGATIONS) + ")$|n''t"
)

SQL = {
    "valence_scores": f"WITH {REVIEWS_CTE}, {VALENCE_CTE} SELECT * FROM scores",
    "valence_scores_in_place": f"WITH {REVIEWS_CTE}, {valence_cte(False)} SELECT * FROM scores",
    "polarity_vote": f"""WITH lex(word, measure) AS (VALUES {sql_values(VALENCE)}),
        words AS (SELECT doc_id, unnest({_WORDS}) AS word FROM documents),
        votes AS (SELECT doc_id, count(*) FILTER (measure > 0) AS n_pos, count(*) FILTER (measure < 0) AS n_neg
                  FROM words JOIN lex USING (word) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_pos, 0) AS n_pos, coalesce(n_neg, 0) AS n_neg,
               CASE WHEN coalesce(n_pos, 0) > coalesce(n_neg, 0) THEN 'positive'
                    WHEN coalesce(n_pos, 0) < coalesce(n_neg, 0) THEN 'negative' ELSE 'neutral' END AS polarity
        FROM documents d LEFT JOIN votes USING (doc_id)""",
    # A token is marked when a negation stands before it with no clause mark between.
    "negation_marks": f"""WITH toks AS (
          SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{{L}}'']+|[.:;!?]')) AS tok,
                 unnest(range(len(regexp_extract_all(text, '[\\p{{L}}'']+|[.:;!?]')))) AS pos FROM documents),
        flags AS (SELECT *, regexp_matches(tok, '{_NEG}') AS neg, tok IN ('.', ':', ';', '!', '?') AS mark
                  FROM toks),
        scoped AS (SELECT *,
            max(CASE WHEN neg THEN pos END) OVER before AS last_neg,
            max(CASE WHEN mark THEN pos END) OVER before AS last_mark
          FROM flags WINDOW before AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT d.doc_id, coalesce(m.marked, '') AS marked FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(tok || CASE WHEN last_neg IS NOT NULL AND last_neg > coalesce(last_mark, -1)
                                                 AND NOT mark THEN '_NEG' ELSE '' END, ' ' ORDER BY pos) AS marked
          FROM scoped GROUP BY doc_id) m USING (doc_id)""",
    "unigram_presence": f"""WITH lists AS (SELECT doc_id, {_WORDS} AS ws FROM documents)
        SELECT doc_id, term, list_contains(ws, term) AS present
        FROM lists, (SELECT unnest([{sql_list(list(VALENCE))}]) AS term) t""",
    "bigram_presence": f"""WITH lists AS (SELECT doc_id, {_WORDS} AS ws FROM documents)
        SELECT doc_id, w1, w2, coalesce(len(list_filter(list_zip(ws[:-2], ws[2:]),
               lambda p: p[1] = w1 AND p[2] = w2)) > 0, FALSE) AS present
        FROM lists, (VALUES ('of', 'the'), ('in', 'the'), ('de', 'la')) t(w1, w2)""",
}
