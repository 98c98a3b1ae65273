"""Registered queries: term counts and chi-square term selection over `documents`."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import ranking, termstats
from gleanery.plans.inputs import (
    REVIEWS_CTE,
    SQL_BLANK_TAB,
    SQL_UNICODE,
    STOP_WORDS,
    sql_list,
    sql_tokens,
    stop_words,
)
from gleanery.sources.tables import reviews


def _scores(spark: SparkSession, sf_dir: str, form: str = "closed") -> DataFrame:
    tokenizer = "unicode" if form == "closed" else "blank_tab"
    return termstats.chi2_scores(reviews(spark, sf_dir), stop_words(spark), tokenizer, form)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termstats.term_category_counts(reviews(spark, sf_dir), stop_words(spark))


def category_sizes(spark, sf_dir):
    docs = reviews(spark, sf_dir)
    return termstats.category_sizes(docs).withColumn("n", termstats.corpus_size(docs))


def corpus_sizes(spark, sf_dir):
    return termstats.corpus_sizes(reviews(spark, sf_dir)).select(
        F.coalesce("category", F.lit("(all)")).alias("category"), "n_docs"
    )


def term_category_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


def term_totals(spark, sf_dir):
    return termstats.term_totals(_counts(spark, sf_dir))


def term_statistics(spark, sf_dir):
    stats = termstats.term_statistics(_counts(spark, sf_dir))
    shown = F.transform(
        F.map_entries("categories"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return stats.select("term", "total", F.array_join(shown, " ").alias("categories"))


def count_records(spark, sf_dir):
    records = termstats.count_records(_counts(spark, sf_dir), reviews(spark, sf_dir))
    return records.select(
        "kind",
        F.coalesce("term", F.lit("")).alias("term"),
        F.coalesce("category", F.lit("")).alias("category"),
        "cnt",
    )


def chi2_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


def chi2_expected(spark, sf_dir):
    return _scores(spark, sf_dir, "expected")


def top_terms(spark, sf_dir):
    return ranking.top_terms(_scores(spark, sf_dir))


def top_terms_expected(spark, sf_dir):
    # Equal up to the last bits of the sum, so scores are rounded before they are ranked.
    scores = _scores(spark, sf_dir, "expected").withColumn("chi2", F.round("chi2", 6))
    return ranking.top_terms(scores)


def merged_dictionary(spark, sf_dir):
    return ranking.merged_dictionary(ranking.top_terms(_scores(spark, sf_dir)))


def ranked_lines(spark, sf_dir):
    return ranking.ranked_lines(ranking.top_terms(_scores(spark, sf_dir))).orderBy("part", "category")


QUERIES = {
    "category_sizes": category_sizes,
    "corpus_sizes": corpus_sizes,
    "term_category_counts": term_category_counts,
    "term_totals": term_totals,
    "term_statistics": term_statistics,
    "count_records": count_records,
    "chi2_scores": chi2_scores,
    "chi2_expected": chi2_expected,
    "top_terms": top_terms,
    "top_terms_expected": top_terms_expected,
    "merged_dictionary": merged_dictionary,
    "ranked_lines": ranked_lines,
}


def _counts_cte(pattern: str) -> str:
    return f"""WITH {REVIEWS_CTE},
counted AS (SELECT * FROM reviews WHERE category IS NOT NULL AND category <> ''),
sizes AS (SELECT category, count(*) AS n_c FROM counted GROUP BY category),
total AS (SELECT count(*) AS n FROM counted),
terms AS (SELECT category, unnest(list_distinct({sql_tokens('reviewText', pattern)})) AS term
          FROM counted),
counts AS (SELECT term, category, count(*) AS a FROM terms
           WHERE term NOT IN ({sql_list(STOP_WORDS)}) GROUP BY term, category)"""


def _cells_cte(pattern: str) -> str:
    return _counts_cte(pattern) + """,
cells AS (
  SELECT x.term, x.category, n, a,
         CAST(f_t - a AS BIGINT) AS b, n_c - a AS c, CAST(n - n_c - f_t + a AS BIGINT) AS d
  FROM (SELECT *, sum(a) OVER (PARTITION BY term) AS f_t FROM counts) x
  JOIN sizes USING (category) CROSS JOIN total)"""


_CLOSED = _cells_cte(SQL_UNICODE) + """,
margins AS (SELECT *, CAST(a + b AS DOUBLE) * CAST(a + c AS DOUBLE)
                      * CAST(b + d AS DOUBLE) * CAST(c + d AS DOUBLE) AS den FROM cells),
scores AS (SELECT term, category, a, b, c, d,
                  CAST(n AS DOUBLE) * CAST(a * d - b * c AS DOUBLE) * CAST(a * d - b * c AS DOUBLE) / den AS chi2
           FROM margins WHERE den > 0),
top AS (SELECT category, term, chi2, rank FROM (
          SELECT category, term, chi2,
                 CAST(row_number() OVER (PARTITION BY category ORDER BY chi2 DESC, term) AS INTEGER) AS rank
          FROM scores) WHERE rank <= 75)"""


def _part(obs: str, row: str, col: str) -> str:
    exp = f"(CAST({row} AS DOUBLE) * CAST({col} AS DOUBLE) / CAST(n AS DOUBLE))"
    gap = f"(CAST({obs} AS DOUBLE) - {exp})"
    return f"CASE WHEN {exp} > 0 THEN {gap} * {gap} / {exp} ELSE 0.0::DOUBLE END"


_EXPECTED = _cells_cte(SQL_BLANK_TAB) + f""",
scores AS (
  SELECT term, category, a, b, c, d,
         {_part('a', 'a + c', 'a + b')} + {_part('b', 'b + d', 'a + b')}
         + {_part('c', 'a + c', 'c + d')} + {_part('d', 'b + d', 'c + d')} AS chi2
  FROM cells WHERE a + c > 0 AND least(a, b, c, d) >= 0)"""

_COUNTS = _counts_cte(SQL_UNICODE)

SQL = {
    "category_sizes": f"{_COUNTS} SELECT category, n_c, n FROM sizes CROSS JOIN total",
    "corpus_sizes": f"""{_COUNTS} SELECT category, n_c AS n_docs FROM sizes
        UNION ALL SELECT '(all)', n FROM total""",
    "term_category_counts": f"{_COUNTS} SELECT term, category, a FROM counts",
    "term_totals": f"{_COUNTS} SELECT term, CAST(sum(a) AS BIGINT) AS f_t FROM counts GROUP BY term",
    "term_statistics": f"""{_COUNTS} SELECT term, CAST(sum(a) AS BIGINT) AS total,
        string_agg(category || '=' || CAST(a AS VARCHAR), ' ' ORDER BY category) AS categories
        FROM counts GROUP BY term""",
    "count_records": f"""{_COUNTS} SELECT 't' AS kind, term, category, a AS cnt FROM counts
        UNION ALL SELECT 'c', '', category, n_c FROM sizes
        UNION ALL SELECT 'n', '', '', n FROM total""",
    "chi2_scores": f"{_CLOSED} SELECT term, category, a, b, c, d, chi2 FROM scores",
    "chi2_expected": f"{_EXPECTED} SELECT term, category, a, b, c, d, chi2 FROM scores",
    "top_terms": f"{_CLOSED} SELECT category, term, chi2, rank FROM top",
    "top_terms_expected": f"""{_EXPECTED}, rounded AS (
          SELECT category, term, round(chi2, 6) AS chi2 FROM scores)
        SELECT category, term, chi2, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY chi2 DESC, term) AS INTEGER) AS rank
          FROM rounded) WHERE rank <= 75""",
    "merged_dictionary": f"{_CLOSED} SELECT DISTINCT term FROM top",
    "ranked_lines": f"""{_CLOSED}
        SELECT 0 AS part, category, category || ' ' || string_agg(
                 term || ':' || printf('%.4f', round_even(chi2, 4)), ' ' ORDER BY rank) AS line
        FROM top GROUP BY category
        UNION ALL
        SELECT 1, '', string_agg(term, ' ' ORDER BY term) FROM (SELECT DISTINCT term FROM top)""",
}
