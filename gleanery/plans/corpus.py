"""Registered queries: counts, n-grams, collocations and contexts over the texts."""

from pyspark.sql import functions as F

from gleanery.functions.tokenize import letter_words
from gleanery.operators import collocations, contexts, features, frequency, ngrams
from gleanery.plans.inputs import STOP_WORDS, sql_list
from gleanery.sources.tables import table

WORD, OTHER = "the", "and"
MIN_COUNT = 3


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _tokens():
    return letter_words(F.col("text"))


def _words(spark, sf_dir, *keep):
    return _documents(spark, sf_dir).select(*keep, F.explode(_tokens()).alias("term"))


def _counts(spark, sf_dir):
    return frequency.counted(_words(spark, sf_dir), "term")


def freq_dist(spark, sf_dir):
    return frequency.freq_dist(_counts(spark, sf_dir))


def most_common(spark, sf_dir):
    return frequency.most_common(_counts(spark, sf_dir), "term", 50)


def hapaxes(spark, sf_dir):
    return frequency.hapaxes(_counts(spark, sf_dir)).select("term")


def count_of_counts(spark, sf_dir):
    return frequency.count_of_counts(_counts(spark, sf_dir))


def cond_freq(spark, sf_dir):
    return frequency.conditional(_words(spark, sf_dir, "lang"), "lang", "term")


def tabulated_freq(spark, sf_dir):
    """Counts of every term under every condition that the data hold, in the long form."""
    return frequency.tabulated(_words(spark, sf_dir, "lang"), "lang", "term")


def smoothed_probabilities(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return counts.select(
        "term",
        "n",
        frequency.lidstone(counts, 0.2).alias("lidstone"),
        frequency.lidstone(counts, 1.0).alias("laplace"),
        frequency.lidstone(counts, 0.5).alias("expected_likelihood"),
        frequency.witten_bell(counts).alias("witten_bell"),
    )


def good_turing(spark, sf_dir):
    fitted = frequency.good_turing(_counts(spark, sf_dir))
    return fitted.select("r", "n_r", F.round(F.col("p") * 1e6, 6).alias("p_per_million"))


def bigrams(spark, sf_dir):
    grams = ngrams.ngrams(_documents(spark, sf_dir), _tokens(), 2)
    return ngrams.gram_counts(grams, ["w1", "w2"])


def padded_bigrams(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    grams = ngrams.ngrams(turns, _tokens(), 2, left="<s>", right="</s>")
    return ngrams.gram_counts(grams, ["w1", "w2"])


def everygrams(spark, sf_dir):
    grams = ngrams.everygrams(_documents(spark, sf_dir), _tokens(), 1, 3)
    return ngrams.gram_counts(grams.withColumnRenamed("n", "size"), ["size", "gram"])


def skipgrams(spark, sf_dir):
    grams = ngrams.skipgrams(_documents(spark, sf_dir), _tokens(), 2, 2)
    return ngrams.gram_counts(grams, ["w1", "w2"])


BIGRAM_NAMES = [
    "raw_freq", "student_t", "chi_sq", "mi_like", "pmi", "likelihood_ratio", "poisson_stirling",
    "jaccard", "phi_sq", "dice",
]
TRIGRAM_NAMES = BIGRAM_NAMES[:8]
# Chi-square of rare triples passes 10^10 and of quadruples 10^14, where a double has no six decimals left.
DIGITS = {2: {"chi_sq": 2}, 3: {"chi_sq": 2}, 4: {"chi_sq": -4}}


def _scored(grams, measures, names):
    columns = [c for c in grams.columns if c.startswith("w")]
    return grams.select(
        *columns, "count", *[F.round(getattr(measures, n)(), DIGITS[len(columns)].get(n, 6)).alias(n) for n in names]
    )


def collocation_measures(spark, sf_dir):
    grams = collocations.frequent(collocations.bigrams(_documents(spark, sf_dir), _tokens()), MIN_COUNT)
    return _scored(grams, collocations.BigramMeasures(), BIGRAM_NAMES)


def _best(spark, sf_dir, measure, window=2):
    grams = collocations.bigrams(_documents(spark, sf_dir), _tokens(), window)
    kept = collocations.without_words(
        collocations.frequent(grams, MIN_COUNT), 2, lambda w: w.isin(STOP_WORDS)
    )
    score = F.round(getattr(collocations.BigramMeasures(), measure)(), 6)
    return collocations.n_best(kept.withColumn("score", score), 2, 100).select("w1", "w2", "score")


def collocations_pmi(spark, sf_dir):
    return _best(spark, sf_dir, "pmi")


def collocations_llr(spark, sf_dir):
    return _best(spark, sf_dir, "likelihood_ratio")


def collocations_window(spark, sf_dir):
    return _best(spark, sf_dir, "likelihood_ratio", window=4)


def collocations_above(spark, sf_dir):
    grams = collocations.frequent(collocations.bigrams(_documents(spark, sf_dir), _tokens()), MIN_COUNT)
    scored = grams.withColumn("score", F.round(collocations.BigramMeasures().student_t(), 6))
    return collocations.above(scored, 2.0).select("w1", "w2", "score")


def trigram_collocations(spark, sf_dir):
    grams = collocations.frequent(collocations.trigrams(_documents(spark, sf_dir), _tokens(), min_count=MIN_COUNT), MIN_COUNT)
    return _scored(grams, collocations.Measures(3), TRIGRAM_NAMES)


def trigram_window(spark, sf_dir):
    """A wider window counts a first word once per choice of the other two."""
    grams = collocations.frequent(collocations.trigrams(_documents(spark, sf_dir), _tokens(), 4, min_count=4), 4)
    return grams.select("w1", "w2", "w3", "count", "n_iix", "n_ixi", "n_xii", "n_ixx", "n_xix", "n_xxi")


def quadgram_collocations(spark, sf_dir):
    grams = collocations.frequent(collocations.quadgrams(_documents(spark, sf_dir), _tokens(), min_count=MIN_COUNT), MIN_COUNT)
    return _scored(grams, collocations.Measures(4), TRIGRAM_NAMES)


def _contexts(spark, sf_dir):
    return contexts.word_contexts(_documents(spark, sf_dir), _tokens())


def similar_words(spark, sf_dir):
    return contexts.similar_words(_contexts(spark, sf_dir), WORD)


def word_similarity(spark, sf_dir):
    found = contexts.word_similarity(_contexts(spark, sf_dir), WORD)
    return found.withColumn("f", F.round("f", 9))


def common_contexts(spark, sf_dir):
    return contexts.common_contexts(_contexts(spark, sf_dir), [WORD, OTHER])


def kwic(spark, sf_dir):
    return contexts.concordance(_documents(spark, sf_dir), "doc_id", _tokens(), [WORD]).select(
        "doc_id", "offset", "line"
    )


def kwic_phrase(spark, sf_dir):
    return contexts.concordance(_documents(spark, sf_dir), "doc_id", _tokens(), ["of", WORD], 60).select(
        "doc_id", "offset", "left_print", "right_print"
    )


def tfidf(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    terms = features.document_terms(rows, ["doc_id"], _tokens())
    lengths = rows.select("doc_id", F.size(_tokens()).alias("n_tokens"))
    n_texts = rows.agg(F.count("*")).scalar()
    scored = contexts.tf_idf(terms, lengths, n_texts, "doc_id")
    return scored.select("doc_id", "term", "tf", F.round("idf", 9).alias("idf"), F.round("tf_idf", 9).alias("tf_idf"))


QUERIES = {
    f.__name__: f
    for f in (
        freq_dist, most_common, hapaxes, count_of_counts, cond_freq, tabulated_freq,
        smoothed_probabilities, good_turing, bigrams, padded_bigrams, everygrams, skipgrams,
        collocation_measures, collocations_pmi, collocations_llr, collocations_window,
        collocations_above, trigram_collocations, trigram_window, quadgram_collocations,
        similar_words, word_similarity, common_contexts, kwic, kwic_phrase, tfidf,
    )
}

_LIST = "list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')"
_LISTS = f"""lists AS MATERIALIZED (SELECT doc_id, lang, {_LIST} AS ws FROM documents),
words AS MATERIALIZED (SELECT doc_id, lang, unnest(ws) AS term, unnest(range(1, len(ws) + 1)) AS pos FROM lists)"""
_COUNTS = f"""{_LISTS}, counts AS (SELECT term, count(*) AS n FROM words GROUP BY term),
total AS (SELECT CAST(sum(n) AS BIGINT) AS nn, count(*) AS bb FROM counts)"""


def _next(n: int) -> str:
    leads = ", ".join(
        f"lead(term, {j}) OVER (PARTITION BY doc_id ORDER BY pos) AS w{j + 1}" for j in range(1, n)
    )
    return f"grams AS MATERIALIZED (SELECT term AS w1, {leads} FROM words)"


def _measure_sql(n: int) -> dict[str, str]:
    """The measures spelled out over columns named like the marginals."""
    places = ["".join("i" if (b >> (n - 1 - j)) & 1 else "x" for j in range(n)) for b in range(2**n)]
    words = ["n_" + "x" * j + "i" + "x" * (n - j - 1) for j in range(n)]
    d = lambda c: f"CAST({c} AS DOUBLE)"
    gram, all_ = d("n_" + "i" * n), d("n_" + "x" * n)
    product = " * ".join(d(w) for w in words)
    power = "(" + " * ".join([all_] * (n - 1)) + ")"
    cells, expected = {}, {}
    for here in reversed(places):
        more = [p for p in places if all(b == "i" for a, b in zip(here, p) if a == "i")]
        cells[here] = "(" + " + ".join(
            f"{(-1) ** (p.count('i') - here.count('i'))} * {d('n_' + p)}" for p in more) + ")"
        sides = [d(words[j]) if c == "i" else f"({all_} - {d(words[j])})" for j, c in enumerate(here)]
        expected[here] = "(" + " * ".join(sides) + f" / {power})"
    small = "1e-20"
    chi = " + ".join(f"({cells[k]} - {expected[k]}) ** 2 / ({expected[k]} + {small})" for k in cells)
    llr = " + ".join(f"{cells[k]} * ln({cells[k]} / ({expected[k]} + {small}) + {small})" for k in cells)
    some = " + ".join(v for k, v in cells.items() if "i" in k)
    out = {
        "raw_freq": f"{gram} / {all_}",
        "student_t": f"({gram} - ({product}) / {power}) / sqrt({gram} + {small})",
        "chi_sq": chi,
        "mi_like": f"{gram} * {gram} * {gram} / ({product})",
        "pmi": f"log2({gram} * {power}) - log2({product})",
        "likelihood_ratio": f"2.0 * ({llr})",
        "poisson_stirling": f"{gram} * (log2({gram} / (({product}) / {power})) - 1)",
        "jaccard": f"{gram} / ({some})",
    }
    if n == 2:
        ii, io, oi, oo = cells["ii"], cells["ix"], cells["xi"], cells["xx"]
        out["phi_sq"] = f"({ii} * {oo} - {io} * {oi}) ** 2 / (({ii} + {io}) * ({ii} + {oi}) * ({io} + {oo}) * ({oi} + {oo}))"
        out["chi_sq"] = f"{all_} * ({out['phi_sq']})"
        out["dice"] = f"2.0 * {gram} / ({d('n_ix')} + {d('n_xi')})"
    return {k: f"round({v}, {DIGITS[n].get(k, 6)}) AS {k}" for k, v in out.items()}


def _bigram_stats(window: int = 2) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT term AS w1, lead(term, {j}) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM words"
        for j in range(1, window)
    )
    return f"""WITH {_COUNTS},
pairs AS (SELECT w1, w2, count(*) AS "count" FROM ({pairs}) WHERE w2 IS NOT NULL GROUP BY w1, w2),
stats AS (SELECT w1, w2, "count", "count" / {window - 1}.0::DOUBLE AS n_ii, a.n AS n_ix, b.n AS n_xi, nn AS n_xx
          FROM pairs JOIN counts a ON a.term = w1 JOIN counts b ON b.term = w2 CROSS JOIN total
          WHERE "count" >= {MIN_COUNT})"""


_STOPPED = f"w1 NOT IN ({sql_list(STOP_WORDS)}) AND w2 NOT IN ({sql_list(STOP_WORDS)})"
_B = _measure_sql(2)


def _best_sql(measure: str, window: int = 2) -> str:
    score = _B[measure].rsplit(" AS ", 1)[0]
    return f"""{_bigram_stats(window)} SELECT w1, w2, {score} AS score FROM stats WHERE {_STOPPED}
               ORDER BY score DESC, w1, w2 LIMIT 100"""


_TRIGRAMS = f"""WITH {_LISTS}, {_next(3)},
w AS MATERIALIZED (SELECT w1, count(*) AS n FROM grams GROUP BY ALL),
p AS MATERIALIZED (SELECT w1, w2, count(*) AS n FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
x AS MATERIALIZED (SELECT w1, w3, count(*) AS n FROM grams WHERE w3 IS NOT NULL GROUP BY ALL),
t AS MATERIALIZED (SELECT w1, w2, w3, count(*) AS n_iii FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
stats AS (SELECT t.*, n_iii AS "count", a.n AS n_iix, b.n AS n_ixi, coalesce(c.n, 0) AS n_xii,
                 d.n AS n_ixx, e.n AS n_xix, f.n AS n_xxi, (SELECT sum(n) FROM w) AS n_xxx
  FROM t LEFT JOIN p a ON a.w1 = t.w1 AND a.w2 = t.w2 LEFT JOIN x b ON b.w1 = t.w1 AND b.w3 = t.w3
  LEFT JOIN p c ON c.w1 = t.w2 AND c.w2 = t.w3 LEFT JOIN w d ON d.w1 = t.w1 LEFT JOIN w e ON e.w1 = t.w2
  LEFT JOIN w f ON f.w1 = t.w3)"""
_T = _measure_sql(3)

_WIDE = f"""WITH {_LISTS},
spots AS (SELECT doc_id, pos, term AS a, lead(term, 1) OVER v AS b, lead(term, 2) OVER v AS c, lead(term, 3) OVER v AS d
          FROM words WINDOW v AS (PARTITION BY doc_id ORDER BY pos)),
grams AS MATERIALIZED (SELECT a AS w1, b AS w2, c AS w3 FROM spots UNION ALL SELECT a, b, d FROM spots
                       UNION ALL SELECT a, c, d FROM spots),
w AS (SELECT w1, count(*) AS n FROM grams GROUP BY ALL),
p AS (SELECT w1, w2, count(*) AS n FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
x AS (SELECT w1, w3, count(*) AS n FROM grams WHERE w3 IS NOT NULL GROUP BY ALL),
t AS (SELECT w1, w2, w3, count(*) AS "count" FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 4)
SELECT t.*, a.n AS n_iix, b.n AS n_ixi, coalesce(c.n, 0) AS n_xii, d.n AS n_ixx, e.n AS n_xix, f.n AS n_xxi
  FROM t LEFT JOIN p a ON a.w1 = t.w1 AND a.w2 = t.w2 LEFT JOIN x b ON b.w1 = t.w1 AND b.w3 = t.w3
  LEFT JOIN p c ON c.w1 = t.w2 AND c.w2 = t.w3 LEFT JOIN w d ON d.w1 = t.w1 LEFT JOIN w e ON e.w1 = t.w2
  LEFT JOIN w f ON f.w1 = t.w3"""

#: Marginals of a quadruple: the places they fix, and the places of the first words at which they are counted.
_FIXED = {
    "iiix": ((1, 2, 3), (1, 2, 3)), "iixi": ((1, 2, 4), (1, 2, 4)), "ixii": ((1, 3, 4), (1, 3, 4)), "xiii": ((2, 3, 4), (1, 2, 3)),
    "iixx": ((1, 2), (1, 2)), "ixix": ((1, 3), (1, 3)), "ixxi": ((1, 4), (1, 4)), "xiix": ((2, 3), (1, 2)), "xixi": ((2, 4), (1, 3)),
    "xxii": ((3, 4), (1, 2)), "ixxx": ((1,), (1,)), "xixx": ((2,), (1,)), "xxix": ((3,), (1,)), "xxxi": ((4,), (1,)),
}


def _quadgram_sql() -> str:
    counted = sorted({places for _, places in _FIXED.values()})
    tables, joins = [], []
    for places in counted:
        columns = ", ".join(f"w{j}" for j in places)
        present = " AND ".join(f"w{j} IS NOT NULL" for j in places)
        tables.append(f"c{''.join(map(str, places))} AS MATERIALIZED (SELECT {columns}, count(*) AS n FROM grams WHERE {present} GROUP BY ALL)")
    for name, (fixed, places) in _FIXED.items():
        on = " AND ".join(f"{name}.w{j} = q.w{i}" for i, j in zip(fixed, places))
        joins.append(f"LEFT JOIN c{''.join(map(str, places))} {name} ON {on}")
    marginals = ", ".join(f"coalesce({name}.n, 0) AS n_{name}" for name in _FIXED)
    return f"""WITH {_LISTS}, {_next(4)}, {", ".join(tables)},
q AS MATERIALIZED (SELECT w1, w2, w3, w4, count(*) AS n_iiii FROM grams WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
stats AS (SELECT q.*, n_iiii AS "count", {marginals}, (SELECT sum(n) FROM c1) AS n_xxxx FROM q {" ".join(joins)})"""


_QUADGRAMS = _quadgram_sql()
_Q = _measure_sql(4)

_CONTEXTS = f"""WITH {_LISTS},
spots AS (SELECT term AS word, coalesce(lag(term) OVER v, '*START*') AS "left", coalesce(lead(term) OVER v, '*END*') AS "right"
          FROM words WINDOW v AS (PARTITION BY doc_id ORDER BY pos)),
contexts AS (SELECT word, "left", "right", count(*) AS n FROM spots GROUP BY ALL),
own AS (SELECT "left", "right", n AS n_own FROM contexts WHERE word = '{WORD}')"""

SQL = {
    "freq_dist": f"WITH {_COUNTS} SELECT term, n, n / nn::DOUBLE AS freq FROM counts, total",
    "most_common": f"WITH {_COUNTS} SELECT term, n FROM counts ORDER BY n DESC, term LIMIT 50",
    "hapaxes": f"WITH {_COUNTS} SELECT term FROM counts WHERE n = 1",
    "count_of_counts": f"WITH {_COUNTS} SELECT n AS r, count(*) AS n_r FROM counts GROUP BY n",
    "cond_freq": f"""WITH {_LISTS}, c AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL)
        SELECT lang, term, n, CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) AS n_condition,
               n / CAST(sum(n) OVER (PARTITION BY lang) AS DOUBLE) AS freq FROM c""",
    "tabulated_freq": f"""WITH {_LISTS}, c AS (SELECT term, lang, count(*) AS n FROM words GROUP BY ALL)
        SELECT t.term, l.lang, coalesce(n, 0) AS n FROM (SELECT DISTINCT term FROM c) t CROSS JOIN (SELECT DISTINCT lang FROM c) l
        LEFT JOIN c ON c.term = t.term AND c.lang = l.lang""",
    "smoothed_probabilities": f"""WITH {_COUNTS} SELECT term, n, (n + 0.2::DOUBLE) / (nn + bb * 0.2::DOUBLE) AS lidstone,
        (n + 1.0::DOUBLE) / (nn + bb * 1.0::DOUBLE) AS laplace, (n + 0.5::DOUBLE) / (nn + bb * 0.5::DOUBLE) AS expected_likelihood,
        n / (nn + bb)::DOUBLE AS witten_bell FROM counts, total""",
    "good_turing": f"""WITH {_COUNTS},
        hist AS (SELECT n AS r, count(*) AS n_r FROM counts GROUP BY n),
        near AS (SELECT *, coalesce(lag(r) OVER (ORDER BY r), 0) AS i, lead(r) OVER (ORDER BY r) AS k, lead(n_r) OVER (ORDER BY r) AS n_k FROM hist),
        pts AS (SELECT *, ln(r) AS x, ln(2.0::DOUBLE * n_r / (coalesce(k, 2 * r - i) - i)) AS y FROM near),
        fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM pts),
        stars AS (SELECT r, n_r, k, (r + 1) * exp(a + b * ln(r + 1)) / exp(a + b * ln(r)) AS smooth,
                         (r + 1) * n_k / n_r::DOUBLE AS plain,
                         sqrt((r + 1.0::DOUBLE) ** 2 * (n_k / (n_r::DOUBLE ** 2)) * (1 + n_k / n_r::DOUBLE)) AS sd FROM pts, fit),
        edge AS (SELECT min(r) AS switch_at FROM stars WHERE k IS NULL OR k <> r + 1 OR abs(plain - smooth) <= 1.96 * sd),
        mass AS (SELECT r, n_r, CASE WHEN r < switch_at THEN plain ELSE smooth END / nn AS m FROM stars, edge, total),
        norm AS (SELECT sum(n_r * m) AS seen, sum(CASE WHEN r = 1 THEN n_r ELSE 0 END) AS ones FROM mass)
        SELECT r, n_r, round(m * (1 - ones / nn::DOUBLE) / seen * 1e6, 6) AS p_per_million FROM mass, norm, total""",
    "bigrams": f"WITH {_LISTS}, {_next(2)} SELECT w1, w2, count(*) AS n FROM grams WHERE w2 IS NOT NULL GROUP BY ALL",
    "padded_bigrams": f"""WITH l AS (SELECT list_concat(['<s>'], {_LIST}, ['</s>']) AS ws FROM conversations)
        SELECT p.w1, p.w2, count(*) AS n FROM (SELECT unnest(list_zip(ws[:-2], ws[2:])) AS z FROM l) q,
        LATERAL (SELECT z[1] AS w1, z[2] AS w2) p GROUP BY ALL""",
    "everygrams": f"""WITH {_LISTS}, {_next(3)} SELECT 1 AS size, w1 AS gram, count(*) AS n FROM grams GROUP BY ALL
        UNION ALL SELECT 2, w1 || ' ' || w2 AS gram, count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 3, w1 || ' ' || w2 || ' ' || w3 AS gram, count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY ALL""",
    "skipgrams": f"""WITH {_LISTS}, {_next(4)} SELECT w1, w2, count(*) AS n FROM (
        SELECT w1, w2 FROM grams UNION ALL SELECT w1, w3 FROM grams UNION ALL SELECT w1, w4 FROM grams)
        WHERE w2 IS NOT NULL GROUP BY ALL""",
    "collocation_measures": f"""{_bigram_stats()} SELECT w1, w2, "count", {', '.join(_B[n] for n in BIGRAM_NAMES)} FROM stats""",
    "collocations_pmi": _best_sql("pmi"),
    "collocations_llr": _best_sql("likelihood_ratio"),
    "collocations_window": _best_sql("likelihood_ratio", 4),
    "collocations_above": f"""{_bigram_stats()}, scored AS (SELECT w1, w2, {_B['student_t'].rsplit(' AS ', 1)[0]} AS score FROM stats)
        SELECT * FROM scored WHERE score > 2.0""",
    "trigram_collocations": f"""{_TRIGRAMS} SELECT w1, w2, w3, "count", {', '.join(_T[n] for n in TRIGRAM_NAMES)} FROM stats""",
    "trigram_window": _WIDE,
    "quadgram_collocations": f"""{_QUADGRAMS} SELECT w1, w2, w3, w4, "count",
        {', '.join(_Q[n] for n in TRIGRAM_NAMES)} FROM stats""",
    "similar_words": f"""{_CONTEXTS} SELECT word, count(*) AS n_shared, CAST(sum(n * n_own) AS BIGINT) AS weight
        FROM contexts JOIN own USING ("left", "right") WHERE word <> '{WORD}' GROUP BY word ORDER BY n_shared DESC, word LIMIT 20""",
    "word_similarity": f"""{_CONTEXTS} SELECT word, count(n_own) AS n_shared,
        round(2.0::DOUBLE * count(n_own) / (count(*) + (SELECT count(*) FROM own)), 9) AS f
        FROM contexts LEFT JOIN own USING ("left", "right") GROUP BY word HAVING count(n_own) > 0""",
    "common_contexts": f"""{_CONTEXTS} SELECT "left", "right", CAST(sum(n) AS BIGINT) AS n FROM contexts
        WHERE word IN ('{WORD}', '{OTHER}') GROUP BY "left", "right" HAVING count(*) = 2""",
    "kwic": f"""WITH {_LISTS} SELECT w.doc_id, CAST(pos - 1 AS INTEGER) AS "offset",
        lpad(right(array_to_string(ws[greatest(pos - 20, 1):pos - 1], ' '), 37), 37, ' ') || ' {WORD} '
        || left(array_to_string(ws[pos + 1:pos + 19], ' '), 37) AS line
        FROM words w JOIN lists l ON l.doc_id = w.doc_id WHERE term = '{WORD}'""",
    "kwic_phrase": f"""WITH {_LISTS}, {_next(2).replace('term AS w1', 'doc_id, pos, term AS w1')}
        SELECT g.doc_id, CAST(pos - 1 AS INTEGER) AS "offset",
        lpad(right(array_to_string(ws[greatest(pos - 15, 1):pos - 1], ' '), 26), 26, ' ') AS left_print,
        left(array_to_string(ws[pos + 2:pos + 14], ' '), 26) AS right_print
        FROM grams g JOIN lists l ON l.doc_id = g.doc_id WHERE w1 = 'of' AND w2 = '{WORD}'""",
    "tfidf": f"""WITH {_LISTS}, t AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM t GROUP BY term),
        s AS (SELECT t.doc_id, term, n / len(ws)::DOUBLE AS tf, ln((SELECT count(*) FROM documents) / df::DOUBLE) AS idf
              FROM t JOIN df USING (term) JOIN lists l ON l.doc_id = t.doc_id)
        SELECT doc_id, term, tf, round(idf, 9) AS idf, round(tf * idf, 9) AS tf_idf FROM s""",
}
