"""Registered queries: language models, text-pair scores, agreement, learners, language ids."""

from pyspark.sql import functions as F

from gleanery.functions import distances, json_fields, stems
from gleanery.functions.tokenize import letter_words
from gleanery.operators import (
    agreement,
    bayes,
    classify,
    features,
    langmodel,
    language_id,
    learners,
    linkage,
    maxent,
    mixtures,
    ngrams,
    stemming,
    textpairs,
    trees,
)
from gleanery.plans.learner_sql import dendrogram_sql, linkage_sql, maxent_sql, mixture_sql, tree_sql
from gleanery.sources.tables import table

ORDER = 2
CUTOFF = 2
MODELS = ["lidstone", "laplace", "witten_bell", "kneser_ney"]
CODERS = ["length", "quality", "toxic"]


def _tokens():
    return letter_words(F.col("text"))


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _turns(spark, sf_dir, role):
    return table(spark, sf_dir, "conversations").where(F.col("role") == role)


def _lm_scored(spark, sf_dir, order):
    """Models of what the assistant says, asked about what the user says."""
    counts = langmodel.fit(_turns(spark, sf_dir, "assistant"), _tokens(), order, CUTOFF)
    asked = ngrams.ngrams(
        _turns(spark, sf_dir, "user"), _tokens(), order, left=langmodel.START, right=langmodel.END
    )
    columns = langmodel.words_of(order)
    grams = ngrams.gram_counts(asked, columns)
    grams = langmodel.masked(grams, counts.vocabulary, order).groupBy(*columns).agg(F.sum("n").alias("n"))
    return langmodel.score(grams, counts)


def _rounded(scored, order):
    plain = langmodel.words_of(order) + ["n"]
    rest = [F.round(c, 9).alias(c) for c in scored.columns if c not in plain]
    return scored.select(*plain, *rest)


def lm_scores(spark, sf_dir):
    return _rounded(_lm_scored(spark, sf_dir, ORDER), ORDER)


def lm_trigram_scores(spark, sf_dir):
    return _rounded(_lm_scored(spark, sf_dir, 3), 3)


def lm_perplexity(spark, sf_dir):
    found = langmodel.perplexity(_lm_scored(spark, sf_dir, ORDER), MODELS)
    return found.select("model", F.round("entropy", 6).alias("entropy"), F.round("perplexity", 4).alias("perplexity"))


def _pairs(spark, sf_dir):
    """Each assistant turn as a hypothesis, the turns around it as references."""
    turns = table(spark, sf_dir, "conversations")
    hyps = turns.where("role = 'assistant'").select("conv_id", "turn", "text")
    refs = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("ref"), F.col("text").alias("ref_text"))
    asked = hyps.withColumn("ref", F.explode(F.array(F.col("turn") - 1, F.col("turn") + 1)))
    return asked.join(refs, ["conv_id", "ref"]).withColumn("pair", F.concat_ws("-", "conv_id", "turn"))


def _sides(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    refs = pairs.select("pair", "ref", letter_words(F.col("ref_text")).alias("tokens"))
    hyps = pairs.groupBy("pair").agg(F.first("text").alias("text")).select("pair", _tokens().alias("tokens"))
    return refs, hyps


def corpus_bleu(spark, sf_dir):
    return textpairs.bleu(*_sides(spark, sf_dir)).select(F.round("bleu", 9).alias("bleu"))


def corpus_gleu(spark, sf_dir):
    return textpairs.gleu(*_sides(spark, sf_dir)).select(F.round("gleu", 9).alias("gleu"))


def corpus_chrf(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).where("ref = turn - 1").select(
        "pair", F.col("ref_text").alias("reference"), F.col("text").alias("hypothesis")
    )
    return textpairs.chrf(pairs).select(F.round("chrf", 9).alias("chrf"))


def corpus_nist(spark, sf_dir):
    return textpairs.nist(*_sides(spark, sf_dir)).select(F.round("nist", 7).alias("nist"))


def _annotations(spark, sf_dir):
    """Three opinions on a document: its two labels and whether it is long."""
    rows = table(spark, sf_dir, "labels").join(_documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    opinions = {
        "length": F.when(F.col("n_chars") > 1500, 1).otherwise(0),
        "quality": F.col("quality"),
        "toxic": F.col("toxic"),
    }
    return rows.select(
        F.col("doc_id").alias("item"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("coder"), l.alias("label")) for c, l in opinions.items()])),
    )


def annotator_pairs(spark, sf_dir):
    pairs = agreement.pairwise(_annotations(spark, sf_dir), CODERS)
    names = ["ao", "ae", "kappa", "weighted_kappa"]
    return pairs.select("coder_a", "coder_b", *[F.round(n, 9).alias(n) for n in names])


def annotator_agreement(spark, sf_dir):
    one = agreement.coefficients(_annotations(spark, sf_dir), CODERS)
    return one.select(*[F.round(c, 9).alias(c) for c in one.columns])


def rank_correlation(spark, sf_dir):
    """Do the words of the documents rank alike in the conversations?"""
    def word_ranks(name):
        words = table(spark, sf_dir, name).select(F.explode(_tokens()).alias("term"))
        return agreement.ranks(words.groupBy("term").agg(F.count("*").alias("n")), "term", "n")

    rho = agreement.spearman(word_ranks("documents"), word_ranks("conversations"), "term")
    return rho.select(F.round("rho", 9).alias("rho"))


def label_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    scores = agreement.set_scores(rows, F.col("quality") == 1, F.col("toxic") == 0, 0.4)
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])


def _guessed(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    profile = language_id.profiles(rows)
    return language_id.guess(rows, profile, "doc_id").join(rows.select("doc_id", "lang"), "doc_id")


def language_profiles(spark, sf_dir):
    return language_id.profiles(_documents(spark, sf_dir))


def langid(spark, sf_dir):
    return _guessed(spark, sf_dir).select("doc_id", "guess")


def confusion(spark, sf_dir):
    return classify.confusion(_guessed(spark, sf_dir), "lang", "guess")


def class_scores(spark, sf_dir):
    counts = classify.confusion(_guessed(spark, sf_dir), "lang", "guess")
    scores = classify.class_scores(counts, "lang", "guess")
    return scores.select("class", "tp", "support", "predicted", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


def _neighbours(spark, sf_dir):
    """Distinct pairs of neighbouring words: candidates that grow with the text, not its square."""
    return ngrams.ngrams(_documents(spark, sf_dir), _tokens(), 2).distinct()


def word_distances(spark, sf_dir):
    a, b = F.col("w1"), F.col("w2")
    la, lb = F.col("letters1"), F.col("letters2")
    return _neighbours(spark, sf_dir).withColumns(
        {"letters1": distances.letters(a), "letters2": distances.letters(b)}
    ).select(
        "w1",
        "w2",
        distances.edit_distance(a, b).cast("long").alias("edit"),
        distances.binary_distance(a, b).alias("different"),
        F.round(distances.jaccard_distance(la, lb), 9).alias("jaccard"),
        F.round(distances.masi_distance(la, lb), 9).alias("masi"),
    )


def word_similarities(spark, sf_dir):
    a, b = F.col("w1"), F.col("w2")
    measured = _neighbours(spark, sf_dir).withColumn("j", distances.jaro_similarity(a, b))
    return measured.select(
        "w1",
        "w2",
        F.round("j", 9).alias("jaro"),
        F.round(distances.jaro_winkler_similarity(a, b, jaro=F.col("j")), 9).alias("jaro_winkler"),
    )


def regexp_stems(spark, sf_dir):
    words = _documents(spark, sf_dir).select(F.explode(F.array_distinct(_tokens())).alias("word")).distinct()
    return words.select("word", stems.regexp_stem(F.col("word"), min_length=4).alias("stem"))


def porter_stems(spark, sf_dir):
    words = _documents(spark, sf_dir).select(F.explode(F.array_distinct(_tokens())).alias("word")).distinct()
    return stemming.porter_stems(words)


def swap_distances(spark, sf_dir):
    """Edit distance with swaps, between neighbouring words of the conversations."""
    pairs = ngrams.ngrams(table(spark, sf_dir, "conversations"), _tokens(), 2).distinct()
    return pairs.select(
        "w1",
        "w2",
        distances.costed_edit_distance(F.col("w1"), F.col("w2"), 1, True).alias("edit"),
    )


def trigram_discount(spark, sf_dir):
    """What the user says, under the discounted trigrams of the assistant."""
    def counts(role):
        grams = ngrams.ngrams(_turns(spark, sf_dir, role), _tokens(), 3)
        return grams.groupBy("w1", "w2", "w3").agg(F.count("*").alias("c"))

    asked = counts("user").select("w1", "w2", "w3").unionByName(
        counts("assistant").select("w1", "w2", "w3")
    ).distinct()
    found = langmodel.trigram_discount(asked, counts("assistant"))
    return found.select("w1", "w2", "w3", F.round("p", 9).alias("p"))


def _presence(spark, sf_dir):
    """The distinct terms of each document; nobody asks how often, so they need not be counted."""
    return _documents(spark, sf_dir).select("doc_id", "lang", F.explode(F.array_distinct(_tokens())).alias("term"))


def naive_bayes_model(spark, sf_dir):
    _, likelihoods = bayes.train(_presence(spark, sf_dir), _documents(spark, sf_dir), "lang")
    return likelihoods.select("term", "lang", F.round("log_p", 9).alias("log_p"))


def naive_bayes(spark, sf_dir):
    present = _presence(spark, sf_dir)
    priors, likelihoods = bayes.train(present, _documents(spark, sf_dir), "lang")
    return bayes.classify(_documents(spark, sf_dir), present, priors, likelihoods, "doc_id", "lang")


MAXENT_ROUNDS = 8
TREE_DEPTH = 4
TREE_SUPPORT = 10


def maxent_confusion(spark, sf_dir):
    rows, present = _documents(spark, sf_dir).select("doc_id", "lang"), _presence(spark, sf_dir)
    model = maxent.train(present, rows, "doc_id", "lang", MAXENT_ROUNDS)
    return classify.confusion(maxent.classify(model, present, rows, "doc_id"), "lang", "predicted")


def tree_confusion(spark, sf_dir):
    rows, present = _documents(spark, sf_dir).select("doc_id", "lang"), _presence(spark, sf_dir)
    tree = trees.grow(present, rows, "doc_id", "lang", TREE_DEPTH, TREE_SUPPORT)
    return classify.confusion(trees.classify(tree, present, rows, "doc_id", TREE_DEPTH), "lang", "predicted")


def _clustered(spark, sf_dir, method):
    rows = learners.vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "label", "features")
    model = learners.fit_clusters(rows, method, 10)
    return model.transform(rows).groupBy("prediction", "label").agg(F.count("*").alias("n"))


def clusters_kmeans(spark, sf_dir):
    return _clustered(spark, sf_dir, "kmeans")


MIXTURE_ROUNDS = 8
MIXTURE_PARTS = 10


def clusters_mixture(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    model = mixtures.fit(rows, MIXTURE_PARTS, rounds=MIXTURE_ROUNDS)
    return mixtures.assign(rows, model).groupBy("prediction", "label").agg(F.count("*").alias("n"))


MICRO_CLUSTERS = 32
MICRO_ROUNDS = 2


def _linked(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    summary = linkage.summarised(rows, MICRO_CLUSTERS, rounds=MICRO_ROUNDS)
    return rows, summary, linkage.linked(summary)


def clusters_hierarchical(spark, sf_dir):
    """Ten clusters by average linkage."""
    rows, summary, merges = _linked(spark, sf_dir)
    found = linkage.assign(rows, summary, linkage.cut(summary, merges, 10))
    return found.groupBy("prediction", "label").agg(F.count("*").alias("n"))


def dendrogram(spark, sf_dir):
    """The merges of average linkage over the micro-clusters of the embeddings."""
    _, _, merges = _linked(spark, sf_dir)
    rows = [(m.step, m.left, m.right, round(m.height, 6), m.n) for m in merges]
    return spark.createDataFrame(rows, "step int, left_part int, right_part int, height double, n long")


def event_fields(spark, sf_dir):
    return json_fields.flat(table(spark, sf_dir, "events"), "props", ["k"], ["event_id"])


def event_entities(spark, sf_dir):
    """Nested lists in JSON text, one row per element: each user's events of a kind and day."""
    event = F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("name")).alias("type"))
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct(F.struct(F.array(event, event).alias("items")).alias("log"))).alias("doc"),
    )
    return json_fields.entities(nested, "doc", "log.items", ["id", "type.name"], ["event_id"])


QUERIES = {
    f.__name__: f
    for f in (
        lm_scores, lm_trigram_scores, lm_perplexity, corpus_bleu, corpus_gleu, corpus_chrf, corpus_nist,
        annotator_pairs, annotator_agreement, rank_correlation, label_scores, language_profiles, langid,
        confusion, class_scores, word_distances, word_similarities, swap_distances, regexp_stems, porter_stems,
        trigram_discount, naive_bayes_model,
        naive_bayes, maxent_confusion, tree_confusion, clusters_kmeans, clusters_mixture,
        clusters_hierarchical, dendrogram, event_fields, event_entities,
    )
}

_LIST = "list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')"


def _lm_sql(n: int) -> str:
    marked = (
        f"list_concat(list_concat(list_transform(range({n - 1}), lambda x: '<s>'), {_LIST}), "
        f"list_transform(range({n - 1}), lambda x: '</s>'))"
    )
    ws = [f"w{j}" for j in range(1, n + 1)]
    spread = ", ".join(
        f"lead(word, {j}) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS w{j + 1}" for j in range(1, n)
    )
    ctes = [
        f"lists AS (SELECT conv_id, turn, role, {marked} AS l FROM conversations)",
        "toks AS (SELECT conv_id, turn, role, unnest(l) AS word, unnest(range(len(l))) AS pos FROM lists)",
        f"vocab AS (SELECT word FROM toks WHERE role = 'assistant' GROUP BY word HAVING count(*) >= {CUTOFF})",
        "size AS (SELECT count(*) + 1 AS v FROM vocab)",
        "known AS (SELECT t.conv_id, t.turn, role, pos, coalesce(v.word, '<UNK>') AS word "
        "FROM toks t LEFT JOIN vocab v ON t.word = v.word)",
        f"spread AS MATERIALIZED (SELECT role, word AS w1, {spread} FROM known)",
        f"asked AS (SELECT {', '.join(ws)}, count(*) AS n FROM spread WHERE role = 'user' AND w{n} IS NOT NULL GROUP BY ALL)",
    ]
    for m in range(1, n + 1):
        cols = ", ".join(ws[:m])
        ctes.append(f"g{m} AS (SELECT {cols}, count(*) AS c FROM spread WHERE role = 'assistant' AND w{m} IS NOT NULL GROUP BY ALL)")
        ctx = ", ".join(ws[: m - 1])
        ctes.append(
            f"x{m} AS (SELECT {ctx + ', ' if ctx else ''}CAST(sum(c) AS BIGINT) AS n, count(*) AS t FROM g{m} {'GROUP BY ALL' if ctx else ''})"
        )
    for m in range(1, n):
        inner = ", ".join(f"w{j + 1} AS w{j}" for j in range(1, m + 1))
        ctes.append(f"k{m} AS (SELECT {inner}, count(*) AS cc FROM g{m + 1} GROUP BY ALL)")
        context = ", ".join(f"w{j + 1} AS w{j}" for j in range(1, m))
        ctes.append(
            f"kx{m} AS (SELECT {context + ', ' if context else ''}count(*) AS cn FROM g{m + 1} {'GROUP BY ALL' if context else ''})"
        )
    joins, cols = [], []

    def on(alias: str, places: list[int]) -> str:
        return " AND ".join(f"{alias}.w{j + 1} = a.w{p}" for j, p in enumerate(places)) or "TRUE"

    for m in range(1, n + 1):
        places = list(range(n - m + 1, n + 1))
        joins.append(f"LEFT JOIN g{m} ON {on(f'g{m}', places)}")
        joins.append(f"LEFT JOIN x{m} ON {on(f'x{m}', places[:-1])}")
        cols.append(f"coalesce(g{m}.c, 0) AS c_{m}, coalesce(x{m}.n, 0) AS n_{m}, coalesce(x{m}.t, 0) AS t_{m}")
        if m < n:
            joins.append(f"LEFT JOIN k{m} ON {on(f'k{m}', places)}")
            joins.append(f"LEFT JOIN kx{m} ON {on(f'kx{m}', places[:-1])}")
            cols.append(f"coalesce(k{m}.cc, 0) AS cc_{m}, coalesce(kx{m}.cn, 0) AS cn_{m}")
    ctes.append(f"r AS (SELECT a.*, v, {', '.join(cols)} FROM asked a CROSS JOIN size {' '.join(joins)})")

    base = "(CASE WHEN n_1 > 0 THEN c_1 / n_1::DOUBLE ELSE 0.0::DOUBLE END)"
    mle = f"(CASE WHEN n_{n} > 0 THEN c_{n} / n_{n}::DOUBLE ELSE 0.0::DOUBLE END)"
    back, wb, ad, kn = base, base, base, "(cc_1 / cn_1::DOUBLE)"
    for m in range(2, n + 1):
        back = f"(CASE WHEN c_{m} > 0 THEN c_{m} / n_{m}::DOUBLE ELSE 0.4::DOUBLE * {back} END)"
        g = f"(t_{m} / (t_{m} + n_{m})::DOUBLE)"
        wb = f"(CASE WHEN n_{m} > 0 THEN (1.0::DOUBLE - {g}) * (c_{m} / n_{m}::DOUBLE) + {g} * {wb} ELSE {wb} END)"
        ad = (f"(CASE WHEN n_{m} > 0 THEN greatest(c_{m} - 0.75::DOUBLE, 0.0::DOUBLE) / n_{m} "
              f"+ (0.75::DOUBLE * t_{m}) / n_{m} * {ad} ELSE {ad} END)")
        c, total = (f"c_{m}", f"n_{m}") if m == n else (f"cc_{m}", f"cn_{m}")
        kn = (f"(CASE WHEN n_{m} > 0 AND {total} > 0 THEN greatest({c} - 0.1::DOUBLE, 0.0::DOUBLE) / {total} "
              f"+ 0.1::DOUBLE * t_{m} / {total} * {kn} ELSE {kn} END)")
    ctes.append(
        f"scored AS (SELECT {', '.join(ws)}, n, {mle} AS mle, (c_{n} + 0.2::DOUBLE) / (n_{n} + v * 0.2::DOUBLE) AS lidstone, "
        f"(c_{n} + 1.0::DOUBLE) / (n_{n} + v * 1.0::DOUBLE) AS laplace, {back} AS stupid_backoff, {wb} AS witten_bell, "
        f"{ad} AS absolute_discount, {kn} AS kneser_ney FROM r)"
    )
    return "WITH " + ",\n".join(ctes)


_NAMES = ["mle", "lidstone", "laplace", "stupid_backoff", "witten_bell", "absolute_discount", "kneser_ney"]
_R9 = ", ".join(f"round({m}, 9) AS {m}" for m in _NAMES)

_PAIRS = f"""WITH pairs AS MATERIALIZED (
  SELECT h.conv_id || '-' || h.turn AS pair, r.turn AS ref, h.turn AS turn, h.text AS hyp, r.text AS ref_text
  FROM conversations h JOIN conversations r ON h.conv_id = r.conv_id AND r.turn IN (h.turn - 1, h.turn + 1)
  WHERE h.role = 'assistant' AND r.role = 'user'),
refs AS MATERIALIZED (SELECT pair, ref, {_LIST.replace('text', 'ref_text')} AS ws FROM pairs),
hyps AS MATERIALIZED (SELECT DISTINCT pair, {_LIST.replace('text', 'hyp')} AS ws FROM pairs)"""


def _grams(source: str, keys: str, max_n: int, separator: str = " ") -> str:
    parts = []
    for n in range(1, max_n + 1):
        parts.append(
            f"SELECT {keys}, {n} AS n, array_to_string(ws[i:i + {n - 1}], '{separator}') AS gram "
            f"FROM {source}, unnest(range(1, len(ws) - {n} + 2)) t(i)"
        )
    return f"(SELECT {keys}, n, gram, count(*) AS c FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"


def _totals(max_n: int) -> str:
    return f"(SELECT unnest(range(1, {max_n + 1})) AS n)"


_CHRF = f"""WITH pairs AS (
  SELECT h.conv_id || '-' || h.turn AS pair, h.text AS hyp, r.text AS ref_text
  FROM conversations h JOIN conversations r ON h.conv_id = r.conv_id AND r.turn = h.turn - 1
  WHERE h.role = 'assistant' AND r.role = 'user'),
refs AS MATERIALIZED (SELECT pair, string_split(regexp_replace(ref_text, '[\\x0b\\x85\\s\\p{{Z}}]+', '', 'g'), '') AS ws FROM pairs),
hyps AS MATERIALIZED (SELECT pair, string_split(regexp_replace(hyp, '[\\x0b\\x85\\s\\p{{Z}}]+', '', 'g'), '') AS ws FROM pairs),
hg AS {_grams('hyps', 'pair', 6, '')}, rg AS {_grams('refs', 'pair', 6, '')},
hits AS (SELECT pair, n, sum(least(h.c, r.c)) AS tp FROM hg h JOIN rg r USING (pair, n, gram) GROUP BY ALL),
per AS (SELECT coalesce(tp, 0) AS tp, greatest(len(h.ws) - n + 1, 0) AS tpfp, greatest(len(r.ws) - n + 1, 0) AS tpfn
        FROM hyps h JOIN refs r USING (pair) CROSS JOIN {_totals(6)} LEFT JOIN hits USING (pair, n))
SELECT round(avg(CASE WHEN tp > 0 THEN 10.0::DOUBLE * (tp / tpfp::DOUBLE) * (tp / tpfn::DOUBLE)
       / (9.0::DOUBLE * tp / tpfp + tp / tpfn::DOUBLE) ELSE 1e-16 END), 9) AS chrf FROM per"""

_ANNOTATIONS = """WITH rows AS (SELECT l.doc_id, quality, toxic, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS long
  FROM labels l JOIN documents d USING (doc_id)),
ann AS (SELECT doc_id AS item, 'length' AS coder, long AS label FROM rows UNION ALL
        SELECT doc_id, 'quality', quality FROM rows UNION ALL SELECT doc_id, 'toxic', toxic FROM rows),
items AS (SELECT count(DISTINCT item)::DOUBLE AS i FROM ann),
cells AS (SELECT a.coder AS coder_a, b.coder AS coder_b, a.label AS la, b.label AS lb
          FROM ann a JOIN ann b ON a.item = b.item AND a.coder < b.coder),
shares AS (SELECT coder, label, count(*) AS n FROM ann GROUP BY ALL),
obs AS (SELECT coder_a, coder_b, count(*) FILTER (la = lb) / any_value(i) AS ao, count(*) FILTER (la <> lb) / any_value(i) AS d
        FROM cells, items GROUP BY ALL),
expd AS (SELECT x.coder AS coder_a, y.coder AS coder_b,
               sum(CASE WHEN x.label = y.label THEN x.n * y.n ELSE 0 END) / any_value(i * i) AS ae,
               sum(CASE WHEN x.label <> y.label THEN x.n * y.n ELSE 0 END) / any_value(i * i) AS de
        FROM shares x JOIN shares y ON x.coder < y.coder CROSS JOIN items GROUP BY ALL),
pairs AS (SELECT coder_a, coder_b, ao, ae, (ao - ae) / (1 - ae) AS kappa, 1 - d / de AS weighted_kappa
          FROM obs JOIN expd USING (coder_a, coder_b)),
avgs AS (SELECT avg(ao) AS ao, avg(ae) AS ae, avg(kappa) AS k, avg(weighted_kappa) AS wk FROM pairs),
tot AS (SELECT label, count(*)::DOUBLE AS n FROM ann GROUP BY label),
pic AS (SELECT count(*) AS k, sum(n * n) AS sq, sum(n) AS m FROM tot),
peritem AS (SELECT item, sum(n) AS m, sum(n * n) AS sq FROM (SELECT item, label, count(*)::DOUBLE AS n FROM ann GROUP BY ALL) GROUP BY item),
within AS (SELECT sum((m * m - sq) / (m - 1)) / sum(m) AS d_o FROM peritem WHERE m > 1)"""

_TRI = """tri AS MATERIALIZED (
  SELECT doc_id, lang, substr(w, i, 3) AS trigram FROM (
    SELECT doc_id, lang, '<' || unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')) || '>' AS w
    FROM documents) x, unnest(range(1, length(w) - 1)) t(i)),
profile AS (SELECT lang AS language, trigram, place - 1 AS rank FROM (
    SELECT lang, trigram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, trigram) AS place
    FROM (SELECT lang, trigram, count(*) AS n FROM tri GROUP BY ALL))),
placed AS (SELECT doc_id, trigram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, trigram) - 1 AS place
           FROM (SELECT doc_id, trigram, count(*) AS n FROM tri GROUP BY ALL)),
dist AS (SELECT doc_id, language, count(*) AS found, sum(abs(rank - place)) AS d FROM placed JOIN profile USING (trigram) GROUP BY ALL),
best AS (SELECT doc_id, language FROM dist
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY found DESC, d, language) = 1),
guess AS (SELECT doc_id, lang, coalesce(language, (SELECT min(language) FROM profile)) AS guess
          FROM documents LEFT JOIN best USING (doc_id)),
judged AS (SELECT lang, guess FROM guess)"""

# DuckDB measures words in bytes, so letters beyond ASCII are first given one byte each.
_WIDE = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
_NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456"


def _bytes(word: str) -> str:
    return f"translate({word}, '{_WIDE}', '{_NARROW}')"


_NEIGHBOURS = f"""WITH l AS (SELECT {_LIST} AS ws FROM documents),
pairs AS (SELECT DISTINCT ws[i] AS w1, ws[i + 1] AS w2 FROM l, unnest(range(1, len(ws))) t(i)),
sets AS (SELECT w1, w2, list_distinct(string_split(w1, '')) AS a, list_distinct(string_split(w2, '')) AS b FROM pairs),
sizes AS (SELECT *, len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS n_both,
                 len(list_distinct(list_concat(a, b))) AS n_either FROM sets)"""

_BAYES = f"""WITH present AS MATERIALIZED (
  SELECT DISTINCT doc_id, lang, unnest({_LIST}) AS term FROM documents),
wanted AS (SELECT term, count(*) AS df FROM present GROUP BY term),
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
total AS (SELECT sum(n) AS nn, count(*) AS k FROM sizes),
seen AS (SELECT term, lang, count(*) AS c FROM present GROUP BY ALL),
model AS (SELECT w.term, s.lang, log2((coalesce(c, 0) + 0.5::DOUBLE) / (n + CASE WHEN df < nn THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)) AS log_p
          FROM wanted w CROSS JOIN sizes s CROSS JOIN total LEFT JOIN seen ON seen.term = w.term AND seen.lang = s.lang)"""

def _porter_sql() -> str:
    """The suffix rules as a chain of SQL steps, one per rule list."""
    def cut(n: int) -> str:
        return f"left(stem, length(stem) - {n})"

    def has(pattern: str, text: str) -> str:
        return f"regexp_matches({text}, '{pattern}')"

    def chain(rules, condition=None) -> str:
        out = []
        for old, new in rules:
            value = f"{cut(len(old))} || '{new}'"
            if condition:
                value = f"CASE WHEN {has(condition, cut(len(old)))} THEN {value} ELSE stem END"
            out.append(f"WHEN stem LIKE '%{old}' THEN {value}")
        return f"CASE {' '.join(out)} ELSE stem END"

    s = stemming
    rest = f"CASE WHEN stem LIKE '%ed' THEN {cut(2)} WHEN stem LIKE '%ing' THEN {cut(3)} END"
    bare = "substr(stem, 2)"
    last = []
    for suffix in s.LAST:
        allowed = has(s.MANY, cut(len(suffix)))
        if suffix == "ion":
            allowed += " AND " + has("[st]$", cut(3))
        last.append(f"WHEN stem LIKE '%{suffix}' THEN CASE WHEN {allowed} THEN {cut(len(suffix))} ELSE stem END")
    steps = [
        f"CASE WHEN stem LIKE '%ies' AND length(stem) = 4 THEN {cut(1)} ELSE {chain(s.PLURAL)} END",
        f"CASE WHEN stem LIKE '%ied' THEN CASE WHEN length(stem) = 4 THEN {cut(1)} ELSE {cut(2)} END "
        f"WHEN stem LIKE '%eed' THEN CASE WHEN {has(s.SOME, cut(3))} THEN {cut(1)} ELSE stem END "
        f"WHEN {has(s.VOWEL, rest)} THEN '+' || ({rest}) ELSE stem END",
        f"CASE WHEN stem NOT LIKE '+%' THEN stem WHEN {has('(at|bl|iz)$', bare)} THEN {bare} || 'e' "
        f"WHEN length(stem) > 2 AND right(stem, 1) = left(right(stem, 2), 1) AND right(stem, 1) NOT IN ('a','e','i','o','u') "
        f"THEN CASE WHEN right(stem, 1) IN ('l', 's', 'z') THEN {bare} ELSE left({bare}, length(stem) - 2) END "
        f"WHEN {has(s.ONE, bare)} AND {has(s.SHORT, bare)} THEN {bare} || 'e' ELSE {bare} END",
        f"CASE WHEN stem LIKE '%y' AND length(stem) > 2 AND ({has('[^aeiouy]$', cut(1))} OR {has('[aeiou]y$', cut(1))}) "
        f"THEN {cut(1)} || 'i' ELSE stem END",
        f"CASE WHEN stem LIKE '%alli' AND {has(s.SOME, cut(4))} THEN {cut(2)} ELSE stem END",
        f"CASE WHEN stem LIKE '%logi' THEN CASE WHEN {has(s.SOME, cut(3))} THEN {cut(1)} ELSE stem END "
        f"ELSE {chain(s.DOUBLE, s.SOME)} END",
        chain(s.DERIVED, s.SOME),
        f"CASE {' '.join(last)} ELSE stem END",
        f"CASE WHEN stem LIKE '%e' AND ({has(s.MANY, cut(1))} OR ({has(s.ONE, cut(1))} AND NOT {has(s.SHORT, cut(1))})) "
        f"THEN {cut(1)} ELSE stem END",
        f"CASE WHEN stem LIKE '%ll' AND {has(s.MANY, cut(1))} THEN {cut(1)} ELSE stem END",
    ]
    ctes = [f"words AS (SELECT DISTINCT unnest({_LIST}) AS word FROM documents)",
            "p0 AS (SELECT word, regexp_replace(word, '^y', 'Y') AS stem FROM words)"]
    for i, step in enumerate(steps):
        ctes.append(f"p{i + 1} AS MATERIALIZED (SELECT word, CASE WHEN stem <> '' THEN {step} ELSE stem END AS stem FROM p{i})")
    own = " ".join(f"WHEN '{w}' THEN '{t}'" for w, t in s.IRREGULAR.items())
    return f"""WITH {', '.join(ctes)} SELECT word, CASE word {own}
        ELSE CASE WHEN length(word) <= 2 THEN word ELSE lower(stem) END END AS stem FROM p{len(steps)}"""


_TRIPLES = f"""WITH l AS (SELECT role, {_LIST} AS ws FROM conversations),
t AS (SELECT role, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3 FROM l, unnest(range(1, len(ws) - 1)) u(i)),
g AS (SELECT w1, w2, w3, count(*) AS c FROM t WHERE role = 'assistant' GROUP BY ALL),
asked AS (SELECT DISTINCT w1, w2, w3 FROM t WHERE role IN ('user', 'assistant')),
pairs AS (SELECT w1, w2, sum(c) AS n, count(*) AS a FROM g GROUP BY ALL),
bef AS (SELECT w2, w3, count(*) AS b FROM g GROUP BY ALL),
hold AS (SELECT w2, count(*) AS h FROM g GROUP BY ALL)"""

SQL = {
    "maxent_confusion": maxent_sql(_LIST, MAXENT_ROUNDS),
    "tree_confusion": tree_sql(_LIST, TREE_DEPTH, TREE_SUPPORT),
    "clusters_mixture": mixture_sql(MIXTURE_PARTS, MIXTURE_ROUNDS, 0.01),
    "clusters_hierarchical": linkage_sql(MICRO_CLUSTERS, MICRO_ROUNDS, 10),
    "dendrogram": dendrogram_sql(MICRO_CLUSTERS, MICRO_ROUNDS),
    "porter_stems": _porter_sql(),
    "swap_distances": f"""WITH l AS (SELECT {_LIST} AS ws FROM conversations),
        pairs AS (SELECT DISTINCT ws[i] AS w1, ws[i + 1] AS w2 FROM l, unnest(range(1, len(ws))) t(i))
        SELECT w1, w2, damerau_levenshtein({_bytes('w1')}, {_bytes('w2')}) AS edit FROM pairs""",
    "trigram_discount": f"""{_TRIPLES} SELECT w1, w2, w3, round(CASE WHEN c IS NOT NULL THEN (c - 0.75::DOUBLE) / n
          WHEN n IS NOT NULL AND b IS NOT NULL THEN CASE WHEN h - a > 0 THEN a * 0.75::DOUBLE / n * (b / (h - a)::DOUBLE) END
          ELSE 0.0 END, 9) AS p
        FROM asked LEFT JOIN g USING (w1, w2, w3) LEFT JOIN pairs USING (w1, w2) LEFT JOIN bef USING (w2, w3)
        LEFT JOIN hold USING (w2)""",
    "lm_scores": f"{_lm_sql(2)} SELECT w1, w2, CAST(n AS BIGINT) AS n, {_R9} FROM scored",
    "lm_trigram_scores": f"{_lm_sql(3)} SELECT w1, w2, w3, CAST(n AS BIGINT) AS n, {_R9} FROM scored",
    "lm_perplexity": f"""{_lm_sql(2)}, bits AS ({' UNION ALL '.join(
        f"SELECT '{m}' AS model, sum(CAST(-log2({m}) * n AS DECIMAL(28,10)))::DOUBLE / sum(n) AS e FROM scored" for m in MODELS)})
        SELECT model, round(e, 6) AS entropy, round(pow(2.0, e), 4) AS perplexity FROM bits""",
    "corpus_bleu": f"""{_PAIRS}, hg AS {_grams('hyps', 'pair', 4)}, rg AS {_grams('refs', 'pair, ref', 4)},
        best AS (SELECT pair, n, gram, max(c) AS c FROM rg GROUP BY ALL),
        hits AS (SELECT n, sum(least(h.c, b.c)) AS hit FROM hg h JOIN best b USING (pair, n, gram) GROUP BY n),
        totals AS (SELECT n, sum(greatest(len(ws) - n + 1, 1)) AS total FROM hyps CROSS JOIN {_totals(4)} GROUP BY n),
        closest AS (SELECT sum(h) AS h, sum(r) AS r FROM (SELECT h.pair, len(h.ws) AS h,
            arg_min(len(r.ws), abs(len(r.ws) - len(h.ws)) * 1000000 + len(r.ws)) AS r FROM hyps h JOIN refs r USING (pair) GROUP BY ALL))
        SELECT round(CASE WHEN any_value(h) > any_value(r) THEN 1.0 ELSE exp(1 - any_value(r) / any_value(h)::DOUBLE) END
               * exp(sum(ln(CASE WHEN hit > 0 THEN hit / total::DOUBLE ELSE 2.2250738585072014e-308 END)) / 4), 9) AS bleu
        FROM totals LEFT JOIN hits USING (n) CROSS JOIN closest""",
    "corpus_gleu": f"""{_PAIRS}, hg AS {_grams('hyps', 'pair', 4)}, rg AS {_grams('refs', 'pair, ref', 4)},
        hits AS (SELECT pair, ref, sum(least(h.c, r.c)) AS hit FROM hg h JOIN rg r USING (pair, n, gram) GROUP BY ALL),
        sizes AS (SELECT pair, ref, greatest(a, b) AS n_all FROM (
            SELECT r.pair, r.ref, {' + '.join(f'greatest(len(r.ws) - {n - 1}, 0)' for n in range(1, 5))} AS a,
                   {' + '.join(f'greatest(len(h.ws) - {n - 1}, 0)' for n in range(1, 5))} AS b FROM refs r JOIN hyps h USING (pair))),
        best AS (SELECT pair, coalesce(hit, 0) AS hit, n_all FROM sizes LEFT JOIN hits USING (pair, ref) WHERE n_all > 0
                 QUALIFY row_number() OVER (PARTITION BY pair ORDER BY coalesce(hit, 0) / n_all::DOUBLE DESC, n_all) = 1)
        SELECT round(sum(hit) / sum(n_all)::DOUBLE, 9) AS gleu FROM best""",
    "corpus_chrf": _CHRF,
    "corpus_nist": f"""{_PAIRS}, hg AS {_grams('hyps', 'pair', 5)}, rg AS {_grams('refs', 'pair, ref', 5)},
        freq AS (SELECT n, gram, sum(c) AS f FROM rg GROUP BY ALL),
        nw AS (SELECT sum(len(ws)) AS words FROM refs),
        info AS (SELECT a.n, a.gram, log2(coalesce(b.f, words) / a.f::DOUBLE) AS info FROM freq a CROSS JOIN nw
                 LEFT JOIN freq b ON b.n = a.n - 1 AND b.gram = regexp_replace(a.gram, ' [^ ]*$', '')),
        nums AS (SELECT pair, ref, n, sum(CAST(info * least(h.c, r.c) AS DECIMAL(28,10))) AS num
                 FROM hg h JOIN rg r USING (pair, n, gram) JOIN info USING (n, gram) GROUP BY ALL),
        grid AS (SELECT r.pair, r.ref, n, len(r.ws) AS r, len(h.ws) AS h, greatest(len(h.ws) - n + 1, 0) AS den
                 FROM refs r JOIN hyps h USING (pair) CROSS JOIN {_totals(5)}),
        scored AS (SELECT g.*, coalesce(num, 0) AS num, CASE WHEN den > 0 THEN coalesce(num, 0)::DOUBLE / den ELSE 0 END AS p
                   FROM grid g LEFT JOIN nums USING (pair, ref, n)),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY pair, n ORDER BY p DESC, num DESC, den DESC, r DESC) = 1),
        byn AS (SELECT n, sum(num)::DOUBLE / sum(den) AS p, sum(r) AS r, sum(h) AS h FROM best GROUP BY n),
        one AS (SELECT sum(p) AS s, sum(h) / sum(r)::DOUBLE AS ratio FROM byn)
        SELECT round(s * CASE WHEN ratio > 0 AND ratio < 1 THEN exp(ln(0.5) / (ln(1.5) ** 2) * ln(ratio) ** 2)
               ELSE greatest(least(ratio, 1.0), 0.0) END, 7) AS nist FROM one""",
    "annotator_pairs": f"""{_ANNOTATIONS} SELECT coder_a, coder_b, round(ao, 9) AS ao, round(ae, 9) AS ae,
        round(kappa, 9) AS kappa, round(weighted_kappa, 9) AS weighted_kappa FROM pairs""",
    "annotator_agreement": f"""{_ANNOTATIONS} SELECT round(ao, 9) AS avg_ao, round((ao - 1.0::DOUBLE / k_) / (1 - 1.0::DOUBLE / k_), 9) AS s,
        round((ao - sq / (i * 3) ** 2) / (1 - sq / (i * 3) ** 2), 9) AS pi, round(k, 9) AS kappa,
        round((ao - ae) / (1 - ae), 9) AS multi_kappa, round(wk, 9) AS weighted_kappa,
        round(1 - d_o / ((m * m - sq) / (m * (m - 1))), 9) AS alpha
        FROM (SELECT ao, ae, avgs.k AS k, wk, pic.k AS k_, sq, m, i, d_o FROM avgs, pic, items, within)""",
    "rank_correlation": f"""WITH a AS (SELECT term, rank() OVER (ORDER BY n DESC) - 1 AS r FROM (
          SELECT unnest({_LIST}) AS term, count(*) AS n FROM documents GROUP BY 1)),
        b AS (SELECT term, rank() OVER (ORDER BY n DESC) - 1 AS r FROM (
          SELECT unnest({_LIST}) AS term, count(*) AS n FROM conversations GROUP BY 1)),
        s AS (SELECT sum((a.r - b.r) * (a.r - b.r))::DOUBLE AS d, count(*)::DOUBLE AS n FROM a JOIN b USING (term))
        SELECT round(1 - 6 * d / (n * (n * n - 1)), 9) AS rho FROM s""",
    "label_scores": """WITH c AS (SELECT count(*) FILTER (quality = 1) AS r, count(*) FILTER (toxic = 0) AS t,
          count(*) FILTER (quality = 1 AND toxic = 0) AS b, count(*) FILTER ((quality = 1) = (toxic = 0)) AS s, count(*) AS n FROM labels)
        SELECT round(b / t::DOUBLE, 9) AS precision, round(b / r::DOUBLE, 9) AS recall,
               round(1 / (0.4 / (b / t::DOUBLE) + 0.6 / (b / r::DOUBLE)), 9) AS f, round(s / n::DOUBLE, 9) AS accuracy FROM c""",
    "language_profiles": f"WITH {_TRI} SELECT language, trigram, CAST(rank AS INTEGER) AS rank FROM profile",
    "langid": f"WITH {_TRI} SELECT doc_id, guess FROM guess",
    "confusion": f"WITH {_TRI} SELECT lang, guess, count(*) AS n FROM judged GROUP BY ALL",
    "class_scores": f"""WITH {_TRI}, names AS (SELECT lang AS class FROM judged UNION SELECT guess FROM judged),
        c AS (SELECT class, CAST((SELECT count(*) FROM judged WHERE lang = class AND guess = class) AS BIGINT) AS tp,
                     CAST((SELECT count(*) FROM judged WHERE lang = class) AS BIGINT) AS support,
                     CAST((SELECT count(*) FROM judged WHERE guess = class) AS BIGINT) AS predicted FROM names),
        p AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted::DOUBLE ELSE 0.0 END AS precision,
                        CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0.0 END AS recall FROM c)
        SELECT class, tp, support, predicted, round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 9) AS f1 FROM p""",
    "word_distances": f"""{_NEIGHBOURS} SELECT w1, w2, levenshtein({_bytes('w1')}, {_bytes('w2')}) AS edit,
        CASE WHEN w1 = w2 THEN 0.0 ELSE 1.0 END::DOUBLE AS different, round((n_either - n_both) / n_either::DOUBLE, 9) AS jaccard,
        round(1 - n_both / n_either::DOUBLE * CASE WHEN na = nb AND na = n_both THEN 1.0 WHEN n_both = least(na, nb) THEN 0.67
              WHEN n_both > 0 THEN 0.33 ELSE 0.0 END, 9) AS masi FROM sizes""",
    "word_similarities": f"""{_NEIGHBOURS} SELECT w1, w2, round(j, 9) AS jaro, round(j + l * 0.1::DOUBLE * (1 - j), 9) AS jaro_winkler
        FROM (SELECT *, CASE WHEN length(w1) = 1 AND length(w2) = 1 THEN 0.0::DOUBLE
                ELSE jaro_similarity({_bytes('w1')}, {_bytes('w2')}) END AS j, CASE
                WHEN length(w1) >= 4 AND left(w2, 4) = left(w1, 4) THEN 4 WHEN length(w1) >= 3 AND left(w2, 3) = left(w1, 3) THEN 3
                WHEN length(w1) >= 2 AND left(w2, 2) = left(w1, 2) THEN 2 WHEN left(w2, 1) = left(w1, 1) THEN 1 ELSE 0 END AS l
              FROM sizes)""",
    "regexp_stems": f"""SELECT DISTINCT word, CASE WHEN length(word) < 4 THEN word
        ELSE regexp_replace(word, 'ing$|s$|e$|able$', '', 'g') END AS stem
        FROM (SELECT unnest({_LIST}) AS word FROM documents)""",
    "naive_bayes_model": f"{_BAYES} SELECT term, lang, round(log_p, 9) AS log_p FROM model",
    "naive_bayes": f"""{_BAYES}, s AS (SELECT doc_id, m.lang, sum(CAST(log_p AS DECIMAL(28,10))) AS s
          FROM present p JOIN model m USING (term) GROUP BY ALL),
        f AS (SELECT doc_id, s.lang, s + CAST(log2((n + 0.5::DOUBLE) / (nn + k * 0.5::DOUBLE)) AS DECIMAL(28,10)) AS score
              FROM s JOIN sizes USING (lang) CROSS JOIN total),
        best AS (SELECT doc_id, lang FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)
        SELECT doc_id, coalesce(best.lang, (SELECT lang FROM sizes ORDER BY n DESC, lang LIMIT 1)) AS predicted
        FROM documents LEFT JOIN best USING (doc_id)""",
    "event_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "event_entities": """SELECT event_id, CAST(event_id AS VARCHAR) AS id, event_type AS type_name
        FROM events, unnest([1, 2]) t(i)""",
}
