"""Registered queries: sentences, words, tags, lemmas and whole normalised reviews."""

import uuid

from pyspark.sql import functions as F

from gleanery.functions import words as w
from gleanery.functions.messages import message_tokens
from gleanery.functions.tokenize import letter_words
from gleanery.operators import normalize, sentence_ends, tagging, word_blocks
from gleanery.operators.moderation import deduplicated, with_review_id
from gleanery.plans.inputs import STOP_WORDS, small_frame, sql_list, stop_words
from gleanery.schemas import DOCUMENT
from gleanery.sources.arrivals import stream_table
from gleanery.sources.tables import ensure_checkpoint_dir, review_view, shared_dir, table
from gleanery.streaming import review_stream

# Irregular forms for the test corpus.
EXCEPTIONS = [("thes", "n", "the"), ("ands", "n", "and"), ("ising", "v", "is")]
ARTICLES = ["the", "la", "le", "der", "de"]
MIN_LEMMA_DF = 3


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def sentence_split(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.posexplode(w.sentences(F.col("text"))).alias("pos", "sentence")
    )


def abbreviations(spark, sf_dir):
    """Abbreviations that the documents show by their full stops."""
    found = sentence_ends.abbreviations(sentence_ends.word_ends(_documents(spark, sf_dir)))
    return found.withColumn("score", F.round("score", 6))


def learned_sentences(spark, sf_dir):
    """Sentences, cut with the abbreviations that the documents show."""
    docs = _documents(spark, sf_dir)
    return sentence_ends.split(docs, sentence_ends.abbreviations(sentence_ends.word_ends(docs)))


def word_tokens(spark, sf_dir):
    return normalize.token_rows(_documents(spark, sf_dir), "doc_id")


def delimiter_tokens(spark, sf_dir):
    """How many tokens each of the plain tokenisers finds."""
    t = F.col("text")
    counts = {
        "word_punct": w.word_punct_tokens(t),
        "blank_line": w.blank_line_tokens(t),
        "white_space": w.white_space_tokens(t),
        "line": w.line_tokens(t),
        "space": w.space_tokens(t),
        "tab": w.tab_tokens(t),
    }
    return _documents(spark, sf_dir).select(
        "doc_id", *[F.size(c).cast("long").alias(f"n_{name}") for name, c in counts.items()]
    )


def message_token_counts(spark, sf_dir):
    """Frequencies of the tokens of the conversations, read as short messages."""
    turns = table(spark, sf_dir, "conversations")
    tokens = message_tokens(F.col("text"), preserve_case=False)
    return turns.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def merged_expressions(spark, sf_dir):
    """Listed word groups as single tokens."""
    tokens = w.merge_expressions(letter_words(F.col("text")), [["of", "the"], ["in", "the"], ["de", "la"]])
    rows = _documents(spark, sf_dir).select("doc_id", F.explode(tokens).alias("token"))
    return rows.where(F.col("token").contains("_")).groupBy("doc_id", "token").agg(F.count("*").alias("n"))


def _ending(word):
    """The tag that a word's ending gives it."""
    return (
        F.when(word.endswith("ly"), "RB")
        .when(word.endswith("ed") | word.endswith("en"), "VB")
        .when(word.endswith("le") | word.endswith("er"), "JJ")
        .otherwise("NN")
    )


def _tagged(spark, sf_dir):
    """A tagged corpus derived from the texts: endings decide, but never after an article."""
    return _tagged_texts(_documents(spark, sf_dir))


def _tagged_texts(docs):
    lists = docs.select("doc_id", letter_words(F.col("text")).alias("ws"))
    # Slices side by side, which generated code builds; a lambda would be interpreted at every word.
    earlier = F.concat(F.array(F.lit(None).cast("string")), F.slice("ws", 1, F.greatest(F.size("ws") - 1, F.lit(0))))
    spots = F.arrays_zip(F.col("ws").alias("word"), F.when(F.size("ws") > 0, earlier).otherwise(F.col("ws")).alias("before"))
    ending = F.when(F.coalesce("before", F.lit("")).isin(ARTICLES), "NN").otherwise(_ending(F.col("word")))
    placed = lists.select("doc_id", F.posexplode(spots.cast("array<struct<word:string,before:string>>")).alias("pos", "spot"))
    return placed.select("doc_id", "pos", "spot.*").select("doc_id", "pos", "word", ending.alias("tag"))


def tag_model(spark, sf_dir):
    return tagging.train_unigram(_tagged(spark, sf_dir), cutoff=1)


def affix_tag_model(spark, sf_dir):
    return tagging.train_affix(_tagged(spark, sf_dir), cutoff=1)


def bigram_tag_model(spark, sf_dir):
    tagged = _tagged(spark, sf_dir)
    unigram = tagging.train_unigram(tagged, cutoff=1)
    return tagging.train_bigram(tagged, ["doc_id", "pos"], unigram, cutoff=1)


def tagged_words(spark, sf_dir):
    """Turns of the conversations tagged by the models of the documents."""
    tagged = _tagged(spark, sf_dir)
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(letter_words(F.col("text"))).alias("pos", "word")
    )
    return tagging.tag_words(
        rows, tagging.train_unigram(tagged, cutoff=1), tagging.train_affix(tagged, cutoff=1)
    )


def tagged_sequences(spark, sf_dir):
    """Left-to-right tagging of the conversations by (previous tag, word)."""
    tagged = _tagged(spark, sf_dir)
    unigram = tagging.train_unigram(tagged, cutoff=1)
    bigram = tagging.train_bigram(tagged, ["doc_id", "pos"], unigram, cutoff=1)
    rows = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"),
        F.posexplode(letter_words(F.col("text"))).alias("pos", "word"),
    )
    return tagging.tag_sequences(rows, "turn_id", bigram, unigram).select(
        "turn_id", F.array_join("tags", " ").alias("tags")
    )


def _word_tables(docs):
    """Of the tagged corpus: (word, tag, times), and (word, pos, df) with the documents that have a word in a class."""
    ensure_checkpoint_dir(docs.sparkSession)
    counts = word_blocks.counts_after(word_blocks.unstored(docs, letter_words(F.col("text"))), ARTICLES).checkpoint()
    ending = _ending(F.col("word"))
    pos, noun = tagging.word_class(ending), F.lit("n")
    tags = [F.struct(ending.alias("tag"), (F.col("n") - F.col("n_after")).alias("times")), F.struct(F.lit("NN").alias("tag"), F.col("n_after").alias("times"))]
    dfs = [
        F.struct(pos.alias("pos"), F.when(pos == noun, F.col("texts")).otherwise(F.col("texts_other")).alias("df")),
        F.struct(noun.alias("pos"), F.when(pos == noun, 0).otherwise(F.col("texts_after")).alias("df")),
    ]
    return counts.select("word", F.inline(F.array(*tags))).where("times > 0"), counts.select("word", F.inline(F.array(*dfs))).where("df > 0")


def _models(spark, sf_dir):
    """Tag model, lemma table and exceptions, all learned from or listed for the given texts."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if again.isEmpty():
        tags, in_documents = _word_tables(docs)
    else:
        # Rows of one id are one document.
        same = docs["doc_id"].eqNullSafe(again["doc_id"])
        tags, in_documents = _word_tables(docs.join(again, same, "left_anti"))
        shared = _tagged_texts(docs.join(again, same, "left_semi"))
        distinct = shared.select("doc_id", "word", tagging.word_class(F.col("tag")).alias("pos")).distinct()
        tags = tags.unionByName(shared.groupBy("word", "tag").agg(F.count("*").alias("times")))
        in_documents = in_documents.unionByName(distinct.groupBy("word", "pos").agg(F.count("*").alias("df")))
    known = in_documents.groupBy(F.col("word").alias("lemma"), "pos").agg(F.sum("df").alias("df"))
    words, classes, lemmas = zip(*EXCEPTIONS)
    return {
        "tag_model": tagging.train_unigram(tags, cutoff=1, times="times"),
        "lemma_table": known.where(F.col("df") >= MIN_LEMMA_DF).select("lemma", "pos"),
        "exceptions": small_frame(spark, word=list(words), pos=list(classes), lemma=list(lemmas)),
        "stop_words": stop_words(spark),
    }


def lemma_forms(spark, sf_dir):
    models = _models(spark, sf_dir)
    tagged = _tagged(spark, sf_dir)
    forms = tagged.select("word", tagging.word_class(F.col("tag")).alias("pos")).distinct()
    return normalize.lemmas(forms, models["lemma_table"], models["exceptions"])


def normalized_reviews(spark, sf_dir):
    done = normalize.normalized(_documents(spark, sf_dir), "doc_id", **_models(spark, sf_dir))
    return done.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def processed_reviews(spark, sf_dir):
    """Reviews enriched with their tokens; every input column stays."""
    rows = with_review_id(review_view(_documents(spark, sf_dir)))
    done = normalize.processed(rows, **_models(spark, sf_dir))
    return done.select("reviewId", "category", "overall", F.array_join("tokens", " ").alias("tokens"))


def stream_processed_reviews(spark, sf_dir):
    """Arriving reviews -> processed reviews as JSON, one folder per micro-batch."""
    work = f"{shared_dir(spark)}/processed-{uuid.uuid4().hex}"
    documents = stream_table(spark, f"{sf_dir}/documents.parquet*", DOCUMENT)
    arriving = with_review_id(review_view(documents))
    models = _models(spark, sf_dir)

    def enrich(batch, batch_id):
        rows = normalize.processed(deduplicated(batch), **models)
        rows.write.mode("overwrite").json(f"{work}/processed/batch={batch_id}", compression="gzip")

    review_stream.run_available(review_stream.start_batches(arriving, f"{work}/cp", enrich))
    schema = "reviewId string, category string, overall double, tokens array<string>"
    done = spark.read.schema(schema).json(f"{work}/processed")
    return done.select("reviewId", "category", "overall", F.array_join("tokens", " ").alias("tokens"))


QUERIES = {
    "processed_reviews": processed_reviews,
    "stream_processed_reviews": stream_processed_reviews,
    "sentence_split": sentence_split,
    "abbreviations": abbreviations,
    "learned_sentences": learned_sentences,
    "word_tokens": word_tokens,
    "delimiter_tokens": delimiter_tokens,
    "message_token_counts": message_token_counts,
    "merged_expressions": merged_expressions,
    "tag_model": tag_model,
    "affix_tag_model": affix_tag_model,
    "bigram_tag_model": bigram_tag_model,
    "tagged_words": tagged_words,
    "tagged_sequences": tagged_sequences,
    "lemma_forms": lemma_forms,
    "normalized_reviews": normalized_reviews,
}

_SHORT = "|".join(a.replace(".", "\\.") for a in w.ABBREVIATIONS)
_SPACE = "[\\x1c-\\x1f\\x0b\\x85\\s\\p{Z}]"
_CLOSERS = "[\"''”’)\\]]*"
_SENTENCES = f"""list_filter(list_transform(string_split(
   regexp_replace(regexp_replace(text, '(?i)(^|[^\\p{{L}}])({_SHORT})\\.', '\\1\\2' || chr(29), 'g'),
                  '([.!?]{_CLOSERS}){_SPACE}+', '\\1' || chr(30), 'g'), chr(30)),
   lambda s: trim(replace(s, chr(29), '.'), ' ')), lambda s: s <> '')"""

_ABBREVIATIONS = f"""WITH runs AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}[\\p{{L}}.]*')) AS run FROM documents),
ends AS (SELECT rtrim(run, '.') AS word, count(*) FILTER (regexp_matches(run, '[^.]\\.$')) AS with_stop,
    count(*) FILTER (NOT regexp_matches(run, '[^.]\\.$')) AS without_stop FROM runs GROUP BY 1),
whole AS (SELECT sum(with_stop)::DOUBLE / sum(with_stop + without_stop) AS p FROM ends),
weighed AS (SELECT word, with_stop, without_stop, len(word) - len(replace(word, '.', '')) AS stops, len(replace(word, '.', '')) AS letters,
    with_stop * ln(p) + without_stop * ln(1 - p + 1e-8::DOUBLE) AS by_chance,
    with_stop * ln(0.99::DOUBLE) + without_stop * ln(1 - 0.99::DOUBLE + 1e-8::DOUBLE) AS by_word FROM ends, whole WHERE with_stop > 0),
scored AS (SELECT *, -2 * (by_chance - by_word) * exp(-letters::DOUBLE) * (stops + 1) * pow(letters::DOUBLE, -without_stop::DOUBLE) AS score FROM weighed),
known AS (SELECT word, with_stop, without_stop, score FROM scored WHERE score >= 0.3)"""

# RE2 has no lookahead and no Unicode \w or \b, so those rewrites are spelled out.
_W = "[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]"
_NOT_W = "[^\\p{L}\\p{M}\\p{Nd}\\p{Pc}]"


def _sql_rules() -> list[tuple[str, str]]:
    single = "(?i)('')([^mtsdn\\P{L}]|[\\p{Nd}_])($|" + _NOT_W + ")"
    rules = [
        ("([«“‘„]|[`]+)", " \\1 "), ('^"', "``"), ("(``)", " \\1 "),
        ("([ (\\[{<])(\"|''{2})", "\\1 `` "), (single, "\\1 \\2\\3"),
        (f"([^.])(\\.)([\\])}}>\"''»”’ ]*){_SPACE}*$", "\\1 \\2 \\3 "),
        ("([:,])([^\\p{Nd}])", " \\1 \\2"), ("([:,])$", " \\1 "), ("(\\.{2,})", " \\1 "),
        ("([;@#$%&])", " \\1 "), (f"([^.])(\\.)([\\])}}>\"'']*){_SPACE}*$", "\\1 \\2\\3 "),
        ("([?!])", " \\1 "), ("([^''])'' ", "\\1 '' "), ("([*])", " \\1 "),
        ("([\\]\\[(){}<>])", " \\1 "), ("--", " -- "),
        ("^", " "), ("$", " "),
        ("([»”’])", " \\1 "), ("''''", " '''' "), ('"', " '''' "), (f"{_SPACE}+", " "),
        ("([^'' ])(''[sS]|''[mM]|''[dD]|'') ", "\\1 \\2 "),
        ("([^'' ])(''ll|''LL|''re|''RE|''ve|''VE|n''t|N''T) ", "\\1 \\2 "),
    ]
    for a, b in [("can", "not"), ("d", "''ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"),
                 ("more", "''n")]:
        rules.append((f"(?i)(^|{_NOT_W})({a})({b})($|{_NOT_W})", "\\1 \\2 \\3 \\4"))
    rules.append((f"(?i)(^|{_NOT_W})(wan)(na)({_SPACE})", "\\1 \\2 \\3 \\4"))
    for b in ("is", "was"):
        rules.append((f"(?i) (''t)({b})($|{_NOT_W})", " \\1 \\2 \\3"))
    return rules


def _sql_words(sentence: str) -> str:
    text = sentence
    for pattern, replacement in _sql_rules():
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"list_filter(string_split_regex({text}, '{_SPACE}+'), lambda t: t <> '')"


_LETTERS = "list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')"
_TOKENS = f"""sents AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents),
lists AS (SELECT doc_id, flatten(list_transform(ss, lambda s: {_sql_words('s')})) AS ws FROM sents),
tokens AS (SELECT doc_id, unnest(ws) AS token, CAST(unnest(range(len(ws))) AS INTEGER) AS pos FROM lists)"""
_ARTICLES = sql_list(ARTICLES)
_TAGGED = f"""words AS (SELECT doc_id, unnest({_LETTERS}) AS word, unnest(range(len({_LETTERS}))) AS pos FROM documents),
tagged AS (SELECT *, CASE WHEN lag(word) OVER (PARTITION BY doc_id ORDER BY pos) IN ({_ARTICLES}) THEN 'NN'
      WHEN word LIKE '%ly' THEN 'RB' WHEN word LIKE '%ed' OR word LIKE '%en' THEN 'VB'
      WHEN word LIKE '%le' OR word LIKE '%er' THEN 'JJ' ELSE 'NN' END AS tag FROM words),
unigram AS (SELECT word, tag, n FROM (SELECT word, tag, count(*) AS n FROM tagged GROUP BY word, tag)
            QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, tag) = 1),
model AS (SELECT * FROM unigram WHERE n > 1),
affixed AS (SELECT right(word, 3) AS affix, tag FROM tagged WHERE length(word) >= 5),
affixes AS (SELECT affix, tag, n FROM (
              SELECT affix, tag, n FROM (SELECT affix, tag, count(*) AS n FROM affixed GROUP BY affix, tag)
              QUALIFY row_number() OVER (PARTITION BY affix ORDER BY n DESC, tag) = 1) WHERE n > 1),
classed AS (SELECT *, CASE left(tag, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' ELSE 'n' END AS class
            FROM tagged),
known AS (SELECT word AS lemma, class FROM classed GROUP BY word, class HAVING count(DISTINCT doc_id) >= {MIN_LEMMA_DF})"""


def _candidates() -> str:
    parts = []
    for pos, rules in normalize.SUFFIXES.items():
        for place, (old, new) in enumerate(rules, 1):
            parts.append(
                f"SELECT word, class, {place} AS place, left(word, length(word) - {len(old)}) || '{new}' AS lemma "
                f"FROM forms WHERE class = '{pos}' AND word LIKE '%{old}' "
                "AND (word, class) NOT IN (SELECT word, class FROM exceptions)"
            )
    return " UNION ALL ".join(parts)


_LEMMAS = f"""exceptions(word, class, lemma) AS (VALUES {', '.join(str(e) for e in EXCEPTIONS)}),
candidates AS MATERIALIZED (SELECT word, class, 0 AS place, word AS lemma FROM forms UNION ALL
  SELECT f.word, f.class, 1, e.lemma FROM forms f JOIN exceptions e ON f.word = e.word AND f.class = e.class UNION ALL
  {_candidates()}),
best AS MATERIALIZED (SELECT word, class, lemma FROM candidates JOIN known USING (lemma, class)
         QUALIFY row_number() OVER (PARTITION BY word, class ORDER BY length(lemma), place) = 1),
lemma_of AS (SELECT f.word, f.class, coalesce(b.lemma, f.word) AS lemma FROM forms f
             LEFT JOIN best b ON f.word = b.word AND f.class = b.class)"""

_NORMAL = f"""kept AS (SELECT doc_id, pos, token, lower(token) AS word FROM tokens
  WHERE regexp_full_match(token, '\\p{{L}}+') AND lower(token) NOT IN ({sql_list(STOP_WORDS)})),
placed AS (SELECT k.*, CASE left(coalesce(m.tag, 'NN'), 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r'
           ELSE 'n' END AS class FROM kept k LEFT JOIN model m ON m.word = k.token),
forms AS MATERIALIZED (SELECT DISTINCT word, class FROM placed), {_LEMMAS},
normal AS (SELECT d.doc_id, coalesce(t.tokens, '') AS tokens FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS tokens FROM placed p
  JOIN lemma_of l ON p.word = l.word AND p.class = l.class GROUP BY doc_id) t USING (doc_id))"""
_MERGED = _TOKENS.replace(
    "FROM documents)", "FROM (SELECT doc_id, split_part(text, chr(10), 1) || ' ' || text AS text FROM documents))", 1
)
_PROCESSED = f"""WITH {_TAGGED}, {_MERGED}, {_NORMAL}
SELECT printf('devset-%06d', doc_id) AS reviewId, source AS category, CAST(1 + doc_id % 5 AS DOUBLE) AS overall, tokens
FROM normal JOIN documents USING (doc_id)"""



def _message_sql() -> str:
    """The same kinds of token for RE2, whose classes are ASCII and which has no back-references."""
    word, letter, digit = "[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]", "\\p{L}", "\\p{Nd}"
    blank = "\\s\\x0b\\x85\\p{Z}"
    mouth = "[)\\](\\[dDpP/:}{@|\\\\]"
    emoticon = f"(?:[<>]?[:;=8][\\-o*'']?{mouth}|{mouth}[\\-o*'']?[:;=8][<>]?|</?3)"
    inner = word[1:-1]
    kinds = [
        f"(?:https?:(?:/{{1,3}}|[a-z0-9%])|[a-z0-9.\\-]+[.][a-z]{{2,13}}/)[^{blank}()<>{{}}\\[\\]]+[^{blank}`!()\\[\\]{{}};:''\".,<>?«»“”‘’]",
        "[a-z0-9]+(?:[.\\-][a-z0-9]+)*[.][a-z]{2,13}\\b/?",
        f"(?:(?:\\+?[01][ *\\-.)]*)?(?:\\(?{digit}{{3}}[ *\\-.)]*)?{digit}{{3}}[ *\\-.)]*{digit}{{4}})",
        emoticon,
        f"<[^>{blank}]+>",
        "\\-+>|<\\-+",
        f"@{word}+",
        f"#+{word}+[{inner}''\\-]*{word}+",
        f"[{inner}.+\\-]+@[{inner}\\-]+\\.(?:[{inner}\\-]\\.?)+[{inner}\\-]",
        f"{letter}(?:{letter}|[''\\-_])+{letter}",
        f"[+\\-]?{digit}+[,/.:\\-]{digit}+[+\\-]?",
        f"{word}+",
        f"\\.(?:[{blank}]*\\.)+",
        f"[^{blank}]",
    ]
    text = "text"
    for entity, character in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        character = character.replace("'", "''")
        text = f"replace({text}, '{entity}', '{character}')"
    for mark in ["\\.", "!", "\\?", "\\*", "#", "-", "=", "_", "~", "%", " ", "\\n"]:
        plain = "chr(10)" if mark == "\\n" else "'" + mark.replace("\\", "") + "'"
        text = f"regexp_replace({text}, '{mark}{{4,}}', repeat({plain}, 3), 'g')"
    return f"""SELECT CASE WHEN regexp_matches(t, '(?i){emoticon}') THEN t ELSE lower(t) END AS token, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all({text}, '(?i){"|".join(kinds)}')) AS t FROM conversations) GROUP BY 1"""


SQL = {
    "message_token_counts": _message_sql(),
    "abbreviations": f"{_ABBREVIATIONS} SELECT word, with_stop, without_stop, round(score, 6) AS score FROM known",
    "learned_sentences": f"""{_ABBREVIATIONS},
        pieces AS (SELECT doc_id, string_split(regexp_replace(trim(coalesce(text, '')), '([.!?]{_CLOSERS}{_SPACE}+)', '\\1' || chr(30), 'g'), chr(30)) AS ps FROM documents),
        placed AS (SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS place FROM pieces),
        ended AS (SELECT *, regexp_extract(lower(piece), '(\\p{{L}}[\\p{{L}}.]*)\\.{_CLOSERS}{_SPACE}*$', 1) IN (SELECT word FROM known) AS open FROM placed),
        numbered AS (SELECT *, count(*) FILTER (NOT open) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM ended),
        glued AS (SELECT doc_id, k, regexp_replace(string_agg(piece, '' ORDER BY place), '{_SPACE}+$', '') AS sentence FROM numbered GROUP BY doc_id, k)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS pos, sentence FROM glued WHERE sentence <> ''""",
    "sentence_split": f"""WITH lists AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents)
        SELECT doc_id, unnest(ss) AS sentence, CAST(unnest(range(len(ss))) AS INTEGER) AS pos FROM lists""",
    "word_tokens": f"WITH {_TOKENS} SELECT doc_id, token, pos FROM tokens",
    "delimiter_tokens": f"""SELECT doc_id,
        len(regexp_extract_all(text, '{_W}+|(?:[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}\\x1c-\\x1f\\x0b\\x85\\s\\p{{Z}}]|[\\x1c-\\x1f])+')) AS n_word_punct,
        len(list_filter(string_split_regex(text, '[\\s\\x0b]*\\n[\\s\\x0b]*\\n[\\s\\x0b]*'), lambda t: t <> '')) AS n_blank_line,
        len(list_filter(string_split_regex(text, '{_SPACE}+'), lambda t: t <> '')) AS n_white_space,
        len(list_filter(string_split_regex(text, '\\r\\n|\\r|\\n'), lambda t: trim(t, ' ') <> '')) AS n_line,
        len(string_split(text, ' ')) AS n_space, len(string_split(text, chr(9))) AS n_tab FROM documents""",
    # Left to right: a pair starts at a word unless the pair before took that word.
    "merged_expressions": f"""WITH words AS (
          SELECT doc_id, unnest({_LETTERS}) AS word, unnest(range(len({_LETTERS}))) AS pos FROM documents),
        pairs AS (SELECT doc_id, word || '_' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS token FROM words)
        SELECT doc_id, token, count(*) AS n FROM pairs WHERE token IN ('of_the', 'in_the', 'de_la') GROUP BY doc_id, token""",
    "tag_model": f"WITH {_TAGGED} SELECT word, tag, n FROM model",
    "affix_tag_model": f"WITH {_TAGGED} SELECT affix, tag, n FROM affixes",
    "bigram_tag_model": f"""WITH {_TAGGED},
        events AS (SELECT word, tag, coalesce(lag(tag) OVER (PARTITION BY doc_id ORDER BY pos), '') AS previous FROM tagged),
        wrong AS (SELECT DISTINCT previous, e.word FROM events e LEFT JOIN model m ON e.word = m.word
                  WHERE e.tag <> coalesce(m.tag, 'NN')),
        best AS (SELECT previous, word, tag, n FROM (SELECT previous, word, tag, count(*) AS n FROM events GROUP BY ALL)
                 QUALIFY row_number() OVER (PARTITION BY previous, word ORDER BY n DESC, tag) = 1)
        SELECT previous, word, tag, n FROM best JOIN wrong USING (previous, word) WHERE n > 1""",
    "tagged_words": f"""WITH {_TAGGED},
        turns AS (SELECT conv_id, turn, unnest({_LETTERS}) AS word, CAST(unnest(range(len({_LETTERS}))) AS INTEGER) AS pos
                  FROM conversations)
        SELECT conv_id, turn, pos, t.word, coalesce(m.tag, a.tag, 'NN') AS tag FROM turns t
        LEFT JOIN model m ON t.word = m.word
        LEFT JOIN affixes a ON length(t.word) >= 5 AND right(t.word, 3) = a.affix""",
    "tagged_sequences": f"""WITH RECURSIVE {_TAGGED},
        events AS (SELECT word, tag, coalesce(lag(tag) OVER (PARTITION BY doc_id ORDER BY pos), '') AS previous FROM tagged),
        wrong AS (SELECT DISTINCT previous, e.word FROM events e LEFT JOIN model m ON e.word = m.word
                  WHERE e.tag <> coalesce(m.tag, 'NN')),
        best AS (SELECT previous, word, tag, n FROM (SELECT previous, word, tag, count(*) AS n FROM events GROUP BY ALL)
                 QUALIFY row_number() OVER (PARTITION BY previous, word ORDER BY n DESC, tag) = 1),
        pairs AS (SELECT previous, word, tag FROM best JOIN wrong USING (previous, word) WHERE n > 1),
        turns AS (SELECT conv_id || '-' || turn AS turn_id, unnest({_LETTERS}) AS word, unnest(range(len({_LETTERS}))) AS pos
                  FROM conversations),
        ready AS MATERIALIZED (SELECT turn_id, pos, t.word, coalesce(m.tag, 'NN') AS plain FROM turns t LEFT JOIN model m ON t.word = m.word),
        chain(turn_id, pos, tag) AS (
          SELECT r.turn_id, r.pos, coalesce(p.tag, plain) FROM ready r LEFT JOIN pairs p ON p.word = r.word AND p.previous = ''
          WHERE r.pos = 0
          UNION ALL
          SELECT r.turn_id, r.pos, coalesce(p.tag, plain) FROM chain c
          JOIN ready r ON r.turn_id = c.turn_id AND r.pos = c.pos + 1
          LEFT JOIN pairs p ON p.word = r.word AND p.previous = c.tag)
        SELECT turn_id, string_agg(tag, ' ' ORDER BY pos) AS tags FROM chain GROUP BY turn_id""",
    "lemma_forms": f"""WITH {_TAGGED}, forms AS MATERIALIZED (SELECT DISTINCT word, class FROM classed), {_LEMMAS}
        SELECT word, class AS pos, lemma FROM lemma_of""",
    "normalized_reviews": f"""WITH {_TAGGED}, {_TOKENS}, {_NORMAL}
        SELECT doc_id, tokens FROM normal""",
    "processed_reviews": _PROCESSED,
    "stream_processed_reviews": _PROCESSED,
}
