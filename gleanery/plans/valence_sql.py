"""The valence rules as SQL over the review view, and the rule lists both sides use."""

from gleanery.operators import valence as v
from gleanery.plans.inputs import (
    EXTRA_DAMPENERS,
    EXTRA_IDIOMS,
    EXTRA_NEGATIONS,
    EXTRA_STRENGTHENERS,
    MERGED_SQL,
    VALENCE,
    sql_list,
    sql_values,
)


def corpus_rules() -> v.Rules:
    return v.Rules(
        negations=v.NEGATIONS + EXTRA_NEGATIONS,
        strengtheners=v.STRENGTHENERS + EXTRA_STRENGTHENERS,
        dampeners=v.DAMPENERS + EXTRA_DAMPENERS,
        idioms={**v.IDIOMS, **EXTRA_IDIOMS},
    )


_RULES = corpus_rules()
_STRONG = sql_list(_RULES.strengtheners)
_WEAK = sql_list(_RULES.dampeners + _RULES.dampening_pairs)
_PAIRS = sql_list(_RULES.dampening_pairs)
_MARKS = r"[.!?,;:\-''\x22]|!!|!!!|\?\?|\?\?\?|\?!\?|!\?!|\?!\?!|!\?!\?"
_PLAIN = r"([^!-/:-@\[-`{-~]{2,})"


def _upper(w: str) -> str:
    return f"({w} = upper({w}) AND {w} <> lower({w}))"


def _boost(p: str) -> str:
    base = f"(CASE WHEN lower({p}) IN ({_STRONG}) THEN 0.293::DOUBLE WHEN lower({p}) IN ({_WEAK}) THEN -0.293::DOUBLE END)"
    signed = f"(CASE WHEN v < 0 THEN -{base} ELSE {base} END)"
    loud = "(CASE WHEN v > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END)"
    return f"coalesce(CASE WHEN {_upper(p)} AND mixed THEN {signed} + {loud} ELSE {signed} END, 0.0::DOUBLE)"


def _negates(p: str) -> str:
    return f"(lower({p}) IN ({sql_list(_RULES.negations)}) OR contains(lower({p}), 'n''t'))"


def _idiom(*parts: str) -> str:
    phrase = " || ' ' || ".join(parts)
    whens = " ".join(
        f"WHEN {phrase} = '{text}' THEN {value}::DOUBLE"
        for text, value in _RULES.idioms.items()
        if len(text.split(" ")) == len(parts)
    )
    return f"(CASE {whens} END)"


def _steps() -> list[str]:
    active = {k: f"p{k} IS NOT NULL AND lower(p{k}) NOT IN (SELECT word FROM lex)" for k in (1, 2, 3)}
    steps = [
        f"CASE WHEN {_upper('w')} AND mixed THEN (CASE WHEN v > 0 THEN v + 0.733::DOUBLE ELSE v - 0.733::DOUBLE END) ELSE v END"
    ]
    scale = {1: 1.0, 2: 0.95, 3: 0.9}
    extra = {
        1: "",
        2: "WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN v * 1.5::DOUBLE",
        3: "WHEN (p3 = 'never' AND p2 IN ('so', 'this')) OR p1 IN ('so', 'this') THEN v * 1.25::DOUBLE",
    }
    for k in (1, 2, 3):
        steps.append(f"CASE WHEN {active[k]} THEN v + {_boost(f'p{k}')} * {scale[k]}::DOUBLE ELSE v END")
        steps.append(
            f"CASE WHEN {active[k]} THEN (CASE {extra[k]} WHEN {_negates(f'p{k}')} THEN v * (-0.74::DOUBLE) ELSE v END) ELSE v END"
        )
    before = ", ".join(
        [_idiom("p1", "w"), _idiom("p2", "p1", "w"), _idiom("p2", "p1"), _idiom("p3", "p2", "p1"), _idiom("p3", "p2")]
    )
    steps.append(
        f"CASE WHEN {active[3]} THEN coalesce({_idiom('w', 'n1', 'n2')}, {_idiom('w', 'n1')}, {before}, v) ELSE v END"
    )
    steps.append(
        f"CASE WHEN {active[3]} AND (p3 || ' ' || p2 IN ({_PAIRS}) OR p2 || ' ' || p1 IN ({_PAIRS})) THEN v - 0.293::DOUBLE ELSE v END"
    )
    steps.append(
        f"CASE WHEN {active[1]} AND lower(p1) = 'least' AND NOT coalesce(lower(p2) IN ('at', 'very'), FALSE) THEN v * (-0.74::DOUBLE) ELSE v END"
    )
    steps.append(
        f"CASE WHEN lower(w) IN ({_STRONG}, {_WEAK}) OR coalesce(lower(w) = 'kind' AND lower(n1) = 'of', FALSE) THEN 0.0::DOUBLE ELSE v END"
    )
    return steps


def valence_cte(first_context: bool = True) -> str:
    place = "first_pos AS ctx" if first_context else "pos AS ctx"
    chain = []
    for i, step in enumerate(_steps()):
        chain.append(f"step{i + 1} AS (SELECT * REPLACE ({step} AS v) FROM step{i})")
    joined = ",\n".join(chain)
    last = f"step{len(chain)}"
    exact = lambda x: f"CAST(coalesce(sum(CAST({x} AS DECIMAL(28,12))), 0) AS DOUBLE)"
    return f"""lex(word, measure) AS (VALUES {sql_values(VALENCE)}),
texts AS (SELECT sourceId AS reviewId, {MERGED_SQL} AS text FROM reviews),
lists AS (
  SELECT reviewId,
         least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
         + (CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0.0::DOUBLE
                 WHEN length(text) - length(replace(text, '?', '')) <= 3
                 THEN (length(text) - length(replace(text, '?', ''))) * 0.18::DOUBLE ELSE 0.96::DOUBLE END) AS emphasis,
         list_transform(
           list_filter(string_split_regex(text, '[\\x1c-\\x1f\\x0b\\x85\\s\\p{{Z}}]+'), lambda w: length(w) > 1),
           lambda w: regexp_replace(w, '^(?:(?:{_MARKS}){_PLAIN}|{_PLAIN}(?:{_MARKS}))$', '\\1\\2')) AS ws
  FROM texts),
described AS (
  SELECT *, len(ws) AS n_words,
         len(list_filter(ws, lambda w: w = upper(w) AND w <> lower(w))) BETWEEN 1 AND len(ws) - 1 AS mixed,
         nullif(list_position(list_transform(ws, lambda w: lower(w)), 'but'), 0) AS but_at
  FROM lists),
spots AS (SELECT reviewId, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM described),
hits AS (
  SELECT s.reviewId, s.w, s.pos, measure, min(s.pos) OVER (PARTITION BY s.reviewId, s.w) AS first_pos
  FROM spots s JOIN lex ON lower(s.w) = lex.word),
placed AS (SELECT reviewId, w, pos, measure, {place} FROM hits),
step0 AS (
  SELECT h.reviewId, h.w, mixed, but_at, measure AS v,
         CASE WHEN but_at IS NULL OR h.pos = but_at THEN 1.0::DOUBLE
              WHEN h.pos < but_at THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS weight,
         a1.w AS p1, a2.w AS p2, a3.w AS p3, b1.w AS n1, b2.w AS n2
  FROM placed h JOIN described d USING (reviewId)
  LEFT JOIN spots a1 ON a1.reviewId = h.reviewId AND a1.pos = ctx - 1
  LEFT JOIN spots a2 ON a2.reviewId = h.reviewId AND a2.pos = ctx - 2
  LEFT JOIN spots a3 ON a3.reviewId = h.reviewId AND a3.pos = ctx - 3
  LEFT JOIN spots b1 ON b1.reviewId = h.reviewId AND b1.pos = ctx + 1
  LEFT JOIN spots b2 ON b2.reviewId = h.reviewId AND b2.pos = ctx + 2),
{joined},
weighted AS (SELECT reviewId, v * weight AS v FROM {last}),
per_review AS (
  SELECT reviewId, {exact('v')} AS s, {exact('CASE WHEN v > 0 THEN v + 1 END')} AS pos_sum,
         {exact('CASE WHEN v < 0 THEN 1 - v END')} AS neg_sum, count(*) FILTER (v <> 0) AS n_scored
  FROM weighted GROUP BY reviewId),
sums AS (
  SELECT d.reviewId, n_words, emphasis AS e, coalesce(s, 0.0::DOUBLE) AS s0, coalesce(pos_sum, 0.0::DOUBLE) AS ps,
         coalesce(neg_sum, 0.0::DOUBLE) AS ns, CAST(n_words - coalesce(n_scored, 0) AS DOUBLE) AS neu
  FROM described d LEFT JOIN per_review USING (reviewId)),
parts AS (
  SELECT reviewId, n_words, neu, CASE WHEN s0 > 0 THEN s0 + e WHEN s0 < 0 THEN s0 - e ELSE s0 END AS s,
         CASE WHEN ps > ns THEN ps + e ELSE ps END AS p, CASE WHEN ps < ns THEN ns + e ELSE ns END AS q
  FROM sums),
scores AS (
  SELECT reviewId,
         CASE WHEN n_words > 0 THEN round_even(q / (p + q + neu), 3) ELSE 0.0 END::DOUBLE AS neg,
         CASE WHEN n_words > 0 THEN round_even(neu / (p + q + neu), 3) ELSE 0.0 END::DOUBLE AS neu,
         CASE WHEN n_words > 0 THEN round_even(p / (p + q + neu), 3) ELSE 0.0 END::DOUBLE AS pos,
         CASE WHEN n_words > 0 THEN round_even(s / sqrt(s * s + 15.0::DOUBLE), 4) ELSE 0.0 END::DOUBLE AS compound
  FROM parts)"""


VALENCE_CTE = valence_cte()
