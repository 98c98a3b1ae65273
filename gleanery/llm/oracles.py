"""Reference SQL of the queries that SQL can express."""

from gleanery.llm import mixing, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHAT = r"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
made AS (SELECT *, length('<turn>### : </turn>' || chr(10))
           + length(regexp_replace(role, '(\\|</?turn>|### |:)', '\\\1', 'g'))
           + length(regexp_replace(text, '(\\|</?turn>|### )', '\\\1', 'g')) AS n FROM rows),
one AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS said,
  CAST(sum(n) AS BIGINT) AS n FROM made GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(said) AS loss_chars, sha256(said) AS loss_sha256,
       n AS formatted_chars FROM one"""

MIXING = f"""WITH best AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (SELECT d.doc_id, source, len({WORDS}) AS size,
    -ln((CAST('0x' || substr(md5('{mixing.SEED}:' || CAST(d.doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS k
  FROM documents d LEFT JOIN best USING (doc_id)),
sources AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, ([5.0::DOUBLE, 2.0, 1.0])[CAST(place % 3 + 1 AS INTEGER)] AS w, 2 * n::DOUBLE AS cap FROM sources),
leveled AS (SELECT *, row_number() OVER lv AS spot,
    (1.5::DOUBLE * sum(n) OVER () - coalesce(sum(cap) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (lv ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW lv AS (ORDER BY cap / w, source NULLS LAST)),
opened AS (SELECT spot AS open_spot, level AS open_level FROM leveled WHERE level * w <= cap ORDER BY spot LIMIT 1),
targets AS (SELECT source, CAST(n AS BIGINT) AS n, CASE WHEN spot >= open_spot THEN open_level * w ELSE cap END AS target
            FROM leveled LEFT JOIN opened ON true),
budgets AS (SELECT *, coalesce(CAST(floor(target / nullif(n, 0)) AS BIGINT), 0) AS epochs,
                   target - coalesce(floor(target / nullif(n, 0)), 0) * n AS budget FROM targets),
placed AS (SELECT s.*, b.n, target, epochs, budget,
             sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS running
           FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source),
gaps AS (SELECT source, any_value(budget) - coalesce(max(running) FILTER (running <= budget AND budget > 0), 0) AS gap
         FROM placed GROUP BY source),
closing AS (SELECT p.source, arg_min(running, (abs(gap - size), running)) AS closes FROM placed p
            JOIN gaps g ON p.source IS NOT DISTINCT FROM g.source
            WHERE NOT (running <= budget AND budget > 0) AND size > 0 AND abs(gap - size) < gap GROUP BY p.source)
SELECT doc_id, size, n AS source_size, target, CAST(size * (epochs
         + CASE WHEN running <= budget AND budget > 0 OR size > 0 AND running IS NOT DISTINCT FROM closes THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed p LEFT JOIN closing c ON p.source IS NOT DISTINCT FROM c.source"""

ANCHORS = f"""WITH lists AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g FROM lists, unnest(range(1, len(ws) - 18)) t(i)),
again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, unnest(range(20)) t(j)),
left_over AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS kept, count(*) AS n FROM
    (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM lists) w
    ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM lists LEFT JOIN left_over USING (doc_id)"""

MINHASH = f"""WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s FROM lists, unnest(range(1, greatest(len(ws) - 1, 2))) t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN ties l ON l.a = r.b),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM roots LEFT JOIN sizes USING (doc_id)"""

_TESTS = ", ".join(
    f"('{name}', {sign}, {step}, {cutoff}::DOUBLE)"
    for name, (sign, cutoffs) in quality_rules.RULES.items()
    for step, cutoff in enumerate(cutoffs)
)
_RULES = ", ".join(f"('{name}', {name})" for name in quality_rules.RULES)
_RISK = 0.02 / len(quality_rules.RULES)

QUALITY = f"""WITH lists AS (SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM lists, unnest(range(1, len(ws) - 6)) t(i)),
often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM often, unnest(range(8)) t(j) GROUP BY doc_id),
counts AS (SELECT doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM lists LEFT JOIN covered USING (doc_id)),
features AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0) AS symbol_share,
    coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS dup_line_share,
    coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0) AS repeat_share,
    coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS mean_word_high,
    coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS mean_word_low FROM counts),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
tests(rule, sign, step, cutoff) AS (VALUES {_TESTS}),
valued AS (SELECT doc_id, lang, base_failed, v.rule, v.value FROM features,
           LATERAL (VALUES {_RULES}) v(rule, value)),
placed AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang NULLS LAST) AS place
           FROM features SEMI JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY lang),
strata AS (SELECT lang, CASE WHEN place <= 64 THEN lang END AS stratum FROM placed),
held AS (SELECT stratum, rule, step, cutoff, count(*) AS n, count(*) FILTER (sign * value > sign * cutoff) AS k
         FROM valued SEMI JOIN good USING (doc_id) JOIN strata ON strata.lang IS NOT DISTINCT FROM valued.lang
         JOIN tests USING (rule) WHERE NOT base_failed GROUP BY ALL),
judged AS (SELECT *, CASE WHEN k >= n * {_RISK!r}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK!r}::DOUBLE) + (n - i) * ln(1 - {_RISK!r}::DOUBLE)))) END
    <= 0.05::DOUBLE / ((SELECT count(DISTINCT coalesce('=' || stratum, '')) FROM strata) * {len(quality_rules.RULES)}) AS passed FROM held),
proven AS (SELECT stratum, rule, arg_max(cutoff, step) AS cutoff FROM (
    SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY step) AS all_passed FROM judged) WHERE all_passed GROUP BY ALL),
rejected AS (SELECT DISTINCT doc_id FROM valued v LEFT JOIN strata s ON s.lang IS NOT DISTINCT FROM v.lang
             JOIN proven p ON p.stratum IS NOT DISTINCT FROM s.stratum AND p.rule = v.rule
             JOIN (SELECT DISTINCT rule, sign FROM tests) g ON g.rule = v.rule WHERE sign * value > sign * cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM features"""

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Unsigned crc32 of the decimal ids: one row per document, from a table of all bytes' remainders.
CRC32 = """bits AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)
    ORDER BY b) AS tab FROM range(256) t(b)),
seeds AS (SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT)),
    lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]), 4294967295), 4294967295) AS h FROM documents, bits)"""

RUNS = f"""WITH {CRC32},
plain AS (SELECT d.doc_id, {WORDS} AS ws, h FROM documents d JOIN seeds s USING (doc_id)),
sized AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM plain),
texts AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized),
ws AS (SELECT doc_id, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w
       FROM texts, unnest(range(n)) t(i)),
often AS (SELECT doc_id, w, i FROM ws QUALIFY count(*) OVER (PARTITION BY doc_id, w) >= 4),
equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM often x JOIN often y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i
          JOIN texts t ON t.doc_id = x.doc_id AND 4 * (y.i - x.i) <= t.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretches a WHERE NOT EXISTS (SELECT 1 FROM stretches b
           WHERE b.doc_id = a.doc_id AND b.q < a.q AND a.q % b.q = 0 AND b.s <= a.s AND b.s + b.len >= a.s + a.len)),
gone AS (SELECT DISTINCT doc_id, t.i FROM runs, unnest(range(s + q, s + len)) t(i)),
left_over AS (SELECT ws.doc_id, string_agg(w, ' ' ORDER BY ws.i) AS kept FROM ws ANTI JOIN gone
              ON gone.doc_id = ws.doc_id AND gone.i = ws.i GROUP BY ws.doc_id),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY doc_id),
ratios AS (SELECT doc_id, s, len, q, row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q::DOUBLE DESC, s, q) AS place FROM runs)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period, (1000 * b.len) // b.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN ratios b ON b.doc_id = d.doc_id AND b.place = 1
LEFT JOIN left_over l ON l.doc_id = d.doc_id"""


def _tree(name: str, leaves: str, levels: int) -> list[str]:
    """Tables of a tree's levels: <name>0 on with (scope, pos, d, n), and <name>p0 on with a node's siblings in front and behind."""
    made = [f"{name}0 AS ({leaves})"]
    for i in range(levels):
        made.append(f"""{name}p{i} AS (SELECT scope, pos, n > 1 AS up,
          coalesce(string_agg(d, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
          coalesce(string_agg(d, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
          FROM {name}{i} WINDOW run AS (PARTITION BY scope, pos // 8 ORDER BY pos))""")
        made.append(f"""{name}{i + 1} AS (SELECT scope, pos // 8 AS pos, CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos))
          ELSE min(d) END AS d, (max(n) + 7) // 8 AS n FROM {name}{i} GROUP BY scope, pos // 8)""")
    return made


def _folds(name: str, levels: int, start: str, spot: str) -> list[str]:
    """Tables that fold the rows of `start` (scope, pos, f, proof, ...) up the tree: a node's digest and its siblings so far."""
    made = []
    for i in range(levels):
        made.append(f"""{name}f{i + 1} AS (SELECT x.* REPLACE (CASE WHEN up THEN sha256(before || f || behind) ELSE f END AS f,
          CASE WHEN up THEN proof || before || behind ELSE proof END AS proof)
          FROM {start if not i else f"{name}f{i}"} x JOIN {name}p{i} p ON p.scope = x.{spot[0]} AND p.pos = x.{spot[1]} // {8**i})""")
    return made


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in fields]
    return f"sha256({' || '.join(parts)})"


#: Levels that the SQL climbs: up to 8^8 documents of a language, and 8^4 languages.
DEEP, HIGH = 8, 4

MERKLE = f"""WITH {CRC32},
leaves AS (SELECT d.doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN h % 3 = 0 THEN {_leaf(LOWERED.format("text"))} ELSE {_leaf("text")} END AS f FROM documents d LEFT JOIN seeds USING (doc_id)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS scope, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
{", ".join(_tree("low", "SELECT scope, pos, leaf AS d, n FROM ordered", DEEP))},
{", ".join(_tree("top", f"SELECT 0 AS scope, scope AS pos, d, count(*) OVER () AS n FROM low{DEEP}", HIGH))},
started AS (SELECT doc_id, leaf, scope, pos, f, '' AS proof, 0 AS whole FROM ordered),
{", ".join(_folds("low", DEEP, "started", ("scope", "pos")))},
{", ".join(_folds("top", HIGH, f"lowf{DEEP}", ("whole", "scope")))}
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.d AS verified
FROM topf{HIGH} x JOIN low{DEEP} s ON s.scope = x.scope JOIN top{HIGH} t ON true"""

SQL = {
    "op2_chat": CHAT,
    "op3_mixing": MIXING,
    "op5_anchors": ANCHORS,
    "op6_minhash_join": MINHASH,
    "op9_quality_rules": QUALITY,
    "op11_periodic_runs": RUNS,
    "op12_merkle": MERKLE,
}
