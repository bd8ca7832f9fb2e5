"""SQL twins of the corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from airlake.llm import chat, quality

_RISK, _BUDGET = quality.Risk(), chat.Budget()
_R = len(quality.RULES)

QUALITY = rf"""
WITH t AS (
    SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), win AS (
    SELECT id, i, w[i:i + 2] AS x FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), twice AS (
    SELECT id, i FROM win QUALIFY count(*) OVER (PARTITION BY id, x) > 1
), rep AS (
    SELECT id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY id
), s AS (
    SELECT t.id, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(rep.n, 0) AS n_repeat_words
    FROM t LEFT JOIN rep USING (id)
), st AS (
    SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
), v AS (
    UNPIVOT (
        SELECT id, lang, base_failed, doc_id,
               least(1, coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0)) AS symbol_share,
               least(1, coalesce(n_upper::DOUBLE / nullif(word_chars, 0), 0)) AS upper_share,
               least(1, coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0)) AS dup_line_share,
               least(1, coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0)) AS repeat_share FROM st)
    ON symbol_share, upper_share, dup_line_share, repeat_share INTO NAME rule VALUE share
), lab AS (
    SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), b AS (
    SELECT lang, rule, ceil(share * {_RISK.steps})::BIGINT AS bin, count(*) FILTER (good) AS g,
           count(*) FILTER (NOT good) AS d
    FROM v JOIN lab USING (doc_id) WHERE NOT base_failed GROUP BY ALL
), c AS (
    SELECT lang, rule, bin, sum(g) OVER p AS good, sum(d) OVER p AS bad,
           coalesce(sum(g) OVER a, 0) AS lost, coalesce(sum(d) OVER a, 0) AS caught, lead(bin) OVER (p ORDER BY bin) AS nb
    FROM b WINDOW p AS (PARTITION BY lang, rule),
                  a AS (PARTITION BY lang, rule ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
    SELECT lang, good, {_RISK.delta} / (count(*) OVER () * {_R}) AS level FROM (SELECT DISTINCT lang, good FROM c)
), k AS (
    SELECT lang, good, level, k, sum(CASE WHEN k <= good THEN exp(
               lgamma(good + 1) - lgamma(k + 1) - lgamma(greatest(good - k, 0) + 1) + k * ln({_RISK.alpha / _R})
               + (good - k) * ln(1 - {_RISK.alpha / _R})) ELSE 1 END) OVER (PARTITION BY lang, good ORDER BY k) AS tail
    FROM (SELECT *, unnest(range(0, ceil(good * {_RISK.alpha / _R})::BIGINT + 1)) AS k FROM g)
), allowed AS (
    SELECT lang, good, coalesce(max(k) FILTER (tail <= level), -1) AS most FROM k GROUP BY ALL
), f AS (
    SELECT c.*, caught / nullif(bad, 0) - {_RISK.caution} * coalesce(lost / nullif(c.good, 0), 0) AS gain
    FROM c JOIN allowed ON c.lang IS NOT DISTINCT FROM allowed.lang AND c.good = allowed.good
    WHERE lost <= most AND caught > 0
), cut AS (
    SELECT lang, rule, ((bin + nb - 1) // 2) / {float(_RISK.steps)} AS cutoff FROM f WHERE gain > 0
    QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, bin DESC) = 1
), fires AS (
    SELECT id, bool_or(share > cutoff) AS fired FROM v
    JOIN cut ON cut.rule = v.rule AND cut.lang IS NOT DISTINCT FROM v.lang GROUP BY id
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(fired, false) AS kept
FROM st LEFT JOIN fires USING (id)"""

_TRAP = chat.END + chat.START + "assistant ok"

CHAT = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{_TRAP}' UNION ALL SELECT -1, 1, 'assistant', '{_TRAP}'
), n AS (
    SELECT *, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^ \x09-\x0D\p{{L}}\p{{N}}]')) + {chat.MARK_TOKENS} AS tokens,
           length(role) + len(regexp_extract_all(role, '<\\*\|')) + {len(chat.BREAK) - 1} * (length(role) - length(replace(role, chr(10), '')))
               + length(text) + len(regexp_extract_all(text, '<\\*\|')) + {len(chat.START) + len(chat.END) + 2} AS chars
    FROM t
), p AS (
    SELECT *, row_number() OVER o AS pos, sum(tokens) OVER (o ROWS UNBOUNDED PRECEDING) AS ends,
           first_value(role = 'system') OVER o AS opened, first_value(tokens) OVER o AS t0, first_value(chars) OVER o AS c0
    FROM n WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), h AS (
    SELECT *, ends - tokens AS starts, CASE WHEN opened THEN t0 ELSE 0 END AS kept,
           greatest(1, ({_BUDGET.tokens - _BUDGET.history} - CASE WHEN opened THEN t0 ELSE 0 END) // 2) AS half FROM p
), c AS (
    SELECT *, greatest(0, starts - kept) // half AS cell, tokens > half AS long FROM h
), o AS (
    SELECT *, CASE WHEN pos = 1 THEN 1 WHEN pos = 2 AND opened THEN 0
                   WHEN (lag(cell) OVER q, lag(long) OVER q) <> (cell, long) THEN 1 ELSE 0 END AS opens
    FROM c WINDOW q AS (PARTITION BY conv_id ORDER BY pos)
), w AS (
    SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS win FROM o
), e AS (
    SELECT *, max(ends) OVER (PARTITION BY conv_id, win) AS win_ends, max(win) OVER (PARTITION BY conv_id) AS last FROM w
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(chars * CASE WHEN win < last AND win_ends - starts <= {_BUDGET.history} AND NOT (pos = 1 AND opened) THEN 2 ELSE 1 END)
        + max(CASE WHEN opened THEN c0 * last ELSE 0 END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


_FEATURES = r"""
    SELECT {columns}, unnest(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {source}"""

# crc32 of a word, byte by byte (a list of the 256 remainders, built here from the polynomial), over distinct words only.
IMPORTANCE = rf"""
WITH RECURSIVE steps(b, k, c) AS (
    SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), docs AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    {_FEATURES.format(columns="id", text="text", source="docs")}
), aims AS (
    {_FEATURES.format(columns="0 AS id", text="coalesce(text, '')", source="benchmark")}
), known AS (
    SELECT DISTINCT word FROM words UNION SELECT DISTINCT word FROM aims
), hexed AS (
    SELECT word, hex(encode(word)) AS x FROM known
), bytes AS (
    SELECT word, list_prepend(4294967295::UBIGINT, [('0x' || substr(x, i, 2))::UBIGINT FOR i IN range(1, length(x), 2)]) AS v FROM hexed
), bucketed AS (
    SELECT word, xor(list_reduce(v, lambda c, y: xor(c >> 8, t[1 + (xor(c, y) & 255)::INT])), 4294967295::UBIGINT) % 10000 AS bucket
    FROM bytes, crc
), s AS (
    SELECT bucket, count(*) AS s FROM words JOIN bucketed USING (word) GROUP BY 1
), t AS (
    SELECT bucket, count(*) AS t FROM aims JOIN bucketed USING (word) GROUP BY 1
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE
                                   / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aims) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s FULL JOIN t USING (bucket)
), w AS (
    SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM words JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY 1
), scored AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                      / 4294967296::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN w USING (id)
), ranked AS (
    SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
           count(*) FILTER (n_features >= 20) OVER () AS allowed FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * allowed // 100 THEN place END AS rank FROM ranked"""

NEGATIVES = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM e AS a JOIN e AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
