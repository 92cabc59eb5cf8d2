"""DuckDB SQL of the training-data queries that SQL can express."""

from martforge.llm import quality

_RULES = f"""
    n_words < {quality.MIN_WORDS}
    OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words
    OR word_chars < {quality.MEAN_WORD_CHARS[0]} * n_words OR word_chars > {quality.MEAN_WORD_CHARS[1]} * n_words
    OR 100 * n_symbols > {quality.MAX_SYMBOL_PERCENT} * n_words
    OR 100 * n_dup_lines > {quality.MAX_DUP_LINE_PERCENT} * n_lines
"""

OP5 = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT r, doc_id, text,
        [w FOR w IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF w <> ''] AS words,
        [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM texts
), words AS (
    SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM cut
), windows AS (
    SELECT r, i, w, lead(w, 4) OVER o IS NOT NULL AS whole,
        [w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o] AS five
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
    SELECT r, i, CASE WHEN whole AND count(*) OVER (PARTITION BY r, five) > 1 THEN 1 ELSE 0 END AS d FROM windows
), covered AS (
    SELECT r, max(d) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM twice
), repeats AS (
    SELECT r, sum(c) AS n FROM covered GROUP BY r
), features AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM cut LEFT JOIN repeats USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    NOT ({_RULES}) AS kept
FROM features
"""

OP2 = """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# DuckDB has no CRC-32: a checksum is the exclusive or of what each byte contributes at its distance
# from the end, and of a constant for the length
OP11 = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), target AS (
    SELECT row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), singles AS (
    SELECT 0 AS side, r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
    UNION ALL SELECT 1, r, unnest(w), generate_subscripts(w, 1) FROM target
), runs AS (
    SELECT side, r, word AS feature FROM singles
    UNION ALL SELECT side, r, feature FROM (
        SELECT side, r, word || ' ' || lead(word) OVER (PARTITION BY side, r ORDER BY i) AS feature FROM singles) WHERE feature IS NOT NULL
), counts AS (
    SELECT side, r, feature, count(*) AS n FROM runs GROUP BY ALL
), features AS (
    SELECT feature, encode(feature) AS raw, octet_length(encode(feature)) AS len FROM (SELECT DISTINCT feature FROM runs)
), bits AS (
    SELECT b.range::UBIGINT AS b, b.range::UBIGINT AS c, 0 AS step FROM range(256) b
    UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
), steps AS (
    SELECT b, c FROM bits WHERE step = 8
), far AS (
    SELECT 0 AS d, b, c FROM steps
    UNION ALL SELECT d + 1, far.b, xor(far.c >> 8, steps.c) FROM far JOIN steps ON steps.b = far.c & 255 WHERE d < (SELECT max(len) FROM features)
), starts AS (
    SELECT 0 AS len, 4294967295::UBIGINT AS c
    UNION ALL SELECT starts.len + 1, xor(starts.c >> 8, steps.c) FROM starts JOIN steps ON steps.b = starts.c & 255 WHERE starts.len < (SELECT max(len) FROM features)
), letters AS (
    SELECT feature, len, unnest(range(len)) AS i, raw FROM features
), checks AS (
    SELECT feature, len, bit_xor(far.c) AS c FROM letters JOIN far ON far.d = len - 1 - i AND far.b = ('0x' || substr(hex(raw), 2 * i::INTEGER + 1, 2))::UBIGINT GROUP BY ALL
), buckets AS (
    SELECT feature, xor(xor(checks.c, starts.c), 4294967295::UBIGINT) % 10000 AS bucket FROM checks JOIN starts USING (len)
), tallies AS (
    SELECT k.range AS bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
    FROM range(10000) k LEFT JOIN (SELECT bucket::BIGINT AS bucket, side, n FROM counts JOIN buckets USING (feature)) c ON c.bucket = k.range GROUP BY k.range
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM tallies) + 10000) / ((s + 1) * ((SELECT sum(t) FROM tallies) + 10000))))::BIGINT AS gain FROM tallies
), weights AS (
    SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
    FROM counts JOIN buckets USING (feature) JOIN gains ON gains.bucket = buckets.bucket::BIGINT WHERE side = 0 GROUP BY r
), scored AS (
    SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256(concat('7:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (r)
), ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM ranked) // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

OP13 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
    SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS p
    FROM (SELECT d, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS p FROM texts)
), words AS (
    SELECT d, lang, p, unnest(w) AS w, generate_subscripts(w, 1) AS i
    FROM (SELECT d, lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), ahead AS (
    SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY d, p ORDER BY i)
), f AS (
    SELECT lang, w AS g, count(*) AS n FROM ahead GROUP BY ALL
), f2 AS (
    SELECT lang, w, w2, w || ' ' || w2 AS g, count(*) AS n FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
    SELECT lang, w, w2, w3, w || ' ' || w2 || ' ' || w3 AS g, count(*) AS n FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), parts AS (
    SELECT lang, g, n FROM f WHERE n >= 10 UNION ALL SELECT lang, g, n FROM f2 WHERE n >= 10
), cuts AS (
    SELECT lang, g, n AS a, 1 AS k, w AS first, w2 AS rest FROM f2 WHERE n >= 10
    UNION ALL SELECT lang, g, n, 1, w, w2 || ' ' || w3 FROM f3
    UNION ALL SELECT lang, g, n, 2, w || ' ' || w2, w3 FROM f3
), scored AS (
    SELECT c.lang, c.g, c.a, c.k, x.n AS l, y.n AS r, (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
    FROM cuts c JOIN parts x ON x.lang = c.lang AND x.g = c.first JOIN parts y ON y.lang = c.lang AND y.g = c.rest
), best AS (
    SELECT lang, g, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, w || ' ' || w2 AS g, n AS a FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, n FROM f3) GROUP BY ALL
), free AS (
    SELECT b.* FROM best b LEFT JOIN inside i USING (lang, g) WHERE longer IS NULL OR 100 * longer < 50 * a
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank,
        g AS phrase, a, l, r, score::BIGINT AS score FROM free
), totals AS (
    SELECT lang, count(*) AS n FROM words GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op2_exact_top_k": OP2, "op5_quality_rules": OP5, "op11_importance_resampling": OP11, "op13_phrase_mining": OP13}
