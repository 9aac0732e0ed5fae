"""The results of those queries that SQL can express, computed the plain way."""

from __future__ import annotations

# Every term of every item against every document.
RANKED_SEARCH = r"""
WITH listed AS (
    SELECT row_number() OVER () AS place, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
    FROM documents),
norm AS (
    SELECT count(*) FILTER (len(terms) > 0) AS documents, sum(len(terms))::BIGINT AS terms FROM listed),
postings AS (
    SELECT place, doc_id, term, count(*) AS times, any_value(n) AS n
    FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM listed)
    GROUP BY place, doc_id, term),
frequency AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
    FROM postings, norm GROUP BY term),
asked AS (
    SELECT item_id, text, unnest(
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)),
scored AS (
    SELECT item_id, text, place, doc_id, sum(
        weight * ((1000000000 * times) // (1000 * times + 8 * (25 + (75 * n * norm.documents) // norm.terms))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN frequency USING (term), norm
    GROUP BY item_id, text, place, doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Every query against every row.
EXACT_TOP_K = """
WITH usable AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asking AS (SELECT vec_id AS query_id, min(vector) AS wanted FROM usable WHERE vec_id % 50 = 0 GROUP BY vec_id),
scored AS (
    SELECT query_id, vec_id, list_inner_product(wanted, vector)::BIGINT AS score
    FROM asking JOIN usable ON query_id <> vec_id AND len(wanted) = len(vector)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Equal words at every lag, their stretches, and those of them that no smaller period explains. The checksum is CRC-32
# bit by bit: a step takes in a byte or, where it is -1, shifts by one.
PERIODIC_RUNS = r"""
WITH summed AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
               list_transform(string_split(doc_id::VARCHAR, ''),
                              lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
                                   ELSE xor(crc // 2, (crc % 2) * 3988292384) END)) END AS h
    FROM documents),
planted AS (
    SELECT place, doc_id, words, len(words) AS n, coalesce(h % 10 = 0 AND len(words) > 0, false) AS chosen,
           CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a, (h // 10) % 8 AS extra
    FROM summed),
worded AS (
    SELECT place, n, i, CASE WHEN chosen AND i >= a THEN words[a + (i - a) % (1 + (n - a) // (3 + extra)) + 1]
                             ELSE words[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM planted)),
equal AS (
    SELECT later.place, later.i, later.i - earlier.i AS period
    FROM worded later JOIN worded earlier
      ON later.place = earlier.place AND later.word = earlier.word AND earlier.i < later.i
     AND 3 * (later.i - earlier.i) <= later.n),
stretches AS (
    SELECT place, period, min(i) - period AS start, count(*) + period AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY place, period ORDER BY i) AS stretch FROM equal)
    GROUP BY place, period, stretch HAVING count(*) + period >= greatest(24, 3 * period)),
runs AS (
    SELECT * FROM stretches AS long WHERE NOT EXISTS (
        SELECT 1 FROM stretches AS short
        WHERE short.place = long.place AND short.period < long.period AND short.start <= long.start
          AND short.start + short.length >= long.start + long.length)),
best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY place ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (
    SELECT place, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY place),
kept AS (
    SELECT place, string_agg(word, ' ' ORDER BY i) AS collapsed FROM worded
    WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.place = worded.place AND i >= start + period AND i < start + length)
    GROUP BY place)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
       period::BIGINT AS period, ((1000 * length) // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (place) LEFT JOIN best USING (place) LEFT JOIN kept USING (place)
"""
