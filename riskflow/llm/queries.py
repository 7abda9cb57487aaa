"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import (
    conversation_repair,
    decontamination,
    exact_topk,
    hard_negatives,
    language_id,
    lattice_lm,
    line_dedup,
    piece_sampling,
    quality_rules,
    secret_scan,
    simhash_dedup,
    url_filter,
    warc_salvage,
)
from riskflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There is no table of listed URLs: the pages' own keys on certain hosts are the list."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.keys_of_names(pages))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.plan(docs))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scores(table(spark, sf_dir, "documents"))


def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(table(spark, sf_dir, "documents"), check=True)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_salvage.round_trip(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(conversations), conversations)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), hard_negatives.shifted_label())


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings"))


REGISTERED: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_lattice_lm": op7_lattice_lm,
    "op8_piece_sampling": op8_piece_sampling,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_topk": op13_exact_topk,
}

ORACLES: dict[str, str] = {}

ORACLES["op2_url_filter"] = """
WITH parted AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
judged AS (
    SELECT *,
           CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule,
           list_has_any(string_split(host, '.'),
                        ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS listed
    FROM parted
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
       listed
FROM judged
"""

ORACLES["op4_quality_rules"] = r"""
WITH listed AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM listed),
windows AS (
    SELECT doc_id, place,
           [word, lead(word) OVER by_place, lead(word, 2) OVER by_place] AS three,
           lead(word, 2) OVER by_place IS NOT NULL AS whole
    FROM words WINDOW by_place AS (PARTITION BY doc_id ORDER BY place)
),
repeated AS (
    SELECT doc_id, count(DISTINCT place + d) AS n_repeat_words
    FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows WHERE whole),
         (VALUES (0), (1), (2)) AS shift(d)
    WHERE n > 1 GROUP BY doc_id
),
per_word AS (
    SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
           count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_letter_words
    FROM words GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
per_text AS (
    SELECT doc_id,
           length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS n_symbols,
           length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_capitals,
           length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) AS n_small
    FROM documents
),
figures AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_letter_words, 0) AS n_letter_words, n_capitals, n_small
    FROM per_text LEFT JOIN per_word USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_letter_words < 8 * n_words OR n_capitals > n_small
            OR 10 * n_repeat_words > 3 * n_words) AS kept
FROM based
"""

ORACLES["op6_line_dedup"] = r"""
WITH ended AS (
    SELECT doc_id, unnest(string_split(marked, chr(57344))) AS piece, unnest(range(len(string_split(marked, chr(57344))))) AS nth
    FROM (SELECT doc_id, regexp_replace(text, '([.!?][ \t]+|\n|[。！？]+)', '\1' || chr(57344), 'g') AS marked FROM documents)
),
pieces AS (
    SELECT *, len(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')) AS words FROM ended WHERE piece <> ''
),
grouped AS (
    SELECT *, coalesce(sum((words >= 6 OR NOT regexp_matches(piece, '[ \t]$'))::INT) OVER (
                  PARTITION BY doc_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
    FROM pieces
),
parts AS (
    SELECT doc_id, part, string_agg(piece, '' ORDER BY nth) AS whole, sum(words) AS words FROM grouped GROUP BY doc_id, part
),
split AS (
    SELECT doc_id, part, word, nth,
           len(long) > 0 AND letters <> '' AND (131 * unicode(left(letters, 1)) + 31 * unicode(right(letters, 1)) + 7 * (length(letters) - 1)) % 10 = 0 AS chosen
    FROM (SELECT *, trim(translate(regexp_replace(word, '[\x20\x09-\x0D]+', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~') AS letters
    FROM (SELECT doc_id, part, long, unnest(CASE WHEN len(long) > 0 THEN long ELSE [whole] END) AS word,
                 unnest(range(greatest(len(long), 1))) AS nth
          FROM (SELECT *, CASE WHEN words > 16 THEN regexp_extract_all(whole, '^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*')
                               ELSE [] END AS long FROM parts)))
),
chunked AS (
    SELECT *, coalesce(sum(chosen::INT) OVER (PARTITION BY doc_id, part ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
    FROM split
),
twenties AS (
    SELECT *, (row_number() OVER (PARTITION BY doc_id, part, chunk ORDER BY nth) - 1) // 20 AS twenty FROM chunked
),
units AS (
    SELECT doc_id, string_agg(word, '' ORDER BY nth) AS unit,
           row_number() OVER (PARTITION BY doc_id ORDER BY part, chunk, twenty) AS place
    FROM twenties GROUP BY doc_id, part, chunk, twenty
),
placed AS (
    SELECT *, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY place) AS stop,
           trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~',
                                         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS form
    FROM units
),
ranked AS (
    SELECT *, CASE WHEN form = '' THEN 0 ELSE greatest(len(string_split(form, ' ')), length(form) // 10) END AS size,
           form <> '' AND row_number() OVER (PARTITION BY form ORDER BY doc_id, place) > 1 AS again
    FROM placed
),
islands AS (
    SELECT *, sum((form <> '' AND NOT again)::INT) OVER (PARTITION BY doc_id ORDER BY place) AS island FROM ranked
),
runs AS (
    SELECT doc_id, min(place) AS first, max(place) AS last, min(stop - length(unit)) AS start, max(stop) AS stop
    FROM islands WHERE again GROUP BY doc_id, island HAVING sum(size) >= 25
),
kept AS (
    SELECT i.doc_id, i.place, i.unit, r.first IS NOT NULL AS gone
    FROM ranked AS i LEFT JOIN runs AS r ON i.doc_id = r.doc_id AND i.place BETWEEN r.first AND r.last
),
texts AS (
    SELECT doc_id, coalesce(string_agg(unit, '' ORDER BY place) FILTER (NOT gone), '') AS text, count(*) AS n_units,
           count(*) FILTER (gone) AS n_removed
    FROM kept GROUP BY doc_id
),
spans AS (
    SELECT doc_id, string_agg(start::BIGINT || '-' || stop::BIGINT, ',' ORDER BY first) AS removed_spans FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text = '' THEN '' ELSE t.text END AS text, coalesce(n_units, 0) AS n_units,
       coalesce(n_removed, 0) AS n_removed, coalesce(removed_spans, '') AS removed_spans
FROM documents AS d LEFT JOIN texts AS t USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

ORACLES["op10_warc"] = """
WITH plain AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hexed FROM pages
),
coded AS (
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      (((('0x' || substr(hexed, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::INT, 1)), '')
               AS payload_digest
    FROM plain
),
held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM coded)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < holder THEN holder END AS refers_to
FROM held
"""


def _op11() -> str:
    """A way is its cost in six digits and its audit, so the least text is the best way."""

    def way(of: str, cost: str, edit: str) -> str:
        return f"lpad((left({of}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({of}, 7) || '{edit}'"

    def least(*of: str) -> str:
        return f"least({', '.join(of)})"

    to_user = [way(f"s{i}", "extra", "K") for i in (0, 1, 3)]
    to_user_anew = [way(f"s{i}", "2 + extra", "R") for i in (0, 1, 3)]
    return f"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
                            lambda c, _: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY n) AS crcs
    FROM (SELECT unnest(range(256))::BIGINT AS n)
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
faulty AS (
    SELECT conv_id, turn, role, text,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
                                       lambda c, b: xor(c // 256, crcs[xor(c, b) % 256 + 1]))) % 20 AS fault
    FROM keyed, crc_table
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM faulty WHERE fault <> 0
),
placed AS (
    SELECT conv_id, turn, role, text, row_number() OVER (
               PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(octet_length(encode(role)) || ':' || role || text)) AS i
    FROM damaged
),
judged AS (
    SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS unended,
           left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
    FROM placed
),
coded AS (SELECT *, blank OR again AS must, (NOT blank AND NOT again AND unended)::INT AS extra FROM judged),
ways AS (
    SELECT conv_id, 0::BIGINT AS i, '000000' AS s0, NULL::VARCHAR AS s1, '000002I' AS s2, '000004II' AS s3
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, n0, n1, {least("n2", way("n0", "2", "I"), way("n1", "2", "I"), way("n3", "2", "I"))} AS m2,
           {least("n3", way("m2", "2", "I"))}
    FROM (
        SELECT w.conv_id, c.i, {way("s0", "3", "D")} AS n0,
               {least(way("s1", "3", "D"), f"CASE WHEN NOT must AND initial = 's' THEN {way('s0', 'extra', 'K')} END")} AS n1,
               {least(way("s2", "3", "D"), f"CASE WHEN must THEN NULL WHEN initial = 'u' THEN {least(*to_user)} ELSE {least(*to_user_anew)} END")} AS n2,
               {least(way("s3", "3", "D"), f"CASE WHEN must THEN NULL WHEN initial = 'a' THEN {way('s2', 'extra', 'K')} ELSE {way('s2', '2 + extra', 'R')} END")} AS n3
        FROM ways AS w JOIN coded AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i + 1
    )
),
best AS (
    SELECT conv_id, arg_max(CASE WHEN i = 0 THEN '000000' ELSE least(s0, s3) END, i) AS way FROM ways GROUP BY conv_id
),
edits AS (
    SELECT *, sum((edit <> 'I')::INT) OVER up_to AS i, sum((edit <> 'D')::INT) OVER up_to AS j
    FROM (SELECT conv_id, unnest(range(1, length(way) - 5)) AS nth, way[nth + 6] AS edit FROM best)
    WINDOW up_to AS (PARTITION BY conv_id ORDER BY nth)
),
rows_of AS (
    SELECT e.conv_id, e.edit, e.j, c.role, CASE WHEN e.edit = 'I' THEN '' ELSE c.text END AS text,
           first_value(e.edit = 'K' AND c.initial = 's') OVER (PARTITION BY e.conv_id ORDER BY e.j) AS has_system
    FROM edits AS e LEFT JOIN coded AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.i = e.i
    WHERE e.edit <> 'D'
),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - has_system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || text, chr(10) ORDER BY j) AS lines
    FROM rows_of GROUP BY conv_id
),
figures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (again AND NOT blank) AS duplicate, sum(extra) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id
)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, left(way, 6)::BIGINT AS cost,
       substr(way, 7) AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM best AS b LEFT JOIN figures AS f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
     LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""


ORACLES["op11_conversation_repair"] = _op11()

USABLE = """vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

ORACLES["op12_hard_negatives"] = f"""
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND {USABLE}
),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM whole AS a JOIN whole AS c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
near AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLES["op13_exact_topk"] = f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE {USABLE}
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole AS q JOIN whole AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
