"""The queries of this subpackage as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, coalesce(source, '') AS source, source IS NOT NULL AS known,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', doc_id, md5(coalesce(text, '')))) AS place
  FROM documents
), per_source AS (
  SELECT source, known, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY known DESC, source) AS rank FROM per_source
), weighed AS (
  SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 3 * source_size AS most FROM ranked
), levels AS (
  SELECT *, most::DOUBLE / weight::DOUBLE AS ratio,
         (sum(source_size) OVER () - coalesce(sum(most) OVER earlier, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS level_here
  FROM weighed
  WINDOW earlier AS (ORDER BY most::DOUBLE / weight::DOUBLE, rank
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT *, least((SELECT level_here FROM levels WHERE level_here <= ratio ORDER BY ratio, rank LIMIT 1)
                  * weight::DOUBLE, most::DOUBLE) AS target
  FROM levels
), size_of AS (
  SELECT greatest(1, least(4096, coalesce(sum(source_size), 0)::BIGINT // 65536)) AS block FROM per_source
), milli AS (
  SELECT source, known, rank, source_size, (source_size + block - 1) // block AS blocks,
         round(target * ((source_size + block - 1) // block)::DOUBLE / source_size::DOUBLE * 1000.0)::BIGINT AS milli
  FROM targets, size_of WHERE source_size > 0
), summed AS (
  SELECT *, sum(milli) OVER ()::BIGINT AS total, sum(milli) OVER (ORDER BY rank)::BIGINT AS upto FROM milli
), cut AS (
  SELECT source, known, source_size, blocks, total,
         floor((upto - milli)::DOUBLE / total::DOUBLE * 1073741824.0)::BIGINT AS low,
         floor(upto::DOUBLE / total::DOUBLE * 1073741824.0)::BIGINT AS high
  FROM summed
), points AS (
  SELECT i AS slot, (i % 1073741824) * 663608941 % 1073741824 AS point
  FROM range((SELECT coalesce(max((total + 999) // 1000), 0) FROM cut)) t(i)
), placed AS (
  SELECT slot, source, known, blocks,
         row_number() OVER (PARTITION BY source, known ORDER BY slot) - 1 AS nth
  FROM points JOIN cut ON point >= low AND point < high
), times AS (
  SELECT source, known, nth % blocks AS block_no, count(*) AS times
  FROM placed WHERE nth // blocks < 3 GROUP BY ALL
), laid AS (
  SELECT *, row_number() OVER () AS row_no,
         coalesce(sum(size) OVER (PARTITION BY source, known ORDER BY place, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized
), pieces AS (
  SELECT row_no, source, known, start, size, block,
         unnest(range(start // block, (start + greatest(size, 1) - 1) // block + 1)) AS block_no
  FROM laid, size_of
), taken AS (
  SELECT row_no, sum((least(start + size, (block_no + 1) * block) - greatest(start, block_no * block))
                     * coalesce(times, 0))::BIGINT AS taken
  FROM pieces LEFT JOIN times USING (source, known, block_no) GROUP BY row_no
)
SELECT doc_id, size, source_size, target, taken
FROM laid JOIN taken USING (row_no) JOIN targets USING (source, known)
"""

QUALITY = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row_no, unnest(range(0, len(words) - 4)) AS i, words FROM split WHERE len(words) >= 5
), keyed AS (
  SELECT row_no, i, [words[i + 1], words[i + 2], words[i + 3], words[i + 4], words[i + 5]] AS w FROM windows
), twice AS (
  SELECT row_no, i FROM keyed QUALIFY count(*) OVER (PARTITION BY row_no, w) > 1
), covered AS (
  SELECT row_no, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY row_no
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '!!'))::BIGINT AS n_exclaim
  FROM split LEFT JOIN covered USING (row_no)
), bits AS (
  SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
             + 4 * (5 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
             + 16 * (word_chars > 15 * n_words)::BIGINT + 32 * (10 * n_exclaim > 3 * n_words)::BIGINT
             + 64 * (word_chars < 2 * n_words)::BIGINT)::BIGINT AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed & 47 = 0 AS kept, failed
FROM bits
"""

# the same ledger, read by policy v1's rules
ABLATIONS = (
    QUALITY[: QUALITY.rindex("SELECT doc_id")]
    + """SELECT rule, count(*) FILTER (failed & bit <> 0)::BIGINT AS failed, count(*) FILTER (failed & 47 = bit)::BIGINT AS failed_alone,
       count(*) FILTER (failed & (47 - bit) = 0)::BIGINT AS kept_without
FROM bits, (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('shouting', 32)) r(rule, bit)
GROUP BY rule
"""
)

SUBSTRINGS = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row_no, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM split WHERE len(words) >= 13)
), seen AS (
  SELECT row_no, i FROM windows
  QUALIFY min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY w) < coalesce(doc_id, 9223372036854775807)
), gone AS (
  SELECT DISTINCT row_no, i + k AS i FROM seen, range(13) t(k)
), numbered AS (
  SELECT row_no, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split
), kept AS (
  SELECT row_no, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM numbered ANTI JOIN gone USING (row_no, i) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row_no)
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS n,
         -- marks and line feed, then both texts with a backslash for each of what is escaped in them
         14 + list_sum([length(x) + length(regexp_replace(x, '[^\\]', '', 'g')) + len(string_split(x, '</turn>')) - 1
                        + coalesce(list_sum([length(h) - 2 for h in regexp_extract_all(x, '###+')]), 0)
                        for x in [role, text]])
            + length(regexp_replace(role, '[^:]', '', 'g')) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), lengths AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY nth) AS upto FROM sized
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR nth = n), 0)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""

_FIELD = "coalesce(strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII text, a bit at a time."""
    step = "list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    byte = f"list_transform([xor(c, x)], lambda b: {step})[1]"
    return f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT), lambda c, x: {byte}), 4294967295)"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row_no, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         {_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS other, {_crc32('doc_id::VARCHAR')} % 7 = 0 AS touched
  FROM documents
), placed AS (
  SELECT row_no, doc_id, g, leaf, CASE WHEN touched THEN other ELSE leaf END AS claimed,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, row_no) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves
), tree AS (
  SELECT g, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY g, level, pos // 2
), subroots AS (
  SELECT g, h, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, g AS pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, pos // 2
), climb AS (
  SELECT row_no, g, 0 AS level, pos, n, claimed AS v, '' AS proof FROM placed
  UNION ALL
  SELECT row_no, c.g, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 0 THEN v || coalesce(s.h, '') ELSE s.h || v END), proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN tree s ON s.g = c.g AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1
), above AS (
  SELECT row_no, 0 AS level, c.g AS pos, s.n, v, proof FROM climb c JOIN subroots s USING (g) WHERE c.n = 1
  UNION ALL
  SELECT row_no, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 0 THEN v || coalesce(s.h, '') ELSE s.h || v END), proof || coalesce(s.h, '')
  FROM above c LEFT JOIN top s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1
), root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, v AS folded_root, v = root AS verified
FROM placed JOIN subroots s USING (g) JOIN (SELECT * FROM above WHERE n = 1) USING (row_no), root
"""

SEARCH = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), size AS (
  SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM split WHERE len(terms) > 0
), postings AS (
  SELECT row_no, doc_id, len(terms)::BIGINT AS length, term, count(*)::BIGINT AS tf
  FROM (SELECT row_no, doc_id, terms, unnest(terms) AS term FROM split) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, size GROUP BY term
), asked AS (
  SELECT DISTINCT item_no, item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS item_no FROM benchmark)
), scored AS (
  SELECT item_no, item_id, row_no, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * length * n) // l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), size GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

ORACLE_SQL = {
    "op3_prefix_targets": CHAT,
    "op4_mix_sources": MIX,
    "op9_quality_rules": QUALITY,
    "quality_ablations": ABLATIONS,
    "op10_cover_substrings": SUBSTRINGS,
    "op12_merkle_manifest": MERKLE,
    "op13_ranked_search": SEARCH,
}
