"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from tidemark.llm import licenses

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM per
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels
), rated AS (
  SELECT doc_id, targets.source, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), drawn AS (
  SELECT *, CAST('0x' || substr(md5('7:' || draw || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 12)
                 AS BIGINT) / 281474976710656.0::DOUBLE < rate % 1 AS extra
  FROM rated, range(32) r(draw)
), sums AS (
  SELECT source, draw, abs(floor(any_value(rate)) * any_value(source_size)
                           + coalesce(sum(size) FILTER (extra), 0) - any_value(target)) AS miss
  FROM drawn GROUP BY source, draw
), best AS (
  SELECT source, min({'miss': miss, 'draw': draw}).draw AS draw FROM sums GROUP BY source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + extra::INT) AS BIGINT) AS taken
FROM drawn JOIN best ON drawn.source IS NOT DISTINCT FROM best.source AND drawn.draw = best.draw
"""

TOP_K = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         list_inner_product(q.vector, r.vector)::BIGINT AS score
  FROM usable q JOIN usable r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

JACCARD = r"""
WITH RECURSIVE tokens AS MATERIALIZED (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + 4], ' ')) AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
        FROM tokens WHERE len(words) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL
  ) JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 75 * (s.size + t.size - common)
), reached(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.node
)
SELECT r.doc_id, coalesce(max(s.size), 0)::BIGINT AS n_shingles, min(node) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id
GROUP BY r.doc_id
"""

SUBSTRINGS = r"""
WITH tokens AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i
        FROM tokens WHERE len(words) >= 35)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY content) AS times FROM windows)
  WHERE times > 1
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM repeated
), gone AS (
  SELECT doc_id, count(*) AS n_removed, list(place) AS places FROM removed GROUP BY doc_id
), kept AS (
  SELECT t.doc_id, count(*) AS n_kept,
         string_agg(t.word, ' ' ORDER BY t.place) AS words
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM tokens) t
  ANTI JOIN removed r ON r.doc_id = t.doc_id AND r.place = t.place
  GROUP BY t.doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(g.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM tokens t LEFT JOIN gone g ON g.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licences() -> str:
    """Sentences are unnested with their places and joined with the dictionary; one step a rule."""
    known = ", ".join(f"({_text(k)}, {_text(v)})" for k, v in licenses.dictionary().items())
    normal = (
        "trim(regexp_replace(translate({}, '" + licenses.UPPER + "', '" + licenses.LOWER + "'),"
        " '[^a-z0-9]+', ' ', 'g'))"
    )
    steps, before = [], "sequences"
    for n, (name, rule) in enumerate(licenses.RULES):
        form, rest = _text(licenses.rule_pattern(rule)), _text(licenses.rule_rest(rule, "\\"))
        steps.append(
            f"r{n} AS (SELECT doc_id, ids, regexp_replace(rest, {form}, {rest}, 'g') AS rest,"
            f" CASE WHEN regexp_matches(rest, {form})"
            f" THEN list_append(found, {_text(name)}) ELSE found END AS found FROM {before})"
        )
        before = f"r{n}"
    return f"""
WITH RECURSIVE known(sentence, id) AS (VALUES {known}),
sentences AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS sentence
  FROM (SELECT doc_id, string_split(regexp_replace(
               regexp_replace(text, {_text(licenses.SPDX_TAG)}, chr(1) || '\\1 ', 'g'),
               {_text(licenses.BOUNDARY)}, '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents)
), whole AS (
  SELECT s.*, k.id FROM sentences s LEFT JOIN known k ON k.sentence = {normal.format("s.sentence")}
), passages AS (
  SELECT doc_id, place,
         list_filter(list_transform(string_split(sentence, chr(10)), lambda s: {normal.format("s")}),
                     lambda s: s <> '') AS parts
  FROM whole WHERE id IS NULL AND contains(sentence, chr(10))
), lines AS (
  SELECT doc_id, place, i, parts, split_part(parts[i], ' ', 1) AS word
  FROM (SELECT *, generate_subscripts(parts, 1) AS i FROM passages)
), begun AS (
  SELECT doc_id, place, i, parts, array_to_string(parts[i:i + {licenses.longest()}], chr(10)) || chr(10) AS rest
  FROM lines WHERE word IN (SELECT split_part(sentence, ' ', 1) FROM known)
), candidates AS (
  SELECT doc_id, place, i,
         arg_min({{'id': k.id,
                  'j': i + length(k.sentence) - length(replace(rest[:length(k.sentence)], chr(10), ''))}},
                 CASE WHEN parts[i] = k.sentence THEN -1000000 ELSE -length(k.sentence) END) AS hit
  FROM begun b JOIN known k
    ON starts_with(replace(b.rest, chr(10), ' '), k.sentence || ' ')
   AND substr(b.rest, length(k.sentence) + 1, 1) = chr(10)
  GROUP BY doc_id, place, i
), picked AS (
  SELECT doc_id, place, min(i) AS i, arg_min(hit, i) AS hit FROM candidates GROUP BY doc_id, place
  UNION ALL
  SELECT c.doc_id, c.place, min(c.i), arg_min(c.hit, c.i)
  FROM picked p JOIN candidates c ON c.doc_id = p.doc_id AND c.place = p.place AND c.i > p.hit.j
  GROUP BY c.doc_id, c.place
), hits AS (
  SELECT doc_id, place, 0 AS line, id FROM whole WHERE id IS NOT NULL
  UNION ALL
  SELECT doc_id, place, i, hit.id FROM picked
), sequences AS (
  SELECT d.doc_id, list(h.id ORDER BY place, line) FILTER (WHERE h.id IS NOT NULL) AS ids,
         '<' || string_agg(h.id, '><' ORDER BY place, line) || '>' AS rest,
         []::VARCHAR[] AS found
  FROM documents d LEFT JOIN hits h USING (doc_id) GROUP BY d.doc_id
), {", ".join(steps)}
SELECT doc_id, coalesce(len(ids), 0) AS n_sentences,
       coalesce(array_to_string(ids, ','), '') AS sentences,
       array_to_string(list_sort(list_distinct(found)), ',') AS licences
FROM {before}
"""

# CRC-32 of the decimal id, byte by byte and bit by bit; the smallest member and the depth name a node.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(
           list_concat([4294967295::BIGINT],
             list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT i.conv_id, t.place AS depth, t.role, t.text
  FROM ids i JOIN turns t ON t.conv_id = i.base AND t.place <= i.h),
given AS (SELECT conv_id, count(*) AS k FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT t.conv_id, coalesce(g.k, 0) + t.place - i.h, t.role, t.text
  FROM turns t JOIN ids i USING (conv_id) LEFT JOIN given g USING (conv_id) WHERE t.place > i.h),
whole AS (
  SELECT i.conv_id, count(r.depth) AS n,
         list([r.role, r.text] ORDER BY r.depth) FILTER (r.depth IS NOT NULL) AS turns
  FROM ids i LEFT JOIN rebuilt r USING (conv_id) GROUP BY i.conv_id),
begun AS (
  SELECT conv_id, n, d AS depth, coalesce(turns[1:d], []) AS beginning
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM whole)),
members AS (
  SELECT conv_id, depth, n = depth AS ended,
         CASE WHEN depth > 0 THEN strlen(beginning[depth][2]) ELSE 0 END AS bytes,
         min(conv_id) OVER (PARTITION BY depth, beginning) AS node
  FROM begun),
nodes AS (
  SELECT depth, node, count(*) AS n_convs, max(bytes) AS bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '') AS ends
  FROM members GROUP BY depth, node),
inside AS (
  SELECT DISTINCT a.depth AS depth, a.node AS node, b.depth AS below_depth, b.node AS below_node
  FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
children AS (
  SELECT depth, node, count(*) AS n_children FROM inside WHERE below_depth = depth + 1 GROUP BY depth, node),
subtrees AS (
  SELECT i.depth, i.node, sum((n.n_convs - 1) * n.bytes) AS saved,
         count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM inside i JOIN nodes n ON n.depth = i.below_depth AND n.node = i.below_node
  LEFT JOIN children c ON c.depth = i.below_depth AND c.node = i.below_node
  GROUP BY i.depth, i.node)
SELECT n.node AS conv_id, n.depth::BIGINT AS depth, p.node AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtrees s USING (depth, node)
LEFT JOIN children c USING (depth, node)
LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1
"""
