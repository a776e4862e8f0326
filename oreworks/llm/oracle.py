"""DuckDB SQL for the queries of this package that SQL can express, with literals of its own."""

WORD = r"[^\x20\x09-\x0D]+"

SQL = {
    "op8_chat_format": """
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t.turn, t.role, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
), sized AS (
  SELECT *,
    length(text) + length(text) - length(replace(text, '\\', ''))
      + (length(text) - length(replace(text, '<|', ''))) // 2
      + (length(text) - length(replace(text, '<s>', ''))) // 3
      + (length(text) - length(replace(text, '</s>', ''))) // 4
      + (length(text) - length(replace(text, '[INST]', ''))) // 6
      + (length(text) - length(replace(text, '[/INST]', ''))) // 7
      + length('<|turn|>') + length(role) + 1 + length('<|end|>') + 1 AS chars
  FROM talks
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op9_quality_rules": r"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT id, doc_id, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT id, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS gram
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS k FROM parts)
), repeated AS (
  SELECT id, k FROM (SELECT id, k, count(*) OVER (PARTITION BY id, gram) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT id, count(DISTINCT k + j) AS n FROM repeated, (VALUES (0), (1), (2)) t(j) GROUP BY id
), counted AS (
  SELECT doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣▪]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '^(?:the|be|to|of|and|that|have|with|a|in|is|for|on|are|this|it|as|was|by|from|or|not|at|an|der|die|das|und|ist|nicht|ein|eine|zu|den|mit|von|sich|auf|für|im|dem|des|le|la|les|et|est|un|une|que|du|de|en|dans|pour|qui|sur|au|par|ne|pas|avec|el|los|las|y|es|no|por|con|para|una|su|al|lo|como|más|del|se|The|Be|To|Of|And|That|Have|With|A|In|Is|For|On|Are|This|It|As|Was|By|From|Or|Not|At|An|Der|Die|Das|Und|Ist|Nicht|Ein|Eine|Zu|Den|Mit|Von|Sich|Auf|Für|Im|Dem|Des|Le|La|Les|Et|Est|Un|Une|Que|Du|De|En|Dans|Pour|Qui|Sur|Au|Par|Ne|Pas|Avec|El|Los|Las|Y|Es|No|Por|Con|Para|Una|Su|Al|Lo|Como|Más|Del|Se)$'))) AS n_stop_words
  FROM parts LEFT JOIN covered USING (id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN n_words < 50 THEN 'enough_words' END,
      CASE WHEN n_words > 1000000 THEN 'not_too_many_words' END,
      CASE WHEN n_words = 0 OR word_chars / n_words NOT BETWEEN 2 AND 15 THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.5 THEN 'repeated_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END,
      CASE WHEN n_lines > 0 AND n_bullet_lines / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines > 0 AND n_ellipsis_lines / n_lines > 0.3 THEN 'cut_lines' END,
      CASE WHEN n_stop_words < 2 THEN 'stop_words' END) AS failed_rules
  FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
  CAST(n_bullet_lines AS BIGINT) AS n_bullet_lines, CAST(n_ellipsis_lines AS BIGINT) AS n_ellipsis_lines,
  CAST(n_stop_words AS BIGINT) AS n_stop_words, base_failed, failed_rules,
  NOT base_failed AND failed_rules = '' AS kept
FROM judged
""",
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE number % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM totals
), room AS (
  SELECT *,
    CAST(sum(source_size) OVER () AS BIGINT) AS words, CAST(sum(weight) OVER () AS BIGINT) AS weights,
    CAST(coalesce(sum(source_size) OVER w, 0) AS BIGINT) AS full_words,
    CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS full_weights
  FROM weighed
  WINDOW w AS (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, max((1.5::DOUBLE * words - 2 * full_words) / (weights - full_weights)) OVER () AS level FROM room
), targets AS (
  SELECT source, source_size, least(2 * source_size, weight * level) AS target FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(greatest(least(start + size, CAST(floor(target) AS BIGINT)) - start, 0)
    + greatest(least(start + size, CAST(floor(target) AS BIGINT) - source_size) - start, 0) AS BIGINT) AS taken
FROM placed
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), spoken AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM spoken GROUP BY lang
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM spoken, (VALUES (1), (2), (3)) t(k))
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT lang, phrase, k AS words, a, cut, array_to_string(p[1 : cut], ' ') AS head,
    array_to_string(p[cut + 1 :], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS p, unnest(range(1, k)) AS cut FROM f WHERE k > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, x.a AS l, y.a AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score, c.cut
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
    JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(p[i : i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, string_split(phrase, ' ') AS p, a, unnest([1, 2]) AS i FROM f WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_phrases i ON b.lang = i.lang AND b.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
""",
    "op13_prefix_trie": r"""
WITH talks AS (
  SELECT conv_id,
    list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), borrowing AS (
  SELECT conv_id, turns, CAST(xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
      lambda x, _: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))
  ), 4294967295::UBIGINT) % 9 AS BIGINT) AS h
  FROM talks
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns
  FROM borrowing c LEFT JOIN talks b ON b.conv_id = c.conv_id - c.conv_id % 5
), starts AS (
  SELECT conv_id, len(turns) AS length, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), nodes AS (
  SELECT turns[1 : depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM starts GROUP BY ALL
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.node[n.depth].text) END AS saved
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1 : n.depth - 1]
    LEFT JOIN (SELECT node[1 : depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL) c
      ON c.node = n.node
), above AS (
  SELECT node[1 : top] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM linked) GROUP BY ALL
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN above USING (node)
""",
}
