"""The same results in DuckDB SQL."""

from __future__ import annotations

from ..operators.chapters import SECTIONS
from ..operators.entities import COMMON_TERMS
from ..operators.quality import CHAPTER_FIELDS, CHUNK_FIELDS, METADATA_FIELDS
from ..operators.translate import CHAPTER_KEYS, PAYLOAD
from .queries import PART_WORDS, REQUEST

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _words(c: str) -> str:
    return rf"len(regexp_extract_all(coalesce({c}, ''), '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_''-]*'))"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '\A{_SPACE}+|{_SPACE}+\z', '', 'g')"


def _sentences(c: str) -> str:
    split = rf"string_split(regexp_replace({_strip(f'''coalesce({c}, '')''')}, '([.!?]){_SPACE}+', '\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({split}, lambda x: {_strip('x')}), lambda x: x <> '')"


def _parts(limit: int) -> str:
    """WITH RECURSIVE ... parts(doc_id, part_no, part): documents packed sentence by sentence."""
    return rf"""
        WITH RECURSIVE s AS (SELECT doc_id, {_sentences('text')} AS p FROM documents),
        c AS (SELECT doc_id, list_transform(p, lambda x: {_words('x')}) AS n, len(p) AS k FROM s),
        r(doc_id, i, g, w, open) AS (
          SELECT doc_id, 0::BIGINT, 0::BIGINT, 0::BIGINT, false FROM c
          UNION ALL
          SELECT r.doc_id, i + 1,
            CASE WHEN n[i + 1] > {limit} OR NOT open OR w + n[i + 1] > {limit} THEN g + 1 ELSE g END,
            CASE WHEN n[i + 1] > {limit} THEN 0 WHEN NOT open OR w + n[i + 1] > {limit} THEN n[i + 1] ELSE w + n[i + 1] END,
            n[i + 1] <= {limit}
          FROM r JOIN c ON c.doc_id = r.doc_id WHERE i < k
        ), t AS (SELECT r.doc_id, i, g, open, p[i] AS sentence FROM r JOIN s ON s.doc_id = r.doc_id WHERE i > 0),
        o AS (
          SELECT doc_id, g, 0 AS k, string_agg(sentence, ' ' ORDER BY i) AS part FROM t WHERE open GROUP BY doc_id, g
          UNION ALL
          SELECT doc_id, g, k, list_aggregate(list_slice(x, k * {limit} + 1, (k + 1) * {limit}), 'string_agg', ' ')
          FROM (SELECT doc_id, g, x, unnest(range((len(x) - 1) // {limit} + 1)) AS k FROM
            (SELECT doc_id, g, list_filter(string_split(regexp_replace(sentence, '{_SPACE}+', chr(1), 'g'), chr(1)), lambda y: y <> '') AS x FROM t WHERE NOT open))
        ), parts AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g, k) - 1)::INTEGER AS part_no, part FROM o)"""


_PAGE = """(CASE WHEN doc_id % 3 = 0 THEN ' ' || (doc_id % 1200)::VARCHAR || chr(10) ELSE '' END || '=====' || chr(10)
  || replace(coalesce(text, ''), '. ', '.  ' || chr(10) || chr(10) || chr(10) || chr(10) || '  ')
  || chr(10) || chr(10) || chr(10) || '-.-.-' || chr(10) || 'xiv' || chr(10) || '....'
  || CASE WHEN doc_id % 3 = 1 THEN chr(10) || (doc_id % 1200)::VARCHAR || ' ' || chr(10) ELSE chr(10) END)"""
_LINES = f"list_transform(string_split(regexp_replace({_PAGE}, '{_END}', chr(10), 'g'), chr(10)), lambda x: {_strip('x')})"

_PAIRS = """(SELECT conv_id, turn, text AS question, answer FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
) WHERE role = 'user' AND next_role = 'assistant')"""

# Conversations as chapters (ch) and their questions (qs), as the queries shape them.
_CHAPTERS = f"""
qs AS (
  SELECT *, CASE (turn // 2) % 3 WHEN 0 THEN 'narrative' WHEN 1 THEN 'direct_answer' ELSE 'multiple_choice' END AS answer_type,
    CASE WHEN turn % 4 = 0 THEN ['user', 'assistant'] ELSE []::VARCHAR[] END AS key_entities FROM {_PAIRS}
), ch AS (
  SELECT DISTINCT conv_id, conv_id AS n, 'Group ' || conv_id % 6 || ' Kanda' AS kanda, CASE WHEN conv_id % 5 <> 0 THEN (conv_id + 1) || '-' || (conv_id + 2) END AS sarga_range,
    CASE WHEN conv_id % 7 <> 0 THEN 'About ' || conv_id END AS summary, CASE WHEN conv_id % 2 = 1 THEN ['assistant'] ELSE []::VARCHAR[] END AS entities,
    CASE WHEN conv_id % 3 = 0 THEN ['Here', 'There'] ELSE []::VARCHAR[] END AS places, 'chat_group_' || conv_id % 6 || '_' || printf('%03d', conv_id) AS base FROM qs
), tx AS (
  SELECT conv_id, -1 AS turn, base || '_summary' AS chunk_id, 'chapter_summary' AS chunk_type, entities,
    'Kanda: ' || kanda || chr(10) || 'Chapter ' || n || ': Conversation ' || n || chr(10) || 'Sarga range: ' || coalesce(sarga_range, 'None') || chr(10)
    || 'Primary entities: ' || CASE WHEN len(entities) = 0 THEN 'None listed' ELSE list_aggregate(entities, 'string_agg', ', ') END || chr(10)
    || 'Places: ' || CASE WHEN len(places) = 0 THEN 'None listed' ELSE list_aggregate(places, 'string_agg', ', ') END || chr(10)
    || 'Themes: None listed' || chr(10) || chr(10) || 'Summary: ' || coalesce(summary, 'None') AS text
  FROM ch
  UNION ALL
  SELECT conv_id, turn, base || '_q' || printf('%03d', turn), CASE answer_type WHEN 'narrative' THEN 'qa_narrative' WHEN 'direct_answer' THEN 'qa_direct_answer' ELSE 'qa_multiple_choice' END,
    CASE WHEN len(key_entities) > 0 THEN key_entities ELSE entities END,
    'Kanda: ' || kanda || chr(10) || 'Chapter ' || n || ': Conversation ' || n || chr(10) || 'Sarga range: ' || coalesce(sarga_range, 'None') || chr(10)
    || 'Primary entities: ' || CASE WHEN len(key_entities) > 0 THEN 'user, assistant' WHEN len(entities) = 0 THEN 'None listed' ELSE list_aggregate(entities, 'string_agg', ', ') END || chr(10)
    || 'Question ' || turn || ': ' || coalesce(question, 'None') || chr(10)
    || CASE WHEN answer_type = 'multiple_choice' THEN 'Options:' || chr(10) || '1. ' || left(answer, 20) || chr(10) || '2. ' || left(question, 20) || chr(10) || 'Correct answer: ' || left(answer, 20)
       ELSE 'Answer: ' || coalesce({_strip('answer')}, '') END
  FROM qs JOIN ch USING (conv_id)
)"""

_preview_list = lambda c: f"CASE WHEN len({c}) = 0 THEN 'None listed' ELSE list_aggregate({c}, 'string_agg', ', ') END"
_common = ", ".join(f"'{t}'" for t in COMMON_TERMS)
_sections = ", ".join(f"('{n}', {a}, {b}, {o}, '{p}')" for n, a, b, o, p in SECTIONS)
_root = ", ".join(f"'{f}'" for f in CHUNK_FIELDS)
_meta = ", ".join(f"'{f}'" for f in METADATA_FIELDS)
_chapter = ", ".join(f"'{f}'" for f in CHAPTER_FIELDS)
_sqlkeys = ", ".join(f"''{k}''" for k in sorted(CHAPTER_KEYS))
_letters = "trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g'))"
_single = lambda c: f"trim(regexp_replace({c}, ' +', ' ', 'g'))"
#: A page's clean text, which is empty if it looks like a roman number, and what a chapter takes of the page then.
_cleaned = lambda c: rf"CASE WHEN regexp_matches(trim({c}), '\A[ivxlcdmIVXLCDM]{{1,8}}\z') THEN '' ELSE trim({c}) END"
_shown = lambda c: f"CASE WHEN {_cleaned(c)} = '' THEN {c} ELSE {_cleaned(c)} END"
#: Canonical name, category and pattern of the phrases in order of their claims. Every character that isn't a letter is doubled
#: before, so that neighbours need not share one as their boundary.
_PHRASES = [("AndThe", "supporting", f"and{_SPACE}+the"), ("OfThe", "place", f"of{_SPACE}+the"), ("InThe", "place", f"in{_SPACE}+the"), ("The", "sage", "the"), ("And", "deity", "and"), ("Of", "primary", "of")]
_claims = ", ".join(
    rf"c{i + 1} AS (SELECT *, list_distinct(list_transform(regexp_extract_all(x{i}, '(?i)(?:^|[^A-Za-z])({w})(?:$|[^A-Za-z])', 1), lambda y: lower(y))) AS k{i + 1}, "
    rf"regexp_replace(x{i}, '(?i)(^|[^A-Za-z]){w}($|[^A-Za-z])', '\1#\2', 'g') AS x{i + 1} FROM {f'c{i}' if i else 's'})" for i, (_, _, w) in enumerate(_PHRASES))

ORACLE = {
    "word_count_by_doc": f"SELECT doc_id, {_words('text')} AS words FROM documents",
    "size_class": f"""
        SELECT CASE WHEN w < 350 THEN 'short' WHEN w <= 750 THEN 'ideal' WHEN w <= 1100 THEN 'long' ELSE 'oversize' END AS size_class, count(*) AS n
        FROM (SELECT {_words('text')} AS w FROM documents) GROUP BY 1""",
    "sentences_exploded": f"""
        WITH s AS (SELECT doc_id, {_sentences('text')} AS p FROM documents)
        SELECT doc_id, sentence_no::INTEGER AS sentence_no, sentence, {_words('sentence')} AS words
        FROM (SELECT doc_id, unnest(range(len(p))) AS sentence_no, unnest(p) AS sentence FROM s)""",
    "narrative_parts": _parts(PART_WORDS) + " SELECT doc_id, part_no, md5(part) AS part_md5, length(part) AS part_chars FROM parts",
    "clean_page_lines": rf"""
        WITH l AS (SELECT doc_id, list_filter({_LINES}, lambda x: NOT regexp_matches(x, '\A(?:\p{{Nd}}{{1,4}}|[ivxlcdmIVXLCDM]{{1,8}}|[.\-_=]{{5,}})\z')) AS p FROM documents),
        t AS (SELECT doc_id, {_strip(rf"regexp_replace(coalesce(list_aggregate(list_transform(p, lambda x: regexp_replace(x, '{_SPACE}+', ' ', 'g')), 'string_agg', chr(10)), ''), '\n{{3,}}', chr(10) || chr(10), 'g')")} AS t FROM l)
        SELECT doc_id, md5(t) AS clean_md5, length(t) AS clean_chars FROM t""",
    "printed_page": rf"""
        WITH l AS (SELECT doc_id, list_filter({_LINES}, lambda x: x <> '') AS p FROM documents)
        SELECT doc_id, list_filter(list_concat(p[1:5], p[greatest(len(p) - 4, 1):len(p)]), lambda x: regexp_matches(x, '\A\p{{Nd}}{{1,4}}\z'))[1] AS printed_page_number FROM l""",
    "page_counts": f"SELECT count(*) AS pages, count(*) FILTER ({_strip('coalesce(text, chr(32))')} <> '') AS filled_pages FROM documents",
    "qa_pairs": f"SELECT * FROM {_PAIRS}",
    "qa_chunks": f"WITH {_CHAPTERS} SELECT chunk_id, chunk_type, coalesce(list_aggregate(entities, 'string_agg', ','), '') AS entities, md5({_strip('text')}) AS text_md5, length({_strip('text')}) AS chars FROM tx",
    "chunk_counts": f"WITH {_CHAPTERS} SELECT chunk_type, count(*) AS n FROM tx GROUP BY 1",
    "conversation_index": f"""
        WITH {_CHAPTERS} SELECT n::INTEGER AS chapter_number, 'conv_' || printf('%03d', n) AS chapter_id, kanda, (n % 6)::INTEGER AS kanda_order, 'Conversation ' || n AS chapter_title, sarga_range,
          '[' || n || ', ' || (n + 1) || ']' AS source_pdf_pages, '["' || n || '"]' AS printed_page_numbers, (count(*) - 1)::INTEGER AS question_count, count(*)::INTEGER AS chunk_count,
          '["' || string_agg(chunk_id, '", "' ORDER BY turn) || '"]' AS chunk_ids
        FROM tx JOIN ch USING (conv_id) GROUP BY n, kanda, sarga_range""",
    "answer_types": f"WITH {_CHAPTERS} SELECT answer_type, count(*) AS n FROM qs GROUP BY 1",
    "chapter_previews": f"""
        WITH {_CHAPTERS}, q AS (
          SELECT conv_id, string_agg('#### Q' || turn || chr(10) || chr(10) || '**Question:** ' || question || chr(10) || chr(10)
            || CASE WHEN answer_type = 'multiple_choice' THEN '**Options:**' || chr(10) || '- 1. ' || left(answer, 20) || chr(10) || '- 2. ' || left(question, 20) || chr(10) || chr(10) || '**Correct answer:** ' || left(answer, 20)
               ELSE '**Answer:** ' || answer END || chr(10) || chr(10) || '**Key entities:** ' || {_preview_list('key_entities')} || chr(10), chr(10) ORDER BY turn) AS t FROM qs GROUP BY conv_id
        )
        SELECT n::INTEGER AS chapter_number, md5('### Chapter ' || n || ': Conversation ' || n || chr(10) || chr(10) || '- Kanda: ' || kanda || chr(10) || '- Sarga range: ' || coalesce(sarga_range, 'None') || chr(10)
          || '- Source PDF pages: ' || n || ', ' || (n + 1) || chr(10) || '- Printed page numbers: ' || n || chr(10) || '- Key entities: ' || {_preview_list('entities')} || chr(10) || '- Places: ' || {_preview_list('places')} || chr(10)
          || chr(10) || '**Summary:** ' || coalesce(summary, 'None') || chr(10) || chr(10) || t) AS preview_md5
        FROM ch JOIN q USING (conv_id)""",
    "quality_summary": f"""
        WITH {_CHAPTERS}, p AS (SELECT conv_id, count(*) AS k FROM qs GROUP BY 1)
        SELECT (SELECT count(*) FROM ch) AS detected_chapters, (SELECT sum(k)::BIGINT FROM p) AS detected_questions,
          (SELECT count(*) FROM range(1, 100) x(i) WHERE i NOT IN (SELECT n FROM ch)) AS missing_chapters, (SELECT count(*) FROM p WHERE k <> 5) AS count_issues,
          (SELECT count(*) FROM ch WHERE n % 4 = 0) AS chapters_with_candidates,
          (SELECT count(*) FROM tx) AS total_chunks, 0::BIGINT AS incomplete_chunks, 0::BIGINT AS without_question, 0::BIGINT AS without_answer,
          (SELECT count(*) FROM tx WHERE len(entities) > 0) AS chunks_with_canonical_entities, (SELECT count(*) FROM tx WHERE len(entities) = 0) AS chunks_without_entities""",
    "report_warnings": f"""
        WITH {_CHAPTERS}, w AS (
          SELECT 1 AS k, 'Parsed chapter count is ' || count(*) || ' of expected 99.' AS warning FROM ch HAVING count(*) <> 99
          UNION ALL SELECT 2, 'Parsed question count is ' || count(*) || ' of expected 495.' FROM qs HAVING count(*) <> 495
          UNION ALL SELECT 3, 'Only ' || count(*) || ' translated/normalized chapters are present; this is acceptable for the current sample run.' FROM ch WHERE n % 2 = 0 HAVING count(*) <> 99
          UNION ALL SELECT 4, 'Translation failures detected: ' || count(*) || '.' FROM labels WHERE quality = 0 HAVING count(*) > 0
          UNION ALL SELECT 5, 'final_chunks.json and final_chunks.jsonl counts do not match.' FROM tx HAVING count(*) <> 1
          UNION ALL SELECT 6, 'Some chunks have no canonical entities in metadata.' FROM tx WHERE len(entities) = 0 HAVING count(*) > 0
          UNION ALL SELECT * FROM (VALUES (7, 'Missing output file: final_chunks_jsonl_exists.'), (8, 'Missing output file: chapter_index_csv_exists.')))
        SELECT 'deepseek-chat' AS translation_model, (row_number() OVER (ORDER BY k) - 1)::INTEGER AS place, warning FROM w""",
    "chapter_schema_gaps": f"""
        WITH k AS (SELECT doc_id, list_concat(['chapter_title', 'kanda'], CASE WHEN doc_id % 4 <> 0 THEN ['questions'] ELSE [] END, CASE WHEN doc_id % 2 = 0 THEN ['places'] ELSE [] END) AS k FROM documents)
        SELECT doc_id, list_aggregate(list_concat(list_sort(list_filter([{_chapter}], lambda x: NOT list_contains(k, x))),
          CASE WHEN doc_id % 4 <> 0 AND doc_id % 3 <> 1 THEN ['questions must be a list'] ELSE [] END), 'string_agg', ',') AS gaps FROM k""",
    "entities_by_chapter": f"""
        WITH {_CHAPTERS}, f AS (
          SELECT conv_id, turn, unnest([coalesce(question, ''), CASE WHEN answer_type = 'multiple_choice' THEN coalesce(left(answer, 20), '') ELSE '' END, coalesce(answer, ''),
              CASE WHEN answer_type = 'multiple_choice' THEN coalesce(left(answer, 20), '') ELSE '' END, CASE WHEN answer_type = 'multiple_choice' THEN coalesce(left(question, 20), '') ELSE '' END]) AS x,
            unnest([true, true, answer_type <> 'multiple_choice', false, false]) AS key FROM qs
        ), w AS (SELECT *, string_split_regex(lower(x), '[^a-z]+') AS w FROM f),
        m AS (SELECT conv_id, turn, key, unnest(['The', 'And', 'Group']) AS name, unnest([list_contains(w, 'the'), list_contains(w, 'and'), list_contains(w, 'conversation')]) AS hit FROM w),
        g AS (SELECT conv_id, count(*) FILTER (hit) AS n, bool_or(hit AND name = 'The') AS the, bool_or(hit AND name = 'And') AS a FROM m GROUP BY 1),
        k AS (SELECT conv_id, list_sort(list(DISTINCT turn || ':' || name)) AS keys FROM m WHERE hit AND key GROUP BY 1)
        SELECT conv_id::INTEGER AS chapter_number, CASE WHEN the THEN 'Group,The' ELSE 'Group' END AS entities, CASE WHEN a THEN 'And' ELSE '' END AS places,
          coalesce(list_aggregate(keys, 'string_agg', ','), '') AS keys, n + 1 AS mentions, 1::BIGINT AS note_mentions, n AS question_mentions FROM g LEFT JOIN k USING (conv_id)""",
    "long_narratives": _parts(1051) + rf""",
        h AS (SELECT 'Kanda: Long Kanda' || chr(10) || 'Chapter 7: One' || chr(10) || 'Sarga range: None' || chr(10) || 'Primary entities: None listed' || chr(10) || 'Question 1: Tell it?' || chr(10) AS h),
        a AS (SELECT doc_id, {_strip("h || 'Answer: ' || " + _strip("coalesce(text, '')"))} AS x FROM documents, h), n AS (SELECT doc_id, count(*) AS n FROM parts GROUP BY 1)
        SELECT doc_id, 'chat_long_007_q001' AS chunk_id, 'qa_narrative' AS chunk_type, md5(x) AS text_md5 FROM a WHERE {_words('x')} <= 1100
        UNION ALL
        SELECT doc_id, 'chat_long_007_q001_part' || printf('%02d', part_no + 1), 'qa_narrative_part', md5({_strip("h || 'Part ' || (part_no + 1) || ' of ' || n || '.' || chr(10) || 'Answer part: ' || part")})
        FROM parts JOIN n USING (doc_id) JOIN a USING (doc_id), h WHERE {_words('x')} > 1100""",
    "chunk_metadata": f"""
        WITH {_CHAPTERS}
        SELECT chunk_id, 'Sri Ramayanamu - Prashnavali' AS document_title, 'ramayana.pdf' AS source_file, 'Telugu' AS language_original, 'English' AS language_output, kanda, (n % 6)::INTEGER AS kanda_order, n::INTEGER AS chapter_number,
          'Conversation ' || n AS chapter_title, sarga_range, CASE WHEN tx.turn >= 0 THEN tx.turn::INTEGER END AS question_number, answer_type, 'deepseek-chat' AS translation_model, '1.0.0' AS pipeline_version,
          CASE WHEN n % 3 = 0 THEN 'Here,There' ELSE '' END AS places, '' AS themes, n || ',' || (n + 1) AS source_pdf_pages, n::VARCHAR AS printed_page_numbers, 0::INTEGER AS entity_mentions
        FROM tx JOIN ch USING (conv_id) LEFT JOIN qs ON qs.conv_id = tx.conv_id AND qs.turn = tx.turn""",
    "sinks_read_back": f"""
        WITH {_CHAPTERS}, t AS (SELECT chunk_id, md5({_strip('text')}) AS digest, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM tx),
        x AS (SELECT n, kanda, sarga_range, count(*) AS k FROM tx JOIN ch USING (conv_id) GROUP BY ALL), r AS (
          SELECT 'array' AS sink, i || ' ' || chunk_id AS id, digest FROM t UNION ALL SELECT 'file', chunk_id, digest FROM t UNION ALL SELECT 'folder', chunk_id, digest FROM t
          UNION ALL SELECT 'index', 'conv_' || printf('%03d', n), md5(kanda || '|' || coalesce(sarga_range, '') || '|' || (k - 1) || '|' || k) FROM x)
        SELECT *, (SELECT count(*) FROM tx) AS lines FROM r""",
    "prompt_payload": f"""
        WITH {_CHAPTERS}, q AS (SELECT conv_id, string_agg(answer, chr(10) ORDER BY turn) AS said, count(*) AS k FROM qs GROUP BY 1)
        SELECT n::INTEGER AS chapter_number, '{",".join(sorted(PAYLOAD))}' AS keys, sarga_range, md5(coalesce(said, '')) AS text_md5, k::INTEGER AS questions FROM ch JOIN q USING (conv_id)""",
    "alias_mentions": rf"""
        WITH s AS (SELECT doc_id, regexp_replace(unnest({_sentences('text')}), '([^A-Za-z])', '\1\1', 'g') AS x0 FROM documents), {_claims}
        SELECT doc_id, canonical, category, sum(k)::BIGINT AS n FROM (
          SELECT doc_id, unnest([{", ".join(f"'{c}'" for c, _, _ in _PHRASES)}, 'On']) AS canonical, unnest([{", ".join(f"'{c}'" for _, c, _ in _PHRASES)}, 'vanara']) AS category,
            unnest([{", ".join(f"len(k{i + 1})" for i in range(len(_PHRASES)))}, CASE WHEN contains(x{len(_PHRASES)}, 'óónn') OR contains(x{len(_PHRASES)}, 'óón') THEN 1 ELSE 0 END]) AS k FROM c{len(_PHRASES)}
        ) WHERE k > 0 GROUP BY ALL""",
    "mention_counts": f"""
        WITH s AS (SELECT doc_id, unnest({_sentences('text')}) AS s FROM documents), w AS (SELECT doc_id, string_split_regex(lower(s), '[^a-z]+') AS w FROM s)
        SELECT doc_id, canonical, n FROM (
          SELECT doc_id, 'The' AS canonical, count(*) FILTER (list_contains(w, 'the')) AS n FROM w GROUP BY doc_id
          UNION ALL SELECT doc_id, 'And', count(*) FILTER (list_contains(w, 'and')) FROM w GROUP BY doc_id) WHERE n > 0""",
    "unmapped_candidate_rows": rf"""
        WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?:^|[^A-Za-z])([A-Z][A-Za-z]+(?:''s)?(?:\s+[A-Z][A-Za-z]+(?:''s)?)*)', 1) AS c FROM documents),
        e AS (SELECT doc_id, unnest(range(len(c))) AS i, unnest(c) AS candidate FROM m),
        f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(candidate) ORDER BY i) AS k FROM e
          WHERE candidate NOT IN ({_common}) AND regexp_extract(candidate, '^\S+') NOT IN ({_common})
            AND lower(candidate) NOT IN ('of', 'the', 'of the', 'and', 'and the', 'in the', 'ofthe', 'andthe', 'inthe', 'on'))
        SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS place, candidate FROM f WHERE k = 1""",
    "range_bucket": f"""
        WITH d(kanda_english, a, b, kanda_order, prefix) AS (VALUES {_sections}), p AS (SELECT (p_partkey % 99 + 1)::INTEGER AS n FROM part)
        SELECT kanda_english, kanda_order, prefix || '_' || printf('%03d', n) AS chapter_id, count(*) AS n FROM p JOIN d ON p.n BETWEEN a AND b GROUP BY ALL""",
    "missing_labels": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "missing_chapter_numbers": "SELECT i::INTEGER AS chapter_number FROM range(1, 100) x(i) WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = i)",
    "first_wins": "SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations) WHERE k = 1",
    "last_wins": "SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1",
    "chunk_schema_gaps": f"""
        WITH j AS (SELECT doc_id, ('{{' || CASE WHEN doc_id % 3 <> 0 THEN '"chunk_id":"c",' ELSE '' END || CASE WHEN doc_id % 5 <> 0 THEN '"text":' || to_json(coalesce(text, '')) || ',' ELSE '' END
          || CASE WHEN doc_id % 7 = 0 THEN '"metadata":[]}}' WHEN doc_id % 2 = 0 THEN '"metadata":{{"kanda":1,"themes":[],"places":null}}}}' ELSE '"other":0}}' END)::JSON AS j FROM documents),
        k AS (SELECT doc_id, json_keys(j) AS r, json_type(j, '$.metadata') AS t, json_keys(j, '$.metadata') AS m FROM j)
        SELECT doc_id, coalesce(list_aggregate(list_filter([{_root}], lambda x: NOT list_contains(r, x)), 'string_agg', ','), '') AS root_missing,
          CASE WHEN t = 'OBJECT' THEN coalesce(list_aggregate(list_filter([{_meta}], lambda x: NOT list_contains(m, x)), 'string_agg', ','), '')
               WHEN t IS NOT NULL THEN 'metadata must be an object' ELSE '' END AS metadata_missing FROM k""",
    "translate_audit": f"""
        WITH {_CHAPTERS}, q AS (SELECT conv_id, count(*) AS k FROM qs GROUP BY 1),
        s AS (SELECT n, k, CASE WHEN n % 5 = 0 THEN 'hit' WHEN n % 5 = 1 THEN 'bad' WHEN n % 7 = 3 THEN 'late' WHEN n % 7 = 4 THEN 'lost' WHEN n % 7 = 5 THEN 'wrong' ELSE 'good' END AS s FROM ch JOIN q USING (conv_id))
        SELECT (row_number() OVER (ORDER BY n) - 1)::INTEGER AS request_no, n::INTEGER AS chapter_number, CASE s WHEN 'hit' THEN 'cached' WHEN 'late' THEN 'translated' WHEN 'good' THEN 'translated' ELSE 'failed' END AS status,
          CASE s WHEN 'hit' THEN 0 WHEN 'bad' THEN 0 WHEN 'late' THEN 2 WHEN 'good' THEN 1 END AS attempts, CASE WHEN s IN ('bad', 'lost', 'wrong') THEN 'TranslationError' END AS error_type,
          CASE s WHEN 'bad' THEN 'Cached translation is invalid: Translated chapter missing fields: [' || '{_sqlkeys}' || ']'
                 WHEN 'lost' THEN 'no usable reply after 3 attempts: Expecting value: line 1 column 1 (char 0)' WHEN 'wrong' THEN 'Question 1 options must be a list.' END AS error,
          CASE s WHEN 'hit' THEN 0 WHEN 'late' THEN k::INTEGER WHEN 'good' THEN k::INTEGER END AS questions FROM s""",
    "toc_spans": rf"""
        WITH t AS (SELECT doc_id, doc_id AS d, {_letters} AS t FROM documents), k AS (SELECT *, length(t) // 3 AS k FROM t),
        r AS (SELECT d, substring(t, 1, k) AS r7, substring(t, k + 1, k) AS r8, substring(t, 2 * k + 1, length(t)) AS r9 FROM k),
        p AS (SELECT d, {_shown('r7')} AS p7, {_shown('r8')} AS p8, CASE WHEN d % 3 = 0 THEN trim('12, 14 సర్గలు' || chr(10) || {_cleaned('r9')}, chr(10)) ELSE {_shown('r9')} END AS p9 FROM r),
        c AS (SELECT p.*, n, CASE WHEN n = 3 AND d % 5 <> 0 THEN 9 WHEN n = 1 OR d % 4 = 0 THEN 7 ELSE 8 END AS a,
            CASE WHEN n = 1 AND d % 4 <> 0 THEN 8 WHEN n = 2 AND d % 5 <> 0 THEN 9 ELSE 10 END AS b FROM p, range(1, 4) x(n)),
        o AS (SELECT *, b >= 9 AND d % 3 = 0 AS sarga, list_filter([CASE WHEN n = 2 AND d % 4 = 0 THEN 'Could not map TOC printed page 4 to PDF page.' WHEN n = 3 AND d % 5 = 0 THEN 'Could not map TOC printed page None to PDF page.' END,
            CASE WHEN NOT (b >= 9 AND d % 3 = 0) THEN 'Could not detect Sarga range.' END], lambda w: w IS NOT NULL) AS w FROM c)
        SELECT d AS doc_id, n::INTEGER AS chapter_number, 'bala_' || printf('%03d', n) AS chapter_id, ['A', 'B', 'C'][n] AS kanda_telugu, 'Bala Kanda' AS kanda_english, ['T' || d, 'U - V', 'W'][n] AS chapter_title_telugu,
          CASE WHEN n = 1 THEN '3' WHEN n = 2 THEN '4' WHEN d % 5 <> 0 THEN '5' END AS toc_page, CASE WHEN sarga THEN '12-14' END AS sarga_range,
          list_aggregate(range(a, b + 1), 'string_agg', ',') AS pages, list_aggregate(list_filter(['3', CASE WHEN d % 4 <> 0 THEN '4' END, '5', '6'][a - 6:b - 6], lambda x: x IS NOT NULL), 'string_agg', ',') AS printed,
          md5({_strip("list_aggregate([p7, p8, p9, 'end of it'][a - 6:b - 6], 'string_agg', chr(10) || chr(10))")}) AS text_md5, coalesce(list_aggregate(w, 'string_agg', ' '), '') AS warnings, len(w) > 0 AS needs_review FROM o""",
    "toc_ends": """
        WITH p AS (SELECT p_partkey::INTEGER AS n, row_number() OVER (ORDER BY p_partkey) AS u, row_number() OVER (ORDER BY p_partkey DESC) AS d FROM part)
        SELECT n AS chapter_number, CASE WHEN u <= 10 AND d <= 10 THEN 'both' WHEN u <= 10 THEN 'head' ELSE 'tail' END AS "end" FROM p WHERE u <= 10 OR d <= 10""",
    "qa_parse": rf"""
        WITH t AS (SELECT doc_id, {_letters} AS t FROM documents), s AS (SELECT *, {_single("'x ' || left(t, 30)")} AS s, {_single("left(t, 30)")} AS b FROM t)
        SELECT doc_id, n::INTEGER AS question_number, [{_single("s || ' one?'")}, 'two?', {_single("'three ' || b || ' x?'")}, 'four?', 'five?'][n] AS question_telugu,
          ['multiple_choice', 'multiple_choice', 'direct_answer', 'narrative', 'narrative'][n] AS answer_type, CASE n WHEN 1 THEN '1=' || s || ';2=b;3=c;4=d' WHEN 2 THEN '1=' || s || ';2=no' ELSE '' END AS options,
          CASE n WHEN 1 THEN '2. b' WHEN 2 THEN '1. ' || s WHEN 3 THEN {_single("'key ' || b || ' x'")} END AS answer_key_telugu,
          CASE n WHEN 3 THEN md5({_single("'key ' || b || ' x'")}) WHEN 4 THEN md5('so ' || t || '.') WHEN 5 THEN md5('') END AS answer_md5,
          CASE n WHEN 2 THEN 'Expected 4 options, detected 2.' WHEN 5 THEN 'Missing narrative answer.' ELSE '' END AS warnings FROM s, range(1, 6) x(n)""",
    "qa_warnings": "SELECT doc_id, 5::INTEGER AS questions, 'kept Q2: Expected 4 options, detected 2. Q5: Missing narrative answer.' AS warnings, true AS needs_review FROM documents",
    "question_markers": r"""
        WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) AS t FROM documents)
        SELECT doc_id, i::INTEGER AS question_number, 'q' || i || '?' AS question_telugu, CASE WHEN i = 3 THEN 'direct_answer' ELSE 'narrative' END AS answer_type,
          CASE WHEN i <> 3 THEN length(t) END AS answer_chars FROM t, range(1, 6) x(i)""",
    "section_dimension": f"""
        SELECT d.*, count(*) AS documents FROM (VALUES {_sections}) d(kanda_english, first_chapter, last_chapter, kanda_order, prefix)
        JOIN documents ON doc_id % 99 + 1 BETWEEN first_chapter AND last_chapter GROUP BY ALL""",
    "report_heads": f"""
        WITH d AS (SELECT doc_id AS d, doc_id % 7 AS n FROM documents), l AS (SELECT doc_id AS d FROM labels WHERE quality = 0)
        SELECT (SELECT count(*) FROM d) AS detected_chapters, (SELECT sum(n)::BIGINT FROM d) AS detected_questions,
          (SELECT count(*)::INTEGER FROM range(1, 100) x(i) WHERE i NOT IN (SELECT d FROM d)) AS missing, (SELECT count(*) FROM d WHERE n <> 5) AS chapters_with_question_count_issues_count,
          (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT d FROM d WHERE n <> 5 ORDER BY d LIMIT 20)) AS issues, (SELECT count(*) FROM d) AS translated_chapters,
          (SELECT count(*) FROM l) AS failed_chapters_count, (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT d FROM l ORDER BY d LIMIT 20)) AS failed,
          (SELECT count(*) FROM d) AS chapters_missing_required_fields_count, (SELECT string_agg('themes', ',') FROM (SELECT d FROM d LIMIT 20)) AS fields, (SELECT count(*) FROM d WHERE n = 0) AS chapters_missing_questions_count,
          (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT d FROM d WHERE n = 0 ORDER BY d LIMIT 20)) AS without_questions, (SELECT count(*) FROM d) AS question_count_by_chapter_count,
          (SELECT string_agg(d || '=' || n, ',' ORDER BY d) FROM (SELECT d, n FROM d ORDER BY d LIMIT 20)) AS counts""",
    "requested_chapters": f"""
        SELECT r.request_no, conv_id::INTEGER AS chapter_number, 'Conversation ' || conv_id AS chapter_title_telugu
        FROM (VALUES {", ".join(f"({i}, {n})" for i, n in enumerate(dict.fromkeys(REQUEST)))}) r(request_no, n) JOIN {_PAIRS} p ON p.conv_id = n GROUP BY ALL""",
    "fallback_keys": rf"""
        WITH t AS (SELECT doc_id, {_letters} AS t FROM documents), s AS (SELECT doc_id, t, trim(left(t, 30)) AS s FROM t),
        k AS (SELECT doc_id, t, {_single("'2. y ' || s || ' q'")} AS k1, {_single("'k ' || s || ' k'")} AS k3 FROM s)
        SELECT doc_id, n::INTEGER AS question_number, ['multiple_choice', 'multiple_choice', 'direct_answer', 'narrative'][n] AS answer_type, CASE n WHEN 1 THEN k1 WHEN 2 THEN '1. x' WHEN 3 THEN k3 END AS answer_key_telugu,
          CASE n WHEN 3 THEN md5(k3) WHEN 4 THEN md5('so ' || t || '.') END AS answer_md5 FROM k, range(1, 5) x(n)""",
    "qa_warnings_by_row": rf"""
        WITH t AS (SELECT doc_id, list_filter(range(1, 6), lambda i: doc_id % (i + 1) <> 0) AS own FROM documents),
        w AS (SELECT doc_id, len(own) AS n, list_concat(
            CASE WHEN len(own) <> 5 THEN ['Expected 5 questions, detected ' || len(own) || '.', 'Missing question numbers: [' || array_to_string(list_filter(range(1, 6), lambda i: NOT list_contains(own, i)), ', ') || ']'] ELSE [] END,
            list_filter(list_transform(own, lambda i: CASE WHEN i = 3 THEN 'Q3: Missing answer key.' WHEN doc_id % 3 = 0 THEN 'Q' || i || ': Missing narrative answer.' END), lambda x: x IS NOT NULL)) AS w FROM t)
        SELECT doc_id, n::INTEGER AS questions, CASE WHEN n = 0 THEN 'No question starts detected.' ELSE array_to_string(w, ' ') END AS warnings, n = 0 OR len(w) > 0 AS needs_review FROM w""",
}
