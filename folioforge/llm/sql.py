"""The same results in DuckDB SQL, where SQL can express them."""

OP6 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

OP3 = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), n AS (
  SELECT *, length(text) + length(role) + length(regexp_replace(text || role, '[^\\<>]', '', 'g')) + length('<turn:') + 2 + length('</turn>') + 1 AS width
  FROM c
), o AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
    string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn NULLS FIRST, role, text) AS shape,
    sum(width)::BIGINT AS formatted_chars
  FROM n GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  formatted_chars, regexp_full_match(shape, 's?(ua)+') AS valid
FROM o
"""


OP8 = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line, coalesce(len(p), 0) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)
), f AS (
  SELECT doc_id, line_no, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS flat FROM l
), d AS (
  SELECT flat, min(struct_pack(d := doc_id, l := line_no)) AS first, string_split(flat, ' ') AS w FROM f WHERE flat <> '' GROUP BY flat
), v AS (
  SELECT flat, first, 0 AS i, w AS v FROM d WHERE len(w) >= 8
  UNION ALL
  SELECT flat, first, i, list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, len(w))) AS v
  FROM (SELECT flat, first, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= 8)
), p AS (
  SELECT DISTINCT a.flat FROM v a JOIN v b ON a.v = b.v AND a.flat <> b.flat AND b.first < a.first
    AND ((a.i = 0) <> (b.i = 0) OR a.i = b.i)
), g AS (
  SELECT f.doc_id, f.line_no, f.line, f.flat <> '' AND (p.flat IS NOT NULL OR d.first < struct_pack(d := f.doc_id, l := f.line_no)) AS gone
  FROM f LEFT JOIN d ON d.flat = f.flat LEFT JOIN p ON p.flat = f.flat
), k AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (coalesce(gone, false)) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT coalesce(gone, false)), '') AS kept
  FROM g GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
"""


# Bytes as pairs of hex digits; 50-byte windows by two hashes, their smallest document, and the spans that windows of larger ones cover.
OP5 = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM h)
), k AS (SELECT doc_id, i, hash(s) AS a, md5_number_lower(s) AS b FROM w
), f AS (SELECT a, b, min(doc_id) AS low FROM k GROUP BY a, b
), g AS (SELECT k.doc_id, i, lag(i) OVER (PARTITION BY k.doc_id ORDER BY i) AS before FROM k JOIN f USING (a, b) WHERE low < k.doc_id
), n AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g
), r AS (SELECT doc_id, span, min(i) AS first, max(i) + 50 AS last FROM n GROUP BY doc_id, span
), p AS (SELECT doc_id, span, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS from_ FROM r
), c AS (
  SELECT p.doc_id, count(*) AS n_spans, sum(last - first) AS n_removed, max(last) AS last, string_agg(substr(h, 2 * from_ + 1, 2 * (first - from_)), '' ORDER BY first) AS head
  FROM p JOIN h USING (doc_id) GROUP BY p.doc_id
)
SELECT h.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN c USING (doc_id)
"""

# Sets of word shingles, links by their overlap, and the smallest id that links reach.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) > 4 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w
), u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= __SHARE__ * (a.n + b.n - count(*))
), r(id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.id
), c AS (SELECT id, min(low) AS component_id FROM r GROUP BY id)
SELECT doc_id, len(s) AS n_shingles, component_id__KEPT__ FROM s JOIN c ON c.id = s.doc_id
"""
OP2 = JACCARD.replace("__SHARE__", "75").replace("__KEPT__", ", doc_id = component_id AS kept")
OP12 = JACCARD.replace("__SHARE__", "80").replace("__KEPT__", "")

OP13 = """
WITH RECURSIVE t AS (
  SELECT doc_id, lang, coalesce('1' || lang, '0') AS tree, CASE WHEN crc % 3 = 0 THEN TRUE ELSE FALSE END AS changed,
    sha256(parts || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(parts || coalesce(strlen(small) || ':' || small, '-')) AS other
  FROM (
    SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS parts,
      list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda x, y: __STEP__) AS low
    FROM documents
  ) s, LATERAL (SELECT xor(low, 4294967295::BIGINT) AS crc)
), l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM t
), a(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM l
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY pos)) FROM a WHERE n > 1 GROUP BY tree, pos // 8
), r AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM a WHERE n = 1
), b(level, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM r
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY pos)) FROM b WHERE n > 1 GROUP BY pos // 8
), runs AS (
  SELECT 0 AS part, tree, level, pos // 8 AS run, list(digest ORDER BY pos) AS own FROM a WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1, r.tree, b.level, b.pos // 8, list(b.digest ORDER BY b.pos) FROM b JOIN r ON r.pos // (8 ** (b.level + 1))::BIGINT = b.pos // 8 WHERE b.n > 1 GROUP BY ALL
), steps AS (
  SELECT l.doc_id, l.leaf, l.pos, l.tree, 0 AS part, x.level, l.pos // (8 ** x.level)::BIGINT % 8 AS k, x.own
  FROM l JOIN runs x ON x.part = 0 AND x.tree = l.tree AND x.run = l.pos // (8 ** (x.level + 1))::BIGINT
  UNION ALL
  SELECT l.doc_id, l.leaf, l.pos, l.tree, 1, x.level, r.pos // (8 ** x.level)::BIGINT % 8, x.own FROM l JOIN r USING (tree) JOIN runs x ON x.part = 1 AND x.tree = l.tree
), path AS (
  SELECT tree, pos, list(struct_pack(k := k, own := own) ORDER BY part, level) AS steps,
    string_agg(array_to_string(list_concat(own[:k], own[k + 2:]), ''), '' ORDER BY part, level) AS others
  FROM steps GROUP BY tree, pos
), f(tree, pos, step, digest) AS (
  SELECT tree, pos, 0, CASE WHEN changed THEN other ELSE leaf END FROM l
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(array_to_string(list_concat(p.steps[f.step + 1].own[:p.steps[f.step + 1].k], [f.digest], p.steps[f.step + 1].own[p.steps[f.step + 1].k + 2:]), ''))
  FROM f JOIN path p ON p.tree = f.tree AND p.pos = f.pos WHERE f.step < len(p.steps)
), e AS (SELECT tree, pos, max_by(digest, step) AS folded_root FROM f GROUP BY tree, pos
)
SELECT l.doc_id, l.leaf, r.subroot, (SELECT digest FROM b WHERE n = 1) AS root, sha256(coalesce(p.others, '')) AS proof_sha256, e.folded_root,
  e.folded_root = (SELECT digest FROM b WHERE n = 1) AS verified
FROM l JOIN r USING (tree) JOIN e ON e.tree = l.tree AND e.pos = l.pos LEFT JOIN path p ON p.tree = l.tree AND p.pos = l.pos
"""
# One byte of a CRC-32, bit by bit.
_BIT = "xor(({0}) >> 1, 3988292384::BIGINT * (({0}) & 1))"


def op13() -> str:
    """The checksum of doc_id is taken digit by digit, in steps of eight bits."""
    bits = "range(8)"
    step = f"list_reduce(list_prepend(xor(x, y), {bits}), lambda u, v: {_BIT.format('u')})"
    return OP13.replace("__STEP__", step)


def op4() -> str:
    from .licenses import ALL_RIGHTS, COPYRIGHT, MARKS, SPELLINGS, known_digests

    spaced = lambda words: " " + words.replace(" ", "  ") + " "

    c = f"regexp_replace(regexp_replace(unit, '{COPYRIGHT}', ' ', 'g'), '{ALL_RIGHTS}', ' ', 'g')"
    c = f"' ' || regexp_replace(lower({c}), '{MARKS}', '  ', 'g') || ' '"
    for old, new in SPELLINGS:
        c = f"replace({c}, '{spaced(old)}', '{spaced(new)}')"
    known = ", ".join(f"('{d}', '{n}')" for d, n in known_digests())
    return f"""
WITH known(digest, license) AS (VALUES {known}),
u AS (
  SELECT doc_id, 'text' AS scope, -1::INTEGER AS line_no, text AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line', unnest(range(len(p)))::INTEGER, unnest(p) FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)
), c AS (SELECT doc_id, scope, line_no, regexp_replace(trim({c}, ' '), ' +', ' ', 'g') AS canon FROM u)
SELECT doc_id, scope, line_no, license FROM c JOIN known ON sha256(canon) = digest WHERE canon <> ''
"""


ORACLE = {
    "op2_lsh_forest_near_dedup": OP2, "op5_suffix_array_dedup": OP5, "op12_jaccard_join": OP12,
    "op3_block_matrix_ann": OP3, "op4_license_scan": op4(), "op6_exact_dedup": OP6, "op8_line_dedup": OP8, "op10_chat_format": OP10,
    "op13_merkle_manifest": op13(),
}
