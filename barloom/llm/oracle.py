"""What SQL can express of the queries, written from their definitions for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# A line is a set of words; pairs of different sets are found over the rarest words of each.
ORACLE["op3_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, n - 1 AS line,
    list_sort(list_distinct(list_filter(regexp_split_to_array(lower(parts[n]), '[ \t-\r]+'), lambda w: w <> ''))) AS words
  FROM split, unnest(range(1, len(parts) + 1)) AS u(n) WHERE doc_id IS NOT NULL),
sets AS (
  SELECT words, len(words) AS size, min(row(doc_id, line)) AS first FROM lines WHERE len(words) > 0 GROUP BY words),
held AS (SELECT first, size, words, unnest(words) AS word FROM sets WHERE size > 3),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY first ORDER BY copies, word) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY word) AS copies FROM held)),
early AS (SELECT * FROM ranked WHERE place <= size - ceil(0.8 * size) + 1),
close AS (
  SELECT DISTINCT b.first FROM early AS a JOIN early AS b
    ON a.word = b.word AND a.first < b.first AND 5 * least(a.size, b.size) >= 4 * greatest(a.size, b.size)
  WHERE 9 * len(list_intersect(a.words, b.words)) >= 4 * (a.size + b.size)),
gone AS (
  SELECT doc_id, line FROM lines JOIN sets USING (words)
  WHERE row(doc_id, line) <> first OR first IN (SELECT first FROM close))
SELECT d.doc_id, coalesce(len(parts), 0) AS n_lines, count(g.line) AS n_removed,
  coalesce(string_agg(g.line, ',' ORDER BY g.line), '') AS removed_lines
FROM split AS d LEFT JOIN gone AS g ON g.doc_id = d.doc_id GROUP BY d.doc_id, parts"""

ORACLE["op7_decontamination"] = r"""
WITH worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
asked AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
tests AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, words[k:k + least(len(words), 10) - 1] AS phrase
  FROM asked, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS u(k) WHERE len(words) > 0),
places AS (
  SELECT doc_id, size, k, words[k:k + size - 1] AS phrase
  FROM worded, (SELECT DISTINCT size FROM tests), unnest(range(1, len(words) - size + 2)) AS u(k)),
found AS (SELECT doc_id, k, size, item FROM places JOIN tests USING (size, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(k, k + size)) AS u(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM worded LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE["op8_quality_rules"] = r"""
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM documents),
windows AS (
  SELECT doc_id, k, words[k:k + 4] AS five FROM worded, unnest(range(1, len(words) - 3)) AS u(k)),
twice AS (SELECT doc_id, k FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(k, k + 5)) AS u(p) GROUP BY doc_id),
told AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[ \t-\r]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS capitals, length(regexp_replace(text, '\P{L}+', '', 'g')) AS letters
  FROM worded LEFT JOIN repeats USING (doc_id)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM told)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
       OR word_chars > 40 * n_words OR (n_words >= 10 AND letters > 0 AND capitals / letters > 0.6)) AS kept
FROM failed"""

#: Levels of runs that the SQL goes through: 16**8 rows of a source, 16**4 sources.
_LEVELS, _OVER = 8, 4
_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _told(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_told, (*_FIELDS, text)))})"


def _climb(first: str, name: str, levels: int) -> list[str]:
    """Runs of each level over ``first`` (tree, idx, n, h), then the nodes that they become."""
    out, nodes = [], first
    for k in range(levels):
        out.append(f"""{name}_run{k} AS (
  SELECT tree, idx // 16 AS up, any_value(n) AS n, list(h ORDER BY idx) AS hs FROM {nodes} GROUP BY tree, idx // 16)""")
        out.append(f"""{name}{k + 1} AS (
  SELECT tree, up AS idx, CASE WHEN n > 1 THEN (n + 15) // 16 ELSE 1 END AS n,
    CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}_run{k})""")
        nodes = f"{name}{k + 1}"
    return out


def _prove(docs: str, runs: str, tree: str, place: str, levels: int, name: str) -> list[str]:
    """Documents with proof and fold carried over the levels of their tree."""
    out = []
    for k in range(levels):
        slot = f"({place} // {16 ** k}) % 16"
        left, right = f"array_to_string(hs[1:{slot}], '')", f"array_to_string(hs[{slot} + 2:], '')"
        out.append(f"""{name}{k} AS (
  SELECT d.* REPLACE (CASE WHEN r.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof,
                      CASE WHEN r.n > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold)
  FROM {docs} AS d JOIN {runs}_run{k} AS r ON r.tree = d.{tree} AND r.up = d.{place} // {16 ** (k + 1)})""")
        docs = f"{name}{k}"
    return out


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::UBIGINT)),
    lambda y, i: xor(y // 2, 3988292384::UBIGINT * (y % 2)))))"""
ORACLE["op11_merkle"] = f"""
WITH hashed AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS fold, '' AS proof FROM documents),
placed AS (
  SELECT *, '' AS over, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM hashed),
leaves AS (SELECT tree, idx, n, leaf AS h FROM placed),
{(',' + chr(10)).join(_climb('leaves', 'a', _LEVELS))},
trees AS (
  SELECT '' AS tree, a{_LEVELS}.tree AS name, row_number() OVER (ORDER BY a{_LEVELS}.tree) - 1 AS idx, count(*) OVER () AS n, h
  FROM a{_LEVELS}),
{(',' + chr(10)).join(_climb('trees', 'b', _OVER))},
{(',' + chr(10)).join(_prove('placed', 'a', 'tree', 'idx', _LEVELS, 'p'))},
joined AS (
  SELECT p.*, t.idx AS tree_idx, t.h AS subroot, r.h AS root FROM p{_LEVELS - 1} AS p
  JOIN trees AS t ON t.name = p.tree CROSS JOIN b{_OVER} AS r),
{(',' + chr(10)).join(_prove('joined', 'b', 'over', 'tree_idx', _OVER, 'q'))}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM q{_OVER - 1}"""

ORACLE["op12_ngram_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda w: w <> '') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
    range(1, greatest(len(words) - 3, 1) + 1), lambda k: array_to_string(words[k:k + 3], ' ')))) END AS s FROM worded),
classes AS (SELECT s, len(s) AS n, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
posts AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
shared AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n + b.n) AS total, count(*) AS k FROM posts AS a JOIN posts AS b
    ON a.shingle = b.shingle AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
edges AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (total - k)),
ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (SELECT rep AS node, rep AS root FROM classes UNION SELECT w.b, r.root FROM reach AS r JOIN ways AS w ON w.a = r.node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(s) AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM sets LEFT JOIN classes USING (s) LEFT JOIN roots ON node = rep"""
