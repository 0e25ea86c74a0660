"""The operators that SQL can express, as SQL for DuckDB."""

from __future__ import annotations

from parcelpay.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, SYMBOLS, WINDOW

SPACE = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
WORDS = r"'[^\x20\x09-\x0D]+'"
#: As many levels as any tree of a table has that one machine can query: 16^6 leaves.
LEVELS = 6


def crc32(text: str) -> str:
    """The CRC-32 of an ASCII text expression, bit by bit."""
    bit = "(CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda c, k: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(name: str, tree: str) -> str:
    """Steps `{name}1` … from `{name}0` (tree, idx, digest): nodes with their parent's run, a lone node staying as it is."""
    steps = []
    for k in range(LEVELS):
        steps.append(
            f"""{name}{k}_runs AS (SELECT {tree}, idx // 16 AS parent, list(digest ORDER BY idx) AS run, any_value(n) AS n FROM
            (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {name}{k}) GROUP BY ALL),
            {name}{k + 1} AS (SELECT {tree}, parent AS idx,
            CASE WHEN n = 1 THEN run[1] ELSE sha256(list_aggregate(run, 'string_agg', '')) END AS digest FROM {name}{k}_runs)"""
        )
    return ",\n".join(steps)


def _paths(name: str, before: str, tree: str) -> str:
    """Steps that take every leaf of `{before}` (place, bent, beside) one level up at a time."""
    steps = []
    for k in range(LEVELS):
        last = before if k == 0 else f"{name}_path{k - 1}"
        mine = "(p.place % 16) + 1"
        left, right = f"run[:{mine} - 1]", f"run[{mine} + 1:]"
        steps.append(
            f"""{name}_path{k} AS (SELECT p.* EXCLUDE (place, bent, beside), p.place // 16 AS place,
            CASE WHEN r.n = 1 THEN bent ELSE sha256(coalesce(array_to_string({left}, ''), '') || bent || coalesce(array_to_string({right}, ''), '')) END AS bent,
            CASE WHEN r.n = 1 THEN beside ELSE beside || coalesce(array_to_string({left}, ''), '') || coalesce(array_to_string({right}, ''), '') END AS beside
            FROM {last} p JOIN {name}{k}_runs r ON r.{tree} IS NOT DISTINCT FROM p.{tree} AND r.parent = p.place // 16)"""
        )
    return ",\n".join(steps)


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER = LOWERED.format("text")
MERKLE = f"""
WITH rows_ AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(LOWER)} END AS other
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows_),
own0 AS (SELECT source, idx, leaf AS digest FROM leaves),
{_climb("own", "source")},
subroots AS (
    SELECT 0 AS tree, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, digest, source FROM own{LEVELS}),
top0 AS (SELECT tree, idx, digest FROM subroots),
{_climb("top", "tree")},
start AS (SELECT doc_id, source, leaf, idx AS place, coalesce(other, leaf) AS bent, '' AS beside FROM leaves),
{_paths("own", "start", "source")},
middle AS (
    SELECT p.doc_id, p.leaf, p.bent, p.beside, s.digest AS subroot, s.tree, s.idx AS place
    FROM own_path{LEVELS - 1} p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source),
{_paths("top", "middle", "tree")}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(beside) AS proof_sha256, bent AS folded_root, bent = r.digest AS verified
FROM top_path{LEVELS - 1} CROSS JOIN (SELECT digest FROM top{LEVELS}) r
"""



SHINGLES = f"""
WITH RECURSIVE words_ AS (
    SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, {WORDS}) AS w FROM documents),
sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(len(w) - 2), lambda i: array_to_string(w[i + 1:i + 3], ' ')) END)) AS s
    FROM words_),
classes AS (SELECT s, row_number() OVER () AS k, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s),
entries AS (SELECT k, len(s) AS n, unnest(s) AS g FROM classes),
links AS (
    SELECT a.k AS a, b.k AS b FROM entries a JOIN entries b ON a.g = b.g AND a.k <> b.k
    GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT k, k AS other FROM classes UNION SELECT r.k, l.b FROM reach r JOIN links l ON l.a = r.other),
firsts AS (SELECT r.k, min(c.least) AS component FROM reach r JOIN classes c ON c.k = r.other GROUP BY r.k)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(f.component, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN firsts f ON f.k = c.k
"""


def _rules() -> str:
    broken = []
    for rule in RULES:
        metric = "n_words" if rule.metric == "words_per_text" else rule.metric
        tests = [f"{metric} < {rule.least}"] if rule.least is not None else []
        tests += [f"{metric} > {rule.most}"] if rule.most is not None else []
        broken.append(f"(n_words >= {rule.from_words} AND ({' OR '.join(tests)}))")
    return " OR ".join(broken)


STOPS = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
QUALITY = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w
    FROM documents),
windows AS (
    SELECT r, i, w[i + 1:i + {WINDOW}] AS g FROM texts, unnest(range(greatest(len(w) - {WINDOW - 1}, 0))) AS x(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) AS y(k) GROUP BY r),
counts AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(translate(t, {SPACE}, '')) AS word_chars,
        length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS exclamations,
        list_filter(string_split(t, chr(10)), lambda x: length(translate(x, {SPACE}, '')) > 0) AS kept_lines,
        coalesce(p.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: list_contains({STOPS}, lower(x)))) AS stops
    FROM texts LEFT JOIN repeats p ON p.r = texts.r),
ratios AS (
    SELECT *, len(kept_lines) - len(list_distinct(kept_lines)) AS n_dup_lines,
        coalesce(100 * n_repeat_words / nullif(n_words, 0), 0.0) AS repeat_percent,
        coalesce(word_chars / nullif(n_words, 0), 0.0) AS mean_word_chars,
        coalesce(n_symbols / nullif(n_words, 0), 0.0) AS symbols_per_word,
        coalesce(exclamations / nullif(n_words, 0), 0.0) AS exclamations_per_word,
        coalesce(stops / nullif(n_words, 0), 0.0) AS stop_word_share,
        coalesce((len(kept_lines) - len(list_distinct(kept_lines))) / nullif(len(kept_lines), 0), 0.0) AS dup_line_share,
        n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM counts)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT (base_failed OR {_rules()}) AS kept, repeat_percent, mean_word_chars, symbols_per_word, exclamations_per_word,
    dup_line_share, stop_word_share
FROM ratios
"""

ARCHIVES = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
digests AS (SELECT *, sha1(payload) AS hexed FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
        ((CAST('0x' || substr(hexed, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '')
        AS payload_digest,
    CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> least THEN least END AS refers_to
FROM digests
"""


def _shown(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), ' ')"


#: One step of a repaired conversation: the next turn with none, one or two turns inserted before it, each with an edit.
#: States are 0 (empty), 1 (after the system turn), 2 (after a user), 3 (after an assistant).
REPAIR = f"""
WITH RECURSIVE fates AS (
    SELECT conv_id, turn, {_shown("role")} AS role, {_shown("text")} AS text,
        {crc32(_shown("conv_id") + " || ':' || " + _shown("turn"))} % 20 AS fate FROM conversations),
hurt AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM fates, range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || ':' || text)) AS i,
        rtrim(text, {SPACE}) AS bare FROM hurt),
turns AS (
    SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS initial,
        CASE WHEN bare = '' THEN 'blank'
             WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
             WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM turns GROUP BY conv_id),
inserts AS (
    SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
        (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'),
        (3, 2, 5, 'I', chr(10) || 'user:'), (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (2, 2, 10, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
        (3, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')) AS v(q, p, price, letters, added)),
steps AS (
    SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS v(q, initial, p)),
paths AS (
    SELECT conv_id, 0 AS i, 0 AS q, {{'cost': 0, 'audit': '', 'lines': ''}} AS best FROM faults
    UNION ALL
    SELECT conv_id, i, q, min(best) AS best FROM (
        SELECT p.conv_id, CAST(t.i AS INTEGER) AS i, e.q, {{'cost': CAST(p.best.cost + s.price + e.price AS INTEGER),
            'audit': p.best.audit || s.letters || e.letter, 'lines': p.best.lines || s.added || e.line}} AS best
        FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
        JOIN inserts s ON s.q = p.q, LATERAL (
            SELECT s.p AS q, 2 AS price, 'D' AS letter, '' AS line
            UNION ALL SELECT m.p, CASE t.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || t.role || ':' || t.text
            FROM steps m WHERE m.q = s.p AND m.initial = t.initial AND t.fault IN ('', 'truncated')
            UNION ALL SELECT m.p, CASE t.fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
                chr(10) || CASE m.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || t.text
            FROM steps m WHERE m.q = s.p AND m.initial <> 's' AND t.fault IN ('', 'truncated')) e) q
    GROUP BY conv_id, i, q),
ends AS (
    SELECT p.conv_id, min({{'cost': p.best.cost + s.price, 'audit': p.best.audit || s.letters, 'lines': p.best.lines || s.added}}) AS best
    FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i
    JOIN inserts s ON s.q = p.q AND s.p IN (0, 3) GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
    coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": SHINGLES,
    "op5_quality_rules": QUALITY,
    "op9_warc_archives": ARCHIVES,
    "op12_merkle_manifest": MERKLE,
    "op13_conversation_repair": REPAIR,
}
