"""The SQL of the word run join, the conversation repair and the spelling variants."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 a byte at a time; ``crc`` is the table of its 256 steps.
_CRC_TABLE = """
    steps AS MATERIALIZED (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
        FROM range(256) r(i)
    )
"""


def _crc(octets: str) -> str:
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"
    return f"xor({folded}, 4294967295::BIGINT)"


def _octets(text: str) -> str:
    return f"list_transform(range(strlen({text})), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"


NGRAM_JOIN = rf"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), s AS (
        SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS run
        FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    ), n AS (SELECT r, count(*) AS size FROM s GROUP BY r),
    links AS (
        SELECT x.r AS x, y.r AS y
        FROM s x JOIN s y ON x.run = y.run AND x.r <> y.r JOIN n nx ON nx.r = x.r JOIN n ny ON ny.r = y.r
        GROUP BY x.r, y.r HAVING 100 * count(*) >= 80 * (any_value(nx.size) + any_value(ny.size) - count(*))
    ), reach AS (
        SELECT r AS x, r AS y FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
    )
    SELECT d.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(other.doc_id) AS component_id
    FROM d LEFT JOIN n USING (r) JOIN reach ON reach.x = d.r JOIN d other ON other.r = reach.y
    GROUP BY d.r, d.doc_id
"""


def _add(cost: int | str, letter: str, rest: str) -> str:
    """A path (its cost in 12 digits, then its audit) with one more edit before it."""
    return f"lpad((left({rest}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || '{letter}' || substr({rest}, 13)"


def _edits(state: int, to: int) -> str:
    """The best path through row ``i`` from a state whose next message leads to ``to``."""
    keep = {0: "'u'", 1: "'u'", 2: "'a'", 3: "'u'"}[state]
    system = f"CASE WHEN NOT gone AND initial = 's' THEN {_add('more', 'K', 'b1')} END," if state == 0 else ""
    return (
        f"least({_add(4, 'D', f'b{state}')}, {system} CASE WHEN NOT gone AND initial = {keep} THEN {_add('more', 'K', f'b{to}')} END,"
        f" CASE WHEN NOT gone THEN {_add('3 + more', 'R', f'b{to}')} END)"
    )


CONVERSATION_REPAIR = rf"""
    WITH RECURSIVE {_CRC_TABLE}, raw AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
        FROM conversations
    ), kinds AS (SELECT raw.*, {_crc(_octets('key'))} % 20 AS kind FROM raw, steps),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM kinds
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place
        FROM damaged
    ), looked AS (
        SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
               NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS step
        FROM placed
    ), faulty AS (
        SELECT *, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more FROM looked
    ), counts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
               count(*) FILTER (cut AND NOT gone) AS truncated,
               count(*) FILTER (step IS NOT NULL AND step NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id
    ), best AS (
        SELECT conv_id, n AS i, '000000000000' AS b0, '000000000006II' AS b1, '000000000003I' AS b2, '000000000000' AS b3
        FROM counts
        UNION ALL
        SELECT conv_id, i - 1, least(e0, {_add(3, 'I', 'c2')}), least(e1, {_add(3, 'I', 'c2')}), c2, c3
        FROM (
            SELECT conv_id, i, e0, e1, least(e2, {_add(3, 'I', 'e3')}) AS c2, least(e3, {_add(3, 'I', 'e2')}) AS c3
            FROM (
                SELECT best.conv_id, i, {_edits(0, 2)} AS e0, {_edits(1, 2)} AS e1, {_edits(2, 3)} AS e2, {_edits(3, 2)} AS e3
                FROM best JOIN faulty ON faulty.conv_id IS NOT DISTINCT FROM best.conv_id AND faulty.place = best.i
            )
        )
    ), solved AS (
        SELECT conv_id, left(b0, 12)::BIGINT AS cost, substr(b0, 13) AS audit FROM best WHERE i = 0
    ), letters AS (
        SELECT conv_id, p, audit[p] AS letter,
               count(*) FILTER (audit[p] <> 'I') OVER upto AS place, count(*) FILTER (audit[p] <> 'D') OVER upto AS nth
        FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS p FROM solved)
        WINDOW upto AS (PARTITION BY conv_id ORDER BY p)
    ), messages AS (
        SELECT letters.*, faulty.role, faulty.text,
               count(*) FILTER (letter = 'K' AND initial = 's') OVER (PARTITION BY letters.conv_id) AS system
        FROM letters LEFT JOIN faulty
          ON faulty.conv_id IS NOT DISTINCT FROM letters.conv_id AND faulty.place = letters.place AND letter <> 'I'
    ), repaired AS (
        SELECT conv_id, string_agg(
                   CASE WHEN letter = 'K' THEN role WHEN (nth - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                   || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
        FROM messages WHERE letter <> 'D' GROUP BY conv_id
    )
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM a.conv_id
"""

SPELLING_VARIANTS = rf"""
    WITH RECURSIVE {_CRC_TABLE}, runs AS (
        SELECT key, any_value(run) AS run, count(*) AS times
        FROM (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
            WHERE length(run) >= 7
        ) GROUP BY key
    ), numbered AS (SELECT run, times, {_crc(_octets('key'))} AS h FROM runs, steps),
    words AS (
        SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
               sum(times)::BIGINT AS n
        FROM numbered GROUP BY 1 HAVING length(word) >= 7 AND sum(times) >= 2
    ), cuts AS (
        SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), near AS (
        SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
        UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
        UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest
    ), best AS (
        SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n
        FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
    ), forms AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
               CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), chain AS (
        SELECT word, form AS at FROM forms WHERE form IS NOT NULL
        UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL
    ), roots AS (
        SELECT chain.word, chain.at AS root FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NULL
    )
    SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)
"""
