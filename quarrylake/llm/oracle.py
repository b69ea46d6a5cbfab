"""SQL of the manifest, mixture and divergence queries, for a database that runs it beside Spark."""

from __future__ import annotations

from quarrylake.llm.mixture import BLOCK

_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = " || ".join(
    _FIELD.format(f"CAST({name} AS VARCHAR)") for name in ("doc_id", "source", "lang", "n_chars", "{text}")
)

MANIFEST = f"""
WITH RECURSIVE
rows AS (
    SELECT *, CASE WHEN list_reduce(
        list_prepend(4294967295, [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1
        THEN replace(text, chr(10), '') ELSE text END AS seen_text
    FROM documents),
leaves AS (
    SELECT doc_id, coalesce('+' || source, '') AS tree, sha256({_LEAF.format(text="text")}) AS leaf,
        sha256({_LEAF.format(text="seen_text")}) AS seen FROM rows),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS members FROM leaves),
up AS (
    SELECT tree, 0 AS height, place, members, leaf AS node FROM placed
    UNION ALL
    SELECT tree, height + 1, place // 3, (members + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
    FROM up WHERE members > 1 GROUP BY tree, height, place // 3, members),
groups AS (
    SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS members
    FROM up WHERE members = 1),
top AS (
    SELECT 0 AS height, place, members, node FROM groups
    UNION ALL
    SELECT height + 1, place // 3, (members + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
    FROM top WHERE members > 1 GROUP BY height, place // 3, members),
runs AS (
    SELECT tree, height, place // 3 AS run, list(node ORDER BY place) AS nodes
    FROM up WHERE members > 1 GROUP BY ALL),
top_runs AS (
    SELECT height, place // 3 AS run, list(node ORDER BY place) AS nodes FROM top WHERE members > 1 GROUP BY ALL),
walk AS (
    SELECT doc_id, tree, leaf, place AS row, 0 AS height, place, members, seen AS folded, '' AS proof FROM placed
    UNION ALL
    SELECT doc_id, w.tree, leaf, row, w.height + 1, place // 3, (members + 2) // 3,
        sha256(array_to_string([CASE WHEN i = place % 3 + 1 THEN folded ELSE nodes[i] END FOR i IN range(1, len(nodes) + 1)], '')),
        proof || array_to_string([nodes[i] FOR i IN range(1, len(nodes) + 1) IF i <> place % 3 + 1], '')
    FROM walk w JOIN runs r ON r.tree = w.tree AND r.height = w.height AND r.run = w.place // 3
    WHERE members > 1),
over AS (
    SELECT doc_id, w.tree, leaf, row, g.node AS subroot, 0 AS height, g.place, g.members, folded, proof
    FROM walk w JOIN groups g ON g.tree = w.tree WHERE w.members = 1
    UNION ALL
    SELECT doc_id, tree, leaf, row, subroot, o.height + 1, place // 3, (members + 2) // 3,
        sha256(array_to_string([CASE WHEN i = place % 3 + 1 THEN folded ELSE nodes[i] END FOR i IN range(1, len(nodes) + 1)], '')),
        proof || array_to_string([nodes[i] FOR i IN range(1, len(nodes) + 1) IF i <> place % 3 + 1], '')
    FROM over o JOIN top_runs r ON r.height = o.height AND r.run = o.place // 3
    WHERE members > 1)
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.node AS verified
FROM over o JOIN top t ON t.members = 1 WHERE o.members = 1
"""


def _mixture(levels: int) -> str:
    """Enough levels for ``BLOCK`` to the power of ``levels`` documents in a source."""
    draw = "CAST(CAST('0x' || substr(md5('1|' || key || '|' || {0} || '|' || {1}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496"
    parts, decided = [], []
    for level in range(levels):
        parts.append(f"""
places{level} AS (
    SELECT key, place // {BLOCK} AS block, place % {BLOCK} AS step, (members + {BLOCK - 1}) // {BLOCK} AS blocks, row, doc_id, size, mass
    FROM units{level}),
run{level} AS (
    SELECT key, block, step, blocks, row, doc_id, size, mass,
        CAST(NULL AS BIGINT) AS out_id, CAST(NULL AS BIGINT) AS out_size, CAST(NULL AS DOUBLE) AS out_mass, FALSE AS out
    FROM places{level} WHERE step = 0
    UNION ALL
    SELECT key, block, step, blocks,
        CASE WHEN settled THEN x_row ELSE row END, CASE WHEN settled THEN x_id ELSE doc_id END,
        CASE WHEN settled THEN x_size ELSE size END,
        CASE WHEN NOT settled THEN CASE WHEN up THEN mass + gain ELSE mass - loss END
            WHEN up THEN CASE WHEN gain = x_mass THEN 0 ELSE x_mass - gain END
            ELSE CASE WHEN loss = x_size - x_mass THEN x_size ELSE x_mass + loss END END,
        CASE WHEN settled THEN doc_id ELSE x_id END, CASE WHEN settled THEN size ELSE x_size END,
        CASE WHEN settled THEN CASE WHEN up THEN size ELSE 0 END ELSE CASE WHEN up THEN 0 ELSE x_size END END, TRUE
    FROM (
        SELECT *, (up AND gain = size - mass) OR (NOT up AND loss = mass) AS settled FROM (
            SELECT *, {draw.format("row", "x_row")} * (gain + loss) < loss AS up FROM (
                SELECT r.key, r.block, x.step, r.blocks, r.row, r.doc_id, r.size, r.mass,
                    x.row AS x_row, x.doc_id AS x_id, x.size AS x_size, x.mass AS x_mass,
                    least(r.size - r.mass, x.mass) AS gain, least(r.mass, x.size - x.mass) AS loss
                FROM run{level} r JOIN places{level} x ON x.key = r.key AND x.block = r.block AND x.step = r.step + 1)))),
held{level} AS (SELECT * FROM run{level} QUALIFY row_number() OVER (PARTITION BY key, block ORDER BY step DESC) = 1),
units{level + 1} AS (
    SELECT key, row, doc_id, size, mass, block AS place, blocks AS members FROM held{level} WHERE blocks > 1)""")
        decided.append(f"SELECT key, out_id AS doc_id, out_size AS size, out_size > 0 AND out_mass >= out_size AS whole FROM run{level} WHERE out")
        decided.append(
            f"SELECT key, doc_id, size, size > 0 AND {draw.format('row', 'row')} * size < mass FROM held{level} WHERE blocks = 1"
        )
    return f"""
WITH RECURSIVE
sized AS (
    SELECT doc_id, coalesce('+' || source, '-') AS key,
        CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (
    SELECT key, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
        [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY key) - 1) % 3 + 1]::DOUBLE AS weight FROM sized GROUP BY key),
water AS (
    SELECT 1.5::DOUBLE * sum(source_size) AS rest, sum(weight) AS open FROM sources
    UNION
    SELECT 1.5::DOUBLE * sum(source_size) - sum(CASE WHEN weight * rest / open >= cap THEN cap ELSE 0 END),
        sum(CASE WHEN weight * rest / open >= cap THEN 0 ELSE weight END)
    FROM water, sources WHERE open > 0 GROUP BY rest, open),
wanted AS (
    SELECT key, source_size, CASE WHEN open = 0 OR weight * rest / open >= cap THEN cap ELSE weight * rest / open END AS target
    FROM sources, (SELECT rest, open FROM water ORDER BY open LIMIT 1)),
rated AS (
    SELECT key, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM wanted),
units0 AS (
    SELECT key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, size) - 1 AS row, doc_id, size,
        CAST((rate - floor(rate)) * size AS DOUBLE) AS mass,
        row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, size) - 1 AS place,
        count(*) OVER (PARTITION BY key) AS members
    FROM sized JOIN rated USING (key)),{",".join(parts)},
decided AS ({" UNION ALL ".join(decided)})
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CAST(whole AS INTEGER)) * size AS BIGINT) AS taken
FROM decided JOIN rated USING (key)
"""


MIXTURE = _mixture(4)

DIVERGENCE = """
WITH texts AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents),
said AS (SELECT id, lang, source, unnest(terms) AS term FROM texts),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
groups AS (SELECT DISTINCT lang, source FROM texts),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN kept USING (lang) GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL),
every AS (
    SELECT g.lang, g.source, k.term, CAST(coalesce(c.n, 0) AS HUGEINT) AS n
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
    SELECT lang, source, term, n,
        1 + 1000000000::HUGEINT * (n + 2) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS HUGEINT) + 2 * v) AS p
    FROM every JOIN v USING (lang)),
whole AS (
    SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (CAST(sum(n) OVER (PARTITION BY lang) AS HUGEINT) + 2 * v) AS q
    FROM (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM every GROUP BY lang, term) JOIN v USING (lang)),
apart AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
