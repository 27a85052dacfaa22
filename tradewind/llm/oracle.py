"""SQL for the numbered operators that SQL can express: windows shared with the benchmark, and ranked search."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

_CONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
doc_window AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM item_window) WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, d.size, item_id FROM doc_window d JOIN item_window t ON d.size = t.size AND d.span = t.span),
word AS (SELECT doc_id, count(DISTINCT place) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM hit))
         GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_RANKED = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sized AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM doc WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized),
asked AS (SELECT item_id, term, count(*) AS repeats
          FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY item_id, term),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM sized)
         WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM held, total GROUP BY term),
part AS (SELECT item_id, doc_id,
                repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))) AS part
         FROM asked JOIN held USING (term) JOIN weight USING (term), total),
scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM part GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op11_decontamination": _CONTAMINATION, "op13_lexical": _RANKED}
