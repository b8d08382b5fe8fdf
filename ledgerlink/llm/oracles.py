"""DuckDB SQL of those queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH item AS (
  SELECT item_id, {_WORDS.format(text='text')} AS w FROM benchmark
), gram AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS g
  FROM item WHERE len(w) > 0
), doc AS (
  SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents
), span AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(w) >= n
), hit AS (
  SELECT doc_id, i, gram.n, item_id FROM span JOIN gram ON gram.n = span.n AND gram.g = array_to_string(w[i:i + span.n - 1], ' ')
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP12 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), u AS (
  SELECT doc_id, x, regexp_extract_all(x, '[^\n]*\n|[^\n]+') AS w,
    ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[25:32])::BIGINT AS h4
  FROM t
), c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
    CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, x, n, form, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(w[b + 1:], ''), '') AS suf
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM p
"""


def _op11(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Every round in full: distances to all entries, then floored means. Whole numbers below 2**53 as doubles."""
    steps = [f"""kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS w FROM kept, range({parts}) AS r(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, w FROM part
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries}
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT vec_id, part.p, any_value(part.w) AS w, min(d * {entries} + e) AS best FROM (
    SELECT part.vec_id, part.p, part.w, e, list_dot_product(part.w, part.w)
      + list_dot_product(b.w, b.w) - 2 * list_dot_product(part.w, b.w) AS d
    FROM part JOIN book{k} AS b ON b.p = part.p
  ) AS part GROUP BY vec_id, part.p
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM book{k} AS b LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS w FROM (
      SELECT p, e, i, floor(sum(x) / count(*)) AS x FROM (
        SELECT p, (best % {entries})::BIGINT AS e, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM near{k}
      ) GROUP BY p, e, i
    ) GROUP BY p, e
  ) AS m ON m.p = b.p AND m.e = b.e
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', (best % {entries})::BIGINT)), '' ORDER BY p) AS code,
    sum(floor(best / {entries}))::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id
), flat AS (
  SELECT p, e, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) FROM flat) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLES: dict[str, str] = {"op10_decontaminate": OP10, "op11_vector_codes": _op11(), "op12_fill_middle": OP12}
