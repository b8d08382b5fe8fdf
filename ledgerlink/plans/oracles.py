"""The same answers in plain SQL, for an engine other than Spark.

Money is held in integer cents, pairs are formed by inequality and list
predicates, and the assignment is a recursive query: formulations of their own.
"""

from __future__ import annotations

_ORDERS = """
o AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
    'Shop' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS shop,
    CAST(round(o_totalprice * 100) AS BIGINT) AS amt,
    CASE WHEN o_orderkey % 5 = 4 THEN 8 ELSE 18 END AS rate
  FROM orders),
src AS (
  SELECT *, 'ERP-' || lpad(CAST(k AS VARCHAR), CAST(greatest(7, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS erp_id,
    CASE WHEN k % 8 = 7 THEN 'BNK-UNMATCHED-' ELSE 'BNK-' END
      || lpad(CAST(k AS VARCHAR), CAST(greatest(7, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS bank_ref,
    CAST(floor((amt * rate + 50) / 100.0::DOUBLE) AS BIGINT) AS tax,
    CAST(CASE WHEN k % 8 = 7 THEN k % 500 WHEN k % 3 = 0 THEN 0
         WHEN k % 3 = 1 THEN floor(amt / 80.0::DOUBLE)
         ELSE floor(amt / 100.0::DOUBLE) END AS BIGINT) AS fee
  FROM o),
ledger AS (
  SELECT k, erp_id, day, shop || ' Pvt Ltd' AS merchant, amt, tax,
    CASE WHEN rate = 8 THEN 'USD' ELSE 'INR' END AS currency
  FROM src),
statement AS (
  SELECT k, bank_ref,
    CAST(day + CAST(CASE WHEN k % 8 = 7 THEN 30 ELSE k % 3 END AS INTEGER) AS DATE) AS sday,
    CASE WHEN k % 8 = 7 THEN 'UNKNOWN MERCHANT ' || CAST(k % 100 AS VARCHAR)
         WHEN k % 3 = 0 THEN shop || ' Pvt Ltd ' || erp_id || ' SETTLEMENT'
         WHEN k % 3 = 1 THEN upper(shop) || ' SETTLEMENT'
         ELSE shop || ' / CARD PAYOUT' END AS description,
    CASE WHEN k % 8 = 7 THEN amt + 12345 WHEN k % 3 = 0 THEN amt
         WHEN k % 3 = 1 THEN amt + tax - fee ELSE amt + tax - fee + 1 END AS net,
    fee
  FROM src),
truth AS (
  SELECT erp_id, bank_ref, fee,
    CASE k % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy_name'
      ELSE 'rounding_difference' END AS match_type
  FROM src WHERE k % 8 <> 7)
"""

_NOISY = """
noisy AS (
  SELECT k, bank_ref, net,
    CASE k % 7
      WHEN 0 THEN description || ' ref ERP-' || lpad(CAST(k + 1 AS VARCHAR), CAST(greatest(7, length(CAST(k + 1 AS VARCHAR))) AS INTEGER), '0')
      WHEN 1 THEN description || '/ERP-' || lpad(CAST(k AS VARCHAR), CAST(greatest(7, length(CAST(k AS VARCHAR))) AS INTEGER), '0')
        || '/erp-' || lpad(CAST(k AS VARCHAR), CAST(greatest(7, length(CAST(k AS VARCHAR))) AS INTEGER), '0')
      WHEN 2 THEN lower(description)
      WHEN 3 THEN replace(description, 'ERP-', 'XERP-')
      WHEN 4 THEN replace(description, ' SETTLEMENT', '-A SETTLEMENT')
      ELSE description END AS description
  FROM statement)
"""


def _ids(text_table: str) -> str:
    """Identifier occurrences per statement row, and the rows naming just one."""
    return f"""
runs AS (
  SELECT k, bank_ref, net, unnest(words) AS word, unnest(range(len(words))) AS pos
  FROM (SELECT *, regexp_split_to_array(description, '[^A-Za-z0-9_-]+') AS words
        FROM {text_table})),
found AS (
  SELECT k, bank_ref, net, count(DISTINCT upper(word)) AS n_ids, arg_max(word, pos) AS id_text
  FROM runs WHERE upper(word) IN (SELECT upper(erp_id) FROM ledger)
  GROUP BY k, bank_ref, net),
exact_pairs AS (
  SELECT l.erp_id, b.bank_ref, l.amt, l.k AS ek, b.k AS bk
  FROM (SELECT *, count(*) OVER (PARTITION BY erp_id, amt) AS n FROM ledger) l
  JOIN (SELECT *, count(*) OVER (PARTITION BY id_text, net) AS n FROM found WHERE n_ids = 1) b
    ON l.erp_id = b.id_text AND l.amt = b.net
  WHERE l.n = 1 AND b.n = 1)
"""


_EXACT = f"{_ORDERS}, {_ids('statement')}"


def _tokens(text: str, stop: str = "'pvt', 'ltd', 'settlement', 'payout'") -> str:
    return (
        f"list_sort(list_distinct(list_filter(regexp_extract_all({text}, '[a-z0-9]+'),"
        f" lambda w: length(w) > 2 AND w NOT IN ({stop}))))"
    )


def _pairs(fold_case: bool) -> str:
    name, text = "merchant", "description"
    if fold_case:
        name, text = f"lower({name})", f"lower({text})"
    return f"""
{_EXACT},
le AS (
  SELECT k AS ek, erp_id, {_tokens(name)} AS et, amt + tax AS gross, day, merchant, currency
  FROM ledger WHERE k NOT IN (SELECT ek FROM exact_pairs)),
st AS (
  SELECT k AS bk, bank_ref, {_tokens(text)} AS bt, net + fee AS settled, sday, description
  FROM statement WHERE bank_ref NOT IN (SELECT bank_ref FROM exact_pairs)),
by_token AS (
  SELECT DISTINCT ek, bk
  FROM (SELECT ek, unnest(et) AS w FROM le) a JOIN (SELECT bk, unnest(bt) AS w FROM st) b
    USING (w)),
by_band AS (
  SELECT ek, bk FROM le JOIN st ON settled BETWEEN gross - 5000 AND gross + 5000)
"""


def _scored(source: str, ranked: str) -> str:
    """Score the pairs of ``source`` and keep the two best per ledger row."""
    return f"""
{ranked}_all AS (
  SELECT ek, bk, erp_id, bank_ref, merchant, description, currency,
    len(list_intersect(et, bt)) AS overlap,
    abs(gross - settled) AS delta_c,
    abs(gross - settled) / 100.0::DOUBLE AS amount_delta,
    abs(date_diff('day', day, sday)) AS days, len(et) AS n_et
  FROM {source} JOIN le USING (ek) JOIN st USING (bk)),
{ranked}_score AS (
  SELECT *, (overlap::DOUBLE / greatest(n_et, 1)::DOUBLE) * 0.55::DOUBLE
    + (1.0::DOUBLE / (1.0::DOUBLE + amount_delta)) * 0.30::DOUBLE
    + (1.0::DOUBLE / (1.0::DOUBLE + days)) * 0.15::DOUBLE AS score
  FROM {ranked}_all),
{ranked} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ek ORDER BY score DESC, bk) AS rnk
    FROM {ranked}_score) WHERE rnk <= 2)
"""


def _top(fold_case: bool = False) -> str:
    return f"""{_pairs(fold_case)},
plausible AS (SELECT * FROM by_token UNION SELECT * FROM by_band),
{_scored('plausible', 'top')}"""


_PAIR_COLUMNS = """
SELECT ek AS erp_ord, bk AS bank_ord, rnk AS rank, overlap, amount_delta, days, score
"""

_STOP_IDENTITY = "'pvt', 'ltd', 'settlement', 'payout', 'card'"


def _identity(text: str) -> str:
    words = _tokens(f"lower({text})", _STOP_IDENTITY)
    return (
        f"list_distinct(list_transform({words},"
        " lambda w: CASE WHEN w = 'rzpay' THEN 'razorpay' ELSE w END))"
    )


def _decided(fold_case: bool = False) -> str:
    return f"""{_top(fold_case)},
named AS (
  SELECT *, {_identity('merchant')} AS names, {_identity('description')} AS words FROM top),
shares AS (
  SELECT *, CASE WHEN len(words) = 0 THEN 0 ELSE
    len(list_filter(words, lambda w: len(list_filter(names, lambda n: starts_with(n, w))) > 0))
      ::DOUBLE / len(words) END AS share
  FROM named),
decided AS (
  SELECT *, share >= 0.5 AND delta_c < 100 AS is_match,
    CASE WHEN share >= 0.5 AND delta_c < 100 THEN 0.95::DOUBLE
         WHEN share >= 0.5 THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END AS confidence_score,
    CASE WHEN NOT (share >= 0.5 AND delta_c < 100) THEN 'no_match'
         WHEN delta_c = 0 THEN 'fuzzy_name_match' ELSE 'rounding_discrepancy' END AS match_type,
    CASE WHEN share >= 0.5 AND delta_c = 0 THEN 'Merchant recognised and totals agree.'
         WHEN share >= 0.5 AND delta_c < 100
           THEN 'Merchant recognised and totals differ by less than one unit.'
         WHEN share >= 0.5 THEN 'Merchant recognised but totals differ too much.'
         ELSE 'Merchant not recognised in the bank description.' END AS reasoning
  FROM shares)
"""


def _assigned(edges: str) -> str:
    """Repeatedly accept the pairs that come first for both of their records."""
    return f"""
edge AS (
  SELECT ek, bk, rnk, row_number() OVER (ORDER BY ek, rnk) AS ord FROM {edges}),
rounds AS (
  SELECT ek, bk, rnk, ord,
    ord = min(ord) OVER (PARTITION BY ek) AND ord = min(ord) OVER (PARTITION BY bk) AS won
  FROM edge
  UNION ALL
  SELECT ek, bk, rnk, ord,
    ord = min(ord) OVER (PARTITION BY ek) AND ord = min(ord) OVER (PARTITION BY bk) AS won
  FROM (
    SELECT *, bool_or(won) OVER (PARTITION BY ek) AS used_e,
      bool_or(won) OVER (PARTITION BY bk) AS used_b
    FROM rounds)
  WHERE NOT used_e AND NOT used_b),
assigned AS (SELECT ek, bk, rnk, ord FROM rounds WHERE won)
"""


def _final(fold_case: bool = False) -> str:
    return f"""{_decided(fold_case)},
eligible AS (
  SELECT * FROM decided
  WHERE is_match AND match_type <> 'no_match' AND confidence_score >= 0.8),
{_assigned('eligible')},
log AS (
  SELECT d.* FROM decided d
  LEFT JOIN assigned e ON e.ek = d.ek LEFT JOIN assigned b ON b.bk = d.bk
  WHERE (e.ek IS NULL OR (d.ek, d.rnk) <= (e.ek, e.rnk))
    AND (b.bk IS NULL OR (d.ek, d.rnk) <= (b.ek, b.rnk))),
matched AS (
  SELECT ek, bk, 'exact' AS match_type, 1.0::DOUBLE AS confidence_score,
    'ERP ID embedded in bank description and amount matched exactly.' AS reasoning,
    'deterministic' AS source
  FROM exact_pairs
  UNION ALL
  SELECT d.ek, d.bk, d.match_type, d.confidence_score, d.reasoning, 'llm'
  FROM decided d JOIN assigned a ON a.ek = d.ek AND a.rnk = d.rnk),
report AS (
  SELECT l.erp_id, b.bank_ref, m.*, l.day, b.sday, l.merchant, b.description, l.amt, l.tax,
    b.net, b.fee
  FROM matched m JOIN ledger l ON l.k = m.ek JOIN statement b ON b.k = m.bk),
seen_e AS (
  SELECT ek, arg_min(bank_ref, bk_order) AS related, max(confidence_score) AS conf
  FROM (SELECT *, rnk AS bk_order FROM log) GROUP BY ek),
seen_b AS (
  SELECT bk, arg_min(erp_id, ek) AS related, max(confidence_score) AS conf
  FROM log GROUP BY bk),
exc AS (
  SELECT 'erp' AS dataset, l.erp_id AS record_id, coalesce(s.related, '') AS related_record_id,
    coalesce(s.conf, 0.0::DOUBLE) AS confidence_score, 'no_match' AS match_type,
    CASE WHEN l.currency NOT IN ('INR', '') THEN 'amount_currency_mismatch'
         WHEN s.conf < 0.8 THEN 'below_confidence_threshold'
         ELSE 'no_counterpart_found' END AS category,
    CASE WHEN l.currency NOT IN ('INR', '')
           THEN 'Currency is ' || l.currency || ' (foreign settlement/currency mismatch).'
         WHEN s.conf IS NULL
           THEN 'No candidate bank settlement found in candidate search pool.'
         WHEN s.conf < 0.8 THEN 'Highest LLM confidence score (' || printf('%.2f', s.conf)
           || ') was below threshold (0.8).'
         ELSE 'No matching bank settlement record satisfied business constraints.' END AS reason,
    l.amt / 100.0::DOUBLE AS amount
  FROM ledger l LEFT JOIN seen_e s ON s.ek = l.k
  WHERE l.k NOT IN (SELECT ek FROM matched)
  UNION ALL
  SELECT 'bank', b.bank_ref, coalesce(s.related, ''), coalesce(s.conf, 0.0::DOUBLE), 'no_match',
    CASE WHEN s.conf < 0.8 THEN 'below_confidence_threshold' ELSE 'no_counterpart_found' END,
    CASE WHEN s.conf IS NULL
           THEN 'No candidate ERP transaction found matching bank settlement details.'
         WHEN s.conf < 0.8 THEN 'Evaluated candidate confidence (' || printf('%.2f', s.conf)
           || ') was below threshold (0.8).'
         ELSE 'Candidate evaluations did not produce an accepted ERP match.' END,
    b.net / 100.0::DOUBLE
  FROM statement b LEFT JOIN seen_b s ON s.bk = b.k
  WHERE b.k NOT IN (SELECT bk FROM matched))
"""


_RATIOS = """
  CASE WHEN tp + fp > 0 THEN tp * 100.0::DOUBLE / (tp + fp) ELSE 100.0::DOUBLE END AS precision,
  CASE WHEN tp + fn > 0 THEN tp * 100.0::DOUBLE / (tp + fn) ELSE 100.0::DOUBLE END AS recall
"""
_F1 = """
  CASE WHEN precision + recall > 0
    THEN precision * 2.0::DOUBLE * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1
"""


def _evaluated(fold_case: bool = False) -> str:
    return f"""{_final(fold_case)},
cats AS (
  SELECT unnest(['exact', 'fuzzy_name_match', 'rounding_discrepancy']) AS category,
    unnest(['exact', 'fuzzy_name', 'rounding_difference']) AS truth_type),
cat_counts AS (
  SELECT c.category,
    (SELECT count(*) FROM report r JOIN truth t USING (erp_id, bank_ref)
      WHERE r.match_type = c.category AND t.match_type = c.truth_type) AS tp,
    (SELECT count(*) FROM report r WHERE r.match_type = c.category AND NOT EXISTS (
      SELECT 1 FROM truth t WHERE t.erp_id = r.erp_id AND t.bank_ref = r.bank_ref
        AND t.match_type = c.truth_type)) AS fp,
    (SELECT count(*) FROM truth t WHERE t.match_type = c.truth_type AND NOT EXISTS (
      SELECT 1 FROM report r WHERE t.erp_id = r.erp_id AND t.bank_ref = r.bank_ref
        AND r.match_type = c.category)) AS fn
  FROM cats c),
cat_prf AS (
  SELECT *, {_F1} FROM (SELECT *, {_RATIOS} FROM cat_counts)),
all_counts AS (
  SELECT
    (SELECT count(*) FROM (SELECT erp_id, bank_ref FROM report
      INTERSECT SELECT erp_id, bank_ref FROM truth)) AS tp,
    (SELECT count(*) FROM (SELECT erp_id, bank_ref FROM report
      EXCEPT SELECT erp_id, bank_ref FROM truth)) AS fp,
    (SELECT count(*) FROM (SELECT erp_id, bank_ref FROM truth
      EXCEPT SELECT erp_id, bank_ref FROM report)) AS fn),
all_prf AS (
  SELECT *, {_F1}, CASE WHEN tp + fn > 0 THEN tp * 100.0::DOUBLE / (tp + fn)
    ELSE 0.0::DOUBLE END AS accuracy
  FROM (SELECT *, {_RATIOS} FROM all_counts)),
true_exc AS (
  SELECT 'erp' AS dataset, erp_id AS record_id FROM src WHERE k % 8 = 7
  UNION ALL SELECT 'bank', bank_ref FROM src WHERE k % 8 = 7),
exc_counts AS (
  SELECT coalesce(e.dataset, t.dataset) AS dataset,
    count(*) FILTER (e.record_id IS NOT NULL AND t.record_id IS NOT NULL) AS tp,
    count(*) FILTER (t.record_id IS NULL) AS fp,
    count(*) FILTER (e.record_id IS NULL) AS fn
  FROM (SELECT DISTINCT dataset, record_id FROM exc) e
  FULL JOIN true_exc t ON t.dataset = e.dataset AND t.record_id = e.record_id
  GROUP BY 1),
exc_prf AS (
  SELECT *, {_F1} FROM (SELECT *, {_RATIOS} FROM (
    SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM exc_counts))),
calibration AS (
  SELECT b.bucket, count(l.ek) AS total, count(l.ek) FILTER (l.correct) AS correct
  FROM (SELECT unnest(['0.0-0.5', '0.5-0.8', '0.8-1.0']) AS bucket) b
  LEFT JOIN (
    SELECT log.ek, log.is_match = (t.erp_id IS NOT NULL) AS correct,
      CASE WHEN confidence_score < 0.5 THEN '0.0-0.5' WHEN confidence_score < 0.8 THEN '0.5-0.8'
        ELSE '0.8-1.0' END AS bucket
    FROM log LEFT JOIN truth t USING (erp_id, bank_ref)) l USING (bucket)
  GROUP BY 1),
totals AS (
  SELECT (SELECT count(*) FROM ledger) AS n_erp, (SELECT count(*) FROM statement) AS n_bank,
    (SELECT count(*) FROM matched) AS n_matched,
    (SELECT count(*) FROM matched WHERE source = 'deterministic') AS n_exact,
    (SELECT count(*) FROM matched WHERE source = 'llm') AS n_model,
    (SELECT count(*) FROM top) AS n_calls, (SELECT count(*) FROM log) AS n_log,
    (SELECT count(*) FROM exc) AS n_exc),
figures AS (
  SELECT 'overall_accuracy' AS metric, accuracy AS value FROM all_prf
  UNION ALL SELECT 'overall_precision', precision FROM all_prf
  UNION ALL SELECT 'overall_recall', recall FROM all_prf
  UNION ALL SELECT 'overall_f1', f1 FROM all_prf
  UNION ALL SELECT 'f1_' || category, f1 FROM cat_prf
  UNION ALL SELECT 'f1_true_exception', f1 FROM exc_prf
  UNION ALL SELECT 'deterministic_match_percent', n_exact * 100.0::DOUBLE / n_matched FROM totals
  UNION ALL SELECT 'llm_match_percent', n_model * 100.0::DOUBLE / n_matched FROM totals
  UNION ALL SELECT 'high_confidence_accuracy',
    CASE WHEN total > 0 THEN correct * 100.0::DOUBLE / total ELSE 0.0::DOUBLE END
  FROM calibration WHERE bucket = '0.8-1.0')
"""


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


_LEDGER_ROWS = """
erp_id, strftime(day, '%Y-%m-%d') AS date, merchant AS merchant_name,
amt / 100.0::DOUBLE AS amount, currency, tax / 100.0::DOUBLE AS tax_line_item
"""
_STATEMENT_ROWS = """
bank_ref, strftime(sday, '%Y-%m-%d') AS settlement_date, description,
net / 100.0::DOUBLE AS net_amount, fee / 100.0::DOUBLE AS fee_deducted
"""
_TRUTH_ROWS = "erp_id, bank_ref, match_type, fee / 100.0::DOUBLE AS expected_fee_deducted"
_DECISION_ROWS = "erp_id, bank_ref, is_match, confidence_score, match_type, reasoning"
_BROKEN_REASON = "AI provider unavailable after fallback: decision violates the contract"
_COARSE = """
coarse AS (
  SELECT 'C-' || substr(merchant, 1, 10) AS erp_id,
    floor(amt / 5000000.0::DOUBLE) * 50000 AS amount FROM ledger),
coarse_bank AS (
  SELECT 'C-' || substr(description, 1, 10) AS erp_id,
    floor(net / 5000000.0::DOUBLE) * 50000 AS amount FROM statement)
"""


def _agreeing(rejected: str, reason: str) -> str:
    """Decisions of the sample evaluators; ``rejected`` rows give ``reason``."""
    return f"""
SELECT erp_id, bank_ref, NOT ({rejected}) AND delta_c = 0 AS is_match,
  CASE WHEN {rejected} THEN 0.0::DOUBLE WHEN delta_c = 0 THEN 0.9::DOUBLE
    ELSE 0.3::DOUBLE END AS confidence_score,
  CASE WHEN NOT ({rejected}) AND delta_c = 0 THEN 'fuzzy_name_match'
    ELSE 'no_match' END AS match_type,
  CASE WHEN {rejected} THEN {reason} WHEN delta_c = 0 THEN 'totals agree'
    ELSE 'totals differ' END AS reasoning
FROM top
"""


def _build() -> dict[str, str]:
    broken = "(ek % 5 = 0 OR ek % 7 = 0 OR ek % 11 = 0)"
    faulty = "(currency = 'USD' OR right(erp_id, 1) = '1')"
    fault = (
        "CASE WHEN currency = 'USD'"
        " THEN 'AI provider unavailable after fallback: no rates for USD'"
        f" ELSE '{_BROKEN_REASON}' END"
    )
    final, evaluated = _final(), _evaluated()
    exc = "record_id, related_record_id, confidence_score, match_type, category, reason"
    return {
        "fixture_ledger": _with(_ORDERS, f"SELECT k AS row_ord, {_LEDGER_ROWS} FROM ledger"),
        "fixture_statement": _with(
            _ORDERS, f"SELECT k AS row_ord, {_STATEMENT_ROWS} FROM statement"
        ),
        "fixture_truth": _with(_ORDERS, f"SELECT {_TRUTH_ROWS} FROM truth"),
        "ledger_scan": _with(
            _ORDERS,
            f"SELECT * REPLACE ({_odd_text('merchant_name')} AS merchant_name), {_odd_date('date')} AS date_text"
            f" FROM (SELECT k, {_LEDGER_ROWS} FROM ledger)",
        ).replace("SELECT * REPLACE", "SELECT * EXCLUDE (k) REPLACE"),
        "statement_scan": _with(
            _ORDERS,
            f"SELECT * REPLACE ({_odd_text('description')} AS description),"
            f" {_odd_date('settlement_date')} AS settlement_date_text"
            f" FROM (SELECT k, {_STATEMENT_ROWS} FROM statement)",
        ).replace("SELECT * REPLACE", "SELECT * EXCLUDE (k) REPLACE"),
        "truth_explode": _with(
            _ORDERS,
            f"SELECT {_TRUTH_ROWS}, '' AS dataset, '' AS record_id FROM truth"
            " UNION ALL SELECT '', '', '', 0.0::DOUBLE, 'erp', erp_id FROM src WHERE k % 8 = 7"
            " UNION ALL SELECT '', '', '', 0.0::DOUBLE, 'bank', bank_ref FROM src WHERE k % 8 = 7",
        ),
        "ledger_normalize": """
SELECT o_orderkey AS row_ord, 'ORD-' || CAST(o_orderkey AS VARCHAR) AS erp_id,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority ELSE '' END AS merchant_name,
  o_totalprice AS amount, 'INR' AS currency, 0.5::DOUBLE AS tax_line_item,
  CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text
FROM orders""",
        "id_extract": _with(
            f"{_ORDERS}, {_NOISY}, {_ids('noisy')}",
            "SELECT k AS row_ord, id_text FROM found WHERE n_ids = 1",
        ),
        "id_ambiguous": _with(
            f"{_ORDERS}, {_NOISY}, {_ids('noisy')}",
            "SELECT k AS row_ord, n_ids FROM found WHERE n_ids > 1",
        ),
        "exact_matches": _with(
            _EXACT,
            "SELECT erp_id, bank_ref, amt / 100.0::DOUBLE AS amount, ek AS erp_ord,"
            " bk AS bank_ord FROM exact_pairs",
        ),
        "exact_matches_noisy": _with(
            f"{_ORDERS}, {_NOISY}, {_ids('noisy')}", "SELECT erp_id, bank_ref FROM exact_pairs"
        ),
        "exact_matches_punct": _with(
            _EXACT, "SELECT replace(erp_id, '-', '/') AS erp_id, bank_ref FROM exact_pairs"
        ),
        "key_multiplicity": _with(
            f"{_ORDERS}, {_COARSE}",
            "SELECT 'erp' AS side, erp_id, amount, count(*) AS n FROM coarse GROUP BY ALL"
            " UNION ALL SELECT 'bank', erp_id, amount, count(*) FROM coarse_bank GROUP BY ALL",
        ),
        "duplicate_keys": _with(
            f"{_ORDERS}, {_COARSE}",
            "SELECT 'erp' AS dataset, erp_id AS record_id, count(*) AS n_rows FROM coarse"
            " GROUP BY ALL HAVING count(*) > 1 UNION ALL"
            " SELECT 'bank', bank_ref, count(*) FROM statement GROUP BY ALL HAVING count(*) > 1",
        ),
        "unresolved_erp": _with(
            _EXACT,
            f"SELECT k AS row_ord, {_LEDGER_ROWS} FROM ledger"
            " WHERE k NOT IN (SELECT ek FROM exact_pairs)",
        ),
        "unresolved_bank": _with(
            _EXACT,
            f"SELECT k AS row_ord, {_STATEMENT_ROWS} FROM statement"
            " WHERE k NOT IN (SELECT bk FROM exact_pairs)",
        ),
        "exact_false_positives": _with(
            _EXACT,
            "SELECT p.erp_id, p.bank_ref, p.amt / 100.0::DOUBLE AS erp_amount, s.description,"
            " s.net / 100.0::DOUBLE AS net_amount, p.erp_id AS trigger_id,"
            " p.amt / 100.0::DOUBLE AS trigger_amount"
            " FROM exact_pairs p JOIN statement s ON s.k = p.bk"
            " WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.erp_id = p.erp_id"
            " AND t.bank_ref = p.bank_ref AND t.match_type = 'exact' AND p.ek % 5 <> 0)",
        ),
        "name_tokens": _with(
            _ORDERS,
            f"SELECT k AS row_ord, array_to_string({_tokens('merchant')}, ' ') AS tokens FROM ledger",
        ),
        "name_tokens_folded": _with(
            _ORDERS,
            f"SELECT k AS row_ord, array_to_string({_tokens('lower(merchant)')}, ' ') AS tokens"
            " FROM ledger",
        ),
        "amount_delta": _with(
            _ORDERS,
            "SELECT k AS row_ord, abs(amt + tax - fee - net) / 100.0::DOUBLE AS amount_delta"
            " FROM ledger JOIN statement USING (k)",
        ),
        "token_overlap_pairs": _with(
            f"{_pairs(False)}, {_scored('by_token', 'top')}", f"{_PAIR_COLUMNS} FROM top"
        ),
        "amount_band_pairs": _with(
            f"{_pairs(False)}, {_scored('by_band', 'top')}", f"{_PAIR_COLUMNS} FROM top"
        ),
        "candidate_pairs": _with(
            f"{_pairs(False)}, {_scored('by_token', 'best_t')}, {_scored('by_band', 'best_b')}",
            "SELECT ek AS erp_ord, bk AS bank_ord FROM best_t"
            " UNION SELECT ek, bk FROM best_b",
        ),
        "candidate_scores": _with(
            f"""{_ORDERS},
le AS (SELECT k AS ek, erp_id, {_tokens('lower(merchant)')} AS et, amt + tax AS gross, day,
  merchant, currency FROM ledger),
st AS (SELECT k AS bk, bank_ref, {_tokens('lower(description)')} AS bt, net + fee AS settled,
  sday, description FROM statement),
same AS (SELECT k AS ek, k AS bk FROM src), {_scored('same', 'top')}""",
            "SELECT ek AS erp_ord, bk AS bank_ord, overlap, amount_delta, days, score"
            " FROM top_score",
        ),
        "top_k_candidates": _with(_top(), f"{_PAIR_COLUMNS} FROM top"),
        "top_k_candidates_folded": _with(_top(True), f"{_PAIR_COLUMNS} FROM top"),
        "rule_decisions": _with(_decided(), f"SELECT {_DECISION_ROWS} FROM decided"),
        "rule_decisions_folded": _with(_decided(True), f"SELECT {_DECISION_ROWS} FROM decided"),
        "accept_predicate": _with(
            _decided(),
            "SELECT erp_id, bank_ref FROM decided WHERE is_match AND match_type <> 'no_match'"
            " AND confidence_score >= 0.8",
        ),
        "decision_validation": _with(
            _decided(),
            f"SELECT erp_id, bank_ref, NOT {broken} AND is_match AS is_match,"
            f" CASE WHEN {broken} THEN 0.0::DOUBLE ELSE confidence_score END AS confidence_score,"
            f" CASE WHEN {broken} THEN 'no_match' ELSE match_type END AS match_type,"
            f" CASE WHEN {broken} THEN '{_BROKEN_REASON}' ELSE reasoning END AS reasoning"
            " FROM decided",
        ),
        "evaluator_plugin": _with(_top(), _agreeing("FALSE", "''")),
        "evaluator_faults": _with(_top(), _agreeing(faulty, fault)),
        "greedy_assignment": _with(
            f"{_top()}, {_assigned('top')}",
            "SELECT erp_id, bank_ref, rnk AS rank FROM assigned JOIN top USING (ek, bk, rnk)",
        ),
        "greedy_assignment_accepted": _with(
            final,
            "SELECT erp_id, bank_ref, rnk AS rank FROM assigned JOIN top USING (ek, bk, rnk)",
        ),
        "decision_log": _with(
            final,
            f"SELECT {_DECISION_ROWS}, rnk AS rank, merchant AS merchant_erp,"
            " description AS description_bank, currency FROM log",
        ),
        "matched_report": _with(
            final,
            f"SELECT {_LEDGER_ROWS.replace('currency, ', '')}, {_STATEMENT_ROWS}, match_type,"
            " confidence_score, reasoning, source"
            " FROM (SELECT *, '' AS currency FROM report)",
        ),
        "erp_exceptions": _with(final, f"SELECT dataset, {exc} FROM exc WHERE dataset = 'erp'"),
        "bank_exceptions": _with(final, f"SELECT dataset, {exc} FROM exc WHERE dataset = 'bank'"),
        "exception_details": _with(
            final,
            "SELECT dataset, record_id, record_id AS detail_id, amount AS detail_amount FROM exc",
        ),
        "exception_counts": _with(
            final, "SELECT category, count(*) AS n_exceptions FROM exc GROUP BY category"
        ),
        "run_metrics": _with(
            evaluated,
            "SELECT n_erp AS total_erp_records, n_bank AS total_bank_records,"
            " n_exact AS deterministic_matches_count, n_model AS llm_matches_count,"
            " n_calls AS llm_calls_made, n_log AS logged_decisions_count,"
            " n_exc AS unresolved_exceptions_count, n_matched AS total_matched_pairs,"
            " n_exact * 100.0::DOUBLE / n_matched AS deterministic_match_percent,"
            " n_model * 100.0::DOUBLE / n_matched AS llm_match_percent FROM totals",
        ),
        "kpi_summary": _with(
            evaluated,
            "SELECT n_erp AS records_processed, n_matched AS matched_pairs,"
            " n_exc AS unresolved_exceptions,"
            " n_matched * 100.0::DOUBLE / greatest(n_erp, 1) AS match_rate_percent FROM totals",
        ),
        "stage_breakdown": _with(
            final,
            "SELECT source AS stage, count(*) AS resolved,"
            " count(*) * 100.0::DOUBLE / (SELECT count(*) FROM matched) AS share_percent"
            " FROM matched GROUP BY source",
        ),
        "throughput_fallback": _with(
            evaluated,
            "SELECT n_exact AS deterministic_matches_count,"
            " n_exact * 100.0::DOUBLE / n_matched AS deterministic_match_percent,"
            " 0.0::DOUBLE AS deterministic_time_seconds, n_model AS llm_matches_count,"
            " n_model * 100.0::DOUBLE / n_matched AS llm_match_percent,"
            " 1.5::DOUBLE AS llm_time_seconds, CAST(0 AS BIGINT) AS llm_calls_made,"
            " 1.5::DOUBLE AS total_time_seconds FROM totals",
        ),
        "job_summary": _with(
            evaluated,
            "SELECT 'orders' AS job_id, n_matched AS matched_count, n_exc AS exception_count,"
            " 'out/reconciled_report.csv' AS report_uri,"
            " 'out/exceptions_list.csv' AS exceptions_uri, TRUE AS timed"
            " FROM totals",
        ),
        "category_prf": _with(evaluated, "SELECT * FROM cat_prf"),
        "overall_prf": _with(evaluated, "SELECT * FROM all_prf"),
        "exception_prf": _with(evaluated, "SELECT * FROM exc_prf"),
        "exception_prf_by_dataset": _with(
            evaluated, f"SELECT *, {_F1} FROM (SELECT *, {_RATIOS} FROM exc_counts)"
        ),
        "pair_set_difference": _with(
            final,
            "SELECT erp_id, bank_ref, 1::BIGINT AS p, 0::BIGINT AS t FROM (SELECT erp_id, bank_ref FROM report"
            " EXCEPT SELECT erp_id, bank_ref FROM truth) UNION ALL"
            " SELECT erp_id, bank_ref, 0, 1 FROM (SELECT erp_id, bank_ref FROM truth"
            " EXCEPT SELECT erp_id, bank_ref FROM report)",
        ),
        "confidence_calibration": _with(
            evaluated,
            "SELECT bucket, total, correct, total - correct AS incorrect, CASE WHEN total > 0"
            " THEN correct * 100.0::DOUBLE / total ELSE 0.0::DOUBLE END AS accuracy"
            " FROM calibration",
        ),
        "audit_complete": _with(
            final,
            "SELECT coalesce(bool_and(trim(reasoning) <> ''), FALSE) AS audit_trail_ok"
            " FROM matched",
        ),
        "audit_rows": _with(
            final,
            "SELECT 'orders' AS job_id, sha256(erp_id || ':' || bank_ref) AS transaction_hash,"
            " 'reconciliation' AS stage, CAST(1500 AS BIGINT) AS duration_ms,"
            " '{\"match_type\":\"' || match_type || '\",\"confidence_score\":' || confidence_score"
            " || ',\"reasoning\":\"' || reasoning || '\"}' AS decision, '' AS model_name,"
            " 0::BIGINT AS prompt_tokens, 0::BIGINT AS completion_tokens, 0.0::DOUBLE AS cost_usd FROM report"
            " UNION ALL SELECT 'orders', sha256(dataset || ':' || record_id), 'exception', 0,"
            " '{\"category\":\"' || category || '\",\"confidence_score\":' || confidence_score"
            " || ',\"reason\":\"' || reason || '\"}', '', 0, 0, 0.0 FROM exc",
        ),
        "stage_timing_rows": _with(
            _top(),
            "SELECT 'orders' AS job_id, stage, TRUE AS timed,"
            " '{\"llm_calls\":' || (SELECT count(*) FROM top) || '}' AS metadata"
            " FROM (VALUES ('deterministic'), ('llm'), ('pipeline')) v(stage)",
        ),
        "idempotent_append": _with(
            evaluated,
            "SELECT 'orders' AS job_id, 'reconciliation' AS stage, n_matched AS n_rows,"
            " n_matched AS n_hashes FROM totals UNION ALL"
            " SELECT 'orders', 'exception', n_exc, n_exc FROM totals",
        ),
        "job_status_latest": """
SELECT 'job-' || CAST(user_id AS VARCHAR) AS job_id,
  CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'processing'
    WHEN 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE event_type WHEN 'error' THEN props ELSE '' END AS error_message
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
      FROM events) WHERE n = 1""",
    }


def metric_comparison_sql() -> str:
    """Both token modes need the whole pipeline, so each is a subquery of its own."""
    sides = [f"({_with(_evaluated(fold), 'SELECT * FROM figures')})" for fold in (False, True)]
    return (
        "SELECT metric, a.value AS first_value, b.value AS second_value,"
        " b.value - a.value AS difference"
        f" FROM {sides[0]} a JOIN {sides[1]} b USING (metric)"
    )


def _odd_text(column: str) -> str:
    return (
        f"CASE k % 4 WHEN 0 THEN {column} || ' \"GOLD\", E1' WHEN 1 THEN 'a\\b ' || {column} || '\\'"
        f" WHEN 2 THEN {column} || '\"' ELSE {column} END"
    )


def _odd_date(column: str) -> str:
    day = f"CAST({column} AS DATE)"
    return (
        f"CASE k % 4 WHEN 0 THEN {column} WHEN 1 THEN strftime({day}, '%m/%d/%Y')"
        f" WHEN 2 THEN strftime({day}, '%Y/%m/%d') ELSE strftime({day}, '%b %-d %Y') END"
    )


DEAD_LETTER = """
SELECT 'job-' || job AS job_id,
  CASE WHEN job IN (2, 3) OR job = 1 AND bool_or(k % 100 = 2) THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN job = 2 THEN 'Invalid input object keys'
    WHEN job = 3 THEN 'erp_ledger.csv: tax_line_item is not a number: 0.00001'
    WHEN job = 1 AND bool_or(k % 100 = 2) THEN 'erp_ledger.csv: amount is not a number: n/a'
    ELSE '' END AS error_message, CAST(0 AS BIGINT) AS retry_count
FROM (SELECT o_orderkey AS k, (o_orderkey // 2) % 4 AS job FROM orders) GROUP BY job
"""


def stream_intake_sql() -> str:
    """Each job is a run of its own over the orders that belong to it."""
    jobs = []
    for number in range(2):
        ctes = _final().replace(
            "FROM orders)", f"FROM orders WHERE (o_orderkey // 2) % 2 = {number})"
        )
        select = f"""SELECT 'job-{number}' AS job_id, match_type, source, count(*) AS n_pairs
          FROM matched GROUP BY match_type, source"""
        jobs.append(f"SELECT * FROM ({_with(ctes, select)})")
    return " UNION ALL ".join(jobs)


def comparison_roundtrip_sql() -> str:
    """As the comparison of figures, of rounded summaries."""
    sides = [f"({_with(_evaluated(fold), 'SELECT metric, round(value, 2) AS value FROM figures')})" for fold in (False, True)]
    return (
        "SELECT metric, a.value AS first_value, b.value AS second_value, b.value - a.value AS difference"
        f" FROM {sides[0]} a JOIN {sides[1]} b USING (metric)"
    )


INTAKE_GATE = """
WITH named AS (
  SELECT page_id, strlen(html) AS n, CASE WHEN contains(url, '.html') THEN 'erp_ledger.csv'
    WHEN contains(url, '?') THEN regexp_extract(url, '([^/?]*)[?]', 1) ELSE 'bank_statement.csv' END AS f
  FROM pages),
judged AS (
  SELECT *, CASE WHEN f NOT IN ('erp_ledger.csv', 'bank_statement.csv')
      THEN 'Expected erp_ledger.csv and bank_statement.csv'
    WHEN n > 2000 THEN 'File exceeds upload size limit' ELSE '' END AS reason
  FROM named)
SELECT 'in/' || page_id || '/' || f AS path, f AS file_name, CAST(n AS BIGINT) AS n_bytes,
  reason = '' AS accepted, reason
FROM judged
"""


def _derived(built: dict[str, str]) -> dict[str, str]:
    """Answers that are those of another query, or figures of several."""
    evaluated = _evaluated()
    shares = ("deterministic_match_percent", "llm_match_percent")
    rounded = ", ".join(f"round({c}, 2) AS {c}" for c in shares)
    figures = ", ".join(f"round(p.{c}, 2) AS overall_{c}" for c in ("precision", "recall", "f1", "accuracy"))
    counts = ", ".join(f"p.{c} AS overall_{c}" for c in ("tp", "fp", "fn"))
    a = _ORDERS.index("    CASE WHEN k % 8 = 7 THEN 'UNKNOWN MERCHANT '")
    b = _ORDERS.index(" AS description,", a)
    crowded = _ORDERS.replace(_ORDERS[a:b], "    'shop' || (k + k % 3) % 20 || ' x'")
    crowded = crowded.replace("shop || ' Pvt Ltd' AS merchant", "'shop' || k % 20 AS merchant")
    ratios = ", ".join(f"round({c}, 2) AS {c}" for c in ("precision", "recall", "f1"))
    return {
        "log_array_roundtrip": built["decision_log"],
        "summary_roundtrip": _with(
            evaluated,
            f"SELECT category, {ratios}, tp, fp, fn FROM cat_prf"
            f" UNION ALL SELECT 'true_exception', {ratios}, tp, fp, fn FROM exc_prf",
        ),
        "report_or_none": _with(
            evaluated,
            "SELECT 'written' AS source, 'reconciled_report' AS product, n_matched AS n_rows FROM totals"
            " UNION ALL SELECT 'written', 'exceptions_list', n_exc FROM totals"
            " UNION ALL VALUES ('absent', 'reconciled_report', 0), ('absent', 'exceptions_list', 0)",
        ),
        "top_k_candidates_hot": _with(_top().replace(_ORDERS, crowded), f"{_PAIR_COLUMNS} FROM top"),
        "evaluator_columns": built["evaluator_plugin"],
        "evaluator_batches": built["evaluator_plugin"],
        "report_roundtrip": built["matched_report"],
        "log_roundtrip": built["decision_log"],
        "exceptions_roundtrip": f"SELECT * FROM ({built['erp_exceptions']}) UNION ALL SELECT * FROM ({built['bank_exceptions']})",
        "metrics_roundtrip": f"SELECT * REPLACE ({rounded}), TRUE AS timed FROM ({built['run_metrics']})",
        "artifact_summary": _with(
            evaluated,
            f"SELECT {figures}, {counts}, round(e.f1, 2) AS exception_f1, n_exact AS exact_matches,"
            " n_model AS llm_matches, TRUE AS timed, c.total AS confident,"
            " (SELECT coalesce(bool_and(trim(reasoning) <> ''), FALSE) FROM matched) AS audit_trail_ok"
            " FROM all_prf p, exc_prf e, totals, (SELECT total FROM calibration WHERE bucket = '0.8-1.0') c",
        ),
    }


def missing_columns_sql() -> str:
    """Of three jobs the first is a run over its orders; the others are refused."""
    ctes = _final().replace("FROM orders)", "FROM orders WHERE (o_orderkey // 2) % 3 = 0)")
    whole = _with(ctes, "SELECT 'job-0' AS job_id, 'success' AS status, '' AS error_message, count(*) AS n_pairs FROM matched")
    return (
        f"SELECT * FROM ({whole}) UNION ALL VALUES"
        " ('job-1', 'failed', 'Dataset A is missing required columns: amount, erp_id', 0),"
        " ('job-2', 'failed', 'Dataset B is missing required columns: net_amount', 0)"
    )


def oracle_queries() -> dict[str, str]:
    built = _build()
    return {
        **built,
        **_derived(built),
        "metric_comparison": metric_comparison_sql(),
        "comparison_roundtrip": comparison_roundtrip_sql(),
        "stream_intake": stream_intake_sql(),
        "missing_columns": missing_columns_sql(),
        "intake_gate": INTAKE_GATE,
        "dead_letter": DEAD_LETTER,
    }
