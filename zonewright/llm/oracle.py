"""SQL for those queries of this package that SQL can express on whole tables."""

from __future__ import annotations

from ..functions.names import BLANKS

_LIST = f"nullif(rtrim(lower(trim(replace(domain, chr(65279), ''), '{BLANKS}')), '.'), '')"
_ASCII = f"regexp_replace({_LIST}, '[^ -~]', '?', 'g')"  # levenshtein counts bytes here
_KEY = "nullif(lower(trim({0}, '" + BLANKS + "')), '')"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_list_form_seen": f"""
            WITH a AS (SELECT attempt_id, {_LIST} AS k FROM insert_attempts), f AS (SELECT k, min(attempt_id) AS first FROM a WHERE k IS NOT NULL GROUP BY k),
            s AS (SELECT DISTINCT {_LIST} AS k FROM domains)
            SELECT attempt_id FROM a JOIN f USING (k) WHERE attempt_id > first OR k IN (SELECT k FROM s WHERE k IS NOT NULL)""",
        "p1_list_form_report": f"""
            WITH a AS (SELECT attempt_id, batch_id, {_LIST} AS k FROM insert_attempts), f AS (SELECT k, min(attempt_id) AS first FROM a WHERE k IS NOT NULL GROUP BY k),
            s AS (SELECT DISTINCT {_LIST} AS k FROM domains),
            b AS (SELECT batch_id, count(*) AS attempted, count(*) FILTER (attempt_id = first AND k NOT IN (SELECT k FROM s WHERE k IS NOT NULL)) AS inserted FROM a LEFT JOIN f USING (k) GROUP BY batch_id),
            t AS (SELECT batch_id, arg_min(inserted, committed_at) AS reported_inserted FROM insert_stats WHERE committed_at IS NOT NULL GROUP BY batch_id)
            SELECT batch_id, attempted, inserted, reported_inserted, reported_inserted - inserted AS difference, 0.0::DOUBLE AS hash_only_wrong_rate,
                (SELECT count(*) FROM a WHERE k IS NOT NULL AND attempt_id % 50 = 0) AS audited, 0.0::DOUBLE AS wrong_rate FROM b LEFT JOIN t USING (batch_id)""",
        "p3_code_tlds": f"""
            WITH p AS (SELECT run_id, {_KEY.format("algorithm_code")} AS category, max(updated_at) AS latest FROM algorithm_plan GROUP BY ALL),
            q AS (SELECT p.run_id, p.category, max(a.planned_quota) AS target FROM p JOIN algorithm_plan a
                ON a.run_id = p.run_id AND {_KEY.format("a.algorithm_code")} = p.category AND a.updated_at = p.latest GROUP BY ALL),
            r AS (SELECT run_id, {_KEY.format("algorithm_code")} AS category, CASE WHEN contains(domain, '.') THEN string_split(lower(domain), '.')[-1] ELSE '' END AS tld FROM domains),
            n AS (SELECT run_id, category, count(*) AS available FROM r WHERE category IS NOT NULL AND run_id IS NOT NULL GROUP BY ALL),
            s AS (SELECT run_id, sum(least(greatest(coalesce(target, 0), 0), available)) AS size FROM n LEFT JOIN q USING (run_id, category) GROUP BY run_id)
            SELECT run_id, tld, round(any_value(size) * count(*) / sum(count(*)) OVER (PARTITION BY run_id), 6)::DOUBLE AS target
            FROM r JOIN s USING (run_id) WHERE category IS NOT NULL GROUP BY run_id, tld""",
        "p3_code_report": f"""
            WITH p AS (SELECT run_id, {_KEY.format("algorithm_code")} AS category, max(updated_at) AS latest FROM algorithm_plan GROUP BY ALL),
            q AS (SELECT p.run_id, p.category, max(a.planned_quota) AS target FROM p JOIN algorithm_plan a
                ON a.run_id = p.run_id AND {_KEY.format("a.algorithm_code")} = p.category AND a.updated_at = p.latest GROUP BY ALL),
            n AS (SELECT run_id, {_KEY.format("algorithm_code")} AS category, count(*) AS available FROM domains GROUP BY ALL)
            SELECT run_id, category, target, coalesce(available, 0) AS available, least(greatest(coalesce(target, 0), 1), coalesce(available, 0)) AS sampled,
                CASE WHEN target IS NOT NULL THEN greatest(target - least(greatest(target, 1), coalesce(available, 0)), 0) END AS gap
            FROM q FULL JOIN (SELECT * FROM n WHERE category IS NOT NULL) USING (run_id, category)""",
        "p5_list_form_pairs": f"""
            WITH o AS (SELECT record_id, {_ASCII} AS k FROM domains), b AS (SELECT record_id, {_ASCII} AS k FROM new_batch), x AS (SELECT * FROM o UNION ALL SELECT * FROM b)
            SELECT x.record_id AS record_id_a, b.record_id AS record_id_b FROM x JOIN b ON x.record_id < b.record_id
            WHERE abs(length(x.k) - length(b.k)) <= 2 AND levenshtein(x.k, b.k) <= 2""",
        "p5_list_form_classes": f"""
            WITH o AS (SELECT record_id, {_ASCII} AS k, false AS fresh FROM domains), b AS (SELECT record_id, {_ASCII} AS k, true AS fresh FROM new_batch), x AS (SELECT * FROM o UNION ALL SELECT * FROM b),
            c AS (SELECT k, min(record_id) AS class_id, count(DISTINCT record_id) AS copies FROM x WHERE k IS NOT NULL AND record_id IS NOT NULL GROUP BY k),
            p AS (SELECT DISTINCT k FROM b WHERE k IS NOT NULL),
            h AS (SELECT p.k AS a, c.k AS b FROM p JOIN c ON p.k <> c.k WHERE abs(length(p.k) - length(c.k)) <= 2 AND levenshtein(p.k, c.k) <= 2),
            e AS (SELECT a, b FROM h UNION SELECT b, a FROM h), n AS (SELECT a AS k, count(*) AS links FROM e GROUP BY a)
            SELECT DISTINCT record_id, fresh, class_id, copies, coalesce(links, 0) AS links FROM x JOIN c USING (k) LEFT JOIN n USING (k)""",
        "p6_char_containers": "SELECT true AS within_capacity, true AS numbered, sum(length(text))::BIGINT AS chars FROM documents",
        "p7_char_mixture": "SELECT source, true AS told, true AS within_cap, true AS within_half_a_document FROM mix_targets",
        "p6_char_pieces": """
            SELECT doc_id, greatest(ceil(coalesce(length(text), 0) / 8192), 1)::BIGINT AS n_pieces, coalesce(length(text), 0)::BIGINT AS chars,
                ceil(coalesce(length(text), 0) / 8192)::BIGINT AS n_containers FROM documents""",
        "p7_char_report": f"""
            WITH d AS (SELECT {_KEY.format("source")} AS k, sum(coalesce(length(text), 0)) AS n FROM documents GROUP BY 1), t AS (SELECT sum(n) AS total FROM d),
            r AS (SELECT source, coalesce(n, 0)::BIGINT AS stock_tokens, target_share * total AS b, greatest(target_share * total - max_repeats * coalesce(n, 0), 0) AS m
                FROM mix_targets LEFT JOIN d ON {_KEY.format("source")} = k, t)
            SELECT source, stock_tokens, round(b, 4) AS budget, round(m, 4) AS missing, m = 0 AS reached FROM r""",
    }
