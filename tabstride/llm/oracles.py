"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tabstride.llm.importance import Resampling
from tabstride.llm.interactions import Filters
from tabstride.llm.licenses import scan_sql
from tabstride.llm.quality import QualityRules

WORD = r"[^\x20\x09-\x0D]+"

_RULES = QualityRules()


def quality_sql(source: str = "documents", rules: QualityRules = _RULES) -> str:
    """CTE bodies up to ``judged``: the measures, ``base_failed`` and ``kept`` per row."""
    runs = [rules.base_run, *(n for n, _ in rules.covered)]
    windows = "\n".join(
        f"""q_w{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c,
              row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k
            FROM (SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g
                  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM q_words
                        WHERE len(ws) >= {n}))),
        q_c{n} AS (SELECT doc_id, count(*) AS words, sum(chars) AS chars
            FROM (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM q_w{n}
                  WHERE {'c > 1' if n == rules.base_run else 'k > 1'}) JOIN q_tokens USING (doc_id, i)
            GROUP BY doc_id),"""
        for n in runs
    )
    joins = " ".join(f"LEFT JOIN q_c{n} ON q_c{n}.doc_id = b.doc_id" for n in runs)
    limits = " AND ".join(
        f"100 * coalesce(q_c{n}.chars, 0) <= {most} * word_chars" for n, most in rules.covered
    )
    base = f"coalesce(q_c{rules.base_run}.words, 0)"
    return f"""q_words AS (SELECT doc_id, coalesce(text, '') AS text,
              regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM {source}),
        q_tokens AS (SELECT doc_id, i, length(ws[i]) AS chars
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM q_words)),
        {windows}
        q_lines AS (SELECT doc_id, length(line) AS chars,
              row_number() OVER (PARTITION BY doc_id, line) AS k
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM q_words)
            WHERE regexp_matches(line, '{WORD}')),
        q_line AS (SELECT doc_id, count(*) AS n_lines, sum(chars) AS line_chars,
              count(*) FILTER (WHERE k > 1) AS n_dup_lines,
              coalesce(sum(chars) FILTER (WHERE k > 1), 0) AS dup_chars
            FROM q_lines GROUP BY doc_id),
        q_base AS (SELECT doc_id, len(ws) AS n_words,
              length(array_to_string(ws, '')) AS word_chars,
              length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM q_words),
        judged AS (SELECT b.doc_id, n_words, word_chars, n_symbols,
              coalesce(n_dup_lines, 0) AS n_dup_lines, {base} AS n_repeat_words,
              n_words < {rules.min_words} OR 100 * {base} > {rules.base_percent} * n_words
                AS base_failed,
              NOT (n_words < {rules.min_words} OR 100 * {base} > {rules.base_percent} * n_words)
                AND {limits}
                AND 100 * coalesce(n_dup_lines, 0) <= {rules.dup_lines} * coalesce(n_lines, 0)
                AND 100 * coalesce(dup_chars, 0) <= {rules.dup_line_chars} * coalesce(line_chars, 0)
                AS kept
            FROM q_base b {joins} LEFT JOIN q_line ON q_line.doc_id = b.doc_id)"""


def resample_sql(rules: Resampling | None = None) -> str:
    """The importance draw over ``documents`` towards ``benchmark``, for features of one word."""
    rules = rules or Resampling()
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    noise = f"('0x' || substr(sha256('{rules.seed}:' || doc_id), 1, 8))::BIGINT"
    return f"""WITH d_words AS (SELECT doc_id, {words} AS ws FROM documents),
        d AS (SELECT doc_id, unnest(ws) AS w FROM d_words),
        b AS (SELECT unnest({words}) AS w FROM benchmark),
        crc_step AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 1, 2, 3, 4, 5, 6, 7, 8],
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        vocabulary AS (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
        spelled AS (SELECT w, list_transform(range(octet_length(encode(w))),
            lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS bytes FROM vocabulary),
        hashed AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % {rules.buckets} AS bucket
            FROM spelled CROSS JOIN crc_step),
        s AS (SELECT bucket, count(*) AS n FROM d JOIN hashed USING (w) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (w) GROUP BY bucket),
        gains AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
              * ((SELECT coalesce(sum(n), 0) FROM s) + {rules.buckets})::DOUBLE
              / ((coalesce(s.n, 0) + 1)::DOUBLE
                 * ((SELECT coalesce(sum(n), 0) FROM t) + {rules.buckets})::DOUBLE)))::BIGINT AS gain
            FROM (SELECT unnest(range({rules.buckets})) AS bucket) k
            LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
        weights AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM d JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + floor(-1000 * ln(-ln(({noise} + 0.5::DOUBLE) / 4294967296)))::BIGINT
                AS score FROM d_words LEFT JOIN weights USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r,
              count(*) OVER () AS n FROM scored WHERE n_features >= {rules.least_words})
        SELECT doc_id, n_features, weight, score,
          CASE WHEN r <= {rules.percent} * n // 100 THEN r END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)"""


def audit_sql(filters: Filters | None = None) -> str:
    """Steps of all orders of the five filters over ``documents`` and ``labels``."""
    filters = filters or Filters()
    letters = list(filters.names)
    orders = " ".join(f"CROSS JOIN (SELECT unnest({letters}) AS f{i})" for i in range(1, 5))
    apart = " AND ".join(f"f{i} <> f{j}" for i in range(5) for j in range(i))
    joined = " || ".join(f"f{i}" for i in range(5))
    fails = f"""CASE substr(filter_order, step, 1) WHEN '{letters[0]}' THEN mask & 1
        WHEN '{letters[1]}' THEN (mask >> 1) & 1 WHEN '{letters[2]}' THEN (mask >> 2) & 1
        WHEN '{letters[3]}' THEN (mask >> 3) & 1 ELSE (mask >> 4) & 1 END = 1"""
    return f"""WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text
            FROM documents),
        measured AS (SELECT doc_id, part, text, regexp_extract_all(text, '{WORD}') AS ws,
              min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
        masks AS (SELECT doc_id, part,
              (len(ws) < {filters.least_words})::INT
              + 2 * (100 * len(list_distinct(ws)) < {filters.distinct_percent} * len(ws))::INT
              + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g'))
                     > {filters.capital_percent} * length(text))::INT
              + 8 * regexp_matches(text, '[{filters.marks}]')::INT
              + 16 * (first < doc_id)::INT AS mask FROM measured),
        cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
              count(*) FILTER (WHERE toxic = 1) AS toxic
            FROM masks LEFT JOIN labels USING (doc_id) GROUP BY part, mask),
        orders AS (SELECT {joined} AS filter_order FROM (SELECT unnest({letters}) AS f0) {orders}
            WHERE {apart}),
        steps AS (SELECT filter_order, step FROM orders CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        judged AS (SELECT part, filter_order, step, n, good, toxic, {fails} AS fails,
              bit_count(mask) = 1 AS single,
              list_bool_or(list_transform(range(1, step), lambda k:
                (mask >> (strpos('{filters.names}', substr(filter_order, k, 1)) - 1)::INT) & 1 = 1)) AS gone
            FROM steps CROSS JOIN cells),
        told AS (SELECT part, filter_order, step,
              coalesce(sum(n) FILTER (WHERE NOT fails AND NOT coalesce(gone, false)), 0) AS kept,
              coalesce(sum(n) FILTER (WHERE fails AND NOT coalesce(gone, false)), 0) AS removed,
              coalesce(sum(n) FILTER (WHERE fails AND coalesce(gone, false)), 0) AS redundant,
              coalesce(sum(n) FILTER (WHERE fails AND single), 0) AS unique_fails,
              coalesce(sum(good) FILTER (WHERE fails AND NOT coalesce(gone, false)), 0) AS good_lost,
              coalesce(sum(toxic) FILTER (WHERE fails AND NOT coalesce(gone, false)), 0) AS toxic_lost
            FROM judged GROUP BY part, filter_order, step)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
          redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
          good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
          (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley
        FROM told"""


ORACLES = {
    "op4_license_scan": scan_sql(),
    "op11_importance_resampling": resample_sql(),
    "op12_filter_audit": audit_sql(),
    "op6_quality_rules": f"""WITH {quality_sql()}
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
          CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
          CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept FROM judged""",
}
