"""DuckDB SQL for the training-data queries that SQL can express."""

from tidemark.llm import secret_scan
from tidemark.llm.license_scan import RULES, SENTENCES, normalise

_KNOWN = list(dict.fromkeys(map(normalise, SENTENCES)))
_ID = {normalise(s): i for i, s in reversed(list(enumerate(SENTENCES)))}
_SENTENCE_ID = "CASE s " + " ".join(f"WHEN '{s}' THEN {_ID[s]}" for s in _KNOWN) + " END"
_TOLD = lambda ids: "," + ",".join(str(_ID[normalise(SENTENCES[i])]) for i in ids) + ","
_LEFT = lambda r: f"replace(told, '{_TOLD(r.unless)}', ',')" if r.unless else "told"
_RULES = ", ".join(f"CASE WHEN contains({_LEFT(r)}, '{_TOLD(r.ids)}') THEN '{r.licence}' END" for r in RULES)


def _matches(rank: int, rule: secret_scan.Rule) -> str:
    """A rule's matches in order, each with what is between it and the one before."""
    p = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, r, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_extract_all(t, '{p}', {rule.group})) AS g, unnest(list_slice(string_split_regex(t, '{p}'), 1, -2)) AS b, generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i FROM d WHERE regexp_matches(t, '{p}')"""


#: The pattern of private keys looks ahead, which this SQL's patterns can't, so texts that hold such a key differ.
_FOUND = " UNION ALL ".join(_matches(i, r) for i, r in enumerate(secret_scan.RULES) if r.kind != "private_key")

SQL = {
    "op7_secret_scans": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents), f AS ({_FOUND}),
        s AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY r, rank ORDER BY i) AS e FROM f),
        k AS (SELECT r, rank, kind, (e - length(m))::BIGINT AS a, e::BIGINT AS e, concat(kind, ':', (e - length(m))::BIGINT, ':', e::BIGINT) AS told FROM s WHERE length(g) >= least),
        c AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(told, ',' ORDER BY a, rank, e) FILTER (rank < 3) AS base, string_agg(told, ',' ORDER BY a, rank, e) AS spans FROM k GROUP BY 1)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN c USING (r)
    """,
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM n WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op9_license_scans": rf"""
        WITH p AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?:])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS parts FROM documents),
        n AS (SELECT doc_id, list_transform(parts, lambda x: trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' ')) AS ss FROM p),
        i AS (SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(ss, lambda s: {_SENTENCE_ID}), lambda x: x IS NOT NULL), ','), '') AS ids FROM n),
        t AS (SELECT doc_id, ids, ',' || ids || ',' AS told FROM i),
        m AS (SELECT doc_id, ids, list_filter([{_RULES}], lambda x: x IS NOT NULL) AS hits FROM t)
        SELECT doc_id, ids AS sentence_ids, coalesce(array_to_string(list_sort(list_distinct(hits)), ','), '') AS licences, len(hits) AS n_rules FROM m
    """,
    "op5_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('h' || source, 'n') AS host FROM documents),
        w AS (SELECT doc_id, t, host, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
        e AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) r(i)),
        f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM e),
        p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM f WHERE k > 1) GROUP BY 1),
        l AS (SELECT doc_id, host, t, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)),
        k AS (SELECT doc_id, host, t, line, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k, len(ws) AS n FROM l WHERE len(ws) > 0),
        u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM k GROUP BY 1),
        x AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY 1),
        m AS (SELECT host, k FROM k JOIN x USING (host) GROUP BY host, k, texts HAVING count(DISTINCT t) > 5 AND (count(DISTINCT t) > 0.05 * texts OR count(DISTINCT t) > 10000)),
        o AS (SELECT doc_id, sum(n)::BIGINT AS n FROM k JOIN m USING (host, k) GROUP BY 1),
        r AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda s: length(s))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words, coalesce(o.n, 0) AS lost_words
            FROM w LEFT JOIN u USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN o USING (doc_id))
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_words <= 0.5 * n_words AS kept FROM r
    """,
}
