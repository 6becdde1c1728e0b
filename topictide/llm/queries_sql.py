"""DuckDB equivalents of the corpus queries."""

# ---- words and lines as the contract of op9 defines them; lists start at 1 in DuckDB ----
OP9 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT *, CASE WHEN len(w) < 5 THEN [] ELSE
        list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4])) END AS grams FROM w),
e AS (SELECT doc_id, text, unnest(grams) AS gram, generate_subscripts(grams, 1) AS pos FROM g),
twice AS (SELECT doc_id, text, pos FROM e QUALIFY count(*) OVER (PARTITION BY doc_id, text, gram) > 1),
covered AS (SELECT doc_id, text, least(5, coalesce(lead(pos) OVER (PARTITION BY doc_id, text ORDER BY pos) - pos, 5)) AS n FROM twice),
rep AS (SELECT doc_id, text, sum(n) AS n FROM covered GROUP BY ALL),
s AS (SELECT g.doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars,
        len(regexp_extract_all(g.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l) AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop
      FROM g LEFT JOIN rep ON rep.doc_id = g.doc_id AND rep.text = g.text),
b AS (SELECT *, coalesce(chars, 0)::BIGINT AS word_chars, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 16 AND n_symbols / greatest(n_words, 1) <= 0.5
  AND (n_words < 100 OR n_stop / greatest(n_words, 1) >= 0.01) AND (n_words < 50 OR n_dup_lines / greatest(n_lines, 1) <= 0.6) AS kept
FROM b
"""

OP8 = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER p AS keep_id, count(*) OVER p AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1 AS kept, sha256(text) AS text_sha256
FROM t WINDOW p AS (PARTITION BY text)
"""

OP5 = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id, url,
        translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1) AS query FROM p),
c AS (SELECT *, CASE WHEN contains(url, '://') THEN
        regexp_replace(host, '^www\.|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS canonical
      FROM (SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS q FROM h)),
ads AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|\.)ads(-|\.)') AND canonical IS NOT NULL),
r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT c.*, (SELECT max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) FROM r
        WHERE (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)) AS ruled FROM c)
SELECT page_id, host, path, ruled.rule AS rule, ads.canonical IS NOT NULL AS listed,
  coalesce(ruled.verdict, CASE WHEN ads.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN ads USING (canonical)
"""

OP10 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
l AS (SELECT conv_id, string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text) AS taught,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns, count(*) AS n_turns,
        sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_start|>') + length('<|im_end|>') + 2)::BIGINT AS formatted_chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(taught) AS loss_chars, sha256(taught) AS loss_sha256, formatted_chars FROM l
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
l AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS l FROM d),
n AS (SELECT *, len(l) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM l),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS pos FROM i)),
x AS (SELECT rid, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS win
      FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
o AS (SELECT rid, pos, k, item_id FROM x JOIN b USING (k, win)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + k)) AS p FROM o) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM o) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN s USING (rid)
"""


def _oracle() -> dict[str, str]:
    from topictide.llm.quality_rules import STOP_WORDS

    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return {"op5_url_filter": OP5, "op10_chat_formatting": OP10, "op8_exact_dedup": OP8, "op9_quality_rules": OP9.replace("{stop}", stop), "op11_fill_in_middle": OP11, "op12_benchmark_decontamination": OP12}


ORACLE = _oracle()
