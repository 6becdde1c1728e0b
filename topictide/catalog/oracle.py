"""The registered queries as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from topictide.catalog.inputs import STOPWORDS

# The settings of the stored results as JSON with sorted keys, written out.
_RESULT_JSON = '{"job_name": "topics-monthly", "n_topics": 7, "sampling_freq": "monthly"}'

# ---- fixed values: decompositions of the accented letters of the given tables ----
_ACCENTS = {
    "ä": "ä", "ç": "ç", "è": "è", "é": "é", "ê": "ê", "í": "í",
    "ñ": "ñ", "ó": "ó", "ö": "ö", "ü": "ü",
    "Ä": "Ä", "Ç": "Ç", "È": "È", "É": "É", "Ê": "Ê", "Í": "Í",
    "Ñ": "Ñ", "Ó": "Ó", "Ö": "Ö", "Ü": "Ü",
}
_PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _nfkd(x: str) -> str:
    for letter, parts in _ACCENTS.items():
        x = f"replace({x}, '{letter}', '{parts}')"
    return x


def _clean(x: str) -> str:
    x = f"regexp_replace({_nfkd(f'lower({x})')}, '[{_SPACE}]+', ' ', 'g')"
    x = f"regexp_replace({x}, 'http[^{_SPACE}]+', '', 'g')"
    return f"trim(translate({x}, '{_PUNCTUATION}', ''))"


_WEEK = "date_trunc('week', {0} - INTERVAL 1 DAY) + INTERVAL 1 DAY"
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

# Named steps; each may use those above it.
STEPS: dict[str, str] = {
    "docs": """SELECT doc_id, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 180 AS INTEGER)) AS published,
        split_part(text, chr(10), 1) AS title,
        CASE WHEN position(chr(10) IN text) > 0 THEN substr(text, position(chr(10) IN text) + 1) ELSE '' END AS summary,
        source AS authors, 'doc:' || doc_id AS link FROM documents""",
    "raw": """SELECT CAST(doc_id AS VARCHAR) AS id, title, nullif(summary, '') AS summary,
        CASE WHEN doc_id % 10 = 3 THEN 'not a date' ELSE strftime(published, '%Y-%m-%dT%H:%M:%SZ') END AS published,
        authors, link FROM docs""",
    "staged": """SELECT id,
        sha256(id || '|' || coalesce(title, 'nan') || '|' || coalesce(summary, 'nan') || '|' || published || '|' || authors || '|' || link) AS hash,
        CASE WHEN published <> 'not a date' THEN CAST(replace(published, 'Z', '') AS TIMESTAMP) END AS published FROM raw""",
    "clean": f"""SELECT doc_id, published, title, {_clean("title || ' ' || summary")} AS text FROM docs""",
    "monthly": """SELECT doc_id, published, text, date_trunc('month', published) AS slice,
        strftime(published, '%Y-%m') AS slice_label FROM clean""",
    "weekly": f"""SELECT doc_id, published, text, {_WEEK.format('published')} AS slice,
        strftime({_WEEK.format('published')}, '%Y-%m-%d') AS slice_label FROM clean""",
    "word": """SELECT doc_id, slice, slice_label, unnest(string_split(text, ' ')) AS w FROM monthly""",
    "unstopped": f"""SELECT m.doc_id, m.slice_label, coalesce(s.text, '') AS text FROM monthly m LEFT JOIN (
        SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM (
            SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM clean)
        WHERE w <> '' AND w NOT IN ({_STOP}) GROUP BY doc_id) s USING (doc_id)""",
    "tf": r"""SELECT slice_label, doc_id, term, count(*) AS tf FROM (
        SELECT slice_label, doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]{2,}')) AS term FROM monthly)
        GROUP BY ALL""",
    "stats": "SELECT slice_label, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY ALL",
    "totals": "SELECT slice_label, count(*) AS n FROM monthly GROUP BY ALL",
    "vocab50": """SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY slice_label ORDER BY cf DESC, term) <= 50""",
    "vocab200": """SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY slice_label ORDER BY cf DESC, term) <= 200""",
    "vocab500": """SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY slice_label ORDER BY cf DESC, term) <= 500""",
    "labels": """SELECT doc_id, strftime(published, '%Y-%m') AS slice_label, CAST(doc_id % 7 - 1 AS INTEGER) AS topic FROM docs""",
    "tc": """SELECT slice_label, topic, term, CAST(sum(tf) AS BIGINT) AS tf FROM tf JOIN labels USING (doc_id, slice_label) GROUP BY ALL""",
    "ctfidf": """SELECT slice_label, topic, term, tf, tf / words * ln(1 + mean / total) AS score FROM tc
        JOIN (SELECT slice_label, topic, sum(tf) AS words FROM tc GROUP BY ALL) USING (slice_label, topic)
        JOIN (SELECT slice_label, term, sum(tf) AS total FROM tc GROUP BY ALL) USING (slice_label, term)
        JOIN (SELECT slice_label, sum(tf) / count(DISTINCT topic) AS mean FROM tc GROUP BY ALL) USING (slice_label)""",
    "terms": """SELECT slice_label, topic, row_number() OVER (PARTITION BY slice_label, topic ORDER BY round(score, 6) DESC, term) AS rank,
        term, score FROM ctfidf QUALIFY rank <= 10""",
    "trend_terms": """SELECT slice_label, topic, rank, CASE WHEN term IN ('the', 'de') THEN 'language'
        WHEN term IN ('of', 'la') THEN 'model' ELSE term END AS term FROM terms""",
    "trend_text": "SELECT slice_label, topic, string_agg(term, ' ' ORDER BY rank) AS text FROM trend_terms GROUP BY ALL",
    "weights": """SELECT slice_label, doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM (
        SELECT slice_label, doc_id, term, tf * (ln((1e0 + n) / (1e0 + df)) + 1e0) AS raw
        FROM tf JOIN stats USING (slice_label, term) JOIN totals USING (slice_label))""",
    "full_weights": """SELECT slice_label, doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM (
        SELECT slice_label, doc_id, term, tf * (ln((1e0 + n) / (1e0 + df)) + 1e0) AS raw
        FROM tf JOIN stats USING (slice_label, term) JOIN totals USING (slice_label))""",
    "sums": "SELECT slice_label, topic, term, sum(weight) AS s FROM weights JOIN labels USING (slice_label, doc_id) GROUP BY ALL",
    "centers": "SELECT slice_label, topic, term, s / sqrt(sum(s * s) OVER (PARTITION BY slice_label, topic)) AS c FROM sums",
    "reps": """SELECT slice_label, topic, row_number() OVER (PARTITION BY slice_label, topic ORDER BY round(sim, 6) DESC, doc_id) AS rank,
        doc_id, sim FROM (SELECT slice_label, topic, doc_id, sum(weight * c) AS sim FROM weights JOIN labels USING (slice_label, doc_id)
        JOIN centers USING (slice_label, topic, term) GROUP BY ALL) QUALIFY rank <= 3""",
    "near": """SELECT a.doc_id AS a, b.doc_id AS b FROM full_weights a JOIN full_weights b USING (slice_label, term)
        GROUP BY ALL HAVING round(sum(a.weight * b.weight), 6) >= 0.6""",
    "core": "SELECT a AS doc_id FROM near GROUP BY a HAVING count(*) >= 3",
    "link": "SELECT a, b FROM near WHERE a IN (SELECT doc_id FROM core) AND b IN (SELECT doc_id FROM core)",
    "reach": "SELECT doc_id AS a, doc_id AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b",
    "component": "SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY a",
    "near_reach": "SELECT a, a AS b FROM near GROUP BY a UNION SELECT r.a, n.b FROM near_reach r JOIN near n ON n.a = r.b",
    "dense": """SELECT slice_label, root, row_number() OVER (PARTITION BY slice_label ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
        FROM component JOIN labels USING (doc_id) GROUP BY slice_label, root HAVING count(*) >= 5""",
    "density": """SELECT doc_id, slice_label, coalesce(topic, -1) AS topic FROM labels l0 LEFT JOIN component USING (doc_id)
        LEFT JOIN (SELECT root, topic FROM dense) USING (root)""".replace(
        "FROM labels l0", "FROM (SELECT doc_id, slice_label FROM labels) l0"
    ),
    "xy": """SELECT label % 6 AS m, vec_id AS doc_id, round(list_sum(list_transform(embedding[1:32], lambda v: CAST(v AS DOUBLE))), 9) AS x,
        round(list_sum(list_transform(embedding[33:64], lambda v: CAST(v AS DOUBLE))), 9) AS y FROM embeddings""",
    "xy_near": """SELECT p.m, p.doc_id AS a, q.doc_id AS b FROM xy p JOIN xy q ON p.m = q.m
        AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 0.2e0 * 0.2e0""",
    "xy_core": "SELECT a FROM xy_near GROUP BY a HAVING count(*) >= 4",
    "xy_reach": """SELECT a, a AS b FROM xy_core UNION SELECT r.a, n.b FROM xy_reach r JOIN xy_near n ON n.a = r.b
        WHERE n.b IN (SELECT a FROM xy_core)""",
    "xy_component": "SELECT a AS doc_id, min(b) AS root FROM xy_reach GROUP BY a",
    "xy_topic": """SELECT m, root, row_number() OVER (PARTITION BY m ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
        FROM xy_component JOIN xy USING (doc_id) GROUP BY m, root HAVING count(*) >= 5""",
    "sparse_labels": f"""SELECT doc_id, strftime({_WEEK.format('published')}, '%Y-%m-%d') AS slice_label,
        CAST(CASE WHEN doc_id % 3 = 0 THEN 10 + dayofyear(published) % 20 ELSE doc_id % 4 - 1 END AS INTEGER) AS topic FROM docs""",
    "week_events": f"""SELECT event_id AS doc_id, ts AS published, {_WEEK.format('ts')} AS slice FROM events""",
    "weeks2024": """SELECT s AS start, s + INTERVAL 7 DAY AS "end" FROM (
        SELECT unnest(generate_series(make_timestamp(a, 1, 1, 0, 0, 0), make_timestamp(b, 12, 31, 0, 0, 0), INTERVAL 7 DAY)) AS s
        FROM (SELECT min(year(published)) AS a, max(year(published)) AS b FROM docs))""",
}

_NEEDS = {
    "raw": ["docs"], "staged": ["raw"], "clean": ["docs"], "monthly": ["clean"], "weekly": ["clean"], "word": ["monthly"],
    "unstopped": ["monthly"], "tf": ["monthly"], "stats": ["tf"], "totals": ["monthly"], "vocab50": ["stats"],
    "vocab200": ["stats"], "vocab500": ["stats"], "labels": ["docs"], "tc": ["tf", "labels"], "ctfidf": ["tc"],
    "terms": ["ctfidf"], "trend_terms": ["terms"], "trend_text": ["trend_terms"],
    "weights": ["stats", "totals"], "full_weights": ["stats", "totals"], "sums": ["weights", "labels"],
    "centers": ["sums"], "reps": ["centers"], "near": ["full_weights"], "core": ["near"], "link": ["core"],
    "reach": ["link"], "component": ["reach"], "near_reach": ["near"], "dense": ["component", "labels"], "density": ["dense"],
    "xy_near": ["xy"], "xy_core": ["xy_near"], "xy_reach": ["xy_core"], "xy_component": ["xy_reach"], "xy_topic": ["xy_component"],
    "sparse_labels": ["docs"], "weeks2024": ["docs"],
}


def sql(body: str, *steps: str) -> str:
    """``body`` behind a WITH clause of the named steps and all they need."""
    needed: set[str] = set()

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        needed.add(name)

    for step in steps:
        add(step)
    if not needed:
        return body
    shared = {"tf", "stats", "full_weights", "near", "core", "link", "weights", "ctfidf", "tc", "terms"}
    parts = [
        f"{name}{'(a, b)' if name.endswith('reach') else ''} AS {'MATERIALIZED ' if name in shared else ''}({STEPS[name]})"
        for name in STEPS if name in needed
    ]
    recursive = "RECURSIVE " if needed & {"reach", "xy_reach", "near_reach"} else ""
    return f"WITH {recursive}{', '.join(parts)} {body}"


def _ranges(step: str, stop: str) -> str:
    return f"""SELECT s AS start, s + INTERVAL {step} AS "end" FROM (
        SELECT unnest(generate_series(make_timestamp(a, 1, 1, 0, 0, 0), make_timestamp(b, 12, {stop}, 0, 0, 0), INTERVAL {step})) AS s
        FROM (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders))"""


_TFIDF = """SELECT slice_label, doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM (
    SELECT slice_label, doc_id, term, tf * (ln((1e0 + n) / (1e0 + df)) + 1e0) AS raw FROM {tf} JOIN {vocab} USING (slice_label, term)
    JOIN totals USING (slice_label))"""

# The same term statistics over other texts or slices.
_OTHER_TF = r"""tf2 AS (SELECT slice_label, doc_id, term, count(*) AS tf FROM (SELECT slice_label, doc_id,
    unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {src}) GROUP BY ALL),
    stats2 AS (SELECT slice_label, term, count(*) AS df, sum(tf) AS cf FROM tf2 GROUP BY ALL),
    totals2 AS (SELECT slice_label, count(*) AS n FROM {src} GROUP BY ALL),
    vocab2 AS (SELECT * FROM stats2 QUALIFY row_number() OVER (PARTITION BY slice_label ORDER BY cf DESC, term) <= {cut}),
    weights2 AS (SELECT slice_label, doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM (
        SELECT slice_label, doc_id, term, tf * (ln((1e0 + n) / (1e0 + df)) + 1e0) AS raw FROM tf2
        JOIN vocab2 USING (slice_label, term) JOIN totals2 USING (slice_label)))"""

_ALL = 1_000_000_000


def _other(body: str, src: str, cut: int, *steps: str, extra: str = "") -> str:
    return sql("", *steps) + ", " + extra + _OTHER_TF.format(src=src, cut=cut) + " " + body


_FLAG = "SELECT DISTINCT slice_label, topic FROM trend_text WHERE regexp_matches(lower(text), 'on th|language model|ou de')"

ORACLE: dict[str, str] = {
    "t1_time_ranges_monthly": _ranges("1 MONTH", "1"),
    "t1_time_ranges_weekly": _ranges("7 DAY", "31"),
    "t1_time_ranges_daily": _ranges("1 DAY", "31"),
    "t2_assign_intervals_half_open": sql(
        'SELECT doc_id, start, "end" FROM docs JOIN weeks2024 ON published >= start AND published < "end"', "weeks2024"
    ),
    "t2_assign_intervals_closed": sql(
        'SELECT doc_id, start, "end" FROM docs JOIN weeks2024 ON published >= start AND published <= "end"', "weeks2024"
    ),
    "j2_range_join_orders": f"""WITH r AS ({_ranges("1 MONTH", "1")}) SELECT start, "end", count(*) AS n_orders
        FROM orders JOIN r ON o_orderdate >= start AND o_orderdate <= "end" GROUP BY ALL""",
    "t3_cap_per_interval": """SELECT start, doc_id FROM (SELECT event_id AS doc_id, ts,
            date_trunc('year', ts) + to_days(CAST(7 * ((dayofyear(ts) - 1) // 7) AS INTEGER)) AS start FROM events)
        QUALIFY row_number() OVER (PARTITION BY start ORDER BY ts DESC, doc_id) <= 100""",
    "t4_pending_intervals": sql(
        'SELECT start, "end" FROM weeks2024 w WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.ts >= w.start AND e.ts < w."end")',
        "weeks2024",
    ),
    "t5_empty_intervals": sql(
        'SELECT start, "end" FROM weeks2024 w WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.published >= w.start AND d.published < w."end")',
        "weeks2024",
    ),
    "t6_slice_monthly": "SELECT o_orderkey, date_trunc('month', o_orderdate) AS slice, strftime(o_orderdate, '%Y-%m') AS slice_label FROM orders",
    "t7_slice_weekly": sql("SELECT doc_id, slice, strftime(slice, '%Y-%m-%d') AS slice_label FROM week_events", "week_events"),
    "t7_slice_daily": "SELECT event_id AS doc_id, date_trunc('day', ts) AS slice, strftime(ts, '%Y-%m-%d') AS slice_label FROM events",
    "t8_slice_labels": sql(
        f"""SELECT doc_id, strftime(published, '%Y-%m') AS monthly_label, strftime({_WEEK.format('published')}, '%Y-%m-%d') AS weekly_label,
        strftime(published, '%Y-%m-%d') AS daily_label FROM docs""", "docs",
    ),
    "t9_date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
        strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""",
    "t10_min_docs": sql(
        "SELECT doc_id, slice_label FROM weekly WHERE slice_label IN (SELECT slice_label FROM weekly GROUP BY 1 HAVING count(*) >= 15)",
        "weekly",
    ),
    "t11_slice_sizes": sql(
        "SELECT strftime(slice, '%Y-%m-%d') AS slice_label, count(*) AS n_docs FROM week_events GROUP BY 1", "week_events"
    ),
    "p1_standardise_columns": "SELECT o_orderkey, o_totalprice AS total_price FROM orders",
    "p2_row_hash": sql("SELECT id, hash FROM staged", "staged"),
    "p3_parse_date": sql("SELECT id, published FROM staged", "staged"),
    "p4_staged": sql(
        """SELECT id, hash, published, CAST(year(published) AS INTEGER) AS year, CAST(month(published) AS INTEGER) AS month,
        strftime(published, '%Y-%m') AS year_month FROM staged WHERE published IS NOT NULL""", "staged",
    ),
    "p5_record_fields": """SELECT doc_id AS id, lang AS title, text AS summary, n_chars AS published,
        source || ', ' || lang AS authors, source AS link FROM documents""",
    "p6_flatten_authors": "SELECT doc_id AS id, source || ', ' || lang AS authors FROM documents",
    "p7_join_title_summary": sql(
        "SELECT id, CASE WHEN summary IS NULL THEN title ELSE title || ' ' || summary END AS text FROM raw", "raw"
    ),
    "p8_expand_contractions": """SELECT doc_id, regexp_replace(regexp_replace(text, ' the ', ' do not ', 'g'), ' of ', ' it is ', 'g') AS text
        FROM documents""",
    "p9_lowercase": "SELECT doc_id, lower(text) AS text FROM documents",
    "p10_nfkd": f"SELECT doc_id, {_nfkd('text')} AS text FROM documents",
    "p11_collapse_whitespace": f"SELECT conv_id, turn, regexp_replace(text, '[{_SPACE}]+', ' ', 'g') AS text FROM conversations",
    "p12_remove_urls": f"SELECT page_id, regexp_replace('see ' || url || ' ' || html, 'http[^{_SPACE}]+', '', 'g') AS text FROM pages",
    "p13_remove_punctuation": f"SELECT page_id, translate(html, '{_PUNCTUATION}', '') AS text FROM pages",
    "p14_strip": f"SELECT conv_id, turn, regexp_replace(text, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS text FROM conversations",
    "p15_clean_text": sql("SELECT doc_id, text FROM clean", "clean"),
    "p16_metadata": sql("SELECT doc_id AS id, title, published FROM docs", "docs"),
    "p17_tokens": sql(
        r"SELECT doc_id, array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]{2,}'), ' ') AS tokens FROM clean", "clean"
    ),
    "p18_remove_stopwords": sql("SELECT doc_id, text FROM unstopped", "unstopped"),
    "p22_max_membership": "SELECT vec_id, round(CAST(list_max(embedding) AS DOUBLE), 6) AS probability FROM embeddings",
    "p24_empty_documents": sql(
        """SELECT slice_label, count(*) AS n_docs, count(*) FILTER (u.text = '') AS n_empty FROM weekly JOIN
        (SELECT doc_id, text FROM unstopped) u USING (doc_id) GROUP BY slice_label""", "weekly", "unstopped",
    ),
    "p25_l2_normalise": """SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value FROM (
        SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) * 3e0 AS x FROM embeddings)""",
    "j1_corpus_metadata": sql("SELECT doc_id, text, title, published FROM clean", "clean"),
    "j4_stopword_join": sql(
        """SELECT w AS word, count(*) AS n FROM word WHERE w <> '' AND w NOT IN (SELECT lower(n_name) FROM nation)
        AND w NOT IN (SELECT unnest(string_split(lower(text), ' ')) FROM benchmark) GROUP BY w""", "word",
    ),
    "a1_staged_per_year": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_records FROM orders GROUP BY 1",
    "a17_dedupe": sql(
        "SELECT min(doc_id) AS doc_id, sha256(title || '|' || summary) AS hash FROM docs GROUP BY sha256(title || '|' || summary)", "docs"
    ),
    "u1_concat_parts": """SELECT doc_id AS id, lang, text, CAST(NULL AS VARCHAR) AS role FROM documents
        UNION ALL SELECT conv_id, NULL, text, role FROM conversations""",
    "a3_term_counts": sql("SELECT doc_id, term, tf FROM tf", "tf"),
    "a4_document_frequency": _other(
        "SELECT slice_label, term, df, n AS n_docs FROM stats2 JOIN totals2 USING (slice_label)", "weekly", _ALL, "weekly"
    ),
    "a5_keyword_freq": sql("SELECT slice_label, term, cf AS frequency FROM stats", "stats"),
    "w2_vocab": sql("SELECT slice_label, term, cf FROM vocab500", "vocab500"),
    "m1_count_vectors": sql(
        """SELECT doc_id, term_id, tf FROM tf JOIN (SELECT slice_label, term,
        row_number() OVER (PARTITION BY slice_label ORDER BY term) - 1 AS term_id FROM vocab500) USING (slice_label, term)""", "vocab500",
    ),
    "a6_tfidf_doc": sql("SELECT doc_id, term, round(weight, 6) AS weight FROM full_weights", "full_weights"),
    "a6_tfidf_doc_top_vocab": sql(
        f"SELECT doc_id, term, round(weight, 6) AS weight FROM ({_TFIDF.format(tf='tf', vocab='vocab500')})", "vocab500", "totals"
    ),
    "a7_tfidf_slice": sql(
        f"SELECT slice_label, term, round(sum(weight), 6) AS score FROM ({_TFIDF.format(tf='tf', vocab='vocab500')}) GROUP BY ALL",
        "vocab500", "totals",
    ),
    "a8_tfidf_plain": sql(
        """SELECT slice_label, term, round(sum(tf / len * ln(n / (1e0 + df))), 6) AS score FROM tf
        JOIN (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY ALL) USING (doc_id) JOIN stats USING (slice_label, term)
        JOIN totals USING (slice_label) GROUP BY slice_label, term""", "stats", "totals",
    ),
    "a9_tfidf_corpus": _other(
        "SELECT term, round(sum(weight), 6) AS score FROM weights2 GROUP BY term", "whole", 500, "clean",
        extra="whole AS (SELECT doc_id, text, 'all' AS slice_label FROM clean), ",
    ),
    "w1_top_keywords": _other(
        """SELECT slice_label, row_number() OVER (PARTITION BY slice_label ORDER BY round(score, 6) DESC, term) AS rank, term, round(score, 6) AS score
        FROM (SELECT slice_label, term, sum(weight) AS score FROM weights2 GROUP BY ALL) QUALIFY rank <= 10""", "unstopped", _ALL, "unstopped",
    ),
    "w9_document_keywords": sql(
        """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 6) DESC, term) AS rank, term, round(weight, 6) AS weight
        FROM full_weights QUALIFY rank <= 5""", "full_weights",
    ),
    "w11_keyword_freq_sorted": sql("SELECT slice_label, term, cf AS frequency FROM vocab500", "vocab500"),
    "p21_joined_keywords": sql(
        f"""SELECT slice_label, string_agg(term, ', ' ORDER BY rank) AS top_keywords FROM (SELECT slice_label, term,
        row_number() OVER (PARTITION BY slice_label ORDER BY round(score, 6) DESC, term) AS rank FROM (SELECT slice_label, term,
        sum(weight) AS score FROM ({_TFIDF.format(tf='tf', vocab='vocab500')}) GROUP BY ALL) QUALIFY rank <= 10) GROUP BY slice_label""",
        "vocab500", "totals",
    ),
    "m17_tfidf_timesliced": _other(
        "SELECT slice_label, term, round(sum(weight), 6) AS score FROM weights2 GROUP BY ALL", "unstopped_weekly", 500, "weekly", "unstopped",
        extra="unstopped_weekly AS (SELECT doc_id, w.slice_label, u.text FROM weekly w JOIN unstopped u USING (doc_id)), ",
    ),
    "a16_topic_sizes": sql('SELECT slice_label, topic, count(*) AS "count" FROM labels GROUP BY ALL', "labels"),
    "a18_ctfidf": sql("SELECT slice_label, topic, term, tf, round(score, 6) AS score FROM ctfidf", "ctfidf"),
    "w4_topic_terms": sql("SELECT slice_label, topic, rank, term, round(score, 6) AS score FROM terms", "terms"),
    "w7_number_topics": sql(
        """SELECT doc_id, coalesce(topic, -1) AS topic FROM (SELECT doc_id, authors, strftime(published, '%Y-%m') AS m FROM docs)
        LEFT JOIN (SELECT strftime(published, '%Y-%m') AS m, authors, row_number() OVER (
            PARTITION BY strftime(published, '%Y-%m') ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
            FROM docs WHERE authors <> 'src0' GROUP BY 1, 2 HAVING count(*) >= 5) USING (m, authors)""", "docs",
    ),
    "w8_representative_docs": sql("SELECT slice_label, topic, rank, doc_id, round(sim, 6) AS similarity FROM reps", "reps"),
    "m11_topic_info": sql(
        """SELECT slice_label, topic, "count", topic || '_' || array_to_string(list_slice(words, 1, 4), '_') AS name,
        array_to_string(words, ' ') AS representation, representative_docs
        FROM (SELECT slice_label, topic, count(*) AS "count" FROM labels GROUP BY ALL)
        JOIN (SELECT slice_label, topic, list(term ORDER BY rank) AS words FROM terms GROUP BY ALL) USING (slice_label, topic)
        JOIN (SELECT slice_label, topic, string_agg(doc_id, ' ' ORDER BY rank) AS representative_docs FROM reps GROUP BY ALL)
        USING (slice_label, topic)""", "terms", "reps", "labels",
    ),
    "m12_document_topics": sql(
        """SELECT l.doc_id, l.topic, round(p, 6) AS probability FROM labels l JOIN (
        SELECT doc_id, max(exp(cosine / 0.1e0)) / sum(exp(cosine / 0.1e0)) AS p FROM (
            SELECT d.doc_id, k.topic, coalesce(sum(w.weight * c.c), 0) AS cosine FROM labels d
            JOIN (SELECT DISTINCT slice_label, topic FROM labels WHERE topic >= 0) k USING (slice_label)
            LEFT JOIN weights w ON w.doc_id = d.doc_id
            LEFT JOIN centers c ON c.slice_label = d.slice_label AND c.topic = k.topic AND c.term = w.term GROUP BY ALL)
        GROUP BY doc_id) USING (doc_id)""", "centers",
    ),
    "m8_reduce_topics": sql(
        """, tp AS (SELECT DISTINCT slice_label, topic FROM centers WHERE topic >= 0),
        dots AS (SELECT a.slice_label, a.topic AS x, b.topic AS y, sum(a.c * b.c) AS s FROM centers a
            JOIN centers b ON a.slice_label = b.slice_label AND a.term = b.term GROUP BY ALL),
        base AS MATERIALIZED (SELECT p.slice_label, p.topic AS x, q.topic AS y, coalesce(s, 0) AS s FROM tp p JOIN tp q USING (slice_label)
            LEFT JOIN dots ON dots.slice_label = p.slice_label AND dots.x = p.topic AND dots.y = q.topic),
        m0 AS (SELECT slice_label, topic, topic AS g FROM tp)"""
        + "".join(
            f""", best{i} AS MATERIALIZED (SELECT * FROM (SELECT b.slice_label, p.g AS ga, q.g AS gb, round(avg(s), 12) AS s FROM base b
                JOIN m{i} p ON p.slice_label = b.slice_label AND p.topic = b.x JOIN m{i} q ON q.slice_label = b.slice_label AND q.topic = b.y
                WHERE p.g < q.g GROUP BY ALL)
            WHERE slice_label IN (SELECT slice_label FROM m{i} GROUP BY slice_label HAVING count(DISTINCT g) > 3)
            QUALIFY row_number() OVER (PARTITION BY slice_label ORDER BY s DESC, ga, gb) = 1),
        m{i + 1} AS MATERIALIZED (SELECT m{i}.slice_label, topic, CASE WHEN g = gb THEN ga ELSE g END AS g
            FROM m{i} LEFT JOIN best{i} USING (slice_label))"""
            for i in range(3)
        )
        + """, merged AS (SELECT doc_id, slice_label, coalesce(g, topic) AS t FROM labels LEFT JOIN m3 USING (slice_label, topic)),
        numbered AS (SELECT slice_label, t, row_number() OVER (PARTITION BY slice_label ORDER BY count(*) DESC, min(doc_id)) - 1 AS n
            FROM merged WHERE t >= 0 GROUP BY slice_label, t)
        SELECT doc_id, coalesce(n, -1) AS topic FROM merged LEFT JOIN numbered USING (slice_label, t)""", "centers",
    ),
    "j11_core_documents": sql("SELECT doc_id FROM core", "core"),
    "j11_cosine_links": sql(
        """SELECT a AS doc_id, n_links, class_id FROM (SELECT a, count(*) - 1 AS n_links FROM near GROUP BY a)
        JOIN (SELECT a, min(b) AS class_id FROM near_reach GROUP BY a) USING (a)""", "near_reach",
    ),
    "m7_density_topics": sql("SELECT doc_id, topic FROM density", "density"),
    "m7_grid_density_topics": sql(
        """SELECT doc_id, coalesce(topic, -1) AS topic FROM xy LEFT JOIN xy_component USING (doc_id)
        LEFT JOIN (SELECT root, topic FROM xy_topic) USING (root)""", "xy_topic",
    ),
    "p19_flagged_topics": sql(_FLAG, "trend_text"),
    "a10_topic_ids": sql("SELECT DISTINCT slice_label, topic FROM labels", "labels"),
    "a11_topic_text": sql("SELECT slice_label, topic, string_agg(term, ' ' ORDER BY rank) AS text FROM terms GROUP BY ALL", "terms"),
    "a12_presence": sql("SELECT topic, count(DISTINCT slice_label) AS n_slices FROM sparse_labels GROUP BY topic", "sparse_labels"),
    "a13_stable": sql(
        """SELECT topic, count(DISTINCT slice_label) AS n_slices FROM sparse_labels GROUP BY topic
        HAVING count(DISTINCT slice_label) >= floor(0.6e0 * (SELECT count(DISTINCT slice_label) FROM sparse_labels))""", "sparse_labels",
    ),
    "a14_flagged_ids": sql(f"SELECT DISTINCT topic FROM ({_FLAG})", "trend_text"),
    "a15_topic_counts": sql("SELECT slice_label, topic, count(*) AS doc_count FROM sparse_labels GROUP BY ALL", "sparse_labels"),
    "j7_baseline_topics": sql(
        """SELECT topic FROM labels GROUP BY topic
        HAVING count(DISTINCT slice_label) >= floor(0.6e0 * (SELECT count(DISTINCT slice_label) FROM labels))
        AND topic NOT IN (SELECT topic FROM terms WHERE contains(term, 'whthti'))""", "labels", "terms",
    ),
    "m15_trend_summary": sql(
        """, flagged AS (SELECT slice_label, topic FROM trend_text WHERE regexp_matches(lower(text), 'en|st')),
        counts AS (SELECT slice_label, topic, count(*) AS doc_count FROM labels WHERE slice_label IN (SELECT slice_label FROM terms) GROUP BY ALL),
        stable AS (SELECT topic FROM counts GROUP BY topic
            HAVING count(DISTINCT slice_label) >= floor(0.6e0 * (SELECT count(DISTINCT slice_label) FROM terms)))
        SELECT slice_label, topic, label, doc_count FROM (SELECT c.*, CASE WHEN f.topic IS NOT NULL THEN 'llm_related'
            WHEN c.topic IN (SELECT topic FROM stable) AND c.topic NOT IN (SELECT topic FROM flagged) THEN 'baseline' END AS label
            FROM counts c LEFT JOIN flagged f USING (slice_label, topic)) WHERE label IS NOT NULL""", "trend_text", "labels",
    ),
    "j9_attach_layout": sql(
        "SELECT doc_id, topic, round(x, 6) AS x, round(y, 6) AS y FROM labels LEFT JOIN xy USING (doc_id)", "labels", "xy",
    ),
    "j8_counted_slices": sql(
        "SELECT slice_label, topic, count(*) AS doc_count FROM labels WHERE slice_label <= '2024-04' GROUP BY ALL", "labels"
    ),
    "p23_complete_positions": sql(
        """SELECT slice_label, topic, n, round(x, 6) AS x, round(y, 6) AS y FROM (
            SELECT slice_label, topic, avg(x) AS x, avg(y) AS y FROM labels JOIN xy USING (doc_id) GROUP BY ALL)
        JOIN (SELECT slice_label, topic, count(*) AS n FROM terms GROUP BY ALL) USING (slice_label, topic)""", "labels", "xy", "terms",
    ),
    "m14_topic_positions": sql(
        """SELECT slice_label, topic, term AS keyword, round(score, 6) AS score, round(x, 6) AS x, round(y, 6) AS y FROM terms JOIN (
        SELECT slice_label, topic, avg(x) AS x, avg(y) AS y
        FROM labels JOIN xy USING (doc_id) GROUP BY ALL) USING (slice_label, topic)""", "terms", "labels", "xy",
    ),
    "m16_cluster_timesliced": sql(
        """, c AS (SELECT slice_label, topic, term, CAST(sum(tf) AS BIGINT) AS tf FROM tf JOIN density USING (doc_id, slice_label) GROUP BY ALL),
        s AS (SELECT slice_label, topic, term, tf / words * ln(1 + mean / total) AS score FROM c
            JOIN (SELECT slice_label, topic, sum(tf) AS words FROM c GROUP BY ALL) USING (slice_label, topic)
            JOIN (SELECT slice_label, term, sum(tf) AS total FROM c GROUP BY ALL) USING (slice_label, term)
            JOIN (SELECT slice_label, sum(tf) / count(DISTINCT topic) AS mean FROM c GROUP BY ALL) USING (slice_label)),
        t AS (SELECT slice_label, topic, term, row_number() OVER (PARTITION BY slice_label, topic ORDER BY round(score, 6) DESC, term) AS rank
            FROM s QUALIFY rank <= 4)
        SELECT slice_label, topic, "count", topic || '_' || words AS name, n_terms, n_terms AS n_positions,
            "count" AS n_docs, "count" AS n_placed, "count" AS n_vectors
        FROM (SELECT slice_label, topic, count(*) AS "count" FROM density GROUP BY ALL)
        JOIN (SELECT slice_label, topic, least(count(*), 10) AS n_terms FROM s GROUP BY ALL) USING (slice_label, topic)
        JOIN (SELECT slice_label, topic, string_agg(term, '_' ORDER BY rank) AS words FROM t GROUP BY ALL) USING (slice_label, topic)""",
        "density", "tf",
    ),
    "s1_read_raw": sql(
        """SELECT CAST(doc_id AS VARCHAR) AS id, title, nullif(summary, '') AS summary, strftime(published, '%Y-%m-%d %H:%M:%S') AS published, authors, link FROM docs""",
        "docs",
    ),
    "s2_read_staged": """SELECT o_orderkey AS id, o_orderdate AS published, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""",
    "s3_metadata": sql("SELECT doc_id AS id, title, published FROM docs", "docs"),
    "s4_corpus_lines": sql("SELECT text FROM clean", "clean"),
    "s5_stopwords": """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS pos, lower(n_name) AS word FROM nation""",
    "w6_first_stopwords": """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS pos, lower(n_name) AS word FROM nation
        QUALIFY pos < 7""",
    "s6_slice_results": sql("SELECT slice_label, topic, count(*) AS doc_count FROM labels GROUP BY ALL", "labels"),
    "s9_keywords_csv": sql("SELECT slice_label, term, cf AS frequency FROM vocab500", "vocab500"),
    "s10_keywords_parquet": sql("SELECT slice_label, term, cf AS frequency FROM vocab500", "vocab500"),
    "s11_embeddings": """SELECT vec_id AS doc_id, '2024-0' || (label % 6 + 1) AS slice_label,
        md5(array_to_string(list_transform(embedding, lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 10000) AS BIGINT) AS VARCHAR)), ',')) AS digest
        FROM embeddings""",
    "s13_result_layout": sql(
        f"""SELECT topic, doc_count, model, substr(sha1('{_RESULT_JSON}'), 1, 8) AS config_hash, slice_label FROM
        (SELECT slice_label, topic, count(*) AS doc_count FROM labels GROUP BY ALL), (VALUES ('tfidf'), ('clusters')) AS m(model)""",
        "labels",
    ),
}
ORACLE["s12_trend_csv"] = ORACLE["m15_trend_summary"]
ORACLE["s12_positions_csv"] = ORACLE["m14_topic_positions"]
ORACLE["s9_topics_csv"] = sql(
    "SELECT slice_label, 'Topic ' || topic AS topic, string_agg(term, ', ' ORDER BY rank) AS top_keywords FROM terms GROUP BY slice_label, terms.topic", "terms"
)
ORACLE["s9_document_topics_csv"] = """SELECT '2024-0' || (label % 6 + 1) AS slice_label, vec_id AS doc_id, round(CAST(embedding[1] AS DOUBLE), 6) AS "Topic 0",
    round(CAST(embedding[2] AS DOUBLE), 6) AS "Topic 1", round(CAST(embedding[3] AS DOUBLE), 6) AS "Topic 2" FROM embeddings"""
ORACLE["p15_clean_pages"] = f"SELECT page_id, {_clean("url || ' ' || html")} AS text FROM pages"


# ---- properties of fitted models ----
# monthly documents without stopwords, their terms, and the 1000 most frequent terms of a slice (or of the corpus)
def _lda_terms(scope: str) -> str:
    return rf"""lt AS (SELECT {scope} AS scope, slice_label, doc_id, term, count(*) AS tf FROM (SELECT slice_label, doc_id,
        unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM unstopped) GROUP BY ALL),
    lv AS (SELECT scope, term FROM lt GROUP BY scope, term QUALIFY row_number() OVER (PARTITION BY scope ORDER BY sum(tf) DESC, term) <= 1000)"""


_TOPICS = "(SELECT unnest(range(10)) AS topic)"
ORACLE["m2_lda_timesliced"] = sql("", "unstopped") + f""", {_lda_terms("slice_label")}
    SELECT slice_label, topic, rank, 10 AS n_terms, true AS known, n_words, true AS improved
    FROM (SELECT slice_label, CAST(sum(tf) AS DOUBLE) AS n_words FROM lt JOIN lv USING (scope, term) GROUP BY slice_label),
    {_TOPICS}, (SELECT unnest(range(1, 11)) AS rank)"""
ORACLE["w3_lda_topic_strings"] = sql("", "unstopped") + f""", {_lda_terms("slice_label")}
    SELECT slice_label, 'Topic ' || topic AS topic, 10 AS n_words FROM (SELECT DISTINCT slice_label FROM lt), {_TOPICS}"""
ORACLE["m3_lda_mixture"] = sql("", "unstopped") + f""", {_lda_terms("slice_label")}
    SELECT doc_id, CAST(doc_id IN (SELECT doc_id FROM lt JOIN lv USING (scope, term)) AS DOUBLE) AS total, true AS shares,
    doc_id IN (SELECT doc_id FROM lt JOIN lv USING (scope, term)) AS uneven FROM monthly"""
ORACLE["m4_lda_corpus"] = sql("", "unstopped") + f""", {_lda_terms("'all'")}
    SELECT slice_label, 10 AS n_topics, round(avg(CAST(doc_id IN (SELECT doc_id FROM lt JOIN lv USING (scope, term)) AS DOUBLE)), 6) AS total
    FROM monthly GROUP BY slice_label"""
ORACLE["m5_embed_documents"] = sql("", "clean") + """, h AS (SELECT doc_id, md5(w) AS d FROM (
        SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM clean) WHERE w <> ''),
    s AS (SELECT doc_id, CAST('0x' || substr(d, 1, 2) AS INTEGER) % 32 AS "at",
        sum(CASE WHEN substr(d, 3, 1) IN ('0', '1', '2', '3', '4', '5', '6', '7') THEN 1e0 ELSE -1e0 END) AS v FROM h GROUP BY ALL),
    n AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM s GROUP BY doc_id)
    SELECT doc_id, "at", round(CASE WHEN n > 0 THEN coalesce(v, 0) / n ELSE 0 END, 4) AS value
    FROM (SELECT doc_id, unnest(range(32)) AS "at" FROM clean) LEFT JOIN s USING (doc_id, "at") LEFT JOIN n USING (doc_id)"""
_PAIRS = "(SELECT a, b FROM range({0}) x(a), range({0}) y(b) WHERE a < b)"
ORACLE["m6_reduce_dimensions"] = f"""SELECT a, b, (SELECT count(*) FROM embeddings) AS n, 0e0 AS mean, 0e0 AS covariance, true AS ordered, true AS spread
    FROM {_PAIRS.format(5)}"""
ORACLE["m13_layout_2d"] = f"""SELECT a, b, (SELECT count(*) FROM documents) AS n, 0e0 AS mean, 0e0 AS covariance, true AS ordered, true AS spread
    FROM {_PAIRS.format(2)}"""
ORACLE["m9_kmeans_topics"] = """WITH v AS (SELECT '2024-0' || (label % 6 + 1) AS slice_label, vec_id, unnest(embedding)::DOUBLE AS x,
        generate_subscripts(embedding, 1) AS "at" FROM embeddings),
    u AS (SELECT slice_label, "at", x / sqrt(sum(x * x) OVER (PARTITION BY slice_label, vec_id)) AS x FROM v),
    o AS (SELECT slice_label, sqrt(sum(s * s)) AS length FROM (SELECT slice_label, "at", sum(x) AS s FROM u GROUP BY ALL) GROUP BY slice_label),
    c AS (SELECT '2024-0' || (label % 6 + 1) AS slice_label, count(*) AS n FROM embeddings GROUP BY ALL)
    SELECT slice_label, n, true AS at_most_4, true AS ordered, round(n - length, 4) AS one, true AS tighter FROM c JOIN o USING (slice_label)"""
ORACLE["a7_tfidf_table_stopwords"] = _other(
    "SELECT slice_label, term, round(sum(weight), 6) AS score FROM weights2 GROUP BY ALL", "stopped", _ALL, "monthly", "tf",
    extra="""stop AS (SELECT term FROM tf GROUP BY term ORDER BY count(*) DESC, term LIMIT 20),
        stopped AS (SELECT m.doc_id, m.slice_label, coalesce(s.text, '') AS text FROM monthly m LEFT JOIN (
            SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM (
                SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM monthly)
            WHERE w <> '' AND w NOT IN (SELECT term FROM stop) GROUP BY doc_id) s USING (doc_id)), """,
)
ORACLE["t4_collected_records"] = sql(
    """SELECT id, start, "end" FROM (SELECT CAST(doc_id AS VARCHAR) AS id, published, start, "end" FROM docs
        JOIN weeks2024 ON published >= start AND published < "end" WHERE published < TIMESTAMP '2024-03-01' OR start >= TIMESTAMP '2024-03-01')
    QUALIFY row_number() OVER (PARTITION BY start ORDER BY published DESC, id) <= 100""", "weeks2024",
)
