"""SQL over the same tables for the queries that SQL can express."""

from __future__ import annotations

from salesmart.llm import embeddings, ranked, spelling
from salesmart.llm.decontaminate import WINDOW
from salesmart.llm.mixing import MOST, SEED, WEIGHTS
from salesmart.llm.queries import MISSPELT
from salesmart.llm.warc import LEAST_BYTES

_ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)"""

# kind, pattern, and the part whose length is held against the least
_KINDS = [
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 0),
    ("hex", "[0-9a-f]{24,}", 0, 0),
    ("chat", "xox[abprs]-[0-9A-Za-z-]{10,}", 0, 0),
    ("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
]


def _secrets_sql() -> str:
    """Places of matches from the lengths of what lies between them."""
    parts = [
        f"""SELECT doc_id, {i} AS place, '{kind}' AS kind,
              unnest([list_sum([length(x) for x in p[1:k]]) + coalesce(list_sum([length(x) for x in m[1:k-1]]), 0) for k in range(1, len(m) + 1)])::BIGINT AS a,
              unnest([length(x) for x in m])::BIGINT AS n,
              unnest(v)::BIGINT AS part
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p,
                    [length(x) for x in regexp_extract_all(t, '{pattern}', {group})] AS v FROM d)
            WHERE len(m) > 0"""
        for i, (kind, pattern, group, _) in enumerate(_KINDS)
    ]
    least = " ".join(f"WHEN kind = '{kind}' THEN part >= {n}" for kind, _, _, n in _KINDS)
    span = "kind || ':' || a || ':' || (a + n)"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE CASE {least} END),
    spans AS (
      SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg({span}, ',' ORDER BY a, place) FILTER (place < 3) AS base, string_agg({span}, ',' ORDER BY a, place) AS spans
      FROM found GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
      coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN spans USING (doc_id)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"""


def contamination_sql(docs: str) -> str:
    return f"""
    WITH i AS ({words_sql("benchmark", "item_id")}),
    windows AS (
      SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), {WINDOW}) AS n, list_slice(w, k, k + least(len(w), {WINDOW}) - 1) AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS k FROM i WHERE len(w) > 0)),
    d AS ({words_sql(docs, "doc_id")}),
    grams AS (
      SELECT doc_id, n, k, list_slice(w, k, k + n - 1) AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    found AS (SELECT doc_id, item, k, n FROM grams JOIN windows USING (n, g)),
    hits AS (SELECT doc_id, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS q FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item)::BIGINT AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


def mix_sql(docs: str = "documents") -> str:
    """Sources stop in the order of limit to weight; the first that need not stop
    settles the share of all that follow."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
    WITH d AS (
      SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, text, ''))), 1, 3))::INTEGER AS step
      FROM {docs}),
    s AS (
      SELECT source, source_size, {weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w
      FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
    o AS (SELECT *, row_number() OVER (ORDER BY {MOST} * source_size / w, source NULLS LAST) AS k FROM s),
    c AS (
      SELECT *, sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS share,
        sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared_by FROM o),
    f AS (SELECT share::BIGINT AS share, shared_by::BIGINT AS shared_by FROM c WHERE w * share <= {MOST} * source_size * shared_by ORDER BY k LIMIT 1),
    t AS (SELECT source, source_size, least(w::BIGINT * share / shared_by::DOUBLE, ({MOST} * source_size)::DOUBLE) AS target FROM s, f),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
    m AS (SELECT *, floor(rate)::BIGINT AS whole, (rate - floor(rate)) * source_size AS more FROM r),
    h AS (SELECT source, step, sum(sum(size)) OVER (PARTITION BY source ORDER BY step) AS upto FROM d GROUP BY source, step),
    e AS (SELECT m.source, more, arg_min(step + 1, (abs(upto - more), step)) AS cut, min(abs(upto - more)) AS off
      FROM h JOIN m ON h.source IS NOT DISTINCT FROM m.source GROUP BY m.source, more),
    k AS (SELECT m.*, CASE WHEN off < e.more THEN cut ELSE 0 END AS cut FROM m JOIN e ON m.source IS NOT DISTINCT FROM e.source)
    SELECT d.*, source_size, target, whole + CASE WHEN step < cut THEN 1 ELSE 0 END AS copies
    FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source"""


def ranked_sql() -> str:
    terms = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH d AS (SELECT doc_id, {terms} AS w FROM documents),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
    s AS (SELECT count(*) FILTER (len(w) > 0) AS documents, sum(len(w))::BIGINT AS total FROM d),
    p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    f AS (SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS weight
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
    r AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
    WHERE rank <= {ranked.TOP}"""


def near_embeddings_sql() -> str:
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 THEN embedding::DOUBLE[] END AS e
      FROM embeddings),
    k AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0
        AND list_cosine_similarity(a.e, b.e) >= {embeddings.THRESHOLD}),
    r AS (SELECT vec_id, vec_id AS spot FROM v UNION SELECT r.vec_id, k.b FROM r JOIN k ON k.a = r.spot)
    SELECT v.vec_id, (SELECT count(*) FROM k WHERE k.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
    FROM v JOIN (SELECT vec_id, min(spot) AS component_id FROM r GROUP BY vec_id) AS c USING (vec_id)"""


def spelling_sql(every: int) -> str:
    """Checksums by a table of 256 entries; near words share what is left of them
    when a letter goes, at the same place if their lengths are equal."""
    letters = "[a-zA-Z\u00C0-\u00FF]"
    return f"""
    WITH RECURSIVE table_of AS (
      SELECT list(v ORDER BY i) AS entries FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
        FROM (SELECT unnest(range(256)) AS i))),
    runs AS (
      SELECT doc_id, run, count(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{letters}{{{spelling.LETTERS},}}')) AS run FROM documents)
      GROUP BY ALL),
    hashed AS (
      SELECT run, n, xor(4294967295, list_reduce([('0x' || h[2 * i + 1:2 * i + 2])::BIGINT for i in range(len(h) // 2)],
          lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295)) AS h
      FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS h FROM runs), table_of),
    w AS (
      SELECT word, sum(n)::BIGINT AS n
      FROM (SELECT n, CASE WHEN h % {every} = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word FROM hashed)
      WHERE len(word) >= {spelling.LETTERS} GROUP BY word HAVING sum(n) >= {spelling.OCCURRENCES}),
    less AS (SELECT DISTINCT word, spot, word[:spot] || word[spot + 2:] AS rest, len(word) AS letters, n
      FROM (SELECT word, n, unnest(range(len(word))) AS spot FROM w)),
    k AS (
      SELECT a.word AS a, b.word AS b, b.n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM less AS a JOIN w AS b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM less AS a JOIN w AS b ON a.rest = b.word),
    f AS (SELECT word, w.n, count(k.b) AS n_near, arg_min(k.b, (-k.n, k.b)) AS near, max(k.n) AS near_n FROM w LEFT JOIN k ON k.a = w.word GROUP BY ALL),
    g AS (SELECT word, n, n_near, CASE WHEN near_n >= {spelling.TIMES} * n THEN near END AS form, CASE WHEN near_n >= {spelling.TIMES} * n THEN near_n END AS form_n FROM f),
    chain AS (SELECT word, word AS spot FROM g UNION SELECT chain.word, g.form FROM chain JOIN g ON g.word = chain.spot WHERE g.form IS NOT NULL)
    SELECT g.word, g.form, chain.spot AS root, g.n, g.n_near, g.form_n
    FROM g JOIN chain USING (word) JOIN g AS last ON last.word = chain.spot AND last.form IS NULL"""


def archives_sql() -> str:
    """What each page's record says, from the pages themselves."""
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    s AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p),
    r AS (SELECT *, payload_bytes >= {LEAST_BYTES} AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM s)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN again THEN first END AS refers_to
    FROM r"""


ORACLE: dict[str, str] = {
    "op1_secrets": _secrets_sql(),
    "op2_warc": archives_sql(),
    "op7_decontaminate": contamination_sql("documents"),
    "op8_mix": f"SELECT doc_id, size, source_size, target, size * copies AS taken FROM ({mix_sql()})",
    "op11_ranked": ranked_sql(),
    "op12_embeddings": near_embeddings_sql(),
    "op13_spelling": spelling_sql(MISSPELT),
}
