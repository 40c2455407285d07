"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lattica.llm import url_index
from lattica.llm.common import LOWERED, UPPER


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWERED}')"


def words(text: str) -> str:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` as a list."""
    return rf"regexp_extract_all({lowered(f"coalesce({text}, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def contamination() -> str:
    """Windows as joined words, their occurrences, and the union of the words they cover."""
    return f"""WITH d AS (SELECT doc_id, {words('text')} AS w FROM documents), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {words('text')} AS w FROM benchmark),
    g AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(list_slice(w, k, k + least(len(w), 13) - 1), ' ') AS gram FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS k FROM i WHERE len(w) > 0)),
    s AS (SELECT DISTINCT size FROM g),
    h AS (SELECT DISTINCT doc_id, k, size, gram FROM (SELECT doc_id, k, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS gram FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, s WHERE len(w) >= size)) WHERE gram IN (SELECT gram FROM g)),
    c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM h) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_items, array_to_string(list_sort(list(item)), ',') AS items FROM (SELECT DISTINCT h.doc_id, g.item FROM h JOIN g ON h.size = g.size AND h.gram = g.gram) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
    coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""


def groups(width: int) -> str:
    """Shingle sets, links by counted intersections, and the least doc_id reachable."""
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, k, k + {width - 1}), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.v FROM r JOIN l ON r.b = l.u)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept FROM d LEFT JOIN n ON d.doc_id = n.doc_id
    JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = d.doc_id"""


def near_vectors() -> str:
    return """WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    f AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM f a JOIN f b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
    r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.v FROM r JOIN l ON r.b = l.u)
    SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.u = e.vec_id) AS n_links, m.component_id, e.vec_id = m.component_id AS kept FROM e JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = e.vec_id"""


def urls() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_index.BASE_RULES)
    sites = ", ".join(f"('{s}')" for s in url_index.BLOCKED_SITES)
    return f"""WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
    f AS (SELECT page_id, arg_max(r.h || r.p, len(r.h || r.p)) AS rule, arg_max(r.v, len(r.h || r.p)) AS v FROM h JOIN (VALUES {rules}) r(v, h, p) ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY page_id),
    b AS (SELECT DISTINCT page_id FROM h JOIN (VALUES {sites}) s(s) ON host = s.s OR ends_with(host, '.' || s.s))
    SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.v, CASE WHEN b.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict FROM h LEFT JOIN f ON h.page_id = f.page_id LEFT JOIN b ON h.page_id = b.page_id"""


def repeated_lines(least: int = 10) -> str:
    """Keys of lines with their least document; lines of other documents go."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM d),
    k AS (SELECT doc_id, place, line, {lowered(f"trim(line, {blanks})")} AS key FROM x),
    o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= {least} GROUP BY key),
    j AS (SELECT k.doc_id, place, line, coalesce(o.owner = k.doc_id, true) AS stays FROM k LEFT JOIN o ON k.key = o.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS kept_sha256 FROM j GROUP BY doc_id"""


def source_divergence(least: int = 10, top: int = 10) -> str:
    """Counts of kept terms for every group and term, and sums over all cells, zeros included."""
    p = lambda n, total: f"(1 + (CAST({n} AS HUGEINT) + 2) * 1000000000 // ({total} + 2 * v))"
    f = "CAST((p - q) * (p - q) // (p + q) AS BIGINT)"
    return rf"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= {least}),
    c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN t USING (lang, term) GROUP BY lang, source, term),
    v AS (SELECT lang, count(*) AS v FROM t GROUP BY lang),
    z AS (SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n FROM g JOIN t ON g.lang = t.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
    s AS (SELECT lang, source, term, n, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS lang_n, sum(n) OVER (PARTITION BY lang) AS lang_total FROM z),
    r AS (SELECT lang, source, term, n, {p('n', 'total')} AS p, {p('lang_n', 'lang_total')} AS q FROM s JOIN v USING (lang)),
    a AS (SELECT x.lang, x.source, y.source AS item, CAST(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS BIGINT) AS value FROM r x JOIN r y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
    pr AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
    tm AS (SELECT lang, source, 'term' AS part, term AS item, {f} AS value FROM r WHERE n > 0 AND p > q),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
    SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= {top}"""


SQL = {
    "op2_decontaminate": contamination(),
    "op5_minhash": groups(2),
    "op8_embeddings": near_vectors(),
    "op10_url_filter": urls(),
    "op11_line_dedup": repeated_lines(),
    "op13_source_divergence": source_divergence(),
}
