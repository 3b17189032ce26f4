"""The same answers as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')"""


def near_duplicate_components(docs: str, size: int, percent: int) -> str:
    """WITH clauses ending in near(doc_id, n_shingles, component_id)."""
    shingle = f"array_to_string(w[i:i + {size - 1}], ' ')"
    return f"""
    w AS (SELECT doc_id, {_WORDS} AS w FROM {docs}),
    s AS (SELECT DISTINCT doc_id, {shingle} AS g FROM w, unnest(range(1, greatest(len(w) - {size - 2}, 2))) AS r(i)
          WHERE len(w) > 0),
    c AS (SELECT doc_id, count(*) AS n, hash(list(g ORDER BY g)) AS k FROM s GROUP BY doc_id),
    rep AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY k, n) AS rep FROM c),
    t AS (SELECT s.doc_id, s.g, n FROM s JOIN rep ON s.doc_id = rep.doc_id AND rep.rep = rep.doc_id),
    p AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
          FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
          AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent} GROUP BY ALL),
    l AS (SELECT u, v FROM p WHERE 100 * common >= {percent} * (na + nb - common)),
    e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
    reach(u, v) AS (SELECT rep, rep FROM rep WHERE rep = doc_id
                    UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u),
    m AS (SELECT u, min(v) AS v FROM reach GROUP BY u),
    near AS (SELECT w.doc_id, coalesce(rep.n, 0)::BIGINT AS n_shingles, coalesce(m.v, w.doc_id) AS component_id
             FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN m ON m.u = rep.rep)"""



def _unsigned(k: int) -> str:
    return f"('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"


#: Lines cut by hashes of the id, put in the order of the form.
FILL_MIDDLE = f"""WITH u AS (
    SELECT doc_id, coalesce(text, '') AS text, {', '.join(f'{_unsigned(k)} AS h{k + 1}' for k in range(4))},
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l FROM documents),
    c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS i,
                 greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS j,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                      OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, array_to_string(l[1:i], '') AS prefix, array_to_string(l[i + 1:j], '') AS middle,
                 array_to_string(l[j + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""



def _terms(rows: str) -> str:
    return rf"""regexp_extract_all(
    translate(coalesce({rows}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


RANKED_SEARCH = f"""WITH
    d AS (SELECT doc_id, unnest({_terms('text')}) AS term FROM documents WHERE doc_id IS NOT NULL),
    f AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
    s AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
    c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM s),
    i AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS term FROM benchmark WHERE item_id IS NOT NULL),
    w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
          FROM f, c WHERE term IN (SELECT term FROM i) GROUP BY term),
    x AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))
                 ::BIGINT AS score
          FROM i JOIN w USING (term) JOIN f USING (term) JOIN s USING (doc_id), c GROUP BY ALL),
    r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id,
                 score FROM x WHERE score > 0)
SELECT * FROM r WHERE rank <= 50"""


SQL: dict[str, str] = {
    "op12_ngram_join": f"""WITH RECURSIVE {near_duplicate_components('documents', 5, 80)}
SELECT doc_id, n_shingles, component_id FROM near""",
    "op13_ranked_search": RANKED_SEARCH,
    "op11_fill_middle": FILL_MIDDLE,
    "op8_near_duplicates": f"""WITH RECURSIVE {near_duplicate_components('documents', 2, 80)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near""",
}
