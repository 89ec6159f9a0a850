"""The same queries in SQL for DuckDB. Plain relational forms, independent of how the Spark side works."""

from __future__ import annotations

from quillrank.functions.stopwords import ENGLISH

_STOPWORDS = ", ".join(f"'{word}'" for word in ENGLISH)
_BREAK = "[^a-z0-9]+"
_INF = "CAST('-inf' AS DOUBLE)"

_ARTICLES = """
articles AS (
  SELECT doc_id, source,
         CASE WHEN len(ls) > 1 THEN regexp_replace(ls[1], '[^ -~]', '?', 'g') END AS title,
         CASE WHEN len(ls) > 1 THEN ls[2:] ELSE ls END AS body
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents)
),
items AS (
  SELECT doc_id, idx, content,
         CASE WHEN content LIKE '%.' THEN
           CASE WHEN contains(content, ',') THEN 'PARAGRAPH' ELSE 'paragraph' END END AS subtype
  FROM (SELECT doc_id, unnest(body) AS content, generate_subscripts(body, 1) AS idx FROM articles)
),
paragraphs AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS INTEGER) AS pos, subtype, content
  FROM items WHERE lower(subtype) = 'paragraph'
  QUALIFY pos < 5
)"""

_ASKED = """
asked AS (
  SELECT item_id AS query_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS query FROM benchmark
)"""


def _pieces(source: str, keys: str, text: str) -> str:
    """Tokens before filters, with their index."""
    array = f"string_split_regex(lower(coalesce({text}, '')), '{_BREAK}')"
    return f"SELECT {keys}, unnest({array}) AS token, generate_subscripts({array}, 1) AS idx FROM {source}"


def _keep(stopwords: bool) -> str:
    return f"token <> '' AND token NOT IN ({_STOPWORDS})" if stopwords else "token <> ''"


def _tokens(stopwords: bool = True) -> str:
    return f"""
tokens AS (
  SELECT doc_id, part, pos, idx, token FROM (
    {_pieces("articles", "doc_id, 0 AS part, 0 AS pos", "title")}
    UNION ALL
    {_pieces("paragraphs", "doc_id, 1 AS part, pos", "content")}
  ) WHERE {_keep(stopwords)}
),
docs AS (
  SELECT a.doc_id, a.title, CAST(count(t.token) AS INTEGER) AS doc_len
  FROM articles a LEFT JOIN tokens t ON t.doc_id = a.doc_id GROUP BY a.doc_id, a.title
)"""


def _asked_tokens(stopwords: bool = True) -> str:
    return f"""
asked_tokens AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY idx) - 1 AS INTEGER) AS pos, token AS term
  FROM ({_pieces("asked", "query_id", "query")}) WHERE {_keep(stopwords)}
)"""


def _shape(word: str) -> str:
    """c and v for the letters of a word, one after the other: a y is a vowel where a consonant stands before it."""
    letter = "CASE WHEN contains('aeiou', c) THEN 'v' WHEN c = 'y' AND right(a, 1) = 'c' THEN 'v' ELSE 'c' END"
    return f"CASE WHEN {word} = '' THEN '' ELSE list_reduce(string_split({word}, ''), lambda a, c: a || {letter}, '') END"


_MEASURE = "((length(shape) - length(replace(shape, 'vc', ''))) // 2)"
_CVC = "(shape LIKE '%cvc' AND right(stem, 1) NOT IN ('w', 'x', 'y'))"
_DOUBLED = """(length(stem) > 1 AND right(stem, 1) = substr(stem, length(stem) - 1, 1) AND right(shape, 1) = 'c'
      AND right(stem, 1) NOT IN ('l', 's', 'z'))"""


def _porter(words: str, name: str) -> str:
    """CTEs up to ``name`` (word, stem) for the words of a query, after Porter's paper and his two later changes."""
    chain = [f"{name}_0 AS (SELECT DISTINCT word, word AS w FROM ({words}))"]

    def step(suffixes: list[str], result: str) -> None:
        before, at = f"{name}_{len(chain) - 1}", f"{name}_{len(chain)}"
        longest = sorted(suffixes, key=len, reverse=True)
        which = " ".join(f"WHEN ends_with(w, '{x}') THEN '{x}'" for x in longest)
        chain.append(f"""{at} AS (
  SELECT word, {result} AS w FROM (
    SELECT *, {_shape('stem')} AS shape FROM (
      SELECT *, left(w, length(w) - length(suffix)) AS stem FROM (
        SELECT *, {f"CASE {which} ELSE '' END" if suffixes else "''"} AS suffix FROM {before})))
)""")

    def table(rules: str) -> tuple[list[str], str]:
        pairs = [rule.split(">") for rule in rules.split()]
        return [x for x, _ in pairs], " ".join(f"WHEN '{x}' THEN '{y}'" for x, y in pairs)

    step(["sses", "ies", "ss", "s"], """CASE suffix WHEN 'sses' THEN stem || 'ss' WHEN 'ies' THEN stem || 'i'
    WHEN 's' THEN stem ELSE w END""")
    step(["eed", "ed", "ing"], f"""CASE WHEN suffix = 'eed' THEN CASE WHEN {_MEASURE} > 0 THEN stem || 'ee' ELSE w END
    WHEN suffix <> '' AND contains(shape, 'v') THEN
      CASE WHEN right(stem, 2) IN ('at', 'bl', 'iz') THEN stem || 'e' WHEN {_DOUBLED} THEN left(stem, length(stem) - 1)
      WHEN {_MEASURE} = 1 AND {_CVC} THEN stem || 'e' ELSE stem END
    ELSE w END""")
    step(["y"], "CASE WHEN suffix = 'y' AND contains(shape, 'v') THEN stem || 'i' ELSE w END")
    for rules in (
        "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize ation>ate"
        " ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log",
        "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>",
    ):
        suffixes, new = table(rules)
        step(suffixes, f"CASE WHEN suffix <> '' AND {_MEASURE} > 0 THEN stem || CASE suffix {new} END ELSE w END")
    step(
        "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(),
        f"CASE WHEN suffix <> '' AND {_MEASURE} > 1 AND (suffix <> 'ion' OR right(stem, 1) IN ('s', 't')) THEN stem ELSE w END",
    )
    step(["e"], f"CASE WHEN suffix = 'e' AND ({_MEASURE} > 1 OR ({_MEASURE} = 1 AND NOT {_CVC})) THEN stem ELSE w END")
    step([], f"CASE WHEN ends_with(w, 'll') AND {_MEASURE} > 1 THEN left(w, length(w) - 1) ELSE w END")
    last = f"{name}_{len(chain) - 1}"
    chain.append(f"{name} AS (SELECT word, CASE WHEN length(word) <= 2 THEN word ELSE w END AS stem FROM {last})")
    return ",\n".join(chain)


def _stems() -> str:
    """``stems`` (word, stem) of tokens and query tokens, ``stems2`` of the stems once more."""
    return f"""
{_porter("SELECT token AS word FROM tokens UNION ALL SELECT term FROM asked_tokens", "stems")},
{_porter("SELECT stem AS word FROM stems", "stems2")}"""


def _terms(stopwords: bool = True, stem: bool = False) -> str:
    source = "asked_tokens"
    if stem:
        source = "(SELECT query_id, pos, stem AS term FROM asked_tokens a JOIN stems s ON s.word = a.term)"
    return f"""
terms AS (
  SELECT query_id, pos, term, CAST(count(*) OVER (PARTITION BY query_id) AS INTEGER) AS n_terms FROM {source}
)"""


_PLAIN_HITS = "hits AS (SELECT doc_id, token AS term FROM tokens)"
_STEMMED_HITS = "hits AS (SELECT t.doc_id, s.stem AS term FROM tokens t JOIN stems s ON s.word = t.token)"
_TWICE_STEMMED_HITS = f"""hits AS (
  SELECT t.doc_id, CASE WHEN t.part = 0 THEN s.stem ELSE z.stem END AS term
  FROM tokens t JOIN stems s ON s.word = t.token JOIN stems2 z ON z.word = s.stem
  WHERE t.part = 0 OR s.stem NOT IN ({_STOPWORDS})
)"""


def _scores(ratio: str = "real", stopwords: bool = True, passes: int = 0) -> str:
    rarity = "s.n_docs / c.cf" if ratio == "real" else "floor(s.n_docs / c.cf)"
    hits = (_PLAIN_HITS, _STEMMED_HITS, _TWICE_STEMMED_HITS)[passes]
    return f"""{_ARTICLES}, {_ASKED}, {_tokens(stopwords)}, {_asked_tokens(stopwords)}, {_stems() + "," if passes else ""}
{_terms(stopwords, passes > 0)}, {hits},
stats AS (SELECT count(*) AS n_docs, sum(doc_len) / count(*) AS avg_len FROM docs WHERE doc_len > 0),
postings AS (
  SELECT t.doc_id, d.doc_len, t.term, count(*) AS tf
  FROM hits t JOIN docs d ON d.doc_id = t.doc_id
  WHERE t.term IN (SELECT term FROM terms) GROUP BY t.doc_id, d.doc_len, t.term
),
cfs AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM postings GROUP BY term),
term_scores AS (
  SELECT q.query_id, p.doc_id, p.doc_len, p.term, p.tf, c.cf, q.weight, q.n_terms,
    CASE WHEN p.tf >= p.doc_len THEN 0.0
    ELSE (1 - p.tf / p.doc_len) * (1 - p.tf / p.doc_len) / (p.tf + 1) * (
      p.tf * (CASE WHEN {rarity} > 0 THEN log2(p.tf * s.avg_len / p.doc_len * {rarity}) ELSE {_INF} END)
      + 0.5 * log2(2 * pi() * p.tf * (1 - p.tf / p.doc_len))) END AS term_score
  FROM postings p JOIN cfs c ON c.term = p.term
  JOIN (SELECT query_id, term, count(*) AS weight, max(n_terms) AS n_terms FROM terms GROUP BY query_id, term) q
    ON q.term = p.term
  CROSS JOIN stats s
),
matched AS (
  SELECT query_id, doc_id, round(sum(weight * term_score) / max(n_terms), 10) + 0.0 AS score
  FROM term_scores GROUP BY query_id, doc_id
)"""


def _ranked(ratio: str = "real", stopwords: bool = True, unmatched: bool = False, passes: int = 0) -> str:
    rows = "SELECT query_id, doc_id, score FROM matched"
    if unmatched:
        rows = """
  SELECT a.query_id, d.doc_id, coalesce(m.score, 0.0) AS score
  FROM asked a CROSS JOIN (SELECT doc_id FROM docs WHERE doc_len > 0) d
  LEFT JOIN matched m ON m.query_id = a.query_id AND m.doc_id = d.doc_id"""
    return f"""{_scores(ratio, stopwords, passes)},
ranked AS (
  SELECT r.query_id, r.doc_id, r.score, d.title,
         CAST(row_number() OVER (PARTITION BY r.query_id ORDER BY r.score DESC, r.doc_id) AS INTEGER) AS position
  FROM ({rows}) r JOIN docs d ON d.doc_id = r.doc_id
)"""


def _selected(**how) -> str:
    """Greedy walk down every ranking, one step per recursion."""
    return f"""WITH RECURSIVE {_ranked(**how)},
walk AS (
  SELECT DISTINCT query_id, 0 AS position, CAST([] AS VARCHAR[]) AS titles, CAST([] AS INTEGER[]) AS kept FROM ranked
  UNION ALL
  SELECT query_id, position,
         CASE WHEN alike THEN titles ELSE list_append(titles, title) END,
         CASE WHEN alike THEN kept ELSE list_append(kept, position) END
  FROM (
    SELECT w.query_id, r.position, w.titles, w.kept, r.title,
           r.title IS NOT NULL AND len(list_filter(w.titles, lambda t: t IS NOT NULL
             AND levenshtein(t, r.title) < 0.5 * greatest(length(t), length(r.title)))) > 0 AS alike
    FROM walk w JOIN ranked r ON r.query_id = w.query_id AND r.position = w.position + 1
    WHERE len(w.kept) < 10
  )
),
last AS (SELECT query_id, arg_max(kept, position) AS kept FROM walk GROUP BY query_id),
selected AS (
  SELECT k.query_id, a.query, k.rank, r.doc_id, r.score, r.title
  FROM (SELECT query_id, unnest(kept) AS position, CAST(generate_subscripts(kept, 1) AS INTEGER) AS rank FROM last) k
  JOIN ranked r ON r.query_id = k.query_id AND r.position = k.position
  JOIN asked a ON a.query_id = k.query_id
)"""


_RANKING = "SELECT query_id, query, rank, doc_id, round(score, 6) + 0.0 AS score, title FROM selected"
_TOP10 = "SELECT query_id, position, doc_id, round(score, 6) + 0.0 AS score, title FROM ranked WHERE position <= 10"
_REPORT = """
SELECT query_id, 0 AS line_no, query AS line FROM selected WHERE rank = 1
UNION ALL
SELECT query_id, rank, concat('  ', rank, ':', doc_id, ' ', round(score, 6) + 0.0, ' ', coalesce(title, 'null')) FROM selected"""

_FLAT_ARTICLE = f"""WITH {_ARTICLES}
SELECT doc_id, concat('https://example.org/', doc_id) AS article_url, title, CAST(NULL AS VARCHAR) AS author,
       1577836800000 + doc_id * 60000 AS published_date, CAST(len(body) AS INTEGER) AS n_contents,
       array_to_string(body, chr(10)) AS body, subtypes, source
FROM articles JOIN (
  SELECT doc_id, string_agg(coalesce(subtype, '-'), ' ' ORDER BY idx) AS subtypes FROM items GROUP BY doc_id
) USING (doc_id)"""


def _text_tokens(where: str) -> str:
    return f"""
SELECT d.doc_id, CAST(count(t.token) AS INTEGER) AS n_tokens, coalesce(string_agg(t.token, ' ' ORDER BY t.idx), '') AS tokens
FROM documents d LEFT JOIN (
  SELECT doc_id, token, idx FROM ({_pieces("documents", "doc_id", "text")}) WHERE {where}
) t ON t.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLE: dict[str, str] = {
    "queries_scan": f"""WITH {_ASKED}
SELECT DISTINCT CAST('0x' || substr(md5(query), 1, 15) AS BIGINT) AS query_id, query FROM asked""",
    "articles_scan": _FLAT_ARTICLE,
    "json_decode": _FLAT_ARTICLE,
    "article_rejects": """SELECT unnest(string_split(text, chr(10))) AS value, 'not an article' AS reason FROM documents
UNION ALL SELECT '{"id":"' || doc_id || '","title":{"a":1}}', 'title' FROM documents
UNION ALL SELECT '{"id":"' || doc_id || '","published_date":"soon"}', 'published_date' FROM documents
UNION ALL SELECT '{"id":"' || doc_id || '","contents":[{"content":[]}]}', 'contents.content' FROM documents""",
    "tokenize": _text_tokens(_keep(False)),
    # RE2 has no back references: four equal characters in a row are spelled out.
    "tokenize_limits": _text_tokens(
        "token <> '' AND length(token) <= 20 AND len(regexp_extract_all(token, '[0-9]')) <= 4 AND NOT regexp_matches(token, '"
        + "|".join(c * 4 for c in "abcdefghijklmnopqrstuvwxyz0123456789")
        + "')"
    ),
    "stopword_filter": _text_tokens(_keep(True)),
    "query_terms": f"WITH {_ASKED}, {_asked_tokens()}, {_terms()} SELECT query_id, pos, term, n_terms FROM terms",
    "query_terms_stemmed": f"""WITH {_ASKED}, {_asked_tokens()}, {_porter("SELECT term AS word FROM asked_tokens", "stems")},
{_terms(stem=True)} SELECT query_id, pos, term, n_terms FROM terms""",
    "analyzed_terms_stemmed": f"""WITH {_ARTICLES}, {_tokens()}, {_porter("SELECT token AS word FROM tokens", "stems")}
SELECT a.doc_id,
       coalesce(string_agg(stem, ' ' ORDER BY pos, idx) FILTER (part = 0), '') AS title_terms,
       coalesce(string_agg(stem, ' ' ORDER BY pos, idx) FILTER (part = 1), '') AS body_terms
FROM articles a LEFT JOIN (SELECT * FROM tokens t JOIN stems s ON s.word = t.token) t ON t.doc_id = a.doc_id GROUP BY a.doc_id""",
    "stem_vocabulary": f"""WITH {_ARTICLES}, {_ASKED}, {_tokens()}, {_asked_tokens()}, {_stems()}
SELECT s.word AS token, s.stem AS stem1, CASE WHEN s.stem NOT IN ({_STOPWORDS}) THEN z.stem END AS stem2
FROM stems s JOIN stems2 z ON z.word = s.stem WHERE s.word IN (SELECT token FROM tokens)""",
    "analyzed_terms": f"""WITH {_ARTICLES}, {_tokens()}
SELECT a.doc_id,
       coalesce(string_agg(token, ' ' ORDER BY pos, idx) FILTER (part = 0), '') AS title_terms,
       coalesce(string_agg(token, ' ' ORDER BY pos, idx) FILTER (part = 1), '') AS body_terms
FROM articles a LEFT JOIN tokens t ON t.doc_id = a.doc_id GROUP BY a.doc_id""",
    "first_paragraphs": f"WITH {_ARTICLES} SELECT doc_id, pos, subtype, content FROM paragraphs",
    "analyzed_contents": f"""WITH {_ARTICLES}, {_tokens()}
SELECT p.doc_id, p.pos, p.content, coalesce(string_agg(token, ' ' ORDER BY idx), '') AS tokens
FROM paragraphs p LEFT JOIN tokens t ON t.doc_id = p.doc_id AND t.pos = p.pos AND t.part = 1
GROUP BY p.doc_id, p.pos, p.content""",
    "doc_length": f"WITH {_ARTICLES}, {_tokens()} SELECT doc_id, doc_len FROM docs",
    "non_empty_docs": f"WITH {_ARTICLES}, {_tokens()} SELECT doc_id, title, doc_len FROM docs WHERE doc_len > 0",
    "corpus_stats": f"""WITH {_ARTICLES}, {_tokens()}
SELECT count(*) AS n_docs, CAST(sum(doc_len) AS BIGINT) AS total_len, round(sum(doc_len) / count(*), 6) AS avg_len
FROM docs WHERE doc_len > 0""",
    "term_frequencies": f"WITH {_scores()} SELECT doc_id, doc_len, term, tf FROM postings",
    "collection_tf": f"WITH {_scores()} SELECT term, cf FROM cfs",
    "doc_query_pairs": f"""WITH {_scores()}
SELECT query_id, doc_id, doc_len, count(*) AS n_matched, CAST(sum(tf) AS BIGINT) AS total_tf
FROM term_scores GROUP BY query_id, doc_id, doc_len""",
    "dph_term_scores": f"""WITH {_scores()}
SELECT query_id, doc_id, term, tf, cf, round(term_score, 6) + 0.0 AS term_score FROM term_scores""",
    "dph_scores": f"WITH {_scores()} SELECT query_id, doc_id, round(score, 6) + 0.0 AS score FROM matched",
    "dph_scores_integer_ratio": f"WITH {_scores('integer')} SELECT query_id, doc_id, round(score, 6) + 0.0 AS score FROM matched",
    "ranked_all": f"WITH {_ranked()} SELECT query_id, doc_id, round(score, 6) + 0.0 AS score, position FROM ranked",
    "top10_raw": f"WITH {_ranked()} {_TOP10}",
    "title_distances": f"""WITH {_ARTICLES}
SELECT doc_id, CAST(idx - 1 AS INTEGER) AS pos,
       round(levenshtein(title, plain) / nullif(greatest(length(title), length(plain)), 0), 6) AS distance
FROM (SELECT doc_id, title, idx, regexp_replace(content, '[^ -~]', '?', 'g') AS plain
      FROM items JOIN articles USING (doc_id))""",
    "title_pairs": f"""WITH {_ranked()}, top AS ({_TOP10})
SELECT a.query_id, a.doc_id, b.doc_id AS other_id, a.title, b.title AS other_title
FROM top a JOIN top b ON a.query_id = b.query_id AND a.position < b.position
WHERE levenshtein(a.title, b.title) < 0.5 * greatest(length(a.title), length(b.title))""",
    "dedup_titles": f"{_selected()} SELECT query_id, rank - 1 AS pos, doc_id, title FROM selected",
    "ranked_top10": f"{_selected()} {_RANKING}",
    "ranked_top10_stemmed": f"{_selected(passes=1)} {_RANKING}",
    "ranked_top10_body_passes2": f"{_selected(passes=2)} {_RANKING}",
    "ranked_top10_integer_ratio": f"{_selected(ratio='integer')} {_RANKING}",
    "ranked_include_unmatched": f"{_selected(unmatched=True)} {_RANKING}",
    "ranked_include_unmatched_integer_ratio": f"{_selected(unmatched=True, ratio='integer')} {_RANKING}",
    "ranked_without_stopword_list": f"{_selected(unmatched=True, ratio='integer', stopwords=False)} {_RANKING}",
    "ranking_nested": f"""{_selected()}
SELECT query_id, CAST(count(*) AS INTEGER) AS n_results,
       string_agg(concat(rank, ':', doc_id), ' ' ORDER BY rank) AS results
FROM selected GROUP BY query_id""",
    "ranking_report": f"{_selected()} {_REPORT}",
    "report_files": f"{_selected()} {_REPORT}",
    "report_packed": f"""{_selected()}
SELECT query_id, translate(any_value(query), ' ', '_') AS file_name, string_agg(line, chr(10) ORDER BY line_no) AS report
FROM ({_REPORT}) JOIN (SELECT DISTINCT query_id, query FROM selected) USING (query_id) GROUP BY query_id""",
    "ranking_file_name": f"WITH {_ASKED} SELECT query_id, translate(query, ' ', '_') AS file_name FROM asked",
}

ORACLE["stem_vocabulary_kept"] = ORACLE["stem_vocabulary"]
ORACLE["stopword_filter_table"] = ORACLE["stopword_filter"]
