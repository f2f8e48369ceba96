"""Queries of the document operators over the test tables, each with SQL of the same result where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import documents as D
from folioforge.operators import enrich as E
from folioforge.operators import maintain as M
from folioforge.operators import resolve as R
from folioforge.operators import sequence as S
from folioforge.plans import pipelines as P
from folioforge.plans import sql_parts as Q
from folioforge.session import shared_folder, table
from folioforge.sources import bundles as B
from folioforge.streaming import watch as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_WS, _STRIP = Q.WS, Q.strip
_CAPTION = r"^(?i)fig(?:ure)?\.?\s*\d+\s*[:.\-—–]\s*."
_JUNK = r"^(?i)(?:open\s+access|copyright|citation|reviewed\s+by\b|edited\s+by\b|\*?correspondence\b|received\s+\d|accepted\s+\d|published\s+\d|handling\s+editor\b|associate\s+editor\b|type\s)"


def _blocks(spark, d):
    return table(spark, d, "blocks")


def _papers(spark, d):
    return table(spark, d, "papers")


# --- text ------------------------------------------------------------------------------------------------------------------

_LIGATURES = "replace(replace(replace(replace(replace(replace(replace(t, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬅ', 'st'), 'ﬆ', 'st')"


@query(f"""
WITH a AS (SELECT block_id, text || ' of' || chr(64257) || 'ce  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'M E T H O D S' AS t FROM blocks),
b AS (SELECT block_id, {_LIGATURES} AS t FROM a),
c AS (SELECT block_id, list_reduce(list_prepend(t, regexp_extract_all(t, '(?:^|[^A-Za-z])([A-Za-z](?:{_WS}[A-Za-z]){{3,}})(?:$|[^A-Za-z])', 1)), lambda x, r: replace(x, r, replace(r, ' ', ''))) AS t FROM b),
d AS (SELECT block_id, regexp_replace(regexp_replace(replace(t, chr(160), ' '), '[\\x{{ad}}\\x{{feff}}\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM c)
SELECT block_id, {_STRIP("array_to_string(list_transform(string_split(t, chr(10)), lambda l: regexp_replace(l, '" + _WS + "+$', '')), chr(10))")} AS clean FROM d WHERE t IS NOT NULL
""")
def q_clean_text(spark, d):
    injected = F.concat("text", F.lit(" ofﬁce  \n\n\n\nM E T H O D S"))
    return _blocks(spark, d).filter("text is not null").select("block_id", T.clean(injected).alias("clean"))


@query()
def q_clean_full(spark, d):
    return D.clean(_blocks(spark, d).select("block_id", "text"))


@query("SELECT bundle_id, nfc_normalize(title) AS title FROM papers WHERE title IS NOT NULL")
def q_nfc(spark, d):
    return _papers(spark, d).filter("title is not null").select("bundle_id", T.nfc("title").alias("title"))


@query()
def q_mojibake(spark, d):
    return _papers(spark, d).filter(F.octet_length("title") > F.length("title")).select("bundle_id", T.compose("title").alias("title"))


# Words of two and more letters are set off, so that runs of single letters need no look-behind.
_LONE_RUN = f"[A-Za-z](?:{_WS}[A-Za-z]){{3,}}"


@query(f"""
WITH a AS (SELECT doc_id, regexp_replace(text || ' A; M E T H O D S; and a b c', '([A-Za-z]{{2,}})', chr(64976) || '\\1' || chr(64977), 'g') AS t FROM documents),
b AS (SELECT doc_id, string_split_regex(t, '{_LONE_RUN}') AS gaps, regexp_extract_all(t, '{_LONE_RUN}') AS runs FROM a)
SELECT doc_id, translate(array_to_string(list_transform(gaps, lambda g, i: g || coalesce(replace(runs[i], ' ', ''), '')), ''), chr(64976) || chr(64977), '') AS joined FROM b
""")
def q_spaced_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.join_spaced_letters(F.concat("text", F.lit(" A; M E T H O D S; and a b c"))).alias("joined"))


@query(f"""
SELECT doc_id, (i - 1)::INT AS chunk_no, {_STRIP("p")} AS chunk FROM (SELECT doc_id, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM (SELECT doc_id, string_split_regex(text, '\\n{{2,}}') AS parts FROM documents WHERE text IS NOT NULL)) WHERE {_STRIP("p")} <> ''
""")
def q_raw_chunks(spark, d):
    return D.paragraphs(table(spark, d, "documents").select("doc_id", "text"))


_IMG = r"^!\[([^\]]*)\]\([^)]+\)"
_HEAD = r"^#{1,6}" + _WS + r"+(.+)"


@query(f"""
WITH c AS (SELECT block_id, {_STRIP("text")} AS t FROM blocks WHERE text IS NOT NULL),
l AS (SELECT *, string_split(t, chr(10)) AS ls, string_split(t, chr(10))[1] AS f, trim(trim(trim(t, '$'), ' '), '$') AS m FROM c WHERE t <> ''),
k AS (SELECT *, CASE WHEN regexp_matches(f, '{_HEAD}') THEN 'section_header'
  WHEN regexp_matches(f, '{_IMG}') AND len(ls) <= 2 THEN 'figure'
  WHEN len(ls) >= 2 AND len(list_filter(ls, lambda x: NOT starts_with(x, '|'))) = 0 THEN 'table'
  WHEN regexp_matches(t, '^\\$\\$(?s:.)+\\$\\$$') THEN CASE WHEN length(m) < 40 THEN 'skip' ELSE 'equation' END
  WHEN regexp_matches(t, '^\\$[^$]+\\$$') AND length(t) < 80 THEN 'skip'
  WHEN len(list_filter(list_filter(ls, lambda x: {_STRIP("x")} <> ''), lambda x: NOT regexp_matches(x, '^[-*]{_WS}+'))) = 0 THEN 'list'
  ELSE 'text' END AS type FROM l)
SELECT block_id, type, CASE type WHEN 'section_header' THEN {_STRIP(f"regexp_extract(f, '{_HEAD}', 1)")} WHEN 'figure' THEN regexp_extract(f, '{_IMG}', 1) ELSE t END AS chunk FROM k
""")
def q_classify(spark, d):
    chunk = _blocks(spark, d).select("block_id", T.strip(F.col("text")).alias("t")).filter("t <> ''")
    return chunk.select("block_id", T.classify(F.col("t")).alias("c")).select("block_id", "c.type", F.col("c.text").alias("chunk"))


@query(f"SELECT block_id, {_STRIP(chr(39).join(['regexp_replace(text, ', '\\[([^\\]]+)\\]\\([^)]+\\)', ', ', '\\1', ', ', 'g', ')']))} AS text FROM blocks WHERE type = 'section_header' AND text IS NOT NULL")
def q_strip_links(spark, d):
    return _blocks(spark, d).filter("type = 'section_header' and text is not null").select("block_id", T.strip_links(F.col("text")).alias("text"))


@query("SELECT block_id, array_to_string(regexp_extract_all(text || ' ![one](a/' || block_id || '.png) and ![](b.jpg)', '!\\[([^\\]]*)\\]\\(([^)]+)\\)', 2), ';') AS refs FROM blocks WHERE text IS NOT NULL")
def q_image_refs(spark, d):
    injected = F.concat("text", F.lit(" ![one](a/"), F.col("block_id").cast("string"), F.lit(".png) and ![](b.jpg)"))
    return _blocks(spark, d).filter("text is not null").select("block_id", F.array_join(T.image_refs(injected), ";").alias("refs"))


@query(f"""
SELECT block_id, (CASE WHEN contains(text, chr(10)) OR length(text) > 120 OR length(text) < 3 THEN false
 WHEN text = upper(text) AND length(text) > 5 AND NOT ends_with(text, '.') THEN true
 ELSE regexp_matches(text, '^\\p{{Nd}}+[.\\p{{Nd}}]*(\\.|{_WS}){_WS}*[A-Z]') AND NOT ends_with(text, '.') END)::BOOLEAN AS heading
FROM blocks WHERE text IS NOT NULL
""")
def q_headings(spark, d):
    return _blocks(spark, d).filter("text is not null").select("block_id", T.is_heading(F.col("text")).alias("heading"))


@query("""
SELECT bundle_id, CASE WHEN arxiv_id <> '' THEN 'arxiv:' || arxiv_id WHEN doi <> '' THEN 'doi:' || doi ELSE 'sha256:' || substr(pdf_hash, 1, 12) END AS id FROM papers
WHERE coalesce(arxiv_id, '') <> '' OR coalesce(doi, '') <> '' OR coalesce(pdf_hash, '') <> ''
""")
def q_paper_ids(spark, d):
    p = _papers(spark, d).filter("coalesce(arxiv_id, '') <> '' or coalesce(doi, '') <> '' or coalesce(pdf_hash, '') <> ''")
    return p.select("bundle_id", T.paper_id(F.col("doi"), F.col("arxiv_id"), F.col("pdf_hash")).alias("id"))


@query(f"""
SELECT bundle_id, {Q.slug("ns", "year", "title")} AS slug FROM (SELECT *, list_transform(authors, lambda a: a.name) AS ns FROM papers)
""")
def q_slugs(spark, d):
    return _papers(spark, d).select("bundle_id", T.slug("authors.name", "year", "title").alias("slug"))


@query(r"""
WITH a AS (SELECT bundle_id, '  DOI:' || upper(doi) || '  ' AS raw, 'see doi:' || doi || ', and so on' AS tag FROM papers WHERE doi <> '')
SELECT bundle_id, regexp_replace(lower(trim(raw)), '^doi:', '') AS normal, regexp_matches(regexp_replace(lower(trim(raw)), '^doi:', ''), '^10\.\d{4,}/[^\s<>"}]+$') AS valid,
 regexp_matches(raw, '^10\.\d{4,}/[^\s<>"}]+$') AS raw_valid, regexp_extract(tag, '(?i)(?:doi:)?(10\.\d{4,}/[^\s<>"},]+)', 1) AS found FROM a
""")
def q_dois(spark, d):
    a = _papers(spark, d).filter("doi <> ''").select("bundle_id", F.concat(F.lit("  DOI:"), F.upper("doi"), F.lit("  ")).alias("raw"), F.concat(F.lit("see doi:"), "doi", F.lit(", and so on")).alias("tag"))
    normal = T.normal_doi(F.col("raw"))
    return a.select("bundle_id", normal.alias("normal"), T.valid_doi(normal).alias("valid"), T.valid_doi(F.col("raw")).alias("raw_valid"), T.doi_in(F.col("tag")).alias("found"))


@query(rf"""
WITH a AS (SELECT bundle_id, len(regexp_extract_all(title, '\p{{L}}')) AS letters, len(regexp_extract_all({Q.plain("title")}, '[A-Za-z]')) AS latin FROM papers WHERE title IS NOT NULL)
SELECT bundle_id, round(coalesce(latin::DOUBLE / nullif(letters, 0), -1), 6) AS share, coalesce(latin::DOUBLE / nullif(letters, 0) < 0.5, false) AS non_latin FROM a
""")
def q_latin_share(spark, d):
    c = F.col("title")
    return _papers(spark, d).filter("title is not null").select("bundle_id", F.round(F.coalesce(T.latin_share(c), F.lit(-1.0)), 6).alias("share"), T.is_non_latin(c).alias("non_latin"))


@query("""
SELECT doc_id, '<document>' || chr(10) || replace(replace(text || '</document> x <DOCUMENT> <document>', '<document>', '<document_lit>'), '</document>', '</document_lit>') || chr(10) || '</document>' AS wrapped FROM documents
""")
def q_wrap_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.wrap_untrusted(F.concat("text", F.lit("</document> x <DOCUMENT> <document>"))).alias("wrapped"))


@query("""
WITH a AS (SELECT block_id, 'CANARY-' || upper(substr(sha256(node_id), 1, 8)) AS token, node_id FROM blocks),
b AS (SELECT *, CASE WHEN block_id % 3 = 0 THEN 'said ' || token || ' aloud' ELSE 'said nothing' END AS response FROM a)
SELECT block_id, token, contains(response, token) AS leaked, trim(replace(response, token, '')) AS kept FROM b
""")
def q_canary(spark, d):
    token = T.canary(F.col("node_id"))
    a = _blocks(spark, d).select("block_id", token.alias("token"))
    b = a.withColumn("response", F.when(F.col("block_id") % 3 == 0, F.concat(F.lit("said "), "token", F.lit(" aloud"))).otherwise("said nothing"))
    return b.select("block_id", "token", T.canary_leaked(F.col("token"), F.col("response")).alias("leaked"), T.canary_removed(F.col("token"), F.col("response")).alias("kept"))


@query(f"SELECT block_id, CASE WHEN length(w) >= 2 THEN w END AS keyword FROM (SELECT block_id, regexp_replace(lower({_STRIP('section_path[1]')}), '[^a-z]', '', 'g') AS w FROM blocks WHERE len(section_path) > 0)")
def q_keywords_clean(spark, d):
    return _blocks(spark, d).filter("size(section_path) > 0").select("block_id", T.keyword(F.get("section_path", F.lit(0))).alias("keyword"))


@query("SELECT bundle_id, concat_ws(chr(10), 'Title: ' || nullif(title, ''), 'Previous: ' || nullif(journal, ''), substr(abstract, 1, 2000)) AS prompt FROM papers")
def q_prompts_whole(spark, d):
    return _papers(spark, d).select("bundle_id", T.prompt(F.col("title"), F.col("journal"), F.col("abstract")).alias("prompt"))


@query(r"""
WITH a AS (SELECT pdf_stem, CASE WHEN body LIKE '{%' AND json_valid(body) THEN body::JSON ->> '$.author' END AS s FROM sidecars),
b AS (SELECT pdf_stem, s, CASE WHEN contains(s, ';') THEN string_split(s, ';') WHEN regexp_matches(s, '(?i) and ') THEN string_split_regex(s, '(?i) and ') ELSE [s] END AS p FROM a WHERE s IS NOT NULL AND NOT starts_with(s, '['))
SELECT pdf_stem, array_to_string(list_filter(list_transform(p, lambda x: trim(x)), lambda x: x <> ''), '|') AS names FROM b
""")
def q_author_strings(spark, d):
    body = F.when(F.col("body").startswith("{") & F.try_parse_json("body").isNotNull(), F.get_json_object("body", "$.author"))
    s = table(spark, d, "sidecars").select("pdf_stem", body.alias("s")).filter("s is not null and not startswith(s, '[')")
    return s.select("pdf_stem", F.array_join(T.split_authors(F.col("s")), "|").alias("names"))


@query(f"""
WITH a AS (SELECT bundle_id, array_to_string(list_transform(list_filter(authors, lambda n: n.name IS NOT NULL), lambda n: n.name || '1,2'), ', ') || ' and Ana Paz' || chr(10) || 'some place' AS txt FROM papers)
SELECT bundle_id, array_to_string({Q.authors("txt")}, '|') AS names FROM a
""")
def q_author_blocks(spark, d):
    text = F.concat(F.array_join(F.transform("authors.name", lambda n: F.concat(n, F.lit("1,2"))), ", "), F.lit(" and Ana Paz\nsome place"))
    return _papers(spark, d).select("bundle_id", F.array_join(T.parse_authors(text), "|").alias("names"))


@query(f"""
WITH a AS (SELECT bundle_id, concat_ws(chr(10), 'arXiv:2301.1 [x]', title, array_to_string(list_transform(list_filter(authors, lambda n: n.name IS NOT NULL), lambda n: n.name), ', '), 'Abstract', abstract) AS txt FROM papers),
b AS (SELECT bundle_id, {Q.title_lines("txt")} AS st FROM a)
SELECT bundle_id, {Q.title_of("st")} AS title, array_to_string({Q.authors_of("st")}, '|') AS authors FROM b
""")
def q_title_blocks(spark, d):
    text = F.concat_ws("\n", F.lit("arXiv:2301.1 [x]"), "title", F.array_join("authors.name", ", "), F.lit("Abstract"), "abstract")
    got = _papers(spark, d).select("bundle_id", T.split_title(text).alias("t"))
    return got.select("bundle_id", "t.title", F.array_join("t.authors", "|").alias("authors"))


@query("""
SELECT bundle_id, concat_ws(', ', nullif(journal, ''), year::VARCHAR) AS citation FROM papers
""")
def q_citations(spark, d):
    return _papers(spark, d).select("bundle_id", T.citation(F.col("journal"), F.col("year")).alias("citation"))


@query("SELECT log_id, lower(list_last(string_split(regexp_replace(filename, '\\.pdf$', ''), '_'))) AS name FROM ingest_log WHERE contains(regexp_replace(filename, '\\.pdf$', ''), '_')")
def q_supplement_names(spark, d):
    stem = F.regexp_replace("filename", r"\.pdf$", "")
    return table(spark, d, "ingest_log").select("log_id", T.supplement_name(stem).alias("name")).filter("name is not null")


@query("""
WITH a AS (SELECT log_id, coalesce(user_name, '') AS u, filename AS f FROM ingest_log WHERE filename IS NOT NULL),
p AS (SELECT log_id, list_filter([u, 'completed', 'old'], lambda x: x <> '' AND lower(x) NOT IN ('completed', 'errors', 'duplicates')) AS t FROM a)
SELECT log_id, array_to_string(t, '/') AS tags, array_to_string(list_sort(list_distinct(list_concat(t, ['pdf', 'old']))), '/') AS all_tags FROM p
""")
def q_tags(spark, d):
    path = F.concat(F.lit("/in/"), F.coalesce("user_name", F.lit("")), F.lit("/completed/old/"), "filename")
    a = table(spark, d, "ingest_log").filter("filename is not null").select("log_id", T.tags_of(path, "/in").alias("t"))
    return a.select("log_id", F.array_join("t", "/").alias("tags"), F.array_join(F.array_sort(F.array_union("t", F.array(F.lit("pdf"), F.lit("old")))), "/").alias("all_tags"))


# --- chunks --------------------------------------------------------------------------------------------------------------------


_NUMBERED = "(row_number() OVER (PARTITION BY id ORDER BY path) - 1)::INT"


@query(f"""
WITH {Q.split_text("SELECT doc_id AS id, text AS t, 800 AS size, 150 AS overlap FROM documents WHERE text IS NOT NULL")}
SELECT id AS doc_id, {_NUMBERED} AS chunk_no, {_STRIP("t")} AS chunk FROM cut WHERE NOT more AND {_STRIP("t")} <> ''
""")
def q_split_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(D.text_chunks(F.col("text"))).alias("chunk_no", "chunk"))


@query(f"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, '. '), lambda x, i: CASE WHEN i = 1 THEN x ELSE '. ' || x END), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL AND text <> ''),
r AS (SELECT doc_id, list_reduce(list_prepend({{'o': []::VARCHAR[], 'c': ''}}, list_transform(ps, lambda x: {{'o': []::VARCHAR[], 'c': x}})),
  lambda s, x: CASE WHEN s.c <> '' AND length(s.c) + length(x.c) > 300 THEN {{'o': list_append(s.o, s.c), 'c': x.c}} ELSE {{'o': s.o, 'c': s.c || x.c}} END) AS z FROM p WHERE len(ps) > 0),
u AS (SELECT doc_id, unnest(list_append(z.o, z.c)) AS q FROM r)
SELECT doc_id, {_STRIP("q")} AS chunk, count(*)::BIGINT AS n FROM u WHERE {_STRIP("q")} <> '' GROUP BY ALL
""")
def q_split_one_level(spark, d):
    parts = table(spark, d, "documents").filter("text <> ''").select("doc_id", F.explode(D.split_at(F.col("text"), ". ", 300)).alias("chunk"))
    return parts.groupBy("doc_id", "chunk").agg(F.count("*").alias("n"))


# Rows are added, so that every table is longer than the size.
_LONG_TABLE = "text || repeat(chr(10) || '| added row | of a few | cells |', 60)"


def _long_table():
    return F.concat("text", F.repeat(F.lit("\n| added row | of a few | cells |"), 60))


@query(f"""
WITH c AS ({Q.split_table(f"SELECT block_id AS id, {_LONG_TABLE} AS t, 1600 AS size FROM blocks WHERE type = 'table' AND text IS NOT NULL")})
SELECT id AS block_id, (i - 1)::INT AS chunk_no, {_STRIP("c")} AS chunk FROM (SELECT id, unnest(chunks) AS c, generate_subscripts(chunks, 1) AS i FROM c)
""")
def q_split_table(spark, d):
    return _blocks(spark, d).filter("type = 'table' and text is not null").select("block_id", F.posexplode(D.table_chunks(_long_table())).alias("chunk_no", "chunk"))


@query(f"""
WITH {Q.split_text("SELECT doc_id AS id, repeat(text || '. ', 3) AS t, 16000 AS size, 800 AS overlap FROM documents WHERE text IS NOT NULL")}
SELECT id AS doc_id, {_NUMBERED} AS chunk_no, {_STRIP("t")} AS chunk FROM cut WHERE NOT more AND {_STRIP("t")} <> ''
""")
def q_hard_max(spark, d):
    run = D._series(lambda s: None if s is None else D.enforce_hard_max([s]))
    return table(spark, d, "documents").select("doc_id", F.posexplode(run(F.repeat(F.concat("text", F.lit(". ")), 3))).alias("chunk_no", "chunk"))


_PLAIN_BLOCKS = "SELECT block_id AS id, repeat(text || '. ', 5) AS t, CASE WHEN coalesce(type, 'text') IN ('text', 'list') THEN 800 ELSE 16000 END AS size, CASE WHEN coalesce(type, 'text') IN ('text', 'list') THEN 150 ELSE 800 END AS overlap FROM blocks WHERE text IS NOT NULL AND coalesce(type, 'text') <> 'table'"


@query(f"""
WITH {Q.split_text(_PLAIN_BLOCKS)},
tables AS ({Q.split_table(f"SELECT block_id AS id, {_LONG_TABLE} AS t, 1600 AS size FROM blocks WHERE type = 'table' AND text IS NOT NULL")}),
every AS (SELECT id AS block_id, {_NUMBERED} AS chunk_no, {_STRIP("t")} AS chunk FROM cut WHERE NOT more AND {_STRIP("t")} <> ''
 UNION ALL SELECT id, (i - 1)::INT, {_STRIP("c")} FROM (SELECT id, unnest(chunks) AS c, generate_subscripts(chunks, 1) AS i FROM tables))
SELECT e.block_id, b.type, e.chunk_no, e.chunk FROM every e JOIN blocks b ON e.block_id = b.block_id
""")
def q_chunks(spark, d):
    long = F.when(F.coalesce("type", F.lit("text")) == "table", _long_table()).otherwise(F.repeat(F.concat("text", F.lit(". ")), 5))
    return D.chunks(_blocks(spark, d).filter("text is not null").select("block_id", "type", long.alias("text")))


# --- order of blocks ----------------------------------------------------------------------------------------------------------------


@query("""
SELECT block_id, coalesce(last_value(CASE WHEN type = 'section_header' THEN text END IGNORE NULLS) OVER (PARTITION BY paper_id ORDER BY pos, block_id), '') AS section FROM blocks
""")
def q_section_path(spark, d):
    return S.section_paths(_blocks(spark, d).select("paper_id", "pos", "block_id", "type", "text")).select("block_id", F.coalesce(F.get("path", F.lit(0)), F.lit("")).alias("section"))


@query("""
SELECT block_id, (row_number() OVER (PARTITION BY paper_id, page ORDER BY pos, block_id) - 1)::INT AS node_no, printf('%s-p%02d-%03d', paper_id, page, row_number() OVER (PARTITION BY paper_id, page ORDER BY pos, block_id) - 1) AS node FROM blocks
""")
def q_node_ids(spark, d):
    return S.node_numbers(_blocks(spark, d).select("paper_id", "page", "pos", "block_id")).select("block_id", "node_no", "node")


@query(f"""
WITH n AS (SELECT block_id, paper_id, pos, type, text, lead(text) OVER w AS nx, row_number() OVER w AS rn FROM blocks WINDOW w AS (PARTITION BY paper_id ORDER BY pos, block_id)),
e AS (SELECT *, coalesce(type = 'figure' AND regexp_matches({_STRIP("nx")}, '{_CAPTION}'), false) AS asks FROM n),
b AS (SELECT *, coalesce(last_value(CASE WHEN NOT asks THEN rn END IGNORE NULLS) OVER (PARTITION BY paper_id ORDER BY rn), 0) AS base FROM e),
t AS (SELECT *, asks AND (rn - base) % 2 = 1 AS takes FROM b),
g AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY paper_id ORDER BY rn), false) AS gone FROM t)
SELECT block_id, type, CASE WHEN takes THEN {_STRIP("nx")} ELSE text END AS text FROM g WHERE NOT gone
""")
def q_captions(spark, d):
    return S.captions(_blocks(spark, d).select("paper_id", "pos", "block_id", "type", "text")).select("block_id", "type", "text")


@query(f"""
WITH b AS (SELECT block_id, paper_id, pos, CASE WHEN type = 'junk' THEN 'section_header' ELSE type END AS type, text, array_to_string(section_path, '/') AS p FROM blocks),
s AS (SELECT *, last_value(CASE WHEN type = 'section_header' THEN {{'j': coalesce(regexp_matches(text, '{_JUNK}'), false), 'p': p}} END IGNORE NULLS) OVER (PARTITION BY paper_id ORDER BY pos, block_id) AS st FROM b)
SELECT block_id, CASE WHEN coalesce(st.j AND (type = 'section_header' OR p IS NOT DISTINCT FROM st.p), false) THEN 'junk' ELSE type END AS type FROM s
""")
def q_junk(spark, d):
    b = _blocks(spark, d).select("paper_id", "pos", "block_id", F.when(F.col("type") == "junk", "section_header").otherwise(F.col("type")).alias("type"), "text", F.array_join("section_path", "/").alias("section_path"))
    return S.mark_junk(b).select("block_id", "type")


@query(f"""
WITH toc AS (SELECT paper_id, pos AS toc_pos, {_STRIP("replace(text, chr(10), ' ')")} AS title, page FROM blocks WHERE type = 'section_header' AND text IS NOT NULL),
t AS (SELECT DISTINCT paper_id, toc_pos, substr(title, 1, 40) AS title, page FROM toc WHERE title <> ''),
m AS (SELECT t.paper_id, t.toc_pos, t.title, t.page, min({{'pos': b.pos, 'block_id': b.block_id}}) AS spot FROM t JOIN blocks b ON t.paper_id = b.paper_id AND contains(replace(coalesce(b.text, ''), chr(10), ' '), t.title) GROUP BY ALL),
a AS (SELECT paper_id, spot.pos AS pos, spot.block_id AS block_id, arg_max(page, toc_pos) AS anchor FROM m GROUP BY ALL),
p AS (SELECT paper_id, max(page_count) AS total FROM papers GROUP BY 1)
SELECT b.block_id, (CASE WHEN coalesce(p.total, 1) <= 1 THEN 0 ELSE least(coalesce(last_value(a.anchor IGNORE NULLS) OVER (PARTITION BY b.paper_id ORDER BY b.pos, b.block_id), 0), p.total - 1) END)::INT AS page_no
FROM blocks b LEFT JOIN a ON a.paper_id = b.paper_id AND a.pos = b.pos AND a.block_id = b.block_id LEFT JOIN p ON p.paper_id = b.paper_id
""")
def q_page_assign(spark, d):
    b = _blocks(spark, d).select("paper_id", "pos", "block_id", "type", "text", "page")
    # Copies of a heading are one entry.
    toc = b.filter("type = 'section_header' and text is not null").select("paper_id", F.col("pos").alias("toc_pos"), F.col("text").alias("title"), F.col("page").alias("page_id")).distinct()
    totals = _papers(spark, d).groupBy("paper_id").agg(F.max("page_count").alias("total_pages"))
    return S.assign_pages(b, toc, totals).select("block_id", "page_no")


_RUNNING = f"""
WITH pg AS (SELECT source AS doc, doc_id AS page, CASE WHEN hash_bucket < 8 THEN 'Bulletin of ' || source || chr(10) ELSE '' END || text AS text FROM (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 1))::INT AS hash_bucket FROM documents) WHERE source IS NOT NULL
),
ln AS (SELECT doc, page, string_split(text, chr(10)) AS ls FROM pg WHERE text IS NOT NULL),
c AS (SELECT DISTINCT doc, page, unnest(list_transform(list_concat(ls[1:3], ls[greatest(len(ls) - 2, 1):]), lambda x: {_STRIP("x")})) AS line FROM ln),
n AS (SELECT doc, count(DISTINCT page) AS total FROM pg GROUP BY 1 HAVING count(DISTINCT page) >= 3),
r AS (SELECT c.doc, c.line, count(*)::BIGINT AS n_pages, n.total::BIGINT AS total FROM c JOIN n ON c.doc = n.doc WHERE length(line) BETWEEN 4 AND 120 GROUP BY c.doc, c.line, n.total HAVING count(*) >= n.total * 0.4)
"""


@query(_RUNNING + "SELECT * FROM r")
def q_running_lines(spark, d):
    return S.running_lines(_pages(spark, d))


def _pages(spark, d):
    # About half of the pages of a source get a running line.
    half = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1), 16, 10).cast("int") < 8
    text = F.concat(F.when(half, F.concat(F.lit("Bulletin of "), "source", F.lit("\n"))).otherwise(""), "text")
    return table(spark, d, "documents").filter("source is not null").select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), text.alias("text"))


@query(_RUNNING + f""", k AS (SELECT doc, list(line) AS lines FROM r GROUP BY 1),
s AS (SELECT pg.doc, pg.page, CASE WHEN k.lines IS NULL THEN pg.text ELSE {_STRIP("array_to_string(list_filter(string_split(pg.text, chr(10)), lambda x: NOT list_contains(k.lines, " + _STRIP("x") + ")), chr(10))")} END AS text FROM pg LEFT JOIN k ON pg.doc = k.doc)
SELECT doc, page, text FROM s WHERE text <> ''
""")
def q_strip_running(spark, d):
    return S.strip_running_lines(_pages(spark, d)).select("doc", "page", "text")


# --- metadata ------------------------------------------------------------------------------------------------------------------------


def _side_sql(name: str, kind: str = "VARCHAR") -> str:
    get = f"(j ->> '$.{name}')"
    return f"CASE WHEN NOT list_contains(ks, '{name}') THEN p.{name} WHEN {get} IS NULL THEN NULL WHEN {get} = '' THEN p.{name} ELSE try_cast({get} AS {kind}) END AS {name}"


@query(f"""
WITH s AS (SELECT bundle_id, CASE WHEN starts_with(body, '{{') AND json_valid(body) THEN body::JSON END AS j FROM sidecars),
k AS (SELECT *, coalesce(json_keys(j), []) AS ks FROM s)
SELECT p.bundle_id, {", ".join(_side_sql(n, "INT" if n == "year" else "VARCHAR") for n in R.OVERRIDES)} FROM papers p JOIN k ON p.bundle_id = k.bundle_id
""")
def q_sidecar_override(spark, d):
    papers, sides = _papers(spark, d), table(spark, d, "sidecars")
    return R.override(papers.join(sides.select("bundle_id"), "bundle_id", "left_semi"), sides, "bundle_id").select("bundle_id", *R.OVERRIDES)


@query("""
WITH c AS (SELECT paper_id AS id, bundle_id AS pos, doi, CASE bundle_id % 3 WHEN 0 THEN 'bundle' WHEN 1 THEN 'internal' ELSE 'filename' END AS provenance FROM papers WHERE doi IS NOT NULL
 UNION ALL SELECT paper_id, bundle_id, upper(' doi:' || doi || 'x'), 'sidecar' FROM papers WHERE doi IS NOT NULL),
n AS (SELECT id, pos, regexp_replace(lower(trim(doi)), '^doi:', '') AS doi, provenance FROM c),
v AS (SELECT n.*, k.doi IS NOT NULL AS validated FROM n LEFT JOIN (SELECT DISTINCT CASE WHEN year % 2 = 0 THEN lower(doi) ELSE lower(doi) || '-old' END AS doi FROM papers WHERE doi <> '') k ON n.doi = k.doi WHERE regexp_matches(n.doi, '^10\\.\\d{4,}/[^\\s<>"}]+$'))
SELECT id, doi, provenance, validated FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY validated DESC, list_position(['bundle', 'sidecar', 'secondary_validator', 'internal', 'existing_tags', 'filename'], provenance), pos, doi) = 1
""")
def q_doi_select(spark, d):
    p = _papers(spark, d).filter("doi is not null")
    by = F.when(F.col("bundle_id") % 3 == 0, "bundle").when(F.col("bundle_id") % 3 == 1, "internal").otherwise("filename")
    c = p.select(F.col("paper_id").alias("id"), F.col("bundle_id").alias("pos"), "doi", by.alias("provenance"))
    c = c.unionByName(p.select(F.col("paper_id").alias("id"), F.col("bundle_id").alias("pos"), F.upper(F.concat(F.lit(" doi:"), "doi", F.lit("x"))).alias("doi"), F.lit("sidecar").alias("provenance")))
    return R.best_doi(c, p.filter("doi <> ''").select(F.when(F.col("year") % 2 == 0, F.col("doi")).otherwise(F.concat("doi", F.lit("-old"))).alias("doi")))


@query("""
SELECT bundle_id, coalesce(nullif(title, ''), translate(slug, '_-', '  ')) AS title, CASE WHEN y BETWEEN 1900 AND 2100 THEN y END AS year, nullif(doi, '') AS doi
FROM (SELECT *, try_cast(substr(regexp_replace('D:' || strftime(extracted_at, '%Y%m%d'), '^D:', ''), 1, 4) AS INT) AS y FROM papers)
""")
def q_local_header(spark, d):
    h = R.local_header(F.col("title"), F.lit(None).cast("string"), F.concat(F.lit("D:"), F.date_format("extracted_at", "yyyyMMdd")), F.col("doi"), F.col("slug"))
    return _papers(spark, d).select("bundle_id", h.alias("h")).select("bundle_id", "h.title", "h.year", "h.doi")


@query(f"""
WITH a AS (SELECT *, lower({_STRIP("coalesce(title, '')")}) AS t, coalesce(doi, '') = '' AND coalesce(arxiv_id, '') = '' AND coalesce(s2_id, '') = '' AS unknown FROM papers)
SELECT bundle_id, CASE WHEN NOT coalesce(verified, false) THEN 'unverified' || CASE WHEN len(verify_warnings) > 0 THEN ': ' || array_to_string(verify_warnings, '; ') ELSE '' END
 WHEN unknown AND (t = '' OR t = 'untitled' OR starts_with(t, 'pii:') OR starts_with(t, 'pii ') OR length(t) < 5) THEN 'garbage title' WHEN unknown AND starts_with(coalesce(slug, ''), 'anon') THEN 'anonymous' END AS reason FROM a
""")
def q_rejections(spark, d):
    c = F.col
    return _papers(spark, d).select("bundle_id", R.rejection(c("verified"), c("verify_warnings"), c("doi"), c("arxiv_id"), c("s2_id"), c("title"), c("slug")).alias("reason"))


@query("""
WITH a AS (SELECT bundle_id, coalesce(doi, '') AS doi, coalesce(title, '') AS title, coalesce(authors[1].name, '') AS author, CASE WHEN bundle_id % 2 = 0 THEN 'doi:' || upper(coalesce(doi, '')) ELSE '' END AS i, CASE WHEN bundle_id % 3 = 0 THEN coalesce(doi, '') || ', x' ELSE '' END AS k,
 CASE WHEN bundle_id % 5 = 0 THEN 'short' ELSE coalesce(title, '') END AS t, CASE WHEN bundle_id % 7 = 0 THEN '' ELSE 'x' END AS w, bundle_id % 11 = 0 AS force FROM papers),
r AS (SELECT bundle_id, CASE WHEN force THEN 'forced' WHEN doi <> '' AND NOT contains(lower(i), 'doi:' || lower(doi)) AND NOT contains(lower(k), lower(doi)) THEN 'doi missing' WHEN title <> '' AND length(t) < 10 THEN 'title missing' WHEN author <> '' AND w = '' THEN 'author missing' ELSE 'up to date' END AS reason FROM a)
SELECT bundle_id, reason <> 'up to date' AS "update", reason FROM r
""")
def q_should_update(spark, d):
    b, e = F.col("bundle_id"), F.lit("")
    old_id = F.when(b % 2 == 0, F.concat(F.lit("doi:"), F.upper(F.coalesce("doi", e)))).otherwise("")
    old_words = F.when(b % 3 == 0, F.concat(F.coalesce("doi", e), F.lit(", x"))).otherwise("")
    old_title = F.when(b % 5 == 0, "short").otherwise(F.coalesce("title", e))
    r = R.update_decision(b % 11 == 0, F.col("doi"), F.col("title"), F.get("authors", F.lit(0))["name"], old_id, old_words, old_title, F.when(b % 7 == 0, "").otherwise("x"))
    return _papers(spark, d).select("bundle_id", r.alias("r")).select("bundle_id", "r.update", "r.reason")


_SIMILAR = Q.similar("x", "y")


@query(f"""
WITH a AS (SELECT bundle_id, entry_type, title, CASE WHEN bundle_id % 2 = 0 THEN concat_ws(chr(10), title, abstract) END AS page, CASE WHEN bundle_id % 5 = 0 THEN verified END AS said, bundle_id % 13 <> 0 AS ask FROM papers),
b AS (SELECT *, {Q.squeeze("title")} AS x, substr(regexp_replace(coalesce(page, ''), '{_WS}+', '', 'g'), 1, length(regexp_replace(coalesce(title, ''), '{_WS}+', '', 'g'))) AS h FROM a),
c AS (SELECT *, lower(h) AS y FROM b),
v AS (SELECT *, CASE WHEN NOT ask OR coalesce(entry_type IN ('datasheet', 'manual', 'techreport', 'notes', 'other'), false) THEN true WHEN said IS NOT NULL THEN said WHEN page <> '' THEN {_SIMILAR} >= 0.8 ELSE false END AS ok FROM c)
SELECT bundle_id, ok AS verified, CASE WHEN NOT ok AND said IS NOT NULL THEN 'sidecar says unverified' WHEN NOT ok AND page <> '' THEN 'title not on first page' WHEN NOT ok THEN 'nothing to verify with' END AS warning FROM v
""")
def q_verify(spark, d):
    first = F.when(F.col("bundle_id") % 2 == 0, F.concat_ws("\n", "title", "abstract"))
    v = R.verification(F.col("bundle_id") % 13 != 0, F.col("entry_type"), F.when(F.col("bundle_id") % 5 == 0, F.col("verified")), F.col("title"), first)
    return _papers(spark, d).select("bundle_id", v.alias("v")).select("bundle_id", "v.verified", "v.warning")


# What a rescue finds: w, and the catalogue's hit: m.
_RESCUE = """WITH
l AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY bundle_id DESC) = 1),
h AS (SELECT *, {title} AS own, {authors} AS own_authors FROM l),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY pos, block_id) AS rn FROM blocks) WHERE rn <= 15),
f AS (SELECT paper_id, {strip} AS t, row_number() OVER (PARTITION BY paper_id ORDER BY rn) AS k FROM e WHERE coalesce(type, '') NOT IN ('junk', 'equation', 'figure', 'table') AND length({strip}) >= 5),
c AS (SELECT * FROM f WHERE k <= 5),
r AS (SELECT *, CASE WHEN length(t) <= 300 THEN t ELSE {title_of} END AS got, CASE WHEN length(t) > 300 THEN {authors_of} END AS with_title FROM (SELECT *, {lines} AS st FROM c WHERE NOT regexp_matches(t, '^\\p{{Nd}}+(\\.|{ws})') AND lower(t) NOT IN ('abstract', 'contents', 'references'))),
t AS (SELECT paper_id, arg_min({{'got': got, 'w': with_title}}, k) AS b FROM r WHERE got IS NOT NULL GROUP BY 1),
n AS (SELECT h.paper_id, arg_min({parse}, c.k) FILTER ({parse} IS NOT NULL) AS listed FROM h LEFT JOIN t ON h.paper_id = t.paper_id JOIN c ON h.paper_id = c.paper_id
 WHERE c.t <> coalesce(CASE WHEN coalesce(h.own, '') = '' THEN t.b.got END, nullif(h.own, ''), '') AND length(c.t) <= 500 AND len(regexp_extract_all(c.t, '\\. ')) <= 3 AND NOT regexp_matches(lower(c.t), '^(abstract|keyword)') GROUP BY 1),
g AS (SELECT h.paper_id, h.year AS y, nullif(h.doi, '') AS d, CASE WHEN coalesce(h.own, '') = '' THEN t.b.got END AS title, CASE WHEN coalesce(len(h.own_authors), 0) = 0 THEN coalesce(CASE WHEN coalesce(h.own, '') = '' THEN t.b.w END, n.listed) END AS names FROM h LEFT JOIN t ON h.paper_id = t.paper_id LEFT JOIN n ON h.paper_id = n.paper_id),
w AS (SELECT * FROM g WHERE title IS NOT NULL OR names IS NOT NULL),
k AS (SELECT lower(title) AS lt, title, list_transform(authors, lambda a: a.name) AS names, year, doi, journal FROM {catalog} WHERE title <> ''),
m AS (SELECT w.paper_id, k.title, k.names, k.year, k.doi, k.journal FROM w JOIN k ON lower(w.title) = k.lt WHERE w.d IS NULL AND abs(coalesce(k.year - w.y, 0)) <= 2
 QUALIFY row_number() OVER (PARTITION BY w.paper_id ORDER BY abs(coalesce(k.year - w.y, 0)), k.doi NULLS FIRST, k.title, k.journal) = 1)
"""
_PARTS = {"strip": _STRIP("coalesce(text, '')"), "title_of": Q.title_of("st"), "authors_of": Q.authors_of("st"), "lines": Q.title_lines("t"), "parse": Q.authors("c.t"), "ws": _WS}


def _catalog(spark, d):
    """Two lookups of every title: a paper of the same year, and one far off."""
    known = M.latest(_papers(spark, d), "paper_id", "bundle_id").select(F.col("title"), F.col("authors.name").alias("authors"), "year", F.lower("doi").alias("doi"), "journal")
    return known.groupBy("title", "year").agg(*[F.min(c).alias(c) for c in ("authors", "doi", "journal")])


_CATALOG = "(SELECT title, year, min(lower(doi)) AS doi, min(journal) AS journal, NULL::STRUCT(name VARCHAR)[] AS authors FROM l GROUP BY title, year)"


@query(_RESCUE.format(title="CASE WHEN bundle_id % 2 = 0 THEN title END", authors="CASE WHEN bundle_id % 3 > 0 THEN authors END", catalog=_CATALOG, **_PARTS) + """
SELECT w.paper_id, coalesce(nullif(m.title, ''), w.title) AS title, array_to_string(w.names, '|') AS authors, m.year, nullif(m.doi, '') AS doi, nullif(m.journal, '') AS journal, CASE WHEN m.paper_id IS NULL THEN 'text_rescue' ELSE 'catalog_rescue' END AS source FROM w LEFT JOIN m ON w.paper_id = m.paper_id
""")
def q_rescue(spark, d):
    papers = M.latest(_papers(spark, d), "paper_id", "bundle_id")
    bare = papers.withColumns({"title": F.when(F.col("bundle_id") % 2 == 0, F.col("title")), "authors": F.when(F.col("bundle_id") % 3 > 0, F.col("authors"))})
    got = R.rescue(_blocks(spark, d), bare, _catalog(spark, d).drop("authors"))
    return got.select("paper_id", "title", F.array_join("authors", "|").alias("authors"), "year", "doi", "journal", "source")


# Every fifth title is replaced by the name of a file.
_POOR = "CASE WHEN bundle_id % 5 = 0 THEN 'draft_' || bundle_id || '.indd' ELSE title END"


@query(_RESCUE.format(title=f"CASE WHEN NOT regexp_matches({_STRIP(f'({_POOR})')}, '{T.GARBAGE_TITLE}') THEN {_POOR} END", authors="authors", catalog=_CATALOG, **_PARTS) + f""",
j AS (SELECT h.*, w.paper_id IS NOT NULL AS rescued, coalesce(nullif(m.title, ''), nullif(w.title, ''), nullif(h.own, '')) AS new_title, coalesce(m.names, w.names, list_transform(h.authors, lambda a: a.name)) AS names, coalesce(m.year, h.year) AS new_year, concat_ws(chr(10), h.title, h.abstract) AS page,
 CASE WHEN w.paper_id IS NULL THEN NULL WHEN m.paper_id IS NULL THEN 'text_rescue' ELSE 'catalog_rescue' END AS src, coalesce(nullif(m.doi, ''), nullif(h.doi, '')) AS new_doi FROM h LEFT JOIN w ON h.paper_id = w.paper_id LEFT JOIN m ON h.paper_id = m.paper_id),
v AS (SELECT *, {Q.squeeze("new_title")} AS x, lower(substr(regexp_replace(coalesce(page, ''), '{_WS}+', '', 'g'), 1, length(regexp_replace(coalesce(new_title, ''), '{_WS}+', '', 'g')))) AS y FROM j)
SELECT paper_id, new_title AS title, array_to_string(names, '|') AS authors, new_year AS year, new_doi AS doi, CASE WHEN rescued THEN {Q.slug("names", "new_year", "new_title")} ELSE slug END AS slug,
 CASE WHEN rescued AND NOT coalesce(entry_type IN ('datasheet', 'manual', 'techreport', 'notes', 'other'), false) AND page <> '' THEN {_SIMILAR} >= 0.8 ELSE verified END AS verified, src AS source, rescued FROM v
""")
def q_fixup(spark, d):
    papers = M.latest(_papers(spark, d), "paper_id", "bundle_id")
    poor = F.when(F.col("bundle_id") % 5 == 0, F.concat(F.lit("draft_"), F.col("bundle_id").cast("string"), F.lit(".indd"))).otherwise(F.col("title"))
    heads = papers.withColumns({"first_page": F.concat_ws("\n", "title", "abstract"), "title": poor, "sidecar_verified": F.lit(None).cast("boolean")})
    got = R.fix_up(heads, _blocks(spark, d), _catalog(spark, d).drop("authors"))
    return got.withColumn("authors", F.array_join("authors", "|"))


@query("""
WITH l AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY bundle_id DESC) = 1),
o AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY bundle_id) = 1)
SELECT o.bundle_id, coalesce(nullif(l.title, ''), nullif(o.title, '')) AS title, coalesce(l.year, o.year) AS year, coalesce(nullif(l.journal, ''), nullif(o.journal, '')) AS journal FROM o JOIN l ON o.paper_id = l.paper_id
""")
def q_update_meta(spark, d):
    p = _papers(spark, d)
    first = p.groupBy("paper_id").agg(F.min_by(F.struct(*[c for c in p.columns if c != "paper_id"]), "bundle_id").alias("r")).select("paper_id", "r.*")
    return M.update_metadata(first, M.latest(p, "paper_id", "bundle_id").select("paper_id", "title", "year", "journal"), "paper_id").select("bundle_id", "title", "year", "journal")


@query("""
WITH p AS (SELECT *, list_transform(authors, lambda a: a.name) AS names FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY bundle_id DESC) = 1)
SELECT paper_id AS id, coalesce(nullif(CASE WHEN bundle_id % 3 = 0 THEN 'On ' || title END, ''), nullif(CASE WHEN bundle_id % 2 = 0 THEN title END, ''), nullif(title, '')) AS title,
 array_to_string(CASE WHEN len(names) > 0 THEN names END, '|') AS authors, year, nullif(journal, '') AS journal, coalesce(nullif(doi, ''), nullif(coalesce(doi, '10.9999/x'), '')) AS doi FROM p
""")
def q_merge_sources(spark, d):
    p = M.latest(_papers(spark, d), "paper_id", "bundle_id").select(F.col("paper_id").alias("id"), "title", F.col("authors.name").alias("authors"), "year", "journal", "doi", "bundle_id")
    empty = F.lit(None).cast("string")
    got = R.merge_sources(p.withColumn("title", F.when(F.col("bundle_id") % 2 == 0, F.col("title"))), p.withColumn("title", F.when(F.col("bundle_id") % 3 == 0, F.concat(F.lit("On "), "title"))), p.withColumn("doi", F.coalesce("doi", F.lit("10.9999/x"))), p.withColumn("journal", empty))
    return got.select("id", "title", F.array_join("authors", "|").alias("authors"), "year", "journal", "doi")


@query("""
WITH f AS (SELECT 'a/' || (log_id % 7) || '/' || filename AS path, regexp_replace(filename, '\\.[^.]*$', '') AS stem, 'a/' || (log_id % 7) AS dir FROM ingest_log WHERE filename IS NOT NULL),
u AS (SELECT DISTINCT * FROM f),
b AS (SELECT DISTINCT CASE WHEN bundle_id % 2 = 0 THEN 'a/' || (bundle_id % 7) ELSE 'a' END AS dir, slug AS stem, CASE WHEN bundle_id % 2 = 0 THEN 'a/' || (bundle_id % 7) ELSE 'a' END || '/' || slug || '.bundle' AS bundle FROM papers WHERE slug IS NOT NULL),
h AS (SELECT u.path, CASE WHEN u.dir = b.dir AND u.stem = b.stem THEN 0 ELSE 1 END AS fuzzy, CASE WHEN u.dir = b.dir THEN 0 ELSE 1 END AS far, b.bundle FROM u JOIN b ON (u.dir = b.dir OR b.dir = 'a') AND (contains(b.stem, u.stem) OR contains(u.stem, b.stem)))
SELECT u.path, (SELECT bundle FROM h WHERE h.path = u.path ORDER BY fuzzy, far, bundle LIMIT 1) AS bundle FROM u
""")
def q_find_bundles(spark, d):
    f = table(spark, d, "ingest_log").filter("filename is not null").select(F.concat(F.lit("a/"), (F.col("log_id") % 7).cast("string"), F.lit("/"), "filename").alias("path")).distinct()
    folder = F.when(F.col("bundle_id") % 2 == 0, F.concat(F.lit("a/"), (F.col("bundle_id") % 7).cast("string"))).otherwise("a")
    b = _papers(spark, d).filter("slug is not null").select(F.concat(folder, F.lit("/"), "slug", F.lit(".bundle")).alias("path")).distinct()
    return R.find_bundles(f, b)


@query("""
WITH s AS (SELECT log_id AS name, CASE log_id % 3 WHEN 0 THEN slug WHEN 1 THEN doi ELSE ref_id::VARCHAR END AS k FROM ingest_log),
h AS (SELECT s.name, 0 AS r, p.bundle_id AS parent FROM s JOIN papers p ON s.k = p.slug UNION ALL SELECT s.name, 1, p.bundle_id FROM s JOIN papers p ON s.k = p.doi UNION ALL SELECT s.name, 2, p.bundle_id FROM s JOIN papers p ON s.k = p.bundle_id::VARCHAR)
SELECT s.name, (SELECT parent FROM h WHERE h.name = s.name ORDER BY r, parent LIMIT 1) AS parent FROM s
""")
def q_find_parents(spark, d):
    by = F.when(F.col("log_id") % 3 == 0, F.col("slug")).when(F.col("log_id") % 3 == 1, F.col("doi")).otherwise(F.col("ref_id").cast("string"))
    s = table(spark, d, "ingest_log").select(F.col("log_id").alias("name"), by.alias("parent_key"))
    return R.find_parents(s, _papers(spark, d).select("slug", "doi", F.col("bundle_id").alias("ref_id")))


# --- hashes, tags, logs, reports --------------------------------------------------------------------------------------------------------


@query("""
WITH h AS (SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL)
SELECT doc_id, digest, min(doc_id) OVER (PARTITION BY digest) AS first_id, count(*) OVER (PARTITION BY digest)::BIGINT AS copies FROM h
""")
def q_dedup_hash(spark, d):
    return M.first_of_copies(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", "digest", "first_id", "copies")


@query("""
WITH f AS (SELECT paper_id, pdf_hash, min(bundle_id) AS first_seen FROM papers WHERE pdf_hash <> '' GROUP BY 1, 2)
SELECT paper_id, arg_min(pdf_hash, first_seen) AS first_hash, string_agg(pdf_hash, ',' ORDER BY first_seen, pdf_hash) AS hashes FROM f GROUP BY 1
""")
def q_hash_history(spark, d):
    return M.hash_histories(_papers(spark, d)).select("paper_id", "first_hash", F.array_join("hashes", ",").alias("hashes"))


@query("""
SELECT bundle_id, array_to_string(CASE WHEN bundle_id % 2 = 0 THEN [pdf_hash] ELSE [pdf_hash, 'n'] END, ',') AS history, bundle_id % 2 = 1 AS changed FROM papers WHERE pdf_hash <> ''
""")
def q_append_hash(spark, d):
    p = _papers(spark, d).filter("pdf_hash <> ''")
    r = M.append_hash(F.col("pdf_hash"), F.lit(None).cast("array<string>"), F.when(F.col("bundle_id") % 2 == 0, F.col("pdf_hash")).otherwise("n"))
    return p.select("bundle_id", r.alias("r")).select("bundle_id", F.array_join("r.history", ",").alias("history"), "r.changed")


@query("""
WITH a AS (SELECT *, list_filter(list_transform(coalesce(authors, []), lambda x: x.name), lambda x: x IS NOT NULL AND x <> '') AS ns FROM papers)
SELECT bundle_id, array_to_string(list_filter(list_concat(['-Title=' || nullif(title, ''), '-Author=' || nullif(array_to_string(ns, '; '), ''), '-Subject=' || nullif(concat_ws(', ', nullif(journal, ''), year::VARCHAR), ''),
 '-Keywords=' || nullif(array_to_string(list_concat(list_filter([nullif(doi, '')], lambda x: x IS NOT NULL), list_filter(coalesce(keywords, []), lambda x: x <> '' AND x <> coalesce(doi, ''))), ', '), ''), '-XMP-dc:Identifier=doi:' || nullif(doi, '')],
 list_transform(ns, lambda x: '-XMP-dc:Creator=' || x), ['-XMP-dc:Date=' || year::VARCHAR, '-XMP-dc:Title=' || nullif(title, ''), '-XMP-dc:Description=' || substr(nullif(abstract, ''), 1, 2000)]), lambda x: x IS NOT NULL), '|') AS args FROM a
""")
def q_tag_arguments(spark, d):
    c = F.col
    a = M.tag_arguments(c("title"), c("authors.name"), c("doi"), c("year"), c("journal"), c("abstract"), F.lit(None).cast("string"), c("keywords"))
    return _papers(spark, d).select("bundle_id", F.array_join(a, "|").alias("args"))


@query(r"""
SELECT log_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(9) || coalesce(regexp_replace(user_name, '[\t\r\n]+', ' ', 'g'), '') || chr(9) || coalesce(slug, '') || chr(9) || coalesce(doi, '') || chr(9) || coalesce(filename, '') || chr(9) || coalesce(ref_id::VARCHAR, '') || chr(9) || coalesce(regexp_replace(title, '[\t\r\n]+', ' ', 'g'), '') AS line FROM ingest_log
""")
def q_log_lines(spark, d):
    c = F.col
    return table(spark, d, "ingest_log").select("log_id", M.log_line(c("ts"), c("user_name"), c("slug"), c("doi"), c("filename"), c("ref_id"), c("title")).alias("line"))


@query("""
SELECT bundle_id, 'papers/' || coalesce(nullif(substr(slug, 1, 1), ''), 'x') || '/' || coalesce(slug, '') AS own, 'papers/' || coalesce(nullif(lower(substr(slug, 1, 1)), ''), '_') || '/' || coalesce(slug, '') AS shared, coalesce(regexp_matches(slug, '(?i)anon|untitled'), false) AS repair FROM papers
""")
def q_layout(spark, d):
    s = F.col("slug")
    return _papers(spark, d).select("bundle_id", M.layout(s).alias("own"), M.layout(s, shared=True).alias("shared"), M.repair_target(s).alias("repair"))


@query("""
WITH f AS (SELECT DISTINCT 'p/' || slug || '.bundle' AS path, 'p/' || regexp_replace(slug, '^anon', 'fymabadi') || '.bundle' AS target FROM papers WHERE slug IS NOT NULL),
m AS (SELECT *, min(path) OVER (PARTITION BY target) AS first FROM f)
SELECT path, target, (m.path <> target AND target IN (SELECT path FROM f)) OR path <> first AS conflict FROM m
""")
def q_rename_plan(spark, d):
    f = _papers(spark, d).filter("slug is not null").select(F.concat(F.lit("p/"), "slug", F.lit(".bundle")).alias("path"), F.regexp_replace("slug", "^anon", "fymabadi").alias("new_stem")).distinct()
    return M.rename_plan(f)


@query("""
WITH a AS (SELECT event_id, event_type <> 'click' AS success, value > 50 AS updated FROM events)
SELECT count(*)::BIGINT AS total, count(*) FILTER (success AND updated)::BIGINT AS updated, count(*) FILTER (success AND NOT coalesce(updated, false))::BIGINT AS skipped, count(*) FILTER (NOT coalesce(success, false))::BIGINT AS failed FROM a
""")
def q_report(spark, d):
    return M.report(table(spark, d, "events").select((F.col("event_type") != "click").alias("success"), (F.col("value") > 50).alias("updated")))


_AUDIT = """
SELECT strftime(extracted_at, '%Y-%m-%dT%H:%M:%S') AS timestamp, bundle_id::VARCHAR AS pdf_path, 'true' AS success, (bundle_id % 2 = 0)::VARCHAR AS updated, coalesce(slug, '') AS old_title, coalesce(title, '') AS new_title, '' AS old_doi, coalesce(doi, '') AS new_doi,
 CASE WHEN bundle_id % 2 = 0 THEN 'forced' ELSE 'up to date' END AS message, coalesce(arxiv_id, '') AS error FROM papers
"""


def _audit(spark, d):
    none, even = F.lit(""), F.col("bundle_id") % 2 == 0
    return _papers(spark, d).select(
        F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("bundle_id").cast("string").alias("pdf_path"), F.lit(True).alias("success"), even.alias("updated"), F.coalesce("slug", none).alias("old_title"),
        F.coalesce("title", none).alias("new_title"), none.alias("old_doi"), F.coalesce("doi", none).alias("new_doi"), F.when(even, "forced").otherwise("up to date").alias("message"), F.coalesce("arxiv_id", none).alias("error"),
        none.alias("old_author"), none.alias("old_identifier"), none.alias("old_keywords"), F.col("authors.name").alias("new_authors"), F.lit("bundle").alias("new_doi_provenance"), F.col("year").alias("new_year"), F.coalesce("journal", none).alias("new_journal"), even.alias("has_new"),
    )


@query(_AUDIT)
def q_audit(spark, d):
    folder = shared_folder(spark, "audit")
    B.write_audit(_audit(spark, d), f"{folder}/audit.csv")
    back = spark.read.options(header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/audit.csv")
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@query("""
SELECT bundle_id::VARCHAR AS pdf_path, coalesce(slug, '') AS old_title, CASE WHEN bundle_id % 2 = 0 THEN coalesce(title, '') END AS new_title, CASE WHEN bundle_id % 2 = 0 THEN len(authors) END AS n_authors, CASE WHEN bundle_id % 2 = 0 THEN year END AS new_year,
 CASE WHEN bundle_id % 2 = 0 THEN 'authors,doi,doi_provenance,journal,title,year' END AS new_keys FROM papers
""")
def q_audit_lines(spark, d):
    folder = shared_folder(spark, "audit")
    B.write_audit(_audit(spark, d), f"{folder}/audit.jsonl")
    get = lambda path: F.get_json_object("value", path)
    keys = F.array_join(F.array_sort(F.json_object_keys(get("$.new_metadata"))), ",")
    number = F.size(F.from_json(get("$.new_metadata.authors"), "array<string>")).cast("long")
    lines = spark.read.text(f"{folder}/audit.jsonl")
    return lines.select(get("$.pdf_path").alias("pdf_path"), get("$.old_metadata.title").alias("old_title"), get("$.new_metadata.title").alias("new_title"), F.when(number >= 0, number).alias("n_authors"), get("$.new_metadata.year").cast("int").alias("new_year"), F.nullif(keys, F.lit("")).alias("new_keys"))


@query("SELECT DISTINCT 'in/' || filename AS path, 'in/' || filename || '.bak' AS backup, 'cp -p in/' || filename || ' in/' || filename || '.bak' AS command FROM ingest_log WHERE filename IS NOT NULL")
def q_backup_plan(spark, d):
    files = table(spark, d, "ingest_log").filter("filename is not null").select(F.concat(F.lit("in/"), "filename").alias("path")).distinct()
    return M.backup_plan(files).withColumn("command", F.array_join("command", " "))


@query(r"""
SELECT log_id, 'in/' || regexp_replace(filename, '(.)\.[^./]*$', '\1') || '.error.txt' AS path, 'PDF: ' || filename || chr(10) || 'Time: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(10) || 'Error: ' || coalesce(doi, '') || chr(10) || chr(10) || 'Traceback:' || chr(10) || coalesce(slug, '') AS body FROM ingest_log WHERE filename IS NOT NULL
""")
def q_error_records(spark, d):
    failed = table(spark, d, "ingest_log").filter("filename is not null")
    record = M.error_record(F.concat(F.lit("in/"), "filename"), F.col("ts"), F.col("doi"), F.col("slug"))
    return failed.select("log_id", record.alias("e")).select("log_id", "e.path", "e.body")


@query(r"""
WITH f AS (SELECT bundle_id AS id, CASE WHEN bundle_id % 3 = 0 THEN 's41586-020-' || lpad((bundle_id % 9999)::VARCHAR, 4, '0') || '-1' ELSE replace(doi, '/', '_') END AS stem, 'doi:' || upper(doi) AS identifier, doi || ', x' AS keywords, journal AS subject, CASE WHEN bundle_id % 2 = 0 THEN doi END AS internal FROM papers),
c AS (SELECT id, 0 AS pos, nullif(regexp_extract(identifier, '(?i)(?:doi:)?(10\.\d{4,}/[^\s<>"},]+)', 1), '') AS doi, 'existing_tags' AS provenance FROM f UNION ALL SELECT id, 1, nullif(regexp_extract(keywords, '(?i)(?:doi:)?(10\.\d{4,}/[^\s<>"},]+)', 1), ''), 'existing_tags' FROM f
 UNION ALL SELECT id, 2, nullif(regexp_extract(subject, '(?i)(?:doi:)?(10\.\d{4,}/[^\s<>"},]+)', 1), ''), 'existing_tags' FROM f UNION ALL SELECT id, 3, internal, 'internal' FROM f
 UNION ALL SELECT id, 4, CASE WHEN starts_with(stem, 's41586') THEN '10.1038/' || stem WHEN regexp_matches(stem, '^10\.\d{4,}[_-]\S+$') THEN regexp_replace(stem, '^(10\.\d{4,})[_-](\S+)$', '\1/\2') END, 'filename' FROM f),
n AS (SELECT id, pos, regexp_replace(lower(trim(doi)), '^doi:', '') AS doi, provenance FROM c)
SELECT * FROM n WHERE regexp_matches(doi, '^10\.\d{4,}/[^\s<>"}]+$')
""")
def q_doi_candidates(spark, d):
    b = F.col("bundle_id")
    stem = F.when(b % 3 == 0, F.concat(F.lit("s41586-020-"), F.lpad((b % 9999).cast("string"), 4, "0"), F.lit("-1"))).otherwise(F.replace("doi", F.lit("/"), F.lit("_")))
    files = _papers(spark, d).select(b.alias("id"), stem.alias("stem"), F.concat(F.lit("doi:"), F.upper("doi")).alias("identifier"), F.concat("doi", F.lit(", x")).alias("keywords"), F.col("journal").alias("subject"), F.when(b % 2 == 0, F.col("doi")).alias("internal"))
    return R.doi_candidates(files)


@query("""
SELECT bundle_id, abstract AS paper_summary, CASE WHEN bundle_id % 3 = 0 THEN 'rake=' || coalesce(title, '') WHEN abstract <> '' THEN 'llm:unknown=' || abstract END AS entries FROM papers
""")
def q_migrate_meta(spark, d):
    made = F.when(F.col("bundle_id") % 3 == 0, F.create_map(F.lit("rake"), F.coalesce("title", F.lit("")))).when(F.col("bundle_id") % 3 == 1, F.create_map().cast("map<string,string>"))
    meta = _papers(spark, d).select("bundle_id", F.struct(F.col("abstract").alias("paper_summary"), made.alias("paper_summaries")).alias("m")).select("bundle_id", E.migrate_meta(F.col("m")).alias("m"))
    again = meta.select("bundle_id", E.migrate_meta(F.col("m")).alias("m"))
    entries = F.array_join(F.transform(F.map_entries("m.paper_summaries"), lambda e: F.concat(e.key, F.lit("="), e.value)), "|")
    return again.select("bundle_id", "m.paper_summary", F.nullif(entries, F.lit("")).alias("entries"))


# --- summaries and embeddings -------------------------------------------------------------------------------------------------------------


@query("""
SELECT block_id, summaries IS NULL AS migrated, CASE WHEN summaries IS NOT NULL THEN summary END AS summary,
 CASE WHEN summaries IS NULL THEN CASE WHEN summary <> '' THEN 'llm:unknown=' || summary ELSE '' END ELSE array_to_string(list_sort(list_transform(map_entries(summaries), lambda e: e.key || '=' || coalesce(e.value, 'NULL'))), '|') END AS entries FROM blocks
""")
def q_migrate_summaries(spark, d):
    m = E.migrate_summaries(_blocks(spark, d).select("block_id", "summary", "summaries"))
    entries = F.array_sort(F.transform(F.map_entries("summaries"), lambda e: F.concat(e.key, F.lit("="), F.coalesce(e.value, F.lit("NULL")))))
    return m.select("block_id", "migrated", "summary", F.array_join(entries, "|").alias("entries"))


@query("SELECT block_id, coalesce(list_contains(map_keys(embeddings), 'mini16'), false) AS removed, CASE WHEN embeddings IS NOT NULL THEN array_to_string(list_sort(list_filter(map_keys(embeddings), lambda k: k <> 'mini16')), ',') END AS profiles FROM blocks")
def q_strip_profile(spark, d):
    return E.strip_profile(_blocks(spark, d).select("block_id", "embeddings"), "mini16").select("block_id", "removed", F.array_join(F.array_sort(F.map_keys("embeddings")), ",").alias("profiles"))


@query("SELECT paper_id, bool_or(coalesce(len(list_filter(map_keys(summaries), lambda k: starts_with(k, 'llm:'))) > 0, false)) AS has_model FROM blocks GROUP BY 1")
def q_has_summaries(spark, d):
    return _blocks(spark, d).groupBy("paper_id").agg(F.bool_or(E.has_model_summary(F.col("summaries"))).alias("has_model"))


@query(f"""
SELECT block_id, NOT coalesce(type IN ('section_header', 'title', 'author', 'equation', 'junk'), false) AND length({_STRIP("coalesce(text, '')")}) >= 50 AS summarise, NOT coalesce(type IN ('section_header', 'title', 'author', 'equation', 'junk'), false) AND {_STRIP("coalesce(text, '')")} <> '' AS embed FROM blocks
""")
def q_eligible(spark, d):
    t, x = F.col("type"), F.col("text")
    return _blocks(spark, d).select("block_id", E.summary_eligible(t, x).alias("summarise"), E.embed_eligible(t, x).alias("embed"))


@query("""
WITH h AS (SELECT vec_id, list_transform(embedding[1:16], lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS first, round(v[16] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS last FROM h
""")
def q_truncate_unit(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", E.truncate_unit(F.col("embedding"), 16).alias("v"))
    return v.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(15)), 6).alias("last"))


_SUMMARISED = f"NOT coalesce(type IN ('section_header', 'title', 'author', 'equation', 'junk'), false) AND length({_STRIP("coalesce(text, '')")}) >= 50"


@query(f"""
WITH {Q.key_phrases(f"SELECT block_id AS id, text AS t FROM blocks WHERE {_SUMMARISED}", E.STOP_WORDS)}
SELECT block_id, CASE WHEN {_SUMMARISED} THEN coalesce(best.phrases, '') ELSE summaries['rake'] END AS rake FROM blocks LEFT JOIN best ON blocks.block_id = best.id
""")
def q_keyword_summaries(spark, d):
    return E.add_keywords(_blocks(spark, d).select("block_id", "type", "text", "summaries")).select("block_id", F.col("summaries")["rake"].alias("rake"))


@query(rf"""
WITH w AS (SELECT block_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w FROM blocks WHERE NOT coalesce(type IN ('section_header', 'title', 'author', 'equation', 'junk'), false) AND {_STRIP("coalesce(text, '')")} <> ''),
h AS (SELECT block_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM w),
v AS (SELECT block_id, list_transform(range(0, 8), lambda j: 0) AS z, sum(CASE WHEN h % 8 = 0 THEN CASE WHEN h >= 9223372036854775808 THEN 1 ELSE -1 END ELSE 0 END) AS d0, {", ".join(f"sum(CASE WHEN h % 8 = {j} THEN CASE WHEN h >= 9223372036854775808 THEN 1 ELSE -1 END ELSE 0 END) AS d{j}" for j in range(1, 8))} FROM h GROUP BY 1),
n AS (SELECT block_id, [{", ".join(f"d{j}::DOUBLE" for j in range(8))}] AS d FROM v)
SELECT b.block_id, round(n.d[1] / nullif(sqrt(list_sum(list_transform(n.d, lambda x: x * x))), 0), 3) AS first, round(n.d[8] / nullif(sqrt(list_sum(list_transform(n.d, lambda x: x * x))), 0), 3) AS last FROM blocks b JOIN n ON b.block_id = n.block_id
""")
def q_embeddings(spark, d):
    v = E.add_embeddings(_blocks(spark, d).select("block_id", "type", "text", "embeddings"), "hash8", 8).select("block_id", F.col("embeddings")["hash8"].alias("v"))
    some = v.filter(F.exists("v", lambda x: x != 0) | F.col("v").isNotNull()).filter("v is not null")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    at = lambda i: F.when(length > 0, F.round(F.get("v", F.lit(i)).cast("double"), 3))
    return some.select("block_id", at(0).alias("first"), at(7).alias("last"))


def _echo(prompt: str) -> str:
    """A model whose answer shows its context: the first word of the text behind the first word of the previous answer."""
    lines = prompt.split("\n")
    previous = next((x[10:] for x in lines if x.startswith("Previous: ")), "")
    text = next((x for x in lines if not x.startswith(("Title: ", "Previous: "))), "")
    return f"{text.split(' ')[0]}<{previous.split('<')[0]}"


@query(f"""
WITH e AS (SELECT paper_id, block_id, pos, string_split(string_split(substr(text, 1, 2000), chr(10))[1], ' ')[1] AS w FROM blocks WHERE NOT coalesce(type IN ('section_header', 'title', 'author', 'equation', 'junk'), false) AND length({_STRIP("coalesce(text, '')")}) >= 50)
SELECT paper_id, block_id, w || '<' || coalesce(string_split(lag(w) OVER (PARTITION BY paper_id ORDER BY pos, block_id), '<')[1], '') AS summary FROM e
""")
def q_summary_context(spark, d):
    titles = M.latest(_papers(spark, d), "paper_id", "bundle_id").select("paper_id", F.replace("title", F.lit("\n"), F.lit(" ")).alias("title"))
    return E.rolling_summaries(_blocks(spark, d).join(titles, "paper_id", "left"), _echo)


@query("""
WITH s AS (SELECT paper_id, pos, block_id, summaries['rake'] AS r FROM blocks WHERE summaries['rake'] <> '')
SELECT paper_id, substr(string_agg('- ' || r, chr(10) ORDER BY pos, block_id), 1, 4000) AS digest FROM s GROUP BY 1
""")
def q_paper_digest(spark, d):
    return E.paper_digest(_blocks(spark, d))


# --- bundles and streams ------------------------------------------------------------------------------------------------------------------------


@query("SELECT paper_id, count(*)::BIGINT AS n_blocks, sum(length(coalesce(text, '')))::BIGINT AS n_chars FROM blocks GROUP BY 1")
def q_bundle_roundtrip(spark, d):
    folder = shared_folder(spark, "bundles")
    papers = M.latest(_papers(spark, d), "paper_id", "bundle_id")
    made = B.assemble(papers, _blocks(spark, d))
    B.write_bundles(made.select(F.sha2("paper_id", 256).alias("name"), "json"), folder)
    back = B.read_bundles(spark, folder).filter("error is null and size(blocks) > 0")
    return back.select("header.paper_id", F.size("blocks").cast("long").alias("n_blocks"), F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + F.length(F.coalesce(b.text, F.lit("")))).alias("n_chars"))


@query("SELECT CASE WHEN new THEN 'new' ELSE 'duplicate' END AS kind, doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS new FROM documents WHERE text IS NOT NULL)")
def q_stream_dedup(spark, d):
    out = shared_folder(spark, "stream")
    source = table(spark, d, "documents")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/documents.parquet" if os.path.isdir(f"{d}/documents.parquet") else f"{d}/documents.parquet*").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))
    run = W.ingest(stream, seen_path=f"{out}/seen", new_path=f"{out}/new", duplicate_path=f"{out}/duplicates", checkpoint=f"{out}/checkpoint", key="digest", order=["doc_id"])
    run.awaitTermination()
    return spark.read.parquet(f"{out}/new").select(F.lit("new").alias("kind"), "doc_id").unionByName(spark.read.parquet(f"{out}/duplicates").select(F.lit("duplicate").alias("kind"), "doc_id"))


@query("""
WITH s AS (SELECT log_id, filename, row_number() OVER (PARTITION BY filename ORDER BY log_id) > 1 AS seen FROM ingest_log WHERE filename IS NOT NULL)
SELECT log_id, CASE WHEN seen THEN 'errors/duplicates' WHEN log_id % 9 <> 0 THEN 'completed' ELSE 'errors' END AS folder FROM s
""")
def q_route(spark, d):
    logs = table(spark, d, "ingest_log").filter("filename is not null").select("log_id", "filename")
    first = logs.groupBy("filename").agg(F.min("log_id").alias("first"))
    return logs.join(first, "filename").select("log_id", W.route(F.when(F.col("log_id") % 9 != 0, "ok").otherwise("failed"), F.col("log_id") != F.col("first")).alias("folder"))


@query("""
WITH l AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY bundle_id DESC) = 1) SELECT type, count(*)::BIGINT AS n FROM blocks b JOIN l ON b.paper_id = l.paper_id WHERE l.verified GROUP BY 1
""")
def q_types_of_verified(spark, d):
    good = M.latest(_papers(spark, d), "paper_id", "bundle_id").filter("verified").select("paper_id")
    return _blocks(spark, d).join(good, "paper_id", "left_semi").groupBy("type").agg(F.count("*").alias("n"))


# --- pipelines ------------------------------------------------------------------------------------------------------------------------------------


@query()
def q_extract(spark, d):
    # Every document gets a figure with its caption, and a table of contents of its first words and of the figure.
    figure = F.lit("\n\n![plot](fig/one.png)\n\nFig. 1: A plot of it.")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.concat("text", figure).alias("markdown"))
    starts = docs.filter("markdown is not null").select("paper_id", F.explode(F.array(F.struct(F.lit(0).alias("toc_pos"), F.substring("markdown", 1, 20).alias("title"), F.lit(1).alias("page_id")), F.struct(F.lit(1).alias("toc_pos"), F.lit("![plot](fig/one.png)").alias("title"), F.lit(7).alias("page_id")))).alias("t"))
    totals = docs.select("paper_id", F.lit(5).alias("total_pages"))
    images = docs.select(F.col("paper_id").alias("doc_id"), F.lit(0).alias("image_pos"), F.lit("one.png").alias("name"))
    got = P.extract_blocks(docs, starts.select("paper_id", "t.*"), totals, images)
    return got.select("paper_id", "node_id", "page", "type", "text", F.coalesce(F.get("section_path", F.lit(0)), F.lit("")).alias("section"), "image")


@query()
def q_extract_pages(spark, d):
    pages = table(spark, d, "documents").filter("paper_id is not null").select("paper_id", F.col("doc_id").alias("page"), "text")
    return P.extract_pages(pages).select("paper_id", "page", "node_id", "type", "text")


@query()
def q_enrich(spark, d):
    out = P.enrich_blocks(_blocks(spark, d).select("paper_id", "pos", "block_id", "type", "text", "embeddings", "summaries"), {"hash8": 8}, model=E.stub_model)
    return out.select("block_id", F.col("summaries")["rake"].alias("rake"), F.col("summaries")["llm:stub"].alias("said"), F.size(F.col("embeddings")["hash8"]).alias("dim"))


@query("""
WITH f AS (SELECT bundle_id, 'p/' || bundle_id || '.pdf' AS path, pdf_hash FROM papers WHERE pdf_hash IS NOT NULL),
s AS (SELECT pdf_hash, min(slug) AS shared_slug FROM papers WHERE CASE WHEN bundle_id % 2 = 0 THEN pdf_hash ELSE 'other-' || pdf_hash END = pdf_hash AND trim(coalesce(title, ''), ' ' || chr(9) || chr(10) || chr(160)) <> '' AND pdf_hash IS NOT NULL GROUP BY 1)
SELECT f.path, s.shared_slug IS NOT NULL AS short_way FROM f LEFT JOIN s ON f.pdf_hash = s.pdf_hash
""")
def q_shared_bundles(spark, d):
    p = _papers(spark, d).filter("pdf_hash is not null")
    # Every file has a bundle beside it; every second one is of another file.
    hashes = F.array(F.when(F.col("bundle_id") % 2 == 0, F.col("pdf_hash")).otherwise(F.concat(F.lit("other-"), "pdf_hash")))
    shared = p.select("pdf_hash", hashes.alias("hashes"), "title", "slug").filter(P.shared_bundle_valid(F.col("pdf_hash"), F.col("hashes"), F.col("title"))).select("pdf_hash").distinct().withColumn("yes", F.lit(True))
    return p.join(shared, "pdf_hash", "left").select(F.concat(F.lit("p/"), F.col("bundle_id").cast("string"), F.lit(".pdf")).alias("path"), F.col("yes").isNotNull().alias("short_way"))


_GATE = f"""
CASE WHEN verified IS NULL AND title IS NULL THEN 'no metadata' WHEN NOT coalesce(verified, false) THEN 'unverified' || CASE WHEN len(verify_warnings) > 0 THEN ': ' || array_to_string(verify_warnings, '; ') ELSE '' END
 WHEN unknown AND (t = '' OR t = 'untitled' OR starts_with(t, 'pii:') OR starts_with(t, 'pii ') OR length(t) < 5) THEN 'garbage title' WHEN unknown AND starts_with(coalesce(slug, ''), 'anon') THEN 'anonymous' END
"""


@query(f"""
WITH a AS (SELECT *, lower({_STRIP("coalesce(title, '')")}) AS t, coalesce(doi, '') = '' AND coalesce(arxiv_id, '') = '' AND coalesce(s2_id, '') = '' AS unknown FROM papers WHERE pdf_hash IS NOT NULL),
h AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY pdf_hash ORDER BY bundle_id) = 1),
s AS (SELECT pdf_hash, min(slug) AS shared_slug FROM papers WHERE pdf_hash IS NOT NULL AND bundle_id % 3 = 0 AND {_STRIP("coalesce(title, '')")} <> '' GROUP BY 1),
j AS (SELECT a.bundle_id, s.shared_slug, h.slug, CASE WHEN s.shared_slug IS NULL THEN h.gate END AS reason FROM a LEFT JOIN s ON a.pdf_hash = s.pdf_hash LEFT JOIN (SELECT pdf_hash, slug, {_GATE} AS gate FROM h) h ON a.pdf_hash = h.pdf_hash)
SELECT 'p/' || bundle_id || '.pdf' AS path, CASE WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS status, reason, coalesce(shared_slug, slug) AS slug FROM j
""")
def q_ingest_results(spark, d):
    p = _papers(spark, d).filter("pdf_hash is not null")
    files = p.select(F.concat(F.lit("p/"), F.col("bundle_id").cast("string"), F.lit(".pdf")).alias("path"), "pdf_hash")
    # Every file has a bundle beside it; two in three are of another file.
    hashes = F.array(F.when(F.col("bundle_id") % 3 == 0, F.col("pdf_hash")).otherwise(F.concat(F.lit("other-"), "pdf_hash")))
    shared = p.select("pdf_hash", hashes.alias("hashes"), "title", "slug")
    first = p.groupBy("pdf_hash").agg(F.min_by(F.struct(*[c for c in p.columns if c != "pdf_hash"]), "bundle_id").alias("r")).select("pdf_hash", "r.*")
    return P.ingest_results(files, first.select("pdf_hash", "verified", "verify_warnings", "doi", "arxiv_id", "s2_id", "title", "slug"), shared)


_TAG_ARGS = """
array_to_string(list_filter(list_concat(['-Title=' || nullif(title, ''), '-Author=' || nullif(array_to_string(ns, '; '), ''), '-Subject=' || nullif(concat_ws(', ', nullif(journal, ''), year::VARCHAR), ''),
 '-Keywords=' || nullif(array_to_string(list_concat(list_filter([nullif(doi, '')], lambda x: x IS NOT NULL), list_filter(coalesce(keywords, []), lambda x: x <> '' AND x <> coalesce(doi, ''))), ', '), ''), '-XMP-dc:Identifier=doi:' || nullif(doi, '')],
 list_transform(ns, lambda x: '-XMP-dc:Creator=' || x), ['-XMP-dc:Date=' || year::VARCHAR, '-XMP-dc:Title=' || nullif(title, ''), '-XMP-dc:Description=' || substr(nullif(abstract, ''), 1, 2000)]), lambda x: x IS NOT NULL), ' ')
"""


@query(f"""
WITH a AS (SELECT *, 'p/' || bundle_id || '.pdf' AS path, list_filter(list_transform(coalesce(authors, []), lambda x: x.name), lambda x: x IS NOT NULL AND x <> '') AS ns, list_filter(list_transform(coalesce(authors, []), lambda x: x.name), lambda x: x IS NOT NULL) AS every,
 CASE WHEN bundle_id % 2 = 0 THEN coalesce('doi:' || doi, '') ELSE '' END AS oi, CASE WHEN bundle_id % 2 = 0 THEN coalesce(doi, '') ELSE '' END AS ok, CASE WHEN bundle_id % 2 = 0 THEN coalesce(title, '') ELSE '' END AS ot, CASE WHEN bundle_id % 2 = 0 THEN 'x' ELSE '' END AS oa FROM papers),
b AS (SELECT *, CASE WHEN coalesce(doi, '') <> '' AND NOT contains(lower(oi), 'doi:' || lower(doi)) AND NOT contains(lower(ok), lower(doi)) THEN 'doi missing' WHEN coalesce(title, '') <> '' AND length(ot) < 10 THEN 'title missing' WHEN array_to_string(every, '; ') <> '' AND oa = '' THEN 'author missing' ELSE 'up to date' END AS message FROM a)
SELECT path AS pdf_path, message <> 'up to date' AS updated, message, ot AS old_title, coalesce(title, '') AS new_title, CASE WHEN message <> 'up to date' THEN 'cp -p ' || path || ' ' || path || '.bak; exiftool -overwrite_original -P ' || CASE WHEN {_TAG_ARGS} <> '' THEN {_TAG_ARGS} || ' ' ELSE '' END || path END AS steps FROM b
""")
def q_tag_updates(spark, d):
    p = _papers(spark, d).select(F.concat(F.lit("p/"), F.col("bundle_id").cast("string"), F.lit(".pdf")).alias("path"), "bundle_id", "title", F.col("authors.name").alias("authors"), "doi", "year", "journal", "abstract", "keywords")
    # Every file has a row of old tags; in every second one they are null.
    tagged = lambda c: F.when(F.col("bundle_id") % 2 == 0, c)
    old = p.select("path", tagged(F.concat(F.lit("doi:"), "doi")).alias("identifier"), tagged(F.col("doi")).alias("keywords"), tagged(F.col("title")).alias("title"), tagged(F.lit("x")).alias("author"))
    return P.tag_updates(p.drop("bundle_id"), old).select("pdf_path", "updated", "message", "old_title", "new_title", F.array_join(F.transform("steps", lambda x: F.array_join(x, " ")), "; ").alias("steps"))


@query("SELECT source AS key, count(*)::BIGINT AS n FROM documents d WHERE sha256(coalesce(text, '')) NOT IN (SELECT sha256(coalesce(text, '')) FROM documents WHERE source = 'publisher_feed') GROUP BY 1")
def q_skip_existing(spark, d):
    files = table(spark, d, "documents").select("source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("pdf_hash"))
    return P.skip_existing(files, files.filter("source = 'publisher_feed'")).groupBy(F.col("source").alias("key")).agg(F.count("*").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
