"""Parts of the SQL of the queries: what the operators do, written a second time for an engine without them.

Text is cut by a recursive query, one level of separators for each step; folds over lists stand for loops.
"""

from __future__ import annotations

# White space as Python and Spark's (?U) see it, for RE2; the characters of it alone; and word characters.
WS_CHARS = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_CHARS}]"
WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    """Lower case without white space."""
    return f"regexp_replace(lower(coalesce({x}, '')), '{WS}+', '', 'g')"


def _kept(held: str, room: str) -> str:
    """How many pieces at the end of ``held`` have ``room`` characters together."""
    return f"coalesce(len(list_filter(list_transform(range(1, len({held}) + 1), lambda k: list_sum(list_transform({held}[len({held}) - k + 1:], lambda y: length(y)))), lambda z: z <= {room})), 0)"


def split_text(source: str) -> str:
    """The common table ``cut`` of a recursive query: the chunks of ``source`` (id, t, size, overlap) are its rows without
    ``more``, in the order of ``path``."""
    start = "{'o': []::VARCHAR[], 'h': []::VARCHAR[], 'n': 0::BIGINT, 'p': ''}"
    piece = "{'o': []::VARCHAR[], 'h': []::VARCHAR[], 'n': 0::BIGINT, 'p': x}"
    tail = f"s.h[len(s.h) - {_kept('s.h', 'overlap')} + 1:]"
    separators = f"[{NL} || {NL}, {NL}, '. ', ', ', ' ', '']"
    pieces = lambda sep: f"list_filter(list_transform(string_split(t, {sep}), lambda x, i: CASE WHEN i = 1 THEN x ELSE {sep} || x END), lambda x: x <> '')"
    return f"""RECURSIVE src AS ({source}),
cut AS (
  SELECT id, [0]::INT[] AS path, t, size, overlap, 1 AS level, length(t) > size AS more FROM src
  UNION ALL
  SELECT id, list_append(path, i), g, size, overlap, level, length(g) > size AND level <= 5 FROM (
    SELECT id, path, size, overlap, lv + 1 AS level, unnest(groups) AS g, generate_subscripts(groups, 1)::INT AS i FROM (
      SELECT id, path, size, overlap, lv, CASE WHEN lv = 6 THEN [t] ELSE list_filter(list_append(z.o, array_to_string(z.h, '')), lambda x: {strip("x")} <> '') END AS groups FROM (
        SELECT *, list_reduce(list_prepend({start}, list_transform({pieces("sep")}, lambda x: {piece})),
          lambda s, x: CASE WHEN len(s.h) > 0 AND s.n + length(x.p) > size
            THEN {{'o': list_append(s.o, array_to_string(s.h, '')), 'h': list_append({tail}, x.p), 'n': length(array_to_string({tail}, '')) + length(x.p), 'p': ''}}
            ELSE {{'o': s.o, 'h': list_append(s.h, x.p), 'n': s.n + length(x.p), 'p': ''}} END) AS z
        FROM (SELECT *, {separators}[lv] AS sep FROM (SELECT *, coalesce(list_min(list_filter(range(level, 6), lambda k: len({pieces(separators + "[k]")}) > 1)), 6) AS lv FROM cut WHERE more)))))
)"""


def split_table(source: str) -> str:
    """(id, chunks) of the tables of ``source`` (id, t, size): groups of rows, each with its header."""
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
    rule = rf"^\|?{WS}*:?-{{2,}}:?{WS}*(?:\|{WS}*:?-{{2,}}:?{WS}*)+\|?$"
    start = "{'g': []::VARCHAR[][], 'n': 0::BIGINT, 'r': ''}"
    return f"""
SELECT id, CASE WHEN length(t) <= size OR len(ls) <= 1 THEN [{strip("t")}] ELSE list_transform(z.g, lambda g: head || {NL} || array_to_string(g, {NL})) END AS chunks FROM (
  SELECT *, list_reduce(list_prepend({start}, list_transform(ls[top + 1:], lambda x: {{'g': []::VARCHAR[][], 'n': 0::BIGINT, 'r': x}})),
    lambda s, x: CASE WHEN len(s.g) = 0 OR length(x.r) + 1 > s.n THEN {{'g': list_append(s.g, [x.r]), 'n': size - length(head) - 1 - length(x.r) - 1, 'r': ''}}
      ELSE {{'g': list_append(s.g[:len(s.g) - 1], list_append(s.g[len(s.g)], x.r)), 'n': s.n - length(x.r) - 1, 'r': ''}} END) AS z
  FROM (SELECT *, array_to_string(ls[:top], {NL}) AS head FROM (SELECT *, CASE WHEN regexp_matches({strip("ls[2]")}, '{rule}') THEN 2 ELSE 1 END AS top FROM (SELECT *, string_split_regex({strip("t")}, '{breaks}') AS ls FROM ({source})))))
"""


def authors(x: str) -> str:
    """Names on the first line of an author block, or null."""
    noise = [("<sup>[^<]*</sup>", ""), (r"\*+", ""), ("[†‡§¶∗⊥#]", ""), (rf"({WORD})\p{{Nd}}+(?:,\p{{Nd}}+)*", r"\1"), (r"\b\p{Nd}+\b", ""), (rf"[^{WS_CHARS}]+@[^{WS_CHARS}]+", ""), (f"^(?i){WS}*and{WS}+", "")]
    for pattern, by in noise:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    names = f"list_filter(list_transform(string_split_regex({strip(f'string_split({x}, {NL})[1]')}, '[;,]|\\band\\b'), lambda p: {strip('p')}), lambda p: length(p) > 2 AND regexp_matches(p, '^[A-ZÀ-ɏ]'))"
    return f"(CASE WHEN len({names}) > 0 THEN ({names})[1:10] END)"


def title_lines(x: str) -> str:
    """{rest: lines behind identifiers, z: the state of the fold over them} of a block in which title and authors run together."""
    lines = f"string_split({x}, {NL})"
    skipped = f"coalesce(list_position(list_transform({lines}, lambda l: NOT regexp_matches({strip('l')}, '^arXiv:\\d')), true) - 1, len({lines}))"
    rest = f"{lines}[{skipped} + 1:]"
    some, blank = "len(s.t) > 0", "x.l = ''"
    heading = rf"(regexp_matches(lower(x.l), '^(abstract|contents)') OR regexp_matches(x.l, '^\p{{Nd}}{{1,2}}(?:st|nd|rd|th)?{WS}+{WORD}+{WS}+\p{{Nd}}{{4}}'))"
    people = rf"(regexp_matches(x.l, '[†‡§¶∗⊥#]|\p{{Nd}}+[,∗]') OR (length(x.l) - length(replace(x.l, ',', '')) >= 2 AND regexp_matches(x.l, '[A-Z]\.{WS}')))"
    stop = f"({heading} OR ({people} AND {some}) OR (NOT (length(x.l) < 200 AND NOT ends_with(x.l, '.')) AND {some} AND NOT {people}))"
    take = f"(NOT s.d AND NOT {blank} AND NOT {stop})"
    title = f"(CASE WHEN {take} THEN list_append(s.t, x.l) ELSE s.t END)"
    ends = f"(NOT s.d AND (({blank} AND {some}) OR (NOT {blank} AND {stop}) OR ({take} AND len({title}) >= 3)))"
    at = f"CASE WHEN NOT s.d AND NOT {blank} AND {stop} THEN s.i WHEN {ends} THEN s.i + 1 ELSE s.a END"
    state = "{'t': []::VARCHAR[], 'i': 0::BIGINT, 'a': NULL::BIGINT, 'd': false, 'l': %s}"
    fold = f"list_reduce(list_prepend({state.replace('%s', repr(''))}, list_transform({rest}, lambda l: {state.replace('%s', strip('l'))})), lambda s, x: {{'t': {title}, 'i': s.i + 1, 'a': {at}, 'd': s.d OR {ends}, 'l': ''}})"
    return f"{{'rest': {rest}, 'z': {fold}}}"


def title_of(state: str) -> str:
    return f"(CASE WHEN len({state}.z.t) > 0 THEN substr(array_to_string({state}.z.t, ' '), 1, 300) END)"


def authors_of(state: str) -> str:
    below = f"array_to_string({state}.rest[{state}.z.a + 1:{state}.z.a + 3], {NL})"
    return f"(CASE WHEN len({state}.z.t) > 0 AND {state}.z.a < len({state}.rest) THEN {authors(below)} END)"


def levenshtein(a: str, b: str) -> str:
    """The edit distance by code points, row by row."""
    chars = f"list_transform(range(1, length({a}) + 1), lambda k: {{'r': []::BIGINT[], 'c': substr({a}, k::BIGINT, 1)}})"
    row = f"list_reduce(list_prepend([s.r[1] + 1], list_transform(range(1, length({b}) + 1), lambda j: [j])), lambda done, cell: list_append(done, least(done[len(done)] + 1, s.r[cell[1] + 1] + 1, s.r[cell[1]] + (substr({b}, cell[1], 1) <> above.c)::BIGINT)))"
    table = f"list_reduce(list_prepend({{'r': range(0, length({b}) + 1), 'c': ''}}, {chars}), lambda s, above: {{'r': {row}, 'c': ''}})"
    return f"({table}).r[length({b}) + 1]"


def plain(x: str) -> str:
    """Compatibility decomposition without what is beyond ASCII."""
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("²", "2"), ("³", "3"), ("¹", "1"), ("½", "12"), ("¼", "14"), ("¾", "34"), ("…", "..."), ("™", "TM"), ("º", "o"), ("ª", "a")):
        x = f"replace({x}, '{a}', '{b}')"
    x = rf"regexp_replace({x}, '[\xa0\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]', ' ', 'g')"
    # Full-width forms stand a fixed distance above ASCII.
    wide = f"array_to_string(list_transform(string_split({x}, ''), lambda c: CASE WHEN c BETWEEN '！' AND '～' THEN chr(unicode(c) - 65248) ELSE c END), '')"
    return rf"regexp_replace(strip_accents({wide}), '[^\x00-\x7f]', '', 'g')"


def slug(names: str, year: str, title: str) -> str:
    """Surname of the first author, year, first telling word of the title, in ASCII."""
    first = strip(f"string_split(coalesce({names}[1], ''), ';')[1]")
    surname = f"CASE WHEN contains({first}, ',') THEN string_split({first}, ',')[1] ELSE coalesce(list_last(string_split_regex({first}, '{WS}+')), '') END"
    letters = f"substr(regexp_replace(lower({plain(surname)}), '[^a-z]', '', 'g'), 1, 30)"
    words = f"regexp_extract_all(lower({plain(f'coalesce({title}, chr(32))')}), '[a-z0-9]+')"
    small = "'a', 'an', 'and', 'as', 'at', 'by', 'for', 'from', 'in', 'into', 'new', 'of', 'on', 'or', 'the', 'to', 'via', 'with'"
    word = f"list_filter({words}, lambda w: w NOT IN ({small}) AND regexp_matches(w, '^[a-z]'))[1]"
    return f"coalesce(nullif({letters}, ''), 'anon') || lpad(coalesce({year}, 0)::VARCHAR, 4, '0') || coalesce({word}, CASE WHEN {strip(f'coalesce({title}, chr(32))')} = '' THEN 'untitled' ELSE substr(sha256({title}), 1, 8) END)"


def similar(x: str, y: str) -> str:
    return f"1 - {levenshtein(x, y)}::DOUBLE / greatest(length({x}), length({y}), 1)"


def key_phrases(source: str, stop_words: frozenset[str]) -> str:
    """(id, phrases) of ``source`` (id, t): the five best key phrases of each text, by degree over frequency of their words."""
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(stop_words))
    words = f"list_filter(string_split_regex(p, '{WS}+'), lambda w: w <> '')"
    marked = f"list_transform({words}, lambda w: CASE WHEN w IN ({stop}) OR NOT regexp_matches(w, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]') THEN '|' ELSE w END)".replace("\\\\", "\\")
    parts = f"string_split_regex(lower(t), '[^\\p{{L}}\\p{{N}}_{WS_CHARS}''’-]+|\\n')".replace("\\\\", "\\")
    return f"""
a AS (SELECT id, list_filter(list_transform(string_split(array_to_string(list_transform({parts}, lambda p: array_to_string({marked}, ' ')), ' | '), '|'), lambda x: trim(x)), lambda x: x <> '') AS ps FROM ({source})),
b AS (SELECT id, unnest(ps) AS phrase, generate_subscripts(ps, 1) AS spot FROM a),
c AS (SELECT id, spot, phrase, ws, len(ws) AS n FROM (SELECT *, string_split(phrase, ' ') AS ws FROM b)),
d AS (SELECT id, spot, phrase, n, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM c),
e AS (SELECT id, w, sum(n)::DOUBLE / count(*) AS share FROM d GROUP BY 1, 2),
f AS (SELECT id, phrase, min(spot) AS spot FROM c GROUP BY 1, 2),
g AS (SELECT f.id, f.phrase, f.spot, round(list_sum(list(e.share ORDER BY d.k)), 9) AS score FROM f JOIN d ON f.id = d.id AND f.spot = d.spot JOIN e ON d.id = e.id AND d.w = e.w GROUP BY 1, 2, 3),
best AS (SELECT id, string_agg(phrase, '; ' ORDER BY score DESC, spot) AS phrases FROM (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, spot) <= 5) GROUP BY 1)"""
