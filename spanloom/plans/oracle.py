"""The registered queries in SQL, from one chain of common table expressions in window form."""

from __future__ import annotations

from spanloom.functions.chars import ABBREVIATIONS, BRACKETS, PAIRS, PUNCTUATION, PUNCTUATION_END, QUOTES, STOP_WORDS, WORD_BREAKS, char_class
from spanloom.operators.chunking import MARGIN, PIECES, SPECIALS, stride
from spanloom.operators.tagging import MARK, PIECE


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def chain(max_tokens: int = 512, overlap_ratio: float = 0.0, min_confidence: float = 0.5) -> dict[str, str]:
    """Table expressions by name, each over those before it."""
    content = max_tokens - SPECIALS
    step = content - stride(max_tokens, overlap_ratio)
    out: dict[str, str] = {}
    out["doc"] = "SELECT doc_id, text FROM documents WHERE text IS NOT NULL"
    out["piece"] = f"SELECT doc_id, unnest(l) AS word, unnest(range(len(l))) AS n FROM (SELECT doc_id, regexp_extract_all(text, '{PIECES}') AS l FROM doc)"
    out["placed"] = "SELECT doc_id, word, n, (sum(length(word)) OVER (PARTITION BY doc_id ORDER BY n))::INT AS stop FROM piece"
    out["token"] = "SELECT doc_id, word, (stop - length(word))::INT AS start, stop AS \"end\", (row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1)::INT AS tok FROM placed WHERE NOT regexp_matches(word, '^\\s')"
    out["total"] = f"SELECT doc.doc_id, doc.text, (greatest(ceil((count(tok) - {content}) / {float(step)}), 0) + 1)::INT AS total_chunks FROM doc LEFT JOIN token USING (doc_id) GROUP BY doc.doc_id, doc.text"
    out["cell"] = "SELECT doc_id, text AS document, total_chunks, unnest(range(total_chunks))::INT AS chunk_id FROM total"
    out["inside"] = f"SELECT c.doc_id, c.chunk_id, t.word, t.start, t.\"end\", t.tok FROM cell c JOIN token t ON t.doc_id = c.doc_id AND t.tok >= c.chunk_id * {step} AND t.tok < c.chunk_id * {step} + {content}"
    out["chunk"] = f"""SELECT c.doc_id, c.chunk_id, c.total_chunks, coalesce(min(i.start), 0)::INT AS global_start, coalesce(max(i."end"), 0)::INT AS global_end, (count(i.tok) + {SPECIALS})::INT AS token_count,
      substring(c.document, coalesce(min(i.start), 0) + 1, coalesce(max(i."end") - min(i.start), 0)) AS text, c.document
      FROM cell c LEFT JOIN inside i USING (doc_id, chunk_id) GROUP BY c.doc_id, c.chunk_id, c.total_chunks, c.document"""
    out["cap"] = """SELECT i.doc_id, i.chunk_id, i.word, i.tok, i.start - c.global_start AS pos, c.global_start,
      CASE WHEN regexp_matches(i.word, '^\\p{Lu}') THEN (['PER', 'LOC', 'ORG', 'DATE'])[length(i.word) % 4 + 1] END AS kind FROM inside i JOIN chunk c USING (doc_id, chunk_id)"""
    out["capped"] = "SELECT *, lag(kind) OVER (PARTITION BY doc_id, chunk_id ORDER BY tok) AS before FROM cap"
    out["part"] = f"SELECT *, unnest(range(0, length(word), {PIECE}))::INT AS k FROM capped WHERE kind IS NOT NULL"
    out["scored"] = f"""SELECT doc_id, chunk_id, global_start, pos + k AS s, substring(word, k + 1, {PIECE}) AS piece, k,
      CASE WHEN k > 0 OR coalesce(before, '') = kind THEN 'I-' ELSE 'B-' END || kind AS label FROM part"""
    out["pred"] = f"""SELECT doc_id, chunk_id, (row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY s) - 1)::INT AS idx, label, ((s * 31 + length(piece) * 17) % 1000) / 1000.0::DOUBLE AS score,
      CASE WHEN k = 0 THEN '{MARK}' ELSE '' END || piece AS word, s::INT AS start, (s + length(piece))::INT AS "end", global_start FROM scored"""
    out["kept"] = f"SELECT * REPLACE ((row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY idx) - 1)::INT AS idx) FROM pred WHERE score >= {min_confidence}"
    out["moved"] = 'SELECT * REPLACE (start + global_start AS start, "end" + global_start AS "end") FROM kept'
    out["g1"] = """SELECT *, regexp_replace(label, '^[BI]-', '') AS ty, label LIKE 'B-%' AS isb, label LIKE 'I-%' AS isi,
      lag(regexp_replace(label, '^[BI]-', '')) OVER w AS pty, lag("end") OVER w AS pe FROM moved WINDOW w AS (PARTITION BY doc_id, chunk_id ORDER BY idx)"""
    out["g2"] = "SELECT *, sum(CASE WHEN idx = 0 OR NOT isi OR ty <> pty THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, chunk_id ORDER BY idx) AS run FROM g1"
    out["g3"] = "SELECT *, first_value(label <> 'O' AND (isb OR idx = 0)) OVER (PARTITION BY doc_id, chunk_id, run ORDER BY idx) AS mem FROM g2"
    out["g4"] = "SELECT *, coalesce(lag(mem) OVER (PARTITION BY doc_id, chunk_id ORDER BY idx), false) AS pmem FROM g3"
    out["grp"] = """SELECT *, (sum(CASE WHEN mem AND NOT coalesce(pmem AND ty = pty AND (isi OR (isb AND start - pe <= 1)), false) THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id, chunk_id ORDER BY idx) - 1)::INT AS grp FROM g4"""
    out["member"] = "SELECT *, lag(\"end\") OVER (PARTITION BY doc_id, chunk_id, grp ORDER BY start, idx) AS last FROM grp WHERE mem"
    out["made"] = f"""SELECT doc_id, chunk_id, grp, string_agg(CASE WHEN start > last THEN ' ' ELSE '' END || replace(word, '{MARK}', ''), '' ORDER BY start, idx) AS text,
      CASE WHEN arg_min(ty, start) IN ('LOC', 'PER', 'ORG', 'MISC') THEN arg_min(ty, start) ELSE 'MISC' END AS type, round(min(score), 4) AS confidence,
      min(start) AS start_pos, arg_max("end", start) AS end_pos, count(*) AS n_tokens FROM member GROUP BY doc_id, chunk_id, grp"""
    out["entity"] = "SELECT *, (row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY grp) - 1)::INT AS ent_idx FROM made WHERE length(text) >= 2"
    out["context"] = f"""SELECT e.*, substring(document, greatest(start_pos - {MARGIN}, 0) + 1, least(start_pos, {MARGIN})) AS "left",
      substring(document, start_pos + 1, end_pos - start_pos) AS inside, substring(document, end_pos + 1, {MARGIN}) AS "right" FROM entity e JOIN total t USING (doc_id) JOIN (SELECT doc_id, text AS document FROM doc) USING (doc_id)"""
    breaks, quotes = char_class(WORD_BREAKS), char_class(QUOTES)
    out["x0"] = f"""SELECT *, right("left", 1) AS c1, CASE WHEN length("left") > 1 THEN substring("left", length("left") - 1, 1) ELSE '' END AS c2, left("right", 1) AS n1, right(inside, 1) AS last1,
      regexp_extract(right("left", 30), '{char_class(WORD_BREAKS, True)}*$') AS l0, regexp_extract(left("right", 30), '^{char_class(WORD_BREAKS, True)}*') AS r0, type IN ('LOC', 'PER', 'ORG') AS may FROM context"""
    out["x1"] = f"""SELECT *, regexp_matches(c1, '^\\p{{L}}$') OR (regexp_matches(c1, '^{quotes}$') AND (length("left") = 1 OR regexp_matches(c2, '^{breaks}$'))) AS okl,
      regexp_matches(n1, '^\\p{{L}}$') OR regexp_matches(n1, '^{quotes}$') AS okr FROM x0"""
    out["x2"] = f"""SELECT *, CASE WHEN NOT may THEN 'type' WHEN length(text) < 2 THEN 'length' WHEN trim(lower(text), '{MARK}') IN ({_quoted(STOP_WORDS)}) THEN 'stopword'
      WHEN type IN ('LOC', 'PER') AND okr AND regexp_matches(n1, '^\\p{{L}}$') AND NOT regexp_matches(n1, '^\\p{{Lu}}$') AND regexp_matches(last1, '^{breaks}$') THEN 'capital'
      WHEN NOT (okl OR okr) THEN 'no room' END AS reason,
      length(l0) + length(r0) > 0 AND regexp_matches(left(inside, greatest(least(length(inside), length(regexp_replace(l0 || inside || r0, '[^\\p{{L}}]+$', '')) - length(l0)), 0)), '{char_class(WORD_BREAKS.replace(" ", ""))}') AS inner_break FROM x1"""
    out["x3"] = "SELECT *, CASE WHEN inner_break THEN '' ELSE r0 END AS r1, l0 || inside || CASE WHEN inner_break THEN '' ELSE r0 END AS whole FROM x2"
    out["x4"] = """SELECT *, len(list_filter(regexp_split_to_array(whole, '\\s+'), lambda w: w <> '')) > 8 OR length(whole) / length(text)::DOUBLE > 5.0 OR regexp_matches(whole, '[.!?]') AS likely_sentence FROM x3"""
    out["x5"] = """SELECT *, reason IS NULL AS expand, CASE WHEN reason IS NOT NULL THEN NULL WHEN likely_sentence THEN 'none' WHEN length(l0) > 0 AND length(r1) > 0 THEN 'both' WHEN length(l0) > 0 THEN 'left' WHEN length(r1) > 0 THEN 'right' ELSE 'none' END AS kind,
      CASE WHEN reason IS NULL AND NOT likely_sentence THEN whole ELSE text END AS new_text FROM x4"""
    out["grown"] = """SELECT *, new_text <> text AS changed, (CASE WHEN new_text <> text THEN start_pos - length(l0) ELSE start_pos END)::INT AS new_start,
      (CASE WHEN new_text <> text THEN end_pos + length(r1) ELSE end_pos END)::INT AS new_end FROM x5"""
    return out


def with_chain(last: str, select: str, **options) -> str:
    """``select`` over the chain up to ``last``."""
    tables = chain(**options)
    names = list(tables)
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in names[: names.index(last) + 1]) + f"\n{select}"


def collapsed(text: str) -> str:
    return f"regexp_replace({text}, '[\\s\\x{{A0}}]+', ' ', 'g')"


def edges(text: str) -> str:
    dot = "chr(57344)"
    kept = f"regexp_replace({text}, '([А-ЯA-Z0-9]|(?i:г|ул|д|пр|тд|тп))\\.(\\s|$)', '\\1' || {dot} || '\\2', 'g')"
    kept = f"regexp_replace({kept}, '^{char_class(PUNCTUATION + BRACKETS)}+', '')"
    kept = f"regexp_replace(ltrim({kept}, ' '), '{char_class(PUNCTUATION_END + ' ')}+$', '')"
    return f"replace(trim({kept}, '-'), {dot}, '.')"


def paired(text: str) -> str:
    """The steps as a chain of scalar subqueries, so that each is computed once."""
    for n, (a, b) in enumerate(PAIRS):
        qa, qb = a.replace("'", "''"), b.replace("'", "''")
        count = lambda c: f"(length(t) - length(replace(t, '{c}', '')))"
        bare = lambda x: f"replace(replace({x}, '{qa}', ''), '{qb}', '')"  # noqa: E731, B023
        first, last = f"instr(t, '{qa}')", f"(length(t) - instr(reverse(t), '{qb}') + 1)"
        inner = f"left(t, {first}) || {bare(f'substring(t, {first} + 1, greatest({last} - {first} - 1, 0))')} || substring(t, {last})"
        text = f"(SELECT CASE WHEN {count(qa)} <> {count(qb)} THEN {bare('t')} WHEN {count(qa)} > 1 AND {first} < {last} THEN {inner} ELSE t END FROM (SELECT {text} AS t))"
    return text


# What may stand before a place's name, and near misses.
PREFIXED = (
    "", "г. ", "г.", "пос. г. ", " г. ", "ст-ца  ", "ПОС. ", "д. ", "с. п. ", "с.п. ", "п.с. ", "г.о. г.п. ", "сл.\t", "-- гп. , дер. ", "г. .,", "г. — пгт. ", "пос.: ст. * ",
)
# Strings and their compatibility forms, each ending in a blank so that what follows doesn't change.
COMPATIBILITY = (("", ""), ("Дом № 5 ", "Дом No 5 "), ("так… ", "так... "), ("a\u00a0b ", "a b "), ("½ x² ", "1⁄2 x2 "), ("ﬁn ", "fin "), ("Ⅻ ", "XII "), ("ｆｕｌｌ ", "full "), ("e\u0301 ", "é "))

# Strings with control, format, private and unassigned characters, and what stays of them.
CONTROLS = (("", ""), ("\u200bМос\u00adква ", "Москва "), ("a\u0007b\u0085c ", "abc "), ("\ufeffx\ty ", "x\ty "), ("p\ue000q\U000e0001 ", "pq "), ("\u0378z ", "z "))


def one_of(strings) -> str:
    """The string that a line gets by its number and its document's."""
    return f"([{_quoted(strings)}])[((doc_id + line) % {len(strings)}) + 1]"


def without_prefix(text: str, rounds: int = 10) -> str:
    """Place abbreviations off the start, blanks and punctuation off both ends, more often than any string here needs."""
    short = "|".join(a.replace(".", "\\.") for a in ABBREVIATIONS)
    marks, blanks = char_class(PUNCTUATION), "[\\s\\x{A0}]"
    for _ in range(rounds):
        text = f"regexp_replace({text}, '(?i)^(?:{short})({blanks}+|$)', '')"
        text = f"regexp_replace({text}, '^{blanks}+|{blanks}+$', '', 'g')"
        text = f"regexp_replace({text}, '^{marks}+|{marks}+$', '', 'g')"
    return text
