"""More queries of the document engine: first scores, proposals, metadata, layout input, formulas in texts, Word documents.

SQL texts here hold their own tables and patterns and share none with the operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import textkit as tk
from ..operators import align, docx, insertion, intake, latex, layout, learn, manuscript, metadata, score
from ..sources import io
from . import registry as r
from .md_docs import MD

add, source, QUERIES, ORACLE, NL = r.add, r.source, r.QUERIES, r.ORACLE, r.NL

# scores of the first kind, against the same truth as the unified ones
FIRST = ["formula_30", "image_20", "text_20", "structure_15", "speed_15", "of_85", "of_100"]


def _first(docs, truth):
    truth = truth.withColumns({"required": F.array(F.lit("introduction"), F.lit("Results"), F.lit("Methods")), "forbidden": F.array(F.lit("downloaded from"), F.lit("^©.*$"))})
    elapsed = F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 40 * F.lit(1.0))
    return score.score_first(docs.withColumn("paper_key", F.col("doc_id") % len(r.TRUTH_ROWS)), truth, elapsed=elapsed)


_share = lambda got, want, most: f"round(CASE WHEN {want} > 0 THEN least({got}::DOUBLE / {want}, 1.0) ELSE 1.0 END * {most}, 2)"
_has = lambda w: f"CASE WHEN len(list_filter(heads, lambda z: contains(lower(z), '{w}'))) > 0 THEN 1 ELSE 0 END"
FIRST_SQL = f"""WITH x AS ({MD}), truth AS ({r.TRUTH}), {r.FEATURES_SQL},
f0 AS (SELECT fe.*, truth.*, CASE WHEN exp_insertable > 0 THEN exp_insertable ELSE exp_inline END AS want, abs(n_images - exp_figures) AS off, CASE WHEN doc_id % 7 > 0 THEN doc_id % 40 END AS sec,
  len(regexp_extract_all(md, '(?im)downloaded from')) + len(regexp_extract_all(md, '(?im)^©.*$')) AS bad FROM fe JOIN truth ON fe.doc_id % {len(r.TRUTH_ROWS)} = truth.paper_key),
f1 AS (SELECT *, round({_share("n_inline", "want", 12)} + {_share("n_display", "exp_display", 8)} + {_share("(inline_valid + display_valid)", "(n_inline + n_display)", 6)} + greatest(0, 4 - not_decoded), 2)::DOUBLE AS formula_30,
  round(CASE off WHEN 0 THEN 14 WHEN 1 THEN 10 WHEN 2 THEN 6 ELSE greatest(0, 14 - 3 * off) END + round(least(n_captions_near::DOUBLE / greatest(exp_captions, 1), 1.0) * 6, 2), 2)::DOUBLE AS image_20,
  round(greatest(0, 5 - u_escape) + greatest(0, 4 - ligature) + greatest(0, 3 - pua / 2.0) + greatest(0, 5 - bad) + greatest(0, 3 - um_space / 2.0), 2)::DOUBLE AS text_20,
  round(round(({_has("introduction")} + {_has("results")} + {_has("methods")}) / 3.0::DOUBLE * 6, 2) + {_share("n_h2plus", "min_h2", 4)} + greatest(0, 5 - 1.5 * n_fallback), 2)::DOUBLE AS structure_15,
  (CASE WHEN sec < 12 THEN 15 WHEN sec < 17 THEN 12 WHEN sec < 22 THEN 9 WHEN sec < 27 THEN 6 WHEN sec < 35 THEN 3 WHEN sec >= 35 THEN 1 END)::DOUBLE AS speed_15 FROM f0),
f2 AS (SELECT *, round(formula_30 + image_20 + text_20 + structure_15, 2) AS of_85, round(formula_30 + image_20 + text_20 + structure_15 + speed_15, 2) AS of_100 FROM f1)
"""
for _name, _columns in (("formula", ["formula_30"]), ("image", ["image_20"]), ("text", ["text_20"]), ("structure", ["structure_15"]), ("speed", ["speed_15"]), ("sum", ["of_85", "of_100"])):
    add(f"b_first_{_name}", {"x": MD, "truth": r.TRUTH}, lambda d, t, c=_columns: _first(d, t).select("doc_id", *c))
    ORACLE[f"b_first_{_name}"] = f"{FIRST_SQL} SELECT doc_id, {', '.join(_columns)} FROM f2"
add("b_first_report", {"x": MD, "truth": r.TRUTH}, lambda d, t: score.report_first(_first(d, t)).select("doc_id", "category", "score", "total", F.col("out_of").cast("long").alias("out_of"), "bar"))
ORACLE["b_first_report"] = FIRST_SQL + ", u AS (" + " UNION ALL ".join(f"SELECT doc_id, '{c}' AS category, {c} AS score, {m} AS most, of_85, of_100 FROM f2" for c, m in (("formula_30", 30), ("image_20", 20), ("text_20", 20), ("structure_15", 15), ("speed_15", 15))) + """)
SELECT doc_id, category, score, coalesce(of_100, of_85) AS total, CAST(CASE WHEN of_100 IS NULL THEN 85 ELSE 100 END AS BIGINT) AS out_of, repeat('█', CAST(floor(score / most * 20) AS INT)) || repeat('░', 20 - CAST(floor(score / most * 20) AS INT)) AS bar FROM u WHERE score IS NOT NULL"""
add("b_unified_speed", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS sec FROM orders", lambda d: d.select("o_orderkey", score.speed_score(F.col("sec")).alias("points")), "SELECT o_orderkey, (CASE WHEN sec < 12 THEN 5 WHEN sec < 20 THEN 4 WHEN sec < 25 THEN 3 WHEN sec < 30 THEN 2 WHEN sec < 40 THEN 1 WHEN sec >= 40 THEN 0.5 END)::DOUBLE AS points FROM x")
add(
    "b_profile_listing", "SELECT n_name AS pid, CASE WHEN n_nationkey % 2 = 0 THEN 'hybrid' END AS rec_engine, CASE WHEN n_nationkey % 3 = 0 THEN CAST(n_nationkey AS DOUBLE) END AS rec_score, n_nationkey FROM nation",
    lambda d: score.profile_listing(d.withColumn("known_papers", F.array(F.concat(F.lit("p"), F.col("n_nationkey").cast("string")), F.lit("a")))),
    "SELECT pid, pid || ' | ' || coalesce(rec_engine, '-') || ' | ' || CASE WHEN rec_score IS NULL THEN '-' ELSE printf('%.1f', rec_score) END || ' | a, p' || n_nationkey AS line FROM x",
)

# proposals of all five rules, and what comes of them


def no_extras():
    """Stored character rules: none."""
    return F.array().cast("array<struct<replace:string,with:string>>")


r.learned(
    "l_proposals", lambda c, p: learn.proposals(c, p.withColumn("postprocess_extras", no_extras())).select("journal", "step", "param", "action", "n", F.array_join("papers", ",").alias("papers")),
    """WITH g AS (SELECT journal, string_agg(DISTINCT paper_key, ',' ORDER BY paper_key) AS papers, count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("after", '\\$[^$]+\\$') AND NOT regexp_matches("before", '\\$[^$]+\\$')) AS a,
  count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("before", '\\$[^$]+\\$') AND NOT regexp_matches("after", '\\$[^$]+\\$')) AS d FROM c GROUP BY journal),
b AS (SELECT journal, trim("before") AS w FROM c WHERE type = 'boilerplate_removal' AND trim("before") <> '' GROUP BY ALL HAVING count(*) >= 3 AND NOT (w = '© F' AND journal IN (SELECT journal FROM p))),
h AS (SELECT journal, trim("before") AS w, trim("after") AS v FROM c WHERE type = 'heading_change' AND trim("before") <> trim("after") GROUP BY ALL HAVING count(*) >= 3 AND NOT (w = '# Head 1' AND v = '## Head' AND journal IN (SELECT journal FROM p))),
z AS (SELECT journal, list_filter(list_zip(string_split("before", ''), string_split("after", '')), lambda q: q[1] <> q[2]) AS d FROM c WHERE type = 'text_fix' AND length("before") = length("after")),
e AS (SELECT journal, d FROM z WHERE len(d) = 1 GROUP BY ALL HAVING count(*) >= 3),
u AS (SELECT journal, 1 AS step, 'mfd_conf_override' AS param, 'lower' AS action, a AS n FROM g WHERE a >= 3 UNION ALL SELECT journal, 2, 'mfd_conf_override', 'raise', d FROM g WHERE d >= 3
  UNION ALL SELECT journal, 3, 'extra_boilerplate_patterns', 'add', count(*) FROM b GROUP BY journal UNION ALL SELECT journal, 4, 'heading_remap', 'add', count(*) FROM h GROUP BY journal UNION ALL SELECT journal, 5, 'postprocess_extras', 'add', count(*) FROM e GROUP BY journal)
SELECT journal, step, param, action, n, papers FROM u JOIN g USING (journal)""",
)


def _applied(c, p):
    p = p.withColumns({"postprocess_extras": no_extras(), "history": F.array().cast("array<struct<date:string,param:string,old:string,new:string,reason:string,papers:array<string>>>")})
    got = learn.apply_proposals(p, learn.proposals(c, p), F.lit("2024-01-01"))
    return got.select("journal", "mfd_conf_override", F.array_join(F.sort_array("extra_boilerplate_patterns"), "|").alias("boilerplate"), F.size("heading_remap").cast("long").alias("n_headings"), F.size("postprocess_extras").cast("long").alias("n_extras"), F.array_join(F.transform("history", lambda h: h["param"]), ",").alias("params"))


r.learned(
    "l_apply_proposals", _applied,
    """WITH g AS (SELECT journal, count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("after", '\\$[^$]+\\$') AND NOT regexp_matches("before", '\\$[^$]+\\$')) AS a,
  count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("before", '\\$[^$]+\\$') AND NOT regexp_matches("after", '\\$[^$]+\\$')) AS d FROM c GROUP BY journal),
b0 AS (SELECT journal, trim("before") AS w FROM c WHERE type = 'boilerplate_removal' AND trim("before") <> '' GROUP BY ALL HAVING count(*) >= 3), b1 AS (SELECT journal, w FROM b0 UNION SELECT journal, '© F' FROM p),
b AS (SELECT journal, string_agg(w, '|' ORDER BY w) AS boilerplate FROM b1 GROUP BY journal), nb AS (SELECT journal FROM b0 WHERE NOT (w = '© F' AND journal IN (SELECT journal FROM p)) GROUP BY journal),
h0 AS (SELECT journal, trim("before") AS w FROM c WHERE type = 'heading_change' AND trim("before") <> trim("after") GROUP BY ALL HAVING count(*) >= 3), h1 AS (SELECT journal, w FROM h0 UNION SELECT journal, '# Head 1' FROM p),
h AS (SELECT journal, count(*) AS n FROM h1 GROUP BY journal), nh AS (SELECT journal FROM h0 WHERE NOT (w = '# Head 1' AND journal IN (SELECT journal FROM p)) GROUP BY journal),
z AS (SELECT journal, list_filter(list_zip(string_split("before", ''), string_split("after", '')), lambda q: q[1] <> q[2]) AS d FROM c WHERE type = 'text_fix' AND length("before") = length("after")),
e0 AS (SELECT journal, d FROM z WHERE len(d) = 1 GROUP BY ALL HAVING count(*) >= 3), e AS (SELECT journal, count(*) AS n FROM e0 GROUP BY journal),
j AS (SELECT journal FROM p UNION SELECT journal FROM g WHERE a >= 3 OR d >= 3 UNION SELECT journal FROM nb UNION SELECT journal FROM nh UNION SELECT journal FROM e)
SELECT j.journal, CASE WHEN d >= 3 THEN round(coalesce(conf, 0.45) + 0.05, 4) WHEN a >= 3 THEN round(coalesce(conf, 0.45) - 0.05, 4) ELSE conf END::DOUBLE AS mfd_conf_override, coalesce(boilerplate, '') AS boilerplate, coalesce(h.n, 0) AS n_headings, coalesce(e.n, 0) AS n_extras,
  concat_ws(',', CASE WHEN a >= 3 THEN 'mfd_conf_override' END, CASE WHEN d >= 3 THEN 'mfd_conf_override' END, CASE WHEN nb.journal IS NOT NULL THEN 'extra_boilerplate_patterns' END, CASE WHEN nh.journal IS NOT NULL THEN 'heading_remap' END, CASE WHEN e.journal IS NOT NULL THEN 'postprocess_extras' END) AS params
FROM j LEFT JOIN p USING (journal) LEFT JOIN g USING (journal) LEFT JOIN b USING (journal) LEFT JOIN nb USING (journal) LEFT JOIN h USING (journal) LEFT JOIN nh USING (journal) LEFT JOIN e USING (journal)""",
)

# the first page of a paper
PAPER = """SELECT doc_id, source, '## A study of ' || CASE WHEN doc_id % 3 = 0 THEN 'liquid metal film' WHEN doc_id % 3 = 1 THEN 'roll printing and coating' ELSE 'nothing' END || ' ' || CAST(doc_id AS STRING) || chr(10) || chr(10)
  || CASE WHEN doc_id % 4 = 0 THEN 'Received: 3 May 2024' || chr(10) || chr(10) ELSE '' END || 'A. Doe, B. Roe 1,2 and C. Poe*' || chr(10) || chr(10)
  || CASE WHEN doc_id % 5 < 3 THEN 'Department of Physics, ' || source || CASE WHEN doc_id % 2 = 0 THEN ', E-mail: a.doe' || CAST(doc_id AS STRING) || '@uni.example.org' ELSE '' END || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 6 = 0 THEN 'Seoul, Korea' || chr(10) || chr(10) || 'E-mail: x@y.com' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 7 = 0 THEN '1234567890():,;' || chr(10) || chr(10) ELSE '' END
  || repeat('Long abstract sentence with sensor and film. ', CAST(3 + doc_id % 5 AS INT)) || chr(10) || chr(10)
  || CASE WHEN doc_id % 4 < 3 THEN 'Key' || CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE '' END || 'words: alpha; beta,, ' || lang || ', d, e, f' || chr(10) || chr(10) ELSE '' END
  || '## 1. Introduction' || chr(10) || chr(10) || text AS md FROM documents"""
PAPER_SQL = f"""WITH x AS ({PAPER}),
a0 AS (SELECT doc_id, md, regexp_extract(md, '^(## [^\\n]*)', 1) AS th, list_filter(list_transform(string_split_regex(regexp_extract(md, '(?s)^(.*?)\\n## 1\\. Introduction', 1), '\\n{{2,}}'), lambda z: trim(z, ' ' || chr(10))), lambda z: z <> '') AS ps FROM x),
a1 AS (SELECT *, substr(th, 4) AS title, 'A. Doe, B. Roe 1,2 and C. Poe*' AS line, list_position(list_transform(ps, lambda z: length(z) > 200 AND NOT starts_with(z, '#') AND NOT regexp_matches(z, '(?i)university|institut|college|school|department|cent(er|re)|laboratory|hospital|foundation|research|lab\\b')), true) AS cut FROM a0),
a2 AS (SELECT *, list_filter(CASE WHEN cut > 0 THEN ps[1 : cut - 1] ELSE ps END, lambda z: NOT starts_with(z, '#') AND NOT contains(z, title) AND NOT contains(z, line)) AS zone FROM a1),
a3 AS (SELECT *, list_filter(zone, lambda z: NOT regexp_matches(z, '^E-mail:') AND NOT regexp_matches(z, '(?i)^(\\d{{10,}}|received[:\\s])') AND (contains(z, 'Department') OR contains(z, '@') OR length(z) <= 200)) AS affs,
  list_filter(list_transform(list_filter(zone, lambda z: NOT regexp_matches(z, '(?i)^(\\d{{10,}}|received[:\\s])')), lambda z: regexp_extract(z, '[A-Za-z0-9.]+@[a-z.]+[a-z]')), lambda z: z <> '') AS mails,
  list_filter(list_transform(ps, lambda z: regexp_extract(z, '^Key ?words: (.*)', 1)), lambda z: z <> '') AS kws FROM a2)"""


def _front(d):
    return metadata.paper_metadata(d)


add("m_affiliations", PAPER, lambda d: _front(d).select("doc_id", F.array_join("meta.affiliations", "|").alias("affiliations"), "meta.email"))
ORACLE["m_affiliations"] = PAPER_SQL + " SELECT doc_id, array_to_string(affs, '|') AS affiliations, coalesce(mails[1], '') AS email FROM a3"
add("m_corresponding", PAPER, lambda d: _front(d).select("doc_id", "meta.corresponding_affiliation"))
ORACLE["m_corresponding"] = PAPER_SQL + " SELECT doc_id, coalesce(regexp_replace((list_filter(affs, lambda z: contains(z, '@')))[1], ' E-mail: [^ ]+', ''), '') AS corresponding_affiliation FROM a3"
add("m_keyword_paragraph", PAPER, lambda d: _front(d).select("doc_id", F.array_join("meta.keywords", "|").alias("keywords")))
ORACLE["m_keyword_paragraph"] = PAPER_SQL + " SELECT doc_id, coalesce(array_to_string((list_filter(list_transform(string_split_regex(kws[1], '[;,]'), lambda z: trim(z)), lambda z: z <> ''))[1:5], '|'), '') AS keywords FROM a3"
add("m_minor", PAPER, lambda d: _front(d).select("doc_id", "meta.title", "meta.category.minor"))
_N = lambda words: " + ".join(f"CASE WHEN contains(t, '{w}') THEN 1 ELSE 0 END" for w in words)
_MINOR = f"""c0 AS (SELECT doc_id, title, lower(title || ' ' || array_to_string(list_filter(ps, lambda z: length(z) > 200), ' ')) AS t FROM a3),
c1 AS (SELECT *, {_N(["material", "elastomer", "polymer", "composite", "alloy", "liquid metal", "pdms", "substrate", "oxide skin", "hydrogel", "film"])} AS a, {_N("fabrication process printing lithography transfer coating deposition etching sintering annealing".split())} AS b, {_N("device display sensor actuator led transistor electrode battery capacitor".split())} AS c FROM c0)"""
ORACLE["m_minor"] = f"""{PAPER_SQL}, {_MINOR}
SELECT doc_id, title, CASE WHEN greatest(a, b, c) = 0 THEN '' WHEN a >= b AND a >= c THEN '소재' WHEN b >= c THEN '공정' ELSE '소자' END AS minor FROM c1"""
add("m_without_affiliations", PAPER, lambda d: _front(d).select("doc_id", metadata.without_affiliations(F.col("md"), F.col("meta.affiliations")).alias("t")).select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("long").alias("n_chars")))
ORACLE["m_without_affiliations"] = PAPER_SQL + f""", w0 AS (SELECT doc_id, list_reduce(list_prepend(md, affs), lambda acc, z: replace(replace(replace(acc, {NL} || {NL} || z || {NL} || {NL}, {NL} || {NL}), {NL} || {NL} || z || {NL}, {NL} || {NL}), {NL} || z || {NL} || {NL}, {NL})) AS t FROM a3),
w1 AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '(?i)\\n\\nE-?mail[:\\s]+\\S+[ \\t]*\\n', chr(10) || chr(10), 'g'), '(?i)\\nE-?mail[:\\s]+\\S+[ \\t]*\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM w0) SELECT doc_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n_chars FROM w1"""
add("s_paper_header", PAPER, lambda d: _front(d).select("doc_id", io.paper_header(F.col("meta"), F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.lit("2024-01-01")).alias("header")))
ORACLE["s_paper_header"] = PAPER_SQL + f""", {_MINOR}, k0 AS (SELECT a3.*, CASE WHEN greatest(a, b, c) = 0 THEN '' WHEN a >= b AND a >= c THEN '소재' WHEN b >= c THEN '공정' ELSE '소자' END AS minor,
  (list_filter(list_transform(string_split_regex(coalesce(kws[1], ''), '[;,]'), lambda z: trim(z)), lambda z: z <> ''))[1:5] AS kw, coalesce(regexp_replace((list_filter(affs, lambda z: contains(z, '@')))[1], ' E-mail: [^ ]+', ''), '') AS corr FROM a3 JOIN c1 USING (doc_id))
SELECT doc_id, '---' || {NL} || 'title: "' || k0.title || '"' || {NL} || 'paper_key: "k' || doc_id || '"' || {NL} || {NL} || 'first_author: "A. Doe"' || {NL} || 'authors:' || {NL} || '  - "A. Doe"' || {NL} || '  - "B. Roe"' || {NL} || '  - "C. Poe"' || {NL} || 'corresponding_authors:' || {NL} || '  - "C. Poe"' || {NL}
  || 'corresponding_affiliation: "' || corr || '"' || {NL} || 'email: "' || coalesce(mails[1], '') || '"' || {NL} || 'affiliations:' || CASE WHEN len(affs) > 0 THEN {NL} || array_to_string(list_transform(affs, lambda z: '  - "' || z || '"'), {NL}) ELSE '[]' END || {NL} || {NL} || 'submission_date: ""' || {NL} || 'publication_date: ""' || {NL}
  || 'keywords: ' || CASE WHEN len(kw) > 0 THEN {NL} || array_to_string(list_transform(kw, lambda z: '  - "' || z || '"'), {NL}) ELSE '[]' END || {NL} || {NL} || 'category_major: ""' || {NL} || 'category_middle: ""' || {NL} || 'category_minor: "' || minor || '"' || {NL} || {NL} || 'engine: "hybrid_v8"' || {NL} || 'converted_date: "2024-01-01"' || {NL} || '---' || {NL} AS header FROM k0"""
LISTS = "SELECT doc_id, lang, source, '---' || chr(10) || 'title: \"T ' || CAST(doc_id AS STRING) || '\"' || chr(10) || '# note' || chr(10) || 'authors:' || chr(10) || '  - \"A ' || lang || '\"' || chr(10) || '  - B' || chr(10) || 'tags: [x, ' || source || ']' || chr(10) || 'none: []' || chr(10) || 'key: v:w' || chr(10) || '---' || chr(10) || 'body' AS md FROM documents"
add("s_front_matter_lists", LISTS, lambda d: d.select("doc_id", F.explode(io.front_matter_lists(F.col("md"))).alias("k", "v")).select("doc_id", "k", F.array_join("v", "|").alias("v")), "SELECT doc_id, k, v FROM (SELECT doc_id, unnest(['title', 'authors', 'tags', 'none', 'key']) AS k, unnest(['T ' || doc_id, 'A ' || lang || '|B', 'x|' || source, '', 'v:w']) AS v FROM x)")

# formulas as text
FORMULA_TEXTS = [r"\varepsilon_{x} = 3 \times 10^{-2} \mathrm{eV} \frac{a}{b}", r"$\Delta\mu \tfrac{a}{b} \le \nabla$", r"\mp \simeq \ge \ne \leftarrow \Rightarrow \partial \sqrt{2} 5\% 90\degree", r"\theta\eta\zeta \unknown{z} \text{max} \infty"]
#: Commands are replaced in their listed order, so one that begins with an earlier one leaves its end.
FORMULA_PLAIN = ["εx=3×10-2eVa/b", "Δµa/b≤∇", "∓~eq≥≠≤ftarrow⇒∂√25%90°", "θηζzmax∞"]
_FORMULAS = "SELECT doc_id, CASE doc_id % 4 " + " ".join(f"WHEN {k} THEN '{t.replace(chr(92), '@')}'" for k, t in enumerate(FORMULA_TEXTS)) + " END || CAST(doc_id AS STRING) AS f FROM documents"
add("f_search_text", _FORMULAS, lambda d: d.select("doc_id", align.search_text(F.translate("f", "@", "\\")).alias("plain")), "SELECT doc_id, CASE doc_id % 4 " + " ".join(f"WHEN {k} THEN '{t}{'$' if k == 1 else ''}'" for k, t in enumerate(FORMULA_PLAIN)) + " END || doc_id AS plain FROM x")
# every formula is put together of six pieces that the row's keys choose; ~ stands for a backslash, # for a line end
PIECES = ["~mathrm { per  cent }", "x ^ { - 3 }", "_{ a b }", "~text{ a 1 }", "3 . 5", "3. 5", "1 2 3 4 5", "7  8", " ~frac { a } { b  c }", "y", "~alpha _ #{ 1 0 }", "^{2}", " ~beta ", "{ k  l }", "~sqrt#{ # 2 }"]
_PIECE = lambda k: f"CASE ({k}) % {len(PIECES)} " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PIECES)) + " END"
LATEX = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, " + " || ".join(_PIECE(k) for k in ("l_partkey", "l_suppkey", "l_partkey * 7 + l_linenumber", "l_suppkey * 3 + l_orderkey", "l_orderkey * 11", "l_partkey + l_suppkey + l_orderkey")) + " AS f FROM __LI__"


def _tidy_sql(digits: str) -> str:
    trimmed = lambda e: rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"
    bare = r"regexp_replace(z, '\s+', '', 'g')"
    group = r"regexp_extract(z, '^\\[a-zA-Z]+') || '{' || " + trimmed(r"regexp_replace(regexp_extract(z, '\{([^}]*)', 1), '\s+', ' ', 'g')") + " || '}'"
    steps = [r.regrouped("f", r"\\[a-zA-Z]+\s*\{[^}]*\}", group), r.regrouped("f", r"\^\s*\{[^}]*\}", bare), r.regrouped("f", r"_\s*\{[^}]*\}", bare)]
    inner = f"SELECT doc_id, pos, {digits} AS f FROM x"
    for step in steps:
        inner = f"SELECT doc_id, pos, {step} AS f FROM ({inner})"
    return f"SELECT doc_id, pos, {trimmed('f')} AS latex FROM ({inner})"


add("f_tidy_latex", LATEX, lambda d: d.select("doc_id", "pos", align.tidy_latex(F.translate("f", "~#", "\\\n")).alias("latex")), "WITH y AS (" + _tidy_sql(r.duck_sub("replace(replace(f, '~', chr(92)), '#', chr(10))", [(r"(\d) (\d)", r"\1\2")] * 3 + [(r"(\d) \. (\d)", r"\1.\2")])) + ") SELECT * FROM y")
SPAN = "SELECT doc_id, lang, CASE doc_id % 6 WHEN 0 THEN 'where $a$ = E x holds' WHEN 1 THEN 'where x holds ' || lang WHEN 2 THEN repeat('long line ', 9) || '$a$ and then x ends' WHEN 3 THEN repeat('long line ', 9) || '$a$ = 𝜈 k' WHEN 4 THEN repeat('long line ', 9) || ' plus + x and $b$' ELSE 'E = x' END AS region FROM documents"
add("f_flexible_pattern", SPAN, lambda d: d.select("doc_id", (tk.position(F.col("region"), insertion.flexible_pattern(F.lit("ν k"))) + 1).cast("long").alias("at")), "SELECT doc_id, CAST(CASE WHEN doc_id % 6 = 3 THEN 97 ELSE 0 END AS BIGINT) AS at FROM x")
add("f_math_context", SPAN, lambda d: d.withColumn("at", F.instr("region", "x") - 1).filter("at >= 0").select("doc_id", insertion.in_math_context(F.col("region"), F.col("at"), F.lit(1)).alias("in_math")), "SELECT doc_id, doc_id % 6 IN (0) OR (doc_id % 6 = 4) AS in_math FROM x WHERE contains(region, 'x')")
POLYS = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_linenumber % 3 AS page, l_partkey % 15 AS category, CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_suppkey % 500 AS DOUBLE) AS y0 FROM __LI__"
HEIGHTS = "SELECT o_orderkey AS doc_id, 1 AS page, 800.0 AS height FROM orders"
add(
    "f_page_boxes", {"x": POLYS, "h": HEIGHTS}, lambda d, h: align.to_page_boxes(d.withColumn("poly", F.array(F.col("x0"), F.col("y0"), F.col("x0") + 20, F.col("y0"), F.col("x0") + 20, F.col("y0") + 10)), h.select("doc_id", "page", F.col("height").cast("double").alias("height"))).select("doc_id", "pos", align.formula_type(F.col("category")).alias("type"), *"lrtb"),
    "SELECT x.doc_id, pos, CASE WHEN category = 14 THEN 'display' ELSE 'inline' END AS type, x0 / 2 AS l, (x0 + 20) / 2 AS r, coalesce(height, 792)::DOUBLE - y0 / 2 AS t, coalesce(height, 792)::DOUBLE - (y0 + 10) / 2 AS b FROM x LEFT JOIN h ON x.doc_id = h.doc_id AND x.page = h.page",
)

# formulas put into texts
PLACED = f"SELECT doc_id, 'Where ν equals $a$ = E x and 2 k' || chr(10) || chr(10) || text AS md FROM documents"  # noqa: F541


def _inserted(d):
    spans = d.select("doc_id", F.lit(0).alias("pos"), F.lit(1).alias("page"), F.lit(10.0).alias("l"), F.lit(110.0).alias("r"), F.lit(700.0).alias("t"), F.lit(690.0).alias("b"), F.substring("md", 1, 32).alias("normed"), F.lit(0).alias("md_start"), F.lit(32).alias("md_end"))
    each = F.array(*(F.struct(F.lit(k).alias("pos"), F.lit(x).alias("latex"), F.lit(float(at)).alias("l"), F.lit(s).alias("score")) for k, (x, at, s) in enumerate([("\\nu", 20, 0.9), ("x", 80, 0.9), ("a", 60, 0.9), ("2 k", 100, 0.9), ("\\beta^{2}_{3}", 50, 0.8), ("\\gamma", 30, 0.9), ("q", 15, 0.9), ("E x", 70, 0.4)])))
    f = d.select("doc_id", F.inline(each)).withColumns({"page": F.lit(1), "type": F.lit("inline"), "r": F.col("l") + 5, "t": F.lit(699.0), "b": F.lit(691.0)})
    return insertion.insert_inline(d, f, spans).select("doc_id", "md", F.col("inserted").cast("long").alias("inserted"))


add("f_insert_inline", PLACED, _inserted, "SELECT doc_id, 'Where $\\nu$ equals $\\beta^{2}_{3}$  $a$ = E $x$ and $2 k$' || substr(md, 33) AS md, 4::BIGINT AS inserted FROM x")
SLOTTED = "SELECT doc_id, 'a' || chr(10) || '<!-- formula-slot:p1:1:0:0:0:0 -->' || chr(10) || 'b <!-- formula-slot:p2:1:0:0:0:0 --> c <!-- formula-slot:p2:2:0:0:0:0 -->' || chr(10) || text AS md FROM documents"


def _merged(d):
    each = F.array(*(F.struct(F.lit(k).alias("pos"), F.lit(p).alias("page"), F.lit(y).alias("top"), F.lit(x).alias("latex")) for k, (p, y, x) in enumerate([(1, 9.0, "E = m"), (1, 2.0, "first"), (2, 5.0, "z = 1"), (3, 1.0, "lost"), (3, 2.0, "first")])))
    f = d.filter("doc_id % 3 > 0").select("doc_id", F.inline(each)).withColumn("type", F.lit("display"))
    return insertion.merge_document(d, f)


add("f_merge_document", SLOTTED, _merged, f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' || {NL} || 'b ' || {NL} || substr(md, 112) ELSE 'a' || {NL} || '$$' || {NL} || 'first' || {NL} || '$$' || {NL} || 'b $$' || {NL} || 'z = 1' || {NL} || '$$ c ' || {NL} || substr(md, 112) || {NL} || {NL} || '---' || {NL} || {NL} || '## 📐 수식 (위치 미매핑)' || {NL} || {NL} || '### Page 1' || {NL} || {NL} || '$$' || {NL} || 'E = m' || {NL} || '$$' || {NL} || {NL} || {NL} || '### Page 3' || {NL} || {NL} || '$$' || {NL} || 'lost' || {NL} || '$$' || {NL} || {NL} END AS md FROM x")

# what extraction gives
BOXES = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, CAST(l_partkey % 600 AS DOUBLE) AS l, CAST(l_partkey % 600 + 50 AS DOUBLE) AS r, CAST(l_suppkey % 700 AS DOUBLE) AS b, CAST(l_suppkey % 700 + 30 AS DOUBLE) AS t, l_partkey % 400 AS w, l_suppkey % 400 AS h FROM __LI__"
add("s_crop_box", BOXES, lambda d: d.select("doc_id", "pos", intake.crop_box(F.struct(*"lrtb"), F.lit(612.0), F.lit(792.0)).alias("c")).select("doc_id", "pos", "c.*"), "SELECT doc_id, pos, greatest(0.0, l - 5)::DOUBLE AS \"left\", greatest(0.0, b - 5)::DOUBLE AS bottom, greatest(0.0, 607 - r)::DOUBLE AS \"right\", greatest(0.0, 787 - t)::DOUBLE AS top FROM x")
add("s_large_images", BOXES, lambda d: intake.large_images(d.select("doc_id", "pos", F.col("w").alias("width"), F.col("h").alias("height"))), "SELECT doc_id, pos, w AS width, h AS height FROM x WHERE w > 200 AND h > 200")
add("s_page_keys", "SELECT o_orderkey AS doc_id, CAST(o_orderkey % 9 AS STRING) AS p FROM orders", lambda d: d.withColumn("j", F.concat(F.lit('{"'), "p", F.lit('": 792.5, "x": 1.0}'))).select("doc_id", F.explode(intake.page_numbers(F.from_json("j", "map<string,double>"))).alias("page", "height")), "SELECT doc_id, CAST(p AS INT) AS page, 792.5::DOUBLE AS height FROM x")
LINED = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_linenumber % 3 AS page, repeat(' ', CAST(l_partkey % 3 AS INT)) || repeat('ab', CAST(l_suppkey % 4 AS INT)) || ' ' AS text, CAST(l_partkey % 600 AS DOUBLE) AS x0, CAST(l_suppkey % 700 AS DOUBLE) AS y0, CAST(l_partkey % 600 + 50 AS DOUBLE) AS x1, CAST(l_suppkey % 700 + 9 AS DOUBLE) AS y1 FROM __LI__"
add("s_line_spans", LINED, lambda d: intake.line_spans(d.withColumn("height", F.lit(792.0))), "SELECT doc_id, pos, page, trim(text) AS text, x0 AS l, 792 - y0 AS t, x1 AS r, 792 - y1 AS b FROM x WHERE length(trim(text)) >= 3")
RAW = """SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_partkey % 4 + 1 AS page, CASE l_linenumber WHEN 1 THEN 'text' WHEN 2 THEN 'heading' WHEN 3 THEN 'picture' WHEN 4 THEN 'formula' WHEN 5 THEN 'list' WHEN 6 THEN 'text' ELSE 'formula' END AS label,
  CASE l_linenumber WHEN 1 THEN CASE WHEN l_partkey % 3 = 0 THEN ' www.noise.com ' ELSE ' Author ' || l_returnflag END WHEN 2 THEN CASE WHEN l_partkey % 2 = 0 THEN 'Introduction' ELSE 'Title' END WHEN 3 THEN 'a/f.png' WHEN 5 THEN CASE WHEN l_partkey % 5 = 0 THEN 'BODYNOISE' ELSE 'point ' || l_linestatus END
  WHEN 6 THEN CASE WHEN l_partkey % 2 = 0 THEN 'Fig. 1. A caption that is long enough ' || l_returnflag ELSE 'plain text' END END AS text,
  CASE WHEN l_linenumber = 2 THEN CAST(l_partkey % 3 AS INT) END AS level, CASE WHEN l_partkey % 7 = 0 THEN '*' END AS marker, CASE WHEN l_partkey % 6 > 0 THEN CAST(l_suppkey % 90 AS DOUBLE) END AS l FROM __LI__"""


def _typed(d):
    d = d.withColumns({"t": F.col("l") + 1, "r": F.col("l") + 2, "b": F.col("l") - 1})
    return intake.typed_items(d, "^(?:Introduction)", lambda t: t.contains("www."), lambda t: t.contains("NOISE"))


TYPED = """t0 AS (SELECT *, trim(coalesce(text, '')) AS tt, coalesce(max(CASE WHEN label = 'heading' AND trim(coalesce(text, '')) = 'Introduction' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS body FROM x),
t1 AS (SELECT * FROM t0 WHERE label IN ('picture', 'formula') OR (tt <> '' AND NOT contains(tt, CASE WHEN body = 1 THEN 'NOISE' ELSE 'www.' END))),
t2 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, label ORDER BY pos) AS n, row_number() OVER (PARTITION BY doc_id, page, label ORDER BY pos) AS k, starts_with(tt, 'Fig. 1.') AS cap FROM t1),
ty AS (SELECT doc_id, pos, page, l, CASE label WHEN 'picture' THEN 'img' WHEN 'formula' THEN 'formula_placeholder' WHEN 'heading' THEN 'heading' ELSE CASE WHEN cap THEN 'caption' ELSE 'text' END END AS type,
  CASE label WHEN 'picture' THEN '![Figure ' || n || '](a/f.png)' WHEN 'formula' THEN '<!-- formula-slot:p' || page || ':' || k || ':' || CASE WHEN l IS NULL THEN '0:0:0:0' ELSE printf('%.1f:%.1f:%.1f:%.1f', l, l + 1, l + 2, l - 1) END || ' -->' WHEN 'heading' THEN repeat('#', CAST(CASE WHEN level = 0 THEN 1 ELSE level END + 1 AS INT)) || ' ' || tt WHEN 'list' THEN coalesce(marker, '-') || ' ' || tt ELSE tt END AS content,
  CASE WHEN label = 'picture' THEN n WHEN cap THEN 1 END AS fig_n FROM t2)"""
add("k_typed_items", RAW, lambda d: _typed(d).select("doc_id", "pos", "type", "content", F.col("fig_n").cast("long").alias("fig_n")), f"WITH {TYPED} SELECT doc_id, pos, type, content, CAST(fig_n AS BIGINT) AS fig_n FROM ty")
add("k_place_captions", RAW, lambda d: intake.place_captions(_typed(d)).select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("sub").cast("long").alias("sub"), "type", "content", F.col("fig_n").cast("long").alias("fig_n")),
    f"""WITH {TYPED}, im AS (SELECT doc_id, min(pos) AS ipos FROM ty WHERE type = 'img' GROUP BY doc_id), ed AS (SELECT doc_id, max(pos) AS last FROM ty GROUP BY doc_id)
SELECT doc_id, pos::BIGINT AS pos, 0::BIGINT AS sub, type, content, fig_n::BIGINT AS fig_n FROM ty WHERE type <> 'caption'
UNION ALL SELECT doc_id, coalesce(ipos, last + 1)::BIGINT, 1::BIGINT, 'caption_inline', '*' || content || '*', 1::BIGINT FROM ty JOIN ed USING (doc_id) LEFT JOIN im USING (doc_id) WHERE type = 'caption'""")  # fmt: skip
add("k_text_spans", RAW, lambda d: intake.text_spans(_typed(d)).select("doc_id", F.col("pos").cast("long").alias("pos"), "text", "page", "l", "is_caption"),
    f"WITH {TYPED} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY type = 'caption', pos) - 1 AS BIGINT) AS pos, content AS text, page, l, type = 'caption' AS is_caption FROM ty WHERE type IN ('text', 'caption') AND l IS NOT NULL")
add("k_formula_items", RAW, lambda d: intake.formula_items(d.withColumns({"orig": F.lit("o"), "provs": F.array(F.struct("page", "l", (F.col("l") + 1).alias("t"), (F.col("l") + 2).alias("r"), (F.col("l") - 1).alias("b")))})).select("doc_id", "pos", "orig", F.to_json(F.struct("prov")).alias("prov")),
    "SELECT doc_id, pos, 'o' AS orig, '{\"prov\":[{\"page\":' || page || CASE WHEN l IS NULL THEN '' ELSE ',\"bbox\":[' || printf('%.1f,%.1f,%.1f,%.1f', l, l + 1, l + 2, l - 1) || ']' END || '}]}' AS prov FROM x WHERE label = 'formula'")
CAPTION_TEXTS = "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Fig. ' || CAST(doc_id % 9 + 1 AS STRING) || ' | A long caption of a figure' WHEN 1 THEN 'Extended Data Figure 2: a long caption here' WHEN 2 THEN 'Figure 3. See next page for the caption' WHEN 3 THEN 'Fig. 4.' ELSE text END AS t FROM documents"
add("k_caption_number", CAPTION_TEXTS, lambda d: d.select("doc_id", layout.caption_number(F.col("t")).cast("long").alias("fig_n")), "SELECT doc_id, CAST(CASE doc_id % 5 WHEN 0 THEN doc_id % 9 + 1 WHEN 1 THEN 102 END AS BIGINT) AS fig_n FROM x")

# Word documents
CELLS = "SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 4 = 0 THEN '작성 요령 안내' ELSE 'Name ' || o_orderstatus END AS a, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'B' END AS b FROM orders"


def _headers(d):
    rows = F.array(F.array(F.concat(F.lit(" "), "a"), F.lit("")), F.array("b"), F.array("b"), F.array("b"), F.array(F.lit("x"), F.lit(" y ")))
    return d.select("doc_id", docx.table_headers(rows).alias("h"))


add("d_table_headers", CELLS, lambda d: _headers(d).select("doc_id", F.array_join("h.headers", "|").alias("headers"), "h.guide"), "SELECT doc_id, a || '|' || CASE WHEN b = '' THEN ' | ' ELSE 'B|B' END || '|x y' AS headers, starts_with(a, '작성') AS guide FROM x")
TABLES = "SELECT doc_id, 'intro' || chr(10) || '| p | q |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || 'after' || chr(10) || '+--+' || chr(10) || '| g |' || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '| z |' ELSE '' END AS md FROM documents"


def templates():
    return F.array(F.struct(F.array(F.lit("Head"), F.lit("B")).alias("headers"), F.lit(False).alias("guide")), F.struct(F.array(F.lit("g")).alias("headers"), F.lit(True).alias("guide")))


add("d_merge_templates", TABLES, lambda d: d.select("doc_id", docx.merge_templates(F.col("md"), templates()).alias("md")), f"SELECT doc_id, 'intro' || {NL} || '| Head | B |' || {NL} || '| ---- | --- |' || {NL} || '|      |     |' || {NL} || '|      |     |' || {NL} || {NL} || 'after' || {NL} || '+--+' || {NL} || '| g |' || {NL} || {NL} || CASE WHEN doc_id % 2 = 0 THEN '| z |' ELSE '' END AS md FROM x")
add("d_plain_markdown", "SELECT doc_id, source, lang FROM documents", lambda d: d.select("doc_id", docx.plain_markdown(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(s).alias("style"), t.alias("text")) for k, s, t in (("p", "Heading 2", F.col("source")), ("p", "Normal", F.lit("  ")), ("table", "", F.lit("")), ("p", "Heading", F.lit(" T ")), ("p", "Normal", F.col("lang")), ("table", "", F.lit("")))))).alias("md")), f"SELECT doc_id, '## ' || source || {NL} || {NL} || '[TABLE_0]' || {NL} || {NL} || '# T' || {NL} || {NL} || lang || {NL} || {NL} || '[TABLE_1]' || {NL} AS md FROM x")
add("d_batch", "SELECT '/in/' || o_orderpriority || '/f' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN '.docx' ELSE '.doc' END AS path, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 5 < 4 END AS ok FROM orders", docx.batch, "SELECT count(*) AS n_files, count(*) FILTER (WHERE ok) AS n_converted FROM x WHERE ends_with(path, '.docx')")

# parts of a manuscript; @ stands for a backslash in the inputs, which both engines read alike


def cases(name: str, pairs, rule) -> None:
    """A query over texts by id, each followed by its id, and the results written out by hand. ``{n}`` is where the id comes in."""
    quoted = lambda t: "'" + t.replace("'", "''").replace("\n", "' || chr(10) || '").replace("{n}", "' || CAST(doc_id AS STRING) || '") + "'"
    pick = lambda k: f"CASE doc_id % {len(pairs)} " + " ".join(f"WHEN {i} THEN {quoted(p[k])}" for i, p in enumerate(pairs)) + " END"
    add(name, f"SELECT doc_id, {pick(0)} AS t FROM documents", lambda d: d.select("doc_id", rule(F.translate("t", "@", "\\")).alias("t")), f"SELECT doc_id, {pick(1)} AS t FROM x")




def keys():
    """Citation keys by number."""
    return F.create_map(F.lit("1"), F.lit("doe2020"), F.lit("3"), F.lit("roe2021"))


cases("x_unicode_math", [("μ of 5 {n}", r"$\mu$ of 5 {n}"), ("a – b … {n} $α$", r"a -- b \ldots{} {n} $$\alpha$$"), ('"q" × 𝜈 {n}', r"``q`` $\times$ $\nu$ {n}"), ("plain {n}", "plain {n}")], manuscript.unicode_math)
cases("x_escape", [("a_b & 5% #{n} {x} ~ ^ $", r"a\_b \& 5\% \#{n} \{x\} \textasciitilde{} \textasciicircum{} \$"), ("@cite{a_b} & {n}", r"\cite{a_b} & {n}"), ("α & {n}", r"$\alpha$ & {n}"), ("✉ a@b {n}", "\\texttt{[email]} a\\b {n}")], manuscript.escape_text)
cases("x_escape_safe", [("a & b % {n} $x & y$ #", r"a \& b \% {n} $x & y$ \#"), ("$$a & b$$ ~{n}^ {x}_y", r"$$a & b$$ \textasciitilde{}{n}\textasciicircum{} {x}_y"), ("± & $q% {n}", r"$\pm$ \& $q\% {n}")], manuscript.escape_safe)
cases("x_math_spaces", [("@mathrm { a x i a l } _ { x } {n}", r"\mathrm {axial} _{x} {n}"), ("3 . 5 ^ { a + b } {n}", "3.5 ^{a + b} {n}"), ("{ @mathrm { x y } } {ab c} {n}", r"{ \mathrm {xy} } {ab c} {n}")], manuscript.math_spaces)
cases("x_fix_inline_math", [("see $@textbf{a}@textit{b}}$ {n}", r"see $\mathbf{a}{b}$ {n}"), ("$@AA + @'e {x$ {n}", r"$\text{\AA} +  {x}$ {n}"), ("$$@textbf{a}}$$ {n}", r"$$\textbf{a}}$$ {n}")], manuscript.fix_inline_math)
cases("x_inline", [("**bold $x_1$ b** and *it* _us_ `c` {n}", r"\textbf{bold $x_1$ b} and \textit{it} \textit{us} \texttt{c} {n}"), ("as [1], [2, 3] and [1–3] & {n}", r"as \cite{doe2020}, \cite{ref2,roe2021} and \cite{doe2020,roe2021} \& {n}"), ("a_b_c $a*b*c$ 5% {n}", r"a_b_c $a*b*c$ 5\% {n}"), ("$@mathrm { a b }$ {n}", r"$\mathrm {ab}$ {n}")], lambda t: manuscript.inline(t, keys()))
cases("x_heading", [("2.1. Width of $@mathrm{x}_1$ {n}", r"\subsubsection{Width of \texorpdfstring{$\mathrm{x}_1$}{x_1} {n}}"), ("3. Results & {n}", r"\subsection{Results \& {n}}"), ("Methods {n}", r"\subsection{Methods {n}}")], lambda t: manuscript.heading(t, keys(), F.lit(3)))
cases("x_orphan_math", [("so @left( a @right) holds {n}", r"so $\left( a \right)$ holds {n}"), ("$@left( a @right)$ {n}", r"$\left( a \right)$ {n}"), ("$$@left( a @right) {n}", r"$$\left( a \right) {n}")], manuscript.wrap_orphan_math)
cases("x_affiliation", [("Lab A, https://a.org/ x1. and B & {n}", r"Lab A, \url{https://a.org/x1.andB\&{n}}"), ("Lab & B {n}", r"Lab \& B {n}"), ("see http://q.de", r"see \url{http://q.de}")][1:], manuscript.escape_affiliation)
cases("x_cite_all", [("[1] [9] {n}", r"\cite{doe2020} \cite{ref9} {n}"), ("[1,3] [1 - 3] {n}", r"\cite{doe2020,roe2021} \cite{doe2020,roe2021} {n}"), ("[a] [] {n}", "[a] [] {n}")], lambda t: manuscript.cite_all(t, keys()))
_T = "\\begin{table}[htbp]\n  \\centering\n  \\caption{Table 2}\n  \\label{tab:table2}\n  \\begin{tabular}{%s}\n    \\hline\n%s\n    \\hline\n  \\end{tabular}\n\\end{table}"
_NOTE = "%% [복잡한 표 — tabular 변환 시 레이아웃 확인 필요]\n%% 원본 이미지가 있다면 figures/ 폴더에 table2.png 추가 후 아래 주석 해제:\n%% \\begin{figure}[htbp]\\centering\n%% \\includegraphics[width=\\linewidth]{figures/table2.png}\n%% \\caption{Table 2}\\label{tab:table2}\n%% \\end{figure}\n".replace("%%", "%")
cases("x_table_environment", [("| a | b_{n} & c |\n|---|---|\n| 1 | 5% |", _T % ("lc", "    a & b_{n} \\& c \\\\\n    \\hline\n    1 & 5\\% \\\\")), ("| a |\n| {n} | 2 |", _NOTE + _T % ("lc", "    a &  \\\\\n    \\hline\n    {n} & 2 \\\\")), ("| {n} |", _T % ("l", "    {n} \\\\\n    \\hline")), ("|--|", "")], lambda t: manuscript.table_environment(t, F.lit(2)))
add("x_short_caption", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN repeat('a', 250) || '. ' || repeat('b', 300) || CAST(doc_id AS STRING) WHEN 1 THEN repeat('a', 150) || '. ' || repeat('b', 338) || '$x. ' || repeat('c', 20) || '$' ELSE 'short. ' || CAST(doc_id AS STRING) END AS t FROM documents", lambda d: d.select("doc_id", manuscript.short_caption(F.col("t")).alias("t")), "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN repeat('a', 250) || '.' WHEN 1 THEN repeat('a', 150) || '. ' || repeat('b', 338) ELSE t END AS t FROM x")
TITLED = "SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN 'acs' WHEN 1 THEN 'elsevier' WHEN 2 THEN 'wiley' ELSE 'generic' END AS journal FROM documents"
add("x_title_block", TITLED, lambda d: d.select("doc_id", manuscript.title_block(F.concat(F.lit("A & "), "source"), F.array(F.lit("A. B"), F.lit("# no"), F.lit("C"), F.lit("D"), F.lit("E")), F.array(F.lit("Lab 5%"), F.lit("Two")), F.lit("a@b.c"), F.when(F.col("doc_id") % 8 > 3, F.array(F.lit("k_1"), F.lit("z"))).otherwise(F.array().cast("array<string>")), F.col("journal")).alias("t")),
    f"SELECT doc_id, CASE journal WHEN 'acs' THEN '\\begin{{document}}' || {NL} || '\\title{{A \\& ' || source || '}}' || {NL} || '\\author{{A. B}}' || {NL} || '\\author{{\\# no}}' || {NL} || '\\author{{C}}' || {NL} || '\\author{{D}}' || {NL} || '\\author{{E}}' || {NL} || '\\affiliation{{Lab 5\\%}}' || {NL} || '\\email{{a@b.c}}' || {NL} || '\\maketitle' || {NL}"
    f" WHEN 'elsevier' THEN '\\title{{A \\& ' || source || '}}' || {NL} || '\\author{{A. B, \\# no, C, D, E}}' || {NL} || '\\address{{Lab 5%\\\\' || {NL} || 'Two}}' || {NL} || '\\ead{{a@b.c}}' || {NL} || '\\begin{{document}}' || {NL} || '\\maketitle' || {NL}"
    f" ELSE '\\title{{A \\& ' || source || '}}' || {NL} || '\\author{{A. B, C, D,\\\\' || {NL} || 'E}}' || {NL} || '\\date{{}}' || {NL} || '\\maketitle' || {NL} || '\\begin{{flushleft}}\\footnotesize Lab 5%\\\\' || {NL} || 'Two\\end{{flushleft}}' || {NL} || CASE WHEN doc_id % 8 > 3 THEN '\\noindent\\textbf{{Keywords:}} k\\_1, z' || {NL} || {NL} ELSE '' END END AS t FROM x")  # fmt: skip
ABSTRACTS = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'top' || chr(10) || '## Abstract' || chr(10) || 'Own text ' || CAST(doc_id AS STRING) || chr(10) || chr(10) || '## Next' || chr(10) || 'x' WHEN 1 THEN '# T' || chr(10) || chr(10) || repeat('long ', 40) || chr(10) || chr(10) || 'tail ' || CAST(doc_id AS STRING) WHEN 2 THEN repeat('long ', 40) || chr(10) || '## In' || chr(10) || 'y' || chr(10) || chr(10) || 'z' ELSE 'short ' || CAST(doc_id AS STRING) END AS t FROM documents"
add("x_abstract", ABSTRACTS, lambda d: d.select("doc_id", manuscript.abstract(F.col("t")).alias("a")).select("doc_id", "a.*"), f"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Own text ' || doc_id WHEN 3 THEN '' ELSE trim(repeat('long ', 40)) END AS abstract, CASE doc_id % 4 WHEN 0 THEN 'top' || {NL} || {NL} || '## Next' || {NL} || 'x' WHEN 1 THEN 'tail ' || doc_id WHEN 2 THEN '## In' || {NL} || 'y' || {NL} || {NL} || 'z' ELSE t END AS body FROM x")
cases(
    "x_body",
    [
        ("## 2. Results & {n}\n\nSee [1] and **b**.\n- one\n- two %\n1. a\n2. b\n---\n> q {n}", "\\section{Results \\& {n}}\n\n\nSee \\cite{doe2020} and \\textbf{b}.\n\\begin{itemize}\n  \\item one\n  \\item two \\%\n\\end{itemize}\n\n\\begin{enumerate}\n  \\item a\n  \\item b\n\\end{enumerate}\n\n\\hrule\n\\begin{quote}\nq {n}\n\\end{quote}"),
        ("![alt {n}](a/f.jpg)\n\n*Figure 1. Cap*\n$$\nx _ { a } $y$\n$$\n![b](c)\n\ntext", "\\begin{figure}[!htbp]\n  \\centering\n  \\includegraphics[width=0.95\\linewidth,height=0.70\\textheight,keepaspectratio]{figures/figure_1.jpg}\n  \\caption{\\small Figure 1. Cap}\n  \\label{fig:figure1}\n\\end{figure}\n\n\\begin{equation}\nx _{a} y\n\\end{equation}\n\n\\begin{figure}[!htbp]\n  \\centering\n  \\includegraphics[width=0.95\\linewidth,height=0.70\\textheight,keepaspectratio]{figures/figure_2.png}\n  \\caption{\\small b}\n  \\label{fig:figure2}\n\\end{figure}\n\n\ntext"),
        ("---\nk: v\n---\na {n}\n| x |\n## References\n[1] gone\n\n### References\nmore\n# Next\nend", "a {n}\n\\begin{table}[htbp]\n  \\centering\n  \\caption{Table 1}\n  \\label{tab:table1}\n  \\begin{tabular}{l}\n    \\hline\n    x \\\\\n    \\hline\n    \\hline\n  \\end{tabular}\n\\end{table}\n\n\\bibliography{references}\n\\bibliographystyle{unsrt}\n\\part{Next}\n\nend"),
    ],
    lambda t: manuscript.body(t, keys()),
)
add("x_submission", TITLED, lambda d: d.select("doc_id", manuscript.submission(F.lit("P"), F.col("journal"), F.lit("T"), F.when(F.col("doc_id") % 8 < 4, F.lit("a & b")).otherwise(""), F.col("source")).alias("t")),
    f"SELECT doc_id, 'P' || {NL} || {NL} || CASE WHEN doc_id % 4 > 1 THEN '\\begin{{document}}' || {NL} || {NL} ELSE '' END || 'T' || {NL} || CASE WHEN doc_id % 8 < 4 THEN '\\begin{{abstract}}' || {NL} || '\\sloppy\\tolerance=9999\\exhyphenpenalty=0' || {NL} || 'a \\& b' || {NL} || '\\fussy' || {NL} || '\\end{{abstract}}' || {NL} || {NL} ELSE '' END || source || {NL} || {NL} || '\\end{{document}}' || {NL} AS t FROM x")
FRONTS = "SELECT doc_id, source, 'noise' || chr(10) || '# Title' || chr(10) || 'J. Choi, H. Y. Jeong' || chr(10) || 'Dept 1, Seoul' || chr(10) || 'KAIST University' || chr(10) || chr(10) || '## ENGINEERING' || chr(10) || 'Ann Lee 1 , Bob Kim 2' || chr(10) || 'ada poe and ben roe' || chr(10) || 'Abstract of ' || source || chr(10) || 'more' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '## 1. Introduction' || chr(10) || 'body' ELSE 'USA' END AS md FROM documents"
add("x_without_front", FRONTS, lambda d: d.select("doc_id", manuscript.without_front(F.col("md"), F.array(F.lit("Ada Poe"), F.lit("Ben Roe"))).alias("f")).select("doc_id", "f.body", F.array_join("f.affiliations", "|").alias("affiliations")),
    f"SELECT doc_id, 'Abstract of ' || source || {NL} || {NL} || 'more' || CASE WHEN doc_id % 2 = 0 THEN {NL} || {NL} || '## 1. Introduction' || {NL} || 'body' ELSE '' END AS body, 'J. Choi, H. Y. Jeong Dept 1, Seoul KAIST University' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '|USA' END AS affiliations FROM x")


def _manuscripts(d):
    """Whole papers: front off, references, abstract and body as a submission."""
    d = d.withColumn("f", manuscript.without_front(F.col("md"), F.array(F.lit("A. Doe"), F.lit("B. Roe"))))
    d = d.withColumn("a", manuscript.abstract(F.col("f.body")))
    title = manuscript.title_block(F.lit("T"), F.array(F.lit("A. Doe"), F.lit("B. Roe")), F.col("f.affiliations"), F.lit(""), F.array().cast("array<string>"), F.lit("generic"))
    return d.select("doc_id", manuscript.submission(latex.preamble(F.lit("generic")), F.lit("generic"), title, F.col("a.abstract"), manuscript.body(F.col("a.body"), keys())).alias("tex"))


add("x_convert", PAPER, lambda d: _manuscripts(d).select("doc_id", F.length("tex").cast("long").alias("n_chars"), F.md5("tex").alias("digest")))

ENTRIES = """SELECT doc_id, 0 AS pos, 1 AS num, 'Doe2020' AS key, 'A. Doe, B. Roe' AS authors, '' AS title, 'Nano Lett.' AS journal, '2020' AS year, '10.1/x' AS doi, 'A. Doe {x} & ' || source AS raw FROM documents
UNION ALL SELECT doc_id, 1, 2, 'Doe2020', '', '', '', '', '', 'raw_' || CAST(doc_id AS STRING) FROM documents UNION ALL SELECT doc_id, 2, 7, 'Poe', 'C. Poe', 'On T', '', '1999', '', 'z' FROM documents WHERE doc_id % 2 = 0"""
_E = f"SELECT DISTINCT doc_id, raw FROM x WHERE pos = 0"  # noqa: F541
add("x_bibtex", ENTRIES, latex.bibtex, f"""WITH e AS ({_E}) SELECT doc_id, '@article{{Doe2020,' || {NL} || '  author  = {{A. Doe, B. Roe}},' || {NL} || '  title   = {{{{A. Doe — Nano Lett. — 2020}}}},' || {NL} || '  journal = {{Nano Lett.}},' || {NL} || '  year    = {{2020}},' || {NL} || '  doi     = {{10.1/x}},' || {NL} || '  note    = {{[1] ' || replace(replace(raw, '{{', '('), '}}', ')') || '...}},' || {NL} || '}}' || {NL} || {NL}
|| '@article{{Doe2020b,' || {NL} || '  title   = {{{{[2]}}}},' || {NL} || '  note    = {{[2] raw_' || doc_id || '...}},' || {NL} || '}}' || {NL} || CASE WHEN doc_id % 2 = 0 THEN {NL} || '@article{{Poe,' || {NL} || '  author  = {{C. Poe}},' || {NL} || '  title   = {{{{On T}}}},' || {NL} || '  year    = {{1999}},' || {NL} || '  note    = {{[7] z...}},' || {NL} || '}}' || {NL} ELSE '' END AS bib FROM e""")
add("x_bibitems", ENTRIES, latex.bibitems, f"""WITH e AS ({_E}) SELECT doc_id, '\\bibitem{{Doe2020}}' || {NL} || '  A. Doe \\{{x\\}} \\& ' || substr(raw, 14) || {NL} || {NL} || '\\bibitem{{Doe2020b}}' || {NL} || '  raw\\_' || doc_id || {NL} || CASE WHEN doc_id % 2 = 0 THEN {NL} || '\\bibitem{{Poe}}' || {NL} || '  z' || {NL} ELSE '' END AS bib FROM e""")
