"""Queries of the document engine by name, and SQL that gives the same rows.

Inputs are the standard tables: Markdown made from ``documents`` (``md_docs``), and
layout items, spans, formulas, corrections and scores made from ``lineitem`` by
plain SQL that both engines read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import textkit as tk
from ..functions.session import ship
from ..operators import align, captions, folds, latex, layout, learn, linediff, metadata, normalize, postprocess, score
from ..sources import io
from .md_docs import MD

QUERIES: dict = {}
ORACLE: dict = {}
NAMES = ("documents", "pages", "conversations", "benchmark", "labels", "events", "lineitem", "orders", "part", "supplier", "customer", "nation", "region")


#: ``lineitem`` with one row an order and line number.
LI = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY l_orderkey, l_linenumber) li"


#: Tables of narrow rows, whose rules take longer than their reading: parts dealt to a core, and parts that an order's lines are dealt to for one of the scan.
NARROW, PARTS_A_CORE, PARTS_A_SCAN = ("events", "lineitem", "orders", "part", "supplier", "customer"), 4, 16


def source(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A statement over the standard tables it names."""
    ship(spark)
    sql = sql.replace("__LI__", LI)
    for n in NAMES:
        if f"FROM {n}" in sql:
            table = spark.read.parquet(f"{sf_dir}/{n}.parquet")
            (by_order(table) if n == "lineitem" and LI in sql else spread(table, PARTS_A_CORE if n in NARROW else 1)).createOrReplaceTempView(n)
    return spark.sql(sql)


def spread(df: DataFrame, share: int = 1) -> DataFrame:
    """A table whose scan has fewer tasks than ``share`` times the cluster's cores is dealt out to so many; a large one never is."""
    parts = df.sparkSession.sparkContext.defaultParallelism * share
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def by_order(lines: DataFrame) -> DataFrame:
    """``lineitem`` dealt by its orders, once for all that groups by them, into parts whose number grows with the table and not their size."""
    return lines.repartition(order_parts(lines), "l_orderkey")


def order_parts(lines: DataFrame) -> int:
    return lines.rdd.getNumPartitions() * PARTS_A_SCAN


def add(name: str, inputs: str | dict, run, oracle: str | None = None, dealt: bool = False) -> None:
    """Registers a query. ``oracle`` may name the inputs; a single one is ``x``. With ``dealt`` ``run`` also gets the ``parts`` that ``lineitem`` is dealt to."""
    inputs = {k: sql.replace("__LI__", LI) for k, sql in ({"x": inputs} if isinstance(inputs, str) else inputs).items()}
    size = lambda spark, sf_dir: {"parts": order_parts(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))} if dealt else {}
    QUERIES[name] = lambda spark, sf_dir: run(*(source(spark, sf_dir, sql) for sql in inputs.values()), **size(spark, sf_dir))
    if oracle:
        head = "WITH RECURSIVE " if oracle.startswith("WITH RECURSIVE ") else "WITH "
        ORACLE[name] = head + ", ".join(f"{k} AS ({sql})" for k, sql in inputs.items()) + (", " if oracle.startswith(head) else " ") + oracle.removeprefix(head)


def text_query(name: str, rule, oracle_expr: str | None = None, sql: str | None = None) -> None:
    """A rule on ``md``: the new text's length and digest, and whether it changed."""
    out = lambda d: d.select("doc_id", rule(F.col("md")).alias("t"), "md").select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("long").alias("n_chars"), (F.col("t") != F.col("md")).alias("changed"))
    add(name, sql or MD, out, oracle_expr and f"WITH y AS (SELECT doc_id, md, {oracle_expr} AS t FROM x) SELECT doc_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n_chars, t <> md AS changed FROM y")


def duck_swap(expr: str, pairs) -> str:
    for a, b in pairs.items() if isinstance(pairs, dict) else pairs:
        expr = f"replace({expr}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"
    return expr


def duck_sub(expr: str, rules) -> str:
    for p, r in rules:
        expr = f"regexp_replace({expr}, '{p.replace(chr(39), chr(39) * 2)}', '{r}', 'g')"
    return expr


def re2(pattern: str) -> str:
    """A pattern in the other engine's dialect, where dots stop at newlines by themselves."""
    flags = re.match(r"\(\?([dUmis]+)\)", pattern)
    if not flags:
        return pattern
    kept = "".join(f for f in flags[1] if f in "mis")
    return (f"(?{kept})" if kept else "") + pattern[flags.end() :]


def duck_rules(expr: str, rules) -> str:
    """Rules as they are written for Spark, in order."""
    return duck_sub(expr, [(re2(p), re.sub(r"\$(\d)", r"\\\1", r.replace("\\$", "$"))) for p, r in rules])


NL = "chr(10)"
#: Lines of x, with their place, as a table.
LINES = f"WITH ln AS (SELECT doc_id, md, unnest(string_split(md, {NL})) AS line, generate_subscripts(string_split(md, {NL}), 1) AS k FROM x)"
PARAS = f"WITH pa AS (SELECT doc_id, md, unnest(string_split(md, {NL} || {NL})) AS p, generate_subscripts(string_split(md, {NL} || {NL}), 1) AS k FROM x)"
DIGEST = "SELECT doc_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n_chars, t <> md AS changed FROM y"
WS = "[ \\t\\n\\r\\f\\v]"

#: Documents with download banners in front.
BANNERS = MD.replace("'## Study '", "CASE WHEN doc_id % 3 = 0 THEN chr(10) || '123' || 'adma, 2024, 5, Downloaded from https://x.y/' || lang || chr(10) WHEN doc_id % 3 = 1 THEN '2024x12, 2024, 3, Downloaded from there' || chr(10) ELSE '' END || '## Study '")
#: Documents with publishers' lines.
NOISY = MD.replace("'## Study '", "'Science Advances' || chr(10) || 'S c i e n c e' || chr(10) || 'www.nature.com/' || source || chr(10) || '© 2024 Elsevier B.V.' || chr(10) || 'x (3 of 10) © 2024 y' || chr(10) || '**Permissions**' || chr(10) || 'DOI: 10.1002/adma.' || CAST(doc_id AS STRING) || chr(10) || 'NATURE | RESEARCH' || chr(10) || 'see orcid.org/0000-0001-0002-0003 x' || chr(10) || 'Creative  Commons ' || lang || chr(10) || '## Study '")
#: Documents with old forms of references, sections and pictures.
OLD = MD.replace("'## References'", "'# Conclusions' || chr(10) || '![](_page_3_Picture_' || CAST(doc_id AS STRING) || '.jpeg)' || chr(10) || '- [3] Au (2019). x' || chr(10) || '**2.1. Sub ' || lang || '**' || chr(10) || '**goes on**' || chr(10) || '**RESULTS**' || chr(10) || '**RESEARCH ARTICLE**' || chr(10) || '**Keywords here**' || chr(10) || '**Figure 3. x**' || chr(10) || '**plain ' || source || '**' || chr(10) || '# **a** b' || chr(10) || '- 3 A' || chr(10) || '## References' || chr(10) || '- 1 Au' || chr(10) || '- w x . 4 Bc' || chr(10) || 'Accepted 3 May' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '**View the article online** z' || chr(10) ELSE '' END")

# normalization
text_query("n_ligatures", normalize.ligatures, duck_swap(duck_swap("md", normalize.LIGATURE_NAMES), normalize.LIGATURES))
text_query("n_hyphens", normalize.hyphens, duck_swap("md", normalize.HYPHEN_NAMES))
text_query("n_special_spaces", normalize.spaces, duck_swap("md", normalize.SPACES))
text_query("n_symbol_font", normalize.symbols, duck_swap("md", normalize.SYMBOLS))
text_query("n_citation_paren", normalize.citation_parens, duck_sub("md", [(r"\(\s+(\d+(?:\s*[-–]\s*\d+)*(?:,\s*\d+)*)\s+\)", r"(\1)")]))
text_query("n_glyph_names", normalize.glyph_names, duck_sub("md", [("(?i)/(?:hair|thin|en|em|nb|zerowidth)space", "")]))
text_query("n_micro_unit", normalize.micro_units, duck_sub("md", [("µ ([mMlLsSnNgGΩ])([a-zA-Z])", r"µ\1 \2"), ("µ ([mMlLsSnNgGΩ])([^a-zA-Z])", r"µ\1\2")]))
text_query("n_volume_spacing", normalize.volume_spacing, duck_sub("md", [(r"(\d) , (\d)", r"\1, \2")]))
text_query("n_unicode_escape", normalize.unicode_escapes)
text_query("n_download_banner", normalize.download_banners, duck_sub("md", [(r"\n\d+\w+(?:\s+\w+)*, \d{4}, \d+, Downloaded from https://[^\n]+\n", "\n"), (r"\d{4}[xX]?\d+x?, \d{4}, \d+, Downloaded from.*?(?:\n|$)", "")]), BANNERS)
text_query("n_normalize_span", normalize.normalize)
text_query("n_normalize_document", lambda c: normalize.normalize(c, whole=True))
text_query("n_normalize_fast", normalize.normalize_fast)
SQUEEZED = f"""{LINES}, f AS (SELECT *, sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) % 2 = 1 AS code FROM ln),
y AS (SELECT doc_id, any_value(md) AS md, string_agg(CASE WHEN code OR starts_with(line, '|') THEN line ELSE regexp_replace(line, ' {{2,}}', ' ', 'g') END, {NL} ORDER BY k) AS t FROM f GROUP BY doc_id) {DIGEST}"""
text_query("n_spaces_fenced", normalize.squeeze_outside_code)
ORACLE["n_spaces_fenced"] = f"WITH x AS ({MD}), " + SQUEEZED.removeprefix("WITH ")
text_query("n_para_merge", normalize.merge_paragraphs)
PROSE = "NOT regexp_matches(trim({0}, ' ' || chr(10) || chr(9) || chr(13)), '^(?:$|#|!\\[|\\*|<!--|\\||-|>)')"
ORACLE["n_para_merge"] = f"""WITH x AS ({MD}), {PARAS.removeprefix("WITH ")},
s AS (SELECT *, trim(p, ' ' || chr(10) || chr(9) || chr(13)) AS st, lag(p) OVER w AS bp FROM pa WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
j AS (SELECT *, k > 1 AND {PROSE.format("bp")} AND {PROSE.format("p")} AND NOT regexp_matches(trim(bp, ' ' || chr(10) || chr(9) || chr(13)), '[.?!:]$') AND regexp_matches(st, '^(?:\\p{{Ll}}|\\(\\p{{Lu}})') AS m FROM s),
n AS (SELECT *, coalesce(lead(m) OVER (PARTITION BY doc_id ORDER BY k), false) AS nm FROM j),
y AS (SELECT doc_id, any_value(md) AS md, string_agg(CASE WHEN k = 1 THEN '' WHEN m THEN ' ' ELSE {NL} || {NL} END || CASE WHEN m THEN st WHEN nm THEN rtrim(p, ' ' || chr(10) || chr(9) || chr(13)) ELSE p END, '' ORDER BY k) AS t FROM n GROUP BY doc_id) {DIGEST}"""

# post-processing
text_query("p_encoding", postprocess.encoding)
text_query("p_entities", lambda c: tk.swap(c, postprocess.ENTITIES), duck_swap("md", postprocess.ENTITIES))
text_query("p_noise", postprocess.noise, duck_rules("md", [(p, "") for p in postprocess.NOISE]), NOISY)
text_query("p_repeat_paras", postprocess.repeated_paragraphs)
ORACLE["p_repeat_paras"] = f"""WITH x AS ({MD}), {PARAS.removeprefix("WITH ")},
q AS (SELECT *, trim(p, ' ' || chr(10)) AS st, lower({duck_sub("p", [(r"\d+\s*of\s*\d+", ""), (r"\b\d{4,7}\b", ""), (r"[\s*_\[\]`#>()]", "")])}) AS key FROM pa),
c AS (SELECT *, count(*) FILTER (WHERE st <> '') OVER (PARTITION BY doc_id, key) AS n FROM q),
y0 AS (SELECT doc_id, string_agg(p, {NL} || {NL} ORDER BY k) AS t FROM c WHERE NOT (n >= 2 AND len(list_filter(string_split(st, {NL}), lambda z: trim(z) <> '')) <= 4 AND regexp_matches(p, '(?i)https?://|www\\.[a-z\\-]+\\.[a-z]{{2,}}|©|\\d{{4,7}}\\s*\\(\\d+\\s*of\\s*\\d+\\)|Downloaded from|published by|All rights reserved|licensee American Association|Use of this article is subject')) GROUP BY doc_id),
y AS (SELECT x.doc_id, x.md, coalesce(t, '') AS t FROM x LEFT JOIN y0 USING (doc_id)) {DIGEST}"""
text_query("p_watermarks", postprocess.watermarks)
text_query("p_spaces", postprocess.spaces)
ORACLE["p_spaces"] = f"WITH x AS ({MD}), " + SQUEEZED.removeprefix("WITH ")
text_query("p_citations", postprocess.citations, duck_sub("md", [(r"\[(\d+)\]\s*\[[–\-]\]\s*\[(\d+)\]", r"[\1–\2]"), (r"\[(\d+)\]\s*[–\-]\s*\[(\d+)\]", r"[\1–\2]"), (r"\[(\d+)\]\s*\[,\]\s*\[(\d+)\]", r"[\1,\2]"), (r"\[\[(\d+)\]\]", r"[\1]"), (r"\[\[\]\[(.*?)\]\[\]\]", r"[\1]"), (r"\(\s+(\d+(?:\s*[-–]\s*\d+)*(?:,\s*\d+)*)\s+\)", r"(\1)")]))
text_query("p_blank_lines", postprocess.blank_lines, f"regexp_replace(md, '\\n{{3,}}', {NL} || {NL}, 'g')")
text_query("p_mid_sentence", postprocess.mid_sentence)
ORACLE["p_mid_sentence"] = f"""WITH RECURSIVE x AS ({MD}), a AS (SELECT doc_id, md, string_split(md, {NL}) AS ls FROM x), {LINES.removeprefix("WITH ")},
w AS (SELECT *, lead(line) OVER z AS l1, lead(line, 2) OVER z AS l2 FROM ln WINDOW z AS (PARTITION BY doc_id ORDER BY k)),
g AS (SELECT doc_id, k FROM w WHERE trim(l1, ' ' || chr(9) || chr(13)) = '' AND NOT regexp_matches(l2, '^(?:$|#|!|\\$|\\*\\*|>|---)') AND trim(line) <> '' AND NOT regexp_matches(line, '^[#!\\[]') AND regexp_matches(trim(line, ' ' || chr(9) || chr(13)), '[a-z,]$') AND regexp_matches(trim(l2), '^[a-z]')),
r AS (SELECT doc_id, min(k) AS k FROM g GROUP BY doc_id UNION ALL SELECT r.doc_id, (SELECT min(g.k) FROM g WHERE g.doc_id = r.doc_id AND g.k >= r.k + 3) FROM r WHERE r.k IS NOT NULL),
tk AS (SELECT doc_id, k FROM r WHERE k IS NOT NULL),
y AS (SELECT ln.doc_id, any_value(ln.md) AS md, string_agg(CASE WHEN b.k IS NOT NULL THEN '' WHEN c.k IS NOT NULL THEN ' ' || trim(ln.line, ' ' || chr(9) || chr(13)) WHEN ln.k = 1 THEN ln.line ELSE {NL} || ln.line END, '' ORDER BY ln.k) AS t
  FROM ln LEFT JOIN tk b ON b.doc_id = ln.doc_id AND b.k = ln.k - 1 LEFT JOIN tk c ON c.doc_id = ln.doc_id AND c.k = ln.k - 2 GROUP BY ln.doc_id) {DIGEST}"""
text_query("p_universal", postprocess.universal)
text_query("p_bold_headings", postprocess.bold_headings, sql=OLD)
_PLAIN = "regexp_replace(trim(regexp_extract(s, '^\\*\\*(.+?)\\*\\*\\s*$', 1)), '\\*\\*([^*]+)\\*\\*', '\\1', 'g')"
ORACLE["p_bold_headings"] = f"""WITH x0 AS ({OLD}), x AS (SELECT doc_id, md AS md0, regexp_replace(md, '(\\*\\*\\d+\\.\\d+\\.?\\s+[^*\\n]+)\\*\\*\\n\\*\\*([^*\\n]+)\\*\\*', '\\1 \\2**', 'g') AS md FROM x0), {LINES.removeprefix("WITH ")},
p AS (SELECT *, trim(line) AS s FROM ln), q AS (SELECT *, {_PLAIN} AS c FROM p),
o AS (SELECT doc_id, k, CASE WHEN starts_with(s, '#') THEN regexp_replace(s, '\\*\\*([^*]+)\\*\\*', '\\1', 'g') WHEN NOT regexp_matches(s, '^\\*\\*(.+?)\\*\\*\\s*$') THEN line WHEN regexp_matches(c, '{re2(postprocess.BANNER)}') THEN ''
  WHEN regexp_matches(c, '{re2(postprocess.SECTION_START)}') THEN '## ' || trim(c) WHEN regexp_matches(c, '^\\d+\\.\\s+.+$') THEN '## ' || regexp_replace(c, '^(\\d+)\\.\\s+(.+)$', '\\1. \\2') WHEN regexp_matches(c, '^\\d+\\.\\d+\\.?\\s+.+$') THEN '### ' || regexp_replace(c, '^(\\d+\\.\\d+\\.?)\\s+(.+)$', '\\1 \\2')
  WHEN regexp_matches(c, '{postprocess.SECTION_PART}') THEN '## ' || c WHEN regexp_matches(c, '^(?:Figure|Fig\\.)\\s+\\d+[.|]') THEN '' ELSE line END AS n FROM q),
y AS (SELECT o.doc_id, any_value(x0.md) AS md, string_agg(n, {NL} ORDER BY k) AS t FROM o JOIN x0 USING (doc_id) GROUP BY o.doc_id) {DIGEST}"""
text_query("p_heading_levels", postprocess.heading_levels, duck_sub("md", [(r"(?m)^#[ \t]+(\d+)\.[ \t]+(.+)$", r"## \1. \2"), (r"(?m)^#[ \t]+(\d+\.\d+\.?)[ \t]+(.+)$", r"### \1 \2")]))
text_query("p_column_merge", postprocess.column_breaks)
ORACLE["p_column_merge"] = f"""WITH x AS ({MD}), {LINES.removeprefix("WITH ")},
s AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS st FROM ln),
g AS (SELECT *, regexp_matches(st, '^(?:$|#|- |\\* |\\d+\\.|\\||>|!\\[|\\$\\$|\\*\\*Authors:\\*\\*|\\*\\*Affiliations:\\*\\*|\\*\\*\\d+\\.)') AS pr FROM s),
m AS (SELECT *, k > 1 AND NOT pr AND NOT lag(pr) OVER (PARTITION BY doc_id ORDER BY k) AS j FROM g),
n AS (SELECT *, coalesce(lead(j) OVER (PARTITION BY doc_id ORDER BY k), false) AS nj FROM m),
y AS (SELECT doc_id, any_value(md) AS md, string_agg(CASE WHEN k = 1 THEN '' WHEN j THEN ' ' ELSE {NL} END || CASE WHEN j THEN st WHEN nj THEN rtrim(line, ' ' || chr(9) || chr(13)) ELSE line END, '' ORDER BY k) AS t FROM n GROUP BY doc_id) {DIGEST}"""
text_query("p_latex_blocks", postprocess.latex_blocks)
REFS_AT = "regexp_extract(md, '(?sm)(.*?)^#{1,3}\\s*(?:REFERENCES|References|Bibliography)\\b', 1)"
text_query("p_reference_numbers", postprocess.reference_numbers, f"CASE WHEN regexp_matches(md, '(?m)^#{{1,3}}\\s*(?:REFERENCES|References|Bibliography)\\b') THEN {REFS_AT} || " + duck_sub(f"substr(md, length({REFS_AT}) + 1)", [(r"(?m)^- w\s+\$x_\{?(\d+)\}?\$\s*", r"- [\1] "), (r"(?m)^- w x\s*\.\s*(\d+)\s+", r"- [\1] "), (r"(?m)^- (\d+) ([A-Z])", r"- \1. \2")]) + " ELSE md END", OLD)
text_query("p_ref_consolidate", postprocess.consolidate_references)
text_query("p_ref_boilerplate_cut", postprocess.reference_boilerplate, sql=OLD)
_ANY = lambda rules: "|".join(f"(?:{p})" for p in rules).replace("'", "''")
ORACLE["p_ref_boilerplate_cut"] = f"""WITH x AS ({OLD}), {LINES.removeprefix("WITH ")},
h AS (SELECT *, min(CASE WHEN regexp_matches(line, '^(?:#{{1,3}}\\s*\\*{{0,2}}\\s*|\\*{{1,3}})\\s*(?:REFERENCES|References|Bibliography)\\b') THEN k END) OVER (PARTITION BY doc_id) AS r FROM ln),
e AS (SELECT *, min(CASE WHEN k >= r AND regexp_matches(trim(line), '{_ANY(postprocess.ENDS)}') THEN k END) OVER (PARTITION BY doc_id) AS stop FROM h),
y AS (SELECT doc_id, any_value(md) AS md, string_agg(line, {NL} ORDER BY k) AS t FROM e WHERE k < r OR r IS NULL OR ((stop IS NULL OR k < stop) AND NOT regexp_matches(trim(line), '{_ANY(postprocess.DROPS)}')) GROUP BY doc_id) {DIGEST}"""
text_query("p_page_image_cap", postprocess.page_images)
text_query("p_marker_quirks", postprocess.marker_quirks, duck_rules("md", postprocess.MARKER), OLD)
text_query("p_pymupdf_quirks", postprocess.pymupdf_quirks)
text_query("p_docling_quirks", postprocess.docling_quirks)
text_query("f_fix_subscripts", align.fix_subscripts)
text_query("f_caption_numbers", align.fix_caption_numbers, duck_sub("md", [(r"(Figure|Fig\.) \$[^$\n]*\$ (\d+)", r"\1 \2")]))

# scores
COUNTS = ["n_display", "n_inline", "display_valid", "inline_valid", "not_decoded", "good_ctx", "n_fallback", "n_images", "n_captions_near", "u_escape", "ligature", "pua", "um_space", "n_h2plus", "table_rows", "n_tables", "n_refs"]
add("b_features", MD, lambda d: score.features(d).select("doc_id", *(F.col(c).cast("long").alias(c) for c in COUNTS)))
_VALID = "len(list_filter({0}, lambda z: {1} = ''))"
_BRACES = "regexp_replace(z, '[^{}]', '', 'g')"
for _ in range(6):
    _BRACES = f"replace({_BRACES}, '{{}}', '')"
_N = lambda p, e="md": f"len(regexp_extract_all({e}, '{p}'))"
FEATURES_SQL = f"""
a AS (SELECT *, regexp_replace(md, '\\${{2,}}', chr(1), 'g') AS m1 FROM x),
b AS (SELECT *, regexp_extract_all(md, '\\$\\$([\\s\\S]+?)\\$\\$', 1) AS disp, regexp_extract_all(m1, '\\$([^$\\n\\x01]+)\\$', 1) AS inl,
  regexp_replace(m1, '\\$([^$\\n\\x01]+)\\$', chr(2) || '\\1' || chr(3), 'g') AS mk, list_transform(regexp_extract_all(md, '(?m)^#{{2,6}} (.+)', 1), lambda z: trim(z)) AS heads FROM a),
ln AS (SELECT doc_id, unnest(string_split(md, {NL})) AS line, generate_subscripts(string_split(md, {NL}), 1) AS k FROM x),
l2 AS (SELECT doc_id, k, trim(line) AS st, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM ln WHERE starts_with(trim(line), '|')),
bl AS (SELECT doc_id, g, count(*) AS n, arg_min(st, k) AS h, sum(len(regexp_extract_all(st, '<br>'))) AS br, sum(CASE WHEN regexp_matches(st, '^\\|[-:| ]+\\|') THEN 0 ELSE 1 END) AS rows FROM l2 GROUP BY doc_id, g),
tb AS (SELECT doc_id, sum(rows) AS table_rows, count(*) AS n_tables FROM bl WHERE n >= 2 AND br < 0.4 * n AND NOT list_bool_or(list_transform(string_split(h, '|'), lambda z: regexp_matches(trim(z), '^Col\\d+$'))) GROUP BY doc_id),
fe AS (SELECT b.doc_id, source, md, heads, len(disp) AS n_display, len(inl) AS n_inline, {_VALID.format("disp", _BRACES)} AS display_valid, {_VALID.format("inl", _BRACES)} AS inline_valid,
  {_N("formula-not-decoded")} AS not_decoded, {_N("(?:^|[ \\n,.(;:\\[])\\x02[^\\x03]*\\x03[ \\n,.)%;:]", "regexp_replace(mk, '\\x03([ \\n,.)%;:])', chr(3) || '\\1\\1', 'g') || ' '")} AS good_ctx,
  {_N("(?m)^### Page \\d+")} AS n_fallback, {_N("!\\[.*?\\]\\(")} AS n_images, {_N("(?i)!\\[.*?\\]\\([^)]+\\)\\n{1,3}[*>]\\s*(?:Fig|Figure|Extended Data)[^\\n]+")} AS n_captions_near,
  {_N("/u[0-9A-Fa-f]{5}")} + {_N("/u[0-9A-Fa-f]{4}")} AS u_escape, {_N("/uniFB[0-9a-f]+")} AS ligature, {_N("[\\x{F000}-\\x{F0FF}]")} AS pua, {_N("µ [mMlLsSnNgGΩ][^a-zA-Z]")} AS um_space, len(heads) AS n_h2plus,
  coalesce(table_rows, 0) AS table_rows, coalesce(n_tables, 0) AS n_tables,
  greatest({_N("(?m)^\\[\\d+\\]")}, {_N("(?m)^-\\s+\\[\\d+\\]")}, {_N("(?m)^\\d+\\.\\s+[A-Z]")}, {_N("(?m)^- [A-Z][a-z]+,")}, {_N("(?m)^-\\s+\\d+\\.\\s+\\S")}) AS n_refs,
  {_N("formula-not-decoded")} + {_N("/u[0-9A-Fa-f]{4,5}")} + {_N("/uniFB[0-9a-f]+")} AS artifacts
  FROM b LEFT JOIN tb USING (doc_id))"""
ORACLE["b_features"] = f"WITH x AS ({MD}), {FEATURES_SQL} SELECT doc_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in COUNTS)} FROM fe"
PARTS = ["formula", "table", "image", "text_quality", "structure", "reference", "subtotal", "total", "grade"]


def _tiers(value: str, steps, other) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {a} THEN {b}" for a, b in steps) + f" ELSE {other} END"


_SEC = [r"(?i)a[\s\-]*b[\s\-]*s[\s\-]*t[\s\-]*r[\s\-]*a[\s\-]*c[\s\-]*t", r"(?i)introduction|1\.\s+intro", r"(?i)conclusion|discussion|summary|overview|background|scope", r"(?i)materials.and.methods|experimental|\bmethods?\b|results?\b"]
_SEEN = " + ".join(f"CASE WHEN len(list_filter(heads, lambda z: regexp_matches(z, '{p}'))) > 0 THEN 1 ELSE 0 END" for p in _SEC)
_TF = "(n_inline + n_display)"
UNIFIED_SQL = f"""
s1 AS (SELECT *, greatest(0.0, {_tiers(_TF, score.FORMULA_TIERS, 2.0)} - least(not_decoded * 2, 6))::DOUBLE AS ft, {_SEEN} AS seen FROM fe),
s2 AS (SELECT *, round(CASE WHEN {_TF} > 0 THEN least(25.0, ft + round((inline_valid + display_valid) / {_TF}::DOUBLE * 2, 2)) ELSE ft END, 2) AS formula,
  ({_tiers("table_rows", score.TABLE_TIERS, 7.0)})::DOUBLE AS "table", round(least(15.0, ({_tiers("n_images", score.IMAGE_TIERS, 0.0)})::DOUBLE + round(CASE WHEN n_images > 0 THEN n_captions_near / n_images::DOUBLE ELSE 0 END * 5, 2)), 2) AS image,
  round(greatest(0.0, 5.0 - u_escape) + greatest(0.0, 4.0 - ligature) + greatest(0.0, 3.0 - pua * 0.5) + greatest(0.0, 3.0 - um_space * 0.5) + greatest(0.0, 5.0 - artifacts), 2)::DOUBLE AS text_quality,
  round(CASE WHEN seen >= 3 THEN 6.0 ELSE round(seen / 4.0 * 6, 2) END::DOUBLE + round(least(n_h2plus / 6.0::DOUBLE, 1.0) * 4, 2) + greatest(0.0, 5.0 - n_fallback * 1.5), 2)::DOUBLE AS structure,
  ({_tiers("n_refs", score.REFERENCE_TIERS, 0.0)})::DOUBLE AS reference FROM s1),
s3 AS (SELECT *, round(formula + "table" + image + text_quality + structure + reference, 2) AS subtotal FROM s2),
sc AS (SELECT *, subtotal AS total, CASE WHEN subtotal >= 90 THEN 'S' WHEN subtotal >= 80 THEN 'A' WHEN subtotal >= 70 THEN 'B' WHEN subtotal >= 60 THEN 'C' ELSE 'D' END AS grade FROM s3)"""
add("b_unified_heuristic", MD, lambda d: score.score_unified(d).select("doc_id", *PARTS))
ORACLE["b_unified_heuristic"] = f"WITH x AS ({MD}), {FEATURES_SQL}, {UNIFIED_SQL} SELECT doc_id, {', '.join(chr(34) + c + chr(34) for c in PARTS)} FROM sc"
# Expected counts of papers (pages, figures, tables, captions, inline, insertable, display, headings).
TRUTH_ROWS = ((14, 5, 0, 5, 343, 218, 5, 8), (15, 5, 0, 5, 255, 207, 9, 6), (11, 6, 0, 6, 274, 200, 0, 5), (9, 5, 0, 5, 158, 123, 0, 8), (10, 6, 0, 6, 231, 178, 0, 5), (9, 5, 0, 5, 219, 178, 0, 5), (14, 5, 0, 5, 163, 137, 0, 8), (12, 6, 0, 6, 0, 0, 0, 5), (9, 14, 2, 14, 0, 0, 0, 5))
TRUTH = " UNION ALL ".join(f"SELECT {k} AS paper_key, {fig} AS exp_figures, {tab} AS exp_tables, {cap} AS exp_captions, {inl} AS exp_inline, {ins} AS exp_insertable, {dis} AS exp_display, {h2} AS min_h2" for k, (_, fig, tab, cap, inl, ins, dis, h2) in enumerate(TRUTH_ROWS))


def _with_truth(docs, truth):
    truth = truth.withColumns({"required": F.array(F.lit("introduction"), F.lit("Results"), F.lit("Methods")), "forbidden": F.array(F.lit("downloaded from"), F.lit("^©.*$"))})
    return score.score_unified(docs.withColumn("paper_key", F.col("doc_id") % len(TRUTH_ROWS)), truth).select("doc_id", *PARTS)


add("b_unified_gt", {"x": MD, "truth": TRUTH}, _with_truth)
_part = lambda got, want: f"CASE WHEN {want} > 0 THEN least({got} / nullif({want}, 0)::DOUBLE, 1.0) ELSE 1.0 END"
ORACLE["b_unified_gt"] = f"""WITH x AS ({MD}), truth AS ({TRUTH}), {FEATURES_SQL},
t1 AS (SELECT fe.*, truth.*, coalesce(nullif(exp_insertable, 0), exp_inline) AS want, n_images / greatest(exp_figures, 1)::DOUBLE AS r,
  CASE WHEN len(list_filter(heads, lambda z: contains(lower(z), 'introduction'))) > 0 THEN 1 ELSE 0 END + CASE WHEN len(list_filter(heads, lambda z: contains(lower(z), 'results'))) > 0 THEN 1 ELSE 0 END + CASE WHEN len(list_filter(heads, lambda z: contains(lower(z), 'methods'))) > 0 THEN 1 ELSE 0 END AS need,
  {_N("(?im)downloaded from")} + {_N("(?im)^©.*$")} AS left_over FROM fe JOIN truth ON fe.doc_id % {len(TRUTH_ROWS)} = truth.paper_key),
s2 AS (SELECT *, round(round({_part("n_inline", "want")} * 10, 2) + round({_part("n_display", "exp_display")} * 6, 2) + round(CASE WHEN {_TF} > 0 THEN (inline_valid + display_valid) / {_TF}::DOUBLE ELSE 1.0 END * 5, 2) + greatest(0.0, 4.0 - not_decoded), 2)::DOUBLE AS formula,
  CASE WHEN exp_tables = 0 THEN CASE WHEN table_rows = 0 THEN 10.0 ELSE greatest(0.0, 10.0 - table_rows) END ELSE round(least(table_rows / greatest(exp_tables * 5, 1)::DOUBLE, 1.0) * 10, 2) END::DOUBLE AS "table",
  round(CASE WHEN n_images = exp_figures THEN 10.0 WHEN r <= 1 THEN round(10 * r, 2) WHEN r <= 2 THEN round(greatest(0.0, 10 - (r - 1) * 5), 2) ELSE round(greatest(0.0, 5 - (r - 2) * 5), 2) END::DOUBLE + round(least(n_captions_near / greatest(exp_captions, 1)::DOUBLE, 1.0) * 5, 2), 2)::DOUBLE AS image,
  round(greatest(0.0, 5.0 - u_escape) + greatest(0.0, 4.0 - ligature) + greatest(0.0, 3.0 - pua * 0.5) + greatest(0.0, 3.0 - um_space * 0.5) + greatest(0.0, 5.0 - left_over), 2)::DOUBLE AS text_quality,
  round(round(need / 3.0::DOUBLE * 6, 2) + round(least(n_h2plus / min_h2::DOUBLE, 1.0) * 4, 2) + greatest(0.0, 5.0 - n_fallback * 1.5), 2)::DOUBLE AS structure,
  ({_tiers("n_refs", score.REFERENCE_TIERS, 0.0)})::DOUBLE AS reference FROM t1),
s3 AS (SELECT *, round(formula + "table" + image + text_quality + structure + reference, 2) AS subtotal FROM s2),
sc AS (SELECT *, subtotal AS total, CASE WHEN subtotal >= 90 THEN 'S' WHEN subtotal >= 80 THEN 'A' WHEN subtotal >= 70 THEN 'B' WHEN subtotal >= 60 THEN 'C' ELSE 'D' END AS grade FROM s3)
SELECT doc_id, {', '.join(chr(34) + c + chr(34) for c in PARTS)} FROM sc"""
QUICK = ["formula_score", "table_score", "image_score", "structure_score", "reference_score", "total"]
add("b_quick", MD, lambda d: score.quick(d).select("doc_id", *(F.col(c).cast("long").alias(c) for c in QUICK)))
add("b_latex_valid", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '{a{b}}' WHEN 1 THEN '}{' WHEN 2 THEN '{' || CAST(doc_id AS STRING) WHEN 3 THEN chr(92) || 'begin{a}x' || chr(92) || 'end{a}' ELSE text END AS s FROM documents", lambda d: d.select("doc_id", score.latex_valid(F.col("s")).alias("valid")), f"SELECT doc_id, {_BRACES.replace('z,', 's,')} = '' AS valid FROM x")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean unified score, and documents of each grade, by source."""
    d = score.score_unified(source(spark, sf_dir, MD))
    return d.groupBy("source").agg(F.count("*").alias("n_docs"), F.round(F.avg("total"), 4).alias("mean_total"), F.count_if(F.col("grade").isin("S", "A")).alias("n_good")).orderBy(F.desc("mean_total"), "source")


QUERIES["flagship"] = flagship
ORACLE["flagship"] = f"WITH x AS ({MD}), {FEATURES_SQL}, {UNIFIED_SQL} SELECT source, count(*) AS n_docs, round(avg(total), 4) AS mean_total, count(*) FILTER (WHERE grade IN ('S', 'A')) AS n_good FROM sc GROUP BY source"

# layout
ITEMS = """SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_linenumber % 2 + 1 AS page, CAST(l_partkey * 17 % 4000 AS BIGINT) AS area_px, l_linenumber % 3 AS depth,
  CAST(l_partkey % 500 AS DOUBLE) AS l, CAST(l_partkey % 500 + l_suppkey % 90 AS DOUBLE) AS r, CAST(l_suppkey * 7 % 700 AS DOUBLE) AS b, CAST(l_suppkey * 7 % 700 + 12 AS DOUBLE) AS t,
  CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_linenumber * 10 END AS md_start, ('item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag) AS content FROM __LI__"""
add("k_subpanel_filter", ITEMS, lambda d: layout.drop_subpanels(d).select("doc_id", "pos", "page", "area_px"), "WITH y AS (SELECT *, greatest(1600.0, 0.2 * max(area_px) OVER (PARTITION BY doc_id)) AS fl, max(area_px) OVER (PARTITION BY doc_id, page) AS pm FROM x) SELECT doc_id, pos, page, area_px FROM y WHERE area_px >= 1600 AND (area_px >= fl OR (pm >= fl AND area_px >= 0.95 * pm))")
add("k_figure_number", ITEMS, lambda d: layout.number_figures(d.filter("area_px >= 1600")).select("doc_id", "pos", F.col("fig_n").cast("long").alias("fig_n")), "SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS fig_n FROM x WHERE area_px >= 1600")
add("k_figure_ranges", ITEMS, lambda d: layout.figure_ranges(layout.figure_boxes(d)), "SELECT doc_id, page, min(b - 10) AS bottom, max(t + 100) AS top FROM x GROUP BY doc_id, page")
BOXES = "SELECT l_orderkey AS doc_id, l_linenumber % 2 + 1 AS page, CAST(l_partkey % 300 AS DOUBLE) AS l, CAST(l_partkey % 300 + 150 AS DOUBLE) AS r, CAST(l_suppkey % 300 AS DOUBLE) AS b, CAST(l_suppkey % 300 + 90 AS DOUBLE) AS t FROM __LI__ WHERE l_linenumber > 5"
add("k_figure_text_anti", {"x": ITEMS, "f": BOXES}, lambda d, f: layout.drop_figure_text(d, f).select("doc_id", "pos"), """WITH g AS (SELECT doc_id, page, min(b) AS bottom, max(t) AS top FROM f GROUP BY doc_id, page)
SELECT doc_id, pos FROM x WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = x.doc_id AND f.page = x.page AND x.depth < 2 AND (x.l + x.r) / 2 BETWEEN f.l AND f.r AND (x.t + x.b) / 2 BETWEEN f.b AND f.t)
AND NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = x.doc_id AND g.page = x.page AND x.depth < 2 AND x.r - x.l < 80 AND (x.t + x.b) / 2 BETWEEN g.bottom - 100 AND g.top + 450)""")
add("k_header_zone", ITEMS, lambda d: layout.in_header(d, F.col("area_px") > 3000).select("doc_id", "pos", "in_header"), "SELECT doc_id, pos, max(CASE WHEN area_px > 3000 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 AS in_header FROM x")
add("k_slot_rank", ITEMS, lambda d: layout.formula_slots(d.filter("depth = 1")).select("doc_id", "pos", "slot"), "SELECT doc_id, pos, '<!-- formula-slot:p' || page || ':' || row_number() OVER (PARTITION BY doc_id, page ORDER BY pos) || ':' || printf('%.1f:%.1f:%.1f:%.1f', l, t, r, b) || ' -->' AS slot FROM x WHERE depth = 1")
CAPTIONS = "SELECT l_orderkey AS doc_id, l_linenumber AS pos, CASE WHEN l_linenumber % 3 = 0 THEN 'img' ELSE 'caption' END AS type, CAST(l_partkey % 3 AS INT) AS fig_n, ('item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag) AS content FROM __LI__"
add("k_caption_group", CAPTIONS, layout.group_captions, "WITH c AS (SELECT doc_id, fig_n, content, row_number() OVER (PARTITION BY doc_id, fig_n ORDER BY length(content) DESC, pos) AS k FROM x WHERE type = 'caption') SELECT c.doc_id, c.fig_n, content AS caption, EXISTS (SELECT 1 FROM x WHERE x.type = 'img' AND x.doc_id = c.doc_id AND x.fig_n = c.fig_n) AS placed FROM c WHERE k = 1")
add("k_assemble", CAPTIONS, layout.assemble, f"SELECT doc_id, string_agg(content, {NL} || {NL} ORDER BY pos) AS md FROM x WHERE trim(content) <> '' GROUP BY doc_id")
IMAGES = "SELECT l_suppkey AS doc_id, l_orderkey * 10 + l_linenumber AS pos, 'f' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '.png' AS name, 'a/f' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '.png' AS ref, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_partkey * 131 % 40000 AS BIGINT) END AS bytes FROM __LI__"
add("k_small_images", IMAGES, lambda d: layout.drop_small_images(d, d).select("doc_id", "pos"), "SELECT doc_id, pos FROM x WHERE NOT EXISTS (SELECT 1 FROM x s WHERE s.doc_id = x.doc_id AND s.bytes < 8192 AND contains(x.ref, s.name))")
add("k_adaptive_topk", IMAGES, lambda d: layout.largest_images(d).select("doc_id", "pos"), "WITH y AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, count(bytes) OVER (PARTITION BY doc_id) AS s, row_number() OVER (PARTITION BY doc_id ORDER BY bytes DESC NULLS LAST, pos) AS k FROM x) SELECT doc_id, pos FROM y WHERE n <= 12 OR s <= 10 OR k <= 10")

# formula alignment
add("f_dynamic_threshold", "SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_partkey % 40 AS boxes, l_suppkey % 12 AS pages FROM __LI__", lambda d: d.select("doc_id", "pos", F.round(align.dynamic_threshold(F.col("boxes"), F.col("pages")), 6).alias("threshold")), "SELECT doc_id, pos, round(CASE WHEN pages <= 0 THEN 0.5 WHEN boxes / pages::DOUBLE <= 0.5 THEN 0.55 WHEN boxes / pages::DOUBLE >= 3 THEN 0.3 ELSE 0.55 - (boxes / pages::DOUBLE - 0.5) / 2.5 * 0.25 END, 6)::DOUBLE AS threshold FROM x")
DETECTIONS = "SELECT l_suppkey % 60 AS doc_id, l_orderkey * 10 + l_linenumber AS pos, l_linenumber % 7 AS page, CASE WHEN l_partkey % 8 = 0 THEN 1 ELSE 0 END AS cls, CAST(l_partkey * 13 % 997 AS DOUBLE) / 1000 AS conf FROM __LI__"
add("f_confident", {"x": DETECTIONS, "pg": "SELECT l_suppkey % 60 AS doc_id, max(l_linenumber) * 30 AS n_pages FROM __LI__ GROUP BY l_suppkey % 60", "ov": "SELECT n_nationkey AS doc_id, 0.45 AS mfd_conf_override FROM nation"}, lambda d, p, o: align.confident(d, p, o.withColumn("mfd_conf_override", F.col("mfd_conf_override").cast("double"))).select("doc_id", "pos"), """WITH c AS (SELECT doc_id, count(*) / n_pages::DOUBLE AS dn, coalesce(CAST(mfd_conf_override AS DOUBLE), CASE WHEN dn <= 0.5 THEN 0.55 WHEN dn >= 3 THEN 0.3 ELSE 0.55 - (dn - 0.5) / 2.5 * 0.25 END) AS th FROM x JOIN pg USING (doc_id) LEFT JOIN ov USING (doc_id) GROUP BY doc_id, n_pages, mfd_conf_override)
SELECT doc_id, pos FROM x JOIN c USING (doc_id) WHERE conf >= th""")
add("f_budget_trim", DETECTIONS, lambda d: align.trim_to_batch(d, 100).select("doc_id", "pos"), """WITH a AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, 100 - sum(cls) OVER (PARTITION BY doc_id) AS bud, row_number() OVER (PARTITION BY doc_id, cls ORDER BY conf DESC) AS k FROM x),
c AS (SELECT *, max(CASE WHEN cls = 0 AND k = bud THEN conf END) OVER (PARTITION BY doc_id) AS cut FROM a),
e AS (SELECT *, cls = 1 OR coalesce(conf >= cut, bud > 0) AS kp FROM c), g AS (SELECT *, sum(CASE WHEN kp THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS lf FROM e)
SELECT doc_id, pos FROM g WHERE n <= 100 OR kp OR lf > 100""")
FORMULAS = """SELECT l_orderkey AS doc_id, l_linenumber AS pos, l_linenumber % 2 + 1 AS page, CAST(l_suppkey % 450 AS DOUBLE) AS l, CAST(l_suppkey % 450 + 40 AS DOUBLE) AS r,
  CAST(l_partkey * 3 % 700 AS DOUBLE) AS b, CAST(l_partkey * 3 % 700 + 10 AS DOUBLE) AS t, substr(('item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag), 1, 22) AS latex FROM __LI__ WHERE l_linenumber % 2 = 1 OR l_partkey % 3 = 0"""
MATCHED = """m AS (SELECT f.doc_id, f.pos, s.pos AS span_pos, abs((f.t + f.b) / 2 - (s.t + s.b) / 2) AS dist, row_number() OVER (PARTITION BY f.doc_id, f.pos ORDER BY abs((f.t + f.b) / 2 - (s.t + s.b) / 2), s.pos) AS k
  FROM f JOIN x s ON f.doc_id = s.doc_id AND f.page = s.page AND s.md_start IS NOT NULL AND (f.t + f.b) / 2 BETWEEN s.b - 30 AND s.t + 30 AND f.l < s.r + 10 AND f.r > s.l - 10)"""
add("f_span_match", {"x": ITEMS, "f": FORMULAS}, lambda s, f: align.match_spans(f, s).select("doc_id", "pos", "span_pos", "dist"), f"WITH {MATCHED} SELECT f.doc_id, f.pos, m.span_pos, m.dist FROM f LEFT JOIN m ON m.doc_id = f.doc_id AND m.pos = f.pos AND m.k = 1")
add("f_unmatched_reason", {"x": ITEMS, "f": FORMULAS}, lambda s, f: align.unmatched_reason(align.match_spans(f, s), s).select("doc_id", "pos", "reason"), f"""WITH {MATCHED} SELECT f.doc_id, f.pos, CASE WHEN EXISTS (SELECT 1 FROM x s WHERE s.doc_id = f.doc_id AND s.page = f.page AND s.md_start IS NOT NULL AND (f.t + f.b) / 2 BETWEEN s.b - 30 AND s.t + 30) THEN 'x' ELSE 'y' END AS reason
FROM f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.doc_id = f.doc_id AND m.pos = f.pos)""")
add("f_slot_merge", {"x": ITEMS, "f": FORMULAS}, lambda s, f: align.merge_slots(s.filter("depth = 1"), f).select("doc_id", "page", F.col("k").cast("long").alias("k"), "slot_pos", "latex"), """WITH s AS (SELECT doc_id, page, pos AS slot_pos, row_number() OVER (PARTITION BY doc_id, page ORDER BY pos) AS k FROM x WHERE depth = 1),
g AS (SELECT doc_id, page, latex, row_number() OVER (PARTITION BY doc_id, page ORDER BY t DESC, pos) AS k FROM f) SELECT doc_id, page, k, slot_pos, latex FROM s FULL JOIN g USING (doc_id, page, k)""")
SUBFORMULAS = "SELECT l_orderkey % 500 AS doc_id, l_linenumber % 2 AS page, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) ELSE 'item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag END AS latex FROM __LI__"
add("f_subformula_anti", SUBFORMULAS, lambda d, parts: align.drop_subformulas(d, 5, parts).select("doc_id", "pos"), "WITH y AS (SELECT *, regexp_replace(latex, '\\s+', '', 'g') AS bare FROM x) SELECT doc_id, pos FROM y WHERE NOT EXISTS (SELECT 1 FROM y g WHERE g.doc_id = y.doc_id AND g.page = y.page AND length(y.bare) >= 5 AND length(g.bare) > length(y.bare) AND contains(g.bare, y.bare))", dealt=True)
add("f_overlap_greedy", "SELECT l_orderkey AS doc_id, CAST(l_partkey % 50 AS INT) AS s, CAST(l_partkey % 50 + l_suppkey % 9 AS INT) AS e FROM __LI__", lambda d: d.groupBy("doc_id").agg(align.accept_intervals(F.collect_list(F.struct(F.col("s").alias("start"), F.col("e").alias("end")))).alias("k")).select("doc_id", F.size("k").cast("long").alias("n_kept"), F.aggregate("k", F.lit(0), lambda a, x: a + x["start"]).cast("long").alias("sum_start")), """WITH RECURSIVE o AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY doc_id ORDER BY s, e) AS k FROM x),
w AS (SELECT doc_id, k, greatest(e, s + 1) AS last, 1 AS n, s AS t FROM o WHERE k = 1 UNION ALL SELECT o.doc_id, o.k, CASE WHEN o.s >= w.last THEN greatest(o.e, o.s + 1) ELSE w.last END, w.n + CASE WHEN o.s >= w.last THEN 1 ELSE 0 END, w.t + CASE WHEN o.s >= w.last THEN o.s ELSE 0 END FROM w JOIN o ON o.doc_id = w.doc_id AND o.k = w.k + 1)
SELECT doc_id, CAST(max(n) AS BIGINT) AS n_kept, CAST(max(t) AS BIGINT) AS sum_start FROM w GROUP BY doc_id""")

# learning
LOG = """SELECT l_suppkey AS paper, 'j' || CAST(l_suppkey % 7 AS STRING) AS journal, 'p' || CAST(l_suppkey AS STRING) AS paper_key,
  CASE l_linenumber WHEN 1 THEN '# Head ' || CAST(l_partkey % 3 AS STRING) WHEN 2 THEN 'a-b ' || CAST(l_partkey % 4 AS STRING) WHEN 3 THEN 'see $x$ here' WHEN 4 THEN CASE WHEN l_partkey % 5 = 0 THEN 'was $z$' ELSE '© ' || l_linestatus END WHEN 5 THEN '![f](a.png)' ELSE ('item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag) END AS "before",
  CASE l_linenumber WHEN 1 THEN '## Head' WHEN 2 THEN 'a–b ' || CAST(l_partkey % 4 AS STRING) WHEN 3 THEN 'see here' WHEN 4 THEN NULL WHEN 5 THEN '![f](b.png)' WHEN 6 THEN 'new $y$' ELSE ('item ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag) END AS "after" FROM __LI__"""
KIND = "CASE WHEN \"after\" IS NULL THEN 'boilerplate_removal' WHEN regexp_matches(\"before\", '\\$[^$]+\\$') OR regexp_matches(\"after\", '\\$[^$]+\\$') THEN 'formula_fix' WHEN regexp_matches(\"before\", '^#{1,6}\\s') OR regexp_matches(\"after\", '^#{1,6}\\s') THEN 'heading_change' WHEN regexp_matches(\"before\", '!\\[[^\\]]*\\]\\([^)]*\\)') OR regexp_matches(\"after\", '!\\[[^\\]]*\\]\\([^)]*\\)') THEN 'image_reorder' ELSE 'text_fix' END"
LOG_SPARK = LOG.replace('"before"', "before").replace('"after"', "after")
TYPED = f"c AS (SELECT *, {KIND} AS type FROM x)"
PARAMS = "SELECT 'j' || CAST(n_nationkey AS STRING) AS journal, CASE WHEN n_nationkey % 2 = 0 THEN 0.4 END AS conf FROM nation WHERE n_nationkey < 4"


def learned(name, run, oracle):
    """A query on typed corrections; the stored parameters are those of four journals."""

    def of(spark, sf_dir):
        c = source(spark, sf_dir, LOG_SPARK).withColumn("type", learn.classify(F.col("before"), F.col("after")))
        p = source(spark, sf_dir, PARAMS).select("journal", F.col("conf").cast("double").alias("mfd_conf_override"), F.array(F.lit("© F")).alias("extra_boilerplate_patterns"), F.create_map(F.lit("# Head 1"), F.lit("## Head")).alias("heading_remap"))
        return run(c, p)

    QUERIES[name] = of
    ORACLE[name] = f"WITH x AS ({LOG.replace('__LI__', LI)}), p AS ({PARAMS}), {TYPED}{', ' if oracle.startswith('WITH ') else ' '}{oracle.removeprefix('WITH ')}"


learned("l_counts_pivot", lambda c, p: learn.counts(c), "SELECT paper_key, " + ", ".join(f"count(*) FILTER (WHERE type = '{k}') AS {k}" for k in learn.KINDS) + " FROM c GROUP BY paper_key")
learned("l_rule_formula", lambda c, p: learn.formula_rule(c, p), """WITH n AS (SELECT journal, count(*) FILTER (WHERE type = 'formula_fix' AND coalesce(regexp_matches("after", '\\$[^$]+\\$'), false) AND NOT regexp_matches("before", '\\$[^$]+\\$')) AS a, count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("before", '\\$[^$]+\\$') AND NOT coalesce(regexp_matches("after", '\\$[^$]+\\$'), false)) AS d FROM c GROUP BY journal)
SELECT journal, 'lower' AS action, round(coalesce(CAST(conf AS DOUBLE), 0.45) - 0.05, 4) AS value, a AS n FROM n LEFT JOIN p USING (journal) WHERE a >= 3 UNION ALL SELECT journal, 'raise', round(coalesce(CAST(conf AS DOUBLE), 0.45) + 0.05, 4), d FROM n LEFT JOIN p USING (journal) WHERE d >= 3""")
learned("l_rule_boilerplate", lambda c, p: learn.boilerplate_rule(c, p), "SELECT journal, trim(\"before\") AS text, count(*) AS n FROM c WHERE type = 'boilerplate_removal' AND trim(\"before\") <> '' GROUP BY ALL HAVING count(*) >= 3 AND NOT (trim(\"before\") = '© F' AND journal IN (SELECT journal FROM p))")
learned("l_rule_heading", lambda c, p: learn.heading_rule(c, p), "SELECT journal, trim(\"before\") AS \"before\", trim(\"after\") AS \"after\", count(*) AS n FROM c WHERE type = 'heading_change' AND trim(\"before\") <> trim(\"after\") GROUP BY ALL HAVING count(*) >= 3 AND NOT (trim(\"before\") = '# Head 1' AND journal IN (SELECT journal FROM p))")
learned("l_rule_char", lambda c, p: learn.character_rule(c), """WITH z AS (SELECT journal, list_filter(list_zip(string_split("before", ''), string_split("after", '')), lambda q: q[1] <> q[2]) AS d FROM c WHERE type = 'text_fix' AND length("before") = length("after"))
SELECT journal, d[1][1] AS replace, d[1][2] AS with, count(*) AS n FROM z WHERE len(d) = 1 GROUP BY ALL HAVING count(*) >= 3""")
SCORES = "SELECT CASE WHEN l_suppkey % 11 = 0 THEN '_x' ELSE 'p' || CAST(l_suppkey AS STRING) END AS paper_key, 'e' || CAST(l_linenumber AS STRING) || '/m' || CAST(l_orderkey AS STRING) AS key_name, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_partkey * 7 % 1000 AS DOUBLE) / 10 END AS total FROM __LI__"
NEWER = SCORES.replace("'p' || CAST(l_suppkey", "'p' || CAST(l_suppkey + 3")
add("l_baseline", SCORES, learn.baseline, "SELECT paper_key, max(total) AS best_total FROM x WHERE NOT starts_with(paper_key, '_') GROUP BY paper_key")
add("l_regression", {"x": SCORES, "z": NEWER}, lambda a, b: learn.regressions(a.select("paper_key").distinct(), learn.baseline(a), learn.baseline(b)), """WITH k AS (SELECT DISTINCT paper_key FROM x), b AS (SELECT paper_key, max(total) AS v FROM x WHERE NOT starts_with(paper_key, '_') GROUP BY paper_key), c AS (SELECT paper_key, max(total) AS v FROM z WHERE NOT starts_with(paper_key, '_') GROUP BY paper_key)
SELECT k.paper_key, b.v AS baseline, c.v AS current, round(c.v - b.v, 3) AS delta, CASE WHEN b.v IS NULL THEN 'no_baseline' WHEN c.v IS NULL THEN 'no_current_score' WHEN round(c.v - b.v, 3) < -0.5 THEN 'regressed' ELSE 'ok' END AS status FROM k LEFT JOIN b USING (paper_key) LEFT JOIN c USING (paper_key)""")
REFS_A = "SELECT l_orderkey AS doc_id, l_linenumber AS idx, 'f' || CAST(l_partkey % 5 AS STRING) AS ref FROM __LI__ WHERE l_linenumber < 5"
REFS_B = "SELECT l_orderkey AS doc_id, l_linenumber AS idx, 'f' || CAST(l_suppkey % 5 AS STRING) AS ref FROM __LI__ WHERE l_linenumber < 5"
add("l_image_reorder", {"x": REFS_A, "z": REFS_B}, learn.image_reorders, "SELECT a.doc_id, a.ref, a.was, b.now FROM (SELECT doc_id, ref, max(idx) AS was FROM x GROUP BY ALL) a JOIN (SELECT doc_id, ref, max(idx) AS now FROM z GROUP BY ALL) b ON a.doc_id = b.doc_id AND a.ref = b.ref WHERE was <> now")
add("s_upsert", {"x": SCORES, "z": NEWER}, lambda a, b: learn.upsert(a, b, ["paper_key", "key_name"]), "SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.paper_key = x.paper_key AND z.key_name = x.key_name) UNION ALL SELECT * FROM z")
add("b_score_rank", SCORES, lambda d: metadata.rank_scores(d).select("paper_key", "key_name", "engine", "total", F.col("rank").cast("long").alias("rank")), "SELECT paper_key, key_name, string_split(key_name, '/')[1] AS engine, total, row_number() OVER (PARTITION BY paper_key ORDER BY coalesce(total, 0) DESC, key_name) AS rank FROM x")

# metadata
# Classification rules in file order.
TAXONOMY = "SELECT * FROM (VALUES (1, 'Display', 'LED', 'the'), (2, 'Electronics', 'Transistor', 'ing'), (3, 'Sensors', 'Strain', 'tion'), (4, 'Energy', 'Battery', 'heit'), (5, 'Energy', 'Battery', 'ung'), (6, 'Materials', 'Graphene', 'ción')) AS v(ord, major, middle, kw)"
_HELD = lambda words: " + ".join(f"CASE WHEN contains(lower(t), '{w}') THEN 1 ELSE 0 END" for w in words)
_MINOR_OF = f"SELECT *, {_HELD(['material', 'elastomer', 'polymer', 'composite', 'alloy', 'liquid metal', 'pdms', 'substrate', 'oxide skin', 'hydrogel', 'film'])} AS a, {_HELD('fabrication process printing lithography transfer coating deposition etching sintering annealing'.split())} AS b, {_HELD('device display sensor actuator led transistor electrode battery capacitor'.split())} AS c FROM x"
add("m_classify", {"x": "SELECT doc_id, text AS t FROM documents", "r": TAXONOMY}, lambda d, r: metadata.classify(d, r, F.col("t")).select("doc_id", "major", "middle", "minor", F.col("hits").cast("long").alias("hits")), f"""WITH h AS (SELECT doc_id, major, middle, count(*) AS n, min(ord) AS o FROM x JOIN r ON contains(lower(t), kw) GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, o) AS k FROM h), m AS ({_MINOR_OF})
SELECT m.doc_id, coalesce(major, '') AS major, coalesce(middle, '') AS middle, CASE WHEN greatest(a, m.b, c) = 0 THEN '' WHEN a >= m.b AND a >= c THEN '소재' WHEN m.b >= c THEN '공정' ELSE '소자' END AS minor, coalesce(n, 0) AS hits FROM m LEFT JOIN b ON b.doc_id = m.doc_id AND b.k = 1""")
# Journal profiles in match order (file keywords, journal keywords, known papers).
PROFILES = (("wiley_advanced_science", ("adma", "adfm", "small-str"), ("Advanced Materials", "Small"), ("p1", "p2")), ("springer_nature", ("nature", "npj"), ("Nature", "npj"), ("p3",)), ("aaas_science", ("sciadv",), ("Science",), ("p4",)), ("elsevier", ("sna",), ("Sensors and Actuators", "Advanced Energy Materials"), ()), ("acs", ("acs", "nl"), ("ACS Nano", "Nano Letters"), ("p9",)))
JOURNALS = "SELECT l_orderkey AS id, l_linenumber AS pos, CASE l_partkey % 7 WHEN 0 THEN 'npj-2d' WHEN 1 THEN 'Advanced Energy Materials' WHEN 2 THEN 'ACS Nano 2024' WHEN 3 THEN 'small str 12' WHEN 4 THEN 'Sciadv paper' WHEN 5 THEN 'other' ELSE 'zz' END AS query, 'p' || CAST(l_partkey % 12 AS STRING) || CASE WHEN l_suppkey % 3 = 0 THEN '_acs' ELSE '' END AS paper_key FROM __LI__"


def profiles(spark):
    return spark.createDataFrame([(k, p, list(f), list(j), list(q), None, 80.0) for k, (p, f, j, q) in enumerate(PROFILES)], "ord int, pid string, filename_keywords array<string>, journal_keywords array<string>, known_papers array<string>, rec_engine string, rec_score double")


def _first(conditions) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{p}'" for p, c in conditions) + " END"


_FORM = "translate(lower(query), '- ', '__')"
QUERIES["m_journal_match"] = lambda spark, sf_dir: metadata.match_journal(source(spark, sf_dir, JOURNALS).select("id", "pos", "query"), profiles(spark)).select("id", "pos", "pid")
ORACLE["m_journal_match"] = f"WITH x AS ({JOURNALS}) SELECT id, pos, {_first([(p, ' OR '.join([f'contains({_FORM}, {chr(39)}{w.replace(chr(45), chr(95))}{chr(39)})' for w in f] + [f'contains(lower(query), {chr(39)}{w.lower()}{chr(39)})' for w in j])) for p, f, j, _ in PROFILES])} AS pid FROM x"
QUERIES["l_detect_profile"] = lambda spark, sf_dir: metadata.detect_profile(source(spark, sf_dir, JOURNALS).select("id", "pos", "paper_key"), profiles(spark)).select("id", "pos", "journal")
ORACLE["l_detect_profile"] = f"WITH x AS ({JOURNALS}) SELECT id, pos, coalesce({_first([(p, 'paper_key IN (' + ', '.join(f'{chr(39)}{x}{chr(39)}' for x in q) + ')') for p, _, _, q in PROFILES if q])}, {_first([(p, ' OR '.join(f'contains(paper_key, {chr(39)}{w}{chr(39)})' for w in f)) for p, f, _, _ in PROFILES])}, 'unknown') AS journal FROM x"
QUERIES["b_profile_update"] = lambda spark, sf_dir: metadata.update_profiles(profiles(spark), source(spark, sf_dir, SCORES).select("paper_key", F.split("key_name", "/")[0].alias("engine"), "total").filter("total is not null")).select("pid", "rec_engine", "rec_score")
_KNOWN = " UNION ALL ".join(f"SELECT '{p}' AS pid, '{x}' AS paper_key" for p, _, _, q in PROFILES for x in q)
ORACLE["b_profile_update"] = f"WITH x AS ({SCORES}), kn AS ({_KNOWN}), pr(pid) AS (VALUES {', '.join(f'({chr(39)}{p}{chr(39)})' for p, *_ in PROFILES)}), b AS (SELECT pid, string_split(key_name, '/')[1] AS engine, total, row_number() OVER (PARTITION BY pid ORDER BY total DESC, string_split(key_name, '/')[1] DESC) AS k FROM x JOIN kn USING (paper_key) WHERE total IS NOT NULL) SELECT pr.pid, CASE WHEN total > 80 THEN engine END AS rec_engine, CASE WHEN total > 80 THEN total ELSE 80.0 END::DOUBLE AS rec_score FROM pr LEFT JOIN b ON b.pid = pr.pid AND b.k = 1"
add("m_keywords", "SELECT doc_id, text || chr(10) || 'Keywords: ' || source || ', b; c ,d,e, f' AS md FROM documents", lambda d: d.select("doc_id", F.array_join(metadata.keywords(F.col("md")), "|").alias("keywords"), F.regexp_extract("md", "Keywords: ([^,]*)", 1).alias("s")), "SELECT doc_id, regexp_extract(md, 'Keywords: ([^,]*)', 1) || '|b|c|d|e' AS keywords, regexp_extract(md, 'Keywords: ([^,]*)', 1) AS s FROM x")
add("x_bibkey_dedup", "SELECT l_orderkey % 300 AS doc_id, l_orderkey * 10 + l_linenumber AS pos, 'Lee' || CAST(l_partkey % 40 AS STRING) AS key FROM __LI__", metadata.unique_keys, "SELECT *, key || CASE WHEN row_number() OVER (PARTITION BY doc_id, key ORDER BY pos) > 1 THEN chr(CAST(96 + row_number() OVER (PARTITION BY doc_id, key ORDER BY pos) AS INT)) ELSE '' END AS bib_key FROM x")
HEADERS = "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'A|A|A|B|B|' || source || '|' || source || '|' || source ELSE 'A|||' || lang || '||B|B|B|B' END AS h FROM documents"
add("d_header_dedup", HEADERS, lambda d: d.select("doc_id", F.array_join(metadata.repeated_headers(F.split("h", r"\|")), "|").alias("kept")), "WITH a AS (SELECT doc_id, unnest(string_split(h, '|')) AS c, generate_subscripts(string_split(h, '|'), 1) AS k FROM x), b AS (SELECT *, lag(c) OVER w AS c1, lag(c, 2) OVER w AS c2 FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY k)) SELECT doc_id, string_agg(c, '|' ORDER BY k) AS kept FROM b WHERE c = '' OR NOT coalesce(c = c1 AND c = c2, false) GROUP BY doc_id")
add("d_header_markdown", HEADERS, lambda d: d.select("doc_id", F.md5(metadata.header_markdown(F.split("h", r"\|"))).alias("digest")), f"SELECT doc_id, md5('| ' || array_to_string(string_split(h, '|'), ' | ') || ' |' || {NL} || '| ' || array_to_string(list_transform(string_split(h, '|'), lambda z: repeat('-', greatest(length(z), 3))), ' | ') || ' |' || {NL} || '| ' || array_to_string(list_transform(string_split(h, '|'), lambda z: repeat(' ', greatest(length(z), 3))), ' | ') || ' |' || {NL} || '| ' || array_to_string(list_transform(string_split(h, '|'), lambda z: repeat(' ', greatest(length(z), 3))), ' | ') || ' |') AS digest FROM x")

# folds, files
text_query("p_abstract", postprocess.abstract)
add("p_postprocess", MD, lambda d: postprocess.postprocess(d, "hybrid").select("doc_id", F.md5("md").alias("digest"), F.length("md").cast("long").alias("n_chars")))
# two versions of a text: an end changed and a formula added; a first line removed; all lines changed; two images in each other's place; no change
PAIRS = r"""SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN '![a](1)' || chr(10) || 'k1' || chr(10) || 'k2' ELSE 'a' END || chr(10) || text || chr(10) || CASE WHEN doc_id % 5 = 3 THEN '![b](2)' || chr(10) ELSE '' END || 'end' AS original,
  CASE doc_id % 5 WHEN 0 THEN 'a' || chr(10) || text || chr(10) || 'new end' || chr(10) || 'x $y$' WHEN 1 THEN text || chr(10) || 'end' WHEN 2 THEN '~a' || chr(10) || '~' || replace(text, chr(10), chr(10) || '~') || chr(10) || '~end'
  WHEN 3 THEN '![b](2)' || chr(10) || 'k1' || chr(10) || 'k2' || chr(10) || text || chr(10) || '![a](1)' || chr(10) || 'end' ELSE 'a' || chr(10) || text || chr(10) || 'end' END AS corrected FROM documents"""
_KIND = r"CASE WHEN regexp_matches({0}, '\$[^$]+\$') OR regexp_matches({1}, '\$[^$]+\$') THEN 'formula_fix' WHEN regexp_matches({0}, '^#{{1,6}}\s') OR regexp_matches({1}, '^#{{1,6}}\s') THEN 'heading_change' WHEN regexp_matches({0}, '!\[[^\]]*\]\([^)]*\)') OR regexp_matches({1}, '!\[[^\]]*\]\([^)]*\)') THEN 'image_reorder' ELSE 'text_fix' END"
_STRIPPED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
add("l_diff", PAIRS, lambda d: linediff.corrections(d, F.col("original"), F.col("corrected")), f"""WITH t AS (SELECT *, len(string_split(original, {NL})) AS n, len(string_split(corrected, {NL})) AS m FROM x),
e AS (SELECT doc_id, unnest(range(1, n + 1)) AS line, {_STRIPPED.format(f"unnest(string_split(original, {NL}))")} AS "before", {_STRIPPED.format(f"unnest(string_split(corrected, {NL}))")} AS "after" FROM t WHERE doc_id % 5 = 2),
k AS (SELECT *, CASE WHEN "before" = '' THEN {_KIND.format('"after"', '"after"')} ELSE {_KIND.format('"before"', '"after"')} END AS type FROM e)
SELECT doc_id, CAST(n AS INT) AS line, 'end' AS "before", 'new end' AS "after", 'text_fix' AS type FROM t WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, CAST(m AS INT), '', 'x $y$', 'formula_fix' FROM t WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, 1, 'a', NULL, 'boilerplate_removal' FROM t WHERE doc_id % 5 = 1
UNION ALL SELECT doc_id, CAST(line AS INT), "before", "after", type FROM k WHERE type <> 'image_reorder'
UNION ALL SELECT doc_id, 2, 'position 1: ![a](1)', 'position 2: ![a](1)', 'image_reorder' FROM t WHERE doc_id % 5 = 3 UNION ALL SELECT doc_id, 1, 'position 2: ![b](2)', 'position 1: ![b](2)', 'image_reorder' FROM t WHERE doc_id % 5 = 3""")
SPANS = "SELECT doc_id, pos, pos % 2 AS page, CASE WHEN pos = 3 THEN 'never there' ELSE substr(text, pos * CAST(floor(length(text) / 4) AS INT) + 1, 24) END AS normed, false AS is_caption FROM documents CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(pos) WHERE length(text) > 0"
QUERIES["f_locate_spans"] = lambda spark, sf_dir: folds.locate_spans(source(spark, sf_dir, SPANS), source(spark, sf_dir, "SELECT doc_id, text AS md FROM documents")).select("doc_id", "pos", "md_start", "md_end")
QUERIES["f_locate_spans_by_page"] = lambda spark, sf_dir: folds.locate_spans(source(spark, sf_dir, SPANS), source(spark, sf_dir, "SELECT doc_id, text AS md FROM documents"), by_page=True).select("doc_id", "pos", "md_start", "md_end")
ORACLE["f_locate_spans"] = f"""WITH RECURSIVE s AS ({SPANS.replace("FROM documents CROSS JOIN", "FROM documents CROSS JOIN")}), w AS (
SELECT s.doc_id, s.pos, strpos(text, normed) - 1 AS a, length(normed) AS n, greatest(strpos(text, normed), 0) AS cur FROM s JOIN documents d USING (doc_id) WHERE pos = 0
UNION ALL SELECT s.doc_id, s.pos, CASE WHEN strpos(substr(text, cur + 1), normed) > 0 THEN cur + strpos(substr(text, cur + 1), normed) - 1 ELSE -1 END, length(normed), CASE WHEN strpos(substr(text, cur + 1), normed) > 0 THEN cur + strpos(substr(text, cur + 1), normed) ELSE cur END
FROM w JOIN s ON s.doc_id = w.doc_id AND s.pos = w.pos + 1 JOIN documents d ON d.doc_id = s.doc_id)
SELECT doc_id, pos, CAST(CASE WHEN a >= 0 THEN a END AS INT) AS md_start, CAST(CASE WHEN a >= 0 THEN a + n END AS INT) AS md_end FROM w"""


def _page_steps() -> str:
    """SQL for two pages of two spans each: the earlier one first, the second page from the first end found."""
    at = lambda x, s: f"CASE WHEN {x} <> '' AND strpos(substr(text, {s} + 1), {x}) > 0 THEN {s} + strpos(substr(text, {s} + 1), {x}) - 1 WHEN length({x}) > 1 AND ends_with({x}, '-') AND strpos(substr(text, {s} + 1), left({x}, length({x}) - 1)) > 0 THEN {s} + strpos(substr(text, {s} + 1), left({x}, length({x}) - 1)) - 1 ELSE -1 END"
    end = lambda x, s: f"CASE WHEN strpos(substr(text, {s} + 1), {x}) > 0 THEN {at(x, s)} + length({x}) ELSE {at(x, s)} + length({x}) - 1 END"
    sql = "w0 AS (SELECT s.doc_id, any_value(text) AS text, " + ", ".join(f"any_value(normed) FILTER (WHERE pos = {k}) AS n{k}" for k in range(4)) + ", 0 AS base0 FROM s JOIN documents USING (doc_id) GROUP BY s.doc_id)"
    for page in (0, 1):
        a, b, base = f"n{page}", f"n{page + 2}", f"base{page}"
        first = lambda x: f"CASE WHEN ({at(x, base)}) >= 0 THEN {at(x, base)} WHEN ({at(x, '0')}) >= 0 THEN {at(x, '0')} ELSE length(text) END"  # noqa: B023, E731
        sql += f", f{page} AS (SELECT *, ({first(a)}) <= ({first(b)}) AS keep{page} FROM w{page})"
        sql += f", o{page} AS (SELECT *, CASE WHEN keep{page} THEN {a} ELSE {b} END AS x{page}, CASE WHEN keep{page} THEN {b} ELSE {a} END AS y{page} FROM f{page})"
        sql += f", p{page} AS (SELECT *, {at(f'x{page}', base)} AS sx{page}, {end(f'x{page}', base)} AS ex{page} FROM o{page})"
        sql += f", c{page} AS (SELECT *, CASE WHEN sx{page} >= 0 THEN sx{page} + 1 ELSE {base} END AS cur{page} FROM p{page})"
        sql += f", q{page} AS (SELECT *, {at(f'y{page}', f'cur{page}')} AS sy{page}, {end(f'y{page}', f'cur{page}')} AS ey{page} FROM c{page})"
        sql += f", w{page + 1} AS (SELECT *, coalesce(least(CASE WHEN sx{page} >= 0 THEN ex{page} END, CASE WHEN sy{page} >= 0 THEN ey{page} END), {base}) AS base{page + 1} FROM q{page})"
    rows = [f"SELECT doc_id, CASE WHEN keep{p} = {first} THEN {p} ELSE {p + 2} END AS pos, CASE WHEN s{v}{p} >= 0 THEN s{v}{p} END AS md_start, CASE WHEN s{v}{p} >= 0 THEN e{v}{p} END AS md_end FROM w2" for p in (0, 1) for v, first in (("x", "true"), ("y", "false"))]
    return sql + " SELECT doc_id, pos, CAST(md_start AS INT) AS md_start, CAST(md_end AS INT) AS md_end FROM (" + " UNION ALL ".join(rows) + ")"


ORACLE["f_locate_spans_by_page"] = f"WITH s AS ({SPANS}), {_page_steps()}"
add("k_move_figures", "SELECT l_orderkey AS doc_id, l_linenumber AS pos, CASE l_partkey % 4 WHEN 0 THEN 'img' WHEN 1 THEN 'text' WHEN 2 THEN 'caption_inline' ELSE 'text' END AS type FROM __LI__", lambda d: folds.move_figures(d).select("doc_id", "pos", "order"))
add("s_front_matter", "SELECT doc_id, '---' || chr(10) || 'title: \"' || source || '\"' || chr(10) || 'lang: ' || lang || chr(10) || '---' || chr(10) || text AS md FROM documents".replace('\\"', '"'), lambda d: d.withColumn("m", io.front_matter(F.col("md"))).select("doc_id", F.col("m")["title"].alias("title"), F.col("m")["lang"].alias("lang"), F.md5(io.without_front_matter(F.col("md"))).alias("digest")), "SELECT x.doc_id, source AS title, lang, md5(ltrim(text, chr(10))) AS digest FROM x JOIN documents USING (doc_id)")

# references and LaTeX
BIB = "SELECT doc_id, '[1] H. W. Choi, J. Lee, Adv. Mater. ' || CAST(1990 + doc_id % 30 AS STRING) || ', 36, 1. DOI: 10.1002/adma.' || CAST(doc_id AS STRING) || chr(10) || '[2] A. Roe, et al., Nano Lett. ' || CAST(1990 + doc_id % 7 AS STRING) || ', 2.' || chr(10) || '3. no year here' AS block FROM documents"
add("x_refs", BIB, lambda d: latex.parse_references(d, F.col("block")).select("doc_id", "num", "key", "authors", "journal", "year", "doi"), """WITH y AS (SELECT doc_id, CAST(1990 + doc_id % 30 AS VARCHAR) AS y1, CAST(1990 + doc_id % 7 AS VARCHAR) AS y2 FROM x)
SELECT doc_id, 1 AS num, 'Lee' || y1 AS key, 'H. W. Choi, J. Lee' AS authors, 'Adv. Mater.' AS journal, y1 AS year, '10.1002/adma.' || doc_id AS doi FROM y UNION ALL SELECT doc_id, 2, 'Roe' || y2, 'A. Roe et al.', 'Nano Lett.', y2, '' FROM y UNION ALL SELECT doc_id, 3, 'ref3', 'no year here', '', '', '' FROM y""")
add("x_references_block", MD, lambda d: d.select("doc_id", F.length(latex.references_block(F.col("md"))).cast("long").alias("n")), "SELECT doc_id, CAST(41 * (doc_id % 30) + 1 AS BIGINT) AS n FROM x")
add("x_cite_map", "SELECT doc_id, 'see [1], [2,' || CAST(doc_id % 5 AS STRING) || '] and [1–3] or [9]' AS t FROM documents", lambda d: d.select("doc_id", latex.cite(F.col("t"), F.create_map(*(F.lit(z) for p in ((1, "a"), (2, "b"), (3, "c")) for z in p))).alias("t")), """SELECT doc_id, 'see ' || chr(92) || 'cite{a}, ' || chr(92) || 'cite{b' || CASE doc_id % 5 WHEN 1 THEN ',a' WHEN 2 THEN ',b' WHEN 3 THEN ',c' ELSE '' END || '} and ' || chr(92) || 'cite{a,c} or [9]' AS t FROM x""")
add("x_table_spec", "SELECT doc_id, '| a | b |' || chr(10) || '|---|---|' || chr(10) || repeat('| 1 |' || chr(10), CAST(doc_id % 4 AS INT)) || '| x | y | z |' AS t FROM documents", lambda d: d.select("doc_id", latex.table(F.col("t")).alias("t")), f"""SELECT doc_id, chr(92) || 'begin{{tabular}}{{lll}}' || {NL} || chr(92) || 'toprule' || {NL} || 'a & b & ' || ' ' || repeat(chr(92), 2) || {NL} || chr(92) || 'midrule' || {NL} || repeat('1 &  &  ' || repeat(chr(92), 2) || {NL}, CAST(doc_id % 4 AS INT)) || 'x & y & z ' || repeat(chr(92), 2) || {NL} || chr(92) || 'bottomrule' || {NL} || chr(92) || 'end{{tabular}}' AS t FROM x""")
add("x_preamble", "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'wiley' WHEN 1 THEN 'NATURE' WHEN 2 THEN 'acs' WHEN 3 THEN 'elsevier' WHEN 4 THEN 'other' ELSE 'generic' END AS j FROM documents", lambda d: d.select("doc_id", latex.preamble(F.col("j")).alias("p")).select("doc_id", F.regexp_extract("p", r"^(.*)", 1).alias("head"), F.element_at(F.split("p", "\n"), -1).alias("last"), F.regexp_count("p", F.lit(r"\\usepackage")).cast("long").alias("n_packages")), "SELECT doc_id, CASE doc_id % 6 WHEN 2 THEN '\\documentclass{achemso}' WHEN 3 THEN '\\documentclass[preprint,12pt]{elsarticle}' ELSE '\\documentclass[12pt]{article}' END AS head, CASE doc_id % 6 WHEN 0 THEN '% Wiley submission: XeLaTeX 권장 (로컬 MikTeX에서는 pdflatex도 가능)' WHEN 1 THEN '% Nature submission: 12pt, double-spaced, line numbers 권장' WHEN 2 THEN '% \\SectionNumbersOn  % 섹션 번호 사용 시' WHEN 3 THEN '\\biboptions{authoryear}' ELSE '\\emergencystretch=5em' END AS last, (CASE doc_id % 6 WHEN 0 THEN 14 WHEN 1 THEN 12 WHEN 2 THEN 5 WHEN 3 THEN 5 ELSE 16 END)::BIGINT AS n_packages FROM x")
add("m_title", MD, lambda d: d.select("doc_id", metadata.title(F.col("md")).alias("title"), metadata.author_line(F.col("md")).alias("author_line")), "SELECT doc_id, 'Study ' || doc_id AS title, 'J. Doe, A. Roe*' AS author_line FROM x")
add("m_authors", "SELECT doc_id, 'J. Doe 1,2, ' || source || ',* and K. Lee & M. Ray†' AS line FROM documents", lambda d: d.select("doc_id", F.array_join(F.transform(metadata.authors(F.col("line")), lambda a: F.concat(a["name"], F.when(a["corresponding"], "*").otherwise(""))), "|").alias("authors")), "SELECT doc_id, 'J. Doe|' || regexp_extract(line, '1,2, (.*),[*]', 1) || '*|K. Lee|M. Ray*' AS authors FROM x")
add("s_zip_by_rank", {"x": CAPTIONS, "z": IMAGES}, lambda a, b: metadata.zip_by_rank(a.filter("type = 'caption'").select("doc_id", "pos"), b.select("doc_id", "pos", F.col("name").alias("value"))).select("doc_id", "pos", "matched"), "WITH a AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM x WHERE type = 'caption'), b AS (SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM z) SELECT a.doc_id, a.pos, b.name AS matched FROM a LEFT JOIN b ON a.doc_id = b.doc_id AND a.k = b.k")

#: Texts with Greek letters and small characters of several kinds, some of them in formulas and blocks.
GREEKY = "SELECT doc_id, '_ν_ of E₁₂ x⁴ μ $α$ Tₓ⁻¹ Δ₂' || chr(10) || '$$' || chr(10) || 'α x₂' || chr(10) || ' $$ ' || chr(10) || translate(text, 'xqzvkj', 'ν𝜈₂⁴σ$') || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '$$' ELSE 'β⁺ $x_ν$ _𝜃_γ' END || chr(10) || text || ' ω₁' AS md FROM documents"
_SMALL = lambda z: "CASE WHEN length({0}) = 0 THEN '' WHEN length({0}) = 1 THEN '{1}' || {0} ELSE '{1}{{' || {0} || '}}' END".format(*z)
_SCRIPTS = f"'$' || regexp_extract(z, '^([A-Za-zα-ωΑ-Ω]*)', 1) || " + _SMALL((f"translate(regexp_replace(z, '[^{captions.LOWERED}]', '', 'g'), '{captions.LOWERED}', '{captions.LOWERED_AS}')", "_")) + " || " + _SMALL((f"translate(regexp_replace(z, '[^{captions.RAISED}]', '', 'g'), '{captions.RAISED}', '{captions.RAISED_AS}')", "^")) + " || '$'"


def regrouped(expr: str, pattern: str, made: str) -> str:
    """SQL for every match z of a pattern replaced by ``made``."""
    found = f"list_transform(regexp_extract_all({expr}, '{pattern}'), lambda z: {made})"
    return f"array_to_string(list_transform(string_split_regex({expr}, '{pattern}'), lambda g, i: g || coalesce(({found})[i], '')), '')"


def _outside(expr: str, made: str) -> str:
    """SQL for ``made`` of every piece p between formulas."""
    pattern = r"\$[^$\n]+\$"
    return f"array_to_string(list_transform(string_split_regex({expr}, '{pattern}'), lambda p, i: ({made}) || coalesce((regexp_extract_all({expr}, '{pattern}'))[i], '')), '')"


text_query("p_inline_math", captions.inline_math, sql=GREEKY)
_NAMED = [(g, f"$\\{n}$") for g, n in captions.GREEK.items()]
ORACLE["p_inline_math"] = f"""WITH x AS ({GREEKY}), {LINES.removeprefix("WITH ")},
s AS (SELECT *, sum(CASE WHEN trim(line) = '$$' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) % 2 = 1 OR trim(line) = '$$' AS block FROM ln),
a AS (SELECT *, {duck_swap("line", [(f"_{g}_", n) for g, n in _NAMED])} AS l1 FROM s), b AS (SELECT *, {_outside("l1", regrouped("p", "[A-Za-zα-ωΑ-Ω]*[₀-₉ₐₑₒₓ⁰-⁹⁺⁻]+", _SCRIPTS))} AS l2 FROM a),
c AS (SELECT *, {_outside("l2", duck_swap("p", _NAMED))} AS l3 FROM b), y AS (SELECT doc_id, any_value(md) AS md, string_agg(CASE WHEN block THEN line ELSE l3 END, {NL} ORDER BY k) AS t FROM c GROUP BY doc_id) {DIGEST}"""
#: Texts with captions of one and more lines, some of one number, and images with and without a caption.
CAPTIONED = "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Fig. 7. at the top' || chr(10) ELSE '![](x)' || chr(10) || chr(10) END || text || chr(10) || '**Figure 2.** Two' || chr(10) || 'goes on' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'figure 1| One **bold**' ELSE '. . Fig. ' || CAST(doc_id % 5 AS STRING) || '. Dots' END || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'more' END || chr(10) || '![](y)' || chr(10) || '> kept' || chr(10) || '![](z)' || chr(10) || chr(10) || text || chr(10) || CASE WHEN doc_id % 7 = 0 THEN 'Fig. 2. Again' || chr(10) || '# End' ELSE '' END || chr(10) || '![](w)' || chr(10) || ' ![](v)' AS md FROM documents"
text_query("p_caption_zip", captions.place_captions, sql=CAPTIONED)
ORACLE["p_caption_zip"] = f"""WITH x AS ({CAPTIONED}), {LINES.removeprefix("WITH ")},
d AS (SELECT doc_id, k, CASE WHEN regexp_matches(trim(line), '(?i)^\\.\\s*\\.\\s*\\.?\\s*(?:Fig\\.?|Figure)\\s+[0-9]+[.|]') THEN regexp_replace(trim(line), '^\\.\\s*\\.\\s*\\.?\\s*', '') ELSE line END AS line FROM ln),
r AS (SELECT *, try_cast(regexp_extract(line, '(?i)^\\s*(?:\\*\\*)?(?:Figure|Fig\\.)\\s+([0-9]+)[.|]', 1) AS INT) AS num, regexp_matches(line, '(?i)^\\s*(?:\\*\\*)?(?:Figure|Fig\\.)\\s+[0-9]+[.|]') AS opens, regexp_matches(trim(line), '^(?:$|#|!\\[|>)') AS shuts FROM d),
g AS (SELECT *, sum(CASE WHEN shuts AND NOT opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS grp, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS cap FROM r),
i AS (SELECT *, coalesce(k >= min(CASE WHEN opens THEN k END) OVER (PARTITION BY doc_id, grp), false) AS inside FROM g),
j AS (SELECT *, coalesce(lag(inside) OVER w, false) AS inside_before, lag(line) OVER w AS line_before FROM i WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
c AS (SELECT doc_id, cap, max(num) AS num, string_agg(trim(line), ' ' ORDER BY k) AS t FROM j WHERE inside GROUP BY doc_id, cap),
q AS (SELECT doc_id, trim(regexp_replace(regexp_replace(arg_max(t, cap), '\\*\\*([^*]+)\\*\\*', '\\1', 'g'), '\\*\\*', '', 'g')) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY num) AS nth FROM c GROUP BY doc_id, num),
kept AS (SELECT doc_id, k, CASE WHEN inside THEN '' ELSE line END AS line FROM j WHERE NOT inside OR (NOT inside_before AND coalesce(line_before, '-') <> '')),
f AS (SELECT *, lead(trim(line)) OVER (PARTITION BY doc_id ORDER BY k) AS nxt FROM kept WHERE trim(line) <> ''),
e AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS nth FROM f WHERE starts_with(trim(line), '![') AND NOT coalesce(regexp_matches(nxt, '^(?:> |\\*Figure|\\*Fig\\.)'), false)),
o AS (SELECT kept.doc_id, kept.k, line || CASE WHEN q.t IS NULL THEN '' ELSE {NL} || {NL} || '> ' || q.t END AS line FROM kept LEFT JOIN e ON e.doc_id = kept.doc_id AND e.k = kept.k LEFT JOIN q ON q.doc_id = e.doc_id AND q.nth = e.nth),
y AS (SELECT x.doc_id, x.md, o.t FROM x JOIN (SELECT doc_id, string_agg(line, {NL} ORDER BY k) AS t FROM o GROUP BY doc_id) o USING (doc_id)) {DIGEST}"""
add("b_report", MD, lambda d: score.report(score.score_unified(d)))
ORACLE["b_report"] = f"WITH x AS ({MD}), {FEATURES_SQL}, {UNIFIED_SQL}, u AS (" + " UNION ALL ".join(f"SELECT doc_id, '{c}' AS category, \"{c}\" AS score, {m}.0::DOUBLE AS most, subtotal FROM sc" for c, m in score.MOST.items()) + ") SELECT doc_id, category, score, most, round(score / most, 4) AS share, CASE WHEN score / most >= 0.8 THEN 'green' WHEN score / most >= 0.6 THEN 'yellow' ELSE 'red' END AS color, round(subtotal * 100 / 95, 2) AS of_100 FROM u"


def _thresholds(c, p):
    held = p.select("journal", "mfd_conf_override").withColumn("history", F.array().cast("array<struct<date:string,param:string,old:string,new:string,reason:string>>"))
    got = learn.apply_thresholds(held, learn.formula_rule(c, p), F.lit("2024-01-01"))
    return got.select("journal", "mfd_conf_override", F.size("history").cast("long").alias("n_changes"))


learned("l_apply", _thresholds, """WITH n AS (SELECT journal, count(*) FILTER (WHERE type = 'formula_fix' AND coalesce(regexp_matches("after", '\\$[^$]+\\$'), false) AND NOT regexp_matches("before", '\\$[^$]+\\$')) AS a, count(*) FILTER (WHERE type = 'formula_fix' AND regexp_matches("before", '\\$[^$]+\\$') AND NOT coalesce(regexp_matches("after", '\\$[^$]+\\$'), false)) AS d FROM c GROUP BY journal)
SELECT coalesce(n.journal, p.journal) AS journal, CASE WHEN d >= 3 THEN round(coalesce(CAST(conf AS DOUBLE), 0.45) + 0.05, 4) WHEN a >= 3 THEN round(coalesce(CAST(conf AS DOUBLE), 0.45) - 0.05, 4) ELSE CAST(conf AS DOUBLE) END AS mfd_conf_override, CAST((coalesce(a, 0) >= 3)::INT + (coalesce(d, 0) >= 3)::INT AS BIGINT) AS n_changes FROM n FULL JOIN p ON n.journal = p.journal WHERE p.journal IS NOT NULL OR a >= 3 OR d >= 3""")

# boilerplate of layout items
TEXTS = """SELECT l_orderkey AS doc_id, l_linenumber AS pos, CASE l_partkey % 22 WHEN 0 THEN 'www.advmat.de' WHEN 1 THEN 'https://x.org/a' WHEN 2 THEN 'Adv. Mater. 2024 , 10 , 24' WHEN 3 THEN ' SCIENCE  NEWS ' WHEN 4 THEN 'DOI: 10.1002/a' WHEN 5 THEN '© 2024 W' WHEN 6 THEN 'nature electronics' WHEN 7 THEN 'Research Article' WHEN 8 THEN '2 School of Physics' WHEN 9 THEN 'E-mail: a@b.c'
  WHEN 10 THEN 'x, RepublicofKorea' WHEN 11 THEN repeat('long ', 50) || 'Republic of Korea' WHEN 12 THEN 'Seoul 02841' WHEN 13 THEN 'D.W.Lee,J.G.Son' WHEN 14 THEN 'J. Cho' WHEN 15 THEN '1. Introduction' WHEN 16 THEN 'Soft Hybrid Materials Research Center' WHEN 17 THEN 'University of Science & Technology (UST)' WHEN 18 THEN 'J.-C. Choi, H. Jeong, S. Chung' WHEN 19 THEN 'the ORCID is 0000' ELSE 'Body text ' || CAST(l_suppkey AS STRING) END AS content FROM __LI__"""
_HAS = lambda rules: " OR ".join(f"regexp_matches(s, '{re2(p)}')" for p in rules)
add("k_boilerplate", TEXTS, lambda d: layout.drop_boilerplate(d).select("doc_id", "pos", "content"), f"""WITH y AS (SELECT *, trim(content) AS s FROM x),
z AS (SELECT *, max(CASE WHEN regexp_matches(s, '{layout.BODY_HEADING}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 AS head FROM y)
SELECT doc_id, pos, content FROM z WHERE NOT ({_HAS(layout.TEMPLATE)}) AND (head OR NOT ({_HAS(layout.AUTHORS)} OR (length(s) <= 200 AND ({_HAS(layout.LOOSE)}))))""")

ORACLE = {k: v.replace("__LI__", LI) for k, v in ORACLE.items()}

from . import files, papers  # noqa: E402, F401  more queries, added to the same tables
