"""Text rules on hand-made cases whose results follow from the rules' wording."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from paperloom.functions import textkit as tk
from paperloom.operators import align, layout, learn, metadata, normalize, postprocess, score

CASES = [
    (normalize.ligatures, "e/uniFB03cient ﬁlm", "efficient film"),
    (normalize.hyphens, "high/C0 speed", "high-speed"),
    (normalize.citation_parens, "( 1 - 3, 5 ) and (x)", "(1 - 3, 5) and (x)"),
    (normalize.glyph_names, "a/hairspace b/ThinSpace", "a b"),
    (normalize.unicode_escapes, "/u03bd x /u03bda /u1D708", "ν x 㯚 \U0001d708"),
    (normalize.micro_units, "5 µ m, 5 µ ma", "5 µm, 5 µm a"),
    (normalize.volume_spacing, "40 , 198", "40, 198"),
    (normalize.symbols, "", "αµϕ"),
    (normalize.spaces, "a b c", "a b c"),
    (normalize.squeeze_outside_code, "a   b\n```x   y\nc   d\n```  e   f\n|  g |\nh   i", "a b\n```x   y\nc   d\n``` e f\n|  g |\nh i"),
    (normalize.squeeze_outside_code, "```\nopen   code", "```\nopen   code"),
    (normalize.merge_paragraphs, "The film\n\nwas grown.\n\nnext", "The film was grown.\n\nnext"),
    (normalize.merge_paragraphs, "A \n\n b\n\n(Cd) e\n\n# F\n\ng", "A b (Cd) e\n\n# F\n\ng"),
    (normalize.download_banners, "a\n1234adma, 2024, 5, Downloaded from https://x.y\nb", "a\nb"),
    (normalize.normalize_fast, "** **a****b (_1_, _2_)", " ab (1, 2)"),
    (postprocess.encoding, "&amp;lt; <sup>2</sup> A<sub>3</sub> <span id=1>s</span>", "< ^2 A_3 s"),
    (postprocess.encoding, "A fi lm", "A film"),
    (postprocess.encoding, "the fi lm", "thefilm"),
    (postprocess.repeated_paragraphs, "© 2024 X\n\nbody\n\n© 2024 X", "body"),
    (postprocess.repeated_paragraphs, "same\n\nbody\n\nsame", "same\n\nbody\n\nsame"),
    (postprocess.noise, "a\n© 2024 Wiley\nwww.nature.com x\nb", "a\n\n\nb"),
    (postprocess.citations, "[1] - [3] [1] [,] [2] [[4]] ( 1 )", "[1–3] [1,2] [4] (1)"),
    (postprocess.mid_sentence, "a\n\nb\n\nc", "a b\n\nc"),
    (postprocess.mid_sentence, "a.\n\nb", "a.\n\nb"),
    (postprocess.blank_lines, "a\n\n\n\nb", "a\n\nb"),
    (postprocess.heading_levels, "# 2. R\n# 2.1 X\n# Other", "## 2. R\n### 2.1 X\n# Other"),
    (postprocess.bold_headings, "**1. Introduction**\n**2.1. Sub**\n**goes on**\n\n**RESULTS and more**\n**plain bold**\n## **x** y\n**Figure 1. z**\n**A B C**", "## 1. Introduction\n### 2.1. Sub goes on\n\n## RESULTS and more\n**plain bold**\n## x y\n\n"),
    (postprocess.column_breaks, "one\ntwo\n\n# h\nthree\n- item\nfour\nfive", "one two\n\n# h\nthree\n- item\nfour five"),
    (postprocess.latex_blocks, "[−][3] $x$nm $a\\tag{1}$", "⁻³ $x$ nm $$\na\\tag{1}\n$$"),
    (postprocess.reference_numbers, "- 1 A\n## References\n- 1 Au\n- w $x_{2}$ B\n- $^{10} \\mathrm { L } .$ rest", "- 1 A\n## References\n- 1. Au\n- [2] B\n- 10. L. rest"),
    (postprocess.consolidate_references, "x\n# References\n12.\nA. Au\n\nNature 2020\n13. B", "x\n# References\n12. A. Au Nature 2020\n\n13. B"),
    (postprocess.reference_boilerplate, "Article\n## References\n[1] a\nAccepted 3 May\n[2] b\n**View the article online** z\n[3] c", "Article\n## References\n[1] a\n[2] b"),
    (postprocess.page_images, "".join(f"![a](p.pdf-4-{k}.png)\n" for k in range(3)) + "![a](p.pdf-5-0.png)", "![a](p.pdf-4-0.png)\n![a](p.pdf-4-1.png)\n\n![a](p.pdf-5-0.png)"),
    (postprocess.marker_quirks, "- [3] A\n# Conclusions\n![](_page_1_Picture_2.jpeg)\n", "[3] A\n## Conclusions\n"),
    (postprocess.pymupdf_quirks, "x\n\n2. Results\n\ny", "x\n\n## 2. Results\n\ny"),
    (align.fix_subscripts, r"$\theta$ 0, and l 0, is", r"$\theta_{0}$, and $l_{0}$, is"),
    (align.search_text, r"$\varepsilon_{x} = 3 \times 10^{-2}$", "εx=3×10-2"),
    (align.tidy_latex, "3 2 4 . 5", "324.5"),
    (align.fix_caption_numbers, "Figure $x$ 1", "Figure 1"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_case(spark, k):
    rule, text, want = CASES[k]
    assert spark.createDataFrame([(text,), ("",), (None,)], "t string").select(rule(F.col("t")).alias("r")).collect()[0].r == want


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([("",), (None,)], "md string")
    for rule in (lambda c: normalize.normalize(c, whole=True), postprocess.universal, postprocess.bold_headings, postprocess.column_breaks, postprocess.consolidate_references):
        assert [r[0] for r in df.select(rule(F.col("md"))).collect()] == ["", None]
    assert [r.total for r in score.score_unified(df.withColumn("doc_id", F.lit(1))).collect()][0] is not None


def test_idempotent_rules(spark):
    text = "a\n\n\n\nb    c"
    df = spark.createDataFrame([(text,)], "t string")
    for rule in (postprocess.blank_lines, normalize.symbols, normalize.spaces):
        once, twice = df.select(rule(F.col("t")), rule(rule(F.col("t")))).first()
        assert once == twice


def test_scores_and_grades(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(score.latex_valid(F.lit(s))) for s in ("{a{b}}", "}{", "{", r"\begin{a}x\end{a}", "")] == [True, False, False, True, True]
    assert [one(score.grade(F.lit(x))) for x in (90, 89.9, 59)] == ["S", "A", "D"]
    assert one(score.speed_score(F.lit(32.0))) == 1.0 and one(score.speed_score(F.lit(None).cast("double"))) is None
    assert [one(F.round(align.dynamic_threshold(F.lit(b), F.lit(p)), 3)) for b, p in ((0, 0), (5, 10), (35, 20), (30, 10))] == [0.5, 0.55, 0.425, 0.3]
    rows = lambda md: tuple(one(score.table_counts(F.lit(md))))
    assert rows("| a |\n|---|\n| 1 |") == (2, 1) and rows("| Col1 |\n|---|\n| 1 |") == (0, 0) and rows("| a<br> |\n| b |") == (0, 0)


def test_layout_and_alignment(spark):
    pics = spark.createDataFrame([(1, k, p, a) for k, (p, a) in enumerate([(1, 10000), (1, 1500), (2, 2050), (2, 1950), (3, 1700)])], "doc_id int, pos int, page int, area_px int")
    assert sorted(r.area_px for r in layout.drop_subpanels(pics).collect()) == [1950, 2050, 10000]
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(layout.caption_number(F.lit("Extended Data Fig. 2 | Long enough caption"))) == 102
    assert one(layout.caption_number(F.lit("Fig. 3. short"))) is None
    kept = one(align.accept_intervals(F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 3), (2, 5), (3, 3), (3, 6))))))
    assert [(r.start, r.end) for r in kept] == [(0, 3), (3, 3)]
    slots = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 2, 2), (1, 2, 3), (1, 2, 4)], "doc_id int, page int, pos int")
    formulas = spark.createDataFrame([(1, 1, k, f"f{k}", float(-k)) for k in range(3)] + [(1, 2, 3, "g", 0.0)], "doc_id int, page int, pos int, latex string, t double")
    got = align.merge_slots(slots, formulas)
    assert got.filter("slot_pos is not null and latex is not null").count() == 3 and got.filter("slot_pos is null").count() == 1 and got.filter("latex is null").count() == 2


def test_learning(spark):
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "paper_key string")
    base = spark.createDataFrame([("a", 94.6), ("b", 94.6), ("d", 1.0)], "paper_key string, best_total double")
    now = spark.createDataFrame([("a", 94.1), ("b", 94.0), ("c", 2.0)], "paper_key string, best_total double")
    assert {r.paper_key: r.status for r in learn.regressions(known, base, now).collect()} == {"a": "ok", "b": "regressed", "c": "no_baseline", "d": "no_current_score"}
    refs = spark.createDataFrame([(1, k, "Lee2024") for k in range(3)], "doc_id int, pos int, key string")
    assert [r.bib_key for r in metadata.unique_keys(refs).orderBy("pos").collect()] == ["Lee2024", "Lee2024b", "Lee2024c"]
    heads = spark.range(1).select(metadata.repeated_headers(F.array(*(F.lit(x) for x in "AAABB"))).alias("h")).first().h
    assert heads == list("AABB")


def test_affiliations(spark):
    row = spark.createDataFrame([("## T\n\nDept. A, E-mail: a@b.org\n\nE-mail: x@y.org\nbody\n\nDept. B", ["Dept. B", "Dept. A, E-mail: a@b.org"])], "md string, affs array<string>")
    got = row.select(metadata.without_affiliations(F.col("md"), F.col("affs")), metadata.corresponding_affiliation(F.col("affs"))).first()
    # as in the original rule, an affiliation goes where line ends stand on both sides, so not at a text's end
    assert tuple(got) == ("## T\n\nbody\n\nDept. B", "Dept. A,")
    row = row.withColumn("md", F.concat("md", F.lit("\n")))
    assert row.select(metadata.without_affiliations(F.col("md"), F.col("affs"))).first()[0] == "## T\n\nbody\n\n"


def test_many_uses_of_a_key(spark):
    """The 160th use of a key and later ones end in the character of their own number, not of the rest by 256."""
    refs = spark.range(400).select(F.lit(1).alias("doc_id"), F.col("id").alias("pos"), F.lit("Lee").alias("key"))
    assert [r.bib_key for r in metadata.unique_keys(refs).orderBy("pos").collect()] == ["Lee", *("Lee" + chr(96 + n) for n in range(2, 401))]


def test_strip_takes_the_white_space_of_unicode(spark):
    """The ends are looked at, not each space of a text: 200 texts of 20,000 spaces."""
    every = "".join(c for c in map(chr, range(0x3100)) if re.match(r"\s", c) and c not in "\x1c\x1d\x1e\x1f")
    df = spark.createDataFrame([(f"{every}a{every}b{every}",), (every,), ("",), (None,)], "t string")
    assert [tuple(r) for r in df.select(tk.strip(F.col("t")), tk.rstrip(F.col("t"))).collect()] == [(f"a{every}b", f"{every}a{every}b"), ("", ""), ("", ""), (None, None)]
    long = spark.range(200).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.lit(20000)), F.lit("b")).alias("t"))
    start = time.time()
    assert long.select(F.sum(F.length(tk.strip(F.col("t"))))).first()[0] == 200 * 20002 and time.time() - start < 20


def test_noise_in_any_case(spark):
    """The literal that a rule needs is found in any case that the rule itself takes."""
    text = "a\nſcience Advances\nVIEW the article online now\nb"
    assert spark.createDataFrame([(text,)], "t string").select(postprocess.noise(F.col("t"))).first()[0] == "a\n\n\nb"


def test_features_are_those_of_the_plain_patterns(spark):
    """Formulas, their context, references, escapes and tables, counted by one pattern a kind."""
    rng = random.Random(5)
    bits = ["$a$", "$x_{2}$", "$y}$", "$$z$$", "$", " ", ",", "a", "\n", "\n", "[1]", "- [2]", "3. A", "- Ab,", "- 4. ", "- 5.\n- 6. x", "- ", "/u12ab", "/u12abc", "/uniFB01", "|", "| a |", "|-|-|", "<br>", "Col1", "µ m ", "![a](b)", "\n*Fig c", "formula-not-decoded", "### Page 3", "\uf001", "\U0001f4d0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(400)] + [(1000, None), (1001, ""), (1002, "$a$"), (1003, "$a$ $b$,$c$")]
    md = F.col("md")
    n = lambda p: F.regexp_count(md, F.lit(p))
    inline = r"(?<!\$)\$(?!\$)([^$\n]+?)(?<!\$)\$(?!\$)"
    plain = {
        "n_inline": n(inline), "n_display": n(r"\$\$([\s\S]+?)\$\$"), "not_decoded": n("formula-not-decoded"), "n_fallback": n(r"(?m)^### Page \d+"), "n_images": n(r"(?d)!\[.*?\]\("),
        "good_ctx": F.regexp_count(F.regexp_replace(md, inline, "\u0001$1\u0002"), F.lit("(?:^|[ \n,.(;:\\[])\u0001[^\u0002]*\u0002(?=\\z|[ \n,.)%;:])")),
        "u_escape": n("/u[0-9A-Fa-f]{5}") + n("/u[0-9A-Fa-f]{4}"), "ligature": n("/uniFB[0-9a-f]+"), "um_space": n("µ [mMlLsSnNgGΩ](?=[^a-zA-Z])"), "generic_artifacts": n("formula-not-decoded") + n("/u[0-9A-Fa-f]{4,5}") + n("/uniFB[0-9a-f]+"),
        "n_refs": F.greatest(*(n(p) for p in score.REFERENCE_STYLES)), "inline_valid": F.size(F.filter(F.regexp_extract_all(md, F.lit(inline), F.lit(1)), score._balanced)),
    }
    got = score.features(spark.createDataFrame(rows, "i long, md string")).select("i", *plain, *(v.alias(f"plain_{k}") for k, v in plain.items())).collect()
    for r in got:
        assert {k: r[k] for k in plain} == {k: r[f"plain_{k}"] for k in plain}, rows[min(r["i"], len(rows) - 1)]
    assert all(any(r[k] for r in got) for k in plain)


def test_a_text_is_not_gone_over_once_for_each_reference_style(spark):
    """One pattern finds the lines of all styles, another only what can overlap; formulas are not marked to see their context."""
    df = score.features(spark.createDataFrame([(1, "a")], "i long, md string")).select("n_refs", "good_ctx")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?m)^") <= 2 and "regexp_replace(md" not in plan


def test_proposals_go_over_corrections_once(spark):
    """All five rules and the papers from one reading, the same as each rule by itself."""
    lines = ["# A", "## A", "# B", "a-b", "a–b", "see $x$", "see", "© W", "item", None, " ", "a_b"]
    log = spark.range(1500).selectExpr("'p' || (id % 9) AS paper_key", "'j' || (id % 3) AS journal", "pmod(hash(id), 12) AS x", "pmod(hash(id, 7), 11) AS y")
    text = F.array(*(F.lit(t) for t in lines))
    log = log.select("paper_key", "journal", F.coalesce(F.get(text, F.col("x").cast("int")), F.lit("b")).alias("before"), F.get(text, F.col("y").cast("int")).alias("after")).withColumn("type", learn.classify(F.col("before"), F.col("after")))
    params = spark.createDataFrame([("j0", 0.4, ["© W"], {"# A": "# B"}, [])], "journal string, mfd_conf_override double, extra_boilerplate_patterns array<string>, heading_remap map<string,string>, postprocess_extras array<struct<replace:string,with:string>>")
    made = learn.proposals(log, params)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    got = {(r["journal"], r["step"]): r for r in made.collect()}
    want = {(r["journal"], 1 if r["action"] == "lower" else 2): r["n"] for r in learn.formula_rule(log, params).collect()}
    for step, rule in ((3, learn.boilerplate_rule(log, params)), (4, learn.heading_rule(log, params)), (5, learn.character_rule(log))):
        want |= {(r["journal"], step): r["count"] for r in rule.groupBy("journal").count().collect()}
    assert {k: r["n"] for k, r in got.items()} == want and {k[1] for k in want} == {1, 2, 3, 4, 5}
    assert all(r["papers"] == sorted({f"p{k}" for k in range(9) if k % 3 == int(r["journal"][1])}) for r in got.values())
