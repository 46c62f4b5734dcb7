"""Sequential and matching steps on random inputs against plain versions."""

import random
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from paperloom.functions import session
from paperloom.functions import textkit as tk
from paperloom.operators import align, captions, folds, layout, linediff, manuscript, metadata, postprocess


def by_key(df, key, value):
    return {r[key]: r[value] for r in df.select(key, value).collect()}


# formulas


def plain_tidy(s):
    for _ in range(3):
        s = re.sub(r"(\d) (\d)", r"\1\2", s)
    s = re.sub(r"(\d) \. (\d)", r"\1.\2", s)
    s = re.sub(r"(\\[a-zA-Z]+)\s*\{([^}]*)\}", lambda m: m[1] + "{" + " ".join(m[2].split()) + "}", s)
    for mark in "^_":
        s = re.sub(re.escape(mark) + r"\s*\{[^}]*\}", lambda m: "".join(m[0].split()), s)
    return s.strip()


def test_tidy_formulas(spark):
    rng = random.Random(4)
    pieces = ["\\mathrm", " ", "  ", "{", "}", "{ ", " }", "^", "_", "1", "2 3", " . ", ".", "a b", "\\text{ a 1 }", "\t", "\n", "\\frac", "x", "$", "\\", "é ", "3 4 5 6 7"]
    rows = [(k, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))) for k in range(1500)]
    rows += [(2000, "x^{ a b }"), (2001, "\\text{ a 1 }"), (2002, "\\mathrm{ per  cent }"), (2003, "3. 5"), (2004, "1  2"), (2005, "")]
    got = by_key(spark.createDataFrame(rows, "k int, f string").withColumn("t", align.tidy_latex(F.col("f"))), "k", "t")
    assert got == {k: plain_tidy(f) for k, f in rows}
    assert [got[k] for k in range(2000, 2005)] == ["x^{ab}", "\\text{a 1}", "\\mathrm{per cent}", "3. 5", "1  2"]


def test_matches_are_rewritten_where_they_stand(spark):
    rows = [(0, "ab(1)c(12)(1)"), (1, "(1)(1)"), (2, "none"), (3, ""), (4, "(2)")]
    made = tk.rewrite(F.col("t"), r"\(\d+\)", lambda m: F.concat(F.lit("<"), m, F.lit("(1)>")))
    got = by_key(spark.createDataFrame(rows, "k int, t string").withColumn("o", made), "k", "o")
    assert got == {k: re.sub(r"\(\d+\)", lambda m: f"<{m[0]}(1)>", t) for k, t in rows}


# containment


@pytest.mark.parametrize("least", [1, 5, 20])
def test_contained_texts(spark, least):
    rng = random.Random(least)
    rows = []
    for page in range(6):
        texts = ["".join(rng.choice("ab" if page == 0 else "abcdefgh12") for _ in range(rng.randint(0, 60))) for _ in range(40)]
        for t in list(texts):
            a = rng.randint(0, len(t))
            texts.append(t[a : a + rng.randint(0, 40)])
        rows += [(page % 2, page, t) for t in texts + texts[:3]] + [(page % 2, page, None)]
    f = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos int, doc_id int, page int, latex string")
    got = sorted(r.pos for r in align.drop_subformulas(f, least).select("pos").collect())
    want = [k for k, (d, p, t) in enumerate(rows) if t is None or not (len(t) >= least and any((d, p) == (e, q) and u and len(u) > len(t) and t in u for e, q, u in rows))]
    assert got == want


def test_one_page_of_many_texts(spark):
    """20,000 texts with a common head on one page: none is held against all others."""
    head = "\\frac{d}{dx}f(x)=a"
    f = spark.range(20000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("pos"), F.concat(F.lit(head), F.sha2(F.col("id").cast("string"), 256), F.when(F.col("id") % 2 == 0, "x").otherwise("")).alias("latex"))
    short = f.filter("pos % 4 = 0").select("doc_id", "page", (F.col("pos") + 100000).alias("pos"), F.substring("latex", 5, 40).alias("latex"))
    start = time.time()
    got = align.drop_subformulas(f.unionAll(short))
    assert got.count() == 20000 and time.time() - start < 60


# spans in texts


def plain_places(md, spans):
    out, cursor = [], 0
    for pos, text, caption in spans:
        text = text or ""
        at = md.find(f"*{text}*") if caption else md.find(text, cursor)
        if at < 0:
            out.append((pos, None, None))
        elif caption:
            out.append((pos, at + 1, at + 1 + len(text)))
        else:
            cursor = at + 1
            out.append((pos, at, at + len(text)))
    return out


def plain_places_by_page(md, spans):
    def find(text, start):
        for t in (text, text[:-1] if text.endswith("-") and len(text) > 1 else ""):
            if t and (at := md.find(t, start)) >= 0:
                return at, at + len(t)
        return -1, -1

    out, base = [], 0
    for page in sorted({s[3] for s in spans}):
        mine, first = [s for s in spans if s[3] == page], []
        for s in mine:
            at = find(s[1] or "", base)[0]
            at = at if at >= 0 else find(s[1] or "", 0)[0]
            first.append(at if at >= 0 else len(md))
        cursor, ends = base, []
        for k in sorted(range(len(mine)), key=lambda k: (first[k], k)):
            at, end = find(mine[k][1] or "", cursor)
            if at < 0:
                out.append((mine[k][0], None, None))
                continue
            out.append((mine[k][0], at, end))
            ends.append(end)
            cursor = at + 1
        if ends:
            base = sorted(ends)[max(0, int(len(ends) * 0.75) - 1)]
    return out


@pytest.mark.parametrize("small", [True, False])
def test_places_of_spans(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    rng, docs, spans = random.Random(8), [], []
    for d in range(60):
        md = "".join(rng.choice(["ab", "ba ", "é", "𝜈", "*ab*", "b-", "\n"]) for _ in range(rng.randint(0, 80)))
        docs.append((d, md or None))
        for pos in range(rng.randint(0, 25)):
            a = rng.randint(0, len(md))
            text = rng.choice([md[a : a + rng.randint(0, 6)], md[a : a + 3] + "-", "lost", None, "ab"])
            spans.append((d, pos, rng.randint(1, 4), text, rng.random() < 0.15))
    s, t = spark.createDataFrame(spans, "doc_id int, pos int, page int, normed string, is_caption boolean"), spark.createDataFrame(docs, "doc_id int, md string")
    for by_page in (False, True):
        got = folds.locate_spans(s, t, by_page)
        assert ("Python" in got._jdf.queryExecution().toString()) is False
        rows = {(r.doc_id, r.pos): (r.md_start, r.md_end) for r in got.collect()}
        want = {}
        for d, md in docs:
            mine = [(p, x, c, g) for e, p, g, x, c in spans if e == d]
            found = plain_places_by_page(md or "", mine) if by_page else plain_places(md or "", [m[:3] for m in mine])
            want |= {(d, p): (a, b) for p, a, b in found}
        assert rows == want


def test_states_of_a_long_scan(spark):
    """A running state over 100,000 items takes little more than ten times that over 10,000."""
    total = tk.scan(F.sequence(F.lit(1), F.col("n")), F.struct(F.lit(0).cast("long").alias("s")), "struct<s:bigint>", lambda a, x: F.struct((a["s"] + x).alias("s")))
    took = {}
    for n in (10_000, 100_000):
        df = spark.range(1).select(F.lit(n).alias("n")).select(total.alias("states")).select(F.size("states").alias("k"), F.element_at("states", -1)["s"].alias("s"), F.col("states")[4]["s"].alias("fifth"))
        for _ in range(2):
            start = time.time()
            assert tuple(df.first()) == (n, n * (n + 1) // 2, 15)
            took[n] = time.time() - start
    assert took[100_000] < 30 * took[10_000] + 1
    assert spark.range(1).select(F.size(tk.scan(F.array().cast("array<int>"), F.struct(F.lit(0).alias("s")), "struct<s:int>", lambda a, x: a)).alias("k")).first().k == 0


# line changes


def plain_diff(a, b, compat):
    """By the whole matrix of common lines, from its end."""
    n, m = len(a), len(b)
    most = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            most[i + 1][j + 1] = most[i][j] + 1 if a[i] == b[j] else max(most[i][j + 1], most[i + 1][j])
    i, j, out, gone, new = n, m, [], [], []

    def close():
        k = min(len(gone), len(new))
        pairs = [(g[0], g[1], x[1]) for g, x in zip(gone[::-1], new[::-1], strict=False)] + [(g[0], g[1], None) for g in gone[::-1][k:]] + [(x[0], "", x[1]) for x in new[::-1][k:]]
        out.extend(pairs[::-1])
        gone.clear(), new.clear()

    while i or j:
        if i and j and a[i - 1] == b[j - 1]:
            close()
            i, j = i - 1, j - 1
        elif j and (not i or most[i][j - 1] >= most[i - 1][j]):
            (out.append((j, "", b[j - 1].strip())) if compat else new.append((j, b[j - 1].strip())))
            j -= 1
        elif compat and j and a[i - 1].strip() != b[j - 1].strip():
            out.append((i, a[i - 1].strip(), b[j - 1].strip()))
            i, j = i - 1, j - 1
        else:
            (out.append((i, a[i - 1].strip(), None)) if compat else gone.append((i, a[i - 1].strip())))
            i -= 1
    close()
    return out[::-1]


def test_changes_are_those_of_the_whole_matrix():
    rng = random.Random(6)
    for t in range(600):
        letters = "abcd " if t % 2 else "abcdefghijklmnopqrstuvwxyz"
        a = [rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 8, 30, 60]))]
        b = [rng.choice(letters) for _ in range(rng.choice([0, 2, 9, 40]))] if t % 3 == 0 else list(a)
        for _ in range(0 if t % 3 == 0 else rng.randint(0, 8)):
            p, kind = rng.randint(0, len(b)), rng.random()
            if kind < 0.4 or not b:
                b.insert(p, rng.choice(letters))
            elif kind < 0.7:
                b.pop(p % len(b))
            else:
                b[p % len(b)] = rng.choice(letters)
        for compat in (False, True):
            x, y = "\n".join(a), "\n".join(b)
            assert linediff.diff(x, y, compat) == plain_diff(x.splitlines(), y.splitlines(), compat)


def test_changes_by_hand():
    assert linediff.diff("A\nX\nB", "A\nB") == [(2, "X", None)]
    assert linediff.diff("A\nX\nB", "A\nB", compat=True) == [(1, "A", None), (2, "X", "A")]
    assert linediff.diff("A\nX\nB", "A\nY\nB\nC") == [(2, "X", "Y"), (4, "", "C")]
    assert linediff.diff("", "") == [] and linediff.diff("a", "") == [(1, "a", None)] and linediff.diff(None, "a") == [(1, "", "a")]


@pytest.mark.parametrize("near", [True, False])
def test_memory_of_long_texts(near):
    rng = random.Random(2)
    a = [f"line {i % 3000} {rng.random() if i % 3 else ''}" for i in range(20000)]
    b = [x + "!" if rng.random() < 0.005 else x for x in a if rng.random() > 0.002] if near else [f"other {i}" for i in range(20000)]
    tracemalloc.start()
    found = linediff.diff("\n".join(a), "\n".join(b))
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert peak < 100 and (len(found) < 400 if near else len(found) == 20000)


def test_images_that_changed_places(spark):
    rows = [
        (0, "![a](1)\nx\nk\nl\n![b](2)\ny ![c](3)", "![b](2)\nx\nk\nl\n![a](1)\ny ![c](3)"),
        (1, "![a](1)\nx", "![a](1)\nz"),
        (2, "![a](1)\n![a](1)\n![b](2)", "![a](1)\n![b](2)"),
        (3, None, "![a](1)"),
        (4, "x\n![a](1)", "x"),
    ]
    got = linediff.corrections(spark.createDataFrame(rows, "doc_id int, a string, b string"), F.col("a"), F.col("b"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [
            (0, 1, "position 2: ![b](2)", "position 1: ![b](2)", "image_reorder"),
            (0, 2, "position 1: ![a](1)", "position 2: ![a](1)", "image_reorder"),
            (1, 2, "x", "z", "text_fix"),
            # the second of two equal images is gone: the last line of it counts, and the one behind moves up
            (2, 1, "position 2: ![a](1)", "position 1: ![a](1)", "image_reorder"),
            (2, 2, "position 3: ![b](2)", "position 2: ![b](2)", "image_reorder"),
            (2, 1, "![a](1)", None, "boilerplate_removal"),
            (4, 2, "![a](1)", None, "boilerplate_removal"),
        ],
        key=str,
    )


# formulas and captions within a row

SMALL, HIGH = str.maketrans("₀₁₂₃₄₅₆₇₈₉ₐₑₒₓ", "0123456789aeox"), str.maketrans("⁰⁴⁵⁶⁷⁸⁹⁺⁻", "0456789+-")


def plain_math(md):
    out, block = [], False
    letter = f"[{''.join(captions.GREEK)}]"
    outside = lambda line, rule: "".join(p if k % 2 else rule(p) for k, p in enumerate(re.split(r"(\$[^$\n]+\$)", line)))

    def scripts(m):
        made = m[1]
        for sign, table in (("_", SMALL), ("^", HIGH)):
            s = "".join(c for c in m[2] if ord(c) in table).translate(table)
            made += "" if not s else sign + (s if len(s) == 1 else "{" + s + "}")
        return f"${made}$"

    for line in md.split("\n"):
        if line.strip() == "$$":
            block = not block
        elif not block:
            line = re.sub(f"_({letter})_", lambda m: f"$\\{captions.GREEK[m[1]]}$", line)
            line = outside(line, lambda p: re.sub(captions.SCRIPTED, scripts, p))
            line = outside(line, lambda p: re.sub(letter, lambda m: f"$\\{captions.GREEK[m[0]]}$", p))
        out.append(line)
    return "\n".join(out)


def plain_captions(md):
    figure, dotted = re.compile(r"\s*(?:\*\*)?(?:Figure|Fig\.)\s+(\d+)[.|]", re.I), re.compile(r"\.\s*\.\s*\.?\s*(?=(?:Fig\.?|Figure)\s+\d+[.|])", re.I)
    kept, found, number = [], {}, None
    for line in md.split("\n"):
        line = dotted.sub("", line.strip(), count=1) if dotted.match(line.strip()) else line
        m, bare = figure.match(line), line.strip()
        if m or (number is not None and bare and not bare.startswith(("#", "![", ">"))):
            number = int(m[1]) if m else number
            found[number] = bare if m else f"{found[number]} {bare}"
            if not kept or kept[-1] != "":
                kept.append("")
        else:
            number = None
            kept.append(line)
    if not found:
        return md
    queue, out = [re.sub(r"\*\*", "", re.sub(r"\*\*([^*]+)\*\*", r"\1", t)).strip() for _, t in sorted(found.items())], []
    for i, line in enumerate(kept):
        out.append(line)
        if queue and line.strip().startswith("![") and not next((x.strip() for x in kept[i + 1 :] if x.strip()), "").startswith(("> ", "*Figure", "*Fig.")):
            out += ["", "> " + queue.pop(0)]
    return "\n".join(out)


def test_rules_on_random_texts(spark):
    rng = random.Random(9)
    pieces = {
        captions.inline_math: (plain_math, ["ν", "𝜈", "_ν_", "_", "E", "₁", "₂", "⁴", "⁻", "ⁱ", "$", "$x$", "$α$", " ", "word", "\n", "\n$$\n", "$$", "Δ", "ɛ"]),
        captions.place_captions: (plain_captions, ["\n", "\n", "\n\n", "![](a)\n", " ![b](c)", "Figure 1. One", "Fig. 2| Two **b**", "**Figure 2.** again\n", ". . Fig. 3. dots", ". .Fig 4. not one", "> quote\n", "# head\n", "text ", "*Figure* x\n", "figure 10. ten"]),
    }
    for rule, (plain, words) in pieces.items():
        texts = ["", "\n", *("".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(500))]
        got = by_key(spark.createDataFrame(list(enumerate(texts)), "k int, md string").withColumn("t", rule(F.col("md"))), "k", "t")
        for k, t in enumerate(texts):
            assert got[k] == plain(t), t


def test_long_texts_take_time_in_proportion(spark):
    """Ten times the lines take no more than some twenty times as long."""
    rules = {"mid_sentence": "line a\n\nb goes on\n", "consolidate_references": "3.\nA text\n\n4. B\n", "page_images": "![](x.pdf-3-1.png)\nt\n", "inline_math": "ν E₁\n$$\nα\n$$\n", "place_captions": "![](a)\nFig. 1. x\n\n", "blocks": "# h\ntext $x$\n- a\n- b\n\n", "without_front": "text of a line\n\nKorea\n"}
    column = {
        "inline_math": captions.inline_math, "place_captions": captions.place_captions, "blocks": lambda c: F.size(manuscript.blocks(tk.lines(c))).cast("string"), "without_front": lambda c: manuscript.without_front(F.concat(F.lit("# t\n"), c), F.array(F.lit("A B")))["body"],
    }
    for name, text in rules.items():
        rule, took = column.get(name) or getattr(postprocess, name), {}
        for n in (3_000, 30_000):
            df = spark.range(1).select(F.concat(F.lit("## References\n"), F.repeat(F.lit(text), n // text.count("\n"))).alias("md")).select(F.length(rule(F.col("md"))))
            for _ in range(2):
                start = time.time()
                df.first()
                took[n] = time.time() - start
        assert took[30_000] < 25 * took[3_000] + 2, (name, took)


# boxes on pages, rules of classes


def test_boxes_meet_in_bands(spark):
    rng = random.Random(12)
    box = lambda top: (x := rng.uniform(0, 500), y := rng.choice([rng.uniform(-50, 900), rng.uniform(-50, 900), 1e7, -1e7]), x + rng.uniform(-5, 80), y + rng.choice([12, 12, 300, top, -100]))
    formulas = [(rng.randint(0, 2), k, rng.randint(0, 2), *box(10)) for k in range(300)] + [(0, 900, 0, None, None, 5.0, 5.0)]
    spans = [(rng.randint(0, 2), k, rng.randint(0, 2), *box(2e7), rng.choice([None, 1, 1])) for k in range(300)] + [(0, 901, 0, 1.0, None, 5.0, 5.0, 1)]
    f = spark.createDataFrame(formulas, "doc_id int, pos int, page int, l double, b double, r double, t double")
    s = spark.createDataFrame(spans, "doc_id int, pos int, page int, l double, b double, r double, t double, md_start int")
    matched = align.match_spans(f, s)
    got = {r.pos: (r.span_pos, r.dist) for r in matched.collect()}
    reasons = {r.pos: r.reason for r in align.unmatched_reason(matched, s).collect()}
    want, why = {}, {}
    for d, k, p, l, b, r, t in formulas:
        best, level = None, False
        for e, n, q, sl, sb, sr, st, at in spans:
            if (d, p) != (e, q) or at is None or None in (b, t, sb, st):
                continue
            y = (t + b) / 2
            if sb - 30 <= y <= st + 30:
                level = True
                if l < sr + 10 and r > sl - 10:
                    here = (abs(y - (st + sb) / 2), n)
                    best = here if best is None or here < best else best
        want[k] = (best[1], best[0]) if best else (None, None)
        if not best:
            why[k] = "x" if level else "y"
    assert got == want and reasons == why
    items = f.withColumn("depth", F.col("pos") % 3)
    kept = sorted(r.pos for r in layout.drop_figure_text(items, s).select("pos").collect())
    figures = [x for x in spans if None not in x[3:7]]
    lost = set()
    for d, k, p, l, b, r, t in formulas:
        if k % 3 < 2 and None not in (l, b, r, t):
            x, y = (l + r) / 2, (t + b) / 2
            mine = [g for g in spans if (g[0], g[2]) == (d, p)]
            low, high = min((g[4] for g in mine if g[4] is not None), default=None), max((g[6] for g in mine if g[6] is not None), default=None)
            if any(g[3] <= x <= g[5] and g[4] <= y <= g[6] for g in figures if (g[0], g[2]) == (d, p)) or (low is not None and r - l < 80 and low - 100 <= y <= high + 450):
                lost.add(k)
    assert kept == sorted(k for _, k, *_ in formulas if k not in lost)


def test_a_crowded_page_is_dealt_by_height(spark):
    """50,000 lines and as many formulas on one page of a scroll: no task has a tenth of them."""
    at = lambda n: spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").cast("int").alias("pos"), F.lit(1).alias("page"), F.lit(0.0).alias("l"), F.lit(50.0).alias("r"), ((F.col("id") % 16000) * 1.0).alias("b"), ((F.col("id") % 16000) + 0.5).alias("t"), F.lit(1).alias("md_start"))
    start = time.time()
    got = align.match_spans(at(50000), at(50000))
    assert got.filter("span_pos is null or dist > 0").count() == 0 and time.time() - start < 120
    bands = align.in_bands(at(50000), F.col("b"), F.col("t")).groupBy("_band").count().agg(F.max("count"), F.count("*")).first()
    assert bands[0] < 5000 and bands[1] > 200


def test_classes_of_repeated_rows(spark):
    rules = spark.createDataFrame([(2, "B", "b", "alpha"), (1, "A", "a", "BETA"), (3, "B", "b", "gamma"), (4, None, "n", "delta"), (5, "C", "c", None)], "ord int, major string, middle string, kw string")
    docs = spark.createDataFrame([(1, "alpha beta", "x"), (1, "alpha beta", "x"), (1, "Alpha gamma beta film", "y"), (2, None, "z"), (3, "delta", "z"), (None, "none", "z")], "doc_id int, t string, major_x string")
    got = metadata.classify(docs, rules, F.col("t"))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, (tuple(r)[3:] for r in got.collect()))) == sorted(map(str, [("A", "a", "", 1), ("A", "a", "", 1), ("B", "b", "소재", 2), ("", "", "", 0), ("", "n", "", 1), ("", "", "", 0)]))
    profiles = spark.createDataFrame([(2, "two", ["ad-x"], ["Small"], ["p1"]), (1, "one", ["zz"], None, None)], "ord int, pid string, filename_keywords array<string>, journal_keywords array<string>, known_papers array<string>")
    q = spark.createDataFrame([("Ad X 3",), ("Ad X 3",), ("zz small",), ("no",), (None,)], "query string")
    assert [r.pid for r in metadata.match_journal(q, profiles).collect()] == ["two", "two", "one", None, None]
    keys = spark.createDataFrame([("p1",), ("p1",), ("azz",), ("q",)], "paper_key string")
    assert [r.journal for r in metadata.detect_profile(keys, profiles).collect()] == ["two", "two", "one", "unknown"]
    with pytest.raises(ValueError):
        metadata.classify(docs, rules.withColumn("kw", F.repeat(F.lit("x"), 1 << 20)), F.col("t"))


def test_assets_stand_before_the_lines_that_name_figures(spark):
    rng = random.Random(11)
    parts = ["Fig. 1", "Fig 2", "figure  3", "FIGURE 4", "Fig.5", "Figure", "\n", "\n", " ", "\t", "text", "Fig. \n6", "\U0001d7d8", "$1 \\2", "\r", "١", "Fig. ٢"]
    names = ["b.jpeg", "a.jpeg", "a.jpeg", "x.png", "é.jpeg", "Z.jpeg", None]
    have = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25))), rng.choices(names, k=rng.randrange(6)) if i % 9 else None) for i in range(400)]
    have += [(900, None, ["a.jpeg"]), (901, "", ["a.jpeg"]), (902, "Fig. 1\n" * 30_000, [f"{k}.jpeg" for k in range(20_000)])]

    def plain(md, names):
        left, out = sorted(n for n in names or [] if n and n.endswith(".jpeg")), []
        for line in md.split("\n"):
            if left and re.search(r"Fig\.?\s+\d|Figure\s+\d", line, re.IGNORECASE):
                out.append(f"\n![{line.strip()}](f/{left.pop(0)})\n")
            out.append(line)
        return "\n".join(out)

    rows = spark.createDataFrame(have, "id long, md string, names array<string>")
    got = dict(rows.select("id", captions.place_assets(F.col("md"), F.col("names"), F.lit("f"))).collect())
    for i, md, names in have:
        assert got[i] == (None if md is None else plain(md, names)), repr(md)


def test_short_texts_make_no_pairs(spark):
    """6,000 short texts of few grams on one page are sorted and not held against each other in pairs."""
    f = spark.range(6000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("pos"), F.concat(F.when(F.col("id") % 2 == 0, "ab").otherwise(""), F.lpad(F.bin(F.floor(F.col("id") / 2)), 12, "0")).alias("latex"))
    got = align.drop_subformulas(f, 5)
    assert sorted(r.pos for r in got.select("pos").collect()) == list(range(0, 6000, 2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the pairs of short texts came from a join by document, page and gram before
    assert "_after" in plan

def shuffled(spark):
    """Rows written to shuffles so far in the session."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_texts_are_shuffled_and_not_their_ends(spark):
    """Texts of 14 characters, each contained in another, have ten ends; a row is shuffled once, and comes out without a join."""
    f = spark.range(8000, numPartitions=4).select((F.col("id") % 4).alias("doc_id"), (F.col("id") % 2).alias("page"), F.col("id").alias("pos"), F.concat(F.when(F.col("id") % 8 < 4, "ab").otherwise(""), F.lpad(F.bin(F.floor(F.col("id") / 8)), 12, "0")).alias("latex"))
    before = shuffled(spark)
    assert sorted(r.pos for r in align.drop_subformulas(f, 5).select("pos").collect()) == [k for k in range(8000) if k % 8 < 4]
    assert shuffled(spark) - before < 2 * 8000


@pytest.mark.parametrize("least", [1, 5, 20, 40])
@pytest.mark.parametrize("crowd", [40, 600])
def test_crowded_pages_are_dealt_by_ends(spark, monkeypatch, least, crowd):
    """Pages over the limit, with copies of texts, texts of one end, long ones and rows without document, page or text."""
    monkeypatch.setattr(align, "CROWD", crowd)
    rng = random.Random(least + crowd)
    rows = []
    for page in range(5):
        texts = ["".join(rng.choice("ab" if page == 0 else "abé𝛼12") for _ in range(rng.choice((0, 3, least, 12, 32, 33, 60)))) for _ in range(12 + 8 * page)]
        for t in list(texts):
            a = rng.randint(0, len(t))
            texts.append(t[a : a + rng.randint(0, 40)])
        rows += [(None if page == 4 and k % 7 == 0 else 1, None if page == 3 and k % 5 == 0 else page, t) for k, t in enumerate(texts + rng.choices(texts, k=20) + [None] * 3)]
    f = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos int, doc_id int, page int, latex string")
    got = {r.pos: (r.doc_id, r.page, r.latex) for r in align.drop_subformulas(f, least, 3).collect()}
    longer = lambda d, p, t: any((d, p) == (e, q) and u and len(u) > len(t) and t in u for e, q, u in rows)
    assert got == {k: (d, p, t) for k, (d, p, t) in enumerate(rows) if None in (d, p, t) or not (len(t) >= least and longer(d, p, t))}
