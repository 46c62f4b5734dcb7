"""Each operator against a plain version, and its edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontamination, html_extraction, language_model, mixing, near_dedup, repetition, sharding, surrogates, token_counts, url_filters

WORD = re.compile(r"[^ \t-\r]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents with nulls, empty and long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(seed)
    out = [(i, sentence(rng, rng.choice([3, 20, 60, 120]), "abcdefghijklmnop")) for i in range(n)]
    out += [(n + i, out[5][1]) for i in range(25)]  # copies
    for i in range(6):  # near copies
        w = out[7][1].split() + sentence(rng, 60).split() if i == 0 else w  # noqa: F821
        v = list(w)
        v[rng.randrange(len(v))] = "changed"
        out.append((200 + i, " ".join(v)))
    out += [(300, None), (301, ""), (302, " \n\t "), (None, "an id that is null " * 4), (None, None), (5, "the id five again"), (9, out[9][1]), (9, out[9][1])]
    out += [(400, sentence(rng, 4000)), (401, "x" * 30000), (402, "one two " * 300)]
    return [(d, t, "en", rng.choice(["a", "b", "b", "b", None]), len(t or "")) for d, t in out]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """The same rows with columns named as the operators' own."""
    for c in ("size", "key", "row", "cell", "unit", "found", "quality", "matches", "attempts", "h1", "h2", "whole", "kept", "__kept", "__m", "__found", "__whole", "__h1", "rank", "finish", "copies", "held_out", "ids"):
        df = df.withColumn(c, F.lit("x"))
    return df


def same(a, b):
    assert collections.Counter(map(str, a.collect())) == collections.Counter(map(str, b.collect()))


# sharding


def test_placing_follows_the_ring():
    rng = np.random.default_rng(0)
    at, owner = sharding._ring(5, 8)
    position, size = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2), rng.integers(1, 100, 300)
    got = sharding.place(position, size, 5, 8, 0.05)
    cap, load = 1.05 * size.sum() / 5, np.zeros(5)
    for u in sorted(range(300), key=lambda u: (-int(math.log2(size[u])), int(position[u]), u)):
        start = next((k for k in range(len(at)) if at[k] >= position[u]), 0)
        ring = [owner[(start + k) % len(at)] for k in range(len(at))]
        want = next((s for s in ring if load[s] + size[u] <= cap + 1e-9), int(np.argmin(load)))
        assert got[u] == want
        load[want] += size[u]


def test_shards(spark, docs, rows, empty):
    got = sharding.shard(clashing(docs), 7).collect()
    assert len(got) == len(rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard(empty, 7).count() == 0


def test_a_hot_text_is_split_and_shards_stay_even(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot " * 20).otherwise(F.concat(F.lit("text number "), F.col("id").cast("string"), F.repeat(F.lit("z"), 60))).alias("text"))
    sizes = [r[0] for r in sharding.shard(df, 10).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 10 and max(sizes) < 1.02 * min(sizes)
    few = sharding.shard(spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 100).cast("string")).alias("text")), 3, slack=0.5)
    assert few.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


# decontamination


def contained(doc, item):
    words = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    d, i = words(doc), words(item)
    n = min(5, len(i))
    if not n:
        return None
    grams = lambda w: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    return len(grams(i)), len(grams(i) & grams(d))


def test_containment_is_exact(spark, docs, rows):
    rng = random.Random(4)
    long = rows[-3][1].split()
    items = [(1, " ".join(long[100:140])), (2, " ".join(long[3000:3012])), (3, sentence(rng, 30)), (4, "two words"), (5, ""), (6, None), (7, rows[5][1].upper() + "!"), (7, "x" * 30000)]
    items += [(10 + k, " ".join(w if j % 20 != k else "q" for j, w in enumerate(long[500:560]))) for k in range(5)]
    have = rows + [(900 + k, sentence(rng, 50) + " " + t + " " + sentence(rng, 900), "en", "a", 1) for k, (_, t) in enumerate(items) if t]
    got = decontamination.contaminated(clashing(spark.createDataFrame(have, DOCS)), spark.createDataFrame(items, "item_id long, text string"), block=3)
    want = collections.Counter()
    for d, t, *_ in have:
        for i, s in items:
            c = contained(t, s)
            if c and 10 * c[1] >= 8 * c[0]:
                want[d, i, c[0], c[1]] += 1
    assert collections.Counter((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in got.collect()) == want


def test_cleaning_keeps_columns_and_clean_rows(spark, docs, rows, empty):
    items = spark.createDataFrame([(1, rows[7][1])], "item_id long, text string")
    wide = clashing(docs)
    got = decontamination.clean(wide, items)
    assert got.columns == wide.columns
    assert got.count() == sum(not ((c := contained(t, rows[7][1])) and 10 * c[1] >= 8 * c[0]) for _, t, *_ in rows)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(docs, none).count() == len(rows)
    assert decontamination.contaminated(docs, none).count() == 0
    assert decontamination.contaminated(empty, items).count() == 0


def test_one_more_shard_moves_little():
    """Of 41 shards the new one takes 2.4 % of all bytes; the bound on loads moves some more between old ones."""
    rng = np.random.default_rng(8)
    position, size = rng.integers(0, 2**64, 20_000, dtype=np.uint64), rng.integers(50, 5_000, 20_000)
    before, after = (sharding.place(position, size, n) for n in (40, 41))
    moved = size[before != after].sum() / size.sum()
    between_old = size[(before != after) & (after < 40)].sum() / size.sum()
    assert moved < 0.07 and between_old < 0.05
    for at, n in ((before, 40), (after, 41)):
        load = np.bincount(at, size, n) / (size.sum() / n)
        assert load.max() <= 1.002 and load.min() > 0.9


# token counts


def test_token_counts_equal_the_library(spark, docs, rows, empty):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = tokenizers.Tokenizer.from_file(path), random.Random(0)
    alphabet = "aAbΣσςİıéé \n\t\x1c\x1f\x85\xa0 'sS'ts123½²٣你好가​<|startoftext|>_-!?ßẞǅ😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) + rng.choice(["", "", " <|endoftext|>x"]) for _ in range(3000)]
    m = token_counts.merger(path)
    assert [m.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    got = token_counts.token_counts(clashing(docs), path).collect()
    want = collections.Counter((d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts.token_counts(empty, path).count() == 0


# html


def test_min_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 7)
        unary = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cost = lambda x: sum(-u if not k and u < 0 else 0 for u, k in zip(unary, x, strict=True)) * 0 + sum(u for u, k in zip(unary, x, strict=True) if u > 0 and not k) - sum(u for u, k in zip(unary, x, strict=True) if u < 0 and k) + sum(c for i, j, c in edges if x[i] != x[j])  # noqa: B023, E731
        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(html_extraction.min_cut(unary, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href='/x>y'>News</a></li></ul></nav>
<div class="cookie-notice">We use cookies, <a>accept</a></div>
<div class="page"><main><article class="post"><h2>The &quot;title&quot; &amp; more</h2><p>First   paragraph
with <b>bold</b> and caf&eacute;&nbsp;text, long enough to look like prose.<p>Second one<br>goes on &lt;here&gt; 3 < 4.</p>
<div class="ad">Buy now!</div><blockquote>A quoted line.</blockquote></article></main>
<aside><p>Related: some long text in the sidebar, which is prose as well, but not the article.</p></aside>
<form><p>Sign up</p><input></form><div id="comments"><article class="comment"><p>I liked this article, said a reader.</p></article></div></div>
<footer><p>&copy; 2024 All rights reserved.</p></footer></body></html>"""
TEXT = 'The "title" & more\nFirst paragraph with bold and café text, long enough to look like prose.\nSecond one goes on <here> 3 < 4.\nA quoted line.'


def test_main_text(spark):
    odd = [(1, "u", PAGE), (1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<article><p>cut off &am"), (None, "u", "no markup"), (6, "u", "<p>" + "word " * 200000), (7, "u", '<a href="x' + "<b>" * 3), (8, "u", PAGE[:700])]
    df = spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("h", F.lit(1))
    got = {r.page_id: r for r in html_extraction.extract(df).collect()}
    assert got[1].text == TEXT and got[1].n_chars == len(TEXT)
    assert got[2].text == got[3].text == "" and got[4].text == "cut off &am"
    assert html_extraction.extract(df.limit(0)).count() == 0
    assert html_extraction.extract(df).count() == len(odd)


def test_labels_of_wrappers_do_not_empty_a_page():
    text = "A long paragraph of prose, which goes on for a while and ends here."
    inner = f"<div class='content'><p>{text}</p><p>{text}</p></div><div class='sidebar'><p>Related things.</p></div>"
    article = f"<p>{text}</p><p>{text}</p>"
    weights = html_extraction.DEFAULT  # what elements say is part of the model
    for page in (f"<body class='page has-sidebar'>{inner}</body>", f"<article class='post comments-open'>{article}</article>", f"<body><form id='aspnetForm'>{inner}</form></body>", f"<body><div class='menu page'>{inner}</div></body>", f"<article class='post social'>{article}</article>"):
        assert html_extraction.main_text(page, weights) == f"{text}\n{text}", page
    for page in (f"<div class='comments'><article class='comment'><p>{text}</p></article></div>", f"<form><p>{text}</p></form>", f"<div class='cookie-notice'><p>{text}</p></div>"):
        assert html_extraction.main_text(page, weights) == ""


def test_elements_that_do_not_end_lose_no_text():
    text = "A long paragraph of prose, which goes on for a while and ends here."
    main = lambda page: html_extraction.main_text(page, html_extraction.DEFAULT)
    assert main(f"<body class='has-sidebar'><div><h1>Title</h1><p>{text}</p></div>") == f"Title\n{text}"
    assert main(f"<article><p>first <svg/> second</p><p>{text}</p></article>") == f"first second\n{text}"
    assert main(f"<article><p>first <svg><text>no</text></svg> second</p><p>{text}") == f"first second\n{text}"
    assert main(f"<article><p>{text}</p><script>var a = 1;<p>{text}</p></article>") == f"{text}\n{text}"
    assert main(f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p><object>{text}</object></article>") == f"Let x=2 be.\n{text}"
    assert main("<div class='content'><p>Buy now<p>Home<p>About us") == ""


def _unmarked_page(rng):
    """A page whose elements say nothing: menus of links with a sentence in them, an article with short paragraphs. Its texts begin with Z."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)) + rng.choice(["...", ".", "?"])
    link = lambda: f"<div><a href=x>{word()} {word()}</a></div>"
    menu = lambda n: "<div><div>" + "".join(link() for _ in range(n)) + (f"<div>{prose(6)}</div>" if rng.random() < 0.5 else "") + "".join(link() for _ in range(n)) + "</div></div>"
    kinds = (lambda: f"<h2>Z {word()}</h2>", lambda: f"<p>Z {word()}</p>", *([lambda: f"<p>Z {prose(rng.randint(15, 60))}</p>"] * 5))
    return f"<html><body>{menu(4)}<div>{''.join(rng.choice(kinds)() for _ in range(rng.randint(4, 12)))}</div>{menu(3)}"


def test_the_cut_labels_better_than_each_block_by_itself():
    rng, alone, together, flipped, n = random.Random(3), 0, 0, 0, 0
    for _ in range(100):
        page = html_extraction.blocks(_unmarked_page(rng))
        by_itself = (html_extraction.logits(html_extraction.features(page), html_extraction.DEFAULT) > 0).tolist()
        for b, x, y in zip(page, by_itself, html_extraction.label(page, html_extraction.DEFAULT), strict=True):
            truth = b.text.startswith("Z ")
            alone, together, flipped, n = alone + (x == truth), together + (y == truth), flipped + (x != y), n + 1
    assert flipped > n / 20 and together / n > 0.95 > alone / n


def test_nothing_around_a_block_outweighs_its_neighbours():
    most = 2 * sum(html_extraction.EDGE_MOST)
    assert all(abs(w) <= most for w in (*html_extraction.TAG_PRIOR, *html_extraction.CLASS_PRIOR))
    rng = random.Random(4)
    w = html_extraction.fit(html_extraction.evidence(p) for p in [PAGE] * 5 + [_unmarked_page(rng) for _ in range(5)])
    assert all(abs(x) <= most for x in w[html_extraction.N_TEXT : html_extraction.N_FEATURES]) and len(w) == len(html_extraction.DEFAULT)


# url filters


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/7?q=1", "https://a.example.net/de/8/x", "http://example.net/de/1#t", "ftp://notcom/en/", "http://x.org/es/1", None, "nothing", "http://h.com/en/", "://", "http://bad.site.io/buy/12?ref=1", "http://good.site.io/read/12"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id long, url string, host long")
    want = [("www.example.com", "/en/7", "example.com/en/7", "allow"), ("a.example.net", "/de/8/x", "example.net/de/8", "block"), ("example.net", "/de/1", "net/de/", "allow"), ("notcom", "/en/", None, "allow"), ("x.org", "/es/1", "org/es/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("h.com", "/en/", "com/en/", "block"), ("", "", None, "allow"), ("bad.site.io", "/buy/12", None, "block"), ("good.site.io", "/read/12", None, "allow")]
    labelled = spark.createDataFrame([(f"http://{'bad' if i % 4 == 0 else 'good'}.site.io/{'buy' if i % 2 else 'read'}/{i}", i % 4 == 0) for i in range(200)], "url string, is_bad boolean")
    index = url_filters.mine(labelled, "url", F.col("is_bad"))
    assert index == {"host:bad": [[]]}
    got = [tuple(r)[1:5] for r in url_filters.filter_urls(pages, index).orderBy("page_id").collect()]
    assert got == want
    assert url_filters.mine(labelled.limit(0), "url", F.col("is_bad")) == {} and url_filters.mine(labelled.filter("not is_bad"), "url", F.col("is_bad")) == {}
    assert url_filters.filter_urls(pages.limit(0), {}).count() == 0


def test_mined_rules_are_those_of_all_subsets(spark):
    rng = random.Random(8)
    data = [(f"http://{rng.choice('ab')}.{rng.choice('cd')}/{rng.choice('ef')}?{rng.choice('gh')}=1", rng.random() < 0.4) for _ in range(300)]
    df = spark.createDataFrame(data, "url string, bad boolean")
    index = url_filters.mine(df, "url", F.col("bad"), 0.02, 0.5)
    baskets = [(frozenset(r.t), r.bad) for r in df.select(url_filters.tokens(F.col("url")).alias("t"), "bad").collect()]
    n, bad = collections.Counter(), collections.Counter()
    for t, b in baskets:
        for k in range(1, len(t) + 1):
            for s in itertools.combinations(sorted(t), k):
                n[s] += 1
                bad[s] += b
    rules = [set(s) for s in n if bad[s] >= math.ceil(0.02 * len(data)) and bad[s] / n[s] >= 0.5]
    got = [r.hit for r in df.select(url_filters.matches(url_filters.tokens(F.col("url")), index).alias("hit")).collect()]
    assert got == [any(r <= t for r in rules) for t, _ in baskets]


# surrogates


def luhn(digits):
    s = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        s += d - 9 if d > 9 else d
    return s % 10 == 0


def test_surrogates(spark):
    texts = ["Mr. John Smith met Mrs Smith and Dr Иван Петров. Mr Smith left.", "a.b@mail3.example.com or A.B@mail3.example.com, +1 (017) 555-7713 or +1-017-555-7713", 'card 4111 1111 1111 1111 or 4111111111111111, ip 10.0.0.1. token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', None, "", "clean text 2.0, 12 numbers\n and 1,234.5 or 10.11.2024", "q@" * 5, "1" * 5000, "a.b@mail3.example.com"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(8, texts[8]), (None, texts[1])], "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in surrogates.replace(clashing(df), "key").collect():
        got[r.doc_id].append(r)
    one = got[0][0].text
    name = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) and Dr ([Ѐ-ӿ-]+) ([Ѐ-ӿ-]+)\. Mr (\w+) left\.", one)
    assert name and name[2] == name[3] == name[6] and name[1] in surrogates.GIVEN["m", "latin"] and "Smith" not in one
    mail = re.fullmatch(r"(\S+@\S+\.com) or (\S+), (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1-\d{3}-\d{3}-\d{4})", got[1][0].text)
    assert mail and mail[1] == mail[2] and re.sub(r"\D", "", mail[3]) == re.sub(r"\D", "", mail[4]) and "555-7713" not in got[1][0].text
    card = re.fullmatch(r'card (\d{4} \d{4} \d{4} \d{4}) or (\d{16}), ip (\d+\.\d+\.\d+\.\d+)\. token = "([0-9a-f]{40})"', got[2][0].text)
    assert card and card[1].replace(" ", "") == card[2] and luhn(card[2]) and card[2] != "4111111111111111" and not card[4].startswith("04dbeb")
    for i in (3, 4, 5, 6, 7):
        assert got[i][0].text == texts[i] and got[i][0].n_entities == 0
    assert got[8][0].text == got[8][1].text == mail[1] and got[None][0].text == got[1][0].text
    assert surrogates.replace(df.limit(0), "key").count() == 0


def test_surrogates_stay_distinct(spark):
    names = [a + b for a in ("Al", "Be", "Ce", "Du", "Em", "Fo", "Gu") for b in ("ra", "no", "li", "to", "mi", "sa", "ke")]
    df = spark.createDataFrame([(i, f"Mr {n} Smith and card {4000000000000000 + i}") for i, n in enumerate(names)], "doc_id long, text string")
    made = [re.match(r"Mr (\S+) (\S+) and card (\d+)", r.text).groups() for r in surrogates.replace(df, "key").collect()]
    assert len({m[0] for m in made}) == len({m[2] for m in made}) == len(names) and len({m[1] for m in made}) == 1
    assert not {m[0] for m in made} & set(names)


class PlainSurrogates:
    """The surrogates once more, character by character."""

    def __init__(self, key):
        self.key = key

    def permuted(self, values, sizes, kind):
        half, values = len(values) // 2, list(values)
        tweak = "\x01".join([self.key, kind, ",".join(map(str, sizes))])
        for r in range(surrogates.ROUNDS):
            own, other = (range(half, len(values)), values[:half]) if r % 2 == 0 else (range(half), values[half:])
            said = ",".join(map(str, other))
            h = "".join(hashlib.sha512("\x01".join([tweak, str(r), str(b), said]).encode()).hexdigest() for b in range(len(values) // 32 + 1))
            for i in own:
                values[i] = (values[i] + int(h[4 * i : 4 * i + 4], 16)) % sizes[i]
        return values

    def shaped(self, kind, text):
        of = [next(((lo, n) for lo, n in surrogates.ALPHABETS if lo <= ord(c) < lo + n), (ord(c), 1)) for c in text]
        made = self.permuted([ord(c) - lo for c, (lo, _) in zip(text, of, strict=True)], [n for _, n in of], kind + "," + ",".join(str(lo) for lo, _ in of))
        return "".join(chr(v + lo) for v, (lo, _) in zip(made, of, strict=True))

    def surrogate(self, kind, norm):
        if kind == "card":
            due = lambda body: next(d for d in range(10) if luhn(body + str(d)))
            body = norm[0] + self.shaped("card", norm[1:-1])
            return body + str((due(body) + int(norm[-1]) - due(norm[:-1])) % 10)
        if kind in surrogates.DIGIT_TYPES:
            return norm[0] + self.shaped(kind, norm[1:])
        if kind == "ip":
            return ".".join(map(str, self.permuted([int(x) for x in norm.split(".")], [256] * 4, kind)))
        if re.fullmatch("[0-9a-f]+", norm):
            return "".join(f"{v:x}" for v in self.permuted([int(c, 16) for c in norm], [16] * len(norm), kind))
        if kind == "email":
            head, _, end = norm.rpartition(".")
            return self.shaped("email", head) + "." + end
        if kind == "iban":
            due = lambda b: 98 - int("".join(str(int(c, 36)) for c in b + norm[:2] + "00")) % 97
            b = self.shaped("iban" + norm[:2], norm[4:])
            return norm[:2] + f"{(due(b) + int(norm[2:4]) - due(norm[4:])) % 100:02d}" + b
        return self.shaped(kind, norm)


def test_surrogates_against_a_plain_version(spark):
    rng, letters = random.Random(5), "abcxyzABCéÜжЯλ中0189.-_"
    of = {
        "email": lambda: "".join(rng.choice(letters.lower()) for _ in range(rng.randint(1, 80))) + "@" + rng.choice(["b", "mail3.example", "ü"]) + "." + rng.choice(["com", "de"]),
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), "phone": lambda: "".join(rng.choice("0123456789") for _ in range(rng.randint(7, 14))),
        "card": lambda: "".join(rng.choice("0123456789") for _ in range(rng.randint(13, 19))), "hex": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 128]))),
        "iban": lambda: "DE" + "".join(rng.choice("0123456789") for _ in range(20)), "secret": lambda: "".join(rng.choice("abAB01+/") for _ in range(rng.randint(16, 200))), "ssn": lambda: "".join(rng.choice("0123456789") for _ in range(9)),
    }
    rows = [(kind, make()) for kind, make in of.items() for _ in range(12)]
    got = spark.createDataFrame(rows, "kind string, norm string").withColumn("made", surrogates.surrogate(F.col("kind"), F.col("norm"), "key")).collect()
    plain = PlainSurrogates("key")
    for r in got:
        assert r.made == plain.surrogate(r.kind, r.norm), r
        assert len(r.made) == len(r.norm) or r.kind == "ip"


def test_all_addresses_of_a_shape_stay_distinct(spark):
    """A full space: each of the 676 addresses of one letter and one letter gets another."""
    names = [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    made = [r.text for r in surrogates.replace(spark.createDataFrame(list(enumerate(names)), "doc_id long, text string"), "key").collect()]
    assert set(made) == set(names)


def test_one_person_has_one_surrogate(spark):
    texts = ["Dr. Anna Schmidt met Mrs. Anna Schmidt; later Anna Schmidt left, and SCHMIDT too.", "Mr. Zoltan Kiss and Prof. Zoltan Kiss, Kissing", "macOS 10.15.7.1, v1.22.3.4, 1.2.3.4, but 192.168.1.77", "Anna Schmidt"]
    got = [r.text for r in surrogates.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "key").orderBy("doc_id").collect()]
    m = re.fullmatch(r"Dr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); later (\w+) (\w+) left, and SCHMIDT too\.", got[0])
    assert m and m[1] == m[3] == m[5] and m[2] == m[4] == m[6] and m[1] in surrogates.GIVEN["f", "latin"] and "Schmidt" not in got[0]
    m = re.fullmatch(r"Mr\. ([\w-]+) (\w+) and Prof\. ([\w-]+) (\w+), Kissing", got[1])
    assert m and m[1] == m[3] and m[2] == m[4] and m[1].split("-")[0] in surrogates.GIVEN["m", "latin"]
    assert re.fullmatch(r"macOS \d+\.\d+\.\d+\.\d+, v1\.22\.3\.4, 1\.2\.3\.4, but (\d+\.){3}\d+", got[2]) and "192.168.1.77" not in got[2]
    assert got[3] == texts[3]  # no title, so no name


# near-duplicates


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def squeezed(words):
    for p in range(1, 6):
        out, i = words[:p], p
        while i < len(words):
            k = 0
            while i + k < len(words) and words[i + k] == words[i + k - p]:
                k += 1
            skip = k // p * p
            i += skip
            out += words[i : i + (k - skip) + 1]
            i += k - skip + 1
        words = out
    return words


def test_banded_alignment():
    rng = random.Random(3)
    for t in range(1500):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            o = rng.random()
            if o < 0.6 and b:
                b[rng.randrange(len(b)) :][: int(o > 0.3)] = []
                b[rng.randrange(len(b) + 1) : 0] = []
                b[rng.randrange(len(b) + 1) - 1 if b else 0 : 0] = [rng.choice("xyz")]
            elif b:
                del b[rng.randrange(len(b))]
        if t % 10 == 0:
            b = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        d = distance(a, b)
        for most in (0, 1, 2, max(len(a), len(b)) // 5, 6):
            assert near_dedup.within(a, b, most) == (d <= most)


def classes(rows, heads=False):
    texts = sorted({t or "" for _, t, *_ in rows})
    words = [squeezed(WORD.findall(t)) for t in texts]
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            long = max(len(words[i]), len(words[j]))
            if abs(len(words[i]) - len(words[j])) <= 2 * long // 10 and sum((collections.Counter(words[i]) & collections.Counter(words[j])).values()) >= long - 2 * long // 10 and distance(words[i], words[j]) <= 2 * long // 10:
                head[find(i)] = find(j)
    of = {t: find(i) for i, t in enumerate(texts)}
    ids = collections.defaultdict(list)
    for d, t, *_ in rows:
        ids[of[t or ""]].append(d)
    if heads:
        return collections.Counter(min((x for x in v if x is not None), default=None) for v in ids.values())
    return [(d, min((x for x in ids[of[t or ""]] if x is not None), default=None), len(ids[of[t or ""]])) for d, t, *_ in rows]


def test_classes_equal_those_of_all_pairs(docs, rows, empty):
    got = near_dedup.near_duplicates(clashing(docs))
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got.collect()) == collections.Counter(classes(rows))
    assert near_dedup.near_duplicates(empty).count() == 0


def test_one_document_of_each_class_stays(docs, rows, empty):
    wide = clashing(docs)
    got = near_dedup.deduplicate(wide)
    assert got.columns == wide.columns
    assert collections.Counter(r.doc_id for r in got.collect()) == classes(rows, heads=True)
    assert near_dedup.deduplicate(empty).count() == 0


def test_large_groups_of_near_copies_are_one_class(spark):
    rng = random.Random(6)
    base = sentence(rng, 120, "abcdefghijklmnop").split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(6):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    shared = sentence(rng, 50)  # a passage that many different texts hold
    rows += [(1000 + i, sentence(rng, 110, "qrstuvwxyz") + " " + shared) for i in range(150)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(150)} == {0}
    assert all(got[1000 + i] == 1000 + i for i in range(150))


def flips(one, other):
    _, _, bits = near_dedup.bands([" ".join(one), " ".join(other)])
    return int(np.bitwise_count((bits[0] ^ bits[1]).view(np.uint64)).sum())


def test_parity_bounds_the_edits():
    rng = random.Random(11)
    one = [f"w{k % 50}" for k in range(100)]  # each word twice, far apart
    other = [f"w{k + 100}" if k < 15 else w for k, w in enumerate(one)]
    assert flips(one, other) <= 2 * distance(one, other)
    for _ in range(300):
        one = [rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 40))]
        other = list(one)
        for _ in range(rng.randint(1, 8)):
            k = rng.randrange(len(other) + 1)
            other[k : k + rng.randint(0, 1)] = [rng.choice("abcdefghijklxyz")] * rng.randint(0, 1)
        # words that repeat at once are counted by their own rule
        if one == squeezed(one) and other == squeezed(other):
            assert flips(one, other) <= 2 * distance(one, other)


def test_pairs_at_the_threshold_share_a_key():
    rng = random.Random(12)
    for low, high, least in ((5, 9, 1), (10, 14, 0.98), (15, 60, 0.98), (60, 150, 0.99)):
        texts = []
        for _ in range(200):
            one = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(low, high))]
            other, edits = list(one), 2 * len(one) // 10
            for k in sorted(rng.sample(range(len(one)), edits), reverse=True):
                # texts that grow or shrink lie in other length classes
                other[k : k + 1] = [f"new{rng.randrange(10**6)}"] * (edits % 2)
            texts += [" ".join(one), " ".join(other)]
        _, keys, _ = near_dedup.bands(texts)
        linked = near_dedup.verify(list(zip(texts[::2], texts[1::2], strict=True)))
        met = [len(np.intersect1d(x, y)) > 0 for x, y in zip(keys[::2], keys[1::2], strict=True)]
        assert all(linked) and sum(met) >= least * len(met)


def test_mixed_edits_share_a_key():
    """A tenth of the words replaced and nearly a tenth left out: similarity 0.8 to 0.82."""
    rng = random.Random(15)
    for n in (60, 200, 600):
        texts = []
        for _ in range(100):
            one = [f"w{rng.randrange(5000)}" for _ in range(n)]
            other = list(one)
            for k, at in enumerate(sorted(rng.sample(range(n), 19 * n // 100), reverse=True)):
                other[at : at + 1] = [f"new{rng.randrange(10**6)}"] * (k % 2)
            texts += [" ".join(one), " ".join(other)]
        _, keys, _ = near_dedup.bands(texts)
        assert all(near_dedup.verify(list(zip(texts[::2], texts[1::2], strict=True))))
        assert sum(len(np.intersect1d(x, y)) > 0 for x, y in zip(keys[::2], keys[1::2], strict=True)) >= 97


def test_near_duplicates_share_a_rare_word():
    """The prefix filter is exact, whatever the order of words is."""
    rng = random.Random(16)
    for t in range(300):
        frequency = np.array([rng.randrange(3) for _ in range(near_dedup.PLACES)], np.uint8) if t % 100 == 0 else frequency  # noqa: F821
        one = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 60))]
        other, edits = list(one), rng.randint(0, 2 * len(one) // 10)
        for _ in range(edits):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randint(0, 1)] = [rng.choice("abcxyz123")] * rng.randint(0, 1)
        if not near_dedup.near(" ".join(one), " ".join(other)):
            continue
        hashes, doc = near_dedup.every_word([" ".join(one), " ".join(other)])
        label, cut = near_dedup._label(hashes, doc), int((doc == 0).sum())
        first = [near_dedup.rarest(hashes[s], label[s], frequency) for s in (slice(0, cut), slice(cut, None))]
        assert len(np.intersect1d(*first)), (one, other)


def test_repeated_words_count():
    rng = random.Random(13)
    one, other = ("buy now " * 400 + sentence(rng, 30, x) for x in ("abcdefgh", "qrstuvwx"))
    assert near_dedup.near(one, other)
    assert not near_dedup.near("buy", "buy " * 1000)


def test_links_in_a_crowd_are_those_of_a_small_table(spark):
    rng = random.Random(14)
    passage = sentence(rng, 60)  # in all texts
    rows, want = [], {}
    for i in range(60):
        base = sentence(rng, 60, "ijklmnopqrst").split()
        for k in range(2):
            w = list(base)
            for at in rng.sample(range(60), 10 * k):
                w[at] = f"v{rng.randrange(10**6)}"
            rows.append((2 * i + k, passage + " " + " ".join(w)))
            want[2 * i + k] = 2 * i
    # a family whose members are all near the first, and half of them near each other
    base = sentence(rng, 100, "uvwxyz").split()
    for i in range(70):
        w = list(base)
        for at in rng.sample(range(100), 18 if i else 0):
            w[at] = f"v{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w)))
        want[1000 + i] = 1000
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def crowd(rng):
    """Texts that share most of their words and are near the threshold, of several lengths, and pairs among them that are links."""
    passage, rows = "is one. " * 40, []
    for i in range(60):
        own = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 2) for _ in range(rng.randint(14, 34))]
        rows.append((i, " ".join(own) + " " + passage))
        if i % 3 == 0:
            own[3:5] = ["other"] * rng.randint(0, 3)
            rows.append((100 + i, " ".join(own) + " " + passage))
    return rows


def plain_classes(rows):
    head = {d: d for d, _ in rows}
    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if near_dedup.near(x, y):
            old, new = max(head[a], head[b]), min(head[a], head[b])
            head = {d: new if h == old else h for d, h in head.items()}
    return head


@pytest.mark.parametrize("pairwise", [64, 0])
def test_a_crowd_at_the_threshold(spark, monkeypatch, pairwise):
    """Pair by pair and by rare words: the same classes, those of all pairs."""
    rows = crowd(random.Random(17))
    monkeypatch.setattr(near_dedup, "PAIRWISE", pairwise)
    monkeypatch.setattr(near_dedup, "BUCKET", 4)
    if not pairwise:  # all that lengths leave in one group is a crowd
        real = near_dedup._groups
        monkeypatch.setattr(near_dedup, "_groups", lambda apart: real(apart).withColumn("crowd", F.lit(True)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_classes(rows)
    assert got == want and 5 < len(set(want.values())) < 60


def test_pairs_of_a_crowd_are_compared_once(spark, monkeypatch):
    """What a smaller group has given is not given again by rare words."""
    rows = crowd(random.Random(17))
    monkeypatch.setattr(near_dedup, "BUCKET", 4)
    grouped, by_pairs, possible, seen = near_dedup._groups, near_dedup._pair_by_pair, near_dedup._possible, []

    def kept(pairs):
        seen.append({(r["a"], r["b"]) for r in pairs.collect()})
        return pairs

    monkeypatch.setattr(near_dedup, "_groups", lambda apart: grouped(apart).withColumn("crowd", F.col("key") % 2 == 0))
    monkeypatch.setattr(near_dedup, "_pair_by_pair", lambda groups, bits: kept(by_pairs(groups, bits)))
    monkeypatch.setattr(near_dedup, "_possible", lambda pairs, bits: possible(kept(pairs), bits))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    *_, small, rare = seen
    assert got == plain_classes(rows) and small and rare and not small & rare


def test_a_crowd_that_meets_on_common_words_is_compared_in_blocks(spark, monkeypatch):
    """Where the rarest words are shared by many, few pairs come out that lengths and word bits rule out: those of smaller keys."""
    rows = crowd(random.Random(23))
    monkeypatch.setattr(near_dedup, "BUCKET", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    grouped, by_words, seen = near_dedup._groups, near_dedup._by_rare_words, []

    def met(apart, nodes, docs):
        pairs = near_dedup.settled(by_words(apart, nodes, docs))
        bits = nodes.select("node", F.slice("bits", 1, near_dedup.PARITY // 64).alias("bits"))
        seen.append((pairs.count(), near_dedup._possible(pairs, bits).count()))
        return pairs

    monkeypatch.setattr(near_dedup, "_groups", lambda apart: grouped(apart).withColumn("crowd", F.lit(True)))
    monkeypatch.setattr(near_dedup, "_by_rare_words", met)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ((pairs, possible),) = seen
    assert got == plain_classes(rows) and 0 < possible <= pairs <= 1.1 * possible


def test_blocks_give_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    members = [(k, node, 20 + node // 2, node % 5) for k in (1, 2) for node in range(40 * k, 40 * k + 60)]
    bits = [(node, [0] * (near_dedup.PARITY // 64)) for node in range(40, 140)]
    got = near_dedup._in_blocks(spark.createDataFrame(members, "key long, node long, n_words long, component long"), spark.createDataFrame(bits, "node long, bits array<long>")).collect()
    want = [(a, b, m, n) for (k, a, m, c), (j, b, n, d) in itertools.combinations(members, 2) if k == j and c != d and 10 * (n - m) <= 2 * n]
    assert sorted(map(tuple, got)) == sorted(want)


def test_texts_with_more_words_than_their_group_has_texts_are_not_taken_apart(spark, monkeypatch):
    rng = random.Random(18)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, 60, "ijklmnopqrst") + " " + passage) for i in range(40)]

    def refused(*args):
        raise AssertionError("rare words for a small group")

    monkeypatch.setattr(near_dedup, "_by_rare_words", refused)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id for r in got)


def test_groups_keep_all_lengths_of_a_link_together(spark):
    members = [("k", n, n, 100, n) for n in (*range(1, 130), 1000, 1249, 1250, 8000, 10000)]
    held = near_dedup._groups(spark.createDataFrame(members, "key string, node long, n_words long, n long, component long")).collect()
    cells = collections.defaultdict(set)
    for r in held:
        cells[r.node].add(r.size_class)
    for m, n in itertools.combinations([x[1] for x in members], 2):
        if 10 * (n - m) <= 2 * n:
            assert cells[m] & cells[n], (m, n)


def test_bits_and_lengths_bound_the_edits_together(spark):
    rng = random.Random(19)
    one = [f"w{rng.randrange(5000)}" for _ in range(100)]
    longer = [*one, *(f"v{k}" for k in range(15))]
    far = [f"u{k}" if k < 16 else w for k, w in enumerate(longer)]  # 15 words more and 16 others: 31 edits of 23
    n, _, bits = near_dedup.bands([" ".join(x) for x in (one, longer, far)])
    rows = [(int(n[0]), bits[0].tolist(), int(n[k]), bits[k].tolist()) for k in (1, 2)]
    got = spark.createDataFrame(rows, "n long, x array<long>, m long, y array<long>").select(near_dedup._alike("n", "m", "x", "y").alias("is")).collect()
    assert [r["is"] for r in got] == [True, False] and not near_dedup.near(" ".join(one), " ".join(far))


def test_long_texts_meet_by_the_bits_of_their_own_size(spark):
    """A passage of 560 words and 200 others each: too many edits, which the places of short texts do not tell."""
    rng = random.Random(21)
    own = [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(2)]
    texts = [" ".join([*x, *["is", "one."] * 280]) for x in (*own, [*own[0][:100], *own[1][100:]])]
    n, _, bits = near_dedup.bands(texts)
    groups = spark.createDataFrame([("k", 0, i, int(n[i]), i) for i in range(3)], "key string, size_class long, node long, n_words long, component long")
    held = spark.createDataFrame([(i, bits[i].tolist()) for i in range(3)], "node long, bits array<long>")
    met = {(r["a"], r["b"]) for r in near_dedup._pair_by_pair(groups, held).collect()}
    assert met == {(0, 2), (1, 2)} == {(a, b) for a, b in itertools.combinations(range(3), 2) if near_dedup.near(texts[a], texts[b])}


def test_components_in_the_driver_are_those_of_the_joins(spark, monkeypatch):
    rng = random.Random(20)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    df = spark.createDataFrame(links, "a long, b long")
    here = near_dedup.components(df).collect()
    monkeypatch.setattr(near_dedup, "HELD_LINKS", 0)
    assert sorted(here) == sorted(near_dedup.components(df).collect())


# language model


def test_gradients(monkeypatch):
    vocab = language_model.Vocabulary(language_model.pd.DataFrame({"hash": range(1, 3000), "cls": [k % 16 for k in range(1, 3000)], "n": [3000 // k + 1 for k in range(1, 3000)]}), 50, {r: 500.0 for r in range(16)})
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, language_model.START, n).astype(np.uint16) for n in (9, 7, 7, 2)]
    model = language_model.Model(vocab)
    for k in ("C", "I"):
        model.p[k] = rng.standard_normal(model.p[k].shape).astype(np.float32) * np.float32(0.3)
    used, before = {k: v.astype(np.float64) for k, v in model.p.items()}, {k: v.astype(np.float64) for k, v in model.seen.items()}
    monkeypatch.setattr(language_model, "RATE", 0.0)
    model.group(seqs, learn=True)  # the sums of squares tell the gradients
    scale = 1 / max(sum(map(len, seqs)), language_model.LANES)
    for k in used:
        g = np.sqrt(np.maximum(model.seen[k] - before[k], 0)).ravel()
        for at in np.argsort(-g)[:3]:
            loss = []
            for e in (1e-2, -1e-2):
                m = language_model.Model(vocab)
                m.p = {n: v.copy() for n, v in used.items()}
                m.p[k].ravel()[at] += e
                loss.append(-m.group(seqs).sum())
            assert abs(g[at] - abs(loss[0] - loss[1]) / 2e-2 * scale) < 2e-3 * g[at] + 1e-6


def test_scores(spark, rows, empty):
    rng = random.Random(9)
    words = {lang: ["".join(rng.choice(a) for _ in range(4)) for _ in range(60)] for lang, a in (("x", "abcde"), ("y", "vwxyz"))}
    have = rows + [(1000 + i, " ".join(rng.choice(words["xy"[i % 2]]) for _ in range(80)), "en", "a", 1) for i in range(400)]
    got = language_model.score(clashing(spark.createDataFrame(have, DOCS))).collect()
    tokens = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + [None]
    out = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0
    c = collections.Counter(w for d, t, *_ in have if not out(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = collections.Counter((d, out(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 4)) for d, t, *_ in have)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    held = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 1000]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert language_model.score(empty).count() == 0


def plain_log10(model, ids):
    """Log-likelihood of one text, step by step in 64 bits."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    h, x, total, H = np.zeros(language_model.HIDDEN), model.start, 0.0, language_model.HIDDEN
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for y in map(int, ids):
        into, back = p["E"][x] @ p["W"] + p["b"], h @ p["U"]
        z, r = sigmoid(into[:H] + back[:H]), sigmoid(into[H : 2 * H] + back[H : 2 * H])
        n = np.tanh(into[2 * H :] + r * back[2 * H :])
        h = (1 - z) * n + z * h
        logits = h @ p["C"] + p["c"]
        k = y // model.width if y < model.places else model.classes + y - model.places
        total += logits[k] - np.log(np.exp(logits).sum())
        if y < model.places:
            inner = h @ p["I"][k] + p["i"][k]
            total += inner[y - k * model.width] - np.log(np.exp(inner).sum())
        else:
            total -= model.rare_log[k - model.classes]
        x = y
    return total / math.log(10)


def test_scores_are_those_of_a_plain_network(spark, monkeypatch):
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words[: 20 + i]) for _ in range(rng.randint(0, 90)))) for i in range(250)]
    docs, seen = spark.createDataFrame(rows, "doc_id long, text string"), []
    monkeypatch.setattr(language_model, "PART_TOKENS", 200)  # several parts and rounds
    monkeypatch.setattr(language_model, "FAN", 2)  # several levels of the tree
    train = language_model.trained

    def watched(model, texts, parts, rounds):
        first = model.vector()
        out = train(model, texts, parts, rounds)
        seen.append((first, texts, rounds, out))
        return out

    monkeypatch.setattr(language_model, "trained", watched)
    init = language_model.Vocabulary.__init__
    monkeypatch.setattr(language_model.Vocabulary, "__init__", lambda self, *a: seen.append(self) or init(self, *a))
    got = {r.doc_id: r.score for r in language_model.score(docs.repartition(3)).collect()}
    vocab, (first, texts, rounds, model) = seen[0], seen[1]
    assert vocab.places == language_model.places_for(1 + len({w for _, t in rows for w in t.split()})) and rounds > 2

    # training: each part from the last average, then the mean by tokens
    by = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in sorted(texts.collect(), key=lambda r: (r.part, r.round, r.hash, r.ids)):
        by[r.round][r.part].append(bytes(r.ids))
    assert sorted(by) == list(range(rounds)) and all(len(x) > 4 for x in by.values())
    m = language_model.Model(vocab)
    assert (m.vector() == first).all()
    for k in range(rounds):
        start, sums, n = m.vector(), 0, 0
        for held in by[k].values():
            m.set_vector(start)
            seqs = m.ids(held)
            m.over(seqs, learn=True)
            tokens = sum(map(len, seqs))
            sums, n = sums + m.vector().astype(np.float64) * tokens, n + tokens
        m.set_vector(sums / n)
    assert np.allclose(m.vector(), model.vector(), atol=2e-3)

    # scoring
    for d, t in rows:
        code = vocab.encode([t])
        want = plain_log10(model, np.frombuffer(code["ids"][0], vocab.kind)) + code["log_table"][0]
        assert not len(code["far"][0]) and abs(got[d] - want) < 1e-3 + 1e-5 * abs(want)


def test_scores_do_not_depend_on_partitions(spark, rows, monkeypatch):
    monkeypatch.setattr(language_model, "PART_TOKENS", 2000)
    docs = spark.createDataFrame(rows, DOCS)
    one, other = (sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in language_model.score(docs.repartition(n)).collect()) for n in (2, 7))
    assert one == other


def test_packed_learning_has_the_gradients_of_single_texts(monkeypatch):
    words = language_model.pd.DataFrame({"hash": range(1, 400), "cls": [k % 16 for k in range(1, 400)], "n": [400 - k for k in range(1, 400)]})
    vocab, rng = language_model.Vocabulary(words, 50, {r: 7.0 for r in range(16)}), np.random.default_rng(5)
    seqs = [rng.integers(0, 400, n).astype(np.uint16) for n in (5, 4, 3, 2, 1)]
    monkeypatch.setattr(language_model, "RATE", 0.0)
    own = []
    for lane in (None, np.array([0, 1, 1, 0, 1])):  # fifteen tokens: one window either way
        model = language_model.Model(vocab, seed=3)
        for k in ("C", "I"):
            model.p[k] = np.random.default_rng(4).standard_normal(model.p[k].shape).astype(np.float32)
        score = model.group(seqs, True, lane)
        own.append((score, {k: v - np.float32(1e-3) for k, v in model.seen.items()}))
    assert np.allclose(own[0][0], own[1][0], rtol=1e-5)
    for k, v in own[0][1].items():
        assert v.max() > 0 and np.allclose(v, own[1][1][k], rtol=1e-2, atol=1e-9), k


def test_words_of_equal_counts_fill_the_table(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.randrange(-(2**63), 2**63), 9 if k < 10 else 4 if k < 400 else 1) for k in range(1000)]
    words = spark.createDataFrame(rows, "hash long, n long")
    for most in (5, 200, 700, 1000):
        monkeypatch.setattr(language_model, "TABLE", most)
        got = sorted(((-r.n, r.hash) for r in language_model.top_words(words).collect()))
        assert got == sorted((-n, h) for h, n in rows)[: len(got)] and most - 2 <= len(got) <= most


def test_words_are_found_by_the_first_bits_of_their_hashes():
    rng = np.random.default_rng(3)
    near = np.concatenate([np.int64(k << 44) + np.arange(5) for k in (-(1 << 19), -1, 0, 7, (1 << 19) - 1)])  # several in one group, the first and the last
    hashes = np.unique(np.concatenate([near, rng.integers(-(1 << 63), (1 << 63) - 1, 4000), [-(1 << 63), (1 << 63) - 1]]))
    vocab = language_model.Vocabulary(language_model.pd.DataFrame({"hash": hashes, "cls": hashes % 16, "n": np.arange(len(hashes)) % 7 + 1}), 50, {r: 9000.0 for r in range(16)})
    asked = rng.permutation(np.concatenate([hashes, near + 5, rng.integers(-(1 << 63), (1 << 63) - 1, 4000)]))
    assert (vocab.hash[vocab.find(asked)] == asked).tolist() == np.isin(asked, hashes).tolist() and vocab.most >= 5


@pytest.mark.parametrize("large", [0.0, 300.0])
def test_heads_give_what_a_plain_softmax_gives_for_large_sums_too(large):
    words = language_model.pd.DataFrame({"hash": range(1, 2000), "cls": [k % 16 for k in range(1, 2000)], "n": [2000 - k for k in range(1, 2000)]})
    model, rng = language_model.Model(language_model.Vocabulary(words, 50, {r: 1e6 for r in range(16)})), np.random.default_rng(4)
    for k in ("C", "I"):
        model.p[k] = rng.standard_normal(model.p[k].shape).astype(np.float32) + np.float32(large) * rng.choice([-1, 1], model.p[k].shape).astype(np.float32)
    hs, y = rng.uniform(-1, 1, (300, language_model.HIDDEN)).astype(np.float32), rng.integers(0, language_model.PLACES + 16, 300)
    got, grad, _ = model._heads(hs, y, True)
    plain = lambda w, b, h, t: (lambda s: s[t] - s.max() - np.log(np.exp(s - s.max()).sum()))(h.astype(float) @ w.astype(float) + b)
    for h, t, g in zip(hs, y.tolist(), got, strict=True):
        c = t // model.width if t < language_model.PLACES else model.classes + t - language_model.PLACES
        want = plain(model.p["C"], model.p["c"], h, c) + (plain(model.p["I"][c], model.p["i"][c], h, t % model.width) if c < model.classes else -model.rare_log[c - model.classes])
        assert abs(g - want) < 1e-3 * max(1, abs(want))
    assert all(np.isfinite(g).all() for g in grad.values())


def test_free_lanes_take_the_next_text(monkeypatch):
    words = language_model.pd.DataFrame({"hash": range(1, 40), "cls": [k % 16 for k in range(1, 40)], "n": [40 - k for k in range(1, 40)]})
    model, rng, windows = language_model.Model(language_model.Vocabulary(words, 50, {r: 7.0 for r in range(16)})), np.random.default_rng(2), []
    for k in ("C", "I"):
        model.p[k] = rng.standard_normal(model.p[k].shape).astype(np.float32)
    seqs = [rng.integers(0, 40, n).astype(np.uint16) for n in (*[20] * 24, 320, *[20] * 24)]
    alone, heads = [model.group([s])[0] for s in seqs], language_model.Model._heads
    monkeypatch.setattr(language_model, "SCORED_LANES", 4)
    monkeypatch.setattr(language_model.Model, "_heads", lambda self, *a: windows.append(1) or heads(self, *a))
    assert np.allclose(model.over(seqs), alone, rtol=1e-4)
    assert len(windows) == 320 // language_model.WINDOW  # four lanes of 320 tokens; 44 windows in groups of four texts


def test_what_is_learned_grows():
    assert language_model.places_for(10**10) > language_model.places_for(10**8) > language_model.places_for(10**6) >= language_model.places_for(0)
    for a, b in itertools.pairwise((10**6, 10**8, 10**10, 10**13)):
        (pa, ra), (pb, rb) = language_model.parts_for(a), language_model.parts_for(b)
        assert pb > pa and rb >= ra and b / pb > a / pa


def test_probabilities_add_up():
    words = language_model.pd.DataFrame({"hash": range(1, 40), "cls": [k % 16 for k in range(1, 40)], "n": [40 - k for k in range(1, 40)]})
    vocab = language_model.Vocabulary(words, 50, {r: 7.0 for r in range(16)})
    m = language_model.Model(vocab)
    every = [np.array([k], np.uint16) for k in range(40)] + [np.array([language_model.PLACES + r], np.uint16) for r in range(16)]
    p = np.exp([m.group([s])[0] for s in every])
    mass = np.concatenate([np.ones(40), vocab.rare_mass])  # all words of a rare class share its mass
    assert abs((p * mass).sum() - 1) < 1e-4


# repetition


def test_repetition(docs, rows, empty):
    got = repetition.repetition(clashing(docs)).select("doc_id", "quality.*").collect()
    assert len(got) == len(rows)

    def plain(t):
        t = t or ""
        w = WORD.findall(t)
        inside = {}
        for n in (3, *repetition.GRAM_LIMITS):
            seen = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
            inside[n] = {i + k for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for k in range(n)}
        lines, seen, dup = [x for x in t.split("\n") if WORD.search(x)], set(), []
        for x in lines:
            if x in seen:
                dup.append(x)
            seen.add(x)
        chars = sum(map(len, w))
        failed = len(w) < 50 or 100 * len(inside[3]) > 50 * len(w)
        over = 100 * sum(map(len, dup)) > repetition.LINE_LIMIT * sum(map(len, lines)) or any(100 * sum(len(w[i]) for i in inside[n]) > most * chars for n, most in repetition.GRAM_LIMITS.items())
        return len(w), chars, sum(c in "#*$%&|<>" for c in t), len(dup), len(inside[3]), failed, not failed and not over

    texts = [t for _, t, *_ in rows] + ["a b c\n" * 40, "x y\r\nx y\r\n" + "q" * 5, "é ü\n" * 3]
    measured = repetition.measure([t or "" for t in texts])
    for i, t in enumerate(texts):
        p = plain(t)
        assert tuple(int(measured[f][i]) for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == p[:5]
    want = collections.Counter((d, *plain(t)) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want
    assert repetition.repetition(empty).count() == 0


# mixing


def fair_queue(rows):
    from hashlib import md5

    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r[3] for r in rows if r[3] is not None}) + ([None] if any(r[3] is None for r in rows) else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    stream, total = [], sum(size(r[1]) for r in rows)
    for k, s in enumerate(sources):
        own = sorted((i for i, r in enumerate(rows) if r[3] == s), key=lambda i: (md5(str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest(), size(rows[i][1])))
        upto = 0
        for _ in range(2):
            for i in own:
                upto += size(rows[i][1])
                if size(rows[i][1]):
                    stream.append((upto * 6 // weight[s], k, i))
    taken, spent = collections.Counter(), 0
    for _, _, i in sorted(stream):
        spent += size(rows[i][1])
        if spent > 1.5 * total:
            break
        taken[i] += 1
    return collections.Counter((r[0], size(r[1]), r[3], taken[i] * size(r[1])) for i, r in enumerate(rows))


def test_mix(docs, rows, empty):
    got = mixing.mix_sources(clashing(docs)).collect()
    assert collections.Counter((r.doc_id, r["size"], r.source, r.taken) for r in got) == fair_queue(rows)
    own = collections.defaultdict(int)
    for r in got:
        own[r.source] += r.taken
        assert r.target <= 2 * r.source_size + 1e-6 and r.taken <= 2 * r["size"]
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * sum({r.source: r.source_size for r in got}.values())) < 1e-3
    assert mixing.mix_sources(empty).count() == 0


def test_mixed_rows(docs, rows, empty):
    wide = clashing(docs)
    got = mixing.mixed(wide)
    assert got.columns == wide.columns
    want = collections.Counter()
    for (d, size, s, taken), n in fair_queue(rows).items():
        want[d, s, size] += n * (taken // size if size else 0)
    assert collections.Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in got.collect()) == +want
    assert mixing.mixed(empty).count() == 0
