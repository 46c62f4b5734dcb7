"""Filter audit, centroid clustering and the web archive against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
import uuid

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperloom.llm import adaptive_kmeans, filter_audit, html_extraction, url_filters, warc_store
from paperloom.llm.common import shared_dir

WORD = re.compile(r"[^ \t-\r]+")


def clashing(df):
    """The same rows with columns named as the operators' own."""
    for c in ("part", "mask", "own", "digest", "first", "id", "vec", "v", "near", "upper", "lower", "cluster", "distance", "need", "payload", "size", "second", "salt", "header", "record", "x_id", "n"):
        df = df.withColumn(c, F.lit("x"))
    return df


# filter audit


def plain_audit(docs, labels):
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))

    def fails(d, t):
        t = t or ""
        w = WORD.findall(t)
        tests = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > least[t]}
        return {f for f, x in tests.items() if x}

    parts, out = collections.defaultdict(list), []
    for d, t, s in docs:
        parts[s or ""].append((d, fails(d, t)))
    for part, rows in parts.items():
        removed_by = collections.Counter()
        mine = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(rows)
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                redundant = sum(f in x and bool(x & set(order[:k])) for _, x in rows)
                removed_by[f] += len(gone)
                mine.append((part, order, k + 1, len(left), len(gone), redundant, sum(x == {f} for _, x in rows), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out += [(*r, removed_by[r[1][r[2] - 1]]) for r in mine]
    return out


def some_documents():
    rng, out = random.Random(3), []
    for i in range(80):
        words = [rng.choice(["alpha", "beta", "Gamma", "DELTA", "e", "z%"] if i % 3 else [f"w{k}" for k in range(300)]) for _ in range(rng.choice([0, 5, 199, 200, 260]))]
        out.append((i, " ".join(words), rng.choice(["a", "b", "", None])))
    out += [(200 + k, out[6][1], "a") for k in range(30)]  # copies
    return out + [(300, None, "a"), (301, "", "b"), (302, " \n\t", None), (None, out[6][1], "a"), (None, None, "c"), (6, out[6][1], "a"), (6, out[6][1], "b"), (5, out[6][1], "b"), (400, "Long " * 30000, "b")]


def test_audit_against_every_order_run(spark):
    docs = some_documents()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 100, 2)] + [(6, 0, 1), (6, 1, None), (None, 1, 1), (11, None, None), (999, 1, 1)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.document_masks(clashing(d), clashing(lab)))
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"], "bigint")
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(docs, labels))
    none = filter_audit.document_masks(d.limit(0), lab)
    assert filter_audit.audit(none).count() == 0
    bare = filter_audit.audit(filter_audit.document_masks(d, lab.limit(0)))
    assert bare.agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[0] == 0


def test_audit_of_other_filters(spark):
    masks = spark.createDataFrame([("p", m, m % 2, 0) for m in (0, 1, 2, 3, 3, 5, 7)], "part string, mask int, good int, toxic int")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(masks, "xyz").collect()}
    assert len(got) == 6 * 3
    assert (got["xyz", 1].removed, got["xyz", 2].removed, got["xyz", 3].removed, got["xyz", 3].kept) == (5, 1, 0, 1)
    assert (got["zyx", 1].removed, got["zyx", 2].redundant, got["zyx", 2].unique_fails) == (2, 1, 1)
    # what the filters remove adds up to what an order removes, in every order
    assert sum(got["xyz", k].shapley for k in (1, 2, 3)) == 6 * 6
    with pytest.raises(ValueError):
        filter_audit.audit(masks, "xx")


# centroid clustering


def plain_clusters(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-(2**27), min(2**27, math.floor(scale * x))) for x in v]))
    name = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=name)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        at = [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
        if turn == rounds:
            break
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    total, per = sum(d for d, _ in at), collections.Counter()
    for d, c in at:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, per[c], total, sha[c]) for (i, _), (d, c) in zip(kept, at, strict=True)]


def some_vectors(n=400, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (9, 64))
    rows = [(i, [float(np.float32(x)) for x in centre[i % 9] + rng.normal(0, 0.4, 64)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)] + [(7, rows[8][1]), (7, rows[7][1]), (None, rows[9][1])]  # copies, repeated ids
    bad = [(1000, None), (1001, []), (1002, rows[0][1][:63]), (1003, [*rows[0][1][:63], None]), (1004, [*rows[0][1][:63], float("nan")]), (1005, [*rows[0][1][:63], float("-inf")]), (1006, [*rows[0][1], 1.0])]
    return rows + bad


def test_clusters_are_those_of_a_full_search(spark):
    rows = some_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = adaptive_kmeans.cluster(clashing(df))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_clusters(rows))


@pytest.mark.parametrize("rows", [[(1, [0.5] * 64)], [(i, [0.25 * (i % 2)] * 64) for i in range(40)], [(i, [1e30 if i % 3 else -2.0e6 - i] * 64) for i in range(30)]], ids=["one", "ties", "large"])
def test_few_tied_and_large_vectors(spark, rows):
    got = adaptive_kmeans.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), dimensions=64)
    assert sorted(map(tuple, got.collect())) == sorted(plain_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in rows]))


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert adaptive_kmeans.cluster(none).collect() == [] == adaptive_kmeans.cluster(none.limit(0)).collect()


def test_bounds_are_bounds_and_spare_distances():
    """Over many rounds no bound is wrong, every assignment is that of a full search, and most vectors need few centroids."""
    rng = np.random.default_rng(5)
    x = rng.integers(-60, 60, (12, 8))[rng.integers(0, 12, 3000)] + rng.integers(-12, 13, (3000, 8))
    x[:300] = x[0]
    c = x[rng.choice(3000, 16, replace=False)].copy()
    near, upper, lower = adaptive_kmeans.ranked(x, c, 4)
    asked = []
    for _ in range(12):
        d = adaptive_kmeans.squared(x, c)
        assert (near[:, 0] == d.argmin(1)).all()
        true = np.sqrt(d)
        rows = np.arange(len(x))
        assert (upper >= true[rows, near[:, 0]] - 1e-9).all()
        for k in range(1, near.shape[1]):
            assert (lower[:, k - 1] <= true[rows, near[:, k]] + 1e-9).all()
        rest = true.copy()
        np.put_along_axis(rest, near.astype(np.int64), np.inf, 1)
        assert (lower[:, -1] <= rest.min(1) + 1e-9).all()
        old = c.copy()
        for j in range(16):
            if (near[:, 0] == j).any():
                c[j] = x[near[:, 0] == j].sum(0) // (near[:, 0] == j).sum()
        near, upper, lower, need = adaptive_kmeans.moved(x, near, upper, lower, np.sqrt(((c - old) ** 2).sum(1)), c)
        asked.append(np.where(need > 4, 16, need).mean())
    assert asked[0] < 8 and asked[-1] < 2


def test_distances_are_whole_numbers_at_any_size():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 20, 1 << 27):
        x, c = rng.integers(-top, top + 1, (20, 64)), rng.integers(-top, top + 1, (5, 64))
        assert [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x] == adaptive_kmeans.squared(x, c).tolist()


# web archive


def place(spark):
    return f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"


def some_pages():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abc <p>é\n\r") for _ in range(n))
    rows = [(i, f"https://h{i % 7}.org/p{i}", text(rng.choice([0, 20, 99, 100, 101, 400]))) for i in range(60)]
    rows += [(100 + i, "https://copy.org/é", "copy " * 40) for i in range(50)] + [(90, None, "copy " * 40), (200, "", "small copy"), (199, "u", "small copy")]
    rows += [(300, "a\r\nWARC-Type: revisit\r\n\r\nb c", None), (301, "x", ""), (None, "n", "copy " * 40), (None, "n", "only without ids " * 9), (None, "m", "only without ids " * 9)]
    rows += [(400, "again", "repeated rows " * 9)] * 3 + [(401, "again", "repeated rows " * 9)] * 2 + [(500, "long", "y" * 300000)]
    return rows


def plain_read_back(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        revisit = len(b) >= 100 and f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return collections.Counter(out)


@pytest.mark.parametrize("broadcast", [True, False])
def test_archive_reads_back_as_written(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(warc_store, "sized", lambda df: df)
    rows, at = some_pages(), place(spark)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    warc_store.write_archive(clashing(df), at)
    assert collections.Counter(map(tuple, warc_store.read_back(spark, at).collect())) == plain_read_back(rows)
    stored = spark.read.parquet(f"{at}/payloads").collect()
    assert len(stored) == len({h or "" for _, _, h in rows})  # each payload once
    # each record's bytes by the rules of the format
    got = warc_store.read_records(spark, at).collect()
    assert collections.Counter((r.id, bytes(r.payload)) for r in got) == collections.Counter((i, (h or "").encode()) for i, _, h in rows)
    for r in got:
        record = bytes(r.record)
        head, block = record.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n") and len(block) == int(fields["Content-Length"]) + 4
        http, body = block[:-4].split(b"\r\n\r\n", 1)
        assert f"Content-Length: {len(bytes(r.payload))}".encode() in http
        assert body == (b"" if fields["WARC-Type"] == "revisit" else bytes(r.payload))
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_an_empty_archive(spark):
    at = place(spark)
    warc_store.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), at)
    assert warc_store.read_back(spark, at).count() == 0


def test_damage_is_found(spark):
    at = place(spark)
    warc_store.write_archive(spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, html string"), at)
    spark.read.parquet(f"{at}/payloads").withColumn("payload", F.when(F.col("payload") == b"one", F.lit(b"ONE")).otherwise(F.col("payload"))).write.parquet(f"{at}-b/payloads")
    spark.read.parquet(f"{at}/headers").write.parquet(f"{at}-b/headers")
    with pytest.raises(PySparkException, match="does not have its digest"):
        warc_store.read_back(spark, f"{at}-b").collect()
    spark.read.parquet(f"{at}/payloads").filter(F.col("payload") == b"two").write.parquet(f"{at}-c/payloads")
    spark.read.parquet(f"{at}/headers").write.parquet(f"{at}-c/headers")
    with pytest.raises(PySparkException, match="no payload under"):
        warc_store.read_back(spark, f"{at}-c").collect()


def test_a_collision_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(warc_store.F, "sha2", lambda c, n: F.lit("00" * 32))
    with pytest.raises(PySparkException, match="two payloads under one digest"):
        warc_store.write_archive(spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, html string"), place(spark))


# pages whose only element has a label of something else


@pytest.mark.parametrize("start", ['<div class="content-sidebar">', '<main class="notice">', '<article class="menu-item">', '<div class="search-content">', '<div class="comment-policy-article">', '<div id="ad-free-post">', '<section class="newsletter">'])
def test_a_label_of_the_whole_page_marks_nothing(start):
    text = "This is a long paragraph of an article, with commas, words and a full stop at its end. It goes on for a while, and ends."
    page = f"<html><body><nav><a href=x>Home</a></nav>{start}<p>{text}</p><p>{text} Again.</p></{start[1:].split()[0]}></body></html>"
    assert html_extraction.main_text(page, html_extraction.DEFAULT) == f"{text}\n{text} Again."
    # beside other text of the page the label counts as before
    beside = page.replace("</body>", f"<div><p>{text} One.</p><p>{text} Two.</p><p>{text} Three.</p></div></body>")
    assert html_extraction.main_text(beside, html_extraction.DEFAULT).endswith(f"{text} One.\n{text} Two.\n{text} Three.")


# tokens that always stand together


def test_shared_query_keys_are_one_item(spark):
    """40 keys that 60 bad URLs share are mined in seconds; any one of them blocks, as each alone is a rule."""
    query = "&".join(f"k{i}={i}" for i in range(40))
    rows = [(k, f"https://h{k}.org/p?{query}" if k < 60 else f"https://h{k}.org/p?id=1", k < 60 or k % 50 == 0) for k in range(260)]
    index = url_filters.mine(spark.createDataFrame(rows, "id long, url string, bad boolean"), "url", F.col("bad"))
    probe = [(1, "https://z.org/?k7=x"), (2, "https://z.org/?id=3"), (3, f"https://z.org/?{query}"), (4, None), (5, "https://z.org/?k40=1")]
    got = url_filters.filter_urls(spark.createDataFrame(probe, "page_id long, url string"), index).orderBy("page_id").collect()
    assert [r.mined for r in got] == [True, False, True, False, False]
