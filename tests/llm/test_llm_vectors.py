"""Codes, hard negatives and URL classes against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from covermonth.llm.codes import Book, decode, encode
from covermonth.llm.negatives import angles_to, bounds, hard_negatives
from covermonth.llm.redirects import Rule, judge, links

VECTORS = "vec_id long, embedding array<float>, label int"
CLASHING = ["n", "q", "code", "error", "angles", "anchor", "slot", "score", "id", "node", "root",
            "url", "host", "path", "link", "rank", "chunk"]
NAN, INF = float("nan"), float("inf")


def with_clashes(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)
                            if c not in df.columns])


def vectors(seed, count, length=32, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, length))
    return [(i, [float(x) for x in centres[i % 5] + spread * rng.normal(size=length)], i % 4)
            for i in range(count)]


UNUSABLE = [(900, None, 1), (901, [], 1), (902, [1.0, None] * 16, 1), (903, [NAN] * 32, 2),
            (904, [INF] + [0.0] * 31, 2), (905, [1.0] * 48, 3)]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Full search and averages, one part at a time."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // parts
    ids = []
    for r in kept:
        if r[0] not in [i for i, _ in ids] and len(ids) < entries:
            ids.append((r[0], r[1]))
    books = [[v[p * width:(p + 1) * width] for _, v in ids] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k)
                   for k, e in enumerate(books[p]))

    def cut(v, p):
        return v[p * width:(p + 1) * width]

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(p, cut(v, p))[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k], strict=True)]
                        if k in members else e for k, e in enumerate(books[p])]
    found = []
    for i, v, label in kept:
        best = [nearest(p, cut(v, p)) for p in range(parts)]
        found.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    text = ",".join(str(c) for book in books for e in book for c in e)
    return found, hashlib.sha256(text.encode()).hexdigest()


def test_codes_are_those_of_a_full_search(spark):
    rows = vectors(1, 300) + vectors(1, 40)  # repeated rows
    rows += [(None, rows[5][1], None), (2000, rows[7][1], None)]
    expected, digest = plain_codes(rows)
    df = with_clashes(spark.createDataFrame(rows, VECTORS)).repartition(5)
    found = encode(df).collect()
    by_label = {}
    for _, _, error, label in expected:
        by_label[label] = by_label.get(label, 0) + error
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in found) == sorted(
        (repr(i), code, error, by_label[label]) for i, code, error, label in expected)
    assert {r["codebooks_sha256"] for r in found} == {digest}


@pytest.mark.parametrize("copies", [1, 3, 90])
def test_codes_of_fewer_vectors_than_entries_and_of_ties(spark, copies):
    rows = [(i, [float(i % 2)] * 16, 0) for i in range(copies)] + [(500, [0.5] * 16, 1)]
    expected, digest = plain_codes(rows)
    found = encode(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in found) == [
        (i, code, error) for i, code, error, _ in expected]
    assert found[0]["codebooks_sha256"] == digest


def test_codes_of_unusable_vectors_and_empty_tables(spark):
    rows = vectors(3, 80) + UNUSABLE
    found = {r["vec_id"]: r for r in encode(spark.createDataFrame(rows, VECTORS)).collect()}
    assert set(found) == set(range(80)) | {901, 905}
    for other in (901, 905):  # of other lengths
        assert found[other]["code"] is None and found[other]["error"] is None
    assert encode(spark.createDataFrame([], VECTORS)).collect() == []
    assert encode(spark.createDataFrame(UNUSABLE[:1], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        encode(spark.createDataFrame([(1, [1.0] * 15, 0)], VECTORS))


def test_rings_leave_out_no_candidate():
    rng = np.random.default_rng(5)
    entries = rng.integers(-20, 20, (2, 30, 3))
    points = rng.integers(-25, 25, (4000, 6))
    squares = [((points[:, 3 * p:3 * p + 3][:, None] - entries[p][None]) ** 2).sum(-1)
               for p in range(2)]
    whole = np.stack([s.argmin(1) for s in squares], 1)
    book = Book(entries)
    codes, distances = book.assign(points, np.zeros((4000, 2), np.int64))
    assert (codes == whole).all()
    assert (distances == np.stack([s.min(1) for s in squares], 1)).all()
    # After a move, the radii of the balls bound the search as well.
    sums = np.array([[points[codes[:, p] == k, 3 * p:3 * p + 3].sum(0) for k in range(30)]
                     for p in range(2)])
    counts = np.array([np.bincount(codes[:, p], minlength=30) for p in range(2)])
    widest = np.array([[distances[codes[:, p] == k, p].max(initial=0) for k in range(30)]
                       for p in range(2)])
    moved = book.moved(sums, counts, widest)
    again, _ = moved.assign(points, codes)
    squares = [((points[:, 3 * p:3 * p + 3][:, None] - moved.entries[p][None]) ** 2).sum(-1)
               for p in range(2)]
    assert (again == np.stack([s.argmin(1) for s in squares], 1)).all()
    left_out = sum(len(near) < 29 for part in moved.neighbours for near in part)
    assert left_out > 0


def test_codes_can_be_read_back(spark):
    entries = np.arange(2 * 3 * 2).reshape(2, 3, 2)
    df = spark.createDataFrame([("0200",), (None,)], "code string")
    assert [r[0] for r in df.select(decode(F.col("code"), Book(entries), spark)).collect()] == [
        [4, 5, 6, 7], None]


def plain_negatives(rows, every=5, positives=5, negatives=3):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label)
            for i, v, label in rows]
    out = []
    for a, (anchor, q, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p, strict=True)), i is None, i or 0, k)
                  for k, (i, p, _) in enumerate(kept) if k != a and len(p) == len(q)]
        same = sorted(s for s in scored if kept[s[3]][2] == label)[:positives]
        other = sorted(s for s in scored if kept[s[3]][2] != label)
        for s in same:
            fit = [o for o in other if 50 * -s[0] <= 100 * -o[0] <= 95 * -s[0]][:negatives]
            out += [(anchor, kept[s[3]][0], rank, kept[o[3]][0], -s[0], -o[0])
                    for rank, o in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("length,spread", [(32, 0.3), (4, 1.5), (16, 0.0)])
def test_negatives_are_those_of_all_pairs(spark, length, spread):
    rows = vectors(7, 400, length, spread)
    rows += rows[:30]  # repeated rows, anchors among them
    rows += [(None, rows[3][1], 2), (3001, [0.0] * length, 1), (3000, [0.0] * length, 1),
             (3005, rows[1][1] * 2, 1), (3010, rows[2][1] * 2, 2)]
    df = with_clashes(spark.createDataFrame(rows, VECTORS)).repartition(6)
    found = hard_negatives(df, F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, plain_negatives(rows)))


def test_negatives_in_chunks(spark, monkeypatch):
    from covermonth.llm import negatives

    monkeypatch.setattr(negatives, "CHUNK", 16)
    rows = vectors(8, 300, 8, 1.0)
    found = hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, found)) == sorted(plain_negatives(rows))


def test_negatives_of_unusable_rows(spark):
    rows = [(0, [1.0] * 4, None), (50, None, 1), (100, [NAN] * 4, 1), (5, [1.0, None], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    for some in (df, df.limit(0)):
        out = hard_negatives(some, F.col("vec_id") % 5 == 0)
        assert out.collect() == []
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                               "positive_score", "negative_score"]
    text = spark.createDataFrame([(0, [2.0], "a"), (1, [2.0], "a"), (2, [1.5], "b")],
                                 "vec_id long, embedding array<double>, label string")
    found = hard_negatives(text, F.col("vec_id") == 0, low=Fraction(1, 2), high=Fraction(95, 100))
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 2, 512 * 512, 512 * 384)]


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 6)) * 100
    points[:40] = points[40:80] * rng.uniform(0.5, 2, (40, 1))  # the same directions
    directions = rng.normal(size=(4, 6))
    directions /= np.linalg.norm(directions, axis=1)[:, None]
    angles = angles_to(points, directions)
    least, most = bounds(angles, np.cos(angles).T.astype(np.float32),
                         np.sin(angles).T.astype(np.float32))
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    cosines = unit @ unit.T
    assert (cosines <= most + 4e-6).all() and (cosines >= least - 4e-6).all()
    assert (most - least).mean() < 1.5  # and they say something


RULES = [Rule("allow", "org", "/"), Rule("block", "bad.org", "/x/"), Rule("block", "com", "/de/"),
         Rule("allow", "ok.com", "/de/")]


def page(*tags, body=""):
    return f"<html><head>{''.join(tags)}</head><body>{body}</body></html>"


def canonical(href):
    return f'<link rel="canonical" href="{href}">'


def test_blocks_follow_links_but_not_over_allowing_rules(spark):
    rows = [
        (1, "http://bad.org/x/1", None), (2, "https://a.net/1", page(canonical("http://bad.org/x/1"))),
        (3, "http://A.net/2#top", page('<META http-equiv=refresh content="0; url=/1">')),
        (4, "http://free.net/", page()), (5, "http://good.org/", page(canonical("http://a.net/2"))),
        (6, "http://b.net/", page(canonical("http://good.org/"))), (7, None, page(canonical("/1"))),
        (8, "no address", page(canonical("http://bad.org/x/1"))), (9, "http://a.net/1", None),
        (9, "http://a.net/1", None), (10, "http://x.com/de/", ""), (11, "http://sub.OK.com/de/?q", ""),
        (12, "http://c.net/t/u", page(canonical("../1?a=1&amp;b=2"))),
        (13, "http://c.net/1?a=1&b=2", page('<link href=http://x.com/de/ rel=canonical>')),
        (14, "http://d.net/", page(body=canonical("http://bad.org/x/1"))),
        (15, "http://e.net/", page("<!--", canonical("http://bad.org/x/1"), "-->")),
        (16, "http://f.net/", page(canonical("mailto:a@bad.org"), "<link rel=canonical"))]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = judge(df, RULES).collect()
    assert len(found) == len(rows)
    verdicts = {r["page_id"]: (r["rule"], r["verdict"], r["blocked_by"]) for r in found}
    for blocked in (2, 3, 6, 9):
        assert verdicts[blocked] == (None, "block", "bad.org/x/1")
    assert verdicts[1] == ("bad.org/x/", "block", None)
    assert verdicts[5] == ("org/", "allow", None)  # its own rule, although its class is blocked
    for blocked in (12, 13):
        assert verdicts[blocked] == (None, "block", "x.com/de/")
    assert verdicts[10] == ("com/de/", "block", None)
    assert verdicts[11] == ("ok.com/de/", "allow", None)
    for free in (4, 7, 8, 14, 15, 16):
        assert verdicts[free] == (None, "allow", None)
    by_id = {r["page_id"]: (r["host"], r["path"]) for r in found}
    assert by_id[7] == by_id[8] == ("", "") and by_id[3] == ("a.net", "/2")
    assert by_id[11] == ("sub.ok.com", "/de/")


def test_given_redirects_join_classes(spark):
    pages = spark.createDataFrame([(1, "http://a.net", ""), (2, "http://b.net/q?x=1", "")],
                                  "page_id long, url string, html string")
    moves = spark.createDataFrame(
        [("http://a.net/", "https://t.net:443/go"), ("http://t.net/go", "http://bad.org/x/"),
         ("http://b.net/q?x=2", "http://bad.org/x/"), (None, "http://bad.org/x/"), ("http://z.net", None)],
        "source string, target string")
    found = {r["page_id"]: r["verdict"] for r in judge(pages, RULES, moves).collect()}
    assert found == {1: "block", 2: "allow"}
    assert judge(pages.limit(0), RULES, moves).collect() == []


def test_a_target_of_very_many_pages(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://m.net/"), "id").alias("url"),
        F.lit(page(canonical("http://bad.org/x/hub"))).alias("html"))
    assert judge(pages, RULES).where("verdict = 'block'").count() == 3000


def test_links_of_long_and_broken_pages(spark):
    rows = [("http://a.net/", "<link " * 20_000), ("http://a.net/", "<meta content='" + "x" * 100_000),
            ("http://a.net/", None), ("http://a.net/", ""),
            ("http://a.net/", canonical("http://b.net/") + "<p>" * 50_000)]
    found = links(spark.createDataFrame(rows, "url string, html string"))
    assert [r["target"] for r in found.where("target is not null").collect()] == ["b.net/"]


def test_a_longer_rule_wins_and_allows_among_equal_ones(spark):
    rules = [Rule("block", "b.org", "/aaa"), Rule("allow", "a.b.org", "/"), Rule("allow", "org", "/aa")]
    random.Random(1).shuffle(rules)
    pages = spark.createDataFrame([(1, "http://a.b.org/aaa/", "")], "page_id long, url string, html string")
    assert judge(pages, rules).first()["verdict"] == "block"
    rules = [Rule("block", "b.org", "/aab"), Rule("allow", "a.b.org", "/a")]
    pages = spark.createDataFrame([(1, "http://a.b.org/aab", "")], "page_id long, url string, html string")
    assert judge(pages, rules).first()["rule"] == "a.b.org/a"
