"""Importance resampling, clustering and address filters, against brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettings.llm import centroids, resampling, url_filter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score string, row long, key int"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def by_hand(rows, target, longest, buckets, seed, least, percent):
    """Sorted results of the whole operator, in plain Python."""

    def features(text):
        words = words_of(text)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return words, [zlib.crc32(run.encode()) % buckets for run in runs]

    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, text in rows:
        np.add.at(s, features(text)[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets))))
        for b in range(buckets)
    ]
    scored = []
    for key, text in rows:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([key, len(words), len(found), weight, score])
    enough = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = percent * len(enough) // 100
    found = [(x[0], x[2], x[3], x[4], place + 1) for place, x in enumerate(enough[:drawn])]
    found += [(x[0], x[2], x[3], x[4], None) for x in enough[drawn:]]
    return sorted(found + [(x[0], x[2], x[3], x[4], None) for x in scored if x[1] < least], key=repr)


def result(frame):
    return sorted((tuple(row) for row in frame.select("key", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_drawn_documents_equal_brute_force(spark, monkeypatch, longest):
    """Small chunks, so that medians of medians of medians are taken; odd texts, nulls and repeats."""
    monkeypatch.setattr(resampling, "CHUNK", 7)
    monkeypatch.setattr(resampling, "PARTS", 3)
    monkeypatch.setattr(resampling, "FINISH", 4)
    monkeypatch.setattr(resampling, "PIECE", 40)
    maker = random.Random(5)
    pool = ["Alpha", "beta", "été", "x1", "42", "日本", "the", "the", "of"]
    texts = [" ".join(maker.choice(pool) for _ in range(maker.randrange(30))) for _ in range(300)]
    texts += [None, "", " .!", "İ😀 K", "long" * 5000, "one two " * 3000]
    rows = [(i, text) for i, text in enumerate(texts)] + [(5, texts[5]), (5, texts[5]), (None, "a b c d e f g h")]
    documents = spark.createDataFrame([(k, x, "s", 1, 2) for k, x in rows], SCHEMA).repartition(5)
    target = spark.createDataFrame([("beta été beta x1",), (None,), ("the alpha",)], "text string")
    got = result(resampling.drawn(documents, target, longest=longest, buckets=97, least_words=3, percent=37))
    assert got == by_hand(rows, [r.text for r in target.collect()], longest, 97, 2024, 3, 37)


def test_empty_tables_and_draws_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resampling.digest(none, none).columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert resampling.digest(none, none).count() == 0
    few = spark.createDataFrame([(1, "a b c", "s", 1, 2)], SCHEMA)
    assert [r.rank for r in resampling.digest(few, none).collect()] == [None]


@pytest.mark.parametrize("drawn", [1, 2, 999, 1000, 1501, 2999, 3000])
def test_cutoff_is_exact_among_ties(spark, monkeypatch, drawn):
    monkeypatch.setattr(resampling, "CHUNK", 64)
    monkeypatch.setattr(resampling, "FINISH", 8)
    keys = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("score"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 4).alias("key"),
        F.col("id").alias("row"),
    ).repartition(6).cache()
    pivot = resampling.cutoff(keys, drawn)
    kept = keys.filter(~resampling._after(pivot))
    assert kept.count() == drawn
    order = resampling.in_order()
    assert [tuple(r) for r in keys.orderBy(*order).limit(drawn).collect()] == [
        tuple(r) for r in kept.orderBy(*order).collect()
    ]
    ranks = resampling.ranked(kept).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, drawn + 1))
    assert [r.row for r in ranks] == [r.row for r in kept.orderBy(*order).collect()]


# --- clustering ----------------------------------------------------------------------------------


def lloyd(rows, components, scale, clusters, rounds, seed):
    kept = [
        (key, [math.floor(scale * x) for x in vector])
        for key, vector in rows
        if vector is not None and len(vector) == components and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def hashed(row):
        text = f"{seed}:{'' if row[0] is None else row[0]}"
        return hashlib.sha256(text.encode()).hexdigest(), np.array(row[1], "<i4").tobytes()

    centers = [x for _, x in sorted(kept, key=hashed)[:clusters]]

    def assign():
        apart = [[sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centers] for _, x in kept]
        return [(row.index(min(row)), min(row)) for row in apart]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centers)):
            own = [x for (_, x), (at, _) in zip(kept, found, strict=True) if at == c]
            if own:
                centers[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return sorted((key, c, d) for (key, _), (c, d) in zip(kept, assign(), strict=True)), centers


def test_clusters_equal_lloyd(spark):
    maker = np.random.default_rng(3)
    middles = maker.normal(0, 1, (7, 8))
    rows = [(i, (middles[i % 7] + maker.normal(0, 0.3, 8)).tolist()) for i in range(400)]
    rows += [(1000, rows[0][1]), (1001, [1e9] * 8), (1002, [-3.5] * 8)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] * 8), (2004, [float("nan")] * 8), (2005, [float("inf")] * 8)]
    rows = [(k, v if k != 1001 else [2e6] * 8) for k, v in rows]
    given = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<double>, key int, cluster int")
    for bits in (2, 6):
        found, centers = centroids.clustered(given.repartition(4), components=8, clusters=9, rounds=3, bits=bits)
        want, want_centers = lloyd(rows, 8, 64, 9, 3, 1)
        assert sorted(tuple(r) for r in found.collect()) == want
        assert centers.tolist() == want_centers


def test_cluster_digest_of_few_rows_and_of_none(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert centroids.digest(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(4, [0.5] * 64, 1), (4, [0.5] * 64, 1), (9, [0.25] * 64, 1)], schema)
    rows = centroids.digest(few).collect()
    assert len(rows) == 3 and {r.inertia for r in rows} == {0}
    nulls = spark.createDataFrame([(None, [0.5] * 64, None), (1, [None] * 64, 1)], schema)
    assert [(r.vec_id, r.cluster, r.distance) for r in centroids.digest(nulls).collect()] == [(None, 0, 0)]


def test_intervals_hold_the_distances_and_packing_is_exact():
    maker = np.random.default_rng(8)
    whole = np.clip(maker.normal(0, 9, (500, 16)).round(), -60, 60).astype(np.int64)
    centers = whole[:5]
    distance = ((whole[:, None, :] - centers) ** 2).sum(2)
    for bits in (1, 3, 6):
        bounds = centroids.cell_bounds(whole[:80], bits)
        cells = centroids.cells_of(whole, bounds)
        assert cells.max() < 1 << bits
        assert (centroids.unpacked(centroids.packed(cells, bits), 16, bits) == cells).all()
        possible = centroids.candidates(cells, centroids.lookup(bounds, centers))
        assert possible[np.arange(500), distance.argmin(1)].all()
        assert (centroids.nearest(possible, whole, centers) == distance.argmin(1)).all()
    assert (possible.sum(1) == 1).mean() > 0.5


# --- addresses -----------------------------------------------------------------------------------


def verdict(url, entries):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h) + len(p), len(h), h + p, kind)
        for h, p, kind in entries
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rules = [x for x in fits if x[3] != "listed"]
    if rules:
        best = max(x[:3] for x in rules)
        kinds = {x[3] for x in rules if x[:3] == best}
        return host, path, best[2], "block" if "block" in kinds else "allow"
    return host, path, None, "block" if fits else "allow"


ODD_URLS = [
    None, "", "nothing", "http://", "http://net", "http://net/", "://NET/en/", "http://a.net?x=/en/", "http://example.net/en",
    "http://www.Example.NET/en/1#top", "http://example.net/EN/1", "http://badexample.net/en/1", "http://x.org/fr/1?u=http://y.net/",
    "http://example.com/de/", "http://example.com/de", "http://example.com.net/de/", "http://a..net/x", "http://.net/x",
    "http://İ.org/fr/é", "ftp://u:p@free-bets.example.com/x", "http://www.free-bets.example.com", "http://freeXbets.example.com/x",
    "http://" + "a." * 3000 + "org/fr/" + "b" * 5000, "http://spam-farm.example.net/en/2", "http://example.net:80/en/",
]


def test_addresses_of_the_query(spark):
    rows = [(i, url, "h", "r") for i, url in enumerate(ODD_URLS)] + [(1, None, None, None), (None, ODD_URLS[5], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = sorted((tuple(r) for r in url_filter.digest(pages).collect()), key=repr)
    entries = url_filter.RULES + url_filter.JUNK_HOSTS
    assert got == sorted(((k, *verdict(url, entries)) for k, url, *_ in rows), key=repr)
    assert url_filter.digest(pages.limit(0)).count() == 0


@pytest.mark.parametrize("filter_bits", [1 << 28, 600])
def test_many_rules_in_one_and_in_several_parts(spark, filter_bits):
    maker = random.Random(2)
    names = [f"{a}{b}" for a in "abcdef" for b in range(40)]

    def host():
        return ".".join([maker.choice(names) for _ in range(maker.randrange(1, 3))] + [maker.choice(["com", "net"])])

    entries = [
        (host(), maker.choice(["", "/", "/x", "/x/y/"]), maker.choice(["allow", "block", "listed"])) for _ in range(150)
    ]
    pages = [
        (i, f"http://{maker.choice(['', 'www.'])}{host() if i % 2 else maker.choice(entries)[0]}{maker.choice(['', '/', '/x/', '/x/y/z?q'])}")
        for i in range(1500)
    ]
    rules = url_filter.entries(spark, [*entries, entries[0], (None, "/", "block"), ("com", "/", "other")])
    frame = spark.createDataFrame(pages, "page_id long, url string").repartition(3)
    got = sorted(tuple(r) for r in url_filter.judged(frame, rules, filter_bits=filter_bits).collect())
    assert got == sorted((k, *verdict(url, entries)) for k, url in pages)


def test_no_rules_allow_everything(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    rows = url_filter.judged(pages, url_filter.entries(spark, RULES_OF_NONE)).collect()
    assert [tuple(r) for r in rows] == [(1, "a.net", "/x", None, "allow")]


RULES_OF_NONE: list = []


def test_cascade_needs_several_levels_and_is_exact(spark):
    """Many listed keys among more others: first filters make mistakes, later ones undo them."""
    codes = spark.range(6000).select(
        F.xxhash64("id", F.lit("a")).alias("a"),
        F.xxhash64("id", F.lit("b")).alias("b"),
        (F.col("id") % 3 == 0).alias("allow"),
        (F.col("id") % 2 == 0).alias("block"),
        F.lit(False).alias("listed"),
    ).cache()
    filters = url_filter.cascades(codes)
    assert set(filters) == {"allow", "block"} and len(filters["block"]) > 2
    rows = codes.toPandas()
    a, b = (rows[x].to_numpy().view(np.uint64) for x in ("a", "b"))
    for kind, levels in filters.items():
        assert (url_filter.contains(levels, a, b) == rows[kind].to_numpy()).all()
        assert sum(level.shape.bits for level in levels) < 6 * 6000
