"""Operators on single texts and on pairs of texts, against brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from lettings.llm import common, contamination, graph, packing, pii, repeats, secret_scan, simhash, token_counts

SCHEMA = "doc_id long, text string, key string, row long, digit int"
ODD = [
    None,
    "",
    " ",
    "\n\n\t",
    "a",
    "Hello, world! it's 12 o'clock  and  more\r\n",
    "<|endoftext|> and <|startoftext|>",
    "café café İstanbul ΣΣ 日本語 😀".encode("utf-16", "surrogatepass").decode("utf-16"),
    "x" * 30_000,
    "word " * 6_000,
    "tie tie tie",
    "tie tie tie",
]


def frame(spark, texts):
    """Texts with ids from 0; the last two rows repeat an id and lack one. Extra columns clash."""
    rows = [(i, t, "k", 7, 1) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "k", 7, 1), (None, texts[-1], None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def by_row(result, *names):
    return Counter(tuple(r[n] for n in names) for r in result.collect())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def sentences():
    maker = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta", "déjà", "x1", "of", "the", "the"]
    return lambda n: " ".join(maker.choice(words) + maker.choice(["", "", ",", "."]) for _ in range(n))


def test_token_counts_equal_the_library(spark, sentences):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    documents, rows = frame(spark, [*ODD, *(sentences(n) for n in (1, 30, 700))])
    found = by_row(token_counts.counted(documents), "doc_id", "n_bytes", "n_tokens", "over_limit")
    expected = Counter()
    for key, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected[key, len((text or "").encode()), n, n > 512] += 1
    assert found == expected
    assert token_counts.counted(empty(spark)).count() == 0


def test_merging_one_unbroken_run_is_not_quadratic():
    merger = token_counts.merger(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "ab" * 40_000
    assert merger.count(text) == len(library.encode(text).ids)


def test_packing_keeps_every_id_in_gapless_sequences(spark, sentences):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    documents, rows = frame(spark, [*ODD, *(sentences(n) for n in range(5, 900, 9))])
    found = packing.packed(documents, group=16).collect()
    expected, total = Counter(), 0
    for key, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            expected[key, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-total // 4096) + 2
    assert packing.packed(empty(spark)).count() == 0


def library_ids(library, texts):
    return [library.encode(x, add_special_tokens=False).ids for x in texts]


def split_ids(words, texts):
    ids, sizes = words.ids(pa.array(texts, pa.string()))
    assert len(ids) == sizes.sum()
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_packing_looks_at_forms_of_a_word_in_columns(monkeypatch):
    """Capitals and marks make no new word: only small letters reach the model, once each."""
    maker = random.Random(5)
    cores = {"".join(maker.choices("aeioubdéüßñ", k=maker.randint(1, 9))) for _ in range(400)}
    forms = [f(x) + m for x in sorted(cores) for f in (str, str.capitalize) for m in ("", ".", ",", "!?", ".\n")]
    forms = [x for x in forms if not x.startswith("S")]  # a capital sharp s is two letters
    maker.shuffle(forms)
    texts = [" ".join(forms[at : at + 50]) for at in range(0, len(forms), 50)]
    words = packing.Words(public_tokenizers.path(packing.VOCABULARY))
    alone, asked = [], []
    monkeypatch.setattr(words, "_word", lambda x: alone.append(x) or words._whole(x))
    letters = words._letters
    monkeypatch.setattr(words, "_letters", lambda x: asked.append(x) or letters(x))
    assert split_ids(words, texts) == library_ids(words.library, texts)
    assert set(alone) <= {""} and len(asked) == len(set(asked)) <= len(cores)


def test_packing_ids_of_odd_words_equal_the_library(monkeypatch):
    maker = random.Random(7)
    odd = [*"abXYéÉßÿÀñØ×÷µªº .,;:!?|$%&*#'\"-_<>/()03\t\n\r\x0b\x0c\x1c\x85\xa0\u3000\u0301İΣςσДж日😀\u212bẞǅ"]
    odd += ["'s", "<|endoftext|>", "</w>", "e\u0301", "x" * 60, "ñandú" * 20, "ÉCOLE", " ", " ", "the"]
    texts = ["".join(maker.choices(odd, k=maker.randint(0, 40))) for _ in range(3000)] + ["", "É" * 3000 + "!!"]
    words = packing.Words(public_tokenizers.path(packing.VOCABULARY))
    expected = library_ids(words.library, texts)
    assert split_ids(words, texts) == expected
    monkeypatch.setattr(packing, "CACHE", 10)
    assert [x for at in range(0, len(texts), 100) for x in split_ids(words, texts[at : at + 100])] == expected


@pytest.mark.parametrize("bound", [1, 30, 10**6])
def test_texts_are_put_together_up_to_a_bound(monkeypatch, bound):
    monkeypatch.setattr(packing, "TOGETHER", bound)
    texts = ["a" * n if n % 7 else None for n in [*range(20), 100, 0, 0, 45, 3]]
    whole = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["key", "text"])
    parts = [whole.slice(0, 0), whole.slice(0, 9), whole.slice(9, 14), whole.slice(23)]
    found = list(packing._together(iter(parts)))
    rows = [x for part in found for x in zip(part["key"].to_pylist(), part["text"].to_pylist(), strict=True)]
    assert rows == [(n, x or "") for n, x in enumerate(texts)]
    sizes = [[len(x) for x in part["text"].to_pylist()] for part in found]
    assert all(sum(x) - max(x) <= bound for x in sizes)
    assert len(found) == 1 or bound < 10**6
    assert list(packing._together(iter([]))) == []


def test_sum_of_squares_chooses_the_least_sum():
    sizes = np.sort(np.random.default_rng(1).integers(1, 40, 300))[::-1]
    bins, offsets = packing.sum_of_squares(sizes, 64)
    loads = Counter()
    for size, own, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        def after(b, size=size, loads=loads):
            gaps = Counter(64 - x for k, x in {**loads, b: loads[b] + size}.items() if x < 64)
            return sum(n * n for n in gaps.values())

        options = [b for b, load in loads.items() if load + size <= 64] + [max(loads, default=-1) + 1]
        assert offset == loads[own]
        assert after(own) == min(after(b) for b in options)
        loads[own] += size


def brute_contamination(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        own = words(text)
        for s in range(max(1, len(own) - 12) if own else 0):
            windows.setdefault(tuple(own[s : s + 13]), set()).add("null" if item is None else str(item))
    found = Counter()
    for key, text, *_ in rows:
        own, hit, names = words(text), set(), set()
        for width in {len(w) for w in windows}:
            for s in range(len(own) - width + 1):
                if tuple(own[s : s + width]) in windows:
                    hit |= set(range(s, s + width))
                    names |= windows[tuple(own[s : s + width])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found[key, len(own), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(own)] += 1
    return found


@pytest.mark.parametrize("block", [200_000, 80])
def test_contamination_against_brute_force(spark, sentences, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    items = [(1, sentences(40)), (2, "Alpha beta"), (3, None), (4, "!!"), (5, sentences(13)), (1, sentences(20))]
    items += [(None, sentences(14)), (6, "the the the the the the the the the the the the the the")]
    texts = [sentences(n) for n in (3, 50, 400)]
    texts += [texts[1] + " " + items[0][1].upper(), items[0][1][:90], items[4][1], "the " * 15, items[6][1]]
    documents, rows = frame(spark, [*ODD, *texts])
    benchmark = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, key string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_row(contamination.judged(documents, benchmark), *names) == brute_contamination(rows, items)
    kept = contamination.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert kept.count() == sum(n for k, n in brute_contamination(rows, items).items() if not k[-1])


def test_contamination_with_empty_tables(spark):
    documents, rows = frame(spark, ODD)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.judged(documents, none).filter("n_hit = 0").count() == len(rows)
    assert contamination.judged(empty(spark), none).count() == 0


def test_copies_of_items_do_not_fill_a_block(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 100)
    sizes = []

    class Counted(contamination.Windows):
        def __init__(self, chunks):
            sizes.append(sum(len(text.split()) for _, text in chunks))
            super().__init__(chunks)

    monkeypatch.setattr(contamination, "Windows", Counted)
    one = " ".join(f"word{i}" for i in range(20))
    benchmark = spark.createDataFrame([("a", one)] * 200 + [(None, one)] * 200, "item_id string, text string")
    documents = spark.createDataFrame([(1, one), (2, "other words")], "doc_id long, text string")
    found = {r.doc_id: (r.n_hit, r.n_items) for r in contamination.judged(documents, benchmark).collect()}
    assert found == {1: (20, 2), 2: (0, 0)}
    assert max(sizes) <= 100


def test_a_column_called_metadata_hides_no_file(spark, tmp_path):
    rows = [(i, "some words of a text " * (i + 1), "own", 3) for i in range(4)]
    made = spark.createDataFrame(rows, "doc_id long, text string, _metadata string, row_number int")
    made.write.parquet(f"{tmp_path}/rows")
    for documents in (made, spark.read.parquet(f"{tmp_path}/rows")):
        numbered, number = common.numbered(documents)
        assert numbered.select(number).distinct().count() == 4 and "_metadata" in numbered.columns
        assert {r["_metadata"] for r in numbered.select("_metadata").collect()} == {"own"}
        assert repeats.digest(documents).count() == 4
        assert simhash.first_of_each(documents).columns == documents.columns


def test_fifty_blocks_find_what_one_does(spark, monkeypatch):
    items = [(f"i{i}", " ".join(f"w{i}x{k % 9}" for k in range(15))) for i in range(60)]
    texts = [(i, f"some {text} more" if i % 3 else "clean words") for i, (_, text) in enumerate(items)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    made = []

    class Counted(contamination.Windows):
        def __init__(self, chunks):
            made.append(len(chunks))
            super().__init__(chunks)

    one = sorted(tuple(r) for r in contamination.judged(documents, benchmark).collect())
    monkeypatch.setattr(contamination, "Windows", Counted)
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 10)
    several = contamination.judged(documents, benchmark)
    assert len(made) >= 40 and max(made) < 10
    assert sorted(tuple(r) for r in several.collect()) == one
    assert "Union" not in several._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r[2] > 0 for r in one) == 40


def test_proximity_finds_scattered_terms(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    near = "thirteen x eleven x twelve ten nine eight seven six five four three two one"
    far = " ".join(f"{w} " + "gap " * 60 for w in item.split())
    documents = spark.createDataFrame([(1, item), (2, near), (3, far), (4, "one two")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = {r.key: (r["items"], r.near) for r in contamination.matches(documents, benchmark).collect()}
    assert found == {1: (["9"], ["9"]), 2: ([], ["9"]), 3: ([], []), 4: ([], [])}


def test_proximity_has_one_span_for_items_of_every_length(spark):
    # "a" is rarest; b, c and d lie up to 38 words on either side of it, over more than 39 words.
    gap = "gap " * 30
    rows = [(1, f"b {gap} a {gap} c d"), (2, f"b a {gap} c d"), (3, "d x c x b"), (4, "b " + "gap " * 36 + "c d")]
    rows += [(5, "b " + "gap " * 37 + "c d"), (6, "b c d b c d"), (7, f"d c {gap} x {gap} a b c d"), (8, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([("four", "a b c d"), ("three", "b c d"), ("one", "gap")], "item_id string, text string")
    found = {r.doc_id: r for r in contamination.judged(documents, benchmark, proximity=True).collect()}
    near = {r.key: set(r.near) for r in contamination.matches(documents, benchmark).collect()}
    terms = {"four": "abcd", "three": "bcd", "one": ["gap"]}
    for key, text in rows:
        words = text.split()
        spans = [set(words[at : at + 39]) for at in range(len(words))]
        wanted = {item for item, own in terms.items() if any(set(own) <= span for span in spans)}
        assert near[key] == wanted
        assert found[key].n_near == len(wanted)
        assert found[key].near_sha256 == hashlib.sha256(",".join(sorted(wanted)).encode()).hexdigest()


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_simhash_clusters_against_brute_force(spark, sentences):
    long = sentences(900).split()
    near = [" ".join([*long[:i], "changed", *long[i + 1 :]]) for i in range(0, 900, 60)]
    documents, rows = frame(spark, [*ODD, " ".join(long), *near, *(sentences(40) for _ in range(20))])
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(set(prints))
    least = {}
    for (key, *_), p in zip(rows, prints, strict=True):
        if key is not None:
            least[roots[p]] = min(key, least.get(roots[p], key))
    expected = Counter((key, f"{p:016x}", least[roots[p]]) for (key, *_), p in zip(rows, prints, strict=True))
    assert by_row(simhash.clusters(documents), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.first_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.clusters(empty(spark)).count() == 0
    assert simhash.first_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [2, 48])
def test_links_join_the_same_components_with_small_and_large_buckets(spark, bucket):
    maker = random.Random(2)
    prints = {maker.getrandbits(64) for _ in range(30)}
    for base in list(prints)[:4]:
        prints |= {base ^ (1 << maker.randrange(64)) ^ (1 << maker.randrange(64)) for _ in range(40)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    found = graph.components(simhash.links(table, bucket=bucket)).collect()
    groups, expected = {}, {}
    for r in found:
        groups.setdefault(r.root, set()).update((r.node % (1 << 64), r.root % (1 << 64)))
    for p, root in brute_components(prints).items():
        expected.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 200)]
    found = graph.components(spark.createDataFrame(chain, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 130)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    found = Counter()
    for (key, *_), t in zip(rows, texts, strict=True):
        covered = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                covered[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        found[key, len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()] += 1
    return found


@pytest.mark.parametrize("kinds", [20_000, 0])
def test_repeats_against_brute_force(spark, sentences, monkeypatch, kinds):
    monkeypatch.setattr(repeats, "KINDS", kinds)
    passage = sentences(60)
    texts = [sentences(20) + passage + sentences(25), passage[:230], passage[3:210], "p" * 250, "q" * 201, "q" * 199]
    texts += [("ab" * 500) + sentences(30), sentences(80) * 2, passage[:150] + "!" + passage[151:], sentences(9)]
    texts += [passage + "ü" * 150, "ü" * 150 + passage[5:], *ODD[:8], "x" * 3_000]
    documents, rows = frame(spark, texts)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert by_row(repeats.digest(documents), *names) == brute_repeats(rows)
    assert repeats.digest(empty(spark)).count() == 0


def test_groups_of_equal_hashes_are_compared_byte_by_byte(monkeypatch):
    monkeypatch.setattr(repeats.Grams, "at", lambda self, starts, lengths: np.zeros(len(starts), np.uint64))
    runs = [b"a" * 200, b"b" * 200, b"a" * 200]
    flags = repeats.repeated_windows(runs, np.zeros(3, np.uint64))
    assert [f.tolist() for f in flags] == [[True], [False], [True]]


PII = [
    "mail a.b%c@x-y.org, or b@c.d_e@f.gh or @x.y a@b",
    "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111",
    "phone +1 (505) 555-1941 +1 (505) 555-1942 4111111111111111 +44 20",
]


def brute_pii(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"]
    patterns += [r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    found = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_of_personal_data_against_brute_force(spark):
    maker = random.Random(8)
    letters = [*"0123456789..@@aB_%+-- ()\n14", "4111111111111111", "+1 (505) 555-1941", "a@b.c"]
    texts = PII + ["".join(maker.choice(letters) for _ in range(maker.randrange(40))) for _ in range(3000)]
    for text in texts:
        assert pii.base_spans(text) == brute_pii(text)
    documents, rows = frame(spark, [*ODD, *texts[:60]])
    result = pii.found(documents)
    expected = Counter()
    for key, text, *_ in rows:
        spans = brute_pii(text or "")
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        expected[key, *counts, hashlib.sha256(pii.listed(spans).encode()).hexdigest()] += 1
    assert by_row(result, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == expected
    assert pii.found(empty(spark)).count() == 0


def test_the_field_adds_what_patterns_drop_and_leaves_other_numbers(spark):
    maker = random.Random(9)

    def text():
        number = f"+1 ({maker.randrange(200, 999)}) 555-{maker.randrange(1000, 9999)}"
        mail = f"{maker.choice('abcdef')}{maker.choice('xyz')}.{maker.randrange(10, 99)}@m{maker.randrange(9)}.example.org"
        return maker.choice([f"call {number} now", f"write to {mail} or", "version 3. of 12 items", "code 9f8e7d6c5b4a3f2e1d"])

    weights = pii.train(sorted({(w, tuple(s)) for _ in range(300) for w, s in pii._examples(text())}))
    _, added = pii.all_spans("so +1 (505) 555-1941 4111111111111112 it is", weights)
    assert (3, 3, 20) in added
    _, added = pii.all_spans("call (505) 555-1941 now", weights)
    assert added == [(5, 3, 19)]
    for clean in ("version 3. of 12 items", "code 9f8e7d6c5b4a3f2e1d", "on 2024-01-02 at 12:30"):
        assert pii.all_spans(clean, weights) == ([], [])


def test_redaction_keeps_columns_and_nulls(spark):
    documents, rows = frame(spark, [*ODD, *PII])
    found = pii.redacted(documents)
    assert found.columns == documents.columns
    texts = {r.text for r in found.collect()}
    assert None in texts and any("[EMAIL]" in (t or "") for t in texts)
    assert not any(pii.base_spans(t or "") for t in texts)


def odd_window(state):
    return "".join(state.choices("+.()- @_%/12345ab\n\t\u00b2\u0663\u00e9,", k=state.randint(1, 90)))


def test_segments_in_arrays_have_the_features_of_one_segment():
    state = random.Random(3)
    for _ in range(300):
        text = odd_window(state)
        for a, b in pii.windows(text):
            cut = [(x + a, y + a) for x, y in pii.units(text[a:b])]
            wanted = {
                (i, j): sorted(pii.features(text, cut[i][0], cut[j - 1][1]))
                for i in range(len(cut))
                for j in pii.segments_from(text, cut, i)
            }
            own = pii.Segments(text, [(*x, 0) for x in cut], len(cut))
            found = {
                (i, j): sorted([*numbers, *(pii._NUMBER[name] for name, holds in zip(pii._FLAGS, flags, strict=True) if holds)])
                for i, j, numbers, flags in zip(
                    own.first.tolist(), own.last.tolist(), own.features.tolist(), own.flags.tolist(), strict=True
                )
            }
            assert found == wanted


def test_decoding_against_all_segmentations(monkeypatch):
    """The best of all choices of segments and kinds, found by trying each; blocks of units lose none."""
    state = random.Random(4)
    monkeypatch.setattr(pii, "UNITS", 3)
    for round_ in range(60):
        weights = np.random.default_rng(round_).normal(0, 1, (len(pii._NAMES), len(pii.KINDS)))
        text = "".join(state.choices("1a@.+ -", k=8))
        segments = [
            (cut[i][0], cut[j - 1][1])
            for a, b in pii.windows(text)
            for cut in [[(x + a, y + a) for x, y in pii.units(text[a:b])]]
            for i in range(len(cut))
            for j in pii.segments_from(text, cut, i)
        ]
        scores = {x: weights[pii.features(text, *x)].sum(0) for x in segments}

        def best(free, scores=scores):
            later = [(x, scores[x].max()) for x in scores if x[0] >= free]
            return max([0.0, *(score + best(x[1]) for x, score in later)])

        spans = pii.decoded(text, pii.windows(text), weights)
        assert all(x[2] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert math.isclose(sum(scores[a, b][kind] for a, kind, b in spans), best(0), abs_tol=1e-9)


def test_gradient_of_the_field_against_differences():
    window = pii.Window("a@b.co 12")
    gold = window.gold([(0, 0, 6)])
    weights = np.random.default_rng(5).normal(0, 0.3, (len(pii._NAMES), len(pii.KINDS)))

    def likelihood(weights):
        scores = window.scores(weights)
        by_end = [[0.0]]
        for j in range(1, len(window.bounds) + 1):
            ways = [np.logaddexp.reduce(by_end[j - 1])]
            ways += [np.logaddexp.reduce(by_end[i]) + x for at, (i, e) in enumerate(window.segments) if e == j for x in scores[at]]
            by_end.append(ways)
        own = sum(scores[window.segments.index(x), kind] for x, kind in gold.items())
        return own - np.logaddexp.reduce(by_end[-1])

    slope = np.zeros_like(weights)
    for segment, change in window.gradient(weights, gold).items():
        np.add.at(slope, window.features[segment], change)
    for name in ("always", "at", "letters", "after_blank"):
        for kind in range(len(pii.KINDS)):
            step = np.zeros_like(weights)
            step[pii._NUMBER[name], kind] = 1e-5
            wanted = (likelihood(weights + step) - likelihood(weights - step)) / 2e-5
            assert math.isclose(slope[pii._NUMBER[name], kind], wanted, abs_tol=2e-3)


def test_a_long_unbroken_text_keeps_its_spans():
    text = "1a" * 60_000 + "x@example.org" + "0f" * 20_000
    weights = np.zeros((len(pii._NAMES), len(pii.KINDS)))
    weights[pii._NUMBER["always"]] = -1
    base, added = pii.all_spans(text, weights)
    assert base == pii.base_spans(text) and len(base) == 1 and added == []


def brute_secrets(text):
    keys = "password|passwd|secret|token|api_?key"
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in keys)
    assign = rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_against_brute_force_and_random_strings(spark):
    maker = random.Random(12)
    parts = ["token", "PassWord", "api_key", "apikey", "=", ": ", '"', "'", "AKIA", "ABCDEFGHIJKLMN12", " ", "é", "0123456789abcdef", "short", "==", "averylongvalue_1"]
    texts = ["".join(maker.choice(parts) for _ in range(maker.randrange(14))) for _ in range(400)]
    letters = secret_scan.ENCODINGS[-2][1]
    random_text = "key " + "".join(maker.choice(letters) for _ in range(44)) + " end"
    natural = "a " + "thentionerestingandtheotherthing" + " b " + "=" * 30 + " " + "abcabcabcabcabcabcabcabcabc"
    many = " ".join(f"{i:017x}" for i in range(700))
    documents, rows = frame(spark, [*ODD, *texts, random_text, natural, many])
    result = secret_scan.digest(documents).collect()
    expected = Counter()
    for key, text, *_ in rows:
        spans = brute_secrets(text or "")
        listed = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        expected[key, *counts, hashlib.sha256(listed.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in result) == expected
    by_id = {r.doc_id: r for r in result}
    place = len(ODD) + len(texts)
    assert by_id[place].spans == "random:4:48"
    assert by_id[place + 1].n_random == 0
    assert secret_scan.digest(empty(spark)).count() == 0


def exact_chi_squared_tail(x, odd):
    """Chance that chi-squared with an odd number of degrees of freedom exceeds ``x``."""
    term, total = 1.0, 0.0
    for i in range(1, (odd - 1) // 2 + 1):
        total += term
        term *= x / (2 * i + 1)
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * total


def battery(text):
    """The three tests with exact tails."""
    bare = text.rstrip("=")
    alphabet = next(letters for shape, letters in secret_scan.ENCODINGS if re.search(shape, bare))
    places = np.array([alphabet.find(c) + 1 for c in bare])
    n, k = len(bare), len(alphabet)
    chi = sum(bare.count(c) ** 2 for c in alphabet) * k / n - n
    high = places > k / 2
    ups = int(high.sum())
    runs = 2 * ups * (n - ups) / n + 1
    spread = max((runs - 1) * (runs - 2) / (n - 1), 0.25)
    off = places - places.mean()
    serial = (off[1:] * off[:-1]).sum() / (off * off).sum() if off.any() else None
    z2 = abs(1 + int((high[1:] != high[:-1]).sum()) - runs) / math.sqrt(spread)
    z3 = 40 if serial is None else abs(serial + 1 / n) * math.sqrt(n)
    tails = exact_chi_squared_tail(max(chi, 0), k - 1), math.erfc(z2 / math.sqrt(2)), math.erfc(z3 / math.sqrt(2))
    return min(1.0, 3 * min(tails))


def test_battery_against_exact_tails(spark):
    maker = random.Random(21)
    texts = ["abc" * 9, "0" * 25, "thequickbrownfoxjumpsoverthelazydog", "/usr/local/share/applications/x"]
    for _, letters in secret_scan.ENCODINGS:
        for size in (20, 33, 64, 200):
            texts.append("".join(maker.choice(letters) for _ in range(size)))
            texts.append("".join(maker.choice(letters[: len(letters) // 2]) for _ in range(size)) + "==")
    given = spark.createDataFrame([(x,) for x in texts], "m string")
    found = {r.m: r.p for r in secret_scan.with_p_value(given).select("m", "p").collect()}
    assert all(abs(found[x] - battery(x)) < 0.015 for x in texts)


def test_bounds_follow_benjamini_and_hochberg(spark):
    maker = random.Random(22)
    rows = [(c, maker.random() ** (1 + 6 * c)) for c in (0, 1, 2) for _ in range(300)] + [(3, 0.9), (3, 0.0)]
    given = spark.createDataFrame(rows, "class int, p double")
    found = {r["class"]: r.bound for r in secret_scan.bounds(given).collect()}
    for kind in range(4):
        # A value stands as the upper end of its eighth of a power of ten.
        steps = [min(math.floor(-math.log10(max(p, 1e-30)) * 8), 160) for c, p in rows if c == kind]
        uppers = sorted(10 ** (-s / 8) for s in steps)
        passed = [u for rank, u in enumerate(uppers, 1) if u * len(uppers) <= secret_scan.LEVEL * rank]
        assert (found[kind] is None) == (not passed)
        assert not passed or math.isclose(found[kind], max(passed))


def test_secret_scan_runs_no_python(spark):
    documents, _ = frame(spark, ODD)
    plan = secret_scan.digest(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
